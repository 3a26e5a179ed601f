"""Views that derive the product model from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def product_facts(lineitem: DataFrame) -> DataFrame:
    """One pass over the lines: rating, reviews, stock, lead supplier and dates per part."""
    qty = F.col("l_quantity")
    return lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count(F.when(F.col("l_returnflag") != "R", 1)).alias("n_kept"),
        F.sum(F.when(F.col("l_returnflag") == "A", qty)).cast("int").alias("reviews_count"),
        F.sum(F.when(F.col("l_linestatus") == "O", qty)).cast("int").alias("quantity"),
        F.coalesce(F.sum(F.when(F.col("l_linestatus") == "O", qty)), F.lit(0.0)).alias("qty_open"),
        F.coalesce(F.sum(F.when(F.col("l_linestatus") == "F", qty)), F.lit(0.0)).alias("qty_done"),
        F.min("l_suppkey").alias("lead_supplier"),
        F.min("l_shipdate").alias("created_at"),
        F.max("l_shipdate").alias("updated_at"),
    )


def build_products(
    part: DataFrame, lineitem: DataFrame, supplier: DataFrame, nation: DataFrame
) -> DataFrame:
    # aggregated by their keys, both sides are known to be unique: a query that shows none of their columns drops
    # the joins, and with them the scan of the lines
    vendors = (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
        .groupBy(F.col("s_suppkey").alias("lead_supplier"))
        .agg(F.min("s_name").alias("s_name"), F.min("n_name").alias("n_name"))
    )
    facts = product_facts(lineitem)
    return (
        part.join(facts, part.p_partkey == facts.l_partkey, "left")
        .join(vendors, "lead_supplier", "left")
        .select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.col("p_name").alias("name"),
            F.concat_ws(" ", "p_brand", "p_type", "p_name").alias("description"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
            (F.col("p_retailprice") * F.col("p_size") / F.lit(250.0)).alias("price"),
            F.lit("USD").alias("currency"),
            F.when(F.col("n_lines").isNotNull(), F.col("qty_open") >= F.col("qty_done")).alias("availability"),
            "quantity",
            F.col("s_name").alias("vendor"),
            F.col("n_name").alias("country"),
            (F.lit(5.0) * F.col("n_kept") / F.col("n_lines")).alias("rating"),
            "reviews_count",
            F.array().cast("array<string>").alias("images"),
            F.split("p_name", " ").alias("tags"),
            F.lit(None).cast("string").alias("source_url"),
            "created_at",
            "updated_at",
        )
    )


def products(spark: SparkSession, sf_dir: str, lines=None) -> DataFrame:
    """The catalogue; ``lines`` may narrow the line table to a snapshot in time."""
    lineitem = table(spark, sf_dir, "lineitem")
    if lines is not None:
        lineitem = lines(lineitem)
    return build_products(
        table(spark, sf_dir, "part"),
        lineitem,
        table(spark, sf_dir, "supplier"),
        table(spark, sf_dir, "nation"),
    )


def held(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns written once to the checkpoint folder.

    For queries that read the catalogue more than once: each pass would otherwise
    prune its own columns, so Spark could not share the aggregate over the lines.
    """
    return cut_lineage(df.select(*columns) if columns else df)


def basket_items(spark: SparkSession, sf_dir: str, item: str = "p_type") -> DataFrame:
    """Distinct (order, item) pairs."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col(item).alias("item"))
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .select(F.col("l_orderkey").alias("basket"), "item")
        .distinct()
    )


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly mean unit price per category, with review and rating activity."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_returnflag"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("category"))
    return (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .join(part, line.l_partkey == part.p_partkey)
        .groupBy("category", F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"))
        .agg(
            F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).otherwise(0.0)).alias("reviews"),
            (F.lit(5.0) * F.count(F.when(F.col("l_returnflag") != "R", 1)) / F.count(F.lit(1))).alias("rating"),
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


PRODUCTS_SQL = """
WITH facts AS (
  SELECT l_partkey, count(*) AS n_lines,
         count(*) FILTER (WHERE l_returnflag <> 'R') AS n_kept,
         CAST(sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS INTEGER) AS reviews_count,
         CAST(sum(l_quantity) FILTER (WHERE l_linestatus = 'O') AS INTEGER) AS quantity,
         coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0)
           >= coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) AS availability,
         min(l_suppkey) AS lead_supplier,
         min(l_shipdate) AS created_at, max(l_shipdate) AS updated_at
  FROM lineitem GROUP BY l_partkey
), products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name,
         concat_ws(' ', p_brand, p_type, p_name) AS description,
         p_type AS category, p_brand AS sub_category,
         p_retailprice * p_size / CAST(250 AS DOUBLE) AS price, 'USD' AS currency,
         availability, quantity, s_name AS vendor, n_name AS country,
         CAST(5 AS DOUBLE) * n_kept / n_lines AS rating, reviews_count,
         created_at, updated_at
  FROM part LEFT JOIN facts ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = lead_supplier
  LEFT JOIN nation ON n_nationkey = s_nationkey
)
"""

BASKETS_SQL = """
WITH baskets AS (
  SELECT DISTINCT l_orderkey AS basket, {item} AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
"""

HISTORY_SQL = """
WITH history AS (
  SELECT p_type AS category, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         avg(l_extendedprice / l_quantity) AS price,
         sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS reviews,
         CAST(5 AS DOUBLE) * count(*) FILTER (WHERE l_returnflag <> 'R') / count(*) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2
)
"""
