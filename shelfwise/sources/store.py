"""Reading and writing stored products, run results and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.scoring import VIEW, score
from shelfwise.operators.tables import FULL_UPDATE, one_per_key
from shelfwise.operators.tables import upsert as upsert_rows
from shelfwise.schema import PRODUCT_SCHEMA, RESULT_TABLES
from shelfwise.session import cut_lineage

# fixed values: the built-in sample
SAMPLE_PRODUCTS = [
    ("1", "Wireless Earbuds", "Electronics", 59.0, 4.6, 1200, True),
    ("2", "Fitness Tracker", "Sport", 49.0, 4.2, 340, True),
    ("3", "LED Desk Lamp", "Home", 29.0, 4.8, 980, True),
]
SAMPLE_COLUMNS = (
    "product_id string, name string, category string, price double, rating double, "
    "reviews_count int, availability boolean"
)


def read_products_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A JSON list of records, or with ``lines`` one record a line as ``write_records`` leaves them, by the product schema.

    Lines are read in parallel; a list is one task a file.
    """
    return spark.read.schema(PRODUCT_SCHEMA).option("multiLine", not lines).json(path)


def write_records(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def sample_products(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SAMPLE_PRODUCTS, SAMPLE_COLUMNS)


def load_products(spark: SparkSession, store: str | None = None, json_path: str | None = None) -> DataFrame:
    """Stored table, else the JSON file, else the sample."""
    for path, read in ((store, ProductStore.read_at), (json_path, read_products_json)):
        if path is None:
            continue
        try:
            df = read(spark, path)
            if not df.isEmpty():
                return df
        except (AnalysisException, FileNotFoundError):
            continue
    return sample_products(spark)


def fetch_latest(df: DataFrame, limit: int = 1000) -> DataFrame:
    return df.orderBy(F.desc("created_at"), "product_id").limit(limit)


def query_products(df: DataFrame, limit: int = 100, category: str | None = None, limit_first: bool = False) -> DataFrame:
    """Newest products of a category.  ``limit_first`` cuts before the category filter."""
    def matching(d: DataFrame) -> DataFrame:
        return d if category is None else d.where(F.col("category") == category)

    return matching(fetch_latest(df, limit)) if limit_first else fetch_latest(matching(df), limit)


def products_by_price(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("price"), "product_id")


MIN_BUCKETS, BUCKET_ROWS = 16, 500_000  # of a new table whose number of partitions is not given


class ProductStore:
    """Product table in partitions by a hash of the key.

    An upsert merges its rows into the partitions their keys fall in and rewrites just those, by dynamic partition
    overwrite; the same batch again leaves the same rows.  The number of partitions is part of the table's layout
    (``buckets=64/bucket=3``): it is chosen when the table is made, by ``buckets`` or by the number of rows, and read
    from there ever after, whatever a later ``buckets`` says.  ``resize`` changes it.
    """

    def __init__(self, spark: SparkSession, root: str, update: Sequence[str] = FULL_UPDATE, buckets: int | None = None):
        self.spark, self.root, self.update, self.buckets = spark, root.rstrip("/"), tuple(update), buckets

    @staticmethod
    def _bucket(width: int) -> Column:
        return F.pmod(F.xxhash64("product_id"), F.lit(width)).cast("int")

    def _stored(self) -> DataFrame | None:
        place = [T.StructField("buckets", T.IntegerType()), T.StructField("bucket", T.IntegerType())]
        try:
            return self.spark.read.schema(T.StructType([*PRODUCT_SCHEMA, *place])).parquet(self.root)
        except AnalysisException:
            return None

    def width(self) -> int | None:
        """Number of hash partitions of the stored table."""
        stored = self._stored()
        row = None if stored is None else stored.select("buckets").first()
        return row and row[0]

    def read(self) -> DataFrame:
        stored = self._stored()
        if stored is None:
            raise FileNotFoundError(self.root)
        return stored.drop("buckets", "bucket")

    @staticmethod
    def read_at(spark: SparkSession, root: str) -> DataFrame:
        return ProductStore(spark, root).read()

    def _write(self, df: DataFrame, mode: str, width: int) -> None:
        rows = df.withColumns({"buckets": F.lit(width), "bucket": self._bucket(width)}).repartition("bucket")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("buckets", "bucket")
        writer.parquet(self.root)

    def _fitting(self, df: DataFrame) -> int:
        return self.buckets or max(MIN_BUCKETS, 1 << (df.count() // BUCKET_ROWS).bit_length())

    def replace(self, df: DataFrame) -> None:
        """Make ``df`` the whole table."""
        rows = cut_lineage(_conform(df))
        self._write(rows, "static", self._fitting(rows))

    def resize(self, buckets: int) -> None:
        """Deal the stored rows into another number of partitions."""
        self._write(cut_lineage(_conform(self.read())), "static", buckets)

    def upsert(self, incoming: DataFrame, order_by: Sequence[str] = (), now: Column | None = None, source_url: str | None = None) -> None:
        """Insert new keys, overwrite the ``update`` columns of known ones; one row of a key wins, see ``tables.upsert``."""
        now = (F.current_timestamp() if now is None else now).cast("timestamp")
        one = _conform(one_per_key(incoming, "product_id", order_by))
        fresh = cut_lineage(one)
        width = self.width()
        if width is None:
            width, stored = self._fitting(fresh), self.spark.createDataFrame([], PRODUCT_SCHEMA)
        else:
            touched = [r[0] for r in fresh.select(self._bucket(width)).distinct().collect()]  # at most ``width``
            stored = self._stored().where(F.col("bucket").isin(touched)).drop("buckets", "bucket")
        merged = upsert_rows(stored, fresh, self.update, now=now, source_url=source_url)
        self._write(cut_lineage(_conform(merged)), "dynamic", width)


def _conform(df: DataFrame) -> DataFrame:
    """The product schema's columns, absent ones as NULL."""
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in PRODUCT_SCHEMA]
    )


def replace_source(df: DataFrame, path: str, source: str) -> None:
    """Replace the rows of one source and leave the other sources alone."""
    (
        df.withColumn("source", F.lit(source))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source")
        .parquet(path)
    )


def append_results(df: DataFrame, root: str, table: str) -> None:
    """Append rows to a result table, stamped with the write time."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([], RESULT_TABLES[table]).schema
    stamped = df if "created_at" in df.columns else df.withColumn("created_at", F.current_timestamp())
    stamped.select(*[F.col(f.name).cast(f.dataType) for f in wanted]).write.mode("append").parquet(f"{root}/{table}")


def top_k_rows(scored: DataFrame, source: str) -> DataFrame:
    """Top-K output as result rows with the product as JSON text."""
    payload = F.to_json(F.struct(*[c for c in scored.columns if c != "_score"]))
    return scored.select(F.lit(source).alias("source"), "product_id", F.col("_score").alias("score"), payload.alias("payload"))


def metric_rows(spark: SparkSession, model_name: str, metrics: dict[str, float]) -> DataFrame:
    return spark.createDataFrame([(model_name, metrics)], "model_name string, metrics map<string,double>")


def run_row(
    spark: SparkSession, run_id: str, products: int, features: int, models: int, top_k: int
) -> DataFrame:
    """Summary row of one run; no products means an empty run."""
    status = "completed" if products else "empty"
    return spark.createDataFrame(
        [(run_id, status, products, features, models, top_k)],
        "run_id string, status string, products_scraped bigint, features_count int, models_trained int, top_k_count int",
    )


def save_model(model: PipelineModel, root: str, name: str, version: str) -> None:
    """Write the model files and register them."""
    path = f"{root}/models/{name}/{version}"
    model.write().overwrite().save(path)
    row = SparkSession.getActiveSession().createDataFrame([(name, path)], "model_name string, path string")
    append_results(row, root, "model_registry")


def load_model(spark: SparkSession, root: str, name: str) -> PipelineModel:
    """Latest registered model of that name."""
    found = (
        spark.read.parquet(f"{root}/model_registry")
        .where(F.col("model_name") == name)
        .agg(F.max_by("path", "created_at").alias("path"))
        .first()
    )
    if found.path is None:
        raise ValueError(f"model {name} is not registered")
    return PipelineModel.load(found.path)


def create_top_k_view(df: DataFrame, view: str = "top_k_products") -> DataFrame:
    """Register the full score ranking as a temporary view."""
    ranked = score(df, VIEW).withColumnRenamed("_score", "score")
    ranked.createOrReplaceTempView(view)
    return df.sparkSession.table(view)
