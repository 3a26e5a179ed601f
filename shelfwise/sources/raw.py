"""Landed shop payloads to product rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import parse_price, text_or, to_double
from shelfwise.schema import RAW_SCHEMA, SHOPIFY_SCHEMA, TARGET_SCHEMA, WOO_SCHEMA

_NO_TEXTS = "array<string>"


def _texts(c: Column) -> Column:
    return F.coalesce(c, F.array().cast(_NO_TEXTS))


def normalize_products(df: DataFrame, record: str = "record") -> DataFrame:
    """Raw records of mixed shape (struct column) to the product columns."""
    r = lambda name: F.col(f"{record}.{name}")
    first_variant = F.get(r("variants"), F.lit(0))["price"]
    extra = [c for c in df.columns if c != record]
    return df.select(
        text_or("", r("id"), r("product_id")).alias("product_id"),
        text_or("", r("title"), r("name"), r("product_name")).alias("name"),
        text_or("", r("description"), r("body_html")).alias("description"),
        text_or("", r("category"), r("product_type")).alias("category"),
        parse_price(text_or(None, r("price"), first_variant)).alias("price"),
        text_or("USD", r("currency"), r("price_currency")).alias("currency"),
        F.coalesce(r("available"), F.lit(True)).alias("availability"),
        r("inventory_quantity").alias("quantity"),
        text_or("", r("vendor"), r("seller")).alias("vendor"),
        r("rating").alias("rating"),
        r("reviews_count").alias("reviews_count"),
        F.when(F.size(r("images")) > 0, r("images"))
        .when(r("image").isNotNull(), F.array(r("image")))
        .otherwise(F.array().cast(_NO_TEXTS))
        .alias("images"),
        _texts(r("tags")).alias("tags"),
        *extra,
    )


def parse_records(df: DataFrame, payload: str, schema: str = RAW_SCHEMA) -> DataFrame:
    """JSON text column to a ``record`` struct column."""
    return df.withColumn("record", F.from_json(payload, schema)).drop(payload)


def woo_price(sale: Column, regular: Column, price: Column) -> Column:
    """First non-empty of sale, regular and price as a number; text that is no number gives 0."""
    chosen = F.coalesce(F.nullif(sale, F.lit("")), F.nullif(regular, F.lit("")), price)
    return F.coalesce(to_double(chosen), F.lit(0.0))


def parse_woocommerce(df: DataFrame, payload: str = "payload") -> DataFrame:
    w = parse_records(df, payload, WOO_SCHEMA)
    r = lambda name: F.col(f"record.{name}")
    stocked = F.when(
        F.coalesce(r("stock_status"), F.lit("")) != "", r("stock_status") == "instock"
    ).otherwise(F.coalesce(r("stock_quantity") > 0, F.lit(False)))
    extra = [c for c in w.columns if c != "record"]
    return w.select(
        F.coalesce(r("id"), F.lit("")).alias("product_id"),
        F.coalesce(r("name"), F.lit("")).alias("name"),
        F.coalesce(r("description"), F.lit("")).alias("description"),
        F.coalesce(F.get(r("categories"), F.lit(0))["name"], F.lit("")).alias("category"),
        woo_price(r("sale_price"), r("regular_price"), r("price")).alias("price"),
        F.coalesce(r("currency"), F.lit("USD")).alias("currency"),
        stocked.alias("availability"),
        r("stock_quantity").alias("quantity"),
        F.coalesce(r("seller_info.name"), F.lit("")).alias("vendor"),
        to_double(r("average_rating")).alias("rating"),
        r("review_count").try_cast("int").alias("reviews_count"),
        _texts(F.filter(F.transform(r("images"), lambda i: i["src"]), lambda s: s != "")).alias("images"),
        _texts(F.transform(r("tags"), lambda t: F.coalesce(t["name"], F.lit("")))).alias("tags"),
        *extra,
    )


def parse_shopify(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Nested node lists: first variant gives price and stock."""
    w = parse_records(df, payload, SHOPIFY_SCHEMA)
    r = lambda name: F.col(f"record.{name}")
    variant = F.get(r("variants.edges"), F.lit(0))["node"]
    extra = [c for c in w.columns if c != "record"]
    return w.select(
        F.coalesce(r("id"), F.lit("")).alias("product_id"),
        F.coalesce(r("title"), F.lit("")).alias("name"),
        F.coalesce(r("description"), F.lit("")).alias("description"),
        F.coalesce(r("productType"), F.lit("")).alias("category"),
        parse_price(variant["price"]).alias("price"),
        F.lit("USD").alias("currency"),
        F.coalesce(variant["availableForSale"], F.lit(True)).alias("availability"),
        variant["inventoryQuantity"].alias("quantity"),
        F.coalesce(r("vendor"), F.lit("")).alias("vendor"),
        to_double(r("rating.value")).alias("rating"),
        r("reviewsCount.value").try_cast("int").alias("reviews_count"),
        _texts(F.filter(F.transform(r("images.edges"), lambda e: e["node"]["originalSrc"]), lambda s: s != "")).alias("images"),
        _texts(r("tags")).alias("tags"),
        *extra,
    )


def payload_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One JSON text per product from a single record, a ``products`` list or a plain list.

    Any other shape yields no rows.
    """
    text = F.col(payload)
    is_list = F.substring(F.ltrim(text), 1, 1) == "["
    listed = F.from_json(text, "array<string>")
    keys = F.coalesce(F.json_object_keys(F.when(~is_list, text)), F.array().cast(_NO_TEXTS))
    inner = F.from_json(F.get_json_object(text, "$.products"), "array<string>")
    single = F.array_contains(keys, "name") | F.array_contains(keys, "title")
    records = F.when(is_list, listed).when(single, F.array(text)).when(F.array_contains(keys, "products"), inner)
    return df.withColumn(payload, F.explode(records))


def add_lineage(df: DataFrame, agent: Column, platform: Column, url: Column, at: Column | None = None) -> DataFrame:
    return df.withColumns(
        {
            "_source_agent": agent,
            "_source_platform": platform,
            "_source_url": url,
            "_collected_at": F.current_timestamp() if at is None else at,
        }
    )


def tag_scraper(df: DataFrame, agent: str, platform: str, scraper: str | None = None) -> DataFrame:
    """Which agent and tool produced the rows."""
    return df.withColumns(
        {"_scraped_by": F.lit(agent), "_platform": F.lit(platform), "_scraper": F.lit(scraper).cast("string")}
    )


def read_api_pages(spark: SparkSession, path: str, max_pages: int | None = None) -> DataFrame:
    """Product records of landed result pages ``page-<n>.json`` (one JSON list per file).

    Pages after the first empty one are not part of the result, nor those beyond ``max_pages`` if it is given.  A page
    that is no JSON list is one row with status ``unreadable`` and no payload.
    """
    pages = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.input_file_name(), r"page-(\d+)", 1).cast("int").alias("page"),
        F.from_json("value", "array<string>").alias("records"),
    )
    empty = pages.where(F.size("records") <= 0).agg(F.min("page")).scalar()
    valid = empty.isNull() | (F.col("page") < empty)
    if max_pages is not None:
        valid = valid & (F.col("page") <= max_pages)
    status = F.when(F.col("records").isNull(), "unreadable").otherwise("ok")
    return pages.where(valid).select("page", status.alias("status"), F.explode_outer("records").alias("payload"))


def collect_outputs(outputs: dict[str, DataFrame | None]) -> DataFrame:
    """Union of per-target results with a status per target; a missing result is an error row."""
    parts = []
    for target, df in outputs.items():
        if df is not None:
            parts.append(df.withColumns({"target": F.lit(target), "status": F.lit("ok")}))
    good = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    lost = [(t, "error") for t, df in outputs.items() if df is None]
    if lost:
        errors = good.sparkSession.createDataFrame(lost, "target string, status string")
        good = good.unionByName(errors, allowMissingColumns=True)
    return good


def successful(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == "ok").drop("status")


def target_defaults(df: DataFrame) -> DataFrame:
    return df.select(
        F.coalesce("platform", F.lit("generic")).alias("platform"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("params", F.create_map().cast("map<string,string>")).alias("params"),
        F.coalesce("priority", F.lit(0)).alias("priority"),
        F.coalesce("max_retries", F.lit(3)).alias("max_retries"),
    )


def read_targets(spark: SparkSession, path: str | None = None, inline: str | None = None) -> DataFrame:
    """Collection targets from a JSON file, or from JSON text when no file is given."""
    if path is not None:
        return target_defaults(spark.read.schema(TARGET_SCHEMA).option("multiLine", True).json(path))
    if inline is not None:
        listed = spark.createDataFrame([(inline,)], "j string").select(
            F.inline(F.from_json("j", f"array<{TARGET_SCHEMA.simpleString()}>"))
        )
        return target_defaults(listed)
    return target_defaults(spark.createDataFrame([], TARGET_SCHEMA))


def tasks_from_targets(targets: DataFrame) -> DataFrame:
    """A pending task per target; the id follows from platform and address."""
    task_id = F.concat(F.lit("task_"), F.substring(F.md5(F.concat_ws("|", "platform", "url")), 1, 12))
    return targets.select(task_id.alias("task_id"), "*", F.lit("pending").alias("status"))
