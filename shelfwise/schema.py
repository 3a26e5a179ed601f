"""Fixed schemas at the boundary of the engine."""

from __future__ import annotations

from pyspark.sql import types as T

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("availability", T.BooleanType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("reviews_count", T.IntegerType()),
        T.StructField("images", T.ArrayType(T.StringType())),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("source_url", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

TARGET_SCHEMA = T.StructType(
    [
        T.StructField("platform", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("priority", T.IntegerType()),
        T.StructField("max_retries", T.IntegerType()),
    ]
)

WOO_SCHEMA = """
    id STRING, name STRING, description STRING, price STRING, regular_price STRING,
    sale_price STRING, currency STRING, stock_quantity INT, stock_status STRING,
    categories ARRAY<STRUCT<name: STRING>>, images ARRAY<STRUCT<src: STRING>>,
    tags ARRAY<STRUCT<name: STRING>>, seller_info STRUCT<name: STRING>,
    average_rating STRING, review_count STRING
"""

SHOPIFY_SCHEMA = """
    id STRING, title STRING, description STRING, productType STRING, vendor STRING,
    tags ARRAY<STRING>,
    variants STRUCT<edges: ARRAY<STRUCT<node: STRUCT<
        price: STRING, availableForSale: BOOLEAN, inventoryQuantity: INT>>>>,
    images STRUCT<edges: ARRAY<STRUCT<node: STRUCT<originalSrc: STRING>>>>,
    rating STRUCT<value: STRING>, reviewsCount STRUCT<value: STRING>
"""

RAW_SCHEMA = """
    id STRING, product_id STRING, title STRING, name STRING, product_name STRING,
    description STRING, body_html STRING, category STRING, product_type STRING,
    price STRING, variants ARRAY<STRUCT<price: STRING>>, currency STRING,
    price_currency STRING, available BOOLEAN, inventory_quantity INT, vendor STRING,
    seller STRING, rating DOUBLE, reviews_count INT, images ARRAY<STRING>, image STRING,
    tags ARRAY<STRING>
"""

TASK_SCHEMA = """
    task_id STRING, platform STRING, url STRING, params MAP<STRING, STRING>,
    priority INT, status STRING, assigned_to STRING, created_at DOUBLE,
    started_at DOUBLE, completed_at DOUBLE, retry_count INT, max_retries INT,
    error STRING
"""

RESULT_TABLES = {
    "ml_results": "model_name STRING, product_id STRING, result STRING, created_at TIMESTAMP",
    "summaries": "source STRING, summary STRING, created_at TIMESTAMP",
    "model_metrics": "model_name STRING, metrics MAP<STRING, DOUBLE>, created_at TIMESTAMP",
    "top_k_results": "source STRING, product_id STRING, score DOUBLE, payload STRING, created_at TIMESTAMP",
    "model_registry": "model_name STRING, path STRING, created_at TIMESTAMP",
    "run_log": (
        "run_id STRING, status STRING, products_scraped BIGINT, features_count INT, "
        "models_trained INT, top_k_count INT, created_at TIMESTAMP"
    ),
}
