from datetime import datetime

from pyspark.sql import functions as F

from shelfwise.plans import run
from shelfwise.schema import PRODUCT_SCHEMA
from shelfwise.sources import store


def catalogue(spark, n):
    i = F.col("id")
    return spark.range(n).select(
        i.cast("string").alias("product_id"),
        F.concat(F.lit("name "), i).alias("name"),
        F.concat(F.lit("c"), i % 4).alias("category"),
        F.when(i % 9 != 0, (i % 83).cast("double") + 1).alias("price"),
        (i % 3 == 0).alias("availability"),
        (i % 31).cast("int").alias("quantity"),
        F.concat(F.lit("v"), i % 5).alias("vendor"),
        (i % 37 / 9 + 0.5).alias("rating"),
        (i * 13 % 400).cast("int").alias("reviews_count"),
    )


def test_whole_run(spark, tmp_path):
    root = str(tmp_path)
    result = run.analyse(spark, catalogue(spark, 120), root, "r1", k=5)
    assert result.status == "completed"
    assert result.products.count() == 120
    top = [r._score for r in result.top_k.collect()]
    assert len(top) == 5 and top == sorted(top, reverse=True)
    assert result.clusters.select("cluster").distinct().count() == 5
    assert result.report.first().accuracy > 0.8
    assert spark.read.parquet(f"{root}/top_k_results").count() == 5
    assert spark.read.parquet(f"{root}/run_log").first().models_trained == 2
    metrics = spark.read.parquet(f"{root}/model_metrics").first().metrics
    assert set(metrics) == {"kmeans_silhouette", "rf_accuracy"}

    # a second run adds rows and keeps the first ones; stored models serve new rows
    again = run.analyse(spark, catalogue(spark, 130), root, "r2", k=5, now=F.lit(datetime(2024, 1, 1)))
    assert again.products.count() == 130
    assert run.run_summary(root, spark).count() == 2
    assert run.refresh_models(spark, root, "r3") == 2
    loaded = store.load_model(spark, root, "kmeans")
    assert loaded.transform(catalogue(spark, 10).fillna({"price": 0.0})).where("cluster IS NULL").count() == 0


def test_empty_run(spark, tmp_path):
    result = run.analyse(spark, spark.createDataFrame([], PRODUCT_SCHEMA), str(tmp_path), "r0")
    assert result.status == "empty"
    assert spark.read.parquet(f"{tmp_path}/run_log").first().status == "empty"


def test_prepared_columns(spark):
    ready = run.prepare(catalogue(spark, 40))
    wanted = {"price_original", "price_normalized", "quantity_normalized", "category_encoded", "vendor_encoded", "price_category", "quality_score", "is_top"}
    assert wanted <= set(ready.columns)
    assert ready.where("price IS NULL").count() == 0
    assert ready.where("price_original IS NULL").count() == 5
