"""One whole run: store what came in, prepare it, score it, model it, keep the results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import cluster, model, prep, scoring
from shelfwise.session import cut_lineage
from shelfwise.sources import store


@dataclass
class RunResult:
    status: str
    products: DataFrame
    top_k: DataFrame | None = None
    clusters: DataFrame | None = None
    report: DataFrame | None = None


def prepare(products: DataFrame) -> DataFrame:
    """Filled, scaled, encoded and labelled products, written once for the steps that read them."""
    columns = [c for c in products.columns if c not in ("images", "tags", "description")]
    base = cut_lineage(products.select(*columns))
    kept = prep.keep_originals(base, ["price", "rating", "reviews_count"])
    filled = cut_lineage(prep.fill_missing(kept))
    ready = prep.zscore(filled, prep.FEATURES, "_normalized")
    ready = prep.with_price_category(prep.quality_score(ready))
    ready = cut_lineage(prep.label_encode(ready))
    return cut_lineage(prep.flag_top_quartile(ready))


def analyse(
    spark: SparkSession,
    incoming: DataFrame,
    root: str,
    run_id: str,
    k: int = 10,
    now: Column | None = None,
    source: str = "run",
) -> RunResult:
    """Upsert, preprocess, top-K, clusters, classifier, result tables and run row."""
    shop = store.ProductStore(spark, f"{root}/products")
    shop.upsert(incoming, now=now)
    products = shop.read()
    n = products.count()
    if n == 0:
        store.append_results(store.run_row(spark, run_id, 0, 0, 0, 0), root, "run_log")
        return RunResult("empty", products)

    ready = prepare(products)
    top = cut_lineage(scoring.top_k(ready, k, scoring.CLIPPED))
    store.append_results(store.top_k_rows(top, source), root, "top_k_results")

    fitted = cluster.fit_cluster_model(ready, k=min(5, n))
    clusters = fitted.transform(ready).select("product_id", "cluster", "features")
    scores = {"kmeans_silhouette": cluster.silhouette(clusters)}
    store.save_model(fitted, root, "kmeans", run_id)
    models = 1

    classifier, report = model.train_classifier(ready, "is_top", min_rows=model.MIN_ROWS)
    if classifier is not None:
        store.save_model(classifier, root, "random_forest", run_id)
        scores["rf_accuracy"] = report.first().accuracy
        models += 1
    metrics = store.metric_rows(spark, "run", {m: v for m, v in scores.items() if v is not None})
    store.append_results(metrics, root, "model_metrics")
    store.append_results(store.run_row(spark, run_id, n, len(prep.FEATURES), models, min(k, n)), root, "run_log")
    return RunResult("completed", products, top, clusters.drop("features"), report)


def refresh_models(spark: SparkSession, root: str, version: str) -> int:
    """Fit and register the stored models again from the products as they stand."""
    ready = prepare(store.ProductStore(spark, f"{root}/products").read())
    store.save_model(cluster.fit_cluster_model(ready), root, "kmeans", version)
    classifier, _ = model.train_classifier(ready, "is_top", min_rows=model.MIN_ROWS)
    if classifier is None:
        return 1
    store.save_model(classifier, root, "random_forest", version)
    return 2


def run_summary(root: str, spark: SparkSession) -> DataFrame:
    """Runs, newest first."""
    return spark.read.parquet(f"{root}/run_log").orderBy(F.desc("created_at"))
