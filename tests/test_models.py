import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from shelfwise.operators import model
from shelfwise.sources import store


@pytest.fixture(scope="module")
def labelled(spark):
    df = spark.range(400).select(
        F.col("id").cast("string").alias("product_id"),
        F.concat(F.lit("n"), "id").alias("name"),
        F.lit("c").alias("category"),
        (F.col("id") % 97).cast("double").alias("price"),
        (F.col("id") % 41 / 10 + 1).alias("rating"),
        (F.col("id") * 7 % 300).cast("int").alias("reviews_count"),
        (F.col("id") % 50).cast("int").alias("quantity"),
    )
    return df.withColumn("y", (F.col("price") > 48).cast("int")).withColumn("z", (F.col("price") / 33).cast("int"))


@pytest.mark.parametrize("kind", ["random_forest", "logistic"])
def test_classifier(labelled, kind):
    fitted, report = model.train_classifier(labelled, "y", kind)
    r = report.first()
    assert r.accuracy > 0.9 and r.roc_auc > 0.95
    assert (r.n_train, r.n_test) == (320, 80)
    assert {f for f in ("accuracy", "precision", "recall", "f1") if not 0 <= r[f] <= 1} == set()


def test_many_classes(labelled):
    _, report = model.train_classifier(labelled, "z")
    assert report.first().roc_auc > 0.9


def test_same_seed_same_report(labelled):
    a = model.train_classifier(labelled, "y")[1].first()
    b = model.train_classifier(labelled.repartition(1), "y")[1].first()
    assert (a.n_train, a.n_test) == (b.n_train, b.n_test)
    assert abs(a.accuracy - b.accuracy) < 0.05


def test_gate(labelled):
    fitted, report = model.train_classifier(labelled.limit(20), "y", min_rows=50)
    assert fitted is None and report.first().status == "insufficient_data"
    assert model.trending_products(labelled.limit(20)).count() == 0


def test_unknown_kind(labelled):
    with pytest.raises(ValueError):
        model.classifier("other", 10)
    with pytest.raises(ValueError):
        model.regressor("other")


def test_store_and_predict(spark, labelled, tmp_path):
    fitted, _ = model.train_classifier(labelled, "y", "logistic")
    store.save_model(fitted, str(tmp_path), "lr", "1")
    store.save_model(fitted, str(tmp_path), "lr", "2")
    loaded = store.load_model(spark, str(tmp_path), "lr")
    shelf = model.ModelShelf()
    with pytest.raises(ValueError):
        shelf.predict(labelled, "lr")
    shelf.add("lr", loaded)
    got = shelf.predict(labelled, "lr").agg(F.avg((F.col("prediction") == F.col("y")).cast("int"))).first()[0]
    assert got > 0.9
    with pytest.raises(ValueError):
        store.load_model(spark, str(tmp_path), "none")


def test_trending_label(labelled):
    rows = model.trending_label(labelled).collect()
    middle = sorted(r.reviews_count for r in rows)
    middle = (middle[199] + middle[200]) / 2
    assert all(r.trending == int(r.rating > 4.0 and r.reviews_count > middle) for r in rows)


def test_folds(labelled):
    assert model.cross_validate(labelled, "y", "logistic", folds=3) > 0.8


def holed(labelled):
    rating = F.when(F.col("product_id").cast("int") % 19 != 3, F.col("rating"))
    return labelled.withColumn("rating", rating).withColumn("label", F.col("y").cast("double"))


def test_scaled_pipeline_with_missing_features(labelled):
    rows = holed(labelled)
    shelf = model.ModelShelf()
    shelf.add("lr", model.scaled_pipeline(rows, ["price", "rating"], model.classifier("logistic", 400)))
    mean, deviation = rows.agg(F.avg("rating"), F.stddev_pop("rating")).first()
    found = shelf.predict(rows, "lr").collect()
    assert len(found) == 400
    for r in found:
        assert (r.rating_z is None) == (r.rating is None) == (r.prediction is None)
        assert r.rating is None or abs(r.rating_z - (r.rating - mean) / deviation) < 1e-9


def test_line_through_rows_with_missing_features(spark, labelled, tmp_path):
    rows = holed(labelled)
    store.save_model(model.scaled_pipeline(rows, ["rating"], LinearRegression(solver="normal")), str(tmp_path), "line", "1")
    found = store.load_model(spark, str(tmp_path), "line").transform(rows)
    a, b = rows.agg(F.regr_slope("label", "rating"), F.regr_intercept("label", "rating")).first()
    for r in found.collect():
        assert r.prediction is None if r.rating is None else abs(r.prediction - (a * r.rating + b)) < 1e-6
