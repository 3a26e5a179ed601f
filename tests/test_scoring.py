import pytest
from pyspark.sql import functions as F

from shelfwise.functions.columns import json_or_raw, parse_flag, parse_price, price_band
from shelfwise.operators import aggregate, competitive, prep, scoring
from shelfwise.sources.store import sample_products


@pytest.fixture
def sample(spark):
    return sample_products(spark)


def by_id(df, column):
    return {r.product_id: r[column] for r in df.collect()}


def test_main_score(sample):
    top = scoring.top_k(sample).collect()
    assert [r.product_id for r in top] == ["3", "1", "2"]
    assert [r._score for r in top] == [0.7559, 0.6875, 0.5172]


def test_clipped_score(sample):
    scores = by_id(scoring.score(sample, scoring.CLIPPED), "_score")
    assert {k: round(v, 4) for k, v in scores.items()} == {"1": 0.5375, "2": 0.3672, "3": 0.6059}


def test_own_weights(sample):
    only_rating = scoring.top_k(sample, 1, weights={"rating": 1.0}).first()
    assert (only_rating.product_id, only_rating._score) == ("3", 1.0)


def test_view_agrees_with_full_score(sample):
    from shelfwise.sources.store import create_top_k_view

    view = create_top_k_view(sample)
    assert {r.product_id: round(r.score, 4) for r in view.collect()} == by_id(scoring.score(sample), "_score")


def test_zero_maxima_and_empty(spark, sample):
    blank = sample.withColumns({"price": F.lit(0.0), "rating": F.lit(0.0), "reviews_count": F.lit(0)})
    for preset in (scoring.MAIN, scoring.CLIPPED, scoring.INTERACTIVE, scoring.VIEW):
        assert len(scoring.top_k(blank, preset=preset).collect()) == 3
        assert scoring.top_k(sample.limit(0), preset=preset).collect() == []
    # without a positive price the price share is 1 - 0
    assert scoring.score(blank).first()._score == pytest.approx(0.35)


def test_ties_by_id(sample):
    same = sample.withColumns({"price": F.lit(1.0), "rating": F.lit(1.0), "reviews_count": F.lit(1)})
    assert [r.product_id for r in scoring.top_k(same, 2).collect()] == ["1", "2"]


def test_emergence_and_segments(sample):
    assert by_id(competitive.emergence_score(sample), "emergence_score") == {"1": 0.913, "2": 0.783, "3": 0.957}
    values = {r.category: r.value_score for r in competitive.segments(sample).collect()}
    assert values == {"Electronics": 0.6667, "Sport": 0.7119, "Home": 1.2308}
    ranks = {r.product_id: r["rank"] for r in competitive.emerging_products(sample).collect()}
    assert ranks == {"3": 1, "1": 2, "2": 3}


def test_missing_category_is_a_segment(sample):
    loose = sample.withColumn("category", F.when(F.col("product_id") == "1", F.col("category")))
    rows = {r.category: r.product_count for r in competitive.segments(loose).collect()}
    assert rows == {"Electronics": 1, None: 2}
    assert {r.category for r in competitive.compare_products(loose).collect()} == {None}
    assert [r.category for r in aggregate.category_stats(loose).collect()] == ["Electronics"]


def test_analysis_types_and_status(spark, sample):
    full = competitive.competitive_analysis(sample)
    assert set(full) == {"comparison", "emerging", "recommendations", "status"}
    assert {r.status for r in full["status"].collect()} == {"completed"}
    assert set(competitive.competitive_analysis(sample, "emerging")) == {"emerging", "status"}
    assert set(competitive.competitive_analysis(sample, "other")) == set(full)
    one = {r.analysis: r.status for r in competitive.analysis_status(sample.limit(1)).collect()}
    assert one == {"comparison": "insufficient_data", "emerging": "completed", "recommendations": "completed"}
    none = {r.status for r in competitive.analysis_status(sample.limit(0)).collect()}
    assert none == {"no_data"}


def test_quality_and_top_flag(sample):
    scored = prep.quality_score(sample)
    assert {k: round(v, 6) for k, v in by_id(scored, "quality_score").items()} == {"1": 0.952, "2": 0.617333, "3": 0.902667}
    assert by_id(prep.flag_top_quartile(scored), "is_top") == {"1": 1, "2": 0, "3": 0}


def test_zscore(sample):
    z = by_id(prep.zscore(sample, ["price"]), "price_norm")
    assert {k: round(v, 6) for k, v in z.items()} == {"1": 1.069045, "2": 0.267261, "3": -1.336306}
    flat = prep.zscore(sample.withColumn("price", F.lit(5.0)), ["price"])
    assert set(by_id(flat, "price_norm").values()) == {0.0}


def test_overview(sample):
    k = aggregate.overview_kpis(sample).first()
    assert (k.products, round(k.avg_price, 4), round(k.avg_rating, 4), k.total_reviews, k.categories, k.pct_available) == (
        3, 45.6667, 4.5333, 2520, 3, 100.0,
    )
    q = aggregate.price_quantiles(sample).first()
    assert (q.median, q.p75) == (49.0, 54.0)


@pytest.mark.parametrize(
    "text,value",
    [("59.99", 59.99), ("$1,299.50 USD", 1299.5), ("€ 19", 19.0), ("1.299,50", 1.2995), ("12.34.56", 0.0), ("N/A", 0.0), ("", 0.0), (None, 0.0)],
)
def test_parse_price(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_price("t")).first()[0] == value


def test_price_bands_and_flags(spark):
    prices = [-5.0, 0.0, 20.0, 20.01, 50.0, 100.0, 100.01, None]
    df = spark.createDataFrame([(p,) for p in prices], "p double")
    want = [None, None, "budget", "mid_range", "mid_range", "premium", "luxury", None]
    assert [r[0] for r in df.select(price_band("p")).collect()] == want
    flags = spark.createDataFrame([("true",), ("YES",), ("1",), ("no",), (None,)], "f string")
    assert [r[0] for r in flags.select(parse_flag("f")).collect()] == [True, True, True, False, False]


def test_json_in_text(spark):
    texts = ['Sure: {"a": {"b": 1}} done', "no object", "{broken", "{not json}", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(json_or_raw("t")).collect()]
    assert got == ['{"a": {"b": 1}}', '{"raw":"no object"}', '{"raw":"{broken"}', '{"raw":"{not json}"}', "{}"]


def test_discount(spark):
    df = spark.createDataFrame([(15.0, 20.0), (15.0, None), (15.0, 0.0)], "price double, compare_at_price double")
    assert [r[0] for r in df.select(prep.discount_pct()).collect()] == [25.0, None, None]


def test_sparse_columns(spark):
    rows = [(i, 1 if i < 7 else None, 1 if i < 6 else None) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    assert prep.drop_sparse(df).columns == ["id", "a"]


def test_all_null_rating(sample):
    bare = sample.withColumn("rating", F.lit(None).cast("double"))
    assert prep.fill_missing(bare.withColumn("quantity", F.lit(1))).first().rating == 0.0
    assert aggregate.rating_stats(bare).first().n == 0
    assert {r.band: r.n for r in aggregate.rating_bands(bare).collect()} == {"haut (4-5)": 3}
    assert len(scoring.top_k(bare).collect()) == 3


def test_label_encoding(spark):
    df = spark.createDataFrame([("1", "b"), ("2", "a"), ("3", None), ("4", "b")], "product_id string, category string")
    assert by_id(prep.label_encode(df, ["category"]), "category_encoded") == {"1": 2, "2": 1, "3": 0, "4": 2}


def test_imputation_is_stable(spark):
    rows = [(str(i), None if i % 2 else 4.0, 0 if i % 3 else 7, None, None if i % 5 else "V", None, []) for i in range(50)]
    df = spark.createDataFrame(
        rows, "product_id string, rating double, reviews_count int, quantity int, vendor string, availability boolean, tags array<string>"
    )
    once = prep.impute_missing(df)
    again = prep.impute_missing(once.repartition(3))
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    for before, after in zip(sorted(df.collect(), key=lambda r: r.product_id), sorted(once.collect(), key=lambda r: r.product_id)):
        assert before.rating is None and 0.5 <= after.rating <= 5.0 or after.rating == before.rating
        assert before.vendor is None and after.vendor in prep.VENDOR_POOL or after.vendor == before.vendor
        assert after.availability is not None and after.quantity is not None and len(after.tags) == 2


def test_feature_frames(spark):
    df = spark.createDataFrame([("1", "x", 2, None), ("2", "3.5", 1, 1)], "product_id string, price string, rating int, label int")
    rows = prep.feature_matrix(df, ("price", "rating", "quantity"), "label").collect()
    assert [list(r.features.toArray()) for r in rows] == [[3.5, 1.0, 0.0]]
    assert prep.numeric_frame(df, ["price"]).collect()[0].price == 0.0
    assert prep.numeric_frame(df).columns == ["rating", "label"]


def test_context_lines(sample):
    lines = [r.line for r in competitive.context_lines(sample, 2).orderBy("position").collect()]
    assert lines == ["- Wireless Earbuds | 59$", "- Fitness Tracker | 49$"]
