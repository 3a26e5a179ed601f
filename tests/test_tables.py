from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import tables
from shelfwise.schema import PRODUCT_SCHEMA
from shelfwise.sources import store

OLD, NOW = datetime(2024, 1, 1), datetime(2024, 6, 1)


def product(**cells):
    return tuple(cells.get(f.name) for f in PRODUCT_SCHEMA)


@pytest.fixture
def stored(spark):
    row = product(product_id="1", name="A", price=10.0, currency="EUR", vendor="V1", quantity=5, images=["a"], tags=[], created_at=OLD, updated_at=OLD)
    return spark.createDataFrame([row], PRODUCT_SCHEMA)


@pytest.fixture
def incoming(spark):
    rows = [
        product(product_id="1", name="A2", price=12.0, currency="USD", vendor="V2", quantity=7, images=["b"]),
        product(product_id="2", name="B", price=1.0),
    ]
    return spark.createDataFrame(rows, PRODUCT_SCHEMA)


def test_full_update(stored, incoming):
    rows = {r.product_id: r for r in tables.upsert(stored, incoming, now=F.lit(NOW), source_url="u").collect()}
    one, two = rows["1"], rows["2"]
    assert (one.name, one.price, one.currency, one.vendor, one.quantity, one.images) == ("A2", 12.0, "EUR", "V1", 7, ["b"])
    assert (one.created_at, one.updated_at, one.source_url) == (OLD, NOW, None)
    assert (two.name, two.currency, two.created_at, two.source_url) == ("B", "USD", NOW, "u")


def test_reduced_update(stored, incoming):
    one = tables.upsert(stored, incoming, tables.REDUCED_UPDATE, now=F.lit(NOW)).where("product_id = '1'").first()
    assert (one.name, one.price, one.currency, one.vendor, one.quantity, one.images) == ("A2", 12.0, "EUR", "V1", 5, ["a"])


def test_last_of_a_batch_wins(spark, stored):
    rows = [(str(1 + i % 2), float(i), i) for i in range(10)]
    batch = spark.createDataFrame(rows, "product_id string, price double, seq int").repartition(4)
    got = {r.product_id: r.price for r in tables.upsert(stored, batch, order_by=["seq"]).collect()}
    assert got == {"1": 8.0, "2": 9.0}


def test_upsert_twice_changes_nothing(stored, incoming):
    once = tables.upsert(stored, incoming, now=F.lit(NOW))
    assert sorted(map(str, tables.upsert(once, incoming, now=F.lit(NOW)).collect())) == sorted(map(str, once.collect()))


def test_best_candidate(spark):
    agents = spark.createDataFrame(
        [("shopify_1", "shopify", 4, 5), ("woo_1", "woocommerce", 0, 5), ("generic_1", "generic", 1, 3)],
        "agent_id string, platform string, current_load int, max_load int",
    )
    tasks = spark.createDataFrame([("a", "shopify"), ("b", "woocommerce"), ("c", "other"), ("d", "generic")], "task_id string, platform string")
    got = {r.task_id: r.agent_id for r in tables.best_candidate(tasks, agents).collect()}
    assert got == {"a": "generic_1", "b": "woo_1", "c": "generic_1", "d": "generic_1"}
    alone = tables.best_candidate(tasks, agents.where("platform = 'shopify'"))
    assert {r.task_id: r.agent_id for r in alone.collect()} == {"a": "shopify_1", "b": None, "c": None, "d": None}


def test_backfill_and_unmatched(spark):
    base = spark.createDataFrame([("1", None, 3), ("2", 4.0, 2), ("3", 0.0, None), ("4", 0.0, 1)], "product_id string, rating double, reviews_count int")
    raw = spark.createDataFrame([("1", 3.5, 9), ("2", 1.0, 1), ("3", 2.0, None)], "product_id string, rating double, reviews_count int")
    got = {r.product_id: (r.rating, r.reviews_count, r.backfilled) for r in tables.rating_backfill(base, raw).collect()}
    assert got == {"1": (3.5, 9, True), "2": (4.0, 2, False), "3": (2.0, 0, True), "4": (0.0, 1, False)}
    assert [r.product_id for r in tables.unmatched_ids(base, raw).collect()] == ["4"]


def test_result_assembly(spark):
    tasks = spark.createDataFrame([(t, "u", "p", "running") for t in "abc"], "task_id string, url string, platform string, status string")
    done = spark.createDataFrame([("a", "x", 1.0, 3.5)], "task_id string, assigned_to string, started_at double, completed_at double")
    lost = spark.createDataFrame([("b", "y", "boom")], "task_id string, assigned_to string, error string")
    got = {r.task_id: (r.status, r.agent, r.duration, r.error) for r in tables.assemble_results(tasks, done, lost).collect()}
    assert got == {"a": ("completed", "x", 2.5, None), "b": ("failed", "y", None, "boom"), "c": ("running", None, None, None)}


def test_union_of_unlike_sources(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "y int")
    assert {(r.x, r.y, r.source) for r in tables.union_sources(a=a, b=b).collect()} == {(1, None, "a"), (None, 2, "b")}


def test_store_round_trip(spark, stored, incoming, tmp_path):
    shop = store.ProductStore(spark, str(tmp_path / "shop"))
    with pytest.raises(FileNotFoundError):
        shop.read()
    shop.upsert(stored)
    shop.upsert(incoming)
    assert {r.product_id: r.name for r in shop.read().collect()} == {"1": "A2", "2": "B"}


@pytest.mark.parametrize("update", [tables.FULL_UPDATE, tables.REDUCED_UPDATE])
def test_store_equals_repeated_upserts(spark, stored, tmp_path, update):
    shop = store.ProductStore(spark, str(tmp_path / "shop"), update, buckets=4)
    big = [product(product_id=f"x{i}", name=f"x{i}", created_at=OLD, updated_at=OLD, currency="USD") for i in range(300)]
    want = stored.unionAll(spark.createDataFrame(big, PRODUCT_SCHEMA))
    shop.replace(want)
    for n in range(4):
        now = F.lit(datetime(2024, 7, 1 + n))
        rows = [product(product_id=str(i), name=f"{i}-{n}", quantity=n, vendor=f"v{n}", price=float(i)) for i in range(n, n + 4)]
        batch = spark.createDataFrame(rows, PRODUCT_SCHEMA)
        for _ in range(2):  # the same batch again changes nothing
            shop.upsert(batch, now=now)
        want = spark.createDataFrame(tables.upsert(want, batch, update, now=now).collect(), PRODUCT_SCHEMA)
        assert sorted(map(str, shop.read().collect())) == sorted(map(str, want.collect()))


def test_repeated_keys_of_a_batch_end_in_one_row(spark, stored, tmp_path):
    rows = [product(product_id="1", name="first", quantity=5), product(product_id="1", name="second", quantity=1), product(product_id="2", name="other")]
    batch = spark.createDataFrame(rows, PRODUCT_SCHEMA)
    for order, name in (((), "second"), (("quantity",), "first")):
        merged = tables.upsert(stored, batch, order_by=order).where("product_id in ('1', '2')").collect()
        assert sorted((r.product_id, r.name) for r in merged) == [("1", name), ("2", "other")]
        shop = store.ProductStore(spark, str(tmp_path / f"shop{len(order)}"))
        shop.upsert(batch, order)
        shop.upsert(batch.limit(0))
        assert sorted((r.product_id, r.name) for r in shop.read().collect()) == [("1", name), ("2", "other")]


def test_fallback_chain(spark, stored, tmp_path):
    assert store.load_products(spark, str(tmp_path / "none"), str(tmp_path / "none.json")).count() == 3
    path = str(tmp_path / "p")
    store.write_records(stored, path)
    assert store.load_products(spark, str(tmp_path / "none"), path).first().name == "A"


def test_json_array(spark, tmp_path):
    f = tmp_path / "p.json"
    f.write_text('[{"product_id": "1", "price": 2.5, "tags": ["x"]}, {"product_id": "2"}]')
    rows = {r.product_id: (r.price, r.tags) for r in store.read_products_json(spark, str(f)).collect()}
    assert rows == {"1": (2.5, ["x"]), "2": (None, None)}


def test_limit_before_or_after_filter(spark):
    rows = [(str(i), "x" if i % 2 else "y", datetime(2024, 1, 1 + i)) for i in range(8)]
    df = spark.createDataFrame(rows, "product_id string, category string, created_at timestamp")
    assert [r.product_id for r in store.query_products(df, 2, "y").collect()] == ["6", "4"]
    assert [r.product_id for r in store.query_products(df, 2, "y", limit_first=True).collect()] == ["6"]


def test_replace_one_source(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    store.replace_source(df, path, "a")
    store.replace_source(df, path, "b")
    store.replace_source(df.limit(1), path, "a")
    counts = {r.source: r["count"] for r in spark.read.parquet(path).groupBy("source").count().collect()}
    assert counts == {"a": 1, "b": 2}


def test_result_tables(spark, tmp_path):
    root = str(tmp_path)
    scored = store.sample_products(spark).withColumn("_score", F.lit(0.5))
    store.append_results(store.top_k_rows(scored, "run"), root, "top_k_results")
    store.append_results(store.metric_rows(spark, "kmeans", {"silhouette": 0.4}), root, "model_metrics")
    store.append_results(store.run_row(spark, "r1", 0, 0, 0, 0), root, "run_log")
    store.append_results(store.run_row(spark, "r2", 5, 4, 2, 3), root, "run_log")
    top = spark.read.parquet(f"{root}/top_k_results")
    assert top.count() == 3 and '"name":"' in top.first().payload
    assert spark.read.parquet(f"{root}/model_metrics").first().metrics == {"silhouette": 0.4}
    assert {r.run_id: r.status for r in spark.read.parquet(f"{root}/run_log").collect()} == {"r1": "empty", "r2": "completed"}
