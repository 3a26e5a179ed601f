import json

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import pages, raw, store


def payloads(spark, *records):
    return spark.createDataFrame([(json.dumps(r) if not isinstance(r, str) else r,) for r in records], "payload string")


@pytest.mark.parametrize(
    "sale,regular,price,status,stock,want",
    [
        ("15", "20", "15", "instock", 4, (15.0, True, 4)),
        ("", "20", "18", "outofstock", 0, (20.0, False, 0)),
        ("", "", "18", None, 3, (18.0, True, 3)),
        ("abc", "20", "18", None, None, (0.0, False, None)),
    ],
)
def test_woo_price_and_stock(spark, sale, regular, price, status, stock, want):
    record = {"id": 7, "sale_price": sale, "regular_price": regular, "price": price, "stock_status": status, "stock_quantity": stock}
    r = raw.parse_woocommerce(payloads(spark, record)).first()
    assert (r.price, r.availability, r.quantity) == want
    assert (r.product_id, r.currency, r.images, r.tags, r.category) == ("7", "USD", [], [], "")


def test_woo_nested_parts(spark):
    record = {
        "id": 1, "name": "N", "categories": [{"name": "C1"}, {"name": "C2"}], "images": [{"src": "a"}, {"src": ""}, {"alt": "x"}],
        "tags": [{"name": "t"}, {}], "average_rating": "4.50", "review_count": 12, "seller_info": {"name": "S"},
    }
    r = raw.parse_woocommerce(payloads(spark, record)).first()
    assert (r.category, r.images, r.tags, r.rating, r.reviews_count, r.vendor) == ("C1", ["a"], ["t", ""], 4.5, 12, "S")


def test_shopify(spark):
    record = {
        "id": "gid", "title": "T", "productType": "P", "tags": ["x"], "vendor": "V", "rating": {"value": "4.1"}, "reviewsCount": {"value": "8"},
        "variants": {"edges": [{"node": {"price": "9.90", "availableForSale": False, "inventoryQuantity": 3}}]},
        "images": {"edges": [{"node": {"originalSrc": "i"}}]},
    }
    r = raw.parse_shopify(payloads(spark, record, {"id": "bare"})).collect()
    assert (r[0].price, r[0].availability, r[0].quantity, r[0].images, r[0].rating, r[0].reviews_count) == (9.9, False, 3, ["i"], 4.1, 8)
    assert (r[1].product_id, r[1].price, r[1].images) == ("bare", 0.0, [])


def test_normalise(spark):
    df = raw.parse_records(
        payloads(
            spark,
            {"product_id": "1", "product_name": "A", "body_html": "d", "product_type": "c", "price": "$5", "seller": "s", "image": "i"},
            {"id": "2", "title": "B", "variants": [{"price": "7.5"}], "available": False, "price_currency": "EUR", "tags": ["t"]},
            {"id": "3"},
        ),
        "payload",
    )
    a, b, c = raw.normalize_products(df).collect()
    assert (a.product_id, a.name, a.description, a.category, a.price, a.vendor, a.images) == ("1", "A", "d", "c", 5.0, "s", ["i"])
    assert (b.price, b.availability, b.currency, b.tags) == (7.5, False, "EUR", ["t"])
    assert (c.price, c.availability, c.currency, c.name) == (0.0, True, "USD", "")


def test_payload_shapes(spark):
    df = payloads(spark, {"name": "a"}, {"products": [{"name": "b"}, {"name": "c"}]}, [{"title": "d"}], {"other": 1}, "not json", "[]")
    names = [json.loads(r.payload) for r in raw.payload_rows(df).collect()]
    assert sorted(n.get("name") or n["title"] for n in names) == ["a", "b", "c", "d"]


def test_lineage(spark):
    df = raw.add_lineage(spark.range(1), F.lit("agent"), F.lit("woo"), F.lit("u"))
    r = df.first()
    assert (r._source_agent, r._source_platform, r._source_url) == ("agent", "woo", "u") and r._collected_at is not None


def test_scraper_tags(spark):
    r = raw.tag_scraper(spark.range(1), "a1", "woocommerce").first()
    assert (r._scraped_by, r._platform, r._scraper) == ("a1", "woocommerce", None)


def test_landed_pages(spark, tmp_path):
    for n, records in ((1, [{"id": 1}, {"id": 2}]), (2, [{"id": 3}]), (3, []), (4, [{"id": 9}])):
        (tmp_path / f"page-{n}.json").write_text(json.dumps(records))
    got = raw.read_api_pages(spark, str(tmp_path))
    assert sorted(json.loads(r.payload)["id"] for r in got.collect()) == [1, 2, 3]
    assert raw.read_api_pages(spark, str(tmp_path), max_pages=1).count() == 2


def test_many_pages_and_unreadable_ones(spark, tmp_path):
    for n in range(1, 71):
        (tmp_path / f"page-{n}.json").write_text("<html>busy</html>" if n == 7 else json.dumps([{"id": n}]))
    got = raw.read_api_pages(spark, str(tmp_path)).collect()
    assert {r.page for r in got} == set(range(1, 71))
    assert [(r.page, r.payload) for r in got if r.status != "ok"] == [(7, None)]


def test_outputs_with_status(spark):
    ok = spark.createDataFrame([("1",)], "product_id string")
    got = raw.collect_outputs({"a": ok, "b": None, "c": ok})
    assert {(r.target, r.status) for r in got.collect()} == {("a", "ok"), ("b", "error"), ("c", "ok")}
    assert raw.successful(got).count() == 2


def test_targets(spark, tmp_path):
    text = json.dumps([{"platform": "woo", "url": "u", "priority": 2, "params": {"k": "v"}}, {"url": "w"}])
    (tmp_path / "t.json").write_text(text)
    for df in (raw.read_targets(spark, str(tmp_path / "t.json")), raw.read_targets(spark, inline=text)):
        rows = {r.url: (r.platform, r.params, r.priority, r.max_retries) for r in df.collect()}
        assert rows == {"u": ("woo", {"k": "v"}, 2, 3), "w": ("generic", {}, 0, 3)}
    tasks = raw.tasks_from_targets(raw.read_targets(spark, inline=text)).collect()
    assert len({t.task_id for t in tasks}) == 2 and {t.status for t in tasks} == {"pending"}


PAGE = """<html><head><title>Lamp &amp; Co</title><meta name="description" content="From the head">
<meta property="product:price:amount" content="19.50"></head><body>
<div class="old-price">was</div><div class="Price">$ 1,020.00</div><p class="long description">A <b>fine</b> lamp for every single desk</p></body></html>"""


def test_page_places(spark):
    assert pages.page_facts(PAGE) == ("Lamp & Co", "was", "A fine lamp for every single desk")
    assert pages.page_facts(PAGE, strict=True) == ("Lamp & Co", "19.50", "A fine lamp for every single desk")
    short = PAGE.replace("A <b>fine</b> lamp for every single desk", "tiny")
    assert pages.page_facts(short)[2] == "tiny"
    assert pages.page_facts(short, strict=True)[2] == "From the head"
    assert pages.page_facts("") == ("", None, "")
    assert pages.page_facts("<title>open") == ("open", None, "")
    assert pages.page_facts('<div id="price"><span>4</span>.50</div>')[1] == "4.50"


def test_pages_with_and_without_marks_agree(spark):
    plain = [
        "<html><head><title>A &lt;b&gt; &eacute;</title></head><body>x</body></html>",
        "<script>var a='<title>no</title>'</script><title>yes</title>",
        "<!-- <title>no</title> --><title lang='en'>two\nlines</title>",
        "<TITLE>Upper</TITLE>",
        "no title at all",
        "",
        PAGE,
    ]
    df = spark.createDataFrame(list(enumerate(plain)), "page_id long, html string").repartition(3)
    got = {r.page_id: (r.title, r.description) for r in pages.extract_pages(df).collect()}
    assert got == {i: (pages.page_facts(h)[0], pages.page_facts(h)[2]) for i, h in enumerate(plain)}
    assert got[1][0] == "yes" and got[3][0] == "Upper"
    strict = pages.extract_pages(df, strict=True).where("page_id = 6").first()
    assert strict.price == 19.5


def test_urls(spark):
    urls = ["https://a.myshopify.com/products/mug?x=1", "http://s.com/product/cup/", "plain"]
    df = pages.url_facts(spark.createDataFrame([(u,) for u in urls], "url string"))
    a, b, c = df.collect()
    assert (a.base_url, a.handle, a.shop_domain, a.is_store) == ("https://a.myshopify.com", "mug", "a", True)
    assert (b.base_url, b.product_slug, b.is_store) == ("http://s.com", "cup", False)
    assert c.base_url is None


def test_store_keeps_its_number_of_partitions(spark, tmp_path):
    """Whatever a later handle says, and whichever keys a batch touches, a key stays one row."""
    root = str(tmp_path / "shop")
    rows = spark.createDataFrame([(str(i), float(i)) for i in range(50)], "product_id string, price double")
    store.ProductStore(spark, root, buckets=64).upsert(rows)
    for buckets in (32, None, 7):
        shop = store.ProductStore(spark, root, buckets=buckets)
        shop.upsert(rows.where("price < 20").withColumn("price", F.col("price") + 1000))
        assert shop.width() == 64
        assert sorted(r.product_id for r in shop.read().collect()) == sorted(str(i) for i in range(50))
    shop.resize(8)
    assert shop.width() == 8 and shop.read().count() == 50
    shop.upsert(rows)
    assert {(r.product_id, r.price) for r in shop.read().collect()} == {(str(i), float(i)) for i in range(50)}
    fresh = store.ProductStore(spark, str(tmp_path / "new"))
    fresh.replace(rows)
    assert fresh.width() == store.MIN_BUCKETS
