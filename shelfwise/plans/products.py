"""Queries over the product view."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.columns import clean_title, parse_price

from shelfwise.operators import aggregate, competitive, prep, scoring, tables
from shelfwise.plans.catalog import PRODUCTS_SQL, held, products, table
from shelfwise.plans.registry import query
from shelfwise.sources import pages, store

P = PRODUCTS_SQL
SPLIT = "1998-01-01"
NOW = "2024-01-01 00:00:00"


def early(spark, sf_dir):
    """Catalogue as of the split date: parts sold before it."""
    df = products(spark, sf_dir, lambda l: l.where(F.col("l_shipdate") < F.lit(SPLIT).cast("timestamp_ntz")))
    return df.where(F.col("rating").isNotNull())


def late(spark, sf_dir):
    """Catalogue of the sales since the split date."""
    df = products(spark, sf_dir, lambda l: l.where(F.col("l_shipdate") >= F.lit(SPLIT).cast("timestamp_ntz")))
    return df.where(F.col("rating").isNotNull())


def _snapshot_sql(name: str, condition: str) -> str:
    facts = (
        P.strip()
        .replace("WITH facts AS", f"{name}_facts AS")
        .replace("FROM lineitem GROUP BY", f"FROM lineitem WHERE l_shipdate {condition} TIMESTAMP '{SPLIT}' GROUP BY")
        .replace("products AS (", f"{name}_all AS (")
        .replace("LEFT JOIN facts", f"LEFT JOIN {name}_facts")
    )
    return facts + f", {name} AS (SELECT * FROM {name}_all WHERE rating IS NOT NULL)"


SNAPSHOTS = "WITH " + _snapshot_sql("early", "<") + ", " + _snapshot_sql("late", ">=")


GAPPY = ("price", "rating", "reviews_count", "vendor", "availability")


def gaps_in(df):
    """Cells blanked by rules on the row, as raw feeds have them."""
    q = F.col("quantity")
    return df.withColumns(
        {
            "rating": F.when(q % 4 != 0, F.col("rating")).otherwise(F.when(q % 8 == 0, 0.0)),
            "reviews_count": F.when(q % 5 != 0, F.col("reviews_count")),
            "price": F.when(q % 7 != 0, F.col("price")),
            "vendor": F.when(q % 3 != 0, F.col("vendor")),
            "availability": F.when(q % 6 != 0, F.col("availability")),
        }
    )


def with_gaps(spark, sf_dir):
    """The whole catalogue with such gaps."""
    return gaps_in(products(spark, sf_dir))


GAPS = P + """, gaps AS (
  SELECT * REPLACE (
    CASE WHEN quantity % 4 <> 0 THEN rating WHEN quantity % 8 = 0 THEN 0.0 END AS rating,
    CASE WHEN quantity % 5 <> 0 THEN reviews_count END AS reviews_count,
    CASE WHEN quantity % 7 <> 0 THEN price END AS price,
    CASE WHEN quantity % 3 <> 0 THEN vendor END AS vendor,
    CASE WHEN quantity % 6 <> 0 THEN availability END AS availability)
  FROM products)
"""


# --- reading -----------------------------------------------------------------

@query("fetch_latest", P + "SELECT product_id, name, created_at FROM products ORDER BY created_at DESC NULLS LAST, product_id LIMIT 1000")
def fetch_latest(spark, sf):
    return store.fetch_latest(products(spark, sf)).select("product_id", "name", "created_at")


@query("products_by_price", P + "SELECT product_id, name, price FROM products ORDER BY price DESC, product_id")
def products_by_price(spark, sf):
    return store.products_by_price(products(spark, sf).select("product_id", "name", "price"))


@query(
    "query_products",
    P + "SELECT product_id, name, category, created_at FROM products WHERE category = 'PROMO' ORDER BY created_at DESC NULLS LAST, product_id LIMIT 100",
)
def query_products(spark, sf):
    return store.query_products(products(spark, sf), 100, "PROMO").select("product_id", "name", "category", "created_at")


def _upsert_sql(overwrite_stock: bool) -> str:
    quantity = "CASE WHEN l.product_id IS NOT NULL THEN l.quantity ELSE e.quantity END" if overwrite_stock else (
        "CASE WHEN e.product_id IS NOT NULL THEN e.quantity ELSE l.quantity END"
    )
    return SNAPSHOTS + f"""
    SELECT coalesce(e.product_id, l.product_id) AS product_id,
           CASE WHEN l.product_id IS NOT NULL THEN l.price * CAST(1.1 AS DOUBLE) ELSE e.price END AS price,
           {quantity} AS quantity,
           CASE WHEN l.product_id IS NOT NULL THEN l.availability ELSE e.availability END AS availability,
           CASE WHEN l.product_id IS NOT NULL THEN l.rating ELSE e.rating END AS rating,
           CASE WHEN l.product_id IS NOT NULL THEN l.reviews_count ELSE e.reviews_count END AS reviews_count,
           CASE WHEN e.product_id IS NOT NULL THEN e.vendor ELSE l.vendor END AS vendor,
           CASE WHEN e.product_id IS NOT NULL THEN e.created_at ELSE TIMESTAMP '{NOW}' END AS created_at,
           CASE WHEN l.product_id IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE e.updated_at END AS updated_at
    FROM early e FULL OUTER JOIN late l ON e.product_id = l.product_id"""


def _upsert(spark, sf, update):
    # every key comes twice, the valid row second
    seen = late(spark, sf)
    first = seen.withColumns({"price": F.col("price") * F.lit(9), "quantity": F.lit(-1), "seq": F.lit(1)})
    incoming = first.unionByName(seen.withColumns({"price": F.col("price") * F.lit(1.1), "seq": F.lit(2)}))
    merged = tables.upsert(early(spark, sf), incoming, update, order_by=["seq"], now=F.lit(NOW).cast("timestamp_ntz"))
    return merged.select(
        "product_id", "price", "quantity", "availability", "rating", "reviews_count", "vendor", "created_at", "updated_at"
    )


@query("catalog_upsert", _upsert_sql(True))
def catalog_upsert(spark, sf):
    return _upsert(spark, sf, tables.FULL_UPDATE)


@query("catalog_upsert_reduced", _upsert_sql(False))
def catalog_upsert_reduced(spark, sf):
    return _upsert(spark, sf, tables.REDUCED_UPDATE)


@query(
    "rating_backfill",
    GAPS + """SELECT g.product_id,
      CASE WHEN (g.rating IS NULL OR g.rating = 0 OR g.reviews_count IS NULL) AND p.rating IS NOT NULL THEN p.rating ELSE g.rating END AS rating,
      CASE WHEN (g.rating IS NULL OR g.rating = 0 OR g.reviews_count IS NULL) AND p.rating IS NOT NULL THEN coalesce(p.reviews_count, 0) ELSE g.reviews_count END AS reviews_count,
      (g.rating IS NULL OR g.rating = 0 OR g.reviews_count IS NULL) AND p.rating IS NOT NULL AS backfilled
    FROM gaps g LEFT JOIN products p ON p.product_id = g.product_id""",
)
def rating_backfill(spark, sf):
    raw = held(products(spark, sf), "product_id", "quantity", *GAPPY)
    filled = tables.rating_backfill(gaps_in(raw), raw.select("product_id", "rating", "reviews_count"))
    return filled.select("product_id", "rating", "reviews_count", "backfilled")


@query(
    "unmatched_ids",
    GAPS + "SELECT product_id FROM products WHERE product_id NOT IN (SELECT product_id FROM gaps WHERE rating IS NOT NULL)",
)
def unmatched_ids(spark, sf):
    raw = held(products(spark, sf), "product_id", "quantity", *GAPPY)
    return tables.unmatched_ids(raw, gaps_in(raw).where(F.col("rating").isNotNull()))


@query(
    "union_sources",
    SNAPSHOTS + """SELECT product_id, quantity, 'early' AS source FROM early
    UNION ALL SELECT product_id, quantity, 'late' FROM late""",
)
def union_sources(spark, sf):
    cols = ("product_id", "quantity")
    return tables.union_sources(early=early(spark, sf).select(*cols), late=late(spark, sf).select(*cols))


@query(
    "dedupe_latest",
    """SELECT user_id, event_id, ts, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def dedupe_latest(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return tables.dedupe_latest(ev, "user_id", ["ts", "event_id"])


@query(
    "best_candidate",
    """WITH agents AS (
      SELECT s_suppkey AS agent_id, CASE WHEN r_name = 'AFRICA' THEN 'generic' ELSE r_name END AS platform,
             count(*) FILTER (WHERE l_linestatus = 'O') AS current_load, count(*) AS max_load
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1, 2
    ), offers AS (
      SELECT *, row_number() OVER (PARTITION BY platform ORDER BY current_load / CAST(greatest(max_load, 1) AS DOUBLE), agent_id) AS rn FROM agents
    ), best AS (SELECT agent_id, platform, current_load / CAST(greatest(max_load, 1) AS DOUBLE) AS load FROM offers WHERE rn = 1),
    generic AS (SELECT * FROM best WHERE platform = 'generic'),
    tasks AS (
      SELECT o_orderkey AS task_id, r_name AS platform FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    )
    SELECT task_id, t.platform,
      CASE WHEN b.agent_id IS NOT NULL AND (g.agent_id IS NULL OR b.load < g.load OR (b.load = g.load AND b.agent_id < g.agent_id)) THEN b.agent_id ELSE g.agent_id END AS agent_id,
      CASE WHEN b.agent_id IS NOT NULL AND (g.agent_id IS NULL OR b.load < g.load OR (b.load = g.load AND b.agent_id < g.agent_id)) THEN b.load ELSE g.load END AS load
    FROM tasks t LEFT JOIN best b ON b.platform = t.platform AND b.platform <> 'generic'
    LEFT JOIN generic g ON true""",
)
def best_candidate(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    place = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", F.col("r_name").alias("platform"))
    load = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_linestatus") == "O").alias("current_load"), F.count(F.lit(1)).alias("max_load")
    )
    supplier = table(spark, sf, "supplier")
    agents = (
        supplier.join(load, supplier.s_suppkey == load.l_suppkey)
        .join(place, supplier.s_nationkey == place.n_nationkey)
        .select(
            F.col("s_suppkey").alias("agent_id"),
            F.when(F.col("platform") == "AFRICA", "generic").otherwise(F.col("platform")).alias("platform"),
            "current_load",
            "max_load",
        )
    )
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    tasks = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(place, customer.c_nationkey == place.n_nationkey)
        .select(F.col("o_orderkey").alias("task_id"), "platform")
    )
    return tables.best_candidate(tasks, agents)


# --- cleaning and features -----------------------------------------------------

PRICE_TEXT = """CASE p_size % 6 WHEN 0 THEN CAST(p_retailprice AS VARCHAR)
  WHEN 1 THEN '$1,' || CAST(p_size + 200 AS VARCHAR) || '.50 USD'
  WHEN 2 THEN 'EUR ' || CAST(p_size AS VARCHAR) WHEN 3 THEN 'N/A'
  WHEN 4 THEN '12.34.' || CAST(p_size AS VARCHAR) ELSE '' END"""


@query(
    "parse_price",
    f"""SELECT p_partkey, t AS price_text,
      coalesce(try_cast(t AS DOUBLE), try_cast(replace(regexp_extract(t, '[0-9.,]+'), ',', '') AS DOUBLE), 0) AS price
    FROM (SELECT p_partkey, {PRICE_TEXT} AS t FROM part)""",
)
def parse_price_query(spark, sf):
    text = F.expr(PRICE_TEXT.replace("VARCHAR", "STRING")).alias("price_text")
    return table(spark, sf, "part").select("p_partkey", text).withColumn("price", parse_price("price_text"))


@query(
    "page_extract",
    """SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1, 's'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;?', '&', 'g') AS title,
      '' AS description, CAST(0 AS DOUBLE) AS price FROM pages""",
)
def page_extract(spark, sf):
    return pages.extract_pages(table(spark, sf, "pages"))


@query(
    "page_marks",
    """SELECT p_partkey AS page_id, p_name AS title, round(p_retailprice, 2) AS price, p_name || ' by ' || p_brand || ' in ' || p_type AS description FROM part""",
)
def page_marks(spark, sf):
    """Pages with price and description marks, made from the parts."""
    text = F.concat("p_name", F.lit(" by <b>"), "p_brand", F.lit("</b> in "), "p_type")
    price = F.expr("CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING)")
    html = F.concat(
        F.lit("<html><head><title>"), "p_name", F.lit('</title></head><body><nav>x</nav><div class="the-price">$ '), price,
        F.lit('</div><p class="long description">'), text, F.lit("</p></body></html>"),
    )
    made = table(spark, sf, "part").select(F.col("p_partkey").alias("page_id"), html.alias("html"))
    return pages.extract_pages(made).withColumn("price", F.round("price", 2))


URLS = """
  SELECT url FROM pages
  UNION ALL SELECT concat('https://shop', CAST(p_size AS {text}), '.myshopify.com/products/', replace(p_name, ' ', '-'), '?ref=', p_brand) FROM part
  UNION ALL SELECT concat('http://store.example.com/product/', replace(p_name, ' ', '-'), '/') FROM part
"""


@query(
    "url_facts",
    f"""SELECT url, split_part(url, '/', 1) || '//' || split_part(url, '/', 3) AS base_url,
      CASE WHEN contains(url, '/product/') THEN trim(split_part(split_part(url, '/product/', 2), '?', 1), '/') END AS product_slug,
      CASE WHEN contains(url, '/products/') THEN trim(split_part(split_part(url, '/products/', 2), '?', 1), '/') END AS handle,
      replace(split_part(split_part(url, '//', 2), '/', 1), '.myshopify.com', '') AS shop_domain,
      NOT contains(url, '/product/') AS is_store
    FROM ({URLS.format(text='VARCHAR')})""",
)
def url_facts(spark, sf):
    part = table(spark, sf, "part")
    dashed = F.replace("p_name", F.lit(" "), F.lit("-"))
    shop = part.select(
        F.concat(F.lit("https://shop"), F.col("p_size").cast("string"), F.lit(".myshopify.com/products/"), dashed, F.lit("?ref="), "p_brand").alias("url")
    )
    woo = part.select(F.concat(F.lit("http://store.example.com/product/"), dashed, F.lit("/")).alias("url"))
    return pages.url_facts(table(spark, sf, "pages").select("url").unionAll(shop).unionAll(woo))


def _draw_sql(salt: str, n: int) -> str:
    return f"CAST(CAST('0x' || substr(md5(product_id || ':{salt}:42'), 1, 8) AS BIGINT) % {n} AS INTEGER)"


@query(
    "impute_missing",
    GAPS + f"""SELECT product_id,
      coalesce(availability, {_draw_sql('availability', 1000)} < 700) AS availability,
      coalesce(quantity, {_draw_sql('quantity', 51)}) AS quantity,
      CASE WHEN trim(vendor) <> '' THEN vendor ELSE list_extract(['Generic Brand', 'TechCo', 'HomeGoods', 'FashionWear', 'SportMax'], {_draw_sql('vendor', 5)} + 1) END AS vendor,
      CASE WHEN rating <> 0 THEN rating ELSE (5 + {_draw_sql('rating', 46)}) / CAST(10 AS DOUBLE) END AS rating,
      CASE WHEN reviews_count <> 0 THEN reviews_count ELSE {_draw_sql('reviews', 200)} + 1 END AS reviews_count
    FROM gaps""",
)
def impute_missing(spark, sf):
    return prep.impute_missing(with_gaps(spark, sf)).select(
        "product_id", "availability", "quantity", "vendor", "rating", "reviews_count"
    )


@query(
    "coerce_types",
    P + """, text AS (SELECT product_id, CASE WHEN quantity % 3 = 0 THEN 'n/a' ELSE CAST(quantity AS VARCHAR) END AS price,
      CASE WHEN quantity % 4 = 0 THEN NULL ELSE CAST(reviews_count AS VARCHAR) END AS rating, CAST(reviews_count AS VARCHAR) AS reviews_count,
      CASE quantity % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'TRUE' WHEN 2 THEN '0' ELSE NULL END AS availability FROM products)
    SELECT product_id, coalesce(try_cast(price AS DOUBLE), 0) AS price, coalesce(try_cast(rating AS DOUBLE), 0) AS rating,
      coalesce(try_cast(reviews_count AS DOUBLE), 0) AS reviews_count, coalesce(lower(availability) IN ('true', '1', 'yes'), false) AS availability FROM text""",
)
def coerce_types(spark, sf):
    q, text = F.col("quantity"), products(spark, sf)
    text = text.select(
        "product_id",
        F.when(q % 3 == 0, "n/a").otherwise(q.cast("string")).alias("price"),
        F.when(q % 4 == 0, None).otherwise(F.col("reviews_count").cast("string")).alias("rating"),
        F.col("reviews_count").cast("string").alias("reviews_count"),
        F.when(q % 4 == 0, "Yes").when(q % 4 == 1, "TRUE").when(q % 4 == 2, "0").alias("availability"),
    )
    return prep.coerce_types(text)


@query(
    "numeric_frame",
    "SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, coalesce(p_retailprice, 0) AS p_retailprice FROM part",
)
def numeric_frame(spark, sf):
    return prep.numeric_frame(table(spark, sf, "part"))


@query(
    "null_profile",
    GAPS + """, c AS (SELECT count(*) AS n, count(price) AS a, count(rating) AS b, count(reviews_count) AS c, count(vendor) AS d, count(availability) AS e FROM gaps),
    r AS (SELECT n, unnest(['price', 'rating', 'reviews_count', 'vendor', 'availability']) AS column_name, unnest([a, b, c, d, e]) AS non_null FROM c)
    SELECT column_name, non_null, non_null >= floor(n * (1 - CAST(0.3 AS DOUBLE))) AS kept FROM r""",
)
def null_profile(spark, sf):
    return prep.null_profile(with_gaps(spark, sf).select("price", "rating", "reviews_count", "vendor", "availability"))


@query(
    "fill_missing",
    GAPS + """SELECT product_id, round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM gaps)), 6) AS price, coalesce(rating, 0) AS rating,
      coalesce(reviews_count, 0) AS reviews_count, coalesce(quantity, 0) AS quantity, coalesce(availability, false) AS availability FROM gaps""",
)
def fill_missing(spark, sf):
    filled = prep.fill_missing(held(with_gaps(spark, sf), "product_id", "price", "rating", "reviews_count", "quantity", "availability"))
    return filled.select("product_id", F.round("price", 6).alias("price"), "rating", "reviews_count", "quantity", "availability")


ZCOLS = ("price", "rating", "reviews_count", "quantity")


@query(
    "zscore",
    P + "SELECT product_id, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}_norm" for c in ZCOLS)
    + " FROM products",
)
def zscore(spark, sf):
    scaled = prep.zscore(held(products(spark, sf), "product_id", *ZCOLS), ZCOLS)
    return scaled.select("product_id", *[F.round(f"{c}_norm", 6).alias(f"{c}_norm") for c in ZCOLS])


@query(
    "label_encode",
    GAPS + """SELECT product_id, dense_rank() OVER (ORDER BY coalesce(category, 'None')) - 1 AS category_encoded,
      dense_rank() OVER (ORDER BY coalesce(vendor, 'None')) - 1 AS vendor_encoded FROM gaps""",
)
def label_encode(spark, sf):
    return prep.label_encode(held(with_gaps(spark, sf), "product_id", "category", "vendor")).select("product_id", "category_encoded", "vendor_encoded")


@query(
    "price_category",
    GAPS + """SELECT product_id, price, CASE WHEN price > 100 THEN 'luxury' WHEN price > 50 THEN 'premium'
      WHEN price > 20 THEN 'mid_range' WHEN price > 0 THEN 'budget' END AS price_category FROM gaps""",
)
def price_category(spark, sf):
    return prep.with_price_category(with_gaps(spark, sf)).select("product_id", "price", "price_category")


QUALITY = """(CAST(0.6 AS DOUBLE) * (coalesce(rating, 0) / CAST(5 AS DOUBLE))
  + CAST(0.4 AS DOUBLE) * (coalesce(reviews_count, 0) / CAST((SELECT max(reviews_count) FROM products) AS DOUBLE)))"""


@query(
    "quality_score",
    P + f"SELECT product_id, rating AS rating_original, reviews_count AS reviews_count_original, round({QUALITY}, 6) AS quality_score FROM products",
)
def quality_score(spark, sf):
    catalog = held(products(spark, sf), "product_id", "rating", "reviews_count")
    scored = prep.quality_score(prep.keep_originals(catalog, ("rating", "reviews_count")))
    return scored.select("product_id", "rating_original", "reviews_count_original", F.round("quality_score", 6).alias("quality_score"))


@query(
    "is_top",
    P + f""", q AS (SELECT product_id, {QUALITY} AS s FROM products)
    SELECT product_id, CAST(s >= (SELECT quantile_cont(s, 0.75) FROM q) AS INTEGER) AS is_top FROM q""",
)
def is_top(spark, sf):
    catalog = held(products(spark, sf), "product_id", "rating", "reviews_count")
    return prep.flag_top_quartile(prep.quality_score(catalog)).select("product_id", "is_top")


@query(
    "feature_matrix",
    GAPS + """SELECT product_id, coalesce(price, 0) AS price, coalesce(rating, 0) AS rating,
      CAST(coalesce(reviews_count, 0) AS DOUBLE) AS reviews_count, CAST(coalesce(quantity, 0) AS DOUBLE) AS quantity
    FROM gaps WHERE availability IS NOT NULL""",
)
def feature_matrix(spark, sf):
    return prep.feature_columns(with_gaps(spark, sf), label="availability").select("product_id", *prep.FEATURES)


@query(
    "missing_ratings",
    GAPS + "SELECT product_id, rating FROM gaps WHERE rating = 0 OR rating IS NULL",
)
def missing_ratings(spark, sf):
    return prep.missing_ratings(with_gaps(spark, sf)).select("product_id", "rating")


@query(
    "price_outliers",
    P + """, b AS (SELECT category, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3, avg(price) AS m, stddev_pop(price) AS s FROM products GROUP BY category)
    SELECT product_id, category, round(q1, 6) AS q1, round(q3, 6) AS q3,
      price < q1 - 0.5 * (q3 - q1) OR price > q3 + 0.5 * (q3 - q1) AS iqr_outlier, abs(price - m) > CAST(1.5 AS DOUBLE) * s AS z_outlier
    FROM products JOIN b USING (category)""",
)
def price_outliers(spark, sf):
    found = prep.price_outliers(held(products(spark, sf), "product_id", "category", "price"), fence=0.5, z=1.5)
    return found.select("product_id", "category", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"), "iqr_outlier", "z_outlier")


@query(
    "minmax_robust",
    P + """, s AS (SELECT min(price) AS lo, max(price) AS hi, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS q2, quantile_cont(price, 0.75) AS q3 FROM products)
    SELECT product_id, round((price - lo) / (hi - lo), 6) AS price_minmax, round((price - q2) / (q3 - q1), 6) AS price_robust FROM products, s""",
)
def minmax_robust(spark, sf):
    scaled = prep.robust_scale(prep.minmax_scale(held(products(spark, sf), "product_id", "price"), ["price"]), "price")
    return scaled.select("product_id", F.round("price_minmax", 6).alias("price_minmax"), F.round("price_robust", 6).alias("price_robust"))


@query(
    "clean_titles",
    """SELECT p_partkey, list_aggregate(list_transform(string_split(lower(trim(p_name)), ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS title,
      count(*) OVER (PARTITION BY lower(trim(p_name))) AS copies FROM part""",
)
def clean_titles(spark, sf):
    named = table(spark, sf, "part").select("p_partkey", clean_title("p_name").alias("title"))
    return named.join(named.groupBy("title").agg(F.count(F.lit(1)).alias("copies")), "title").select("p_partkey", "title", "copies")


# --- scores and top-K ------------------------------------------------------------

def _score_sql(source: str = "products", max_price: str = "max(price) FILTER (WHERE price > 0)") -> str:
    return f""", m AS (SELECT {max_price} AS mp, max(coalesce(rating, 0)) AS mr, CAST(max(coalesce(reviews_count, 0)) AS DOUBLE) AS mv FROM {source}),
    parts AS (SELECT t.*, coalesce(rating, 0) / mr AS rs, coalesce(reviews_count, 0) / mv AS vs,
      CAST(1 AS DOUBLE) - coalesce(price, 0) / mp AS ps, CASE WHEN availability THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS av FROM {source} t, m)"""


BASE_SCORE = "CAST(0.3 AS DOUBLE) * rs + CAST(0.25 AS DOUBLE) * vs + CAST(0.2 AS DOUBLE) * ps"
FULL_SCORE = BASE_SCORE + " + CAST(0.15 AS DOUBLE) * av"
SCORED = ("product_id", "name", "category", "price", "rating", "reviews_count", "availability")
SHOWN = ("product_id", "name", "category", "price", "_score")
SHOWN_SQL = "product_id, name, category, price"


@query("top_k", P + _score_sql() + f"SELECT {SHOWN_SQL}, round({FULL_SCORE}, 4) AS _score FROM parts ORDER BY _score DESC, product_id LIMIT 10")
def top_k(spark, sf):
    return scoring.top_k(held(products(spark, sf), *SCORED)).select(*SHOWN)


@query(
    "top_k_clipped",
    P + _score_sql() + f", s AS (SELECT *, {BASE_SCORE} AS u FROM parts) SELECT {SHOWN_SQL}, round(u, 6) AS _score FROM s ORDER BY u DESC, product_id LIMIT 10",
)
def top_k_clipped(spark, sf):
    top = scoring.top_k(held(products(spark, sf), *SCORED), preset=scoring.CLIPPED)
    return top.withColumn("_score", F.round("_score", 6)).select(*SHOWN)


FILTERED = ", f AS (SELECT * FROM products WHERE price >= 0 AND price <= 100 AND category = 'PROMO')"


@query("filter_price_category", P + FILTERED + "SELECT product_id, name, price FROM f")
def filter_price_category(spark, sf):
    return scoring.filter_products(products(spark, sf), 100, "PROMO").select("product_id", "name", "price")


@query("top_k_filtered", P + FILTERED + _score_sql("f") + f"SELECT {SHOWN_SQL}, round({FULL_SCORE}, 4) AS _score FROM parts ORDER BY _score DESC, product_id LIMIT 10")
def top_k_filtered(spark, sf):
    kept = held(scoring.filter_products(products(spark, sf), 100, "PROMO"), *SCORED)
    return scoring.top_k(kept, preset=scoring.INTERACTIVE).select(*SHOWN)


@query("top_k_view", P + _score_sql() + f"SELECT product_id, round({FULL_SCORE}, 6) AS score FROM parts")
def top_k_view(spark, sf):
    return scoring.score(held(products(spark, sf), *SCORED), scoring.VIEW).select("product_id", F.round("_score", 6).alias("score"))


@query("top_5", P + _score_sql() + f"SELECT {SHOWN_SQL}, round({FULL_SCORE}, 4) AS _score FROM parts ORDER BY _score DESC, product_id LIMIT 5")
def top_5(spark, sf):
    return scoring.top_k(held(products(spark, sf), *SCORED), 5, scoring.INTERACTIVE).select(*SHOWN)


@query(
    "top_k_recency",
    P + _score_sql() + f""", d AS (SELECT max(CAST(updated_at AS DATE)) AS hi, min(CAST(updated_at AS DATE)) AS lo FROM products)
    SELECT {SHOWN_SQL}, round({FULL_SCORE} + CAST(0.1 AS DOUBLE) * coalesce(CAST(1 AS DOUBLE) - (hi - CAST(updated_at AS DATE)) / CAST(nullif(hi - lo, 0) AS DOUBLE), 0), 4) AS _score
    FROM parts, d ORDER BY _score DESC, product_id LIMIT 10""",
)
def top_k_recency(spark, sf):
    return scoring.top_k(held(products(spark, sf), *SCORED, "updated_at"), preset=scoring.RECENCY).select(*SHOWN)


POPULAR = ", pop AS (SELECT *, coalesce(rating, 0) * coalesce(reviews_count, 0) AS popularity FROM products)"
LEADERS = POPULAR + ", leaders AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY popularity DESC, product_id) AS rank FROM pop) WHERE rank <= 5)"


@query("top_per_category", P + LEADERS + "SELECT category, CAST(rank AS INTEGER) AS rank, product_id, popularity FROM leaders")
def top_per_category(spark, sf):
    return scoring.top_per_category(products(spark, sf)).select("category", "rank", "product_id", "popularity")


@query(
    "category_rank",
    P + POPULAR + "SELECT product_id, category, row_number() OVER (PARTITION BY category ORDER BY popularity DESC, product_id) AS category_rank FROM pop",
)
def category_rank(spark, sf):
    scored = products(spark, sf).select("product_id", "category", scoring.popularity().alias("popularity"))
    return scoring.category_rank(scored).select("product_id", "category", "category_rank")


EMERGENCE = """round((coalesce(rating, 0) / CAST(5 AS DOUBLE)) * CAST(0.35 AS DOUBLE)
  + least(coalesce(reviews_count, 0) / CAST(500 AS DOUBLE), 1) * CAST(0.35 AS DOUBLE)
  + (CAST(1 AS DOUBLE) - least(coalesce(price, 0) / CAST(200 AS DOUBLE), 1)) * CAST(0.2 AS DOUBLE)
  + CASE WHEN availability THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END * CAST(0.1 AS DOUBLE), 4)"""


@query(
    "emerging_products",
    P + f""", e AS (SELECT product_id, name, category, price, rating, reviews_count, {EMERGENCE} AS emergence_score FROM products),
    t AS (SELECT * FROM e ORDER BY emergence_score DESC, product_id LIMIT 10)
    SELECT CAST(row_number() OVER (ORDER BY emergence_score DESC, product_id) AS INTEGER) AS rank, * FROM t""",
)
def emerging_products(spark, sf):
    return competitive.emerging_products(products(spark, sf)).select(
        "rank", "product_id", "name", "category", "price", "rating", "reviews_count", "emergence_score"
    )


@query(
    "rating_extremes",
    P + """SELECT 'highest' AS side, product_id, rating FROM (SELECT * FROM products WHERE rating IS NOT NULL ORDER BY rating DESC, product_id LIMIT 5)
    UNION ALL SELECT 'lowest', product_id, rating FROM (SELECT * FROM products WHERE rating IS NOT NULL ORDER BY rating, product_id LIMIT 10)""",
)
def rating_extremes(spark, sf):
    return scoring.rating_extremes(held(products(spark, sf), "product_id", "rating")).select("side", "product_id", "rating")


# --- comparisons -------------------------------------------------------------------

@query(
    "segments",
    P + """, g AS (SELECT category, count(*) AS product_count, avg(coalesce(price, 0)) AS p, avg(coalesce(rating, 0)) AS r,
      count(*) FILTER (WHERE NOT coalesce(availability, true)) AS out_of_stock FROM products GROUP BY category)
    SELECT category, product_count, round(p, 2) AS avg_price, round(r, 2) AS avg_rating, out_of_stock,
      round(r / (p / 10 + 1), 4) AS value_score FROM g ORDER BY value_score DESC, category LIMIT 8""",
)
def segments(spark, sf):
    return competitive.segments(products(spark, sf))


@query(
    "compare_products",
    P + LEADERS + """SELECT category, count(*) AS products_compared, string_agg(name, ', ' ORDER BY rank) AS product_names,
      round(min(coalesce(price, 0)), 2) AS min_price, round(max(coalesce(price, 0)), 2) AS max_price, round(avg(coalesce(price, 0)), 2) AS avg_price,
      round(avg(coalesce(rating, 0)), 2) AS avg_rating, (SELECT count(*) FROM products p WHERE p.category = leaders.category) AS category_size
    FROM leaders GROUP BY category HAVING category_size >= 2""",
)
def compare_products(spark, sf):
    return competitive.compare_products(held(products(spark, sf), "product_id", "name", "category", "price", "rating", "reviews_count"))


@query(
    "market_context",
    P + """SELECT count(*) AS products, round(avg(coalesce(price, 0)), 4) AS avg_price, round(avg(coalesce(rating, 0)), 4) AS avg_rating,
      min(coalesce(price, 0)) AS min_price, max(coalesce(price, 0)) AS max_price FROM products""",
)
def market_context(spark, sf):
    return competitive.market_context(products(spark, sf)).withColumns(
        {"avg_price": F.round("avg_price", 4), "avg_rating": F.round("avg_rating", 4)}
    )


@query(
    "category_brief",
    P + LEADERS + """, lines AS (SELECT category, rank, concat(CAST(rank AS VARCHAR), '. ', name, ' | Vendeur: ', coalesce(vendor, 'Unknown'), ' | Prix: ',
      printf('%.2f', round(coalesce(price, 0), 2)), '$ | Note: ', printf('%.2f', round(coalesce(rating, 0), 2)), '/5 | Avis: ',
      CAST(coalesce(reviews_count, 0) AS VARCHAR), ' | Disponible: ', CASE WHEN availability THEN 'Oui' ELSE 'Non' END) AS line FROM leaders)
    SELECT category, string_agg(line, chr(10) ORDER BY rank) AS brief FROM lines GROUP BY category""",
)
def category_brief(spark, sf):
    return competitive.category_brief(products(spark, sf))


@query(
    "context_lines",
    P + """, t AS (SELECT * FROM products ORDER BY price DESC, product_id LIMIT 50)
    SELECT CAST(row_number() OVER (ORDER BY price DESC, product_id) AS INTEGER) AS position, concat('- ', name, ' | ', CAST(CAST(round(price, 0) AS BIGINT) AS VARCHAR), '$') AS line FROM t""",
)
def context_lines(spark, sf):
    return competitive.context_lines(products(spark, sf))


@query(
    "vendor_ranking",
    P + _score_sql() + f""", s AS (SELECT *, round({FULL_SCORE}, 4) AS sc FROM parts WHERE vendor IS NOT NULL)
    SELECT vendor, country, count(*) AS products, sum(round(sc * 10000)) / count(sc) / 10000 AS avg_score, round(avg(rating), 9) AS avg_rating,
      arg_max(name, (sc, product_id)) AS flagship, max(sc) AS flagship_score FROM s GROUP BY vendor, country""",
)
def vendor_ranking(spark, sf):
    ranked = competitive.vendor_ranking(scoring.score(held(products(spark, sf), *SCORED, "vendor", "country")))
    return ranked.withColumn("avg_rating", F.round("avg_rating", 9))


# --- aggregates ----------------------------------------------------------------------

@query(
    "overview_kpis",
    P + """SELECT count(*) AS products, round(avg(price), 4) AS avg_price, round(avg(rating), 4) AS avg_rating, CAST(sum(reviews_count) AS BIGINT) AS total_reviews,
      count(DISTINCT category) AS categories, round(avg(CASE WHEN availability THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct_available FROM products""",
)
def overview_kpis(spark, sf):
    return aggregate.overview_kpis(products(spark, sf)).withColumns(
        {c: F.round(c, 4) for c in ("avg_price", "avg_rating", "pct_available")}
    )


@query(
    "catalog_profile",
    P + """SELECT category, count(*) AS n, min(price) FILTER (WHERE price > 0) AS min_price, max(price) FILTER (WHERE price > 0) AS max_price,
      round(avg(price) FILTER (WHERE price > 0), 4) AS avg_price, min(rating) FILTER (WHERE rating > 0) AS min_rating, max(rating) FILTER (WHERE rating > 0) AS max_rating
    FROM products GROUP BY category""",
)
def catalog_profile(spark, sf):
    return aggregate.catalog_profile(products(spark, sf)).withColumn("avg_price", F.round("avg_price", 4))


@query("category_distribution", P + "SELECT category, count(*) AS n FROM products GROUP BY category ORDER BY n DESC, category")
def category_distribution(spark, sf):
    return aggregate.category_distribution(products(spark, sf))


@query(
    "category_stats",
    P + """SELECT category, count(price) AS n, round(avg(price), 4) AS avg_price, round(avg(rating), 4) AS avg_rating, CAST(sum(reviews_count) AS BIGINT) AS total_reviews
    FROM products WHERE category IS NOT NULL GROUP BY category""",
)
def category_stats(spark, sf):
    return aggregate.category_stats(products(spark, sf)).withColumns({c: F.round(c, 4) for c in ("avg_price", "avg_rating")})


@query(
    "category_movers",
    P + """, s AS (SELECT sub_category AS category, count(price) AS n, avg(rating) AS r FROM products WHERE sub_category IS NOT NULL GROUP BY 1),
    m AS (SELECT avg(n) AS m FROM s)
    SELECT 'rising' AS direction, category, n FROM (SELECT s.* FROM s, m WHERE n > m * CAST(1.05 AS DOUBLE) OR r > 4.2 ORDER BY category LIMIT 6)
    UNION ALL SELECT 'declining', category, n FROM (SELECT s.* FROM s, m WHERE n < m * CAST(0.95 AS DOUBLE) AND r < 3.5 ORDER BY category LIMIT 6)""",
)
def category_movers(spark, sf):
    branded = products(spark, sf).withColumn("category", F.col("sub_category"))
    branded = held(branded, "category", "price", "rating", "reviews_count")
    return aggregate.category_movers(branded, rising_share=1.05, declining_share=0.95)


@query(
    "rating_stats",
    P + "SELECT count(rating) AS n, round(avg(rating), 2) AS avg_rating, round(min(rating), 2) AS min_rating, round(max(rating), 2) AS max_rating FROM products",
)
def rating_stats(spark, sf):
    return aggregate.rating_stats(products(spark, sf))


@query(
    "rating_bands",
    P + "SELECT CASE WHEN rating < 3 THEN 'bas (<3)' WHEN rating < 4 THEN 'moyen (3-4)' ELSE 'haut (4-5)' END AS band, count(*) AS n FROM products GROUP BY 1",
)
def rating_bands(spark, sf):
    return aggregate.rating_bands(products(spark, sf))


@query("category_list", P + "SELECT DISTINCT category FROM products WHERE category IS NOT NULL ORDER BY category")
def category_list(spark, sf):
    return aggregate.category_list(products(spark, sf))


@query(
    "price_quantiles",
    P + "SELECT round(quantile_cont(price, 0.25), 6) AS p25, round(quantile_cont(price, 0.5), 6) AS median, round(quantile_cont(price, 0.75), 6) AS p75 FROM products",
)
def price_quantiles(spark, sf):
    return aggregate.price_quantiles(products(spark, sf)).select(*[F.round(c, 6).alias(c) for c in ("p25", "median", "p75")])


@query("low_stock", P + "SELECT product_id, name, quantity FROM products WHERE quantity < 100")
def low_stock(spark, sf):
    return products(spark, sf).where(F.col("quantity") < 100).select("product_id", "name", "quantity")


@query(
    "promotions",
    """SELECT p_type AS category, count(*) AS lines, count(*) FILTER (WHERE l_discount > 0) AS discounted, round(avg(l_discount) * 100, 4) AS avg_discount_pct,
      max(l_discount) * 100 AS max_discount_pct FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""",
)
def promotions(spark, sf):
    line = table(spark, sf, "lineitem").select("l_partkey", "l_discount")
    part = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("category"))
    by_part = line.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_discount") > 0).alias("d"), F.sum("l_discount").alias("s"), F.max("l_discount").alias("m")
    )
    return (
        by_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("category")
        .agg(
            F.sum("n").alias("lines"),
            F.sum("d").alias("discounted"),
            F.round(F.sum("s") / F.sum("n") * 100, 4).alias("avg_discount_pct"),
            (F.max("m") * 100).alias("max_discount_pct"),
        )
    )


@query(
    "customer_profile",
    """WITH s AS (SELECT o_custkey, p_type, sum(round(l_extendedprice * 100)) AS spend, count(*) AS n, sum(l_quantity) AS q
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
    SELECT o_custkey, arg_max(p_type, (spend, p_type)) AS top_category, CAST(sum(n) AS BIGINT) AS lines, sum(spend) / 100 / sum(q) AS avg_unit_price FROM s GROUP BY o_custkey""",
)
def customer_profile(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    spend = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("o_custkey", "p_type")
        .agg(
            F.sum(F.round(F.col("l_extendedprice") * 100)).alias("spend"),
            F.count(F.lit(1)).alias("n"),
            F.sum("l_quantity").alias("q"),
        )
    )
    return spend.groupBy("o_custkey").agg(
        F.max_by("p_type", F.struct("spend", "p_type")).alias("top_category"),
        F.sum("n").alias("lines"),
        (F.sum("spend") / 100 / F.sum("q")).alias("avg_unit_price"),
    )


@query(
    "scalar_suite",
    """SELECT p_partkey, round(p_retailprice / 7, 2) AS rounded, least(p_size, 25) AS low, greatest(p_size, 25) AS high, p_retailprice / nullif(p_size % 5, 0) AS guarded,
      split_part(p_name, ' ', 1) AS first_word, upper(replace(p_name, ' ', '_')) AS joined, contains(p_name, 'ring') AS has_ring, regexp_extract(p_brand, '[0-9]+') AS brand_no,
      p_brand || ':' || lpad(CAST(p_size AS VARCHAR), 3, '0') AS formatted, len(string_split(p_name, ' ')) AS words,
      strftime(DATE '2024-01-01' - CAST(p_size AS INTEGER), '%Y-%m-%d') AS day, '{"size":' || CAST(p_size AS VARCHAR) || '}' AS as_json,
      coalesce(nullif(p_size, 1), 0) AS no_ones, try_cast(p_brand AS DOUBLE) AS not_a_number, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class,
      md5(p_name) AS name_hash FROM part""",
)
def scalar_suite(spark, sf):
    size, words = F.col("p_size"), F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.round(F.col("p_retailprice") / 7, 2).alias("rounded"),
        F.least(size, F.lit(25)).alias("low"),
        F.greatest(size, F.lit(25)).alias("high"),
        (F.col("p_retailprice") / F.nullif(size % 5, F.lit(0))).alias("guarded"),
        F.get(words, F.lit(0)).alias("first_word"),
        F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("joined"),
        F.contains("p_name", F.lit("ring")).alias("has_ring"),
        F.regexp_extract("p_brand", "[0-9]+", 0).alias("brand_no"),
        F.format_string("%s:%03d", "p_brand", "p_size").alias("formatted"),
        F.size(words).cast("bigint").alias("words"),
        F.date_format(F.date_sub(F.lit("2024-01-01").cast("date"), size), "yyyy-MM-dd").alias("day"),
        F.to_json(F.struct(size.alias("size"))).alias("as_json"),
        F.coalesce(F.nullif(size, F.lit(1)), F.lit(0)).alias("no_ones"),
        F.col("p_brand").try_cast("double").alias("not_a_number"),
        F.when(size < 10, "small").when(size < 30, "medium").otherwise("large").alias("size_class"),
        F.md5("p_name").alias("name_hash"),
    )
