"""Landing, storing and run records, bound to payloads and records made from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from shelfwise.operators import cluster, competitive, model, prep, tables, ward
from shelfwise.plans.catalog import PRODUCTS_SQL, held, products, table
from shelfwise.plans.models import DENSITY, LABELLED, POINTS_SQL, labelled
from shelfwise.plans.registry import query
from shelfwise.session import scratch_path, shuffled
from shelfwise.sources import raw, store

MISSING = {"platform": "string", "params": "map<string,string>", "priority": "int", "max_retries": "int"}
PRICE_TEXT = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING)"


def records(spark, sf):
    """Landed payloads in the three shapes: one record, a ``products`` list, a plain list."""
    one = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("product_type"),
        F.concat(F.lit("$ "), F.expr(PRICE_TEXT)).alias("price"),
        F.when(F.col("p_size") % 2 == 0, F.lit(False)).alias("available"),
        F.col("p_brand").alias("vendor"),
    )
    shape = F.col("p_partkey") % 3
    payload = (
        F.when(shape == 0, F.to_json(one))
        .when(shape == 1, F.to_json(F.struct(F.array(one).alias("products"))))
        .otherwise(F.to_json(F.array(one, one)))
    )
    return table(spark, sf, "part").select(payload.alias("payload"))


@query(
    "normalize_records",
    """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category, round(p_retailprice, 2) AS price, 'USD' AS currency,
      p_size % 2 <> 0 AS availability, p_brand AS vendor FROM part, range(0, 2) r(i) WHERE p_partkey % 3 = 2 OR i = 0""",
)
def normalize_records(spark, sf):
    found = raw.normalize_products(raw.parse_records(raw.payload_rows(records(spark, sf)), "payload"))
    return found.select("product_id", "name", "category", F.round("price", 2).alias("price"), "currency", "availability", "vendor")


@query(
    "woo_records",
    """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, round(CASE WHEN p_size % 3 = 0 THEN p_retailprice / 2 ELSE p_retailprice END, 1) AS price,
      CASE WHEN p_size % 2 = 0 THEN p_size % 4 = 0 ELSE p_size > 25 END AS availability, p_size AS quantity, p_brand AS vendor, p_name AS tag FROM part""",
)
def woo_records(spark, sf):
    named = lambda c: F.array(F.struct(F.col(c).alias("name")))
    half = F.expr("CAST(CAST(p_retailprice / 2 AS DECIMAL(12,3)) AS STRING)")
    record = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.when(F.col("p_size") % 3 == 0, half).otherwise(F.lit("")).alias("sale_price"),
        F.expr(PRICE_TEXT).alias("regular_price"),
        F.when(F.col("p_size") % 4 == 0, "instock").when(F.col("p_size") % 2 == 0, "outofstock").otherwise("").alias("stock_status"),
        (F.when(F.col("p_size") > 25, F.col("p_size")).otherwise(F.lit(0))).alias("stock_quantity"),
        named("p_type").alias("categories"),
        F.struct(F.col("p_brand").alias("name")).alias("seller_info"),
        named("p_name").alias("tags"),
    )
    found = raw.parse_woocommerce(table(spark, sf, "part").select("p_size", F.to_json(record).alias("payload")))
    return found.select(
        "product_id", "category", F.round("price", 1).alias("price"), "availability", F.col("p_size").alias("quantity"), "vendor", F.get("tags", F.lit(0)).alias("tag")
    )


@query(
    "shopify_records",
    """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category, round(p_retailprice, 2) AS price,
      p_size % 2 = 0 AS availability, p_size AS quantity, p_brand AS vendor FROM part""",
)
def shopify_records(spark, sf):
    variant = F.struct(
        F.expr(PRICE_TEXT).alias("price"), (F.col("p_size") % 2 == 0).alias("availableForSale"), F.col("p_size").alias("inventoryQuantity")
    )
    record = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("productType"),
        F.col("p_brand").alias("vendor"),
        F.struct(F.array(F.struct(variant.alias("node"))).alias("edges")).alias("variants"),
    )
    found = raw.parse_shopify(table(spark, sf, "part").select(F.to_json(record).alias("payload")))
    return found.select("product_id", "name", "category", F.round("price", 2).alias("price"), "availability", "quantity", "vendor")


@query(
    "lineage_rows",
    """SELECT page_id, 'agent-' || (page_id % 3) AS _source_agent, 'generic' AS _source_platform, url AS _source_url, TIMESTAMP '2024-01-01' AS _collected_at,
      'a1' AS _scraped_by, 'generic' AS _platform, 'html' AS _scraper FROM pages""",
)
def lineage_rows(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    agent = F.concat(F.lit("agent-"), (F.col("page_id") % 3).cast("string"))
    found = raw.add_lineage(pages, agent, F.lit("generic"), F.col("url"), F.lit("2024-01-01").cast("timestamp_ntz"))
    return raw.tag_scraper(found, "a1", "generic", "html").drop("url")


@query(
    "target_outputs",
    """SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_size < 10 THEN 'small' ELSE 'large' END AS target, 'ok' AS status FROM part
    UNION ALL SELECT NULL, 'lost', 'error'""",
)
def target_outputs(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product_id"), "p_size")
    small, large = part.where("p_size < 10").drop("p_size"), part.where("p_size >= 10").drop("p_size")
    return raw.collect_outputs({"small": small, "large": large, "lost": None}).select("product_id", "target", "status")


@query(
    "collection_tasks",
    """SELECT 'task_' || substr(md5('generic|' || url), 1, 12) AS task_id, 'generic' AS platform, url, 0 AS priority, 3 AS max_retries, 'pending' AS status FROM pages""",
)
def collection_tasks(spark, sf):
    """A task for each page's address; what a target leaves out has its default."""
    given = table(spark, sf, "pages").select("url", *[F.lit(None).cast(k).alias(c) for c, k in MISSING.items()])
    targets = raw.target_defaults(given)
    return raw.tasks_from_targets(targets).select("task_id", "platform", "url", "priority", "max_retries", "status")


@query(
    "replaced_source",
    """SELECT CAST(p_partkey AS VARCHAR) AS product_id, 'shop' AS source FROM part WHERE p_size >= 25
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'mail' FROM part WHERE p_size < 10""",
)
def replaced_source(spark, sf):
    path, part = scratch_path(spark, "sources"), table(spark, sf, "part")
    rows = part.select(F.col("p_partkey").cast("string").alias("product_id"), "p_size")
    for condition, source in (("p_size < 25", "shop"), ("p_size < 10", "mail"), ("p_size >= 25", "shop")):
        store.replace_source(rows.where(condition).select("product_id"), path, source)
    return spark.read.parquet(path).select("product_id", "source")


@query(
    "appended_results",
    """SELECT s AS source, CAST(p_partkey AS VARCHAR) AS product_id, round(p_retailprice, 2) AS score, CAST(p_partkey AS VARCHAR) AS payload_id
    FROM part, (VALUES ('first'), ('second')) v(s)""",
)
def appended_results(spark, sf):
    root = scratch_path(spark, "results")
    scored = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product_id"), F.round("p_retailprice", 2).alias("_score"))
    for source in ("first", "second"):
        store.append_results(store.top_k_rows(scored, source), root, "top_k_results")
    kept = spark.read.parquet(f"{root}/top_k_results")
    return kept.select("source", "product_id", "score", F.get_json_object("payload", "$.product_id").alias("payload_id"))


@query(
    "run_record",
    """SELECT 'r1' AS run_id, CASE WHEN count(*) > 0 THEN 'completed' ELSE 'empty' END AS status, count(*) AS products_scraped,
      CAST((count(p_retailprice) > 0)::INT + (count(p_size) > 0)::INT + (count(nullif(p_size, p_size)) > 0)::INT AS INTEGER) AS features_count,
      CAST(count(DISTINCT p_type) AS INTEGER) AS models_trained, CAST(least(10, count(*)) AS INTEGER) AS top_k_count FROM part WHERE p_size > 25
    UNION ALL SELECT 'r2', 'empty', 0, 0, 0, 0""",
)
def run_record(spark, sf):
    """Run rows from what the runs left: result rows in the store, columns with values, one registered model a type."""
    root = scratch_path(spark, "runs")
    for run, part in (("r1", table(spark, sf, "part").where("p_size > 25")), ("r2", table(spark, sf, "part").where("p_size < 0"))):
        rows = part.select(F.col("p_partkey").cast("string").alias("product_id"), "p_retailprice", "p_size", F.lit(None).cast("int").alias("none"), "p_type")
        rows = held(rows.withColumn("_score", F.col("p_retailprice")))
        store.append_results(store.top_k_rows(rows.orderBy(F.desc("_score"), "product_id").limit(10), run), root, "top_k_results")
        values = rows.agg(*[F.count(c).alias(c) for c in ("p_retailprice", "p_size", "none")]).first()
        kept = spark.read.parquet(f"{root}/top_k_results").where(F.col("source") == run).count()
        models = rows.select("p_type").distinct().count()
        store.append_results(store.run_row(spark, run, rows.count(), sum(v > 0 for v in values), models, kept), root, "run_log")
    return spark.read.parquet(f"{root}/run_log").drop("created_at")


@query(
    "json_round_trip",
    "SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_retailprice AS price, CASE WHEN p_size % 2 = 0 THEN p_size END AS quantity, p_size > 10 AS availability FROM part",
)
def json_round_trip(spark, sf):
    """Products written as a JSON artifact and read back by the fixed schema; absent values stay absent."""
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("quantity"), (F.col("p_size") > 10).alias("availability"),
    )
    path = scratch_path(spark, "artifact")
    store.write_records(rows, path)
    return store.read_products_json(spark, path, lines=True).select(*rows.columns)


@query(
    "task_results",
    """SELECT CAST(o_orderkey AS VARCHAR) AS task_id, CASE o_orderkey % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'failed' ELSE 'pending' END AS status,
      CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 50 AS DOUBLE) END AS duration,
      CASE WHEN o_orderkey % 3 < 2 THEN 'agent-' || (o_orderkey % 7) END AS agent, CASE WHEN o_orderkey % 3 = 1 THEN 'timeout' END AS error FROM orders""",
)
def task_results(spark, sf):
    agent = F.concat(F.lit("agent-"), (F.col("o_orderkey") % 7).cast("string")).alias("assigned_to")
    log = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("task_id"), "o_orderkey", agent)
    tasks = log.select("task_id", F.lit("u").alias("url"), F.lit("p").alias("platform"), F.lit("pending").alias("status"))
    times = {"started_at": F.lit(100.0), "completed_at": F.lit(100.0) + F.col("o_orderkey") % 50}
    completed = log.where("o_orderkey % 3 = 0").withColumns(times)
    failed = log.where("o_orderkey % 3 = 1").withColumn("error", F.lit("timeout"))
    return tables.assemble_results(tasks, completed, failed).select("task_id", "status", "duration", "agent", "error")


@query(
    "analysis_status",
    """WITH s AS (SELECT 'all' AS part, count(*) AS products FROM part UNION ALL SELECT 'one', count(*) FILTER (WHERE p_partkey = 1) FROM part
      UNION ALL SELECT 'none', count(*) FILTER (WHERE p_partkey < 0) FROM part)
    SELECT part, analysis, products, CASE WHEN products = 0 THEN 'no_data' WHEN products < needs THEN 'insufficient_data' ELSE 'completed' END AS status
    FROM s, (VALUES ('comparison', 2), ('emerging', 1), ('recommendations', 1)) v(analysis, needs)""",
)
def analysis_status(spark, sf):
    """Status of every analysis over all products, over a single one, and over none."""
    catalog = products(spark, sf)
    parts = {"all": catalog, "one": catalog.where("product_id = '1'"), "none": catalog.where("product_id = 'none'")}
    rows = [competitive.competitive_analysis(df, "full")["status"].select(F.lit(n).alias("part"), "analysis", "products", "status") for n, df in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


SPLIT = LABELLED + """, r AS (SELECT *, row_number() OVER (PARTITION BY is_top ORDER BY md5(product_id || ':split:42'), product_id) - 1 AS position, count(*) OVER (PARTITION BY is_top) AS total FROM lab),
  parts AS (SELECT *, position < floor(total * CAST(0.2 AS DOUBLE) + 0.5) AS is_test FROM r), train AS (SELECT * FROM parts WHERE NOT is_test)"""


def fitted_and_test(spark, sf):
    rows = held(model.stratified_split(labelled(spark, sf), "product_id", "is_top"), "product_id", *DENSITY, "is_top", "is_test")
    train = rows.where("NOT is_test").withColumn("label", F.col("is_top").cast("double"))
    shelf = model.ModelShelf()
    shelf.add("logistic", model.scaled_pipeline(train, DENSITY, LogisticRegression()))
    return shelf, rows.where("is_test")


@query(
    "scaled_by_train",
    SPLIT + " SELECT product_id, " + ", ".join(f"round((CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM train)) / (SELECT stddev_pop({c}) FROM train), 6) AS {c}_z" for c in DENSITY) + " FROM parts WHERE is_test",
)
def scaled_by_train(spark, sf):
    """Test rows by the statistics of the training rows, through a model called by its name."""
    shelf, test = fitted_and_test(spark, sf)
    return shelf.predict(test, "logistic").select("product_id", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in DENSITY])


@query(
    "predicted_by_name",
    SPLIT
    + """ , fit AS (SELECT regr_slope(CAST(is_top AS DOUBLE), CAST(rating AS DOUBLE)) AS a, regr_intercept(CAST(is_top AS DOUBLE), CAST(rating AS DOUBLE)) AS b,
      regr_slope(CAST(is_top AS DOUBLE), CAST(reviews_count AS DOUBLE)) AS c, regr_intercept(CAST(is_top AS DOUBLE), CAST(reviews_count AS DOUBLE)) AS d FROM train)
    SELECT product_id, round(a * rating + b, 5) AS by_rating, round(c * reviews_count + d, 5) AS by_reviews FROM parts, fit WHERE is_test""",
)
def predicted_by_name(spark, sf):
    """Two straight-line models, stored, loaded as the latest of their name, and called by it."""
    rows = held(model.stratified_split(labelled(spark, sf), "product_id", "is_top"), "product_id", *DENSITY, "is_top", "is_test")
    train = rows.where("NOT is_test").withColumn("label", F.col("is_top").cast("double"))
    test, root, shelf = rows.where("is_test"), scratch_path(spark, "shelf"), model.ModelShelf()
    for name, feature in (("by_rating", "rating"), ("by_reviews", "reviews_count")):
        for version, some in (("old", train.where("price > 100")), ("new", train)):
            store.save_model(model.scaled_pipeline(some, [feature], LinearRegression(solver="normal")), root, name, version)
        shelf.add(name, store.load_model(spark, root, name))
    found = [shelf.predict(test, n).select("product_id", F.round("prediction", 5).alias(n)) for n in ("by_rating", "by_reviews")]
    return found[0].join(found[1], "product_id")


def beside(*tables):
    """Tables of one row as one row, joined on a written column."""
    keyed = [held(t.withColumn("_one", F.lit(0))) for t in tables]
    return reduce(lambda a, b: a.join(b, "_one"), keyed).drop("_one")


@query(
    "kmeans_checks",
    PRODUCTS_SQL + "SELECT count(*) AS n, 5 AS clusters, count(*) AS at_nearest, 10 AS restarts, true AS centres_are_means, true AS least_cost, true AS cost_of_rows FROM products",
)
def kmeans_checks(spark, sf):
    """Rows at the nearest centre, centres that are the means of their rows, and the least cost of ten restarts."""
    vectors = held(cluster.scaled_vectors(held(products(spark, sf), "product_id", *DENSITY), "product_id"))
    fitted = cluster.fit_kmeans(vectors)
    rows = held(cluster.assign(fitted, vectors).withColumn("f", vector_to_array("features")))
    gaps = [sum((F.col("f")[i] - x) * (F.col("f")[i] - x) for i, x in enumerate(c)) for c in fitted.centres]
    own = F.element_at(F.array(*gaps), F.col("cluster") + 1)
    means = rows.groupBy("cluster").agg(*[F.avg(F.col("f")[i]).alias(f"m{i}") for i in range(len(DENSITY))])
    centres = spark.createDataFrame([(i, *c) for i, c in enumerate(fitted.centres)], "cluster int, c0 double, c1 double, c2 double")
    off = F.greatest(*[F.abs(F.col(f"m{i}") - F.col(f"c{i}")) for i in range(len(DENSITY))])
    means = means.join(centres, "cluster").agg((F.max(off) < 1e-6).alias("centres_are_means"))
    counts = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("cluster").cast("int").alias("clusters"),
        F.count_if(own <= F.least(*gaps) + 1e-9).alias("at_nearest"),
        (F.abs(F.sum(own) - F.lit(fitted.cost)) < 1e-6 * F.lit(fitted.cost)).alias("cost_of_rows"),
    )
    return beside(counts, means).select(
        "*", F.lit(len(fitted.costs)).alias("restarts"), F.lit(fitted.cost == min(fitted.costs)).alias("least_cost")
    )


MERGE = "x.w * y.w / (x.w + y.w) * ((x.p - y.p) * (x.p - y.p) + (x.r - y.r) * (x.r - y.r) + (x.v - y.v) * (x.v - y.v))"


@query(
    "hierarchical_merges",
    PRODUCTS_SQL.replace("WITH facts", "WITH RECURSIVE facts", 1)
    + f""", g AS (SELECT category || '/' || sub_category AS id, avg(price) / 100 AS p, avg(rating) AS r, avg(reviews_count) / 100 AS v
      FROM products WHERE rating IS NOT NULL GROUP BY 1),
    state AS (
      SELECT list({{'id': id, 'w': CAST(1 AS DOUBLE), 'p': p, 'r': r, 'v': v}}) AS c, CAST(NULL AS STRUCT(cost DOUBLE, a VARCHAR, b VARCHAR)) AS done FROM g
      UNION ALL
      SELECT list_append(list_filter(c, lambda x: x.id <> best.a AND x.id <> best.b), list_transform(
          [{{'x': list_filter(c, lambda x: x.id = best.a)[1], 'y': list_filter(c, lambda x: x.id = best.b)[1]}}], lambda m: {{
            'id': m.x.id, 'w': m.x.w + m.y.w, 'p': (m.x.w * m.x.p + m.y.w * m.y.p) / (m.x.w + m.y.w),
            'r': (m.x.w * m.x.r + m.y.w * m.y.r) / (m.x.w + m.y.w), 'v': (m.x.w * m.x.v + m.y.w * m.y.v) / (m.x.w + m.y.w)}})[1]), best
      FROM (SELECT c, list_min(flatten(list_transform(c, lambda x: list_transform(list_filter(c, lambda y: x.id < y.id),
              lambda y: {{'cost': {MERGE}, 'a': x.id, 'b': y.id}})))) AS best FROM state WHERE len(c) > 1))
    SELECT done.a AS a, done.b AS b, round(done.cost, 6) AS cost FROM state WHERE done IS NOT NULL""",
)
def hierarchical_merges(spark, sf):
    """Every Ward merge of the category and brand profiles with its cost."""
    catalog = held(products(spark, sf), "category", "sub_category", *DENSITY).where("rating IS NOT NULL")
    profile = catalog.groupBy(F.concat_ws("/", "category", "sub_category").alias("id")).agg(
        F.array(F.avg("price") / 100, F.avg("rating"), F.avg("reviews_count") / 100).alias("f")
    )
    found = ward.ward(profile.withColumn("features", array_to_vector("f")), "id")
    return found.merges.select("a", "b", F.round("cost", 6).alias("cost"))


@query(
    "hierarchical_checks",
    POINTS_SQL
    + """ SELECT count(*) AS n, count(DISTINCT product_id) AS products, 5 AS clusters, count(DISTINCT (price_z, rating_z, reviews_count_z)) - 1 AS merges,
      round(count(*) * (var_pop(price_z) + var_pop(rating_z) + var_pop(reviews_count_z)), 4) AS total_cost, true AS cut_at_dearest, true AS never_cheaper FROM z""",
)
def hierarchical_checks(spark, sf):
    """Ward over all products: the costs of all merges add up to the spread of the points, those below the cut to the
    spread inside the clusters, and no merge is cheaper than a merge inside one of its halves."""
    vectors = held(cluster.scaled_vectors(held(products(spark, sf), "product_id", *DENSITY), "product_id"))
    found = ward.ward(vectors, "product_id")
    merges, labels = held(found.merges), held(found.labels)
    f = vector_to_array("features")
    inside = vectors.join(shuffled(labels), "product_id").groupBy("cluster").agg(*[(F.var_pop(f[i]) * F.count(F.lit(1))).alias(f"v{i}") for i in range(3)])
    within = inside.agg(F.sum(F.col("v0") + F.col("v1") + F.col("v2")).alias("within"))
    dearest = merges.orderBy(F.desc("cost")).limit(4).agg(F.sum("cost").alias("above"))
    # a merge's halves: the last earlier merges into its two clusters, which are the dearest ones below it
    kept = merges.select(F.col("a").alias("half"), F.col("cost").alias("inner"))
    cheaper = merges.join(shuffled(kept), F.col("b") == F.col("half")).agg(F.count_if(F.col("inner") > F.col("cost") + 1e-9).alias("wrong"))
    sums = merges.agg(F.count(F.lit(1)).alias("merges"), F.sum("cost").alias("total"))
    rows = labels.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("product_id").alias("products"), F.count_distinct("cluster").cast("int").alias("clusters"))
    return beside(rows, sums, within, dearest, cheaper).select(
        "n", "products", "clusters", "merges", F.round("total", 4).alias("total_cost"),
        (F.abs(F.col("total") - F.col("above") - F.col("within")) < 1e-6 * F.col("total")).alias("cut_at_dearest"),
        (F.col("wrong") == 0).alias("never_cheaper"),
    )


def _report(kind: str) -> str:
    return (
        SPLIT
        + f" SELECT '{kind}' AS model_type, CAST(count(*) FILTER (WHERE NOT is_test) AS BIGINT) AS n_train, CAST(count(*) FILTER (WHERE is_test) AS BIGINT) AS n_test, true AS in_range, true AS better_than_chance FROM parts"
    )


def _checked(report):
    scores = ("accuracy", "precision", "recall", "f1", "roc_auc")
    inside = [F.col(c).between(0.0, 1.0) for c in scores]
    ok = inside[0]
    for c in inside[1:]:
        ok = ok & c
    return report.select(
        "model_type", F.col("n_train").cast("long").alias("n_train"), F.col("n_test").cast("long").alias("n_test"), ok.alias("in_range"), (F.col("roc_auc") > 0.5).alias("better_than_chance")
    )


@query("logistic_checks", _report("logistic"))
def logistic_checks(spark, sf):
    return _checked(model.train_classifier(labelled(spark, sf), "is_top", "logistic")[1])


@query("rf_checks", _report("random_forest"))
def rf_checks(spark, sf):
    return _checked(model.train_classifier(labelled(spark, sf), "is_top", "random_forest")[1])


@query("xgb_checks", _report("xgboost"))
def xgb_checks(spark, sf):
    """Boosted trees of depth 6."""
    return _checked(model.train_classifier(labelled(spark, sf), "is_top", "xgboost")[1])


@query(
    "xgb_regressor_checks",
    PRODUCTS_SQL + "SELECT 'xgboost' AS model_type, count(*) - CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS n_train, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS n_test, true AS learned FROM products",
)
def xgb_regressor_checks(spark, sf):
    """The quality score is a function of rating and reviews: a fit explains nearly all of it on unseen rows."""
    report = model.train_regressor(labelled(spark, sf), "quality_score", "xgboost", ("rating", "reviews_count", "price"))[1]
    learned = (F.abs(F.col("rmse") * F.col("rmse") - F.col("mse")) <= 1e-6 * F.col("mse")) & F.col("r2").between(0.95, 1.0)
    return report.select(
        "model_type", F.col("n_train").cast("long").alias("n_train"), F.col("n_test").cast("long").alias("n_test"), learned.alias("learned")
    )


@query(
    "xgb_three_classes",
    PRODUCTS_SQL + """, k AS (SELECT CASE WHEN price <= 50 THEN 0 WHEN price <= 100 THEN 1 ELSE 2 END AS y, count(*) AS n FROM products GROUP BY 1)
    SELECT 'xgboost' AS model_type, CAST(sum(n - floor(n * CAST(0.2 AS DOUBLE) + 0.5)) AS BIGINT) AS n_train, CAST(sum(floor(n * CAST(0.2 AS DOUBLE) + 0.5)) AS BIGINT) AS n_test, true AS learned FROM k""",
)
def xgb_three_classes(spark, sf):
    """Price bands, a function of a feature: three classes by softmax, nearly all right on unseen rows."""
    band = F.when(F.col("price") <= 50, 0).when(F.col("price") <= 100, 1).otherwise(2)
    rows = held(held(products(spark, sf), "product_id", *prep.FEATURES).withColumn("band", band))
    report = model.train_classifier(rows, "band", "xgboost")[1]
    learned = (F.col("accuracy") > 0.97) & (F.col("roc_auc") > 0.99)
    return report.select(
        "model_type", F.col("n_train").cast("long").alias("n_train"), F.col("n_test").cast("long").alias("n_test"), learned.alias("learned")
    )


@query("cross_validation", "SELECT true AS in_range, true AS better_than_majority")
def cross_validation(spark, sf):
    """Mean accuracy over five folds; a quarter of the rows has the label, so the majority alone gives 0.75."""
    score = model.cross_validate(labelled(spark, sf), "is_top", "logistic")
    return spark.range(1).select(F.lit(0.0 <= score <= 1.0).alias("in_range"), F.lit(score > 0.75).alias("better_than_majority"))
