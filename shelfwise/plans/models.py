"""Queries that fit or score models."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import cluster, isolation, metrics, model, neighbors, prep
from shelfwise.plans.catalog import PRODUCTS_SQL, held, products, table
from shelfwise.plans.products import QUALITY
from shelfwise.plans.registry import query

DENSITY = ("price", "rating", "reviews_count")


def scaled_points(spark, sf_dir):
    """Standardised price, rating and reviews, missing values as 0."""
    base = products(spark, sf_dir).select("product_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in DENSITY])
    return prep.zscore(held(base), DENSITY, "_z").select("product_id", *[f"{c}_z" for c in DENSITY])


Z = [f"{c}_z" for c in DENSITY]

POINTS_SQL = PRODUCTS_SQL + ", z0 AS (SELECT product_id, coalesce(price, 0) AS price, coalesce(rating, 0) AS rating, CAST(coalesce(reviews_count, 0) AS DOUBLE) AS reviews_count FROM products), z AS (SELECT product_id, " + ", ".join(
    f"({c} - (SELECT avg({c}) FROM z0)) / (SELECT stddev_pop({c}) FROM z0) AS {c}_z" for c in DENSITY
) + " FROM z0)"


@query(
    "eps_neighbors",
    POINTS_SQL + """SELECT a.product_id, count(*) AS n_neighbors, count(*) >= 5 AS is_core FROM z a JOIN z b
      ON abs(a.price_z - b.price_z) <= 0.5
      AND (a.price_z - b.price_z) * (a.price_z - b.price_z) + (a.rating_z - b.rating_z) * (a.rating_z - b.rating_z) + (a.reviews_count_z - b.reviews_count_z) * (a.reviews_count_z - b.reviews_count_z) <= 0.25
    GROUP BY a.product_id""",
)
def eps_neighbors(spark, sf):
    return neighbors.eps_neighbors(scaled_points(spark, sf), "product_id", Z)


WIDE = 6


@query(
    "eps_neighbors_wide",
    "SELECT a.vec_id, count(*) AS n_neighbors, count(*) >= 5 AS is_core FROM embeddings a JOIN embeddings b ON "
    + " + ".join(f"(a.embedding[{i}]::DOUBLE - b.embedding[{i}]) * (a.embedding[{i}]::DOUBLE - b.embedding[{i}])" for i in range(1, WIDE + 1))
    + " <= 0.015625 GROUP BY a.vec_id",
)
def eps_neighbors_wide(spark, sf):
    """Six features: more than the grid has dimensions."""
    names = [f"e{i}" for i in range(WIDE)]
    points = table(spark, sf, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return neighbors.eps_neighbors(points, "vec_id", names, eps=0.125)


@query(
    "dbscan_wide",
    "WITH RECURSIVE z AS (SELECT vec_id AS id, embedding AS e FROM embeddings), near AS (SELECT a.id AS a, b.id AS b FROM z a JOIN z b ON "
    + " + ".join(f"(a.e[{i}]::DOUBLE - b.e[{i}]) * (a.e[{i}]::DOUBLE - b.e[{i}])" for i in range(1, WIDE + 1))
    + """ <= 0.015625),
    core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 5),
    links AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core) AND a <> b),
    reach AS (SELECT id, id AS root FROM core UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id WHERE r.root < l.b),
    numbered AS (SELECT id, dense_rank() OVER (ORDER BY min(root)) - 1 AS cluster FROM reach GROUP BY id),
    border AS (SELECT n.a AS id, min(c.cluster) AS cluster FROM near n JOIN numbered c ON c.id = n.b WHERE n.a NOT IN (SELECT id FROM core) GROUP BY n.a)
    SELECT vec_id, CAST(coalesce(n.cluster, b.cluster, -1) AS INTEGER) AS cluster FROM embeddings LEFT JOIN numbered n ON n.id = vec_id LEFT JOIN border b ON b.id = vec_id""",
)
def dbscan_wide(spark, sf):
    """Density clusters over six features."""
    names = [f"e{i}" for i in range(WIDE)]
    points = table(spark, sf, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return neighbors.dbscan(points, "vec_id", names, eps=0.125)


@query(
    "multiclass_auc",
    """WITH s AS (SELECT label, c, embedding[c + 1] AS s FROM embeddings, range(0, 10) r(c)),
    k AS (SELECT c, label = c AS pos, rank() OVER (PARTITION BY c ORDER BY s) + (count(*) OVER (PARTITION BY c, s) - 1) / CAST(2 AS DOUBLE) AS r FROM s),
    n AS (SELECT c, sum(r) FILTER (WHERE pos) AS ranks, CAST(count(*) FILTER (WHERE pos) AS DOUBLE) AS p, count(*) FILTER (WHERE NOT pos) AS q FROM k GROUP BY c)
    SELECT round(avg((ranks - p * (p + 1) / 2) / nullif(p * q, 0)), 6) AS roc_auc FROM n""",
)
def multiclass_auc(spark, sf):
    """Vector components as the scores of the ten labels, one against the rest."""
    rows = table(spark, sf, "embeddings").select("label", F.slice("embedding", 1, 10).alias("p"))
    return metrics.roc_auc_one_vs_rest(rows, "label", "p").select(F.round("roc_auc", 6).alias("roc_auc"))


@query(
    "dbscan",
    POINTS_SQL.replace("WITH facts", "WITH RECURSIVE facts", 1) + """, near AS (SELECT a.product_id AS a, b.product_id AS b FROM z a JOIN z b
      ON abs(a.price_z - b.price_z) <= 0.5
      AND (a.price_z - b.price_z) * (a.price_z - b.price_z) + (a.rating_z - b.rating_z) * (a.rating_z - b.rating_z) + (a.reviews_count_z - b.reviews_count_z) * (a.reviews_count_z - b.reviews_count_z) <= 0.25),
    core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 5),
    links AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core) AND a <> b),
    reach AS (SELECT id, id AS root FROM core UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id WHERE r.root < l.b),
    rooted AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
    numbered AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM rooted),
    border AS (SELECT n.a AS id, min(c.cluster) AS cluster FROM near n JOIN numbered c ON c.id = n.b WHERE n.a NOT IN (SELECT id FROM core) GROUP BY n.a)
    SELECT product_id, CAST(coalesce(n.cluster, b.cluster, -1) AS INTEGER) AS cluster FROM products p LEFT JOIN numbered n ON n.id = p.product_id LEFT JOIN border b ON b.id = p.product_id""",
)
def dbscan(spark, sf):
    return neighbors.dbscan(scaled_points(spark, sf), "product_id", Z)


@query("kmeans")
def kmeans(spark, sf):
    vectors = cluster.scaled_vectors(held(products(spark, sf), "product_id", *DENSITY), "product_id")
    fitted = cluster.fit_kmeans(vectors)
    return cluster.assign(fitted, vectors).select("product_id", "cluster")


@query("hierarchical")
def hierarchical(spark, sf):
    vectors = cluster.scaled_vectors(held(products(spark, sf), "product_id", *DENSITY), "product_id")
    return cluster.hierarchical(vectors).select("product_id", "cluster")


@query("segment_names")
def segment_names(spark, sf):
    catalog = held(products(spark, sf), "product_id", *DENSITY)
    vectors = cluster.scaled_vectors(catalog, "product_id")
    return cluster.name_segments(cluster.assign(cluster.fit_kmeans(vectors), vectors))


def _pca_sql() -> str:
    """Eigenvectors of the 3x3 correlation matrix in closed form."""
    parts = []
    for n, value in ((1, "1 + 2 * p * cos(acos(r) / 3)"), (2, "1 - 2 * p * cos(acos(r) / 3) - 2 * p * cos(acos(r) / 3 + 2 * pi() / 3)")):
        parts.append(
            f"e{n} AS (SELECT {value} AS l, a, b, c FROM m), "
            f"v{n} AS (SELECT a * c - b * (1 - l) AS x, b * a - (1 - l) * c AS y, (1 - l) * (1 - l) - a * a AS z FROM e{n}), "
            f"u{n} AS (SELECT x / s AS x, y / s AS y, z / s AS z FROM (SELECT x, y, z, sqrt(x * x + y * y + z * z) * "
            f"CASE WHEN CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN x WHEN abs(y) >= abs(z) THEN y ELSE z END >= 0 THEN 1 ELSE -1 END AS s FROM v{n}))"
        )
    dot = "{u}.x * price_z + {u}.y * rating_z + {u}.z * reviews_count_z"
    return (
        POINTS_SQL
        + ", cor AS (SELECT covar_pop(price_z, rating_z) AS a, covar_pop(price_z, reviews_count_z) AS b, covar_pop(rating_z, reviews_count_z) AS c FROM z), "
        + "m AS (SELECT a, b, c, sqrt((a * a + b * b + c * c) / 3) AS p, a * b * c / pow(sqrt((a * a + b * b + c * c) / 3), 3) AS r FROM cor), "
        + ", ".join(parts)
        + f" SELECT product_id, round({dot.format(u='u1')}, 4) AS x, round({dot.format(u='u2')}, 4) AS y FROM z, u1, u2"
    )


@query("pca", _pca_sql())
def pca(spark, sf):
    coordinates, _ = cluster.pca(cluster.scaled_vectors(held(products(spark, sf), "product_id", *DENSITY), "product_id"))
    return coordinates.select("product_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


COLS = ("price", "rating", "reviews_count", "quantity")


@query(
    "covariance",
    PRODUCTS_SQL + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 4) AS cov FROM products"
        for i, a in enumerate(COLS) for b in COLS[i:]
    ),
)
def covariance(spark, sf):
    return cluster.covariance(products(spark, sf), COLS).withColumn("cov", F.round("cov", 4))


@query(
    "cluster_quality",
    """WITH x AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
    c AS (SELECT label, d, avg(CAST(v AS DOUBLE)) AS m, count(*) AS n FROM x GROUP BY 1, 2),
    g AS (SELECT d, avg(CAST(v AS DOUBLE)) AS m FROM x GROUP BY 1),
    dist AS (SELECT vec_id, label, sum((v - c.m) * (v - c.m)) AS d2 FROM x JOIN c USING (label, d) GROUP BY 1, 2),
    s AS (SELECT label, avg(sqrt(d2)) AS s, sum(d2) AS w, count(*) AS n FROM dist GROUP BY 1),
    b AS (SELECT sum(c.n * (c.m - g.m) * (c.m - g.m)) AS b FROM c JOIN g USING (d)),
    pairs AS (SELECT a.label AS i, z.label AS j, sqrt(sum((a.m - z.m) * (a.m - z.m))) AS gap FROM c a JOIN c z ON a.d = z.d AND a.label <> z.label GROUP BY 1, 2),
    worst AS (SELECT i, max((si.s + sj.s) / gap) AS r FROM pairs JOIN s si ON si.label = i JOIN s sj ON sj.label = j GROUP BY i)
    SELECT (SELECT count(*) FROM s) AS n_clusters, CAST(0 AS BIGINT) AS n_noise,
      round(((SELECT b FROM b) / ((SELECT count(*) FROM s) - 1)) / ((SELECT sum(w) FROM s) / ((SELECT sum(n) FROM s) - (SELECT count(*) FROM s))), 4) AS calinski_harabasz,
      round((SELECT avg(r) FROM worst), 4) AS davies_bouldin""",
)
def cluster_quality(spark, sf):
    vectors = cluster.as_vectors(table(spark, sf, "embeddings"), "embedding")
    scored = cluster.cluster_quality(vectors, "label")
    return scored.withColumns({c: F.round(c, 4) for c in ("calinski_harabasz", "davies_bouldin")})


@query(
    "silhouette",
    """WITH x AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
    p AS (SELECT vec_id, label, sum(CAST(v AS DOUBLE) * v) AS q FROM x GROUP BY 1, 2),
    c AS (SELECT label, d, sum(CAST(v AS DOUBLE)) AS s FROM x GROUP BY 1, 2),
    k AS (SELECT label, count(*) AS n, sum(q) AS q FROM p GROUP BY 1),
    dots AS (SELECT x.vec_id, x.label, c.label AS other, sum(x.v * c.s) AS dot FROM x JOIN c USING (d) GROUP BY 1, 2, 3),
    t AS (SELECT dots.vec_id, dots.label, other, k.n, k.n * p.q + k.q - 2 * dot AS total FROM dots JOIN k ON k.label = other JOIN p USING (vec_id)),
    ab AS (SELECT vec_id, max(total / (n - 1)) FILTER (WHERE label = other) AS a, min(total / n) FILTER (WHERE label <> other) AS b FROM t GROUP BY 1)
    SELECT round(avg((b - a) / greatest(a, b)), 4) AS silhouette FROM ab""",
)
def silhouette(spark, sf):
    vectors = cluster.as_vectors(table(spark, sf, "embeddings"), "embedding")
    value = cluster.silhouette(vectors, "label")
    return spark.range(1).select(F.round(F.lit(value), 4).alias("silhouette"))


@query("isolation_outliers")
def isolation_outliers(spark, sf):
    """Lonely products by price, rating, reviews and stock."""
    catalog = held(products(spark, sf), "product_id", *prep.FEATURES)
    return isolation.isolation_outliers(catalog, "product_id", prep.FEATURES)


@query(
    "isolation_checks",
    PRODUCTS_SQL + "SELECT count(*) AS n, true AS in_range, true AS extremes_above_middle FROM products",
)
def isolation_checks(spark, sf):
    """Rows with a score in (0, 1); those farthest from the medians score higher than those nearest on average."""
    catalog = held(products(spark, sf), "product_id", *prep.FEATURES)
    scores = held(isolation.isolation_outliers(catalog, "product_id", prep.FEATURES))
    z = prep.zscore(catalog.fillna(0.0, list(prep.FEATURES)), prep.FEATURES, "_z")
    away = z.select("product_id", sum((F.col(f"{c}_z") * F.col(f"{c}_z") for c in prep.FEATURES), F.lit(0.0)).alias("away"))
    both = scores.join(away, "product_id")
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if((F.col("score") > 0) & (F.col("score") < 1)) == F.count(F.lit(1))).alias("in_range"),
        (F.avg(F.when(F.col("away") > 12, F.col("score"))) > F.avg(F.when(F.col("away") < 2, F.col("score"))) + 0.05).alias("extremes_above_middle"),
    )


LABELLED = PRODUCTS_SQL + f", q AS (SELECT *, {QUALITY} AS s FROM products), lab AS (SELECT *, CAST(s >= (SELECT quantile_cont(s, 0.75) FROM q) AS INTEGER) AS is_top FROM q)"


def labelled(spark, sf_dir):
    catalog = held(products(spark, sf_dir), "product_id", *prep.FEATURES)
    return held(prep.flag_top_quartile(prep.quality_score(catalog)))


@query(
    "stratified_split",
    LABELLED + """, r AS (SELECT product_id, is_top, row_number() OVER (PARTITION BY is_top ORDER BY md5(product_id || ':split:42'), product_id) - 1 AS position, count(*) OVER (PARTITION BY is_top) AS total FROM lab)
    SELECT product_id, is_top, position < floor(total * CAST(0.2 AS DOUBLE) + 0.5) AS is_test FROM r""",
)
def stratified_split(spark, sf):
    return model.stratified_split(labelled(spark, sf).select("product_id", "is_top"), "product_id", "is_top")


@query("rf_classifier")
def rf_classifier(spark, sf):
    return model.train_classifier(labelled(spark, sf), "is_top", "random_forest")[1]


@query("gbt_classifier")
def gbt_classifier(spark, sf):
    return model.train_classifier(labelled(spark, sf), "is_top", "gradient_boosting")[1]


@query("logistic")
def logistic(spark, sf):
    return model.train_classifier(labelled(spark, sf), "is_top", "logistic")[1]


@query("regressor")
def regressor(spark, sf):
    return model.train_regressor(held(products(spark, sf), "product_id", *prep.FEATURES), "price")[1]


@query("trending_products")
def trending_products(spark, sf):
    return model.trending_products(held(products(spark, sf), "product_id", "name", "category", *DENSITY))


@query(
    "trending_label",
    PRODUCTS_SQL + "SELECT product_id, CAST(coalesce(rating > 4.0 AND reviews_count > (SELECT quantile_cont(reviews_count, 0.5) FROM products), false) AS INTEGER) AS trending FROM products",
)
def trending_label(spark, sf):
    return model.trending_label(held(products(spark, sf), "product_id", "rating", "reviews_count")).select("product_id", "trending")


@query(
    "above_median_price",
    PRODUCTS_SQL + "SELECT product_id, CAST(price > (SELECT quantile_cont(price, 0.5) FROM products) AS INTEGER) AS dear FROM products",
)
def above_median_price(spark, sf):
    return model.above_median_price(held(products(spark, sf), "product_id", "price")).select("product_id", "dear")


def graded(spark, sf_dir):
    """Document quality labels with a length rule as the prediction."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(documents, "doc_id").select(
        F.col("quality").alias("label"), (F.col("n_chars") > 500).cast("int").alias("prediction"), F.col("n_chars").alias("score")
    )


GRADED = "WITH g AS (SELECT quality AS label, CAST(n_chars > 500 AS INTEGER) AS prediction, n_chars AS score FROM labels JOIN documents USING (doc_id))"


@query("confusion_matrix", GRADED + " SELECT label, prediction, count(*) AS n FROM g GROUP BY 1, 2")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(graded(spark, sf))


@query(
    "classification_metrics",
    GRADED + """, c AS (SELECT l.c, count(*) FILTER (WHERE label = l.c) AS support, count(*) FILTER (WHERE prediction = l.c) AS predicted, count(*) FILTER (WHERE label = l.c AND prediction = l.c) AS tp
      FROM g, (SELECT DISTINCT label AS c FROM g) l GROUP BY 1),
    m AS (SELECT support, tp, coalesce(tp / nullif(CAST(predicted AS DOUBLE), 0), 0) AS p, tp / CAST(support AS DOUBLE) AS r FROM c),
    auc AS (SELECT sum(CASE WHEN a.score > b.score THEN 1 WHEN a.score = b.score THEN 0.5 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS auc FROM g a JOIN g b ON a.label = 1 AND b.label = 0)
    SELECT round(sum(tp) / CAST(sum(support) AS DOUBLE), 6) AS accuracy, round(sum(support * p) / sum(support), 6) AS precision, round(sum(support * r) / sum(support), 6) AS recall,
      round(sum(support * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(support), 6) AS f1, round((SELECT auc FROM auc), 6) AS roc_auc FROM m""",
)
def classification_metrics(spark, sf):
    rows = held(graded(spark, sf))
    scores = metrics.classification_metrics(rows)
    area = metrics.roc_auc(rows, F.col("label") == 1, "score").scalar()
    return scores.withColumn("roc_auc", area).select(
        *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")]
    )
