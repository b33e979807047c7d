"""Projections, models and clustering."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lexiframe.operators import features as ft
from lexiframe.operators import models as md
from lexiframe.operators import neighbours as nb
from lexiframe.operators import sampling as sm
from lexiframe.operators import selection as sl
from lexiframe.queries import register
from lexiframe.queries.matrix import COLS, SPLIT_SQL, split_table, table, vectors
from lexiframe.session import materialize, packed

# ---- projections -------------------------------------------------------------------------------------------


def scaled_features(spark, folder):
    rows = table(spark, folder)
    scaled = md.assembled(ft.rescale(rows, ft.fit_standard(rows, COLS)), COLS).select("vec_id", "label", "features")
    return packed(materialize(scaled, "scaled"))


@register("k03_principal_components")
def principal_components(spark, folder):
    rows = scaled_features(spark, folder)
    scored = md.centred_pca(30).fit(rows).transform(rows)
    return scored.select("vec_id", F.posexplode(vector_to_array("pca")).alias("component", "value"))


@register("k04_explained_variance")
def explained_variance(spark, folder):
    shares = md.explained_variance(scaled_features(spark, folder), 30)
    rows = [(i, v, sum(shares[: i + 1])) for i, v in enumerate(shares)]
    return spark.createDataFrame(rows, "component int, share double, cumulative double")


@register("k06_selection_methods")
def selection_methods(spark, folder):
    """Width of the feature vector after each method."""
    rows = scaled_features(spark, folder)
    out = None
    for method in ("none", "pca", "selectkbest"):
        stage = sl.selection_stage(method, len(COLS), n_features=50, n_components=30)
        kept = rows.withColumn("selected", F.col("features")) if stage is None else stage.fit(rows).transform(rows)
        size = kept.select(F.lit(method).alias("method"), F.size(vector_to_array("selected")).alias("width"))
        counted = size.groupBy("method", "width").agg(F.count(F.lit(1)).alias("n"))
        out = counted if out is None else out.unionByName(counted)
    return out


@register("k07_plane_projection")
def plane_projection(spark, folder):
    rows = scaled_features(spark, folder)
    clustered = md.kmeans(rows, k=7).transform(rows)
    plane = md.centred_pca(2).fit(rows).transform(clustered).withColumn("xy", vector_to_array("pca"))
    return plane.select("vec_id", "label", "cluster", F.col("xy")[0].alias("x"), F.col("xy")[1].alias("y"))


# ---- models ------------------------------------------------------------------------------------------------


def prepared(spark, folder):
    """Split, scaled on the training part, clipped and weighted; written once, as every fit reads it many times."""
    rows = split_table(spark, folder)
    fitted = ft.fit_standard(rows.filter(F.col("split") == "train"), COLS)
    scaled = ft.clip_columns(ft.rescale(rows, fitted), COLS, 5.0)
    ready = md.assembled(scaled, COLS).select("vec_id", "label", "split", "features")
    weighted = sm.with_class_weights(ready, "label")
    return packed(materialize(weighted, "prepared"))


def parts(rows):
    return rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "val"), rows.filter(F.col("split") == "test")


def predicted(model, rows):
    return model.transform(rows).select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"))


@register("l01_logistic")
def logistic(spark, folder):
    train, _, test = parts(prepared(spark, folder))
    return predicted(md.logistic(0.3, train.count(), "weight").fit(train), test)


@register("l02_random_forest")
def random_forest(spark, folder):
    train, _, test = parts(prepared(spark, folder))
    return predicted(md.random_forest(50, 7, 2, "weight").fit(train), test)


KNN_PAIRS = f"""{SPLIT_SQL}, e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    tr AS (SELECT e.* FROM e JOIN split USING (vec_id) WHERE split = 'train'),
    te AS (SELECT e.* FROM e JOIN split USING (vec_id) WHERE split = 'test'),
    pair AS (SELECT te.vec_id, tr.vec_id AS nb, tr.label, round(list_distance(te.v, tr.v), 6) AS euclidean,
        round(1 - list_cosine_similarity(te.v, tr.v), 6) AS cosine,
        round(list_sum(list_transform(range(1, 65), lambda i: abs(te.v[i] - tr.v[i]))), 6) AS manhattan FROM te, tr)"""


def knn_sql(k: int, metric: str, weight: str) -> str:
    return f"""(SELECT vec_id, '{metric}' AS metric, label AS prediction FROM (
        SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id ORDER BY round(sum(w), 9) DESC, label) AS r FROM (
            SELECT vec_id, label, CAST({weight} AS DOUBLE) AS w FROM (
                SELECT vec_id, label, d, min(d) OVER (PARTITION BY vec_id) AS dmin FROM (
                    SELECT vec_id, label, {metric} AS d, row_number() OVER (PARTITION BY vec_id ORDER BY {metric}, nb) AS rk FROM pair)
                WHERE rk <= {k})) GROUP BY vec_id, label) WHERE r = 1)"""


INVERSE = "CASE WHEN dmin = 0 THEN CASE WHEN d = 0 THEN 1 ELSE 0 END ELSE 1 / d END"


@register(
    "l03_knn_vote",
    f"WITH {KNN_PAIRS} SELECT * FROM {knn_sql(5, 'euclidean', '1')} UNION ALL SELECT * FROM {knn_sql(7, 'cosine', INVERSE)} "
    f"UNION ALL SELECT * FROM {knn_sql(9, 'manhattan', INVERSE)}",
)
def knn_vote(spark, folder):
    rows = materialize(knn_rows(spark, folder), "rows")
    train, _, test = parts(rows)
    out = None
    for k, metric, weights in ((5, "euclidean", "uniform"), (7, "cosine", "distance"), (9, "manhattan", "distance")):
        found = nb.knn_classify(train, test, k, metric, weights, digits=(6, 9)).select(
            F.col("id").alias("vec_id"), F.lit(metric).alias("metric"), "prediction"
        )
        out = found if out is None else out.unionByName(found)
    return out


def knn_rows(spark, folder):
    return sm.stratified_split(vectors(spark, folder), "label", "id", 0.15, 0.15)


@register(
    "l04_knn_class_vote",
    f"WITH {KNN_PAIRS}, size AS (SELECT label AS l, count(*) AS n FROM tr GROUP BY label) SELECT * FROM "
    + knn_sql(5, "euclidean", "pow((SELECT min(n) FROM size) / (SELECT n FROM size WHERE l = label)::DOUBLE, 2) / (d + 1e-10)"),
)
def knn_class_vote(spark, folder):
    train, _, test = parts(materialize(knn_rows(spark, folder), "rows"))
    found = nb.knn_classify(train, test, 5, "euclidean", "class", digits=(6, 9))
    return found.select(F.col("id").alias("vec_id"), F.lit("euclidean").alias("metric"), "prediction")


@register("l05_gradient_boosting")
def gradient_boosting(spark, folder):
    train, _, test = parts(prepared(spark, folder))
    return predicted(md.boosting(50, 2, 0.03, 0.8).fit(train), test)


@register("l06_support_vectors")
def support_vectors(spark, folder):
    train, _, test = parts(prepared(spark, folder))
    n, gamma = train.count(), md.scale_gamma(train, len(COLS))
    linear = predicted(md.linear_svm(0.5, n, "weight").fit(train), test).withColumn("kernel", F.lit("linear"))
    rbf = predicted(md.rbf_svm(0.5, gamma, n, weight="weight").fit(train), test)
    return linear.unionByName(rbf.withColumn("kernel", F.lit("rbf")))


@register("l07_grid_search")
def grid_search(spark, folder):
    train, _, _ = parts(prepared(spark, folder))
    folded = packed(materialize(sm.stratified_folds(train, "label", "vec_id", 5), "folded"))
    n = folded.count()
    candidates = [({"family": "logistic", "c": c}, md.logistic(c, n, "weight")) for c in (0.05, 0.3)]
    candidates += [({"family": "random_forest", "trees": 50, "depth": d}, md.random_forest(50, d, 2, "weight")) for d in (5, 7)]
    _, best, scores = md.grid_search(folded, candidates, "fold", 5)
    rows = [(str(about), score, about == best) for about, score in scores]
    return spark.createDataFrame(rows, "setting string, accuracy double, best boolean")


@register("l08_validation_scores")
def validation_scores(spark, folder):
    from lexiframe.operators import evaluate as ev

    train, val, _ = parts(prepared(spark, folder))
    n, gamma = train.count(), md.scale_gamma(train, len(COLS))
    families = {
        "logistic": md.logistic(0.3, n, "weight"),
        "random_forest": md.random_forest(50, 7, 2, "weight"),
        "gradient_boosting": md.boosting(50, 2, 0.03, 0.8),
        "svm": md.rbf_svm(0.5, gamma, n, weight="weight"),
    }
    scored = {name: predicted(model.fit(train), val) for name, model in families.items()}
    near = [part.select(F.col("vec_id").alias("id"), "label", vector_to_array("features").alias("vector")) for part in (train, val)]
    found = nb.knn_classify(*near, 5).join(near[1].select("id", "label"), "id")
    scored["knn"] = found.select(F.col("id").alias("vec_id"), "label", "prediction")
    return ev.compare_models(scored)


@register("l09_kmeans")
def kmeans(spark, folder):
    rows = prepared(spark, folder)
    train, _, _ = parts(rows)
    return md.kmeans(train, k=7).transform(rows).select("vec_id", "split", "cluster")


CENTRES_SQL = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    centre AS (SELECT label AS code, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS m FROM
        (SELECT label, unnest(range(64)) AS i, unnest(v) AS x FROM e) GROUP BY label, i) GROUP BY label),
    assigned AS (SELECT vec_id, label, code AS cluster FROM (SELECT vec_id, label, code,
        row_number() OVER (PARTITION BY vec_id ORDER BY round(list_distance(v, c), 6), code) AS r FROM e, centre WHERE code < 7) WHERE r = 1)"""


def clustered(spark, folder):
    """All rows assigned to the means of the first seven classes."""
    rows = vectors(spark, folder)
    centres = [c for c in md.centroids(rows, "label") if c[0] < 7]
    return rows.withColumn("cluster", md.nearest_centroid(F.col("vector"), centres, digits=6))


@register("l10_cluster_assignment", f"WITH {CENTRES_SQL} SELECT vec_id, cluster FROM assigned")
def cluster_assignment(spark, folder):
    return clustered(spark, folder).select(F.col("id").alias("vec_id"), "cluster")
