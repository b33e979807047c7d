import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lexiframe.operators import evaluate as ev
from lexiframe.operators import features as ft
from lexiframe.operators import models as md
from lexiframe.operators import neighbours as nb
from lexiframe.operators import sampling as sm
from lexiframe.operators import selection as sl
from lexiframe.operators.ranking import exact_quantiles


def grid(spark, n=120, dims=4, classes=3, seed=1):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = 0 if i % 2 else 1 + i // 2 % (classes - 1)
        rows.append((i, y, [float(v) for v in draw.normal(3.0 * y, 1.0, dims)]))
    return spark.createDataFrame(rows, "id long, label int, vector array<double>")


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_quantiles_are_exact_with_a_hot_value(spark, accuracy):
    draw = np.random.default_rng(3)
    values = np.concatenate([np.full(700, 2.5), draw.normal(size=1301)])
    other = draw.integers(0, 4, 2001).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(values, other)], "a double, b double")
    df = df.union(spark.createDataFrame([(None, float("nan"))], "a double, b double"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = exact_quantiles(df, ["a", "b"], probs, accuracy)
    assert np.allclose(found["a"], np.quantile(values, probs), atol=1e-12)
    assert np.allclose(found["b"], np.quantile(other, probs), atol=1e-12)


def test_quantiles_of_tiny_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.25, 0.5]) == {"a": [1.5, 2.0], "b": [None, None]}


def test_winsorize_and_scaling(spark):
    df = spark.createDataFrame([(float(i), 7.0) for i in range(11)] + [(1000.0, 7.0), (float("nan"), 7.0)], "a double, b double")
    bounds = ft.fit_outlier_bounds(df, ["a"], 2.5)
    high = max(r["a"] for r in ft.winsorize(df, bounds).collect() if not math.isnan(r["a"]))
    assert high == bounds["a"][1] < 1000
    assert any(math.isnan(r["a"]) for r in ft.winsorize(df, bounds).collect())
    scaled = ft.rescale(df, ft.fit_standard(df.filter(~F.isnan("a")), ["a", "b"])).filter(~F.isnan("a"))
    stats = scaled.agg(F.avg("a"), F.stddev_pop("a"), F.max("b")).first()
    assert abs(stats[0]) < 1e-9 and abs(stats[1] - 1) < 1e-9 and stats[2] == 0.0
    assert ft.fit_robust(df, ["b"]) == {"b": (7.0, 1.0)}


def test_interactions_use_the_widest_columns(spark):
    df = spark.createDataFrame([(1.0, 10.0, 0.1), (2.0, 30.0, 0.1), (5.0, 20.0, 0.2)], "a double, b double, c double")
    pairs = ft.interaction_names(df, ["a", "b", "c"], 2)
    assert pairs == [("b", "a")]
    assert [r["b_x_a"] for r in ft.with_interactions(df, pairs).collect()] == [10.0, 60.0, 100.0]


def test_split_sizes_are_exact_and_repeatable(spark):
    rows = grid(spark, 270)
    one = sm.stratified_split(rows, "label", "id", 0.15, 0.15)
    sizes = {r["split"]: r["count"] for r in one.groupBy("split").count().collect()}
    assert sizes == {"test": 41, "val": 41, "train": 188}
    again = sm.stratified_split(rows.repartition(5), "label", "id", 0.15, 0.15)
    assert {(r["id"], r["split"]) for r in one.collect()} == {(r["id"], r["split"]) for r in again.collect()}
    share = {r["label"]: r["count"] for r in one.filter("split = 'test'").groupBy("label").count().collect()}
    whole = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    assert all(abs(share[c] - 41 * n / 270) < 1 for c, n in whole.items())


def test_split_with_one_dominant_class(spark):
    rows = spark.range(5000).select("id", (F.col("id") < 20).cast("int").alias("label"))
    split = sm.stratified_split(rows, "label", "id", 0.2)
    got = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert got == {(0, "test"): 996, (0, "train"): 3984, (1, "test"): 4, (1, "train"): 16}


def test_folds_differ_by_one_row_at_most(spark):
    folds = sm.stratified_folds(grid(spark, 101), "label", "id", 5)
    for label in (0, 1, 2):
        sizes = [r["count"] for r in folds.filter(F.col("label") == label).groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_oversampling_balances_and_stays_on_segments(spark, block_rows):
    rows = grid(spark, 90)
    new = sm.oversample(rows, k=3, block_rows=block_rows).collect()
    have = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    for c, n in have.items():
        assert n + sum(r["label"] == c for r in new) == max(have.values())
    by_id = {r["id"]: (r["label"], np.array(r["vector"])) for r in rows.collect()}
    for r in new:
        (ya, a), (yb, b) = by_id[r["source"]], by_id[r["neighbour"]]
        assert ya == yb == r["label"] and r["source"] != r["neighbour"] and 0 < r["u"] < 1
        assert np.allclose(r["vector"], a + r["u"] * (b - a))
        same = [(round(float(np.linalg.norm(a - v)), 6), i) for i, (y, v) in by_id.items() if y == ya and i != r["source"]]
        assert r["neighbour"] in [i for _, i in sorted(same)[:3]]


def test_oversampling_a_class_of_one(spark):
    rows = spark.createDataFrame([(1, 0, [0.0]), (2, 0, [1.0]), (3, 0, [2.0]), (9, 1, [5.0])], "id long, label int, vector array<double>")
    assert [list(r["vector"]) for r in sm.oversample(rows).collect()] == [[5.0], [5.0]]


def test_noise_is_gaussian_and_vanishes_at_zero(spark):
    df = spark.range(4000).select("id", F.lit(1.0).alias("a"))
    stats = sm.with_noise(df, ["a"], "id", 0.1).agg(F.avg("a"), F.stddev_pop("a")).first()
    assert abs(stats[0] - 1.0) < 0.01 and abs(stats[1] - 0.1) < 0.005
    assert sm.with_noise(df, ["a"], "id", 0.0).filter("a <> 1.0").count() == 0


def test_class_weights_sum_to_rows(spark):
    weighted = sm.with_class_weights(grid(spark, 60), "label")
    per_class = [r["s"] for r in weighted.groupBy("label").agg(F.sum("weight").alias("s")).collect()]
    assert np.allclose(per_class, 20.0)


@pytest.mark.parametrize("metric", nb.METRICS)
@pytest.mark.parametrize("block_rows", [4096, 13])
def test_nearest_equals_brute_force(spark, metric, block_rows):
    rows = grid(spark, 70)
    found = nb.nearest(rows, rows, 4, metric, exclude_self=True, block_rows=block_rows).collect()
    data = {r["id"]: np.array(r["vector"]) for r in rows.collect()}
    want = {}
    for i, x in data.items():
        gaps = [(round(float(nb.distances(x[None], y[None], metric)[0, 0]), 6), j) for j, y in data.items() if j != i]
        want[i] = [j for _, j in sorted(gaps)[:4]]
    got = {i: [r["neighbour"] for r in sorted(found, key=lambda r: r["rank"]) if r["id"] == i] for i in data}
    assert got == want


def test_knn_votes(spark):
    train = spark.createDataFrame(
        [(1, 0, [0.0]), (2, 0, [1.0]), (3, 1, [2.0]), (4, 1, [3.0]), (5, 1, [2.0])], "id long, label int, vector array<double>"
    )
    test = spark.createDataFrame([(10, [1.0]), (11, [1.4])], "id long, vector array<double>")
    exact = {r["id"]: r["prediction"] for r in nb.knn_classify(train, test, 5, weights="distance").collect()}
    assert exact[10] == 0  # a neighbour at distance 0 decides alone
    plain = {r["id"]: r["prediction"] for r in nb.knn_classify(train, test, 5).collect()}
    assert plain == {10: 1, 11: 1}
    assert nb.knn_classify(train, test, 4, weights="uniform").filter("id = 10").first()["prediction"] == 0
    with pytest.raises(ValueError):
        nb.nearest(test, train.select("id", "vector"), 1, "chebyshev")


def test_silhouette_equals_brute_force(spark):
    rows = grid(spark, 40).withColumn("cluster", F.when(F.col("id") == 0, 9).otherwise(F.col("label")))
    got = {r["id"]: r["silhouette"] for r in nb.silhouette_rows(rows, block_rows=11).collect()}
    data = [(r["id"], r["cluster"], np.array(r["vector"])) for r in rows.collect()]
    for i, c, x in data:
        mean = {}
        for k in {c2 for _, c2, _ in data}:
            gaps = [np.linalg.norm(x - y) for j, c2, y in data if c2 == k and j != i]
            mean[k] = np.mean(gaps) if gaps else None
        a, b = mean[c], min(m for k, m in mean.items() if k != c)
        assert math.isclose(got[i], 0.0 if a is None else (b - a) / max(a, b), abs_tol=1e-9)


def test_anova_and_information(spark):
    wide = ft.wide(grid(spark, 120), "vector", 4, ["id", "label"]).withColumn("flat", F.lit(1.0))
    cols = ["f00", "f01", "f02", "f03", "flat"]
    scores = {r["feature"]: r["score"] for r in sl.anova_scores(wide, cols, "label").collect()}
    data = wide.toPandas()
    groups = [g["f00"].to_numpy() for _, g in data.groupby("label")]
    grand = data["f00"].mean()
    between = sum(len(g) * (g.mean() - grand) ** 2 for g in groups) / 2
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (120 - 3)
    assert math.isclose(scores["f00"], between / within, rel_tol=1e-9) and scores["flat"] is None
    info = {r["feature"]: r["score"] for r in sl.mutual_information(wide, cols, "label").collect()}
    assert info["f00"] > 0.3 and abs(info["flat"]) < 1e-12
    assert "flat" not in sl.selected_names(sl.anova_scores(wide, cols, "label"), 4, cols)


def test_selection_stage_choices():
    assert sl.selection_stage("none", 4) is None
    with pytest.raises(ValueError):
        sl.selection_stage("magic", 4)


def told(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 2), (3, 0)]
    return spark.createDataFrame(rows, "label int, prediction int")


def test_report_and_confusion(spark):
    report = {r["class"]: r for r in ev.classification_report(told(spark)).collect()}
    assert math.isclose(report["0"]["precision"], 2 / 3) and math.isclose(report["0"]["recall"], 2 / 3)
    assert report["2"]["precision"] == 0.0 and report["3"]["f1"] == 0.0 and report["3"]["support"] == 1
    assert math.isclose(report["accuracy"]["f1"], 0.5) and report["accuracy"]["support"] == 6
    cells = {(r["y"], r["p"]): r for r in ev.confusion_matrix(told(spark)).collect()}
    assert len(cells) == 16 and cells[0, 0]["n"] == 2 and cells[2, 2]["share"] == 0.0
    assert math.isclose(sum(cells[0, p]["share"] for p in range(4)), 1.0)


def test_cluster_mapping(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (1, 1), (2, 2)], "label int, cluster int")
    assert {r["cluster"]: r["mapped"] for r in ev.cluster_labels(rows, 4).collect()} == {0: 0, 1: 1, 2: 2, 3: 1}
    none = ev.cluster_labels(rows, 4, fallback="none")
    assert {r["cluster"]: r["mapped"] for r in none.collect()}[3] == -1
    assert ev.accuracy(ev.mapped_predictions(rows, none)).first()["accuracy"] == 0.8


def test_models_learn_separable_classes(spark, tmp_path):
    from pyspark.ml.functions import array_to_vector

    rows = sm.with_class_weights(grid(spark, 120).withColumn("features", array_to_vector("vector")), "label").coalesce(2).cache()
    n = rows.count()

    def score(model):
        return ev.accuracy(model.transform(rows).withColumn("prediction", F.col("prediction").cast("int"))).first()["accuracy"]

    forest = md.random_forest(10, 4, 2, "weight").fit(rows)
    assert score(forest) > 0.9 and math.isclose(sum(forest.featureImportances.toArray()), 1.0)
    assert score(md.logistic(1.0, n, "weight", max_iter=20).fit(rows)) > 0.9
    rbf = md.rbf_svm(1.0, md.scale_gamma(rows, 4), n, 60, "weight", max_iter=10).fit(rows)
    assert score(rbf) > 0.85
    rbf.write().overwrite().save(str(tmp_path / "svm"))
    assert score(PipelineModel.load(str(tmp_path / "svm"))) == score(rbf)
    shares = md.explained_variance(rows, 4)
    assert shares == sorted(shares, reverse=True) and math.isclose(sum(shares), 1.0)
    one, many = md.kmeans(rows, 3, 1), md.kmeans(rows, 3, 3)
    assert many.summary.trainingCost <= one.summary.trainingCost + 1e-9


def test_fourier_features_approximate_the_kernel(spark):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = grid(spark, 20).withColumn("features", array_to_vector("vector"))
    z = md.FourierFeatures(gamma=0.05, components=4000).transform(rows).orderBy("id").select(vector_to_array("kernel").alias("z"), "vector").collect()
    zs, xs = np.array([r["z"] for r in z]), np.array([r["vector"] for r in z])
    kernel = np.exp(-0.05 * ((xs[:, None] - xs[None]) ** 2).sum(-1))
    assert np.abs(zs @ zs.T - kernel).max() < 0.1


def test_nearest_centroid(spark):
    rows = grid(spark, 30)
    centres = md.centroids(rows, "label")
    assert [c for c, _ in centres] == [0, 1, 2]
    told_ = rows.withColumn("prediction", md.nearest_centroid(F.col("vector"), centres))
    assert ev.accuracy(told_).first()["accuracy"] > 0.8
