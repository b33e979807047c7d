import json

import pytest
from pyspark.sql import functions as F

from lexiframe.operators import studies
from lexiframe.plans.style import extract_style
from lexiframe.plans.topical import extract_topical
from lexiframe.plans.training import train_basic, train_full
from lexiframe.session import lookup_join
from lexiframe.sources import readers, sinks
from lexiframe.streaming.intake import take_in

SF = "/root/testdata/sf0.001"


def features(spark, n=150):
    """Three classes that differ in two of five columns."""
    rows = spark.range(n).withColumn("movement", F.element_at(F.array(F.lit("b"), F.lit("a"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")))
    for j in range(5):
        noise = (F.conv(F.substring(F.md5(F.concat_ws(":", "id", F.lit(j))), 1, 8), 16, 10).cast("double") / 2**32) - 0.5
        apart = F.when(F.col("id") % 3 == j + 1, 3.0).otherwise(0.0) if j < 2 else F.lit(0.0)
        rows = rows.withColumn(f"x{j}", noise + apart)
    return rows, [f"x{j}" for j in range(5)]


def test_texts_round_trip_and_missing(spark, tmp_path):
    texts = spark.createDataFrame([(7, "a\nb"), (9, "é c")], "doc_id long, text string")
    sinks.write_text_files(texts, str(tmp_path / "files"))
    assert {tuple(r) for r in sinks.read_text_files(spark, str(tmp_path / "files")).collect()} == {(7, "a\nb"), (9, "é c")}
    store = str(tmp_path / "store")
    sinks.append_texts(texts.filter("doc_id = 7"), store)
    sinks.append_texts(texts, store)
    stored = spark.read.parquet(store)
    assert sorted(r["doc_id"] for r in stored.collect()) == [7, 9]
    wanted = spark.createDataFrame([(7,), (8,)], "doc_id long")
    assert [r["doc_id"] for r in readers.missing_texts(wanted, stored).collect()] == [8]
    assert {r["doc_id"]: r["text"] for r in readers.cached_or_empty(wanted, stored.select("doc_id", "text")).collect()}[8] == ""


def test_numbered_text_files(spark, tmp_path):
    (tmp_path / "12.txt").write_bytes(b"ok \xff\nline")
    row = readers.read_texts(spark, str(tmp_path)).first()
    assert row["doc_id"] == 12 and row["text"] == "ok �\nline"


def test_catalogue_csv_with_quotes(spark, tmp_path):
    path = tmp_path / "books.csv"
    path.write_text('Title,Author,Movement,DocID,IsProse\n"Tales, ""odd"" ones",A B,Realism,5,True\n')
    row = readers.read_catalogue(spark, str(path)).first()
    assert tuple(row) == ('Tales, "odd" ones', "A B", "Realism", 5, True)


def test_rewrite_in_place_keeps_only_new_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    sinks.rewrite_in_place(spark.read.parquet(path).filter("id < 3"), path)
    assert spark.read.parquet(path).count() == 3
    assert not sinks.path_exists(spark, path + "__old") and not sinks.path_exists(spark, path + "__new")


def test_stream_takes_each_file_once(spark, tmp_path):
    source, sink, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    (source / "1.txt").write_text("_one_ [x]")
    take_in(spark, str(source), sink, check)
    (source / "2.txt").write_text("two")
    take_in(spark, str(source), sink, check)
    assert {tuple(r) for r in spark.read.parquet(sink).collect()} == {(1, "one "), (2, "two")}


def test_lookup_join_without_broadcast_gives_the_same_rows(spark):
    left, right = spark.range(50), spark.range(40).withColumn("v", F.col("id") * 2)
    small = lookup_join(left, right, "id")
    large = lookup_join(left, right, "id", max_rows=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert sorted(small.collect()) == sorted(large.collect())


def test_basic_training(spark):
    rows, cols = features(spark)
    grids = {
        "logistic": {"c": [0.1, 10.0]},
        "random_forest": {"trees": [40], "depth": [None]},
        "knn": {"k": [3, 5], "weights": ["uniform", "distance"]},
        "svm": {"c": [1.0], "kernel": ["linear"]},
    }
    run = train_basic(rows, cols, "movement", "id", grids=grids, k_clusters=3, restarts=2, n_folds=2, max_iter=15)
    scores = {r["model"]: r["accuracy"] for r in run.comparison.collect()}
    assert set(scores) == {*grids, "kmeans"}
    # A clustering from two starts may end in a local optimum, so only the classifiers must do well.
    assert all(v > 0.7 for n, v in scores.items() if n != "kmeans")
    assert run.best in scores and run.settings["logistic"]["c"] in (0.1, 10.0)
    assert run.contingency.agg(F.sum("n")).first()[0] == 90
    assert run.reports.filter("class = 'accuracy'").count() == len(scores)


@pytest.mark.parametrize("method", ["selectkbest", "pca"])
def test_full_training(spark, method, tmp_path):
    rows, cols = features(spark)
    rows = rows.filter("movement <> 'c' OR id < 75")
    grids = {
        "random_forest": {"trees": [10], "depth": [5], "min_leaf": [2]},
        "knn": {"k": [3], "weights": ["distance", "class"], "metric": ["cosine", "manhattan"]},
    }
    run = train_full(rows, cols, "movement", "id", grids, method, n_features=6, n_components=4, k_clusters=3, restarts=2, n_folds=2)
    assert all(r["accuracy"] > 0.6 for r in run.comparison.filter("model <> 'kmeans'").collect())
    assert run.best != "kmeans" and len(run.columns) == (6 if method == "selectkbest" else 4)
    sinks.save_model(run.models["random_forest"], str(tmp_path / "forest"))
    assert sinks.load_model(str(tmp_path / "forest")).stages[-1].getNumTrees == 10


def test_unknown_selection_method_is_refused(spark):
    rows, cols = features(spark, 60)
    with pytest.raises(ValueError):
        train_full(rows, cols, "movement", "id", {}, "magic")


def test_studies(spark):
    from lexiframe.operators import sampling as sm

    rows, cols = features(spark)
    rows = sm.stratified_split(rows.withColumn("label", (F.col("id") % 3).cast("int")), "label", "id", 0.3)
    recipe = {"n_features": 5, "gammas": (0.2,), "cs": (0.3, 1.0), "components": 60, "max_iter": 8, "n_folds": 3}
    same = studies.ablation(rows, cols, ["absent"], "id", 1, **recipe).collect()
    assert same[0]["accuracy"] == same[1]["accuracy"] > 0.9 and same[0]["class_f1"] == same[1]["class_f1"]
    less = {r["setting"]: r["accuracy"] for r in studies.ablation(rows, cols, ["x0", "x1"], "id", 1, **recipe).collect()}
    assert less["ablated"] < less["baseline"]
    quiet = studies.noise_robustness(rows, cols, "id", 1, sigma=0.0, **recipe).collect()
    assert quiet[0]["accuracy"] == quiet[1]["accuracy"]


def labelled(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    return spark.read.parquet(f"{SF}/documents.parquet").join(labels, "doc_id", "left")


def test_extract_style(spark):
    docs = labelled(spark)
    table = extract_style(docs, "quality", n_terms=30, n_selected=20, topic_passes=2, paragraph_separator="\n")
    rows = table.collect()
    assert len(rows) == docs.count() == len({r["doc_id"] for r in rows})
    assert len(table.columns) == 2 + 39 + 20
    assert all(v is not None for r in rows for c, v in r.asDict().items() if c != "quality")


def test_extract_topical(spark):
    table = extract_topical(
        labelled(spark), "quality", author="source", min_words=0, n_terms=30, n_topics=3, topic_passes=2, n_selected=20, n_components=5
    )
    assert [c for c in table.columns if c.startswith("pca_")] == [f"pca_{i}" for i in range(5)]
    assert table.count() == labelled(spark).count()


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
    assert json.dumps(sorted(entry.queries()))


def test_all_cores_write_text_files(spark, tmp_path):
    """A table in one partition is dealt to the cores before a file is written for each of its rows."""
    texts = spark.range(64).selectExpr("id AS doc_id", "concat('text ', id) AS text").coalesce(1)
    sinks.write_text_files(texts, str(tmp_path / "files"))
    parts = {p.name.split("-")[1] for p in (tmp_path / "files").glob("doc_id=*/part-*.txt")}
    assert len(parts) > spark.sparkContext.defaultParallelism // 2
    assert sorted(map(tuple, sinks.read_text_files(spark, str(tmp_path / "files")).collect())) == [(i, f"text {i}") for i in range(64)]
