"""Cases that earlier answers got wrong or left out."""

import math

import pytest
from pyspark.sql import functions as F

from lexiframe.functions import tokens as tk
from lexiframe.operators import corpus
from lexiframe.operators import lexicons as lx
from lexiframe.operators import neighbours as nb
from lexiframe.operators import selection as sl
from lexiframe.operators import topics as tp
from lexiframe.session import lookup_join, materialize, scratch, scratch_path
from lexiframe.sources import readers, sinks


def scores(df):
    return {r["feature"]: r["score"] for r in df.collect()}


@pytest.fixture(scope="module")
def columns(spark):
    rows = [
        (i % 2, float(i % 2), 1.0, float(i % 5) + i % 2, 1e8 + i % 5 + i % 2, None if i % 3 else float(i % 2 + i % 7), None, math.nan if i % 4 else 1.0 * i)
        for i in range(60)
    ]
    names = "label int, apart double, same double, noisy double, shifted double, holes double, empty double, nans double"
    return spark.createDataFrame(rows, names)


def test_anova_ranks_a_perfect_column_first(columns):
    got = scores(sl.anova_scores(columns, columns.columns[1:], "label"))
    assert got["apart"] == math.inf and got["same"] is None and got["empty"] is None
    assert got["noisy"] == pytest.approx(got["shifted"], rel=1e-6) and 0 < got["holes"] < math.inf
    assert sl.top_features(sl.anova_scores(columns, columns.columns[1:], "label"), 1).first()["feature"] == "apart"


def test_anova_like_its_definition(spark):
    rows = [(i % 3, (i * 7919 % 101) / 10.0 + i % 3) for i in range(90)]
    got = scores(sl.anova_scores(spark.createDataFrame(rows, "label int, v double"), ["v"], "label"))["v"]
    groups = [[v for c, v in rows if c == k] for k in range(3)]
    mean = sum(v for _, v in rows) / 90
    between = sum(len(g) * (sum(g) / len(g) - mean) ** 2 for g in groups) / 2
    within = sum((v - sum(g) / len(g)) ** 2 for g in groups for v in g) / 87
    assert got == pytest.approx(between / within)


def test_mutual_information_reports_every_column(columns):
    got = scores(sl.mutual_information(columns, columns.columns[1:], "label", bins=4))
    assert set(got) == set(columns.columns[1:]) and got["empty"] == 0.0 and got["apart"] == pytest.approx(math.log(2))
    few = columns.where("holes IS NOT NULL")
    assert got["holes"] == pytest.approx(scores(sl.mutual_information(few, ["holes"], "label", bins=4))["holes"])


def test_class_vote_does_not_fade_with_class_size(spark):
    near = spark.createDataFrame([(1, 10, 1.0, 1), (1, 11, 1.0, 2), (1, 20, 9.0, 3)], "id long, neighbour long, distance double, rank int")
    many = spark.range(100_000).select((F.col("id") + 10).alias("neighbour"), F.when((F.col("id") < 2) | (F.col("id") % 2 == 0), 1).otherwise(0).alias("_label"))
    assert nb.vote(near, many, 3, "class").first()["prediction"] == 1


def test_neighbours_of_small_scale(spark):
    rows = spark.createDataFrame([(i, [i * 1e-8, 0.0]) for i in range(10)], "id long, vector array<double>")
    got = nb.nearest(rows.where("id = 9"), rows, 2, exclude_self=True).orderBy("rank").collect()
    assert [r["neighbour"] for r in got] == [8, 7] and got[0]["distance"] == pytest.approx(1e-8)


def test_words_are_what_python_splits(apply):
    text = "one two three　four\u0085five\x1csix  \tseven "
    assert apply(tk.words, text) == text.split() and apply(tk.n_words, text) == len(text.split())
    assert len(apply(tk.sentences, "One. Two! Three")) == 3


def test_stray_files_do_not_stop_a_scan(spark, tmp_path):
    (tmp_path / "12.txt").write_text("twelve")
    (tmp_path / "notes.md").write_text("no id")
    (tmp_path / ("9" * 30 + ".txt")).write_text("no long")
    got = readers.read_texts(spark, str(tmp_path)).collect()
    assert [(r["doc_id"], r["text"]) for r in got] == [(12, "twelve")]
    assert readers.stray_files(spark, str(tmp_path)).count() == 2


def test_rewrite_survives_a_failing_swap(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    spark.range(5).write.parquet(path)
    monkeypatch.setattr(sinks, "_moved", lambda fs, source, target: False)
    with pytest.raises(OSError):
        sinks.rewrite_in_place(spark.range(7), path)
    assert spark.read.parquet(path).count() == 5
    monkeypatch.undo()
    (tmp_path / "table").rename(tmp_path / "table__old")  # killed between the renames
    sinks.rewrite_in_place(spark.range(9), path)
    assert spark.read.parquet(path).count() == 9 and not (tmp_path / "table__old").exists()
    spark.range(3).write.parquet(path + "__old")  # left over beside a whole table
    sinks.rewrite_in_place(spark.read.parquet(path).where("id < 4"), path)
    assert spark.read.parquet(path).count() == 4 and not (tmp_path / "table__old").exists()


def test_topics_read_every_document_and_term(spark):
    rows = [(i, [f"w{i}", f"w{i % 3}", "common"]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    model = tp.fit_lda(docs, 2, passes=2)
    assert model.terms.count() == 41
    assert sum(model.totals) == pytest.approx(120 + 41)  # every token once, and an even share for every term
    pruned = tp.fit_lda(docs, 2, vocabulary=["w0", "common"], passes=1)
    assert {r["term"] for r in pruned.terms.collect()} == {"w0", "common"}
    assert corpus.unit_dictionary(docs, no_below=1, no_above=1.0).count() == 41


def test_factors_of_documents_with_long_ids(spark):
    rows = [(2**40 + i * 10**9, t, 1.0 + i % 3) for i in range(30) for t in ("a", f"t{i % 4}")]
    weights = spark.createDataFrame(rows, "doc_id long, term string, weight double").repartition(5)
    got = tp.factor_vectors(tp.fit_factors(weights, k=2, max_iter=3)).collect()
    assert {r["doc_id"] for r in got} == {r[0] for r in rows} and all(v >= 0 for r in got for v in r["factors"])


@pytest.mark.parametrize("listed", [1000, 1])
def test_kept_terms_either_way(spark, monkeypatch, listed):
    monkeypatch.setattr(lx, "MAX_LISTED_TERMS", listed)
    docs = spark.createDataFrame([(1, "a b a c".split()), (2, ["c"]), (3, [])], "doc_id long, tokens array<string>")
    words = spark.createDataFrame([("a",), ("c",), ("c",)], "term string")
    got = sorted(tuple(r) for r in lx.kept_rows(docs, F.col("tokens"), words).select("doc_id", "term", "tf").collect())
    assert got == [(1, "a", 2), (1, "c", 1), (2, "c", 1)]


def test_broadcast_is_bounded_by_bytes(spark, monkeypatch):
    from lexiframe import session

    left = spark.range(100)
    wide = spark.range(50).withColumn("v", F.sha2(F.col("id").cast("string"), 512))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(lookup_join(left, wide, "id"))
    monkeypatch.setattr(session, "MAX_LOOKUP_BYTES", 1000)
    joined = lookup_join(left, wide, "id")
    assert "broadcast" not in plan(joined) and joined.count() == 50


def test_scratch_tables_go_with_their_job(spark):
    from pathlib import Path

    with scratch(spark):
        table = materialize(spark.range(10))
        path = Path(scratch_path(spark, "x")).parent
        made = Path(table.inputFiles()[0].removeprefix("file://")).parent
        assert table.count() == 10 and made.exists()
    assert not made.exists() and not path.exists()


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from lexiframe import session

    fake = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="a"),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(fake, "t")
    fake.conf.get = lambda key, default=None: "hdfs://shared/"
    assert session.scratch_path(fake, "t").startswith("hdfs://shared/lexiframe/")
