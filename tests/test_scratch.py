"""Scratch tables and shuffle files do not pile up while a job runs."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexiframe import session
from lexiframe.operators import topics
from lexiframe.sources import sinks


def files(folder) -> set[str]:
    return {str(p) for p in Path(folder).rglob("*.parquet") if p.is_file()}


def test_materialize_drops_its_shuffle_files(spark, tmp_path):
    seen = []
    inner = spark._jsc.sc().shuffleDriverComponents()
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> set[str]:
        return {str(b) for b in tracker.getAllBlocks().mkString("\n").split("\n") if b.startswith("shuffle_")}

    assert inner is not None
    before, setting = shuffles(), spark.conf.get(session.CLEANUP, None)
    table = session.materialize(spark.range(10_000).groupBy((F.col("id") % 100).alias("g")).count(), "counted")
    for _ in range(50):
        seen = shuffles() - before
        if not seen:
            break
        __import__("time").sleep(0.1)
    assert not seen and table.count() == 100 and spark.conf.get(session.CLEANUP, None) == setting


def test_passes_leave_only_the_last_state(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "_scratch_root", lambda spark: str(tmp_path))
    texts = [(i, [f"w{(i * j) % 17}" for j in range(1, 9)]) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, tokens array<string>")
    model = topics.fit_lda(docs, 3, passes=4)
    assert len({p.split("/")[-2] for p in files(tmp_path)}) == 1 and model.terms.count() == 17
    weights = docs.select("doc_id", F.explode("tokens").alias("term")).groupBy("doc_id", "term").agg(F.count("*").cast("double").alias("weight"))
    found = topics.fit_factors(weights, 3, 4)
    assert found.terms.count() == 17 and found.documents.count() == 40
    kept = {p.split("/")[-2] for p in files(tmp_path)}
    assert kept <= {"weights", "factors", "round", "blocks"}
    assert len({p.split("/")[-3] for p in files(tmp_path)}) == 4
    empty = topics.fit_lda(docs.limit(0), 3, passes=2)
    assert empty.terms.count() == 0


def test_discard_deletes_scratch_tables_only(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/given")
    with pytest.raises(ValueError):
        session.discard(spark.read.parquet(f"{tmp_path}/given"))
    assert spark.read.parquet(f"{tmp_path}/given").count() == 3


def test_text_files_are_those_of_sparks_writer(spark, tmp_path):
    rows = [(1, "one"), (2, None), (2, None), (None, "no id"), (3, "two\nlines\n"), (-4, "below"), (5, ""), (7, "Ä\u0000\r\n"), (7, "Ä\u0000\r\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def read(path):
        found = [(str(p.parent.relative_to(path)), p.read_bytes()) for p in Path(path).rglob("*.txt") if not p.name.startswith(".")]
        return sorted(found)

    sinks.spread(docs, "doc_id").write.partitionBy("doc_id").text(f"{tmp_path}/spark")
    for _ in range(2):
        sinks.write_text_files(docs, f"{tmp_path}/own")
    assert read(f"{tmp_path}/own") == sorted(2 * read(f"{tmp_path}/spark"))
    assert not [p for p in (tmp_path / "own").rglob(".*") if p.is_file()]
    once = sinks.read_text_files(spark, f"{tmp_path}/spark")
    assert sorted(map(tuple, sinks.read_text_files(spark, f"{tmp_path}/own").distinct().collect())) == sorted(map(tuple, once.collect()))


def test_no_hadoop_file_is_made_per_document(spark, tmp_path):
    """Hadoop's local file system leaves a checksum beside each file it makes, and starts processes for it."""
    docs = spark.range(200).selectExpr("id AS doc_id", "repeat('x', 10) AS text")
    sinks.write_text_files(docs, f"{tmp_path}/texts")
    assert not list((tmp_path / "texts").rglob("*.crc")) and sinks.read_text_files(spark, f"{tmp_path}/texts").count() == 200
