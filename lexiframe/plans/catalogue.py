"""Catalogue hygiene as one job."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.operators import hygiene as hy
from lexiframe.session import materialize


class CleanCatalogue(NamedTuple):
    kept: DataFrame
    dropped: DataFrame
    counts: DataFrame


def clean_catalogue(df: DataFrame, key: str = "doc_id", title: str = "title", seq: str = "seq") -> CleanCatalogue:
    """Drop rows without a key, then later rows of a key, then later rows of a title; report what went and why."""
    staged = materialize(hy.staged_catalogue(df, key, title, seq), "staged")  # kept, dropped and counts all read it
    kept = staged.filter(F.col("stage") == "kept").drop("stage")
    return CleanCatalogue(kept, staged.filter(F.col("stage") != "kept"), hy.stage_counts(staged))
