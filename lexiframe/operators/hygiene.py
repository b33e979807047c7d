"""Row hygiene: blank keys, keep-first dedup, stage counts, column dropping, null filling, label codes.

Keep-first dedup finds the first row of every key with a pre-aggregating ``min`` and then joins on the row
number ``seq``, which is unique. No window or join ever runs on the duplicated key, so a key that holds a
third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.session import lookup_join

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def has_key(col: str) -> Column:
    return F.col(col).isNotNull() & (F.trim(F.col(col).cast("string")) != "")


def drop_blank_key(df: DataFrame, col: str) -> DataFrame:
    return df.filter(has_key(col))


def first_rows(df: DataFrame, key: str, seq: str) -> DataFrame:
    """``seq`` of the first row of every key."""
    return df.groupBy(key).agg(F.min(seq).alias(seq)).select(seq)


def keep_first(df: DataFrame, key: str, seq: str) -> DataFrame:
    return df.join(first_rows(df, key, seq), seq, "left_semi")


def duplicates(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Rows with an earlier row of the same key."""
    return df.join(first_rows(df, key, seq), seq, "left_anti")


def staged_catalogue(df: DataFrame, key: str, title: str, seq: str) -> DataFrame:
    """Add ``stage``: blank, dup_key, dup_title or kept. The title stage sees only rows that passed the key stage."""
    firsts = (
        drop_blank_key(df, key).groupBy(key).agg(F.min(F.struct(F.col(seq), F.col(title))).alias("_row")).select("_row.*")
    )
    # One row per surviving key; mark the first row of every title among them.
    kept = firsts.groupBy(title).agg(F.min(seq).alias(seq)).select(seq, F.lit(True).alias("_kept"))
    passed = firsts.select(seq, F.lit(True).alias("_passed"))
    marked = df.join(passed, seq, "left").join(kept, seq, "left")
    stage = (
        F.when(~F.coalesce(has_key(key), F.lit(False)), "blank")
        .when(F.col("_kept"), "kept")
        .when(F.col("_passed"), "dup_title")
        .otherwise("dup_key")
    )
    return marked.withColumn("stage", stage).drop("_kept", "_passed")


def stage_counts(staged: DataFrame) -> DataFrame:
    """Rows left after each stage, from one aggregate."""

    def left(*gone: str) -> Column:
        return F.count_if(~F.col("stage").isin(*gone)) if gone else F.count(F.lit(1))

    return staged.agg(
        left().alias("n_initial"),
        left("blank").alias("n_with_key"),
        left("blank", "dup_key").alias("n_unique_key"),
        left("blank", "dup_key", "dup_title").alias("n_unique_title"),
    )


def filter_if_present(df: DataFrame, flag: str) -> DataFrame:
    """Keep rows whose flag is true; a table without the flag passes unchanged."""
    return df.filter(F.col(flag)) if flag in df.columns else df


def head(df: DataFrame, seq: str, n: int | None) -> DataFrame:
    return df if n is None else df.orderBy(seq).limit(n)


def numeric_columns(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES and c not in exclude]


def fill_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null and NaN to 0 in numeric columns."""
    return df.fillna(0, subset=numeric_columns(df) if cols is None else cols)


def hstack(blocks: list[DataFrame], key: str) -> DataFrame:
    """Put blocks of columns side by side by key; the first block decides which rows exist."""
    out = blocks[0]
    for block in blocks[1:]:
        out = out.join(block, key, "left")
    return out


def label_codes(df: DataFrame, label: str, code: str = "label_code") -> DataFrame:
    """Alphabetical code per distinct label. The window only sees one row per class."""
    classes = df.filter(F.col(label).isNotNull()).select(label).distinct()
    return classes.withColumn(code, (F.row_number().over(Window.orderBy(F.col(label))) - 1).cast("int"))


def encode_labels(df: DataFrame, label: str, code: str = "label_code") -> DataFrame:
    return lookup_join(df, label_codes(df, label, code), label, "left")
