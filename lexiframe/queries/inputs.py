"""Input tables of the registered queries, and the SQL snippets that both engines share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.sources.readers import read_table, spread

DIGITS = 6


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(read_table(spark, folder, "documents"), "doc_id")


def rounded(value: Column, digits: int = DIGITS) -> Column:
    return F.round(value, digits)


def rounded_columns(df: DataFrame, keep: list[str], digits: int = DIGITS) -> DataFrame:
    """Round every column but the ``keep`` ones, as doubles."""
    return df.select(
        *keep, *[F.round(F.col(f"`{c}`").cast("double"), digits).alias(c) for c in df.columns if c not in keep]
    )


def rnd(sql: str, digits: int = DIGITS) -> str:
    """SQL: rounded double without a negative zero."""
    return f"round(CAST({sql} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE)"


def quoted(items) -> str:
    return ", ".join("'" + str(i).replace("'", "''") + "'" for i in items)


def text_literal(value: str) -> str:
    """SQL string expression for a text with line ends."""
    parts = []
    for i, piece in enumerate(value.split("\n")):
        if i:
            parts.append("chr(10)")
        if piece:
            parts.append("'" + piece.replace("'", "''") + "'")
    return "concat(" + ", ".join(parts or ["''"]) + ")"


# A catalogue derived from the documents: blank keys, repeated keys and repeated titles all occur.
CATALOGUE_EXPRS = [
    "doc_id AS seq",
    "CASE WHEN lang = 'es' THEN NULL WHEN lang = 'de' THEN '  ' "
    "ELSE concat(source, ':', substring(cast(length(text) AS string), 1, 2)) END AS book_id",
    "md5(text) AS title",
    "source AS author",
    "lang AS movement",
]
CATALOGUE_SQL = f"SELECT {', '.join(CATALOGUE_EXPRS)} FROM documents"


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").selectExpr(*CATALOGUE_EXPRS)
