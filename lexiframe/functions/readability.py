"""Readability indices over per-document counts. A document without words or sentences scores 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_default(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` as double, null where ``b`` is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def flesch(n_words: Column, n_sentences: Column, n_syllables: Column) -> Column:
    return zero_default(206.835 - 1.015 * ratio(n_words, n_sentences) - 84.6 * ratio(n_syllables, n_words))


def fog(n_words: Column, n_sentences: Column, n_complex: Column) -> Column:
    return zero_default(0.4 * (ratio(n_words, n_sentences) + 100.0 * ratio(n_complex, n_words)))


def smog(n_words: Column, n_sentences: Column, n_complex: Column) -> Column:
    scored = 1.043 * F.sqrt(30.0 * ratio(n_complex, n_sentences)) + 3.1291
    return zero_default(F.when(n_words > 0, scored))


def automated_readability(n_words: Column, n_sentences: Column, n_letters: Column) -> Column:
    return zero_default(4.71 * ratio(n_letters, n_words) + 0.5 * ratio(n_words, n_sentences) - 21.43)


def coleman_liau(n_words: Column, n_sentences: Column, n_letters: Column) -> Column:
    return zero_default(
        0.0588 * (100.0 * ratio(n_letters, n_words)) - 0.296 * (100.0 * ratio(n_sentences, n_words)) - 15.8
    )


def dale_chall(n_words: Column, n_sentences: Column, n_difficult: Column) -> Column:
    share = ratio(n_difficult, n_words)
    return zero_default(
        0.1579 * (100.0 * share) + 0.0496 * ratio(n_words, n_sentences) + F.when(share > 0.05, 3.6365).otherwise(0.0)
    )
