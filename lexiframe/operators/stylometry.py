"""Per-document style features. Each is an expression over the row's own text: no explode, no shuffle.

``with_parts`` splits a text once; every feature group below reads those parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.functions import readability as rd
from lexiframe.functions import tokens as tk
from lexiframe.functions import wordlists as wl
from lexiframe.functions.syllables import syllables, syllables_refined

Features = dict[str, Column]

# Punctuation counted per 10,000 characters and per sentence.
MARKS_PER_LENGTH = {
    "exclamation_marks": ["!"],
    "question_marks": ["?"],
    "semicolons": [";"],
    "colons": [":"],
    "ellipses": ["..."],
    "dashes": ["—", "--"],
    "parentheses": ["(", ")"],
}
MARKS_PER_SENTENCE = {
    "exclamation_marks": ["!"],
    "question_marks": ["?"],
    "semicolons": [";"],
    "colons": [":"],
    "ellipses": ["...", ". . ."],
    "dashes": ["—", "--", "–"],
}


def with_parts(docs: DataFrame, text: str = "text", paragraph_separator: str = "\n\n") -> DataFrame:
    """Add the parts of the text that the features share, under names with a leading underscore."""
    t, low = F.col(text), F.col("_lower")
    listed = sorted({w for words in wl.NARRATIVE_WORDS.values() for w in words} | set(wl.SPEECH_VERBS))
    split = docs.withColumn("_lower", F.lower(t)).withColumns(
        {
            "_sentences": tk.sentences(t),
            "_words": tk.words(low),
            "_letters": tk.letter_tokens(low, lower=False),
            "_tokens": tk.all_tokens(low),
            "_paragraph_words": F.transform(tk.paragraphs(t, paragraph_separator), tk.n_words),
        }
    )
    return split.withColumns(
        {
            "_sentence_words": F.transform("_sentences", tk.n_words),
            "_n_tokens": F.size("_tokens"),
            "_listed": F.filter("_tokens", lambda w: w.isin(listed)),
        }
    )


def without_parts(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def mean_of(values: Column) -> Column:
    def mean(vs: Column) -> Column:  # bound: values worked out for their sum would be worked out again for their number
        total = F.aggregate(vs, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
        return F.try_divide(total, F.size(vs).cast("double"))

    return tk.let(values, mean)


def variance_of(values: Column) -> Column:
    """Population variance."""
    return tk.let(
        values,
        lambda vs: tk.let(mean_of(vs), lambda m: mean_of(F.transform(vs, lambda v: (v - m) * (v - m)))),
    )


def median_of(values: Column) -> Column:
    def middle(vs: Column) -> Column:
        n = F.size(vs)
        return (F.get(vs, F.floor((n - 1) / 2).cast("int")) + F.get(vs, F.floor(n / 2).cast("int"))) / 2.0

    return tk.let(F.sort_array(values), middle)


def count_marks(text: Column, marks: list[str]) -> Column:
    """Occurrences of any of the marks, without overlap, from the bytes that removing them saves."""
    return sum(
        (
            ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(m), F.lit("")))) / len(m.encode())).cast("bigint")
            for m in marks
        ),
        F.lit(0).cast("bigint"),
    )


def sentence_length_features() -> Features:
    n = F.col("_sentence_words")
    return {
        "avg_sentence_length": rd.zero_default(mean_of(n)),
        "var_sentence_length": rd.zero_default(variance_of(n)),
        "max_sentence_length": rd.zero_default(F.array_max(n).cast("double")),
        "median_sentence_length": rd.zero_default(median_of(n)),
    }


def with_syllable_counts(parts: DataFrame, refined: bool = False) -> DataFrame:
    count = syllables_refined if refined else syllables
    return parts.withColumn("_syllables", F.transform("_words", lambda w: count(w, lowered=True)))


def readability_features(refined: bool = False, stop_words: list[str] | None = None) -> Features:
    """Needs ``with_syllable_counts``. The refined set adds three indices."""
    words, sents = F.size("_words"), F.size("_sentences")
    total = F.aggregate("_syllables", F.lit(0), lambda acc, s: acc + s)
    hard = F.size(F.filter("_syllables", lambda s: s > 2))
    found = {
        "flesch_reading_ease": rd.flesch(words, sents, total),
        "gunning_fog": rd.fog(words, sents, hard),
        "smog_index": rd.smog(words, sents, hard),
    }
    if refined:
        letters = F.aggregate("_words", F.lit(0), lambda acc, w: acc + F.length(w))
        stops = sorted(set(wl.stop_words() if stop_words is None else stop_words))
        types = F.array_distinct("_words")
        difficult = F.size(F.filter(types, lambda w: ~w.isin(stops) & (syllables_refined(w, lowered=True) > 2)))
        found |= {
            "automated_readability_index": rd.automated_readability(words, sents, letters),
            "coleman_liau_index": rd.coleman_liau(words, sents, letters),
            "dale_chall": tk.let(difficult, lambda d: rd.dale_chall(words, sents, d)),
        }
    return found


def syllable_mean_feature() -> Features:
    return {"avg_syllables_per_word": rd.zero_default(mean_of(F.transform("_letters", lambda w: syllables(w, lowered=True))))}


def punctuation_by_length(text: str = "text") -> Features:
    unit = F.greatest(F.length(text) / 10000.0, F.lit(1.0))
    return {name: count_marks(F.col(text), marks) / unit for name, marks in MARKS_PER_LENGTH.items()}


def punctuation_by_sentence(text: str = "text") -> Features:
    unit = F.greatest(F.size("_sentences"), F.lit(1))
    return {name: count_marks(F.col(text), marks) / unit for name, marks in MARKS_PER_SENTENCE.items()}


def sentence_shape_features() -> Features:
    n = F.col("_sentence_words")

    def share(test) -> Column:
        return rd.zero_default(rd.ratio(F.size(F.filter(n, test)), F.size(n)) * 100.0)

    return {"sentence_fragments": share(lambda x: x < 5), "complex_sentences": share(lambda x: x > 30)}


def paragraph_features() -> Features:
    n = F.col("_paragraph_words")
    return {
        "avg_paragraph_length": rd.zero_default(mean_of(n)),
        "var_paragraph_length": rd.zero_default(variance_of(n)),
    }


def type_token_ratio(tokens: Column) -> Column:
    return rd.zero_default(rd.ratio(F.size(F.array_distinct(tokens)), F.size(tokens)))


def moving_type_token_ratio(tokens: Column, window: int = 1000) -> Column:
    """Mean type-token ratio of windows half a window apart; a short text is its own window."""

    def windows(ts: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ts) - window - 1, F.lit(window // 2))
        return mean_of(
            F.transform(starts, lambda i: F.size(F.array_distinct(F.slice(ts, i + 1, window))) / float(window))
        )

    return tk.let(tokens, lambda ts: F.when(F.size(ts) > window, windows(ts)).otherwise(type_token_ratio(ts)))


def diversity_features(window: int = 1000) -> Features:
    return {
        "type_token_ratio": type_token_ratio(F.col("_letters")),
        "mattr": moving_type_token_ratio(F.col("_letters"), window),
    }


def capitalized_feature() -> Features:
    """Capitalized words that do not begin a sentence, per 100 tokens."""

    def inner(sentence: Column) -> Column:
        found = F.filter(tk.letter_tokens(sentence, lower=False), lambda w, i: (i > 0) & w.rlike(r"^\p{Lu}"))
        return F.size(found)

    total = F.aggregate(F.transform("_sentences", inner), F.lit(0), lambda acc, n: acc + n)
    return {"capitalized_words": rd.zero_default(rd.ratio(total, F.col("_n_tokens")) * 100.0)}


def style_features(text: str = "text") -> Features:
    """All features that need nothing but the text and the fixed word lists."""
    from lexiframe.operators import lexicons as lx

    return {
        **sentence_length_features(),
        **syllable_mean_feature(),
        **punctuation_by_length(text),
        **lx.narrative_features(),
        **lx.dialogue_feature(text),
        **readability_features(),
        **sentence_shape_features(),
        **lx.substring_rates(wl.ERA_MARKERS, "_markers", per=1000.0, at_least=1.0),
        **lx.substring_rates(wl.CATEGORY_WORDS, "_words", per=1000.0),
        **capitalized_feature(),
        **paragraph_features(),
        **diversity_features(),
    }


def style_record(
    docs: DataFrame, key: str = "doc_id", text: str = "text", paragraph_separator: str = "\n\n"
) -> DataFrame:
    """One row of style features per document, from one pass over its text."""
    parts = with_syllable_counts(with_parts(docs, text, paragraph_separator))
    return parts.select(key, *[c.alias(name) for name, c in style_features(text).items()])
