"""Word-list features.

Fixed lists are compared inside the row. Lists that live in a table are joined to the row's term counts:
the join is a broadcast only if the list is seen to be small, and only matching terms are aggregated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiframe.functions import readability as rd
from lexiframe.functions import tokens as tk
from lexiframe.functions import wordlists as wl
from lexiframe.operators.automaton import category_hits
from lexiframe.operators.term_blocks import Entries, lists, matrix, term_blocks, whole
from lexiframe.session import lookup_join

Features = dict[str, Column]
MAX_LISTED_TERMS = 2_000
VECTOR_BLOCK_TERMS = 1_000_000


def token_share(tokens: Column, items: list[str], total: Column) -> Column:
    hits = F.size(F.filter(tokens, lambda t: t.isin(sorted(set(items)))))
    return rd.zero_default(rd.ratio(hits, total) * 100.0)


def narrative_features() -> Features:
    return {
        name: token_share(F.col("_listed"), items, F.col("_n_tokens")) for name, items in wl.NARRATIVE_WORDS.items()
    }


def dialogue_feature(text: str = "text") -> Features:
    from lexiframe.operators.stylometry import count_marks

    verbs = F.size(F.filter("_listed", lambda t: t.isin(sorted(wl.SPEECH_VERBS))))
    marks = count_marks(F.col(text), ['"', "'"])
    return {"dialogue_markers": rd.zero_default(rd.ratio(marks + verbs, F.col("_n_tokens")) * 100.0)}


def substring_rates(
    lists: dict[str, list[str]], suffix: str, per: float = 1000.0, at_least: float | None = None, hits: Column | None = None
) -> Features:
    """Occurrences of each list's terms anywhere in the text, per ``per`` words. ``at_least`` bounds the number of units
    from below; ``hits`` are the counts where they are known already.

    Needs ``_lower`` and ``_words``, as made by ``with_parts``. All terms are found in one pass over the text.
    """
    words = F.size("_words")
    units = F.greatest(words, F.lit(1)) / per if at_least is None else F.greatest(words / per, F.lit(at_least))
    hits = category_hits(F.col("_lower"), lists) if hits is None else hits
    return {name.lower() + suffix: hits[i] / units for i, name in enumerate(lists)}


def token_rates(lists: dict[str, list[str]], suffix: str = "_marker_freq") -> Features:
    """Share of letter tokens that equal a listed marker, in percent."""
    letters = F.col("_letters")
    return {name + suffix: token_share(letters, items, F.size(letters)) for name, items in lists.items()}


def lexicon_table(spark, lists: dict[str, list[str]]) -> DataFrame:
    rows = [(c, t) for c, terms in lists.items() for t in terms]
    return spark.createDataFrame(rows, "category string, term string")


def expand_terms(
    seeds: DataFrame, relations: DataFrame, max_sense: int = 3, depth: int = 1
) -> DataFrame:
    """Seed terms, the synonyms of their first senses and, for ``depth`` > 0, those senses' hypernyms.

    ``seeds(category, term)``, ``relations(term, sense_rank, relation, related)``; result is distinct.
    """
    kinds = ["synonym", "hypernym"] if depth > 0 else ["synonym"]
    near = relations.filter((F.col("sense_rank") <= max_sense) & F.col("relation").isin(kinds))
    related = lookup_join(near, seeds, "term").select(
        "category", F.replace(F.lower("related"), F.lit("_"), F.lit(" ")).alias("term")
    )
    return seeds.select("category", "term").union(related).distinct()


def lexicon_lists(lexicon: DataFrame) -> dict[str, list[str]]:
    """Term lists by category, for jobs that make a column of every term; ``automaton.with_lexicon_hits`` takes tables."""
    lists: dict[str, list[str]] = {}
    for row in sorted(lexicon.select("category", "term").collect()):
        lists.setdefault(row["category"], []).append(row["term"])
    return lists


def term_rows(docs: DataFrame, tokens: Column, key: str = "doc_id") -> DataFrame:
    """``(key, term, tf)`` without a shuffle."""
    return docs.select(key, F.inline(tk.counted(tokens)))


def kept_rows(docs: DataFrame, tokens: Column, vocabulary: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, term, tf)`` of the terms in ``vocabulary`` alone.

    Up to ``MAX_LISTED_TERMS`` terms are a constant that drops the other tokens before they are counted; a larger
    vocabulary is joined to the counts, with the same rows.
    """
    terms = vocabulary.select("term").distinct()
    listed = [r["term"] for r in terms.limit(MAX_LISTED_TERMS + 1).collect()]
    if len(listed) > MAX_LISTED_TERMS:
        return lookup_join(term_rows(docs, tokens, key), terms, "term")
    return docs.select(key, F.inline(tk.counted(F.filter(tokens, lambda t: t.isin(sorted(listed))))))


def vocabulary_counts(terms: DataFrame, vocabulary: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of vocabulary terms and their share among the document's vocabulary hits."""
    hits = lookup_join(terms, vocabulary.select("term").distinct(), "term")
    total = F.sum("tf").over(Window.partitionBy(key))
    return hits.select(key, "term", "tf", (F.col("tf") / total).alias("share"))


def category_scores(terms: DataFrame, lexicon: DataFrame, categories: list[str], key: str = "doc_id") -> DataFrame:
    """Per category, the sum of the document's L2-normalized lexicon counts; one row per document with a hit."""
    by_term = lexicon.groupBy("term").agg(F.collect_list("category").alias("_in"))
    hits = lookup_join(terms, by_term, "term")
    norm = F.sqrt(F.sum(F.col("tf") * F.col("tf")))

    def total(category: str) -> Column:
        times = F.size(F.filter("_in", lambda c: c == category))
        return F.sum(F.col("tf") * times) / norm

    return hits.groupBy(key).agg(*[total(c).alias(f"{c}_term_score") for c in categories])


def sentiment(
    docs: DataFrame,
    lexicon: DataFrame,
    key: str = "doc_id",
    tokens: str = "tokens",
    negations: tuple[str, ...] = ("no", "not", "never", "nor", "without"),
) -> DataFrame:
    """Mean polarity and subjectivity of the lexicon words of a text; a negation before a word turns it by -0.5."""
    def pairs(ts: Column) -> Column:
        return F.transform(
            ts,
            lambda t, i: F.struct(
                t.alias("term"),
                F.when(i > 0, F.get(ts, i - 1)).isin(list(negations)).alias("negated"),
            ),
        )

    words = docs.select(key, F.inline(tk.let(F.col(tokens), pairs)))
    hits = lookup_join(words, lexicon, "term")
    sign = F.when(F.col("negated"), -0.5).otherwise(1.0)
    scores = hits.groupBy(key).agg(
        F.avg(F.col("polarity") * sign).alias("sentiment_polarity"), F.avg("subjectivity").alias("sentiment_subjectivity")
    )
    return docs.select(key).join(scores, key, "left").fillna(0.0)


def mean_vectors(
    terms: DataFrame, vectors: DataFrame, documents: DataFrame, dims: int, key: str = "doc_id"
) -> DataFrame:
    """Mean word vector of a text over its tokens that have one; zeros if none has.

    Blocks of documents meet the vectors of their own terms: a vector is shuffled once per block and term, not per document.
    Missing numbers count as zeros; a term listed more than once counts with each of its vectors.
    """
    sums = F.array(*[F.coalesce(F.sum(F.get("vector", F.lit(j))), F.lit(0.0)) for j in range(dims)])
    listed = vectors.groupBy("term").agg(sums.alias("vector"), F.count("*").alias("times"))
    docs = terms.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct("term", "tf")).alias("bag"))  # a document's own terms

    def work(rows: pa.Table, known: pa.Table) -> pa.Table:
        keys = whole(rows, key)
        if not rows.num_rows or not known.num_rows:
            return pa.table([keys[:0], pa.array([], pa.list_(pa.float64()))], names=[key, "_m"])
        entries = Entries.of(rows, known)
        state = np.column_stack([matrix(known, "vector"), whole(known, "times").to_numpy()])
        each = (np.bincount(entries.doc, entries.weight * column[entries.at], rows.num_rows) for column in state.T)
        found = np.column_stack(list(each))  # a column at a time: a block's entries times all columns would be too much
        full = found[:, -1] > 0
        return pa.table([keys.filter(pa.array(full)), lists(found[full, :-1] / found[full, -1:])], names=[key, "_m"])

    blocks = term_blocks(docs, F.col("bag"), key, VECTOR_BLOCK_TERMS)
    means = blocks.met(listed, work, f"`{key}` {terms.schema[key].dataType.simpleString()}, _m array<double>")
    zeros = F.array_repeat(F.lit(0.0), dims)
    joined = documents.select(key).join(means, key, "left")
    return joined.select(key, F.coalesce("_m", zeros).alias("vector"))
