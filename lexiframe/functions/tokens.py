"""Sentences, words and n-grams of one text as array expressions: no explode and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's ``str.split`` takes for blanks: ASCII ones, separators and all Unicode blanks.
BLANKS = r"\t-\r\x1c-\x20\x85\p{Z}"
# Tried at the first mark of a run alone and possessive, so a long run of marks is read once.
SENTENCE_END = r"""((?<![.!?])[.!?]++["')\]]*+)[""" + BLANKS + "]++"
LETTERS = r"\p{L}+"
WORD_CHARS = r"[\p{L}\p{N}_]{2,}"
ANY_TOKEN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]"
_MARK = "\u0001"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside a lambda.

    Spark evaluates whatever a lambda refers to anew for each element, so anything costly is bound first.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def positions(array: Column) -> Column:
    """``0 .. size - 1`` of an array; empty for an empty one."""
    none = F.array().cast("array<int>")
    return F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(none)


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def sentences(text: Column) -> Column:
    marked = F.regexp_replace(text, SENTENCE_END, "$1" + _MARK)
    return F.filter(F.split(marked, _MARK), lambda s: s.rlike(f"[^{BLANKS}]"))


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{BLANKS}]+"))


def letter_tokens(text: Column, lower: bool = True) -> Column:
    return _all(F.lower(text) if lower else text, LETTERS)


def word_char_tokens(text: Column) -> Column:
    return _all(F.lower(text), WORD_CHARS)


def all_tokens(text: Column) -> Column:
    return _all(text, ANY_TOKEN)


def n_all_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(ANY_TOKEN))


def without(tokens: Column, stop_words: list[str], min_length: int = 1) -> Column:
    """Drop stop words, and tokens shorter than ``min_length``."""
    stops = sorted(set(stop_words))
    if min_length > 1:
        return F.filter(tokens, lambda t: (F.length(t) >= min_length) & ~t.isin(stops))
    return F.filter(tokens, lambda t: ~t.isin(stops))


def sentence_tokens(text: Column, stop_words: list[str], more_than: int = 2, lower: bool = True) -> Column:
    """Content words per sentence; sentences with at most ``more_than`` of them are dropped."""
    stops = sorted(set(stop_words))

    def content(sentence: Column) -> Column:
        if lower:
            return F.filter(letter_tokens(sentence), lambda t: ~t.isin(stops))
        return F.filter(letter_tokens(sentence, lower=False), lambda t: ~F.lower(t).isin(stops))

    return F.filter(F.transform(sentences(text), content), lambda s: F.size(s) > more_than)


def paragraphs(text: Column, separator: str = "\n\n") -> Column:
    return F.filter(F.split(text, separator), lambda p: p.rlike(r"\S"))


def ngrams(tokens: Column, n: int, joiner: str = " ") -> Column:
    """All runs of ``n`` neighbouring tokens, in order."""
    if n == 1:
        return tokens
    return let(tokens, lambda ts: _longer(ts, ngrams(ts, n - 1, joiner), n, joiner))


def _longer(ts: Column, shorter: Column, n: int, joiner: str) -> Column:
    """Runs of ``n`` tokens: each run of ``n - 1``, bar the last, with the token that follows it."""
    count = F.greatest(F.size(ts) - (n - 1), F.lit(0))
    runs = F.zip_with(F.slice(shorter, 1, count), F.slice(ts, n, count), lambda run, t: F.concat_ws(joiner, run, t))
    return F.coalesce(runs, F.array().cast("array<string>"))


def ngrams_upto(tokens: Column, n: int, joiner: str = " ") -> Column:
    def upto(ts: Column, runs: Column, j: int, found: list[Column]) -> Column:
        if j == n:
            return F.concat(*found, runs)
        return let(_longer(ts, runs, j + 1, joiner), lambda longer: upto(ts, longer, j + 1, [*found, runs]))

    return let(tokens, lambda ts: upto(ts, ts, 1, []))


def counted(tokens: Column) -> Column:
    """Distinct tokens with their counts, ``array<struct<term, tf>>``, from one sort inside the row.

    Doing this in the row keeps the document-term matrix free of a shuffle over all tokens.
    """

    def runs(ts: Column, heads: Column) -> Column:
        return F.transform(
            heads,
            lambda h, j: F.struct(
                F.get(ts, h).alias("term"),
                (F.coalesce(F.get(heads, j + 1), F.size(ts)) - h).cast("bigint").alias("tf"),
            ),
        )

    def heads_of(ts: Column) -> Column:
        return F.filter(positions(ts), lambda i: (i == 0) | (F.get(ts, i) != F.get(ts, i - 1)))

    return let(F.sort_array(tokens), lambda ts: let(heads_of(ts), lambda heads: runs(ts, heads)))


def merged_pairs(tokens: Column, pairs: Column, joiner: str = "_", few_pairs: int = 32) -> Column:
    """Join neighbouring tokens whose ``a_b`` form is in ``pairs``: left to right, no token used twice."""

    def joined(ts: Column, i: Column) -> Column:
        return F.concat_ws(joiner, F.get(ts, i), F.get(ts, i + 1))

    def flags_by_search(ts: Column, ps: Column) -> Column:
        return F.array_join(
            F.transform(
                positions(ts),
                lambda i: F.when((i < F.size(ts) - 1) & F.array_contains(ps, joined(ts, i)), "1").otherwise("0"),
            ),
            "",
        )

    def flags_by_sort(ts: Column, ps: Column) -> Column:
        """The same for many pairs: pairs and positions sorted together, so no pair list is searched per token."""
        listed = F.transform(F.array_distinct(ps), lambda p: F.struct(p.alias("pair"), F.lit(-1).alias("at")))
        at = F.filter(positions(ts), lambda i: i < F.size(ts) - 1)
        found = F.transform(at, lambda i: F.struct(joined(ts, i).alias("pair"), i.alias("at")))

        def hits(both: Column) -> Column:
            heads = F.filter(positions(both), lambda i: (i == 0) | (F.get(both, i)["pair"] != F.get(both, i - 1)["pair"]))

            def run(h: Column, following: Column) -> Column:
                return F.transform(
                    F.slice(both, h + 2, F.coalesce(following, F.size(both)) - h - 1), lambda e: e["at"]
                )

            listed_runs = let(
                heads,
                lambda hs: F.transform(
                    hs,
                    lambda h, j: F.when(F.get(both, h)["at"] == -1, run(h, F.get(hs, j + 1))).otherwise(
                        F.array().cast("array<int>")
                    ),
                ),
            )
            return F.sort_array(F.flatten(listed_runs))

        def written(hs: Column) -> Column:
            ones = F.transform(
                hs, lambda h, j: F.concat(F.repeat(F.lit("0"), h - F.coalesce(F.get(hs, j - 1), F.lit(-1)) - 1), F.lit("1"))
            )
            last = F.coalesce(F.get(hs, F.size(hs) - 1), F.lit(-1))
            return F.concat(F.array_join(ones, ""), F.repeat(F.lit("0"), F.size(ts) - last - 1))

        return let(let(F.sort_array(F.concat(listed, found)), hits), written)

    def flags(ts: Column, ps: Column) -> Column:
        return F.when(F.size(ps) <= few_pairs, flags_by_search(ts, ps)).otherwise(flags_by_sort(ts, ps))

    def rebuilt(ts: Column, roles: Column) -> Column:
        return F.transform(
            F.filter(positions(ts), lambda i: F.get(roles, i) != "S"),
            lambda i: F.when(F.get(roles, i) == "M", joined(ts, i)).otherwise(F.get(ts, i)),
        )

    def roles_of(ts: Column, ps: Column) -> Column:
        # One pass of a regular expression over the flags takes pairs greedily and without overlap.
        return F.split(F.regexp_replace(flags(ts, ps), "1[01]", "MS"), "")

    return let(
        tokens, lambda ts: let(pairs, lambda ps: let(roles_of(ts, ps), lambda roles: rebuilt(ts, roles)))
    )
