"""Stylometry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiframe.functions import tokens as tk
from lexiframe.functions import wordlists as wl
from lexiframe.operators import stylometry as sty
from lexiframe.operators import tagged as tg
from lexiframe.queries import register, sqltext as st
from lexiframe.queries.inputs import documents, quoted, rnd, rounded_columns

# Parts of a text in SQL: sentences s, words w, lower-cased letter tokens a, all tokens k, paragraph words p.
PARTS = rf"""parts AS (SELECT doc_id, text, {st.sentences('text')} AS s, {st.words('lower(text)')} AS w,
    {st.letters('lower(text)')} AS a, {st.all_tokens('lower(text)')} AS k,
    list_transform(list_filter(string_split(text, chr(10)), lambda z: regexp_matches(z, '\S')),
                   lambda z: {st.n_words('z')}) AS p FROM documents),
    sized AS (SELECT *, list_transform(s, lambda z: {st.n_words('z')}) AS sl FROM parts)"""


def parts(spark, folder):
    return sty.with_parts(documents(spark, folder), paragraph_separator="\n")


def _select(df, features):
    return rounded_columns(df.select("doc_id", *[c.alias(n) for n, c in features.items()]), ["doc_id"])


def zero(sql: str) -> str:
    return rnd(f"coalesce({sql}, 0)")


def feature_sql(features: dict[str, str], source: str = "sized") -> str:
    """``features`` maps names to SQL over the parts."""
    return "SELECT doc_id, " + ", ".join(f'{zero(e)} AS "{n}"' for n, e in features.items()) + f" FROM {source}"


SENTENCE_SQL = {
    "avg_sentence_length": "list_avg(sl)",
    "var_sentence_length": "list_aggregate(CAST(sl AS DOUBLE[]), 'var_pop')",
    "max_sentence_length": "list_max(sl)",
    "median_sentence_length": "list_median(sl)",
}


@register("f01_sentence_lengths", f"WITH {PARTS} {feature_sql(SENTENCE_SQL)}")
def sentence_lengths(spark, folder):
    return _select(parts(spark, folder), sty.sentence_length_features())


def read_sql(refined: bool) -> str:
    syl = st.syllables_refined("z") if refined else st.syllables("z")
    hard_types = f"len(list_filter(list_distinct(list_transform(w, lambda z: lower(z))), lambda z: ({syl}) > 2 AND z NOT IN ({st.STOPS_SQL})))"
    extra = f", {hard_types} AS d" if refined else ""
    return f"""counts AS (SELECT doc_id, CAST(len(w) AS DOUBLE) AS nw, CAST(len(s) AS DOUBLE) AS ns,
        CAST(list_sum(list_transform(w, lambda z: {syl})) AS DOUBLE) AS ny,
        CAST(len(list_filter(w, lambda z: ({syl}) > 2)) AS DOUBLE) AS nc,
        CAST(list_sum(list_transform(w, lambda z: length(z))) AS DOUBLE) AS nl {extra} FROM sized)"""


INDEX_SQL = {
    "flesch_reading_ease": "206.835::DOUBLE - 1.015::DOUBLE * (nw / nullif(ns, 0)) - 84.6::DOUBLE * (ny / nullif(nw, 0))",
    "gunning_fog": "0.4::DOUBLE * (nw / nullif(ns, 0) + 100 * nc / nullif(nw, 0))",
    "smog_index": "CASE WHEN nw > 0 THEN 1.043::DOUBLE * sqrt(30 * nc / nullif(ns, 0)) + 3.1291::DOUBLE END",
    "automated_readability_index": "4.71::DOUBLE * (nl / nullif(nw, 0)) + 0.5::DOUBLE * (nw / nullif(ns, 0)) - 21.43::DOUBLE",
    "coleman_liau_index": "0.0588::DOUBLE * (nl / nullif(nw, 0) * 100) - 0.296::DOUBLE * (ns / nullif(nw, 0) * 100) - 15.8::DOUBLE",
    "dale_chall": "0.1579::DOUBLE * (100 * d / nullif(nw, 0)) + 0.0496::DOUBLE * (nw / nullif(ns, 0)) "
    "+ CASE WHEN d / nullif(nw, 0) > 0.05 THEN 3.6365::DOUBLE ELSE 0 END",
}


def _index(spark, folder, names, refined=False):
    scored = sty.with_syllable_counts(parts(spark, folder), refined)
    found = sty.readability_features(refined)
    return _select(scored, {n: found[n] for n in names})


def _register_index(query: str, names: list[str], refined: bool = False) -> None:
    sql = f"WITH {PARTS}, {read_sql(refined)} {feature_sql({n: INDEX_SQL[n] for n in names}, 'counts')}"
    register(query, sql)(lambda spark, folder: _index(spark, folder, names, refined))


_register_index("f02_flesch_reading_ease", ["flesch_reading_ease"])
_register_index("f03_gunning_fog", ["gunning_fog"])
_register_index("f04_smog", ["smog_index"])
_register_index("f05_automated_readability", ["automated_readability_index"], refined=True)
_register_index("f06_coleman_liau", ["coleman_liau_index"], refined=True)
_register_index("f07_dale_chall", ["dale_chall"], refined=True)

# Texts stripped of letters have no words, so every index falls back to zero for them.
BARE = "regexp_replace(text, '[a-zA-Z.,]+', '', 'g')"


@register(
    "f08_readability_zero_default",
    f"""WITH documents AS (SELECT turn + conv_id * 1000 AS doc_id, {BARE} AS text FROM conversations), {PARTS},
        {read_sql(True)} {feature_sql(INDEX_SQL, 'counts')}""",
)
def readability_zero_default(spark, folder):
    from lexiframe.sources.readers import read_table

    talk = read_table(spark, folder, "conversations").select(
        (F.col("turn") + F.col("conv_id") * 1000).alias("doc_id"), F.regexp_replace("text", "[a-zA-Z.,]+", "").alias("text")
    )
    scored = sty.with_syllable_counts(sty.with_parts(talk, paragraph_separator="\n"), refined=True)
    return _select(scored, sty.readability_features(refined=True))


@register(
    "f09_syllables_per_word",
    f"WITH {PARTS} {feature_sql({'avg_syllables_per_word': f'list_avg(list_transform(a, lambda z: {st.syllables(chr(122))}))'})}",
)
def syllables_per_word(spark, folder):
    return _select(parts(spark, folder), sty.syllable_mean_feature())


def marks_sql(marks: list[str]) -> str:
    return "(" + " + ".join(st.n_substring("text", m) for m in marks) + ")"


PUNCT_LENGTH_SQL = {
    n: f"{marks_sql(m)} / greatest(length(text) / 10000::DOUBLE, 1)" for n, m in sty.MARKS_PER_LENGTH.items()
}
PUNCT_SENTENCE_SQL = {n: f"{marks_sql(m)} / greatest(len(s), 1)::DOUBLE" for n, m in sty.MARKS_PER_SENTENCE.items()}


@register("f10_punctuation_by_length", f"WITH {PARTS} {feature_sql(PUNCT_LENGTH_SQL)}")
def punctuation_by_length(spark, folder):
    return _select(parts(spark, folder), sty.punctuation_by_length())


@register("f11_punctuation_by_sentence", f"WITH {PARTS} {feature_sql(PUNCT_SENTENCE_SQL)}")
def punctuation_by_sentence(spark, folder):
    return _select(parts(spark, folder), sty.punctuation_by_sentence())


SHAPE_SQL = {
    "sentence_fragments": "len(list_filter(sl, lambda z: z < 5)) / nullif(len(sl), 0)::DOUBLE * 100",
    "complex_sentences": "len(list_filter(sl, lambda z: z > 30)) / nullif(len(sl), 0)::DOUBLE * 100",
}


@register("f12_sentence_shapes", f"WITH {PARTS} {feature_sql(SHAPE_SQL)}")
def sentence_shapes(spark, folder):
    return _select(parts(spark, folder), sty.sentence_shape_features())


PARAGRAPH_SQL = {
    "avg_paragraph_length": "list_avg(p)",
    "var_paragraph_length": "list_aggregate(CAST(p AS DOUBLE[]), 'var_pop')",
}


@register("f13_paragraph_lengths", f"WITH {PARTS} {feature_sql(PARAGRAPH_SQL)}")
def paragraph_lengths(spark, folder):
    return _select(parts(spark, folder), sty.paragraph_features())


TTR_SQL = {"type_token_ratio": "len(list_distinct(a)) / nullif(len(a), 0)::DOUBLE"}
MATTR_SQL = {
    "mattr": "CASE WHEN len(a) > 1000 THEN list_avg(list_transform(range(0, len(a) - 1000, 500), "
    "lambda i: len(list_distinct(a[i + 1:i + 1000])) / 1000::DOUBLE)) "
    "ELSE len(list_distinct(a)) / nullif(len(a), 0)::DOUBLE END"
}


@register("f14_type_token_ratio", f"WITH {PARTS} {feature_sql(TTR_SQL)}")
def type_token_ratio(spark, folder):
    return _select(parts(spark, folder), {"type_token_ratio": sty.type_token_ratio(F.col("_letters"))})


@register("f15_moving_type_token_ratio", f"WITH {PARTS} {feature_sql(MATTR_SQL)}")
def moving_type_token_ratio(spark, folder):
    return _select(parts(spark, folder), {"mattr": sty.moving_type_token_ratio(F.col("_letters"))})


CAPITAL_SQL = {
    "capitalized_words": f"list_sum(list_transform(s, lambda q: len(list_filter(({st.letters('q')})[2:], "
    r"lambda z: regexp_matches(z, '^\p{Lu}'))))) / nullif(len(k), 0)::DOUBLE * 100"
}


@register("f16_capitalized_words", f"WITH {PARTS} {feature_sql(CAPITAL_SQL)}")
def capitalized_words(spark, folder):
    return _select(parts(spark, folder), sty.capitalized_feature())


# ---- tagged tokens: tags derived from the documents by closed word lists and endings -------------------------

POS_EXPR = """CASE
    WHEN NOT regexp_like(token, '^[a-zA-Z]') THEN 'PUNCT'
    WHEN low IN ('the', 'a', 'an', 'le', 'la', 'les', 'der', 'die', 'das', 'el', 'los', 'un', 'une') THEN 'DET'
    WHEN low IN ('and', 'or', 'but', 'et', 'ou', 'und', 'y') THEN 'CCONJ'
    WHEN low IN ('if', 'because', 'while', 'que', 'dass') THEN 'SCONJ'
    WHEN low IN ('of', 'in', 'to', 'for', 'with', 'on', 'at', 'by', 'from', 'de', 'en', 'von', 'mit') THEN 'ADP'
    WHEN low IN ('oh', 'ah', 'alas') THEN 'INTJ'
    WHEN low IN ('he', 'she', 'it', 'they', 'who', 'which', 'that') THEN 'PRON'
    WHEN low IN ('is', 'was', 'are', 'were', 'be') OR low LIKE '%ing' OR low LIKE '%ed' OR low LIKE '%es' THEN 'VERB'
    WHEN low LIKE '%ly' THEN 'ADV'
    WHEN low LIKE '%ous' OR low LIKE '%ble' OR low LIKE '%ive' OR low LIKE '%less' THEN 'ADJ'
    WHEN tok_no > 0 AND token <> low THEN 'PROPN' ELSE 'NOUN' END"""
TAG_EXPR = """CASE WHEN pos <> 'VERB' THEN pos WHEN low IN ('was', 'were') OR low LIKE '%ed' THEN 'VBD'
    WHEN low LIKE '%ing' THEN 'VBG' WHEN low = 'be' THEN 'VB' WHEN low = 'are' THEN 'VBP' ELSE 'VBZ' END"""
DEP_EXPR = """CASE WHEN pos IN ('NOUN', 'PROPN') AND prev = ',' THEN 'appos'
    WHEN pos = 'VERB' AND lower(prev) IN ('who', 'which', 'that') THEN 'relcl' ELSE 'dep' END"""


def tagged(spark, folder):
    sents = documents(spark, folder).select("doc_id", F.posexplode(tk.sentences(F.col("text"))).alias("sent_no", "s"))

    def with_previous(ts):
        return F.transform(
            ts, lambda t, i: F.struct(i.alias("tok_no"), t.alias("token"), F.when(i > 0, F.get(ts, i - 1)).alias("prev"))
        )

    toks = sents.select("doc_id", "sent_no", F.inline(tk.let(tk.all_tokens(F.col("s")), with_previous)))
    classed = toks.withColumn("low", F.lower("token")).selectExpr("*", f"{POS_EXPR} AS pos")
    return classed.selectExpr(
        "doc_id", "sent_no", "tok_no", "token", "pos", f"{TAG_EXPR} AS tag", f"coalesce({DEP_EXPR}, 'dep') AS dep"
    )


TAGGED_SQL = f"""sents AS (SELECT doc_id, unnest(range(len(s))) AS sent_no, unnest(s) AS s
        FROM (SELECT doc_id, {st.sentences('text')} AS s FROM documents)),
    toks AS (SELECT doc_id, sent_no, unnest(range(len(t))) AS tok_no, unnest(t) AS token
        FROM (SELECT doc_id, sent_no, {st.all_tokens('s')} AS t FROM sents)),
    prevs AS (SELECT *, lower(token) AS low, lag(token) OVER (PARTITION BY doc_id, sent_no ORDER BY tok_no) AS prev FROM toks),
    classed AS (SELECT *, {POS_EXPR.replace("regexp_like", "regexp_matches")} AS pos FROM prevs),
    tagged AS (SELECT doc_id, pos, {TAG_EXPR} AS tag, coalesce({DEP_EXPR}, 'dep') AS dep FROM classed)"""


def shares_sql(column: str, groups: dict[str, list[str]], base: str = "TRUE") -> str:
    return ", ".join(
        f"""{zero(f"count(*) FILTER (WHERE {base} AND {column} IN ({quoted(v)})) / nullif(count(*) FILTER (WHERE {base}), 0)::DOUBLE * 100")} AS {n}"""
        for n, v in groups.items()
    )


@register(
    "f17_word_classes",
    f"WITH {TAGGED_SQL} SELECT doc_id, {shares_sql('pos', tg.WORD_CLASSES | tg.WORD_CLASSES_SHORT)} FROM tagged GROUP BY doc_id",
)
def word_classes(spark, folder):
    shares = tg.word_class_shares(tg.WORD_CLASSES | tg.WORD_CLASSES_SHORT)
    return rounded_columns(tg.tagged_features(tagged(spark, folder), shares), ["doc_id"])


TENSE_BASE = "pos = 'VERB'"


@register("f18_verb_tenses", f"WITH {TAGGED_SQL} SELECT doc_id, {shares_sql('tag', tg.TENSES, TENSE_BASE)} FROM tagged GROUP BY doc_id")
def verb_tenses(spark, folder):
    return rounded_columns(tg.tagged_features(tagged(spark, folder), tg.tense_shares()), ["doc_id"])


@register("f19_dependency_labels", f"WITH {TAGGED_SQL} SELECT doc_id, {shares_sql('dep', tg.DEPENDENCIES)} FROM tagged GROUP BY doc_id")
def dependency_labels(spark, folder):
    return rounded_columns(tg.tagged_features(tagged(spark, folder), tg.dependency_shares()), ["doc_id"])


# ---- the whole record --------------------------------------------------------------------------------------

NARRATIVE_SQL = {
    n: f"{st.share_of('k', items)} / nullif(len(k), 0)::DOUBLE * 100" for n, items in wl.NARRATIVE_WORDS.items()
}
DIALOGUE_MARKS = marks_sql(['"', "'"])
DIALOGUE_SQL = {
    "dialogue_markers": f"({DIALOGUE_MARKS} + {st.share_of('k', wl.SPEECH_VERBS)}) / nullif(len(k), 0)::DOUBLE * 100"
}


def substrings_sql(terms: list[str]) -> str:
    return "(" + " + ".join(st.n_substring("lower(text)", t) for t in terms) + ")"


ERA_SQL = {
    f"{n.lower()}_markers": f"{substrings_sql(t)} / greatest(len(w) / 1000::DOUBLE, 1)" for n, t in wl.ERA_MARKERS.items()
}
CATEGORY_SQL = {
    f"{n.lower()}_words": f"{substrings_sql(t)} / greatest(len(w), 1)::DOUBLE * 1000" for n, t in wl.CATEGORY_WORDS.items()
}
_SYL = "(SELECT doc_id AS id2, nw, ns, ny, nc FROM counts)"
RECORD_SQL = {
    **SENTENCE_SQL,
    "avg_syllables_per_word": f"list_avg(list_transform(a, lambda z: {st.syllables('z')}))",
    **PUNCT_LENGTH_SQL,
    **NARRATIVE_SQL,
    **DIALOGUE_SQL,
    **{n: INDEX_SQL[n] for n in ("flesch_reading_ease", "gunning_fog", "smog_index")},
    **SHAPE_SQL,
    **ERA_SQL,
    **CATEGORY_SQL,
    **CAPITAL_SQL,
    **PARAGRAPH_SQL,
    **TTR_SQL,
    **MATTR_SQL,
}


@register(
    "f20_style_record",
    f"WITH {PARTS}, {read_sql(False)}, "
    f"whole AS (SELECT * FROM sized JOIN {_SYL} ON doc_id = id2) {feature_sql(RECORD_SQL, 'whole')}",
)
def style_record(spark, folder):
    return rounded_columns(sty.style_record(documents(spark, folder), paragraph_separator="\n"), ["doc_id"])
