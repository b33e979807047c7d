"""Cleaning, tokens and syllables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexiframe.functions import cleaning as cl
from lexiframe.functions import tokens as tk
from lexiframe.functions import wordlists as wl
from lexiframe.functions.syllables import syllables, syllables_refined
from lexiframe.operators import corpus
from lexiframe.queries import register, sqltext as st
from lexiframe.queries.inputs import documents, quoted, text_literal
from lexiframe.sources.readers import read_table

# ---- cleaning: the documents wrapped in marker lines, notes, emphasis and odd line ends ----------------------

HEAD = "*** START OF THE PROJECT GUTENBERG EBOOK ODD TALES ***"
TAIL = "*** END OF THE PROJECT GUTENBERG EBOOK ODD TALES ***"
RAW_EXPR = f"""CASE lang
    WHEN 'en' THEN concat('Title page', chr(13), chr(10), '{HEAD}', chr(13), chr(10), chr(13), chr(10), chr(13), chr(10),
                          text, chr(10), chr(10), chr(10), chr(10), ' _The End_ [note [1] x]', chr(10), '{TAIL}', ' more')
    WHEN 'fr' THEN concat('Transcribed from a print', chr(10), chr(9), text, ' [Illustration]', chr(7), chr(127))
    WHEN 'de' THEN concat(text, chr(10), chr(10), 'End of the Project Gutenberg text')
    ELSE concat('__', text, '__', chr(133), '[a', chr(10), 'b]') END"""
RAW = f"WITH raw AS (SELECT doc_id, {RAW_EXPR} AS text FROM documents)"


def raw_texts(spark, folder):
    return documents(spark, folder).selectExpr("doc_id", f"{RAW_EXPR} AS text")


def _first(markers: list[str], then) -> str:
    return "CASE " + " ".join(
        f"WHEN instr(text, {text_literal(m)}) > 0 THEN {then(m)}" for m in markers
    ) + " END"


def boilerplate_sql(text_cte: str) -> str:
    start = _first(cl.START_MARKERS_STRICT, lambda m: f"instr(text, {text_literal(m)}) + {len(m)}")
    stop = _first(cl.END_MARKERS_STRICT, lambda m: f"instr(text, {text_literal(m)})")
    cut = st.trimmed("substr(text, a, greatest(b - a, 0))")
    return f"""SELECT doc_id, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN {cut} ELSE text END AS text
               FROM (SELECT doc_id, text, {start} AS a, {stop} AS b FROM {text_cte})"""


def boilerplate_lines_sql(text_cte: str) -> str:
    def after(m: str) -> str:
        at, rest = f"instr(text, {text_literal(m)})", f"instr(substr(text, instr(text, {text_literal(m)})), chr(10))"
        return f"CASE WHEN {rest} > 0 THEN {at} + {rest} ELSE {at} + {len(m)} END"

    start = _first(cl.START_MARKERS_WIDE, after)
    stop = _first(cl.END_MARKERS_WIDE, lambda m: f"instr(text, {text_literal(m)})")
    cut = st.trimmed("substr(text, coalesce(a, 1), greatest(coalesce(b, length(text) + 1) - coalesce(a, 1), 0))")
    return f"""SELECT doc_id, CASE WHEN a IS NOT NULL OR b IS NOT NULL THEN {cut} ELSE text END AS text
               FROM (SELECT doc_id, text, {start} AS a, {stop} AS b FROM {text_cte})"""


def newlines_sql(text: str, at_least: int) -> str:
    return (
        f"regexp_replace(replace({text}, chr(13) || chr(10), chr(10)), '\\n{{{at_least},}}', chr(10) || chr(10), 'g')"
    )


def emphasis_sql(text: str) -> str:
    return rf"regexp_replace(replace({text}, '_', ''), '\[[^\n]*?\]', '', 'g')"


@register("c01_strip_boilerplate", f"{RAW} {boilerplate_sql('raw')}")
def strip_boilerplate(spark, folder):
    return raw_texts(spark, folder).select("doc_id", cl.strip_boilerplate(F.col("text")).alias("text"))


@register("c02_strip_boilerplate_lines", f"{RAW} {boilerplate_lines_sql('raw')}")
def strip_boilerplate_lines(spark, folder):
    return raw_texts(spark, folder).select("doc_id", cl.strip_boilerplate_lines(F.col("text")).alias("text"))


FRONT_EXPR = "concat('Preface', chr(10), text, chr(10), 'CHAPTER I', chr(10), text, chr(10), 'I. End')"
LONG, BEYOND = 3000, 200
FRONT_SQL = "CASE " + " ".join(
    f"WHEN instr(text, {text_literal(m)}) - 1 > {BEYOND} THEN instr(text, {text_literal(m)})" for m in cl.CHAPTER_MARKERS
) + " END"


@register(
    "c03_skip_front_matter",
    f"""SELECT doc_id, CASE WHEN length(text) > {LONG} AND a IS NOT NULL THEN substr(text, a) ELSE text END AS text
        FROM (SELECT doc_id, text, {FRONT_SQL} AS a FROM (SELECT doc_id, {FRONT_EXPR} AS text FROM documents))""",
)
def skip_front_matter(spark, folder):
    fronted = documents(spark, folder).selectExpr("doc_id", f"{FRONT_EXPR} AS text")
    return fronted.select("doc_id", cl.skip_front_matter(F.col("text"), LONG, BEYOND).alias("text"))


@register(
    "c04_normalize_newlines",
    f"{RAW} SELECT doc_id, {newlines_sql('text', 2)} AS double_breaks, {newlines_sql('text', 3)} AS triple_breaks FROM raw",
)
def normalize_newlines(spark, folder):
    text = F.col("text")
    return raw_texts(spark, folder).select(
        "doc_id",
        cl.normalize_newlines(text, 2).alias("double_breaks"),
        cl.normalize_newlines(text, 3).alias("triple_breaks"),
    )


@register("c05_drop_emphasis_and_notes", f"{RAW} SELECT doc_id, {emphasis_sql('text')} AS text FROM raw")
def drop_emphasis_and_notes(spark, folder):
    return raw_texts(spark, folder).select("doc_id", cl.drop_emphasis_and_notes(F.col("text")).alias("text"))


CONTROL_KEEP = r"regexp_replace({t}, '[\x00-\x08\x0B-\x1F\x7F-\x{{9F}}]', '', 'g')"
CONTROL_ALL = r"regexp_replace({t}, '[\x00-\x1F\x7F-\x{{9F}}]', '', 'g')"


@register(
    "c06_drop_control_chars",
    f"{RAW} SELECT doc_id, {CONTROL_KEEP.format(t='text')} AS text, {CONTROL_ALL.format(t='text')} AS one_line FROM raw",
)
def drop_control_chars(spark, folder):
    text = F.col("text")
    return raw_texts(spark, folder).select(
        "doc_id",
        cl.drop_control_chars(text).alias("text"),
        cl.drop_control_chars(text, keep_newlines=False).alias("one_line"),
    )


@register(
    "c07_prefix",
    "SELECT doc_id, substr(text, 1, 10000) AS prefix, length(text) AS n_chars, "
    "length(text) > 10000 AS is_cut FROM documents",
)
def prefix(spark, folder):
    """The prefix is this operator's result; no other query shortens a text."""
    return documents(spark, folder).select(
        "doc_id",
        cl.take_prefix(F.col("text"), 10_000).alias("prefix"),
        F.length("text").cast("bigint").alias("n_chars"),
        (F.length("text") > 10_000).alias("is_cut"),
    )


PUNCT_SQL = st.trimmed(r"regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\t-\r\x1c-\x20\x85\p{Z}]', ' ', 'g'), '[\t-\r\x1c-\x20\x85\p{Z}]+', ' ', 'g')")


@register(
    "c08_punctuation_to_space",
    f"""SELECT 'd' || doc_id AS id, {PUNCT_SQL} AS text FROM documents
        UNION ALL SELECT 'c' || conv_id || '-' || turn, {PUNCT_SQL} FROM conversations""",
)
def punctuation_to_space(spark, folder):
    docs = documents(spark, folder).select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    talk = read_table(spark, folder, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), "text"
    )
    return docs.unionByName(talk).select("id", cl.punctuation_to_space(F.col("text")).alias("text"))


# ---- tokens ------------------------------------------------------------------------------------------------

BAR = "'|'"


def _per_document(spark, folder, **columns):
    return documents(spark, folder).select("doc_id", *[c.alias(n) for n, c in columns.items()])


def _joined(tokens):
    return F.array_join(tokens, "|")


@register(
    "d01_sentences",
    f"""SELECT doc_id, unnest(range(len(s))) AS sent_no, unnest(s) AS sentence
        FROM (SELECT doc_id, {st.sentences('text')} AS s FROM documents)""",
)
def sentences(spark, folder):
    return documents(spark, folder).select("doc_id", F.posexplode(tk.sentences(F.col("text")))).select(
        "doc_id", F.col("pos").cast("bigint").alias("sent_no"), F.col("col").alias("sentence")
    )


@register("d02_words", f"SELECT doc_id, array_to_string({st.words('text')}, {BAR}) AS words FROM documents")
def words(spark, folder):
    return _per_document(spark, folder, words=_joined(tk.words(F.col("text"))))


@register(
    "d03_letter_tokens", f"SELECT doc_id, array_to_string({st.letters('lower(text)')}, {BAR}) AS tokens FROM documents"
)
def letter_tokens(spark, folder):
    return _per_document(spark, folder, tokens=_joined(tk.letter_tokens(F.col("text"))))


@register(
    "d04_word_char_tokens", f"SELECT doc_id, array_to_string({st.word_chars('text')}, {BAR}) AS tokens FROM documents"
)
def word_char_tokens(spark, folder):
    return _per_document(spark, folder, tokens=_joined(tk.word_char_tokens(F.col("text"))))


@register(
    "d05_stop_word_sets",
    f"""WITH base(term) AS (SELECT unnest([{quoted(sorted(set(wl.STOP_WORDS)))}])),
             kept(term) AS (SELECT unnest([{quoted(wl.KEPT_WORDS)}])),
             added(term) AS (SELECT unnest([{quoted(wl.AMBIGUOUS_WORDS)}])),
             stops AS ((SELECT term FROM base EXCEPT SELECT term FROM kept) UNION SELECT term FROM added),
             tf AS (SELECT t AS term, count(*) AS n FROM
                    (SELECT unnest({st.letters('lower(text)')}) AS t FROM documents) GROUP BY t)
        SELECT s.term, coalesce(tf.n, 0) AS n FROM stops s LEFT JOIN tf ON s.term = tf.term""",
)
def stop_word_sets(spark, folder):
    """The derived stop-word set with each word's frequency in the documents."""
    def terms(items):
        return spark.createDataFrame([(t,) for t in items], "term string")

    stops = terms(wl.STOP_WORDS).subtract(terms(wl.KEPT_WORDS)).union(terms(wl.AMBIGUOUS_WORDS)).distinct()
    used = documents(spark, folder).select(F.explode(tk.letter_tokens(F.col("text"))).alias("term"))
    counts = used.filter(F.col("term").isin(wl.stop_words())).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return stops.join(counts, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


@register(
    "d06_without_stop_words",
    f"""SELECT doc_id, array_to_string(list_filter({st.letters('lower(text)')},
               lambda z: z NOT IN ({st.STOPS_SQL}) AND length(z) >= 3), {BAR}) AS tokens FROM documents""",
)
def without_stop_words(spark, folder):
    return _per_document(
        spark, folder, tokens=_joined(tk.without(tk.letter_tokens(F.col("text")), wl.stop_words(), min_length=3))
    )


def content_sql(text: str, lower: bool = True) -> str:
    source, probe = ("lower(q)", "z") if lower else ("q", "lower(z)")
    return (
        f"list_filter(list_transform({st.sentences(text)}, lambda q: list_filter({st.letters(source)}, "
        f"lambda z: {probe} NOT IN ({st.STOPS_SQL}))), lambda q: len(q) > 2)"
    )


@register(
    "d07_content_sentences",
    f"""SELECT doc_id, unnest(range(len(s))) AS sent_no, array_to_string(unnest(s), {BAR}) AS tokens
        FROM (SELECT doc_id, {content_sql('text')} AS s FROM documents)""",
)
def content_sentences(spark, folder):
    kept = tk.sentence_tokens(F.col("text"), wl.stop_words())
    return documents(spark, folder).select("doc_id", F.posexplode(kept)).select(
        "doc_id", F.col("pos").cast("bigint").alias("sent_no"), _joined(F.col("col")).alias("tokens")
    )


@register(
    "d08_joined_and_nested",
    f"""SELECT doc_id, array_to_string(flatten({content_sql('text')}), ' ') AS joined,
               array_to_string(list_transform({content_sql('text', False)}, lambda q: array_to_string(q, ' ')), '/') AS nested
        FROM documents""",
)
def joined_and_nested(spark, folder):
    flat = tk.sentence_tokens(F.col("text"), wl.stop_words())
    nested = tk.sentence_tokens(F.col("text"), wl.stop_words(), lower=False)
    return _per_document(
        spark,
        folder,
        joined=F.array_join(F.flatten(flat), " "),
        nested=F.array_join(F.transform(nested, lambda s: F.array_join(s, " ")), "/"),
    )


@register(
    "d09_paragraphs",
    r"""SELECT doc_id, unnest(range(len(p))) AS par_no, unnest(p) AS paragraph FROM (SELECT doc_id,
        list_filter(string_split(text, chr(10)), lambda z: regexp_matches(z, '\S')) AS p FROM documents)""",
)
def paragraphs(spark, folder):
    return documents(spark, folder).select("doc_id", F.posexplode(tk.paragraphs(F.col("text"), "\n"))).select(
        "doc_id", F.col("pos").cast("bigint").alias("par_no"), F.col("col").alias("paragraph")
    )


TOKEN_ROWS = f"""tok AS (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS t
    FROM (SELECT doc_id, {{tokens}} AS a FROM documents))"""
CONTENT_WORDS = f"list_filter({st.word_chars('text')}, lambda z: z NOT IN ({st.STOPS_SQL}))"


@register(
    "d10_word_ngrams",
    f"""WITH {TOKEN_ROWS.format(tokens=CONTENT_WORDS)},
        g AS (SELECT doc_id, i, t AS g1, lead(t, 1) OVER w AS t2, lead(t, 2) OVER w AS t3 FROM tok
              WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        n AS (SELECT doc_id, 1 AS n, i, g1 AS gram FROM g
              UNION ALL SELECT doc_id, 2, i, g1 || ' ' || t2 FROM g WHERE t2 IS NOT NULL
              UNION ALL SELECT doc_id, 3, i, g1 || ' ' || t2 || ' ' || t3 FROM g WHERE t3 IS NOT NULL)
        SELECT doc_id, n, count(*) AS n_grams, count(DISTINCT gram) AS n_distinct,
               string_agg(gram, '|' ORDER BY i) AS grams FROM n GROUP BY doc_id, n""",
)
def word_ngrams(spark, folder):
    content = tk.without(tk.word_char_tokens(F.col("text")), wl.stop_words())
    per_n = documents(spark, folder).select("doc_id", content.alias("t")).select(
        "doc_id", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), tk.ngrams(F.col("t"), n).alias("g")) for n in (1, 2, 3)]))
    )
    return per_n.select("doc_id", "col.n", "col.g").filter(F.size("g") > 0).select(
        "doc_id",
        "n",
        F.size("g").cast("bigint").alias("n_grams"),
        F.size(F.array_distinct("g")).cast("bigint").alias("n_distinct"),
        _joined(F.col("g")).alias("grams"),
    )


PAIRS_SQL = f"""{TOKEN_ROWS.format(tokens=st.letters('lower(text)'))},
    nxt AS (SELECT doc_id, i, t AS a, lead(t) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM tok),
    uni AS (SELECT doc_id, t, count(*) AS n FROM tok GROUP BY doc_id, t),
    bi AS (SELECT doc_id, a, b, count(*) AS n FROM nxt WHERE b IS NOT NULL GROUP BY doc_id, a, b),
    size AS (SELECT doc_id, sum(k) AS v FROM (SELECT doc_id, count(*) AS k FROM uni GROUP BY doc_id
             UNION ALL SELECT doc_id, count(*) FROM bi GROUP BY doc_id) GROUP BY doc_id),
    pairs AS (SELECT bi.doc_id, bi.a, bi.b, bi.n,
                     (CAST(bi.n AS DOUBLE) - 2) / ua.n / ub.n * CAST(size.v AS DOUBLE) AS score
              FROM bi JOIN uni ua ON bi.doc_id = ua.doc_id AND bi.a = ua.t
                      JOIN uni ub ON bi.doc_id = ub.doc_id AND bi.b = ub.t JOIN size ON bi.doc_id = size.doc_id)"""


@register(
    "d11_collocations",
    f"""WITH {PAIRS_SQL}
        SELECT doc_id, a, b, n, round(score, 6) + CAST(0 AS DOUBLE) AS score FROM pairs WHERE score > 10""",
)
def collocations(spark, folder):
    tokens = _per_document(spark, folder, tokens=tk.letter_tokens(F.col("text")))
    return corpus.collocations(tokens).withColumn("score", F.round("score", 6))


@register(
    "d12_merged_collocations",
    f"""WITH {PAIRS_SQL},
        flag AS (SELECT x.doc_id, x.i, x.a, x.b, p.a IS NOT NULL AS hit FROM nxt x
                 LEFT JOIN (SELECT * FROM pairs WHERE score > 10) p ON x.doc_id = p.doc_id AND x.a = p.a AND x.b = p.b),
        run AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM flag WHERE hit),
        head AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, island ORDER BY i) AS k
                 FROM run) WHERE k % 2 = 1),
        res AS (SELECT f.doc_id, f.i, CASE WHEN h.i IS NOT NULL THEN f.a || '_' || f.b ELSE f.a END AS t,
                       lag(h.i IS NOT NULL) OVER (PARTITION BY f.doc_id ORDER BY f.i) AS used
                FROM flag f LEFT JOIN head h ON f.doc_id = h.doc_id AND f.i = h.i)
        SELECT d.doc_id, coalesce(m.merged, '') AS merged FROM documents d LEFT JOIN (SELECT doc_id,
               string_agg(t, ' ' ORDER BY i) AS merged FROM res WHERE NOT coalesce(used, false) GROUP BY doc_id) m
        ON d.doc_id = m.doc_id""",
)
def merged_collocations(spark, folder):
    tokens = _per_document(spark, folder, tokens=tk.letter_tokens(F.col("text")))
    return corpus.merge_collocations(tokens).select("doc_id", F.array_join("tokens", " ").alias("merged"))


@register("d13_all_tokens", f"SELECT doc_id, array_to_string({st.all_tokens('text')}, ' ') AS tokens FROM documents")
def all_tokens(spark, folder):
    return _per_document(spark, folder, tokens=F.array_join(tk.all_tokens(F.col("text")), " "))


# ---- syllables ---------------------------------------------------------------------------------------------


def _word_types(spark, folder):
    return documents(spark, folder).select(F.explode(F.array_distinct(tk.words(F.lower(F.col("text"))))).alias("word")).distinct()


WORD_TYPES = f"(SELECT DISTINCT unnest({st.words('lower(text)')}) AS word FROM documents)"


@register("e01_syllables", f"SELECT word, CAST({st.syllables('word')} AS BIGINT) AS n FROM {WORD_TYPES}")
def count_syllables(spark, folder):
    return _word_types(spark, folder).select("word", syllables(F.col("word")).cast("bigint").alias("n"))


@register("e02_syllables_refined", f"SELECT word, CAST({st.syllables_refined('word')} AS BIGINT) AS n FROM {WORD_TYPES}")
def count_syllables_refined(spark, folder):
    return _word_types(spark, folder).select("word", syllables_refined(F.col("word")).cast("bigint").alias("n"))
