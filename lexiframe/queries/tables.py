"""Sources, sinks and row hygiene."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lexiframe.operators import hygiene as hy
from lexiframe.queries import register
from lexiframe.queries.inputs import CATALOGUE_SQL, catalogue, documents, rnd, rounded
from lexiframe.session import scratch_path
from lexiframe.sources import readers, sinks
from lexiframe.sources.readers import read_table


# ---- sources and sinks -------------------------------------------------------------------------------------


def _book_rows(spark, folder):
    return read_table(spark, folder, "documents").select(
        F.concat_ws(", ", F.col("source"), F.concat(F.lit('"'), F.col("lang"), F.lit('"'))).alias("title"),
        F.col("source").alias("author"),
        F.col("lang").alias("movement"),
        "doc_id",
        (F.col("lang") == "en").alias("is_prose"),
    )


BOOKS_SQL = """SELECT source || ', "' || lang || '"' AS title, source AS author, lang AS movement, doc_id,
                      lang = 'en' AS is_prose FROM documents"""


@register("a01_csv_catalogue_scan", BOOKS_SQL)
def csv_catalogue_scan(spark, folder):
    path = scratch_path(spark, "catalogue.csv")
    sinks.write_feature_table(_book_rows(spark, folder), path)
    return readers.read_catalogue(spark, path)


@register(
    "a02_feature_table_scan",
    f"""WITH t AS (SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem),
        u AS (UNPIVOT t ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE v)
        SELECT feature, count(v) AS n, {rnd('avg(v)', 4)} AS mean FROM u GROUP BY feature""",
)
def feature_table_scan(spark, folder):
    path = scratch_path(spark, "features.csv")
    items = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"
    )
    sinks.write_feature_table(items, path)
    found = readers.read_feature_table(spark, path)
    cols = hy.numeric_columns(found, exclude=["l_orderkey"])
    stats = found.agg(*[F.struct(F.count(c).alias("n"), F.avg(c).alias("mean")).alias(c) for c in cols])
    named = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c)["n"].alias("n"), F.col(c)["mean"].alias("mean"))
                      for c in cols])
    return stats.select(F.inline(named)).select("feature", "n", rounded(F.col("mean"), 4).alias("mean"))


@register("a03_whole_text_scan", "SELECT doc_id, text FROM documents")
def whole_text_scan(spark, folder):
    path = scratch_path(spark, "texts")
    sinks.write_text_files(read_table(spark, folder, "documents"), path)
    return sinks.read_text_files(spark, path)


@register(
    "a04_missing_texts",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'cached' END AS state,
              CASE WHEN l.doc_id IS NULL THEN '' ELSE d.text END AS text
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def missing_texts(spark, folder):
    docs = read_table(spark, folder, "documents")
    cache = docs.select("doc_id", "text").join(read_table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    todo = readers.missing_texts(docs.select("doc_id"), cache)
    everything = readers.cached_or_empty(docs.select("doc_id"), cache)
    state = F.when(F.col("_todo"), "missing").otherwise("cached")
    return everything.join(todo.withColumn("_todo", F.lit(True)), "doc_id", "left").select(
        "doc_id", state.alias("state"), "text"
    )


@register("a05_text_sink", "SELECT doc_id, text FROM documents")
def text_sink(spark, folder):
    path = scratch_path(spark, "texts.parquet")
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    first = docs.join(read_table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    sinks.append_texts(first, path)
    sinks.append_texts(docs, path)  # stores only what the first call left out
    return spark.read.parquet(path).select("doc_id", "text")


@register("a06_feature_table_sink", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem")
def feature_table_sink(spark, folder):
    path = scratch_path(spark, "features.csv")
    items = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag"
    )
    sinks.write_feature_table(items, path)
    return spark.read.schema(items.schema).csv(path, header=True)


@register(
    "a07_rewrite_in_place",
    f"""WITH c AS ({CATALOGUE_SQL})
        SELECT seq, book_id, title, author, movement FROM c WHERE book_id IS NOT NULL AND trim(book_id) <> ''""",
)
def rewrite_in_place(spark, folder):
    path = scratch_path(spark, "catalogue.parquet")
    catalogue(spark, folder).write.parquet(path)
    sinks.rewrite_in_place(hy.drop_blank_key(spark.read.parquet(path), "book_id"), path)
    return spark.read.parquet(path)


@register(
    "a08_fitted_model_sink",
    f"""WITH s AS (SELECT avg(l_quantity) m1, stddev_samp(l_quantity) s1, avg(l_extendedprice) m2,
                          stddev_samp(l_extendedprice) s2 FROM lineitem)
        SELECT l_orderkey, l_linenumber, {rnd('(l_quantity - m1) / s1')} AS quantity,
               {rnd('(l_extendedprice - m2) / s2')} AS price FROM lineitem, s""",
)
def fitted_model_sink(spark, folder):
    items = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    stages = [
        VectorAssembler(inputCols=["l_quantity", "l_extendedprice"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True),
    ]
    path = scratch_path(spark, "scaler")
    sinks.save_model(Pipeline(stages=stages).fit(items), path)
    scaled = sinks.load_model(path).transform(items).withColumn("v", vector_to_array("scaled"))
    return scaled.select(
        "l_orderkey", "l_linenumber", rounded(F.col("v")[0]).alias("quantity"), rounded(F.col("v")[1]).alias("price")
    )


@register(
    "a09_name_list_sink",
    "SELECT CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS idx, source AS name "
    "FROM (SELECT DISTINCT source FROM documents)",
)
def name_list_sink(spark, folder):
    path = scratch_path(spark, "names.parquet")
    names = hy.label_codes(read_table(spark, folder, "documents"), "source", "idx")
    sinks.write_names(names.select("idx", F.col("source").alias("name")), path)
    return spark.read.parquet(path)


@register(
    "a10_result_summary_sink",
    f"""SELECT 'toxic' AS model, {rnd('avg(CASE WHEN quality = toxic THEN 1 ELSE 0 END)')} AS accuracy,
               count(*) AS n FROM labels
        UNION ALL SELECT 'constant', {rnd('avg(CASE WHEN quality = 1 THEN 1 ELSE 0 END)')}, count(*) FROM labels""",
)
def result_summary_sink(spark, folder):
    labels = read_table(spark, folder, "labels")
    hits = labels.agg(
        F.avg((F.col("quality") == F.col("toxic")).cast("double")).alias("toxic"),
        F.avg((F.col("quality") == 1).cast("double")).alias("constant"),
        F.count(F.lit(1)).alias("n"),
    )
    summary = hits.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(m).alias("model"), rounded(F.col(m)).alias("accuracy"), F.col("n"))
                  for m in ("toxic", "constant")]
            )
        )
    )
    path = scratch_path(spark, "summary.json")
    sinks.write_summary(summary, path)
    return spark.read.schema(summary.schema).json(path)


# ---- row hygiene -------------------------------------------------------------------------------------------

KEYED = "book_id IS NOT NULL AND trim(book_id) <> ''"
RANKED = f"""WITH c AS ({CATALOGUE_SQL}),
    k AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY seq) AS key_no FROM c WHERE {KEYED}),
    t AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY seq) AS title_no FROM k WHERE key_no = 1)"""


@register("b01_drop_blank_key", f"WITH c AS ({CATALOGUE_SQL}) SELECT seq, book_id FROM c WHERE {KEYED}")
def drop_blank_key(spark, folder):
    return hy.drop_blank_key(catalogue(spark, folder), "book_id").select("seq", "book_id")


@register("b02_duplicate_report", f"{RANKED} SELECT seq, book_id, title FROM k WHERE key_no > 1")
def duplicate_report(spark, folder):
    keyed = hy.drop_blank_key(catalogue(spark, folder), "book_id")
    return hy.duplicates(keyed, "book_id", "seq").select("seq", "book_id", "title")


@register("b03_keep_first", f"{RANKED} SELECT seq, book_id, title FROM t WHERE title_no = 1")
def keep_first(spark, folder):
    keyed = hy.drop_blank_key(catalogue(spark, folder), "book_id")
    return hy.keep_first(hy.keep_first(keyed, "book_id", "seq"), "title", "seq").select("seq", "book_id", "title")


@register(
    "b04_stage_counts",
    f"""{RANKED} SELECT (SELECT count(*) FROM c) AS n_initial, (SELECT count(*) FROM k) AS n_with_key,
        (SELECT count(*) FROM t) AS n_unique_key, (SELECT count(*) FROM t WHERE title_no = 1) AS n_unique_title""",
)
def stage_counts(spark, folder):
    return hy.stage_counts(hy.staged_catalogue(catalogue(spark, folder), "book_id", "title", "seq"))


@register("b05_flag_filter", f"WITH b AS ({BOOKS_SQL}) SELECT doc_id, title FROM b WHERE is_prose")
def flag_filter(spark, folder):
    prose = hy.filter_if_present(_book_rows(spark, folder), "is_prose")
    return hy.filter_if_present(prose, "is_verse").select("doc_id", "title")


@register(
    "b06_label_present",
    "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL",
)
def label_present(spark, folder):
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    joined = docs.select("doc_id").join(labels.select("doc_id", "quality"), "doc_id", "left")
    return joined.filter(F.col("quality").isNotNull())


@register("b07_head_slice", "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 100")
def head_slice(spark, folder):
    return hy.head(read_table(spark, folder, "documents").select("doc_id", "source"), "doc_id", 100)


@register(
    "b08_minimum_length",
    "SELECT doc_id, len(regexp_extract_all(text, '\\S+')) AS n_words FROM documents "
    "WHERE len(regexp_extract_all(text, '\\S+')) > 1000",
)
def minimum_length(spark, folder):
    from lexiframe.functions.tokens import n_words

    counted = documents(spark, folder).select("doc_id", n_words(F.col("text")).cast("bigint").alias("n_words"))
    return counted.filter(F.col("n_words") > 1000)


@register(
    "b09_skip_empty",
    "SELECT turn, count(*) AS n FROM conversations WHERE length(regexp_replace(text, '[a-z]+', '', 'g')) > 0 GROUP BY turn",
)
def skip_empty(spark, folder):
    talk = read_table(spark, folder, "conversations")
    left = talk.withColumn("text", F.regexp_replace("text", "[a-z]+", ""))
    return left.filter(F.length("text") > 0).groupBy("turn").agg(F.count(F.lit(1)).alias("n"))


@register("b10_tolerant_drop", "SELECT doc_id, lang, source FROM documents")
def tolerant_drop(spark, folder):
    return read_table(spark, folder, "documents").drop("text", "n_chars", "no_such_column")


@register(
    "b11_fill_zero",
    f"""SELECT d.doc_id, CAST(coalesce(l.quality, 0) AS INTEGER) AS quality, CAST(coalesce(l.toxic, 0) AS INTEGER) AS toxic,
               {rnd('coalesce(d.n_chars / nullif(l.quality, 0), 0)')} AS per_quality
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def fill_zero(spark, folder):
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    joined = docs.select("doc_id", "n_chars").join(labels, "doc_id", "left")
    per = F.when(F.col("quality") == 0, F.lit(float("nan"))).otherwise(F.col("n_chars") / F.col("quality"))
    return hy.fill_zero(joined.withColumn("per_quality", per)).select(
        "doc_id", "quality", "toxic", rounded(F.col("per_quality")).alias("per_quality")
    )


@register(
    "b12_side_by_side",
    """SELECT d.doc_id, d.n_chars, l.quality, len(string_split(d.text, ' ')) AS n_blank_parts
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def side_by_side(spark, folder):
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    parts = documents(spark, folder).select("doc_id", F.size(F.split("text", " ")).cast("bigint").alias("n_blank_parts"))
    return hy.hstack([docs.select("doc_id", "n_chars"), labels.select("doc_id", "quality"), parts], "doc_id")


@register(
    "b13_vertical_concat",
    """SELECT 'labelled' AS part, d.doc_id, d.n_chars FROM documents d SEMI JOIN labels l ON d.doc_id = l.doc_id
       UNION ALL SELECT 'other', d.doc_id, d.n_chars FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id""",
)
def vertical_concat(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = read_table(spark, folder, "labels").select("doc_id")
    labelled = docs.join(labels, "doc_id", "left_semi").withColumn("part", F.lit("labelled"))
    other = docs.join(labels, "doc_id", "left_anti").withColumn("part", F.lit("other"))
    return labelled.unionByName(other)


@register(
    "b14_label_codes",
    "SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_code FROM documents",
)
def label_codes(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "lang")
    return hy.encode_labels(docs, "lang").select("doc_id", "lang", "label_code")
