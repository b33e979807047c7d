"""Registered queries of this subpackage and the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.functions.tokens import let
from lexiframe.llm import (
    decontaminate,
    language,
    packing,
    periodic_runs,
    ptolemaic,
    repeats,
    secret_scan,
    shards,
    simhash,
    surrogates,
    token_files,
    url_rules,
    vector_dups,
)
from lexiframe.sources.readers import read_table

N_SHARDS = 24
SURROGATE_KEY = "lexiframe"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@register("op1_surrogates")
def op1_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY)


@register("op2_byte_shards")
def op2_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.byte_shards(read_table(spark, folder, "documents"), N_SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@register("op3_near_vectors")
def op3_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dups.near_vectors(read_table(spark, folder, "embeddings"))


@register("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return secret_scan.scan(docs, secret_scan.train_net(docs))


def held_out(key: str = "doc_id"):
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2


def language_model(spark: SparkSession, docs: DataFrame):
    """Learned only from rows that are not held out and have a language."""
    vocabulary = language.Vocabulary.from_file(tokenizer_path("piece_bpe_32k.model"))
    return language.fit_language_model(docs.where(~held_out()), vocabulary)


@register("op5_language")
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = language.identify(docs, language_model(spark, docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@register("op6_template_leaks")
def op6_template_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@register("op7_simhash")
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


HOST_PATH_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in HOST_PATH_RULES)
BLOCKED_SQL = "|".join(w for w in url_rules.BLOCKED_WORDS)
URLS_SQL = f"""
WITH rules(h, p, v) AS (VALUES {RULES_SQL}),
rest AS (
  SELECT page_id, row_number() OVER () AS n, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, n, regexp_extract(r, '^[^/?#]*') AS raw, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), addresses AS (
  SELECT page_id, n, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
), best AS (
  SELECT n, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS v
  FROM addresses, rules WHERE (host = h OR suffix(host, '.' || h)) AND prefix(path, p) GROUP BY n
), words AS (
  SELECT n FROM addresses WHERE regexp_matches(host || path, '(^|[^A-Za-z0-9])({BLOCKED_SQL})($|[^A-Za-z0-9])')
)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN n IN (SELECT n FROM words) THEN 'block' ELSE 'allow' END) AS verdict
FROM addresses LEFT JOIN best USING (n)
"""


@register("op8_url_rules", URLS_SQL)
def op8_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = [url_rules.host_path_rule(*r) for r in HOST_PATH_RULES] + url_rules.word_rules()
    return url_rules.judge_urls(read_table(spark, folder, "pages"), rules).drop("pattern_rule")


@register("op9_packing")
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pieces(read_table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


@register("op10_repeats")
def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, folder, "documents"))


def with_planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)`` with a run from some word on in a tenth of the texts: with h the CRC-32 of the key's digits and g the
    tenth of it, where h ends in 0 word i becomes word a + (i - a) % p, for a = g % n and p = 1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words):
        a = (g % F.size(words)).cast("int")
        period = (1 + F.floor((F.size(words) - a) / (3 + g % 8))).cast("int")
        return let(
            F.struct(a.alias("a"), period.alias("p")),
            lambda c: F.transform(words, lambda w, i: F.when(i < c["a"], w).otherwise(F.get(words, c["a"] + F.pmod(i - c["a"], c["p"])))),
        )

    split = F.filter(F.split(F.col(text), r"[\x20\t-\r]+"), lambda w: w != "")
    changed = let(split, lambda words: F.when(F.size(words) > 0, F.array_join(planted(words), " ")).otherwise(""))
    return docs.select(key, F.when(h % 10 == 0, changed).otherwise(F.col(text)).alias(text))


@register("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_runs(read_table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length DIV -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@register("op12_token_files")
def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_table(read_table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


def clusters_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Rounds of exact assignment and floored means, one after another, every distance computed."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (SELECT vec_id, unnest(range({dims})) AS d, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('3:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k})
)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, min({k} * CAST(list_sum(list_transform(list_zip(kept.v, c{r}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) + c) AS m
  FROM kept, c{r} GROUP BY vec_id
)""")
        if r < rounds:
            steps.append(f"""s{r} AS MATERIALIZED (
  SELECT m % {k} AS c, d, sum(x) AS s, count(*) AS n FROM a{r} JOIN cells USING (vec_id) GROUP BY ALL
), c{r + 1} AS MATERIALIZED (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS v FROM s{r} GROUP BY c
  UNION ALL SELECT c, v FROM c{r} WHERE c NOT IN (SELECT c FROM s{r})
)""")
    last = ", ".join([*steps, f"found AS (SELECT vec_id, m % {k} AS c, m // {k} AS distance FROM a{rounds})"])
    return f"""
WITH {last}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(v, ',')) AS centroid_sha256
FROM found JOIN c{rounds} USING (c)
"""


@register("op13_centroid_clusters", clusters_sql())
def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    rows, centroids = ptolemaic.ptolemaic_clusters(read_table(spark, folder, "embeddings"))
    per_cluster = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = rows.agg(F.sum("distance")).first()[0]
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    facts = centroids.join(F.broadcast(per_cluster), "cluster").select(  # one row per cluster
        "cluster", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), digest.alias("centroid_sha256")
    )
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
