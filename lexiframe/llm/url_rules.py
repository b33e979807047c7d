"""URL verdicts by pattern rules that are indexed by their rarest literal token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiframe.session import lookup_join, materialize

TOKEN = "[A-Za-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host and path as one string; ``tokens`` are literals that any address with a match
    holds as whole runs of ASCII letters and digits (none: every address is tried). A match of a higher ``rank``
    wins, then the longer name, then the name in alphabetical order."""

    name: str
    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    rank: int


def host_path_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits ``host`` and its subdomains where the address's path starts with ``path``."""
    # the last run of the path may go on in the address, so it is no whole token unless something ends it
    ended = re.findall(TOKEN, re.sub(f"{TOKEN}$", "", path)) if path else []
    tokens = re.findall(TOKEN, host if path else "") + ended
    return Rule(host + path, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", verdict, tuple(tokens), 2)


def word_rule(words: str, verdict: str) -> Rule:
    """Fits addresses that hold ``words``, with its own separators, not amid further letters or digits."""
    return Rule(words, f"(?:^|[^A-Za-z0-9]){re.escape(words)}(?:$|[^A-Za-z0-9])", verdict, tuple(re.findall(TOKEN, words)), 1)


# Words of addresses that are blocked where no rule on host and path fits.
BLOCKED_WORDS = ["casino", "free-bets", "pills", "poker", "porn", "xxx", "viagra", "payday-loan", "torrent"]


def word_rules() -> list[Rule]:
    return [word_rule(w, "block") for w in BLOCKED_WORDS]


def address(url: Column) -> tuple[Column, Column]:
    """Host and path. Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    path: what follows it up to ``?``, ``#`` or the end. Both are empty for null and where there is no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    empty = F.lit("")
    return F.coalesce(F.translate(host, UPPER, LOWER), empty), F.coalesce(path, empty)


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.name, r.pattern, r.verdict, list(r.tokens), r.rank) for r in rules]
    return spark.createDataFrame(rows, "rule string, pattern string, verdict string, tokens array<string>, rank int")


def rarest_token_index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """``rules`` with the ``token`` each is filed under: its literal that the fewest rows of ``tokens (token)`` hold,
    the smallest of equals, and ``''`` for a rule without literals. Only tokens of rules are counted."""
    literals = rules.select("rule", F.explode(F.array_distinct("tokens")).alias("token"))
    counts = lookup_join(tokens, literals.select("token").distinct(), "token").groupBy("token").count()
    filed = (
        literals.join(counts, "token", "left")
        .groupBy("rule")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), F.col("token"))).alias("best"))
    )
    return rules.join(filed, "rule", "left").select(
        "rule", "pattern", "verdict", "rank", F.coalesce("best.token", F.lit("")).alias("token")
    )


def judge_urls(
    pages: DataFrame, rules: list[Rule] | DataFrame, key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, pattern_rule.

    The tokens of an address fetch the rules filed under one of them; only those run their regular expressions, and
    the best match decides. ``rule`` names it if it is one on host and path (rank 2), ``pattern_rule`` if it is
    another; ``default`` holds where none matches. Null urls and urls without ``://`` have an empty host and path, so
    only rules without literals are tried. Repeated keys and rows are judged like any other row.

    Pages lose all columns but key and url before anything moves. The rules are broadcast only after their table has
    been written and counted (``lookup_join``); a larger list is joined by token with a shuffle.
    """
    spark = pages.sparkSession
    table = rules if isinstance(rules, DataFrame) else rule_table(spark, rules)
    host, path = address(F.col(url).cast("string"))
    rows = pages.select(F.col(key), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("_row"))
    rows = materialize(rows, "addresses")
    whole = F.concat("host", "path")
    tokens = F.array_distinct(F.regexp_extract_all(whole, F.lit(TOKEN), F.lit(0)))
    asked = rows.select("_row", whole.alias("_address"), F.explode(F.array_append(tokens, F.lit(""))).alias("token"))
    index = rarest_token_index(table, asked.select("token"))
    tried = lookup_join(asked, index, "token").where(F.expr("regexp_like(_address, pattern)"))
    order = F.struct(F.col("rank"), F.length("rule").alias("size"), F.col("rule"))
    best = tried.groupBy("_row").agg(F.max_by(F.struct("rule", "verdict", "rank"), order).alias("best"))
    return rows.join(best, "_row", "left").select(
        key,
        "host",
        "path",
        F.when(F.col("best.rank") == 2, F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.when(F.col("best.rank") != 2, F.col("best.rule")).alias("pattern_rule"),
    )
