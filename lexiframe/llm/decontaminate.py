"""Benchmark decontamination by canonical templates: re-parameterised questions match, inconsistent slots do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.functions.tokens import let
from lexiframe.session import lookup_join, materialize

# Placeholders of the canonical text, single characters that no kept token holds; ``FIRST`` marks a capitalised
# word that begins a sentence, and the last two enclose what a placeholder stands for.
NAME, NUMBER, UNIT, FIRST, OPEN, CLOSE = "\u0001", "\u0002", "\u0003", "\u0004", "\u0005", "\u0006"

# Words that count as units behind a number.
UNITS = [
    "%", "€", "$", "£", "°", "mm", "cm", "m", "km", "in", "ft", "mi", "mg", "g", "kg", "lb", "lbs", "oz", "ml", "l", "s", "min",
    "h", "hr", "hrs", "meters", "metres", "meter", "metre", "miles", "feet", "inches", "grams", "kilograms", "pounds", "liters",
    "litres", "seconds", "minutes", "hours", "days", "weeks", "months", "years", "dollars", "euros", "cents", "percent", "degrees",
]

BLANKED = f"[{NAME}-{CLOSE}]"
CAPITAL = r"\p{Lu}[\p{L}\p{M}]*+"
NAMES = r"(?<=[\p{Ll},;]\s)" + CAPITAL
FIRSTS = r"(?<![\p{L}\p{M}" + OPEN + "])" + CAPITAL
CAPITALS = r"(?<![\p{L}\p{M}])" + CAPITAL
NUMBERS = r"\p{Nd}++(?:[.,]\p{Nd}++)*+"  # possessive: lists of numbers are as long as the text
UNIT_WORDS = "|".join((u.replace("$", r"\$") + ("" if not u.isalpha() else r"(?![\p{L}\p{M}])")) for u in sorted(UNITS, key=lambda u: (-len(u), u)))
AFTER = f"({NUMBER}{OPEN}[^{CLOSE}]*+{CLOSE})" + r"(\s?)(" + UNIT_WORDS + ")"
TOKENS = r"[\p{L}\p{M}]+|" + f"[{NAME}{NUMBER}{UNIT}{FIRST}]{OPEN}[^{CLOSE}]*+{CLOSE}"
#: kinds of placeholders in the two forms of a template: with the words that begin sentences as they are, and as names
FORMS = {0: [NAME, NUMBER, UNIT], 1: [NAME, NUMBER, UNIT, FIRST]}


def valued_tokens(text: Column) -> Column:
    """Lower-cased tokens of a text: words, and placeholders with what they stand for. Numbers, units behind numbers,
    capitalised words amid a sentence (after a lower-case letter, comma or semicolon and a blank) and capitalised words
    elsewhere have placeholders of their own. Punctuation is dropped."""
    value = F.regexp_replace(F.coalesce(text, F.lit("")), BLANKED, " ")
    value = F.regexp_replace(value, NAMES, f"{NAME}{OPEN}$0{CLOSE}")
    value = F.regexp_replace(value, FIRSTS, f"{FIRST}{OPEN}$0{CLOSE}")
    value = F.regexp_replace(value, NUMBERS, f" {NUMBER}{OPEN}$0{CLOSE}")
    value = F.regexp_replace(value, AFTER, f"$1$2 {UNIT}{OPEN}$3{CLOSE}")
    return F.regexp_extract_all(F.lower(value), F.lit(TOKENS), F.lit(0))


def _kind(token: Column) -> Column:
    return F.substring(token, 1, 1)


def _value(token: Column) -> Column:
    return F.substring(token, F.lit(3), F.length(token) - 3)


def templated(tokens: Column, form: int) -> Column:
    """The tokens of a form of the template: words and bare placeholders."""

    def plain(t: Column) -> Column:
        kind = _kind(t)
        if form == 1:
            return F.when(kind == FIRST, NAME).when(kind.isin(FORMS[0]), kind).otherwise(t)
        return F.when(kind == FIRST, _value(t)).when(kind.isin(FORMS[0]), kind).otherwise(t)

    return F.transform(tokens, plain)


def canonical(text: Column, form: int = 0) -> Column:
    """The template of a text, as ``templated(valued_tokens(text), form)`` but without the values: words that begin
    sentences stay in form 0 and are names in form 1."""
    value = F.regexp_replace(F.coalesce(text, F.lit("")), BLANKED, " ")
    value = F.regexp_replace(value, NAMES if form == 0 else CAPITALS, NAME)
    value = F.regexp_replace(value, NUMBERS, f" {NUMBER}")
    value = F.regexp_replace(value, f"(?<={NUMBER})" + r"(\s?)(?:" + UNIT_WORDS + ")", f"$1 {UNIT}")
    return F.regexp_extract_all(F.lower(value), F.lit(r"[\p{L}\p{M}]+|" + f"[{NAME}{NUMBER}{UNIT}]"), F.lit(0))


def run_of(tokens: Column, at: Column, n: Column | int) -> Column:
    """The ``n`` tokens from position ``at`` on; ``slice`` inside a lambda would copy the whole array each time."""
    return F.transform(F.sequence(at, at + n - 1), lambda i: F.get(tokens, i))


def hashed(tokens: list[Column]) -> Column:
    """A 64-bit hash of some tokens; nulls do not count."""
    return F.xxhash64(*tokens)


def with_windows(rows: DataFrame, text: str, widths: list[int]) -> DataFrame:
    """``rows`` without ``text`` and with ``(w, at, form, hash)`` of every window of its template: of both forms, the second
    only where it differs."""

    def of(forms: Column) -> Column:
        def run(w: int) -> Column:
            size = F.size(forms["a"])
            starts = F.when(size >= w, F.sequence(F.lit(0), size - w)).otherwise(F.array().cast("array<int>"))
            each = lambda i, c: hashed([F.get(forms[c], i + j) for j in range(w)])
            return F.transform(starts, lambda i: F.named_struct(F.lit("w"), F.lit(w), F.lit("at"), i, F.lit("a"), each(i, "a"), F.lit("b"), each(i, "b")))

        return F.concat(*[run(w) for w in widths])

    kept = [c for c in rows.columns if c != text]
    forms = F.struct(canonical(F.col(text), 0).alias("a"), canonical(F.col(text), 1).alias("b"))
    found = rows.select(*kept, F.inline(let(forms, of)))
    first, second = (F.struct(F.lit(n).alias("form"), F.col(c).alias("hash")) for n, c in ((0, "a"), (1, "b")))
    both = F.when(F.col("a") == F.col("b"), F.array(first)).otherwise(F.array(first, second))
    return found.select(*kept, "w", "at", F.inline(both))


def slots(window: Column, form: Column) -> Column:
    """Kind and value of each placeholder of a window of valued tokens, in a form."""
    kept = F.filter(window, lambda t: _kind(t).isin(FORMS[0]) | ((form == 1) & (_kind(t) == FIRST)))
    kind = lambda t: F.when(_kind(t) == FIRST, NAME).otherwise(_kind(t))
    return F.transform(kept, lambda t: F.named_struct(F.lit("kind"), kind(t), F.lit("value"), _value(t)))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = 8,
    least_words: int = 5,
) -> DataFrame:
    """``(key, items, n_items, n_windows)`` for the rows that hold a passage of a benchmark item, and no others.

    Both sides become token templates (``canonical``), and windows of ``width`` tokens join by hash, so a question
    with other numbers, names or units still matches. Capitalised words that begin sentences are names in a second form of
    a window, as which of them are cannot be told. An item of fewer tokens is one window of its own length.
    Windows of fewer than ``least_words`` words, placeholders not counted, are not distinctive: they match only where the
    slots hold the same values too, or where those of an alignment hold ``width`` words together. Then slots are checked: over all windows of a row and an
    item at the same distance, one value of the item must always stand for one value of the row and the other way
    round; of an alignment that breaks this only windows whose slots hold the item's own values count. ``items`` are
    the ids found, sorted.

    Null and empty texts match nothing. Rows of one key count together. Texts are read once for their hashes, which is
    all that the join sees; only rows that match windows with slots are read again. The benchmark's windows
    are broadcast if their counted table is small enough, and shuffled otherwise.
    """
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text"), valued_tokens(F.col(item_text)).alias("tokens"))
    items = items.where(F.col("item").isNotNull())
    items = materialize(items.where(F.size("tokens") > 0), "templates")
    short = [r["n"] for r in items.where(F.size("tokens") < width).select(F.size("tokens").alias("n")).distinct().collect()]
    widths = sorted({width, *short})  # at most ``width`` numbers
    docs = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))

    wanted = None
    for w in widths:
        size = F.size("tokens")
        own = with_windows(items.where((size == w) if w < width else (size >= w)), "text", [w])
        window = run_of(F.col("tokens"), F.col("at"), w)
        part = own.select("w", "hash", "item", F.col("at").alias("item_at"), F.col("form").alias("item_form"), slots(window, F.col("form")).alias("item_slots"))
        wanted = part if wanted is None else wanted.unionByName(part)
    wanted = materialize(wanted.withColumn("words", F.col("w") - F.size("item_slots")), "windows")
    found = lookup_join(with_windows(docs, "_text", widths), wanted.select("w", "hash").distinct(), ["w", "hash"], "left_semi")
    found = materialize(found, "found")
    hits = found.join(wanted, ["w", "hash"])

    plain = hits.where((F.size("item_slots") == 0) & (F.col("words") >= least_words)).select("_key", "item", "w", "at")
    slotted = hits.where((F.size("item_slots") > 0) | (F.col("words") < least_words))
    again = slotted.select("_key").distinct()
    texts = docs.join(materialize(again, "again"), "_key", "left_semi").select("_key", valued_tokens(F.col("_text")).alias("tokens"))
    window = run_of(F.col("tokens"), F.col("at"), F.col("w"))
    held = slotted.join(materialize(texts, "texts"), "_key").where(F.size("tokens") >= F.col("at") + F.col("w"))
    # bound once a hit: an expression that is used often would be worked out as often
    read = let(window, lambda ts: let(
        F.when(F.col("form") == 0, templated(ts, 0)).otherwise(templated(ts, 1)),
        lambda xs: F.named_struct(F.lit("tokens"), ts, F.lit("hash"), hashed([F.get(xs, F.lit(j)) for j in range(width)])),
    ))
    held = held.select("_key", "item", "w", "at", "item_at", "words", "item_slots", "form", "item_form", "hash", read.alias("read"))
    held = materialize(held, "held").where("read.hash = hash")
    window = F.col("read.tokens")
    bare = lambda t: _kind(t).isin(FORMS[0]) | ((F.col("form") == 1) & (_kind(t) == FIRST))
    word_at = F.filter(F.transform(window, lambda t, i: F.when(~bare(t), F.col("at") + i)), lambda x: x.isNotNull())
    # windows of first forms are judged by themselves, and together with those where words that begin sentences are names
    views = F.when((F.col("form") == 0) & (F.col("item_form") == 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    held = held.select("_key", "item", "w", "at", "item_at", "words", "item_slots", F.explode(views).alias("view"), word_at.alias("word_at"), slots(window, F.col("form")).alias("doc_slots"))
    pairs = F.expr("transform(item_slots, (s, i) -> struct(s.kind AS kind, s.value AS mine, doc_slots[i].value AS theirs))")
    held = held.withColumn("pairs", pairs).withColumn("shift", F.col("at") - F.col("item_at"))
    # an alignment has as many windows as the item has at most
    lined = held.groupBy("_key", "item", "shift", "view").agg(
        F.collect_set(F.struct("w", "at", "words", "pairs")).alias("windows"),
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("all"),
        F.size(F.array_distinct(F.flatten(F.collect_list("word_at")))).alias("covered"),
    )
    one = lambda side: F.size(F.expr(f"array_distinct(transform(all, p -> struct(p.kind AS kind, p.{side} AS v)))"))
    agree = (one("mine") == F.size("all")) & (one("theirs") == F.size("all"))
    kept = lined.select("_key", "item", "covered", agree.alias("agree"), F.explode("windows").alias("x"))
    literal = F.forall("x.pairs", lambda p: p["mine"] == p["theirs"])
    kept = kept.where(literal | (F.col("agree") & ((F.col("x.words") >= least_words) | (F.col("covered") >= width))))
    every = plain.unionByName(kept.select("_key", "item", "x.w", "x.at"))
    return every.groupBy(F.col("_key").alias(key)).agg(
        F.array_sort(F.collect_set("item")).alias("items"),
        F.count_distinct("item").alias("n_items"),
        F.count_distinct("w", "at").alias("n_windows"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, all columns unchanged; rows with a null key stay."""
    found = materialize(contaminated(docs, benchmark, key, text, **options).select(key), "contaminated")
    return docs.join(found, key, "left_anti").select(*[f"`{c}`" for c in docs.columns])
