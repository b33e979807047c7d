"""Surrogates for personal data: keyed, of the same type, gender, script and format, distinct and consistent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.session import lookup_join, materialize

# Forms of address by the gender they tell, and the patterns of the other kinds.
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Sra", "Señora", "г-жа"]
MALE = ["Mr", "Herr", "Monsieur", "Sr", "Señor", "г-н"]
NEUTRAL = ["Dr", "Prof"]
WORD = r"\p{Lu}[\p{L}\p{M}'’-]+"
TITLED = r"(?<![\p{L}\p{N}])(" + "|".join(sorted(FEMALE + MALE + NEUTRAL, key=lambda t: (-len(t), t))) + r")\.?\s(" + WORD + r"(?:\s" + WORD + r"){0,2})"
# a domain has at most 127 labels; without the bound a long one would be taken label by label on the stack
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.){1,126}\p{L}{2,}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
IP = r"(?<![\p{L}\p{N}.])(?:" + OCTET + r"\.){3}" + OCTET + r"(?![\p{L}\p{N}]|\.\p{N})"
CARD = r"(?<![\p{L}\p{N}])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])"
PHONE = r"(?<![\p{L}\p{N}(+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]?\d{4}(?![\p{L}\p{N}])"
SOCIAL = r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
PLAIN = "|".join([EMAIL, IP, IBAN, CARD, SOCIAL, PHONE])
QUICK = r"@|\d\D{0,2}\d\D{0,2}\d|" + TITLED

# Parts of invented names; 16 beginnings and 16 middles make 256 syllables a script.
SYLLABLES = {
    "latin": ("b c d f g h j k l m n p r s t v".split(), "a e i o u al an ar el en er in ol on or ul".split()),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у ал ан ар ел ен ер ин ол он ор ул".split()),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ ψ".split(), "α ε ι ο υ αλ αν αρ ελ εν ερ ιν ολ ον ορ υλ".split()),
}
ENDINGS = {
    "latin": {"given_f": "a", "given_m": "us", "given": "e", "surname": "sen"},
    "cyrillic": {"given_f": "а", "given_m": "ий", "given": "е", "surname": "ко"},
    "greek": {"given_f": "α", "given_m": "ος", "given": "ι", "surname": "ου"},
}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
ROUNDS = 40
PLAIN_DRAWS = 8  # draws in the shape of the original before surrogates may grow


def _digest(key: str, kind: Column, canon: Column, salt: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), kind, canon, salt.cast("string")), 256)


def _byte(digest: Column, k: Column) -> Column:
    return F.conv(F.substring(digest, (2 * F.pmod(k, F.lit(32)) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _script(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _pick(items: list[str] | str, n: Column) -> Column:
    at = (F.pmod(n, F.lit(len(items))) + 1).cast("int")
    if isinstance(items, str):
        return F.substring(F.lit(items), at, F.lit(1))
    return F.element_at(F.split(F.lit(" ".join(items)), " "), at)


def reshaped(value: Column, digest: Column) -> Column:
    """``value`` with its letters and digits replaced from the digest, each by one of its class, script and case."""

    def step(acc: Column, c: Column) -> Column:
        n = _byte(digest, acc["k"])
        small = F.lower(c)
        letter = F.when(_script(c) == "cyrillic", _pick(LETTERS["cyrillic"], n)).when(_script(c) == "greek", _pick(LETTERS["greek"], n))
        letter = letter.otherwise(_pick(LETTERS["latin"], n))
        letter = F.when(small != c, F.upper(letter)).otherwise(letter)
        new = F.when(c.rlike(r"\p{Nd}"), F.pmod(n, F.lit(10)).cast("string")).when(c.rlike(r"\p{L}"), letter).otherwise(c)
        moved = F.when(c.rlike(r"[\p{Nd}\p{L}]"), 1).otherwise(0)
        return F.struct(F.concat(acc["out"], new).alias("out"), (acc["k"] + moved).alias("k"))

    return F.aggregate(_chars(value), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), step)["out"]


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by ``digits``, one after another."""

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.rlike(r"\d")
        new = F.when(is_digit, F.substring(digits, acc["k"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(acc["out"], new).alias("out"), (acc["k"] + is_digit.cast("int")).alias("k"))

    return F.aggregate(_chars(value), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), step)["out"]


def luhn(digits: Column) -> Column:
    """Sum of a number's digits, every second from the right doubled and cast out by nine, modulo 10."""

    def step(acc: Column, c: Column) -> Column:
        d = c.cast("int") * (1 + acc["k"])
        return F.struct((acc["sum"] + F.when(d > 9, d - 9).otherwise(d)).alias("sum"), (1 - acc["k"]).alias("k"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("k"))
    return F.aggregate(F.reverse(_chars(digits)), start, step)["sum"] % 10


def _drawn(digest: Column, n: Column) -> Column:
    return F.substring(F.translate(digest, "abcdef", "012345"), F.lit(1), n)


def _name(raw: Column, kind: Column, digest: Column, salt: Column, syllables: int) -> Column:
    def made(script: str) -> Column:
        begin, middle = SYLLABLES[script]
        # a name that keeps colliding grows, so there is always a free one
        count = F.lit(syllables) + F.when(salt > PLAIN_DRAWS, F.least(salt - PLAIN_DRAWS, F.lit(8))).otherwise(0)
        parts = F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda i: F.concat(_pick(begin, (_byte(digest, i) / 16).cast("int")), _pick(middle, _byte(digest, i))),
        )
        end = F.lit("")
        for k, v in ENDINGS[script].items():
            end = F.when(kind == k, F.lit(v)).otherwise(end)
        return F.initcap(F.concat(F.array_join(parts, ""), end))

    name = F.when(_script(raw) == "cyrillic", made("cyrillic")).when(_script(raw) == "greek", made("greek")).otherwise(made("latin"))
    return F.when((F.upper(raw) == raw) & (F.length(raw) > 1), F.upper(name)).otherwise(name)


def surrogate(raw: Column, kind: Column, canon: Column, salt: Column, key: str, syllables: int = 3) -> Column:
    """The replacement of ``raw``, one spelling of the entity ``canon`` of that kind, in its ``salt``-th draw."""
    digest = _digest(key, kind, canon, salt)
    digits = F.regexp_replace(raw, r"\D", "")
    n = F.length(digits)
    local, domain = F.substring_index(raw, "@", 1), F.substring_index(raw, "@", -1)
    head = F.regexp_extract(domain, r"^(.*)(\.\p{L}+)$", 1)
    grown = F.when(salt > PLAIN_DRAWS, F.substring(digest, 40, 12)).otherwise("")
    site = reshaped(head, _digest(key, F.lit("domain"), F.lower(domain), F.lit(0)))
    email = F.concat(reshaped(local, digest), grown, F.lit("@"), site, F.regexp_extract(domain, r"\.\p{L}+$", 0))
    card = _drawn(digest, n - 1)
    check = F.pmod(luhn(digits) - luhn(F.concat(card, F.lit("0"))), F.lit(10)).cast("string")
    own = F.length(canon)  # what stands before is the country's prefix and stays
    phone = F.concat(F.substring(digits, F.lit(1), n - own), _drawn(digest, own))
    octets = F.concat_ws(".", *[(1 + F.pmod(_byte(digest, F.lit(k)), F.lit(254))).cast("string") for k in range(4)])
    iban = F.concat(F.substring(raw, 1, 2), reshaped(F.substring(raw, F.lit(3), F.length(raw)), digest))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", octets)
        .when(kind == "card", _refilled(raw, F.concat(card, check)))
        .when(kind == "iban", iban)
        .when(kind.isin("phone", "social"), _refilled(raw, phone))
        .otherwise(_name(raw, kind, digest, salt, syllables))
    )


def _kind(raw: Column, parts: Column) -> Column:
    named = F.filter(parts, lambda p: p["word"] == raw)
    return (
        F.when(F.size(named) > 0, F.get(named, F.lit(0))["kind"])
        .when(raw.contains("@"), "email")
        .when(raw.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$"), "ip")
        .when(raw.rlike("^[A-Z]{2}"), "iban")
        .when(raw.rlike(r"^\d{3}-\d{2}-\d{4}$"), "social")
        .when(F.length(F.regexp_replace(raw, r"\D", "")) >= 13, "card")
        .otherwise("phone")
    )


def _canon(raw: Column, kind: Column) -> Column:
    digits = F.regexp_replace(raw, r"\D", "")
    return (
        F.when(kind == "phone", F.substring(digits, F.greatest(F.lit(1), F.length(digits) - 9), F.lit(10)))
        .when(kind.isin("card", "social"), digits)
        .when(kind == "iban", F.regexp_replace(raw, " ", ""))
        .otherwise(F.lower(raw))
    )


def _name_parts(text: Column) -> Column:
    """Words of the names a text introduces by a form of address, with their kind: the last is the surname, the
    others are given names of the gender that the form tells."""
    titles, names = (F.regexp_extract_all(text, F.lit(TITLED), F.lit(g)) for g in (1, 2))

    def parts(pair: Column) -> Column:
        words = F.split(pair["names"], r"\s")
        given = F.when(pair["titles"].isin(FEMALE), "given_f").when(pair["titles"].isin(MALE), "given_m").otherwise("given")
        kind = lambda i: F.when(i == F.size(words) - 1, "surname").otherwise(given)
        return F.transform(words, lambda w, i: F.struct(kind(i).alias("kind"), w.alias("word")))

    pairs = F.arrays_zip(titles.alias("titles"), names.alias("names"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(pairs, parts))))


def with_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_pattern``, which finds this text's entities, and ``_found``, each as raw, kind and canon."""
    value = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<struct<kind:string,word:string>>")
    step = docs.withColumn("_quick", value.rlike(QUICK))
    step = step.withColumn("_parts", F.when(F.col("_quick"), F.when(value.rlike(TITLED), _name_parts(value))))
    step = step.withColumn("_parts", F.coalesce("_parts", none))
    words = F.array_join(F.array_distinct(F.transform("_parts", lambda p: p["word"])), "|")
    named = F.concat(F.lit(PLAIN + r"|(?<![\p{L}\p{M}])(?:"), words, F.lit(r")(?![\p{L}\p{M}])"))
    step = step.withColumn("_pattern", F.when(F.size("_parts") > 0, named).otherwise(PLAIN))
    raws = F.regexp_extract_all(value, F.col("_pattern"), F.lit(0))
    step = step.withColumn("_raws", F.when(F.col("_quick"), raws).otherwise(F.array().cast("array<string>")))

    def entity(raw: Column) -> Column:
        kind = _kind(raw, F.col("_parts"))
        return F.struct(raw.alias("raw"), kind.alias("kind"), _canon(raw, kind).alias("canon"))

    return step.withColumn("_found", F.transform("_raws", entity)).drop("_quick", "_parts", "_raws")


def redraws(entities: DataFrame, key: str, syllables: int = 3) -> DataFrame:
    """``(kind, canon, salt)`` of the entities whose first surrogate would not do: another entity of the kind has it, or
    it is itself an entity of the corpus. Of those that share a surrogate the smallest keeps it; the others draw anew,
    until all are distinct. ``entities`` holds distinct ``(kind, canon)``."""
    state = materialize(entities.select("kind", "canon", F.lit(0).alias("salt")), "entities")
    known = state.select("kind", F.col("canon").alias("surrogate")).withColumn("real", F.lit(True))
    for _ in range(ROUNDS):
        drawn = state.withColumn("surrogate", F.lower(surrogate(F.col("canon"), F.col("kind"), F.col("canon"), F.col("salt"), key, syllables)))
        firsts = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("salt", "canon")).alias("keeps"))
        firsts = firsts.join(known, ["kind", "surrogate"], "left")
        judged = materialize(drawn.join(firsts, ["kind", "surrogate"]), "drawn")
        again = F.col("real").isNotNull() | (F.col("keeps.canon") != F.col("canon"))
        if judged.where(again).isEmpty():
            return judged.where("salt > 0").select("kind", "canon", "salt")
        state = judged.select("kind", "canon", (F.col("salt") + again.cast("int")).alias("salt"))
    raise RuntimeError("surrogates still collide; give more syllables")


def replace_entities(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text", syllables: int = 3) -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced, and ``n_entities``, how many spans were.

    Found are e-mail addresses, IP addresses, payment cards, account numbers, social security and phone numbers, and
    names that a form of address introduces, with all later mentions of their words in the text. A surrogate is drawn
    from the entity by a hash keyed with ``secret``, so it is the same wherever the entity occurs, however it is
    written: phone and card numbers keep their separators and country prefix, cards their check sum, e-mails their
    shape, top domain and common domain, names their gender, script and capitals. Draws are checked over all entities
    of the table and repeated until no two share a surrogate and none is an entity itself.

    The replacement is an expression of the row alone; only the entities are shuffled, without their texts. The
    few that drew again reach their rows through a table of those keys, joined by key and text, which is broadcast
    after its size is known and shuffled otherwise. Null texts stay null; texts without entities are unchanged; repeated
    keys and rows are replaced alike. A column ``n_entities`` in ``docs`` is replaced.
    """
    columns = [c for c in docs.columns if c != "n_entities"]
    rows = docs.select(
        F.struct(*[f"`{c}`" for c in columns if c != text]).alias("_row"),  # so that no column clashes with those below
        F.col(text).alias("_text"),
        F.xxhash64(F.col(key).cast("string"), text).alias("_digest"),
    )
    found = with_entities(rows, "_text")
    spread = found.where(F.size("_found") > 0).select("_digest", F.explode("_found").alias("e")).select("_digest", "e.kind", "e.canon")
    spread = materialize(spread.distinct(), "mentions")
    extra = materialize(redraws(spread.select("kind", "canon").distinct(), secret, syllables), "redraws")
    if extra.isEmpty():
        found = found.withColumn("_salts", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>")))
    else:
        per_row = lookup_join(spread, extra, ["kind", "canon"]).groupBy("_digest").agg(
            F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\u0001", "kind", "canon"), "salt"))).alias("_salts")
        )
        found = lookup_join(found, per_row, "_digest", "left")

    def drawn(e: Column) -> Column:
        salt = F.coalesce(F.try_element_at("_salts", F.concat_ws("\u0001", e["kind"], e["canon"])), F.lit(0))
        return surrogate(e["raw"], e["kind"], e["canon"], salt, secret, syllables)

    found = found.withColumn("_new", F.transform("_found", drawn))
    gaps = F.split("_text", F.col("_pattern"), -1)
    joined = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get("_new", i), F.lit("")))), "")
    value = F.when(F.size("_found") > 0, joined).otherwise(F.col("_text"))
    kept = [value.alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in columns]
    return found.select(*kept, F.size("_found").alias("n_entities"))
