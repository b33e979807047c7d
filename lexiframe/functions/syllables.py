"""Syllable estimates for one word, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiframe.functions.tokens import let

# Words whose syllables are given rather than estimated.
SYLLABLE_EXCEPTIONS = {
    "the": 1,
    "every": 2,
    "different": 3,
    "difficult": 3,
    "beautiful": 3,
    "absolutely": 4,
    "area": 2,
    "business": 2,
    "camera": 3,
    "poem": 2,
    "poems": 1,
    "through": 1,
    "thoroughly": 3,
    "thought": 1,
    "variable": 4,
    "society": 3,
    "science": 2,
}
# Vowel pairs spoken as one sound.
GLIDES = ["ia", "io", "ua", "uo"]
GLIDES_WIDE = ["io", "ia", "eo", "ua", "uo", "ie"]
# Vowels that begin no wide glide: as many as there are vowels less glides.
_ENDS = {v: "".join(g[1] for g in GLIDES_WIDE if g[0] == v) for v in "aeiouy"}
SOUNDED = "|".join(f"{v}(?![{ends}])" if ends else v for v, ends in _ENDS.items())


def _vowel_groups(word: Column) -> Column:
    return F.regexp_count(word, F.lit("[aeiouy]+"))


def syllables(word: Column, lowered: bool = False) -> Column:
    """Vowel groups with a silent-e, a consonant+le and a glide correction; at least 1, empty word 0."""
    w = word if lowered else F.lower(word)
    groups = _vowel_groups(w)
    ends = (
        F.when(w.endswith("le"), groups + w.rlike("[^aeiouy]le$").cast("int"))
        .when(w.endswith("e"), F.greatest(groups - 1, F.lit(1)))
        .otherwise(groups)
    )
    glides = sum((F.contains(w, F.lit(g)).cast("int") for g in GLIDES), F.lit(0))
    return F.when(w == "", 0).otherwise(F.greatest(ends - glides, F.lit(1)))


def syllables_refined(word: Column, lowered: bool = False) -> Column:
    """Exception table, suffix stripping, single vowels less glides, and e/le/y endings."""
    w = word if lowered else F.lower(word)
    listed = F.create_map(*[F.lit(x) for kv in SYLLABLE_EXCEPTIONS.items() for x in kv])
    known = F.when(w.isin(list(SYLLABLE_EXCEPTIONS)), F.try_element_at(listed, w))  # a map is searched entry by entry
    shorter = F.substring(w, F.lit(1), F.length(w) - 2)
    stem = (
        F.when(w.endswith("es"), F.when(w.rlike("(ies|ves|oes)$"), w).otherwise(shorter))
        .when(w.endswith("ed") & ~w.endswith("ied"), shorter)
        .otherwise(w)
    )
    return F.when(w == "", 0).otherwise(F.coalesce(known, let(stem, _sounded)))


def _sounded(stem: Column) -> Column:
    count = F.regexp_count(stem, F.lit(SOUNDED))
    ends = (
        F.when(stem.endswith("e"), F.when(stem.rlike("(le|ie|ee|oe)$"), count).otherwise(F.greatest(count - 1, F.lit(1))))
        .otherwise(count)
    )
    extra = F.when(stem.endswith("le") | stem.endswith("y"), stem.rlike("[^aeiouy](le|y)$").cast("int")).otherwise(0)
    return F.greatest(ends + extra, F.lit(1))
