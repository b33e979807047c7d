"""SQL for the text functions, written independently of the Column expressions."""

from __future__ import annotations

from lexiframe.functions import syllables as syl
from lexiframe.functions import wordlists as wl
from lexiframe.queries.inputs import quoted

STOPS = wl.stop_words()
STOPS_SQL = quoted(STOPS)


def sentences(text: str) -> str:
    return (
        "list_filter(string_split(regexp_replace(" + text + r""", '([.!?]+["'')\]]*)[\t-\r\x1c-\x20\x85\p{Z}]+', '\1' || chr(1), 'g'), chr(1)), """
        r"lambda z: regexp_matches(z, '[^\t-\r\x1c-\x20\x85\p{Z}]'))"
    )


def words(text: str) -> str:
    return rf"list_filter(string_split_regex({text}, '[\t-\r\x1c-\x20\x85\p{{Z}}]+'), lambda z: z <> '')"


def n_words(text: str) -> str:
    return rf"len(regexp_extract_all({text}, '[^\t-\r\x1c-\x20\x85\p{{Z}}]+'))"


def letters(text: str) -> str:
    return rf"regexp_extract_all({text}, '\p{{L}}+')"


def word_chars(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def all_tokens(text: str) -> str:
    return rf"regexp_extract_all({text}, '\p{{L}}+|\p{{N}}+|[^\p{{L}}\p{{N}}\s]')"


def trimmed(text: str) -> str:
    return rf"regexp_replace({text}, '^[\t-\r\x1c-\x20\x85\p{{Z}}]+|[\t-\r\x1c-\x20\x85\p{{Z}}]+$', '', 'g')"


def syllables(word: str) -> str:
    """Via a lower-cased word ``w``; ``word`` is any SQL string expression."""
    w = f"lower({word})"
    groups = f"len(regexp_extract_all({w}, '[aeiouy]+'))"
    glides = " + ".join(f"CAST(contains({w}, '{g}') AS BIGINT)" for g in syl.GLIDES)
    return f"""CASE WHEN {w} = '' THEN 0 ELSE greatest(1, CASE
        WHEN ends_with({w}, 'le') AND length({w}) > 2 AND instr('aeiouy', substr({w}, -3, 1)) = 0 THEN {groups} + 1
        WHEN ends_with({w}, 'e') AND NOT ends_with({w}, 'le') THEN greatest(1, {groups} - 1)
        ELSE {groups} END - ({glides})) END"""


def syllables_refined(word: str) -> str:
    w = f"lower({word})"
    known = " ".join(f"WHEN '{k}' THEN {v}" for k, v in syl.SYLLABLE_EXCEPTIONS.items())
    stem = f"""(CASE WHEN ends_with({w}, 'es') AND right({w}, 3) NOT IN ('ies', 'ves', 'oes') THEN left({w}, length({w}) - 2)
        WHEN ends_with({w}, 'ed') AND NOT ends_with({w}, 'es') AND right({w}, 3) <> 'ied' THEN left({w}, length({w}) - 2)
        ELSE {w} END)"""
    vowels = "len(regexp_extract_all(s, '[aeiouy]'))"
    pairs = " + ".join(f"(length(s) - length(replace(s, '{g}', ''))) // 2" for g in syl.GLIDES_WIDE)
    sounded = f"({vowels} - ({pairs}))"
    body = f"""(CASE WHEN right(s, 1) = 'e' AND right(s, 2) NOT IN ('le', 'ie', 'ee', 'oe')
          THEN greatest(1, {sounded} - 1) ELSE {sounded} END)
        + (CASE WHEN right(s, 2) = 'le' AND length(s) > 2 AND instr('aeiouy', substr(s, -3, 1)) = 0 THEN 1 ELSE 0 END)
        + (CASE WHEN right(s, 1) = 'y' AND length(s) > 1 AND instr('aeiouy', substr(s, -2, 1)) = 0 THEN 1 ELSE 0 END)"""
    return (
        f"CASE WHEN {w} = '' THEN 0 ELSE coalesce(CASE {w} {known} END, "
        f"list_transform([{stem}], lambda s: greatest(1, {body}))[1]) END"
    )


def n_substring(text: str, term: str) -> str:
    t = term.replace("'", "''")
    return f"((length({text}) - length(replace({text}, '{t}', ''))) // {len(term)})"


def share_of(tokens: str, items: list[str]) -> str:
    return f"len(list_filter({tokens}, lambda z: z IN ({quoted(items)})))"
