import time

import pytest
from pyspark.sql import functions as F

from lexiframe.functions import cleaning as cl
from lexiframe.functions import readability as rd
from lexiframe.functions import tokens as tk
from lexiframe.functions import wordlists as wl
from lexiframe.functions.syllables import syllables, syllables_refined

START = "*** START OF THE PROJECT GUTENBERG EBOOK X ***"
END = "*** END OF THE PROJECT GUTENBERG EBOOK X ***"


def test_strict_strip_needs_both_markers(apply):
    assert apply(cl.strip_boilerplate, f"a {START}\nbody\n{END} z") == "X ***\nbody"
    assert apply(cl.strip_boilerplate, f"a {START}\nbody") == f"a {START}\nbody"
    assert apply(cl.strip_boilerplate, f"body\n{END}") == f"body\n{END}"
    assert apply(cl.strip_boilerplate, f"{END} body {START}") == ""


def test_wide_strip_takes_one_marker_and_drops_the_line(apply):
    assert apply(cl.strip_boilerplate_lines, f"a {START}\nbody\n{END} z") == "body"
    assert apply(cl.strip_boilerplate_lines, f"a {START}\n body ") == "body"
    assert apply(cl.strip_boilerplate_lines, f"body\n{END}") == "body"
    assert apply(cl.strip_boilerplate_lines, "Produced by me") == "me"
    assert apply(cl.strip_boilerplate_lines, "plain") == "plain"


def test_front_matter_only_in_long_texts_and_far_enough(apply):
    text = "x" * 20 + "\nCHAPTER I\nbody"
    assert apply(lambda t: cl.skip_front_matter(t, 10, 5), text) == "\nCHAPTER I\nbody"
    assert apply(lambda t: cl.skip_front_matter(t, 10, 50), text) == text
    assert apply(lambda t: cl.skip_front_matter(t, 1000, 5), text) == text


def test_newlines_notes_and_control_characters(apply):
    assert apply(lambda t: cl.normalize_newlines(t, 2), "a\r\n\r\n\r\nb\nc") == "a\n\nb\nc"
    assert apply(lambda t: cl.normalize_newlines(t, 3), "a\n\nb\n\n\n\nc") == "a\n\nb\n\nc"
    assert apply(cl.drop_emphasis_and_notes, "_a__b_ [1] [x [y] z] [p\nq]") == "ab   z] [p\nq]"
    assert apply(cl.drop_control_chars, "a\x07\n\tb\x7f\x85") == "a\n\tb"
    assert apply(lambda t: cl.drop_control_chars(t, keep_newlines=False), "a\n\tb") == "ab"


def test_prefix_and_punctuation(apply):
    assert apply(lambda t: cl.take_prefix(t, 3), "abcdef") == "abc"
    assert apply(lambda t: cl.take_prefix(t, None), "abcdef") == "abcdef"
    assert apply(cl.punctuation_to_space, " Don’t,  stop_it -- é! ") == "Don t stop_it é"


@pytest.mark.parametrize("text", ["", "   ", "\n\t"])
def test_blank_texts_have_no_parts(apply, text):
    for split in (tk.sentences, tk.words, tk.letter_tokens, tk.word_char_tokens, tk.all_tokens, tk.paragraphs):
        assert apply(split, text) == []
    assert apply(lambda t: tk.counted(tk.words(t)), text) == []
    assert apply(lambda t: tk.ngrams(tk.words(t), 2), text) == []


def test_sentences_words_and_tokens(apply):
    assert apply(tk.sentences, 'He left. "Why?" she said!  No end') == ["He left.", '"Why?"', "she said!", "No end"]
    assert apply(tk.words, " a  b\nc ") == ["a", "b", "c"]
    assert apply(tk.letter_tokens, "It's 2 Élan") == ["it", "s", "élan"]
    assert apply(tk.word_char_tokens, "It's 22 a_b x") == ["it", "22", "a_b"]
    assert apply(tk.all_tokens, "It's 22!") == ["It", "'", "s", "22", "!"]
    assert apply(lambda t: tk.without(tk.words(t), ["b"], 2), "aa b cc d") == ["aa", "cc"]
    kept = apply(lambda t: tk.sentence_tokens(t, ["the"]), "The a b c. The d e. F g h i.")
    assert kept == [["a", "b", "c"], ["f", "g", "h", "i"]]


def test_ngrams_counts_and_merging(apply):
    assert apply(lambda t: tk.ngrams(tk.words(t), 2), "a b c") == ["a b", "b c"]
    assert apply(lambda t: tk.ngrams(tk.words(t), 3), "a b") == []
    assert apply(lambda t: tk.ngrams_upto(tk.words(t), 2), "a b") == ["a", "b", "a b"]
    assert [tuple(r) for r in apply(lambda t: tk.counted(tk.words(t)), "b a b")] == [("a", 1), ("b", 2)]
    pairs = F.array(F.lit("a_b"), F.lit("b_c"))
    aa = F.array(F.lit("a_a"))
    for few in (32, 0):  # both ways to look a pair up
        assert apply(lambda t: tk.merged_pairs(tk.words(t), pairs, few_pairs=few), "a b c a b") == ["a_b", "c", "a_b"]
        assert apply(lambda t: tk.merged_pairs(tk.words(t), pairs, few_pairs=few), "b c a b c c") == ["b_c", "a_b", "c", "c"]
        assert apply(lambda t: tk.merged_pairs(tk.words(t), aa, few_pairs=few), "a a a") == ["a_a", "a"]
        assert apply(lambda t: tk.merged_pairs(tk.words(t), aa, few_pairs=few), "x") == ["x"]
        assert apply(lambda t: tk.merged_pairs(tk.words(t), aa, few_pairs=few), "") == []


def test_plain_syllables_by_hand(apply):
    want = {"": 0, "hmm": 1, "make": 1, "table": 3, "the": 1, "Society": 3, "radio": 1, "baked": 2, "le": 1, "apple.": 2}
    assert {w: apply(syllables, w) for w in want} == want


def test_refined_syllables_by_hand(apply):
    found = {w: apply(syllables_refined, w) for w in ("society", "baked", "boxes", "pies", "table", "happy", "trial")}
    assert found == {"society": 3, "baked": 1, "boxes": 1, "pies": 1, "table": 3, "happy": 3, "trial": 1}


def test_stop_words_algebra():
    stops = wl.stop_words()
    assert "not" not in stops and "nature" in stops and "the" in stops and stops == sorted(set(stops))


def test_readability_defaults_to_zero(spark):
    zero = F.lit(0)
    row = spark.range(1).select(
        rd.flesch(zero, zero, zero), rd.fog(zero, zero, zero), rd.smog(zero, zero, zero),
        rd.automated_readability(zero, zero, zero), rd.coleman_liau(zero, zero, zero), rd.dale_chall(zero, zero, zero),
    ).first()
    assert list(row) == [0.0] * 6


def test_long_runs_of_one_kind_take_linear_time(spark):
    """Texts of a million characters that a backtracking or restarting expression would not get through."""
    n = 1_000_000
    texts = ["a" + " " * n + "b", " " * n, "[" * n, "[x " * (n // 3) + "]", "\n" * n, "_" * n, "." * n, "a. " * (n // 3), "\r\n" * (n // 2)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(len(texts))
    t = F.col("t")
    cleaned = {
        "stripped": cl.strip_ws(t), "notes": cl.drop_emphasis_and_notes(t), "plain": cl.punctuation_to_space(t),
        "strict": cl.clean_strict(t), "wide": cl.clean_wide(t), "sentences": F.size(tk.sentences(t)), "words": tk.n_words(t),
    }
    begun = time.perf_counter()
    got = {r["i"]: r for r in rows.select("i", *[c.alias(k) for k, c in cleaned.items()]).collect()}
    assert time.perf_counter() - begun < 60
    assert got[0]["stripped"] == texts[0] and got[1]["stripped"] == "" and got[0]["plain"] == "a b"
    assert got[2]["notes"] == texts[2] and got[3]["notes"] == "" and got[5]["notes"] == ""
    assert got[7]["words"] == n // 3


def test_brackets_and_blanks_as_before(apply):
    for text, want in [("a [b] c", "a  c"), ("[a [b] c]", " c]"), ("[a\n] b", "[a\n] b"), ("[[x]", ""), ("]a[", "]a["), ("[a [b\n[c]", "[a [b\n")]:
        assert apply(cl.drop_emphasis_and_notes, text) == want
    for text in ["", "  ", " a ", "\ta\u00a0", "a  b  ", "\u2003\n x y \u2003"]:
        assert apply(cl.strip_ws, text) == text.strip()
