import time

import pytest

from lexiframe.llm import decontaminate
from lexiframe.llm.decontaminate import canonical, contaminated, drop_contaminated

from .cases import MEDIUM, documents, edge_docs, prose

ITEMS = [
    (1, "Anna has 12 apples and gives Anna's friend, Bob, 5 apples. How many apples does she keep now?"),
    (2, "A train runs 300 km in 4 hours while another train runs 300 km in 6 hours; which one is faster and why"),
    (3, "short item here"),
    (4, None),
    (5, ""),
    (6, "7 8 9 10 11 12 13 14 15"),
]
ITEM_TYPE = "item_id long, text string"


def ids(df):
    return {r["doc_id"]: r["items"] for r in df.collect()}


def test_placeholders(spark):
    df = spark.createDataFrame([("Then Anna, of Rome, ran 3.5 km in 10kg! She\nwon 20% of it. Ärger 7m",)], "t string")
    got = df.select(canonical(df.t).alias("t")).first()["t"]
    name, number, unit = "\x01\x02\x03"
    other = df.select(canonical(df.t, 1).alias("t")).first()["t"]
    assert [t for t, u in zip(got, other) if t != u] == ["then", "she", "ärger"] and {u for t, u in zip(got, other) if t != u} == {name}
    assert got == ["then", name, "of", name, "ran", number, unit, "in", number, unit, "she", "won", number, unit, "of", "it", "ärger", number, unit]


def test_reparameterised_questions(spark):
    docs = [
        (0, prose(1, 50) + " a train runs 120 km in 9 hours while another train runs 120 km in 7 hours; which one is faster and why " + prose(2, 9)),
        (1, "a train runs 120 km in 9 hours while another train runs 130 km in 7 hours; which one is faster and why"),  # one slot, two values
        (2, "a train runs 9 miles in 9 hours while another train runs 9 miles in 7 hours; which one is faster and why"),  # two slots, one value
        (3, "A bus goes 300 km in 4 hours and another bus goes 310 km in 7 hours; which one is slower and where"),
        (4, "say it: short item here"),
        (5, "1 2 3 4 5 6 7 8 9"),  # no words: slots must be equal
        (6, "now 7 8 9 10 11 12 13 14 15 it is"),
        (7, ITEMS[0][1].replace("Anna", "Maria").replace("Bob", "Paul").replace("12", "40")),
        (8, None),
        (9, ""),
        (10, prose(7, 400)),
    ]
    got = ids(contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(ITEMS, ITEM_TYPE)))
    assert set(got) == {0, 4, 6, 7} | ({1, 2} & set(got))
    assert got[0] == [2] and got[4] == [3] and got[6] == [6] and got[7] == [1]
    whole = ids(contaminated(spark.createDataFrame(docs[:3], "doc_id long, text string"), spark.createDataFrame(ITEMS[1:2], ITEM_TYPE)))
    assert set(whole) == {0}


def test_copies_with_one_changed_value(spark):
    docs = [
        (0, ITEMS[1][1].replace("300 km in 6", "310 km in 6")),  # 300 stands for 300 and for 310
        (1, ITEMS[1][1].replace("in 6 hours", "in 4 hours")),  # 4 and 6 both stand for 4
        (2, "a train runs 120 km in 9 hours while another train runs 130 km in 7 hours; which one is faster and why"),
    ]
    got = ids(contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(ITEMS[1:2], ITEM_TYPE)))
    assert got == {0: [2], 1: [2]}


def test_names_that_begin_sentences(spark):
    items = spark.createDataFrame([(1, "Tom has 3 red pens. Ann gives Tom 5 pens. Tom loses 2 pens. Ann buys 4 pens.")], ITEM_TYPE)
    docs = [
        (0, "Bob has 8 red pens. Sue gives Bob 1 pens. Bob loses 6 pens. Sue buys 9 pens."),
        (1, "Bob has 8 red pens. Sue gives Max 1 pens. Kim loses 6 pens. Lea buys 9 pens."),  # Tom would be three people
        (2, "They said: Tom has 3 red pens. Ann gives Tom 5 pens. Tom loses 2 pens. Ann buys 4 pens."),
        (3, "Tom ate. Ann sat. Sue ran. Max hid. Lea won. Kim lost. Bob cried. Eve left."),
    ]
    assert ids(contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items)) == {0: [1], 2: [1]}


def test_units_are_slots(spark):
    items = spark.createDataFrame([(1, "a car goes 5 km to town and then another 5 km to work before it stops for good")], ITEM_TYPE)
    docs = [
        (0, "a car goes 7 miles to town and then another 7 miles to work before it stops for good"),
        (1, "a car goes 7 km to town and then another 7 miles to work before it stops for good"),  # km stands for two units
    ]
    got = {r["doc_id"]: r["n_windows"] for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {0: 12}


def test_long_texts_take_linear_time(spark):
    item = "a train runs 300 km in 4 hours while another train runs 310 km in 6 hours which one is faster and why"
    items = spark.createDataFrame([(1, item)], ITEM_TYPE)
    seconds = []
    for n in (1000, 4000):
        docs = spark.createDataFrame([(1, (item.replace("300", "500") + ". ") * n), (2, "1,2,3," * (10 * n) + "4"), (3, "Ab " * n)], "doc_id long, text string")
        begun = time.perf_counter()
        rows = contaminated(docs, items).collect()
        seconds.append(time.perf_counter() - begun)
        assert [r["doc_id"] for r in rows] == [1] and rows[0]["n_windows"] > 10 * n
    assert seconds[1] < 12 * seconds[0]


def brute(rows, items, width=8):
    import re

    tokens = lambda t: re.findall(r"[^\W\d_]+|[\x01]", re.sub(r"(?<=[^\W\d_A-ZÀ-ÞŒ]\s)[A-ZÀ-ÞŒ][^\W\d_]*|(?<=[,;]\s)[A-ZÀ-ÞŒ][^\W\d_]*", "\x01", t).lower())
    grams: dict = {}
    for k, t in items:
        w = tokens(t)
        for i in range(len(w) - width + 1):
            grams.setdefault(tuple(w[i : i + width]), set()).add(k)
    out = {}
    for k, t in rows:
        w = tokens(t)
        found = set().union(*(grams.get(tuple(w[i : i + width]), ()) for i in range(len(w) - width + 1)))
        if found:
            out[k] = sorted(found)
    return out


def test_table(spark):
    docs, items = documents(spark, MEDIUM), spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert ids(contaminated(docs, items)) == want and len(want) > 10


@pytest.mark.parametrize("small", [True, False])
def test_join_by_shuffle_gives_the_same(spark, monkeypatch, small):
    docs, items = documents(spark, MEDIUM), spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    want = ids(contaminated(docs, items))
    if not small:
        plain = decontaminate.lookup_join
        monkeypatch.setattr(decontaminate, "lookup_join", lambda a, b, on, how="inner": plain(a, b, on, how, max_rows=0))
    assert ids(contaminated(docs, items)) == want


def test_edges(spark):
    docs = edge_docs(spark, keyed=False)
    items = spark.createDataFrame([(1, prose(1, 40)), (2, None), (None, prose(2, 12))], ITEM_TYPE)
    assert ids(contaminated(docs, items)) == {6: [1], 7: [1], 8: [1], 15: [1]}
    assert ids(contaminated(docs, items.limit(0))) == {} and ids(contaminated(docs.limit(0), items)) == {}
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 6
