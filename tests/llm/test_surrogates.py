import re

import pytest
from pyspark.sql import functions as F

from lexiframe.llm import surrogates
from lexiframe.llm.surrogates import luhn, redraws, replace_entities

from .cases import MEDIUM, documents, edge_docs

KEY = "k1"


@pytest.fixture(scope="module")
def put(spark):
    def run(texts, **options):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return [r["text"] for r in sorted(replace_entities(df, options.pop("secret", KEY), **options).collect())]

    return run


def shape(text):
    return re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "0", text)))


def python_luhn(digits):
    return sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 * (int(d) > 4)) for i, d in enumerate(reversed(digits))) % 10


def test_formats_and_coreference(put):
    texts = [
        "write to Ann.Lee7@mail4.example.com or ann.lee7@MAIL4.example.com, not bob@mail4.example.com.",
        "call +1 (017) 555-7713, 017-555-7713 or (017) 555 7713; server 129.38.82.176 end",
        "card 4845168114407329 and 4845 1681 1440 7329, ssn 123-45-6789, iban DE89 3704 0044 0532 0130 00.",
        "nothing here but 12 apples, 3.14, v1.2.3 and 2024-01-02",
        "ann.lee7@mail4.example.com",
    ]
    got = put(texts)
    assert got[3] == texts[3]
    for old in ("lee7", "mail4", "555", "7713", "129.38", "4845", "6789", "3704", "bob"):
        assert not any(old in g.lower() for g in got), old
    a, b, c = re.findall(r"\S+@[\w.]+\w", got[0])
    assert a.lower() == b.lower() == got[4] and a != b
    assert len({x.split("@")[1].lower() for x in (a, b, c)}) == 1 and c.lower() != a.lower()
    assert shape(got[0]).replace("A", "a") == shape(texts[0]).replace("A", "a")
    assert shape(got[1].split(";")[0]) == shape(texts[1].split(";")[0])
    phones = [re.sub(r"\D", "", p)[-10:] for p in re.split(",| or ", got[1].split(";")[0])]
    assert len(set(phones)) == 1 and "+1 (" in got[1]
    cards = re.findall(r"\d(?:[ ]?\d){15}", got[2])
    assert cards[0] == cards[1].replace(" ", "") and python_luhn(cards[0]) == python_luhn("4845168114407329")
    assert re.search(r"iban DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d\.", got[2])


def test_names_keep_gender_script_and_capitals(put):
    got = put([
        "Mrs. Anna Kowalski met Mr. John Stone. Later Kowalski and JOHN left; Anna and Stone stayed, annals and Stones too. John came.",
        "Herr Anna Stone; г-жа Анна Петрова и Петрова.",
        "Anna and Stone without any form of address",
    ])
    m = re.match(r"Mrs\. (\w+) (\w+) met Mr\. (\w+) (\w+)\. Later (\w+) and JOHN left; (\w+) and (\w+) stayed, annals and Stones too\. (\w+) came\.", got[0])
    anna, kowalski, john, stone = m.groups()[:4]
    assert m.groups()[4:] == (kowalski, anna, stone, john)
    assert anna.endswith("a") and john.endswith("us") and len({anna, kowalski, john, stone}) == 4
    other = re.match(r"Herr (\w+) (\w+); г-жа (\w+) (\w+) и (\w+)\.", got[1]).groups()
    assert other[1] == stone and other[0].endswith("us")
    assert other[3] == other[4] and all(re.fullmatch("[А-Яа-я]+", w) for w in other[2:]) and other[2].endswith("а")
    assert got[2] == "Anna and Stone without any form of address"


def test_another_key_gives_others(put):
    text = ["a.b@c.org 129.38.82.176"]
    assert put(text) == put(text) and put(text) != put(text, secret="k2") != text


def test_collisions_are_drawn_anew(spark, put):
    names = [chr(65 + i % 26) + chr(97 + i // 26) + "q" + chr(97 + i % 7) + "z" for i in range(300)]
    texts = [f"Mr. {n} said so and {n} left" for n in names]
    got = put(texts, syllables=1)  # 256 names for 300
    found = [re.match(r"Mr\. (\w+) said so and (\w+) left", g).groups() for g in got]
    assert all(a == b for a, b in found) and len({a for a, _ in found}) == len(set(names))
    assert not {a for a, _ in found} & set(names)


def test_no_surrogate_is_an_entity(spark):
    canon = "bqzt"
    df = spark.createDataFrame([("surname", canon)], "kind string, canon string")
    taken = df.select(F.lower(surrogates.surrogate(F.col("canon"), F.col("kind"), F.col("canon"), F.lit(0), KEY))).first()[0]
    both = spark.createDataFrame([("surname", canon), ("surname", taken)], "kind string, canon string")
    assert canon in {r["canon"] for r in redraws(both, KEY).collect()}


def test_luhn(spark):
    for n in ("4845168114407329", "79927398713", "0", "18"):
        assert spark.range(1).select(luhn(F.lit(n))).first()[0] == python_luhn(n)


def test_table(spark):
    docs = documents(spark, MEDIUM).select("doc_id", "text", "lang")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = replace_entities(docs, KEY)
    assert got.columns == ["doc_id", "text", "lang", "n_entities"]
    rows = got.collect()
    assert len(rows) == len(texts)
    find = re.compile(r"[\w.]+@[\w.]+\.\w+|\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b|(?<!\w)\d{16}(?!\w)|\(\d{3}\) \d{3}-\d{4}")
    seen: dict = {}
    for r in rows:
        old = find.findall(texts[r["doc_id"]])
        assert (r["n_entities"] > 0) == bool(old) and (old or r["text"] == texts[r["doc_id"]])
        new = find.findall(r["text"])
        assert [shape(o) for o in old if "." not in o] == [shape(n) for n in new if "." not in n]
        for o, n in zip(old, new, strict=True):
            assert o != n and o not in r["text"] and seen.setdefault(o, n) == n
    assert len(set(seen.values())) == len(seen) > 20


def test_edges(spark):
    docs = edge_docs(spark, keyed=False).withColumn("n_entities", F.lit("clash"))
    got = replace_entities(docs, KEY)
    assert [c for c in got.columns if c != "n_entities"] == [c for c in docs.columns if c != "n_entities"]
    back = got.drop("n_entities").collect()
    assert sorted(map(str, back)) == sorted(map(str, docs.drop("n_entities").collect()))
    assert replace_entities(docs.limit(0), KEY).collect() == []
