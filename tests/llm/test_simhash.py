import itertools
import random

import pytest
import xxhash

from lexiframe.llm.components import components
from lexiframe.llm.simhash import covering_masks, drop_near_duplicates, near_duplicates, near_links

from .cases import MEDIUM, documents, edge_docs, edge_rows, joined


def plain(text, width=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    grams = [words[i : i + width] for i in range(len(words) - width + 1)] or [words]
    hashes = [xxhash.xxh64(" ".join(g).encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows, radius=2):
    prints = {k: plain(t) for k, t in rows}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= radius]
    roots = joined(list(prints), links)
    return {k: (prints[k], roots[k]) for k in prints}


@pytest.mark.parametrize("radius", [2, 4])
def test_masks_cover(radius):
    masks = covering_masks(radius)
    rng = random.Random(1)
    for bits in [rng.sample(range(64), radius) for _ in range(2000)]:
        x = sum(1 << b for b in bits)
        assert any(not x & m for m in masks)


@pytest.mark.parametrize("direct", [0, 32])
def test_like_all_pairs(spark, direct):
    docs = documents(spark, MEDIUM)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component"]) for r in near_duplicates(docs, direct=direct).collect()}
    assert got == expected(rows)


@pytest.mark.parametrize("radius", [2, 4])
@pytest.mark.parametrize("direct", [0, 3, 1000])
def test_crowded_buckets(spark, direct, radius):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = {0} | set(base)
    for b in base:
        for _ in range(60):
            prints.add(b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(1, 6))))
    prints = list(prints)
    signed = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    links = near_links(spark.createDataFrame(signed, "fp long, rep long"), radius, direct)
    want = [(i, j) for i, j in itertools.combinations(range(len(prints)), 2) if (prints[i] ^ prints[j]).bit_count() <= radius]
    for r in links.collect():
        assert (prints[r["a"]] ^ prints[r["b"]]).bit_count() <= radius
    roots = joined(range(len(prints)), want)
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert {i: found.get(i, i) for i in range(len(prints))} == roots


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r[0], r[1]) for r in edge_rows() if r[0] is not None]
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["fp"] % (1 << 64), r["component"]) for r in got} == expected(rows)
    assert near_duplicates(docs.limit(0)).collect() == []
    kept = drop_near_duplicates(edge_docs(spark, keyed=False))
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert None in ids and ids.count(6) == 3 and 7 not in ids and 8 not in ids


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, j) for j in range(200, 260)] + [(260, 259), (5, 5), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = list(range(100, 141)) + [7] + list(range(200, 261))
    assert got == joined(nodes, [x for x in links if None not in x and x != (5, 5)])
