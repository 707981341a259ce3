"""SimHash: fingerprints, trie self-join and components against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import clashing, documents
from tillroll.llm.connected import connected_components
from tillroll.llm.queries import op6_simhash
from tillroll.llm.simhash import (
    fingerprint,
    fingerprint_links,
    near_duplicates,
    one_of_each,
    trie_roots,
)


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace(
        "\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = [2 * sum(h >> b & 1 for h in hashes) > len(hashes) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b])


def plain_components(items, linked):
    """Smallest member of each item's class."""
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def close(a, b):
    return bin(a ^ b).count("1") <= 3


def clustered(rng, n):
    """Fingerprints with dense clusters, chains and singles."""
    values = set()
    while len(values) < n:
        centre = rng.getrandbits(64)
        values.add(centre)
        for _ in range(rng.choice([0, 0, 3, 40])):
            for _ in range(rng.randrange(1, 5)):
                centre ^= 1 << rng.randrange(64)
            values.add(centre)
    return sorted(values)[:n]


def test_fingerprint_by_the_letter():
    rng = random.Random(1)
    texts = [None, "", " \n\t", "One", "One two", "one TWO three", "É é\x0bß\x0c x y z", "a a a a a a a"]
    texts += [" ".join(rng.choice("AbCdé") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    for text in texts:
        assert fingerprint(text) & (2**64 - 1) == plain_fingerprint(text), text


def test_trie_against_all_pairs():
    rng = random.Random(2)
    for bits in (8, 20, 64):
        values = sorted({v & ((1 << bits) - 1) for v in clustered(rng, 300)})
        got = trie_roots(np.zeros(len(values), int), np.array(values, np.uint64), bits, 3)
        assert got.tolist() == plain_components(values, close)


def test_trie_keeps_groups_apart():
    group, value = np.array([0, 0, 1, 1]), np.array([1, 2, 1, 3], np.uint64)
    assert trie_roots(group, value, 64, 3).tolist() == [0, 0, 2, 2]


def test_links_connect_as_all_pairs_do(spark):
    values = clustered(random.Random(4), 400)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    expected = plain_components(values, close)
    for trie_rows in (50_000, 5):
        df = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
        links = [(r["a"], r["b"]) for r in fingerprint_links(df, 3, trie_rows).collect()]
        at = {v: i for i, v in enumerate(signed)}
        pairs = {frozenset((at[a], at[b])) for a, b in links}
        got = plain_components(list(range(len(values))), lambda i, j: frozenset((i, j)) in pairs)
        assert got == expected


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(1000, 1000 + i) for i in range(1, 200)] + [(2000 + i, 2001 + i) for i in range(60)]
    df = spark.createDataFrame([*links, (None, 3), (5000, 5000)], "a long, b long")
    nodes = sorted({x for pair in links for x in pair} | {5000})
    pairs = {frozenset(x) for x in links}
    expected = [nodes[i] for i in plain_components(nodes, lambda a, b: frozenset((a, b)) in pairs)]
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert got == dict(zip(nodes, expected, strict=True))
    assert connected_components(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_fingerprint(r["text"]) for r in docs]
    roots = plain_components(prints, close)
    expected = {
        (r["doc_id"], f"{p:016x}", docs[k]["doc_id"])
        for r, p, k in zip(docs, prints, roots, strict=True)
    }
    got = [tuple(r) for r in op6_simhash(spark, "/root/testdata/sf0.01").collect()]
    assert len(got) == len(docs) and set(got) == expected


def test_odd_rows(spark):
    text = "many words " * 40_000
    rows = [(9, None), (8, ""), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (6, text), (7, text)]
    got = near_duplicates(clashing(documents(spark, rows))).collect()
    named = sorted((r["doc_id"] or 0, r["component_id"]) for r in got)
    assert named == [(0, 5), (5, 5), (5, 5), (6, 6), (7, 6), (8, 8), (9, 8)]
    assert {r["fp"] for r in got if r["doc_id"] in (8, 9)} == {0}
    assert near_duplicates(documents(spark, [])).count() == 0


def test_one_of_each_carries_columns_of_any_name(spark):
    rows = [(3, "a b c d"), (1, "A b c d"), (None, "a b c d"), (2, "other words are here"), (None, None), (None, ""), (1, "a b c d")]
    df = documents(spark, rows).withColumns({"__row": F.lit("r"), "__fp": F.lit("f"), "fp": F.lit(1)})
    out = one_of_each(df).collect()
    assert sorted((r["doc_id"] or 0, r["__row"], r["__fp"], r["fp"]) for r in out) == [(0, "r", "f", 1), (1, "r", "f", 1), (2, "r", "f", 1)]
    assert one_of_each(documents(spark, [])).count() == 0
