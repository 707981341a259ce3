"""Differencing: balance, indivisible groups, gapless slots, odd rows."""

import itertools
import random
import zlib

import pytest

from tests.llm.helpers import clashing, documents
from tillroll.llm.queries import op10_sharding
from tillroll.llm.sharding import balanced_groups, difference, sharded


def spread(sizes, placed, shards, start=None):
    sums = list(start or [0] * shards)
    for size, shard in zip(sizes, placed, strict=True):
        sums[shard] += size
    return max(sums) - min(sums)


def test_difference_is_close_to_the_best_partition():
    rng = random.Random(3)
    for _ in range(20):
        sizes = [rng.randrange(1, 60) for _ in range(8)]
        best = min(spread(sizes, p, 2) for p in itertools.product(range(2), repeat=8))
        assert spread(sizes, difference(sizes, 2), 2) <= best + max(sizes) // 2


def test_difference_known_case():
    # Differencing 8 7 6 5 4 in two: 1 6 5 4, 1 1 4, 1 3, 2.
    assert spread([8, 7, 6, 5, 4], difference([8, 7, 6, 5, 4], 2), 2) == 2


def test_difference_fills_up_what_shards_hold():
    rng = random.Random(5)
    sizes = [rng.randrange(1, 50) for _ in range(2000)]
    start = [9000, 100, 0, 4000]
    assert spread(sizes, difference(sizes, 4, start), 4, start) <= 5
    assert difference([], 4, start) == []


def test_blocks_with_a_giant_group_stay_balanced(spark):
    rng = random.Random(7)
    sizes = {k: rng.randrange(1, 3000) for k in range(3000)}
    sizes[9999] = sum(sizes.values()) // 10
    df = spark.createDataFrame(list(sizes.items()), "key long, bytes long")
    dealt = balanced_groups(df, 8, 200).collect()
    assert {r["key"]: r["bytes"] for r in dealt} == sizes and len(dealt) == len(sizes)
    sums = [sum(r["bytes"] for r in dealt if r["shard"] == s) for s in range(8)]
    assert max(sums) - min(sums) < 0.002 * sum(sums)


def test_laws_on_a_whole_table(spark):
    rows = op10_sharding(spark, "/root/testdata/sf0.01").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    shard_of, sums, slots = {}, [0] * 8, [[] for _ in range(8)]
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        assert shard_of.setdefault(raw, r["shard"]) == r["shard"]
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert max(sums) - min(sums) < 0.001 * sum(sums)
    assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "ab"), (3, "ab"), (3, "ab"), (4, "long " * 30_000)]
    got = sharded(clashing(documents(spark, rows))).collect()
    assert len(got) == 6
    by_text = {}
    for r in got:
        by_text.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    assert sorted(r["size"] for r in got) == [1, 1, 3, 3, 3, 150_001]
    assert sharded(documents(spark, [])).count() == 0


@pytest.mark.parametrize("shards", [1, 3])
def test_other_shard_counts(spark, shards):
    got = sharded(documents(spark, [(i, "x" * (i % 17)) for i in range(200)]), shards).collect()
    assert {r["shard"] for r in got} == set(range(shards))
