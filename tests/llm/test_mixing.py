"""Mixing: permutations, targets, words taken, and the texts of the mix."""

import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import clashing, documents
from tillroll.llm.mixing import (
    mix,
    mixed_documents,
    mixed_sizes,
    permuted,
    shard_counts,
    shares,
    targets,
)
from tillroll.llm.queries import op7_mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """By raising a common level until all is given out."""
    total = sum(sizes)
    weights = [Fraction(1 + i % 3) for i in range(len(sizes))]
    breaks = sorted({3 * s / w for s, w in zip(sizes, weights, strict=True)})
    given = lambda level: sum(min(level * w, 3 * s) for s, w in zip(sizes, weights, strict=True))
    low = Fraction(0)
    for high in breaks:
        if given(high) >= total:
            break
        low = high
    free = sum(w for s, w in zip(sizes, weights, strict=True) if 3 * s / w > low)
    level = low + (total - given(low)) / free if free else low
    return [float(min(level * w, 3 * s)) for s, w in zip(sizes, weights, strict=True)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1], [0, 5, 900, 2, 0, 77], [4], [0], []])
def test_targets(sizes):
    got = targets(sizes, [1 + i % 3 for i in range(len(sizes))])
    assert got == pytest.approx(plain_targets(sizes) if sum(sizes) else [0.0] * len(sizes))
    assert sum(got) == pytest.approx(sum(sizes))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 4097])
def test_permutation(n):
    index = np.arange(n)
    there = permuted(index, n, 12345)
    assert sorted(there.tolist()) == list(range(n))
    assert permuted(there, n, 12345, inverse=True).tolist() == list(range(n))
    if n > 100:
        assert permuted(index, n, 12346).tolist() != there.tolist()
        assert (there == index).mean() < 0.05


def test_shards_draw_every_slot_once():
    plan = shares({"a": 9000, "b": 500, None: 4000}, 10, 1)
    rows = shard_counts(plan, 64, 1)
    for share in plan:
        own = sorted((first, n) for _, s, first, n in rows if s == share.number)
        assert [f for f, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) == share.slots
    by_shard = Counter()
    for shard, _, _, n in rows:
        by_shard[shard] += n
    assert set(list(by_shard.values())[:-1]) == {64}


def check(rows, got):
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    expected = dict(zip(names, plain_targets([sizes[s] for s in names]), strict=True))
    source_of = {r[0]: r[3] for r in rows}
    taken = Counter()
    assert sorted(r["doc_id"] for r in got) == sorted(source_of)
    for r in got:
        source = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(expected[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source in names:
        assert abs(taken[source] - expected[source]) <= 1


def test_query_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = op7_mixing(spark, folder).collect()
    check([(r["doc_id"], r["text"], None, r["source"]) for r in docs], got)
    assert sorted(map(tuple, op7_mixing(spark, folder).collect())) == sorted(map(tuple, got))


def rows_of(n):
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(i % 40)), "en", f"s{i % 7 % 3}") for i in range(n)]
    return rows + [(n, None, "en", "s0"), (n + 1, "", "en", None), (n + 2, "p q", "en", None), (n + 3, "x " * 9000, "en", "s9")]


@pytest.mark.parametrize("block_words", [1, 7, 64])
def test_blocks_of_any_length(spark, block_words):
    rows = rows_of(300)
    made = mix(documents(spark, rows), block_words=block_words, shard_slots=50, seed=3)
    check(rows, mixed_sizes(made).collect())
    slots = made.slots.collect()
    assert len({(r["source_no"], r["slot"]) for r in slots}) == len(slots)


def test_documents_of_the_mix(spark):
    rows = rows_of(120)
    df = documents(spark, rows).repartition(3)
    sizes = {r["doc_id"]: r for r in mixed_sizes(mix(df, block_words=16)).collect()}
    out = mixed_documents(df, block_words=16)
    assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    text_of = {r[0]: r[1] for r in rows}
    taken = Counter()
    for r in out.collect():
        words = WORD.findall(r["text"])
        assert words and r["n_chars"] == len(r["text"])
        assert not Counter(words) - Counter(WORD.findall(text_of[r["doc_id"]]))
        taken[r["doc_id"]] += len(words)
    assert all(taken[i] == r["taken"] for i, r in sizes.items())


def test_odd_rows(spark):
    rows = [(None, "a b", "en", "s"), (1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, None, None, None)]
    got = mixed_sizes(mix(clashing(documents(spark, rows)))).collect()
    assert sorted((r["doc_id"] or 0, r["size"], r["taken"]) for r in got) == [(0, 2, 2), (1, 2, 2), (1, 2, 2), (2, 0, 0)]
    assert mixed_sizes(mix(documents(spark, []))).count() == 0
    assert mixed_documents(documents(spark, [])).count() == 0


def test_columns_of_any_name_stay(spark):
    rows = rows_of(30)
    df = documents(spark, rows).withColumns({"__row": F.lit("r"), "__takes": F.lit("t"), "__NEW": F.lit("n"), "row_id": F.lit(1)})
    out = mixed_documents(df, block_words=16)
    assert out.columns == df.columns and out.count() > 10
    assert {(r["__row"], r["__takes"], r["__NEW"], r["row_id"]) for r in out.collect()} == {("r", "t", "n", 1)}
