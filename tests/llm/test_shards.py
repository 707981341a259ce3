"""Shards of the mix against a plain packer."""

import re
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import clashing, documents
from tillroll.llm.mixing import mix, mixed_sizes, shard_blocks, shard_counts, shares, write_shards

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(n):
    rows = [
        (i, "\n ".join(f"w{i}_{j}" for j in range(i * 7 % 90)), "en", f"s{i % 7 % 3}") for i in range(n)
    ]
    rows += [(n, None, "en", "s0"), (n + 1, " \t", "en", "s0"), (n + 2, "p\u00a0q r", "en", None)]
    return rows + [(n + 3, " ".join(f"x{j}" for j in range(3000)), "en", "s9")]


def packed(rows, ordered, block_words):
    """{source: blocks}: the words of a source's documents in order, cut every ``block_words``."""
    words, text_of = defaultdict(list), {r[0]: r[1] for r in rows}
    for r in sorted(ordered, key=lambda r: r["first"]):
        if r["size"]:
            assert len(words[r["source"]]) == r["first"]
            words[r["source"]] += WORD.findall(text_of[r["doc_id"]])
    return {s: [w[i : i + block_words] for i in range(0, len(w), block_words)] for s, w in words.items()}


@pytest.mark.parametrize("block_words, shard_slots", [(1, 900), (16, 50), (64, 7), (5000, 2)])
def test_shards_hold_the_packed_blocks_they_drew(spark, block_words, shard_slots):
    rows = rows_of(90)
    df = documents(spark, rows).repartition(3)
    options = {"block_words": block_words, "shard_slots": shard_slots, "seed": 5}
    made = mix(df, **options)
    blocks = packed(rows, made.rows.collect(), block_words)
    got = shard_blocks(df, **options).collect()
    sizes = {s: sum(map(len, own)) for s, own in blocks.items()}
    plan = shares(sizes, block_words, 5)
    drawn = {(shard, plan[no].source): n for shard, no, _, n in shard_counts(plan, shard_slots, 5)}
    assert Counter((r["shard"], r["source"]) for r in got) == drawn
    last = {s.source: (s.slots - 1, s.last_words) for s in plan}
    positions, passes = defaultdict(list), defaultdict(list)
    for r in got:
        whole = blocks[r["source"]][r["block"]]
        slot, words = last[r["source"]]
        expected = whole[:words] if r["slot"] == slot else whole
        assert r["text"] == " ".join(expected) and r["n_words"] == len(expected)
        positions[r["shard"]].append(r["position"])
        passes[r["source"]].append((r["slot"], r["block"]))
    assert all(sorted(p) == list(range(len(p))) and len(p) <= shard_slots for p in positions.values())
    for source, taken in passes.items():
        n, taken = len(blocks[source]), [b for _, b in sorted(taken)]
        # Each pass over a source takes every block once; the last one as many as are due.
        assert all(len(set(taken[i : i + n])) == len(taken[i : i + n]) for i in range(0, len(taken), n))
    # Every document's words in the shards are what the query reports as taken.
    owner = {w: r[0] for r in rows for w in WORD.findall(r[1] or "")}
    counted = Counter(owner[w] for r in got for w in r["text"].split(" "))
    assert {r["doc_id"]: r["taken"] for r in mixed_sizes(made).collect()} == {r[0]: counted[r[0]] for r in rows}


def test_a_shard_lies_in_one_file_in_order(spark, tmp_path):
    blocks = shard_blocks(documents(spark, rows_of(60)), block_words=8, shard_slots=40)
    write_shards(blocks, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards")).selectExpr("*", "_metadata.file_path AS file").collect()
    assert Counter(tuple(r)[:7] for r in back) == Counter(map(tuple, blocks.collect()))
    at = defaultdict(list)
    for r in back:
        at[r["shard"]].append((r["file"], r["position"]))
    for places in at.values():
        assert len({f for f, _ in places}) == 1
        assert [p for _, p in places] == list(range(len(places)))


def test_shards_of_odd_rows(spark, tmp_path):
    rows = [(None, "a b", "en", "s"), (1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, None, None, None), (3, "", "en", "t")]
    df = clashing(documents(spark, rows)).selectExpr("*", "1 AS row_id", "2 AS __row", "4 AS first", "5 AS position")
    got = shard_blocks(df, block_words=4).collect()
    assert sorted(r["text"] for r in got) == ["a b", "a b a b"] and {r["source"] for r in got} == {"s"}
    nothing = shard_blocks(documents(spark, []))
    assert nothing.count() == 0
    write_shards(nothing, str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
