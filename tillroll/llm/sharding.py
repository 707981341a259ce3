"""Balanced shards for indivisible groups by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
import random
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.numbering import running_total
from tillroll.llm.storage import checkpointed

# Groups differenced together in one task, on average.
BLOCK_GROUPS = 4096
# A group this many times smaller than a block's fair shard is left to its block.
_FINE = 4


def difference(
    sizes: Sequence[int], shards: int, start: Sequence[int] | None = None, seed: int = 0
) -> list[int]:
    """The shard of each size. ``start`` is what the shards hold beforehand.

    A partial partition is one sum per shard, largest first, less its smallest sum. The two of
    largest spread are combined oppositely ordered until one is left. With ``start`` the
    result's shards are those of ``start``; else their numbers are drawn by ``seed``,
    so that what is left over does not pile up over many calls.
    """
    shuffled = random.Random(seed).sample(range(shards), shards)
    heap: list[tuple[int, int, list[int], list]] = []
    for i, size in enumerate(sizes):
        heap.append((-size, i, [size] + [0] * (shards - 1), [i] + [None] * (shards - 1)))
    pinned = start is not None and len(set(start)) > 1
    if pinned:
        order = sorted(shuffled, key=lambda j: -start[j])
        least = min(start)
        sums = [start[j] - least for j in order]
        heap.append((-sums[0], -1, sums, [-1 - j for j in order]))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, first, first_rope = heapq.heappop(heap)
        _, _, second, second_rope = heapq.heappop(heap)
        opposed = [(first[j] + second[-1 - j], j) for j in range(shards)]
        merged = sorted(opposed, key=lambda x: -x[0])
        least = merged[-1][0]
        ropes = [_tie(first_rope[j], second_rope[-1 - j]) for _, j in merged]
        sums = [total - least for total, _ in merged]
        heapq.heappush(heap, (-sums[0], made, sums, ropes))
        made += 1
    found = [0] * len(sizes)
    if not heap:
        return found
    for slot, rope in enumerate(heap[0][3]):
        members = _members(rope)
        number = next((-1 - m for m in members if m < 0), shuffled[slot])
        for member in members:
            if member >= 0:
                found[member] = number
    return found


def _tie(left, right):
    if left is None or right is None:
        return right if left is None else left
    return (left, right)


def _members(rope) -> list[int]:
    found, stack = [], [rope]
    while stack:
        item = stack.pop()
        if isinstance(item, tuple):
            stack.extend(item)
        elif item is not None:
            found.append(item)
    return found


def balanced_groups(
    groups: DataFrame, shards: int = 8, block_groups: int = BLOCK_GROUPS
) -> DataFrame:
    """(key, bytes, shard) for ``groups(key long, bytes long)`` with unique keys.

    Groups are dealt by hash into blocks of about ``block_groups`` that are differenced
    side by side. Groups too large for a block to even out (at most one in
    ``block_groups / (shards * 4)``) are placed first, by the same means; every block then
    starts from its share of what they left uneven and fills it up. No task has more
    than about a block of groups, and only one number per shard reaches the driver.
    """
    number, total = groups.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    blocks = max(1, -(-number // block_groups))
    if blocks == 1:
        return _by_block(groups, shards, 1, None, 1)
    limit = total // (blocks * shards * _FINE)
    large = groups.filter(F.col("bytes") > limit)
    small = groups.filter(F.col("bytes") <= limit)
    placed = checkpointed(balanced_groups(checkpointed(large), shards, block_groups))
    sums = placed.groupBy("shard").agg(F.sum("bytes").alias("held")).collect()
    held = {r["shard"]: r["held"] for r in sums}
    start = [int(held.get(s, 0)) for s in range(shards)]
    rest = total - sum(start)
    return placed.unionByName(_by_block(small, shards, blocks, start, rest))


def _by_block(
    groups: DataFrame, shards: int, blocks: int, start: list[int] | None, rest: int
) -> DataFrame:
    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "key"], ascending=False, kind="stable")
        sizes = [int(b) for b in frame["bytes"]]
        share = None
        if start is not None and rest:
            least, own = min(start), sum(sizes)
            share = [(s - least) * own // rest for s in start]
        seed = int(frame["__block"].iloc[0])
        return frame[["key", "bytes"]].assign(shard=difference(sizes, shards, share, seed))

    block = F.pmod(F.xxhash64(F.lit("block"), "key"), F.lit(blocks)).cast("int")
    return (
        groups.select("key", "bytes", block.alias("__block"))
        .groupBy("__block")
        .applyInPandas(place, "key long, bytes long, shard int")
    )


def sharded(
    df: DataFrame,
    shards: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_groups: int = BLOCK_GROUPS,
) -> DataFrame:
    """Documents dealt to shards of near-equal bytes; equal texts stay together.

    Law ``bytes``: (id, size, text_crc32, law, shard, slot, grown_shard). The size is the
    UTF-8 length plus one. A group is all rows with one 64-bit hash of the text: equal
    texts always share it, and a collision only joins two groups. ``slot`` numbers the
    rows of a shard without gaps from 0; ``grown_shard`` is null under this law.

    Null texts count as empty ones and are grouped with them. Rows with null or repeated
    ids are rows like any other. An empty table gives an empty result. Columns other than
    the two named are not carried.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = checkpointed(
        df.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        )
    )
    groups = checkpointed(rows.groupBy("key").agg(F.sum("size").alias("bytes")))
    dealt = balanced_groups(groups, shards, block_groups).select("key", "shard")
    placed = checkpointed(rows.join(dealt, "key").drop("key"))
    numbered = running_total(
        placed, "shard", ["doc_id", "text_crc32", "size"], F.lit(1), "slot"
    )
    return numbered.select(
        F.col("doc_id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
