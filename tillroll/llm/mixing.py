"""Mixing sources to target weights: fixed-length blocks drawn through index permutations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.numbering import running_total
from tillroll.llm.storage import checkpointed, new_folder, unused

BLOCK_WORDS = 1024
# Blocks in one output shard.
SHARD_SLOTS = 4096
# No source is repeated more often; weights by position.
MOST = 3
WEIGHTS = (1, 2, 3)
_WORD = r"[^\x20\x09-\x0D]+"
_ROUNDS = 4


@dataclass(frozen=True)
class Share:
    """What the mix takes of one source."""

    number: int
    source: str | None
    size: int
    target: float
    blocks: int
    slots: int
    # Words of the last slot; the others take whole blocks.
    last_words: int


def targets(sizes: list[int], weights: list[int], most: int = MOST) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its size; the excess is reshared."""
    total = sum(sizes)
    found = [0.0] * len(sizes)
    open_ = list(range(len(sizes)))
    left = total
    while open_ and left:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] > most * sizes[i] * weight]
        if not full:
            for i in open_:
                found[i] = left * weights[i] / weight
            break
        for i in full:
            found[i] = float(most * sizes[i])
        left -= sum(most * sizes[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return found


def _mixed(x: np.ndarray, key: int, bits: int) -> np.ndarray:
    """``bits`` pseudorandom bits of x under a key."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) & np.uint64((1 << bits) - 1)


def permuted(index: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0 … n-1 at ``index``: a Feistel network, walked into range."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    keys = [(seed * 1_000_003 + r * 7_919 + 1) & (2**63 - 1) for r in range(_ROUNDS)]
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for key in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ _mixed(left, key, half), left
            else:
                left, right = right, left ^ _mixed(right, key, half)
        return (left << np.uint64(half)) | right

    with np.errstate(over="ignore"):
        x = once(np.asarray(index, np.uint64))
        while (outside := x >= n).any():
            x[outside] = once(x[outside])
    return x.astype(np.int64)


def _seed(seed: int, number: int, epoch: int) -> int:
    return (seed * 7_368_787 + number) * 64 + epoch


def shares(sizes: dict[str | None, int], block_words: int, seed: int, most: int = MOST) -> list[Share]:
    """The plan per source, in code point order with null last."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))]
    plan = []
    for i, (name, target) in enumerate(
        zip(names, targets([sizes[s] for s in names], weights, most), strict=True)
    ):
        size, words = sizes[name], round(target)
        blocks = -(-size // block_words)
        if not words:
            plan.append(Share(i, name, size, target, blocks, 0, 0))
            continue
        epochs, rest = divmod(words, size)
        slots, last = epochs * blocks, block_words
        if rest:
            short = size - (blocks - 1) * block_words
            at = int(permuted(np.array([blocks - 1]), blocks, _seed(seed, i, epochs), True)[0])
            # The short block is met at slot ``at`` of the last pass.
            if rest > at * block_words + short:
                rest += block_words - short
            more = -(-rest // block_words)
            slots, last = slots + more, rest - (more - 1) * block_words
        plan.append(Share(i, name, size, target, blocks, slots, last))
    return plan


def shard_counts(plan: list[Share], shard_slots: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, source number, first slot, slots): multinomial draws by what sources have left."""
    rng = np.random.default_rng(seed)
    left = np.array([s.slots for s in plan], np.int64)
    rows, shard = [], 0
    while left.sum():
        room, drawn = min(shard_slots, int(left.sum())), np.zeros(len(plan), np.int64)
        while room:
            more = np.minimum(rng.multinomial(room, left / left.sum()), left)
            drawn, left, room = drawn + more, left - more, room - int(more.sum())
        for s, n in zip(plan, drawn.tolist(), strict=True):
            if n:
                rows.append((shard, s.number, s.slots - int(left[s.number]) - n, n))
        shard += 1
    return rows


@dataclass(frozen=True)
class Mix:
    """``rows`` (row_id, source_no, source, size, source_size, target, first), ``slots`` and ``takes``."""

    rows: DataFrame
    slots: DataFrame
    takes: DataFrame


def mix(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    row_id: str | None = None,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 0,
) -> Mix:
    """Plans a mix of sources as long as the whole input.

    Words of a source, documents in a fixed order, are packed into blocks of
    ``block_words``. Each shard of the output draws how many of its slots each source
    fills; the j-th slot of a source takes block ``permutation(j)`` of it, a new
    permutation for every pass. The last slot of a source takes only the words that are
    still due, so a source comes within one word of its target. ``takes`` has, per
    document, the block ranges the mix takes: (row_id, low, high, times, of which `part` only
    as many words) in words of the document.

    The driver holds one line per source and per (shard, source); blocks, slots and
    documents stay in Spark and meet by (source, block).

    Null texts have no words; documents without words are never taken. A null source is a
    source, the last. Null and repeated ids are rows like any other. An empty table gives
    an empty mix. ``row_id`` names a unique column; without one, rows are numbered.
    """
    sized = df.select(
        (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("row_id"),
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_column), F.lit(_WORD)), F.lit(0))
        .cast("long")
        .alias("size"),
        F.xxhash64(F.col(text_column)).alias("tie"),
    )
    sized = checkpointed(sized)
    spark = df.sparkSession
    totals = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    plan = shares({r["source"]: r["size"] for r in totals}, block_words, seed)
    known = spark.createDataFrame(
        [(s.number, s.source, s.size, s.target, s.blocks, s.slots, s.last_words) for s in plan],
        "source_no int, source string, source_size long, target double, blocks long,"
        " slots long, last_words long",
    )
    numbered = sized.join(
        known.select("source_no", F.col("source").alias("of"), "source_size", "target"),
        F.col("source").eqNullSafe(F.col("of")),
    ).drop("of")
    rows = checkpointed(
        running_total(
            checkpointed(numbered),
            "source_no",
            ["doc_id", "tie", "size", "row_id"],
            F.col("size"),
            "first",
        ).drop("tie")
    )

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            block = np.zeros(len(frame), np.int64)
            epoch = (frame["slot"] // frame["blocks"]).to_numpy()
            index = (frame["slot"] % frame["blocks"]).to_numpy()
            number, n = frame["source_no"].to_numpy(), frame["blocks"].to_numpy()
            for source, e in set(zip(number.tolist(), epoch.tolist(), strict=True)):
                at = (number == source) & (epoch == e)
                block[at] = permuted(index[at], int(n[at][0]), _seed(seed, source, e))
            yield frame.assign(block=block)[["shard", "source_no", "slot", "block", "words"]]

    counts = spark.createDataFrame(
        shard_counts(plan, shard_slots, seed), "shard int, source_no int, first long, n long"
    )
    last = F.col("slot") == F.col("slots") - 1
    slots = (
        counts.join(known, "source_no")
        .repartition("shard", "source_no")
        .withColumn("slot", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)))
        .withColumn("words", F.when(last, F.col("last_words")).otherwise(F.lit(block_words)))
        .select("shard", "source_no", "slot", "blocks", "words")
        .mapInPandas(draw, "shard int, source_no int, slot long, block long, words long")
    )
    taken = slots.groupBy("source_no", "block").agg(
        F.count_if(F.col("words") == block_words).alias("times"),
        F.coalesce(F.max(F.when(F.col("words") < block_words, F.col("words"))), F.lit(0)).alias(
            "part"
        ),
    )
    begin = F.col("block") * block_words
    ranges = (
        rows.filter("size > 0")
        .withColumn(
            "block",
            F.explode(
                F.sequence(
                    F.floor(F.col("first") / block_words),
                    F.floor((F.col("first") + F.col("size") - 1) / block_words),
                )
            ),
        )
        .join(taken, ["source_no", "block"])
        .select(
            "row_id",
            (F.greatest(begin, "first") - F.col("first")).alias("low"),
            (F.least(begin + block_words, F.col("first") + F.col("size")) - F.col("first")).alias(
                "high"
            ),
            "times",
            F.greatest(begin + F.col("part") - F.greatest(begin, "first"), F.lit(0)).alias("part"),
        )
    )
    takes = ranges.withColumn("part", F.least("part", F.col("high") - F.col("low"))).filter(
        "times > 0 OR part > 0"
    )
    return Mix(rows, slots, takes)


def mixed_sizes(mixed: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document."""
    words = F.col("times") * (F.col("high") - F.col("low")) + F.col("part")
    taken = mixed.takes.groupBy("row_id").agg(F.sum(words).alias("taken"))
    return mixed.rows.join(taken, "row_id", "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def shard_blocks(
    df: DataFrame,
    text_column: str = "text",
    block_words: int = BLOCK_WORDS,
    seed: int = 0,
    **options,
) -> DataFrame:
    """The mix itself: (shard, position, source, slot, block, n_words, text), a row for each slot.

    A block is ``block_words`` words of a source, joined by single spaces; documents follow each
    other without a mark. A shard holds as many blocks of a source as were drawn for it, in an order
    fixed by their hashes; positions are gapless from 0. The last slot of a source takes the first words
    of its block only, the block at a source's end may be short. Texts are cut where they lie and only the
    pieces are shuffled, once to make blocks and once to meet the slots by (source, block):
    neither step gathers more than a block.

    Null texts and texts without words are in no block; a null source is a source. Repeated rows
    and rows without an id are documents of their own; an empty table gives no slots.
    """
    wanted = [options.get("id_column", "doc_id"), text_column, options.get("source_column", "source")]
    needed = df.select(*dict.fromkeys(wanted))
    row = unused(needed, "__row")
    path = new_folder(df.sparkSession, "mix")
    needed.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    mixed = mix(rows, text_column=text_column, row_id=row, block_words=block_words, seed=seed, **options)
    size, first = F.col("size"), F.col("first")
    lying = (
        mixed.rows.filter("size > 0")
        .select("row_id", "source_no", "source", "size", "first")
        .join(rows.select(F.col(row).alias("row_id"), F.col(text_column).alias("text")), "row_id")
        .withColumn("words", F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
    )

    def piece(block: Column) -> Column:
        low = F.greatest(block * block_words - first, F.lit(0))
        high = F.least((block + 1) * block_words - first, size)
        words = F.slice("words", (low + 1).cast("int"), (high - low).cast("int"))
        return F.struct(
            block.alias("block"), first.alias("first"), F.concat_ws(" ", words).alias("piece")
        )

    covered = F.sequence(
        F.floor(first / block_words), F.floor((first + size - 1) / block_words)
    )
    pieces = lying.select("source_no", "source", F.inline(F.transform(covered, piece)))
    blocks = pieces.groupBy("source_no", "block").agg(
        F.first("source").alias("source"),
        F.sort_array(F.collect_list(F.struct("first", "piece"))).alias("pieces"),
    )
    texts = blocks.select(
        "source_no", "block", "source", F.concat_ws(" ", F.col("pieces.piece")).alias("text")
    )
    # A shard has a bounded number of slots.
    order = Window.partitionBy("shard").orderBy(
        F.xxhash64(F.lit(seed), "source_no", "slot"), "source_no", "slot"
    )
    slots = mixed.slots.withColumn("position", F.row_number().over(order) - 1)
    part = F.concat_ws(" ", F.slice(F.split("text", " "), F.lit(1), F.col("words").cast("int")))
    taken = F.when(F.col("words") < block_words, part).otherwise(F.col("text"))
    return (
        slots.join(texts, ["source_no", "block"])
        .withColumn("text", taken)
        .select(
            "shard",
            "position",
            "source",
            "slot",
            "block",
            F.size(F.split("text", " ")).cast("long").alias("n_words"),
            "text",
        )
    )


def write_shards(blocks: DataFrame, path: str) -> None:
    """Writes :func:`shard_blocks` as Parquet; a shard lies in one file, in the order of its positions.

    No blocks give an empty folder that can be read.
    """
    placed = blocks.repartition("shard").sortWithinPartitions("shard", "position")
    placed.write.parquet(path)


def mixed_documents(
    df: DataFrame, text_column: str = "text", chars_column: str = "n_chars", **options
) -> DataFrame:
    """The documents of the mix: a row for each pass that takes words of a document.

    A pass that takes the whole document keeps its text as it is; one that takes some
    words has those, joined by single spaces. Other columns are carried over, whatever their names, and
    ``chars_column``, if there is one, follows the text.

    Null texts and texts without words are never taken. Repeated rows and rows without an id are
    documents of their own; an empty table gives an empty mix.
    """
    row, takes, new = (unused(df, name) for name in ("__row", "__takes", "__new"))
    path = new_folder(df.sparkSession, "mix")
    df.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    mixed = mix(rows, text_column=text_column, row_id=row, **options)
    parts = mixed.takes.groupBy(F.col("row_id").alias(row)).agg(
        F.sort_array(F.collect_list(F.struct("low", "high", "times", "part"))).alias(takes)
    )

    @F.pandas_udf("array<string>")
    def passes(text: pd.Series, takes: pd.Series) -> pd.Series:
        return pd.Series([_passes(t, k) for t, k in zip(text, takes, strict=True)])

    found = rows.join(parts, row).withColumn(
        new, F.explode(passes(F.col(text_column), F.col(takes)))
    )
    named = {text_column: F.col(new)}
    if chars_column in df.columns:
        named[chars_column] = F.char_length(new).cast(df.schema[chars_column].dataType)
    return found.withColumns(named).select(*df.columns)


def _passes(text: str, takes) -> list[str]:
    raw = text.encode("utf-8", "surrogatepass").split()
    found = []
    for turn in range(1, MOST + 1):
        words, whole = [], 0
        for take in takes:
            low, high, times, part = take["low"], take["high"], take["times"], take["part"]
            if times >= turn:
                words += raw[low:high]
            elif times == turn - 1 and part:
                words += raw[low : low + part]
            whole = max(whole, high)
        if len(words) == len(raw):
            found.append(text)
        elif words:
            found.append(b" ".join(words).decode("utf-8", "surrogatepass"))
    return found
