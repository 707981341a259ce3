"""Where rows sit and what is kept: partitioning, reuse, cut lineage."""

from __future__ import annotations

import heapq
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.hashing import bucket_hash


def repartition_by(
    df: DataFrame,
    keys: Sequence[str],
    partitions: int | None = None,
    salt_on: Sequence[str] = (),
    salts: int = 1,
) -> DataFrame:
    """Hash layout by key, with an optional salt for hot keys.

    With ``salts`` above 1 each key is spread over that many partitions, chosen by
    the values of ``salt_on``. Country needs it: the home country has most rows.
    """
    spread = [F.col(k) for k in keys]
    if salts > 1:
        spread.append(bucket_hash(salt_on, salts))
    return df.repartition(partitions, *spread) if partitions else df.repartition(*spread)


# Slots of the rest per partition, and the least share of a partition that a key is placed by.
_REST_SLOTS = 16
_LEAST_SHARE = 0.125


def _free_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _pieces(
    heavy: dict[int, int], total: int, partitions: int
) -> tuple[list[tuple[int, float, float, int]], list[tuple[int, int]]]:
    """Where heavy keys and the rest go: (key, from, to, partition) and (slot, partition).

    A key of more rows than a partition should have fills whole partitions and has one
    remainder; remainders and smaller keys go whole to the emptiest partition, the largest
    first. Slots of the rest are dealt by the room that is left.
    """
    room = total / partitions
    pieces: dict[int, list[tuple[float, int]]] = {key: [] for key in heavy}
    loads, items, filled = [0.0] * partitions, [], 0
    for key, rows in sorted(heavy.items(), key=lambda kv: (-kv[1], kv[0])):
        whole = min(int(rows // room), partitions - filled)
        for _ in range(whole):
            pieces[key].append((room, filled))
            loads[filled] = room
            filled += 1
        rest = rows - whole * room
        if rest > 0:
            items.append((rest, key))
    heap = [(load, p) for p, load in enumerate(loads)]
    heapq.heapify(heap)
    for rest, key in sorted(items, reverse=True):
        load, p = heapq.heappop(heap)
        pieces[key].append((rest, p))
        loads[p] = load + rest
        heapq.heappush(heap, (loads[p], p))
    ranges = []
    for key, own in pieces.items():
        size, low = sum(rows for rows, _ in own), 0.0
        for i, (rows, p) in enumerate(own):
            high = 1.0 if i == len(own) - 1 else low + rows / size
            ranges.append((key, low, high, p))
            low = high
    free = [max(0.0, room - load) for load in loads]
    if sum(free) <= 0:
        free = [1.0] * partitions
    n_slots, slots, seen = _REST_SLOTS * partitions, [], 0.0
    for p, part in enumerate(free):
        begin, seen = round(seen / sum(free) * n_slots), seen + part
        slots += [(slot, p) for slot in range(begin, round(seen / sum(free) * n_slots))]
    return ranges, slots


def hot_key_placement(
    df: DataFrame,
    keys: Sequence[str],
    partitions: int,
    salt_on: Sequence[str],
    tracked: int = 10_000,
    name: str = "partition",
) -> DataFrame:
    """The rows, and in ``name`` the partition that would even out hot keys.

    One scan of the keys, before this returns, finds the heavy ones with a mergeable sketch of
    ``tracked`` counters; at most four keys per partition reach the driver. A key with more
    rows than its share of a partition is spread, by the values of ``salt_on``, over as many
    partitions as its rows need; every other key stays in one partition. The places of heavy
    keys are broadcast: at most five rows per partition, and 16 slots per partition for the rest.

    Null keys are a key like any other. Rows alike in ``salt_on`` and key stay together. An empty
    table gets an empty placement.
    """
    session = df.sparkSession
    key_name, unit, slot = (_free_name(df, n) for n in ("__key", "__unit", "__slot"))
    hashed = F.xxhash64(*[F.col(k) for k in keys])
    tracked = max(tracked, 8 * partitions)
    top = df.select(hashed.alias("key")).agg(
        F.count(F.lit(1)).alias("total"),
        F.expr(f"approx_top_k(key, {4 * partitions}, {tracked})").alias("top"),
    )
    row = top.first()
    total = row["total"]
    least = _LEAST_SHARE * total / partitions
    heavy = {r["item"]: r["count"] for r in row["top"] if r["count"] >= least}
    ranges, slots = _pieces(heavy, total, partitions)
    of, low, high, heavy_place = (_free_name(df, n) for n in ("__of", "__low", "__high", "__heavy"))
    rest_slot, rest_place = _free_name(df, "__rest_slot"), _free_name(df, "__rest")
    places = session.createDataFrame(
        ranges, f"{of} bigint, {low} double, {high} double, {heavy_place} int"
    )
    rest = session.createDataFrame(slots, f"{rest_slot} bigint, {rest_place} int")
    steps = 1 << 40
    by_value = F.pmod(F.xxhash64(F.lit("salt"), *[F.col(c) for c in salt_on]), F.lit(steps))
    marked = df.withColumns(
        {
            key_name: hashed,
            unit: by_value / F.lit(float(steps)),
            slot: F.pmod(hashed, F.lit(_REST_SLOTS * partitions)),
        }
    )
    hit = (
        (F.col(key_name) == F.col(of))
        & (F.col(unit) >= F.col(low))
        & (F.col(unit) < F.col(high))
    )
    place: Column = F.coalesce(F.col(heavy_place), F.col(rest_place))
    return (
        marked.join(F.broadcast(places), hit, "left")
        .join(F.broadcast(rest), F.col(slot) == F.col(rest_slot), "left")
        .select(*[F.col(f"`{c}`") for c in df.columns], place.alias(name))
    )


def spread_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    partitions: int,
    salt_on: Sequence[str],
    tracked: int = 10_000,
) -> DataFrame:
    """Lay rows out by key in partitions of near-equal rows: see :func:`hot_key_placement`.

    Adaptive execution may still merge neighbouring partitions that are small in bytes.
    """
    place = _free_name(df, "__place")
    placed = hot_key_placement(df, keys, partitions, salt_on, tracked, place)
    return placed.repartitionById(partitions, F.col(place)).drop(place)


def repartition_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, to compare before and after a new layout."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """At least one partition per core: by the hash of ``keys``, or in turn without any.

    For relations that are quick to store and slow to work on, such as training data
    or predictions to explain: adaptive execution merges partitions by their size
    and would leave most cores idle.
    """
    session = df.sparkSession
    shuffle_partitions = int(session.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(shuffle_partitions, session.sparkContext.defaultParallelism)
    return df.repartition(partitions, *keys)


@contextmanager
def reused(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Keep a relation while several queries read it, then let it go.

    Filling happens with the first query. Partitions lost with an executor are
    computed again, so this is a saving and never a source of truth. A relation the
    caller keeps already stays theirs.
    """
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a relation as Parquet in the shared folder while several queries read it.

    Written once, when the block is entered, and removed when it is left: what outlives the
    block must be written or collected before. Unlike :func:`reused` it takes no executor
    memory, each reader scans only its own columns, and a lost executor costs a file read.
    """
    session = df.sparkSession
    path = f"{checkpoint_folder(session)}/staged-{uuid.uuid4().hex}"
    try:
        yield _written(df, path)
    finally:
        folder = session._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(session._jsc.hadoopConfiguration()).delete(folder, True)


def kept_by_column(df: DataFrame) -> DataFrame:
    """A checkpoint as Parquet: each reader scans only its own columns. Like one, it stays."""
    return _written(df, f"{checkpoint_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write a relation to the session's checkpoint folder and go on from there.

    For relations that take a whole scan to compute and that iterative work (fitting
    a model, then scoring) reads many times: lost executors cost a file read, not
    another scan.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder is the cluster's to name; only a local session gets one made up."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(named)
    return str(context.getCheckpointDir()).rstrip("/")
