"""Vector code compression: product codes, parts assigned along a trie of their components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.storage import checkpointed

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Components beyond are taken as this: squared distances stay within 64 bits.
_LARGEST = 1 << 27
# Leaves of a trie that are walked side by side, and rows whose parts share a trie.
_LEAVES, _ROWS = 1024, 32_768


def components(vector: Column, scale: int = SCALE) -> Column:
    """The integer components floor(scale * x), held within ± 2 ** 27."""
    bound = F.lit(float(_LARGEST))
    return F.transform(
        vector,
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, bound), -bound)).cast("long"),
    )


def _usable(vector: Column) -> Column:
    """Not null, not empty, and all components finite."""
    big = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x < big) & (x > -big))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


class Trie:
    """The lexicographic trie over the distinct rows of a matrix of integers.

    Sorted distinct rows are its leaves; a node is a run of leaves alike in their first components.
    ``shared`` is the number of first components a leaf has in common with the leaf before.
    """

    def __init__(self, rows: np.ndarray) -> None:
        order = np.lexsort(rows.T[::-1])
        ordered = rows[order]
        changed = ordered[1:] != ordered[:-1]
        first = np.ones(len(rows), bool)
        first[1:] = changed.any(axis=1)
        self.leaf = np.empty(len(rows), np.int64)
        self.leaf[order] = np.cumsum(first) - 1
        self.rows = ordered[first]
        self.counts = np.bincount(self.leaf, minlength=len(self.rows))
        self.shared = np.concatenate(([0], changed.argmax(axis=1)[first[1:]]))

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest entry, squared distance) of each leaf, ties to the lower entry.

        Leaves are walked depth first, a run of them at a time. In a run every node has one vector of
        distances to all entries over the components so far, which its children share and extend by
        their own component; at the leaves the least is taken.
        """
        span = int(np.abs(self.rows).max(initial=0)) + int(np.abs(entries).max(initial=0))
        kind = np.int32 if span * span * max(1, self.rows.shape[1]) < 2**31 else np.int64
        entries = entries.astype(kind)
        code, error = np.empty(len(self.rows), np.int64), np.empty(len(self.rows), np.int64)
        for start in range(0, len(self.rows), _LEAVES):
            rows = self.rows[start : start + _LEAVES].astype(kind)
            shared = self.shared[start : start + _LEAVES].copy()
            shared[0] = 0
            node = np.zeros(len(rows), np.int64)
            sums = np.zeros((1, len(entries)), kind)
            for depth in range(rows.shape[1]):
                opens = shared <= depth
                opens[0] = True
                at = np.flatnonzero(opens)
                step = rows[at, depth][:, None] - entries[:, depth]
                step *= step
                step += sums[node[at]]
                node, sums = np.cumsum(opens) - 1, step
            best = sums.argmin(axis=1)
            code[start : start + len(rows)] = best[node]
            error[start : start + len(rows)] = sums[np.arange(len(sums)), best][node]
        return code, error

    def weighted_sums(self, code: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(sum of rows, number of rows) per entry: leaves count as often as they occur."""
        number = np.bincount(code, self.counts, n).astype(np.int64)
        order = np.argsort(code, kind="stable")
        found, first = np.unique(code[order], return_index=True)
        total = np.zeros((n, self.rows.shape[1]), np.int64)
        if len(found):
            total[found] = np.add.reduceat((self.rows * self.counts[:, None])[order], first, axis=0)
        return total, number


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined to about ``_ROWS`` rows."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        waiting.append(batch)
        size += len(batch)
        if size >= _ROWS:
            yield pa.Table.from_batches(waiting)
            waiting, size = [], 0
    if size:
        yield pa.Table.from_batches(waiting)


def _parts(block: pa.Table, cuts: list[int]) -> list[np.ndarray]:
    lists = block.column("ints").combine_chunks()
    rows = lists.flatten().to_numpy().reshape(len(lists), -1)
    return [rows[:, a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Codebooks:
    """Entries per part, as integers."""

    def __init__(self, entries: list[np.ndarray], cuts: list[int]) -> None:
        self.entries, self.cuts = entries, cuts

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and place, in decimal, comma-joined."""
        numbers = ",".join(str(x) for part in self.entries for x in part.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()

    def moved(self, kept: DataFrame) -> Codebooks:
        """One round: each entry becomes the rounded-down mean of the parts it is nearest to."""
        books, cuts = self.entries, self.cuts

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [(np.zeros(b.shape, np.int64), np.zeros(len(b), np.int64)) for b in books]
            for block in _blocks(batches):
                for part, entries, (total, number) in zip(_parts(block, cuts), books, sums, strict=True):
                    trie = Trie(part)
                    more, count = trie.weighted_sums(trie.nearest(entries)[0], len(entries))
                    total += more
                    number += count
            for k, (total, number) in enumerate(sums):
                used = np.flatnonzero(number)
                width = total.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(used) * width, k, np.int32)),
                        pa.array(np.repeat(used, width).astype(np.int32)),
                        pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                        pa.array(total[used].ravel()),
                        pa.array(np.repeat(number[used], width)),
                    ],
                    names=["part", "entry", "place", "total", "number"],
                )

        found = (
            kept.select("ints")
            .mapInArrow(partial, "part int, entry int, place int, total long, number long")
            .groupBy("part", "entry", "place")
            .agg(
                F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                F.sum("number").alias("number"),
            )
            .collect()
        )
        entries = [b.copy() for b in books]
        for part, entry, place, total, number in found:
            entries[part][entry, place] = int(total) // int(number)
        return Codebooks(entries, cuts)


def first_codebooks(
    kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES
) -> Codebooks | None:
    """The parts of the vectors of the least ids; at most ``entries`` rows reach the driver."""
    order = [F.col("id").asc_nulls_last(), F.col("ints")]
    rows = np.array([r["ints"] for r in kept.orderBy(*order).limit(entries).select("ints").collect()], np.int64)
    if not len(rows):
        return None
    cuts = [k * rows.shape[1] // parts for k in range(parts + 1)]
    return Codebooks([rows[:, a:b].copy() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], cuts)


def vector_codes(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector.

    Components become integers; vectors are cut into ``parts`` parts, as equal as possible. Codebooks
    begin as the parts of the vectors of least ids and are moved ``rounds`` times to the rounded-down
    means of the parts nearest to each entry; an unused entry stays. The code has two hex digits per
    part; the error is the sum of squared distances, ``label_error`` its sum over rows of equal label.

    Vectors are written once and read once per round. A task puts the parts of a bounded run of rows
    into a trie and returns sums per entry; only those are shuffled, and only codebooks reach the driver.

    Vectors that are null or empty or hold a null or non-finite component are dropped, as are those of
    another length than the one of least id. Null ids come last; repeated rows are coded each; null
    labels are one label. Components are held within ± 2 ** 27. Empty tables give an empty
    result; other columns are not carried.
    """
    kind = vectors.schema[id_column].dataType.simpleString()
    label = vectors.schema[label_column].dataType.simpleString()
    usable = vectors.filter(_usable(F.col(vector_column))).select(
        F.col(id_column).alias("id"),
        components(F.col(vector_column)).alias("ints"),
        F.col(label_column).alias("label"),
    )
    kept = checkpointed(usable)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "ints").select(F.size("ints").alias("n")).first()
    kept = kept.filter(F.size("ints") == (first["n"] if first else 0))
    books = first_codebooks(kept, parts, entries)
    for _ in range(rounds if books else 0):
        books = books.moved(kept)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            digits, errors = [], np.zeros(len(block), np.int64)
            for part, own in zip(_parts(block, books.cuts), books.entries, strict=True):
                trie = Trie(part)
                code, error = trie.nearest(own)
                digits.append(code[trie.leaf])
                errors += error[trie.leaf]
            codes = ["".join(f"{c:02x}" for c in row) for row in np.stack(digits, axis=1).tolist()]
            table = pa.table(
                {
                    "id": block.column("id"),
                    "label": block.column("label"),
                    "code": pa.array(codes, pa.string()),
                    "error": pa.array(errors),
                }
            )
            yield from table.to_batches()

    coded = checkpointed(kept.mapInArrow(encode, f"id {kind}, label {label}, code string, error long"))
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_column),
        "code",
        "error",
        "label_error",
        F.lit(books.digest() if books else "").alias("codebooks_sha256"),
    )
