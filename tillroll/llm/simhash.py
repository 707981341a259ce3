"""SimHash near-duplicates: fingerprints, a trie self-join, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.connected import connected_components
from tillroll.llm.storage import checkpointed, new_folder, unused

_BITS = 64
_SEED = 42
# Fingerprints that one trie holds; a larger group is joined part by part.
TRIE_ROWS = 50_000
# Node pairs expanded at a time.
_FRONTIER = 500_000


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """The 64-bit hashes of the word shingles of a text, big-endian, in text order.

    A-Z become a-z, words are runs of anything but ASCII white space, shingles are joined
    by one space and counted as often as they occur. Fewer words than a shingle has make
    one shingle; no words make none.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.array([], dtype=">u8")
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        starts, ends = starts[: 1 - words or None], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], _SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)],
        dtype=">u8",
    )


def fingerprint(text: str | None, words: int = 3) -> int:
    """The signed 64-bit SimHash of the word shingles of a text; no words make zero."""
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(
    df: DataFrame, words: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, fp long) of whole texts; null texts count as empty and give 0."""

    def compute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[["doc_id"]].assign(fp=[fingerprint(t, words) for t in frame["text"]])

    plain = df.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInPandas(compute, f"doc_id {kind}, fp long")


def _roots(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Parents after joining a[i] with b[i]; every parent is a root again."""
    while True:
        left, right = parent[a], parent[b]
        apart = left != right
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(left, right)[apart], np.minimum(left, right)[apart])
        while not np.array_equal(parent, higher := parent[parent]):
            parent = higher


def trie_roots(group: np.ndarray, value: np.ndarray, bits: int, budget: int) -> np.ndarray:
    """Component of each value, linking values of one group at ``budget`` or fewer bits.

    ``group`` and, inside a group, ``value`` (unsigned, unique) are sorted, so a node
    of the binary trie over the ``bits`` low bits is a range of rows. Pairs of nodes go
    down together, one bit a level: equal branches keep their number of differing bits,
    crossed ones add one and end beyond the budget. A pair whose rows are all in one
    component already cannot link anything new and ends too; links of neighbours in
    sorted order are made first, which joins most of a dense cluster before the descent.
    """
    n = len(value)
    parent = np.arange(n)
    if n < 2:
        return parent
    close = (group[1:] == group[:-1]) & (np.bitwise_count(value[1:] ^ value[:-1]) <= budget)
    near = np.flatnonzero(close)
    parent = _roots(parent, near, near + 1)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    last = np.concatenate((first[1:], [n]))
    many = last - first > 1
    top = np.stack([first[many], last[many], first[many], last[many], np.zeros(many.sum(), int)])
    zeros: dict[int, np.ndarray] = {}
    stack = [(bits - 1, top)]
    while stack:
        depth, pairs = stack.pop()
        if pairs.shape[1] > _FRONTIER:
            half = pairs.shape[1] // 2
            stack += [(depth, pairs[:, half:]), (depth, pairs[:, :half])]
            continue
        changes = np.concatenate(([0], np.cumsum(parent[1:] != parent[:-1])))
        lo1, hi1, lo2, hi2, diff = pairs
        done = (
            (changes[lo1] == changes[hi1 - 1])
            & (changes[lo2] == changes[hi2 - 1])
            & (parent[lo1] == parent[lo2])
        )
        single = ~done & (hi1 - lo1 == 1) & (hi2 - lo2 == 1)
        a, b = lo1[single], lo2[single]
        linked = np.bitwise_count(value[a] ^ value[b]) <= budget
        if linked.any():
            parent = _roots(parent, a[linked], b[linked])
        pairs = pairs[:, ~done & ~single]
        if not pairs.shape[1] or depth < 0:
            continue
        if depth not in zeros:
            bit = (value >> np.uint64(depth)) & np.uint64(1)
            zeros[depth] = np.concatenate(([0], np.cumsum(bit == 0)))
        before = zeros[depth]
        lo1, hi1, lo2, hi2, diff = pairs
        mid1, mid2 = lo1 + before[hi1] - before[lo1], lo2 + before[hi2] - before[lo2]
        own = lo1 == lo2
        crossed = np.stack([lo1, mid1, mid2, hi2, diff + 1])
        mirrored = np.stack([mid1, hi1, lo2, mid2, diff + 1])[:, ~own]
        children = np.concatenate(
            [
                np.stack([lo1, mid1, lo2, mid2, diff]),
                np.stack([mid1, hi1, mid2, hi2, diff]),
                crossed,
                mirrored,
            ],
            axis=1,
        )
        lo1, hi1, lo2, hi2, diff = children
        alone = (lo1 == lo2) & (hi1 - lo1 < 2)
        kept = (hi1 > lo1) & (hi2 > lo2) & (diff <= budget) & ~alone
        stack.append((depth - 1, children[:, kept]))
    return parent


def fingerprint_links(prints: DataFrame, budget: int = 3, trie_rows: int = TRIE_ROWS) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``budget`` bits, directly or not.

    ``prints(fp long)`` are distinct. Two fingerprints within the budget agree on one of
    ``budget + 1`` blocks of bits, so each block is a root branch where tries are joined: a task
    descends from the node pairs that agree on the block, over the other bits. It returns a
    spanning forest, not all pairs. A block value with more than ``trie_rows`` fingerprints
    is cut into parts by hash, and every two parts share a trie of their own, so no task
    holds more than about ``trie_rows`` and no link is lost.
    """
    blocks = budget + 1
    width = -(-_BITS // blocks)
    branch = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("block"),
                    F.shiftrightunsigned("fp", width * i)
                    .bitwiseAND(F.lit((1 << min(width, _BITS - width * i)) - 1))
                    .alias("branch"),
                )
                for i in range(blocks)
            ]
        )
    )
    nodes = prints.select("fp", branch.alias("n")).select("fp", "n.block", "n.branch")
    counts = nodes.groupBy("block", "branch").count().filter(F.col("count") > trie_rows)
    parts = counts.select(
        "block", "branch", F.ceil(2 * F.col("count") / trie_rows).cast("int").alias("parts")
    )
    own = F.pmod(F.xxhash64(F.lit("part"), "fp"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    spread = (
        nodes.join(parts, ["block", "branch"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", other)
        # A part meets itself in its meetings with the others.
        .filter((F.col("parts") == 1) | (F.col("own") != F.col("other")))
        .select(
            "fp",
            "block",
            "branch",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
        )
    )
    keys = ["block", "branch", "low", "high"]

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for frame in frames:
            if not len(frame):
                continue
            changed = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
            changed[0] = bool(waiting) and not waiting[-1][keys].iloc[-1].equals(frame[keys].iloc[0])
            cuts = np.flatnonzero(changed)
            if len(cuts):
                waiting.append(frame.iloc[: cuts[-1]])
                yield _forest(pd.concat(waiting), keys, width, budget)
                waiting = [frame.iloc[cuts[-1] :]]
            else:
                waiting.append(frame)
        if waiting:
            yield _forest(pd.concat(waiting), keys, width, budget)

    return (
        spread.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(join, "a long, b long")
    )


def _forest(frame: pd.DataFrame, keys: list[str], width: int, budget: int) -> pd.DataFrame:
    """Links of a run of whole groups to the first row of each component."""
    fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
    block = frame["block"].to_numpy(np.uint64) * np.uint64(width)
    change = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
    group = np.cumsum(change)
    # The branch bits are equal in a group: close the gap they leave.
    low = fp & ((np.uint64(1) << block) - np.uint64(1))
    above = block + np.uint64(width)
    high = np.where(
        above < _BITS, (fp >> np.minimum(above, np.uint64(_BITS - 1))) << block, np.uint64(0)
    )
    rest = low | high
    order = np.lexsort((rest, group))
    fp, root = fp[order].view(np.int64), trie_roots(group[order], rest[order], _BITS - width, budget)
    linked = np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"a": fp[linked], "b": fp[root[linked]]})


def near_duplicates(
    df: DataFrame,
    words: int = 3,
    budget: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    trie_rows: int = TRIE_ROWS,
) -> DataFrame:
    """(id, fp long, component_id) per row: rows linked, directly or not, share the component.

    Fingerprints link at ``budget`` or fewer differing bits; the component is named by
    its smallest id. Equal fingerprints are joined once, not pair by pair.

    Null and empty texts have fingerprint 0 and link like any other. Rows with a null id
    get the component of their fingerprint but never name one; repeated rows stay.
    An empty table gives an empty result. Columns other than the two named are not
    carried.
    """
    rows = checkpointed(fingerprints(df, words, id_column, text_column))
    prints = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = fingerprint_links(prints.select("fp"), budget, trie_rows)
    roots = checkpointed(connected_components(links))
    member = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(names, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("doc_id").alias(id_column), "fp", "component_id")


def one_of_each(
    df: DataFrame,
    words: int = 3,
    budget: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
    trie_rows: int = TRIE_ROWS,
) -> DataFrame:
    """One row, as it is, of each component of near duplicates: the one of smallest id.

    Rows that repeat this id in the component count as duplicates too: the first by
    fingerprint and text hash stays. A component in which no row has an id keeps one row.
    Null and empty texts are one component. An empty table gives an empty result; all
    columns are carried, whatever their names.
    """
    path = new_folder(df.sparkSession, "simhash")
    fp, row = unused(df, "__fp"), unused(df, "__row")

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    # Row numbers and fingerprints are written once, so that both readings agree.
    df.withColumns(
        {row: F.monotonically_increasing_id(), fp: prints(F.col(text_column))}
    ).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    # The first row of a fingerprint stands for it; a hot one is folded before it is exchanged.
    first = F.struct(
        F.col(id_column).isNull().alias("a"),
        F.col(id_column).alias("b"),
        F.xxhash64(text_column).alias("c"),
        F.col(row).alias("row"),
    )
    classes = checkpointed(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(first).alias("first")))
    links = fingerprint_links(classes.select("fp"), budget, trie_rows)
    roots = connected_components(links)
    kept = (
        classes.join(roots, classes["fp"] == roots["node"], "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias(row))
    )
    return rows.join(checkpointed(kept), row, "left_semi").select(*df.columns)
