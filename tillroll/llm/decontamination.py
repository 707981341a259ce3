"""Benchmark decontamination: pieces by the pigeonhole rule, verified by bit-parallel distance."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Edits allowed per character of a test item.
ERROR_RATE = 0.08
# Shorter items (normalised) count only where they stand unchanged between word boundaries.
SHORT_CHARS = 24
# Characters of test items searched for in one pass over the documents.
_PASS_CHARS = 4_000_000


def normal(text: str | None) -> str:
    """Lower case, white space as single spaces."""
    return " ".join((text or "").lower().split())


def best_distance(pattern: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """(least edit distance of the pattern to a part of the text, first end of such a part).

    Myers' bit vectors: bit i of the vertical differences stands for row i of the column.
    """
    if masks is None:
        masks = char_masks(pattern)
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, at = size, 0
    for i, char in enumerate(text, 1):
        equal = masks.get(char, 0)
        vertical = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
        if score < best:
            best, at = score, i
    return best, at


def char_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, char in enumerate(pattern):
        masks[char] |= 1 << i
    return dict(masks)


def pieces(text: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` parts of near-equal length and where they start."""
    parts = budget + 1
    cuts = [i * len(text) // parts for i in range(parts + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Matcher:
    """Finds test items in documents, with at most ``rate`` edits per character of an item.

    At most ``budget`` edits touch at most that many of ``budget + 1`` pieces, so some piece
    occurs unchanged. An Aho-Corasick automaton finds all pieces of all items in one
    run over the text; around the hits of an item the distance decides.
    """

    def __init__(
        self, items: list[tuple[int, str]], rate: float = ERROR_RATE, short_chars: int = SHORT_CHARS
    ) -> None:
        self.short_chars = short_chars
        self.items = [
            (i, text, int(rate * len(text)) if len(text) >= short_chars else 0, char_masks(text))
            for i, text in items
        ]
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, text, budget, _) in enumerate(self.items):
            for start, piece in pieces(text, budget):
                found[piece].append((number, start))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if self.items:
            self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item id, distance, budget, end) of the best place of each item in a normalised text."""
        if not self.items:
            return
        starts: dict[int, set[int]] = defaultdict(set)
        for last, (length, places) in self.automaton.iter(text):
            for number, offset in places:
                starts[number].add(last + 1 - length - offset)
        for number in sorted(starts):
            item, pattern, budget, masks = self.items[number]
            if len(pattern) < self.short_chars:
                ends = [at + len(pattern) for at in starts[number] if _bounded(text, at, len(pattern))]
                if ends:
                    yield item, 0, 0, min(ends)
                continue
            best = (budget + 1, 0)
            for low, high in _merged(sorted(starts[number]), budget):
                begin = max(0, low - budget)
                window = text[begin : high + len(pattern) + budget]
                exact = window.find(pattern)
                if exact >= 0:
                    found = (0, exact + len(pattern))
                else:
                    found = best_distance(pattern, window, masks)
                best = min(best, (found[0], begin + found[1]))
                if best[0] == 0:
                    break
            if best[0] <= budget:
                yield item, best[0], budget, best[1]

    def contains_any(self, text: str) -> bool:
        return next(self.matches(text), None) is not None


def _bounded(text: str, start: int, size: int) -> bool:
    """Whether a part of the text does not end inside a word on either side."""
    before, behind = text[max(start - 1, 0) : start], text[start + size : start + size + 1]
    return not (before.isalnum() and text[start].isalnum()) and not (
        behind.isalnum() and text[start + size - 1].isalnum()
    )


def _merged(starts: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Ranges of expected starts whose windows touch, joined."""
    low = high = starts[0]
    for start in starts[1:]:
        if start - high > 2 * budget + 1:
            yield low, high
            low = start
        high = start
    yield low, high


Items = list[tuple[int, str]]


def item_blocks(
    benchmark: DataFrame,
    item_column: str = "item_id",
    text_column: str = "text",
    pass_chars: int = _PASS_CHARS,
) -> Iterator[Items]:
    """Test items, normalised, in blocks of about ``pass_chars`` characters.

    A block is what one pass over the documents carries, so what is sent to the tasks is
    bounded however many items there are. Items without an id or without any character but white
    space take no part.
    """
    items = benchmark.filter(F.col(item_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(item_column).alias("item"), F.col(text_column).alias("text")
    )
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // pass_chars))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    for number in range(blocks):
        rows = items.filter(block == number).collect()
        chosen = sorted({(r["item"], normal(r["text"])) for r in rows})
        if found := [(i, t) for i, t in chosen if t]:
            yield found


_BUILT: dict[str, Matcher] = {}


class _Carried:
    """A block of items; a worker builds its matcher when it first needs it and keeps the last one."""

    def __init__(self, items: Items, rate: float, short_chars: int) -> None:
        self.items, self.rate, self.short_chars = items, rate, short_chars
        self.key = hashlib.sha256(
            repr((rate, short_chars, items)).encode("utf-8", "surrogatepass")
        ).hexdigest()

    def get(self) -> Matcher:
        if self.key not in _BUILT:
            _BUILT.clear()
            _BUILT[self.key] = Matcher(self.items, self.rate, self.short_chars)
        return _BUILT[self.key]


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rate: float = ERROR_RATE,
    short_chars: int = SHORT_CHARS,
    pass_chars: int = _PASS_CHARS,
) -> DataFrame:
    """(id, item_id, distance, budget, end) for each test item found in a document.

    ``distance`` is the least number of edits that turn the item into a part of the
    document, both in lower case with single spaces; ``end`` is where that part first
    ends. Items of fewer than ``short_chars`` characters, which common phrases contain by
    chance, are found only unchanged and between word boundaries. The whole text is searched.
    Documents are read once per block of items and never shuffled.

    Null and empty texts contain nothing. Rows with null or repeated ids are searched like
    any other; items of equal text are found as each of their ids. Empty tables give an
    empty result. Columns other than those named are not carried.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = None
    for items in item_blocks(benchmark, pass_chars=pass_chars):
        part = rows.mapInPandas(
            _search(_Carried(items, rate, short_chars)),
            f"id {kind}, item_id long, distance int, budget int, end int",
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.limit(0).select(
            "id",
            F.lit(0).cast("long").alias("item_id"),
            *[F.lit(0).alias(c) for c in ("distance", "budget", "end")],
        )
    return found.withColumnRenamed("id", id_column)


def _search(carried: _Carried):
    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = carried.get()
        for frame in frames:
            rows, ids = [], []
            for doc, text in zip(frame["id"].tolist(), frame["text"], strict=True):
                for match in matcher.matches(normal(text)):
                    ids.append(doc)
                    rows.append(match)
            if rows:
                out = pd.DataFrame(rows, columns=["item_id", "distance", "budget", "end"])
                out.insert(0, "id", pd.Series(ids, dtype=frame["id"].dtype))
                yield out

    return search


def without_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    rate: float = ERROR_RATE,
    short_chars: int = SHORT_CHARS,
) -> DataFrame:
    """The rows, as they are, in which no test item is found, by the rules of ``contaminated``.

    Null and empty texts stay, as do repeated rows and rows without an id. Without items all rows
    stay; an empty table gives an empty result. All columns are carried, whatever their names.
    """
    kept = documents
    for items in item_blocks(benchmark):
        kept = kept.filter(_clean(_Carried(items, rate, short_chars))(F.col(text_column)))
    return kept


def _clean(carried: _Carried):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        matcher = carried.get()
        return pd.Series([not matcher.contains_any(normal(t)) for t in texts], dtype=bool)

    return clean
