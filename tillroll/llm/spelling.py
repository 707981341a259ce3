"""Spelling variants: words one edit apart, found by search schemes on a bidirectional FM-index."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.storage import checkpointed

# Rows of one group, and of one index.
GROUP_ROWS = 40_000
# Queries followed side by side.
_QUERIES = 8_000
# What a word is, and every how many runs lose a code point.
RUN = "[A-Za-zÀ-ÿ]"
LEAST_CHARS, LEAST_COUNT, TIMES, DAMAGE = 6, 5, 5, 199
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    damage: int = DAMAGE,
) -> DataFrame:
    """(word, n): distinct words of whole texts with at least so many code points and occurrences.

    A word is a maximal run of Latin letters with A-Z lower-cased. Of every ``damage``-th one, by the
    CRC-32 of ``<id>:<run>``, a code point is left out, which plants spelling variants. Counts
    combine before the shuffle. Null texts have no words; a null id counts as empty text; repeated
    rows count again.
    """
    text = F.translate(F.coalesce(F.col(text_column), F.lit("")), _UPPER, _LOWER)
    # A shorter run is no word, damaged or not.
    runs = F.regexp_extract_all(text, F.lit(f"{RUN}{{{least_chars},}}"), F.lit(0))
    found = documents.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")
    )
    hash_ = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("hash") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (
        found.withColumn("hash", hash_)
        .select(F.when(F.col("hash") % damage == 0, less).otherwise(F.col("run")).alias("word"))
        .filter(F.length("word") >= least_chars)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= least_count)
    )


class _Wavelet:
    """Ranks of symbols in a sequence: a wavelet matrix of running counts of zeros per bit."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, size = bits, len(symbols)
        self.symbols = symbols
        self.zeros = np.zeros((bits, size + 1), np.int32)
        self.split = np.zeros(bits, np.int64)
        order = symbols
        for level in range(bits):
            low = (order >> (bits - 1 - level)) & 1 == 0
            np.cumsum(low, out=self.zeros[level, 1:])
            self.split[level] = self.zeros[level, -1]
            order = np.concatenate([order[low], order[~low]])
        counts = np.bincount(symbols, minlength=1 << bits)
        # Where a symbol's rotations begin, less where it begins in the last order of the matrix.
        begin = np.zeros(1 << bits, np.int64)
        begin[order[::-1]] = np.arange(size)[::-1]
        self.shift = np.cumsum(counts) - counts - begin

    def step(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, ...]:
        """The interval of the pattern longer by a symbol, and how many smaller symbols the old one has."""
        smaller = np.zeros(len(low), np.int64)
        shift = self.shift[symbol]
        for level in range(self.bits):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            zeros = self.zeros[level]
            a, b = zeros[low], zeros[high]
            smaller += np.where(one, b - a, 0)
            low = np.where(one, self.split[level] + low - a, a)
            high = np.where(one, self.split[level] + high - b, b)
        return low + shift, high + shift, smaller


def _rotations(text: np.ndarray, starts: np.ndarray, bits: int) -> np.ndarray:
    """Start positions of the sorted rotations of delimited, sorted, distinct words.

    ``starts`` are the delimiters, symbol 0. Behind a delimiter the order of the words decides, so
    ranks of 63 bits' worth of symbols are doubled in length until none is shared.
    """
    size = len(text)
    begin = np.flatnonzero(text)
    ends = np.append(starts[1:], size)
    end = ends[np.searchsorted(starts, begin, "right") - 1]
    width = 63 // bits
    key = np.zeros(len(begin), np.int64)
    for k in range(width):
        at = begin + k
        key = (key << bits) | np.where(at < end, text[np.minimum(at, size - 1)], 0)
    rank = np.zeros(size, np.int64)
    rank[starts] = np.arange(len(starts))
    values, dense = np.unique(key, return_inverse=True)
    while len(values) < len(begin):
        rank[begin] = len(starts) + dense
        behind = np.minimum(begin + width, end)
        values, dense = np.unique(
            dense * np.int64(size + 1) + rank[np.where(behind == size, 0, behind)], return_inverse=True
        )
        width *= 2
    return np.concatenate([starts, begin[np.argsort(dense)]])


class Index:
    """A bidirectional FM-index over delimited words: intervals of suffix ranks in both directions.

    ``#w1#w2…`` is read as a ring and its sorted rotations are kept as the symbols before them;
    so is the text of the reversed words. A pattern has an interval of equal size in
    either; longer by a symbol on one side, its interval there is a step of that side, and in the
    other it moves by the number of smaller symbols. The rotations that begin with ``#`` stand in the
    order of the words, so the first rank of ``#word#`` is the word's number.
    """

    def __init__(self, words: list[str]) -> None:
        """``words`` are distinct and in code-point order."""
        self.size = len(words)
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.alphabet = np.unique(letters)
        self.bits = (len(self.alphabet) + 1).bit_length()
        # Steps to the left read the words as they are, steps to the right the reversed ones.
        self.left = self._side(words)
        self.right = self._side(sorted(w[::-1] for w in words))

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words in a row, 0 before each, and where the zeros stand."""
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths + 1) - lengths - 1
        text = np.zeros(len(letters) + len(words), np.int64)
        inside = np.ones(len(text), bool)
        inside[starts] = False
        place = np.searchsorted(self.alphabet, letters)
        known = place < len(self.alphabet)
        known[known] = self.alphabet[place[known]] == letters[known]
        # A letter that no word has is a symbol of its own, which never occurs.
        text[inside] = np.where(known, place, len(self.alphabet)) + 1
        return text, starts

    def _side(self, words: list[str]) -> _Wavelet:
        text, starts = self.codes(words)
        return _Wavelet(text[_rotations(text, starts, self.bits) - 1], self.bits)

    def near(self, queries: list[str], exact: np.ndarray, rightwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query number, word number) of words one edit from a query, the edit outside its exact part.

        Rightwards, the first ``exact`` code points of a query are matched as they are and the match is
        extended to the right; else the last ones, and to the left. Each pair is given once.
        """
        found: list[np.ndarray] = []
        for start in range(0, len(queries), _QUERIES):
            part = queries[start : start + _QUERIES]
            # A word matched leftwards is read from its end.
            text, starts = self.codes(part if rightwards else [w[::-1] for w in part])
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            search = _Search(self, self.right if rightwards else self.left, rightwards, text, starts + 1, lengths)
            found.append(search.run(exact[start : start + _QUERIES]) + start * self.size)
        pairs = np.concatenate(found) if found else np.zeros(0, np.int64)
        return pairs // max(self.size, 1), pairs % max(self.size, 1)


@dataclass
class _States:
    """Partial matches: whose, how far in the query, and their intervals in both directions."""

    query: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    other: np.ndarray

    def take(self, chosen: np.ndarray) -> _States:
        return _States(*(getattr(self, f)[chosen] for f in self.__dataclass_fields__))

    def join(self, more: list[_States]) -> _States:
        both = [self, *more]
        return _States(*(np.concatenate([getattr(s, f) for s in both]) for f in self.__dataclass_fields__))


class _Search:
    """All queries of a batch in step: the exact chain, and from it matches with their one edit."""

    def __init__(self, index, side, rightwards, text, begin, lengths) -> None:
        self.index, self.side, self.rightwards = index, side, rightwards
        self.text, self.begin, self.lengths = text, begin, lengths

    def next_symbol(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The query's symbol at a place, the delimiter behind its end."""
        inside = at < self.lengths[query]
        place = np.minimum(self.begin[query] + at, len(self.text) - 1)
        return np.where(inside, self.text[place], 0)

    def advance(self, s: _States, symbol: np.ndarray, step: int = 1) -> _States:
        low, high, smaller = self.side.step(s.low, s.high, symbol)
        moved = _States(s.query, s.at + step, low, high, s.other + smaller)
        return moved.take(np.flatnonzero(high > low))

    def branches(self, s: _States) -> tuple[np.ndarray, np.ndarray]:
        """(state, symbol) for the letters that can follow each state."""
        letters = len(self.index.alphabet)
        size = s.high - s.low
        few = np.flatnonzero(size <= letters)
        many = np.flatnonzero(size > letters)
        width = size[few]
        place = np.repeat(s.low[few] - np.cumsum(width) + width, width) + np.arange(width.sum())
        pairs = np.unique((np.repeat(few, width) << 32) | self.side.symbols[place])
        pairs = np.concatenate(
            [pairs, (np.repeat(many, letters) << 32) | np.tile(np.arange(1, letters + 1), len(many))]
        )
        pairs = pairs[pairs & 0xFFFFFFFF > 0]
        return pairs >> 32, pairs & 0xFFFFFFFF

    def run(self, exact: np.ndarray) -> np.ndarray:
        """Pairs as query number * words + word number, sorted and distinct."""
        n, words = len(exact), self.index.size
        zero = np.zeros(n, np.int64)
        # The delimiter has all words on either side.
        chain = _States(np.arange(n), zero, zero, np.full(n, words, np.int64), zero)
        for k in range(int(exact.max(initial=0))):
            going = np.flatnonzero(exact[chain.query] > k)
            rest = np.flatnonzero(exact[chain.query] <= k)
            moved = chain.take(going)
            chain = chain.take(rest).join([self.advance(moved, self.next_symbol(moved.query, moved.at))])
        edited = chain.take(np.zeros(0, np.int64))
        found = []
        while len(chain.query) or len(edited.query):
            symbol = self.next_symbol(chain.query, chain.at)
            at, letter = self.branches(chain)
            wrong = np.flatnonzero(letter != symbol[at])
            wider = self.advance(chain.take(at[wrong]), letter[wrong], 0)
            inside = np.flatnonzero(wider.at < self.lengths[wider.query])
            replaced = wider.take(inside)
            replaced.at = replaced.at + 1
            # Of equal letters in a row the last one is left out, and a letter like the next is not
            # put before it: either gives the same word later.
            last = (symbol > 0) & (symbol != self.next_symbol(chain.query, chain.at + 1))
            without = chain.take(np.flatnonzero(last))
            without.at = without.at + 1
            chain = chain.take(np.flatnonzero(symbol > 0))
            chain = self.advance(chain, symbol[symbol > 0])
            edited = self.advance(edited, self.next_symbol(edited.query, edited.at))
            done = edited.at > self.lengths[edited.query]
            complete = edited.take(np.flatnonzero(done))
            # Rightwards, the interval of the words as they are is the other one.
            number = complete.other if self.rightwards else complete.low
            found.append(complete.query * words + number)
            edited = edited.take(np.flatnonzero(~done)).join([wider, replaced, without])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


class _Part:
    """Words indexed together, searched for others."""

    def __init__(self, rows: pd.DataFrame) -> None:
        known = dict(zip(rows["word"], rows["n"], strict=True))
        self.words = sorted(known)
        self.numbers = np.array([known[w] for w in self.words], np.int64)
        self.index = Index(self.words) if self.words else None

    def near(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Per word of ``rows`` and scheme: how many near words, and the one of largest count."""
        for side in (0, 1) if self.index else ():
            asked = sorted(set(rows["word"][rows["asks"] & (rows["side"] == side)]))
            lengths = np.array([len(w) for w in asked], np.int64)
            half = lengths // 2
            query, word = self.index.near(asked, lengths - half if side else half, side == 0)
            if side:
                # What the other scheme finds too, is its.
                own = [
                    not self.words[w].startswith(asked[q][: len(asked[q]) // 2])
                    for q, w in zip(query.tolist(), word.tolist(), strict=True)
                ]
                query, word = query[np.array(own, bool)], word[np.array(own, bool)]
            # Words are in code-point order: the first of the largest counts is the least.
            best = np.lexsort((word, -self.numbers[word], query))
            query, word = query[best], word[best]
            first = np.flatnonzero(np.diff(query, prepend=-1))
            yield pd.DataFrame(
                {
                    "word": pd.Series([asked[q] for q in query[first]], dtype=object),
                    "n_near": np.diff(np.append(first, len(query))).astype(np.int64),
                    "best_n": self.numbers[word[first]],
                    "best": pd.Series([self.words[w] for w in word[first]], dtype=object),
                }
            )


def _search_groups(frames: Iterator[pd.DataFrame], keys: list[str], rows: int) -> Iterator[pd.DataFrame]:
    """Runs of whole groups, each of about ``rows`` rows, indexed and searched."""
    waiting: list[pd.DataFrame] = []
    for frame in frames:
        waiting.append(frame)
        if sum(map(len, waiting)) < rows:
            continue
        whole = pd.concat(waiting, ignore_index=True)
        last = int(np.flatnonzero((whole[keys] != whole[keys].shift()).any(axis=1))[-1])
        if last:
            ready = whole.iloc[:last]
            yield from _Part(ready).near(ready)
        waiting = [whole.iloc[last:]]
    if waiting:
        ready = pd.concat(waiting, ignore_index=True)
        yield from _Part(ready).near(ready)


def _search_parts(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Parts of large groups one by one: the indexed rows come first, the others pass by."""
    key, held, part = None, [], None

    def built() -> Iterator[pd.DataFrame]:
        nonlocal part
        rows = pd.concat(held, ignore_index=True)
        part = _Part(rows)
        yield from part.near(rows)

    for frame in frames:
        for found, piece in frame.groupby(keys, sort=False):
            if found != key:
                if held and part is None:
                    yield from built()
                key, held, part = found, [], None
            indexed = piece[piece["indexed"]]
            if len(indexed):
                held.append(indexed)
            passing = piece[~piece["indexed"]]
            if len(passing) and held:
                if part is None:
                    yield from built()
                yield from part.near(passing)
    if held and part is None:
        yield from built()


def _halves(word: Column) -> Column:
    """(side, half, asks) under which a word meets its near ones.

    A near word of length q shares the first q // 2 or the last q - q // 2 code points of the query,
    and its own length differs by one at most.
    """
    length = F.length(word)
    pieces = []
    for side in (0, 1):
        own = F.floor(length / 2) if side == 0 else length - F.floor(length / 2)
        for shift in (-1, 1):
            near = F.floor((length + shift) / 2)
            size = (near if side == 0 else length + shift - near).cast("int")
            half = F.substring(word, F.lit(1), size) if side == 0 else F.right(word, size)
            # One of the two neighbouring lengths halves like the word's own.
            pieces.append(
                F.struct(F.lit(side).alias("side"), half.alias("half"), (size == own).alias("asks"))
            )
    return F.array(*pieces)


def near_words(words: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(word, n_near, best_n, best) for the words of ``words(word, n)`` that have a near one.

    Two words are near if one inserted, deleted or replaced code point makes them equal. Words are
    dealt by their halves, where near ones must meet; a task builds an index of each bounded run of
    groups and searches it. A half that more than ``group_rows`` words share is cut into parts
    by hash: each part is indexed once and searched for all words of the group.
    """
    rows = words.select("word", "n", F.explode(_halves(F.col("word"))).alias("h")).select("word", "n", "h.*")
    hot = (
        rows.groupBy("side", "half")
        .count()
        .filter(F.col("count") > group_rows)
        .select("side", "half", F.ceil(2 * F.col("count") / group_rows).cast("int").alias("parts"))
    )
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    each = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    dealt = (
        rows.join(hot, ["side", "half"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.explode(each))
        .select("word", "n", "side", "half", "asks", "parts", "part", (F.col("part") == own).alias("indexed"))
    )
    keys, kind = ["side", "half", "part"], "word string, n_near long, best_n long, best string"

    def groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _search_groups(frames, keys, group_rows)

    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _search_parts(frames, keys)

    few = dealt.filter("parts = 1").repartition(*keys).sortWithinPartitions(*keys)
    many = dealt.filter("parts > 1").repartition(*keys).sortWithinPartitions(*keys, F.desc("indexed"))
    found = few.mapInPandas(groups, kind).unionByName(many.mapInPandas(parts, kind))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("b"))
        .select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))
    )


def spelling_variants(
    words: DataFrame, times: int = TIMES, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the distinct words of ``words(word, n)``.

    The form of a word is its near word of largest ``n``, ties to the smaller in code-point order, if
    that has at least ``times`` its count; else null. The root is where the forms lead, the word itself
    without one. Counts rise ``times``-fold along the forms, so their chains are short and are
    followed in doubling steps. Every round is checkpointed.

    Rows with a null word or count are left out; a word that is repeated counts with the sum. An empty
    table gives an empty result; other columns are not carried.
    """
    known = checkpointed(
        words.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    )
    near = near_words(known, group_rows)
    large = F.col("best_n") >= times * F.col("n")
    found = checkpointed(
        known.join(near, "word", "left").select(
            "word",
            F.when(large, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(large, F.col("best_n")).alias("form_n"),
        )
    )
    most = found.agg(F.max("n")).first()[0] or 1
    # A chain has no more steps than counts can rise; each round doubles the steps taken.
    steps = 1 + int(math.log(max(most, 1)) / math.log(max(times, 2)))
    roots = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(0, steps - 1).bit_length()):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = checkpointed(
            roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        )
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
