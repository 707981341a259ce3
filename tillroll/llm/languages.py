"""Language identification by cross-parsing: phrases that suffix automata match."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Labelled documents per language and characters of each that a model is learned from.
TRAIN_DOCUMENTS = 64
TRAIN_CHARS = 700
UNDETERMINED = "und"
# Parts in which the first documents of a language are looked for.
_BUCKETS = 64
# A long text is parsed in blocks of that many characters, side by side; what a block's neighbour
# before it leaves unfinished is then carried into it.
_BLOCK = 256
# Times that blocks are parsed again side by side before the rest is walked through one by one.
_ROUNDS = 12
# Entries up to which an automaton is a full table; a language of many letters has a sorted list.
_FULL_TABLE = 1 << 24
_SLICE_CHARS = 3_000_000
_SHARPNESS = 40.0


@dataclass(frozen=True)
class Sample:
    """The texts a model is built from: languages and their labelled text, in code point order."""

    languages: tuple[str, ...]
    texts: tuple[str, ...]


def learn_languages(
    documents: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    train_documents: int = TRAIN_DOCUMENTS,
    train_chars: int = TRAIN_CHARS,
) -> Sample:
    """A bounded sample of labelled text per language.

    Of each language the ``train_documents`` texts of smallest hash give ``train_chars``
    characters each, from a place the hash chooses. Equal texts count once. Rows without text
    or label, or whose text has no letter, are not learned from.
    """
    text, size = F.col(text_column), F.char_length(text_column)
    start = F.pmod(F.xxhash64(F.lit("place"), text), F.greatest(size - train_chars, F.lit(1))) + 1
    labelled = documents.filter(text.rlike(r"\p{L}") & F.col(lang_column).isNotNull()).select(
        F.col(lang_column).alias("lang"),
        F.xxhash64(F.lit("language"), text).alias("order"),
        F.substring(text, start, F.lit(train_chars)).alias("part"),
    )
    # First in each of many buckets, then among those: no task gets a whole language, or what
    # every task of a large input has kept of it.
    each = Window.partitionBy("lang", "bucket").orderBy("order")
    first = Window.partitionBy("lang").orderBy("order")
    wanted = (
        labelled.select("lang", "order", F.pmod("order", F.lit(_BUCKETS)).alias("bucket"))
        .distinct()
        .withColumn("rank", F.row_number().over(each))
        .filter(F.col("rank") <= train_documents)
        .withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= train_documents)
        .select("lang", "order", "rank")
    )
    # Bounded by languages times documents.
    chosen = (
        labelled.join(F.broadcast(wanted), ["lang", "order"])
        .groupBy("lang", "rank")
        .agg(F.min("part").alias("part"))
        .collect()
    )
    parts: dict[str, list[str]] = {}
    for row in sorted(chosen, key=lambda r: (r["lang"], r["rank"])):
        parts.setdefault(row["lang"], []).append(row["part"])
    return Sample(tuple(parts), tuple("\n".join(p) for p in parts.values()))


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that has every substring of ``codes``; 0 is its start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and code not in moves[at]:
            moves[at][code] = new
            at = link[at]
        if at >= 0:
            target = moves[at][code]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                while at >= 0 and moves[at].get(code) == target:
                    moves[at][code] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    return moves


class Automaton:
    """Moves of one language's automaton, for many texts in step.

    Symbols are numbered within the language: 0 space, its letters, one for letters it does not
    have, padding. States are multiples of the number of symbols. State 0 stands between phrases;
    the automaton's start is left only to begin one, so it takes that place.
    """

    def __init__(self, codes: np.ndarray, symbols: int, full: int) -> None:
        """``codes`` is the labelled text in the model's symbols, the last of which is padding."""
        own = np.unique(codes)
        own = own[own != 0]
        self.other, self.pad, self.width = len(own) + 1, len(own) + 2, len(own) + 3
        self.local = np.full(symbols, self.other, np.int32)
        self.local[0], self.local[symbols - 1] = 0, self.pad
        self.local[own] = np.arange(1, len(own) + 1)
        moves = suffix_automaton(self.local[codes].tolist())
        sizes = np.fromiter(map(len, moves), np.int64, len(moves))
        states = np.repeat(np.arange(len(moves)), sizes)
        letters = np.fromiter((c for targets in moves for c in targets), np.int64, len(states))
        targets = np.fromiter((t for found in moves for t in found.values()), np.int64, len(states))
        keys, steps = states * self.width + letters, targets * self.width * 2 + (states == 0)
        # Where a state has no move a phrase begins, as from state 0.
        begin = np.ones(self.width, np.int64)
        begin[keys[states == 0]] = steps[states == 0]
        if len(moves) * self.width <= full:
            table = np.tile(begin | 1, (len(moves), 1))
            table.ravel()[keys] = steps
            table[:, self.pad] = np.arange(len(moves)) * self.width * 2
            self.table: np.ndarray | None = table.astype(np.int32).ravel()
        else:
            order = np.argsort(keys)
            self.table, self.begin = None, begin | 1
            # A key above all others spares a bound check.
            self.keys = np.append(keys[order], np.iinfo(np.int64).max)
            self.steps = np.append(steps[order], 0)

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Next state times two, and one more if a phrase begins."""
        if self.table is not None:
            return self.table[state + letter]
        key = state.astype(np.int64) + letter
        at = np.searchsorted(self.keys, key)
        found = np.where(self.keys[at] == key, self.steps[at], self.begin[letter])
        return np.where(letter == self.pad, state.astype(np.int64) * 2, found)

    def walk(self, state: int, letters: np.ndarray) -> tuple[int, int]:
        """(state, phrases) behind a run of symbols."""
        count = 0
        at = np.array([state])
        for letter in letters.tolist():
            step = self.table.item(state + letter) if self.table is not None else None
            if step is None:
                at[0] = state
                step = int(self.step(at, np.array([letter]))[0])
            state, count = step >> 1, count + (step & 1)
        return state, count


class Model:
    """Automata of all languages, for parsing many texts in step.

    Texts are folded to lower-case letters, everything else to single spaces. A phrase
    is the longest match from where the last one ended; a letter that a language does not have
    is a phrase of its own. All letters of the labelled text are told apart.
    """

    def __init__(self, sample: Sample, full_table: int = _FULL_TABLE) -> None:
        self.languages = sample.languages
        letters = sorted({c for text in sample.texts for c in text.lower() if c.isalpha()})
        # Symbols: 0 space, 1 … letters, then one for letters of no language, then padding.
        self.other, self.pad = len(letters) + 1, len(letters) + 2
        kinds = np.zeros(0x110000, np.int32)
        kinds[[i for i in range(0x110000) if chr(i).isalpha()]] = self.other
        kinds[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.kinds = kinds
        self.automata = [
            Automaton(self.codes([text])[0], self.pad + 1, full_table) for text in sample.texts
        ]

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts in a row, and where each text's symbols end."""
        lowered = [t.lower() + " " for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.kinds[points]
        kept = codes != 0
        kept[1:] |= codes[:-1] != 0
        ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)))
        return codes[kept], np.cumsum(kept)[ends - 1] if len(ends) else ends

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per (text, language), and symbols per text."""
        codes, ends = self.codes(texts)
        sizes = np.diff(ends, prepend=0)
        blocks = -(-sizes // _BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = (ends - sizes)[owner] + number * _BLOCK
        left = np.minimum(ends[owner] - at, _BLOCK)
        grid = np.full((len(owner), _BLOCK), self.pad, np.int32)
        inside = np.arange(_BLOCK) < left[:, None]
        grid[inside] = codes
        columns = np.ascontiguousarray(grid.T)
        found = np.zeros((len(texts), len(self.languages)), np.int64)
        for language, automaton in enumerate(self.automata):
            count = _parsed(automaton, columns, number > 0)
            found[:, language] = np.bincount(owner, count, len(texts)).astype(np.int64)
        return found, sizes

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language of fewest phrases per symbol, confidence) of each text."""
        if not self.languages or not texts:
            return [(UNDETERMINED, 0.0)] * len(texts)
        found, sizes = self.phrases(texts)
        rate = found / np.maximum(sizes, 1)[:, None]
        best = rate.argmin(axis=1)
        gap = rate - rate[np.arange(len(texts)), best][:, None]
        score = 1 / np.exp(-_SHARPNESS * gap).sum(axis=1)
        return [(self.languages[b], float(s)) for b, s in zip(best, score, strict=True)]


def _parsed(automaton: Automaton, columns: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Phrases that begin in each block, as if every text were parsed from end to end.

    All blocks are parsed from state 0 first. A block that ``follows`` another is then parsed again
    from the state its neighbour ended in, beside the parse it had, until both are in the same state:
    from there on nothing differs. Where they never meet, the block ends otherwise and the next
    one is parsed again in turn; what ``_ROUNDS`` have not settled is walked through in order.
    """
    local = automaton.local
    state, count = np.zeros(columns.shape[1], np.int32), np.zeros(columns.shape[1], np.int64)
    for column in columns:
        step = automaton.step(state, local[column])
        count += step & 1
        state = step >> 1
    entry = np.zeros_like(state)
    for _ in range(_ROUNDS):
        before = np.where(follows, np.roll(state, 1), 0)
        rows = np.flatnonzero(before != entry)
        if not len(rows):
            return count
        old, new = entry[rows], before[rows]
        entry[rows] = new
        for column in columns:
            letter = local[column[rows]]
            was, now = automaton.step(old, letter), automaton.step(new, letter)
            count[rows] += (now & 1).astype(np.int64) - (was & 1)
            old, new = was >> 1, now >> 1
            apart = old != new
            rows, old, new = rows[apart], old[apart], new[apart]
            if not len(rows):
                break
        state[rows] = new
    for block in range(len(state)):
        start = state[block - 1] if follows[block] else 0
        if start != entry[block]:
            state[block], count[block] = automaton.walk(int(start), local[columns[:, block]])
    return count


_MODELS: dict[str, Model] = {}


def _model(sample: Sample) -> Model:
    """Built once per worker from the sample, which is all that travels."""
    key = hashlib.sha256(repr(sample).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(sample)
    return _MODELS[key]


def languages(
    documents: DataFrame, sample: Sample, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, lang_pred, score) of whole texts, row by row.

    The language whose automaton needs fewest phrases per symbol wins; ties go to the
    first in code point order. The score is near 1 where the others need many more. Texts
    that are null or have no letter, and all texts if nothing was learned, are ``und``
    with score 0. Rows with null or repeated ids are rows like any other; an empty table
    gives an empty result. Columns other than the two named are not carried.
    """

    def compute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(sample)
        for frame in frames:
            texts = [t if isinstance(t, str) else "" for t in frame["text"]]
            found: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
            lettered = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
            for chosen in _slices(lettered, texts):
                for i, answer in zip(chosen, model.predict([texts[i] for i in chosen]), strict=True):
                    found[i] = answer
            yield frame[["id"]].assign(
                lang_pred=pd.Series([f[0] for f in found], dtype=object, index=frame.index),
                score=pd.Series([f[1] for f in found], dtype="float64", index=frame.index),
            )

    kind = documents.schema[id_column].dataType.simpleString()
    return (
        documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
        .mapInPandas(compute, f"id {kind}, lang_pred string, score double")
        .withColumnRenamed("id", id_column)
    )


def _slices(chosen: list[int], texts: list[str]) -> Iterator[list[int]]:
    part: list[int] = []
    size = 0
    for i in chosen:
        if part and size + len(texts[i]) > _SLICE_CHARS:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(texts[i])
    if part:
        yield part
