"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.storage import checkpointed

# The most labelled documents of either class that a lexicon is learned from, chosen by hash.
TOXIC_ROWS = 2000
CLEAN_ROWS = 6000
# An entry needs that many toxic documents and distinct surroundings, and evidence (a G statistic).
_SUPPORT = 3
_EVIDENCE = 15.0
# The least weight: toxic documents have an entry at least five and a half times as often.
_LEAST_WEIGHT = 1.7
# Resolution of a share of all rows.
_STEPS = 1 << 40
# Lengths of word beginnings that can be entries, besides whole words.
_STEMS = range(4, 9)

# Look-alikes of Latin letters, substitutes of letters, phrases without offence.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l", "ɪ": "i", "ꜱ": "s", "ᴏ": "o",
    # Without width: zero-width space and joiners, word joiner, soft hyphen, byte order mark.
    "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "", "\u00ad": "", "\ufeff": "",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
EXCEPTIONS = ("trash can", "trash bin", "trash collection", "clown fish", "worthless bond")

_LETTER = r"[^\W\d_]"
_WORD = re.compile(f"{_LETTER}+")
_ALIKE = re.compile("[" + "".join(HOMOGLYPHS) + "]")
_ALIKE_TABLE = str.maketrans(HOMOGLYPHS)
_SIGNS = "[0134578@$]"
_SUBSTITUTE = re.compile(
    rf"{_SIGNS}(?={_SIGNS}*{_LETTER})|(?<={_LETTER}){_SIGNS}(?![\w@$])"
)


def fold(text: str | None) -> str:
    """Lower case, compatibility forms and look-alikes as plain letters, substitutes undone.

    A digit or sign is a substitute where a letter follows it, maybe after other
    substitutes, or where it alone ends a word.
    """
    folded = (text or "").lower()
    if not folded.isascii():
        if not unicodedata.is_normalized("NFKC", folded):
            # Compatibility forms of letters may be capitals: lower again.
            folded = unicodedata.normalize("NFKC", folded).lower()
        if _ALIKE.search(folded):
            folded = folded.translate(_ALIKE_TABLE)
    return _SUBSTITUTE.sub(lambda m: SUBSTITUTES[m[0]], folded)


def entries_of(word: str) -> list[str]:
    """What a folded word can match: its beginnings, and the whole word marked by a full stop."""
    return [word[:n] for n in _STEMS if n <= len(word)] + [word + "."]


@dataclass
class Lexicon:
    """Weights of words (ending in a full stop) and of word beginnings, and a calibration."""

    weights: dict[str, float]
    coefficients: tuple[float, float, float] = (-30.0, 0.0, 0.0)
    exceptions: tuple[str, ...] = EXCEPTIONS
    _automaton: ahocorasick.Automaton | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_automaton": None}

    def _matcher(self) -> ahocorasick.Automaton | None:
        if self._automaton is None and self.weights:
            made: dict[str, list] = {}
            for entry, weight in self.weights.items():
                text = entry.rstrip(".")
                made.setdefault(text, [len(text), 0.0, 0.0, False])[2 if entry[-1] == "." else 1] = weight
            for phrase in self.exceptions:
                text = fold(phrase)
                made.setdefault(text, [len(text), 0.0, 0.0, False])[3] = True
            self._automaton = ahocorasick.Automaton()
            for text, value in made.items():
                self._automaton.add_word(text, tuple(value))
            self._automaton.make_automaton()
        return self._automaton

    def matched(self, folded: str) -> float:
        """The sum of the weights of matched words; a word counts once, by its largest weight.

        Entries match at the beginning of a word, words to its end; what lies inside an
        exception phrase does not count.
        """
        matcher = self._matcher()
        if matcher is None:
            return 0.0
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for last, (length, stem, word, exception) in matcher.iter(folded):
            start = last + 1 - length
            if start and folded[start - 1].isalpha():
                continue
            ended = last + 1 == len(folded) or not folded[last + 1].isalpha()
            weight = max(stem, word) if ended else stem
            if weight > best.get(start, 0.0):
                best[start] = weight
            if exception and ended:
                spared.append((start, last))
        for start, last in spared:
            for at in [at for at in best if start <= at <= last]:
                del best[at]
        return sum(best.values())

    def features(self, text: str | None) -> tuple[float, float]:
        """Matched weight as a sum and normalised by length, both damped."""
        folded = fold(text)
        total = self.matched(folded)
        if not total:
            return 0.0, 0.0
        return math.log1p(total), math.log1p(100 * total / (20 + len(folded.split())))

    def score(self, text: str | None) -> float:
        bias, by_sum, by_length = self.coefficients
        total, density = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, bias + by_sum * total + by_length * density))))


def _evidence(toxic: int, clean: int, toxic_rows: int, clean_rows: int) -> float:
    """G statistic of an entry that is more frequent in toxic documents, else 0."""
    n, rows = toxic + clean, toxic_rows + clean_rows
    expected = n * toxic_rows / rows
    if toxic <= expected:
        return 0.0
    rest = clean * math.log(clean / (n - expected)) if clean else 0.0
    return 2 * (toxic * math.log(toxic / expected) + rest)


def learn_lexicon(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
) -> Lexicon:
    """A lexicon from labelled documents, at most so many of either class.

    Entries are words and word beginnings that toxic documents have significantly more often,
    in several documents and in different surroundings: copies of one text repeat words
    but not surroundings. A weight is the log ratio of document rates; the calibration is a
    logistic fit on the same documents, its intercept set back to the rates of all labels.

    Rows with a null id, text or label are not learned from. Without labels of both
    classes the lexicon is empty and every score is near zero. The sample is fixed
    by the ids' hashes; what reaches the driver is bounded by it.
    """
    marked = labels.filter(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("doc_id"), F.col(label_column).cast("int").alias("label")
    )
    rates = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(rates) < 2:
        return Lexicon({})
    order = F.xxhash64(F.lit("toxicity"), "doc_id")

    def first(label: int, bound: int) -> DataFrame:
        """The rows of smallest hash, sought among about four times as many: few meet to be sorted."""
        share = min(1.0, 4 * bound / rates[label])
        near = F.pmod(F.xxhash64(F.lit("near"), "doc_id"), F.lit(_STEPS)) < int(share * _STEPS)
        rows = marked.filter((F.col("label") == label) & near)
        return rows.orderBy(order, "doc_id").limit(bound)

    sample = [first(1, toxic_rows), first(0, clean_rows)]
    chosen = F.broadcast(sample[0].unionByName(sample[1]).dropDuplicates(["doc_id"]))
    train = checkpointed(
        documents.filter(F.col(text_column).isNotNull())
        .select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
        .join(chosen, "doc_id")
        .repartition(documents.sparkSession.sparkContext.defaultParallelism * 2)
    )
    number = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if len(number) < 2:
        return Lexicon({})

    def surroundings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["text"]:
                found, before = set(), ""
                for word in _WORD.findall(fold(text)):
                    place = hash_of(before, word)
                    found.update((entry, place) for entry in entries_of(word))
                    before = word
                if found:
                    yield pd.DataFrame(list(found), columns=["entry", "place"]).astype(
                        {"entry": object}
                    )

    places = (
        train.filter("label = 1")
        .select("text")
        .mapInPandas(surroundings, "entry string, place long")
        .groupBy("entry", "place")
        .agg(F.count("*").alias("n"))
    )
    # A document counts once for each place, so the largest count bounds what copies add.
    candidates = (
        places.groupBy("entry")
        .agg(F.count("*").alias("places"), F.sum("n").alias("n"))
        .filter((F.col("places") >= _SUPPORT) & (5 * F.col("places") >= F.col("n")))
        .filter(F.col("n") >= _SUPPORT)
        .select("entry")
    )
    wanted = frozenset(r["entry"] for r in candidates.collect())

    def present(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text, label in zip(frame["text"], frame["label"], strict=True):
                words = set(_WORD.findall(fold(text)))
                found = sorted({entry for word in words for entry in entries_of(word)} & wanted)
                if found:
                    entry = pd.Series(found, dtype=object)
                    yield pd.DataFrame({"entry": entry, "label": label})

    counts = (
        train.select("text", "label")
        .mapInPandas(present, "entry string, label int")
        .groupBy("entry")
        .agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count("*").alias("all"))
        .collect()
    )
    weights = {}
    for entry, toxic, everywhere in counts:
        clean = everywhere - toxic
        if toxic >= _SUPPORT and _evidence(toxic, clean, number[1], number[0]) >= _EVIDENCE:
            rate = math.log((toxic + 0.5) / (number[1] + 1)) - math.log((clean + 0.5) / (number[0] + 1))
            if rate >= _LEAST_WEIGHT:
                weights[entry] = rate
    lexicon = Lexicon(weights)

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            both = np.array([lexicon.features(t) for t in frame["text"]]).reshape(-1, 2)
            yield pd.DataFrame({"total": both[:, 0], "density": both[:, 1], "label": frame["label"]})

    rows = (
        train.select("text", "label")
        .mapInPandas(measured, "total double, density double, label int")
        .toPandas()
    )
    bias, *slopes = _logistic(rows[["total", "density"]].to_numpy(), rows["label"].to_numpy())
    shift = math.log(rates[1] / rates[0]) - math.log(number[1] / number[0])
    return Lexicon(weights, (bias + shift, *slopes))


def hash_of(before: str, word: str) -> int:
    """A fixed 64-bit number of two neighbouring words."""
    import xxhash

    return xxhash.xxh64_intdigest(f"{before} {word}".encode("utf-8", "surrogatepass")) - 2**63


def _logistic(features: np.ndarray, label: np.ndarray, ridge: float = 0.05) -> list[float]:
    """Newton's method with a small penalty on the slopes."""
    x = np.column_stack([np.ones(len(features)), features])
    penalty = np.diag([1e-6, ridge, ridge])
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (label - p) - penalty @ beta
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + penalty, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return [float(b) for b in beta]


def toxicity(
    documents: DataFrame, lexicon: Lexicon, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, score) of whole texts, 0 to 1, row by row.

    Null and empty texts match nothing and get the score of no match. Rows with null or
    repeated ids are rows like any other; an empty table gives an empty result.
    Columns other than the two named are not carried.
    """

    def compute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[["id"]].assign(score=[lexicon.score(t) for t in frame["text"]]).astype(
                {"score": "float64"}
            )

    kind = documents.schema[id_column].dataType.simpleString()
    return (
        documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
        .mapInPandas(compute, f"id {kind}, score double")
        .withColumnRenamed("id", id_column)
    )


def without_toxic(
    documents: DataFrame, lexicon: Lexicon, least: float = 0.7, text_column: str = "text"
) -> DataFrame:
    """The rows, as they are, whose text scores below ``least``.

    Null and empty texts get the score of no match. Repeated rows and rows without an id are rows
    like any other; an empty table gives an empty result. All columns are carried, whatever their names.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([lexicon.score(t) for t in texts], dtype="float64")

    return documents.filter(score(F.col(text_column)) < least)
