"""Token ids in ORC files: encode, write in id order, read back."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: how the word tokenizer splits. It drops white space, so words can be encoded one by one.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for lower-case ASCII and Latin letters that no normal form changes, U+0130 left out.
_PLAIN_WORD = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
_PLAIN_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u017f]+|[0-9]|[^a-z0-9\u00df-\u017f]+")
# Distinct words a worker keeps (30 to 40 bytes each), and bytes of text it encodes at a time.
_KEPT_WORDS = 1_000_000
_SLICE_BYTES = 4_000_000

SCHEMA = "part int, before long, n_tokens int, ids array<int>"


def _byte_letters() -> dict[int, int]:
    """Byte-level tokenizers show a byte as itself if it is printable, else as 256 and up in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


class Encoder:
    """Encodes texts with a tokenizer file of the tokenizers library.

    A tokenizer that drops white space gives a text the ids of its words, one after
    another; distinct words are encoded once and kept. Any other tokenizer gets whole texts.
    Words of plain letters, digits and ASCII signs are split here and given to the tokenizer's
    model; all others go through the whole tokenizer.

    Kept words are one Arrow array, their ids one flat array of 32-bit integers. Beyond
    ``_KEPT_WORDS`` only those stay that were met again since the last time.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            split = (json.load(file).get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_word = (
            split.get("pattern", {}).get("Regex") == _WORD_SPLIT
            and split.get("behavior") == "Removed"
            and split.get("invert") is True
        )
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = pa.array([], pa.string())
        self.flat = np.zeros(0, np.int32)
        self.lengths = np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)

    def encode(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """One list of ids per text, each ended by ``end_id``."""
        if not self.by_word:
            found = self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
            return pa.array([[*x.ids, end_id] for x in found], pa.list_(pa.int32()))
        words = pc.ascii_split_whitespace(texts)
        bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
        coded = words.flatten().dictionary_encode()
        places = self._places(coded.dictionary)
        # The end of a text is one more word, the last.
        flat = np.append(self.flat, np.int32(end_id))
        lengths = np.append(self.lengths, np.int32(1))
        starts = (np.cumsum(lengths, dtype=np.int64) - lengths).astype(np.int32)
        at = np.append(places, np.int32(len(lengths) - 1))[
            np.insert(coded.indices.to_numpy(), bounds[1:], len(places))
        ]
        each = lengths[at]
        ends = np.concatenate(([0], np.cumsum(each, dtype=np.int64)))
        ids = flat[
            np.repeat((starts[at] - ends[:-1]).astype(np.int32), each)
            + np.arange(ends[-1], dtype=np.int32)
        ]
        cuts = ends[bounds + np.arange(len(bounds))]
        return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids))

    def _places(self, words: pa.StringArray) -> np.ndarray:
        """The number of each word among those kept; new ones are encoded and kept."""
        if len(self.words) + len(words) > _KEPT_WORDS:
            self._drop_rare()
        places = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().copy()
        new = np.flatnonzero(places < 0)
        self.again[places[places >= 0]] = True
        places[new] = len(self.words) + np.arange(len(new))
        missing = words.take(pa.array(new))
        ids = self._ids(missing.to_pylist())
        lengths = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        self.words = pa.concat_arrays([self.words, missing])
        self.flat = np.concatenate([self.flat, flat])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.again = np.concatenate([self.again, np.zeros(len(ids), bool)])
        return places

    def _drop_rare(self) -> None:
        kept = self.again & (self.again.sum() <= _KEPT_WORDS // 2)
        self.words = self.words.filter(pa.array(kept))
        self.flat = self.flat[np.repeat(kept, self.lengths)]
        self.lengths = self.lengths[kept]
        self.again = np.zeros(len(self.lengths), bool)

    def _ids(self, words: list[str]) -> list[list[int]]:
        """Ids of words; a piece that several of them have is encoded once."""
        pieces: dict[str, list[int]] = {}
        tokenize = self.model.tokenize
        found: list[list[int]] = []
        rest = []
        for word in words:
            if word.isascii() and word.isalpha():
                parts = [word.lower()]
            elif _PLAIN_WORD.fullmatch(word) and "<|" not in word:
                parts = _PLAIN_SPLIT.findall(word.lower())
            else:
                rest.append((len(found), word))
                found.append([])
                continue
            ids: list[int] = []
            for part in parts:
                known = pieces.get(part)
                if known is None:
                    shown = part
                    if not part.isascii():
                        shown = part.encode().decode("latin-1").translate(_BYTE_LETTERS)
                    known = pieces[part] = [token.id for token in tokenize(shown)]
                ids = ids + known if ids else known
            found.append(ids)
        encoded = self.tokenizer.encode_batch_fast([w for _, w in rest], add_special_tokens=False)
        for (at, _), one in zip(rest, encoded, strict=True):
            found[at] = one.ids
        return found


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder per worker, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of about ``_SLICE_BYTES`` of text, a document at least."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + _SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def write_token_files(
    df: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Writes (id, part, before, n_tokens, ids) as ORC, in ascending id order over all files.

    Documents are ranged by id and sorted in each range; ``part`` numbers the ranges in
    order and ``before`` counts the ids of earlier documents of the part. ORC packs the
    integers by run lengths and keeps row indexes and, for ids, Bloom filters, so stripes
    are read side by side and readers skip those that cannot hold a wanted document.

    Null texts are encoded as empty and give the end id alone. Null ids come first; rows of
    one id follow each other in the order of their texts' hashes. An empty table writes
    no rows. Columns other than the two named are not carried. ``tokenizer`` is a path
    that every executor can open.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in _slices(batch):
                ids = encoder.encode(piece.column(1).cast(pa.string()), end_id)
                counts = np.diff(ids.offsets.to_numpy()).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array(np.full(len(counts), part, np.int32)),
                        pa.array(before + np.cumsum(counts) - counts),
                        pa.array(counts.astype(np.int32)),
                        ids,
                    ],
                    names=["doc_id", "part", "before", "n_tokens", "ids"],
                )
                before += int(counts.sum())
        pa.default_memory_pool().release_unused()

    kind = df.schema[id_column].dataType.simpleString()
    ordered = (
        df.select(
            F.col(id_column).alias("doc_id"),
            F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        )
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    (
        ordered.mapInArrow(encode, f"doc_id {kind}, {SCHEMA}")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.create.index", "true")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts the ids of all documents before."""
    return _started(spark, path, spark.read.orc(path))


def _started(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``part`` and ``before`` replaced by ``start``. There is one base per written file, so it is broadcast."""
    totals = spark.read.orc(path).groupBy("part").agg(
        F.sum(F.col("n_tokens").cast("long")).alias("total")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base")
    )
    others = [c for c in rows.columns if c not in ("doc_id", "part", "before", "n_tokens")]
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id",
        (F.col("base") + F.col("before")).alias("start"),
        F.col("n_tokens").cast("long"),
        *others,
    )


def token_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files' ids.

    The checksum is the CRC-32 of a document's ids as little-endian 32-bit integers.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            raw = memoryview(np.asarray(lists.values).astype("<u4", copy=False).view(np.uint8))
            codes = [
                zlib.crc32(raw[4 * a : 4 * b])
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array(np.diff(ends).astype(np.int32)),
                    pa.array(codes, pa.int64()),
                ],
                names=["doc_id", "part", "before", "n_tokens", "ids_crc32"],
            )

    files = spark.read.orc(path).select("doc_id", "part", "before", "ids")
    kind = files.schema["doc_id"].dataType.simpleString()
    summed = files.mapInArrow(
        sums, f"doc_id {kind}, part int, before long, n_tokens int, ids_crc32 long"
    )
    return _started(spark, path, summed)
