"""Token files: exact ids of the library, round trip, order, pruning metadata."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.orc
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import clashing, documents
from tillroll.llm.queries import END_ID, TOKENIZER, op9_token_output
from tillroll.llm.tokens import Encoder, read_token_files, token_checksums, write_token_files

TEXTS = [
    "",
    "  \n",
    "Don't you'll THE they've 's 'S d'accord",
    "Écoute ça, Übermaß ñandú İstanbul ΣΑΣ ﬁne x́ é ́a",
    "a\xa0b c d\x1ce f\x85g \x00z\x7f",
    "<|endoftext|> x<|startoftext|>y <|other|> <| |>",
    "3.14159 12,000 a1b2 !!! ... @#$%^&*()_+ |~` --",
    "日本語 テスト 🎉🎉 \U0001f468‍\U0001f469 ﻿bom ퟿",
    "Ŀlanfair ŉ ſ ÀÉ×Ü÷ß naïve l'été J'AI ÿ&& Œuvre İz café—bar “quoted” don’t",
    "word " * 5000 + "x" * 3000,
]


def plain_rows(docs):
    """(doc_id, start, n_tokens, crc) with whole texts given to the library."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    start, rows = 0, []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_agrees_with_the_library(name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    got = Encoder(path).encode(pa.array(TEXTS), END_ID).to_pylist()
    assert got == [[*plain.encode(t, add_special_tokens=False).ids, END_ID] for t in TEXTS]


def test_encoder_forgets_words_and_stays_right(monkeypatch):
    monkeypatch.setattr("tillroll.llm.tokens._KEPT_WORDS", 3)
    encoder = Encoder(TOKENIZER)
    first = encoder.encode(pa.array(TEXTS), END_ID).to_pylist()
    assert encoder.encode(pa.array(TEXTS), END_ID).to_pylist() == first


def test_query_against_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in op9_token_output(spark, "/root/testdata/sf0.01").collect())
    assert got == plain_rows([(r["doc_id"], r["text"]) for r in docs])


def reader(spark, file):
    jvm = spark._jvm
    options = jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration())
    return jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(str(file)), options)


def test_files_are_ordered_and_indexed(spark, tmp_path):
    path = str(tmp_path / "tokens")
    df = documents(spark, [(i, f"text {i}") for i in range(500)]).repartition(7)
    write_token_files(df, path, TOKENIZER, END_ID)
    ids = []
    for file in sorted((tmp_path / "tokens").glob("part-*.orc")):
        ids += pa.orc.ORCFile(file).read(columns=["doc_id"]).column(0).to_pylist()
        assert reader(spark, file).getRowIndexStride() == 10_000
    assert ids == list(range(500))
    one = read_token_files(spark, path).filter("doc_id = 77")
    assert one.count() == 1
    assert "EqualTo(doc_id,77)" in one._jdf.queryExecution().toString()


def test_odd_rows(spark, tmp_path):
    rows = [(3, "b"), (None, "x y"), (1, None), (3, "b"), (2, ""), (4, "w " * 200_000)]
    path = str(tmp_path / "odd")
    write_token_files(clashing(documents(spark, rows)), path, TOKENIZER, END_ID)
    got = sorted((tuple(r) for r in token_checksums(spark, path).collect()), key=lambda r: r[1])
    assert got == plain_rows([(None, "x y"), (1, None), (2, ""), (3, "b"), (3, "b"), (4, "w " * 200_000)])
    empty = str(tmp_path / "empty")
    write_token_files(documents(spark, []), empty, TOKENIZER, END_ID)
    assert token_checksums(spark, empty).count() == 0
