"""The pipeline's token files are there when it has ended."""

import zlib

import corpus_pipeline
import numpy as np

from tests.llm.helpers import documents
from tillroll.llm.storage import shared_root
from tillroll.llm.tokens import read_token_files


def checksums(spark, path):
    rows = read_token_files(spark, path).collect()
    return {(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in rows}


def test_files_stay_where_the_caller_wants_them(spark, tmp_path):
    path = str(tmp_path / "tokens")
    docs = documents(spark, [(1, "some words here"), (2, "and more of them"), (3, None)])
    rows = {tuple(r) for r in corpus_pipeline.write_tokens(spark, docs, "", path).collect()}
    assert len(rows) == 3 and checksums(spark, path) == rows


def test_files_stay_without_a_path(spark):
    docs = documents(spark, [(7, "some words here")])
    folders = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/pipeline-tokens-*")
    system = folders.getFileSystem(spark._jsc.hadoopConfiguration())
    found = lambda: {str(f.getPath()) for f in system.globStatus(folders)}
    before = found()
    rows = {tuple(r) for r in corpus_pipeline.write_tokens(spark, docs, "").collect()}
    (path,) = found() - before
    assert checksums(spark, path) == rows
