"""From documents to token files: five stages, each over all rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.decontamination import without_contaminated
from tillroll.llm.mixing import mixed_documents
from tillroll.llm.queries import TOXIC, kept_token_files, table, toxicity_lexicon
from tillroll.llm.simhash import one_of_each
from tillroll.llm.storage import new_folder
from tillroll.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores below the threshold; the lexicon comes from the labels."""
    return without_toxic(docs, toxicity_lexicon(docs, table(spark, sf_dir, "labels")), TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of linked fingerprints."""
    return one_of_each(docs, words=3, budget=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources: a row for each pass that takes words of a document."""
    return mixed_documents(docs)


def write_tokens(
    spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None
) -> DataFrame:
    """Token files of the mix, read back: place, number and checksum of ids per row.

    The files stay in ``path``, a folder that does not exist yet; without one, in a new folder
    ``pipeline-tokens-*`` under the shared root. ``read_token_files`` reads them.
    """
    return kept_token_files(docs, path or new_folder(spark, "pipeline-tokens"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

# Learned lexicons, fingerprints and token ids are beyond SQL; a plain version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, tokens: str | None = None) -> DataFrame:
    """All stages on the documents table; each result is written and read again.

    The token files stay in ``tokens``, or where ``write_tokens`` puts them without a path.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        more = {"path": tokens} if stage is write_tokens else {}
        stage(spark, docs, sf_dir, **more).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
