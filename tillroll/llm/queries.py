"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.codes import vector_codes
from tillroll.llm.decontamination import contaminated
from tillroll.llm.languages import languages, learn_languages
from tillroll.llm.licences import licence_scan
from tillroll.llm.mixing import mix, mixed_sizes
from tillroll.llm.neighbours import nearest_neighbours
from tillroll.llm.pii import personal_data, span_digest
from tillroll.llm.sharding import sharded
from tillroll.llm.simhash import near_duplicates
from tillroll.llm.spelling import spelling_variants, vocabulary
from tillroll.llm.storage import checkpointed, new_folder, remove_folder
from tillroll.llm.syncmers import edited_fingerprints
from tillroll.llm.tokens import token_checksums, write_token_files
from tillroll.llm.toxicity import Lexicon, learn_lexicon, toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
TOXIC = 0.7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_of(folds: int) -> Column:
    """The fold of a document, by its id's text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def toxicity_lexicon(documents: DataFrame, labels: DataFrame) -> Lexicon:
    """Learned from the labels that are not held out."""
    return learn_lexicon(documents, labels.filter(fold_of(3) != 1))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    documents = table(spark, folder, "documents")
    scored = toxicity(documents, toxicity_lexicon(documents, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(fold_of(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )


def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest vectors of every hundredth vector."""
    vectors = table(spark, folder, "embeddings")
    return nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op3_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licences granted in every document."""
    return licence_scan(table(spark, folder, "documents"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every document."""
    return span_digest(personal_data(table(spark, folder, "documents")))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    return mixed_sizes(mix(table(spark, folder, "documents")))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(fold_of(4) == 2, F.lit(False))
    found = languages(documents, learn_languages(documents.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def token_files(documents: DataFrame) -> DataFrame:
    """Writes the documents' token files, reads them back as checksums and removes them."""
    spark = documents.sparkSession
    path = new_folder(spark, "tokens")
    write_token_files(documents, path, TOKENIZER, END_ID)
    digest = checkpointed(token_checksums(spark, path))
    remove_folder(spark, path)
    return digest


def kept_token_files(documents: DataFrame, path: str) -> DataFrame:
    """Writes the documents' token files to a new folder and leaves them; their checksums are returned."""
    write_token_files(documents, path, TOKENIZER, END_ID)
    return token_checksums(documents.sparkSession, path)


def op9_token_output(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, written to ORC and read back."""
    return token_files(table(spark, folder, "documents"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one of eight shards of near-equal bytes."""
    return sharded(table(spark, folder, "documents"))


def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return edited_fingerprints(table(spark, folder, "documents"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Spelling variants in the vocabulary of all documents."""
    return spelling_variants(vocabulary(table(spark, folder, "documents")))


def op13_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Product codes of every vector."""
    return vector_codes(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_neighbours": op2_neighbours,
    "op3_licences": op3_licences,
    "op4_decontamination": op4_decontamination,
    "op5_pii": op5_pii,
    "op6_simhash": op6_simhash,
    "op7_mixing": op7_mixing,
    "op8_language": op8_language,
    "op9_token_output": op9_token_output,
    "op10_sharding": op10_sharding,
    "op11_fingerprints": op11_fingerprints,
    "op12_spelling": op12_spelling,
    "op13_codes": op13_codes,
}
