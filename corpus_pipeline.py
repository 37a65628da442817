"""A corpus through five stages, each written as Parquet and read again before the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import chosen_path, pieces, pseudonyms, quality, templates
from quayside.llm.common import shared_dir, table
from quayside.llm.queries import pii_key, piece_model

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, trusted).filter("kept").select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones: the one with the smallest id. Of rows that are equal
    in id and text one stays."""
    first = chosen_path.similar_documents(docs).filter("first_of_class").select(*DOCUMENT_COLUMNS)
    return first.dropDuplicates(["doc_id", "text"])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    judged = templates.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.filter(~F.col("contaminated")).select(*DOCUMENT_COLUMNS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data in their texts. n_chars follows the text."""
    done = pseudonyms.pseudonymise(docs, pii_key(spark))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their ids, and the text that the ids decode to."""
    encoded = pieces.encode_pieces(docs, piece_model(), check=True)
    return encoded.select(*DOCUMENT_COLUMNS, "ids", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", pii),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: Hashes of several stages have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = shared_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
