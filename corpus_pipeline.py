"""From raw documents to token digests: the stages in order, each reading what its predecessor kept."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import bpe, cotrain, phrase_index, quotient, simhash
from skein.llm.queries import WORD_BPE, read
from skein.llm.rows import without
from skein.session import cut, new_folder, small_batches


def in_small_batches(stage):
    """Whole texts go through Python in every stage, so its session hands over few rows at once."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


@in_small_batches
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifiers hold for good and not toxic.

    Every row is judged by its own text and metadata, null, empty, repeated and very long ones too; a null id is judged but not
    learnt from. No rows give no rows; columns of any name go through as they are.
    """
    scored = cotrain.score(docs, read(spark, sf_dir, "labels"), rows=True)
    return scored.filter(~F.col("rejected")).select("row.*")


@in_small_batches
def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id.

    A null text equals an empty one; a null id stays only where its group has no other; of rows that repeat the id that stays, one does. No rows
    give no rows; columns of any name go through as they are.
    """
    return quotient.exact_groups(docs, rows=True).filter("kept").select("row.*")


@in_small_batches
def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints of three-word shingles at two or fewer differing bits, the row with the smallest doc_id.

    A null ``doc_id`` stays only where its group has no other; of rows that repeat the id that stays, one does. Texts without words
    (null, empty) are one group. No rows give no rows; columns of any name go through as they are.
    """
    return simhash.near_groups(docs, rows=True).filter("kept").select("row.*")


@in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a window of a benchmark item.

    The decision hangs on the text alone, so it is found and taken by the text's hash; ids may be null or repeat. A null or empty text
    has no words and stays. No rows give no rows; columns of any name go through as they are.
    """
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    found = phrase_index.contamination(docs.select(digest.alias("digest"), "text"), read(spark, sf_dir, "benchmark"), key="digest")
    dropped = cut(found.filter("contaminated").select("doc_id").distinct())
    return without(docs, dropped, digest)


@in_small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of what is left, a row per row; a null text is encoded as an empty one, other columns end here."""
    return bpe.round_trip_digests(docs, WORD_BPE)


STAGES = [
    ("quality", keep_good),
    ("exact dedup", keep_one_copy),
    ("near dedup", keep_one_near_copy),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# Classifier, components and encoding are beyond SQL; tests compare each stage with a brute-force one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is a table in the shared folder that the next one reads."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        folder = new_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
