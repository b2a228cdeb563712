"""From raw documents to training tokens: toxic documents go, boilerplate lines
go, one document of each near-duplicate group stays, sources are mixed to their
target weights, and the mix is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import line_dedup, mixing, sentencepiece, shared, simhash, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.reject(docs, labels)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat over a source's documents go; no document goes."""
    cleaned = line_dedup.drop_boilerplate(docs)
    return _with_length(cleaned)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix, in place of its text."""
    return sentencepiece.encode(docs)


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows the text, where the table has that column."""
    from pyspark.sql import functions as F
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

#: The classifier and the fingerprints have no SQL form; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    root = shared.shared_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path := f"{root}/{i}-{name}")
        docs = spark.read.parquet(path)
    return docs
