"""The registered queries: each operator over its whole table, with production
parameters.  ORACLES holds the DuckDB form where SQL can express the result."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chunk_dedup, hard_negatives, html_text, langid, line_dedup, lm, mixing, runs, sentencepiece, simhash, topk, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fold(col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % 5


def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, probability per category, toxic (the pipeline's decision)."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    chain = toxicity.fit(docs, labels)
    scored = toxicity.classify(docs.select("doc_id", "text"), chain, keep_text=False)
    return scored.select("doc_id", F.col("p_quality").alias("p_quality"), F.col("p_toxic").alias("p_toxic"),
                         (F.col("p_toxic") >= toxicity.THRESHOLD).alias("toxic"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, token_ids, n_tokens, n_differ, roundtrip."""
    return sentencepiece.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = lm.fit(docs.filter(_fold() != 1))
    return lm.score(docs.select("doc_id", (_fold() == 1).alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score", "score")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    prototypes = langid.learn(docs.filter(_fold() != 0).select("text", "lang"))
    return langid.predict(docs.select("doc_id", (_fold() == 0).alias("held_out"), "text"), prototypes)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sizes(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, counts=True).select("doc_id", "text", "lines_total", "lines_dropped")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def _planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's words: in a tenth of the documents a stretch repeats up
    to the end.  A row without an id keeps its words."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return (words[:a] + words[a:a + period] * (-(-(n - a) // period)))[:n]


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"), prepare=_planted)
    # the longest run; of equal ones the first start, then the smallest period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity_chain, op2_sentencepiece, op3_bit_sliced_top_k, op4_kneser_ney, op5_simhash_near_dedup,
    op6_language_id, op7_source_mix, op8_main_text, op9_line_dedup, op10_nearest, op11_hard_negatives,
    op12_chunk_recipes, op13_word_runs)}

ORACLES: dict[str, str] = {
    "op3_bit_sliced_top_k": topk.ORACLE,
    "op7_source_mix": mixing.ORACLE,
    "op9_line_dedup": line_dedup.ORACLE.format(docs="documents", columns="doc_id", ratio=line_dedup.RATIO,
                                               min_pages=line_dedup.MIN_PAGES),
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_chunk_recipes": chunk_dedup.ORACLE,
}
