"""The queries of this subpackage, and their SQL where SQL can say the same.

``op1``, ``op4`` to ``op10``, ``op12`` and ``op13`` rest on hashes, archives, vocabularies or trained models that SQL
doesn't have; their tests hold them against brute force, exact round trips or held-out rows.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm import (
    alignment,
    chat_format,
    embedding_dedup,
    fingerprints,
    hard_negatives,
    licenses,
    minhash_dedup,
    mixing,
    packing,
    pii,
    quality,
    subword_sampling,
    warc,
)
from cardsentry.llm.common import read

PROBE_TEXT = "\\### Assistant: </turn> ok"


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.withColumns({c: F.round(c, 6) for c in ("weight", "probability")})


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    return chat_format.format_conversations(turns.unionByName(probe))[1]


def op6_subword_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_sampling.sample_segmentations(read(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(read(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, read(spark, sf_dir, "pages"))


def learned(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.QualityModel:
    """Fitted to the labels of the rows that are not held out."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).where(~held_out())
    return quality.fit(docs, labels)


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = quality.score(docs.select("doc_id", "text"), learned(spark, sf_dir, docs))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"))[0]


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_license_scan,
        op3_mixing,
        op4_minhash_near_dedup,
        op5_chat_format,
        op6_subword_sampling,
        op7_fingerprints,
        op8_pii,
        op9_warc,
        op10_quality,
        op11_hard_negatives,
        op12_alignment,
        op13_packing,
        pipeline,
    )
}
SQL: dict[str, str] = {
    "op2_license_scan": licenses.scan_sql(),
    "op3_mixing": mixing.mix_sql(),
    "op11_hard_negatives": hard_negatives.negatives_sql(),
}
