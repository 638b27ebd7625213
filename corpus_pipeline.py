"""A corpus pipeline: documents in, sampled segmentations out.

Each stage reads what the one before it wrote. All but the last return the columns of ``documents``.
"""

import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsentry.llm import catalog, minhash_dedup, mixing, pii, quality, subword_sampling
from cardsentry.llm.common import read, written

KEPT_TOKENS = 0.8


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Null, empty and blank texts get the score of no evidence, as any text by itself does: repeated rows stay or go together,
    long texts are read whole, rows without a doc_id are scored too. Columns of any name are returned as they were. An
    empty table gives an empty one.
    """
    docs = _bounded(spark, docs, sf_dir)
    names = _free(docs, "quality_score"), _free(docs, "quality_kept")
    scored = quality.score(docs, catalog.learned(spark, sf_dir, docs), names=names)
    return scored.where(F.col(names[1]) == 1).select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id.

    Null, empty and blank texts have no shingles and stay. Of rows with equal ids one stays, whatever their other columns
    hold; rows without a doc_id stay. Columns of any name are returned as they were. An empty table gives an empty one.
    """
    return minhash_dedup.drop_near_duplicates(_bounded(spark, docs, sf_dir))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars counted anew.

    Null texts stay null with null n_chars, empty ones empty. Every row stays, also repeated ones and those without a
    doc_id; long texts are read whole. Other columns are returned as they were. An empty table gives an empty one.
    """
    docs = _bounded(spark, docs, sf_dir)
    clean = pii.redact(docs, pii.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn such that sources, languages and topics have their target shares of the tokens.

    A null source, language or text is a value of its own; a text without tokens weighs nothing. Rows with equal ids are
    drawn alike. Columns of any name are returned as they were. An empty table gives an empty one.
    """
    docs = _bounded(spark, docs, sf_dir)
    return mixing.sample(docs, kept=KEPT_TOKENS)


def subword_segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document, and the text that their ids decode to.

    Null and empty texts give one sample without ids; repeated rows are sampled alike. Columns other than doc_id and text
    are left out. An empty table gives an empty one.
    """
    return subword_sampling.sample_segmentations(_bounded(spark, docs, sf_dir), decoded=True)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    return next(n for n in (name + "_" * i for i in range(len(taken) + 1)) if n not in taken)


def _bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Set the sizes of batches for Python, and let go of what the stage before has left on the driver."""
    read(spark, sf_dir, "documents")
    gc.collect()
    pa.default_memory_pool().release_unused()
    return docs


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("PII", personal_data),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", subword_segmentations),
]

ORACLE_SQL = None  # trained models and hashes; tests/llm/test_pipeline.py has a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
