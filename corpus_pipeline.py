"""Corpus pipeline: documents that are neither toxic nor poor, each once, mixed to target weights and packed.

``STAGES`` lists (name, function) in order; a function takes (spark, docs,
sf_dir) and returns a DataFrame.  ``run`` writes each stage's rows as Parquet in
the shared folder and reads them back as the next one's docs, so a lost executor
costs at most the stage it was lost in.  All stages but the last return the
columns of their input; the last returns the packed pieces.

Every stage takes null ids, texts and sources, empty and very long texts, repeated
rows and an empty table, and keeps the columns of ``documents``, extra ones too,
whatever their names; each function says what becomes of such rows.

SQL can't express the stages (learned models, fingerprints, pseudorandom
permutations, a linear programme): the tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import common, mixing, packing, quality, simhash, toxicity
from tidepool.llm.encoding import public_tokenizer
from tidepool.shipping import ship
from tidepool.sources.tables import load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; a null or empty text has nothing toxic and stays, repeated rows share their fate."""
    ship(spark)
    scored, score = toxicity.scored(docs, load(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return scored.where(F.col(score) < toxicity.PREDICTED).drop(score)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest; a null or empty text has too few words and goes, repeated rows share their fate."""
    ship(spark)
    judged, verdict = quality.judged(docs, load(spark, sf_dir, "labels", ["doc_id", "quality"]))
    return judged.where(F.col(verdict)["kept"]).drop(verdict)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash component (3-word shingles, at most 3 bits): the smallest id, null last; of repeated rows one."""
    ship(spark)
    return simhash.deduplicated(docs, shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix: a row per document and pass, cut to the words taken; null is a source of its own, a text of no words is not taken."""
    ship(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts in sequences of at most 2048 tokens; an empty text is one piece, of the end token."""
    ship(spark)
    return packing.pack_documents(docs, public_tokenizer(), end_id=0, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
