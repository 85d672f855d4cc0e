"""Corpus pipeline: rules, near-duplicates, benchmark leaks, PII, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm._shared import discard, free_names, materialise, own, own_columns, scratch_scope
from textloom.llm.decontam import contamination
from textloom.llm.minhash import deduplicate
from textloom.llm.pii import pseudonymise
from textloom.llm.poisson_mix import mix
from textloom.llm.quality_rules import quality
from textloom.llm.queries import surrogate_key


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    (verdict,) = free_names(docs, "verdict")
    return quality(docs, into=verdict).where(own(verdict)["kept"]).select(*own_columns(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    (leak,) = free_names(docs, "leak")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, benchmark, into=leak).where(own(leak)["n_hit"] == 0).select(*own_columns(docs))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; n_chars follows the new text."""
    (found,) = free_names(docs, "found")
    new = pseudonymise(docs, surrogate_key(spark), into=found)
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return new.select(*own_columns(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at square-root weights, as many rows expected as came in."""
    return mix(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

#: Shingle components and surrogates have no SQL; tests/llm compare the rows
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``. Once a stage's rows are written, what it
    read and what else it wrote in the shared folder is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark) as keep:
            new = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
            keep.add(new._scratch)
        discard(docs)
        docs = new
    return STAGES[-1][1](spark, docs, sf_dir)
