"""A training corpus from documents: each stage's result is a Parquet table that the next one reads.

Language ID drops what it rejects, near-duplicates keep one document of each group, contaminated documents go, personal data
becomes surrogates, and the last stage mixes the sources to their target weights, one row per copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import decontaminate, language_id, minhash, mixing, surrogates
from quern.llm.common import discard, fold, materialize, reads, table


def _as(docs: DataFrame, found: DataFrame, keep: str = "true", **changed: Column) -> DataFrame:
    """The rows of found that stay, with the columns of docs; it notes the tables that found reads."""
    return reads(found.filter(keep).withColumns(changed).select(*docs.columns), found)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.filter(fold("doc_id", language_id.FOLDS) != language_id.HELD_OUT))
    return _as(docs, language_id.identify(docs, model), "NOT rejected")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as(docs, minhash.drop_near_duplicates(docs, k=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as(docs, decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")), "NOT contaminated")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    n_chars = F.when(F.col("n_replaced") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _as(docs, surrogates.replace(docs), n_chars=n_chars)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = mixing.emit(mixing.mix(docs))
    return reads(out.select(*docs.columns, "copy", "copies", "size", "target"), out)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
]

#: Compression, MinHash and keyed surrogates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        written = materialize(out, f"pipeline-{name}")
        discard(out)  # the tables that the stage wrote for itself
        discard(docs)  # and the stage before
        docs = written
    return docs
