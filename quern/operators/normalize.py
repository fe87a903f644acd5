"""Cleaning of entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.schema import CLEAN_COLUMNS


def normalize(entities: DataFrame, unicode: bool = True) -> DataFrame:
    """The four columns of an entity with seven cleaned ones, in the order of CLEAN_COLUMNS."""
    raw = entities.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in CLEAN_COLUMNS[:4]])
    worked = raw.withColumns({"_n": X.name_words(F.col("business_name"), unicode), "_a": X.address_words(F.col("business_address"), unicode), "_d": X.digit_runs(F.col("business_address"), unicode)})
    name, address = F.array_join("_n", " "), F.array_join("_a", " ")
    return worked.select(
        *CLEAN_COLUMNS[:4], name.alias("business_name_clean"), address.alias("business_address_clean"), X.clean_country(F.col("country")).alias("country_clean"),
        F.array_join("_d", " ").alias("address_numbers"), name.alias("name_tokens"), F.array_join(X.significant(F.col("_n")), " ").alias("name_significant_tokens"), address.alias("address_tokens"),
    )


def invariants(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: what cleaning must preserve. Rows of a table have no order, so ids are compared with their counts."""
    counts = lambda df, n: df.groupBy("entity_id").agg(F.count(F.lit(1)).alias(n))
    other = counts(raw, "a").join(counts(clean, "b"), "entity_id", "full").agg(F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("ids_with_other_counts"))
    missing = len(set(CLEAN_COLUMNS) - set(clean.columns)) + (tuple(clean.columns[:4]) != CLEAN_COLUMNS[:4])
    gone = raw.join(clean, "entity_id", "left_anti").agg(F.count(F.lit(1)).alias("lost_ids"))
    new = clean.join(raw, "entity_id", "left_anti").agg(F.count(F.lit(1)).alias("new_ids"))
    before = raw.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(X.blank(F.col("business_address"))).alias("no_address_before"))
    after = clean.agg(F.count(F.lit(1)).alias("rows_after"), F.count_if(F.col("business_address_clean") == "").alias("empty_clean_address"), F.count_if(X.blank(F.col("business_address"))).alias("no_address_after"))
    one_row = before.crossJoin(after).crossJoin(gone).crossJoin(new).crossJoin(other)  # five tables of one row
    return one_row.withColumn("missing_columns", F.lit(missing).cast("long"))
