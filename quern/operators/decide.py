"""From scored pairs to matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.schema import Policy


def linear_score() -> Column:
    """A deterministic stand-in for the probability of a match."""
    return 0.35 * F.col("sig_jaccard") + 0.2 * F.col("name_jaccard") + 0.2 * F.col("addr_jaccard") + 0.15 * F.col("num_jaccard") + 0.1 * F.col("prefix4")


def model_rank(scored: DataFrame) -> DataFrame:
    """Rank by p; ties keep the candidates' order."""
    return scored.withColumn("model_rank", F.row_number().over(W.partitionBy("s1_id").orderBy(F.desc("p"), F.asc("candidate_rank"))))


def decide(scored: DataFrame, policy: Policy, default_country: str = "US") -> DataFrame:
    """(s1_id, cand_id, country, p, candidate_rank[, exact_name]) -> the matched pairs, with model_rank."""
    country = F.coalesce("country", F.lit(default_country))
    t = F.lit(policy.default)
    for name, value in policy.by_country.items():
        t = F.when(country == name, value).otherwise(t)
    passes = F.col("p") >= t
    if policy.exact_name_from is not None:
        passes = passes | ((F.col("exact_name") == 1.0) & (F.col("p") >= policy.exact_name_from))
    ranked = model_rank(scored.withColumn("_ok", passes)).withColumn("_any", F.max("_ok").over(W.partitionBy("s1_id")))
    chosen = F.col("_ok")
    if policy.fallback is not None:
        where = F.lit(True) if policy.fallback_everywhere else ~country.isin(*policy.by_country)
        chosen = chosen | (~F.col("_any") & (F.col("model_rank") == 1) & (F.col("p") >= policy.fallback) & where)
    return ranked.filter(chosen).drop("_ok", "_any")


def prediction_counts(matches: DataFrame, queries: DataFrame) -> DataFrame:
    """By country: queries with and without a match."""
    has = matches.select(F.col("s1_id").alias("entity_id")).distinct().withColumn("_has", F.lit(1))
    both = queries.join(has, "entity_id", "left")
    return both.groupBy(F.col("country_clean").alias("country")).agg(F.count(F.lit(1)).alias("n_queries"), F.count("_has").alias("n_matched"), (F.count(F.lit(1)) - F.count("_has")).alias("n_empty"))
