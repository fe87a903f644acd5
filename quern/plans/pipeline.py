"""Whole runs over files: clean, block, score, decide, write, evaluate. Used by the command line and by experiments."""

from __future__ import annotations

import json
from dataclasses import asdict, replace
from functools import reduce
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from quern.operators import blocking, decide, features, metrics, model
from quern.operators.normalize import normalize
from quern.schema import POLICIES, PROFILES, Blocking, Policy
from quern.sources import tsv
from quern.storage import materialize


def cleaned(spark: SparkSession, *paths: str) -> DataFrame:
    """Entity files, cleaned; of entities with one id the later file's wins."""
    tables = [normalize(tsv.read_tsv(spark, p)) for p in paths]
    return tables[0] if len(tables) == 1 else features.pool_of(*tables)


def truth_pairs(spark: SparkSession, path: str) -> DataFrame:
    return tsv.pairs_of(tsv.read_id_lists(spark, path))


def candidates(queries: DataFrame, pool: DataFrame, profile: Blocking, rank_mode: str = "evidence") -> DataFrame:
    """Ranked candidates with pool sizes; rank_mode: what the feature candidate_rank tells."""
    return blocking.with_ranks(blocking.ranked(queries, pool, profile, profile.top_k), rank_mode)


def vectors(ranked: DataFrame, queries: DataFrame, pool: DataFrame, extra: bool = False) -> DataFrame:
    return features.features(ranked, queries, pool, features.FEATURES + (features.EXTRA if extra else ()))


def train(labelled: DataFrame, extra: bool = False) -> PipelineModel:
    return model.train(labelled, features.FEATURES + (features.EXTRA if extra else ()))


def probabilities(pairs: DataFrame, fitted: PipelineModel | None) -> DataFrame:
    """p from the model, or the deterministic linear score without one."""
    return pairs.withColumn("p", decide.linear_score()) if fitted is None else model.score(fitted, pairs)


def match(spark: SparkSession, s1: str, pool: list[str], out: str, profile: str = "evidence", policy: str = "country", fitted: PipelineModel | None = None) -> int:
    """Writes one line of matches for every query that the output lacks; returns how many queries that were."""
    targets = materialize(cleaned(spark, *pool), "pool")

    def make(todo: DataFrame) -> DataFrame:
        ranked = candidates(todo, targets, PROFILES[profile])
        chosen = decide.decide(probabilities(vectors(ranked, todo, targets), fitted), POLICIES[policy])
        return blocking.as_lists(chosen, todo, "matched_entity_ids", "model_rank")

    return tsv.append_remaining(materialize(cleaned(spark, s1), "queries"), out, make)


def evaluate(queries: DataFrame, pool: DataFrame, truth: DataFrame, profile: Blocking, policy: Policy, fitted: PipelineModel | None = None) -> dict[str, float]:
    """Candidate recall, pooled precision, recall and F0.5, per-entity F0.5, Recall@k and MRR, as one flat record."""
    ranked = materialize(candidates(queries, pool, profile), "candidates")
    scored = materialize(probabilities(vectors(ranked, queries, pool), fitted), "scored")
    matches = materialize(decide.decide(scored, policy), "matches")
    tables = [metrics.pair_recall(truth, ranked), metrics.micro(truth, matches), metrics.macro(truth, matches, queries), metrics.rank_metrics(decide.model_rank(scored), truth, queries)]
    return reduce(lambda a, b: b | a, (t.first().asDict() for t in tables))


def experiment(spark: SparkSession, folder: str, name: str, hypothesis: str, config: dict, queries: DataFrame, pool: DataFrame, truth: DataFrame, baseline: dict[str, float] | None = None) -> dict:
    """Runs a configuration once: if its record is there already, that is returned.

    config: candidate_strategy (a profile), candidate_cap, posting_cap, threshold_us, threshold_india, threshold_other, fallback_thresh.
    """
    at = Path(folder, name, "config.json")  # a report on the driver's side, like a log
    if at.exists():
        return json.loads(at.read_text())
    profile = PROFILES[config.get("candidate_strategy", "evidence")]
    if cap := config.get("posting_cap"):
        profile = replace(profile, caps={k: v if k == "name" else min(v, cap) for k, v in profile.caps.items()})
    profile = replace(profile, top_k=config.get("candidate_cap", profile.top_k))
    policy = Policy(config["threshold_other"], {"US": config["threshold_us"], "India": config["threshold_india"]}, config.get("fallback_thresh"))
    found = evaluate(queries, pool, truth, profile, policy)
    record = {"experiment": name, "hypothesis": hypothesis, "config": config, "policy": asdict(policy), "metrics": found}
    if baseline:
        record |= {"deltas": {k: found[k] - baseline[k] for k in ("f05", "recall", "precision")}, "retained": found["f05"] > baseline["f05"]}
    at.parent.mkdir(parents=True, exist_ok=True)
    at.write_text(json.dumps(record, indent=1))
    return record
