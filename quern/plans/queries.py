"""The catalogue of queries: name -> (spark, sf_dir) -> DataFrame of plain columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators import audit, blocking, decide, features, keys, metrics, model, validate
from quern.operators.normalize import invariants, normalize
from quern.plans import fixtures
from quern.plans.linkage import Linkage
from quern.schema import ENTITY, POLICIES, PROFILES
from quern.sources import tsv
from quern.storage import shared_dir, ship
from quern.streaming import scoring

THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
GRID = (0.21, 0.31, 0.41, 0.52, 0.62)
CAP = PROFILES["fixture_evidence"].top_k
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(make: Callable[[Linkage], DataFrame], name: str = "", profile: str = "fixture_evidence") -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        out = make(Linkage(spark, sf_dir, PROFILES[profile]))
        return out.select(*[F.col(c).cast("long").alias(c) if t == "int" and c not in ("label", "bin") else F.col(c) for c, t in out.dtypes])

    QUERIES[name] = run


def _plain(pairs: DataFrame) -> DataFrame:
    return pairs.select("s1_id", "cand_id")


def _key_query(kind: str) -> None:
    def make(x: Linkage) -> DataFrame:
        return keys.keys(x.clean, (kind,), query=True).select("entity_id", "country", F.regexp_replace("key", "\u0001", "|").alias("key"))

    query(make, f"keys_{kind}")


# audits
query(lambda x: audit.row_counts(x.entities), "audit_row_counts")
query(lambda x: audit.missing(x.entities), "audit_missing")
query(lambda x: audit.ids(x.entities), "audit_ids")
query(lambda x: audit.duplicates(x.entities), "audit_duplicates")
query(lambda x: audit.country_counts(x.entities), "audit_country_dist")
query(lambda x: audit.lengths(x.entities), "audit_lengths")
query(lambda x: audit.quality_flags(x.entities), "audit_quality_flags")
query(lambda x: audit.truth_histogram(x.truth_lists), "audit_gt_histogram")
query(lambda x: audit.referential(x.truth, x.raw(1), x.raw(2).union(x.raw(3))), "audit_ref_integrity")
query(lambda x: audit.first_rows(x.entities, 10).select("source", "nth", "entity_id", "business_name"), "sample_per_source")
# cleaning
query(lambda x: x.clean.select("entity_id", "business_name_clean", "name_tokens", "name_significant_tokens"), "norm_name")
query(lambda x: x.clean.select("entity_id", "business_address_clean", "address_numbers", "address_tokens"), "norm_addr")
query(lambda x: x.clean.select("entity_id", "country", "country_clean"), "norm_country")
query(lambda x: x.clean.select("entity_id", F.posexplode(X.words_of(F.col("name_tokens"))).alias("at", "token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("entity_id").alias("n_entities")), "norm_tokens_exploded")
query(lambda x: invariants(x.entities.drop("source"), x.clean), "norm_invariants")
query(lambda x: normalize(x.entities.drop("source").withColumn("business_name", F.concat(F.lit("Ｆｕｌｌ ① "), "business_name"))).select("entity_id", "business_name_clean"), "norm_nfkc")
# keys
for _kind in ("name", "addr", "num", "prefix", "exact", "pair", "name_num", "addr_num"):
    _key_query(_kind)
query(lambda x: keys.keys(x.clean, ("name", "pair", "name_num", "addr_num"), arrays=keys.archived_arrays()).withColumn("key", F.regexp_replace("key", "\u0001", "|")), "keys_archived")
query(lambda x: keys.posting_stats(keys.keys(x.pool, ("name", "addr", "num", "prefix"))), "posting_stats")
query(lambda x: keys.capped(keys.keys(x.pool, ("name", "addr", "num", "prefix")).distinct(), x.profile).groupBy("kind", "country").agg(F.count(F.lit(1)).alias("n_postings"), F.countDistinct("key").alias("n_keys")), "posting_capped")
# candidates
query(lambda x: _plain(blocking.union_candidates(x.s1, x.pool, x.profile)), "cand_v1_union", "fixture_union")
query(lambda x: x.scored, "cand_evidence_scores")
query(lambda x: x.ranked.select("s1_id", "cand_id", "score", "evidence_rank"), "cand_evidence_topk")
query(lambda x: x.scored, "cand_v2_scores", "fixture_composite")
query(lambda x: x.ranked.select("s1_id", "cand_id", "score", "evidence_rank"), "cand_v2_topk", "fixture_composite")
query(lambda x: blocking.scored(x.s1, x.pool, x.profile), "cand_evidence_full_caps", "evidence")
# the same at the sizes of real runs
_RANKED = ("s1_id", "cand_id", "score", "evidence_rank")
query(lambda x: blocking.ranked(x.s1, x.pool, x.profile, allow_empty_country=False).select(*_RANKED), "cand_union_full", "union")
for _name, _profile in {"cand_balanced_350": "balanced", "cand_evidence_350": "evidence", "cand_emergency_350": "emergency", "cand_composite_500": "composite"}.items():
    query(lambda x: x.ranked.select(*_RANKED), _name, _profile)
query(lambda x: blocking.with_ranks(x.candidates).select("s1_id", "cand_id", F.col("candidate_rank").cast("long").alias("candidate_rank"), "total_candidates"), "cand_id_rank")
query(lambda x: _plain(blocking.top_k(x.candidates.drop("evidence_rank"), 4, "id")), "cand_static_cap")
query(lambda x: _plain(blocking.top_k(x.candidates.drop("evidence_rank"), 4, "hash")), "cand_unranked_cap")
query(lambda x: metrics.distribution(x.candidates, x.s1, CAP, (2, 5, 8)), "cand_distribution")
query(lambda x: blocking.as_lists(x.candidates, x.s1, "candidate_entity_ids"), "cand_list_render")
query(lambda x: blocking.cross_country(x.candidates, x.s1, x.pool), "cand_cross_country")


def _growth(x: Linkage) -> DataFrame:
    small = blocking.top_k(x.candidates.drop("evidence_rank"), 5)
    return metrics.growth(metrics.distribution(small, x.s1), metrics.distribution(x.candidates, x.s1))


query(_growth, "cand_growth")
# features and decisions
query(lambda x: x.vectors.select("s1_id", "cand_id", *features.FEATURES), "feat16")
query(lambda x: x.vectors.select("s1_id", "cand_id", *features.EXTRA), "feat20")
query(lambda x: features.features(blocking.with_ranks(x.candidates), x.s1, x.pool, ("edit_similarity",)).select("s1_id", "cand_id", "edit_similarity"), "feat_edit")
query(lambda x: features.sanity(x.vectors), "feat_sanity")
query(lambda x: x.vectors.select("s1_id", "cand_id", "label"), "labels")
query(lambda x: features.grouped_split(_plain(x.vectors)), "grouped_split")
query(lambda x: x.vectors.select("s1_id", "cand_id", "p"), "score_linear")
query(lambda x: decide.model_rank(x.vectors).select("s1_id", "cand_id", "model_rank"), "rank_model")
for _policy in POLICIES:
    query(lambda x, p=_policy: _plain(x.matches(p)), f"decide_{_policy}")
query(lambda x: blocking.as_lists(x.matches(), x.s1, "matched_entity_ids", "model_rank"), "matches_complete")
query(lambda x: decide.prediction_counts(x.matches(), x.s1), "pred_counts_by_country")
# evaluation
query(lambda x: metrics.pair_recall(x.truth, x.candidates), "eval_pair_recall")
query(lambda x: metrics.recall_by_country(x.truth, x.candidates, x.s1), "eval_recall_by_country")
query(lambda x: metrics.micro(x.truth, x.matches()), "eval_micro_f05")
query(lambda x: metrics.macro(x.truth, x.matches(), x.s1), "eval_macro_f05")
query(lambda x: metrics.per_entity(x.truth, x.matches(), x.s1), "eval_entity_f05")
query(lambda x: metrics.rank_metrics(decide.model_rank(x.vectors), x.truth, x.s1), "eval_rank_metrics")
query(lambda x: metrics.rank_buckets(decide.model_rank(x.vectors), x.truth), "eval_rank_buckets")
query(lambda x: metrics.error_ceiling(x.truth, x.candidates, x.matches()), "eval_error_ceiling")
query(lambda x: metrics.misses_simple(x.truth, x.candidates, CAP), "eval_miss_simple")
query(lambda x: metrics.miss_reasons(x.truth, x.candidates, CAP), "eval_miss_reason")
query(lambda x: metrics.misses_detailed(x.truth, x.candidates, x.s1, x.pool, CAP), "eval_miss_detailed")
query(lambda x: metrics.confusion(x.vectors), "eval_confusion")
query(lambda x: metrics.curve_areas(x.vectors), "auc")
query(lambda x: metrics.calibration(x.vectors), "eval_calibration")
query(lambda x: metrics.threshold_sweep(x.vectors, x.truth, THRESHOLDS), "eval_threshold_sweep")
query(lambda x: metrics.threshold_grid(x.vectors, x.truth, ("US", "India"), GRID), "eval_threshold_grid")
query(lambda x: metrics.best(metrics.threshold_grid(x.vectors, x.truth, ("US", "India"), GRID), "t_us", "t_india", "t_other"), "eval_threshold_best")


def _deltas(x: Linkage) -> DataFrame:
    runs = [metrics.micro(x.truth, x.matches(p)).select(F.lit(p).alias("experiment"), "f05", "recall") for p in POLICIES]
    return metrics.deltas(runs[0].union(runs[1]).union(runs[2]).union(runs[3]), "global")


query(_deltas, "exp_deltas")


# validation, over the broken file of the fixtures
def _lines(x: Linkage) -> DataFrame:
    return fixtures.list_lines(x.spark, x.sf_dir)


def _lists(x: Linkage) -> DataFrame:
    return tsv.id_lines(_lines(x))


query(lambda x: validate.malformed(_lines(x)), "val_malformed")
query(lambda x: validate.duplicate_rows(_lists(x)), "val_dup_rows")
query(lambda x: validate.duplicate_ids(_lists(x)), "val_dup_ids")
query(lambda x: validate.self_matches(_lists(x)), "val_self")
query(lambda x: validate.wrong_prefix(_lists(x)), "val_prefix")
query(lambda x: validate.unknown_ids(_lists(x), x.raw(2).union(x.raw(3))), "val_unknown")
query(lambda x: validate.required(_lists(x), x.raw(1)), "val_required")
query(lambda x: validate.summary(_lists(x)), "val_summary")
query(lambda x: validate.report(_lines(x), x.raw(1), x.raw(2).union(x.raw(3))).select("rule", "n"), "val_report")


def _subset(x: Linkage) -> DataFrame:
    names = lambda df: df.select(F.col("source1_entity_id").alias("s1_id"), F.col(df.columns[1]).alias("ids"))
    return validate.not_in_candidates(names(x.truth_lists), names(blocking.as_lists(x.candidates, x.s1, "candidate_entity_ids")))


query(_subset, "val_subset")
query(lambda x: validate.candidate_audit(blocking.as_lists(x.candidates, x.s1, "ids").withColumnRenamed("source1_entity_id", "s1_id"), x.s1), "val_candidate_audit")


# sources, sinks and streams, through files in the shared folder
def _folder(x: Linkage) -> str:
    return f"{shared_dir(x.spark).rstrip('/')}/quern-io-{uuid.uuid4().hex}"


def _written_tsv(x: Linkage) -> str:
    at = _folder(x)
    for n in (1, 2, 3):
        tsv.write_tsv(x.raw(n), f"{at}/S{n}")
    return at


def _tsv(x: Linkage) -> DataFrame:
    at = _written_tsv(x)
    return audit.with_source(*[tsv.read_tsv(x.spark, f"{at}/S{n}") for n in (1, 2, 3)]).select("source", *ENTITY.fieldNames())


def _ids(x: Linkage) -> DataFrame:
    at = _written_tsv(x)
    return tsv.read_ids(x.spark, f"{at}/S1").union(tsv.read_ids(x.spark, f"{at}/S2")).union(tsv.read_ids(x.spark, f"{at}/S3"))


def _known(x: Linkage) -> DataFrame:
    at = _written_tsv(x)
    return tsv.read_only_known(tsv.read_tsv(x.spark, f"{at}/S2", columns=("entity_id", "business_name")), x.truth.select(F.col("cand_id").alias("entity_id")))


def _id_lists(x: Linkage) -> DataFrame:
    at = _folder(x)
    tsv.write_id_lists(x.truth_lists, at)
    return tsv.read_id_lists(x.spark, at)


def _resumed(x: Linkage) -> DataFrame:
    """Written in two runs, of which the first has a part of the queries."""
    at, queries = _folder(x), x.raw(1).select("entity_id")
    lists = x.truth_lists
    make = lambda todo: lists.join(todo.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi").select(*lists.columns)
    tsv.append_remaining(queries.filter(F.col("entity_id").endswith("3")), at, make)
    tsv.append_remaining(queries, at, make)
    return tsv.read_id_lists(x.spark, at)


def _status(x: Linkage) -> DataFrame:
    at = _written_tsv(x)
    found = tsv.file_status(x.spark, [f"{at}/S{n}" for n in (1, 2, 3, 4)])
    return found.select(F.element_at(F.split("path", "/"), -1).alias("source"), "found", "parsable")


def _streamed(x: Linkage) -> DataFrame:
    """The queries arrive as files and are ranked batch by batch."""
    at, pool = _written_tsv(x), x.pool
    make = lambda batch: blocking.ranked(normalize(batch), pool, x.profile, x.profile.top_k)
    scoring.score_files(x.spark, f"{at}/S1", f"{at}/out", f"{at}/checkpoint", make, files_per_batch=2)
    return x.spark.read.parquet(f"{at}/out").select("s1_id", "cand_id", "score", "evidence_rank")


for _name, _make in {"io_tsv": _tsv, "io_ids": _ids, "io_known": _known, "io_id_lists": _id_lists, "io_resume": _resumed, "io_status": _status, "stream_scoring": _streamed}.items():
    query(_make, _name)


# beyond SQL
def _gbt(x: Linkage, names: tuple[str, ...] = features.FEATURES, **how) -> DataFrame:
    split = features.grouped_split(x.vectors)
    fitted = model.train(split.filter("is_train").drop("p"), names, **how)
    scored = model.score(fitted, split.filter("NOT is_train").drop("p")).select("p", "label")
    return metrics.confusion(scored).crossJoin(metrics.curve_areas(scored))  # one row each


def _challenger(x: Linkage) -> DataFrame:
    """16 against 20 features on the same split, with smaller models than model_gbt's."""
    runs = [_gbt(x, names, rounds=20, depth=5).withColumn("n_features", F.lit(len(names)).cast("long")) for names in (features.FEATURES, (*features.FEATURES, *features.EXTRA))]
    return runs[0].union(runs[1])


query(_gbt, "model_gbt")
query(_challenger, "model_challenger")


def _sha(x: Linkage) -> DataFrame:
    return tsv.files(x.spark, f"{x.sf_dir}/benchmark.parquet")


query(_sha, "integrity_sha256")
query(lambda x: x.s1.orderBy(F.xxhash64("entity_id"), "entity_id").limit(100).select("entity_id"), "sample_hash")
