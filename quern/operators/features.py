"""The pairwise feature vector. The order of FEATURES is part of the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import similarity as S
from quern.functions.text import words_of

FEATURES = (
    "exact_name", "exact_sig_name", "name_jaccard", "sig_jaccard", "name_len_diff", "prefix4", "exact_addr", "addr_jaccard", "cand_addr_missing",
    "exact_nums", "num_jaccard", "addr_len_diff", "country_match", "is_s3", "candidate_rank", "total_candidates",
)
EXTRA = ("char_set_similarity", "name_length_ratio", "sig_overlap", "any_num_shared")

_PARTS = {"name": "business_name_clean", "sig": "name_significant_tokens", "addr": "business_address_clean", "nums": "address_numbers", "country": "country_clean"}


def _side(entities: DataFrame, key: str, p: str) -> DataFrame:
    """Token sets are made once for each entity and carried through the join."""
    words = {f"{p}{k}_set": F.array_distinct(words_of(F.col(_PARTS[k]))) for k in ("name", "sig", "addr", "nums")}
    return entities.select(F.col("entity_id").alias(key), *[F.col(c).alias(p + k) for k, c in _PARTS.items()], *[c.alias(n) for n, c in words.items()])


def pool_of(*sources: DataFrame) -> DataFrame:
    """The sources' entities, one for each id: the later source wins."""
    out = sources[0].withColumn("_at", F.lit(0))
    for i, s in enumerate(sources[1:], 1):
        out = out.unionByName(s.withColumn("_at", F.lit(i)))
    columns = [c for c in out.columns if c not in ("_at", "entity_id")]
    best = out.groupBy("entity_id").agg(F.max_by(F.struct(*columns), "_at").alias("x"))
    return best.select("entity_id", "x.*")


def joined(pairs: DataFrame, queries: DataFrame, pool: DataFrame) -> DataFrame:
    return pairs.join(_side(queries, "s1_id", "a_"), "s1_id").join(_side(pool, "cand_id", "b_"), "cand_id")


def expressions() -> dict[str, Column]:
    a, b = (lambda k, p=p: F.col(p + k) for p in ("a_", "b_"))
    return {
        "exact_name": S.same(a("name"), b("name")), "exact_sig_name": S.same(a("sig"), b("sig")), "name_jaccard": S.jaccard(a("name_set"), b("name_set")), "sig_jaccard": S.jaccard(a("sig_set"), b("sig_set")),
        "name_len_diff": S.length_diff(a("name"), b("name")), "prefix4": S.prefix4(a("name"), b("name")), "exact_addr": S.same(a("addr"), b("addr")), "addr_jaccard": S.jaccard(a("addr_set"), b("addr_set")),
        "cand_addr_missing": S.flag(b("addr") == ""), "exact_nums": S.same(a("nums"), b("nums")), "num_jaccard": S.jaccard(a("nums_set"), b("nums_set")), "addr_len_diff": S.length_diff(a("addr"), b("addr")),
        "country_match": S.flag(a("country") == b("country")), "is_s3": S.flag(F.col("cand_id").startswith("S3-")), "candidate_rank": F.col("candidate_rank").cast("double"), "total_candidates": F.col("total_candidates").cast("double"),
        "char_set_similarity": S.char_set(a("name"), b("name")), "name_length_ratio": S.length_ratio(a("name"), b("name")), "sig_overlap": S.overlap(a("sig_set"), b("sig_set")), "any_num_shared": S.any_shared(a("nums_set"), b("nums_set")),
        "edit_similarity": S.edit_similarity(a("name"), b("name")),
    }


def features(pairs: DataFrame, queries: DataFrame, pool: DataFrame, names: tuple[str, ...] = FEATURES, keep: tuple[str, ...] = ()) -> DataFrame:
    """pairs must hold candidate_rank and total_candidates; pairs with an unknown entity go, their rank stays taken."""
    e = expressions()
    return joined(pairs, queries, pool).select("s1_id", "cand_id", *keep, F.col("a_country").alias("country"), *[e[n].alias(n) for n in names])


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    marks = truth.select("s1_id", "cand_id").distinct().withColumn("_hit", F.lit(1))
    return pairs.join(marks, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("_hit", F.lit(0)).cast("int")).drop("_hit")


def sanity(vectors: DataFrame, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """One row: pairs, features, and how many values are NaN, infinite or null."""
    bad = lambda f: sum((F.count_if(f(F.col(n))) for n in names), F.lit(0))
    return vectors.agg(F.count(F.lit(1)).alias("n_pairs"), F.lit(len(names)).cast("long").alias("n_features"), bad(F.isnan).alias("n_nan"), bad(lambda c: F.abs(c) == float("inf")).alias("n_infinite"), bad(F.isnull).alias("n_null"))


def grouped_split(pairs: DataFrame, percent: int = 80) -> DataFrame:
    """All pairs of a query fall on one side."""
    return pairs.withColumn("is_train", F.pmod(F.regexp_extract("s1_id", r"(\d+)$", 1).cast("long"), F.lit(100)) < percent)
