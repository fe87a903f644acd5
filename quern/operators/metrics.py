"""Quality of candidates and of matches. Pairs are (s1_id, cand_id)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import words_of
from quern.storage import materialize

KEY = ["s1_id", "cand_id"]


def _marked(truth: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    return truth.select(*KEY).distinct().join(pairs.select(*KEY).distinct().withColumn(name, F.lit(1)), KEY, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("long"))


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def fbeta(p: Column, r: Column, beta2: float = 0.25) -> Column:
    return F.when(p + r > 0, (1 + beta2) * p * r / (beta2 * p + r)).otherwise(0.0)


def pair_recall(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pair recall, and the share of queries all of whose matches were found."""
    per = _marked(truth, candidates, "hit").groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("hits"))
    out = per.agg(F.sum("n").alias("n_pairs"), F.sum("hits").alias("n_found"), F.count(F.lit(1)).alias("n_queries"), F.count_if(F.col("n") == F.col("hits")).alias("n_complete"))
    return out.withColumns({"pair_recall": 100 * F.col("n_found") / F.col("n_pairs"), "query_coverage": 100 * F.col("n_complete") / F.col("n_queries")})


def recall_by_country(truth: DataFrame, candidates: DataFrame, queries: DataFrame) -> DataFrame:
    country = queries.select(F.col("entity_id").alias("s1_id"), F.col("country_clean").alias("country"))
    found = _marked(truth, candidates, "hit").join(country, "s1_id", "left").withColumn("country", F.coalesce("country", F.lit("US")))
    return found.groupBy("country").agg(F.count(F.lit(1)).alias("n_pairs"), F.sum("hit").alias("n_found")).withColumn("pair_recall", 100 * F.col("n_found") / F.col("n_pairs"))


def distribution(candidates: DataFrame, queries: DataFrame, cap: int = 500, over: tuple[int, ...] = (100, 250, 500, 1000)) -> DataFrame:
    """Candidates per query, from all queries."""
    counts = candidates.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"))
    per = queries.select(F.col("entity_id").alias("s1_id")).join(counts, "s1_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    q = lambda p: F.percentile("n", F.lit(p))
    total = F.count(F.lit(1))
    return per.agg(
        total.alias("n_queries"), F.sum("n").alias("total"), F.avg("n").alias("mean"), q(0.5).alias("median"), q(0.9).alias("p90"), q(0.95).alias("p95"), q(0.99).alias("p99"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.count_if(F.col("n") == 0).alias("n_zero"), (100 * F.count_if(F.col("n") == cap) / total).alias("pct_at_cap"), *[F.count_if(F.col("n") > x).alias(f"gt_{x}") for x in over],
        *[F.round(100 * F.count_if(F.col("n") > x) / total, 2).alias(f"pct_gt_{x}") for x in over],
    )


def micro(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """Pooled precision, recall and F0.5."""
    t, p = truth.select(*KEY).distinct().withColumn("t", F.lit(1)), predicted.select(*KEY).distinct().withColumn("p", F.lit(1))
    both = t.join(p, KEY, "full").agg(F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count_if(F.col("t").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    pr = both.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return pr.withColumn("f05", fbeta(F.col("precision"), F.col("recall")))


def per_entity(truth: DataFrame, predicted: DataFrame, queries: DataFrame) -> DataFrame:
    """F0.5 of every query: 1 if nothing is true and nothing predicted, 0 if only one of them is nothing."""
    t, p = truth.select(*KEY).distinct().withColumn("t", F.lit(1)), predicted.select(*KEY).distinct().withColumn("p", F.lit(1))
    counts = t.join(p, KEY, "full").groupBy("s1_id").agg(F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count("t").alias("nt"), F.count("p").alias("np"))
    all_ = queries.select(F.col("entity_id").alias("s1_id")).distinct().join(counts, "s1_id", "left").na.fill(0, ["tp", "nt", "np"])
    score = F.when((F.col("nt") == 0) & (F.col("np") == 0), 1.0).otherwise(fbeta(ratio(F.col("tp"), F.col("np")), ratio(F.col("tp"), F.col("nt"))))
    return all_.withColumn("f05", score)


def macro(truth: DataFrame, predicted: DataFrame, queries: DataFrame) -> DataFrame:
    per = per_entity(truth, predicted, queries)
    return per.agg(F.count(F.lit(1)).alias("n_queries"), F.count_if(F.col("f05") == 1.0).alias("n_perfect"), F.count_if(F.col("f05") == 0.0).alias("n_zero"), F.round(F.avg("f05"), 9).alias("macro_f05"))


def rank_metrics(ranked: DataFrame, truth: DataFrame, queries: DataFrame, ks: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """Share of queries with a true match among the first k, and the mean reciprocal rank, over all queries and over those with a true candidate."""
    first = ranked.join(truth.select(*KEY).distinct(), KEY, "left_semi").groupBy("s1_id").agg(F.min("model_rank").alias("r"))
    per = queries.select(F.col("entity_id").alias("s1_id")).distinct().join(first, "s1_id", "left")
    n, found = F.count(F.lit(1)), F.count("r")
    hits = lambda k: F.count_if(F.col("r") <= k)
    total = F.coalesce(F.sum(1.0 / F.col("r")), F.lit(0.0))
    return per.agg(n.alias("n_queries"), found.alias("n_with_true"), *[hits(k).alias(f"hits_{k}") for k in ks], *[(hits(k) / n).alias(f"recall_{k}") for k in ks], F.round(total / n, 9).alias("mrr_all"), F.round(F.when(found > 0, total / found).otherwise(0.0), 9).alias("mrr_with_true"))


def rank_buckets(ranked: DataFrame, truth: DataFrame, ks: tuple[int, ...] = (1, 5, 10, 25, 50, 100, 350)) -> DataFrame:
    """True pairs by model rank, cumulative."""
    true = ranked.join(truth.select(*KEY).distinct(), KEY, "left_semi")
    return true.agg(*[F.count_if(F.col("model_rank") <= k).alias(f"rank_{k}") for k in ks])


def error_ceiling(truth: DataFrame, candidates: DataFrame, predicted: DataFrame) -> DataFrame:
    t = _marked(truth, candidates, "reach").join(predicted.select(*KEY).distinct().withColumn("hit", F.lit(1)), KEY, "left")
    out = t.agg(F.count(F.lit(1)).alias("n_true"), F.count_if(F.col("reach") == 0).alias("blocking_misses"), F.sum("reach").alias("reachable"), F.count("hit").alias("tp"), F.count_if((F.col("reach") == 1) & F.col("hit").isNull()).alias("threshold_misses"))
    fp = predicted.select(*KEY).distinct().join(truth.select(*KEY).distinct(), KEY, "left_anti").agg(F.count(F.lit(1)).alias("fp"))
    return out.crossJoin(fp)  # one row each


def _misses(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    counts = candidates.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_cands"))
    missed = truth.select(*KEY).distinct().join(candidates.select(*KEY), KEY, "left_anti")
    return missed.join(counts, "s1_id", "left").withColumn("n_cands", F.coalesce("n_cands", F.lit(0)))


def misses_simple(truth: DataFrame, candidates: DataFrame, cap: int) -> DataFrame:
    """Missed pairs by cause: the cap, no candidate at all, or other."""
    cause = F.when(F.col("n_cands") == cap, "cap").when(F.col("n_cands") == 0, "zero_candidates").otherwise("sparse")
    return _misses(truth, candidates).groupBy(cause.alias("cause")).agg(F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("s1_id").alias("n_queries"))


def miss_reasons(truth: DataFrame, candidates: DataFrame, cap: int) -> DataFrame:
    """Each missed pair with a reason."""
    reason = F.when(F.col("n_cands") == 0, "zero_candidates").when(F.col("n_cands") >= cap, "cap_truncation").when(F.col("cand_id").startswith("S2-"), "s2_no_key").otherwise("s3_no_key")
    return _misses(truth, candidates).select(*KEY, F.col("n_cands").alias("candidate_count"), reason.alias("reason"))


def misses_detailed(truth: DataFrame, candidates: DataFrame, queries: DataFrame, pool: DataFrame, cap: int, examples: int = 3) -> DataFrame:
    """Missed pairs by the first category that fits, with example pairs."""
    columns = {"sig": "name_significant_tokens", "num": "address_numbers", "addr": "address_tokens", "raw": "business_address", "country": "country_clean"}
    side = lambda df, key, p: df.select(F.col("entity_id").alias(key), *[F.col(c).alias(p + k) for k, c in columns.items()], F.lit(True).alias(p + "in"))
    m = _misses(truth, candidates).join(side(queries, "s1_id", "a_"), "s1_id", "left").join(side(pool, "cand_id", "b_"), "cand_id", "left")
    meet = lambda k: F.arrays_overlap(words_of(F.col("a_" + k)), words_of(F.col("b_" + k)))
    category = (
        F.when(F.col("a_in").isNull() | F.col("b_in").isNull(), "missing_record")
        .when((F.col("n_cands") >= cap) & (meet("sig") | meet("num")), "cap_truncation")
        .when(F.col("n_cands") >= cap, "name_mismatch")
        .when(F.col("b_raw") == "", "missing_address")
        .when(~meet("sig"), "name_mismatch")
        .when(~meet("addr"), "address_mismatch")
        .when(F.col("a_country") != F.col("b_country"), "country_mismatch")
        .otherwise("other_key_miss")
    )
    tagged = m.select(*KEY, category.alias("category"))
    from pyspark.sql import Window as W

    firsts = tagged.withColumn("nth", F.row_number().over(W.partitionBy("category").orderBy(*KEY))).filter(F.col("nth") <= examples)
    texts = firsts.groupBy("category").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", F.concat_ws(">", *KEY).alias("x")))), lambda s: s["x"]), " ").alias("examples"))
    return tagged.groupBy("category").agg(F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("s1_id").alias("n_queries")).join(texts, "category")


def confusion(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(p, label) -> counts, precision, recall, F1."""
    yes, true = F.col("p") >= threshold, F.col("label") == 1
    c = scored.agg(F.count_if(yes & true).alias("tp"), F.count_if(yes & ~true).alias("fp"), F.count_if(~yes & true).alias("fn"), F.count_if(~yes & ~true).alias("tn"))
    c = c.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return c.withColumn("f1", fbeta(F.col("precision"), F.col("recall"), 1.0))


def curve_areas(scored: DataFrame, buckets: int = 1000) -> DataFrame:
    """Areas under the ROC and the precision-recall curve (trapezoids), from counts per distinct score, so ties are exact.

    Running counts are taken in two levels, over ranges of scores from 0 to 1 and within each, so that no task holds all scores.
    """
    from pyspark.sql import Window as W

    yes = F.col("label").cast("long")
    range_ = F.least(F.greatest(F.floor(F.col("p") * buckets), F.lit(0)), F.lit(buckets - 1))
    per = scored.groupBy("p").agg(F.sum(yes).alias("pos"), F.sum(1 - yes).alias("neg")).withColumn("range", range_)
    ranges = per.groupBy("range").agg(F.sum("pos").alias("in_pos"), F.sum("neg").alias("in_neg"))  # a row for each range
    above = W.orderBy(F.desc("range")).rowsBetween(W.unboundedPreceding, -1)
    starts = ranges.select("range", F.coalesce(F.sum("in_pos").over(above), F.lit(0)).alias("pos_above"), F.coalesce(F.sum("in_neg").over(above), F.lit(0)).alias("neg_above"))
    down = W.partitionBy("range").orderBy(F.desc("p")).rowsBetween(W.unboundedPreceding, 0)
    run = per.join(F.broadcast(starts), "range").select("pos", "neg", (F.sum("pos").over(down) + F.col("pos_above")).alias("tp"), (F.sum("neg").over(down) + F.col("neg_above")).alias("fp"))
    totals = scored.agg(F.sum(yes).alias("P"), F.sum(1 - yes).alias("N"))
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    tp, fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")  # before this score: its precision needs no look at the row before
    before = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(1.0)
    steps = run.select("*", (F.col("neg") * (F.col("tp") - F.col("pos") / 2)).alias("roc"), (F.col("pos") * (precision + before) / 2).alias("pr"))
    sums = steps.agg(F.sum("roc").alias("roc"), F.sum("pr").alias("pr")).crossJoin(totals)  # one row each
    return sums.select(F.round(F.col("roc") / F.nullif(F.col("P") * F.col("N"), F.lit(0)), 9).alias("roc_auc"), F.round(F.col("pr") / F.nullif(F.col("P"), F.lit(0)), 9).alias("pr_auc"))


def calibration(scored: DataFrame, bins: int = 5) -> DataFrame:
    b = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n_pairs"), F.sum(F.col("label").cast("long")).alias("n_true")).withColumn("match_rate", F.col("n_true") / F.col("n_pairs"))


def _threshold_counts(scored: DataFrame, thresholds: tuple[float, ...], *by: str) -> DataFrame:
    """For each threshold the pairs at or above it; the pairs are scanned once and counted per interval first."""
    at = F.array(*[F.lit(t) for t in thresholds])
    passed = F.filter(at, lambda t: F.col("p") >= t)
    top = scored.withColumn("_n", F.size(passed)).groupBy(*by, "_n").agg(F.sum(F.col("label").cast("long")).alias("tp"), F.count(F.lit(1)).alias("n"))
    each = top.select(*by, "tp", "n", F.explode(F.when(F.col("_n") > 0, F.slice(F.sort_array(at), 1, F.col("_n"))).otherwise(F.array().cast("array<double>"))).alias("threshold"))
    return each.groupBy(*by, "threshold").agg(F.sum("tp").alias("tp"), F.sum(F.col("n") - F.col("tp")).alias("fp"))


def threshold_sweep(scored: DataFrame, truth: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    n = truth.select(*KEY).distinct().agg(F.count(F.lit(1)).alias("n_true"))
    all_ = scored.sparkSession.createDataFrame([(float(t),) for t in thresholds], "threshold double")
    c = all_.join(_threshold_counts(scored, thresholds), "threshold", "left").na.fill(0, ["tp", "fp"]).crossJoin(n)
    c = c.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("n_true"))})
    return c.withColumn("f05", fbeta(F.col("precision"), F.col("recall")))


def threshold_grid(scored: DataFrame, truth: DataFrame, countries: tuple[str, ...], thresholds: tuple[float, ...]) -> DataFrame:
    """F0.5 for every combination of thresholds of the countries and of all others; counts are made once, combinations come from a few rows."""
    group = F.coalesce(*[F.when(F.col("country") == c, F.lit(c)) for c in countries], F.lit("other"))
    counts = materialize(_threshold_counts(scored.withColumn("grp", group), thresholds, "grp").coalesce(1), "grid")  # a row for each group and threshold
    all_ = scored.sparkSession.createDataFrame([(float(t),) for t in thresholds], "threshold double").coalesce(1)
    tables = []
    for g in (*countries, "other"):
        name = g.lower()
        t = all_.join(counts.filter(F.col("grp") == g), "threshold", "left").na.fill(0, ["tp", "fp"])
        tables.append(t.select(F.col("threshold").alias(f"t_{name}"), F.col("tp").alias(f"tp_{name}"), F.col("fp").alias(f"fp_{name}")))
    combos = reduce(lambda a, b: a.crossJoin(b), tables)  # thresholds to the power of the groups, independent of the data
    n = truth.select(*KEY).distinct().agg(F.count(F.lit(1)).alias("n_true"))
    names = [g.lower() for g in (*countries, "other")]
    total = lambda k: reduce(lambda a, b: a + b, [F.col(f"{k}_{g}") for g in names])
    c = combos.crossJoin(n).select(*[f"t_{g}" for g in names], total("tp").alias("tp"), total("fp").alias("fp"), "n_true")
    c = c.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("n_true"))})
    return c.withColumn("f05", fbeta(F.col("precision"), F.col("recall")))


def best(grid: DataFrame, *keys: str) -> DataFrame:
    """The row of the greatest F0.5; of equals, the first in the order of the keys."""
    return grid.orderBy(F.desc("f05"), *keys).limit(1)


def growth(before: DataFrame, after: DataFrame, n_queries: int = 3_938_000, id_bytes: int = 12) -> DataFrame:
    """(mean) of two distributions -> change in volume, and the size on disk that it would take."""
    b, a = before.select(F.col("total").alias("total_before")), after.select(F.col("total").alias("total_after"), "mean")
    return b.crossJoin(a).select("total_before", "total_after", (100 * (F.col("total_after") - F.col("total_before")) / F.col("total_before")).alias("growth_pct"), (F.col("mean") * n_queries * id_bytes / 1e9).alias("disk_gb"))


def deltas(results: DataFrame, baseline: str) -> DataFrame:
    """(experiment, f05, recall) -> differences to the baseline, and whether to retain it."""
    base = results.filter(F.col("experiment") == baseline).select(F.col("f05").alias("_f"), F.col("recall").alias("_r"))
    both = results.crossJoin(base)  # the baseline is one row
    return both.select("experiment", (F.col("f05") - F.col("_f")).alias("delta_f05"), (F.col("recall") - F.col("_r")).alias("delta_recall"), (F.col("f05") > F.col("_f")).alias("retained"))
