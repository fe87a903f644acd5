"""Audits of entity tables and of ground truth. Counts are long, shares in percent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as X

COLUMNS = ("entity_id", "business_name", "business_address", "country")


def _n(c: Column) -> Column:
    return F.count_if(F.coalesce(c, F.lit(False)))


def with_source(*tables: DataFrame) -> DataFrame:
    """The tables, one below the other, with the source from the prefix of the id."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.withColumn("source", F.substring("entity_id", 1, 2))


def row_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(COLUMNS)).cast("long").alias("n_columns"))


def missing(entities: DataFrame) -> DataFrame:
    """A row for each source and column."""
    flags = entities.select("source", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), X.blank(F.col(c)).alias("is_missing")) for c in COLUMNS])).alias("x"))
    return flags.groupBy("source", F.col("x.column_name").alias("column_name")).agg(_n(F.col("x.is_missing")).alias("n_missing"), (100 * _n(F.col("x.is_missing")) / F.count(F.lit(1))).alias("pct_missing"))


def ids(entities: DataFrame) -> DataFrame:
    bad = ~F.col("entity_id").rlike(r"^S[123]-\p{Nd}+$")
    return entities.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("entity_id").alias("n_ids"), (F.count(F.lit(1)) - F.countDistinct("entity_id")).alias("n_duplicate_ids"), _n(bad).alias("n_malformed"), _n(X.blank(F.col("entity_id"))).alias("n_missing_ids"))


def duplicates(entities: DataFrame) -> DataFrame:
    """Rows beyond the first of equal ones, for several sets of columns; each is an aggregation on a hash of the columns' texts."""
    name, addr, country = (F.coalesce(F.col(c), F.lit("")) for c in COLUMNS[1:])
    low = lambda c: X.strip(F.lower(c))
    sets = {"all": (F.col("entity_id"), name, addr, country), "name": (name,), "address": (addr,), "name_address": (name, addr), "name_address_country": (name, addr, country), "name_address_lower": (low(name), low(addr))}
    keyed = entities.select("source", F.explode(F.array(*[F.struct(F.lit(k).alias("subset"), F.concat_ws("\u0001", *cols).alias("value")) for k, cols in sets.items()])).alias("x"))
    per_value = keyed.groupBy("source", "x.subset", "x.value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("source", "subset").agg(F.sum(F.col("n") - 1).alias("n_duplicates"))


def country_counts(entities: DataFrame) -> DataFrame:
    named = entities.withColumn("country", F.when(X.blank(F.col("country")), F.lit("<MISSING>")).otherwise(F.col("country")))
    counts = named.groupBy("source", "country").agg(F.count(F.lit(1)).alias("n_rows"))
    totals = counts.groupBy("source").agg(F.sum("n_rows").alias("total"))
    return counts.join(totals, "source").select("source", "country", "n_rows", (100 * F.col("n_rows") / F.col("total")).alias("pct"))


def lengths(entities: DataFrame) -> DataFrame:
    out = []
    for c, most in (("business_name", 150), ("business_address", 300)):
        n = F.length(F.coalesce(F.col(c), F.lit("")))
        short = c.removeprefix("business_")
        out += [F.min(n).cast("long").alias(f"min_{short}"), F.max(n).cast("long").alias(f"max_{short}"), F.avg(n).alias(f"avg_{short}"), _n(n > most).alias(f"long_{short}")]
    return entities.groupBy("source").agg(*out)


#: name of the flag -> pattern that the name or the address contains
QUALITY = {
    "non_ascii": r"[^\x00-\x7F]", "latin1": r"[\x{80}-\x{FF}]", "double_space": r"  ", "tab_or_newline": r"[\t\n\r]", "repeated_marks": r"\?\?|!!|,,|--", "edge_space": r"^ | $",
    "devanagari": r"[\x{900}-\x{97F}]", "arabic": r"[\x{600}-\x{6FF}]", "cjk": r"[\x{4E00}-\x{9FFF}]", "cyrillic": r"[\x{400}-\x{4FF}]", "greek": r"[\x{370}-\x{3FF}]", "hebrew": r"[\x{590}-\x{5FF}]",
}


def quality_flags(entities: DataFrame) -> DataFrame:
    hit = lambda p: F.col("business_name").rlike(p) | F.col("business_address").rlike(p)
    return entities.groupBy("source").agg(*[_n(hit(p)).alias(k) for k, p in QUALITY.items()])


def truth_histogram(truth_lists: DataFrame) -> DataFrame:
    """(source1_entity_id, matched_entity_ids) -> one row of counts."""
    lists = truth_lists.select(X.id_list(F.col("matched_entity_ids"), trim=False).alias("l"))
    n = F.size("l")
    of = lambda p: F.coalesce(F.sum(F.size(F.filter("l", lambda x: x.startswith(p)))), F.lit(0)).cast("long")
    return lists.agg(
        F.count(F.lit(1)).alias("n_queries"), _n(n == 0).alias("n_none"), _n(n == 1).alias("n_one"), _n(n > 1).alias("n_several"), F.max(n).cast("long").alias("most"),
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("n_pairs"), of("S2-").alias("n_s2"), of("S3-").alias("n_s3"), _n(n != F.size(F.array_distinct("l"))).alias("n_with_repeats"),
    )


def referential(truth: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Pairs (s1_id, cand_id) against the tables, both ways; a row for each check."""
    count = lambda df, name: df.distinct().agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("n"))
    s1_ids, pool_ids = s1.select(F.col("entity_id").alias("s1_id")), pool.select(F.col("entity_id").alias("cand_id"))
    return (
        count(truth.select("s1_id").join(s1_ids, "s1_id", "left_anti"), "truth_s1_unknown")
        .union(count(s1_ids.join(truth, "s1_id", "left_anti"), "s1_without_truth"))
        .union(count(truth.select("cand_id").join(pool_ids, "cand_id", "left_anti"), "truth_match_unknown"))
    )


def first_rows(entities: DataFrame, n: int) -> DataFrame:
    """The first n rows of each source in the order of ids."""
    from pyspark.sql import Window as W

    return entities.withColumn("nth", F.row_number().over(W.partitionBy("source").orderBy("entity_id"))).filter(F.col("nth") <= n)
