"""Rules for ID-list files. Each rule is a table of offenders; summary() counts rows and offenders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.sources.tsv import id_lines


def header_errors(header: str, expected: tuple[str, str]) -> list[str]:
    """V2 and V3: a header must be tab-separated and hold the expected names, whatever their case."""
    if "\t" not in header:
        return ["header is comma-separated, tabs are expected" if "," in header else "header has no tab"]
    found = [c.strip().lower() for c in header.split("\t")]
    return [] if found == [c.lower() for c in expected] else [f"header is {found}, expected {list(expected)}"]


def malformed(lines: DataFrame) -> DataFrame:
    """Lines (value) that are not blank and have no tab."""
    return lines.filter(~X.blank(F.col("value")) & ~F.col("value").contains("\t")).select("value")


def duplicate_rows(lists: DataFrame) -> DataFrame:
    return lists.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def _ids(lists: DataFrame) -> DataFrame:
    return lists.select("s1_id", F.explode(X.id_list(F.col("ids"), trim=False, keep_blank=True)).alias("cand_id")).filter(~X.blank(F.col("cand_id")))


def duplicate_ids(lists: DataFrame) -> DataFrame:
    """Lists that name an id twice."""
    ids = X.id_list(F.col("ids"), trim=False)
    return lists.filter(F.size(ids) != F.size(F.array_distinct(ids))).select("s1_id", (F.size(ids) - F.size(F.array_distinct(ids))).cast("long").alias("n_repeats"))


def self_matches(lists: DataFrame) -> DataFrame:
    return _ids(lists).filter(F.col("cand_id").startswith("S1-"))


def wrong_prefix(lists: DataFrame) -> DataFrame:
    """Ids are not stripped: one with a space before it has the wrong prefix."""
    known = F.col("cand_id").startswith("S1-") | F.col("cand_id").startswith("S2-") | F.col("cand_id").startswith("S3-")
    return _ids(lists).filter(~known)


def unknown_ids(lists: DataFrame, pool: DataFrame) -> DataFrame:
    return _ids(lists).join(pool.select(F.col("entity_id").alias("cand_id")), "cand_id", "left_anti").select("s1_id", "cand_id")


def required(lists: DataFrame, queries: DataFrame) -> DataFrame:
    """Queries without a row, and rows of no query."""
    have, want = lists.select("s1_id").distinct(), queries.select(F.col("entity_id").alias("s1_id")).distinct()
    return want.join(have, "s1_id", "left_anti").select("s1_id", F.lit("missing").alias("problem")).union(have.join(want, "s1_id", "left_anti").select("s1_id", F.lit("unexpected").alias("problem")))


def not_in_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Queries with a match that is none of their candidates."""
    return _ids(matches).join(_ids(candidates), ["s1_id", "cand_id"], "left_anti").groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_outside"))


def summary(lists: DataFrame) -> DataFrame:
    empty = F.size(X.id_list(F.col("ids"))) == 0
    return lists.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(empty).alias("n_empty"), F.count_if(~empty).alias("n_non_empty"), F.coalesce(F.sum(F.size(X.id_list(F.col("ids")))), F.lit(0)).cast("long").alias("n_ids"))


def candidate_audit(lists: DataFrame, queries: DataFrame) -> DataFrame:
    """The checklist of a candidate file as one row of counts; all but n_rows must be 0."""
    zero = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    parts = [lists.agg(F.count(F.lit(1)).alias("n_rows")), zero(duplicate_rows(lists), "duplicate_rows"), zero(lists.filter(~F.col("s1_id").startswith("S1-")), "bad_keys"), zero(duplicate_ids(lists), "lists_with_repeats"), zero(self_matches(lists), "self_matches"), zero(required(lists, queries), "missing_or_unexpected")]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


def not_utf8(lines: DataFrame) -> DataFrame:
    """Lines whose bytes are no UTF-8, shown with replacement characters."""
    return lines.filter(~F.is_valid_utf8("value")).select(F.make_valid_utf8("value").alias("value"))


def validate(spark: SparkSession, path: str, expected: tuple[str, str], queries: DataFrame | None = None, pool: DataFrame | None = None, examples: int = 5) -> DataFrame:
    """All rules over a file: (rule, n, examples), offenders only. A missing or empty file is an offence; each part of a file may have the header once."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(at) is None:
        return spark.createDataFrame([("file", 1, "file is missing")], "rule string, n long, examples string")
    lines = spark.read.text(path)
    first = lines.limit(1).collect()
    header = first[0]["value"] if first else ""
    errors = [("file", "file is empty")] if not first else [("header", e) for e in header_errors(header, expected)]
    is_header = F.col("value") == F.lit(header)
    again = lines.filter(is_header).groupBy(F.input_file_name().alias("x")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("x")
    out = spark.createDataFrame(errors, "rule string, x string").union(again.select(F.lit("repeated_header"), "x"))
    return report(lines.filter(~is_header), queries, pool, examples, out)


def report(body: DataFrame, queries: DataFrame | None = None, pool: DataFrame | None = None, examples: int = 5, before: DataFrame | None = None) -> DataFrame:
    """The rules for the lines below the header: (rule, n, examples), offenders only. before: (rule, x) of earlier rules."""
    lists = id_lines(body)
    tables = {"not_utf8": not_utf8(body).select(F.col("value").alias("x")), "malformed_line": malformed(body).select(F.col("value").alias("x"))}
    tables |= {"duplicate_row": duplicate_rows(lists).select(F.col("s1_id").alias("x")), "duplicate_id": duplicate_ids(lists).select(F.col("s1_id").alias("x"))}
    tables |= {k: t.select(F.concat_ws(">", "s1_id", "cand_id").alias("x")) for k, t in (("self_match", self_matches(lists)), ("wrong_prefix", wrong_prefix(lists)))}
    if queries is not None:
        tables["required"] = required(lists, queries).select(F.concat_ws(":", "problem", "s1_id").alias("x"))
    if pool is not None:
        tables["unknown_id"] = unknown_ids(lists, pool).select(F.concat_ws(">", "s1_id", "cand_id").alias("x"))
    out = before
    for rule, t in tables.items():
        named = t.select(F.lit(rule).alias("rule"), "x")
        out = named if out is None else out.union(named)
    # counts are combined in the tasks that find the offenders, and of examples each task hands on a few
    counts = out.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    few = out.withColumn("nth", F.row_number().over(W.partitionBy("rule").orderBy("x"))).filter(F.col("nth") <= examples)
    return counts.join(few.groupBy("rule").agg(F.array_join(F.sort_array(F.collect_list("x")), "; ").alias("examples")), "rule")
