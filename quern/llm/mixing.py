"""Mixing sources to target weights by systematic sampling.

Every document of a source expects target / source_size copies. The running sum of expected copies
within the source, plus one random offset, crosses some integers at each document; the document is
emitted once for each. The running sum is taken in two levels (size class, then hash bucket), so no
task ever holds a whole source, however hot it is.

Defined cases: a null text has size 0; sources are ordered by code point with null last; a source
whose documents are all empty has target 0 and emits nothing; an empty table gives an empty result;
rows repeated with the same id are separate documents; ties in size are ordered by id, then by a hash of the text. A document of
size 0 can be emitted, its taken words are 0. Columns of the input are kept, whatever their names, unless
a computed column has their name (size, source_size, target, expected, copies, taken; in emit() copy too).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.llm.common import WORD, materialize, reads, table

WEIGHTS = (5, 2, 1)
MOST = 3  # times its size that a source or a document may be taken
BUCKETS = 2  # hexadecimal digits of the md5 of the id: 256 buckets in each size class


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _offset(source: Column, seed: str) -> Column:
    """One offset in [0, 1) for each source, a multiple of 2**-20, so that adding it stays exact."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), source)), 1, 5), 16, 10).cast("double") / F.lit(float(16**5))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(_source, source_size) -> the same with target: the weights' shares of all sizes, filled up to caps.

    A source holds at most `most` times its own size; what exceeds that is shared again among the others by
    weight. In the order of size / weight the capped sources come first, so running sums over the sources
    (one row each) give the level at which the rest is shared.
    """
    by_name = W.orderBy("_source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    before = W.orderBy(F.col("_cap") / F.col("_w"), "_source").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    total, all_w = F.sum("source_size").over(everything), F.sum("_w").over(everything)
    left = total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    level = left / (all_w - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    levels = ranked.withColumn("_level", level).withColumn("_order", F.col("_cap") / F.col("_w"))
    open_ = F.when(F.col("_cap") > F.col("_w") * F.col("_level"), F.struct("_order", "_source", F.col("_level").alias("level")))
    # the first source in that order which its share does not fill: its level holds for all that are not full
    first = F.min(open_).over(everything)["level"]
    return levels.select("_source", "source_size", F.least(F.col("_cap"), F.coalesce(F.col("_w") * first, F.col("_cap"))).alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = WEIGHTS, most: float = MOST, seed: str = "mix", size: Column | None = None) -> DataFrame:
    """docs with size, source_size, target, expected (copies), copies and taken (copies * size).

    Only DataFrame operations. The rows are shuffled once, by (source, size class, bucket), for the running count, and meet the
    counts of those groups in the same partitions. size: instead of the words of the text, so that the text need not be in docs.
    """
    computed = ["size", "source_size", "target", "expected", "copies", "taken"]
    # ties of size and id are ordered by the text, where there is one; columns of the input stay in a struct, so that no name clashes
    tie = F.xxhash64(F.col(f"`{text}`")) if text in docs.columns else F.lit(0).cast("long")
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), (n_words(text) if size is None else size).alias("size"), tie.alias("_tie"))
    digits, f = F.col("size").cast("string"), F.col("_row")
    # sorts as the source by code point, null last, and is never null: joins and windows then share one partitioning
    rows = inner.select("_row", F.coalesce(F.concat(F.lit("0"), f[source]), F.lit("1")).alias("_source"), f[key].alias("_key"), "size", "_tie")
    # never null to Catalyst either: else the join's check for nulls would count the words once more
    class_ = F.coalesce(F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int"), F.lit(0))
    rows = rows.withColumns({"_class": class_, "_bucket": F.substring(F.md5(F.coalesce(F.col("_key").cast("string"), F.lit(""))), 1, BUCKETS)})
    group = ["_source", "_class", "_bucket"]
    groups = materialize(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_count"), F.sum("size").alias("_sum")), "mix-groups")
    classes = groups.groupBy("_source", "_class").agg(F.sum("_count").alias("_n"), F.sum("_sum").alias("_sum"))
    up_to = lambda *keys: W.partitionBy("_source", *keys).rowsBetween(W.unboundedPreceding, -1)
    starts = classes.select("_source", "_class", F.coalesce(F.sum("_n").over(up_to().orderBy("_class")), F.lit(0)).alias("_start"))
    per_source = targets(classes.groupBy("_source").agg(F.sum("_sum").alias("source_size")), weights, most)
    per_source = per_source.withColumn("expected", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    inside = groups.select(*group, F.coalesce(F.sum("_count").over(up_to("_class").orderBy("_bucket")), F.lit(0)).alias("_in"))
    before = inside.join(starts, group[:2]).join(per_source, "_source").select(*group, (F.col("_start") + F.col("_in")).alias("_before"), "source_size", "target", "expected")
    placed = rows.withColumn("_nth", F.row_number().over(W.partitionBy(*group).orderBy("size", "_key", "_tie")))
    placed = placed.join(before, group).withColumn("_nth", F.col("_before") + F.col("_nth"))
    u = _offset(F.col("_source"), seed)
    copies = F.floor(F.col("expected") * F.col("_nth") + u) - F.floor(F.col("expected") * (F.col("_nth") - 1) + u)
    out = placed.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    return reads(out.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in computed], *computed), groups)


def emit(mixed: DataFrame) -> DataFrame:
    """One row for each copy, numbered from 1 in the column copy; documents with no copy go."""
    return reads(mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), mixed)


def op7_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = materialize(table(spark, sf_dir, "documents").select("doc_id", "source", n_words().alias("n")), "mix-sizes")  # words are counted once
    return mix(docs, size=F.col("n")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


#: DuckDB: documents stands for the relation that is mixed.
MIX_SQL = r"""
rows0 AS (SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {docs}),
rows1 AS (SELECT *, length(size::VARCHAR) * 100 + substr(size::VARCHAR, 1, 2)::INT AS class_, substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2) AS bucket_ FROM rows0),
src0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows1 GROUP BY source),
src1 AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS w, source_size * 3.0::DOUBLE AS cap FROM src0),
src2 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level FROM src1
  WINDOW b AS (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT level AS first_level FROM src2 WHERE cap > w * level ORDER BY cap / w, source IS NULL, source LIMIT 1),
src AS (SELECT source, source_size, least(cap, coalesce(w * (SELECT first_level FROM lev), cap)) AS target FROM src2),
placed AS (SELECT r.*, s.source_size, s.target, CASE WHEN s.source_size > 0 THEN s.target / s.source_size ELSE 0 END AS expected,
    row_number() OVER (PARTITION BY r.source ORDER BY class_, bucket_, size, doc_id) AS nth,
    ('0x' || substr(md5('mix:' || coalesce('0' || r.source, '1')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u
  FROM rows1 r JOIN src s ON r.source IS NOT DISTINCT FROM s.source),
mixed AS (SELECT *, (floor(expected * nth + u) - floor(expected * (nth - 1) + u))::BIGINT AS copies FROM placed)"""

SQL = "WITH " + MIX_SQL.format(docs="documents") + "\nSELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM mixed"
