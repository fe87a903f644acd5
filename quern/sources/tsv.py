"""Tab-separated sources and sinks, ID lists, integrity checks and resumable output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import text as X
from quern.schema import ENTITY

_OPTIONS = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}  # the writer drops outer spaces by default


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = ENTITY, columns: tuple[str, ...] | None = None, na_literals: bool = False) -> DataFrame:
    """All columns are strings, empty ones stay empty; na_literals also empties what data-frame readers take for missing."""
    df = spark.read.options(**_OPTIONS).schema(schema).csv(path).fillna("")
    df = df.select(*columns) if columns else df
    return df.select(*[X.na_as_empty(F.col(c)).alias(c) for c in df.columns]) if na_literals else df


def write_tsv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.options(**_OPTIONS, emptyValue="").mode(mode).csv(path)


def id_lines(lines: DataFrame) -> DataFrame:
    """Text lines (value) -> (s1_id, ids): split at the first tab only; blank lines and lines without a tab are skipped."""
    v = F.col("value")
    ok = lines.filter(~X.blank(v) & v.contains("\t"))
    at = F.instr(v, "\t")
    return ok.select(X.strip(F.substring(v, F.lit(1), at - 1)).alias("s1_id"), F.substring(v, at + 1, F.length(v)).alias("ids"))


def read_id_lists(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, ids) without the header; a stray tab stays inside the list."""
    lines = spark.read.text(path)
    return id_lines(lines).filter(~F.lower("s1_id").isin("source1_entity_id"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The distinct first column of a file."""
    first = X.strip(F.split_part(F.col("value"), F.lit("\t"), F.lit(1)))
    return spark.read.text(path).select(first.alias("entity_id")).filter("entity_id <> '' AND lower(entity_id) NOT IN ('entity_id', 'source1_entity_id')").distinct()


def pairs_of(lists: DataFrame, key: str = "s1_id", ids: str = "ids") -> DataFrame:
    return lists.select(F.col(key).alias("s1_id"), F.explode(X.id_list(F.col(ids))).alias("cand_id"))


def write_id_lists(lists: DataFrame, path: str, mode: str = "error") -> None:
    """(source1_entity_id, list): one unquoted line each, with a header in every part."""
    a, b = lists.columns
    lists.select(F.concat_ws("\t", F.col(a), F.coalesce(F.col(b), F.lit(""))).alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def read_only_known(df: DataFrame, ids: DataFrame, key: str = "entity_id") -> DataFrame:
    """Rows whose id is wanted."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def remaining(queries: DataFrame, done: DataFrame) -> DataFrame:
    """Queries that an earlier run has not written."""
    return queries.join(done.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_anti")


def append_remaining(queries: DataFrame, path: str, make) -> int:
    """Resumable sink: make(queries not yet in path) -> (source1_entity_id, list), appended. Returns how many queries there were."""
    spark = queries.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jpath)
    todo = remaining(queries, read_id_lists(spark, path)) if exists else queries
    n = todo.count()
    if n:
        write_id_lists(make(todo), path, "append")
    return n


def files(spark: SparkSession, path: str) -> DataFrame:
    """Files with size and SHA-256, for existence and integrity checks."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def verify(spark: SparkSession, path: str, expected: dict[str, str]) -> DataFrame:
    """(file, status): ok, changed, missing or unexpected."""
    want = spark.createDataFrame(list(expected.items()), "file string, want string")
    status = F.when(F.col("sha256").isNull(), "missing").when(F.col("want").isNull(), "unexpected").when(F.col("sha256") == F.col("want"), "ok").otherwise("changed")
    return files(spark, path).join(want, "file", "full").select("file", status.alias("status"))


def write_report(df: DataFrame, path: str, kind: str = "json") -> None:
    """Metric tables as JSON or CSV."""
    w = df.write.mode("overwrite")
    w.json(path) if kind == "json" else w.option("header", True).csv(path)


def markdown(df: DataFrame) -> str:
    """A small metric table as Markdown."""
    rows = df.collect()
    out = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(out + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows])


def file_status(spark: SparkSession, paths: list[str], schema: T.StructType = ENTITY) -> DataFrame:
    """(path, found, n_bytes, parsable) of a list of entity files: the header must name the schema's columns."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    rows = []
    for p in paths:  # a few metadata calls and one line of each file
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(conf)
        found = fs.exists(at)
        n = fs.getContentSummary(at).getLength() if found else 0
        first = spark.read.text(p).head(1) if n else []
        rows.append((p, found, n, bool(first) and first[0]["value"].split("\t") == schema.fieldNames()))
    return spark.createDataFrame(rows, "path string, found boolean, n_bytes long, parsable boolean")
