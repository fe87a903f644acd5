"""URL rules as a sort-merge range join on reversed-host keys.

A host is written from its last label to its first, each label closed by a character below all others, so
that a host and all its subdomains are one interval of sorted keys, and rules nest or are disjoint. A task sorts
its rows by key and sweeps them against the sorted rules, keeping a stack of the rules whose interval is open;
a row takes, of the rules on the stack, the longest whose path its own path starts with. Rows are not
shuffled: the sorted rules go to every task, in blocks of at most RULE_BLOCK rules; more rules than that take
more passes, one after the other, each keeping the better of its own and the earlier result, so the broadcast is bounded.

Defined cases: a null url, or one without ://, has empty host and path, and fits no rule; an empty path fits
only a rule with an empty path; a rule repeated with one verdict counts once, with two verdicts block wins; of fitting rules
of one length that with the longer host counts; nulls in a table of rules are an empty host or path, and block; no
rules give the default verdict; other columns of pages are kept unless a computed column has their name.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import Shared, discard, mapped, materialize, reads, table

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
RULE_BLOCK = 100_000
CLOSE = "\x01"  # closes a label in a key


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lowered = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def _key(host: Column) -> Column:
    """tail.example.net -> net\\x01example\\x01tail\\x01; an empty host has an empty key."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), CLOSE), F.lit(CLOSE)))


def rule_key(host: str) -> str:
    return CLOSE.join(reversed(host.split("."))) + CLOSE if host else ""


class Rules:
    """Sorted rules of a block, with their keys for a first look-up."""

    def __init__(self, ordered: list[tuple[str, str, str, str]]):
        self.rules = ordered  # (key, path, host, verdict)
        self.keys = [r[0] for r in ordered]


def sweep(keys: Sequence[str], paths: Sequence[str], block: Rules) -> Iterator[int]:
    """For keys in order, the index of the longest fitting rule or -1; of rules of equal length that with the longer host."""
    stack: list[tuple[str, list[tuple[str, int]]]] = []
    rules, at = block.rules, 0
    if keys:  # the sweep begins at the first key, with the rules open that enclose it
        first = keys[0]
        for end in [i + 1 for i, c in enumerate(first) if c == CLOSE] if first else [0]:
            a, b = bisect_left(block.keys, first[:end]), bisect_right(block.keys, first[:end])
            if a < b:
                stack.append((first[:end], [(rules[i][1], i) for i in range(a, b)]))
        at = bisect_right(block.keys, first)
    for key, path in zip(keys, paths, strict=True):
        while stack and (not key.startswith(stack[-1][0]) or not stack[-1][0] and key):  # that interval has ended
            stack.pop()
        while at < len(rules) and rules[at][0] <= key:
            rule_at, rule_path = rules[at][:2]
            at += 1
            if not key.startswith(rule_at) or (not rule_at and key):
                continue
            if stack and stack[-1][0] == rule_at:
                stack[-1][1].append((rule_path, at - 1))
            else:
                stack.append((rule_at, [(rule_path, at - 1)]))
        best = (-1, -1, -1)
        for rule_at, at_host in stack:
            for rule_path, index in at_host:
                if path.startswith(rule_path):
                    best = max(best, (len(rule_at) + len(rule_path), len(rule_at), index))
        yield best[2]


def _blocks(rules: Sequence[tuple[str, str, str]] | DataFrame, most: int) -> Iterator[list[tuple[str, str, str, str]]]:
    """(key, path, host, verdict) in order of key and path, at most `most` at a time; of one host and path block wins."""
    if isinstance(rules, DataFrame):
        low = F.translate(F.coalesce("host", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        named = rules.select(low.alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.coalesce("verdict", F.lit("block")).alias("verdict"))
        chosen = named.groupBy("host", "path").agg(F.coalesce(F.max(F.when(F.col("verdict") == "block", F.lit("block"))), F.max("verdict")).alias("verdict"))
        rows = chosen.select(_key(F.col("host")).alias("key"), "path", "host", "verdict").orderBy("key", "path").toLocalIterator()
        found = (tuple(r) for r in rows)
    else:
        by_name: dict[tuple[str, str], str] = {}
        for host, path, verdict in rules:
            host = re.sub("[A-Z]+", lambda m: m.group().lower(), host)
            by_name[host, path] = "block" if "block" in (verdict, by_name.get((host, path))) else verdict
        found = iter(sorted((rule_key(h), p, h, v) for (h, p), v in by_name.items()))
    while part := list(islice(found, most)):
        yield part


def apply_rules(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, url: str = "url", default: str = "allow", block: int = RULE_BLOCK) -> DataFrame:
    """pages with host, path, rule (text of the rule, or null) and verdict. rules: (host, path, verdict), as a sequence or a table."""
    kept = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict"}]
    own = ["host", "path", "rule", "verdict", "length"]
    # columns of the input stay in a struct, so that no name clashes; length orders the rules that several blocks have
    row = F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("none")]).alias("row")
    address = F.col(f"`{url}`")
    out = pages.select(row, host_of(address).alias("host"), path_of(address).alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"), F.lit(-1).cast("long").alias("length"))
    schema = T.StructType(list(out.schema.fields))

    def sweeping(shared: Shared):
        def run(batches):
            found = shared.built(Rules, keep=1)
            for batch in batches:  # sorted within the task, and each batch starts at its first key
                got = list(sweep(batch.column("key").to_pylist(), batch.column("path").to_pylist(), found))
                rule, verdict, length = (batch.column(c).to_pylist() for c in own[2:])
                for at, i in enumerate(got):
                    if i >= 0:
                        key, path, host, v = found.rules[i]
                        n = (len(key) + len(path) << 20) + len(key)
                        if n > length[at]:
                            rule[at], verdict[at], length[at] = host + path, v, n
                columns = [batch.column("row"), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(length, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["row", *own])

        return run

    parts, before = _blocks(rules, block), None
    now = next(parts, None)
    while now is not None:
        after = next(parts, None)
        shared = Shared(pages.sparkSession, now)
        out = mapped(out.withColumn("key", _key(F.col("host"))).sortWithinPartitions("key"), sweeping(shared), schema)
        if after is not None:  # one block at a time
            out = materialize(out, "url-state")
            shared.sent.destroy()
            discard(before)
            before = out
        now = after
    return reads(out.select(*[F.col("row")[c].alias(c) for c in kept], *own[:-1]), before)


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*(/[^?#]*)', 1, 's'), '') AS path FROM pages),
ruled AS (SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""
