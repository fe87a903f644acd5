"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of WINDOW consecutive words of a benchmark item; an item with fewer words, but not none,
is one pattern. For each length of pattern there is a table of shifts, keyed by the block of two words that ends
at the current position, and a table of the patterns that end in that block. A block in no pattern shifts by
the whole length, a word in no pattern past itself; a shift of 0 leads to the patterns with that suffix, and a direct comparison
of all their words confirms an occurrence.

Items are streamed from the benchmark in blocks of at most PATTERN_BLOCK windows and BLOCK_BYTES bytes, one after the other: each is broadcast and run over all rows;
a row carries its hit spans from block to block in a written table, so the result does not depend on the blocks, and one block at a time is held. Nothing is shuffled.

Defined cases: a null or empty text has no words and is not contaminated; null or empty items have no pattern; a
null item_id is the empty name; rows repeated with one item_id count as one item; repeated documents are judged each by
itself; an empty benchmark or table gives no hits or no rows; other columns are kept unless a computed column has their name.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import Shared, discard, free_name, mapped, materialize, reads, table

WINDOW = 13
PATTERN_BLOCK, BLOCK_BYTES = 100_000, 8 << 20  # windows and bytes of items in a block; its tables take some 50 MB in a worker
SHARE = 20  # contaminated: at least one word in SHARE is hit

#: Lower-cases A-Z; what is no word character becomes a space: words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of UTF-8.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


def windows_of(text: str | None, window: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    words = words_of(text)
    if 0 < len(words) < window:
        yield tuple(words)
    for i in range(len(words) - window + 1):
        yield tuple(words[i : i + window])


class WuManber:
    """Occurrences of word patterns; patterns: word tuples with the names that have them."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]]):
        self.ids: dict[bytes, int] = {}
        for p in patterns:
            for w in p:
                self.ids.setdefault(w, len(self.ids))
        self.base = len(self.ids) + 1
        self.by_length = []
        for m in sorted({len(p) for p in patterns}):
            shift: dict[int, int] = {}
            bucket: dict[int, dict[bytes, list[str]]] = {}
            for p, names in patterns.items():
                if len(p) != m:
                    continue
                own = [self.ids[w] for w in p]
                blocks = [own[0]] if m == 1 else [own[j - 1] * self.base + own[j] for j in range(1, m)]
                for j, block in enumerate(blocks):
                    to_end = len(blocks) - 1 - j
                    if shift.get(block, m) > to_end:
                        shift[block] = to_end
                bucket.setdefault(blocks[-1], {})[array("i", own).tobytes()] = names
            self.by_length.append((m, shift, bucket))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, word after the last, names) of every occurrence."""
        ids = list(map(self.ids.get, words, repeat(-1)))
        n, base, raw = len(ids), self.base, None
        for m, shift, bucket in self.by_length:
            far = max(1, m - 1)  # the shift of a block that no pattern has
            at, of = m - 1, shift.get
            while at < n:
                last = ids[at]
                if last < 0:
                    at += m
                    continue
                if m == 1:
                    block = last
                else:
                    prior = ids[at - 1]
                    if prior < 0:
                        at += m - 1
                        continue
                    block = prior * base + last
                step = of(block, far)
                if step:
                    at += step
                    continue
                if raw is None:
                    raw = array("i", ids).tobytes()
                names = bucket[block].get(raw[4 * (at - m + 1) : 4 * (at + 1)])
                if names is not None:
                    yield at - m + 1, at + 1, names
                at += 1


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, most: int) -> Iterator[list[tuple[str, bytes]]]:
    """(name, words joined by spaces) with at most `most` windows in a block; an item of more is cut where windows start."""
    found: list[tuple[str, bytes]] = []
    windows = size = 0
    for row in benchmark.select(F.col(f"`{item}`").cast("string"), F.col(f"`{text}`")).toLocalIterator():
        words, at = words_of(row[1]), 0
        while at == 0 and words or at + window <= len(words):
            n = min(most - windows, max(1, len(words) - window + 1 - at))
            found.append((row[0] or "", b" ".join(words[at : at + n + window - 1])))
            at, windows, size = at + n, windows + n, size + len(found[-1][1])
            if windows >= most or size >= BLOCK_BYTES:
                yield found
                found, windows, size = [], 0, 0
    if found:
        yield found


def _searcher(value: tuple[int, list[tuple[str, bytes]]]) -> WuManber:
    window, items = value
    patterns: dict[tuple[bytes, ...], list[str]] = {}
    for name, text in items:
        words = text.split()
        for i in range(max(1, len(words) - window + 1)):
            names = patterns.setdefault(tuple(words[i : i + window]), [])
            if name not in names:
                names.append(name)
    return WuManber(patterns)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block: int = PATTERN_BLOCK, keep_text: bool = True) -> DataFrame:
    """docs with n_words, n_hit, n_items, items (sorted names), items_sha256, hit_spans and contaminated."""
    made = ["n_words", "n_hit", "n_items", "items", "items_sha256", "hit_spans", "contaminated"]
    kept = [c for c in docs.columns if c.lower() not in made]
    spans, names, total = free_name(docs, "_spans", "_names", "_total")
    state = [T.StructField(spans, T.ArrayType(T.LongType())), T.StructField(names, T.ArrayType(T.StringType())), T.StructField(total, T.LongType())]
    schema = T.StructType([*[docs.schema[c] for c in kept], *state])
    out = docs.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(None).cast(f.dataType).alias(f.name) for f in state])

    def searching(shared: Shared):
        def run(batches):
            search = shared.built(_searcher, keep=1).search
            for batch in batches:
                s, k, n = [], [], []
                for t, old, old_names in zip(batch.column(text), batch.column(spans).to_pylist(), batch.column(names).to_pylist(), strict=True):
                    words = words_of(t.as_py())
                    at, items = list(zip(*[iter(old or [])] * 2, strict=True)), set(old_names or [])
                    for a, b, who in search(words):
                        at.append((a, b))
                        items.update(who)
                    s.append([x for span in merged(at) for x in span])
                    k.append(sorted(items))
                    n.append(len(words))
                columns = [pa.array(s, pa.list_(pa.int64())), pa.array(k, pa.list_(pa.string())), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *columns], [*kept, spans, names, total])

        return run

    blocks = _blocks(benchmark, item, item_text, window, block)
    now, before = next(blocks, []), None
    while now is not None:
        after = next(blocks, None)
        shared = Shared(docs.sparkSession, (window, now))
        out = mapped(out, searching(shared), schema)
        if after is not None:  # one block at a time: its table is gone before the next one's is built
            out = materialize(out, "decontaminate-state")
            shared.sent.destroy()
            discard(before)
            before = out
        now = after
    n_hit = F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)
    columns = [F.col(f"`{c}`") for c in kept if keep_text or c != text]
    out = out.select(*columns, F.col(total).alias("n_words"), n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"), F.col(names).alias("items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), F.col(spans).alias("hit_spans"))
    return reads(out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))), before)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), keep_text=False)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
WITH low AS (SELECT doc_id, row_number() OVER () AS uid, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, uid, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM low),
b AS (SELECT item_id::VARCHAR AS item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
pat AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM pat),
win AS (SELECT uid, m, i, array_to_string(w[i:i + m - 1], ' ') AS p FROM (SELECT uid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)),
occ AS (SELECT win.uid, win.i, win.m, pat.item_id FROM win JOIN pat USING (m, p)),
hit AS (SELECT uid, count(DISTINCT j) AS n_hit FROM (SELECT uid, unnest(range(i, i + m)) AS j FROM (SELECT DISTINCT uid, i, m FROM occ)) GROUP BY uid),
its AS (SELECT uid, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h FROM (SELECT DISTINCT uid, item_id FROM occ) GROUP BY uid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (uid) LEFT JOIN its USING (uid)
"""
