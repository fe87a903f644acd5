"""Token counts by a map-side two-tier lookup.

A byte-level BPE encodes each pre-token by itself, so a text's count is the sum of its pre-tokens' counts.
Tier one is a compact table of frequent pre-tokens' lengths, broadcast once (at most HEAD entries, found in
a sample of about SAMPLE documents; it only saves work, no count depends on it). Tier two is a cache in each
Python worker, of at most CACHE entries, filled by encoding what tier one misses. Pre-tokens never leave the
task that found them, so nothing is shuffled.

Texts whose characters all lie below U+0300 are split by the pattern of the tokenizer's own pre-tokenizer; for others
the library's pre-tokenizer gives the pieces, so differences between Unicode versions cannot matter. The string
of an added token inside a text is that token, as the library has it by default.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows and ids are counted each by itself;
an empty table gives an empty result; columns of the input are kept unless a computed column has their name.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import Shared, mapped, table

LIMIT = 1024
SAMPLE = 4096
HEAD = 65_536
CACHE = 400_000
LONGEST = 64  # characters of a pre-token that is kept in a cache

#: The pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """A tokenizer file with its pattern and the worker's cache; count() is exact for any text."""

    def __init__(self, path: str, head: dict[str, int] | None = None):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(regex.escape(a) for a in sorted(added, key=len, reverse=True))) if added else None
        self.find = regex.compile(PATTERN).findall
        self.wide = regex.compile(r"[^\x00-˿]").search
        encoder, lengths = self, head or {}

        class Cache(dict):
            """The second tier: filled by encoding, emptied when full."""

            def __missing__(self, piece: str) -> int:
                n = len(encoder.tok.encode(piece, add_special_tokens=False).ids)
                if len(piece) <= LONGEST:
                    if len(self) >= CACHE:
                        self.clear()
                    self[piece] = n
                return n

        class Head(dict):
            """The first tier: what it lacks goes to the cache and is not kept here."""

            def __missing__(self, piece: str) -> int:
                return encoder.cache[piece]

        self.cache = Cache()
        self.look_up = Head(lengths).__getitem__

    def pieces(self, text: str) -> list[str]:
        if self.wide(text) is None:
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.added is None or self.added.search(text) is None:
            return sum(map(self.look_up, self.pieces(text)))
        parts = self.added.split(text)
        return len(parts) - 1 + sum(sum(map(self.look_up, self.pieces(p))) for p in parts if p)


def _encoder(value: tuple[str, dict[str, int]]) -> Encoder:
    return Encoder(*value)


def _head(docs: DataFrame, path: str, text: str, sample: int, most: int) -> dict[str, int]:
    """The `most` commonest pre-tokens of about `sample` documents, with their lengths. Their counts are summed across all tasks."""
    n = docs.count()
    every = max(1, n // max(1, sample))
    column = F.col(f"`{text}`")
    # copies of one text are dealt apart by the row's number
    chosen = docs.filter(F.pmod(F.xxhash64(column, F.monotonically_increasing_id()), F.lit(every)) == 0).select(column.alias("text"))

    def counted(batches):
        encoder, counts = Encoder(path), Counter()

        def summed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["piece", "n"])

        for batch in batches:
            for t in batch.column(0):
                if t.is_valid:
                    counts.update(p for p in encoder.pieces(t.as_py()) if len(p) <= LONGEST)
                    if len(counts) > CACHE:
                        yield summed()
                        counts.clear()
        yield summed()

    rows = mapped(chosen, counted, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(most).select("piece").toArrow()
    encoder = Encoder(path)
    return {p: len(encoder.tok.encode(p, add_special_tokens=False).ids) for p in rows.column(0).to_pylist()}


def count_tokens(docs: DataFrame, tokenizer: str | None = None, text: str = "text", limit: int = LIMIT, sample: int = SAMPLE, head: int = HEAD) -> DataFrame:
    """docs without the text, with n_bytes, n_tokens and over_limit."""
    path = tokenizer or default_tokenizer()
    shared = Shared(docs.sparkSession, (path, _head(docs, path, text, sample, head)))
    made = ["n_bytes", "n_tokens", "over_limit"]
    kept = [c for c in docs.columns if c.lower() not in made and c != text]
    # columns of the input stay in a struct, so that no name clashes
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("none")]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([slim.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def counted(batches):
        encoder = shared.built(_encoder)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for t in batch.column(1):
                s = t.as_py()
                n_bytes.append(len(s.encode()) if s else 0)
                n_tokens.append(encoder.count(s))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())], ["row", *made])

    return mapped(slim, counted, schema).select(*[F.col("row")[c].alias(c) for c in kept], *made)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
