"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a text: its words, hashed into WORDS buckets, with log counts of unit length; statistics of its structure
(repetition, case, symbols, digits, lines, word lengths, compressibility), each cut into BINS bins; and metadata, the size
that the table states and its agreement with the text, binned too. A score is

    sigmoid(w0 + <w, x> + 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

where the second sum-of-squares form makes the pairwise interactions linear in the features. Training uses a bounded sample
of labelled rows (at most MAX_TRAIN, chosen by a hash of the id), whose features are made on the executors;
the model (a fixed size) is broadcast, and scoring is a map over whole texts without a shuffle.

Defined cases: a null or empty text has the features of no word and gets a score; a document with several labels counts with
their mean; without labelled rows, or with one class only, the score is the smoothed share of label 1 (0.5 without any); repeated rows and ids
are scored each by itself; an empty table gives an empty result; other columns are kept unless a computed column has their name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import Shared, fold, mapped, table

FOLDS, HELD_OUT = 5, 0
WORDS = 1 << 16
BINS = 12
RANK = 8
MAX_TRAIN = 8000
EPOCHS, BATCH = 12, 256
THRESHOLD = 0.3

_UPPER = bytes(range(0x41, 0x5B))
_DIGIT = bytes(range(0x30, 0x3A))
_SPACE = b" \t\n\r\x0b\x0c"
_MARKS = bytes(b for b in range(0x21, 0x7F) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))
_COMMON = b".,'-;:?!\"()"
_RARE = bytes(b for b in _MARKS if b not in _COMMON)

STATS = ("words", "mean_word", "distinct", "bigrams", "runs", "upper", "digits", "marks", "rare_marks", "lines", "same_lines", "short_lines", "zipped", "wide", "stated_size", "size_agrees")
FEATURES = WORDS + len(STATS) * BINS


def zipped(data: bytes) -> int:
    """Compressed size of all of it; memory does not grow with it."""
    c = zlib.compressobj(1)
    return sum(len(c.compress(data[i : i + (1 << 16)])) for i in range(0, len(data), 1 << 16)) + len(c.flush())


def statistics(text: str, words: list[bytes], hashes: np.ndarray, stated: int | None) -> np.ndarray:
    """Each from 0 to 1, in the order of STATS."""
    data = text.encode()
    n, size = len(words), max(1, len(data))
    share = lambda chars: (len(data) - len(data.translate(None, chars))) / size
    lines = text.split("\n")
    pairs = hashes[1:] * np.int64(31) + hashes[:-1]
    unique = lambda x: len(np.unique(x)) / len(x) if len(x) else 1.0
    solid = max(1, len(data) - len(data.translate(None, _SPACE)))
    return np.clip(
        [
            np.log2(1 + n) / 16,
            (size - solid) / max(1, n) / 16,
            unique(hashes),
            unique(pairs),
            float((hashes[1:] == hashes[:-1]).mean()) if n > 1 else 0.0,
            share(_UPPER) * 1.5,
            share(_DIGIT) * 4,
            share(_MARKS) * 2,
            share(_RARE) * 8,
            np.log2(1 + len(lines)) / 12,
            1 - len(set(lines)) / len(lines),
            sum(len(x) < 20 for x in lines) / len(lines),
            zipped(data) / size if data else 0.0,
            (len(data) - len(text)) / size * 2,
            np.log2(1 + max(0, stated)) / 20 if stated is not None else 0.0,
            1.0 if stated is not None and stated == len(text) else 0.0,
        ],
        0.0,
        1.0,
    )


def features(text: str | None, stated: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values; indices are distinct."""
    text = text or ""
    words = text.encode().lower().split()
    hashes = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    at, counts = np.unique(hashes % WORDS, return_counts=True)
    value = np.log1p(counts)
    value = value / max(1e-9, np.sqrt((value**2).sum()))
    bins = np.minimum((statistics(text, words, hashes, stated) * BINS).astype(np.int64), BINS - 1)
    own = WORDS + np.arange(len(STATS)) * BINS + bins
    return np.concatenate([at, own]), np.concatenate([value, np.ones(len(STATS))])


class FactorisationMachine:
    def __init__(self, w0: float = 0.0, w: np.ndarray | None = None, v: np.ndarray | None = None, size: int = FEATURES, rank: int = RANK, seed: int = 5):
        self.w0 = w0
        self.w = np.zeros(size) if w is None else w
        self.v = np.random.default_rng(seed).normal(0, 0.01, (size, rank)) if v is None else v

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[at] * x[:, None]
        return float(self.w0 + self.w[at] @ x + 0.5 * ((vx.sum(axis=0) ** 2) - (vx**2).sum(axis=0)).sum())

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Of many rows at once; each has a feature at least."""
        out, start, size = [], 0, 0
        for end in range(1, len(rows) + 1):
            size += len(rows[end - 1][0])
            if size > 100_000 or end == len(rows):
                at, x = (np.concatenate([r[i] for r in rows[start:end]]) for i in (0, 1))
                sizes = np.array([len(r[0]) for r in rows[start:end]])
                first = np.cumsum(sizes) - sizes
                vx = self.v[at] * x[:, None]
                pairs = (np.add.reduceat(vx, first) ** 2 - np.add.reduceat(vx**2, first)).sum(axis=1)
                out.append(self.w0 + np.add.reduceat(self.w[at] * x, first) + 0.5 * pairs)
                start, size = end, 0
        raw = np.concatenate(out) if out else np.empty(0)
        return 1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 2e-4) -> FactorisationMachine:
        """Adagrad on the logistic loss, in batches; the same rows give the same model."""
        rng = np.random.default_rng(7)
        p = (labels.sum() + 0.5) / (len(labels) + 1)
        self.w0 = float(np.log(p / (1 - p)))
        gw, gv, g0 = np.full(len(self.w), 1e-3), np.full(self.v.shape, 1e-3), 1e-3
        if len(labels) == 0 or labels.min() == labels.max():
            return self
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for s in range(0, len(order), BATCH):
                own = order[s : s + BATCH]
                sizes = np.array([len(rows[i][0]) for i in own])
                at, x = np.concatenate([rows[i][0] for i in own]), np.concatenate([rows[i][1] for i in own])
                doc, starts = np.repeat(np.arange(len(own)), sizes), np.cumsum(sizes) - sizes
                v = self.v[at]
                vx = v * x[:, None]
                total = np.add.reduceat(vx, starts)
                raw = self.w0 + np.add.reduceat(self.w[at] * x, starts) + 0.5 * (total**2 - np.add.reduceat(vx**2, starts)).sum(axis=1)
                err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[own]) / len(own)
                ex = err[doc] * x
                used, where = np.unique(at, return_inverse=True)
                dw = np.bincount(where, ex) + decay / 10 * self.w[used]
                gw[used] += dw**2
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                dv_rows = ex[:, None] * (total[doc] - vx)
                dv = np.stack([np.bincount(where, dv_rows[:, f]) for f in range(v.shape[1])], axis=1) + decay / 10 * self.v[used]
                gv[used] += dv**2
                self.v[used] -= rate / 2 * dv / np.sqrt(gv[used])
                d0 = err.sum()
                g0 += d0**2
                self.w0 -= rate * d0 / np.sqrt(g0)
        return self


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", stated: str | None = "n_chars", most: int = MAX_TRAIN) -> FactorisationMachine:
    """Learns from the labelled rows of docs, at most `most` of them."""
    id_, y = F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("double")
    marks = labels.select(id_, y.alias("y")).filter("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.avg("y").alias("y"))
    size = F.col(f"`{stated}`").cast("long") if stated else F.lit(None).cast("long")
    slim = docs.select(id_, size.alias("stated"), F.col(f"`{text}`").alias("text"))
    few = marks.join(slim.select("id").distinct(), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(most)
    # of rows with one id, always the same one
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "stated", "text")).alias("r")
    rows = slim.join(F.broadcast(few), "id").groupBy("id").agg(F.first("y").alias("y"), least).select("y", "r.stated", "r.text")

    def made(batches):
        for batch in batches:
            found = [features(t.as_py(), s.as_py()) for t, s in zip(batch.column("text"), batch.column("stated"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array([a for a, _ in found], pa.list_(pa.int32())), pa.array([x.astype(np.float32) for _, x in found], pa.list_(pa.float32()))], ["y", "at", "x"])

    got = mapped(rows, made, T.StructType([T.StructField("y", T.DoubleType()), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.FloatType()))])).toArrow()
    at, x = (got.column(n).combine_chunks() for n in ("at", "x"))
    data = sorted(((np.asarray(a.values, np.int64), np.asarray(b.values, float), y) for a, b, y in zip(at, x, got.column("y").to_pylist(), strict=True)), key=lambda r: (len(r[0]), r[0].tobytes(), r[1].tobytes(), r[2]))
    return FactorisationMachine().fit([(a, b) for a, b, _ in data], np.array([y for _, _, y in data], float))


def _machine(value: tuple) -> FactorisationMachine:
    return FactorisationMachine(*value)


def score(docs: DataFrame, model: FactorisationMachine, text: str = "text", stated: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """docs without the text, with score and predicted."""
    shared = Shared(docs.sparkSession, (model.w0, model.w, model.v))
    kept = [c for c in docs.columns if c != text and c.lower() not in ("score", "predicted")]
    size = F.col(f"`{stated}`").cast("long") if stated else F.lit(None).cast("long")
    # columns of the input stay in a struct, so that no name clashes
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("none")]).alias("row"), F.col(f"`{text}`").alias("text"), size.alias("stated"))
    fields = [slim.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

    def scored(batches):
        fm = shared.built(_machine)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = fm.scores([features(t.as_py(), s.as_py()) for t, s in zip(part.column(1), part.column(2), strict=True)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))], ["row", "score", "predicted"])

    return mapped(slim, scored, T.StructType(fields)).select(*[F.col("row")[c].alias(c) for c in kept], "score", "predicted")


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    model = train(docs.filter(~held_out), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
