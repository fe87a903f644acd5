"""Language-model scoring with a hidden Markov model over words.

Vocabulary counts of all training texts are summed across partitions. The TOP most frequent words (of at most HEAD_BYTES bytes) are symbols of their
own; any other word w is a symbol of its class g (CLASSES classes by the word's last two bytes) times
p(w | g) = (c + 1) / (N_g + V_g + 1) from its class's counts, where one unseen word takes the rest. The end
of a text is a symbol too. So the model is a distribution over texts, and the scaled forward recursion gives a
text's exact probability, whatever its length.

Baum-Welch: every round runs forward and backward over whole training texts in all partitions; each task sums its expected
counts (a table bounded by the symbols), and those are summed across tasks. Rounds end when the log-likelihood hardly rises.
Texts longer than SEGMENT are laid out as several segments; each segment's transfer matrix gives the exact forward vector it starts with and the backward vector it ends with.

Counts of words outside the HEAD most frequent, and of longer words, are joined by the word, pre-aggregated per document, so nothing that
grows with the vocabulary is broadcast or collected.

Defined cases: a null text is empty, and an empty text is its end alone; with no training text every token has base
probability 1 and symbols are uniform; repeated rows and ids are scored each by itself; an empty table gives an empty result;
other columns are kept unless a computed column has their name. Scores go to a written table that the result reads.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import Shared, discard, fold, mapped, materialize, table

STATES = 8
TOP, HEAD, CLASSES = 20_000, 200_000, 256
HEAD_BYTES = 64  # of a word in the head, which is broadcast: HEAD * HEAD_BYTES bytes at most
ROUNDS, TOLERANCE = 12, 1.25e-3  # rounds over all training texts, fewer when the log-likelihood rises by less than this share
SEGMENT = 1024  # tokens that one step of the recursion's layout may hold of a text; longer texts are several segments
BATCH_TOKENS = 500_000
PIECE = 2 << 20  # bytes of text that are split at a time
ROW_GROUP = 4 << 20  # of the coded texts: a small buffer to write, and rounds can split a large file
DISTINCT, DISTINCT_BYTES = 200_000, 16 << 20  # words that a task counts before it hands them on
FOLDS, HELD_OUT = 7, 2


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


class Layout:
    """Sequences side by side, by time: step t holds the symbols t of all sequences that are longer than t."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray, starts: np.ndarray | None = None):
        starts = np.cumsum(lengths) - lengths if starts is None else starts
        order = np.argsort(-lengths, kind="stable")
        sizes, starts = lengths[order], starts[order]
        total, longest = int(lengths.sum()), int(sizes[0]) if len(sizes) else 0
        self.active = len(sizes) - np.cumsum(np.bincount(sizes, minlength=longest + 1))[:longest]  # longer than t
        self.at = np.concatenate([[0], np.cumsum(self.active)]).astype(np.int64)
        rank = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        t = np.arange(total, dtype=np.int32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)
        place = self.at[t] + rank
        self.symbols = np.empty(total, np.int32)
        self.symbols[place] = flat[np.repeat(starts, sizes) + t]
        self.rank = np.empty(total, np.int32)
        self.rank[place] = rank
        self.last = self.at[np.maximum(sizes - 1, 0)] + np.arange(len(sizes))  # of each sequence, by rank
        self.order, self.n = order, len(sizes)


class Segments:
    """Texts cut for the layout only: a text's segments carry their forward and backward vectors to each other, so nothing is lost."""

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, np.int64)
        cuts = np.maximum(1, -(-lengths // SEGMENT))
        self.doc = np.repeat(np.arange(len(lengths)), cuts)
        self.nth = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        self.starts = np.repeat(np.cumsum(lengths) - lengths, cuts) + self.nth * SEGMENT
        self.sizes = np.minimum(np.repeat(lengths, cuts) - self.nth * SEGMENT, SEGMENT)
        self.several = np.flatnonzero(np.repeat(cuts > 1, cuts))

    def batches(self):
        """Positions of segments of like length, about BATCH_TOKENS at a time."""
        order = np.argsort(self.sizes, kind="stable")
        batch = np.cumsum(self.sizes[order]) // BATCH_TOKENS
        return [own for own in np.split(order, np.flatnonzero(np.diff(batch)) + 1) if self.sizes[own].sum()]


class Model:
    """start: (K,), move: (K, K), emit: (symbols, K). Work arrays are (K, tokens), so that a step runs along the sequences."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit
        self.by_state = np.ascontiguousarray(emit.T)

    def single(self) -> Model:
        """In single precision, for training."""
        return Model(*(x.astype(np.float32) for x in (self.start, self.move, self.emit)))

    def forward(self, lay: Layout, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled alphas (K, tokens) and scales, by time. start: (K, sequences by rank), the vectors that sequences start with."""
        alpha = np.take(self.by_state, lay.symbols, axis=1)
        scale = np.empty(alpha.shape[1], alpha.dtype)
        at, move = lay.at.tolist(), np.ascontiguousarray(self.move.T)
        for t in range(len(at) - 1):
            now, c = alpha[:, at[t] : at[t + 1]], scale[at[t] : at[t + 1]]
            now *= move @ alpha[:, at[t - 1] : at[t - 1] + len(c)] if t else start[:, : len(c)]
            np.add.reduce(now, axis=0, out=c)
            now /= c
        return alpha, scale

    def transfer(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """(K, K, segments), each up to a factor: row k is where the segment's recursion ends if it starts in state k alone."""
        k = len(self.start)
        out, move = np.empty((k, k, len(sizes))), np.ascontiguousarray(self.move.T)
        for s in range(0, len(sizes), 1024):
            lay = Layout(flat, sizes[s : s + 1024], starts[s : s + 1024])
            now = np.zeros((k, k, lay.n), self.move.dtype)
            now[np.arange(k), np.arange(k)] = 1
            at = lay.at.tolist()
            for t in range(len(at) - 1):
                own = now[:, :, : at[t + 1] - at[t]]
                made = move @ own if t else own
                np.multiply(made, np.take(self.by_state, lay.symbols[at[t] : at[t + 1]], axis=1), out=own)
                if t % 4 == 3:
                    own /= own.max(axis=(0, 1))
            out[:, :, s + lay.order] = now
        return out

    def borders(self, flat: np.ndarray, seg: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(K, segments) each: the forward vector that a segment starts with, the last alpha before it, and the beta at its end."""
        n, k = len(seg.sizes), len(self.start)
        start, prior, end = np.tile(self.start.astype(float)[:, None], (1, n)), np.zeros((k, n)), np.ones((k, n))
        if len(seg.several):
            own = seg.several
            m = self.transfer(flat, seg.starts[own], seg.sizes[own])
            nth = seg.nth[own]
            by_nth = np.split(np.argsort(nth, kind="stable"), np.cumsum(np.bincount(nth))[:-1])
            for at in by_nth[1:]:
                before = np.einsum("kn,kln->ln", start[:, own[at - 1]], m[:, :, at - 1])
                prior[:, own[at]] = before / before.sum(axis=0)
                start[:, own[at]] = self.move.T @ prior[:, own[at]]
            for at in reversed(by_nth[1:]):
                u = self.move @ np.einsum("kln,ln->kn", m[:, :, at], end[:, own[at]])
                end[:, own[at - 1]] = u / (prior[:, own[at]] * u).sum(axis=0)
        kind = self.start.dtype
        return start.astype(kind), prior.astype(kind), end.astype(kind)

    def log10(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 of each sequence's probability; memory does not grow with a text's length."""
        out = np.zeros(len(lengths))
        seg = Segments(lengths)
        start, _, _ = self.borders(flat, seg)
        for own in seg.batches():
            lay = Layout(flat, seg.sizes[own], seg.starts[own])
            own = own[lay.order]
            _, scale = self.forward(lay, start[:, own])
            np.add.at(out, seg.doc[own], np.bincount(lay.rank, weights=np.log10(scale), minlength=lay.n))
        return out

    def expected(self, flat: np.ndarray, lengths: np.ndarray, counts: dict[str, np.ndarray]) -> None:
        """Adds the expected counts of starts, moves and emissions over whole sequences, and the log-likelihood."""
        seg = Segments(lengths)
        start, prior, end = self.borders(flat, seg)
        for own in seg.batches():
            lay = Layout(flat, seg.sizes[own], seg.starts[own])
            own = own[lay.order]
            alpha, scale = self.forward(lay, start[:, own])
            ahead = np.take(self.by_state, lay.symbols, axis=1)  # becomes emission * beta / scale, and alpha the share of each state
            ahead /= scale
            full = seg.sizes[own] > 0
            last, u = lay.last[full], end[:, own[full]]
            alpha[:, last] *= u
            ahead[:, last] *= u
            at, moves = lay.at.tolist(), np.zeros_like(self.move)
            for t in range(len(at) - 3, -1, -1):
                nxt = ahead[:, at[t + 1] : at[t + 2]]
                here = slice(at[t], at[t] + nxt.shape[1])
                moves += alpha[:, here] @ nxt.T
                beta = self.move @ nxt
                alpha[:, here] *= beta
                ahead[:, here] *= beta
            later = np.flatnonzero(seg.nth[own] > 0)
            moves += prior[:, own[later]] @ ahead[:, later].T
            counts["move"] += moves * self.move
            counts["start"] += alpha[:, np.flatnonzero((seg.nth[own] == 0) & full)].sum(axis=1)
            for i in range(len(self.move)):
                counts["emit"][:, i] += np.bincount(lay.symbols, weights=alpha[i], minlength=len(self.emit))
            counts["loglik"] += np.log10(scale, dtype=np.float64).sum()


def zero_counts(symbols: int, k: int) -> dict[str, np.ndarray]:
    return {"start": np.zeros(k), "move": np.zeros((k, k)), "emit": np.zeros((symbols, k)), "loglik": np.zeros(1)}


def maximize(counts: dict[str, np.ndarray], prior: np.ndarray, weight: float = 50.0) -> Model:
    """The next model; emissions lean on the symbols' overall shares by a little, so that none is 0."""
    start = counts["start"] + 0.1
    move = counts["move"] + 0.1
    emit = counts["emit"] + weight * prior[:, None]
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def initial(prior: np.ndarray, k: int = STATES) -> Model:
    """Random emissions around the prior, sticky moves."""
    emit = prior[:, None] * np.random.default_rng(11).gamma(2.0, 0.5, (len(prior), k))
    return Model(np.full(k, 1 / k), np.full((k, k), 0.1 / k) + np.eye(k) * 0.9, emit / emit.sum(axis=0))


def _pieces(batch: pa.RecordBatch, text: int):
    """Parts of a batch with at most about PIECE bytes of text, so that memory does not grow with a batch's texts."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // PIECE
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A-Z lowered, and the position of each word's text; the white space is that of words_of()."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    full = np.asarray(pc.binary_length(words)) > 0
    doc = np.repeat(np.arange(len(texts)), np.asarray(lists.value_lengths()))
    return words.filter(pa.array(full)).cast(pa.binary()), doc[full]


def _count(batches):
    """Word counts of a task's pieces, handed on whenever there are DISTINCT words or DISTINCT_BYTES bytes of them."""
    words, counts, n, size = [], [], 0, 0

    def summed() -> pa.RecordBatch:
        coded = pa.concat_arrays(words).dictionary_encode()
        total = np.bincount(np.asarray(coded.indices), weights=np.concatenate(counts), minlength=len(coded.dictionary))
        return pa.RecordBatch.from_arrays([coded.dictionary, pa.array(total.astype(np.int64))], ["word", "c"])

    for batch in batches:
        for piece in _pieces(batch, 0):
            coded = split_words(piece.column(0))[0].dictionary_encode()
            words.append(coded.dictionary)
            counts.append(np.bincount(np.asarray(coded.indices), minlength=len(coded.dictionary)))
            n, size = n + len(coded.dictionary), size + coded.dictionary.nbytes
            if n >= DISTINCT or size >= DISTINCT_BYTES:
                yield summed()
                words, counts, n, size = [], [], 0, 0
    if n:
        yield summed()


_ENCODED = T.StructType([T.StructField("uid", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_head", T.LongType()), T.StructField("base_head", T.DoubleType()), T.StructField("rare_head", T.DoubleType()), T.StructField("symbols", T.ArrayType(T.ShortType())), T.StructField("tail", T.ArrayType(T.BinaryType())), T.StructField("tail_n", T.ArrayType(T.IntegerType()))])


class _Coder:
    """Codes texts, many at a time: head counts, symbols, and the counts of the words outside the head."""

    def __init__(self, value: tuple):
        words, counts, class_norm, top, end_count = value
        self.head = pa.array(words, pa.binary())
        self.top, self.known_end = top, int(end_count > 0)
        self.log_c = np.append(np.log10(counts + 1.0), 0.0)  # index -1: not in the head
        self.log_end, self.class_norm = float(np.log10(end_count + 1.0)), class_norm
        self.symbol = np.arange(len(words) + 1, dtype=np.int32)
        self.symbol[top:-1] = [top + class_of(w) for w in words[top:]]

    def __call__(self, texts: pa.Array) -> list[pa.Array]:
        words, doc = split_words(texts)
        lengths = np.bincount(doc, minlength=len(texts))
        ids = np.asarray(pc.fill_null(pc.index_in(words, value_set=self.head), -1), dtype=np.int32)
        total = lambda x: np.bincount(doc, weights=x, minlength=len(texts)).astype(float)
        missing = np.flatnonzero(ids < 0)
        tail = words.take(pa.array(missing)).dictionary_encode()
        at = np.asarray(tail.indices)
        symbols = self.symbol[ids]
        symbols[missing] = np.array([self.top + class_of(w) for w in tail.dictionary.to_pylist()], np.int32)[at]
        log_c, in_class = self.log_c[ids], symbols >= self.top
        rare = np.where(in_class, log_c, 0.0)
        rare[in_class] -= self.class_norm[symbols[in_class] - self.top]
        # an end after every text
        offsets = np.append(0, np.cumsum(lengths + 1))
        out = np.full(int(offsets[-1]), self.top + CLASSES, np.int16)
        out[np.arange(len(ids)) + doc] = symbols
        tail_doc = doc[missing]
        both, n = np.unique(tail_doc * max(1, len(tail.dictionary)) + at, return_counts=True)  # a row for each text and word
        ends = np.append(0, np.cumsum(np.bincount(both // max(1, len(tail.dictionary)), minlength=len(texts))))
        names = tail.dictionary.take(pa.array(both % max(1, len(tail.dictionary))))
        lists = lambda at, values: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values)
        return [
            pa.array(lengths + 1), pa.array(total(ids >= 0).astype(np.int64) + self.known_end), pa.array(total(log_c) + self.log_end), pa.array(total(rare)),
            lists(offsets, pa.array(out)), lists(ends, names), lists(ends, pa.array(n.astype(np.int32))),
        ]


def _encode(shared: Shared):
    """(uid, text, ...) -> _ENCODED and what else the batch has."""

    def run(batches):
        coder = shared.built(_Coder)
        for batch in batches:
            for piece in _pieces(batch, 1):
                yield pa.RecordBatch.from_arrays([piece.column(0), *coder(piece.column(1)), *piece.columns[2:]], [*_ENCODED.names, *piece.schema.names[2:]])

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(column.flatten()), np.asarray(column.value_lengths(), dtype=np.int64)


def _model(value: tuple) -> Model:
    return Model(*value)


def _expectations(shared: Shared, k: int):
    def run(batches):
        model = shared.built(_model).single()
        counts = zero_counts(len(model.emit), k)
        for batch in batches:
            model.expected(*_flat(batch.column(0)), counts)
        rows = np.vstack([counts["emit"], counts["move"], counts["start"][None], np.full((1, k), counts["loglik"][0] / k)])
        at = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *[pa.array(rows[at, i]) for i in range(k)]], ["row", *[f"k{i}" for i in range(k)]])

    return run


def _scored(shared: Shared):
    def run(batches):
        model = shared.built(_model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.log10(*_flat(batch.column(1))))], ["uid", "sequence"])

    return run


def baum_welch(training: DataFrame, model: Model, prior: np.ndarray, rounds: int, weight: float = 50.0, tolerance: float = TOLERANCE) -> tuple[Model, list[float]]:
    """Rounds over all rows of training (symbols), whose expected counts are summed across tasks; the log-likelihood before each.

    A round that raises the log-likelihood by less than the tolerance is the last.
    """
    s, k = model.emit.shape
    names, seen = [f"k{i}" for i in range(k)], []
    for _ in range(rounds):
        now = Shared(training.sparkSession, (model.start, model.move, model.emit))
        found = mapped(training.select("symbols"), _expectations(now, k), "row long, " + ", ".join(f"{n} double" for n in names))
        got = found.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toArrow()  # a row for each symbol
        sums = np.zeros((s + k + 2, k))
        sums[np.asarray(got.column("row"))] = np.stack([np.asarray(got.column(n)) for n in names], axis=1)
        model = maximize({"emit": sums[:s], "move": sums[s : s + k], "start": sums[s + k]}, prior, weight)
        seen.append(float(sums[s + k + 1].sum()))
        if len(seen) > 1 and seen[-1] - seen[-2] < tolerance * abs(seen[-1]):
            break
    return model, seen


def train_and_score(docs: DataFrame, train: Column, text: str = "text", k: int = STATES, rounds: int = ROUNDS, top: int = TOP, head: int = HEAD) -> DataFrame:
    """docs without the text, with n_tokens, n_known, train_tokens, base_score and score; `train` marks training rows."""
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != text]
    # columns of the input stay in a struct, so that no name clashes
    slim = docs.select(F.col(f"`{text}`").alias("text"), F.coalesce(train, F.lit(False)).alias("train"), F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(0).alias("none")]).alias("kept"))
    learned = slim.filter("train")
    n_docs = learned.count()
    class_ = F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(CLASSES)).cast("int")  # class_of()
    counts = materialize(mapped(learned.select("text"), _count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")).withColumn("g", class_), "hmm-counts")
    # the head is all short words of at least some count: the classes of counts (few) tell which, so that nothing else is sent
    short = F.length("word") <= HEAD_BYTES
    steps = counts.filter(short).groupBy(F.floor(F.log2("c") * 16).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).orderBy(F.desc("s")).collect()
    least, size = None, 0
    for r in steps:
        if (size := size + r["n"]) > head:
            break
        least = r["least"]
    words, c_head, g_head = [], np.zeros(0), np.zeros(0, int)
    if least is not None:
        found = counts.filter(short & (F.col("c") >= least)).orderBy(F.desc("c"), "word").select("word", "c", "g").toArrow()
        words, c_head, g_head = found.column("word").to_pylist(), np.asarray(found.column("c"), float), np.asarray(found.column("g"))
    top = min(top, len(words))
    n_words, v_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_all, v_all = n_words + n_docs, v_words + (n_docs > 0)
    n_g, v_g = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy("g").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        n_g[r["g"]], v_g[r["g"]] = r["c"], r["v"]
    n_g -= np.bincount(g_head[:top], weights=c_head[:top], minlength=CLASSES)
    v_g -= np.bincount(g_head[:top], minlength=CLASSES)
    prior = np.concatenate([c_head[:top], n_g + 1.0, [n_docs + 1.0]])
    prior /= prior.sum()
    coder = Shared(spark, (words, c_head, np.log10(n_g + v_g + 1.0), top, n_docs))
    # one plan gives each row its number, its own columns and its code, written at once: numbers cannot change later
    numbered = slim.select(F.monotonically_increasing_id().alias("uid"), "text", "train", "kept")
    schema = T.StructType([*_ENCODED.fields, *[numbered.schema[c] for c in ("train", "kept")]])
    encoded = materialize(mapped(numbered, _encode(coder), schema), "hmm-encoded", row_group=ROW_GROUP)
    training = encoded.filter("train").select("symbols")
    model = initial(prior, k)
    if n_docs:
        model, _ = baum_welch(training, model, prior, rounds)
    final = Shared(spark, (model.start, model.move, model.emit))
    sequence = mapped(encoded.select("uid", "symbols"), _scored(final), "uid long, sequence double")
    rest = (counts if least is None else counts.filter(~short | (F.col("c") < least))).select("word", "c")
    tail = encoded.select("uid", F.explode(F.arrays_zip("tail", "tail_n")).alias("x")).select("uid", F.col("x.tail").alias("word"), F.col("x.tail_n").alias("n"))
    tail = tail.join(rest, "word").groupBy("uid").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("tail_log"), F.sum(F.col("n").cast("long")).alias("n_tail"))
    out = encoded.drop("symbols", "tail", "tail_n").join(sequence, "uid").join(tail, "uid", "left")
    tail_log, n_tail = F.coalesce("tail_log", F.lit(0.0)), F.coalesce("n_tail", F.lit(0))
    made = {"n_tokens", "n_known", "train_tokens", "base_score", "score"}
    out = out.select(
        *[F.col("kept")[c].alias(c) for c in others if c.lower() not in made],
        "n_tokens",
        (F.col("n_head") + n_tail).cast("long").alias("n_known"),
        F.lit(int(n_all)).cast("long").alias("train_tokens"),
        (F.col("base_head") + tail_log - F.col("n_tokens") * F.lit(float(np.log10(n_all + 1.0 * (v_all + 1))))).alias("base_score"),
        (F.col("sequence") + F.col("rare_head") + tail_log).alias("score"),
    )
    done = materialize(out, "hmm-scores")  # without the texts, so small
    for table_ in (counts, encoded):
        discard(table_)
    return done


def op1_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    out = train_and_score(docs.withColumn("held_out", held_out), ~held_out)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
