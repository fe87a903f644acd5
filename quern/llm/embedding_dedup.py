"""Embedding near-duplicates: randomised-rotation binary codes with stored correction factors.

A valid vector is rotated by seeded random orthogonal matrices. For each rotation its code is stored, the packed signs of the rotated
coordinates, with the inner product of the vector with its own code as correction factor; and, for the vector as a query, the
rotated coordinates rounded at random to QUERY_BITS bits, as packed bit planes. The product of a query with another vector's code
is counted from the bits of planes and code; divided by the factor it is an unbiased estimate of their cosine, with a
confidence bound that follows from the factor and the rounding. Pairs whose upper bound is below the threshold are
rejected; all others are computed again exactly, in double precision.

Candidates (per label and dimension) share a group of sign bits of further rotations. Bits per band grow with the logarithm of the largest label and bands grow so
that a pair at the threshold is missed with probability MISS at most. Equal vectors, compared by all their components, are one class from the start. A bucket beyond
BLOCK classes is compared in blocks against blocks by separate tasks, twice: codes alone tell which members have an open pair, and of those
members only the vectors are fetched. A block yields one row per class with links, never pairs: its links not seen in an earlier band,
and the root of its component within the block.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component, and rows with a null label,
have no links and are their own component; repeated rows count as separate vectors; vectors of different lengths do not link;
a null vec_id is larger than all others and stays null; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import discard, mapped, materialize, reads, ship, table
from quern.llm.components import components, roots

COSINE = 0.98
EPSILON = 6.0  # of the confidence bound; the chance of a wrong rejection is below 1e-7
CODE_BITS = 256  # of a code at least: as many rotations as that takes
QUERY_BITS = 4
CODES = 1 << 20  # rotations from this seed on are for codes, those from 0 on for bands
STRIP = 64  # queries that are estimated against a block at a time
MISS = 1e-5
BUCKET, BLOCK = 256, 1024
LAST = (1 << 63) - 1


@lru_cache(maxsize=64)
def rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def plan_bands(largest: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits in a band, bands) for a label of that many vectors."""
    bits = max(4, math.ceil(math.log2(max(2, largest) / BUCKET)))
    same = 1 - math.acos(min(1.0, cosine)) / math.pi
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-(same**bits))))


def signs(unit: np.ndarray, need: int) -> np.ndarray:
    """At least `need` sign bits of each row, from as many rotations as that takes."""
    dim = unit.shape[1]
    return np.hstack([unit @ rotation(dim, i).T > 0 for i in range(-(-need // dim))])


def _packed(bits: np.ndarray) -> np.ndarray:
    """(rows, dim) of booleans -> (rows, words) of 64 bits."""
    data = np.packbits(bits, axis=1, bitorder="little")
    return np.pad(data, ((0, 0), (0, -data.shape[1] % 8))).view(np.uint64)


def rotations(dim: int) -> int:
    return -(-CODE_BITS // dim)


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, rotations, words), factors (rows, rotations), planes (rows, rotations, QUERY_BITS, words), least and step (rows, rotations, 2)."""
    n, dim = unit.shape
    rng = np.random.default_rng(17)
    code, factor, plane, scale = [], [], [], []
    for r in range(rotations(dim)):
        turned = unit @ rotation(dim, CODES + r).T
        code.append(_packed(turned > 0))
        factor.append(np.abs(turned).sum(axis=1) / math.sqrt(dim))
        least = turned.min(axis=1)
        step = np.maximum((turned.max(axis=1) - least) / ((1 << QUERY_BITS) - 1), 1e-300)
        level = np.clip(np.floor((turned - least[:, None]) / step[:, None] + rng.random(turned.shape)), 0, (1 << QUERY_BITS) - 1).astype(np.uint8)
        plane.append(np.stack([_packed(level >> b & 1) for b in range(QUERY_BITS)], axis=1))
        scale.append(np.stack([least, step], axis=1))
    return tuple(np.stack(x, axis=1) for x in (code, factor, plane, scale))


def estimates(dim: int, code: np.ndarray, factor: np.ndarray, plane: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of queries (plane, scale) with coded vectors (code, factor), and their standard deviations; from bit counts."""
    total, variance = np.zeros((len(plane), len(code)), np.float32), np.zeros((len(plane), len(code)), np.float32)
    for r in range(code.shape[1]):
        inner = np.zeros(total.shape, np.uint16)
        for w in range(code.shape[2]):
            for b in range(QUERY_BITS):
                inner += np.bitwise_count(plane[:, None, r, b, w] & code[None, :, r, w]).astype(np.uint16) << np.uint16(b)
        ones = np.bitwise_count(code[:, r]).sum(axis=1, dtype=np.float32)
        levels = (np.bitwise_count(plane[:, r]).sum(axis=2, dtype=np.float32) * (1 << np.arange(QUERY_BITS))).sum(axis=1)
        least, step, f = scale[:, r, 0, None], scale[:, r, 1, None], factor[None, :, r]
        product = 2 * (least * ones + step * inner) - (least * dim + step * levels[:, None])
        total += (product / math.sqrt(dim) / f).astype(np.float32)
        variance += (((1 - f**2).clip(0) / max(1, dim - 1) + step**2 / 4) / f**2).astype(np.float32)
    return total / code.shape[1], np.sqrt(variance) / code.shape[1]


_CODE = ["code", "factor", "plane", "scale"]
_CODED = [T.StructField("code", T.ArrayType(T.LongType())), T.StructField("factor", T.ArrayType(T.DoubleType())), T.StructField("plane", T.ArrayType(T.LongType())), T.StructField("scale", T.ArrayType(T.DoubleType()))]
_KEYED = T.StructType([T.StructField("node", T.LongType()), T.StructField("label", T.StringType()), T.StructField("dim", T.IntegerType()), T.StructField("bands", T.ArrayType(T.LongType())), *_CODED])


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.abs(x).max(axis=1, keepdims=True)  # large and small components must not overflow


def _matrix(column, rows: int) -> np.ndarray:
    """A column of lists of one length."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(rows, -1)


def _coded(bits: int, bands: int):
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches):
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():  # few
                part = batch.filter(pa.array(dims == dim))
                x = _scaled(_matrix(part.column("vec"), part.num_rows))
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                keys = signs(unit, bits * bands)[:, : bits * bands].reshape(len(unit), bands, bits) @ weights
                made = [keys, *codes(unit)]
                lists = [pa.array(list(m.reshape(len(unit), -1).view(np.int64) if m.dtype == np.uint64 else m.reshape(len(unit), -1))) for m in made]
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("label"), part.column("dim"), *lists], _KEYED.names)

    return run


def open_pairs(found: pa.Table, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the pairs of a left with a right member whose upper bound reaches the threshold; each pair once."""
    side, dim, n = np.asarray(found.column("side")), found.column("dim")[0].as_py(), found.num_rows
    r = rotations(dim)
    code, plane = (_matrix(found.column(c), n).view(np.uint64) for c in ("code", "plane"))
    code, plane = code.reshape(n, r, -1), plane.reshape(n, r, QUERY_BITS, -1)
    factor, scale = _matrix(found.column("factor"), n), _matrix(found.column("scale"), n).reshape(n, r, 2)
    left, right, same = np.flatnonzero(side != 1), np.flatnonzero(side != 0), bool((side == 2).all())
    out = [(np.empty(0, int), np.empty(0, int))]
    for s in range(0, len(left), STRIP):
        own = left[s : s + STRIP]
        to = right[right > own[0]] if same else right
        estimate, deviation = estimates(dim, code[to], factor[to], plane[own], scale[own])
        ok = estimate + EPSILON * deviation >= cosine
        if same:
            ok &= own[:, None] < to[None, :]
        i, j = np.nonzero(ok)
        out.append((own[i], to[j]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _open(cosine: float, names: list[str]):
    """The members of a block pair that have a pair which the bound leaves open."""

    def run(found: pa.Table) -> pa.Table:
        return found.select(names).take(pa.array(np.unique(np.concatenate(open_pairs(found, cosine)))))

    return run


def exact(x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines in double precision, in pieces."""
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    out = np.empty(len(i))
    for s in range(0, len(i), 20_000):
        a, b = i[s : s + 20_000], j[s : s + 20_000]
        out[s : s + 20_000] = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b])
    return out


def _linked(cosine: float):
    """The open pairs of a block pair, decided on the vectors: a row for each class with links that no earlier band has."""

    def run(found: pa.Table) -> pa.Table:
        node, copies = np.asarray(found.column("node")), np.asarray(found.column("copies"))
        keys, band = _matrix(found.column("bands"), len(node)), found.column("band")[0].as_py()
        i, j = open_pairs(found, cosine)
        good = exact(_scaled(_matrix(found.column("vec"), len(node))), i, j) >= cosine
        i, j = i[good], j[good]
        if band and len(i):
            new = np.concatenate([~(keys[i[s : s + 50_000], :band] == keys[j[s : s + 50_000], :band]).any(axis=1) for s in range(0, len(i), 50_000)])
            i, j = i[new], j[new]
        add = np.bincount(i, weights=copies[j], minlength=len(node)) + np.bincount(j, weights=copies[i], minlength=len(node))
        root = roots(len(node), i, j)
        at = np.flatnonzero(add > 0)
        return pa.table({"node": pa.array(node[at]), "root": pa.array(node[root[at]]), "links": pa.array(add[at].astype(np.int64))})

    return run


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) for every row."""
    v = F.col("vec")
    rows = vectors.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST)).alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vec"))
    fine = v.isNotNull() & F.col("label").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False))).withColumn("vec", F.transform("vec", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))  # -0.0 is 0.0
    # the hash spares comparisons; the vector itself is a key too, so classes are exact
    equal = ["h", "label", "vec"]
    valid = rows.filter("fine").select("id", F.xxhash64("label", "vec").alias("h"), "label", "vec")
    classes = valid.groupBy(*equal).agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("rep"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("node"), *equal, F.size("vec").alias("dim"), "copies", "rep"), "rabitq-classes")
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, bands = plan_bands(largest, cosine)
    keyed = materialize(mapped(classes.select("node", "label", "dim", "vec"), _coded(bits, bands), _KEYED), "rabitq-codes")
    bucket, place = ["label", "dim", "band", "at"], ["i", "j", "side"]
    placed = keyed.select("node", "label", "dim", F.posexplode("bands").alias("band", "at"))
    sizes = placed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK)
    own = F.pmod(F.xxhash64("node", F.lit(3)), blocks)
    meets = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.struct(F.least(o, own).alias("i"), F.greatest(o, own).alias("j"), F.when(o == own, 2).when(o > own, 0).otherwise(1).alias("side")))
    spread = placed.join(sizes, bucket).withColumn("meet", F.explode(meets)).select(*bucket, *[F.col(f"meet.{c}").alias(c) for c in place], "node")
    ship(vectors.sparkSession)
    groups, schema = [*bucket, "i", "j"], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spread.schema)
    opened = materialize(spread.join(keyed.select("node", *_CODE), "node").groupBy(*groups).applyInArrow(_open(cosine, spread.columns), schema), "rabitq-open")
    members = opened.join(keyed.select("node", "bands", *_CODE), "node").join(classes.select("node", "copies", "vec"), "node")
    linked = materialize(members.groupBy(*groups).applyInArrow(_linked(cosine), "node long, root long, links long"), "rabitq-links")
    comp = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")), "rabitq-components")
    n_links = linked.groupBy("node").agg(F.sum("links").alias("more"))
    named = classes.select("node", *equal, "rep", "copies").join(n_links, "node", "left").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select(*equal, (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id")
    single = rows.filter("NOT fine").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    done = materialize(valid.join(named, equal).select("id", "n_links", "component_id").unionByName(single), "rabitq-result")
    for scratch in (classes, keyed, opened, linked, comp):
        discard(scratch)
    real = lambda c: F.when(c != LAST, c)
    component = F.col("component_id")
    return reads(done.select(real(F.col("id")).alias(key), "n_links", real(component).alias("component_id"), (F.col("id") == component).alias("kept")), done)


def op8_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: Brute force over all pairs of a label; fit for small tables.
SQL = r"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON pairs.a = reach.b),
comp AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
n AS (SELECT a AS r, count(*) AS n_links FROM pairs GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept FROM v JOIN comp USING (r) LEFT JOIN n USING (r)
"""
