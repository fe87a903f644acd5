"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. One pass over the texts makes, per document, its shingle set's hash and size, PERMS minima folded into band
   keys, and the minima's low bits packed into longs. Documents with the same set are one class from here on.
2. Classes that share a band key are candidates; the share of equal low bits, corrected for chance
   collisions, estimates the similarity, and pairs whose estimate is far below the threshold go.
3. First each class is compared with the least member of its buckets only (no pairs within a group), confirmed on the
   full sets, and linked classes are merged. Buckets that still hold several components are then compared in blocks of
   at most BLOCK classes and ITEMS shingles, twice: signatures tell which members have a candidate in another component, and of those
   members the full sets are brought together, all their candidate pairs decided exactly, and only a link per pair of
   components that meet is handed on. So links are complete for all candidates, while a group of any size yields rows in
   proportion to its members.

At 0.8, bands of 5 among 160 minima miss a pair with probability 3e-6.

Shingles are compared by 64-bit hashes. Defined cases: a text with fewer words than a shingle is one shingle; a null
text, or one without words, has none and links with nothing (its component is itself); rows with one id and one text are
copies; a null id is larger than all others and stays null; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import discard, free_name, mapped, materialize, reads, table
from quern.llm.components import components, roots

PERMS, ROWS, BITS = 160, 5, 4
BANDS = PERMS // ROWS
SLACK = 0.18  # below the threshold, over five standard deviations of the estimate
BLOCK, ITEMS = 1024, 1 << 19  # classes and shingles in a block at most, but for chance; two blocks are compared in some 50 MB
STRIP = 64  # rows whose signatures are compared with a block at a time
MANY = 5000  # candidate pairs of a block pair beyond which all its intersections are taken at once
BROADCAST_IDS = 1_000_000  # 8 MB
LAST = (1 << 63) - 1  # stands for a null id

_RNG = np.random.default_rng(20240601)
_A = (_RNG.integers(0, 1 << 32, PERMS, dtype=np.uint32) | np.uint32(1))[:, None]
_B = _RNG.integers(0, 1 << 32, PERMS, dtype=np.uint32)[:, None]
_C = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = 0x1111111111111111


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """The set of hashes of k words in a row, sorted."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b"\n".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - k + 1
    total = h[:n] * _C[0]
    for i in range(1, k):
        total = _mix(total) + h[i : n + i] * _C[i]
    return np.unique(_mix(total))


def sketch(found: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Hash of the set, band keys, packed low bits."""
    few = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full((PERMS, 1), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(few), 512):
        part = few[None, i : i + 512] * _A
        part += _B
        np.minimum(least, part.min(axis=1, keepdims=True), out=least)
    least = least[:, 0]
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = _mix(key * _C[0] + rows[:, i] + np.uint64(1))
    low = ((least * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint64).reshape(-1, 16)
    packed = (low << (np.arange(16, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)
    return xxhash.xxh3_64_intdigest(found.tobytes()), key, packed


_SKETCH = T.StructType([T.StructField("id", T.LongType()), T.StructField("sh", T.LongType()), T.StructField("n", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("sig", T.ArrayType(T.LongType()))])


def _sketches(k: int):
    def run(batches):
        for batch in batches:
            sh, size, keys, sigs = [], [], [], []
            for t in batch.column(1):
                found = shingles(t.as_py(), k)
                size.append(len(found))
                if len(found):
                    h, key, sig = sketch(found)
                    sh.append(h - (1 << 64) if h >> 63 else h)
                    keys.append(key.view(np.int64))
                    sigs.append(sig.view(np.int64))
                else:
                    sh.append(0)
                    keys.append(np.empty(0, np.int64))
                    sigs.append(np.empty(0, np.int64))
            lists = lambda x: pa.array(x, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sh, pa.int64()), pa.array(size, pa.int64()), lists(keys), lists(sigs)], _SKETCH.names)

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            sh, sets = [], []
            for t in batch.column(0):
                found = shingles(t.as_py(), k)
                h = xxhash.xxh3_64_intdigest(found.tobytes())
                sh.append(h - (1 << 64) if h >> 63 else h)
                sets.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(sh, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["sh", "items"])

    return run


def similarity(a: Column, b: Column) -> Column:
    """The estimate from packed low bits: equal share, less what chance makes equal."""

    def differ(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        return F.bit_count(z.bitwiseAND(F.lit(_LOW)))

    unequal = F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / (1 << BITS)
    return ((1 - unequal / F.lit(float(PERMS))) - chance) / (1 - chance)


def _similar(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same for all pairs of two sets of signatures."""
    unequal = np.zeros((len(a), len(b)), np.uint8)  # PERMS is below 256
    for i in range(a.shape[1]):
        z = a[:, None, i] ^ b[None, :, i]
        z |= z >> np.uint64(2)
        z |= z >> np.uint64(1)
        z &= np.uint64(_LOW)
        unequal += np.bitwise_count(z)
    chance = 1.0 / (1 << BITS)
    return ((1 - unequal / np.float32(PERMS)) - np.float32(chance)) / np.float32(1 - chance)


def _candidates(found: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions (i, j) of the pairs of two blocks of a bucket that may be similar and lie in two components, with the estimate."""
    side, comp, n = (np.asarray(found.column(c)) for c in ("side", "comp", "n"))
    sig = np.asarray(found.column("sig").combine_chunks().flatten()).view(np.uint64).reshape(len(n), -1)
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    same = bool((side == 2).all())
    out = []
    for s in range(0, len(left), STRIP):
        own = left[s : s + STRIP]
        est = _similar(sig[own], sig[right])
        nl, nr = n[own][:, None], n[right][None, :]
        ok = (est >= threshold - SLACK) & (np.minimum(nl, nr) >= threshold * np.maximum(nl, nr) - 1e-9) & (comp[own][:, None] != comp[right][None, :])
        if same:
            ok &= own[:, None] < right[None, :]
        i, j = np.nonzero(ok)
        out.append((own[i].astype(np.int32), right[j].astype(np.int32), est[i, j]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, int), np.empty(0, int), np.empty(0))


def _contested(threshold: float):
    """The members of a block pair that have a candidate in another component."""

    def run(found: pa.Table) -> pa.Table:
        i, j, _ = _candidates(found, threshold)
        at = np.unique(np.concatenate([i, j]))
        return found.select(["band", "i", "j", "side", "sh"]).take(pa.array(at))

    return run


def intersections(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all sets with each other, by products of 0/1 matrices over a few items at a time."""
    _, item, counts = np.unique(flat, return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(sizes)), sizes)
    shared = counts[item] > 1
    column = (np.cumsum(counts > 1) - 1)[item[shared]]
    member = member[shared]
    order = np.argsort(column, kind="stable")
    column, member = column[order], member[order]
    out = np.zeros((len(sizes), len(sizes)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 512):
        a, b = np.searchsorted(column, [start, start + 512])
        part = np.zeros((len(sizes), 512), np.float32)
        part[member[a:b], column[a:b] - start] = 1
        out += part @ part.T
    return out


def _exact_links(threshold: float, percent: int):
    """All candidate pairs of a block pair are decided on the full sets; a row for each component joined to another."""

    def run(found: pa.Table) -> pa.Table:
        i, j, est = _candidates(found, threshold)
        n = np.asarray(found.column("n"))
        items = found.column("items").combine_chunks()
        flat, sizes = np.asarray(items.flatten()), np.asarray(items.value_lengths(), dtype=np.int64)
        comps, at = np.unique(np.asarray(found.column("comp")), return_inverse=True)
        similar = lambda both, a, b: 100 * both >= percent * (n[a] + n[b] - both)
        if len(i) > MANY:
            both = intersections(flat, sizes)[i, j].astype(np.int64)
            link = similar(both, i, j)
            root = roots(len(comps), at[i[link]], at[j[link]])
        else:
            root, starts = np.arange(len(comps)), np.cumsum(sizes) - sizes
            for e in np.argsort(-est, kind="stable"):
                a, b = i[e], j[e]
                ra, rb = root[at[a]], root[at[b]]
                if ra != rb:
                    x, y = (flat[starts[k] : starts[k] + sizes[k]] for k in (a, b))
                    if similar(len(np.intersect1d(x, y, assume_unique=True)), a, b):
                        root[root == max(ra, rb)] = min(ra, rb)
        moved = root != np.arange(len(comps))
        return pa.table({"a": pa.array(comps[moved]), "b": pa.array(comps[root[moved]])})

    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of docs; links: 100 * intersection >= percent * union."""
    threshold = percent / 100
    slim = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"), F.col(text).alias("text"))
    feats = materialize(mapped(slim, _sketches(k), _SKETCH), "minhash-sketches")
    classes = materialize(feats.filter("n > 0").groupBy("sh").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sig").alias("sig")), "minhash-classes")
    banded = classes.select("sh", "n", F.explode("keys").alias("band"))
    several = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.min("sh").alias("pivot")).filter("size > 1")
    members = materialize(banded.drop("n").join(several, "band"), "minhash-members")
    sig = classes.select("sh", "n", "sig")
    as_ = lambda df, p: df.select(*[F.col(c).alias(p + c) for c in df.columns])
    stars = members.filter("sh <> pivot").groupBy(F.col("sh").alias("a"), F.col("pivot").alias("b")).agg((F.min("size") == 2).alias("alone"))
    stars = stars.join(as_(sig, "a_"), F.col("a") == F.col("a_sh")).join(as_(sig, "b_"), F.col("b") == F.col("b_sh"))
    est = similarity(F.col("a_sig"), F.col("b_sig"))
    stars = stars.filter(F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent).withColumn("est", est).filter(F.col("est") >= threshold - SLACK)
    # every pair that is a bucket by itself, and of the others each class's best: a class has at most BANDS of them
    found = stars.groupBy("a").agg(F.max(F.struct("est", "b"))["b"].alias("best"), F.collect_list(F.when(F.col("alone"), F.col("b"))).alias("own"))
    pairs = found.select("a", F.explode(F.array_distinct(F.concat(F.array("best"), "own"))).alias("b"))
    pairs = materialize(pairs.distinct(), "minhash-pairs")
    sets = _full_sets(slim, classes, pairs.select(F.col("a").alias("sh")).union(pairs.select(F.col("b").alias("sh"))), None, k)
    comp = _written(components(_confirmed(pairs, sets, percent), "minhash-components"), "minhash-component")
    blocks = _open_blocks(members.filter("size > 2"), sig, comp)
    contested = materialize(blocks.groupBy("band", "i", "j").applyInArrow(_contested(threshold), "band long, i long, j long, side int, sh long"), "minhash-contested")
    more = _full_sets(slim, classes, contested.select("sh"), sets, k)
    rows = _with_component(contested, comp).join(sig, "sh").join(sets.union(more), "sh")
    links = rows.select("band", "i", "j", "side", "comp", "n", "sig", "items").groupBy("band", "i", "j").applyInArrow(_exact_links(threshold, percent), "a long, b long")
    before, comp = comp, _merged(comp, links)
    final = _with_component(classes.select("sh", "rep"), comp)
    least = final.groupBy("comp").agg(F.min("rep").alias("component_id"))
    final = final.join(least, "comp").select("sh", "component_id")
    sized = feats.select("id", "n", "sh")
    # texts without words have no class: they stay out of the join, where they would all meet in one key
    out = sized.filter("n > 0").join(final, "sh").drop("sh").unionByName(sized.filter("n = 0").drop("sh").withColumn("component_id", F.col("id")))
    real = lambda c: F.when(c != LAST, c)
    done = materialize(out.select("id", "n", "component_id"), "minhash-result")
    for scratch in (feats, classes, members, pairs, sets, contested, more, before, comp):
        discard(scratch)
    component = F.col("component_id")
    return reads(done.select(real(F.col("id")).alias(key), F.col("n").alias("n_shingles"), real(component).alias("component_id"), (F.col("id") == component).alias("kept")), done)


def _with_component(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """rows (sh, ...) with comp; a class without a link is its own."""
    return rows.join(comp.withColumnRenamed("node", "sh"), "sh", "left").withColumn("comp", F.coalesce("component", "sh")).drop("component")


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components after links between components."""
    new = _written(components(links, "minhash-components"), "minhash-merge")
    to = new.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    kept = comp.join(to, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    out = materialize(kept.union(new.join(comp, "node", "left_anti").select("node", "component")), "minhash-component")
    discard(new)
    return out


def _written(found: DataFrame, name: str) -> DataFrame:
    """The components as one table, without the last step's links."""
    out = materialize(found, name)
    discard(found)
    return out


def _full_sets(slim: DataFrame, classes: DataFrame, wanted: DataFrame, known: DataFrame | None, k: int) -> DataFrame:
    """The full sets of the wanted classes (sh) that are not known yet, made again from the text of one document of each."""
    wanted = wanted.distinct()
    if known is not None:
        wanted = wanted.join(known, "sh", "left_anti")
    reps = materialize(classes.join(wanted, "sh", "left_semi").select(F.col("rep").alias("id")).distinct(), "minhash-reps")
    small = reps.count() <= BROADCAST_IDS
    texts = slim.join(F.broadcast(reps) if small else reps, "id", "left_semi").select("text")
    out = materialize(mapped(texts, _sets(k), "sh long, items array<long>").dropDuplicates(["sh"]), "minhash-sets")
    discard(reps)
    return out


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("sh").alias("a"), F.col("items").alias("x"))
    b = sets.select(F.col("sh").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    checked = pairs.join(a, "a").join(b, "b").select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).cast("long").alias("all"))
    return checked.filter(F.col("both") * 100 >= (F.col("all") - F.col("both")) * percent).select("a", "b")


def _open_blocks(members: DataFrame, sig: DataFrame, comp: DataFrame) -> DataFrame:
    """The buckets whose members lie in several components, dealt into pairs of blocks."""
    now = _with_component(members.select("band", "sh", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / ITEMS)).alias("blocks")), comp)
    open_ = now.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("band")
    rows = now.join(open_, "band", "left_semi").join(sig, "sh")
    blocks = F.col("blocks")
    own = F.pmod(F.xxhash64("sh", F.lit(7)), blocks)
    # block i meets block j once for i <= j: a row goes to (own, j) for j >= own and to (i, own) for i <= own
    meets = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.struct(F.least(o, own).alias("i"), F.greatest(o, own).alias("j"), F.when(o == own, 2).when(o > own, 0).otherwise(1).alias("side")))
    columns, zero = ["band", "meet.i", "meet.j", "meet.side", "sh", "comp", "n", "sig"], F.lit(0).cast("long")
    whole = rows.filter("blocks = 1").withColumn("meet", F.struct(zero.alias("i"), zero.alias("j"), F.lit(2).alias("side"))).select(*columns)
    return whole.union(rows.filter("blocks > 1").withColumn("meet", F.explode(meets)).select(*columns))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group: that of the least id; of rows repeated with that id, one for each text."""
    id_, hash_ = free_name(docs, "_id", "_hash")
    real = F.coalesce(F.col(key).cast("long"), F.lit(LAST))
    found = near_duplicates(docs, key, text, k, percent)
    kept = found.filter("kept").select(real.alias(id_)).distinct()
    own = docs.withColumns({id_: real, hash_: F.xxhash64(F.col(f"`{text}`"))})
    return reads(own.join(kept, id_, "left_semi").dropDuplicates([id_, hash_]).drop(id_, hash_), found)


def op10_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, k=2, percent=80)


#: Brute force over all pairs with a shingle in common; fit for small tables.
SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS (SELECT r, CASE WHEN len(w) = 1 THEN [w[1]] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w WHERE len(w) > 0),
cls AS (SELECT min(r) AS c, list_sort(s) AS s FROM sh GROUP BY list_sort(s)),
member AS (SELECT sh.r, cls.c FROM sh JOIN cls ON list_sort(sh.s) = cls.s),
items AS (SELECT c, len(s) AS n, unnest(s) AS x FROM cls),
pairs AS (SELECT a.c AS a, b.c AS b FROM items a JOIN items b ON a.x = b.x AND a.c <> b.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT c AS a, c AS b FROM cls UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON pairs.a = reach.b),
root AS (SELECT reach.a AS c, min(w.doc_id) AS component_id FROM reach JOIN member ON member.c = reach.b JOIN w ON w.r = member.r GROUP BY reach.a)
SELECT w.doc_id, coalesce(len(sh.s), 0)::BIGINT AS n_shingles, coalesce(root.component_id, w.doc_id) AS component_id, w.doc_id = coalesce(root.component_id, w.doc_id) AS kept
FROM w LEFT JOIN sh USING (r) LEFT JOIN member USING (r) LEFT JOIN root USING (c)
"""
