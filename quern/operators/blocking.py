"""Candidate generation: capped keys, scored by evidence, with a second pass for sparse queries.

A query meets thousands of candidates, so pairs are never shuffled nor written: queries are dealt into blocks, each key's posting
goes once to every block that has the key, and a block's pairs are summed and ranked there, a query at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.operators.keys import capped, keys
from quern.schema import Blocking
from quern.storage import mapped, materialize

KEY = ["kind", "country", "key"]
BLOCK_HITS = 32_000_000  # of a block's queries, about: its postings are fewer, since queries share them
TASK_HITS = 2_000_000  # worth a task of their own
ROWS = 200_000  # of an output batch


def _name() -> Column:
    """Names travel as 64-bit hashes; 0: no name."""
    return F.when(F.col("business_name_clean") != "", F.xxhash64("business_name_clean")).otherwise(F.lit(0)).alias("name")


def _postings(pool: DataFrame, profile: Blocking, kinds: tuple[str, ...], empty: bool) -> DataFrame:
    """(kind, country, key, n, cands): a row for each key within its cap, with the ids and names of its n entities."""
    # of rows with one id always the same one; pool_of() has decided already which source's it is
    rest = [c for c in pool.columns if c != "entity_id"]
    pool = pool.groupBy("entity_id").agg(F.max(F.struct(*rest)).alias("x")).select("entity_id", "x.*")
    p = capped(keys(pool, kinds, profile.min_num_len, allow_empty_country=empty, carry=(_name(),)), profile)
    return p.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.struct(F.col("entity_id").alias("id"), "name")).alias("cands"))


def _query_keys(queries: DataFrame, profile: Blocking, kinds: tuple[str, ...], empty: bool) -> DataFrame:
    return keys(queries, kinds, profile.min_num_len, query=True, allow_empty_country=empty, carry=(_name(),)).withColumnRenamed("entity_id", "s1_id")


class _Block:
    """The queries of a block, and the postings that they meet. Candidates are numbered in the order of their ids."""

    def __init__(self, batches: list[pa.RecordBatch]):
        flat = lambda i: pa.concat_arrays([b.column(i).flatten() for b in batches])
        sizes = lambda i: np.concatenate([np.asarray(b.column(i).value_lengths(), dtype=np.int64) for b in batches])
        self.weight = np.concatenate([np.asarray(b.column(1)) for b in batches])
        queries, self.size = flat(2).dictionary_encode("encode"), sizes(4)
        self.queries, of = queries.dictionary, np.asarray(queries.indices)
        order = np.argsort(of, kind="stable")
        self.rows, self.names = np.repeat(np.arange(len(self.weight)), sizes(2))[order], np.asarray(flat(3))[order]
        self.bounds = np.append(0, np.cumsum(np.bincount(of, minlength=len(self.queries)))).tolist()
        cands = flat(4).dictionary_encode("encode")
        order = pc.array_sort_indices(cands.dictionary, null_placement="at_start")
        self.cands, number = cands.dictionary.take(order), np.empty(len(order), np.int32)
        number[np.asarray(order)] = np.arange(len(order), dtype=np.int32)
        self.hits, self.at = number[np.asarray(cands.indices)], np.append(0, np.cumsum(self.size)).tolist()
        self.name_of = np.empty(len(order), np.int64)
        self.name_of[self.hits] = np.asarray(flat(5))
        self.total = np.zeros(len(order))

    def scores(self, q: int, bonus: float) -> tuple[np.ndarray, np.ndarray]:
        """A query's candidates by id, and their scores. A query id with several names gains by each over that row's keys."""
        rows, names = self.rows[self.bounds[q] : self.bounds[q + 1]], self.names[self.bounds[q] : self.bounds[q + 1]]
        parts = [self.hits[self.at[r] : self.at[r + 1]] for r in rows.tolist()]
        hits = np.concatenate(parts)
        np.add.at(self.total, hits, np.repeat(self.weight[rows], self.size[rows]))
        hits.sort()
        found = hits[np.append(True, hits[1:] != hits[:-1])]
        score = self.total[found]
        self.total[found] = 0
        if (names == names[0]).all():
            same = self.name_of[found] == names[0] if names[0] else None
        else:
            same = np.isin(found, np.concatenate([p[self.name_of[p] == n] for p, n in zip(parts, names, strict=True) if n]))
        if same is not None:
            score[same] += bonus
        return found, score


def _best(found: np.ndarray, score: np.ndarray, k: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The first k by (-score, id), in that order; found is in the order of ids."""
    if k is not None and len(found) > k:
        least = np.partition(score, len(score) - k)[len(score) - k] if k else np.inf
        above = score > least
        above[np.flatnonzero(score == least)[: k - int(above.sum())]] = True
        found, score = found[above], score[above]
    order = np.argsort(-score, kind="stable")
    return found[order], score[order]


def _ranking(k: int | None, bonus: float):
    """Rows sorted by block (block, weight, and the lists of queries, of their names, of candidates and of theirs) -> ranked pairs."""

    def ranked(batches: list[pa.RecordBatch]):
        block, out, n = _Block(batches), [], 0
        for q in range(len(block.queries)):
            found, score = _best(*block.scores(q, bonus), k)
            out.append((q, found, score))
            n += len(found)
            if n >= ROWS or q == len(block.queries) - 1:
                of, found, score = (list(x) for x in zip(*out, strict=True))
                lengths = [len(x) for x in found]
                rank = np.concatenate([np.arange(1, x + 1, dtype=np.int32) for x in lengths])
                yield pa.RecordBatch.from_arrays([block.queries.take(pa.array(np.repeat(of, lengths))), block.cands.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(score)), pa.array(rank)], ["s1_id", "cand_id", "score", "evidence_rank"])
                out, n = [], 0

    def run(batches):
        held, now = [], None
        for batch in batches:
            blocks = np.asarray(batch.column(0))
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if held and b > a and blocks[a] != now:
                    yield from ranked(held)
                    held = []
                if b > a:
                    now = blocks[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield from ranked(held)

    return run


def ranked(queries: DataFrame, pool: DataFrame, profile: Blocking, k: int | None = None, allow_empty_country: bool = True) -> DataFrame:
    """(s1_id, cand_id, score, evidence_rank): the best k of each query by (-score, id), or all. The score is the sum of weights;
    queries with fewer than sparse_below candidates also probe prefixes; candidates with the same non-empty clean name gain the bonus.

    A query's hits are bounded by its tokens times the caps, so no query is hot.
    """
    postings = materialize(_postings(pool, profile, tuple(dict.fromkeys((*profile.kinds, "prefix"))), allow_empty_country), "postings")
    lengths = postings.select(*KEY, "n")
    first = _query_keys(queries, profile, profile.kinds, allow_empty_country)
    reach = materialize(first.join(lengths, KEY).groupBy("s1_id").agg(F.sum("n").alias("hits"), F.max("n").alias("most")), "reach")
    # one posting that is long enough makes a query not sparse; the candidates of the others are few, and are counted
    ids = lambda df: df.select(F.col("s1_id").alias("entity_id"))
    rest = queries.join(ids(reach.filter(F.col("most") >= profile.sparse_below)), "entity_id", "left_anti")
    few = _query_keys(rest, profile, profile.kinds, allow_empty_country).join(postings.filter(F.col("n") < profile.sparse_below), KEY)
    enough = few.select("s1_id", F.explode("cands.id").alias("id")).groupBy("s1_id").agg(F.countDistinct("id").alias("n")).filter(F.col("n") >= profile.sparse_below)
    more = materialize(_query_keys(rest.join(ids(enough), "entity_id", "left_anti"), profile, ("prefix",), allow_empty_country), "sparse-keys")
    hits = sum(df.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for df, c in ((reach, "hits"), (more.join(lengths, KEY), "n")))
    n = max(1, -(-hits // BLOCK_HITS), min(2 * queries.sparkSession.sparkContext.defaultParallelism, hits // TASK_HITS))
    asked = first.unionByName(more).groupBy(F.pmod(F.xxhash64("s1_id"), F.lit(n)).alias("block"), *KEY).agg(F.collect_list(F.struct(F.col("s1_id").alias("id"), "name")).alias("asking"))
    weight = F.coalesce(*[F.when(F.col("kind") == kind, F.lit(float(w))) for kind, w in profile.weights.items()])
    met = asked.join(postings, KEY).select("block", weight.alias("weight"), "asking.id", F.col("asking.name").alias("name"), F.col("cands.id").alias("cand_id"), F.col("cands.name").alias("cand_name"))
    dealt = met.repartition(n, "block").sortWithinPartitions("block")
    return mapped(dealt, _ranking(k, profile.exact_bonus), "s1_id string, cand_id string, score double, evidence_rank int")


def scored(queries: DataFrame, pool: DataFrame, profile: Blocking, allow_empty_country: bool = True) -> DataFrame:
    """(s1_id, cand_id, score) of all pairs; see ranked()."""
    return ranked(queries, pool, profile, None, allow_empty_country).drop("evidence_rank")


def union_candidates(queries: DataFrame, pool: DataFrame, profile: Blocking) -> DataFrame:
    """(s1_id, cand_id) reached by any key; a query or entity without a country has none."""
    return scored(queries, pool, profile, allow_empty_country=False).select("s1_id", "cand_id")


def top_k(candidates: DataFrame, k: int, mode: str = "evidence") -> DataFrame:
    """The best k of each query by (-score, id), or the first k ids, or k by a hash of the id."""
    order = {"evidence": [F.desc("score"), F.asc("cand_id")], "id": [F.asc("cand_id")], "hash": [F.xxhash64("cand_id"), F.asc("cand_id")]}[mode]
    ranked = candidates.withColumn("evidence_rank", F.row_number().over(W.partitionBy("s1_id").orderBy(*order)))
    return ranked.filter(F.col("evidence_rank") <= k)


def with_ranks(candidates: DataFrame, mode: str = "id") -> DataFrame:
    """candidate_rank by id or by evidence, and the pool's size. Taken before candidates are joined away."""
    order = {"id": [F.asc("cand_id")], "evidence": [F.desc("score"), F.asc("cand_id")]}[mode]
    per = W.partitionBy("s1_id")
    return candidates.withColumns({"candidate_rank": F.row_number().over(per.orderBy(*order)), "total_candidates": F.count(F.lit(1)).over(per)})


def as_lists(pairs: DataFrame, queries: DataFrame, column: str, order: str = "cand_id") -> DataFrame:
    """One row for each query: its ids, comma-joined in order; empty if it has none."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), "cand_id"))), lambda x: x["cand_id"]), ",").alias(column))
    ids = queries.select(F.col("entity_id").alias("s1_id")).distinct()
    return ids.join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(column, F.lit("")).alias(column))


def cross_country(pairs: DataFrame, queries: DataFrame, pool: DataFrame) -> DataFrame:
    """Pairs whose countries differ; blocking must give none."""
    c = lambda df, i, n: df.select(F.col("entity_id").alias(i), F.col("country_clean").alias(n))
    return pairs.join(c(queries, "s1_id", "_a"), "s1_id").join(c(pool, "cand_id", "_b"), "cand_id").filter("_a <> _b").select("s1_id", "cand_id")
