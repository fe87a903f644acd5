"""Blocking keys: from a cleaned entity to rows (entity_id, country, kind, key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import words_of
from quern.schema import Blocking

SEP = "\u0001"


def _sets(min_num_len: int) -> dict[str, Column]:
    distinct = lambda c, n: F.array_distinct(F.filter(words_of(F.col(c)), lambda t: F.length(t) >= n))
    return {"sig": distinct("name_significant_tokens", 2), "addr": distinct("address_tokens", 3), "num": distinct("address_numbers", min_num_len)}


def _pairs(tokens: Column, window: int) -> Column:
    """Neighbours up to `window` apart in a sorted array."""

    def of(t: Column, i: Column) -> Column:
        return F.transform(F.slice(tokens, i + 2, window), lambda u: F.concat(t, F.lit(SEP), u))

    return F.flatten(F.transform(tokens, of))


def _product(a: Column, b: Column) -> Column:
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.concat(x, F.lit(SEP), y))))


def key_arrays(min_num_len: int = 1, pair_window: int = 2, top_tokens: int = 3, query: bool = False) -> dict[str, Column]:
    """kind -> array of keys. On the query side prefixes repeat, once for each token that has them."""
    s = _sets(min_num_len)
    ordered = F.array_sort(s["sig"])
    prefixes = F.transform(F.filter(s["sig"], lambda t: F.length(t) >= 4), lambda t: F.substring(t, 1, 4))
    name = F.col("business_name_clean")
    return {
        "name": s["sig"], "addr": s["addr"], "num": s["num"], "prefix": prefixes if query else F.array_distinct(prefixes),
        "exact": F.when(name != "", F.array(name)).otherwise(F.array().cast("array<string>")),
        "pair": _pairs(ordered, pair_window), "name_num": _product(F.slice(ordered, 1, top_tokens), s["num"]), "addr_num": _product(s["addr"], s["num"]),
    }


def archived_arrays(pair_window: int = 2, top: int = 2, min_name_len: int = 3) -> dict[str, Column]:
    """The earlier variants: neighbours in the order of the text, each pair sorted; products of the first few tokens and numbers only."""
    tokens = lambda c, n: F.filter(words_of(F.col(c)), lambda t: F.length(t) >= n)
    sig, addr, num = tokens("name_significant_tokens", 2), tokens("address_tokens", 3), tokens("address_numbers", 1)
    pairs = F.transform(_pairs(sig, pair_window), lambda x: F.array_join(F.array_sort(F.split(x, SEP)), SEP))
    first = lambda c: F.slice(c, 1, top)
    found = {"name": F.filter(sig, lambda t: F.length(t) >= min_name_len), "pair": pairs, "name_num": _product(first(sig), first(num)), "addr_num": _product(first(addr), first(num))}
    return {kind: F.array_distinct(c) for kind, c in found.items()}


def keys(clean: DataFrame, kinds: tuple[str, ...], min_num_len: int = 1, query: bool = False, allow_empty_country: bool = True, carry: tuple[Column, ...] = (), arrays: dict[str, Column] | None = None, **how: int) -> DataFrame:
    """One explode for all kinds, so the entities are scanned once. carry: further columns of the entity; arrays: other keys than key_arrays()."""
    arrays = arrays or key_arrays(min_num_len, query=query, **how)

    def tagged(kind: str) -> Column:
        return F.transform(arrays[kind], lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("key")))

    all_ = F.concat(*map(tagged, kinds))
    rows = clean if allow_empty_country else clean.filter("country_clean <> ''")
    exploded = rows.select("entity_id", F.col("country_clean").alias("country"), *carry, F.explode(all_).alias("x"))
    return exploded.select(*[c for c in exploded.columns if c != "x"], "x.kind", "x.key")


def posting_stats(pool_keys: DataFrame) -> DataFrame:
    return pool_keys.groupBy("kind", "country", "key").agg(F.countDistinct("entity_id").alias("posting_count"))


def capped(pool_keys: DataFrame, profile: Blocking) -> DataFrame:
    """Postings whose length is within the cap; longer ones are dropped whole. The long keys are few
    (at most all postings / cap), so the anti join needs no shuffle of the postings when they fit a broadcast."""
    cap = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in profile.caps.items()])
    long_ = pool_keys.groupBy("kind", "country", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cap).select("kind", "country", "key")
    return pool_keys.join(long_, ["kind", "country", "key"], "left_anti")
