"""Schemas and parameter profiles of the record-linkage engine."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ENTITY = strings("entity_id", "business_name", "business_address", "country")
GROUND_TRUTH = strings("source1_entity_id", "matched_entity_ids")
CANDIDATES = strings("source1_entity_id", "candidate_entity_ids")
CLEAN_COLUMNS = ("entity_id", "business_name", "business_address", "country", "business_name_clean", "business_address_clean", "country_clean", "address_numbers", "name_tokens", "name_significant_tokens", "address_tokens")


@dataclass(frozen=True)
class Blocking:
    """caps: postings longer than this are dropped whole; weights: score of a hit, by kind of key."""

    caps: dict[str, int]
    weights: dict[str, float]
    kinds: tuple[str, ...]
    top_k: int | None = None
    sparse_below: int = 5
    exact_bonus: float = 10.0
    min_num_len: int = 1


_EVIDENCE = {"name": 3.0, "addr": 1.5, "num": 2.0, "prefix": 1.0}
_COMPOSITE = {"exact": 15.0, "pair": 6.0, "name_num": 5.0, "addr_num": 4.0, "name": 3.0, "prefix": 1.0}
_SIMPLE = ("name", "addr", "num")
_JOINT = ("exact", "pair", "name_num", "addr_num", "name")

PROFILES: dict[str, Blocking] = {
    "union": Blocking({"name": 3000, "addr": 1000, "num": 1000, "prefix": 1000}, _EVIDENCE, _SIMPLE, min_num_len=2),
    "balanced": Blocking({"name": 1500, "addr": 500, "num": 500, "prefix": 500}, _EVIDENCE, _SIMPLE, 350, min_num_len=2),
    "evidence": Blocking({"name": 3000, "addr": 1000, "num": 1000, "prefix": 1000}, _EVIDENCE, _SIMPLE, 350),
    "emergency": Blocking({"name": 3000, "addr": 1500, "num": 1500, "prefix": 1500}, _EVIDENCE, _SIMPLE, 350),
    "composite": Blocking({"exact": 5000, "name": 3000, "pair": 3000, "name_num": 2000, "addr_num": 2000, "prefix": 1000}, _COMPOSITE, _JOINT, 500),
    "fixture_union": Blocking({"name": 40, "addr": 20, "num": 20, "prefix": 20}, _EVIDENCE, _SIMPLE, min_num_len=2),
    "fixture_evidence": Blocking({"name": 40, "addr": 20, "num": 20, "prefix": 20}, _EVIDENCE, _SIMPLE, 10),
    "fixture_composite": Blocking({"exact": 30, "name": 40, "pair": 20, "name_num": 20, "addr_num": 20, "prefix": 20}, _COMPOSITE, _JOINT, 10),
}


@dataclass(frozen=True)
class Policy:
    """A pair is matched if p reaches its country's threshold; fallback: else the best, if it reaches that."""

    default: float
    by_country: dict[str, float] = field(default_factory=dict)
    fallback: float | None = None
    fallback_everywhere: bool = False
    exact_name_from: float | None = None


POLICIES: dict[str, Policy] = {
    "global": Policy(0.35, fallback=0.30, fallback_everywhere=True),
    "country": Policy(0.35, {"US": 0.60, "India": 0.50}, fallback=0.30),
    "grid": Policy(0.20, {"US": 0.60, "India": 0.50}, fallback=0.15),
    "exact_name": Policy(0.20, {"US": 0.60, "India": 0.50}, fallback=0.15, exact_name_from=0.15),
}
