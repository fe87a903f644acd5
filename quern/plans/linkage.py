"""The linkage of the derived entity tables, stage by stage; what several stages need is written once."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import audit, blocking, decide, features
from quern.operators.normalize import normalize
from quern.plans import fixtures
from quern.schema import POLICIES, PROFILES, Blocking
from quern.storage import materialize


class Linkage:
    def __init__(self, spark: SparkSession, sf_dir: str, profile: Blocking = PROFILES["fixture_evidence"]):
        self.spark, self.sf_dir, self.profile = spark, sf_dir, profile

    @cached_property
    def base(self) -> DataFrame:
        return materialize(fixtures.view(self.spark, self.sf_dir, "fx_base"), "base")

    def raw(self, n: int) -> DataFrame:
        return fixtures.view(self.spark, self.sf_dir, f"fx_source{n}", self.base)

    @cached_property
    def entities(self) -> DataFrame:
        return audit.with_source(self.raw(1), self.raw(2), self.raw(3))

    @cached_property
    def clean(self) -> DataFrame:
        """All three sources, cleaned, with source."""
        both = normalize(self.entities.drop("source")).withColumn("source", F.substring("entity_id", 1, 2))
        return materialize(both, "clean")

    @property
    def s1(self) -> DataFrame:
        return self.clean.filter("source = 'S1'").drop("source")

    @property
    def pool(self) -> DataFrame:
        return self.clean.filter("source <> 'S1'").drop("source")

    @cached_property
    def truth(self) -> DataFrame:
        return fixtures.view(self.spark, self.sf_dir, "fx_gt_pairs")

    @cached_property
    def truth_lists(self) -> DataFrame:
        return blocking.as_lists(self.truth, self.raw(1), "matched_entity_ids")

    @cached_property
    def scored(self) -> DataFrame:
        """(s1_id, cand_id, score), before the cap."""
        return blocking.scored(self.s1, self.pool, self.profile)

    @property
    def ranked(self) -> DataFrame:
        """The candidates, for a single reader: not written."""
        return blocking.ranked(self.s1, self.pool, self.profile, self.profile.top_k)

    @cached_property
    def candidates(self) -> DataFrame:
        return materialize(self.ranked, "candidates")

    @cached_property
    def vectors(self) -> DataFrame:
        """The 16 features and the 4 extra ones, with label and p."""
        ranked = blocking.with_ranks(self.candidates, "id")
        vectors = features.features(ranked, self.s1, self.pool, (*features.FEATURES, *features.EXTRA))
        return materialize(features.labelled(vectors, self.truth).withColumn("p", decide.linear_score()), "vectors")

    def matches(self, policy: str = "country") -> DataFrame:
        return decide.decide(self.vectors, POLICIES[policy])
