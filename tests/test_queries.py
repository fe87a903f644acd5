"""Every linkage query against its DuckDB oracle, or for rows where SQL cannot express it."""

import pytest

from quern.plans.oracles import ORACLES
from quern.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, oracle, same, name):
    got = QUERIES[name](spark, sf).toPandas()
    if name in ORACLES:
        same(got, oracle(ORACLES[name]))
    else:
        assert len(got) > 0
    if name in ("model_gbt", "model_challenger"):
        assert (got["f1"] >= 0.9).all() and (got["roc_auc"] >= 0.95).all()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
