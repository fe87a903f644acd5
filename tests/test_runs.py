"""Whole runs over files, the command line and experiments."""

import json

from quern.__main__ import main
from quern.plans import pipeline as run
from quern.plans.linkage import Linkage
from quern.schema import POLICIES, PROFILES
from quern.sources import tsv


def files(spark, sf, tmp_path):
    x = Linkage(spark, sf)
    for i in (1, 2, 3):
        tsv.write_tsv(x.raw(i).orderBy("entity_id").limit(60), f"file://{tmp_path}/s{i}")
    tsv.write_id_lists(x.truth_lists, f"file://{tmp_path}/truth")
    return [f"file://{tmp_path}/s{i}" for i in (1, 2, 3)], f"file://{tmp_path}/truth"


def test_command_line(spark, sf, tmp_path, capsys):
    (s1, s2, s3), truth = files(spark, sf, tmp_path)
    out = f"file://{tmp_path}/matches"
    match = ["match", "--s1", s1, "--pool", s2, s3, "--out", out, "--profile", "fixture_evidence"]
    assert main(match) == 0 and json.loads(capsys.readouterr().out)["queries"] == 60
    assert main(match) == 0 and json.loads(capsys.readouterr().out)["queries"] == 0  # resumed: nothing is left
    assert tsv.read_id_lists(spark, out).count() == 60
    assert main(["candidates", "--s1", s1, "--pool", s2, s3, "--out", f"file://{tmp_path}/cands", "--profile", "fixture_evidence"]) == 0
    capsys.readouterr()
    assert main(["evaluate", "--s1", s1, "--pool", s2, s3, "--truth", truth, "--profile", "fixture_evidence"]) == 0
    found = json.loads(capsys.readouterr().out)
    assert 0 < found["recall"] <= 1 and found["n_queries"] >= 60
    assert main(["audit", s1, s2]) == 0 and "## missing" in capsys.readouterr().out
    assert main(["clean", s1, "--out", f"file://{tmp_path}/clean"]) == 0
    assert main(["validate", out, "--s1", s1, "--candidates", f"file://{tmp_path}/cands"]) in (0, 1)
    assert "warning: 0 queries" in capsys.readouterr().out


def test_experiment_is_cached(spark, sf, tmp_path):
    x = Linkage(spark, sf)
    config = {"candidate_strategy": "fixture_evidence", "candidate_cap": 5, "threshold_us": 0.6, "threshold_india": 0.5, "threshold_other": 0.35, "fallback_thresh": 0.3, "posting_cap": 15}
    base = run.evaluate(x.s1, x.pool, x.truth, PROFILES["fixture_evidence"], POLICIES["country"])
    first = run.experiment(spark, str(tmp_path), "e1", "fewer candidates", config, x.s1, x.pool, x.truth, base)
    assert first["deltas"]["f05"] == first["metrics"]["f05"] - base["f05"]
    assert run.experiment(spark, str(tmp_path), "e1", "", {}, None, None, None) == first


def test_model_round_trip(spark, sf, tmp_path):
    from quern.operators import model

    v = Linkage(spark, sf).vectors
    fitted = model.train(v.drop("p"), rounds=3, depth=3)
    model.save(fitted, f"file://{tmp_path}/m")
    a, b = (model.score(m, v.drop("p")).agg({"p": "sum"}).first()[0] for m in (fitted, model.load(f"file://{tmp_path}/m")))
    assert abs(a - b) < 1e-9


def test_validation_of_files(spark, tmp_path):
    """Missing and empty files, bytes that are no UTF-8, a header that comes again, several parts."""
    from quern.operators import validate

    names = ("source1_entity_id", "matched_entity_ids")
    found = lambda at: {r["rule"]: (r["n"], r["examples"]) for r in validate.validate(spark, f"file://{at}", names).collect()}
    assert found(tmp_path / "none") == {"file": (1, "file is missing")}
    (tmp_path / "empty.tsv").write_bytes(b"")
    assert found(tmp_path / "empty.tsv") == {"file": (1, "file is empty")}
    head = "\t".join(names).encode()
    (tmp_path / "bad.tsv").write_bytes(head + b"\nS1-1\tS2-\xe9\nS1-2\tS2-2\n" + head + b"\nS1-3\tS2-\xc3\xa9\n")
    bad = found(tmp_path / "bad.tsv")
    assert bad["not_utf8"][0] == 1 and bad["repeated_header"][0] == 1 and set(bad) == {"not_utf8", "repeated_header"}
    (tmp_path / "parts").mkdir()
    for i in (1, 2):
        (tmp_path / "parts" / f"{i}.tsv").write_bytes(head + f"\nS1-{i}\tS2-{i}\n".encode())
    assert found(tmp_path / "parts") == {}
    lines = spark.createDataFrame([(f"S1-{i}\tS1-{i}",) for i in range(500)], "value string").repartition(7)
    assert [(r["rule"], r["n"], r["examples"].count(">")) for r in validate.report(lines).collect()] == [("self_match", 500, 5)]


def test_areas_with_many_scores(spark):
    """Ranges of scores change nothing, also for ties, scores outside of 0 to 1 and one range."""
    import random

    from quern.operators import metrics

    rnd = random.Random(3)
    rows = [(rnd.choice([rnd.random(), 0.5, 1.0, -0.5, 2.0]), int(rnd.random() < 0.3)) for _ in range(900)]
    df = spark.createDataFrame(rows, "p double, label int")
    pos, neg = ([p for p, y in rows if y == k] for k in (1, 0))
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    got = [metrics.curve_areas(df, n).first() for n in (1, 7, 1000)]
    assert all(abs(g["roc_auc"] - want) < 1e-8 and g["pr_auc"] == got[0]["pr_auc"] for g in got)


def test_pool_keeps_the_same_row(spark):
    from quern.operators import blocking
    from quern.operators.normalize import normalize

    entity = "entity_id string, business_name string, business_address string, country string"
    s1 = normalize(spark.createDataFrame([("S1-1", "red mill", "1 a road", "US")], entity))
    pool = normalize(spark.createDataFrame([("S2-1", n, "1 a road", "US") for n in ("red mill", "blue mill", "mill red")], entity))
    profile = PROFILES["evidence"]
    got = [sorted(map(tuple, blocking.scored(s1, p, profile).collect())) for p in (pool, pool.orderBy("business_name"), pool.repartition(3))]
    assert got[0] == got[1] == got[2] and len(got[0]) == 1


def test_shared_folder_must_be_named_on_a_cluster():
    import pytest

    from quern import storage

    class Session:
        class sparkContext:
            master = "spark://somewhere:7077"

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        storage.shared_dir(Session)


def test_ranking_writes_no_row_per_pair(spark, monkeypatch):
    """Every query meets every entity; blocks are small, ids repeat with two names, and ties are ordered by id."""
    from pathlib import Path

    from quern.operators import blocking
    from quern.operators.normalize import normalize
    from quern.storage import shared_dir

    entity = "entity_id string, business_name string, business_address string, country string"
    words = ("red", "blue", "old", "new")
    s1 = normalize(spark.createDataFrame([(f"S1-{i % 190}", f"mill {words[i % 4]} {i % 7}", "", "US") for i in range(200)], entity))
    pool = normalize(spark.createDataFrame([(f"S2-{i}", f"mill {words[i % 3]} {i % 7}", "", "US") for i in range(200)], entity))
    profile = PROFILES["composite"]
    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.glob("quern-*"))
    results = []
    for hits in (blocking.TASK_HITS, 3000):
        monkeypatch.setattr(blocking, "TASK_HITS", hits)
        monkeypatch.setattr(blocking, "BLOCK_HITS", hits * 4)
        monkeypatch.setattr(blocking, "ROWS", 777)
        results.append(sorted(map(tuple, blocking.ranked(s1, pool, profile, 23).collect())))
    written = [spark.read.parquet(str(p)).count() for p in set(shared.glob("quern-*")) - before if any(p.glob("*.parquet"))]
    assert 0 < max(written) < 200 * 20
    every = blocking.scored(s1, pool, profile)
    assert every.count() == 190 * 200
    assert results[0] == results[1] == sorted(map(tuple, blocking.top_k(every, 23).select("s1_id", "cand_id", "score", "evidence_rank").collect()))
    # an id with two names gains by both
    gained = {r["cand_id"]: r["score"] for r in every.filter("s1_id = 'S1-0'").collect()}
    names = {r["entity_id"]: r["business_name_clean"] for r in pool.collect()}
    own = {r["business_name_clean"] for r in s1.filter("entity_id = 'S1-0'").collect()}
    assert len(own) == 2
    least = {n: min(s for c, s in gained.items() if names[c] == n) for n in own & set(names.values())}
    assert least and min(least.values()) > 10
