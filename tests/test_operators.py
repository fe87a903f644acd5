"""Golden rows, brute force and edge cases of the linkage operators."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.functions import similarity as S
from quern.functions import text as X
from quern.operators import blocking, decide, features, keys, metrics, validate
from quern.operators.normalize import normalize
from quern.schema import PROFILES, Blocking, Policy
from quern.sources import tsv
from quern.streaming.scoring import score_files


def entities(spark, rows):
    return spark.createDataFrame([(i, n, a, c) for i, n, a, c in rows], "entity_id string, business_name string, business_address string, country string")


GOLDEN = [
    ("B+ Retail Inc", "b retail incorporated", "b retail", "1712 Montebello Avenue, Phoenix, AZ", "1712 montebello avenue phoenix az", "1712"),
    ("-- Holloway Peak Inc Seafood", "holloway peak incorporated seafood", "holloway peak seafood", "105 ELM ST, MORGANTON, NC", "105 elm street morganton nc", "105"),
    ("Summit Inc", "summit incorporated", "summit", "GREENSBORO, NC, 19 1/2 STARDUST TRAIL", "greensboro nc 19 1 2 stardust trail", "19 1 2"),
    ("LLC Moncada Léarning Center", "llc moncada léarning center", "moncada léarning center", "5780 Fawn Ct, Fort Worth, Texas", "5780 fawn ct fort worth texas", "5780"),
    ("Ectolumdrex dba X+ Madison Inc", "ectolumdrex dba x madison incorporated", "ectolumdrex dba x madison", "S03575 Cty Tk M, Town Of Buffalo, WI", "s03575 cty tk m town of buffalo wi", "03575"),
    ("Pvt Ltd Co", "private limited company", "private limited company", "", "", ""),
    ("Ｆｕｌｌ　Ｗｉｄｔｈ ① 😀", "full width 1 😀", "full width 1 😀", "٤٢ Rd", "٤٢ road", "٤٢"),
    (None, "", "", "  \t ", "", ""),
    ("x\x1cy", "x y", "x y", "a--b", "a b", ""),
]


def test_cleaning_golden_rows(spark):
    df = entities(spark, [(f"S1-{i}", g[0], g[3], "US") for i, g in enumerate(GOLDEN)])
    rows = {r["entity_id"]: r for r in normalize(df).collect()}
    for i, (_, name, sig, _, addr, nums) in enumerate(GOLDEN):
        r = rows[f"S1-{i}"]
        assert (r["business_name_clean"], r["name_significant_tokens"], r["business_address_clean"], r["address_numbers"]) == (name, sig, addr, nums)


def test_country(spark):
    cases = {" USA ": "US", "united states": "US", "FRA": "France", "ind": "India", "new zealand": "New Zealand", "côte d'ivoire": "Côte D'Ivoire", "": "", None: ""}
    df = spark.createDataFrame(list(enumerate(cases)), "i int, c string")
    got = {r["i"]: r["x"] for r in df.select("i", X.clean_country(F.col("c")).alias("x")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def clean_rows(spark, n, seed):
    rnd = random.Random(seed)
    words = ["alpha", "alps", "beta", "betamax", "gamma", "go", "x", "delta", "deltoid", "inc"]
    def row(p, i):
        return (f"{p}-{i}", " ".join(rnd.choices(words, k=rnd.randint(0, 4))), " ".join([str(rnd.randint(1, 6))] + rnd.choices(words, k=rnd.randint(0, 2))), rnd.choice(["us", "fr", ""]))
    return normalize(entities(spark, [row("S1", i) for i in range(n)])), normalize(entities(spark, [row(rnd.choice(["S2", "S3"]), i) for i in range(2 * n)]))


def brute_scores(queries, pool, p: Blocking):
    """Sets and loops, from the rules of the keys."""
    words = lambda r, c, n: {t for t in r[c].split(" ") if len(t) >= n}
    def keys_of(r, query):
        sig, addr, num = words(r, "name_significant_tokens", 2), words(r, "address_tokens", 3), words(r, "address_numbers", p.min_num_len)
        order = sorted(sig)
        out = [("name", t) for t in sig] + [("addr", t) for t in addr] + [("num", t) for t in num]
        out += [("exact", r["business_name_clean"])] if r["business_name_clean"] else []
        out += [("pair", order[i], order[j]) for i in range(len(order)) for j in (i + 1, i + 2) if j < len(order)]
        out += [("name_num", t, x) for t in order[:3] for x in num] + [("addr_num", t, x) for t in addr for x in num]
        prefixes = [("prefix", t[:4]) for t in sig if len(t) >= 4]
        return out, prefixes if query else list(set(prefixes))
    index = {}
    for r in pool:
        a, b = keys_of(r, False)
        for k in a + b:
            index.setdefault((r["country_clean"], *k), set()).add(r["entity_id"])
    index = {k: v for k, v in index.items() if len(v) <= p.caps.get(k[1], 0)}
    names = {r["entity_id"]: r["business_name_clean"] for r in pool}
    out = {}
    for r in queries:
        hits, (main, prefixes) = {}, keys_of(r, True)
        for group, wanted in ((main, p.kinds), (prefixes, ("prefix",))):
            if group is prefixes and len(hits) >= p.sparse_below:
                break
            for k in group:
                if k[0] in wanted:
                    for c in index.get((r["country_clean"], *k), ()):
                        hits[c] = hits.get(c, 0) + p.weights[k[0]]
        for c, s in hits.items():
            out[r["entity_id"], c] = s + (p.exact_bonus if r["business_name_clean"] and names[c] == r["business_name_clean"] else 0)
    return out


@pytest.mark.parametrize("profile", ["fixture_evidence", "fixture_composite", "evidence"])
def test_blocking_against_brute_force(spark, profile):
    q, pool = clean_rows(spark, 40, 3)
    p = PROFILES[profile]
    got = {(r["s1_id"], r["cand_id"]): r["score"] for r in blocking.scored(q, pool, p).collect()}
    assert got == brute_scores(q.collect(), pool.collect(), p)


def test_posting_cap_drops_whole_lists(spark):
    df = spark.createDataFrame([(f"S2-{i}", "US", "name", "hot") for i in range(5)] + [("S2-9", "US", "name", "rare")], "entity_id string, country string, kind string, key string")
    profile = Blocking({"name": 4}, {"name": 1.0}, ("name",))
    assert [r["key"] for r in keys.capped(df, profile).collect()] == ["rare"]


def test_top_k_is_monotone_and_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("S1-0", f"S2-{i}", float(i // 3)) for i in range(9)], "s1_id string, cand_id string, score double")
    first = [r["cand_id"] for r in blocking.top_k(df, 4).orderBy("evidence_rank").collect()]
    assert first == ["S2-6", "S2-7", "S2-8", "S2-3"]
    assert set(first) <= {r["cand_id"] for r in blocking.top_k(df, 6).collect()}


def test_similarities(spark):
    df = spark.createDataFrame([("", ""), ("abc", ""), ("abc", "abc"), ("abcd", "abce"), ("a", "aaaaaaaaaaaaaa")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    rows = df.select(S.char_set(a, b).alias("c"), S.same(a, b).alias("s"), S.prefix4(a, b).alias("p"), S.edit_similarity(a, b).alias("e"), S.jaccard(X.words_of(a), X.words_of(b)).alias("j"), S.length_ratio(a, b).alias("r")).collect()
    assert [r["c"] for r in rows] == [1.0, 0.0, 1.0, 0.6, 0.0]
    assert [r["s"] for r in rows] == [0.0, 0.0, 1.0, 0.0, 0.0]
    assert [r["j"] for r in rows] == [0.0, 0.0, 1.0, 0.0, 0.0]
    assert [round(r["e"], 3) for r in rows] == [1.0, 0.0, 1.0, 0.75, 0.071]
    assert [r["r"] for r in rows][:2] == [0.0, 0.0]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("aé1 -.&　\x1c", max_size=12), st.text("b2 st,;/", max_size=12)), min_size=1, max_size=8))
def test_cleaning_is_idempotent_on_names(spark, rows):
    df = entities(spark, [(f"S1-{i}", n, a, "US") for i, (n, a) in enumerate(rows)])
    once = normalize(df).select("entity_id", F.col("business_name_clean").alias("business_name"), F.col("business_address_clean").alias("business_address"), "country")
    again = normalize(once).select("entity_id", "business_name", "business_name_clean")
    assert all(r["business_name"] == r["business_name_clean"] for r in again.collect())


def pairs(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, cand_id string") if rows else spark.createDataFrame([], "s1_id string, cand_id string")


def test_entity_f05(spark):
    queries = spark.createDataFrame([("S1-a",), ("S1-b",), ("S1-c",), ("S1-d",)], "entity_id string")
    truth = pairs(spark, [("S1-a", "S2-47"), ("S1-a", "S3-812"), ("S1-d", "S2-1")])
    predicted = pairs(spark, [("S1-a", "S2-47"), ("S1-a", "S2-193"), ("S1-a", "S3-812"), ("S1-c", "S2-5")])
    got = {r["s1_id"]: r["f05"] for r in metrics.per_entity(truth, predicted, queries).collect()}
    assert round(got["S1-a"], 3) == 0.714
    assert (got["S1-b"], got["S1-c"], got["S1-d"]) == (1.0, 0.0, 0.0)


def test_metrics_of_nothing(spark):
    queries = spark.createDataFrame([("S1-a",)], "entity_id string")
    none = pairs(spark, [])
    assert metrics.micro(none, none).first()["f05"] == 0.0
    assert metrics.macro(none, none, queries).first()["macro_f05"] == 1.0


def scored(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, cand_id string, country string, p double, candidate_rank int, exact_name double")


def test_policies(spark):
    df = scored(spark, [("S1-1", "S2-1", "US", 0.5, 1, 1.0), ("S1-2", "S2-1", "Spain", 0.32, 1, 0.0), ("S1-2", "S2-2", "Spain", 0.32, 2, 0.0), ("S1-3", "S2-1", None, 0.61, 1, 0.0)])
    chosen = lambda p: {(r["s1_id"], r["cand_id"]) for r in decide.decide(df, p).collect()}
    base = Policy(0.35, {"US": 0.6}, fallback=0.3)
    assert chosen(base) == {("S1-2", "S2-1"), ("S1-3", "S2-1")}
    assert ("S1-1", "S2-1") in chosen(Policy(0.35, {"US": 0.6}, fallback=0.3, fallback_everywhere=True))
    assert ("S1-1", "S2-1") in chosen(Policy(0.35, {"US": 0.6}, fallback=0.3, exact_name_from=0.15))


def test_later_source_wins(spark):
    a = spark.createDataFrame([("S2-1", "old")], "entity_id string, v string")
    b = spark.createDataFrame([("S2-1", "new")], "entity_id string, v string")
    assert [r["v"] for r in features.pool_of(a, b).collect()] == ["new"]


def test_tsv_round_trip(spark, tmp_path):
    df = entities(spark, [("S1-1", 'A "quoted" name', "", "US"), ("S1-2", "NA", "a, b", "FR"), ("S1-3", "nan", "c", "")])
    tsv.write_tsv(df, f"file://{tmp_path}/t")
    back = {r["entity_id"]: tuple(r) for r in tsv.read_tsv(spark, f"file://{tmp_path}/t").collect()}
    assert back == {r["entity_id"]: tuple(r) for r in df.collect()}
    emptied = {r["entity_id"]: r["business_name"] for r in tsv.read_tsv(spark, f"file://{tmp_path}/t", na_literals=True).collect()}
    assert emptied["S1-2"] == emptied["S1-3"] == ""


def test_id_lists_resume(spark, tmp_path):
    queries = spark.createDataFrame([(f"S1-{i}",) for i in range(4)], "entity_id string")
    make = lambda q: q.select(F.col("entity_id").alias("source1_entity_id"), F.lit("S2-1,S3-2").alias("matched_entity_ids"))
    path = f"file://{tmp_path}/lists"
    assert tsv.append_remaining(queries.limit(2), path, make) == 2
    assert tsv.append_remaining(queries, path, make) == 2
    assert tsv.append_remaining(queries, path, make) == 0
    lists = tsv.read_id_lists(spark, path)
    assert lists.count() == 4 and tsv.pairs_of(lists).count() == 8
    assert {r["entity_id"] for r in tsv.read_ids(spark, path).collect()} == {f"S1-{i}" for i in range(4)}


def test_integrity(spark, tmp_path):
    import hashlib

    (tmp_path / "a.bin").write_bytes(b"one")
    (tmp_path / "b.bin").write_bytes(b"two")
    want = {"a.bin": hashlib.sha256(b"one").hexdigest(), "b.bin": "0", "c.bin": "0"}
    assert {r["file"]: r["status"] for r in tsv.verify(spark, f"file://{tmp_path}", want).collect()} == {"a.bin": "ok", "b.bin": "changed", "c.bin": "missing"}


def test_validator_file(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-1\t\nbroken\nS1-2\tS1-2\nS1-3\tQ-1")
    queries = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-9",)], "entity_id string")
    got = {r["rule"]: r["n"] for r in validate.validate(spark, f"file://{tmp_path}/m.tsv", ("source1_entity_id", "matched_entity_ids"), queries).collect()}
    assert got == {"duplicate_id": 1, "duplicate_row": 1, "malformed_line": 1, "self_match": 1, "wrong_prefix": 1, "required": 2}
    (tmp_path / "c.csv").write_text("source1_entity_id,matched_entity_ids\n")
    assert [r["rule"] for r in validate.validate(spark, f"file://{tmp_path}/c.csv", ("a", "b")).collect()] == ["header"]


def test_stream_scoring(spark, tmp_path):
    (tmp_path / "in").mkdir()
    header = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    (tmp_path / "in" / "1.tsv").write_text(header + "S1-1\tAlpha Beta\t\tUS\n")
    pool = normalize(entities(spark, [("S2-1", "alpha", "", "US"), ("S2-2", "alpha beta", "", "US")]))
    make = lambda q: blocking.top_k(blocking.scored(normalize(q), pool, PROFILES["evidence"]), 1)
    args = (spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out", f"file://{tmp_path}/check", make)
    assert score_files(*args) == 1
    (tmp_path / "in" / "2.tsv").write_text(header + "S1-2\tAlpha\t\tUS\n")
    assert score_files(*args) == 1  # only the new file
    assert score_files(*args) == 0
    got = {(r["s1_id"], r["cand_id"]) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    assert got == {("S1-1", "S2-2"), ("S1-2", "S2-1")}


def test_file_status(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\ta\tb\tc\n")
    (tmp_path / "b.tsv").write_text("")
    (tmp_path / "c.tsv").write_text("id,name\n")
    rows = tsv.file_status(spark, [f"file://{tmp_path}/{n}.tsv" for n in "abcd"]).collect()
    assert [(r["found"], r["n_bytes"] > 0, r["parsable"]) for r in rows] == [(True, True, True), (True, False, False), (True, True, False), (False, False, False)]
