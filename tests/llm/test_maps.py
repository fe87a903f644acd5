"""Operators that judge each row by itself: URL rules, token counts, decontamination, language, quality."""

import random
import re
import zlib

import pytest
from helpers import LONG, awkward, empty
from pyspark.sql import functions as F

from quern.llm import decontaminate as dc
from quern.llm import language_id as li
from quern.llm import quality as q
from quern.llm import token_counts as tc
from quern.llm import url_filter as uf


# URL rules
def brute_rule(url, rules, default="allow"):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x.group().lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h) and h) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def test_rules_against_brute_force(spark):
    rnd = random.Random(4)
    label = lambda: rnd.choice(["a", "b", "ab", "net", "example"])
    rules = {(".".join(label() for _ in range(rnd.randint(1, 3))), "/" + "/".join(label() for _ in range(rnd.randint(0, 2)))): rnd.choice(["allow", "block"]) for _ in range(40)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [f"{rnd.choice(['http', 'HTTPS'])}://{'.'.join(rnd.choice([label(), label().upper()]) for _ in range(rnd.randint(1, 4)))}/{'/'.join(label() for _ in range(rnd.randint(0, 3)))}{rnd.choice(['', '?q=/net', '#x'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "x://", "x://net", "x://net?/a", "x:///a", "x://NET/a", "x://a..net/", "a://b://net/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").repartition(3)
    as_table = spark.createDataFrame([*rules, *rules[:3]], "host string, path string, verdict string")
    for given, block in ((rules, 1000), (rules, 14), (as_table, 1000)):  # one pass, and several
        got = {r["page_id"]: (r["host"], r["path"], r["verdict"], r["rule"]) for r in uf.apply_rules(df, given, block=block).collect()}
        for i, u in enumerate(urls):
            host, path, rule, verdict = brute_rule(u, rules)
            assert got[i][:2] == (host, path), u
            assert got[i][2:] == (verdict, rule), (u, got[i], rule)


def test_sweep_starts_anywhere():
    rules = sorted((uf.rule_key(h), p, h, "block") for h in ("", "a", "b.a", "c.b.a", "z", "b.z") for p in ("", "/x"))
    keys = sorted(uf.rule_key(h) for h in ("", "a", "q.a", "b.a", "d.c.b.a", "y", "z", "a.b.z"))
    whole = list(uf.sweep(keys, ["/x"] * len(keys), uf.Rules(rules)))
    assert whole == [next(uf.sweep([k], ["/x"], uf.Rules(rules))) for k in keys] and whole[0] >= 0


def test_rule_columns_and_emptiness(spark):
    df = spark.createDataFrame([(1, "http://x.net/a", "mine", "k"), (1, "http://x.net/a", "mine", "k")], "page_id int, url string, Host string, key string")
    out = uf.apply_rules(df)
    assert out.columns == ["page_id", "url", "key", "host", "path", "rule", "verdict"] and {r["key"] for r in out.collect()} == {"k"}
    assert [r["verdict"] for r in out.collect()] == ["block", "block"]
    assert uf.apply_rules(df.limit(0)).count() == 0
    assert {r["verdict"] for r in uf.apply_rules(df, [], default="keep").collect()} == {"keep"}


# token counts
def test_counts_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    texts = ["don't stop   now\n\n ok", "a<|endoftext|>b", "日本語 テスト 😀", "\x1c\x85　x", "Straße été ²³", "  ", "x" * 500, LONG]
    df = awkward(spark).select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")).withColumn("N_TOKENS", F.lit("x"))
    tok = tokenizers.Tokenizer.from_file(tc.default_tokenizer())
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), len(tok.encode(r["text"] or "", add_special_tokens=False).ids)) for r in df.collect())
    got = tc.count_tokens(df)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = got.collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)
    assert tc.count_tokens(empty(spark)).count() == 0


def test_head_holds_all_it_may(spark):
    """More different pre-tokens than a task used to hand on."""
    df = spark.createDataFrame([(i, " ".join("w" + chr(97 + i % 20) + chr(97 + i // 20) + chr(97 + j % 20) + chr(97 + j // 20) for j in range(40))) for i in range(400)], "doc_id long, text string")
    assert len(tc._head(df, tc.default_tokenizer(), "text", 4096, tc.HEAD)) > 4096
    assert len(tc._head(df, tc.default_tokenizer(), "text", 4096, 100)) == 100
    assert tc.count_tokens(df.withColumn("_text", F.lit("k"))).columns == ["doc_id", "_text", "n_bytes", "n_tokens", "over_limit"]


# decontamination
def brute_hits(text, items, window=13):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", text.lower().encode() if text else b"")
    hit, names = set(), set()
    for name, t in items:
        for p in set(dc.windows_of(t, window)):
            for i in range(len(words) - len(p) + 1):
                if tuple(words[i : i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    names.add(name or "")
    return len(words), len(hit), ",".join(sorted(names))


def test_search_against_brute_force(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(12)]
    say = lambda n: " ".join(rnd.choices(words, k=n))
    items = [(str(i), say(rnd.choice([1, 2, 3, 5, 13, 14, 20]))) for i in range(12)] + [(None, "alone in the dark"), ("7", None), ("8", ""), ("1", "again one")]
    texts = [say(rnd.randint(0, 60)) for _ in range(60)]
    texts += [f"x y {t} z" for _, t in items if t] + [None, "", "...", "Alone, IN the-dark!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("Items", F.lit(1))
    bench = spark.createDataFrame(items, "item_id string, text string")
    for block in (10_000, 25):
        rows = {r["doc_id"]: r for r in dc.decontaminate(docs, bench, block=block).collect()}
        for i, t in enumerate(texts):
            n, h, names = brute_hits(t, items)
            r = rows[i]
            assert (r["n_words"], r["n_hit"], ",".join(r["items"])) == (n, h, names), t
            assert r["contaminated"] == (h > 0 and 20 * h >= n)


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(1, "the cat sat on the mat and the dog ran to the park today")], "item_id long, text string")
    rows = dc.decontaminate(awkward(spark), bench).collect()
    assert sum(r["contaminated"] for r in rows) == 3 and len(rows) == 12
    assert not any(r["n_hit"] for r in dc.decontaminate(awkward(spark), bench.limit(0)).collect())
    assert dc.decontaminate(empty(spark), bench).count() == 0


# language
def test_language_edges(spark):
    docs = awkward(spark).withColumn("SCORE", F.lit(1))
    model = li.train(docs)
    assert [k for k, _ in model][:1] == ["en"]
    rows = li.identify(docs, model).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 12
    for i in (3, 4, 5, 8):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["rejected"]) == ("und", 0.0, True)
    assert by[7]["lang_pred"] == "fr" and by[1]["lang_pred"] == "en" and not by[1]["rejected"]
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in li.identify(docs, []).collect()} == {"und"}
    assert li.train(empty(spark)) == [] and li.identify(empty(spark), model).count() == 0


def test_language_held_out_accuracy(spark, sf):
    out = li.op9_language_id(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in out) >= 0.95 * len(out)


def test_dictionary_takes_passages():
    """A text longer than a dictionary, or without a space, does not leave it empty."""
    assert len(li.dictionary(["x" * 200_000, "ab " * 90_000])) > 200
    many = ["".join(chr(0x4E00 + (i * 7919 + j) % 20_000) for j in range(5000)) for i in range(40)]
    found = li.dictionary(many)
    assert 0.9 * li.DICT_BYTES < len(found) <= li.DICT_BYTES + 1 and many[3][:li.PASSAGE].encode() in found


def test_language_learns_from_hot_rows(spark):
    """A language whose rows all have one id and one text, or a null id."""
    rows = [(None, "ein hund und eine katze", "de")] * 3000 + [(i, f"the dog number {i} and a cat", "en") for i in range(3000)]
    model = dict(li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=5))
    assert set(model) == {"de", "en"} and b"katze" in model["de"]


# quality
def test_long_texts_are_read_whole():
    import os

    noise = os.urandom(150_000).hex()
    tail, plain = q.zipped((noise + "a" * 300_000).encode()), q.zipped(("a" * 300_000).encode())
    assert tail > 140_000 > 5000 > plain


def test_scores_of_many_equal_single_ones():
    import numpy as np

    m = q.FactorisationMachine(0.3)
    rows = [q.features(t, n) for t, n in (("a b c", 5), (None, None), ("x " * 9000, 3), ("q", 1))]
    assert np.allclose(m.scores(rows), [1 / (1 + np.exp(-m.raw(*r))) for r in rows]) and len(m.scores([])) == 0


def test_quality_learns_from_one_row_of_an_id(spark):
    rows = [(1, "a b", 3), (1, "c d", 3), (2, "good text", 9), (2, "other text", 9), (None, "x", 1)]
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumns({c: F.lit(0) for c in ("_text", "_y", "_stated", "row", "y", "id")})
    a, b = (q.train(d, labels) for d in (docs, docs.orderBy(F.desc("text")).repartition(5)))
    assert (a.w == b.w).all() and (a.v == b.v).all()
    assert "_text" in q.score(docs, a).columns and q.score(docs, a).count() == 5


# quality model
def test_fm_identity():
    m = q.FactorisationMachine(size=30, rank=4, seed=1)
    m.w[:] = 0.1
    import numpy as np

    at, x = np.array([1, 5, 9]), np.array([1.0, 2.0, 0.5])
    pairs = sum(m.v[a] @ m.v[b] * x[i] * x[j] for i, a in enumerate(at) for j, b in enumerate(at) if i < j)
    assert abs(m.raw(at, x) - (m.w[at] @ x + pairs)) < 1e-9


def test_quality_held_out(spark, sf):
    out = q.op2_quality_fm(spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    bad, good = [r["score"] for r in rows if r["quality"] == 0], [r["score"] for r in rows if r["quality"] == 1]
    assert sum(g > b for g in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_quality_edges(spark):
    docs = awkward(spark).withColumn("PREDICTED", F.lit(1))
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, 0), (6, 1), (None, 1), (3, None), (4, 0)], "doc_id long, quality int")
    rows = q.score(docs, q.train(docs, labels)).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    one = q.train(docs, labels.filter("quality = 1 AND doc_id = 6"))
    assert 0.5 < q.score(docs, one).first()["score"] < 1
    none = q.train(empty(spark), labels)
    assert abs(q.score(docs, none).first()["score"] - 0.5) < 0.2
    assert q.score(empty(spark), one).count() == 0
