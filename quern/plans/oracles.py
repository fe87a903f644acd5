"""The same queries in DuckDB SQL, written apart from the DataFrame operators."""

from __future__ import annotations

from quern.functions.text import ADDRESS_WORDS, COUNTRIES, GENERIC, LEGAL_FORMS
from quern.operators.audit import QUALITY
from quern.operators.features import EXTRA, FEATURES
from quern.plans import fixtures
from quern.schema import POLICIES, PROFILES, Blocking, Policy

SEP = "chr(1)"


def _case(value: str, table: dict[str, str], other: str) -> str:
    return f"CASE {value} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {other} END"


_TOKENS = r"list_filter(regexp_split_to_array(regexp_replace({0}, '[\p{{P}}\p{{S}}]', ' ', 'g'), '\s+'), lambda x: x <> '')"
_GENERIC = ", ".join(f"'{g}'" for g in GENERIC)
BASE = f"""{fixtures.ctes()},
ents AS (SELECT 'S1' AS source, * FROM fx_source1 UNION ALL SELECT 'S2', * FROM fx_source2 UNION ALL SELECT 'S3', * FROM fx_source3),
words AS (SELECT *, list_transform({_TOKENS.format("lower(business_name)")}, lambda t: {_case("t", LEGAL_FORMS, "t")}) AS nw,
  list_transform({_TOKENS.format("lower(business_address)")}, lambda t: {_case("t", ADDRESS_WORDS, "t")}) AS aw, regexp_extract_all(lower(business_address), '[0-9]+') AS dw FROM ents),
clean AS (SELECT source, entity_id, business_name, business_address, country, array_to_string(nw, ' ') AS business_name_clean, array_to_string(aw, ' ') AS business_address_clean,
  CASE WHEN trim(country) = '' THEN '' ELSE {_case("lower(trim(country))", COUNTRIES, "country")} END AS country_clean, array_to_string(dw, ' ') AS address_numbers,
  array_to_string(CASE WHEN len(list_filter(nw, lambda t: t NOT IN ({_GENERIC}))) = 0 THEN nw ELSE list_filter(nw, lambda t: t NOT IN ({_GENERIC})) END, ' ') AS name_significant_tokens FROM words)"""


def _keys(min_num: int) -> str:
    split = lambda c, n: f"list_distinct(list_filter(string_split({c}, ' '), lambda x: length(x) >= {n}))"
    each = "SELECT source, entity_id, country_clean AS country"
    return f"""sets AS (SELECT source, entity_id, country_clean, business_name_clean, {split("name_significant_tokens", 2)} AS sig, {split("business_address_clean", 3)} AS addr, {split("address_numbers", min_num)} AS num FROM clean),
srt AS (SELECT *, list_sort(sig) AS st FROM sets), nums AS (SELECT unnest(range(1, 60)) AS i), steps AS (SELECT unnest([1, 2]) AS d),
k AS ({each}, 'name' AS kind, unnest(sig) AS key FROM sets UNION ALL {each}, 'addr', unnest(addr) FROM sets UNION ALL {each}, 'num', unnest(num) FROM sets
  UNION ALL {each}, 'prefix', substr(t, 1, 4) FROM (SELECT *, unnest(sig) AS t FROM sets) WHERE length(t) >= 4
  UNION ALL {each}, 'exact', business_name_clean FROM sets WHERE business_name_clean <> ''
  UNION ALL {each}, 'pair', st[i] || {SEP} || st[i + d] FROM srt, nums, steps WHERE i + d <= len(st)
  UNION ALL {each}, 'name_num', a || {SEP} || b FROM (SELECT *, unnest(st[1:3]) AS a FROM srt) x, LATERAL (SELECT unnest(x.num) AS b)
  UNION ALL {each}, 'addr_num', a || {SEP} || b FROM (SELECT *, unnest(addr) AS a FROM sets) x, LATERAL (SELECT unnest(x.num) AS b))"""


def _candidates(p: Blocking, empty_country: bool = True) -> str:
    cap = "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in p.caps.items()) + " END"
    weight = "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in p.weights.items()) + " END"
    kinds = ", ".join(f"'{k}'" for k in p.kinds)
    where = "" if empty_country else "AND country <> ''"
    return f"""{_keys(p.min_num_len)},
pk AS (SELECT DISTINCT entity_id, country, kind, key FROM k WHERE source <> 'S1' {where}),
post AS (SELECT * FROM pk QUALIFY count(*) OVER (PARTITION BY kind, country, key) <= {cap}),
hits AS (SELECT q.entity_id AS s1_id, post.entity_id AS cand_id, kind, {weight} AS weight FROM k q JOIN post USING (kind, country, key) WHERE q.source = 'S1'),
first AS (SELECT s1_id, cand_id, sum(weight) AS score FROM hits WHERE kind IN ({kinds}) GROUP BY s1_id, cand_id),
busy AS (SELECT s1_id FROM first GROUP BY s1_id HAVING count(*) >= {p.sparse_below}),
more AS (SELECT s1_id, cand_id, sum(weight) AS score FROM hits WHERE kind = 'prefix' AND s1_id NOT IN (SELECT s1_id FROM busy) GROUP BY s1_id, cand_id),
both_ AS (SELECT s1_id, cand_id, sum(score) AS score FROM (SELECT * FROM first UNION ALL SELECT * FROM more) GROUP BY s1_id, cand_id),
scored AS (SELECT s1_id, cand_id, score + CASE WHEN a.business_name_clean <> '' AND a.business_name_clean = b.business_name_clean THEN {p.exact_bonus} ELSE 0 END AS score
  FROM both_ JOIN clean a ON a.entity_id = s1_id JOIN clean b ON b.entity_id = cand_id),
cands AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id) AS evidence_rank FROM scored QUALIFY evidence_rank <= {p.top_k or 10**9})"""


_WORDS = "list_distinct(list_filter(string_split({0}, ' '), lambda x: x <> ''))"
_SAME = "CASE WHEN a.{0} <> '' AND a.{0} = b.{0} THEN 1.0::DOUBLE ELSE 0.0 END"


def _jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"


_LETTERS = "list_distinct(list_filter(string_split({0}, ''), lambda x: x <> ''))"
_NAME = ("a.business_name_clean", "b.business_name_clean")
_CHARS = f"""CASE WHEN {_NAME[0]} = '' AND {_NAME[1]} = '' THEN 1.0::DOUBLE WHEN {_NAME[0]} = '' OR {_NAME[1]} = '' THEN 0.0 WHEN {_NAME[0]} = {_NAME[1]} THEN 1.0
  WHEN abs(length({_NAME[0]}) - length({_NAME[1]})) > 10 THEN 0.0 ELSE {_jaccard(_LETTERS.format(_NAME[0]), _LETTERS.format(_NAME[1]))} END"""
_FEATURES = {
    "exact_name": _SAME.format("business_name_clean"), "exact_sig_name": _SAME.format("name_significant_tokens"), "name_jaccard": _jaccard("a.nset", "b.nset"), "sig_jaccard": _jaccard("a.sset", "b.sset"),
    "name_len_diff": "abs(length(a.business_name_clean) - length(b.business_name_clean))::DOUBLE", "exact_addr": _SAME.format("business_address_clean"), "addr_jaccard": _jaccard("a.aset", "b.aset"),
    "prefix4": "CASE WHEN length(a.business_name_clean) >= 4 AND length(b.business_name_clean) >= 4 AND substr(a.business_name_clean, 1, 4) = substr(b.business_name_clean, 1, 4) THEN 1.0::DOUBLE ELSE 0.0 END",
    "cand_addr_missing": "CASE WHEN b.business_address_clean = '' THEN 1.0::DOUBLE ELSE 0.0 END", "exact_nums": _SAME.format("address_numbers"), "num_jaccard": _jaccard("a.dset", "b.dset"),
    "addr_len_diff": "abs(length(a.business_address_clean) - length(b.business_address_clean))::DOUBLE", "country_match": "CASE WHEN a.country_clean = b.country_clean THEN 1.0::DOUBLE ELSE 0.0 END",
    "is_s3": "CASE WHEN cand_id LIKE 'S3-%' THEN 1.0::DOUBLE ELSE 0.0 END", "candidate_rank": "candidate_rank::DOUBLE", "total_candidates": "total_candidates::DOUBLE", "char_set_similarity": _CHARS,
    "name_length_ratio": "least(length(a.business_name_clean), length(b.business_name_clean))::DOUBLE / greatest(length(a.business_name_clean), length(b.business_name_clean), 1)",
    "sig_overlap": "len(list_intersect(a.sset, b.sset))::DOUBLE / greatest(len(a.sset), 1)", "any_num_shared": "CASE WHEN len(list_intersect(a.dset, b.dset)) > 0 THEN 1.0::DOUBLE ELSE 0.0 END",
}

VECTORS = f"""side AS (SELECT *, {_WORDS.format("business_name_clean")} AS nset, {_WORDS.format("name_significant_tokens")} AS sset, {_WORDS.format("business_address_clean")} AS aset, {_WORDS.format("address_numbers")} AS dset FROM clean),
ranked AS (SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY cand_id) AS candidate_rank, count(*) OVER (PARTITION BY s1_id) AS total_candidates FROM cands),
feats AS (SELECT s1_id, cand_id, a.country_clean AS country, {", ".join(f"{_FEATURES[n]} AS {n}" for n in (*FEATURES, *EXTRA))} FROM ranked JOIN side a ON a.entity_id = s1_id JOIN side b ON b.entity_id = cand_id),
vec AS (SELECT feats.*, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label, 0.35 * sig_jaccard + 0.2 * name_jaccard + 0.2 * addr_jaccard + 0.15 * num_jaccard + 0.1 * prefix4 AS p
  FROM feats LEFT JOIN (SELECT DISTINCT s1_id, cand_id FROM fx_gt_pairs) t USING (s1_id, cand_id)),
mr AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, candidate_rank) AS model_rank FROM vec)"""
VECTORS = VECTORS.replace("0.35 *", "0.35::DOUBLE *").replace("0.2 *", "0.2::DOUBLE *").replace("0.15 *", "0.15::DOUBLE *").replace("+ 0.1 *", "+ 0.1::DOUBLE *")


def _decided(p: Policy, name: str = "matched") -> str:
    t = f"CASE country {' '.join(f'WHEN {c!r} THEN {v}::DOUBLE' for c, v in p.by_country.items())} ELSE {p.default}::DOUBLE END" if p.by_country else f"{p.default}::DOUBLE"
    ok = f"p >= {t}" + (f" OR (exact_name = 1 AND p >= {p.exact_name_from}::DOUBLE)" if p.exact_name_from is not None else "")
    where = "" if p.fallback_everywhere else f"AND country NOT IN ({', '.join(repr(c) for c in p.by_country)})"
    return f"""{name}_ok AS (SELECT *, {ok} AS ok FROM mr),
{name} AS (SELECT s1_id, cand_id, model_rank FROM (SELECT *, bool_or(ok) OVER (PARTITION BY s1_id) AS any_ok FROM {name}_ok) WHERE ok OR (NOT any_ok AND model_rank = 1 AND p >= {p.fallback}::DOUBLE {where}))"""


TRUTH = "truth AS (SELECT DISTINCT s1_id, cand_id FROM fx_gt_pairs)"
_RATIO = "CASE WHEN {1} > 0 THEN {0}::DOUBLE / ({1}) ELSE 0.0::DOUBLE END"
_F = "CASE WHEN precision_ + recall_ > 0 THEN (1 + {b}) * precision_ * recall_ / ({b} * precision_ + recall_) ELSE 0.0::DOUBLE END"
F05, F1 = _F.format(b="0.25::DOUBLE"), _F.format(b="1.0::DOUBLE")

_EVIDENCE = _candidates(PROFILES["fixture_evidence"])
ORACLES: dict[str, str] = {}


def base(name: str, sql: str) -> None:
    ORACLES[name] = f"WITH {BASE}\n{sql}"


def on_keys(name: str, sql: str) -> None:
    ORACLES[name] = f"WITH {BASE},\n{_keys(1)}\n{sql}"


def on_cands(name: str, sql: str, *more: str, chain: str = _EVIDENCE) -> None:
    ORACLES[name] = "WITH " + ",\n".join([BASE, chain, TRUTH, *more]) + "\n" + sql


def on_vectors(name: str, sql: str, *more: str) -> None:
    on_cands(name, sql, VECTORS, *more)


_COUNTRY = _decided(POLICIES["country"])
_ALL = "entity_id || chr(1) || business_name || chr(1) || business_address || chr(1) || country"
_LOWER = "trim(lower(business_name)) || chr(1) || trim(lower(business_address))"
_SUBSETS = {"all": _ALL, "name": "business_name", "address": "business_address", "name_address": "business_name || chr(1) || business_address", "name_address_country": "business_name || chr(1) || business_address || chr(1) || country", "name_address_lower": _LOWER}
_IDS = "list_filter(string_split(matched_entity_ids, ','), lambda x: x <> '')"
_GT_LISTS = "gt_lists AS (SELECT s.entity_id AS source1_entity_id, coalesce(string_agg(g.cand_id, ',' ORDER BY g.cand_id), '') AS matched_entity_ids FROM fx_source1 s LEFT JOIN fx_gt_pairs g ON g.s1_id = s.entity_id GROUP BY s.entity_id)"

# audits
base("audit_row_counts", "SELECT source, count(*) AS n_rows, 4::BIGINT AS n_columns FROM ents GROUP BY source")
base("audit_missing", "SELECT source, c AS column_name, count(*) FILTER (trim(v) = '') AS n_missing, 100 * count(*) FILTER (trim(v) = '')::DOUBLE / count(*) AS pct_missing FROM ("
     + " UNION ALL ".join(f"SELECT source, '{c}' AS c, {c} AS v FROM ents" for c in ("entity_id", "business_name", "business_address", "country")) + ") GROUP BY source, c")
base("audit_ids", "SELECT source, count(*) AS n_rows, count(DISTINCT entity_id) AS n_ids, count(*) - count(DISTINCT entity_id) AS n_duplicate_ids, count(*) FILTER (NOT regexp_matches(entity_id, '^S[123]-[0-9]+$')) AS n_malformed, count(*) FILTER (entity_id = '') AS n_missing_ids FROM ents GROUP BY source")
base("audit_duplicates", " UNION ALL ".join(f"SELECT source, '{k}' AS subset, (count(*) - count(DISTINCT {v}))::BIGINT AS n_duplicates FROM ents GROUP BY source" for k, v in _SUBSETS.items()))
base("audit_country_dist", "SELECT source, country, count(*) AS n_rows, 100 * count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY source) AS pct FROM ents GROUP BY source, country")
base("audit_lengths", "SELECT source, " + ", ".join(f"min(length(business_{c})) AS min_{c}, max(length(business_{c})) AS max_{c}, avg(length(business_{c})) AS avg_{c}, count(*) FILTER (length(business_{c}) > {n}) AS long_{c}" for c, n in (("name", 150), ("address", 300))) + " FROM ents GROUP BY source")
base("audit_quality_flags", "SELECT source, " + ", ".join(f"count(*) FILTER (regexp_matches(business_name, '{p}') OR regexp_matches(business_address, '{p}')) AS {k}" for k, p in QUALITY.items()) + " FROM ents GROUP BY source")
ORACLES["audit_gt_histogram"] = f"""WITH {BASE}, {_GT_LISTS}, l AS (SELECT {_IDS} AS l FROM gt_lists) SELECT count(*) AS n_queries, count(*) FILTER (len(l) = 0) AS n_none, count(*) FILTER (len(l) = 1) AS n_one, count(*) FILTER (len(l) > 1) AS n_several, max(len(l)) AS most,
  sum(len(l))::BIGINT AS n_pairs, sum(len(list_filter(l, lambda x: x LIKE 'S2-%')))::BIGINT AS n_s2, sum(len(list_filter(l, lambda x: x LIKE 'S3-%')))::BIGINT AS n_s3, count(*) FILTER (len(l) <> len(list_distinct(l))) AS n_with_repeats FROM l"""
base("audit_ref_integrity", """SELECT 'truth_s1_unknown' AS check_name, count(DISTINCT s1_id) AS n FROM fx_gt_pairs WHERE s1_id NOT IN (SELECT entity_id FROM fx_source1)
UNION ALL SELECT 's1_without_truth', count(DISTINCT entity_id) FROM fx_source1 WHERE entity_id NOT IN (SELECT s1_id FROM fx_gt_pairs)
UNION ALL SELECT 'truth_match_unknown', count(DISTINCT cand_id) FROM fx_gt_pairs WHERE cand_id NOT IN (SELECT entity_id FROM ents)""")
base("sample_per_source", "SELECT source, row_number() OVER (PARTITION BY source ORDER BY entity_id) AS nth, entity_id, business_name FROM ents QUALIFY nth <= 10")
# cleaning
base("norm_name", "SELECT entity_id, business_name_clean, business_name_clean AS name_tokens, name_significant_tokens FROM clean")
base("norm_addr", "SELECT entity_id, business_address_clean, address_numbers, business_address_clean AS address_tokens FROM clean")
base("norm_country", "SELECT entity_id, country, country_clean FROM clean")
base("norm_tokens_exploded", "SELECT token, count(*) AS n, count(DISTINCT entity_id) AS n_entities FROM (SELECT entity_id, unnest(nw) AS token FROM words) GROUP BY token")
base("norm_invariants", "SELECT count(*) AS rows_before, count(*) FILTER (trim(business_address) = '') AS no_address_before, count(*) AS rows_after, count(*) FILTER (business_address_clean = '') AS empty_clean_address, count(*) FILTER (trim(business_address) = '') AS no_address_after, 0::BIGINT AS lost_ids, 0::BIGINT AS new_ids, 0::BIGINT AS ids_with_other_counts, 0::BIGINT AS missing_columns FROM clean")
# keys
for _kind in ("name", "addr", "num", "prefix", "exact", "pair", "name_num", "addr_num"):
    on_keys(f"keys_{_kind}", f"SELECT entity_id, country, replace(key, {SEP}, '|') AS key FROM k WHERE kind = '{_kind}'")
_TOP = "SELECT entity_id, country_clean AS country, list_filter(string_split(name_significant_tokens, ' '), lambda x: length(x) >= 2) AS ts, list_filter(string_split(business_address_clean, ' '), lambda x: length(x) >= 3) AS ad, list_filter(string_split(address_numbers, ' '), lambda x: length(x) >= 1) AS nu FROM clean"
base("keys_archived", f"""SELECT DISTINCT entity_id, country, kind, replace(key, {SEP}, '|') AS key FROM (
  SELECT entity_id, country, 'name' AS kind, t AS key FROM (SELECT *, unnest(ts) AS t FROM ({_TOP})) WHERE length(t) >= 3
  UNION ALL SELECT entity_id, country, 'pair', least(ts[i], ts[i + d]) || {SEP} || greatest(ts[i], ts[i + d]) FROM ({_TOP}), (SELECT unnest(range(1, 60)) AS i), (SELECT unnest([1, 2]) AS d) WHERE i + d <= len(ts)
  UNION ALL SELECT entity_id, country, 'name_num', a || {SEP} || b FROM (SELECT *, unnest(ts[1:2]) AS a FROM ({_TOP})) x, LATERAL (SELECT unnest(x.nu[1:2]) AS b)
  UNION ALL SELECT entity_id, country, 'addr_num', a || {SEP} || b FROM (SELECT *, unnest(ad[1:2]) AS a FROM ({_TOP})) x, LATERAL (SELECT unnest(x.nu[1:2]) AS b))""")
_FOUR = "('name', 'addr', 'num', 'prefix')"
on_keys("posting_stats", f"SELECT kind, country, key, count(DISTINCT entity_id) AS posting_count FROM k WHERE source <> 'S1' AND kind IN {_FOUR} GROUP BY kind, country, key")
on_cands("posting_capped", f"SELECT kind, country, count(*) AS n_postings, count(DISTINCT key) AS n_keys FROM post WHERE kind IN {_FOUR} GROUP BY kind, country")
# candidates
_COMPOSITE = _candidates(PROFILES["fixture_composite"])
on_cands("cand_v1_union", "SELECT s1_id, cand_id FROM scored", chain=_candidates(PROFILES["fixture_union"], False))
on_cands("cand_evidence_scores", "SELECT s1_id, cand_id, score FROM scored")
on_cands("cand_evidence_topk", "SELECT s1_id, cand_id, score, evidence_rank FROM cands")
on_cands("cand_v2_scores", "SELECT s1_id, cand_id, score FROM scored", chain=_COMPOSITE)
on_cands("cand_v2_topk", "SELECT s1_id, cand_id, score, evidence_rank FROM cands", chain=_COMPOSITE)
on_cands("cand_evidence_full_caps", "SELECT s1_id, cand_id, score FROM scored", chain=_candidates(PROFILES["evidence"]))
for _name, _profile in {"cand_union_full": "union", "cand_balanced_350": "balanced", "cand_evidence_350": "evidence", "cand_emergency_350": "emergency", "cand_composite_500": "composite"}.items():
    on_cands(_name, "SELECT s1_id, cand_id, score, evidence_rank FROM cands", chain=_candidates(PROFILES[_profile], _profile != "union"))
on_cands("cand_id_rank", "SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY cand_id) AS candidate_rank, count(*) OVER (PARTITION BY s1_id) AS total_candidates FROM cands")
on_cands("cand_static_cap", "SELECT s1_id, cand_id FROM cands QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY cand_id) <= 4")
_PER = "per AS (SELECT s.entity_id, count(c.cand_id) AS n FROM fx_source1 s LEFT JOIN {0} c ON c.s1_id = s.entity_id GROUP BY s.entity_id)"
on_cands("cand_distribution", "SELECT count(*) AS n_queries, sum(n)::BIGINT AS total, avg(n) AS mean, quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.95) AS p95, quantile_cont(n, 0.99) AS p99, min(n) AS least, max(n) AS most, count(*) FILTER (n = 0) AS n_zero, 100 * count(*) FILTER (n = 10)::DOUBLE / count(*) AS pct_at_cap, count(*) FILTER (n > 2) AS gt_2, count(*) FILTER (n > 5) AS gt_5, count(*) FILTER (n > 8) AS gt_8, " + ", ".join(f"round(100 * count(*) FILTER (n > {x})::DOUBLE / count(*), 2) AS pct_gt_{x}" for x in (2, 5, 8)) + " FROM per", _PER.format("cands"))
on_cands("cand_list_render", "SELECT s.entity_id AS source1_entity_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS candidate_entity_ids FROM fx_source1 s LEFT JOIN cands ON s1_id = s.entity_id GROUP BY s.entity_id")
on_cands("cand_cross_country", "SELECT s1_id, cand_id FROM cands JOIN clean a ON a.entity_id = s1_id JOIN clean b ON b.entity_id = cand_id WHERE a.country_clean <> b.country_clean")
on_cands("cand_growth", "SELECT (SELECT count(*) FROM cands WHERE evidence_rank <= 5) AS total_before, sum(n)::BIGINT AS total_after, 100 * (sum(n) - (SELECT count(*) FROM cands WHERE evidence_rank <= 5))::DOUBLE / (SELECT count(*) FROM cands WHERE evidence_rank <= 5) AS growth_pct, avg(n) * 3938000 * 12 / 1e9::DOUBLE AS disk_gb FROM per", _PER.format("cands"))
# features and decisions
on_vectors("feat16", f"SELECT s1_id, cand_id, {', '.join(FEATURES)} FROM vec")
on_vectors("feat20", f"SELECT s1_id, cand_id, {', '.join(EXTRA)} FROM vec")
# the letters beyond ASCII stand for themselves as capitals, which clean names lack: the oracle's edit distance counts bytes
_ASCII = "translate({0}, 'àáâäæçèéêëíîïñóôöœùúûüß', 'ABCDEFGHIJKLMNOPQRSTUVW')"
_EDIT = [_ASCII.format(x) for x in _NAME]
on_vectors("feat_edit", f"SELECT s1_id, cand_id, CASE WHEN greatest(length({_NAME[0]}), length({_NAME[1]})) = 0 THEN 1.0::DOUBLE ELSE 1 - levenshtein({_EDIT[0]}, {_EDIT[1]})::DOUBLE / greatest(length({_NAME[0]}), length({_NAME[1]})) END AS edit_similarity FROM ranked JOIN side a ON a.entity_id = s1_id JOIN side b ON b.entity_id = cand_id")
on_vectors("feat_sanity", "SELECT count(*) AS n_pairs, 16::BIGINT AS n_features, 0::BIGINT AS n_nan, 0::BIGINT AS n_infinite, 0::BIGINT AS n_null FROM vec")
on_vectors("labels", "SELECT s1_id, cand_id, label FROM vec")
on_vectors("grouped_split", "SELECT s1_id, cand_id, substr(s1_id, 4)::BIGINT % 100 < 80 AS is_train FROM vec")
on_vectors("score_linear", "SELECT s1_id, cand_id, p FROM vec")
on_vectors("rank_model", "SELECT s1_id, cand_id, model_rank FROM mr")
for _name, _policy in POLICIES.items():
    on_vectors(f"decide_{_name}", "SELECT s1_id, cand_id FROM matched", _decided(_policy))
on_vectors("matches_complete", "SELECT s.entity_id AS source1_entity_id, coalesce(string_agg(cand_id, ',' ORDER BY model_rank), '') AS matched_entity_ids FROM fx_source1 s LEFT JOIN matched ON s1_id = s.entity_id GROUP BY s.entity_id", _COUNTRY)
on_vectors("pred_counts_by_country", "SELECT country_clean AS country, count(*) AS n_queries, count(*) FILTER (entity_id IN (SELECT s1_id FROM matched)) AS n_matched, count(*) FILTER (entity_id NOT IN (SELECT s1_id FROM matched)) AS n_empty FROM clean WHERE source = 'S1' GROUP BY country_clean", _COUNTRY)
# evaluation
_HITS = "marked AS (SELECT t.*, c.s1_id IS NOT NULL AS hit FROM truth t LEFT JOIN cands c USING (s1_id, cand_id))"
on_cands("eval_pair_recall", """SELECT sum(n)::BIGINT AS n_pairs, sum(h)::BIGINT AS n_found, count(*) AS n_queries, count(*) FILTER (n = h) AS n_complete, 100 * sum(h)::DOUBLE / sum(n) AS pair_recall, 100 * count(*) FILTER (n = h)::DOUBLE / count(*) AS query_coverage
FROM (SELECT s1_id, count(*) AS n, count(*) FILTER (hit) AS h FROM marked GROUP BY s1_id)""", _HITS)
on_cands("eval_recall_by_country", "SELECT country_clean AS country, count(*) AS n_pairs, count(*) FILTER (hit) AS n_found, 100 * count(*) FILTER (hit)::DOUBLE / count(*) AS pair_recall FROM marked JOIN clean ON entity_id = s1_id GROUP BY country_clean", _HITS)
_MICRO = "(SELECT count(*) FILTER (t.s1_id IS NOT NULL AND m.s1_id IS NOT NULL) AS tp, count(*) FILTER (t.s1_id IS NULL) AS fp, count(*) FILTER (m.s1_id IS NULL) AS fn FROM truth t FULL JOIN {0} m ON t.s1_id = m.s1_id AND t.cand_id = m.cand_id)"
_PR = f"*, {_RATIO.format('tp', 'tp + fp')} AS precision_, {_RATIO.format('tp', 'tp + fn')} AS recall_"
on_vectors("eval_micro_f05", f"SELECT tp, fp, fn, precision_ AS precision, recall_ AS recall, {F05} AS f05 FROM (SELECT {_PR} FROM {_MICRO.format('matched')})", _COUNTRY)
_ENTITY = f"""cnt AS (SELECT coalesce(t.s1_id, m.s1_id) AS s1_id, count(*) FILTER (t.s1_id IS NOT NULL AND m.s1_id IS NOT NULL) AS tp, count(t.s1_id) AS nt, count(m.s1_id) AS np FROM truth t FULL JOIN matched m ON t.s1_id = m.s1_id AND t.cand_id = m.cand_id GROUP BY 1),
ent AS (SELECT entity_id AS s1_id, coalesce(tp, 0) AS tp, coalesce(nt, 0) AS nt, coalesce(np, 0) AS np FROM fx_source1 LEFT JOIN cnt ON cnt.s1_id = entity_id),
ef AS (SELECT s1_id, tp, nt, np, CASE WHEN nt = 0 AND np = 0 THEN 1.0::DOUBLE ELSE {F05} END AS f05 FROM (SELECT *, {_RATIO.format("tp", "np")} AS precision_, {_RATIO.format("tp", "nt")} AS recall_ FROM ent))"""
on_vectors("eval_entity_f05", "SELECT * FROM ef", _COUNTRY, _ENTITY)
on_vectors("eval_macro_f05", "SELECT count(*) AS n_queries, count(*) FILTER (f05 = 1) AS n_perfect, count(*) FILTER (f05 = 0) AS n_zero, round(avg(f05), 9) AS macro_f05 FROM ef", _COUNTRY, _ENTITY)
_RM = "fr AS (SELECT s1_id, min(model_rank) AS r FROM mr JOIN truth USING (s1_id, cand_id) GROUP BY s1_id), pr AS (SELECT entity_id, r FROM fx_source1 LEFT JOIN fr ON s1_id = entity_id)"
on_vectors("eval_rank_metrics", "SELECT count(*) AS n_queries, count(r) AS n_with_true, " + ", ".join(f"count(*) FILTER (r <= {k}) AS hits_{k}, count(*) FILTER (r <= {k})::DOUBLE / count(*) AS recall_{k}" for k in (1, 3, 5, 10)) + ", round(sum(1.0::DOUBLE / r) / count(*), 9) AS mrr_all, round(sum(1.0::DOUBLE / r) / count(r), 9) AS mrr_with_true FROM pr", _RM)
on_vectors("eval_rank_buckets", "SELECT " + ", ".join(f"count(*) FILTER (model_rank <= {k}) AS rank_{k}" for k in (1, 5, 10, 25, 50, 100, 350)) + " FROM mr JOIN truth USING (s1_id, cand_id)")
on_vectors("eval_error_ceiling", """SELECT count(*) AS n_true, count(*) FILTER (NOT hit) AS blocking_misses, count(*) FILTER (hit) AS reachable, count(m.s1_id) AS tp, count(*) FILTER (hit AND m.s1_id IS NULL) AS threshold_misses,
  (SELECT count(*) FROM matched ANTI JOIN truth USING (s1_id, cand_id)) AS fp FROM marked LEFT JOIN matched m USING (s1_id, cand_id)""", _COUNTRY, _HITS)
_MISS = "miss AS (SELECT s1_id, cand_id, coalesce(n, 0) AS n FROM marked LEFT JOIN (SELECT s1_id, count(*) AS n FROM cands GROUP BY s1_id) USING (s1_id) WHERE NOT hit)"
on_cands("eval_miss_simple", "SELECT CASE WHEN n = 10 THEN 'cap' WHEN n = 0 THEN 'zero_candidates' ELSE 'sparse' END AS cause, count(*) AS n_pairs, count(DISTINCT s1_id) AS n_queries FROM miss GROUP BY cause", _HITS, _MISS)
on_cands("eval_miss_reason", "SELECT s1_id, cand_id, n AS candidate_count, CASE WHEN n = 0 THEN 'zero_candidates' WHEN n >= 10 THEN 'cap_truncation' WHEN cand_id LIKE 'S2-%' THEN 's2_no_key' ELSE 's3_no_key' END AS reason FROM miss", _HITS, _MISS)
_MEET = "len(list_intersect(list_filter(string_split(a.{0}, ' '), lambda x: x <> ''), list_filter(string_split(b.{0}, ' '), lambda x: x <> ''))) > 0"
_TAGS = f"""tag AS (SELECT m.s1_id, m.cand_id, CASE WHEN a.entity_id IS NULL OR b.entity_id IS NULL THEN 'missing_record' WHEN n >= 10 AND ({_MEET.format("name_significant_tokens")} OR {_MEET.format("address_numbers")}) THEN 'cap_truncation' WHEN n >= 10 THEN 'name_mismatch'
  WHEN b.business_address = '' THEN 'missing_address' WHEN NOT ({_MEET.format("name_significant_tokens")}) THEN 'name_mismatch' WHEN NOT ({_MEET.format("business_address_clean")}) THEN 'address_mismatch' WHEN a.country_clean <> b.country_clean THEN 'country_mismatch' ELSE 'other_key_miss' END AS category
  FROM miss m LEFT JOIN clean a ON a.entity_id = m.s1_id LEFT JOIN clean b ON b.entity_id = m.cand_id),
nth AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY s1_id, cand_id) AS i FROM tag)"""
on_cands("eval_miss_detailed", "SELECT category, count(*) AS n_pairs, count(DISTINCT s1_id) AS n_queries, string_agg(s1_id || '>' || cand_id, ' ' ORDER BY i) FILTER (i <= 3) AS examples FROM nth GROUP BY category", _HITS, _MISS, _TAGS)
on_vectors("eval_confusion", f"SELECT tp, fp, fn, tn, precision_ AS precision, recall_ AS recall, {F1} AS f1 FROM (SELECT {_PR} FROM (SELECT count(*) FILTER (p >= 0.5 AND label = 1) AS tp, count(*) FILTER (p >= 0.5 AND label = 0) AS fp, count(*) FILTER (p < 0.5 AND label = 1) AS fn, count(*) FILTER (p < 0.5 AND label = 0) AS tn FROM vec))")
on_vectors("auc", """SELECT round(sum(neg * (tp - pos / 2.0::DOUBLE)) / ((SELECT sum(label) FROM vec) * (SELECT sum(1 - label) FROM vec)), 9) AS roc_auc, round(sum(pos * (pr + coalesce(lp, 1)) / 2) / (SELECT sum(label) FROM vec), 9) AS pr_auc
FROM (SELECT *, tp::DOUBLE / (tp + fp) AS pr, lag(tp::DOUBLE / (tp + fp)) OVER (ORDER BY p DESC) AS lp FROM (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp FROM (SELECT p, sum(label) AS pos, sum(1 - label) AS neg FROM vec GROUP BY p)))""")
on_vectors("eval_calibration", "SELECT least(floor(p * 5), 4)::INT AS bin, count(*) AS n_pairs, sum(label)::BIGINT AS n_true, sum(label)::DOUBLE / count(*) AS match_rate FROM vec GROUP BY bin")
_T = "(SELECT unnest([{0}]::DOUBLE[]) AS {1})"
_SWEEP = f"""SELECT threshold, tp, fp, n_true, precision_ AS precision, recall_ AS recall, {F05} AS f05 FROM (SELECT *, {_RATIO.format("tp", "tp + fp")} AS precision_, {_RATIO.format("tp", "n_true")} AS recall_
FROM (SELECT threshold, (SELECT count(*) FROM vec WHERE p >= threshold AND label = 1) AS tp, (SELECT count(*) FROM vec WHERE p >= threshold AND label = 0) AS fp, (SELECT count(*) FROM truth) AS n_true FROM {_T.format("0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9", "threshold")}))"""
on_vectors("eval_threshold_sweep", _SWEEP)
_GRID = "0.21, 0.31, 0.41, 0.52, 0.62"
_GRID_CTE = f"""th AS (SELECT unnest([{_GRID}]::DOUBLE[]) AS t), g AS (SELECT CASE WHEN country IN ('US', 'India') THEN country ELSE 'other' END AS grp, t, count(*) FILTER (label = 1 AND p >= t) AS tp, count(*) FILTER (label = 0 AND p >= t) AS fp FROM vec, th GROUP BY grp, t),
gg AS (SELECT grp, th.t, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp FROM th CROSS JOIN (SELECT unnest(['US', 'India', 'other']) AS grp) x LEFT JOIN g USING (grp, t)),
grid AS (SELECT t_us, t_india, t_other, tp, fp, n_true, precision_ AS precision, recall_ AS recall, {F05} AS f05 FROM (SELECT *, {_RATIO.format("tp", "tp + fp")} AS precision_, {_RATIO.format("tp", "n_true")} AS recall_
  FROM (SELECT a.t AS t_us, b.t AS t_india, c.t AS t_other, a.tp + b.tp + c.tp AS tp, a.fp + b.fp + c.fp AS fp, (SELECT count(*) FROM truth) AS n_true FROM gg a, gg b, gg c WHERE a.grp = 'US' AND b.grp = 'India' AND c.grp = 'other')))"""
on_vectors("eval_threshold_grid", "SELECT * FROM grid", _GRID_CTE)
on_vectors("eval_threshold_best", "SELECT * FROM grid ORDER BY f05 DESC, t_us, t_india, t_other LIMIT 1", _GRID_CTE)
_RUNS = " UNION ALL ".join(f"SELECT '{n}' AS experiment, {F05} AS f05, recall_ AS recall FROM (SELECT {_PR} FROM {_MICRO.format('m_' + n)})" for n in POLICIES)
on_vectors("exp_deltas", f"SELECT r.experiment, r.f05 - b.f05 AS delta_f05, r.recall - b.recall AS delta_recall, r.f05 > b.f05 AS retained FROM ({_RUNS}) r, ({_RUNS}) b WHERE b.experiment = 'global'", *[_decided(p, f"m_{n}") for n, p in POLICIES.items()])
# sources, sinks and streams
_ENTS = "SELECT source, entity_id, business_name, business_address, country FROM ents"
base("io_tsv", _ENTS)
base("io_ids", "SELECT entity_id FROM ents")
base("io_known", "SELECT entity_id, business_name FROM ents WHERE source = 'S2' AND entity_id IN (SELECT cand_id FROM fx_gt_pairs)")
ORACLES["io_id_lists"] = f"WITH {BASE}, {_GT_LISTS} SELECT source1_entity_id AS s1_id, matched_entity_ids AS ids FROM gt_lists"
ORACLES["io_resume"] = ORACLES["io_id_lists"]
base("io_status", "SELECT * FROM (VALUES ('S1', true, true), ('S2', true, true), ('S3', true, true), ('S4', false, false)) t(source, found, parsable)")
on_cands("stream_scoring", "SELECT s1_id, cand_id, score, evidence_rank FROM cands")
# validation
LISTS = f"""lines AS ({fixtures.LIST_LINES}),
lists AS (SELECT trim(substr(value, 1, instr(value, chr(9)) - 1)) AS s1_id, substr(value, instr(value, chr(9)) + 1) AS ids FROM lines WHERE trim(value) <> '' AND contains(value, chr(9))),
each_ AS (SELECT * FROM (SELECT s1_id, unnest(string_split(ids, ',')) AS cand_id FROM lists) WHERE trim(cand_id) <> '')"""


def on_lists(name: str, sql: str) -> None:
    ORACLES[name] = f"WITH {BASE},\n{LISTS}\n{sql}"


on_lists("val_malformed", "SELECT value FROM lines WHERE trim(value) <> '' AND NOT contains(value, chr(9))")
on_lists("val_dup_rows", "SELECT s1_id, count(*) AS n FROM lists GROUP BY s1_id HAVING count(*) > 1")
on_lists("val_dup_ids", "SELECT s1_id, (len(l) - len(list_distinct(l)))::BIGINT AS n_repeats FROM (SELECT s1_id, list_filter(string_split(ids, ','), lambda x: x <> '') AS l FROM lists) WHERE len(l) <> len(list_distinct(l))")
on_lists("val_self", "SELECT s1_id, cand_id FROM each_ WHERE cand_id LIKE 'S1-%'")
on_lists("val_prefix", "SELECT s1_id, cand_id FROM each_ WHERE NOT regexp_matches(cand_id, '^S[123]-')")
on_lists("val_report", """SELECT * FROM (SELECT 'malformed_line' AS rule, count(*) AS n FROM lines WHERE trim(value) <> '' AND NOT contains(value, chr(9)) UNION ALL SELECT 'duplicate_row', count(*) FROM (SELECT s1_id FROM lists GROUP BY s1_id HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_id', count(*) FROM (SELECT list_filter(string_split(ids, ','), lambda x: x <> '') AS l FROM lists) WHERE len(l) <> len(list_distinct(l)) UNION ALL SELECT 'self_match', count(*) FROM each_ WHERE cand_id LIKE 'S1-%' UNION ALL SELECT 'wrong_prefix', count(*) FROM each_ WHERE NOT regexp_matches(cand_id, '^S[123]-')
UNION ALL SELECT 'required', (SELECT count(*) FROM fx_source1 WHERE entity_id NOT IN (SELECT s1_id FROM lists)) + (SELECT count(DISTINCT s1_id) FROM lists WHERE s1_id NOT IN (SELECT entity_id FROM fx_source1)) UNION ALL SELECT 'unknown_id', count(*) FROM each_ WHERE cand_id NOT IN (SELECT entity_id FROM ents WHERE source <> 'S1')) WHERE n > 0""")
on_lists("val_unknown", "SELECT s1_id, cand_id FROM each_ WHERE cand_id NOT IN (SELECT entity_id FROM ents WHERE source <> 'S1')")
on_lists("val_required", "SELECT entity_id AS s1_id, 'missing' AS problem FROM fx_source1 WHERE entity_id NOT IN (SELECT s1_id FROM lists) UNION ALL SELECT DISTINCT s1_id, 'unexpected' FROM lists WHERE s1_id NOT IN (SELECT entity_id FROM fx_source1)")
on_lists("val_summary", "SELECT count(*) AS n_rows, count(*) FILTER (n = 0) AS n_empty, count(*) FILTER (n > 0) AS n_non_empty, sum(n)::BIGINT AS n_ids FROM (SELECT len(list_filter(string_split(ids, ','), lambda x: trim(x) <> '')) AS n FROM lists)")
on_cands("val_subset", "SELECT s1_id, count(*) AS n_outside FROM marked WHERE NOT hit GROUP BY s1_id", _HITS)
on_cands("val_candidate_audit", "SELECT (SELECT count(*) FROM fx_source1) AS n_rows, 0::BIGINT AS duplicate_rows, 0::BIGINT AS bad_keys, 0::BIGINT AS lists_with_repeats, 0::BIGINT AS self_matches, 0::BIGINT AS missing_or_unexpected")
