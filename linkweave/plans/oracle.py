"""DuckDB SQL for the catalogue's queries, written from the definitions and not from the plans."""

from __future__ import annotations

from linkweave.functions.normalize import ABBREVIATIONS, ADDRESS_STOP_WORDS, LEGAL_WORDS, SPELLED, STATES, latin_table

CAP, K, THRESHOLD, MARGIN = 20, 5, 0.45, 0.12
FULL_CAP, FULL_K = 5000, 100


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(map(_text, words)) + "]"


def _ascii(column: str) -> str:
    left, right = latin_table()
    out = f"translate({column}, {_text(left)}, {_text(right)})"
    for char, spelled in SPELLED.items():
        out = f"replace({out}, {_text(char)}, {_text(spelled)})"
    return f"CASE WHEN regexp_matches({column}, '[^\\x00-\\x7F]') THEN {out} ELSE {column} END"


def _strip(column: str) -> str:
    return rf"regexp_replace(coalesce({column}, ''), '^\s+|\s+\z', '', 'g')"


def _plain(column: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({column}, '[^\w\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _expand(column: str) -> str:
    for short, long in ABBREVIATIONS.items():
        column = rf"regexp_replace({column}, '\b{short}\b', '{long}', 'g')"
    return column


_RAW = r"""
raw AS (
  SELECT 'S' || (doc_id % 3 + 1) || '-' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS entity_id, 'S' || (doc_id % 3 + 1) AS source,
    regexp_replace(substr(text, 1, 60), '\s\S*\z', '') AS business_name,
    regexp_replace(substr(text, 61, 60), '\s\S*\z', '') || ' ' || CAST(10000 + n_chars % 90000 AS VARCHAR) AS business_address,
    upper(lang) AS country, md5(text) AS h
  FROM documents)"""

_NAMES = rf"""
nm0 AS (SELECT *, {_strip('business_name')} AS nraw, {_strip('business_address')} AS araw FROM raw),
nm1 AS (SELECT *, string_split({_plain("replace(lower(" + _ascii('nraw') + "), '&', ' and ')")}, ' ') AS every0, lower({_ascii('araw')}) AS alow FROM nm0),
nm2 AS (SELECT *, list_filter(every0, lambda t: t <> '') AS every FROM nm1),
nm3 AS (SELECT *, list_filter(every, lambda t: NOT list_contains({_list(LEGAL_WORDS)}, t) AND length(t) > 1) AS sig0 FROM nm2),
nm4 AS (SELECT *, CASE WHEN len(sig0) > 0 THEN sig0 ELSE every END AS sig, string_split({_expand(_plain('alow'))}, ' ') AS aevery FROM nm3),
nm5 AS (SELECT entity_id, source, country, h, business_name, business_address, array_to_string(list_sort(sig), ' ') AS name_canonical, list_sort(list_distinct(sig)) AS name_tokens,
    coalesce(sig[1], '') AS name_first_token, array_to_string(sig, '') AS name_concat_key,
    CASE WHEN length(coalesce(sig[1], '')) >= 3 THEN substr(sig[1], 1, 3) ELSE '' END AS name_char_prefix,
    array_to_string(list_sort(list_distinct(sig))[1:2], ' ') AS name_prefix_key, regexp_matches(nraw, '[^\x00-\x7F]') AS name_was_transliterated,
    array_to_string(aevery, ' ') AS addr_normalized, regexp_extract(alow, '\b(\d{{5,6}})\b', 1) AS addr_pincode,
    coalesce(list_filter(aevery, lambda t: list_contains({_list(STATES)}, t))[1], '') AS addr_state_abbr,
    list_sort(list_distinct(list_filter(aevery, lambda t: length(t) > 2 AND NOT regexp_full_match(t, '[0-9]+') AND NOT list_contains({_list(ADDRESS_STOP_WORDS)}, t)))) AS addr_tokens
  FROM nm4),
ent AS MATERIALIZED (SELECT * FROM nm5),
s1 AS (SELECT * FROM ent WHERE source = 'S1'),
cands AS (SELECT * FROM ent WHERE source <> 'S1')"""


def _index(tokens: str, name: str, k: int) -> str:
    return f"""
{name}_all AS (SELECT entity_id, source, country, unnest({tokens}) AS token FROM ent),
{name}_freq AS (SELECT *, count(*) OVER (PARTITION BY source, country, token) AS freq FROM {name}_all WHERE token <> ''),
{name} AS (SELECT entity_id, source, country, token, freq FROM
  (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY freq, token) AS rn FROM {name}_freq WHERE freq <= {CAP}) WHERE rn <= {k})"""


_INDEXES = _index("name_tokens", "name_ix", 3) + "," + _index("addr_tokens", "addr_ix", 4)


def _key_block(key: str, signal: str, cap: int | None) -> str:
    few = "" if cap is None else f"WHERE n <= {cap}"
    a = f"(SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY country, {key}) AS n FROM s1 WHERE {key} <> '') {few})"
    b = f"(SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY source, country, {key}) AS n FROM cands WHERE {key} <> '') {few})"
    return f"SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, '{signal}' AS signal FROM {a} a JOIN {b} b ON a.country = b.country AND a.{key} = b.{key}"


def _token_block(index: str, signal: str) -> str:
    return f"SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, '{signal}' AS signal FROM {index} a JOIN {index} b ON a.source = 'S1' AND b.source <> 'S1' AND a.country = b.country AND a.token = b.token"


_BLOCKS = {
    "name_prefix": _key_block("name_prefix_key", "name_prefix", CAP),
    "name_char_prefix": _key_block("name_char_prefix", "name_char_prefix", CAP),
    "name_token": _token_block("name_ix", "name_token"),
    "addr_pincode": _key_block("addr_pincode", "addr_pincode", None),
    "addr_token": _token_block("addr_ix", "addr_token"),
    "name_concat": _key_block("name_concat_key", "name_concat", CAP),
}


def _jaccard(a: str, b: str) -> str:
    return f"coalesce(CAST(len(list_intersect({a}, {b})) AS DOUBLE) / nullif(len(list_distinct(list_concat({a}, {b}))), 0), 0.0)"


def _similarity(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) = 0 AND length({b}) = 0 THEN 1.0 ELSE 1.0 - CAST(levenshtein({a}, {b}) AS DOUBLE) / greatest(length({a}), length({b})) END"


_PAIRS = f"""
bag AS ({' UNION ALL '.join(f'SELECT *, {i} AS o FROM ({sql})' for i, sql in enumerate(_BLOCKS.values()))}),
firsts AS (SELECT source1_entity_id, candidate_entity_id, min_by(signal, o) AS signal FROM bag GROUP BY 1, 2),
rated AS (SELECT f.*, 0.7 * CASE WHEN a.name_canonical = '' OR b.name_canonical = '' THEN 0.0 ELSE 100 * ({_similarity('a.name_canonical', 'b.name_canonical')}) END + 30.0 * {_jaccard('a.addr_tokens', 'b.addr_tokens')} AS score
  FROM firsts f JOIN s1 a ON a.entity_id = f.source1_entity_id JOIN cands b ON b.entity_id = f.candidate_entity_id),
top AS MATERIALIZED (SELECT source1_entity_id, candidate_entity_id, signal, score, round(score / 100, 6) AS prob FROM
  (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY round(score, 6) DESC, candidate_entity_id) AS rn FROM rated) WHERE rn <= {K})"""



def _indel(a: str, b: str) -> str:
    """200 * LCS / (both lengths): the LCS by a row of bits, one for each letter of ``a`` (names have less than 120)."""
    masks = f"list_transform(string_split({b}, ''), lambda c: CAST(list_sum(list_transform(string_split({a}, ''), lambda d, i: CASE WHEN d = c THEN CAST(1 AS HUGEINT) << (i - 1) ELSE CAST(0 AS HUGEINT) END)) AS HUGEINT))"
    ones = f"((CAST(1 AS HUGEINT) << length({a})) - 1)"
    row = f"list_reduce({masks}, lambda s, m: ((s + (s & m)) | (s - (s & m))) & {ones}, {ones})"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 200.0 * (length({a}) - bit_count({row})) / (length({a}) + length({b})) END"


_INDEL_SCORE = f"0.7 * {_indel('a.name_canonical', 'b.name_canonical')} + 30.0 * {_jaccard('a.addr_tokens', 'b.addr_tokens')}"
_RATED = f"irated AS (SELECT f.*, {_INDEL_SCORE} AS iscore FROM firsts f JOIN s1 a ON a.entity_id = f.source1_entity_id JOIN cands b ON b.entity_id = f.candidate_entity_id)"

_TRUTH = """
truth AS (SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id FROM raw a JOIN raw b ON a.source = 'S1' AND b.source <> 'S1' AND a.country = b.country AND a.h = b.h)"""

_FULL = ",".join([_NAMES, _INDEXES, _PAIRS, _TRUTH])
_ATTACHED = "SELECT t.source1_entity_id, t.candidate_entity_id, {} FROM top t JOIN s1 a ON a.entity_id = t.source1_entity_id JOIN cands b ON b.entity_id = t.candidate_entity_id"
_JACCARDS = _ATTACHED.format(f"round({_jaccard('a.name_tokens', 'b.name_tokens')}, 6) AS feat_name_jaccard, CAST(len(list_intersect(a.name_tokens, b.name_tokens)) AS DOUBLE) AS feat_name_overlap, round({_jaccard('a.addr_tokens', 'b.addr_tokens')}, 6) AS feat_addr_jaccard, CAST(len(list_intersect(a.addr_tokens, b.addr_tokens)) AS DOUBLE) AS feat_addr_overlap")


def _f_half() -> str:
    return "CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_true = 0 OR n_pred = 0 THEN 0.0 ELSE 1.25 * hits / (0.25 * n_true + n_pred) END"


def _tfidf(text: str, name: str) -> str:
    """From the definition: documents are the pairs' two texts, by country."""
    return f"""
{name}_docs AS (SELECT row_number() OVER () AS d, entity_id, country, side FROM (
    SELECT e.entity_id, e.country, 1 AS side FROM top t JOIN ent e ON e.entity_id = t.source1_entity_id
    UNION ALL SELECT e.entity_id, e.country, 2 FROM top t JOIN ent e ON e.entity_id = t.candidate_entity_id)),
{name}_n AS (SELECT country, count(*) AS n FROM {name}_docs GROUP BY 1),
{name}_tf AS (SELECT entity_id, country, token, count(*) AS tf FROM (SELECT entity_id, country, unnest(string_split({text}, ' ')) AS token FROM ent) WHERE token <> '' GROUP BY ALL),
{name}_df AS (SELECT d.country, f.token, count(*) AS df FROM {name}_docs d JOIN {name}_tf f ON f.entity_id = d.entity_id GROUP BY ALL),
{name}_w AS (SELECT f.entity_id, f.token, f.tf * (ln((1.0 + n.n) / (1.0 + x.df)) + 1) AS w FROM {name}_tf f JOIN {name}_df x ON x.country = f.country AND x.token = f.token JOIN {name}_n n ON n.country = f.country),
{name}_norm AS (SELECT entity_id, sqrt(sum(w * w)) AS norm FROM {name}_w GROUP BY 1),
{name} AS (SELECT t.source1_entity_id, t.candidate_entity_id, sum(p.w * q.w) / (any_value(u.norm) * any_value(v.norm)) AS c
  FROM top t JOIN {name}_w p ON p.entity_id = t.source1_entity_id JOIN {name}_w q ON q.entity_id = t.candidate_entity_id AND q.token = p.token
  JOIN {name}_norm u ON u.entity_id = t.source1_entity_id JOIN {name}_norm v ON v.entity_id = t.candidate_entity_id GROUP BY 1, 2)"""


def _counts(pred: str) -> str:
    return f"""
cnt AS (SELECT e.entity_id AS source1_entity_id, (SELECT count(*) FROM truth t WHERE t.source1_entity_id = e.entity_id) AS n_true,
  (SELECT count(*) FROM {pred} p WHERE p.source1_entity_id = e.entity_id) AS n_pred,
  (SELECT count(*) FROM {pred} p JOIN truth t USING (source1_entity_id, candidate_entity_id) WHERE p.source1_entity_id = e.entity_id) AS hits FROM s1 e)"""


_ACCEPTED = f"acc AS (SELECT * FROM (SELECT *, max(prob) OVER (PARTITION BY source1_entity_id) - prob AS gap FROM top) WHERE prob >= {THRESHOLD} AND round(gap, 10) <= {MARGIN})"


def _grid(points: str) -> str:
    return f"""
grid AS ({points}),
gaps AS (SELECT *, round(max(prob) OVER (PARTITION BY source1_entity_id) - prob, 10) AS gap FROM top),
per AS (SELECT g.g, p.source1_entity_id, count(*) AS n_pred, count(t.candidate_entity_id) AS hits FROM grid g JOIN gaps p ON p.prob >= g.threshold AND p.gap <= g.margin
  LEFT JOIN truth t ON t.source1_entity_id = p.source1_entity_id AND t.candidate_entity_id = p.candidate_entity_id GROUP BY 1, 2),
tr AS (SELECT e.entity_id AS source1_entity_id, count(t.candidate_entity_id) AS n_true FROM s1 e LEFT JOIN truth t ON t.source1_entity_id = e.entity_id GROUP BY 1),
f AS (SELECT g.g, g.threshold, g.margin, x.n_true, coalesce(per.n_pred, 0) AS n_pred, coalesce(per.hits, 0) AS hits FROM grid g CROSS JOIN tr x LEFT JOIN per ON per.g = g.g AND per.source1_entity_id = x.source1_entity_id)
SELECT CAST(g AS INT) AS g, round(threshold, 6) AS threshold, round(margin, 6) AS margin, round(avg({_f_half()}), 6) AS macro_f05 FROM f GROUP BY ALL"""


_BROKEN = """
broken0 AS (SELECT c_custkey AS k, 'S1-' || c_custkey AS source1_entity_id, CASE c_custkey % 7 WHEN 0 THEN 'S2-' || c_custkey || ',S2-' || c_custkey WHEN 1 THEN 'S1-' || c_custkey WHEN 2 THEN 'X-1, S3-9' WHEN 3 THEN ''
    ELSE ' S2-' || c_custkey || ' , ,S3-' || c_custkey END AS ids FROM customer),
broken AS (SELECT * FROM (SELECT * FROM broken0 UNION ALL SELECT * FROM broken0 WHERE k % 50 = 0) WHERE k % 11 <> 0),
broken_ids AS (SELECT k, source1_entity_id, trim(unnest(string_split(ids, ','))) AS id FROM broken)"""

_CTX = "SELECT l_orderkey AS order_key, l_linenumber AS candidate_entity_id, {} FROM lineitem"
_ORDER = "(PARTITION BY l_orderkey)"
_RANK = "(rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_orderkey, l_quantity) - 1) / 2.0) / count(l_quantity) OVER (PARTITION BY l_orderkey)"


def all_sql() -> dict[str, str]:
    raw, names, full = f"WITH {_RAW}", f"WITH {_RAW}, {_NAMES}", f"WITH {_RAW}, {_FULL}"
    indexed = f"{names}, {_INDEXES}"
    sql = {
        "source_entities": f"{raw} SELECT * FROM raw",
        "source_counts": f"{raw} SELECT source, country, count(*) AS n, count(DISTINCT entity_id) AS n_ids FROM raw GROUP BY 1, 2",
        "head_sample": f"{raw} SELECT entity_id, business_name FROM raw WHERE country = 'EN' ORDER BY entity_id LIMIT 25",
        "truth_restricted": f"{raw}, {_TRUTH} SELECT t.* FROM truth t JOIN raw a ON a.entity_id = t.source1_entity_id JOIN raw b ON b.entity_id = t.candidate_entity_id WHERE a.country <> 'FR' AND b.source = 'S2'",
        "try_cast_score": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS score FROM events",
        "entity_once": f"{raw} SELECT entity_id, min(n) AS business_name FROM (SELECT entity_id, business_name AS n FROM raw UNION ALL SELECT entity_id, '~' || business_name FROM raw) GROUP BY 1",
        "has_non_latin": rf"{raw} SELECT entity_id, regexp_matches(business_name, '[^\x00-\x7F]') AS non_latin FROM raw",
        "norm_name": f"{names} SELECT entity_id, name_canonical, array_to_string(name_tokens, ',') AS name_tokens, name_first_token, name_concat_key, name_char_prefix, name_prefix_key, name_was_transliterated FROM ent",
        "norm_address": f"{names} SELECT entity_id, addr_normalized, addr_pincode, addr_state_abbr, array_to_string(addr_tokens, ',') AS addr_tokens FROM ent",
        "pincode_extract": r"SELECT page_id, regexp_extract(lower(url), '\b(\d{5,6})\b', 1) AS pincode_url, regexp_extract(lower(html), '\b(\d{5,6})\b', 1) AS pincode_html FROM pages",
        "explode_tokens": f"{names} SELECT entity_id, unnest(name_tokens) AS token FROM ent",
        "token_freq": f"{names} SELECT source, country, token, count(*) AS freq FROM (SELECT source, country, unnest(name_tokens) AS token FROM ent) GROUP BY ALL",
        "rarest_k_index": f"{indexed} SELECT * FROM name_ix",
        "key_cap_filter": f"{names} SELECT country, name_char_prefix FROM s1 WHERE name_char_prefix <> '' GROUP BY ALL HAVING count(*) <= {CAP} INTERSECT SELECT country, name_char_prefix FROM cands WHERE name_char_prefix <> '' GROUP BY ALL HAVING count(*) <= {CAP}",
        "block_union_dedup": f"{full} SELECT * FROM firsts",
        "signal_counts": f"{full} SELECT substr(candidate_entity_id, 1, 2) AS source, signal, count(*) AS n_pairs FROM bag GROUP BY 1, 2",
        "candidates_topk": f"{full} SELECT source1_entity_id, candidate_entity_id, signal, round(score, 6) AS score FROM top",
        "candidate_lists_all_s1": f"{full} SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(t.candidate_entity_id, ',' ORDER BY t.candidate_entity_id), '') AS candidate_entity_ids FROM s1 e LEFT JOIN top t ON t.source1_entity_id = e.entity_id GROUP BY 1",
        "candidate_lists_by_score": f"{full} SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(t.candidate_entity_id, ',' ORDER BY round(t.score, 6) DESC, t.candidate_entity_id), '') AS candidate_entity_ids FROM s1 e LEFT JOIN top t ON t.source1_entity_id = e.entity_id GROUP BY 1",
        "feat_jaccard_overlap": f"{full} {_JACCARDS}",
        "feat_tfidf_cosine": f"{full}, {_tfidf('name_canonical', 'nt')}, {_tfidf('addr_normalized', 'adt')} SELECT t.source1_entity_id, t.candidate_entity_id, round(coalesce(nt.c, 0.0), 6) AS feat_name_tfidf, round(coalesce(adt.c, 0.0), 6) AS feat_addr_tfidf FROM top t LEFT JOIN nt ON nt.source1_entity_id = t.source1_entity_id AND nt.candidate_entity_id = t.candidate_entity_id LEFT JOIN adt ON adt.source1_entity_id = t.source1_entity_id AND adt.candidate_entity_id = t.candidate_entity_id",
        "feat_levenshtein": f"{full} " + _ATTACHED.format(f"round({_similarity('a.name_canonical', 'b.name_canonical')}, 6) AS feat_name_levenshtein, round({_similarity('a.addr_normalized', 'b.addr_normalized')}, 6) AS feat_addr_levenshtein"),
        "feat_jaro_winkler": f"{full} " + _ATTACHED.format("round(CASE WHEN a.name_canonical = '' AND b.name_canonical = '' THEN 1.0 ELSE jaro_winkler_similarity(a.name_canonical, b.name_canonical) END, 6) AS feat_name_jaro_winkler"),
        "feat_match_flags": f"{full} " + _ATTACHED.format("CAST(a.addr_pincode <> '' AND a.addr_pincode = b.addr_pincode AS INT) AS feat_pincode_match, CAST(coalesce(a.country = b.country, false) AS INT) AS feat_country_match"),
        "ctx_count": _CTX.format(f"count(l_linenumber) OVER {_ORDER} AS _grp_candidate_count"),
        "ctx_diff_max": _CTX.format(f"round(l_quantity - max(l_quantity) OVER {_ORDER}, 6) + 0.0 AS _grp_quantity_diff_max"),
        "ctx_zscore": _CTX.format(f"round((l_quantity - avg(l_quantity) OVER {_ORDER}) / (coalesce(stddev_samp(l_quantity) OVER {_ORDER}, 0) + 1e-5), 6) + 0.0 AS _grp_quantity_zscore"),
        "ctx_pct_rank": _CTX.format(f"round({_RANK}, 6) AS _grp_quantity_pct_rank"),
        "ctx_candidates": f"{full}, r AS (SELECT source1_entity_id, candidate_entity_id, round(score, 6) AS score FROM top) SELECT source1_entity_id, candidate_entity_id, score, count(*) OVER g AS _grp_candidate_count, round(score - max(score) OVER g, 6) + 0.0 AS _grp_score_diff_max, round((score - avg(score) OVER g) / (coalesce(stddev_samp(score) OVER g, 0) + 1e-5), 6) + 0.0 AS _grp_score_zscore, round((rank() OVER (PARTITION BY source1_entity_id ORDER BY score) + (count(*) OVER (PARTITION BY source1_entity_id, score) - 1) / 2.0) / count(*) OVER g, 6) AS _grp_score_pct_rank FROM r WINDOW g AS (PARTITION BY source1_entity_id)",
        "attach_labels": f"{full} SELECT t.source1_entity_id, t.candidate_entity_id, CAST(EXISTS (SELECT 1 FROM truth x WHERE x.source1_entity_id = t.source1_entity_id AND x.candidate_entity_id = t.candidate_entity_id) AS INT) AS label FROM top t",
        "separation_report": f"{full}, j AS ({_JACCARDS}), l AS (SELECT j.*, t.candidate_entity_id IS NOT NULL AS y FROM j LEFT JOIN truth t ON t.source1_entity_id = j.source1_entity_id AND t.candidate_entity_id = j.candidate_entity_id) SELECT 'feat_name_jaccard' AS feature, round(avg(feat_name_jaccard) FILTER (WHERE NOT y), 6) AS mean_negative, round(avg(feat_name_jaccard) FILTER (WHERE y), 6) AS mean_positive FROM l UNION ALL SELECT 'feat_addr_jaccard', round(avg(feat_addr_jaccard) FILTER (WHERE NOT y), 6), round(avg(feat_addr_jaccard) FILTER (WHERE y), 6) FROM l",
        "class_weight": "SELECT CAST(sum(toxic) AS BIGINT) AS n_pos, count(*) AS n_rows, round(least(greatest(sqrt((count(*) - greatest(sum(toxic), 1)) / greatest(sum(toxic), 1)), 1.0), 10.0), 6) AS scale_pos FROM labels",
        "fill_features": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN coalesce(CAST(quality AS DOUBLE), -999.0) ELSE -999.0 END AS quality, CAST(-999.0 AS DOUBLE) AS absent FROM labels",
        "predict_threshold_margin": f"{full}, {_ACCEPTED} SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(t.candidate_entity_id, ',' ORDER BY t.candidate_entity_id), '') AS matched_entity_ids FROM s1 e LEFT JOIN acc t ON t.source1_entity_id = e.entity_id GROUP BY 1",
        "macro_f05": f"{full}, {_ACCEPTED}, {_counts('acc')}, f AS (SELECT *, {_f_half()} AS f FROM cnt) SELECT round(avg(f), 6) AS macro_f05, round(coalesce(avg(f) FILTER (WHERE n_true = 0), 0), 6) AS singleton_acc, round(coalesce(avg(f) FILTER (WHERE n_true > 0), 0), 6) AS non_singleton_f05, count(*) AS n_entities, count(*) FILTER (WHERE n_true = 0) AS n_singletons FROM f",
        "tune_grid": f"{full}, {_grid('SELECT i AS g, CAST((30 + 2 * i) / 100.0 AS DOUBLE) AS threshold, CAST(1.0 AS DOUBLE) AS margin FROM range(32) r(i)')}",
        "tune_grid_fine": f"{full}, {_grid('SELECT 7 * i + j - 1 AS g, CAST((44 + i) / 100.0 AS DOUBLE) AS threshold, CAST([1.0, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05][j] AS DOUBLE) AS margin FROM range(13) r(i) CROSS JOIN range(1, 8) q(j)')}",
        "average_precision": "WITH p AS (SELECT (n_chars % 1000) / 1000.0 AS p, sum(toxic) AS tp, count(*) AS n FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1), c AS (SELECT tp, sum(tp) OVER (ORDER BY p DESC) AS ctp, sum(n) OVER (ORDER BY p DESC) AS cn FROM p) SELECT round(sum(tp * CAST(ctp AS DOUBLE) / cn) / sum(tp), 6) AS average_precision FROM c",
        "blocking_recall": f"{full}, {_counts('top')} SELECT count(*) AS s1_evaluated, count(*) FILTER (WHERE n_true > 0) AS s1_with_truth, CAST(sum(n_true) AS BIGINT) AS true_pairs, CAST(sum(hits) AS BIGINT) AS found_pairs, count(*) FILTER (WHERE n_true > 0 AND hits = n_true) AS fully_recalled, CAST(sum(n_pred) AS BIGINT) AS candidates, round(sum(hits) / nullif(sum(n_true), 0), 6) AS pair_recall, round(count(*) FILTER (WHERE n_true > 0 AND hits = n_true) / nullif(count(*) FILTER (WHERE n_true > 0), 0), 6) AS entity_recall, round(sum(n_pred) / count(*), 6) AS avg_candidates, round(1 - (sum(n_pred) / count(*)) / (SELECT count(*) FROM cands), 6) AS reduction_ratio FROM cnt",
        "missed_matches": f"{full}, m AS (SELECT * FROM truth t WHERE NOT EXISTS (SELECT 1 FROM top x WHERE x.signal = 'addr_token' AND x.source1_entity_id = t.source1_entity_id AND x.candidate_entity_id = t.candidate_entity_id)), few AS (SELECT DISTINCT source1_entity_id FROM m ORDER BY 1 LIMIT 10), n AS (SELECT m.*, row_number() OVER (PARTITION BY m.source1_entity_id ORDER BY m.candidate_entity_id) AS rn FROM m JOIN few ON few.source1_entity_id = m.source1_entity_id) SELECT n.source1_entity_id, n.candidate_entity_id, CAST(rn AS INT) AS rn, a.business_name AS s1_name, b.business_name AS cand_name, a.business_address AS s1_address, b.business_address AS cand_address FROM n JOIN raw a ON a.entity_id = n.source1_entity_id JOIN raw b ON b.entity_id = n.candidate_entity_id WHERE rn <= 3",
        "match_subset_antijoin": f"{full} SELECT * FROM truth EXCEPT SELECT source1_entity_id, candidate_entity_id FROM top WHERE CAST(substr(candidate_entity_id, 4) AS BIGINT) % 2 = 0",
        "candidates_indel_topk": f"{full}, {_RATED} SELECT source1_entity_id, candidate_entity_id, signal, round(iscore, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY round(iscore, 6) DESC, candidate_entity_id) AS rn FROM irated) WHERE (rn <= {K})",
        "expand_ids_roundtrip": f"{full} SELECT source1_entity_id, candidate_entity_id FROM top",
        "group_fold_integrity": f"{full} SELECT count(DISTINCT source1_entity_id) AS n_entities, CAST(1 AS BIGINT) AS most_folds, true AS low_fits, true AS high_fits FROM top",
        "validate_grouped": f"WITH {_BROKEN}, wanted AS (SELECT 'S1-' || c_custkey AS w, c_custkey AS k FROM customer WHERE c_custkey % 13 <> 0), ids AS (SELECT source1_entity_id, id, count(*) AS n FROM broken_ids WHERE id <> '' GROUP BY 1, 2) SELECT 'duplicate_row' AS rule, source1_entity_id, CAST(NULL AS VARCHAR) AS id FROM broken GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'missing_s1', w, NULL FROM wanted WHERE w NOT IN (SELECT source1_entity_id FROM broken) UNION ALL SELECT DISTINCT 'extra_s1', source1_entity_id, CAST(NULL AS VARCHAR) FROM broken WHERE source1_entity_id NOT IN (SELECT w FROM wanted) UNION ALL SELECT 'duplicate_in_list', source1_entity_id, id FROM ids WHERE n > 1 UNION ALL SELECT 'self_match', source1_entity_id, id FROM ids WHERE starts_with(id, 'S1-') UNION ALL SELECT 'wrong_prefix', source1_entity_id, id FROM ids WHERE NOT regexp_matches(id, '^S[123]-') UNION ALL SELECT 'unknown_id', source1_entity_id, id FROM ids WHERE regexp_matches(id, '^S[23]-') AND substr(id, 4) NOT IN (SELECT CAST(k AS VARCHAR) FROM wanted)",
        "missing_and_extra_ids": "WITH a AS (SELECT c_custkey AS id FROM customer WHERE c_custkey % 3 <> 0), b AS (SELECT DISTINCT o_custkey AS id FROM orders) SELECT id, 'missing' AS side FROM a WHERE id NOT IN (SELECT id FROM b) UNION ALL SELECT id, 'extra' FROM b WHERE id NOT IN (SELECT id FROM a)",
        "id_universe": f"{raw} SELECT DISTINCT entity_id FROM raw WHERE source IN ('S2', 'S3')",
        "expand_ids": f"WITH {_BROKEN} SELECT source1_entity_id, id AS candidate_entity_id FROM broken_ids WHERE id <> ''",
        "id_sets": f"WITH {_BROKEN} SELECT k, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(ids, ','), lambda x: trim(x)), lambda x: x <> ''))), '|') AS id_set FROM broken",
    }
    sql |= {f"block_{signal}": f"{full} {block}" for signal, block in _BLOCKS.items()}
    one_size = {
        "indel_score": f"{full} " + _ATTACHED.format(f"round({_INDEL_SCORE}, 6) AS score"),
        "feature_frame": f"{full}, {_tfidf('name_canonical', 'nt')}, {_tfidf('addr_normalized', 'adt')}, j AS ({_JACCARDS}), l AS ({sql['feat_levenshtein'].removeprefix(full)}), w AS ({sql['feat_jaro_winkler'].removeprefix(full)}), m AS ({sql['feat_match_flags'].removeprefix(full)})"
        " SELECT t.source1_entity_id, t.candidate_entity_id, t.signal, round(t.score, 6) AS score, j.feat_name_jaccard, j.feat_name_overlap, j.feat_addr_jaccard, j.feat_addr_overlap, round(coalesce(nt.c, 0.0), 6) AS feat_name_tfidf, round(coalesce(adt.c, 0.0), 6) AS feat_addr_tfidf,"
        " l.feat_name_levenshtein, w.feat_name_jaro_winkler, l.feat_addr_levenshtein, m.feat_pincode_match, m.feat_country_match FROM top t"
        " JOIN j USING (source1_entity_id, candidate_entity_id) JOIN l USING (source1_entity_id, candidate_entity_id) JOIN w USING (source1_entity_id, candidate_entity_id) JOIN m USING (source1_entity_id, candidate_entity_id)"
        " LEFT JOIN nt ON nt.source1_entity_id = t.source1_entity_id AND nt.candidate_entity_id = t.candidate_entity_id LEFT JOIN adt ON adt.source1_entity_id = t.source1_entity_id AND adt.candidate_entity_id = t.candidate_entity_id",
    }
    full_size = lambda text: text.replace(f"<= {CAP}", f"<= {FULL_CAP}").replace(f"rn <= {K})", f"rn <= {FULL_K})")
    wide = {name: full_size(text) for name, text in sql.items()}
    return sql | {name: full_size(text) for name, text in one_size.items()} | {f"{name}_full": text for name, text in wide.items() if text != sql[name] and name != "block_addr_pincode"}
