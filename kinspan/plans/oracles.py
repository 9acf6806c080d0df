"""SQL (DuckDB's) that gives the same rows as the driver's queries."""

from __future__ import annotations

from kinspan.functions.normalize import JUNK, NOT_WORD, SPACE, STREETS, SUFFIXES
from kinspan.operators.blocking import STOPWORDS
from kinspan.operators.decide import GRID


def _case(lookup: dict[str, str]) -> str:
    return "CASE x " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in lookup.items()) + " ELSE x END"


def _punct(c: str) -> str:
    return f"trim(regexp_replace(replace({c}, '&', ' and '), '{NOT_WORD}', ' ', 'g'))"


def _words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda x : x <> '')"


def _spaces(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SPACE}+', ' ', 'g'))"


def _grams(c: str, n: int) -> str:
    t = f"replace({c}, ' ', '')"
    return f"CASE WHEN length({t}) = 0 THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, greatest(length({t}) - {n - 1}, 1) + 1), lambda i : substring({t}, i, {n}))) END"


def _jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len(list_distinct(list_concat({a}, {b}))) = 0 THEN 1.0 ELSE len(list_intersect(list_distinct({a}), list_distinct({b})))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END"


def _lcs(a: str, b: str) -> str:
    """Bits of a HUGEINT are a column of the table; strings are shorter than 126 characters."""
    full = f"((1::HUGEINT << length({a})::INT) - 1)"
    mask = f"list_transform(range(1, length({b}) + 1), lambda j : coalesce(list_sum(list_transform(range(1, length({a}) + 1), lambda i : CASE WHEN substring({a}, i, 1) = substring({b}, j, 1) THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END)), 0)::HUGEINT)"
    return f"(length({a}) - bit_count(list_reduce({mask}, lambda s, m : ((s + (s & m)) | (s - (s & m))) & {full}, {full})))"


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 1.0 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0 ELSE 2.0::DOUBLE * {_lcs(a, b)} / (length({a}) + length({b})) END"


RECORDS = r"""fields AS (
 SELECT doc_id, lang, n_chars, coalesce(array_to_string(ws[substring(list_min(ks), 33)::INT:substring(list_min(ks), 33)::INT + 4], ' '), '') AS name, coalesce(array_to_string(ws[substring(list_max(ks), 33)::INT:substring(list_max(ks), 33)::INT + 6], ' '), '') AS place,
  coalesce(array_to_string(ws[substring(list_min(list_transform(ks, lambda k : substring(k, 17))), 17)::INT:substring(list_min(list_transform(ks, lambda k : substring(k, 17))), 17)::INT + 9], ' '), '') AS passage
 FROM (SELECT *, list_transform(range(1, len(ws) + 1), lambda i : md5(array_to_string(ws[i:i + 2], ' ')) || lpad(CAST(i AS VARCHAR), 9, '0')) AS ks
  FROM (SELECT doc_id, lang, n_chars, list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda x : length(x) <= 12) AS ws FROM documents))),
records AS (
 SELECT 'S' || CAST(1 + doc_id % 3 AS VARCHAR) || '-' || CAST(doc_id AS VARCHAR) AS entity_id, 'S' || CAST(1 + doc_id % 3 AS VARCHAR) AS source,
  CASE doc_id % 3 WHEN 0 THEN name || ' Private Limited' WHEN 1 THEN name || ' Pvt Ltd' ELSE '-- ' || name || ' & Co' END AS business_name,
  coalesce(place || ', ' || CAST(n_chars AS VARCHAR) || CASE doc_id % 3 WHEN 0 THEN ' Main Street' ELSE ' Main St' END, '') AS business_address,
  coalesce(lang, '') AS country, passage
 FROM fields)"""

PREP = f"""words AS (
 SELECT *, {_spaces("lower(country)")} AS country_norm, {_words(_punct(f"lower(regexp_replace(business_name, '{JUNK}', ''))"))} AS nw, {_words(_punct("lower(business_address)"))} AS aw,
  regexp_extract_all(business_address, '\\p{{Nd}}+') AS digit_tokens FROM records),
prep AS (
 SELECT *, array_to_string(name_tokens, ' ') AS name_norm, array_to_string(addr_tokens, ' ') AS addr_norm FROM (
  SELECT *, list_transform(nw, lambda x : {_case(SUFFIXES)}) AS name_tokens, list_transform(aw, lambda x : {_case(STREETS)}) AS addr_tokens FROM words))"""

KEYS = f"""keys AS (
 SELECT entity_id, source, country_norm, 'name_token' AS key_type, u.k AS key FROM prep, UNNEST(name_tokens) AS u(k) WHERE length(u.k) >= 3
 UNION ALL SELECT entity_id, source, country_norm, 'name_prefix', substring(array_to_string(name_tokens, ''), 1, 4) FROM prep WHERE length(array_to_string(name_tokens, '')) >= 4
 UNION ALL SELECT entity_id, source, country_norm, 'addr_digit', u.k FROM prep, UNNEST(digit_tokens) AS u(k) WHERE length(u.k) >= 3
 UNION ALL SELECT entity_id, source, country_norm, 'addr_token', u.k FROM prep, UNNEST(addr_tokens) AS u(k)
  WHERE length(u.k) >= 3 AND u.k NOT IN ({", ".join(f"'{w}'" for w in STOPWORDS)}) AND NOT regexp_full_match(u.k, '\\p{{Nd}}+')),
posts AS (SELECT source, key_type, country_norm, key, count(*) AS n FROM keys GROUP BY ALL)"""


def _pairs(posting: int, product: int) -> str:
    return f"""kept AS (
 SELECT r.source, r.key_type, r.country_norm, r.key, l.n AS left_n, r.n AS right_n FROM posts r JOIN posts l ON l.source = 'S1' AND r.source <> 'S1' AND l.key_type = r.key_type AND l.country_norm = r.country_norm AND l.key = r.key
 WHERE l.n <= {posting} AND r.n <= {posting} AND l.n * r.n <= {product}),
pairs AS (
 SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, b.source, sum(CASE b.key_type WHEN 'addr_digit' THEN 3.0::DOUBLE WHEN 'name_token' THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END / log2(k.right_n + 2.0::DOUBLE)) AS weight
 FROM kept k JOIN keys a ON a.source = 'S1' AND a.key_type = k.key_type AND a.country_norm = k.country_norm AND a.key = k.key
  JOIN keys b ON b.source = k.source AND b.key_type = k.key_type AND b.country_norm = k.country_norm AND b.key = k.key GROUP BY 1, 2, 3),
cands AS (
 SELECT * FROM (SELECT source1_entity_id, candidate_entity_id, source, round(weight, 6) AS weight, row_number() OVER (PARTITION BY source1_entity_id ORDER BY round(weight, 6) DESC, candidate_entity_id) AS rank FROM pairs) WHERE rank <= 10)"""


WIDE = """wide AS (
 SELECT c.source1_entity_id, c.candidate_entity_id, c.source, """ + ", ".join(f"{t}.{c} AS {c}_{t}" for t in "lr" for c in ("business_name", "name_norm", "addr_norm", "name_tokens", "addr_tokens", "digit_tokens", "country_norm")) + """
 FROM cands c JOIN prep l ON l.entity_id = c.source1_entity_id JOIN prep r ON r.entity_id = c.candidate_entity_id)"""

TRUTH = """truth AS (SELECT l.entity_id AS source1_entity_id, r.entity_id AS candidate_entity_id FROM records l JOIN records r ON l.source = 'S1' AND r.source <> 'S1' AND l.country = r.country AND l.passage = r.passage AND l.passage <> ''),
entities AS (SELECT entity_id AS source1_entity_id FROM records WHERE source = 'S1'),
truth_table AS (SELECT e.source1_entity_id, coalesce(t.ids, []::VARCHAR[]) AS ids FROM entities e LEFT JOIN (SELECT source1_entity_id, list_sort(list_distinct(list(candidate_entity_id))) AS ids FROM truth GROUP BY 1) t USING (source1_entity_id))"""


def _rarity(f: str) -> str:
    return f"""rarity_{f} AS (
 SELECT t.source, t.token, ln((SELECT 2.0 * count(*) FROM wide w WHERE w.source = t.source) / count(*)) AS weight FROM (
  SELECT source, u.x AS token FROM wide, UNNEST(list_distinct({f}_tokens_l)) AS u(x) UNION ALL SELECT source, u.x FROM wide, UNNEST(list_distinct({f}_tokens_r)) AS u(x)) t GROUP BY 1, 2),
rare_{f} AS (
 SELECT s.source1_entity_id, s.candidate_entity_id, max(r.weight) AS weight FROM (
  SELECT source1_entity_id, candidate_entity_id, source, u.x AS token FROM wide, UNNEST(list_intersect(list_distinct({f}_tokens_l), list_distinct({f}_tokens_r))) AS u(x)) s JOIN rarity_{f} r ON r.source = s.source AND r.token = s.token GROUP BY 1, 2)"""


def _tfidf(f: str) -> str:
    cut = lambda k: f"list_transform(range(1, greatest(length(w) - {k - 1}, 1) + 1), lambda i : substring(w, i, {k}))"
    return f"""texts_{f} AS (SELECT DISTINCT source, t FROM (SELECT source, {f}_norm_l AS t FROM wide UNION ALL SELECT source, {f}_norm_r FROM wide) WHERE t <> ''),
tf_{f} AS (
 SELECT source, t, g.g, count(*) AS tf FROM (SELECT source, t, ' ' || u.w || ' ' AS w FROM texts_{f}, UNNEST(string_split(t, ' ')) AS u(w) WHERE u.w <> ''),
  UNNEST(CASE WHEN length(w) <= 3 THEN {cut(3)} ELSE list_concat({cut(3)}, {cut(4)}) END) AS g(g) GROUP BY 1, 2, 3),
df_{f} AS (SELECT source, g, count(*) AS df, row_number() OVER (PARTITION BY source ORDER BY sum(tf) DESC, g) AS r FROM tf_{f} GROUP BY 1, 2),
w_{f} AS (SELECT a.source, a.t, a.g, a.tf * (ln((1.0 + n.n) / (1.0 + d.df)) + 1.0) AS x FROM tf_{f} a JOIN df_{f} d ON d.source = a.source AND d.g = a.g AND d.r <= 200000 JOIN (SELECT source, count(*) AS n FROM texts_{f} GROUP BY 1) n ON n.source = a.source),
v_{f} AS (SELECT source, t, g, x / sqrt(sum(x * x) OVER (PARTITION BY source, t)) AS x FROM w_{f}),
cos_{f} AS (
 SELECT p.source, p.l, p.r, sum(a.x * b.x) AS cosine FROM (SELECT DISTINCT source, {f}_norm_l AS l, {f}_norm_r AS r FROM wide) p
  JOIN v_{f} a ON a.source = p.source AND a.t = p.l JOIN v_{f} b ON b.source = p.source AND b.t = p.r AND b.g = a.g GROUP BY 1, 2, 3)"""


SCORED = """scored AS (SELECT w.source1_entity_id, w.candidate_entity_id, w.name_norm_l, w.name_norm_r, round(coalesce(c.cosine, 0.0), 4) AS score FROM wide w LEFT JOIN cos_name c ON c.source = w.source AND c.l = w.name_norm_l AND c.r = w.name_norm_r),
accepted AS (SELECT source1_entity_id, candidate_entity_id, score FROM (SELECT *, max(score) OVER (PARTITION BY source1_entity_id) AS best FROM scored) WHERE best >= 0.6 AND score >= 0.4)"""

#: precision, recall and F of counts p (predicted), t (true) and h (both).
_METRICS = """CASE WHEN t = 0 AND p = 0 THEN 1.0 WHEN t = 0 OR p = 0 THEN 0.0 ELSE h::DOUBLE / p END AS pr, CASE WHEN t = 0 THEN 1.0 WHEN p = 0 THEN 0.0 ELSE h::DOUBLE / t END AS re,
 CASE WHEN t = 0 AND p = 0 THEN 1.0 WHEN h = 0 THEN 0.0 ELSE 1.25 * (h::DOUBLE / p) * (h::DOUBLE / t) / (0.25 * (h::DOUBLE / p) + h::DOUBLE / t) END AS f"""


def _per_entity(predicted: str) -> str:
    return f"""counts AS (
 SELECT e.source1_entity_id, coalesce(a.p, 0) AS p, coalesce(b.t, 0) AS t, coalesce(c.h, 0) AS h FROM entities e
  LEFT JOIN (SELECT source1_entity_id, count(*) AS p FROM {predicted} GROUP BY 1) a USING (source1_entity_id) LEFT JOIN (SELECT source1_entity_id, count(*) AS t FROM truth GROUP BY 1) b USING (source1_entity_id)
  LEFT JOIN (SELECT x.source1_entity_id, count(*) AS h FROM {predicted} x JOIN truth y USING (source1_entity_id, candidate_entity_id) GROUP BY 1) c USING (source1_entity_id)),
per AS (SELECT *, {_METRICS} FROM counts)"""


def _grid(scores: str) -> str:
    steps = ", ".join(f"({t}::DOUBLE)" for t in GRID)
    return f"""steps AS (SELECT * FROM (VALUES {steps}) AS v(threshold)), models AS (SELECT DISTINCT model FROM {scores}),
gc AS (SELECT s.model, g.threshold, s.source1_entity_id, count(*) AS p, count(y.source1_entity_id) AS h FROM {scores} s JOIN steps g ON s.score >= g.threshold LEFT JOIN truth y USING (source1_entity_id, candidate_entity_id) GROUP BY 1, 2, 3),
gall AS (SELECT m.model, g.threshold, {_METRICS} FROM (
  SELECT m.model, g.threshold, e.source1_entity_id, coalesce(c.p, 0) AS p, coalesce(c.h, 0) AS h, coalesce(b.t, 0) AS t FROM entities e CROSS JOIN steps g CROSS JOIN models m
   LEFT JOIN gc c ON c.model = m.model AND c.threshold = g.threshold AND c.source1_entity_id = e.source1_entity_id LEFT JOIN (SELECT source1_entity_id, count(*) AS t FROM truth GROUP BY 1) b ON b.source1_entity_id = e.source1_entity_id) AS m JOIN steps g USING (threshold)),
grid AS (SELECT model, threshold, count(*) AS n_entities, avg(pr) AS macro_precision, avg(re) AS macro_recall, avg(f) AS macro_f_beta FROM gall GROUP BY 1, 2),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY round(macro_f_beta, 12) DESC, threshold) AS r FROM grid) WHERE r = 1)"""


_GRID_COLUMNS = "threshold, n_entities, round(macro_precision, 4) AS macro_precision, round(macro_recall, 4) AS macro_recall, round(macro_f_beta, 4) AS macro_f_beta"

CORRUPTED = """numbered AS (SELECT source1_entity_id AS e, ids, (strpos('0123456789abcdef', substring(md5(source1_entity_id), 1, 1)) - 1) % 8 AS n FROM truth_table),
bad AS (SELECT CASE WHEN n = 4 THEN 'Q-' || e ELSE e END AS s1, CASE n WHEN 0 THEN list_concat(ids, ['S2-1', 'S2-1']) WHEN 1 THEN list_concat(ids, [e]) WHEN 2 THEN list_concat(ids, ['X-9', '']) WHEN 3 THEN list_concat(ids, ['S3-none']) ELSE ids END AS ids, n FROM numbered),
lines AS (SELECT s1, ids FROM bad UNION ALL SELECT s1, ids FROM bad WHERE n = 5),
each AS (SELECT DISTINCT s1, u.id FROM lines, UNNEST(ids) AS u(id))"""


def _finding(rule: str, items: str, severity: str = "error") -> str:
    return f"SELECT '{severity}' AS severity, '{rule}' AS rule, count(*) AS n, array_to_string(list_slice(list_sort(list(item)), 1, 5), ', ') AS examples FROM (SELECT DISTINCT item FROM ({items})) HAVING count(*) > 0"


def _with(select: str, *parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def oracle_sql() -> dict[str, str]:
    full, low = _pairs(500, 50_000), _pairs(100, 10_000)
    prep = (RECORDS, PREP)
    keys = (*prep, KEYS)
    wide = (*keys, full, WIDE)
    scored = (*wide, _tfidf("name"), SCORED, TRUTH)
    pair = "source1_entity_id, candidate_entity_id"
    n3 = _grams("name_norm", 3)
    flag = lambda a, b: f"CAST({a} = {b} AS INT)::DOUBLE"
    length = lambda c: f"greatest(length({c}), 1)"
    nj, aj = _jaccard("name_tokens_l", "name_tokens_r"), _jaccard("addr_tokens_l", "addr_tokens_r")
    ce = flag("country_norm_l", "country_norm_r")
    sort = lambda c: f"array_to_string(list_sort({c}), ' ')"
    lists = lambda src, col: f"SELECT e.source1_entity_id, coalesce(x.ids, '') AS {col} FROM (SELECT DISTINCT entity_id AS source1_entity_id FROM records WHERE source = 'S1') e LEFT JOIN (SELECT source1_entity_id, array_to_string(list_sort(list_distinct(list(candidate_entity_id))), ',') AS ids FROM {src} GROUP BY 1) x USING (source1_entity_id)"
    lr = lambda f, e: f"length({f}_norm_{e})"
    sets = """sets AS (SELECT *, length(met) AS s, CASE WHEN length(met) > 0 THEN 1 ELSE 0 END AS gap FROM (
 SELECT source1_entity_id, candidate_entity_id, len(name_tokens_l) AS nl, len(name_tokens_r) AS nr, array_to_string(list_sort(list_intersect(list_distinct(name_tokens_l), list_distinct(name_tokens_r))), ' ') AS met,
  array_to_string(list_sort(list_filter(list_distinct(name_tokens_l), lambda x : NOT list_contains(name_tokens_r, x))), ' ') AS da, array_to_string(list_sort(list_filter(list_distinct(name_tokens_r), lambda x : NOT list_contains(name_tokens_l, x))), ' ') AS db FROM wide)),
ratios AS (SELECT *, CASE WHEN nl = 0 OR nr = 0 OR (s > 0 AND (length(da) = 0 OR length(db) = 0)) THEN NULL WHEN length(da) + length(db) = 0 THEN 0 ELSE length(da) + length(db) - 2 * CASE WHEN length(da) = 0 OR length(db) = 0 THEN 0 ELSE """ + _lcs("da", "db") + """ END END AS dist FROM sets)"""
    split = """h AS (SELECT source1_entity_id, md5('42:' || source1_entity_id) AS h FROM (SELECT DISTINCT source1_entity_id FROM entities)),
split AS (SELECT source1_entity_id, CASE WHEN row_number() OVER (ORDER BY h, source1_entity_id) <= floor((SELECT count(*) FROM h) * 0.15::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM h)"""
    label = """lab AS (SELECT c.*, CASE WHEN t.source1_entity_id IS NULL THEN 0 ELSE 1 END AS label FROM cands c LEFT JOIN truth t USING (source1_entity_id, candidate_entity_id))"""
    describe = lambda kind, items: f"SELECT {pair.replace('source1', 'x.source1').replace('candidate_', 'x.candidate_')}, l.business_name AS s1_name, l.business_address AS s1_address, r.business_name AS other_name, r.business_address AS other_address, '{kind}' AS kind FROM (SELECT * FROM {items} ORDER BY {pair} LIMIT 30) x JOIN records l ON l.entity_id = x.source1_entity_id JOIN records r ON r.entity_id = x.candidate_entity_id"
    fp = f"fp AS (SELECT {pair} FROM accepted EXCEPT SELECT {pair} FROM truth), fn AS (SELECT {pair} FROM truth EXCEPT SELECT {pair} FROM accepted)"
    models = (*scored, f"named AS (SELECT 'tfidf_retrieval' AS model, {pair}, score FROM scored UNION ALL SELECT 'exact_name', {pair}, {flag('name_norm_l', 'name_norm_r')} FROM scored)", _grid("named"))
    one = (*scored, "named AS (SELECT 'one' AS model, * FROM scored)", _grid("named"))
    return {
        "norm_name_tokens": _with("SELECT entity_id, name_norm AS tokens FROM prep", *prep),
        "norm_addr_tokens": _with("SELECT entity_id, addr_norm AS tokens FROM prep", *prep),
        "norm_strings": _with(f"SELECT entity_id, name_norm, addr_norm, {_spaces('business_name')} AS name_spaces, regexp_replace(business_name, '{JUNK}', '') AS name_junk, lower(business_name) AS name_lower, {_punct('business_name')} AS name_punct, array_to_string({_words(_spaces('business_name'))}, '|') AS name_words FROM prep", *prep),
        "digit_tokens": _with("SELECT entity_id, array_to_string(digit_tokens, ' ') AS digits FROM prep", *prep),
        "char_ngrams": _with(f"SELECT entity_id, len({n3})::BIGINT AS n, array_to_string(list_sort({n3}), '|') AS grams FROM prep", *prep),
        "alnum_fingerprint": _with("SELECT entity_id, regexp_replace(lower(business_name), '[^a-z0-9]', '', 'g') AS fingerprint FROM records", RECORDS),
        "country_norm": _with("SELECT entity_id, " + _spaces("lower('  ' || country || ' \t X ')") + " AS country_norm FROM records", RECORDS),
        "block_keys": _with("SELECT entity_id, source, country_norm, key_type, key FROM keys", *keys),
        "key_posting_counts": _with("SELECT * FROM posts", *keys),
        "pruned_keys": _with("SELECT * FROM kept", *keys, full),
        "pruned_keys_lowcap": _with("SELECT * FROM kept", *keys, low),
        "key_pair_estimate": _with("SELECT source, sum(left_n * right_n)::BIGINT AS estimated_pairs FROM kept GROUP BY 1", *keys, full),
        "pair_weights": _with(f"SELECT {pair}, source, round(weight, 4) AS weight FROM pairs", *keys, full),
        "candidates_topk": _with(f"SELECT {pair}, source, weight, rank FROM cands", *keys, full),
        "candidates_topk_lowcap": _with(f"SELECT {pair}, source, weight, rank FROM cands", *keys, low),
        "candidate_lists": _with(lists("cands", "candidate_entity_ids"), *keys, full),
        "feat_exact": _with(f"SELECT {pair}, {flag('business_name_l', 'business_name_r')} AS name_exact_raw, {flag('name_norm_l', 'name_norm_r')} AS name_exact_norm, {flag('addr_norm_l', 'addr_norm_r')} AS addr_exact_norm, {ce} AS country_exact FROM wide", *wide),
        "feat_jaccard": _with(f"SELECT {pair}, round({nj}, 4) AS name_jaccard, round({aj}, 4) AS addr_jaccard FROM wide", *wide),
        "feat_ngram_jaccard": _with(f"SELECT {pair}, round({_jaccard('gl', 'gr')}, 4) AS name_char_ngram_jaccard FROM (SELECT *, {_grams('name_norm_l', 3)} AS gl, {_grams('name_norm_r', 3)} AS gr FROM wide)", *wide),
        "feat_lengths": _with("SELECT " + pair + ", " + ", ".join(f"round(least({length(f + '_norm_l')}, {length(f + '_norm_r')})::DOUBLE / greatest({length(f + '_norm_l')}, {length(f + '_norm_r')}), 4) AS {f}_len_ratio, abs({length(f + '_norm_l')} - {length(f + '_norm_r')})::DOUBLE AS {f}_len_diff" for f in ("name", "addr")) + ", abs(len(name_tokens_l) - len(name_tokens_r))::DOUBLE AS name_token_count_diff FROM wide", *wide),
        "feat_shared_digit": _with(f"SELECT {pair}, CAST(list_has_any(digit_tokens_l, digit_tokens_r) AS INT)::DOUBLE AS addr_shared_digit_token FROM wide", *wide),
        "feat_cross": _with(f"SELECT {pair}, round(({nj}) * ({aj}), 6) AS name_x_addr_jaccard, round({ce} * ({nj}), 6) AS country_x_name_jaccard, round({ce} * ({aj}), 6) AS country_x_addr_jaccard FROM wide", *wide),
        "token_rarity": _with("SELECT source, token, round(weight, 4) AS weight, 'name' AS field FROM rarity_name UNION ALL SELECT source, token, round(weight, 4), 'addr' FROM rarity_addr", *wide, _rarity("name"), _rarity("addr")),
        "feat_shared_rare": _with(f"SELECT {pair}, round(coalesce(n.weight, 0.0), 4) AS name_shared_rare_token, round(coalesce(a.weight, 0.0), 4) AS addr_shared_rare_token FROM wide LEFT JOIN rare_name n USING ({pair}) LEFT JOIN rare_addr a USING ({pair})", *wide, _rarity("name"), _rarity("addr")),
        "feat_tfidf_cosine": _with(f"SELECT {pair}, round(coalesce(n.cosine, 0.0), 4) AS name_tfidf_cosine, round(coalesce(a.cosine, 0.0), 4) AS addr_tfidf_cosine FROM wide w LEFT JOIN cos_name n ON n.source = w.source AND n.l = w.name_norm_l AND n.r = w.name_norm_r LEFT JOIN cos_addr a ON a.source = w.source AND a.l = w.addr_norm_l AND a.r = w.addr_norm_r", *wide, _tfidf("name"), _tfidf("addr")),
        "feat_indel_ratio": _with(f"SELECT {pair}, round({_ratio('name_norm_l', 'name_norm_r')}, 4) AS name_levenshtein, round({_ratio('addr_norm_l', 'addr_norm_r')}, 4) AS addr_levenshtein FROM wide", *wide),
        "feat_token_sort": _with(f"SELECT {pair}, round({_ratio('nl', 'nr')}, 4) AS name_token_sort, round({_ratio('al', 'ar')}, 4) AS addr_token_sort FROM (SELECT {pair}, {sort('name_tokens_l')} AS nl, {sort('name_tokens_r')} AS nr, {sort('addr_tokens_l')} AS al, {sort('addr_tokens_r')} AS ar FROM wide)", *wide),
        "feat_token_set": _with(f"SELECT {pair}, round(CASE WHEN nl = 0 OR nr = 0 THEN 0.0 WHEN s > 0 AND (length(da) = 0 OR length(db) = 0) THEN 1.0 ELSE greatest(1.0::DOUBLE - dist::DOUBLE / (2 * (s + gap) + length(da) + length(db)), CASE WHEN s > 0 THEN 1.0::DOUBLE - (gap + length(da))::DOUBLE / (2 * s + gap + length(da)) ELSE 0.0 END, CASE WHEN s > 0 THEN 1.0::DOUBLE - (gap + length(db))::DOUBLE / (2 * s + gap + length(db)) ELSE 0.0 END) END, 4) AS name_token_set FROM ratios", *wide, sets),
        "truth_pairs": _with("SELECT * FROM truth", RECORDS, TRUTH),
        "labeled_candidates": _with(f"SELECT {pair}, label, split FROM lab JOIN split USING (source1_entity_id)", *keys, full, TRUTH, split, label),
        "label_counts": _with("SELECT label, count(*) AS n FROM lab GROUP BY 1", *keys, full, TRUTH, label),
        "grouped_split": _with("SELECT * FROM split", RECORDS, TRUTH, split),
        "score_exact": _with(f"SELECT {pair}, {flag('name_norm_l', 'name_norm_r')} AS score FROM wide", *wide),
        "score_exact_country": _with(f"SELECT {pair}, {flag('name_norm_l', 'name_norm_r')} * {ce} AS score FROM wide", *wide),
        "score_tfidf": _with(f"SELECT {pair}, score FROM scored", *scored),
        "apply_thresholds": _with("SELECT * FROM accepted", *scored),
        "predictions_at_threshold": _with("SELECT source1_entity_id, array_to_string(list_sort(list_distinct(list(candidate_entity_id))), ',') AS predicted FROM scored WHERE score >= 0.5 GROUP BY 1", *scored),
        "threshold_grid": _with(f"SELECT {_GRID_COLUMNS} FROM grid", *one),
        "best_threshold": _with(f"SELECT {_GRID_COLUMNS} FROM best", *one),
        "baseline_grid": _with(f"SELECT model, {_GRID_COLUMNS} FROM best", *models),
        "f_beta_per_entity": _with("SELECT source1_entity_id, p AS n_pred, t AS n_true, h AS tp, round(pr, 4) AS precision, round(re, 4) AS recall, round(f, 4) AS f_beta FROM per", *scored, _per_entity("accepted")),
        "macro_f_beta": _with("SELECT count(*) AS n_entities, round(avg(pr), 4) AS macro_precision, round(avg(re), 4) AS macro_recall, round(avg(f), 4) AS macro_f_beta FROM per", *scored, _per_entity("accepted")),
        "blocking_quality": _with("SELECT count(*) AS n_source1_entities, count(*) FILTER (t > 0) AS entities_with_truth, sum(t)::BIGINT AS true_matches_total, sum(h)::BIGINT AS true_matches_recovered, count(*) FILTER (p = 0) AS zero_candidate_entities, round(coalesce(avg(p) FILTER (p > 0), 0.0), 4) AS avg_candidates_per_entity, coalesce(max(p), 0) AS max_candidates_per_entity, sum(p)::BIGINT AS total_candidate_pairs, round(sum(h)::DOUBLE / nullif(sum(t), 0), 4) AS candidate_recall, round(1.0::DOUBLE - sum(p)::DOUBLE / (count(*) * (SELECT count(*) FROM records WHERE source <> 'S1')), 4) AS reduction_ratio FROM per", *keys, full, TRUTH, _per_entity("cands")),
        "false_positives": _with("SELECT * FROM fp", *scored, fp),
        "false_negatives": _with("SELECT * FROM fn", *scored, fp),
        "error_examples": _with(describe("false_positive", "fp") + " UNION ALL " + describe("false_negative", "fn"), *scored, fp),
        "matching_results": _with(lists("accepted", "matched_entity_ids"), *scored),
        "validate_findings": _with(" UNION ALL ".join([
            _finding("duplicate_row", "SELECT s1 AS item FROM lines GROUP BY 1 HAVING count(*) > 1"), _finding("duplicate_id_in_list", "SELECT s1 AS item FROM lines WHERE len(ids) <> len(list_distinct(ids))"),
            _finding("self_match", "SELECT id AS item FROM each WHERE id LIKE 'S1-%'"), _finding("wrong_prefix", "SELECT id AS item FROM each WHERE NOT regexp_matches(id, '^S[123]-')"),
            _finding("missing_required", "SELECT source1_entity_id AS item FROM entities EXCEPT SELECT s1 FROM lines"), _finding("extra_row", "SELECT s1 AS item FROM lines EXCEPT SELECT source1_entity_id FROM entities"),
            _finding("unknown_id", "SELECT id AS item FROM each WHERE regexp_matches(id, '^S[23]-') EXCEPT SELECT entity_id FROM records WHERE source <> 'S1'"),
            _finding("not_a_candidate", "SELECT s1 AS item FROM (SELECT s1, id FROM each EXCEPT SELECT source1_entity_id, candidate_entity_id FROM cands)", "warning")]), *keys, full, TRUTH, CORRUPTED),
        "validate_counts": _with("SELECT count(*) AS n_rows, count(*) FILTER (len(ids) = 0) AS n_empty, count(*) FILTER (len(ids) > 0) AS n_non_empty FROM lines", RECORDS, TRUTH, CORRUPTED),
        "profile_sources": _with("SELECT source, count(*) AS row_count, count(*) - count(DISTINCT entity_id) AS duplicate_entity_ids, count(*) - count(DISTINCT business_name) AS duplicate_business_name_rows, count(*) - count(DISTINCT business_address) AS duplicate_address_rows, count(*) FILTER (business_name = '') AS empty_name, count(*) FILTER (business_address = '') AS empty_address, count(*) FILTER (country = '') AS empty_country, round(avg(length(business_name)), 4) AS name_len_mean, round(quantile_cont(length(business_name)::DOUBLE, 0.95), 4) AS name_len_p95, round(avg(length(business_address)), 4) AS address_len_mean, round(quantile_cont(length(business_address)::DOUBLE, 0.95), 4) AS address_len_p95, count(*) FILTER (regexp_matches(business_name, '[^\\x00-\\x7F]')) AS names_with_non_ascii, count(*) FILTER (regexp_matches(business_address, '\\p{Nd}')) AS addresses_with_digits FROM records GROUP BY 1", RECORDS),
        "country_distribution": _with("SELECT source, country, count(*) AS n FROM records GROUP BY ALL", RECORDS),
        "profile_truth": _with("SELECT count(*) AS n_source1_entities, count(*) FILTER (len(ids) = 0) AS n_singleton, round(avg(CAST(len(ids) = 0 AS INT)), 4) AS singleton_frequency, count(*) FILTER (len(ids) > 1) AS n_multi_match, round(avg(CAST(len(ids) > 1 AS INT)), 4) AS multi_match_frequency, round(avg(len(ids)), 4) AS avg_match_count, max(len(ids)) AS max_match_count FROM truth_table", RECORDS, TRUTH),
    }
