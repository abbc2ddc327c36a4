"""DuckDB SQL of the linkage queries, written apart from the Spark plans: shared table expressions and one statement a query."""

from __future__ import annotations

from pairloom.functions import tokens as K


def _map(entries: dict[str, str]) -> str:
    return f"MAP([{', '.join(repr(k) for k in entries)}], [{', '.join(repr(v) for v in entries.values())}])"


def _list(words) -> str:
    return f"[{', '.join(repr(w) for w in words)}]"


def _chain(x: str, *steps: tuple[str, str]) -> str:
    for pattern, replacement in steps:
        x = f"regexp_replace({x}, '{pattern}', '{replacement}', 'g')"
    return x


# Patterns, tables and constants of the linkage are fixed values, here as in the Spark plans.
FOLD = "strip_accents(replace(replace(replace({0}, 'ß', 'ss'), 'œ', 'oe'), 'æ', 'ae'))"
RECORDS = """
rec AS (SELECT doc_id AS idx, CASE WHEN n % 4 = 0 THEN 1 WHEN n % 2 = 1 THEN 2 ELSE 3 END AS src, lang AS country,
          l[1] AS business_name, array_to_string(l[2:], ', ') AS business_address
        FROM (SELECT *, CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) AS n, string_split(text, chr(10)) AS l FROM documents)),
truth AS (SELECT f.s1_idx, r.idx AS cand_idx FROM rec r JOIN
          (SELECT country, business_name, business_address, min(idx) AS s1_idx FROM rec WHERE src = 1 GROUP BY ALL) f
          USING (country, business_name, business_address) WHERE r.src <> 1)"""
SCRIPTS = "[" + "".join(rf"\p{{{x}}}" for x in K.SCRIPTS) + "]"
_latin, _cyrillic = "aeiostnr", "аеиостнр"
TWO_SCRIPTS = f"two AS (SELECT idx, src, lower(business_name) AS latin, CASE WHEN src = 3 THEN translate(lower(business_name), '{_latin}', '{_cyrillic}') ELSE lower(business_name) END AS business_name FROM rec)"
LEARNED = rf"""
lw AS (SELECT string_split_regex(trim(regexp_replace(latin, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')), '\s+') AS x, string_split_regex(trim(regexp_replace(business_name, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')), '\s+') AS y
       FROM two WHERE src = 3 AND regexp_matches(business_name, '{SCRIPTS}')),
lp AS (SELECT y[i] AS word, x[i] AS latin FROM (SELECT x, y, unnest(range(1, len(x) + 1)) AS i FROM lw WHERE len(x) = len(y)) WHERE regexp_matches(y[i], '{SCRIPTS}')),
lc AS (SELECT word, latin, count(*) AS k FROM lp GROUP BY ALL),
lr AS (SELECT *, sum(k) OVER (PARTITION BY word) AS total, row_number() OVER (PARTITION BY word ORDER BY k DESC, latin) AS r FROM lc),
mapped AS (SELECT map(list(word), list(latin)) AS m FROM lr WHERE r = 1 AND k >= 2 AND k::DOUBLE / total >= 0.5)"""
ROMANIZED = FOLD.format("business_name")
for _a, _b in zip(_cyrillic, ("a", "ie", "i", "o", "es", "te", "en", "er")):
    ROMANIZED = f"replace({ROMANIZED}, '{_a}', '{_b}')"
_name = _chain(
    f"lower({FOLD.format('lower(business_name)')})",
    (r"www\.", " "),
    (r"\.(com|net|org|co\.in|in|fr|biz|info|us)\b", " "),
    (r"d/b/a|\bdba\b", " "),
    (r"\(?\bid\s*[:#]?\s*\d+\)?", " "),
    (r"\b([a-z])\.([a-z])\.([a-z])\.?", r"\1\2\3"),
    (r"\b([a-z])\.([a-z])\.?(\s|$)", r"\1\2\3"),
    (r"\s\+\s|&", " and "),
    (r"[^a-z0-9]+", " "),
    (r"\b\d{7,}\b", " "),
)
DELEET = "CASE WHEN regexp_full_match(t, '[a-z]*[013-8][a-z]*') AND length(t) >= 4 THEN translate(t, '01345678', 'oieasgtb') ELSE t END"
_sounds = "translate(replace(replace(replace(t, 'ph', 'f'), 'ck', 'k'), 'x', 'ks'), 'cqzwi', 'kksvl')"
SKELETON = (
    "array_to_string(list_transform(range(1, length({s}) + 1), lambda i: CASE WHEN i = 1 OR substr({s}, i, 1) <> substr({s}, i - 1, 1) THEN substr({s}, i, 1) ELSE '' END), '')"
).format(s=f"(substr({_sounds}, 1, 1) || regexp_replace(substr({_sounds}, 2), '[aeiouyh]', '', 'g'))")
# Lists keep their order when repeats go: the first place of each element.
_distinct = "list_filter({0}, lambda x, i: list_position({0}, x) = i)".format
NORM = f"""{RECORDS},
n1 AS (SELECT *, trim({_name}) AS base FROM rec),
n2 AS (SELECT *, list_transform(string_split(base, ' '), lambda t: {DELEET}) AS words FROM n1),
n3 AS (SELECT *, array_to_string(words, ' ') AS name_norm, list_filter(words, lambda t: NOT list_contains({_list([*K.LEGAL_FORMS, *K.FILLER, ''])}, t)) AS kept,
         array_to_string(list_sort(list_distinct(list_transform(list_filter(words, lambda t: list_contains({_list(K.LEGAL_FORMS)}, t)), lambda t: {_map(K.LEGAL_FORMS)}[t]))), ' ') AS legal_form FROM n2),
n4 AS (SELECT *, {_distinct('kept')} AS name_tokens FROM n3),
n5 AS (SELECT *, CASE WHEN len(name_tokens) = 0 THEN name_norm ELSE array_to_string(name_tokens, ' ') END AS name_core,
         CASE WHEN len(name_tokens) = 0 THEN replace(name_norm, ' ', '') ELSE array_to_string(name_tokens, '') END AS name_compact,
         list_transform(name_tokens, lambda t: {SKELETON}) AS name_skel,
         {_chain(f"lower({FOLD.format('business_address')})", (r"<\s*null\s*>|\bnull\b", " "))} AS abase FROM n4),
n6 AS (SELECT *, trim({_chain("abase", ("[^a-z0-9,]+", " "), (r"\s*,\s*", ", "), (r"\s+", " "))}, ' ,') AS addr_norm FROM n5),
n7 AS (SELECT *, addr_norm = '' AS addr_empty,
         list_filter(list_transform(list_transform(string_split(replace(addr_norm, ',', ' '), ' '),
           lambda t: regexp_replace(regexp_replace(t, '^(\\d+)(st|nd|rd|th)$', '\\1'), '^0+(\\d)', '\\1')),
           lambda t: coalesce({_map(K.ADDRESS_CANON)}[t], t)), lambda t: NOT list_contains({_list(['', *K.ADDRESS_DROP])}, t)) AS addr_tokens,
         list_filter(list_transform(list_filter(string_split_regex(abase, '[\\s,;]+'), lambda t: regexp_matches(t, '\\d') AND regexp_matches(t, '[a-z/\\-.]')),
           lambda t: regexp_replace(regexp_replace(t, '[^a-z0-9]', '', 'g'), '^0+(\\d)', '\\1')), lambda t: length(t) >= 2) AS ids,
         coalesce(list_filter(string_split(addr_norm, ', '), lambda c: regexp_matches(c, '\\d'))[1], '') AS part FROM n6),
n8 AS (SELECT *, list_filter(addr_tokens, lambda t: regexp_matches(t, '^\\d+$')) AS nums, {_distinct('ids')} AS addr_ids,
         regexp_replace(regexp_extract(part, '(\\d+)', 1), '^0+(\\d)', '\\1') AS house_no, regexp_extract(part, '\\d+\\w*\\s+([a-z]{{2,}})', 1) AS street FROM n7),
n AS (SELECT *, {_distinct('nums')} AS addr_numbers, CASE WHEN house_no <> '' AND street <> '' THEN house_no || '_' || street ELSE '' END AS street_key FROM n8)"""
KEYS = f"""{NORM},
allkeys AS (
  SELECT DISTINCT country, idx, src, channel, key FROM (
    SELECT country, idx, src, 'name' AS channel, 't:' || t AS key FROM (SELECT *, unnest(name_tokens) AS t FROM n) WHERE length(t) >= 2
    UNION ALL SELECT country, idx, src, 'name', 'k:' || t FROM (SELECT *, unnest(name_skel) AS t FROM n) WHERE length(t) >= 2
    UNION ALL SELECT country, idx, src, 'name', 'c:' || name_compact FROM n WHERE length(name_compact) >= 4
    UNION ALL SELECT country, idx, src, 'name', 'p:' || substr(name_compact, 1, 6) FROM n WHERE length(name_compact) >= 6
    UNION ALL SELECT country, idx, src, 'addr', 's:' || street_key FROM n WHERE length(street_key) >= 3
    UNION ALL SELECT country, idx, src, 'addr', 'i:' || t FROM (SELECT *, unnest(addr_ids) AS t FROM n) WHERE length(t) >= 2
    UNION ALL SELECT country, idx, src, 'addr', 'n:' || t FROM (SELECT *, unnest(addr_numbers) AS t FROM n) WHERE length(t) >= 3
    UNION ALL SELECT country, idx, src, 'addr', 'b:' || b FROM (
      SELECT country, idx, src, addr_tokens[i] || '_' || addr_tokens[i + 1] AS b FROM (SELECT *, unnest(range(1, len(addr_tokens))) AS i FROM n))
      WHERE length(b) >= 5 AND NOT regexp_matches(b, '^\\d+_|_\\d+$')))"""
BLOCK = f"""{KEYS},
pool AS (SELECT country, count(*) AS n_pool FROM rec WHERE src <> 1 GROUP BY country),
df AS (SELECT country, channel, key, count(*) AS df, max(n_pool) AS n_pool FROM allkeys JOIN pool USING (country) WHERE src <> 1 GROUP BY ALL),
wt AS (SELECT country, channel, key, df, 1 + ln(n_pool::DOUBLE / df) AS w FROM df WHERE df <= greatest(20, floor(0.002 * n_pool))),
q AS (SELECT country, channel, key, idx AS s1_idx, w / sum(w) OVER (PARTITION BY idx, channel) AS share FROM allkeys JOIN wt USING (country, channel, key) WHERE src = 1),
sc AS (SELECT q.s1_idx, p.idx AS cand_idx, round(sum(CASE WHEN channel = 'name' THEN share ELSE 0 END), 6) AS blk_name,
         round(sum(CASE WHEN channel = 'addr' THEN share ELSE 0 END), 6) AS blk_addr
       FROM q JOIN allkeys p USING (country, channel, key) WHERE p.src <> 1 GROUP BY ALL),
s2 AS (SELECT *, round(blk_name + blk_addr, 6) AS blk_score FROM sc),
rk AS (SELECT *, CASE WHEN blk_name > 1e-6 THEN row_number() OVER (PARTITION BY s1_idx ORDER BY blk_name DESC, cand_idx) END AS rn,
         CASE WHEN blk_addr > 1e-6 THEN row_number() OVER (PARTITION BY s1_idx ORDER BY blk_addr DESC, cand_idx) END AS ra,
         CASE WHEN blk_score > 1e-6 THEN row_number() OVER (PARTITION BY s1_idx ORDER BY blk_score DESC, cand_idx) END AS rb FROM s2),
hits AS (SELECT s1_idx, cand_idx, blk_name, blk_addr, blk_score, CASE WHEN rn <= 30 THEN rn ELSE 31 END AS blk_rank_name,
         CASE WHEN ra <= 30 THEN ra ELSE 31 END AS blk_rank_addr, CASE WHEN rb <= 40 THEN rb ELSE 41 END AS blk_rank_both FROM rk WHERE rn <= 30 OR ra <= 30 OR rb <= 40),
cand AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_idx ORDER BY blk_score DESC, cand_idx) AS blk_rank FROM hits) WHERE blk_rank <= 100),
meta AS (SELECT r.idx AS s1_idx, count(t.cand_idx) AS n_true FROM rec r LEFT JOIN truth t ON r.idx = t.s1_idx WHERE r.src = 1 GROUP BY r.idx)"""
PAIRS = f"""{BLOCK},
pt AS (SELECT c.s1_idx, c.cand_idx, c.blk_score, a AS a, b AS b FROM cand c JOIN n a ON c.s1_idx = a.idx JOIN n b ON c.cand_idx = b.idx)"""
SCORED = """
scored AS (SELECT s1_idx, cand_idx, ((s1_idx * 104729 + cand_idx * 7919) % 1000003)::DOUBLE / 1000003.0::DOUBLE AS p,
             CASE WHEN ((s1_idx * 104729 + cand_idx * 7919) % 1000003) % 1000 >= 600 THEN 1 ELSE 0 END AS label
           FROM (SELECT DISTINCT l_orderkey AS s1_idx, l_partkey AS cand_idx FROM lineitem)),
smeta AS (SELECT o_orderkey AS s1_idx, coalesce(n_true, 0) AS n_true FROM orders LEFT JOIN (SELECT s1_idx, count(*) AS n_true FROM scored WHERE label = 1 GROUP BY s1_idx) t ON o_orderkey = t.s1_idx),
owned AS (SELECT s1_idx, cand_idx, p, label, p - coalesce(second, 0) AS lead FROM (
            SELECT *, row_number() OVER w AS r, lead(p) OVER w AS second FROM scored WINDOW w AS (PARTITION BY cand_idx ORDER BY p DESC, s1_idx)) WHERE r = 1)"""


def expected(source: str, min_p: str, keys: str = "s1_idx") -> str:
    """The pairs that expected F0.5 keeps."""
    return f"""(SELECT * FROM (
      SELECT *, min(CASE WHEN ef = best THEN k END) OVER (PARTITION BY {keys}) AS best_k FROM (
        SELECT *, max(ef) OVER (PARTITION BY {keys}) AS best FROM (
          SELECT *, 1.25 * sum(p) OVER w / (0.25 * sum(p) OVER (PARTITION BY {keys}) + row_number() OVER w) AS ef, row_number() OVER w AS k,
                 product(1 - p) OVER (PARTITION BY {keys}) AS none FROM {source} WHERE p >= {min_p} / 2
          WINDOW w AS (PARTITION BY {keys} ORDER BY p DESC, cand_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))))
      WHERE k <= best_k AND k <= 15 AND p >= {min_p} AND best > none)"""


F05 = "CASE WHEN n_true = 0 THEN (n_pred = 0)::INTEGER::DOUBLE WHEN n_pred = 0 THEN 0 ELSE 1.25 * tp / (0.25 * n_true + n_pred) END"


def entities(pred: str, meta: str = "smeta") -> str:
    return f"(SELECT m.*, coalesce(c.n_pred, 0) AS n_pred, coalesce(c.tp, 0) AS tp FROM {meta} m LEFT JOIN (SELECT s1_idx, count(*) AS n_pred, CAST(sum(label) AS BIGINT) AS tp FROM {pred} GROUP BY s1_idx) c USING (s1_idx))"


BREAKDOWN = """round(avg(CASE WHEN n_true = 0 THEN (n_pred = 0)::INTEGER END), 4) AS singleton_acc, round(avg(CASE WHEN n_true <> 0 THEN (n_pred = 0)::INTEGER END), 4) AS nonsingleton_empty_pred,
  round(sum(tp)::DOUBLE / greatest(sum(n_pred), 1), 4) AS pair_precision, round(sum(tp)::DOUBLE / greatest(sum(n_true), 1), 4) AS pair_recall"""


def bucket(key: str, seed: int) -> str:
    return f"(concat('0x', substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::UBIGINT % 10000)::BIGINT"


def overlap(prefix: str, column: str) -> str:
    a, b = f"a.{column}", f"b.{column}"
    i = f"len(list_intersect({a}, {b}))"
    return f"""CAST({i} AS INTEGER) AS {prefix}_inter, CASE WHEN len({a}) + len({b}) - {i} > 0 THEN round({i}::DOUBLE / (len({a}) + len({b}) - {i}), 6) END AS {prefix}_jac,
      CASE WHEN len({a}) > 0 THEN round({i}::DOUBLE / len({a}), 6) END AS {prefix}_cont1, CASE WHEN len({b}) > 0 THEN round({i}::DOUBLE / len({b}), 6) END AS {prefix}_cont2"""


# -- comparators: a bit-parallel longest common subsequence in a 127-bit integer, for strings below that length ------------------------------------


def _lcs(a: str, b: str) -> str:
    full = f"((1::HUGEINT << length({a})::INTEGER) - 1)"
    mask = f"list_sum(list_transform(range(length({a})), lambda place: CASE WHEN substr({a}, place + 1, 1) = letter THEN 1::HUGEINT << place::INTEGER ELSE 0::HUGEINT END))::HUGEINT"
    steps = f"list_transform(string_split({b}, ''), lambda letter: {mask})"
    return f"(length({a}) - bit_count(list_reduce({steps}, lambda state, mask: ((state + (state & mask)) | (state - (state & mask))) & {full}, {full})))"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} = {b} THEN 100.0::DOUBLE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE 200.0::DOUBLE * {_lcs(a, b)} / (length({a}) + length({b})) END"


def similarity(kind: str, pairs: str) -> str:
    """(a, b, score) of distinct pairs (a, b)."""
    words = lambda c: f"list_filter(string_split({c}, ' '), lambda t: t <> '')"
    apart = lambda x, y: f"array_to_string(list_sort(list_filter({x}, lambda t: NOT list_contains({y}, t))), ' ')"
    stages = f"""
p0 AS (SELECT a, b, {words('a')} AS wa, {words('b')} AS wb FROM ({pairs})),
p1 AS (SELECT *, list_distinct(wa) AS da, list_distinct(wb) AS db, array_to_string(list_sort(wa), ' ') AS sa, array_to_string(list_sort(wb), ' ') AS sb FROM p0),
p2 AS (SELECT *, array_to_string(list_sort(list_filter(da, lambda t: list_contains(db, t))), ' ') AS common, {apart('da', 'db')} AS l, {apart('db', 'da')} AS r FROM p1),
p3 AS (SELECT *, trim(common || ' ' || l) AS x, trim(common || ' ' || r) AS y FROM p2)"""
    sorted_ = ratio("sa", "sb")
    sets = f"CASE WHEN len(da) = 0 OR len(db) = 0 THEN 0.0 WHEN common <> '' AND (l = '' OR r = '') THEN 100.0 ELSE greatest({ratio('x', 'y')}, CASE WHEN common <> '' THEN greatest({ratio('common', 'x')}, {ratio('common', 'y')}) ELSE 0.0 END) END"

    def best(name: str, a: str, b: str) -> str:
        """A table of the best windows: of each side that is not longer, against the other one."""
        return f"""
w_{name} AS (SELECT a, b, s, substr(t, greatest(k, 0) + 1, least(length(t), k + length(s)) - greatest(k, 0)) AS w FROM (
    SELECT a, b, s, t, unnest(range(1 - length(s), length(t))) AS k FROM (
      SELECT p.a, p.b, p.{a} AS s, p.{b} AS t FROM p3 p WHERE length(p.{a}) <= length(p.{b}) AND p.{a} <> ''
      UNION ALL SELECT p.a, p.b, p.{b}, p.{a} FROM p3 p WHERE length(p.{b}) <= length(p.{a}) AND p.{b} <> ''))),
{name} AS (SELECT p.a, p.b, CASE WHEN p.{a} = p.{b} THEN 100.0 WHEN p.{a} = '' OR p.{b} = '' THEN 0.0 ELSE v END AS v FROM p3 p
    LEFT JOIN (SELECT a, b, max({ratio('s', 'w')}) AS v FROM w_{name} GROUP BY a, b) m ON m.a = p.a AND m.b = p.b)"""

    if kind == "ratio":
        return f"WITH {stages} SELECT a, b, round({ratio('a', 'b')}, 6) AS score FROM p3"
    if kind == "token_sort":
        return f"WITH {stages} SELECT a, b, round({sorted_}, 6) AS score FROM p3"
    if kind == "token_set":
        return f"WITH {stages} SELECT a, b, round({sets}, 6) AS score FROM p3"
    if kind == "partial":
        return f"WITH {stages}, {best('whole', 'a', 'b')} SELECT a, b, round(v, 6) AS score FROM whole"
    longer = "greatest(length(p.a), length(p.b))::DOUBLE / least(length(p.a), length(p.b))"
    scale = f"CASE WHEN {longer} <= 8 THEN 0.9 ELSE 0.6 END::DOUBLE"
    near = f"greatest({ratio('p.a', 'p.b')}, 0.95::DOUBLE * greatest({sorted_}, {sets}))"
    far = f"greatest({ratio('p.a', 'p.b')}, {scale} * whole.v, 0.95::DOUBLE * {scale} * CASE WHEN common <> '' THEN 100.0 ELSE greatest(sort.v, rest.v) END)"
    return f"""WITH {stages}, {best('whole', 'a', 'b')}, {best('sort', 'sa', 'sb')}, {best('rest', 'l', 'r')}
SELECT p.a, p.b, round(CASE WHEN p.a = '' OR p.b = '' THEN 0.0 WHEN {longer} < 1.5 THEN {near} ELSE {far} END, 6) AS score
FROM p3 p JOIN whole ON whole.a = p.a AND whole.b = p.b JOIN sort ON sort.a = p.a AND sort.b = p.b JOIN rest ON rest.a = p.a AND rest.b = p.b"""
