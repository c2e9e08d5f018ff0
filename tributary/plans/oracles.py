"""DuckDB SQL of the registered queries, put together from common parts."""

from __future__ import annotations

from tributary.operators.features import KERNEL_FEATURES
from tributary.operators.normalize import LEGAL_FORMS, LEGAL_SUFFIXES
from tributary.plans import oracle_kernels, round_trips

FOLD = "lower(regexp_replace(strip_accents({0}), '[^\\x00-\\x7F]', '', 'g'))"
WORDS = "list_filter(regexp_split_to_array(regexp_replace({0}, '[^\\w\\s]', ' ', 'g'), '\\s+'), lambda x: x <> '')"
GRAMS = "CASE WHEN length({0}) >= 3 THEN list_transform(range(1, length({0}) - 1), lambda k: substr({0}, CAST(k AS INTEGER), 3)) ELSE {1} END"

ENTITIES = """ent AS (
  SELECT 'S' || CAST(page_id % 3 + 1 AS VARCHAR) || '-' || CAST(page_id AS VARCHAR) AS entity_id, regexp_extract(coalesce(html, ''), '<title>([^<]*)</title>', 1) AS business_name,
    CAST(length(coalesce(html, '')) % 997 + 1 AS VARCHAR) || ' ' || regexp_replace(coalesce(url, ''), '^https?://', '') || ' ' || CAST(10000 + length(coalesce(html, '')) * 37 % 90000 AS VARCHAR) AS business_address,
    regexp_extract(coalesce(html, ''), '<html lang="([^"]*)"', 1) AS country FROM pages)"""

#: Records with few names and places, so that buckets pass their ceiling, candidates their cap, and ties abound.
PART_ENTITIES = """ent AS (
  SELECT 'S' || CAST(p_partkey % 3 + 1 AS VARCHAR) || '-' || CAST(p_partkey AS VARCHAR) AS entity_id, p_name || CASE p_partkey % 4 WHEN 0 THEN ' Ltd' WHEN 1 THEN ', Inc.' WHEN 2 THEN '' ELSE ' GmbH' END AS business_name,
    CAST(p_size % 2 + 1 AS VARCHAR) || ' ' || lower(p_type) || ' road ' || CAST(10000 + p_size % 2 AS VARCHAR) AS business_address,
    CASE WHEN p_partkey % 10 < 8 THEN 'US' WHEN p_partkey % 10 = 8 THEN 'FR' ELSE 'IN' END AS country FROM part)"""

_SUFFIXES = ", ".join(f"'{w}'" for w in LEGAL_SUFFIXES)


def _canonical() -> str:
    out = "array_to_string(words, ' ')"
    for long, short in LEGAL_FORMS:
        out = f"regexp_replace({out}, '\\b{long}\\b', '{short}', 'g')"
    return out


LETTERS = f"regexp_replace(upper({FOLD.format('w')}), '[^A-Z]', '', 'g')"


def _prepared(entities: str) -> str:
    """Normalised records as prep, s1 and targets; sound is the phonetic code of a name's first word."""
    return f"""{entities}, folded AS (
  SELECT *, {FOLD.format("trim(business_name)")} AS fn, {FOLD.format("trim(business_address)")} AS fa FROM ent
), split AS (
  SELECT *, {WORDS.format("fn")} AS words, {WORDS.format("fa")} AS addr_words, regexp_extract_all(fa, '\\b(\\d{{5,6}})\\b', 1)[-1] AS postal, regexp_extract_all(fa, '\\b(\\d+[a-z]?)\\b', 1) AS numbers FROM folded
), kept AS (
  SELECT *, list_filter(words, lambda w: w NOT IN ({_SUFFIXES})) AS unsuffixed FROM split
), named AS (
  SELECT *, CASE WHEN len(unsuffixed) > 0 THEN unsuffixed ELSE words END AS tokens, list_filter(numbers, lambda x: postal IS NULL OR x <> postal)[1] AS street FROM kept
), {oracle_kernels.phonetic("SELECT DISTINCT coalesce(tokens[1], '') AS w FROM named", LETTERS)}, compacted AS (
  SELECT *, array_to_string(tokens, ' ') AS name, array_to_string(tokens, '') AS compact, array_to_string(addr_words, ' ') AS address, code AS sound FROM named JOIN codes ON w = coalesce(tokens[1], '')
), prep AS (
  SELECT entity_id, upper(trim(country)) AS country, business_name, business_address, words, tokens, name, address, addr_words, street, postal, sound,
    {GRAMS.format("compact", "CASE WHEN length(compact) > 0 THEN [compact] ELSE [] END")} AS char_3grams
  FROM compacted
), s1 AS (SELECT * FROM prep WHERE entity_id LIKE 'S1-%'), targets AS (SELECT * FROM prep WHERE entity_id NOT LIKE 'S1-%')"""


PREPARED = _prepared(ENTITIES)
PREPARED_PARTS = _prepared(PART_ENTITIES)
#: The short form: texts in lower case as they stand, the first numbers of the address.
LITE = f"""{ENTITIES}, plain AS (
  SELECT entity_id, upper(trim(country)) AS country, lower(trim(business_name)) AS name, lower(trim(business_address)) AS address FROM ent
), split AS (
  SELECT *, list_filter(regexp_split_to_array(name, '\\s+'), lambda x: x <> '') AS tokens, nullif(regexp_extract(address, '\\b(\\d+)\\b', 1), '') AS street, nullif(regexp_extract(address, '\\b(\\d{{5,6}})\\b', 1), '') AS postal FROM plain
), {oracle_kernels.phonetic("SELECT DISTINCT coalesce(tokens[1], '') AS w FROM split", LETTERS)}, prep AS (SELECT *, code AS sound FROM split JOIN codes ON w = coalesce(tokens[1], ''))"""

KEYS = """keyed AS (
  SELECT entity_id, unnest(list_filter([
    CASE WHEN name <> '' THEN concat_ws(chr(31), 'name', country, name) END,
    CASE WHEN name <> '' AND street IS NOT NULL THEN concat_ws(chr(31), 'start', country, substr(name, 1, 4), street) END,
    CASE WHEN sound <> '' AND postal IS NOT NULL THEN concat_ws(chr(31), 'sound', country, sound, postal) END,
    CASE WHEN postal IS NOT NULL AND street IS NOT NULL THEN concat_ws(chr(31), 'place', country, postal, street) END], lambda x: x IS NOT NULL)) AS key FROM prep)"""


def _tier1(ceiling: int = 250, k: int = 35) -> str:
    return f"""{KEYS}, posted AS (SELECT DISTINCT key, entity_id AS cand FROM keyed WHERE entity_id NOT LIKE 'S1-%'
), rare AS (SELECT key FROM posted GROUP BY key HAVING count(*) <= {ceiling}
), t1_all AS (
  SELECT a.entity_id AS s1, cand, round(sum(CASE WHEN a.key LIKE 'name' || chr(31) || '%' THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END), 9) AS score
  FROM keyed a JOIN rare USING (key) JOIN posted USING (key) WHERE a.entity_id LIKE 'S1-%' GROUP BY 1, 2
), t1 AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, cand) AS rank FROM t1_all QUALIFY rank <= {k})"""


def _overlap(name: str, words: str, grams: str, ceiling: int, k: int, extra: str = "") -> str:
    """Weighted overlap of words and trigrams as the table `name`."""
    return f"""{name}_terms AS (
  SELECT DISTINCT entity_id, country, kind, term FROM (
    SELECT entity_id, country, 'word' AS kind, unnest({words}) AS term FROM prep
    UNION ALL SELECT entity_id, country, 'gram', unnest({grams}) FROM prep) WHERE kind = 'gram' OR length(term) >= 3
), {name}_n AS (SELECT country, count(*) AS n FROM targets GROUP BY country
), {name}_w AS (
  SELECT country, kind, term, CASE kind WHEN 'word' THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END * (ln((n + 1) / (df + 1)) + 1) AS weight
  FROM (SELECT country, kind, term, count(*) AS df FROM {name}_terms WHERE entity_id NOT LIKE 'S1-%' GROUP BY ALL HAVING count(*) <= {ceiling}) JOIN {name}_n USING (country)
), {name}_all AS (
  SELECT s1, cand, round(sum(weight), 9) AS score FROM (
    SELECT a.entity_id AS s1, b.entity_id AS cand, weight FROM {name}_terms a JOIN {name}_w USING (country, kind, term) JOIN {name}_terms b USING (country, kind, term)
    WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%'{extra}) GROUP BY s1, cand
), {name} AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, cand) AS rank FROM {name}_all QUALIFY rank <= {k})"""


TIER2 = _overlap("t2", "list_filter(regexp_split_to_array(name || ' ' || address, '\\s+'), lambda x: x <> '')", GRAMS.format("name", "[]"), 1000, 20)
ANCHORS = """
    UNION ALL SELECT a.entity_id, b.entity_id, 5.0::DOUBLE FROM s1 a JOIN targets b USING (country, postal, street)
      JOIN (SELECT country, postal, street FROM targets WHERE street IS NOT NULL AND postal IS NOT NULL GROUP BY ALL HAVING count(*) <= 500) USING (country, postal, street)"""
LEGACY = _overlap("lg", "tokens", "char_3grams", 500, 25, ANCHORS)

FUSED = """fused_all AS (
  SELECT s1, cand, round(sum(w), 9) AS score FROM (
    SELECT s1, cand, 1.5::DOUBLE / (60 + rank) AS w FROM t1 UNION ALL SELECT s1, cand, 1.0::DOUBLE / (60 + rank) FROM t2) GROUP BY s1, cand
), fused AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, cand) AS rank FROM fused_all QUALIFY rank <= 25)"""

JACCARD = "CASE WHEN len({0}) > 0 AND len({1}) > 0 THEN len(list_intersect({0}, {1})) / len(list_distinct(list_concat({0}, {1}))) ELSE 0.0::DOUBLE END"


def _scored(candidates: str = "t1") -> str:
    lev = "CASE WHEN a.name <> '' AND b.name <> '' THEN 1.0::DOUBLE - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name))::DOUBLE ELSE 0.0::DOUBLE END"
    return f"""pairs AS (
  SELECT c.s1, c.cand, a.country, (a.name = b.name AND a.name <> '')::INT::DOUBLE AS exact, {lev} AS lev, {JACCARD.format("list_distinct(a.char_3grams)", "list_distinct(b.char_3grams)")} AS gram,
    {JACCARD.format("list_distinct(a.addr_words)", "list_distinct(b.addr_words)")} AS addr, a.street AS street_a, b.street AS street_b, a.postal AS postal_a, b.postal AS postal_b
  FROM {candidates} c JOIN prep a ON c.s1 = a.entity_id JOIN prep b ON c.cand = b.entity_id
), scored AS (SELECT *, round(0.30::DOUBLE * exact + 0.25::DOUBLE * lev + 0.20::DOUBLE * gram + 0.25::DOUBLE * addr, 9) AS p FROM pairs)"""


ASSIGNED = """claimed AS (
  SELECT * FROM scored WHERE p >= {secondary} QUALIFY row_number() OVER (PARTITION BY country, cand ORDER BY p DESC, s1) = 1
), matched AS (
  SELECT s1, cand, p, row_number() OVER (PARTITION BY s1 ORDER BY p DESC, cand) AS rank FROM claimed QUALIFY max(p) OVER (PARTITION BY s1) >= {singleton} AND rank <= {most})"""

TRUTH = """pairs_true AS (
  SELECT DISTINCT a.entity_id AS s1, b.entity_id AS cand FROM ent a JOIN ent b ON a.business_name = b.business_name AND a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%')"""

T1 = _tier1()
#: What linkage.link() does by default: 25 candidates of both tiers, the fixed score, thresholds 0.74 and 0.85 of it.
LINKED = f"{_tier1(k=25)}, {TIER2}, {FUSED}, {_scored('fused')}, " + ASSIGNED.format(secondary="0.74::DOUBLE * 0.85::DOUBLE", singleton="0.74::DOUBLE", most=15)
MATCH_LISTS = "SELECT entity_id AS source1_entity_id, coalesce(string_agg(cand, ',' ORDER BY rank), '') AS matched_entity_ids FROM s1 LEFT JOIN matched ON s1.entity_id = matched.s1 GROUP BY entity_id"
SCORED = _scored()
NEGATIVES = "SELECT s1, cand, 0 AS label FROM (SELECT c.*, row_number() OVER (PARTITION BY s1 ORDER BY rank, cand) AS nth FROM {0} c ANTI JOIN pairs_true USING (s1, cand)) WHERE nth <= 10"

GRID = """curve AS (
  SELECT step, tau, avg(f05) AS f05 FROM (
    SELECT step, tau, u.s1, CASE WHEN n_true = 0 AND coalesce(n_found, 0) = 0 THEN 1.0::DOUBLE WHEN n_true = 0 OR coalesce(n_found, 0) = 0 OR n_both = 0 THEN 0.0::DOUBLE
      ELSE 1.25::DOUBLE * (n_both / n_found::DOUBLE) * (n_both / n_true::DOUBLE) / (0.25::DOUBLE * (n_both / n_found::DOUBLE) + n_both / n_true::DOUBLE) END AS f05
    FROM (SELECT s1.entity_id AS s1, count(cand) AS n_true FROM s1 LEFT JOIN pairs_true ON s1.entity_id = pairs_true.s1 GROUP BY 1) u CROSS JOIN taus
      LEFT JOIN (SELECT step, g.s1, count(*) AS n_found, count(t.cand) AS n_both FROM (
          SELECT step, s1, cand FROM (SELECT *, max(p) OVER (PARTITION BY step, s1) AS best, row_number() OVER (PARTITION BY step, s1 ORDER BY p DESC, cand) AS r FROM (
            SELECT * FROM (SELECT step, tau, s1, cand, p, country FROM scored JOIN taus ON p >= tau * 0.85::DOUBLE) QUALIFY row_number() OVER (PARTITION BY step, country, cand ORDER BY p DESC, s1) = 1)) WHERE best >= tau AND r <= 15) g
        LEFT JOIN pairs_true t ON g.s1 = t.s1 AND g.cand = t.cand GROUP BY step, g.s1) f USING (step, s1)) GROUP BY step, tau)"""
THREE_COUNTRIES = " AND country IN ('EN', 'FR', 'DE')"


def _competitive(most: int, where: str = "") -> str:
    """The sequential pass over pairs by falling score, as the table pass: a row a pair, won or not."""
    return f"""queue AS (SELECT s1, cand, p, row_number() OVER (ORDER BY p DESC, s1, cand) AS n FROM scored WHERE p >= 0.3{where}
      ), pass(n, taken, held, s1, cand, p, won) AS (SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[], '', '', 0.0::DOUBLE, FALSE
        UNION ALL SELECT n, CASE WHEN ok THEN list_append(taken, cand) ELSE taken END, CASE WHEN ok THEN list_append(held, s1) ELSE held END, s1, cand, p, ok FROM (
          SELECT q.n, taken, held, q.s1, q.cand, q.p, NOT list_contains(taken, q.cand) AND len(list_filter(held, lambda x: x = q.s1)) < {most} AND (NOT list_contains(held, q.s1) OR q.p >= 0.4) AS ok FROM pass JOIN queue q ON q.n = pass.n + 1))"""


#: The curve of each country: its own records alone.
COUNTRY_GRID = GRID.replace("SELECT step, tau, avg(f05) AS f05 FROM", "SELECT u_country AS country, step, tau, avg(f05) AS f05 FROM").replace("SELECT step, tau, u.s1, CASE", "SELECT u.country AS u_country, step, tau, u.s1, CASE").replace("(SELECT s1.entity_id AS s1, count(cand) AS n_true FROM s1 LEFT JOIN pairs_true ON s1.entity_id = pairs_true.s1 GROUP BY 1) u", "(SELECT s1.entity_id AS s1, s1.country, count(cand) AS n_true FROM s1 LEFT JOIN pairs_true ON s1.entity_id = pairs_true.s1 GROUP BY 1, 2) u").replace("GROUP BY step, tau)", "GROUP BY u_country, step, tau)")
TAUS = "taus AS (SELECT k AS step, round(0.3::DOUBLE + k * (0.6::DOUBLE / 24), 10) AS tau FROM range(25) x(k))"

TRAINING = """SELECT c.s1, c.cand, (p.cand IS NOT NULL)::INT AS label, TRUE AS is_blocker, CAST(rank AS INT) AS rank FROM t1 c LEFT JOIN pairs_true p ON c.s1 = p.s1 AND c.cand = p.cand
      UNION ALL SELECT s1, cand, 1, FALSE, CAST(coalesce((SELECT max(rank) FROM t1 WHERE t1.s1 = p.s1), 0) + 1 AS INT) FROM pairs_true p ANTI JOIN t1 USING (s1, cand)"""

ORDER_ROWS = "o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, CAST(('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS fold"


def _statistics(values: str) -> str:
    """row_* over the list `values` of doubles."""
    n, mean = f"len({values})", f"(list_sum({values}) / len({values}))"
    m = lambda k: f"list_sum(list_transform({values}, lambda x: pow(x - {mean}, {k})))"
    return f"""round(coalesce(list_sum({values}), 0), 6) AS row_sum, round(CASE WHEN {n} > 0 THEN {mean} ELSE 0 END, 6) AS row_mean, round(CASE WHEN {n} > 1 THEN sqrt({m(2)} / ({n} - 1)) ELSE 0 END, 6) AS row_std,
    round(CASE WHEN {n} > 2 AND {m(2)} / {n} > 1e-30 THEN sqrt({n} * ({n} - 1)::DOUBLE) / ({n} - 2) * ({m(3)} / {n}) / pow({m(2)} / {n}, 1.5) ELSE 0 END, 6) AS row_skew"""


SOUNDEX_DIGITS = "translate(regexp_replace(upper(w), '[^A-Z]', '', 'g'), 'BFPVCGJKQSXZDTLMNRAEIOUYHW', '11112222222233455600000000')"
for _d in "0123456":
    SOUNDEX_DIGITS = f"regexp_replace({SOUNDEX_DIGITS}, '{_d}+', '{_d}', 'g')"

#: Soundex codes of a list of words.
SOUNDEX_OF = "list_transform({0}, lambda w: CASE WHEN regexp_replace(upper(w), '[^A-Z]', '', 'g') = '' THEN '' ELSE regexp_replace(upper(w), '[^A-Z]', '', 'g')[1] || substr(rpad(replace(substr(" + SOUNDEX_DIGITS.replace("{", "{{").replace("}", "}}") + ", 2), '0', ''), 3, '0'), 1, 3) END)"

FEATURE_PAIRS = f"""sided AS (
  SELECT *, {SOUNDEX_OF.format("tokens")} AS sounds, list_distinct(tokens) AS own, list_distinct(addr_words) AS addr_own, array_to_string(list_sort(tokens), ' ') AS sorted, array_to_string(list_sort(addr_words), ' ') AS addr_sorted,
    list_distinct(char_3grams) AS grams, lower(trim(business_address)) AS raw_addr, list_distinct(list_filter(addr_words, lambda t: NOT regexp_full_match(t, '\\d+') AND length(t) >= 3)) AS places, list_distinct(list_filter(addr_words, lambda t: regexp_matches(t, '\\d'))) AS numerals FROM prep
), both_sides AS (
  SELECT c.s1, c.cand, c.rank, a, b, array_to_string(list_sort(list_intersect(a.own, b.own)), ' ') AS n_both, array_to_string(list_sort(list_filter(a.own, lambda x: NOT list_contains(b.own, x))), ' ') AS n_a, array_to_string(list_sort(list_filter(b.own, lambda x: NOT list_contains(a.own, x))), ' ') AS n_b,
    array_to_string(list_sort(list_intersect(a.addr_own, b.addr_own)), ' ') AS p_both, array_to_string(list_sort(list_filter(a.addr_own, lambda x: NOT list_contains(b.addr_own, x))), ' ') AS p_a, array_to_string(list_sort(list_filter(b.addr_own, lambda x: NOT list_contains(a.addr_own, x))), ' ') AS p_b
  FROM t1 c JOIN sided a ON c.s1 = a.entity_id JOIN sided b ON c.cand = b.entity_id
), {oracle_kernels.lcs("SELECT a.name AS s, b.name AS t FROM both_sides UNION SELECT a.sorted, b.sorted FROM both_sides UNION SELECT n_a, n_b FROM both_sides UNION SELECT a.address, b.address FROM both_sides UNION SELECT a.addr_sorted, b.addr_sorted FROM both_sides UNION SELECT p_a, p_b FROM both_sides")}"""


def _common(s: str, t: str) -> str:
    return f"coalesce((SELECT n FROM lcs WHERE lcs.s = {s} AND lcs.t = {t}), 0)"


def _lcs_ratio(s: str, t: str) -> str:
    return f"CASE WHEN {s} <> '' AND {t} <> '' THEN 2.0::DOUBLE * {_common(s, t)} / (length({s}) + length({t})) ELSE 0.0::DOUBLE END"


def _set_ratio(both: str, a: str, b: str, some: str) -> str:
    gap = f"(length({both}) > 0)::INT"
    whole = f"(1.0::DOUBLE - (length({a}) + length({b}) - 2 * {_common(a, b)}) / (2 * (length({both}) + {gap}) + length({a}) + length({b}))::DOUBLE)"
    side = lambda x: f"(1.0::DOUBLE - ({gap} + length({x})) / (2 * length({both}) + {gap} + length({x}))::DOUBLE)"
    return f"CASE WHEN NOT ({some}) THEN 0.0::DOUBLE WHEN {both} <> '' AND ({a} = '' OR {b} = '') THEN 1.0::DOUBLE WHEN {both} <> '' THEN greatest({whole}, {side(a)}, {side(b)}) WHEN length({a}) + length({b}) > 0 THEN {whole} ELSE 0.0::DOUBLE END"


def _within(name: str, place: str) -> str:
    return f"(length({name}.name) >= 3 AND (regexp_matches({place}.raw_addr, '\\b' || {name}.name || '\\b') OR regexp_matches({place}.address, '\\b' || {name}.name || '\\b')))"


FEATURES = {
    "name_exact_match": "(lower(trim(a.business_name)) = lower(trim(b.business_name)) AND trim(a.business_name) <> '')::INT::DOUBLE",
    "name_clean_exact_match": "(a.name = b.name AND a.name <> '')::INT::DOUBLE",
    "name_jaro_winkler": "CASE WHEN a.name <> '' AND b.name <> '' THEN jaro_winkler_similarity(a.name, b.name) ELSE 0 END",
    "name_levenshtein_ratio": "CASE WHEN a.name <> '' AND b.name <> '' THEN 1 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name))::DOUBLE ELSE 0 END",
    "name_token_sort_ratio": _lcs_ratio("a.sorted", "b.sorted"),
    "name_token_set_ratio": _set_ratio("n_both", "n_a", "n_b", "a.name <> '' AND b.name <> ''"),
    "name_char_3gram_jaccard": JACCARD.format("a.grams", "b.grams"),
    "name_length_diff": "abs(length(a.name) - length(b.name))::DOUBLE",
    "name_length_ratio": "CASE WHEN greatest(length(a.name), length(b.name)) > 0 THEN least(length(a.name), length(b.name)) / greatest(length(a.name), length(b.name))::DOUBLE ELSE 0 END",
    "name_first_token_match": "coalesce(a.tokens[1] = b.tokens[1], FALSE)::INT::DOUBLE",
    "name_soundex_match": "coalesce(a.sounds[1] = b.sounds[1] AND a.sounds[1] <> '', FALSE)::INT::DOUBLE",
    "name_soundex_jaccard": JACCARD.format("list_distinct(a.sounds)", "list_distinct(b.sounds)"),
    "name_common_tokens_count": "len(list_intersect(a.own, b.own))::DOUBLE",
    "addr_exact_match": "((a.address = b.address AND a.address <> '') OR (a.raw_addr = b.raw_addr AND a.raw_addr <> ''))::INT::DOUBLE",
    "addr_token_jaccard": JACCARD.format("a.addr_own", "b.addr_own"),
    "addr_token_sort_ratio": _lcs_ratio("a.addr_sorted", "b.addr_sorted"),
    "addr_token_set_ratio": _set_ratio("p_both", "p_a", "p_b", "a.address <> '' AND b.address <> ''"),
    "addr_street_num_status": "CASE WHEN a.street IS NULL OR b.street IS NULL THEN 0 WHEN a.street = b.street THEN 1 ELSE -1 END::DOUBLE",
    "addr_postal_code_status": "CASE WHEN a.postal IS NULL OR b.postal IS NULL THEN 0 WHEN a.postal = b.postal THEN 1 ELSE -1 END::DOUBLE",
    "addr_locality_jaccard": JACCARD.format("a.places", "b.places"),
    "addr_numeric_overlap": JACCARD.format("a.numerals", "b.numerals"),
    "addr_is_empty": "(a.address = '' OR b.address = '')::INT::DOUBLE",
    "name_in_address_cross": f"({_within('a', 'b')} OR {_within('b', 'a')})::INT::DOUBLE",
    "is_source2": "(cand LIKE 'S2%')::INT::DOUBLE",
    "is_source3": "(cand LIKE 'S3%')::INT::DOUBLE",
    "blocking_rank": "rank::DOUBLE",
    "blocking_score": "1.0::DOUBLE / rank",
    "name_lcs_ratio": _lcs_ratio("a.name", "b.name"),
    "addr_lcs_ratio": _lcs_ratio("a.address", "b.address"),
    "name_char_3gram_dice": "CASE WHEN len(a.grams) > 0 AND len(b.grams) > 0 THEN 2.0::DOUBLE * len(list_intersect(a.grams, b.grams)) / (len(a.grams) + len(b.grams)) ELSE 0 END",
    "dense_cosine_similarity": "0.0::DOUBLE",
    "dense_norm_difference": "0.0::DOUBLE",
}

PREDICTIONS = "pred AS (SELECT l_orderkey, l_linenumber, l_quantity AS y, 25.0::DOUBLE + l_discount * 100 AS p, (l_returnflag = 'R')::INT AS c, (l_tax > 0.03)::INT AS q, round(l_discount / 0.11, 6) AS s, l_returnflag AS cls, CASE WHEN l_tax > 0.05 THEN 'R' WHEN l_tax > 0.02 THEN 'N' ELSE 'A' END AS guess FROM lineitem)"

SQL = {
    "records": f"WITH {ENTITIES} SELECT * FROM ent",
    "normalize_name": f"WITH RECURSIVE {PREPARED} SELECT entity_id, name AS clean_name, {_canonical()} AS canonical_name, array_to_string(char_3grams, ',') AS char_3grams FROM prep",
    "normalize_address": f"WITH RECURSIVE {PREPARED} SELECT entity_id, address AS clean_address, street AS street_number, postal AS postal_code FROM prep",
    "soundex_codes": f"""WITH RECURSIVE {PREPARED}, w AS (SELECT DISTINCT unnest(tokens) AS w FROM prep)
      SELECT w AS word, CASE WHEN regexp_replace(upper(w), '[^A-Z]', '', 'g') = '' THEN '' ELSE regexp_replace(upper(w), '[^A-Z]', '', 'g')[1] || substr(rpad(replace(substr({SOUNDEX_DIGITS}, 2), '0', ''), 3, '0'), 1, 3) END AS code FROM w""",
    "bucket_keys": f"WITH RECURSIVE {PREPARED}, {KEYS} SELECT entity_id, replace(key, chr(31), '|') AS key FROM keyed",
    "bucket_ceiling": f"WITH RECURSIVE {PREPARED_PARTS}, {KEYS}, posted AS (SELECT DISTINCT key, entity_id FROM keyed WHERE entity_id NOT LIKE 'S1-%') SELECT replace(key, chr(31), '|') AS key, count(*) AS n_ids FROM posted GROUP BY key HAVING count(*) <= 250",
    "tier1_candidates": f"WITH RECURSIVE {PREPARED}, {T1} SELECT * FROM t1",
    "tier2_candidates": f"WITH RECURSIVE {PREPARED}, {TIER2} SELECT s1, cand, round(score, 6) AS score, rank FROM t2",
    "fused_candidates": f"WITH RECURSIVE {PREPARED}, {T1}, {TIER2}, {FUSED} SELECT s1, cand, round(score, 6) AS score, rank FROM fused",
    "legacy_candidates": f"WITH RECURSIVE {PREPARED}, {LEGACY} SELECT s1, cand, round(score, 6) AS score, rank FROM lg",
    "candidate_lists": f"WITH RECURSIVE {PREPARED}, {T1} SELECT entity_id AS source1_entity_id, coalesce(string_agg(cand, ',' ORDER BY rank), '') AS candidate_entity_ids FROM s1 LEFT JOIN t1 ON s1.entity_id = t1.s1 GROUP BY entity_id",
    "dense_neighbours": """WITH d AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), m AS (
      SELECT CAST(a.vec_id AS VARCHAR) AS s1, CAST(b.vec_id AS VARCHAR) AS cand, round(list_cosine_similarity(a.v, b.v), 9) AS score FROM d a, d b WHERE a.vec_id % 50 = 0)
      SELECT s1, cand, round(score, 6) AS score, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, cand) AS rank FROM m QUALIFY rank <= 20""",
    "all_features": f"WITH RECURSIVE {PREPARED}, {T1}, {FEATURE_PAIRS} SELECT s1, cand, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in FEATURES.items()) + " FROM both_sides",
    "pair_features": f"WITH RECURSIVE {PREPARED}, {T1}, {FEATURE_PAIRS} SELECT s1, cand, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in FEATURES.items() if n not in KERNEL_FEATURES) + " FROM both_sides",
    "generated_candidates": f"WITH RECURSIVE {PREPARED}, {T1}, {TIER2}, {FUSED.replace('rank <= 25', 'rank <= 35')} SELECT s1, cand, round(score, 6) AS score, rank FROM fused",
    "metaphone_codes": f"WITH RECURSIVE {ENTITIES}, {oracle_kernels.phonetic('SELECT DISTINCT unnest(tokens) AS w FROM (' + 'WITH RECURSIVE ' + PREPARED + ' SELECT tokens FROM prep)', LETTERS)} SELECT w AS word, code AS primary, other AS secondary FROM codes",
    "phonetic_candidates": f"WITH RECURSIVE {PREPARED} SELECT DISTINCT a.entity_id AS s1, b.entity_id AS cand, a.sound AS code, a.postal FROM s1 a JOIN targets b USING (country, sound, postal) WHERE a.sound <> ''",
    "lite_candidates": f"WITH RECURSIVE {LITE}, {T1} SELECT s1, cand, round(score, 6) AS score, rank FROM t1",
    "competitive_assignment": f"WITH RECURSIVE {PREPARED}, {T1}, {SCORED}, {_competitive(2)} SELECT s1, cand, p, CAST(row_number() OVER (PARTITION BY s1 ORDER BY n) AS INT) AS rank FROM pass WHERE won",
    "reassigned": f"WITH RECURSIVE {PREPARED}, {T1}, {SCORED}, {_competitive(15, THREE_COUNTRIES)} SELECT entity_id AS source1_entity_id, coalesce(string_agg(cand, ',' ORDER BY n), '') AS matched_entity_ids FROM s1 LEFT JOIN (SELECT * FROM pass WHERE won) m ON s1.entity_id = m.s1 GROUP BY entity_id",
    "assignment_universe": f"WITH RECURSIVE {PREPARED}, {T1}, {SCORED}, inside AS (SELECT * FROM scored WHERE CAST(regexp_extract(s1, '([0-9]+)$', 1) AS BIGINT) % 2 = 0), {ASSIGNED.format(secondary='0.2::DOUBLE', singleton='0.3::DOUBLE', most=15).replace('FROM scored', 'FROM inside')} SELECT * FROM matched",
    "saved_model": f"WITH RECURSIVE {PREPARED}, {T1} SELECT s1, cand, TRUE AS same FROM t1",
    "safe_floats": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN o_totalprice ELSE -1.0::DOUBLE END AS value FROM orders",
    "country_thresholds": f"WITH RECURSIVE {PREPARED}, {T1}, {SCORED}, {TRUTH}, {TAUS}, {COUNTRY_GRID} SELECT country, round(quantile_cont(tau, 0.5), 6) AS tau, round(max(f05), 6) AS f05 FROM (SELECT *, max(f05) OVER (PARTITION BY country) AS best FROM curve) WHERE best - f05 <= 1e-5 GROUP BY country",
    "linkage": f"WITH RECURSIVE {PREPARED}, {LINKED} {MATCH_LISTS}",
    "linkage_skewed": f"WITH RECURSIVE {PREPARED_PARTS}, {LINKED} {MATCH_LISTS}",
    "scored_skewed": f"WITH RECURSIVE {PREPARED_PARTS}, {LINKED} SELECT s1, cand, round(p, 6) AS p, country FROM scored",
    "assignment": f"WITH RECURSIVE {PREPARED}, {T1}, {SCORED}, {ASSIGNED.format(secondary='0.2::DOUBLE', singleton='0.5::DOUBLE', most=3)} SELECT * FROM matched",
    "threshold_curve": f"WITH RECURSIVE {PREPARED}, {T1}, {SCORED}, {TRUTH}, {TAUS}, {GRID} SELECT step::INT AS step, round(tau, 6) AS tau, round(f05, 6) AS f05 FROM curve",
    "best_threshold": f"WITH RECURSIVE {PREPARED}, {T1}, {SCORED}, {TRUTH}, {TAUS}, {GRID} SELECT round(quantile_cont(tau, 0.5), 6) AS tau, round(max(f05), 6) AS f05 FROM (SELECT *, max(f05) OVER () AS best FROM curve) WHERE best - f05 <= 1e-5",
    "hard_negatives": f"WITH RECURSIVE {PREPARED}, {T1}, {TRUTH} SELECT s1, cand, 1 AS label FROM pairs_true UNION ALL {NEGATIVES.format('t1')}",
    "missed_truth": f"WITH RECURSIVE {PREPARED}, {TIER2.replace('1000', '20')}, {TRUTH} SELECT s1, cand, CAST(coalesce((SELECT max(rank) FROM t2 WHERE t2.s1 = p.s1), 0) + 1 AS INT) AS rank FROM pairs_true p WHERE (s1, cand) NOT IN (SELECT s1, cand FROM t2)",
    "stratified_sample": f"""WITH {ENTITIES}, g AS (SELECT country, count(*) AS n, sum(count(*)) OVER () AS total FROM ent GROUP BY country), r AS (
      SELECT ent.*, row_number() OVER (PARTITION BY country ORDER BY md5('42:' || entity_id), entity_id) AS nth FROM ent)
      SELECT entity_id, r.country FROM r JOIN g USING (country) WHERE nth <= greatest(1, least(n, round_even(100 * n / total, 0))) ORDER BY md5('42:' || entity_id), entity_id LIMIT 100""",
    "folds": f"""WITH {ENTITIES} SELECT entity_id, CAST(CAST('0x' || substr(md5('42:' || country), 1, 8) AS BIGINT) % 3 AS INT) AS group_fold,
      CAST((row_number() OVER (PARTITION BY country ORDER BY md5('42:' || entity_id), entity_id) - 1) % 5 AS INT) AS stratified_fold, CAST(CAST('0x' || substr(md5('42:' || entity_id), 1, 8) AS BIGINT) % 5 AS INT) AS fold FROM ent""",
    "cascade_admission": "SELECT l_orderkey, l_linenumber, p FROM (SELECT l_orderkey, l_linenumber, round(l_discount * 8 + l_tax, 6) AS p, row_number() OVER (PARTITION BY l_orderkey ORDER BY round(l_discount * 8 + l_tax, 6) DESC, l_linenumber) AS r FROM lineitem WHERE round(l_discount * 8 + l_tax, 6) >= 0.12) WHERE r <= 3",
    "blend": "SELECT l_orderkey, l_linenumber, round(least(greatest(CASE WHEN l_linenumber % 3 = 0 THEN 0.5 * l_discount * 10 + 0.5 * l_tax * 10 ELSE 0.5 * l_quantity / 50 + 0.25 * l_discount * 10 + 0.25 * l_tax * 10 END, 0), 1), 6) AS p FROM lineitem",
    "target_encoding": f"""WITH o AS (SELECT {ORDER_ROWS} FROM orders), g AS (SELECT avg(o_totalprice) AS m FROM o), t AS (SELECT o_orderpriority, fold, count(*) AS n, sum(o_totalprice) AS s FROM o GROUP BY ALL), u AS (SELECT o_orderpriority, sum(n) AS n, sum(s) AS s FROM t GROUP BY 1)
      SELECT o_orderkey, round(((u.s - t.s) + 10 * m) / (u.n - t.n + 10), 4) AS priority_te FROM o JOIN t USING (o_orderpriority, fold) JOIN u USING (o_orderpriority), g""",
    "frequency_encoding": "SELECT o_orderkey, round(count(*) OVER (PARTITION BY o_orderpriority) / (count(*) OVER ())::DOUBLE, 6) AS priority_freq FROM orders",
    "label_encoding": "SELECT event_id, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INT) AS code FROM events",
    "row_statistics": f"SELECT l_orderkey, l_linenumber, {_statistics('v')} FROM (SELECT l_orderkey, l_linenumber, list_filter([l_quantity, l_discount * 100, l_tax * 100, CASE WHEN l_linenumber % 4 <> 0 THEN l_linenumber::DOUBLE END], lambda x: x IS NOT NULL) AS v FROM lineitem)",
    "preprocess": "WITH e AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value, event_type FROM events), f AS (SELECT *, coalesce(value, (SELECT median(value) FROM e)) AS v FROM e) SELECT event_id, round((v - (SELECT avg(v) FROM f)) / (SELECT stddev_pop(v) FROM f), 6) AS value, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INT) AS event_type FROM f",
    "rank_average": "WITH r AS (SELECT p_partkey, (rank() OVER (ORDER BY p_size) - 1 + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0) / (count(*) OVER () - 1) AS a, (rank() OVER (ORDER BY p_retailprice) - 1 + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2.0) / (count(*) OVER () - 1) AS b FROM part) SELECT p_partkey, round(0.25 * a + 0.75 * b, 6) AS score FROM r",
    "regression_metrics": f"""WITH {PREDICTIONS} SELECT metric, round(value, 6) AS value FROM (SELECT 'rmse' AS metric, sqrt(avg((y - p) ** 2)) AS value FROM pred UNION ALL SELECT 'mse', avg((y - p) ** 2) FROM pred UNION ALL SELECT 'mae', avg(abs(y - p)) FROM pred
      UNION ALL SELECT 'mape', avg(abs((y - p) / y)) FILTER (WHERE y <> 0) * 100 FROM pred UNION ALL SELECT 'smape', avg(2 * abs(y - p) / (abs(y) + abs(p))) FILTER (WHERE abs(y) + abs(p) <> 0) * 100 FROM pred)""",
    "classification_metrics": f"""WITH {PREDICTIONS}, k AS (SELECT c, sum(tp) AS tp, sum(n) AS n, sum(m) AS m FROM (SELECT cls AS c, (cls = guess)::INT AS tp, 1 AS n, 0 AS m FROM pred UNION ALL SELECT guess, 0, 0, 1 FROM pred) GROUP BY c), f AS (SELECT *, 2 * tp / (n + m)::DOUBLE AS f1 FROM k),
      a AS (SELECT s, sum(c) AS pos, sum(1 - c) AS neg FROM pred GROUP BY s), b AS (SELECT *, sum(neg) OVER (ORDER BY s) - neg AS below FROM a)
      SELECT metric, round(value, 6) AS value FROM (SELECT 'f1_macro' AS metric, avg(f1) AS value FROM f UNION ALL SELECT 'f1_micro', 2 * sum(tp) / sum(n + m)::DOUBLE FROM f UNION ALL SELECT 'f1_weighted', sum(f1 * n) / sum(n) FROM f
      UNION ALL SELECT 'accuracy', avg((c = q)::INT) FROM pred UNION ALL SELECT 'log_loss', -avg(c * ln(least(greatest(s, 1e-15), 1 - 1e-15)) + (1 - c) * ln(1 - least(greatest(s, 1e-15), 1 - 1e-15))) FROM pred
      UNION ALL SELECT 'roc_auc', sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg))::DOUBLE FROM b)""",
    "text_statistics": """SELECT doc_id, length(t) AS txt_char_len, w AS txt_word_cnt, round(length(t) / (w + 1e-5), 6) AS txt_mean_word_len, round(len(regexp_extract_all(t, '\\p{Lu}')) / (length(t) + 1e-5), 6) AS txt_upper_ratio, round(len(regexp_extract_all(t, '\\p{Nd}')) / (length(t) + 1e-5), 6) AS txt_digit_ratio, len(regexp_extract_all(t, '[!-/:-@\\[-`{-~]')) AS txt_punc_cnt
      FROM (SELECT doc_id, coalesce(text, '') AS t, len(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '')) AS w FROM documents)""",
    "clean_text": """SELECT page_id, md5(trim(regexp_replace(lower(regexp_replace(replace(replace(replace(replace(replace(replace(replace(coalesce(html, ''), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&'), '<[^>]+>', ' ', 'g')), '\\s+', ' ', 'g'), ' ')) AS cleaned FROM pages""",
    "list_codec": "SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids, count(*) AS n FROM orders GROUP BY o_custkey",
    "validation_rules": """WITH l AS (SELECT 'S1-' || CAST(o_custkey AS VARCHAR) AS s1, 'S' || CAST(o_orderkey % 4 + 1 AS VARCHAR) || '-' || CAST(o_orderkey % 50 AS VARCHAR) AS id FROM orders), d AS (SELECT s1, id, count(*) AS k FROM l GROUP BY ALL), u AS (SELECT DISTINCT 'S1-' || CAST(c_custkey AS VARCHAR) AS s1 FROM customer WHERE c_acctbal >= 0)
      SELECT 'duplicate_s1' AS rule, 0::BIGINT AS n UNION ALL SELECT 'duplicate_id_in_list', count(*) FROM d WHERE k > 1 UNION ALL SELECT 'self_match', count(*) FROM l WHERE id LIKE 'S1-%' UNION ALL SELECT 'wrong_prefix', count(*) FROM l WHERE NOT regexp_matches(id, '^S[123]-')
      UNION ALL SELECT 'missing_s1', count(*) FROM u WHERE s1 NOT IN (SELECT s1 FROM l) UNION ALL SELECT 'extra_s1', count(DISTINCT s1) FROM l WHERE s1 NOT IN (SELECT s1 FROM u)""",
    "blocker_recall": f"WITH RECURSIVE {PREPARED}, {T1}, {TRUTH} SELECT count(*) AS true_pairs, count(t1.cand) AS found, round(count(t1.cand) / count(*)::DOUBLE, 6) AS recall FROM pairs_true p LEFT JOIN t1 ON p.s1 = t1.s1 AND p.cand = t1.cand",
    "partition_summary": f"""WITH RECURSIVE {PREPARED}, {T1}, {SCORED}, {ASSIGNED.format(secondary='0.255::DOUBLE', singleton='0.3::DOUBLE', most=15)} SELECT country, count(*) AS total, count(m.s1) AS matched, count(*) - count(m.s1) AS singletons, round(count(m.s1) * 100.0::DOUBLE / count(*), 6) AS match_ratio
      FROM s1 LEFT JOIN (SELECT DISTINCT s1 FROM matched) m ON s1.entity_id = m.s1 GROUP BY country""",
    "match_counts": f"WITH RECURSIVE {PREPARED}, {T1}, {SCORED}, {ASSIGNED.format(secondary='0.255::DOUBLE', singleton='0.3::DOUBLE', most=15)} SELECT n AS n_matches, count(*) AS records FROM (SELECT entity_id, count(cand) AS n FROM s1 LEFT JOIN matched ON s1.entity_id = matched.s1 GROUP BY entity_id) GROUP BY n",
    "candidate_percentiles": f"WITH RECURSIVE {PREPARED}, {T1}, c AS (SELECT entity_id, count(cand) AS n FROM s1 LEFT JOIN t1 ON s1.entity_id = t1.s1 GROUP BY entity_id) SELECT count(*) AS records, round(avg(n), 6) AS mean, min(n) AS least, " + ", ".join(f"round(quantile_cont(n, {q / 100}), 6) AS p{q}" for q in (25, 50, 75, 90, 95, 99)) + ", max(n) AS most FROM c",
    "target_collisions": f"WITH RECURSIVE {PREPARED}, {T1}, k AS (SELECT cand, count(DISTINCT s1) AS k FROM t1 GROUP BY cand) SELECT count(*) AS claimed, count(*) FILTER (WHERE k > 1) AS shared, round(avg((k > 1)::INT), 6) AS shared_share FROM k",
    "leaderboard": "WITH r AS (SELECT s_name AS run_name, 'run-' || CAST(s_suppkey AS VARCHAR) AS run_id, s_acctbal AS m FROM supplier) SELECT run_id, run_name, round(m, 6) AS macro_f05, row_number() OVER (ORDER BY m DESC, run_id) AS rank FROM r",
    "pair_texts": f"WITH {ENTITIES} SELECT entity_id, 'name: ' || trim(business_name) || ' | addr: ' || trim(business_address) || ' | country: ' || trim(country) AS text FROM ent",
    "focal_loss": """SELECT l_orderkey, l_linenumber, round((y * 0.25 + (1 - y) * 0.75) * pow(1 - exp(-e), 2) * e, 6) AS loss FROM (
      SELECT l_orderkey, l_linenumber, y, greatest(x, 0) - x * y + ln(1 + exp(-abs(x))) AS e FROM (SELECT l_orderkey, l_linenumber, l_discount * 20 - 1 AS x, (l_returnflag = 'R')::INT::DOUBLE AS y FROM lineitem))""",
    "training_pairs": f"WITH RECURSIVE {PREPARED}, {T1}, {TRUTH} {TRAINING}",
    "balanced_pairs": f"WITH RECURSIVE {PREPARED}, {T1}, {TRUTH}, t AS ({TRAINING}) SELECT s1, cand, label FROM t QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5('42:' || s1 || '|' || cand), s1, cand) <= 20",
    "downsampled_targets": f"WITH {ENTITIES}, {TRUTH}, k AS (SELECT entity_id FROM ent WHERE entity_id NOT LIKE 'S1-%' AND entity_id IN (SELECT cand FROM pairs_true)), r AS (SELECT entity_id, row_number() OVER (ORDER BY md5('42:' || entity_id), entity_id) AS n FROM ent WHERE entity_id NOT LIKE 'S1-%' AND entity_id NOT IN (SELECT cand FROM pairs_true)) SELECT entity_id FROM k UNION ALL SELECT entity_id FROM r WHERE n <= greatest(0, 120 - (SELECT count(*) FROM k))",
    "country_limits": f"WITH {ENTITIES}, c AS (SELECT DISTINCT upper(country) AS country, CASE WHEN upper(country) = 'EN' THEN 0.7::DOUBLE ELSE 0.5::DOUBLE + length(country) / 100 END AS t FROM ent WHERE entity_id LIKE 'S1-%') SELECT country, round(t, 6) AS tau_singleton, round(t * 0.85, 6) AS tau_secondary FROM c",
    "concatenated_text": "SELECT event_id, coalesce(event_type, '') || ' | ' || coalesce(CAST(user_id AS VARCHAR), '') || ' | ' || coalesce(props, '') AS text FROM events",
}
SQL["written_candidates"] = SQL["candidate_lists"]
SQL["arrivals"] = f"WITH RECURSIVE {PREPARED}, {LINKED} SELECT s1, cand, round(p, 6) AS p FROM scored"
PAIR_TEXT = "list_distinct(list_filter(regexp_split_to_array(lower('name: ' || trim(business_name) || ' | addr: ' || trim(business_address) || ' | country: ' || trim(country)), '\\s+'), lambda x: x <> ''))"
SQL["pair_scorer"] = f"WITH RECURSIVE {PREPARED}, {T1}, said AS (SELECT entity_id, {PAIR_TEXT} AS w FROM ent) SELECT s1, cand, round({JACCARD.format('a.w', 'b.w')}, 6) AS p_ce FROM t1 JOIN said a ON s1 = a.entity_id JOIN said b ON cand = b.entity_id"
SQL |= round_trips.sql(PREPARED, T1, SCORED, TRUTH, ENTITIES)
