"""SQL for DuckDB that says independently what the queries return."""

from __future__ import annotations

from ..functions import complexity, llm_json, rules
from ..operators import sketches
from ..schema import COMPARED, FIELDS, SHORT
from .fixtures import addresses_sql

A = f"addresses AS MATERIALIZED ({addresses_sql()})"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def squeeze(c: str) -> str:
    return f"regexp_replace({c}, '\\s+', ' ', 'g')"


def first_match(c: str, patterns: list[str], flag: str = "") -> str:
    f = f", '{flag}'" if flag else ""
    return "coalesce(" + ", ".join(f"CASE WHEN regexp_matches({c}, '{p}'{f}) THEN {strip(f"regexp_extract({c}, '{p}', 1{f})")} END" for p in patterns) + ", '')"


def first_listed(c: str, names: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({c}), '{n.lower()}') THEN '{n}'" for n in names) + " ELSE '' END"


def parsed(source: str = "addresses", city: str | None = None, society: str | None = None, note: str = rules.NOTE) -> str:
    """CTEs t, c and p: the rule parser over a relation with row_id, addr_text and whatever it has besides."""
    own_city, own_society = first_listed("t", rules.CITIES), squeeze(first_match("t", rules.SOCIETY, "i"))
    return f"""t AS MATERIALIZED (SELECT *, {strip("coalesce(addr_text, '')")} AS t FROM {source}),
c AS MATERIALIZED (SELECT *, {f"coalesce(nullif({city}, ''), {own_city})" if city else own_city} AS r_city, {f"coalesce(nullif({society}, ''), {own_society})" if society else own_society} AS r_society FROM t),
d AS (SELECT *, CASE WHEN r_city = '' THEN 0 ELSE instr(lower(t), lower(r_city)) END AS place FROM c),
e AS MATERIALIZED (SELECT *, CASE WHEN place > 1 THEN list_transform(string_split({strip("substr(t, 1, place - 1)")}, ','), lambda x: {strip("x")}) ELSE [] END AS parts FROM d),
p AS MATERIALIZED (SELECT * EXCLUDE (t, r_city, r_society, place, parts), t <> '' AS parse_success, CASE WHEN t = '' THEN '{rules.EMPTY_ERROR}' END AS parse_error,
  CASE WHEN t = '' THEN '' ELSE {first_match("t", rules.UNIT, "i")} END AS unit_number, CASE WHEN t = '' THEN '' ELSE r_society END AS society_name,
  {strip(f"regexp_extract(t, '{rules.LANDMARK}', 1)")} AS landmark, {first_match("t", rules.ROAD)} AS road,
  CASE WHEN len(parts) >= 2 THEN parts[-1] ELSE '' END AS sub_locality, CASE WHEN len(parts) >= 3 THEN parts[-2] ELSE '' END AS locality,
  CASE WHEN t = '' THEN '' ELSE r_city END AS city, CASE WHEN t = '' THEN '' ELSE r_city END AS district, {first_listed("t", rules.STATES)} AS state, CASE WHEN t = '' THEN '' ELSE 'India' END AS country,
  regexp_extract(t, '{rules.PIN}', 1) AS pin_code, CASE WHEN t = '' THEN '' ELSE '{note}' END AS note FROM e)"""


RULES = f"WITH {A}, {parsed()}"
ALL = ", ".join(FIELDS)
PIN = f"regexp_extract({strip("coalesce(addr_text, '')")}, '{rules.PIN}', 1)"


def entities(compare: str, note: str) -> str:
    """CTE n: what the fixture's entity lists amount to."""
    x = f"x_score {compare} 0.5"
    blank = f"{strip("coalesce(addr_text, '')")} = ''"
    word = lambda c: strip(f"regexp_replace({strip(c)}, ',+$', '')")
    town = "x_city" if compare == ">=" else "''"
    v = {
        "unit_number": word("x_unit"), "society_name": f"coalesce(nullif({word('x_society')}, ''), CASE WHEN {x} THEN 'Second Name' ELSE '' END)", "landmark": f"CASE WHEN {x} THEN {word('x_near')} ELSE '' END", "road": word("x_road"), "sub_locality": "''",
        "locality": word("x_locality"), "city": f"coalesce(nullif({town}, ''), CASE WHEN {x} THEN x_city ELSE '' END)", "district": f"coalesce(nullif({town}, ''), CASE WHEN {x} THEN x_city ELSE '' END)", "state": word("x_state"), "country": "'India'", "pin_code": PIN, "note": f"'{note}'",
    }
    return "n AS MATERIALIZED (SELECT row_id, addr_text, pincode, " + ", ".join(f"CASE WHEN {blank} THEN '' ELSE {e} END AS {f}" for f, e in v.items()) + f", NOT ({blank}) AS parse_success, CASE WHEN {blank} THEN '{rules.EMPTY_ERROR}' END AS parse_error FROM addresses)"


def score(c: str) -> str:
    parts = [f"least(({' + '.join(f"contains(lower({c}), '{p}')::INT" for p in ps)}) / {float(len(ps))}::DOUBLE, 1.0::DOUBLE) * {w}::DOUBLE" for w, ps in complexity.KINDS]
    total = "0.0::DOUBLE"
    for x in [*parts, f"least(length({c}) / 100.0::DOUBLE, 1.0::DOUBLE) * 0.1::DOUBLE", f"least(len(list_filter(regexp_split_to_array({c}, '\\s+'), lambda w: w <> '')) / 10.0::DOUBLE, 1.0::DOUBLE) * 0.1::DOUBLE", f"CASE WHEN len(regexp_extract_all({c}, '\\d+')) >= 3 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END"]:
        total = f"({total} + {x})"
    return f"least(greatest({total}, 0.0::DOUBLE), 1.0::DOUBLE)"


NAME = strip(squeeze(f"regexp_replace(regexp_replace({strip('lower(society_name)')}, '[-_]', ' ', 'g'), '[^a-z0-9\\s]', '', 'g')"))
KEYED = f"k AS (SELECT *, CASE WHEN {strip('society_name')} <> '' THEN {NAME} END AS name_key FROM p), g AS (SELECT *, CASE WHEN name_key IS NULL THEN 'UNMATCHED' ELSE md5(name_key || '|' || pin_code) END AS group_id FROM k)"
GROUPS = "gs AS (SELECT group_id, CASE WHEN group_id = 'UNMATCHED' THEN '' ELSE arg_min(society_name, row_id) END AS society_name, CASE WHEN group_id = 'UNMATCHED' THEN '' ELSE arg_min(pin_code, row_id) END AS pin_code, count(*) AS record_count, min(row_id) AS first_row FROM g GROUP BY group_id)"
EPIN = "coalesce(nullif(pin_code, ''), nullif(pincode, ''), 'UNKNOWN')"
TITLE = lambda c: f"list_aggregate(list_transform(regexp_extract_all(lower({c}), '[\\p{{L}}]+|[^\\p{{L}}]+'), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), 'string_agg', '')"


def summary(sample: int = 5, titles: bool = True) -> str:
    shape = (lambda c: f"list_transform({c}, lambda v: {TITLE('v')})") if titles else (lambda c: c)
    short = lambda c: f"coalesce(array_to_string(({c})[1:{sample}], '; '), '') || CASE WHEN len({c}) > {sample} THEN '...' ELSE '' END"
    full = lambda c: f"coalesce(array_to_string({c}, '; '), '')"
    return f"""q AS (SELECT {EPIN} AS pin, parse_success AS ok, nullif({strip('lower(locality)')}, '') AS l, nullif({strip('lower(society_name)')}, '') AS s FROM p),
r AS MATERIALIZED (SELECT pin AS pin_code, count(*) AS total_addresses, count_if(ok)::BIGINT AS successful_parses, coalesce(list_sort(list_distinct(list(l) FILTER (ok AND l IS NOT NULL))), []) AS ls, coalesce(list_sort(list_distinct(list(s) FILTER (ok AND s IS NOT NULL))), []) AS ss FROM q GROUP BY pin),
u AS (SELECT pin_code, total_addresses, successful_parses, successful_parses / total_addresses * 100 AS success_rate_percent, len(ls)::BIGINT AS distinct_localities_count, len(ss)::BIGINT AS distinct_societies_count,
  {short(shape('ls'))} AS localities_sample, {short(shape('ss'))} AS societies_sample, {full(shape('ls'))} AS all_localities, {full(shape('ss'))} AS all_societies FROM r)"""


def rate_rows(table: str, expr) -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS field, round(coalesce({expr(f)}, 0) * 100, 6) AS rate FROM {table}" for f in COMPARED)


SAME = lambda f: f"({strip(f'lower(coalesce(a.{f}, \'\'))')} = {strip(f'lower(coalesce(b.{f}, \'\'))')})"
PAIRS = f"{RULES}, {entities('>', 'Parsed using entity recogniser')}, pairs AS (SELECT a.row_id, a.parse_success AS oka, b.parse_success AS okb, {', '.join(f'{SAME(f)} AS same_{f}, a.{f} AS a_{f}, b.{f} AS b_{f}' for f in COMPARED)} FROM p a JOIN n b USING (row_id))"
COUNT = lambda side, fs: " + ".join(f"(coalesce({side}_{f}, '') <> '')::INT" for f in fs)
MEAN = lambda t: "(" + " + ".join(f"avg((parse_success AND {strip(f)} <> '')::INT)" for f in COMPARED) + f") / {len(COMPARED)} * 100"
METRICS = f"m AS (SELECT 'a' AS parser, round(avg(parse_success::INT) * 100, 6) AS success_rate, round({MEAN('p')}, 6) AS extraction_rate, 0.3::DOUBLE AS ms FROM p UNION ALL SELECT 'b', round(avg(parse_success::INT) * 100, 6), round({MEAN('n')}, 6), 800.0 FROM n)"
CHECKED = f"""WITH {A}, x AS (SELECT row_id, {strip('addr_text')} AS addr_text, {strip('pincode')} AS pincode, {strip('city_id')} AS city_id, coalesce(try_cast(nullif({strip('assigned_pickup_dlvd_geo_points_count')}, '') AS INT), 0) AS assigned_pickup_dlvd_geo_points_count FROM addresses),
y AS (SELECT *, CASE WHEN addr_text = '' THEN 'Empty addr_text' WHEN pincode = '' THEN 'Empty pincode' WHEN city_id = '' THEN 'Empty city_id' END AS reject_reason FROM x)"""
RUNS = "runs AS (SELECT event_id, user_id, ts, event_type AS configuration, value AS throughput, event_id % 10 <> 0 AS ok, ((event_id * 7) % 100)::DOUBLE AS utilisation, event_id % 2 AS suite FROM events)"
BENCH = lambda where: f"SELECT configuration, avg(throughput) FILTER (ok) AS avg_throughput, max(throughput) FILTER (ok) AS max_throughput, min(throughput) FILTER (ok) AS min_throughput, coalesce(stddev_samp(throughput) FILTER (ok), 0) AS throughput_std, avg(utilisation) FILTER (ok) AS avg_utilisation, count(*) AS test_count, avg(ok::INT) * 100 AS success_rate FROM runs WHERE {where} GROUP BY 1 HAVING count_if(ok) > 0"
BENCH_OUT = "configuration, round(avg_throughput, 6) AS avg_throughput, max_throughput, min_throughput, round(throughput_std, 6) AS throughput_std, round(avg_utilisation, 6) AS avg_utilisation, test_count, round(success_rate, 6) AS success_rate"


SHEET_FIELDS = ["unit_number", "society_name", "landmark", "road", "locality", "city", "pin_code"]
SHEET = f"sh AS (SELECT row_id, CASE WHEN length(addr_text) > 100 THEN substr(addr_text, 1, 100) || '...' ELSE addr_text END AS address, {', '.join(SHEET_FIELDS)}, {' + '.join(f"({f} <> '')::INT" for f in SHEET_FIELDS)} AS fields, parse_success AS ok, coalesce(parse_error, '') AS error FROM p)"


FILES = """fs AS (SELECT source_file, count(*) AS rows, count_if(parse_success)::BIGINT AS succeeded FROM p GROUP BY 1),
fr AS (SELECT row_number() OVER (ORDER BY source_file)::INT AS file_index, source_file, rows, succeeded, rows - succeeded AS errors, round(succeeded / rows * 100, 6) AS success_rate, seconds, round(CASE WHEN seconds > 0 THEN rows / seconds ELSE 0 END, 6) AS rate
  FROM (SELECT *, CASE WHEN source_file = 'p7.csv' THEN 0.0::DOUBLE ELSE regexp_extract(source_file, '(\\d+)', 1)::INT * 0.25::DOUBLE END AS seconds FROM fs))"""
MACHINE = "WITH m AS (SELECT *, mb / greatest(gpus, 1) AS each FROM (SELECT o_orderkey, o_orderkey % 4 AS gpus, o_orderkey % 13 * 1000 AS mb, o_orderkey % 3 <> 0 AS usable, o_orderkey % 33 AS cores, o_orderkey % 40 AS memory FROM orders))"


def splits_sql() -> str:
    def row(name: str, shares: list[str]) -> str:
        parts = [f"floor(n * {x}::DOUBLE)::BIGINT" for x in shares]
        return f"SELECT o_orderkey, '{name}' AS split, array_to_string([{', '.join([*parts, 'n - ' + ' - '.join(parts)])}]::VARCHAR[], ',') AS rows FROM x"

    named = {"70/30": ["0.7"], "65/30/5": ["0.65", "0.3"], "80/1/19": ["0.8", "0.01"], "75/1/24": ["0.75", "0.01"], "90/1/9": ["0.9", "0.01"], "85/2/13": ["0.85", "0.02"], "95/5": ["0.95"], "80/20": ["0.8"], "90/10": ["0.9"], "98/2": ["0.98"]}
    even = "SELECT o_orderkey, 'even' AS split, array_to_string([" + ", ".join(["n // 7"] * 6) + ", n - 6 * (n // 7)]::VARCHAR[], ',') AS rows FROM x"
    return "WITH x AS (SELECT o_orderkey, o_orderkey % 2000 + 1 AS n FROM orders) " + " UNION ALL ".join([*(row(k, v) for k, v in named.items()), even])


def mock_fields() -> dict[str, str]:
    low, words = "lower(addr_text)", "list_filter(regexp_split_to_array(addr_text, '\\s+'), lambda w: w <> '')"

    def around(keys: list[str], before: int, least: int) -> str:
        hit = f"coalesce(list_position(list_transform({words}, lambda w: regexp_matches(lower(w), '{'|'.join(keys)}')), true), 0)"
        return f"CASE WHEN {hit} >= {least} THEN array_to_string(({words})[greatest({hit} - {before}, 1):{hit}], ' ') ELSE '' END"

    at = f"greatest(instr({low}, 'near'), instr({low}, 'opposite'))"
    city = "CASE " + " ".join(f"WHEN contains({low}, '{c}') THEN '{c.title()}'" for c in llm_json.MOCK_CITIES) + " ELSE '' END"
    return {
        "unit_number": "coalesce(" + ", ".join(f"CASE WHEN regexp_matches({low}, '{p}') THEN regexp_extract({low}, '{p}', 1) END" for p in llm_json.MOCK_UNIT) + ", '')",
        "society_name": around(llm_json.MOCK_SOCIETY, 2, 2),
        "landmark": f"CASE WHEN {at} > 0 THEN string_split(substr(addr_text, {at}, 50), ',')[1] ELSE '' END",
        "road": "CASE " + " ".join(f"WHEN contains({low}, '{k}') THEN {around([k], 3, 1)}" for k in llm_json.MOCK_ROAD) + " ELSE '' END",
        "city": city, "pin_code": f"regexp_extract(addr_text, '{rules.PIN}', 1)", "state": "CASE " + " ".join(f"WHEN contains({low}, '{s}') THEN '{s.title()}'" for s in llm_json.MOCK_STATES) + " ELSE '' END",
    }


def component_fields() -> dict[str, str]:
    low = lambda c: strip(f"lower({c})")
    return {
        "unit_number": low("x_unit"), "society_name": low("x_society"), "landmark": low("x_near"), "road": f"CASE WHEN x_road = '' THEN 'lane 2' ELSE {low('x_road')} || ' lane 2' END", "sub_locality": low("x_locality"), "city": low("x_city"), "district": low("x_city"), "state": low("x_state"), "country": "'India'",
        "pin_code": f"CASE WHEN row_id % 2 = 0 AND x_pin <> '' THEN x_pin ELSE {PIN} END",
    }


def when_text(fields: dict[str, str]) -> str:
    return ", ".join(f"CASE WHEN {strip('addr_text')} = '' THEN '' ELSE {e} END AS {f}" for f, e in fields.items())


def fuzzy_names() -> str:
    """CTEs: distinct names per code in order of their first rows (k), and how alike any two names are, by the longest common subsequence of their sorted words."""
    n = NAME.replace("society_name", "society_name")
    longest = """list_reduce(list_prepend(list_transform(range(0, len(y) + 1), lambda i: 0::BIGINT), list_transform(x, lambda c: [ascii(c)::BIGINT])),
      lambda row, c: list_transform(range(1, len(y) + 2), lambda j: list_max(list_prepend(0::BIGINT, list_transform(range(2, j + 1), lambda i: CASE WHEN ascii(y[i - 1]) = c[1] THEN row[i - 1] + 1 ELSE row[i] END)))))"""
    return f"""{RULES}, {entities('>', 'x')},
kn AS (SELECT row_id, pin_code AS pin_key, society_name, CASE WHEN {strip('society_name')} <> '' THEN {n} END AS name_key FROM n),
dn AS MATERIALIZED (SELECT pin_key, name_key, min(row_id) AS first_row, count(*) AS rows, arg_min(society_name, row_id) AS society FROM kn WHERE name_key IS NOT NULL GROUP BY 1, 2),
one AS MATERIALIZED (SELECT DISTINCT name_key AS name, string_split(array_to_string(list_sort(list_filter(string_split(name_key, ' '), lambda w: w <> '')), ' '), '') AS c FROM dn WHERE name_key <> ''),
two AS MATERIALIZED (SELECT a.name AS a, b.name AS b, a.c AS x, b.c AS y FROM one a JOIN one b ON a.name < b.name AND 2 * least(len(a.c), len(b.c)) >= 0.84 * (len(a.c) + len(b.c))),
like_ AS MATERIALIZED (SELECT a, b, round(2.0::DOUBLE * ({longest})[-1] / (len(x) + len(y)), 6) AS similarity FROM two)"""


def oracle_sql() -> dict[str, str]:
    levels = [f"round((n - {c}) / n * 100, 6) AS {c}_pct" for c in ("societies", "localities", "pins")] + [f"round(n / {c}, 6) AS {c}_factor" for c in ("societies", "localities", "pins")]
    top = lambda by, n, extra="": f"{RULES}, {summary()} SELECT pin_code, total_addresses{extra} FROM u ORDER BY {by} DESC, pin_code LIMIT {n}"
    routed = f"{RULES}, {entities('>', 'x')}, w AS (SELECT row_id, {score("coalesce(addr_text, '')")} AS complexity FROM addresses)"
    cs = "(o_totalprice % 2500)"
    return {
        "ingest_valid": f"{CHECKED} SELECT * EXCLUDE (reject_reason) FROM y WHERE reject_reason IS NULL",
        "ingest_rejects": f"{CHECKED} SELECT row_id, reject_reason FROM y WHERE reject_reason IS NOT NULL",
        "ingest_counts": f"{CHECKED} SELECT count_if(reject_reason IS NULL)::BIGINT AS loaded, count_if(reject_reason IS NOT NULL)::BIGINT AS malformed FROM y",
        "clean_address": f"WITH {A} SELECT row_id, substr({squeeze(strip('addr_text'))}, 1, 300) AS cleaned FROM addresses",
        "clean_address_cpu": f"WITH {A} SELECT row_id, substr({squeeze(strip('addr_text'))}, 1, 250) AS cleaned FROM addresses",
        "clean_documents": f"SELECT doc_id, substr({squeeze(strip("coalesce(text, '')"))}, 1, 300) AS cleaned FROM documents",
        "with_address": f"WITH {A} SELECT row_id FROM addresses WHERE {strip('addr_text')} <> ''",
        "rule_parse": f"{RULES} SELECT row_id, {ALL}, parse_success, parse_error FROM p",
        "rule_locality": f"{RULES} SELECT city, locality, sub_locality, count(*) AS n FROM p GROUP BY ALL",
        "normalize_names": f"WITH {A} SELECT row_id, {NAME.replace('society_name', 'x_society')} AS name FROM addresses",
        "location_identifier": f"{RULES} SELECT row_id, CASE WHEN society_name = '' THEN 'UNMATCHED' ELSE society_name END || '_' || pin_code AS location_identifier FROM p",
        "sanitize": "SELECT doc_id, regexp_replace(coalesce(text, '') || chr(1) || 'x' || chr(9) || chr(11) || chr(31), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g') AS clean FROM documents",
        "display_truncate": f"WITH {A} SELECT row_id, CASE WHEN length(addr_text) > 100 THEN substr(addr_text, 1, 100) || '...' ELSE addr_text END AS shown FROM addresses",
        "random_sample": f"WITH {A} SELECT row_id, addr_text FROM addresses ORDER BY md5('42|' || row_id), row_id LIMIT 100",
        "similarity_pairs": f"{fuzzy_names()} SELECT p1.pin_key, a AS left_name, b AS right_name, similarity FROM like_ JOIN dn p1 ON p1.name_key = a JOIN dn p2 ON p2.name_key = b AND p1.pin_key = p2.pin_key WHERE similarity >= 0.85",
        "consolidate_fuzzy": f"""{fuzzy_names().replace('WITH ', 'WITH RECURSIVE ', 1)},
near AS MATERIALIZED (SELECT name, list(other) AS others FROM (SELECT a AS name, b AS other FROM like_ WHERE similarity >= 0.85 UNION ALL SELECT b, a FROM like_ WHERE similarity >= 0.85) GROUP BY 1),
seq AS MATERIALIZED (SELECT pin_key, name_key, coalesce(others, []) AS others, row_number() OVER (PARTITION BY pin_key ORDER BY first_row) AS k FROM dn LEFT JOIN near ON name = name_key),
walk AS (SELECT pin_key, 0::BIGINT AS k, []::VARCHAR[] AS leaders, NULL::VARCHAR AS name_key, NULL::VARCHAR AS leader FROM (SELECT DISTINCT pin_key FROM dn)
  UNION ALL SELECT w.pin_key, s.k, CASE WHEN len(list_filter(w.leaders, lambda l: list_contains(s.others, l))) > 0 THEN w.leaders ELSE list_append(w.leaders, s.name_key) END, s.name_key, coalesce(list_filter(w.leaders, lambda l: list_contains(s.others, l))[1], s.name_key)
  FROM walk w JOIN seq s ON s.pin_key = w.pin_key AND s.k = w.k + 1),
led AS (SELECT coalesce(md5(w.leader || '|' || kn.pin_key), 'UNMATCHED') AS group_id, kn.row_id, kn.society_name, kn.pin_key FROM kn LEFT JOIN walk w ON w.pin_key = kn.pin_key AND w.name_key = kn.name_key)
SELECT group_id, CASE WHEN group_id = 'UNMATCHED' THEN '' ELSE arg_min(society_name, row_id) END AS society_name, CASE WHEN group_id = 'UNMATCHED' THEN '' ELSE arg_min(pin_key, row_id) END AS pin_code, count(*) AS record_count FROM led GROUP BY group_id""",
        "stream_consolidation": f"""{fuzzy_names().replace('WITH ', 'WITH RECURSIVE ', 1)},
near AS MATERIALIZED (SELECT name, list(other) AS others FROM (SELECT a AS name, b AS other FROM like_ WHERE similarity >= 0.85 UNION ALL SELECT b, a FROM like_ WHERE similarity >= 0.85) GROUP BY 1),
seq AS MATERIALIZED (SELECT pin_key, name_key, coalesce(others, []) AS others, row_number() OVER (PARTITION BY pin_key ORDER BY first_row) AS k FROM dn LEFT JOIN near ON name = name_key),
walk AS (SELECT pin_key, 0::BIGINT AS k, []::VARCHAR[] AS leaders, NULL::VARCHAR AS name_key, NULL::VARCHAR AS leader FROM (SELECT DISTINCT pin_key FROM dn)
  UNION ALL SELECT w.pin_key, s.k, CASE WHEN len(list_filter(w.leaders, lambda l: list_contains(s.others, l))) > 0 THEN w.leaders ELSE list_append(w.leaders, s.name_key) END, s.name_key, coalesce(list_filter(w.leaders, lambda l: list_contains(s.others, l))[1], s.name_key)
  FROM walk w JOIN seq s ON s.pin_key = w.pin_key AND s.k = w.k + 1) SELECT w.pin_key, w.name_key, w.leader, dn.rows::BIGINT AS rows, (sum(dn.rows) OVER (PARTITION BY w.pin_key, w.leader))::BIGINT AS leader_rows FROM walk w JOIN dn ON dn.pin_key = w.pin_key AND dn.name_key = w.name_key""",
        "consolidate_exact": f"{RULES}, {KEYED}, {GROUPS} SELECT group_id, society_name, pin_code, record_count FROM gs",
        "group_members": f"{RULES}, {KEYED} SELECT row_id, group_id FROM g",
        "group_stats": f"""{RULES}, {KEYED}, {GROUPS}, s AS (SELECT count(*) AS total_groups, sum(record_count)::BIGINT AS n, max(record_count) AS largest_group_size, arg_max(society_name, (record_count, (group_id <> 'UNMATCHED')::INT, -first_row)) AS largest_group_name, coalesce(sum(record_count) FILTER (group_id = 'UNMATCHED'), 0)::BIGINT AS unmatched_count FROM gs)
SELECT n AS total_records, total_groups, round(n / total_groups, 6) AS avg_records_per_group, largest_group_size, largest_group_name, round((n - unmatched_count) / n * 100, 6) AS match_percentage, (SELECT count_if(parse_success) FROM p)::BIGINT AS parse_success_count, n - (SELECT count_if(parse_success) FROM p)::BIGINT AS parse_failure_count, unmatched_count FROM s""",
        "pin_summary": f"{RULES}, {summary()} SELECT * FROM u",
        "pin_names": f"{RULES}, {summary()} SELECT pin AS pin_code, kind, name, count(*)::BIGINT AS addresses FROM (SELECT pin, 'locality' AS kind, l AS name FROM q WHERE ok UNION ALL SELECT pin, 'society', s FROM q WHERE ok) WHERE name IS NOT NULL GROUP BY ALL",
        "pin_sketches": f"""{RULES}, q AS (SELECT {EPIN} AS pin, nullif({strip('lower(locality)')}, '') AS l, nullif({strip('lower(society_name)')}, '') AS s, nullif({strip('lower(addr_text)')}, '') AS a FROM p WHERE parse_success),
h AS (SELECT DISTINCT pin AS pin_code, kind, ('0x' || substr(md5(name), 1, 15))::BIGINT AS hash FROM (SELECT pin, 'locality' AS kind, l AS name FROM q UNION ALL SELECT pin, 'society', s FROM q UNION ALL SELECT pin, 'address', a FROM q) WHERE name IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY pin_code, kind ORDER BY hash) AS k FROM (SELECT * FROM h UNION SELECT 'ALL', kind, hash FROM h))
SELECT pin_code, kind, count(*)::BIGINT AS kept, round(CASE WHEN count(*) < {sketches.K} THEN count(*)::DOUBLE ELSE {sketches.K - 1}::DOUBLE * {1 << 60}::DOUBLE / (max(hash) + 1)::DOUBLE END, 6) AS names FROM r WHERE k <= {sketches.K} GROUP BY ALL""",
        "pin_summary_lower": f"{RULES}, {summary(10, False)} SELECT * FROM u",
        "consolidation_pct": f"""{RULES}, z AS (SELECT coalesce(nullif(pin_code, ''), 'Unknown') AS pin_code, count(*) AS total_addresses, count(DISTINCT nullif(society_name, '')) AS distinct_societies, count(DISTINCT nullif(locality, '')) AS distinct_localities FROM p WHERE parse_success GROUP BY 1)
SELECT *, round((total_addresses - distinct_societies) / total_addresses * 100, 6) AS society_consolidation_pct, round((total_addresses - distinct_localities) / total_addresses * 100, 6) AS locality_consolidation_pct FROM z""",
        "consolidation_levels": f"{RULES}, {summary()}, v AS (SELECT sum(total_addresses)::BIGINT AS n, sum(distinct_societies_count)::BIGINT AS societies, sum(distinct_localities_count)::BIGINT AS localities, count(*) AS pins FROM u) SELECT n AS total_addresses, societies, localities, pins, {', '.join(levels)}, round(n / pins, 6) AS addresses_per_pin, round(societies / pins, 6) AS societies_per_pin, round(localities / pins, 6) AS localities_per_pin FROM v",
        "top_pins": top("total_addresses", 10),
        "locality_diversity": top("distinct_localities_count", 10, ", distinct_localities_count"),
        "society_diversity": top("distinct_societies_count", 10, ", distinct_societies_count"),
        "sample_per_pin": f"{RULES}, h AS (SELECT row_id, {EPIN} AS pin_code, CASE WHEN length(addr_text) > 100 THEN substr(addr_text, 1, 100) || '...' ELSE addr_text END AS address, society_name AS society, locality FROM p) SELECT *, row_number() OVER (PARTITION BY pin_code ORDER BY row_id)::INT AS place FROM h QUALIFY place <= 3",
        "distinct_societies": f"{RULES} SELECT DISTINCT {strip('society_name')} AS society_name FROM p WHERE {strip('society_name')} <> ''",
        "keyword_buckets": f"{RULES}, h AS (SELECT DISTINCT {strip('society_name')} AS s FROM p WHERE {strip('society_name')} <> '') SELECT count(*) AS names, {', '.join(f"count_if(contains(lower(s), '{k}'))::BIGINT AS {k}" for k in ('apartment', 'society', 'complex', 'tower', 'residency'))} FROM h",
        "quality_buckets": f"{RULES}, {summary()} SELECT count_if(total_addresses >= 10 AND success_rate_percent > 90)::BIGINT AS high_quality, count_if(total_addresses >= 10 AND success_rate_percent < 50)::BIGINT AS low_quality FROM u",
        "geo_diversity": f"{RULES} SELECT count(DISTINCT nullif(city, '')) + count(DISTINCT nullif(pin_code, '')) AS diversity, count(DISTINCT nullif(city, '')) AS cities, count(DISTINCT nullif(pin_code, '')) AS pins FROM p",
        "complexity_score": f"WITH {A} SELECT row_id, round({score("coalesce(addr_text, '')")}, 6) AS complexity FROM addresses",
        "complexity_documents": f"SELECT doc_id, round({score("coalesce(text, '')")}, 6) AS complexity FROM documents",
        "route": f"WITH {A} SELECT row_id, CASE WHEN {score("coalesce(addr_text, '')")} >= 0.3 THEN 'entities' ELSE 'rules' END AS route FROM addresses",
        "route_usage": f"""{routed}, v AS (SELECT row_id, complexity, CASE WHEN complexity >= 0.3 THEN 'entities' ELSE 'rules' END AS route, p.parse_success AND row_id % 7 <> 0 AS okr, n.parse_success AND row_id % 5 <> 0 AS oke FROM w JOIN p USING (row_id) JOIN n USING (row_id)),
f AS (SELECT *, CASE WHEN route = 'rules' THEN CASE WHEN okr THEN 'rules' WHEN oke THEN 'entities' END ELSE CASE WHEN oke THEN 'entities' WHEN okr THEN 'rules' END END AS used FROM v),
h AS (SELECT count(*) AS total_attempts, count(used) AS total_parsed, count_if(used = 'rules')::BIGINT AS rules_used, count_if(used = 'entities')::BIGINT AS entities_used, count_if(used <> route)::BIGINT AS fallback_used FROM f)
SELECT *, total_attempts - total_parsed AS total_failed, round(total_parsed / total_attempts * 100, 1) AS success_rate_percent, round(rules_used / total_parsed * 100, 1) AS rules_usage_percent, round(entities_used / total_parsed * 100, 1) AS entities_usage_percent, round(fallback_used / total_attempts * 100, 1) AS fallback_usage_percent FROM h""",
        "route_notes": f"""{RULES}, {entities('>', 'x')}, w AS (SELECT row_id, {score("coalesce(addr_text, '')")} AS complexity FROM addresses), v AS (SELECT row_id, complexity, CASE WHEN complexity >= 0.3 THEN 'entities' ELSE 'rules' END AS route, p.parse_success AND row_id % 7 <> 0 AS okr, n.parse_success AND row_id % 5 <> 0 AS oke, p.parse_error AS er, n.parse_error AS ee FROM w JOIN p USING (row_id) JOIN n USING (row_id)),
f AS (SELECT *, CASE WHEN route = 'rules' THEN okr ELSE oke END AS ok1, CASE WHEN route = 'rules' THEN oke ELSE okr END AS ok2, CASE WHEN route = 'rules' THEN 'entities' ELSE 'rules' END AS other, CASE WHEN route = 'rules' THEN ee ELSE er END AS e2 FROM v)
SELECT row_id, ok1 OR ok2 AS parse_success, CASE WHEN ok1 THEN 'Parsed using ' || route || ' parser (complexity: ' || printf('%.2f', complexity) || ')' WHEN ok2 THEN 'Parsed using ' || other || ' parser (fallback, complexity: ' || printf('%.2f', complexity) || ')' ELSE '' END AS note, CASE WHEN NOT ok1 AND NOT ok2 THEN 'Both parsers failed. Primary: ' || route || ', Fallback: ' || coalesce(e2, '') END AS parse_error FROM f""",
        "tune_threshold": f"WITH {A}, w AS (SELECT {score("coalesce(addr_text, '')")} AS s FROM addresses), o AS (SELECT s, row_number() OVER (ORDER BY s) AS k, count(*) OVER () AS n FROM w) SELECT round(s, 6) AS threshold FROM o WHERE k = floor(n * (1.0::DOUBLE - 0.3::DOUBLE)) + 1",
        "entity_map": f"WITH {A}, {entities('>', 'Parsed using entity recogniser')} SELECT row_id, {ALL}, parse_success FROM n",
        "entity_map_cpu": f"WITH {A}, {entities('>=', 'cpu')} SELECT row_id, {ALL}, parse_success FROM n",
        "generic_entity_map": f"WITH {A}, {parsed(city=strip('x_city'), society=strip('x_society'), note='Parsed using entities and rules')} SELECT row_id, {ALL} FROM p",
        "label_inventory": f"WITH {A}, n AS (SELECT count(*) AS n FROM addresses) SELECT unnest(['HOUSE_DETAILS', 'building_name', 'building', 'landmarks', 'street', 'locality', 'town', 'city', 'state']) AS label, n FROM n",
        "component_map": f"WITH {A} SELECT row_id, {when_text(component_fields())} FROM addresses",
        "llm_json": f"WITH {A}, v AS (SELECT *, {strip('addr_text')} <> '' AND row_id % 5 <> 2 AS ok, row_id % 5 = 1 AS short FROM addresses) SELECT row_id, ok AS parse_success, CASE WHEN ok AND NOT short THEN x_unit ELSE '' END AS unit_number, CASE WHEN ok AND NOT short AND {strip('x_society')} <> '' THEN x_society ELSE '' END AS society_name, CASE WHEN ok THEN CASE WHEN short THEN 'Pune' ELSE x_city END ELSE '' END AS city, CASE WHEN ok AND NOT short THEN x_pin ELSE '' END AS pin_code FROM v",
        "keyword_parse": f"WITH {A} SELECT row_id, {when_text(mock_fields())} FROM addresses",
        "llm_cost": f"WITH {A}, c AS (SELECT count(*) AS n FROM addresses) SELECT n, s AS paid_share, round(n * s * 0.02::DOUBLE, 6) AS cost FROM c, (SELECT unnest([0.3::DOUBLE, 0.5::DOUBLE, 0.4::DOUBLE]) AS s)",
        "extraction_rates_all": f"{RULES} {rate_rows('p', lambda f: f"avg(({f} <> '')::INT)")}",
        "extraction_rates_success": f"{RULES} {rate_rows('p', lambda f: f"avg((parse_success AND {strip(f)} <> '')::INT)")}",
        "extraction_rates_strict": f"{RULES} {rate_rows('p', lambda f: f"avg(({f} <> '')::INT) FILTER (parse_success)")}",
        "agreement_by_field": f"{PAIRS} {rate_rows('pairs', lambda f: f'avg(same_{f}::INT) FILTER (oka AND okb)')}",
        "agreement_by_row": f"{PAIRS} SELECT row_id, round(({' + '.join(f'same_{f}::INT' for f in COMPARED)}) / 11.0::DOUBLE * 100, 6) AS agreement_score FROM pairs",
        "field_verdicts": f"{PAIRS} " + " UNION ALL ".join(f"SELECT '{f}' AS field, count_if(a_{f} = b_{f})::BIGINT AS same, count_if(a_{f} <> b_{f})::BIGINT AS different FROM pairs" for f in COMPARED),
        "parser_metrics": f"{RULES}, {entities('>', 'x')}, {METRICS} SELECT * FROM m",
        "measured_parsers": f"{RULES}, {entities('>', 'x')}, {METRICS} SELECT parser, success_rate, extraction_rate, n AS rows, round(success_rate * n / 100)::BIGINT AS succeeded, b AS bytes, true AS measured FROM m, (SELECT count(*) AS n, sum(strlen(addr_text))::BIGINT AS b FROM addresses)",
        "parser_score": f"{RULES}, {entities('>', 'x')}, {METRICS}, s AS (SELECT CASE WHEN x.success_rate > y.success_rate THEN 40 ELSE 0 END + CASE WHEN x.ms < y.ms THEN 30 ELSE 0 END + CASE WHEN x.extraction_rate > y.extraction_rate THEN 30 ELSE 0 END AS a FROM m x, m y WHERE x.parser = 'a' AND y.parser = 'b') SELECT a::INT AS score_a, (100 - a)::INT AS score_b FROM s",
        "best_parser": f"{RULES}, {entities('>', 'x')}, {METRICS} SELECT arg_min(parser, (-success_rate, parser)) AS best_success, arg_min(parser, (ms, parser)) AS fastest, arg_min(parser, (-extraction_rate, parser)) AS best_extraction FROM m",
        "row_winner": f"{PAIRS}, f AS (SELECT row_id, {COUNT('a', ['unit_number', 'society_name', 'locality', 'city', 'pin_code'])} AS fields_a, {COUNT('b', ['unit_number', 'society_name', 'locality', 'city', 'pin_code'])} AS fields_b FROM pairs) SELECT *, CASE WHEN fields_a > fields_b THEN 'a' WHEN fields_b > fields_a THEN 'b' ELSE 'Tie' END AS winner FROM f",
        "sheet_field_count": f"{RULES} SELECT row_id, {' + '.join(f"({f} <> '')::INT" for f in ['unit_number', 'society_name', 'landmark', 'road', 'locality', 'city', 'pin_code'])} AS fields FROM p",
        "target_check": f"{RULES}, o AS (SELECT 'success_rate' AS metric, avg(parse_success::INT) AS v, 95.0::DOUBLE AS target FROM p {' '.join(f"UNION ALL SELECT '{m}', avg(({m} <> '')::INT) FILTER (parse_success), {t} FROM p" for m, t in (('society_name', 30.0), ('locality', 30.0), ('landmark', 15.0), ('unit_number', 50.0)))}) SELECT metric, round(v * 100, 6) AS value, target, CASE WHEN round(v * 100, 6) >= target THEN 'PASS' ELSE 'REVIEW' END AS status FROM o UNION ALL SELECT 'seconds', 0.0, 2.0, 'PASS'",
        "complete_results": f"{RULES} SELECT row_id, parse_success AND row_id % 3 <> 0 AS parse_success, CASE WHEN row_id % 3 = 0 THEN 'No result from processing' ELSE parse_error END AS parse_error FROM p",
        "flat_results": f"{RULES} SELECT row_number() OVER (ORDER BY row_id) AS id, addr_text AS original_address, {', '.join(COMPARED)}, parse_success, coalesce(parse_error, '') AS parse_error, note FROM p",
        "comprehensive_output": f"{RULES} SELECT row_id, {', '.join(f'{f} AS parsed_{f}' for f in FIELDS)}, parse_success, coalesce(parse_error, '') AS parse_error, CASE WHEN row_number() OVER (ORDER BY row_id) <= 1000 THEN 'GPU' ELSE 'CPU' END AS processing_device FROM p",
        "enriched_output": f"{RULES}, {KEYED} SELECT addr_hash_key, addr_text, pincode, {', '.join(f'{f} AS {s}' for f, s in zip(FIELDS, ['UN', 'SN', 'LN', 'RD', 'SL', 'LOC', 'CY', 'DIS', 'ST', 'CN', 'PIN', 'Note'], strict=True))}, group_id, CASE WHEN society_name = '' THEN 'UNMATCHED' ELSE society_name END || '_' || pin_code AS location_identifier FROM g",
        "run_metadata": f"{RULES} SELECT count(*) AS total_rows, count_if(parse_success)::BIGINT AS successful, count_if(NOT parse_success)::BIGINT AS failed, round(avg(parse_success::INT) * 100, 6) AS success_rate FROM p",
        "unprocessed_files": f"WITH {A}, f AS (SELECT DISTINCT source_file AS path FROM addresses) SELECT path FROM f WHERE path NOT IN ('p1.csv', 'p4.csv')",
        "part_numbers": f"WITH {A} SELECT source_file, regexp_extract(source_file, 'p(\\d+)', 1)::INT AS part, count(*) AS n FROM addresses GROUP BY ALL",
        "head_rows": f"WITH {A} SELECT row_id, addr_text FROM addresses ORDER BY row_id LIMIT 100",
        "throughput_1s": "SELECT date_trunc('second', ts) AS at, count(*) AS n FROM events GROUP BY 1",
        "running_peak": f"WITH {RUNS} SELECT event_id, round(avg(throughput) OVER w + 1e-9, 4) AS running_mean, max(throughput) OVER w AS running_peak FROM runs WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)",
        "moving_100": f"WITH {RUNS} SELECT event_id, round(avg(throughput) OVER w + 1e-9, 4) AS running_mean, max(throughput) OVER w AS running_peak FROM runs WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)",
        "relative_perf": f"WITH {RUNS}, b AS ({BENCH('true')}), m AS (SELECT greatest(avg(avg_throughput), 1.0) AS mean FROM b) SELECT configuration, round(avg_throughput / mean * 100, 6) AS relative_pct, avg_throughput / mean * 100 < 80 AS needs_optimization FROM b, m",
        "bench_by_config": f"WITH {RUNS}, b AS ({BENCH('true')}) SELECT {BENCH_OUT} FROM b",
        "best_config": f"WITH {RUNS}, b AS ({BENCH('true')}) SELECT arg_min(configuration, (-avg_throughput, configuration)) AS best_configuration, round(max(avg_throughput), 6) AS best_throughput FROM b",
        "variation": f"WITH {RUNS} SELECT round(stddev_pop(throughput) / avg(throughput), 6) AS variation, stddev_pop(throughput) / avg(throughput) > 0.3 AS variable FROM runs",
        "regression": f"WITH {RUNS}, x AS ({BENCH('suite = 0')}), y AS ({BENCH('suite = 1')}) SELECT configuration, round((y.avg_throughput - x.avg_throughput) / x.avg_throughput * 100, 6) AS change_percent, (y.avg_throughput - x.avg_throughput) / x.avg_throughput < -0.01 AS regression FROM x JOIN y USING (configuration)",
        "perf_score": f"SELECT o_orderkey, round(least({cs} / 2000 * 100, 100) * 0.4 + least((o_orderkey % 101) / 90.0::DOUBLE * 100, 100) * 0.4 + (o_orderkey % 100) * 0.2, 6) AS report, round(least({cs} / 1500 * 50, 50) + least((o_orderkey % 101) / 90.0::DOUBLE * 50, 50), 6) AS validation, round(least({cs} / 1500 * 50, 50) + least((o_orderkey % 101) / 90.0::DOUBLE * 30, 30) + (o_orderkey % 100) * 0.2, 6) AS batch, round(((o_orderkey % 100) + least({cs} / 1500 * 100, 100) + least((o_orderkey % 101) / 90.0::DOUBLE * 100, 100)) / 3, 6) AS file FROM orders",
        "tier": f"SELECT o_orderkey, CASE WHEN {cs} >= 1500 THEN 'ULTIMATE' WHEN {cs} >= 1000 THEN 'EXCELLENT' WHEN {cs} >= 500 THEN 'GOOD' ELSE 'STANDARD' END AS tier FROM orders",
        "config_name": "SELECT o_orderkey, concat_ws('_', CASE WHEN o_orderkey % 700 >= 500 THEN 'HighBatch' WHEN o_orderkey % 700 <= 200 THEN 'LowBatch' ELSE 'MedBatch' END, CASE WHEN (o_orderkey % 8) / 100.0::DOUBLE >= 0.05 THEN 'HighCPU' WHEN (o_orderkey % 8) / 100.0::DOUBLE <= 0.02 THEN 'LowCPU' END, CASE WHEN o_orderkey % 2 = 0 THEN 'Compiled' END, CASE WHEN o_orderkey % 3 = 0 THEN 'FP16' END) AS name FROM orders",
        "bottleneck": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 3 > 0 THEN 'data_feeding' WHEN o_orderkey % 11 >= 8.0 THEN 'result_collection' ELSE '' END AS bottleneck FROM orders",
        "backoff_schedule": "SELECT * FROM (VALUES ('gpu_processing', 0, 0.5::DOUBLE), ('gpu_processing', 1, 1.0), ('memory_allocation', 0, 1.0), ('memory_allocation', 1, 2.0), ('memory_allocation', 2, 4.0), ('model_loading', 0, 2.0), ('model_loading', 1, 4.0), ('model_loading', 2, 8.0), ('timeout', 0, 5.0), ('timeout', 1, 10.0), ('timeout', 2, 20.0), ('critical_system', 0, 10.0)) v(error_type, attempt, delay)",
        "workload_split": """WITH x AS (SELECT o_orderkey, (o_orderkey % 2000 + 1) AS n, CASE WHEN (o_orderkey % 100) / 100.0::DOUBLE > 0.95 THEN least(0.03::DOUBLE * 1.5, 0.05) WHEN (o_orderkey % 100) / 100.0::DOUBLE < 0.8 THEN greatest(0.03::DOUBLE * 0.5, 0.01) ELSE 0.03::DOUBLE END AS r FROM orders),
y AS (SELECT *, greatest(1, floor(n * r)) AS cpu FROM x),
z AS (SELECT o_orderkey, n, CASE WHEN (n - cpu) / n < 0.95 THEN greatest(floor(n * 0.95::DOUBLE), n - greatest(10, floor(n * 0.05::DOUBLE))) WHEN (n - cpu) / n > 0.98 THEN n - greatest(1, floor(n * 0.02::DOUBLE)) ELSE n - cpu END::BIGINT AS gpu FROM y) SELECT o_orderkey, gpu, n - gpu AS cpu FROM z""",
        "recommendations": f"SELECT o_orderkey, coalesce(nullif(concat_ws('; ', CASE WHEN {cs} < 1500 THEN 'raise throughput' END, CASE WHEN o_orderkey % 101 < 90 THEN 'raise utilisation' END, CASE WHEN o_orderkey % 100 < 80 THEN 'raise efficiency' END), ''), 'targets achieved') AS advice FROM orders",
        "batch_totals": f"{RULES}, f AS (SELECT source_file, count(*) AS rows, count_if(parse_success) AS succeeded, sum(length(addr_text)) / 1000.0::DOUBLE AS seconds FROM p GROUP BY 1) SELECT count(*) AS files, sum(rows)::BIGINT AS rows, sum(succeeded)::BIGINT AS succeeded, round(avg(rows / seconds), 6) AS avg_rate FROM f",
        "rank_suites": f"WITH {RUNS}, b AS ({BENCH('true')}) SELECT configuration, row_number() OVER (ORDER BY max_throughput DESC, configuration)::INT AS place, round((SELECT max(max_throughput) FROM b) - max_throughput, 6) AS gap, (SELECT max(max_throughput) FROM b) - max_throughput > 500 AS notable FROM b",
        "recovery_rate": f"{RULES} SELECT count(*) AS errors, count_if(row_id % 2 = 0)::BIGINT AS recovered, round(count_if(row_id % 2 = 0) / greatest(count(*), 1) * 100, 6) AS recovery_pct FROM p WHERE NOT parse_success",
        "first_errors": f"{RULES} SELECT row_id, parse_error AS error FROM p WHERE NOT parse_success ORDER BY row_id LIMIT 5",
        "sheet_details": f"{RULES}, {SHEET} SELECT * EXCLUDE (error) FROM sh",
        "sheet_summary": f"{RULES}, {SHEET} SELECT count(*) AS rows, count_if(ok)::BIGINT AS parsed, round(avg(fields), 6) AS fields_per_row FROM sh",
        "sheet_quality": f"{RULES}, {SHEET} SELECT fields, count(*) AS rows FROM sh GROUP BY 1",
        "sheet_failed": f"{RULES}, {SHEET} SELECT row_id, address, error FROM sh WHERE NOT ok",
        "prompts": f"WITH {A} SELECT row_id, 'Split this Indian postal address into its parts. Answer with one JSON object with the keys {', '.join(COMPARED)}; use an empty string for a part that is missing.' || chr(10) || 'Address: ' || '{{\"address\":' || to_json(addr_text) || '}}' AS prompt FROM addresses",
        "report_json": f"{RULES} SELECT '{{\"total_rows\":' || count(*) || ',\"successful\":' || count_if(parse_success) || ',\"failed\":' || count_if(NOT parse_success) || '}}' AS report FROM p",
        "stream_rule_parse": f"{RULES} SELECT row_id, {ALL}, parse_success FROM p",
        "stream_throughput": "SELECT date_trunc('second', ts) AS at, count(*) AS n FROM events GROUP BY 1",
        "pins_by_size": f"{RULES}, {summary()} SELECT row_number() OVER (ORDER BY total_addresses DESC, pin_code) AS place, pin_code, total_addresses FROM u",
        "first_societies": f"{RULES} SELECT DISTINCT {strip('society_name')} AS society_name FROM p WHERE {strip('society_name')} <> '' ORDER BY 1 LIMIT 20",
        "hybrid_output": f"{RULES} SELECT addr_hash_key, addr_text, city_id, pincode, state_id, zone_id, address_id, assigned_pickup_dlvd_geo_points, assigned_pickup_dlvd_geo_points_count, {', '.join(f'{f} AS {x}' for f, x in SHORT.items())}, parse_success, coalesce(parse_error, '') AS parse_error, 'hybrid_gpu_cpu' AS processing_method, 1.5::DOUBLE AS processing_time FROM p",
        "comprehensive_full": f"{RULES} SELECT row_id, {', '.join(f'{f} AS parsed_{f}' for f in FIELDS)}, parse_success, coalesce(parse_error, '') AS parse_error, '2024-01-01T00:00:00' AS processing_timestamp, 2.5::DOUBLE AS processing_time_seconds, CASE WHEN row_number() OVER (ORDER BY row_id) <= 1000 THEN 'GPU' ELSE 'CPU' END AS processed_by_device, 'none' AS gpu_device_name, 400.0::DOUBLE AS throughput_rate, 10.0::DOUBLE AS gpu_utilization_percent, 50.0::DOUBLE AS processing_efficiency FROM p",
        "file_report": f"{RULES}, {FILES} SELECT * FROM fr",
        "batch_report": f"{RULES}, {FILES}, b AS (SELECT count(*) AS files, sum(rows)::BIGINT AS rows, sum(succeeded)::BIGINT AS succeeded, avg(CASE WHEN rate > 0 THEN rate END) AS m, max(rate) AS x, stddev_pop(CASE WHEN rate > 0 THEN rate END) AS sp FROM fr) SELECT files, rows, succeeded, round(m, 6) AS mean_rate, round(x, 6) AS peak_rate, round(sp / m, 6) AS variation, round(least(m / 1500 * 50, 50) + 30 + 14, 6) AS score, m >= 1500 AS rate_target_met, true AS utilisation_target_met, concat_ws('; ', CASE WHEN m < 1500 THEN 'raise throughput' END, 'raise efficiency', CASE WHEN sp / m > 0.3 THEN 'files differ much: like sizes, like batches' END) AS advice, files::INT AS details FROM b",
        "csv_ingest": f"WITH {A} SELECT row_id, addr_text, pincode, city_id, source_file AS file_name FROM addresses",
        "csv_line_breaks": f"""WITH {A} SELECT row_id, CASE row_id % 3 WHEN 0 THEN replace(addr_text, ', ', ',' || chr(10)) WHEN 1 THEN '"' || addr_text || '"' || chr(10) ELSE addr_text END AS addr_text, pincode, city_id FROM addresses""",
        "batch_journal": f"{CHECKED} SELECT CASE WHEN row_id % 2 = 0 THEN 'north' ELSE 'south' END AS region, a.source_file AS name, 'completed' AS status, count(*)::BIGINT AS rows, 1::BIGINT AS times FROM y JOIN addresses a USING (row_id) WHERE reject_reason IS NULL GROUP BY ALL",
        "file_digest": "SELECT length(t)::BIGINT AS size, sha256(t) AS sha256 FROM (SELECT string_agg(r_name || chr(10), '' ORDER BY r_regionkey) AS t FROM region)",
        "file_digests": "SELECT c_nationkey::INT AS c_nationkey, sum(length(c_name) + 1)::BIGINT AS size, sha256(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS sha256, true AS readable FROM customer GROUP BY 1",
        "discovered_files": "SELECT * FROM (VALUES ('flat', 0, 'p1.csv'), ('flat', 1, 'p10.csv'), ('deep', 0, 'p5.csv'), ('deep', 1, 'p1.csv'), ('deep', 2, 'p10.csv'), ('numbered', 0, 'p1.csv')) v(how, place, name)",
        "address_columns": "SELECT * FROM (VALUES ('customer', 'sample', 'c_name'), ('customer', 'compare', 'c_name'), ('customer', 'report', 'c_custkey'), ('documents', 'sample', 'text'), ('documents', 'compare', 'text'), ('documents', 'report', 'doc_id'), ('addresses', 'sample', 'addr_text'), ('addresses', 'compare', 'addr_hash_key'), ('addresses', 'report', 'addr_text')) v(\"table\", strategy, \"column\")",
        "state_round_trip": "SELECT r_regionkey, r_name FROM region",
        "skip_files": f"WITH {A} SELECT DISTINCT source_file AS path FROM addresses WHERE source_file NOT IN ('p1.csv', 'p4.csv')",
        "processed_parts": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN 'p' || o_orderkey % 50 END AS part FROM orders",
        "run_times": "SELECT user_id, strftime(min(ts), '%Y%m%d_%H%M%S') AS stamp, date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS seconds FROM events GROUP BY 1",
        "external_parser": f"""WITH {A}, v AS (SELECT row_id, {strip('addr_text')} AS t, list_transform(string_split({strip('addr_text')}, ','), lambda x: trim(x)) AS c FROM addresses WHERE row_id % 101 <> 0)
SELECT row_id, CASE WHEN len(c) > 1 THEN c[-2] ELSE '' END AS locality, CASE WHEN len(c) > 1 THEN c[-1] ELSE '' END AS city, CASE WHEN len(c) > 1 THEN 'India' ELSE '' END AS country, len(c) > 1 AS parse_success, CASE WHEN t = '' THEN '{rules.EMPTY_ERROR}' WHEN len(c) < 2 THEN 'parsing failed after 2 attempts: no parts' END AS parse_error FROM v""",
        "llm_json_long": f"WITH {A}, v AS (SELECT *, {strip('addr_text')} <> '' AND row_id % 5 <> 2 AS ok FROM addresses) SELECT row_id, ok AS parse_success, CASE WHEN ok THEN x_unit ELSE '' END AS unit_number, CASE WHEN ok AND {strip('x_society')} <> '' THEN x_society ELSE '' END AS society_name, CASE WHEN ok THEN x_city ELSE '' END AS city, CASE WHEN ok THEN CASE WHEN row_id % 2 = 0 THEN 'Bharat' ELSE 'India' END ELSE '' END AS country FROM v",
        "llm_token_cost": f"""WITH {A}, j AS (SELECT source_file, row_id, length('Split this Indian postal address into its parts. Answer with one JSON object with the keys {', '.join(COMPARED)}; use an empty string for a part that is missing.' || chr(10) || 'Address: ' || '{{"address":' || to_json(addr_text) || '}}') AS q, length('{{"UN":' || to_json(x_unit) || ',"SN":' || to_json(x_society) || ',"LOC":' || to_json(x_locality) || ',"CY":' || to_json(x_city) || ',"PIN":' || to_json(x_pin) || '}}') AS f FROM addresses),
t AS (SELECT source_file, ceil(q / 4) AS asked, ceil(CASE row_id % 5 WHEN 0 THEN f + 12 WHEN 1 THEN 14 WHEN 2 THEN 12 ELSE f END / 4) AS answered FROM j)
SELECT source_file, sum(asked + answered)::BIGINT AS tokens, round(sum(asked / 1000 * 0.01::DOUBLE + answered / 1000 * 0.03::DOUBLE), 6) AS cost, round(avg(asked / 1000 * 0.01::DOUBLE + answered / 1000 * 0.03::DOUBLE), 6) AS cost_per_address FROM t GROUP BY 1""",
        "entity_lookup": f"WITH {A} SELECT row_id, x_road AS street, x_state AS state, 9 AS labels FROM addresses",
        "fixed_splits": splits_sql(),
        "device_conflict": "SELECT o_orderkey, (o_orderkey % 2 = 0 AND o_orderkey % 4 >= 2) OR (o_orderkey % 3 = 0 AND o_orderkey % 5 >= 4) OR (o_orderkey % 4 > 0 AND o_orderkey % 5 > 2) AS conflict FROM orders",
        "hardware_estimate": f"""{MACHINE} SELECT o_orderkey, floor(500.0::DOUBLE * CASE WHEN gpus > 0 AND usable THEN CASE WHEN mb > 8000 THEN 4.0::DOUBLE WHEN mb > 4000 THEN 2.5 ELSE 1.5 END * CASE WHEN gpus > 1 THEN least(gpus * 0.7::DOUBLE, 2.0) ELSE 1.0 END ELSE 1.0 END * CASE WHEN cores >= 16 THEN 1.3::DOUBLE WHEN cores >= 8 THEN 1.1 ELSE 1.0 END * CASE WHEN memory >= 32 THEN 1.2::DOUBLE WHEN memory >= 16 THEN 1.1 ELSE 1.0 END + 1e-9)::BIGINT AS rate,
CASE WHEN gpus <= 0 THEN 400 WHEN each > 8000 THEN 600 WHEN each > 4000 THEN 400 ELSE 200 END AS batch_size, CASE WHEN gpus <= 0 THEN 10 WHEN each > 8000 THEN 15 WHEN each > 4000 THEN 10 ELSE 8 END AS queue_size, CASE WHEN cores >= 16 THEN 0.01::DOUBLE WHEN cores >= 8 THEN 0.02 ELSE 0.03 END AS cpu_ratio,
(CASE WHEN gpus > 0 THEN least(gpus * 2, 4) ELSE 2 END)::INT AS streams, (CASE WHEN cores < 4 THEN 1 ELSE greatest(2, cores // 4) END)::INT AS workers, memory < 8 AS memory_limited, gpus > 0 AND floor(each) < 4000 AS gpu_memory_limited, cores < 4 AS cpu_limited FROM m""",
        "hardware_tuning": f"""{MACHINE} SELECT o_orderkey, CASE WHEN mb / 600 >= 12 THEN 800 WHEN mb / 600 >= 8 THEN 600 ELSE 400 END AS batch_size, CASE WHEN mb / 600 >= 12 THEN 0.95::DOUBLE WHEN mb / 600 >= 8 THEN 0.9 ELSE 0.85 END AS memory_share, CASE WHEN mb / 600 >= 12 THEN 15 WHEN mb / 600 >= 8 THEN 12 ELSE 8 END AS queue_size, CASE WHEN mb / 600 >= 12 THEN 3 ELSE 2 END AS streams,
CASE WHEN cores >= 16 THEN 0.02::DOUBLE WHEN cores >= 8 THEN 0.03 ELSE 0.05 END AS cpu_ratio, CASE WHEN cores >= 16 THEN 4 WHEN cores >= 8 THEN 3 ELSE 2 END AS workers, CASE WHEN cores >= 16 THEN 75 WHEN cores >= 8 THEN 60 ELSE 50 END AS cpu_batch_size, CASE WHEN o_orderkey % 3000 >= 2500 THEN 5 WHEN o_orderkey % 3000 >= 2000 THEN 10 ELSE 15 END AS log_interval, CASE WHEN o_orderkey % 3000 >= 2500 THEN 0.95::DOUBLE WHEN o_orderkey % 3000 >= 2000 THEN 0.9 ELSE 0.85 END AS utilisation FROM m""",
        "progress_eta": "SELECT o_orderkey, round((o_orderkey % 1000) / 1000 * 100, 6) AS percent, round(CASE WHEN o_orderkey % 60 > 0 THEN (o_orderkey % 1000) / (o_orderkey % 60) ELSE 0.0::DOUBLE END, 6) AS rate, round(CASE WHEN o_orderkey % 60 > 0 AND o_orderkey % 1000 > 0 THEN (1000 - o_orderkey % 1000) / ((o_orderkey % 1000) / (o_orderkey % 60)) / 60 ELSE 0.0::DOUBLE END, 6) AS eta_minutes FROM orders",
        "time_estimate": "SELECT o_orderkey, floor(o_orderkey * 0.75::DOUBLE)::BIGINT AS rows, 10 + floor(o_orderkey * 0.75::DOUBLE) * 0.5::DOUBLE AS seconds, (10 + floor(o_orderkey * 0.75::DOUBLE) * 0.5::DOUBLE) * 1.5::DOUBLE AS safe_seconds FROM orders",
        "advice_run": f"""SELECT o_orderkey, concat_ws('; ', CASE WHEN o_orderkey % 101 < 50 THEN 'utilisation is very low: larger batches, or fewer rows for the CPU' WHEN o_orderkey % 101 < 70 THEN 'utilisation is low: a longer queue, or more streams' END, CASE WHEN {cs} < 1000 THEN 'rate is below half the target: compile the model, use half precision' WHEN {cs} < 1600 THEN 'rate is below the target: larger batches, or more memory for them' END,
CASE o_orderkey % 3 WHEN 0 THEN 'feeding is slow: more feeders, or cheaper preparation of batches' WHEN 1 THEN 'collecting is slow: more collectors, or cheaper output' END, CASE WHEN o_orderkey % 100 > 95 THEN 'memory is nearly full: smaller batches' WHEN o_orderkey % 100 < 70 THEN 'memory is free: larger batches' END, CASE WHEN o_orderkey % 97 > 80 THEN 'temperature is high: check the cooling' END) AS advice FROM orders""",
        "advice_benchmarks": f"""WITH {RUNS}, b AS ({BENCH('true')}), t AS (SELECT max(avg_throughput) AS rate, max(avg_utilisation) AS use FROM b) SELECT unnest(list_filter([CASE WHEN rate < 1000 THEN 'rate is low: accelerate, enlarge batches or compile the model' WHEN rate < 1500 THEN 'rate is moderate: tune batch sizes and the queue' END, CASE WHEN use < 70 THEN 'utilisation is low: enlarge batches or feed faster' WHEN use > 95 THEN 'utilisation is very high: watch heat and memory' END], lambda x: x IS NOT NULL)) AS advice FROM t
UNION ALL SELECT 'low success rate: ' || configuration FROM b WHERE success_rate < 90""",
        "advice_suite": f"WITH {RUNS}, b AS ({BENCH('true')}), t AS (SELECT arg_max(avg_utilisation, avg_throughput) AS use, max(avg_throughput) AS rate, min(avg_throughput) AS worst, count(*) AS n FROM b) SELECT concat_ws('; ', CASE WHEN rate < 1000 THEN 'best rate is below half the target: better hardware, or acceleration' WHEN rate < 1600 THEN 'best rate is below the target: larger batches, or a compiled model' END, CASE WHEN use < 70 THEN 'utilisation is low: enlarge batches or feed faster' WHEN use > 95 THEN 'utilisation is very high: watch heat and memory' END, 'little memory: smaller batches', CASE WHEN n > 1 AND rate > worst * 1.5 THEN 'configurations differ much: keep to the best' END) AS advice FROM t",
        "advice_batch": f"SELECT o_orderkey, coalesce(nullif(concat_ws('; ', CASE WHEN {cs} < 1500 THEN 'raise throughput' END, CASE WHEN o_orderkey % 101 < 90 THEN 'raise utilisation' END, CASE WHEN o_orderkey % 100 < 80 THEN 'raise efficiency' END, CASE WHEN (o_orderkey % 10) / 20.0::DOUBLE > 0.3 THEN 'files differ much: like sizes, like batches' END), ''), 'targets achieved') AS advice FROM orders",
        "error_counts": f"{RULES} SELECT parse_error AS error_type, count(*) AS errors FROM p WHERE parse_error IS NOT NULL GROUP BY 1",
    }
