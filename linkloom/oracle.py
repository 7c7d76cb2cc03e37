"""The queries' results in DuckDB's SQL, over the same relations."""

from __future__ import annotations

from linkloom import constants as C
from linkloom.proxies import EXCLUDED, POPULATIONS, with_relations


def q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def clean(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(replace(lower(coalesce({x}, '')), '&', ' and '), '[^\pL\pN_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def core(x: str) -> str:
    """Of a cleaned string."""
    return f"array_to_string(list_filter({words(x)}, lambda t: NOT list_contains([{', '.join(map(q, C.NOISE))}], t)), ' ')"


def _map(values: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in values.items()) + "}"


def address(x: str) -> str:
    s = rf"regexp_replace({clean(x)}, '\bp\s*o\s*box\b', 'po box', 'g')"
    return f"array_to_string(list_transform({words(s)}, lambda t: coalesce({_map(C.ADDRESS_WORDS)}[t], t)), ' ')"


def state(x: str) -> str:
    s = clean(x)
    return f"CASE WHEN length({s}) = 2 THEN upper({s}) ELSE coalesce({_map(C.STATES)}[{s}], substr(upper({s}), 1, 2)) END"


def zip5(x: str) -> str:
    d = f"regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g')"
    return f"CASE WHEN {d} = '' THEN '' WHEN length({d}) < 5 THEN lpad({d}, 5, '0') ELSE substr({d}, 1, 5) END"


def lcs(a: str, b: str) -> str:
    chars = f"list_transform(list_filter(string_split({a}, ''), lambda c: c <> ''), lambda c: [unicode(c)])"
    cells = f"list_transform(range(1, length({b}) + 1), lambda j: [j, unicode({b}[j])])"
    step = "list_append(n, CASE WHEN x[1] = y[2] THEN r[y[1]] + 1 ELSE greatest(r[y[1] + 1], list_last(n)) END)"
    fold = f"list_reduce({chars}, lambda r, x: list_reduce({cells}, lambda n, y: {step}, [0::BIGINT]), list_transform(range(0, length({b}) + 1), lambda j: 0::BIGINT))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE list_last({fold}) END"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * ({lcs(a, b)}) / (length({a}) + length({b})) END"


def round1(x: str) -> str:
    return f"round_even(({x}) * 10, 0) / 10"


def universe(flag: str) -> str:
    return f"""FROM entity e JOIN info i ON i.info_id = e.entity_id LEFT JOIN address a ON a.info_id = i.info_id AND a.is_default = 1
 LEFT JOIN state s ON s.state_id = a.state_id {{links}}
 WHERE e.archived = 0 AND i.archived = 0 AND e.{flag} = 1 AND coalesce(trim(e.description), '') NOT IN ({', '.join(map(q, EXCLUDED))})"""


COLUMNS = "e.entity_id, e.entity_name, i.info_name, a.address1, a.address2, a.address3, a.city, a.zip, s.state_name"


def with_id(flag: str) -> str:
    return f"""SELECT {COLUMNS}, e.source_id AS entity_ref_id, l.source_id AS link_ref_id
 {universe(flag).replace('{links}', 'LEFT JOIN link l ON l.entity_id = e.entity_id')}
 AND ((e.source_name_id = 1 AND coalesce(e.source_id, 0) <> 0) OR (l.source_name_id = 1 AND coalesce(l.source_id, 0) <> 0))"""


OTHER = """SELECT entity_id, string_agg(source_name, ', ' ORDER BY source_name) AS other_sources FROM
 (SELECT DISTINCT l.entity_id, n.source_name FROM link l JOIN source_name n ON n.source_name_id = l.source_name_id WHERE coalesce(l.source_id, 0) <> 0) GROUP BY entity_id"""


def without_id(flag: str) -> str:
    return f"""SELECT {COLUMNS}, CAST(NULL AS INT) AS entity_ref_id, CAST(NULL AS INT) AS link_ref_id, o.other_sources
 {universe(flag).replace('{links}', f'LEFT JOIN ({OTHER}) o ON o.entity_id = e.entity_id')}
 AND NOT (coalesce(e.source_name_id, 0) = 1 AND coalesce(e.source_id, 0) <> 0)
 AND NOT EXISTS (SELECT 1 FROM link k WHERE k.entity_id = e.entity_id AND coalesce(k.source_name_id, 0) = 1 AND coalesce(k.source_id, 0) <> 0)"""


def canonical(build) -> str:
    part = lambda i, label, flag: f"SELECT {i} AS ord, entity_id, '{label}' AS population, entity_name AS name1, info_name AS name2, address1 AS addr1, address2 AS addr2, address3 AS addr3, city, state_name AS state, zip, entity_ref_id, link_ref_id FROM ({build(flag)})"
    return f"""SELECT * FROM ({' UNION ALL '.join(part(i, label, flag) for i, (label, flag) in enumerate(POPULATIONS))})
 QUALIFY row_number() OVER (PARTITION BY entity_id, population, name1, name2, addr1, addr2, addr3
 ORDER BY ord, entity_ref_id NULLS LAST, link_ref_id NULLS LAST, city NULLS LAST, state NULLS LAST, zip NULLS LAST) = 1"""


ROWS = canonical(with_id)
ORDER = "ORDER BY " + ", ".join(["ord", *(f"{c} NULLS LAST" for c in ("entity_ref_id", "link_ref_id", "city", "state", "zip", "name1", "name2", "addr1", "addr2", "addr3"))])


def pooled(rows: str) -> str:
    """Lists by column, then row; distinct by first place."""
    def listed(cols: list[str], blank: bool = False) -> str:
        every = "list_concat(" + ", ".join(f"list({c} {ORDER})" for c in cols) + ")" if len(cols) > 1 else f"list({cols[0]} {ORDER})"
        kept = f"list_filter({every}, lambda x: x IS NOT NULL{'' if blank else ' AND trim(x) <> ' + q('')})"
        return f"list_reduce(list_transform({kept}, lambda x: [x]), lambda acc, x: CASE WHEN list_contains(acc, x[1]) THEN acc ELSE list_concat(acc, x) END, []::VARCHAR[])"

    lists = {"names": listed(["name1", "name2"]), "addrs": listed(["addr1", "addr2", "addr3"]), "cities": listed(["city"]), "states": listed(["state"]), "zips": listed(["zip"], True)}
    first = lambda c: f"CAST((list({c} {ORDER}) FILTER (WHERE {c} IS NOT NULL))[1] AS BIGINT) AS {c}"
    return f"""SELECT entity_id, string_agg(DISTINCT population, '|' ORDER BY population) AS populations, count(DISTINCT population)::INT AS n_populations,
 {', '.join(f'{e} AS {k}' for k, e in lists.items())}, {first('entity_ref_id')}, {first('link_ref_id')} FROM ({rows}) GROUP BY entity_id"""


def resolved(pool: str) -> str:
    return f"""SELECT *, coalesce(entity_ref_id, link_ref_id) AS ref_id, CASE WHEN entity_ref_id IS NOT NULL THEN 'entity_ref_id' WHEN link_ref_id IS NOT NULL THEN 'link_ref_id' ELSE 'None' END AS ref_id_source,
 coalesce(entity_ref_id <> link_ref_id, false) AS ref_id_conflict FROM ({pool})"""


POOL = pooled(ROWS)
RESOLVED = resolved(POOL)

SPLIT = f"""SELECT ref_id, entity_type, name, addr1, addr2, city, state, zip, list_transform(regexp_extract_all(coalesce(name, ''), {q(C.ALIAS)}, 1), lambda x: trim(x)) AS named,
 regexp_replace(regexp_replace(coalesce(name, ''), {q(C.ALIAS)}, ' ', 'g'), {q(C.STATUS)}, ' ', 'g') AS rest FROM"""


def identities(source: str) -> str:
    return f"""SELECT ref_id, entity_type, name, addr1, addr2, city, state, zip, trim(regexp_replace(regexp_replace(rest, '\\([^)]*\\)', ' ', 'g'), '\\s+', ' ', 'g')) AS primary_name,
 list_filter(list_transform(list_concat(named, list_filter(list_transform(regexp_extract_all(rest, '\\(([^)]*)\\)', 1), lambda x: trim(x)), lambda x: length(x) > 3)), lambda x: trim(regexp_replace(x, {q(C.STATUS)}, ' ', 'g'))), lambda x: x <> '') AS aliases
 FROM ({SPLIT} ({source}))"""


_PLACED = "struct_pack(a := coalesce(name, ''), b := coalesce(addr1, ''), c := coalesce(addr2, ''), d := coalesce(city, ''), e := coalesce(state, ''), f := coalesce(zip, ''))"
LONELY = f"""SELECT ref_id, 'PracticeLocation' AS entity_type, {', '.join(f'arg_min({c}, {_PLACED}) FILTER (WHERE {c} IS NOT NULL) AS {c}' for c in ('name', 'addr1', 'addr2', 'city', 'state', 'zip'))}
 FROM location WHERE ref_id NOT IN (SELECT ref_id FROM identity) GROUP BY ref_id"""
KNOWN = identities(f"SELECT ref_id, 'Hospital' AS entity_type, name, addr1, addr2, city, state, zip FROM identity UNION ALL {LONELY}")

_AT = "struct_pack(k := {k}, a := coalesce(name, ''), b := coalesce(addr1, ''), c := coalesce(addr2, ''), d := coalesce(city, ''), e := coalesce(state, ''), f := coalesce(zip, ''))"
#: The distinct lines of each record's locations, and the first place of each.
LOCATION_LINES = f"""SELECT ref_id, t, min(o) AS o FROM (SELECT ref_id, addr1 AS t, {_AT.replace('{k}', '1')} AS o FROM location UNION ALL SELECT ref_id, addr2, {_AT.replace('{k}', '2')} FROM location) WHERE trim(t) <> '' GROUP BY ref_id, t"""

LABEL = f"len(list_filter({words('core')}, lambda t: NOT list_contains({words(clean('city'))}, t) AND NOT list_contains([{', '.join(map(q, C.COMPASS))}], t))) = 0"
NAMED = f"""SELECT ref_id, name, city, core, coalesce(parents, 0) AS parents, (core <> '' AND coalesce(parents, 0) < {C.SHARED_NAME_PARENTS} AND NOT ({LABEL})) AS usable
 FROM (SELECT *, {core(clean('name'))} AS core FROM location WHERE name IS NOT NULL) LEFT JOIN
 (SELECT core AS k, count(DISTINCT ref_id) AS parents FROM (SELECT ref_id, {core(clean('name'))} AS core FROM location WHERE name IS NOT NULL) WHERE core <> '' GROUP BY core) ON k = core"""

SPACE = f"""SELECT ref_id, 'Name' AS kind, {clean('primary_name')} AS "full" FROM ({KNOWN})
 UNION ALL SELECT ref_id, 'Alias', {clean('aliases[1]')} FROM ({KNOWN}) WHERE len(aliases) > 0
 UNION ALL SELECT ref_id, 'Location', min("full") FROM (SELECT ref_id, {clean('name')} AS "full", core FROM ({NAMED}) WHERE usable AND ref_id IN (SELECT ref_id FROM ({KNOWN}))) GROUP BY ref_id, core"""

GRADED = """SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 13 <> 0 THEN l_quantity * 2 END AS name, CASE WHEN l_partkey % 7 <> 0 THEN l_discount * 1000 END AS address,
 CASE WHEN l_partkey % 5 <> 0 THEN l_quantity + 50 END AS city, CASE WHEN l_partkey % 3 <> 0 THEN CASE WHEN l_suppkey % 2 = 0 THEN 100.0::DOUBLE ELSE 0 END END AS state,
 CASE WHEN l_partkey % 4 <> 0 THEN CASE WHEN l_suppkey % 3 = 0 THEN 100.0::DOUBLE ELSE 0 END END AS zip, l_tax * 100 AS margin,
 CASE l_returnflag WHEN 'R' THEN 'Name' WHEN 'A' THEN 'Alias' ELSE 'Location' END AS via, l_linenumber % 3 AS words FROM lineitem"""

VERDICT = f"""SELECT l_orderkey, l_linenumber, CASE WHEN name IS NULL THEN 'Unscored' WHEN name >= 92 OR (name >= 75 AND coalesce(address, 0) >= 60) THEN {q(C.VERDICTS[1])} WHEN name >= 75 THEN {q(C.VERDICTS[2])}
 WHEN coalesce(address, 0) >= 85 AND name >= 45 THEN {q(C.VERDICTS[3])} WHEN name >= 45 OR coalesce(address, 0) >= 50 THEN {q(C.VERDICTS[4])} ELSE {q(C.VERDICTS[5])} END AS verdict FROM ({GRADED})"""

_PLACE = "(coalesce(address, 0) >= 60 OR coalesce(zip, 0) = 100 OR (coalesce(city, 0) >= 90 AND coalesce(state, 0) = 100))"
TIER = f"""SELECT l_orderkey, l_linenumber, CASE WHEN coalesce(name, 0) < 75 THEN {q(C.TIERS[4])} WHEN margin < 3 THEN {q(C.TIERS[2])}
 WHEN name >= 92 AND (coalesce(address, 0) >= 85 OR (via IN ('Name', 'Alias') AND words >= 2 AND {_PLACE})) THEN {q(C.TIERS[0])}
 WHEN name >= 92 OR (name >= 82 AND {_PLACE}) THEN {q(C.TIERS[1])} ELSE {q(C.TIERS[3])} END AS tier FROM ({GRADED})"""


def distribution(sql: str, by: str) -> str:
    return f"SELECT {by}, n, round_even(n / greatest(sum(n) OVER (), 1) * 10000, 0) / 10000 AS share FROM (SELECT {by}, count(*) AS n FROM ({sql}) GROUP BY {by})"


def _weighted(parts: dict[str, str], weights: dict[str, float]) -> str:
    total = " + ".join(f"coalesce({p} * {weights[k]}::DOUBLE, 0)" for k, p in parts.items())
    weight = " + ".join(f"CASE WHEN {p} IS NULL THEN 0.0::DOUBLE ELSE {weights[k]}::DOUBLE END" for k, p in parts.items())
    return f"CASE WHEN ({weight}) > 0 THEN ({total}) / ({weight}) END"


_SORTED = lambda x: f"array_to_string(list_sort({words(x)}), ' ')"
PAIRS = "SELECT n.p_name AS a, m.p_name || ' inc' AS b FROM (SELECT DISTINCT p_name FROM part) n, (SELECT DISTINCT p_name FROM part) m"
_SETS = f"""SELECT a, b, xs, ys, common, array_to_string(common, ' ') AS s, array_to_string(list_sort(list_filter(xs, lambda t: NOT list_contains(ys, t))), ' ') AS dx, array_to_string(list_sort(list_filter(ys, lambda t: NOT list_contains(xs, t))), ' ') AS dy FROM
 (SELECT a, b, xs, ys, list_sort(list_filter(xs, lambda t: list_contains(ys, t))) AS common FROM (SELECT a, b, list_distinct({words('a')}) AS xs, list_distinct({words('b')}) AS ys FROM ({PAIRS})))"""
_LEAD = "(length(s) + CASE WHEN s = '' THEN 0 ELSE 1 END)"
_SET = f"""CASE WHEN len(xs) = 0 OR len(ys) = 0 THEN 0.0::DOUBLE WHEN len(common) > 0 AND (len(common) = len(xs) OR len(common) = len(ys)) THEN 100.0::DOUBLE ELSE greatest(
 100.0::DOUBLE * (1 - (length(dx) + length(dy) - 2 * ({lcs('dx', 'dy')}))::DOUBLE / (2 * {_LEAD} + length(dx) + length(dy))),
 CASE WHEN s = '' THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * (1 - (1 + length(dx))::DOUBLE / (length(s) + {_LEAD} + length(dx))) END,
 CASE WHEN s = '' THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * (1 - (1 + length(dy))::DOUBLE / (length(s) + {_LEAD} + length(dy))) END) END"""
_SORT_ROWS = f"SELECT a, b, {_SORTED('a')} AS sa, {_SORTED('b')} AS sb FROM ({PAIRS})"

ORACLE: dict[str, str] = {
    "eval_population": with_id("is_client"),
    "gap_population": without_id("is_client"),
    "population_partition_counts": f"SELECT 'linked' AS part, count(DISTINCT entity_id) AS n FROM ({with_id('is_client')}) UNION ALL SELECT 'unlinked', count(DISTINCT entity_id) FROM ({without_id('is_client')})",
    "other_sources_listagg": OTHER,
    "canonical_union_dedup": f"SELECT * EXCLUDE (ord) FROM ({ROWS})",
    "pool_entities": f"SELECT entity_id, populations, n_populations, {', '.join(f'array_to_string({c}, {q(chr(32) + chr(124) + chr(32))}) AS {c}' for c in ('names', 'addrs', 'cities', 'states', 'zips'))}, entity_ref_id, link_ref_id FROM ({POOL})",
    "resolve_id_conflict": f"SELECT entity_id, ref_id, ref_id_source, ref_id_conflict FROM ({RESOLVED})",
    "normalised_arrays": f"""SELECT entity_id, array_to_string(list_filter(list_transform(cities, lambda x: {clean('x')}), lambda x: x <> ''), '|') AS cities_n,
 array_to_string(list_sort(list_distinct(list_filter(list_transform(states, lambda x: {state('x')}), lambda x: x <> ''))), '|') AS states_n,
 array_to_string(list_sort(list_distinct(list_filter(list_transform(zips, lambda x: {zip5('x')}), lambda x: x <> ''))), '|') AS zips_n FROM ({POOL})""",
    "clean_text": f"SELECT entity_id, {clean('entity_name')} AS cleaned FROM entity",
    "name_core": f"SELECT entity_id, {core(clean('entity_name'))} AS core FROM entity",
    "norm_addr": f"SELECT info_id, {address('address1')} AS line FROM address",
    "street_number_body": rf"""SELECT info_id, CASE WHEN regexp_extract(n, '^(\d+[a-z]?)\b', 1) <> '' THEN regexp_extract(n, '^(\d+[a-z]?)\b', 1) WHEN regexp_extract(n, '\b(?:po )?box (\w+)', 1) <> '' THEN 'box' || regexp_extract(n, '\b(?:po )?box (\w+)', 1) ELSE '' END AS number,
 trim(regexp_replace(n, '^\d+[a-z]?\s*', '')) AS body FROM (SELECT info_id, {address('address1')} AS n FROM address)""",
    "norm_state": f"SELECT state_id, {state('state_name')} AS code FROM state",
    "norm_zip5": f"SELECT info_id, {zip5('zip')} AS zip5 FROM address",
    "split_name": f"""SELECT ref_id, primary_name AS "primary", array_to_string(aliases, ' | ') AS aliases, array_to_string(regexp_extract_all(coalesce(name, ''), {q(C.STATUS)}, 0), ' ') AS note
 FROM ({identities("SELECT ref_id, 'Hospital' AS entity_type, name, addr1, addr2, city, state, zip FROM identity")})""",
    "indel_ratio": f"SELECT a, b, {round1(ratio('a', 'b'))} AS score FROM ({PAIRS})",
    "token_sort_ratio": f"SELECT a, b, {round1(ratio('sa', 'sb'))} AS score FROM ({_SORT_ROWS})",
    "token_set_ratio": f"SELECT a, b, {round1(_SET)} AS score FROM ({_SETS})",
    "pair_score": f"""SELECT a, b, {round1(f'{C.TOKEN_SET}::DOUBLE * t + {C.TOKEN_SORT}::DOUBLE * o')} AS score FROM (SELECT a, b, {_SET} AS t FROM ({_SETS})) JOIN (SELECT a, b, {ratio('sa', 'sb')} AS o FROM ({_SORT_ROWS})) USING (a, b)""",
    "weighted_score": f"SELECT l_orderkey, l_linenumber, {round1(_weighted({'number': 'name', 'body': 'address', 'city': 'city', 'state': 'state', 'zip': 'zip'}, C.ADDRESS_WEIGHTS))} AS score FROM ({GRADED})",
    "verdict": VERDICT,
    "tier": TIER,
    "location_identity": LONELY,
    "location_index": f"""SELECT ref_id, loc_n, coalesce(array_to_string(loc_names[:{C.LOCATION_CAP}], '|'), '') AS loc_names, coalesce(array_to_string(loc_addrs[:{C.LOCATION_CAP}], '|'), '') AS loc_addrs, loc_cities, loc_states, loc_zips FROM (SELECT ref_id, count(*) AS loc_n,
 coalesce(string_agg(DISTINCT nullif({clean('city')}, ''), '|' ORDER BY nullif({clean('city')}, '')), '') AS loc_cities, coalesce(string_agg(DISTINCT nullif({state('state')}, ''), '|' ORDER BY nullif({state('state')}, '')), '') AS loc_states,
 coalesce(string_agg(DISTINCT nullif({zip5('zip')}, ''), '|' ORDER BY nullif({zip5('zip')}, '')), '') AS loc_zips FROM location GROUP BY ref_id)
 LEFT JOIN (SELECT ref_id, list(DISTINCT name ORDER BY name) AS loc_names FROM location WHERE trim(name) <> '' GROUP BY ref_id) USING (ref_id)
 LEFT JOIN (SELECT ref_id, list(t ORDER BY o, t) AS loc_addrs FROM ({LOCATION_LINES}) GROUP BY ref_id) USING (ref_id)""",
    "location_name_filter": NAMED,
    "candidate_states": f"""SELECT DISTINCT ref_id, state FROM (SELECT ref_id, {state('state')} AS state FROM ({KNOWN}) UNION ALL SELECT ref_id, {state('state')} FROM location WHERE ref_id IN (SELECT ref_id FROM ({KNOWN}))) WHERE state <> ''""",
    "search_space": f"""SELECT ref_id, kind, "full", {core('"full"')} AS core FROM ({SPACE})""",
    "identity_counts": """SELECT entity_type, count(*) AS rows, count(*) - count(id) AS without_id, count(id) - count(DISTINCT id) AS repeated FROM (SELECT 'Hospital' AS entity_type, ref_id AS id FROM identity
 UNION ALL SELECT 'Repeated', ref_id FROM identity UNION ALL SELECT 'Repeated', CASE WHEN ref_id % 3 <> 0 THEN ref_id END FROM identity) GROUP BY entity_type""",
    "location_counts": "SELECT count(*) AS rows, count(*) - count(ref_id) AS without_id, count(DISTINCT ref_id) AS ids FROM location",
    "pool_sizes": f"""SELECT state, count(*) AS n FROM (SELECT ref_id FROM ({SPACE})) JOIN (SELECT DISTINCT ref_id, state FROM (SELECT ref_id, {state('state')} AS state FROM ({KNOWN}) UNION ALL SELECT ref_id, {state('state')} FROM location WHERE ref_id IN (SELECT ref_id FROM ({KNOWN}))) WHERE state <> '') USING (ref_id) GROUP BY state""",
    "margin_rivals": f"""SELECT entity_id, ref_id, match_score, name_score, rank, candidates_considered, same_name_rivals, match_margin FROM (SELECT *, coalesce({round1('match_score - following')}, 100.0::DOUBLE) AS match_margin,
 count(*) FILTER (WHERE name_score >= best - 2) OVER (PARTITION BY entity_id) - 1 AS same_name_rivals FROM (SELECT *, row_number() OVER w AS rank, lead(match_score) OVER w AS following, count(*) OVER (PARTITION BY entity_id) AS candidates_considered, first_value(name_score) OVER w AS best
 FROM (SELECT l_orderkey AS entity_id, l_linenumber::BIGINT AS ref_id, max(city) AS match_score, max(coalesce(name, 0.0::DOUBLE)) AS name_score FROM ({GRADED}) GROUP BY ALL) WINDOW w AS (PARTITION BY entity_id ORDER BY match_score DESC NULLS LAST, ref_id)))""",
    "verdict_distribution": distribution(VERDICT, "verdict"),
    "tier_distribution": distribution(TIER, "tier"),
    "by_population": f"""SELECT population, n, conflicts, round_even(conflicts / greatest(n, 1) * 10000, 0) / 10000 AS share FROM (SELECT population, count(*) AS n, count(*) FILTER (WHERE ref_id_conflict) AS conflicts
 FROM (SELECT unnest(string_split(populations, '|')) AS population, ref_id_conflict FROM ({RESOLVED})) GROUP BY population)""",
    "funnel": f"""SELECT step, n FROM (SELECT count(*) AS supplied, count(ref_id) AS populated, count(*) FILTER (WHERE ref_id IS NULL) AS blank, count(*) FILTER (WHERE wide) AS implausible, count(*) FILTER (WHERE found) AS resolves,
 count(*) FILTER (WHERE ref_id IS NOT NULL AND NOT found) AS not_in_directory FROM (SELECT r.entity_id, r.ref_id, r.ref_id IS NOT NULL AND r.ref_id IN (SELECT ref_id FROM ({KNOWN})) AS found, w.wide FROM ({RESOLVED}) r JOIN
 (SELECT entity_id, bool_or(coalesce(greatest(length(entity_ref_id::VARCHAR), length(link_ref_id::VARCHAR)) > (SELECT max(length(ref_id::VARCHAR)) FROM ({KNOWN})), false)) AS wide FROM ({ROWS}) GROUP BY entity_id) w USING (entity_id))) UNPIVOT (n FOR step IN (supplied, populated, blank, implausible, resolves, not_in_directory))""",
    "duplicate_ids": f"SELECT entity_id, ref_id, holders FROM (SELECT entity_id, ref_id, count(*) OVER (PARTITION BY ref_id) AS holders FROM ({RESOLVED}) WHERE ref_id IS NOT NULL) WHERE holders > 1",
    "id_conflicts": f"SELECT entity_id, entity_ref_id, link_ref_id FROM ({RESOLVED}) WHERE ref_id_conflict",
    "unverifiable": f"SELECT entity_id, ref_id FROM ({RESOLVED}) WHERE ref_id IS NULL OR ref_id NOT IN (SELECT ref_id FROM ({KNOWN}))",
    "unreferenced_reference": f"SELECT ref_id, entity_type, name FROM ({KNOWN}) WHERE ref_id NOT IN (SELECT ref_id FROM ({RESOLVED}) WHERE ref_id IS NOT NULL)",
}


def every() -> dict[str, str]:
    """All of the audit's oracles, over the relations."""
    from linkloom import oracle_scores

    return {k: with_relations(v) for k, v in {**ORACLE, **oracle_scores.ORACLE}.items()}
