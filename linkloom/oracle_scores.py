"""The fuzzy half of the oracle in DuckDB's SQL: search, exact scores, verdicts, proposals and the reports on them.

Each distinct pair of strings is scored once.  A longest common subsequence takes a bit for each character of one string in a
128-bit number, as long as strings are shorter than that.
"""

from __future__ import annotations

from linkloom import constants as C
from linkloom import oracle as O


def texts(names: str) -> str:
    """A list's items that aren't null."""
    return f"list_filter({names}, lambda x: x IS NOT NULL)"


def _mask(a: str) -> str:
    """For each character of a string, the bits of its places."""
    return f"map_from_entries(list_transform(list_distinct(string_split({a}, '')), lambda c: struct_pack(k := c, v := list_sum(list_transform(range(1, length({a}) + 1), lambda i: CASE WHEN {a}[i] = c THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END)))))"


def _lcs(a: str, mask: str, b: str) -> str:
    full = f"((1::HUGEINT << length({a})) - 1)"
    return f"""CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE length({a}) - bit_count(list_reduce(list_transform(string_split({b}, ''), lambda c: coalesce({mask}[c], 0::HUGEINT)),
 lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full}, {full})) END"""


def _ratio(a: str, b: str, common: str) -> str:
    return f"CASE WHEN {a} = {b} THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {common} / (length({a}) + length({b})) END"


def ratios(name: str, pairs: str) -> str:
    """CTEs that end in name(x, y, score): the ratio of each pair that the query pairs(x, y) gives."""
    return f"""{name}_p AS MATERIALIZED (SELECT DISTINCT x, y FROM ({pairs})), {name}_m AS MATERIALIZED (SELECT x, {_mask('x')} AS mask FROM (SELECT DISTINCT x FROM {name}_p)),
 {name} AS MATERIALIZED (SELECT x, y, {_ratio('x', 'y', 'common')} AS score FROM (SELECT x, y, {_lcs('x', 'mask', 'y')} AS common FROM {name}_p JOIN {name}_m USING (x)))"""


def pair_scores(name: str, pairs: str) -> str:
    """CTEs that end in name(x, y, score): the blend of words in common and words in order."""
    w = f"{name}_w"
    lead = "(length(s) + CASE WHEN s = '' THEN 0 ELSE 1 END)"
    return f"""{name}_p AS MATERIALIZED (SELECT DISTINCT x, y FROM ({pairs})),
 {w} AS MATERIALIZED (SELECT t, ts, so, {_mask('so')} AS mask FROM (SELECT t, list_distinct(ws) AS ts, array_to_string(list_sort(ws), ' ') AS so FROM (SELECT t, {O.words('t')} AS ws FROM (SELECT x AS t FROM {name}_p UNION SELECT y FROM {name}_p)))),
 {name}_s AS MATERIALIZED (SELECT x, y, a.ts AS xs, b.ts AS ys, a.so AS xo, b.so AS yo, a.mask, list_sort(list_filter(a.ts, lambda t: list_contains(b.ts, t))) AS common FROM {name}_p JOIN {w} a ON a.t = x JOIN {w} b ON b.t = y),
 {name}_d AS MATERIALIZED (SELECT *, array_to_string(common, ' ') AS s, array_to_string(list_sort(list_filter(xs, lambda t: NOT list_contains(common, t))), ' ') AS dx, array_to_string(list_sort(list_filter(ys, lambda t: NOT list_contains(common, t))), ' ') AS dy FROM {name}_s),
 {name}_e AS MATERIALIZED (SELECT dx, dy, {_lcs('dx', 'mask', 'dy')} AS n FROM (SELECT dx, dy, {_mask('dx')} AS mask FROM (SELECT DISTINCT dx, dy FROM {name}_d))),
 {name} AS MATERIALIZED (SELECT x, y, {C.TOKEN_SET}::DOUBLE * CASE WHEN len(xs) = 0 OR len(ys) = 0 THEN 0.0::DOUBLE WHEN len(common) > 0 AND (len(common) = len(xs) OR len(common) = len(ys)) THEN 100.0::DOUBLE ELSE greatest(
 100.0::DOUBLE * (1 - (length(dx) + length(dy) - 2 * n)::DOUBLE / ({lead} + length(dx) + {lead} + length(dy))),
 CASE WHEN s = '' THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * (1 - (1 + length(dx))::DOUBLE / (length(s) + {lead} + length(dx))) END,
 CASE WHEN s = '' THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * (1 - (1 + length(dy))::DOUBLE / (length(s) + {lead} + length(dy))) END) END
 + {C.TOKEN_SORT}::DOUBLE * {_ratio('xo', 'yo', '(' + _lcs('xo', 'mask', 'yo') + ')')} AS score FROM {name}_d JOIN {name}_e USING (dx, dy))"""


def _normal(pool: str) -> str:
    kept = lambda c, f: f"list_filter(list_transform({c}, lambda x: {f('x')}), lambda x: x <> '')"
    return f"""SELECT *, {kept('cities', O.clean)} AS cities_n, list_sort(list_distinct({kept('states', O.state)})) AS states_n, list_sort(list_distinct({kept('zips', O.zip5)})) AS zips_n FROM ({pool})"""


def _numbered(source: str, key: str, lists: list[tuple[str, int, str]]) -> str:
    """(key, rank of the list, place, text) of lists' items."""
    return " UNION ALL ".join(f"SELECT {key}, {rank} AS r, unnest(range(1, len({x}) + 1)) AS i, unnest({x}) AS t, '{via}' AS via FROM ({source})" for x, rank, via in lists)


USABLE = f"list_filter(names, lambda x: length(replace({O.clean('x')}, ' ', '')) >= {C.LEAST_NAME_CHARS})"

#: The directory, its locations in order, and both populations' entities.
BASE = f""", known AS MATERIALIZED ({O.KNOWN}),
 entities AS MATERIALIZED ({_normal(O.RESOLVED)}),
 unlinked AS MATERIALIZED (SELECT * REPLACE ({USABLE} AS names), names AS every_name FROM ({_normal(O.resolved(O.pooled(O.canonical(O.without_id))))})),
 named AS MATERIALIZED ({O.NAMED}),
 place_names AS MATERIALIZED (SELECT ref_id, name AS t, row_number() OVER (PARTITION BY ref_id ORDER BY name) AS i FROM (SELECT DISTINCT ref_id, name FROM location WHERE trim(name) <> '')),
 place_lines AS MATERIALIZED (SELECT ref_id, t, row_number() OVER (PARTITION BY ref_id ORDER BY o, t) AS i FROM ({O.LOCATION_LINES})),
 place_sets AS MATERIALIZED (SELECT ref_id, count(*) AS loc_n, list_distinct(list_filter(list({O.clean('city')}), lambda x: x <> '')) AS loc_cities, list_distinct(list_filter(list({O.state('state')}), lambda x: x <> '')) AS loc_states, list_distinct(list_filter(list({O.zip5('zip')}), lambda x: x <> '')) AS loc_zips FROM location GROUP BY ref_id)"""


def scored(name: str, pairs: str, entities: str, cap: int | None, barred: bool, places: bool = True) -> str:
    """CTEs that end in name: all component scores of the pairs (entity_id, ref_id) that a query gives, over the first cap names and lines of locations, or all of them."""
    p, within = name, "true" if cap is None else f"i <= {cap}"
    names = f"SELECT ref_id, 3 AS r, i, t, 'Location' AS via FROM place_names WHERE {within}"
    if barred:
        names += " AND (ref_id, t) NOT IN (SELECT ref_id, name FROM named WHERE NOT usable AND core <> '')"
    overlap = lambda a, b: f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN CASE WHEN len(list_intersect({a}, {b})) > 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END END"
    parts = {k: f"{k}_score" for k in ("number", "body", "city", "state", "zip")}
    one = lambda c: f"CASE WHEN {c} <> '' THEN [{c}] ELSE []::VARCHAR[] END"
    return f"""{p}_pairs AS MATERIALIZED (SELECT entity_id, ref_id FROM ({pairs})),
 {p}_a AS MATERIALIZED (SELECT entity_id, i, t, "full", {O.core('"full"')} AS core FROM (SELECT *, {O.clean('t')} AS "full" FROM ({_numbered(f'SELECT entity_id, names FROM {entities} WHERE entity_id IN (SELECT entity_id FROM {p}_pairs)', 'entity_id', [('names', 1, '')])}))),
 {p}_b AS MATERIALIZED (SELECT ref_id, row_number() OVER (PARTITION BY ref_id ORDER BY r, i) AS j, t, via, "full", {O.core('"full"')} AS core FROM (SELECT *, {O.clean('t')} AS "full" FROM
 ({_numbered(f'SELECT ref_id, [primary_name] AS p, aliases FROM known WHERE ref_id IN (SELECT ref_id FROM {p}_pairs)', 'ref_id', [('p', 1, 'Name'), ('aliases', 2, 'Alias')])} UNION ALL SELECT * FROM ({names}) WHERE ref_id IN (SELECT ref_id FROM {p}_pairs)) WHERE t <> '')),
 {p}_f AS MATERIALIZED (SELECT entity_id, ref_id, i, j, a.t AS own, b.t AS other, via, a."full" AS af, b."full" AS bf, a.core AS ac, b.core AS bc FROM {p}_pairs JOIN {p}_a a USING (entity_id) JOIN {p}_b b USING (ref_id) WHERE a.t <> ''),
 {pair_scores(f'{p}_g', f"SELECT af AS x, bf AS y FROM {p}_f UNION ALL SELECT ac, bc FROM {p}_f WHERE ac <> '' AND bc <> ''")},
 {p}_h AS MATERIALIZED (SELECT entity_id, ref_id, own, other, via, greatest(f.score, coalesce(c.score, -1)) AS score, len({O.words("CASE WHEN c.score > f.score THEN bc ELSE bf END")})::INT AS n, row_number() OVER (PARTITION BY entity_id, ref_id ORDER BY greatest(f.score, coalesce(c.score, -1)) DESC, i, j) AS k
 FROM {p}_f JOIN {p}_g f ON f.x = af AND f.y = bf LEFT JOIN {p}_g c ON c.x = ac AND c.y = bc AND ac <> '' AND bc <> ''),
 {p}_names AS MATERIALIZED (SELECT entity_id, ref_id, coalesce(score, 0.0::DOUBLE) AS name_score, coalesce(own, '') AS matched_name, coalesce(other, '') AS matched_ref_name, coalesce(via, '') AS matched_via, coalesce(n, 0) AS matched_words FROM {p}_pairs LEFT JOIN (SELECT * FROM {p}_h WHERE k = 1 AND score > 0) USING (entity_id, ref_id)),
 {p}_l AS MATERIALIZED (SELECT entity_id, i, {_number('n')} AS number, {_body('n')} AS body FROM (SELECT entity_id, i, {O.address('t')} AS n FROM ({_numbered(f"SELECT entity_id, list_filter(addrs, lambda x: trim(x) <> '') AS lines FROM {entities} WHERE entity_id IN (SELECT entity_id FROM {p}_pairs)", 'entity_id', [('lines', 1, '')])}))),
 {p}_o AS MATERIALIZED (SELECT ref_id, row_number() OVER (PARTITION BY ref_id ORDER BY r, i) AS j, via, {_number('n')} AS number, {_body('n')} AS body FROM (SELECT ref_id, r, i, via, {O.address('t')} AS n FROM
 ({_numbered(f"SELECT ref_id, list_filter([addr1, addr2], lambda x: trim(x) <> '') AS lines FROM known WHERE ref_id IN (SELECT ref_id FROM {p}_pairs)", 'ref_id', [('lines', 1, 'HQ')])} UNION ALL SELECT ref_id, 2, i, t, 'Location' FROM place_lines WHERE {within} AND ref_id IN (SELECT ref_id FROM {p}_pairs)))),
 {p}_q AS MATERIALIZED (SELECT entity_id, ref_id, i, j, b.via, a.body AS ab, b.body AS bb, CASE WHEN a.number <> '' AND b.number <> '' THEN CASE WHEN a.number = b.number THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END END AS n FROM {p}_pairs JOIN {p}_l a USING (entity_id) JOIN {p}_o b USING (ref_id)),
 {ratios(f'{p}_t', f"SELECT ab AS x, bb AS y FROM {p}_q WHERE ab <> '' AND bb <> ''")},
 {p}_lines AS MATERIALIZED (SELECT entity_id, ref_id, number_score, body_score, coalesce(via, '') AS address_source FROM {p}_pairs LEFT JOIN (SELECT entity_id, ref_id, n AS number_score, score AS body_score, via,
 row_number() OVER (PARTITION BY entity_id, ref_id ORDER BY coalesce(n, 0) + coalesce(score, 0) DESC, i, j) AS k FROM {p}_q LEFT JOIN {p}_t ON x = ab AND y = bb AND ab <> '' AND bb <> '') USING (entity_id, ref_id) WHERE k = 1 OR k IS NULL),
 {p}_sets AS MATERIALIZED (SELECT entity_id, ref_id, e.cities_n, e.states_n, e.zips_n, list_concat({one(O.clean('d.city'))}, coalesce(loc_cities, [])) AS cities, list_concat({one(O.state('d.state'))}, coalesce(loc_states, [])) AS states, list_concat({one(O.zip5('d.zip'))}, coalesce(loc_zips, [])) AS zips, d.entity_type, d.name AS ref_name, coalesce(loc_n, 0) AS loc_n
 FROM {p}_pairs JOIN (SELECT entity_id, cities_n, states_n, zips_n FROM {entities}) e USING (entity_id) JOIN known d USING (ref_id) LEFT JOIN (SELECT * FROM place_sets WHERE {str(places).lower()}) USING (ref_id)),
 {ratios(f'{p}_u', f"SELECT x, unnest(cities) AS y FROM (SELECT unnest(cities_n) AS x, cities FROM {p}_sets)")},
 {p}_cities AS MATERIALIZED (SELECT entity_id, ref_id, max(score) AS city_score FROM (SELECT entity_id, ref_id, x, unnest(cities) AS y FROM (SELECT entity_id, ref_id, unnest(cities_n) AS x, cities FROM {p}_sets)) JOIN {p}_u USING (x, y) GROUP BY ALL),
 {p}_every AS MATERIALIZED (SELECT entity_id, ref_id, entity_type, ref_name, loc_n, {overlap('states_n', 'states')} AS state_score, {overlap('zips_n', 'zips')} AS zip_score, name_score, number_score, body_score, city_score, address_source, matched_name, matched_ref_name, matched_via, matched_words
 FROM {p}_sets JOIN {p}_names USING (entity_id, ref_id) JOIN {p}_lines USING (entity_id, ref_id) LEFT JOIN {p}_cities USING (entity_id, ref_id)),
 {p} AS MATERIALIZED (SELECT *, {O._weighted(parts, C.ADDRESS_WEIGHTS)} AS address_score, {O._weighted({'name': 'name_score', **parts}, C.MATCH_WEIGHTS)} AS match_score FROM {p}_every)"""


def _number(n: str) -> str:
    lead, box = rf"regexp_extract({n}, '^(\d+[a-z]?)\b', 1)", rf"regexp_extract({n}, '\b(?:po )?box (\w+)', 1)"
    return f"CASE WHEN {lead} <> '' THEN {lead} WHEN {box} <> '' THEN 'box' || {box} ELSE '' END"


def _body(n: str) -> str:
    return rf"trim(regexp_replace({n}, '^\d+[a-z]?\s*', ''))"


SCORES = ("name_score", "number_score", "body_score", "city_score", "state_score", "zip_score", "address_score", "match_score")
ROUNDED = ", ".join(f"{O.round1(c)} AS {c}" for c in SCORES)


def _verdict(name: str, address: str) -> str:
    v, a = [O.q(x) for x in C.VERDICTS], f"coalesce({address}, 0)"
    return f"CASE WHEN {name} IS NULL THEN {v[0]} WHEN {name} >= 92 OR ({name} >= 75 AND {a} >= 60) THEN {v[1]} WHEN {name} >= 75 THEN {v[2]} WHEN {a} >= 85 AND {name} >= 45 THEN {v[3]} WHEN {name} >= 45 OR {a} >= 50 THEN {v[4]} ELSE {v[5]} END"


def audited(name: str) -> str:
    """From name_raw to name: rounded scores, verdict, flags."""
    return f"""{name} AS MATERIALIZED (SELECT *, coalesce(verdict = {O.q(C.VERDICTS[1])} AND address_score < 60, false) AS address_divergent, coalesce(name_score >= 92 AND state_score = 0, false) AS geo_conflict
 FROM (SELECT *, {_verdict('name_score', 'address_score')} AS verdict FROM (SELECT * REPLACE ({ROUNDED}) FROM {name}_raw)))"""


_TESTABLE = "SELECT entity_id, ref_id FROM entities WHERE ref_id IN (SELECT ref_id FROM known)"
AUDIT = f"""{BASE}, {scored('audited_raw', _TESTABLE, 'entities', C.LOCATION_CAP, False)}, {audited('audited')}"""
#: The same over all names and lines of locations.
AUDIT_WHOLE = f"""{BASE}, {scored('audited_raw', _TESTABLE, 'entities', None, False)}, {audited('audited')}"""


def _best(name: str, asked: str, held: str, keep: int, floor: float) -> str:
    """CTEs that end in name(query, block, target, score): the keep best rows of held (block, target, forms) for each distinct row of asked (query, block, forms); forms are two strings, x1 and x2."""
    return f"""{name}_r AS MATERIALIZED (SELECT DISTINCT * FROM ({asked})), {name}_h AS MATERIALIZED (SELECT DISTINCT * FROM ({held})),
 {name}_pairs AS MATERIALIZED (SELECT DISTINCT r.x1, r.x2, h.x1 AS y1, h.x2 AS y2 FROM {name}_r r JOIN {name}_h h USING (block)),
 {pair_scores(f'{name}_c', f'SELECT x1 AS x, y1 AS y FROM {name}_pairs UNION ALL SELECT x2, y2 FROM {name}_pairs')},
 {name}_v AS MATERIALIZED (SELECT x1, x2, y1, y2, greatest(a.score, b.score) AS score FROM {name}_pairs JOIN {name}_c a ON a.x = x1 AND a.y = y1 JOIN {name}_c b ON b.x = x2 AND b.y = y2 WHERE greatest(a.score, b.score) >= {floor}),
 {name} AS MATERIALIZED (SELECT query, block, target, score FROM (SELECT r.*, h.target, v.score, row_number() OVER (PARTITION BY r.query, r.name, r.block, r.x1, r.x2 ORDER BY v.score DESC, h.target) AS k FROM {name}_r r JOIN {name}_h h USING (block)
 JOIN {name}_v v ON v.x1 = r.x1 AND v.x2 = r.x2 AND v.y1 = h.x1 AND v.y2 = h.x2) WHERE k <= {keep})"""


def _filled(core: str, full: str) -> str:
    return f"CASE WHEN {core} <> '' THEN {core} ELSE {full} END"


_REF_STATES = f"""SELECT DISTINCT ref_id, state FROM (SELECT ref_id, {O.state('state')} AS state FROM known UNION ALL SELECT ref_id, {O.state('state')} FROM location WHERE ref_id IN (SELECT ref_id FROM known)) WHERE state <> ''"""
_NAMED_ENTITIES = f"""SELECT entity_id, i AS name, "full", {O.core('"full"')} AS core, states_n FROM (SELECT entity_id, i, {O.clean('t')} AS "full", states_n FROM (SELECT entity_id, unnest(range(1, len(names) + 1)) AS i, unnest(names) AS t, states_n FROM unlinked))"""

SEARCH = f"""{BASE}, space AS MATERIALIZED (SELECT ref_id AS target, {_filled('core', '"full"')} AS x1, "full" AS x2 FROM (SELECT *, {O.core('"full"')} AS core FROM ({O.SPACE})) WHERE "full" <> ''),
 ref_states AS MATERIALIZED ({_REF_STATES}), asking AS MATERIALIZED ({_NAMED_ENTITIES}), blocks AS MATERIALIZED (SELECT DISTINCT state AS block FROM ref_states JOIN space ON target = ref_id),
 placed AS MATERIALIZED (SELECT * FROM (SELECT entity_id, name, unnest(states_n) AS block, {_filled('core', '"full"')} AS x1, "full" AS x2 FROM asking) WHERE block IN (SELECT block FROM blocks)),
 {_best('best', f'''SELECT entity_id AS query, name, block, x1, x2 FROM placed UNION ALL SELECT entity_id, name, '*', {_filled('core', '"full"')}, "full" FROM asking WHERE (entity_id, name) NOT IN (SELECT entity_id, name FROM placed)''',
        "SELECT state AS block, target, x1, x2 FROM space JOIN ref_states ON ref_id = target UNION ALL SELECT '*', target, x1, x2 FROM space", C.TOP_K * C.OVER_FETCH, C.FLOOR)},
 found AS MATERIALIZED (SELECT entity_id, ref_id, stage_a FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY stage_a DESC, ref_id) AS k FROM (SELECT query AS entity_id, target AS ref_id, max(score) AS stage_a FROM best GROUP BY ALL)) WHERE k <= {C.TOP_K})"""  # fmt: skip



def _candidates(cap: int | None) -> str:
    return f"""{SEARCH}, {scored('exact', 'SELECT entity_id, ref_id FROM found', 'unlinked', cap, True)}, candidates AS MATERIALIZED (SELECT *  FROM exact JOIN found USING (entity_id, ref_id))"""


CANDIDATES = _candidates(C.GAP_LOCATION_CAP)

_LOCAL = "(coalesce(address_score, 0) >= 60 OR coalesce(zip_score, 0) = 100 OR (coalesce(city_score, 0) >= 90 AND coalesce(state_score, 0) = 100))"
_TIER = f"""CASE WHEN len(names) = 0 THEN {O.q(C.TIERS[5])} WHEN ref_id IS NULL THEN {O.q(C.TIERS[4])} WHEN coalesce(name_score, 0) < 75 THEN {O.q(C.TIERS[4])} WHEN match_margin < {C.LEAST_MARGIN} THEN {O.q(C.TIERS[2])}
 WHEN name_score >= 92 AND (coalesce(address_score, 0) >= 85 OR (matched_via IN ('Name', 'Alias') AND matched_words >= 2 AND {_LOCAL})) THEN {O.q(C.TIERS[0])}
 WHEN name_score >= 92 OR (name_score >= 82 AND {_LOCAL}) THEN {O.q(C.TIERS[1])} ELSE {O.q(C.TIERS[3])} END"""
_RANKED = f"""SELECT *, coalesce({O.round1('match_score - following')}, 100.0::DOUBLE) AS match_margin, count(*) FILTER (WHERE name_score >= best_name - 2) OVER (PARTITION BY entity_id) - 1 AS same_name_rivals FROM
 (SELECT *, row_number() OVER w AS rank, lead(match_score) OVER w AS following, count(*) OVER (PARTITION BY entity_id) AS candidates_considered, first_value(name_score) OVER w AS best_name FROM candidates WINDOW w AS (PARTITION BY entity_id ORDER BY match_score DESC NULLS LAST, ref_id))"""
_ALTERNATES = ", ".join(f"max({c}) FILTER (WHERE rank = {r}) AS alt{r - 1}_{c}" for r in (2, 3) for c in ("ref_id", "ref_name", "match_score"))
_EXACT = f"len(list_filter(names, lambda x: {O.clean('x')} = {O.clean('ref_name')})) > 0 AND (zip_score = 100 OR (city_score >= 95 AND state_score = 100))"
_RULED = f"""ranked AS MATERIALIZED ({_RANKED}), alternates AS MATERIALIZED (SELECT entity_id, {_ALTERNATES} FROM ranked WHERE rank IN (2, 3) GROUP BY entity_id),
 proposed AS MATERIALIZED (SELECT * EXCLUDE (names, cities_n, every_name) REPLACE ({ROUNDED}), array_to_string(every_name, ' | ') AS names, array_to_string(cities_n, ' | ') AS cities_n, {_TIER} AS tier, coalesce({_EXACT}, false) AS exact_name_and_geo,
 array_to_string(regexp_extract_all(coalesce(ref_name, ''), {O.q(C.STATUS)}, 0), ' ') AS status_note, coalesce(ref_id IN (SELECT ref_id FROM entities WHERE ref_id IS NOT NULL), false) AS id_already_linked
 FROM (SELECT entity_id, populations, names, every_name, cities_n FROM unlinked) LEFT JOIN (SELECT * EXCLUDE (rank, following, best_name) FROM ranked WHERE rank = 1) USING (entity_id) LEFT JOIN alternates USING (entity_id))"""
PROPOSED = f"{CANDIDATES}, {_RULED}"
#: The same over all names and lines of locations.
PROPOSED_WHOLE = f"{_candidates(None)}, {_RULED}"

_TEXT = f"""SELECT entity_id, CASE WHEN core <> '' THEN core ELSE "full" END AS x, states_n FROM (SELECT *, {O.core('"full"')} AS core FROM (SELECT entity_id, states_n, {O.clean('t')} AS "full" FROM (SELECT entity_id, states_n, unnest(CASE WHEN len(names) > 0 THEN names ELSE [NULL] END) AS t FROM entities
 WHERE entity_id IN (SELECT entity_id FROM audited WHERE verdict <> {O.q(C.VERDICTS[1])}))))"""
_SUGGESTED = f"""{AUDIT}, text AS MATERIALIZED ({_TEXT}), cores AS MATERIALIZED (SELECT ref_id AS target, {O.state('state')} AS block, unnest([{O.core(O.clean('primary_name'))}, {O.core(O.clean('aliases[1]'))}]) AS y FROM known),
 homes AS MATERIALIZED (SELECT entity_id, x, block FROM (SELECT entity_id, x, unnest(states_n) AS block FROM text) WHERE block IN (SELECT block FROM cores WHERE block <> '')),
 {_best('near', "SELECT entity_id AS query, 0 AS name, block, x AS x1, x AS x2 FROM homes UNION ALL SELECT entity_id, 0, '*', x, x FROM text WHERE entity_id NOT IN (SELECT entity_id FROM homes)", "SELECT block, target, y AS x1, y AS x2 FROM cores WHERE block <> '' UNION ALL SELECT '*', target, y, y FROM cores", 1, 0.0)},
 picks AS MATERIALIZED (SELECT entity_id, ref_id FROM (SELECT query AS entity_id, target AS ref_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, target) AS k FROM near) WHERE k = 1),
 {scored('again', 'SELECT * FROM picks', 'entities', C.LOCATION_CAP, False)},
 corrected AS MATERIALIZED (SELECT *, coalesce(suggestion_differs AND suggested_name_score >= 80 AND suggested_name_score > name_score + 10 AND suggested_address_score >= 60 AND suggested_address_score >= address_score - 10, false) AS correction_recommended FROM
 (SELECT a.*, s.* EXCLUDE (entity_id), suggested_ref_id <> a.ref_id AS suggestion_differs FROM audited a LEFT JOIN (SELECT entity_id, ref_id AS suggested_ref_id, ref_name AS suggested_name, entity_type AS suggested_type, printf('%.1f', name_score)::DOUBLE AS suggested_name_score, printf('%.1f', address_score)::DOUBLE AS suggested_address_score FROM again) s ON s.entity_id = a.entity_id))"""


def _share(n: str, total: str) -> str:
    return f"round_even({n} / greatest({total}, 1) * 10000, 0) / 10000"


def _counted(source: str, by: str, **counts: str) -> str:
    """A row for each count over a source."""
    return f"SELECT {by}, n FROM (SELECT {', '.join(f'{e} AS {k}' for k, e in counts.items())} FROM ({source})) UNPIVOT (n FOR {by} IN ({', '.join(counts)}))"


_STRONG = f"SELECT *, count(*) OVER (PARTITION BY ref_id) AS holders FROM proposed WHERE tier = {O.q(C.TIERS[0])}"
_WHEN = lambda c: f"count(*) FILTER (WHERE {c})"



def _places(sheets: dict[str, tuple[str, str]], order: dict[str, str]) -> str:
    """sheet, place, entity_id, ref_id of sheets (title: source and condition)."""
    parts = []
    for title, (source, where) in sheets.items():
        parts.append(f"SELECT '{title}' AS sheet, row_number() OVER (ORDER BY {order[title]})::INT AS place, entity_id, ref_id FROM {source} WHERE {where}")
    return " UNION ALL ".join(parts)


_FLAT = ", ".join(f"coalesce({c}[1], '') AS {c}_first, array_to_string({c}, ' | ') AS {c}_all" for c in ("names", "addrs", "cities", "states", "zips"))
_TIERED = [f"tier = {O.q(t)}" for t in C.TIERS]
_ACCURACY_SHEETS = {
    "Review_Queue": ("corrected", f"verdict IN ({O.q(C.VERDICTS[4])}, {O.q(C.VERDICTS[5])})"), "Geo_Conflict": ("corrected", "geo_conflict"), "Address_Divergence": ("corrected", "address_divergent"),
    "Corrections_Recommended": ("corrected", "correction_recommended"), "Duplicate_IDs": ("(SELECT entity_id, ref_id, count(*) OVER (PARTITION BY ref_id) AS holders FROM entities WHERE ref_id IS NOT NULL)", "holders > 1"),
    "ID_Conflicts": ("(SELECT entity_id, CAST(NULL AS BIGINT) AS ref_id, ref_id_conflict FROM entities)", "ref_id_conflict"), "Scored_Detail": ("corrected", "true"),
    "Unreferenced_Records": ("(SELECT CAST(NULL AS BIGINT) AS entity_id, ref_id FROM known)", "ref_id NOT IN (SELECT ref_id FROM entities WHERE ref_id IS NOT NULL)"),
}
_ACCURACY_ORDER = {
    "Review_Queue": "name_score NULLS FIRST, entity_id", "Geo_Conflict": "name_score DESC NULLS LAST, entity_id", "Address_Divergence": "address_score NULLS FIRST, entity_id", "Corrections_Recommended": "suggested_name_score DESC NULLS LAST, entity_id",
    "Duplicate_IDs": "ref_id, entity_id", "ID_Conflicts": "entity_id", "Scored_Detail": "entity_id", "Unreferenced_Records": "ref_id",
}
_COVERAGE_SHEETS = {
    "Ready_To_Load": _TIERED[0], "Review_Probable": _TIERED[1], "Ambiguous_Rivals": _TIERED[2], "Review_Weak": _TIERED[3], "Parent_Id_Proposals": f"{_TIERED[0]} AND matched_via = 'Location'",
    "Shared_Id_Proposals": f"{_TIERED[0]} AND ref_id IN (SELECT ref_id FROM proposed WHERE {_TIERED[0]} GROUP BY ref_id HAVING count(*) > 1)", "Id_Already_Linked": f"{_TIERED[0]} AND id_already_linked",
    "Status_Flagged": "status_note <> ''", "No_Credible_Match": _TIERED[4], "Candidates_Detail": f"NOT ({_TIERED[4]})",
}
_COVERAGE_ORDER = {t: "match_score DESC NULLS LAST, entity_id" for t in _COVERAGE_SHEETS} | {"Ambiguous_Rivals": "match_margin NULLS FIRST, entity_id", "Shared_Id_Proposals": "ref_id, entity_id", "No_Credible_Match": "entity_id", "Candidates_Detail": "entity_id"}

_MEASURES = {"corroborated": _WHEN(f"verdict = {O.q(C.VERDICTS[1])}"), "divergent": _WHEN("address_divergent"), "geo_conflict": _WHEN("geo_conflict"), "satellite": _WHEN("address_source = 'Location'")}

ORACLE: dict[str, str] = {
    "name_score": f"{AUDIT} SELECT entity_id, ref_id, name_score, matched_name, matched_ref_name, matched_via, matched_words FROM audited",
    "addr_scores": f"{AUDIT_WHOLE} SELECT entity_id, ref_id, number_score, body_score, city_score, state_score, zip_score, address_score, address_source FROM audited",
    "accuracy_audit": f"{AUDIT} SELECT * FROM audited",
    "by_entity_type": f"{AUDIT_WHOLE} SELECT entity_type, n, corroborated, {_share('corroborated', 'n')} AS share FROM (SELECT entity_type, count(*) AS n, count(*) FILTER (WHERE verdict = {O.q(C.VERDICTS[1])}) AS corroborated FROM audited GROUP BY entity_type)",
    "corroborated_by_population": f"{AUDIT} SELECT population, n, corroborated, {_share('corroborated', 'n')} AS share FROM (SELECT population, count(*) AS n, count(*) FILTER (WHERE verdict = {O.q(C.VERDICTS[1])}) AS corroborated FROM (SELECT unnest(string_split(populations, '|')) AS population, verdict FROM audited JOIN entities USING (entity_id)) GROUP BY population)",
    "audited_verdicts": f"{AUDIT} {O.distribution('SELECT verdict FROM audited', 'verdict')}",
    "outcome_overall": f"""{AUDIT} SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN verdict = {O.q(C.VERDICTS[1])} THEN 'confirmed' WHEN verdict LIKE 'Probable%' THEN 'probable' WHEN verdict = {O.q(C.VERDICTS[4])} THEN 'review' ELSE 'wrong' END AS outcome FROM audited
 UNION ALL SELECT 'untestable' FROM entities WHERE ref_id IS NULL OR ref_id NOT IN (SELECT ref_id FROM known)) GROUP BY outcome""",
    "baseline_gains": f"""{AUDIT}, {scored('before_raw', _TESTABLE, 'entities', 0, False, False)}, {audited('before')} SELECT measure, baseline, now FROM ({_counted('SELECT * FROM before', 'measure', **_MEASURES)}) AS b(measure, baseline) JOIN ({_counted('SELECT * FROM audited', 'measure', **_MEASURES)}) AS a(measure, now) USING (measure)""",
    "reverse_lookup": f"{_SUGGESTED} SELECT * FROM corrected",
    "flattened_lists": f"{BASE} SELECT entity_id, {_FLAT} FROM entities",
    "usable_names": f"{BASE} SELECT entity_id, array_to_string(names, ' | ') AS usable FROM unlinked",
    "first_entities": f"{BASE} SELECT entity_id, populations FROM unlinked ORDER BY entity_id LIMIT 20",
    "accuracy_sheets": f"{_SUGGESTED} {_places(_ACCURACY_SHEETS, _ACCURACY_ORDER)}",
    "coverage_sheets": f"{PROPOSED} {_places({k: ('proposed', v) for k, v in _COVERAGE_SHEETS.items()}, _COVERAGE_ORDER)}",
    "coverage_by_population": f"{PROPOSED} SELECT population, n, strong, {_share('strong', 'n')} AS share FROM (SELECT population, count(*) AS n, count(*) FILTER (WHERE {_TIERED[0]}) AS strong FROM (SELECT unnest(string_split(populations, '|')) AS population, tier FROM proposed) GROUP BY population)",
    "proposed_types": f"{PROPOSED} {O.distribution(f'SELECT entity_type FROM proposed WHERE {_TIERED[0]}', 'entity_type')}",
    "blocked_topk": f"{SEARCH} SELECT entity_id, ref_id, {O.round1('stage_a')} AS stage_a FROM found",
    "exact_scores": f"{CANDIDATES} SELECT * REPLACE ({ROUNDED}, {O.round1('stage_a')} AS stage_a) FROM candidates",
    "gap_proposals": f"{PROPOSED} SELECT * REPLACE ({O.round1('stage_a')} AS stage_a, {O.round1('alt1_match_score')} AS alt1_match_score, {O.round1('alt2_match_score')} AS alt2_match_score) FROM proposed",
    "exact_name_geo": f"{PROPOSED} SELECT entity_id, exact_name_and_geo FROM proposed",
    "proposed_tiers": f"{PROPOSED} {O.distribution('SELECT tier FROM proposed', 'tier')}",
    "strong_evidence": f"{PROPOSED} " + _counted(_STRONG, "evidence", strong="count(*)", exact_name_and_geo=_WHEN("exact_name_and_geo"), street=_WHEN("address_score >= 85"), name=_WHEN("name_score >= 99.9"), margin=_WHEN("match_margin >= 10"), own_name=_WHEN("matched_via = 'Name'")),
    "load_flags": f"{PROPOSED_WHOLE} " + _counted(_STRONG, "flag", already_linked=_WHEN("id_already_linked"), shared_id=_WHEN("holders > 1"), via_location=_WHEN("matched_via = 'Location'"), status_note=_WHEN("status_note <> ''")),
    "estate_coverage": f"""{PROPOSED_WHOLE} SELECT linked, unlinked, strong, linked + unlinked AS total, {_share('linked', '(linked + unlinked)')} AS coverage, {_share('(linked + strong)', '(linked + unlinked)')} AS coverage_if_loaded
 FROM (SELECT count(DISTINCT entity_id) AS linked FROM entities), (SELECT count(*) AS unlinked, count(*) FILTER (WHERE tier = {O.q(C.TIERS[0])}) AS strong FROM proposed)""",
    "population_checks": f"""{PROPOSED} SELECT *, rows = entities AND tiered = rows AND supplied = rows AS holds FROM (SELECT count(*) AS rows, count(DISTINCT entity_id) AS entities, count(tier) AS tiered FROM proposed), (SELECT count(DISTINCT entity_id) AS supplied FROM ({O.canonical(O.without_id)}))""",
}
