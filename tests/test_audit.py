import duckdb
import pytest

import __spark_entry__ as entry
from linkloom import proxies, queries
from linkloom.functions.fuzzy import pair_score
from linkloom.operators import gap, pool, reports
from linkloom.operators.blocking import best_in_blocks
from linkloom.operators.directory import candidate_states, location_names, search_space
from linkloom.oracle import every
from linkloom.queries import QUERIES

SF = "/root/testdata/sf0.001"
ORACLE = every()


@pytest.fixture(autouse=True, scope="module")
def one_audit():
    """The audit's plans, and what they keep, are shared by the tests."""
    made = {}
    build = queries.audit
    queries.audit = lambda spark, sf_dir: made.setdefault(sf_dir, build(spark, sf_dir))
    yield
    queries.audit = build


def _norm(row):
    return tuple((0, "") if v is None else (1, repr(round(v, 6))) if isinstance(v, float) else (1, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in proxies.TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    want = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(_norm(r) for r in df.collect()) == sorted(_norm([r[i] for i in at]) for r in want.fetchall())


def test_populations_partition_the_universe(spark):
    from linkloom.operators import populations
    from linkloom.queries import POPULATIONS

    r = proxies.relations(spark, SF)
    linked = {x[0] for x in populations.with_id(r, POPULATIONS[0]).select("entity_id").collect()}
    unlinked = {x[0] for x in populations.without_id(r, POPULATIONS[0]).select("entity_id").collect()}
    every = {x[0] for x in populations._universe(r, POPULATIONS[0]).select("entity_id").collect()}
    assert linked and unlinked and not linked & unlinked and linked | unlinked == every


def test_blocks_match_brute_force(spark, monkeypatch):
    from linkloom.operators import blocking

    monkeypatch.setattr(blocking, "CHUNK", 3)
    names = ["red ring", "red ring two", "blue widget", "widget blue", "steel nut", "", "red"]
    targets = [(100 + i, "A" if i % 3 else "B", [n]) for i, n in enumerate(names * 2)]
    queries = [(i, b, [n]) for i, n in enumerate(names) for b in "AB"]
    got = {(r.query, r.block): [] for r in spark.createDataFrame(queries, "query long, block string, forms array<string>").collect()}
    found = best_in_blocks(spark.createDataFrame(queries, "query long, block string, forms array<string>"), spark.createDataFrame(targets, "target long, block string, forms array<string>"), 3, 55.0)
    for r in found.orderBy("query", "block", "score", "target").collect():
        got[r.query, r.block].append((r.target, r.score))
    for i, b, (n,) in queries:
        want = sorted((-s, t) for t, block, (m,) in targets if block == b and (s := pair_score(n, m)) >= 55)[:3]
        assert sorted(got[i, b]) == sorted((t, -s) for s, t in want)


def test_retrieval_and_proposals(spark):
    a = queries.audit(spark, SF)
    space = [r.asDict() for r in search_space(a.known, location_names(a.located)).collect() if r.full]
    states = {}
    for r in candidate_states(a.known, a.located).collect():
        states.setdefault(r.ref_id, set()).add(r.state)
    placed = set().union(*states.values())
    best = {}
    from linkloom.functions.normalize import clean, core_of, usable_names
    from pyspark.sql import functions as F

    entities = a.entities(False).withColumn("u", F.transform(usable_names("names"), lambda n: F.struct(clean(n).alias("f"), core_of(clean(n)).alias("c")))).collect()
    for e in entities:
        score = {}
        for n in e.u:
            blocks = [s for s in e.states_n if s in placed] or [None]
            for block in blocks:
                rows = sorted((-max(pair_score(n.c or n.f, t["core"] or t["full"]), pair_score(n.f, t["full"])), t["ref_id"]) for t in space if block is None or block in states.get(t["ref_id"], ()))
                for s, i in [x for x in rows if -x[0] >= 55][:18]:
                    score[i] = max(score.get(i, 0), -s)
        best[e.entity_id] = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:6]
    got = {}
    for r in a.retrieved.collect():
        got.setdefault(r.entity_id, []).append((r.ref_id, r.stage_a))
    for e, want in best.items():
        assert sorted(i for i, _ in got.get(e, [])) == sorted(i for i, _ in want), e
    proposed = a.proposed
    check = reports.population_checks(proposed, a.rows(False)).first()
    assert check.holds and check.rows == len(entities)
    assert reports.load_flags(proposed).count() == 4 and reports.strong_evidence(proposed).count() == 6


def test_accuracy(spark):
    a = queries.audit(spark, SF)
    rows = a.corrected.collect()
    assert len(rows) + a.unverifiable.count() == a.entities().count()
    assert all((r.suggested_ref_id is None) == (r.verdict == "ID corroborated") for r in rows)
    assert any(r.verdict == "ID corroborated" for r in rows) and all(0 <= r.name_score <= 100 for r in rows)


def test_empty_inputs(spark):
    a = queries.audit(spark, SF)
    none = a.entities(False).limit(0)
    found = gap.retrieve(none, a.known, a.located)
    assert found.count() == 0
    with pytest.raises(pool.MissingColumns):
        pool.canonical(a.known, "x", {"name": ["nope"]})


def test_entry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns


def test_records_of_many_pairs_are_dealt_out(spark, monkeypatch):
    from linkloom.operators import accuracy, scoring

    a = queries.audit(spark, SF)
    monkeypatch.setattr(scoring, "PAIRS", 2)
    assert sorted(map(str, accuracy.audit(a.entities(), a.known, a.located).collect())) == sorted(map(str, a.audited.collect()))


def test_populations_that_are_alike_are_built_at_once(spark):
    from linkloom.operators import populations

    r, every = proxies.relations(spark, SF), queries.POPULATIONS
    assert populations.alike([*every, populations.Population("x", "is_client")]) == [list(every), [populations.Population("x", "is_client")]]
    for build in (populations.with_id, populations.without_id):
        at_once = build(r, *every)
        for p in every[:3]:
            one = build(r, p)
            assert sorted(map(str, at_once.where(f"{p.flag} = 1").select(*one.columns).collect())) == sorted(map(str, one.collect()))


def test_chunks_score_few_pairs_one_by_one(monkeypatch):
    from linkloom.operators import blocking

    names = [f"{a} {b} {c}" for a in ("small", "large", "cold") for b in ("ring", "nut", "bolt", "pin") for c in ("steel", "brass", "tin")] + ["red", ""]
    asked = [[n, f"{n} inc"] for n in (*names[::5], "ring of small steel", "nothing alike", "")]
    want = [sorted((-max(pair_score(a, n), pair_score(b, f"{n} inc")), i) for i, n in enumerate(names))[:3] for a, b in asked]
    want = [[x for x in best if -x[0] >= 55] for best in want]
    calls = []
    monkeypatch.setattr(blocking, "pair_score", lambda a, b: calls.append(1) or pair_score(a, b))
    monkeypatch.setattr(blocking, "CELLS", 100)
    assert list(blocking._Chunk([[n, f"{n} inc"] for n in names], [[i] for i in range(len(names))]).every_best(asked, 3, 55.0)) == want
    assert len(calls) < len(asked) * len(names) // 4


def test_rules_of_names_are_those_of_rows(spark):
    from linkloom.operators.directory import name_rules, ruled

    a = queries.audit(spark, SF)
    made = spark.createDataFrame([(i, n, c) for i in range(8) for n, c in (("The East Inc", "x"), ("Reid " + "ab"[i % 2], None), (f"Only {i}", ""), ("Inc", None), (f"Salem {i}", f"salem {i}"))], "ref_id long, name string, city string")
    for located in (a.located, made):
        rows, rules = location_names(located), name_rules(located)
        assert sorted(map(str, rules.collect())) == sorted(map(str, rows.select(*rules.columns).distinct().collect()))
        assert sorted(map(str, ruled(located, rules).collect())) == sorted(map(str, rows.select("ref_id", "name", "core", "usable").distinct().collect()))


def test_names_of_many_targets_fill_the_best(monkeypatch):
    from linkloom.operators import blocking

    names = [f"{a} {b} {c}" for a in ("small", "large", "cold") for b in ("ring", "nut", "bolt", "pin") for c in ("steel", "brass", "tin")]
    asked = [[n] for n in (*names[::7], "ring of small steel", "tin pin small")]
    ids = [[100 * j + i for j in range(3)] for i in range(len(names))]
    want = [sorted((-s, x) for n, own in zip(names, ids) if (s := pair_score(a, n)) >= 55 for x in own)[:3] for (a,) in asked]
    calls = []
    monkeypatch.setattr(blocking, "pair_score", lambda a, b: calls.append(1) or pair_score(a, b))
    assert list(blocking._Chunk([[n] for n in names], ids).every_best(asked, 3, 55.0)) == want
    # An equal name's three targets are all of the best: no other is scored.
    calls.clear()
    assert list(blocking._Chunk([[n] for n in names], ids).every_best([[n] for n in names], 3, 55.0)) == [[(-100.0, x) for x in own] for own in ids]
    assert not calls
    assert list(blocking._Chunk([["red"], ["red ring"]], [[1], [2]]).every_best([["red"], ["none"]], 3, 55.0)) == [[(-100.0, 1), (-pair_score("red", "red ring"), 2)], []]


def test_parts_of_a_block_match_brute_force(spark, monkeypatch):
    from linkloom.operators import blocking

    monkeypatch.setattr(blocking, "CHUNK", 3)
    monkeypatch.setattr(blocking, "MET", 2)
    names = [f"{a} {b}" for a in ("small", "large", "cold") for b in ("ring", "nut", "bolt")]
    asked = [(b, [n]) for n in names for b in "AB"]
    targets = [(100 + i, "AB"[i % 2], [n]) for i, n in enumerate(names * 4)]
    found = blocking.best_of_names(spark.createDataFrame(asked * 2, "block string, forms array<string>"), spark.createDataFrame(targets, "target long, block string, forms array<string>"), 3, 55.0)
    got = sorted((r.block, r.forms[0], -r.score, r.target) for r in found.collect())
    assert got == sorted((b, n, *x) for b, (n,) in asked for x in sorted((-pair_score(n, m), t) for t, block, (m,) in targets if block == b and pair_score(n, m) >= 55)[:3])


@pytest.mark.parametrize("parts", [1, 4])
def test_parents_between_the_ends_are_counted(spark, monkeypatch, parts):
    from linkloom.operators import directory

    monkeypatch.setattr(directory, "PARTS", parts)
    rows = [(i, f"Held by {n}{' Inc' * (i % 2)}", "x") for n in range(1, 9) for i in range(n)]
    rules = directory.name_rules(spark.createDataFrame(rows * 2, "ref_id long, name string, city string"))
    assert {(r.core, r.usable) for r in rules.collect()} == {(f"held by {n}", n < 5) for n in range(1, 9)}
