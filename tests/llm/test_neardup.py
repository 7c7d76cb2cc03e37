import random

import numpy as np

from linkloom.llm import neardup
from linkloom.llm.graph import components


def _corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randrange(30, 120))]
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    texts += texts[:5] + [None, "", "!!", "one two", "One two!", "three"]
    return list(enumerate(texts))


def _brute(rows, threshold=0.8):
    sets = {d: frozenset(neardup.shingle_set(t, 5).tolist()) for d, t in rows}
    near = {a: [b for b in sets if b != a and sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])] for a in sets}
    root = {}
    for a in sorted(sets):
        if a not in root:
            front = [a]
            root[a] = a
            while front:
                for y in near[front.pop()]:
                    if y not in root:
                        root[y] = a
                        front.append(y)
    return {a: (root[a], len(near[a])) for a in sets}


def test_matches_brute_force(spark, monkeypatch):
    rows = _corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = _brute(rows)
    for block in (1024, 2):
        monkeypatch.setattr(neardup, "BLOCK", block)
        got = {r.doc_id: (r.class_id, r.n_links) for r in neardup.join(df).collect()}
        assert got == want


def test_edges(spark):
    wide = "doc_id long, text string, fp string, band int, size int"
    empty = spark.createDataFrame([], wide)
    assert neardup.join(empty).count() == 0
    rows = [(1, "a b c d e f", "x", 1, 1), (1, "a b c d e f", "x", 1, 1), (None, "a b c d e f", None, None, None), (2, None, None, 1, 1), (3, "", "y", 1, 1)]
    df = spark.createDataFrame(rows, wide)
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in neardup.join(df).collect())
    assert got == [("1", "1", 1), ("1", "1", 1), ("2", "2", 0), ("3", "3", 0), ("None", "None", 0)]
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "None"]


def test_keep_one_with_repeated_ids_and_clashing_names(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (1, long), (1, "quite another text of some seven words"), (2, long + " more"), (3, "quite another text of some seven words"), (4, None), (4, ""), (4, "!"), (None, long), (5, long)]
    names = ["doc_id", "text", "id", "fp", "n", "node", "a.b", "times", "c1"]
    df = spark.createDataFrame([(*r, *[k] * 7) for k, r in enumerate(rows)], "doc_id long, text string, " + ", ".join(f"x{i} int" for i in range(7))).toDF(*names)
    kept = neardup.keep_one(df)
    assert kept.columns == names
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert got == sorted([("1", long), ("1", "quite another text of some seven words"), ("4", ""), ("4", ""), ("4", "!"), ("None", long)])
    once = neardup.keep_one(df.where("doc_id > 1 AND doc_id <> 4"))
    assert sorted(r.doc_id for r in once.collect()) == [2, 3] and once.columns == names


def test_marks_miss_nothing(spark, monkeypatch):
    rows = spark.createDataFrame([(i,) for i in range(2000)] + [(None,)], "x long")
    ids = spark.createDataFrame([(i,) for i in range(0, 2000, 7)], "id long")
    for most, share in ((1 << 26, 0.25), (1 << 10, 1.0)):
        monkeypatch.setattr(neardup, "MOST_MARKS", most)
        got = {r.x: r.may for r in neardup.marked(rows, rows["x"], ids, "may").collect()}
        assert len(got) == 2001 and got[None] is False and all(got[i] for i in range(0, 2000, 7))
        assert sum(got.values()) <= 2001 * share
    assert not any(r.may for r in neardup.marked(rows, rows["x"], ids.limit(0), "may").collect())


def test_bands_reach_recall():
    bands, rows = neardup.bands_for(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999


def test_shared_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 500, 200).astype(np.uint64)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = neardup.shared(sets)
    off = ~np.eye(9, dtype=bool)
    assert (got[off] == np.array(want)[off]).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 102), (102, 101), (7, 7), (None, 3)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert all(got[i] == 0 for i in range(41)) and got[101] == got[102] == got[100] == 100 and len(got) == 44


def test_query_matches_sql(spark):
    import duckdb

    from linkloom.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.sql(ORACLE["op8_jaccard_join"]).fetchall())
    got = QUERIES["op8_jaccard_join"](spark, sf).select("doc_id", "class_id", "n_links", "n_copies").collect()
    assert sorted(map(tuple, got)) == want and any(r.n_links for r in got)
