import numpy as np
import pytest

from linkloom.llm import ann


def _unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _kinds(n, d):
    rng = np.random.default_rng(3)
    own = _unit(rng.standard_normal((n, d)))
    centres = _unit(rng.standard_normal((8, d)))
    return {
        "unit": own,
        "lengths": own * rng.lognormal(0, 0.5, (n, 1)),
        "wide lengths": own * rng.lognormal(0, 1, (n, 1)),
        "clusters": _unit(centres[rng.integers(0, 8, n)] + 0.5 * own),
        "cone": own + 3 * centres[0],
        "falling": rng.standard_normal((n, d)) / np.arange(1, d + 1),
    }


@pytest.mark.parametrize("kind", sorted(_kinds(40, 32)))
def test_recall(kind, monkeypatch):
    """A block against brute force."""
    own = _kinds(5000, 32)[kind]
    ids = np.arange(len(own))
    block = ann.Block(ids, own, np.ones(len(own), np.int64), ann.Coder(own[:2000]))
    asked = ids[::50]
    q, found, score = block.nearest(asked, own[asked], 20)
    hits = 0
    for i, a in enumerate(asked):
        want = own @ own[a]
        want[a] = -np.inf
        best = np.lexsort((ids, -want))[:20]
        mine = found[q == i]
        assert len(mine) == 20 and a not in mine
        assert np.allclose(score[q == i], want[mine], atol=1e-12) and (np.lexsort((mine, -want[mine])) == np.arange(20)).all()
        hits += len(set(best.tolist()) & set(mine.tolist()))
    assert hits / (20 * len(asked)) >= 0.93


def test_all_within_the_radius(monkeypatch):
    rng = np.random.default_rng(1)
    own = _unit(rng.standard_normal((6000, 16)))
    own[100:200] = own[0] + 0.02 * own[100:200]
    coder = ann.Coder(own)
    words = coder.words(own)
    band = ann.Band(words, 1.0)
    far = np.array([np.bitwise_count(words ^ words[q]).sum(axis=1) for q in range(5)])
    probed = 0
    for radius in (0, 3, 20, 31, 60, 101, 256):
        q, row = band.within(words[:5], np.array([radius, radius, -1, radius, radius]))
        assert sorted(zip(q.tolist(), row.tolist())) == [(a, b) for a in (0, 1, 3, 4) for b in np.flatnonzero(far[a] <= radius).tolist()]
        probed += radius <= band.probed
    assert 0 < probed < 7
    assert band.probe(words[:0], np.zeros(0, np.int64))[0].size == 0


def _brute(rows, every, k):
    """A row's k best others; rows of equal id and vector each leave out one."""
    out = []
    for n, (a, v) in enumerate(rows):
        if a % every == 0:
            other = sorted((-float(np.dot(v, w)), b) for m, (b, w) in enumerate(rows) if m != n and len(w) == len(v))[:k]
            out += [(a, r, b, round(-s, 9)) for r, (s, b) in enumerate(other, 1)]
    return sorted(out)


def test_search_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)  # several blocks
    own = _kinds(300, 16)["lengths"]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(own)]
    rows += [(20, rows[20][1]), (20, rows[41][1]), (40, rows[40][1]), (40, rows[40][1]), (7, rows[7][1]), (500, [1.0, 2.0]), (501, [2.0, 0.5]), (500, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, block string, copies int")
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in ann.search(df).collect())
    want = _brute(rows, 20, 20)
    assert len(got) == len(want) and [g[:2] for g in got] == [w[:2] for w in want]
    assert len(set(got) & set(want)) >= 0.95 * len(set(want))
    assert [g for g in got if g[0] == 500] == [w for w in want if w[0] == 500]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, []), (None, [1.0, 1.0]), (20, [0.5, 0.5]), (40, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.5), (20, 1, 1, 1.0), (20, 2, 2, 1.0), (20, 3, 0, 0.5)]
    assert ann.search(df.limit(0)).count() == 0
