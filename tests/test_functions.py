import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions import fuzzy, normalize, scores


def _one(spark, rows, kind, fn):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}").coalesce(1).orderBy("i").select(fn(F.col("x"))).collect()]


def test_names(spark):
    got = _one(spark, [None, " A&B,  Café_1 ", "The Medical Group", "."], "string", normalize.clean)
    assert got == ["", "a and b café_1", "the medical group", ""]
    assert _one(spark, ["The Reid Health Center, Inc.", "The Medical Group"], "string", normalize.name_core) == ["reid", ""]
    names = ["Reid (FKA Old Reid) (Closed 2020)", "X (Newton Clinic)", "X (Nowhere Clinic)", "A (abc) (Long Note)", None]
    got = [(r["primary"], r["aliases"]) for r in _one(spark, names, "string", normalize.split_name)]
    assert got == [("Reid", ["Old Reid"]), ("X", []), ("X", ["here Clinic"]), ("A", ["Long Note"]), ("", [])]
    assert _one(spark, ["X (Closed) (Merged 2)", "X"], "string", normalize.status_note) == ["(Closed) (Merged 2)", ""]


def test_addresses(spark):
    rows = ["12B Main Street", "P.O. Box 7", "1st Ave", "First Street", None]
    assert _one(spark, rows, "string", normalize.norm_address) == ["12b main st", "po box 7", "1st ave", "1st st", ""]
    assert _one(spark, rows, "string", normalize.street_number) == ["12b", "box7", "", "", ""]
    assert _one(spark, rows, "string", normalize.street_body) == ["main st", "po box 7", "t ave", "t st", ""]
    assert _one(spark, ["new york", "tx", "W. Virginia", "Ontario", "", None], "string", normalize.norm_state) == ["NY", "TX", "W ", "ON", "", ""]
    assert _one(spark, ["1234", "01234-5678", "", None, "x"], "string", normalize.norm_zip5) == ["01234", "01234", "", "", ""]
    assert _one(spark, ["12.0", "7", "1.5", "abc", None], "string", normalize.to_id) == [12, 7, None, None, None]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcdé ", max_size=40), st.text("abcdé ", max_size=40))
def test_ratio_matches_the_table(a, b):
    assert fuzzy.lcs(a, b) == _lcs(a, b)
    for f in (fuzzy.ratio, fuzzy.token_sort_ratio, fuzzy.token_set_ratio, fuzzy.pair_score):
        assert f(a, b) == pytest.approx(f(b, a)) and 0 <= f(a, b) <= 100


def test_known_scores(spark):
    assert fuzzy.ratio("kitten", "sitting") == pytest.approx(61.538, abs=1e-3)
    assert round(fuzzy.pair_score("indianapolis breast", "east indianapolis"), 2) == 94.44
    assert fuzzy.pair_score("reid health", "reid health richmond campus") < 100 and fuzzy.token_set_ratio("", "a") == 0
    rng = random.Random(1)
    pairs = [("".join(rng.choice("abc ") for _ in range(rng.randrange(9))), "".join(rng.choice("abc ") for _ in range(rng.randrange(9)))) for _ in range(40)] + [("", "")]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", fuzzy.ratio_expr(F.col("a"), F.col("b")).alias("e"), fuzzy.ratio_udf(F.col("a"), F.col("b")).alias("u"))
    assert all(r.e == pytest.approx(r.u) and r.u == pytest.approx(fuzzy.ratio(r.a, r.b)) for r in df.collect())


def test_kernels():
    form = lambda x: (x, x, x)
    assert scores.best_name([], [(form("a b"), "Name")])[0] == 0.0
    assert scores.best_name([form("a b")], [(form("x"), "Name"), (form("b a"), "Alias"), (form("a b"), "Location")])[1:] == ("a b", "b a", "Alias", 2)
    assert scores.best_address([("1", "main st")], [("2", "main st"), ("1", "")]) == (0.0, 100.0, 0)
    assert scores.best_address([("", "")], [("1", "x")]) == (None, None, 0)
    assert scores.best_address([], [("1", "x")]) == (None, None, None)
    assert scores.best_city([], ["a"]) is None


@pytest.mark.parametrize("name,address,want", [(None, 1.0, 0), (92.0, None, 1), (91.9, 60.0, 1), (75.0, 59.9, 2), (74.9, 85.0, 3), (45.0, None, 4), (44.9, 50.0, 4), (44.9, 49.9, 5)])
def test_verdicts(spark, name, address, want):
    from linkloom.constants import VERDICTS

    df = spark.createDataFrame([(name, address)], "n double, a double")
    assert df.select(scores.verdict(F.col("n"), F.col("a"))).first()[0] == VERDICTS[want]


names = st.lists(st.sampled_from(["red", "blue", "ring", "widget", "a", "steel nut", "é", "red red", ""]), max_size=5).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(names, min_size=1, max_size=8), names)
def test_bounds_hold_and_are_exact_without_shared_words(others, name):
    low, high = fuzzy.Names(others).bounds(name)
    for a, b, other in zip(low, high, others):
        score = fuzzy.pair_score(name, other)
        assert a <= score <= b and (a == b or set(name.split()) & set(other.split()) or len(set(name.split())) < len(name.split()) or len(set(other.split())) < len(other.split()))
        if a == b:
            assert a == score


def test_long_names_are_scored_whole():
    long = " ".join(f"word{i}" for i in range(30))
    low, high = fuzzy.Names([long, "word1", ""]).bounds(long + " more")
    assert (low == high).all() and low[0] == fuzzy.pair_score(long + " more", long)
    low, high = fuzzy.Names([long, "x"]).bounds("word1 word2")
    assert low[0] <= fuzzy.pair_score("word1 word2", long) <= high[0]


def test_bounds_hold_the_score_and_are_it_without_words_in_common():
    rng = random.Random(3)
    words = ["red", "ring", "two", "ab", "a", "b", "steel", "ring", "é"]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 5)))
    for _ in range(20):
        names, asked = [text() for _ in range(30)] + ["x" * 70 + " red"], [text() for _ in range(8)] + ["y " * 40]
        low, high = fuzzy.Names(names).every_bounds(asked)
        for i, a in enumerate(asked):
            for j, b in enumerate(names):
                score = fuzzy.pair_score(a, b)
                assert low[i, j] - 1e-9 <= score <= high[i, j] + 1e-9
                assert low[i, j] != high[i, j] or low[i, j] == score
                if {*a.split()} <= {*b.split()}:  # words within the other's are scored at once
                    assert low[i, j] == high[i, j]


def test_a_record_finds_what_each_pair_would(monkeypatch):
    rng = random.Random(4)
    words = ["red", "ring", "two", "ab", "steel", "nut", ""]
    text = lambda: " ".join(filter(None, (rng.choice(words) for _ in range(rng.randint(0, 4)))))
    form = lambda: (t := text(), t, t.replace("nut", "").strip())
    line = lambda: (rng.choice(["", "1", "2", "3"]), rng.choice(["", "main st", "main ave", "oak rd"]))
    for _ in range(40):
        others = [(form(), rng.choice(["Name", "Alias", "Location"])) for _ in range(rng.randint(0, 30))]
        lines = [line() for _ in range(rng.randint(0, 30))]
        record = scores.Record(others, lines)
        for _ in range(20):
            names, own = [form() for _ in range(rng.randint(0, 3))], [line() for _ in range(rng.randint(0, 3))]
            assert record.best_name(names) == scores.best_name(names, others)
            assert record.best_address(own) == scores.best_address(own, lines)
    # However many pairs: a name is compared once, and then only with those that can be the best.
    calls = []
    kernel = scores.pair_score
    monkeypatch.setattr(scores, "pair_score", lambda a, b: calls.append(1) or kernel(a, b))
    record = scores.Record([((f"red {x} {i}",) * 3, "Location") for i, x in enumerate(["ring", "nut", "bolt", "gear", "axle"] * 50)], [])
    assert {record.best_name([("red gear 3",) * 3]) for _ in range(1000)} == {(100.0, "red gear 3", "red gear 3", "Location", 3)}
    assert len(calls) < 10
