import numpy as np
from pyspark.sql import functions as F

from linkloom.llm import langid
from linkloom.llm.queries import op4_langid


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = op4_langid(spark, sf).join(docs, "doc_id").where("held_out").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok")).collect()
    assert len(got) > 200 and np.mean([r.ok for r in got]) > 0.97


def test_edges(spark):
    rows = [(i, "the cat sat on the mat and then", "en", "x", 1) for i in range(6)] + [(10 + i, "der hund ist nicht auf das dach", "de", "x", 1) for i in range(6)]
    rows += [(50, None, "en", None, 1), (51, "", None, None, 1), (52, "123 !", "de", "x", 1), (53, "the dog and the hat", None, "x", None), (53, "the dog and the hat", None, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score int")
    model = langid.fit(df)
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(df, model).collect()]
    assert len(got) == len(rows)
    assert {p for d, p, _ in got if d < 10} == {"en"} and {p for d, p, _ in got if 10 <= d < 20} == {"de"} and {p for d, p, _ in got if d == 53} == {"en"}
    assert all(p == "und" and s == 0 for d, p, s in got if d in (50, 51, 52))
    assert all(0 <= s <= 1 for _, _, s in got)
    none = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0


def test_masks_match_plain_sets():
    """Every n-gram of a profile is found, and the corrected counts are near those of plain sets, for over 64 languages."""
    rng = np.random.default_rng(2)
    profiles = {f"l{i:03d}": np.unique(rng.integers(0, 1 << 63, 2000, dtype=np.uint64)) for i in range(150)}
    model = langid.build(profiles)
    assert len(model.slices) == 3 and model.languages == sorted(profiles)
    for i, x in enumerate(model.languages):
        mask = np.bitwise_and.reduce([model.slices[i // 64][at] for at in langid.probes(profiles[x])])
        assert ((mask >> np.uint64(i % 64)) & np.uint64(1)).all()
    small = {"a": langid.grams("der hund und die katze im haus"), "b": langid.grams("the dog and the cat in a house")}
    small = {x: np.unique(h) for x, h in small.items()}
    model = langid.build(small | profiles)
    n, found = model.counts("the dog and der hund in the house")
    own = langid.grams("the dog and der hund in the house")
    for x in "ab":
        assert abs(found[model.languages.index(x)] - np.isin(own, small[x]).sum()) < 0.02 * n + 1


def test_a_large_profile_gets_a_larger_filter():
    rng = np.random.default_rng(2)
    model = langid.build({"a": rng.integers(0, 1 << 63, 600_000, dtype=np.uint64), "b": rng.integers(0, 1 << 63, 10, dtype=np.uint64)})
    assert len(model.slices[0]) > 1 << langid.BITS and (model.wrong < 0.2).all()


def test_many_languages(spark):
    words = [f"{chr(97 + i // 10)}{chr(104 + i % 10)}o{chr(97 + i % 7)}u" for i in range(80)]
    rows = [(100 * i + k, " ".join([w, w + "s", w]), f"l{i:02d}") for i, w in enumerate(words) for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    got = {r.doc_id: r.lang_pred for r in langid.predict(df, model).collect()}
    assert sum(got[d] == x for d, _, x in rows) > 0.95 * len(rows) and len(set(got.values())) > 64


def test_profiles_match_plain_counting(spark):
    from collections import Counter

    rows = [(i, t, x) for i, (t, x) in enumerate([("ab ab abc b", "x"), ("ab cd cd", "x"), ("cd cd ce ab", "y"), ("ab ab", "y"), ("ce ce", "y")])]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    count = {x: Counter(h for _, t, y in rows if y == x for h in langid.grams(t).tolist()) for x in "xy"}
    share = {x: {h: n / sum(c.values()) for h, n in c.items()} for x, c in count.items()}
    for x, other in ("xy", "yx"):
        want = {h for h, n in count[x].items() if n >= langid.LEAST and share[x][h] >= langid.RELATIVE * max(share[x][h], share[other].get(h, 0))}
        expected = langid.build({x: np.array(sorted(want), np.uint64)})
        bit = np.uint64(1 << model.languages.index(x))
        assert ((model.slices[0] & bit != 0) == (expected.slices[0] != 0)).all()


def test_marks_alone_are_no_letters_and_names_may_clash(spark):
    df = spark.createDataFrame([(1, "\u0301\u0301 \u0301", "en", 1), (2, "cafe\u0301", "en", 2)], "doc_id long, text string, lang string, `a.b` int").withColumnRenamed("lang", "text_")
    model = langid.fit(df.withColumnRenamed("text_", "lang"))
    got = {r.doc_id: r for r in langid.predict(df, model, ("doc_id", "text_", "a.b")).collect()}
    assert got[1].lang_pred == "und" and got[2]["a.b"] == 2 and got[2].text_ == "en"
