import math
import random
import time

from linkloom.llm import toxicity
from linkloom.llm.queries import op10_toxicity


def test_folding():
    assert toxicity.fold("Id1ot!  ѕcum, l0s3r 2024") == " idiot scum loser 2024 "
    assert toxicity.fold(None) == toxicity.fold("") == " "
    for text in ("\uff54oxic", "t\u00f3xic", "to\u0445ic", "tox\u0131c", "to\u200bxic", "T.O.X.I.C", "t-o-x-i-c", "\U0001d42d\U0001d428\U0001d431\U0001d422\U0001d41c", "t0x1c", "\u03c4\u03bf\u03c7ic"):
        assert toxicity.fold(text) == " toxic ", text
    assert toxicity.fold("a.b is no word, nor x-y; e.g. 3.5.7") == " a b is no word nor x y e g 357 "


def test_exceptions_and_length():
    model = toxicity.Model({" trash ": 3.0, " stup": 2.0}, frozenset({" trash can "}), (0.0, 1.0, 0.0), True)
    assert model.weigh("the trash can") == (0.0, 0.0)
    total, normal = model.weigh("trash and stupid tr4sh")
    assert total == 8.0 and normal < total
    assert model.weigh("trash " + "word " * 500)[1] < model.weigh("trash word")[1]


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = op10_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.toxic and r.predicted for r in got)
    assert hit >= 0.88 * sum(r.toxic for r in got) and hit >= 0.95 * sum(r.predicted for r in got)


def test_edges(spark):
    rows = [(i, f"you are a moron {i}", "x") for i in range(10)] + [(20 + i, f"you are nice {i}", "x") for i in range(30)] + [(90, None, None), (91, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([(i, 1) for i in range(10)] + [(20 + i, 0) for i in range(30)] + [(3, 0), (None, 1), (25, None)], "doc_id long, toxic int")
    model = toxicity.fit(df, marks)
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert min(got[i] for i in range(10)) > max(got[20 + i] for i in range(30)) and got[90] == got[91] < 0.3
    none = toxicity.fit(df, marks.limit(0))
    assert {r.score for r in toxicity.score(df, none).collect()} == {0.0}
    assert toxicity.score(df.limit(0), model).count() == 0


def test_exceptions_of_the_whole_lexicon(spark):
    # 2,100 entries seen in more toxic texts than the last one, which has an exception phrase in clean texts.
    many = " ".join(f"{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" for i in range(2100))
    rows = [(i, f"{many} {i}") for i in range(30)] + [(100 + i, f"zorn {i}") for i in range(8)]
    rows += [(200 + i, f"nice day {i}") for i in range(300)] + [(600 + i, f"zorn valley {i}") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 200)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(df, marks)
    assert " zorn " in model.weights and sum(x.endswith(" ") for x in model.weights) > 2000
    assert " zorn valley " in model.exceptions


def test_weights_match_a_naive_matcher():
    rng = random.Random(5)
    words = ["trash", "trashy", "can", "stupid", "stupendous", "bin", "nice", "x"]
    weights = {" trash ": 3.0, " stup": 2.0, " stupid ": 2.5, " nic": 0.5}
    barred = [" trash can ", " nice trash ", " stupid bin "]
    model = toxicity.Model(weights, frozenset(barred), (0.0, 1.0, 0.0), True)
    for _ in range(300):
        folded = toxicity.fold(" ".join(rng.choice(words) for _ in range(rng.randrange(12))))
        total = 0.0
        for at in range(len(folded)):
            held = any(folded.startswith(x, i) and i <= at < i + len(x) - 1 for x in barred for i in range(len(folded)))
            total += 0.0 if held else max([w for x, w in weights.items() if folded.startswith(x, at)], default=0.0)
        a, b = model.weigh(folded)
        assert abs(a - total) < 1e-9 and abs(b - total / math.log(8.0 + folded.count(" "))) < 1e-9


def test_counts_match_plain_counting(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["moron", "nice", "day", "the", "slur", "cat"] if i % 3 == 0 else ["nice", "day", "the", "cat", "dog"]) for _ in range(8))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0 and ("moron" in t or "slur" in t))) for i, t in rows], "doc_id long, toxic int")
    toxic = {r.doc_id: r.toxic for r in marks.collect()}
    texts = {}
    for i, t in rows:
        texts[t] = max(texts.get(t, 0), toxic[i])
    nt, nc = sum(texts.values()), len(texts) - sum(texts.values())
    want = {}
    for x in {e for t in texts for e in toxicity.entries(toxicity.fold(t))}:
        t = sum(v for k, v in texts.items() if x in toxicity.entries(toxicity.fold(k)))
        c = sum(1 - v for k, v in texts.items() if x in toxicity.entries(toxicity.fold(k)))
        odds = (t + 0.5) / (nt + 1) / ((c + 0.5) / (nc + 1))
        if t >= toxicity.SUPPORT and odds >= toxicity.ODDS:
            want[x] = round(math.log(odds), 9)
    model = toxicity.fit(df, marks)
    assert want and {k: round(w, 9) for k, w in model.weights.items()} == want


def test_many_matches_take_linear_time():
    model = toxicity.Model({" trash ": 3.0}, frozenset({" trash can "}), (0.0, 1.0, 0.0), True)
    began = time.time()
    assert model.weigh("trash can trash " * 100_000)[0] > 0
    toxicity.fold("a.b." * 200_000)
    assert time.time() - began < 20
