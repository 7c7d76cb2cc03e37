import numpy as np

from linkloom.llm import lm
from linkloom.llm.common import word_hashes


def test_probabilities_sum_to_one():
    net = lm.Network(np.arange(lm.SIZE, dtype=float))
    ids = np.array([5, 900, 4000, 17, 5])
    total = np.zeros(5)
    for token in range(lm.SIZE):
        padded, at, _ = lm.pad([ids])
        for k in range(5):
            own = padded.copy()
            own[at[k] + lm.SIDE] = token  # masked, so only the target changes
            total[k] += np.exp(net.log_probabilities(own, at[k : k + 1]))[0] if k == 2 else 0
    assert abs(total[2] - 1) < 1e-3


def test_score_matches_a_plain_loop():
    net = lm.Network(np.ones(lm.SIZE))
    texts = [np.array([1, 2, 3, 70, 4000]), np.zeros(0, np.int64), np.array([9])]
    got = lm.score_texts(net, texts)
    for own, want in zip(texts, got):
        total = 0.0
        for i, t in enumerate(own):
            z = np.zeros(lm.WIDTH)
            for j, off in enumerate([-2, -1, 1, 2]):
                k = i + off
                z += net.context[j][own[k] if 0 <= k < len(own) else lm.SIZE]
            h = np.tanh(z)
            a = net.outer @ h + net.outer_bias
            b = net.inner[t // lm.MEMBERS] @ h + net.inner_bias[t // lm.MEMBERS]
            total += a[t // lm.MEMBERS] - np.log(np.exp(a).sum()) + b[t % lm.MEMBERS] - np.log(np.exp(b).sum())
        assert abs(total - want) < 1e-3


def test_a_step_follows_the_slope():
    """Against differences of the loss; a first Adagrad step is the slope over its own size."""
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, lm.SIZE, 12)]
    loss = lambda net: -lm.score_texts(net, texts)[0]
    net = lm.Network(np.ones(lm.SIZE))
    slopes = []
    net._descend = lambda name, at, slope, rate: slopes.append((name, at, slope))
    padded, at, _ = lm.pad(texts)
    net.step(padded, at, 0.1)
    for name, at, slope in slopes:
        whole = np.zeros(getattr(net, name).shape, np.float64)
        whole[at] = slope
        for place in zip(*np.nonzero(np.abs(whole) > 0.6 * np.abs(whole).max())):
            own, old = getattr(net, name), getattr(net, name)[place]
            own[place] = old + 1e-2
            up = loss(net)
            own[place] = old - 1e-2
            assert abs((up - loss(net)) / 2e-2 - whole[place]) < 0.02 * max(1, abs(whole[place]))
            own[place] = old


def _plain(rows, words, net):
    """Scores by plain loops over all rows."""
    every = {}
    for _, text, *_ in rows:
        for w in word_hashes(text).tolist():
            every[w] = every.get(w, 0) + 1
    out = []
    for doc_id, text, *_ in rows:
        found = word_hashes(text)
        ids = words.ids(found)
        total = lm.score_texts(net, [ids])[0]
        unseen = 0
        for w, t in zip(found.tolist(), ids.tolist()):
            if t < lm.SIZE - lm.OTHERS:
                continue
            mine = sum(x == w for x in found.tolist())
            same = [x for x, u in zip(found.tolist(), ids.tolist()) if u == t]
            total += np.log((every[w] - mine + lm.PRIOR) / (words.counts[t] - len(same) + lm.PRIOR * (words.kinds[t - lm.SIZE + lm.OTHERS] + 1)))
            unseen += every[w] == mine
        out.append((doc_id, len(ids), round(total, 3), unseen))
    return sorted(out, key=str)


def test_scores_and_training(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 90)
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{(s + k) % 12}" for k in range(30)) for s in rng.integers(0, 12, 100)]
    # More words than are frequent, so that some are rare; some in two documents, some repeated in one.
    texts = [t + f" {' '.join(f'r{i}x{j}' for j in range(45))} shared{i // 2} own{i} own{i}" for i, t in enumerate(texts)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(500, None, "x"), (501, "", "x"), (502, "!!", None), (0, texts[0], "x"), (None, texts[3], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, log_prob string").repartition(3)
    counted = lm.count_words(df)
    words = lm.vocabulary(counted)
    assert words.counts.sum() == sum(len(word_hashes(t)) for _, t, _ in rows)
    assert words.kinds.sum() == counted.count() - (lm.SIZE - lm.OTHERS)
    net = lm.train(df, words)
    coded = [words.ids(word_hashes(t)) for _, t, _ in rows]
    assert lm.score_texts(net, coded).sum() > lm.score_texts(lm.Network(words.counts), coded).sum() + 100
    got = lm.score(df, words, net, counted).collect()
    assert sorted([(r.doc_id, r.n_tokens, round(r.log_prob, 3), r.n_unseen) for r in got], key=str) == _plain(rows, words, net)
    assert all(r.n_tokens == 0 and r.log_prob == 0 and r.mean_log_prob is None for r in got if (r.doc_id or 0) >= 500)
    assert all((r.n_unseen == 0) == (r.doc_id in (0, 3, None) or r.doc_id >= 500 or r.n_rare == 0) for r in got if r.n_rare or (r.doc_id or 0) >= 500)


def test_every_row_trains_once(spark, monkeypatch):
    """Rows of all rounds together are all rows, and a step moves what any one of them holds."""
    monkeypatch.setattr(lm, "STEP", 0.1)
    rows = [(i, f"red green blue {i % 20} red green blue {i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    words = lm.vocabulary(lm.count_words(df))
    trained = lm.train(df, words)
    plain = lm.Network(words.counts)
    from pyspark.sql import functions as F

    for turn in range(lm.ROUNDS):
        part = [r.text for r in df.where(F.pmod(F.xxhash64("text"), F.lit(lm.ROUNDS)) == turn).collect()]
        plain = lm.Network(words.counts).load(plain.flat())
        assert part and lm.learn_texts(plain, [words.ids(word_hashes(t)) for t in part]) == sum(len(word_hashes(t)) for t in part)
    assert np.allclose(trained.flat(), plain.flat(), atol=1e-5)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    counted = lm.count_words(none)
    words = lm.vocabulary(counted)
    assert lm.score(none, words, lm.train(none, words), counted).count() == 0
