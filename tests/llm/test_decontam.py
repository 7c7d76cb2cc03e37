import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import decontam
from linkloom.llm.common import word_hashes

RNG = random.Random(4)
WORDS = [f"w{i}" for i in range(300)]
ITEMS = [(i, " ".join(RNG.choice(WORDS) for _ in range(n))) for i, n in enumerate([3, 6, 9, 15, 20, 33, 40, 56, 70, 150] * 3)]


def _edited(text, share):
    w = text.split()
    for _ in range(int(share * len(w))):
        p = RNG.randrange(len(w))
        kind = RNG.randrange(3)
        if kind == 0:
            w[p] = RNG.choice(WORDS)
        elif kind == 1:
            w.insert(p, RNG.choice(WORDS))
        elif len(w) > 1:
            del w[p]
    return " ".join(w)


def _plain(a, b):
    """Edit distance of a to the best substring of b, by the table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=14))
def test_distance_matches_the_table(a, b):
    assert decontam.substring_distance(np.array(a, np.uint64), np.array(b, np.uint64))[0] == _plain(a, b)


def test_finds_items_and_nothing_else():
    index = decontam.Index([i for i, _ in ITEMS], [word_hashes(t) for _, t in ITEMS], decontam.repetitions())
    for share, least in ((0.0, 1.0), (0.1, 0.97), (0.18, 0.95)):
        hits = 0
        for i, text in ITEMS:
            around = [" ".join(RNG.choice(WORDS) for _ in range(50)) for _ in range(2)]
            document = f"{around[0]}, {_edited(text, share).upper()}. {around[1]}"
            found = {item: (d, first) for item, d, _, first in index.matches(document)}
            hits += i in found
            words = word_hashes(document)
            for item, (d, first) in found.items():
                own = word_hashes(ITEMS[item][1])
                assert d == _plain(own.tolist(), words[max(0, first - 40) : first + 2 * len(own) + 40].tolist()) <= decontam.allowed(len(own))
        assert hits >= least * len(ITEMS)
    clean = " ".join(RNG.choice(WORDS) for _ in range(3000))
    assert all(len(ITEMS[item][1].split()) < 5 for item, *_ in index.matches(clean))


def test_tables(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 7)
    items = spark.createDataFrame([*ITEMS[3:], (99, None), (98, ""), (3, ITEMS[3][1])], "item_id long, text string")
    rows = [(1, f"x y {ITEMS[5][1]} z", "q"), (1, f"x y {ITEMS[5][1]} z", "q"), (2, None, None), (3, "", "q"), (4, "clean words only here", "q"), (None, ITEMS[7][1], "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, distance string")
    got = [(r.doc_id, r.item_id, r.distance, r.similarity, r.first_word) for r in decontam.find(df, items).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, 5, 0, 1.0, 2), (1, 5, 0, 1.0, 2), (None, 7, 0, 1.0, 0)]))
    kept = decontam.drop(df, items)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert decontam.find(df, items.limit(0)).count() == 0 and decontam.find(df.limit(0), items).count() == 0
    assert decontam.drop(df, items.limit(0)).count() == len(rows)


def test_finds_items_wherever_the_edits_are():
    rng = random.Random(9)
    items = [(i, [rng.choice(WORDS) for _ in range(n)]) for i, n in enumerate([12, 20, 59, 100, 127, 150, 300, 700] * 4)]
    index = decontam.Index([i for i, _ in items], [word_hashes(" ".join(w)) for _, w in items], decontam.repetitions())
    around = [" ".join(rng.choice(WORDS) for _ in range(40)) for _ in range(2)]
    missed = []
    for i, own in items:
        m, k = len(own), decontam.allowed(len(own))
        third = [rng.choice(WORDS) + "x" for _ in range(k)]
        forms = {
            "head replaced": third + own[k:],
            "head deleted": own[k:],
            "head inserted into": own[:1] + third + own[1:],
            "tail replaced": own[: m - k] + third,
            "middle deleted": own[: m // 2] + own[m // 2 + k :],
            "spread": [third[j // 5] if j % 5 == 4 and j // 5 < k else w for j, w in enumerate(own)],
        }
        for name, words in forms.items():
            got = {item: d for item, d, *_ in index.matches(f"{around[0]} {' '.join(words)} {around[1]}")}
            if got.get(i, m) > k:
                missed.append((m, name))
    assert not missed
