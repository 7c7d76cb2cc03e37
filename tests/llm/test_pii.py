import hashlib
import itertools
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2]) and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0 or 13 <= len(d) <= 19 and not any(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["a", "a@b.c", "@", ".", "b.c", "1", "12", "255.", "1.2.3.4", "+1", " ", "-", "(", ")", "4111 1111-1111 1111", "000000000000000", "é", "+1 (456) 555-2186", "%", "256"]), max_size=12).map("".join))
def test_base_matches_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    began = time.time()
    for c in ("a", "1", "1.", "@", "a@", "+1", "1 ", ".", "a1"):
        pii.base_spans(c * 200_000)
        pii.tokens(c * 200_000)
    assert time.time() - began < 20


def _trained(texts):
    return pii.train(x for t in texts for x in pii.examples(t))


def _texts():
    out = []
    for i in range(120):
        phone = f"+1 ({200 + i}) 555-{1000 + 37 * i % 9000:04d}"
        out.append(f"word mail a{i}.b@mail{i % 9}.example.com then {phone} and 10.2.{i}.7 end item {i} of 40 code x{i}y " + ("again " + phone if i % 2 else ""))
    return out


def test_repeated_mentions_share_their_label():
    field = _trained(_texts())
    text = "call +1 (456) 555-2186 now. " + "word " * 300 + "or (456) 555-2186 later, room 12 and 1234567"
    base = pii.base_spans(text)
    added = pii.Field.added(field, text, base)
    assert [k for k, _, _ in base] == ["phone"]
    assert [(k, text[i:j]) for k, i, j in added] == [("phone", "(456) 555-2186")]
    assert pii.masked(text, base + added).count("<PHONE>") == 2


def test_query_columns(spark):
    rows = [(1, _texts()[1], "x"), (1, _texts()[1], "x"), (2, None, None), (3, "", "x"), (None, "a@b.co", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    field = pii.fit(df)
    got = [tuple(r) for r in pii.digest(pii.find(df, field)).collect()]
    assert len(got) == 5
    one = [g for g in got if g[0] == 1]
    assert one[0] == one[1] and one[0][1:5] == (1, 1, 0, 2)
    assert one[0][5] == hashlib.sha256(pii.listed(pii.base_spans(rows[0][1])).encode()).hexdigest()
    assert [g[1:5] for g in got if g[0] in (2, 3)] == [(0, 0, 0, 0)] * 2
    assert sorted(str(r.text) for r in pii.redact(df, field).collect())[1] == "<EMAIL>"
    assert pii.find(df.limit(0), pii.fit(df.limit(0))).count() == 0


def test_mentions_in_groups_are_linked():
    texts = _texts()
    for i in range(120):
        card = next(f"4{i:03d} 1111 2222 {n:04d}" for n in range(1000, 1100) if pii.luhn(f"4{i:03d}11112222{n:04d}"))
        texts[i] += f" pay by {card} or ring +44 20 {7000 + i} {1000 + 13 * i} today" + (f" and {card} too" if i % 3 == 0 else "")
    field = _trained(texts)
    for mention, again, kind in (
        ("4111 1111 1111 1111", "4111.1111.1111.1111", "card"),
        ("+44 20 7946 0958", "44-20-7946-0958", "phone"),
        ("+44 20 7946 0958", "020 7946 0958", "phone"),
        ("+44 20 7946 0958", "44 20 7946 0958", "phone"),
    ):
        text = f"first {mention} here. " + "word " * 300 + f"then {again} later, room 12 of 40"
        base = pii.base_spans(text)
        assert [k for k, _, _ in base] == [kind]
        added = field.added(text, base)
        assert [(k, text[i:j]) for k, i, j in added] == [(kind, again)], again


def test_other_spellings_and_similar_tokens():
    field = _trained(_texts())
    text = "write jane.doe@mail.example.com now. " + "word " * 200 + "or jane.doe(at)mail[dot]example.com again, item 12"
    base = pii.base_spans(text)
    assert [(k, text[i:j]) for k, i, j in field.added(text, base)] == [("email", "jane.doe(at)mail[dot]example.com")]
    known = pii.observed(pii.tokens(text), base)
    ends, kind, _ = pii.edges(text, pii.tokens(text), known)
    assert [tuple(e) for e, k in zip(ends.tolist(), kind.tolist()) if k == pii.REPEAT] == [(0, 1)]
    text = "from 10.2.3.4 x 10.2.3.77 x 4111111111111111 x 4111119999999999 x jo.hn@a.example x john@b.example"
    ends, kind, _ = pii.edges(text, spans := pii.tokens(text), pii.observed(spans, pii.base_spans(text)))
    assert [tuple(e) for e, k in zip(ends.tolist(), kind.tolist()) if k == pii.SIMILAR] == [(0, 1), (2, 3), (4, 5)]
    # A similar token alone is no mention: the tokens' own features decide.
    assert [(k, i) for k, i, _ in field.added("card 4111 1111 1111 1111 x order 4111119999999998 x", [("card", 5, 24)]) if k == "phone"] == []


def _exact(unary, ends, pair, strength):
    """Marginals by summing over all labellings."""
    n, labels = unary.shape
    out = np.zeros((n, labels))
    for own in itertools.product(range(labels), repeat=n):
        w = np.exp(sum(unary[k, x] for k, x in enumerate(own)) + sum(s * p[own[a], own[b]] for (a, b), p, s in zip(ends, pair, strength)))
        for k, x in enumerate(own):
            out[k, x] += w
    return out / out.sum(axis=1, keepdims=True)


def test_marginals_against_all_labellings():
    field = _trained(_texts())
    for text, exact in (
        ("a1 +1 (205) 555-1185 x b2 word 205-555-1185", 1e-3),  # a tree
        ("+1 (205) 555-1185 x 205-555-1185 y 205.555.1185", 0.12),  # a loop
        ("10.2.3.4 x 10.2.3.9 12 10.2.3.300", 0.12),
    ):
        base = pii.base_spans(text)
        spans = pii.nodes(text, base)
        known = pii.observed(spans, base)
        ends, kind, strength = pii.edges(text, spans, known)
        unary = np.zeros((len(spans), pii.NONE + 1))
        for k, own in enumerate(pii.features(text, spans)):
            for f in own:
                if f in field.index:
                    unary[k] += field.unary[field.index[f]]
        seen = known != pii.NONE
        unary[seen] = -30.0
        unary[np.flatnonzero(seen), known[seen]] = 0.0
        assert len(ends)
        got = field.marginals(text, spans, known)
        assert np.abs(got - _exact(unary, ends.tolist(), field.pair[kind], strength)).max() < exact


def test_a_label_travels_along_many_repeats():
    field = _trained(_texts())
    text = "+1 (456) 555-2186 " + " ".join(f"word 456-555-2186 w{'x' * (k % 5)}" for k in range(60))
    base = pii.base_spans(text)
    assert len([k for k, _, _ in field.added(text, base) if k == "phone"]) == 60


def test_many_mentions_take_linear_time():
    field = _trained(_texts())
    for one in ("a{}@b{}.example ", "+1 (456) 555-{} ", "+{}1234567 ", "10.2.3.{} "):
        text = "".join(one.replace("{}", str(1000 + i) if "+1 " in one else str(i)) for i in range(50_000))
        began = time.time()
        base = pii.base_spans(text)
        field.added(text, base)
        assert time.time() - began < 20


def test_long_tokens_and_samples(spark, monkeypatch):
    monkeypatch.setattr(pii, "RUN", 7)
    text = " ".join(_texts()[:30]) + " " + "x1" * 50_000 + " " + "9" * 100
    runs = list(pii.examples(text))
    assert all(len(r[0]) <= 7 and len(r[0]) == len(r[1]) for r in runs) and len(runs) > 10
    assert {f for r in runs for own in r[0] for f in own if "long" in f}
    monkeypatch.setattr(pii, "SAMPLE", 5)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(_texts())], "doc_id long, text string")
    one, two = pii.fit(df), pii.fit(df.orderBy(df.text.desc()))
    assert one.index == two.index and np.allclose(one.unary, two.unary)
