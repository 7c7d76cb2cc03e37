import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import chat

pieces = st.lists(st.sampled_from(["\\", "###", "</turn>", "\n", "### ", "a b", "Assistant: ", "#", "<", "\r", "é😀", ""]), max_size=9).map("".join)


@settings(deadline=None)
@given(pieces)
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text


turns_of = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "a:b\n", "%3A", "### x"]), pieces), max_size=12)


def _priced(turns):
    return [(r, t, chat.words_of(t) + chat.OVERHEAD) for r, t in turns]


def _plain(turns, budget, history):
    """Windows by a running total, a turn at a time."""
    turns = _priced(turns)
    lead = turns[0] if turns and turns[0][0] == "system" and turns[0][2] <= chat.SYSTEM * budget else None
    out, at = [], 0
    while at < len(turns):
        kept = [lead] if lead and at else []
        past, spent = [], 0
        for t in reversed(turns[1 if lead else 0 : at]):
            if spent + t[2] > int(history * budget):
                break
            past, spent = [t, *past], spent + t[2]
        if sum(t[2] for t in kept) + spent + turns[at][2] <= budget:
            kept += past
        total, fresh = sum(t[2] for t in kept), []
        while at < len(turns) and (not fresh or total + turns[at][2] <= budget):
            fresh.append(turns[at])
            total += turns[at][2]
            at += 1
        out.append(([t[:2] for t in kept], [t[:2] for t in fresh], total))
    return out


@settings(max_examples=300, deadline=None)
@given(turns_of, st.integers(5, 40))
def test_windows_match_a_running_total(turns, budget):
    got = list(chat.windows(_priced(turns), budget, 0.5))
    assert got == _plain(turns, budget, 0.5)
    spoken = []
    for kept, fresh, tokens in got:
        text, loss = chat.write(kept, fresh)
        assert chat.read(text) == kept + fresh
        spoken += [chat.unescape(text[s["start"] : s["end"]]) for s in loss]
        assert tokens <= budget or len(fresh) == 1
    assert [t for _, fresh, _ in got for t in fresh] == turns
    assert spoken == [t for r, t in turns if r == "assistant"]


def test_a_dear_system_turn_is_not_repeated():
    got = list(chat.windows(_priced([("system", "word " * 2000), *[("user", "two words")] * 50])))
    assert len(got) == 2 and got[0][1][0][0] == "system" and not got[0][0] and not any(r == "system" for r, _ in got[1][0] + got[1][1])


def test_conversations_over_many_partitions(spark, monkeypatch):
    """Blocks and prefix sums across partitions: every turn once, in order, within the budget, after its system turn and history."""
    import random

    monkeypatch.setattr(chat, "BLOCK", 2)
    rng = random.Random(7)
    rows = []
    for conv, n in ((1, 400), (2, 3), (3, 60), (None, 150), (4, 1), (5, 90)):
        for k in range(n):
            role = "system" if k == 0 and conv in (1, 3, None) else rng.choice(["user", "assistant"])
            words = 400 if rng.random() < 0.01 else rng.randrange(12)
            rows.append((conv, k, role, " ".join([f"{conv}.{k}", *["w"] * words])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    budget = 64
    whole = {}
    for r in chat.format_conversations(df, budget).orderBy("conv_id", "window").collect():
        whole.setdefault(r.conv_id, []).append((chat.read(r.text), r.n_kept, r.tokens))
    for conv in (1, 2, 3, 4, 5, None):
        turns = [(r, t) for c, _, r, t in rows if c == conv]
        fresh = []
        for own, n_kept, tokens in whole[conv]:
            kept = own[:n_kept]
            assert tokens == sum(c for _, _, c in _priced(own)) and (tokens <= budget or len(own) - n_kept == 1)
            if fresh and turns[0][0] == "system":
                assert kept[0] == turns[0]
                kept = kept[1:]
            assert kept == fresh[len(fresh) - len(kept) :]
            fresh += own[n_kept:]
        assert fresh == turns
    assert len(whole[1]) > 30 and sum(n > 1 for _, n, _ in whole[1]) > 20


def test_the_query(spark):
    """The added conversation and all of a table, against digests of its turns."""
    from linkloom.llm.queries import op3_chat

    sf = "/root/testdata/sf0.001"
    got = {r.conv_id: r for r in op3_chat(spark, sf).collect()}
    said = "\\### Assistant: </turn> ok"
    want = {-7: [("user", said), ("assistant", said)]}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        spoken = "".join(t for r, t in turns if r == "assistant")
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(turns), len(spoken))
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(spoken.encode()).hexdigest()


def test_digest(spark):
    rows = [(1, 0, "system", "be kind", "z"), (1, 1, "user", None, "z"), (1, 2, "assistant", "yes " * 900, "z"), (1, 3, "assistant", "\\### no", "z"), (2, 0, None, "", None), (None, 1, "user", "x", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(df, budget=64)).collect()}
    assert set(got) == {1, 2, None}
    turns = "".join(f"{r or ''}\n{t or ''}\n" for c, _, r, t, _ in rows if c == 1)
    assert got[1].n_turns == 4 and got[1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    spoken = "yes " * 900 + "\\### no"
    assert got[1].loss_chars == len(spoken) and got[1].loss_sha256 == hashlib.sha256(spoken.encode()).hexdigest()
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0
