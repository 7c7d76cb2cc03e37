r"""Chat formatting in budgeted, turn-aligned windows.

A turn is written as a line `### role:`, its text and a line `</turn>`.  Inside texts and roles, a
control string (`###`, `</turn>`) gets a backslash before it, and backslashes that
already stand before it are doubled; so `unescape` is exact.
A turn's cost is its number of tokens (of the counter given; words if none is) plus OVERHEAD.  Prefix sums of the costs choose
spans: a window holds as many new turns as the budget leaves beside the system
turn (the leading turn of role system, kept in every window) and the repeated history (the last turns
before the window, as many as HISTORY of the budget holds).  The loss mask covers the texts of
new assistant turns; repeated ones are masked out.  A turn dearer than the budget stands in a
window of its own, whole.  A system turn dearer than SYSTEM of the budget stands once, as a new turn, and isn't repeated.

No task holds a conversation.  Turns are sorted by ranges of (id, turn), so that a long conversation lies in many partitions; a row for each
partition tells the others what its last conversation has cost so far, which gives every turn its prefix sum.  Those cut conversations into blocks of BLOCK budgets,
and each block, with its conversation's system turn and the history before it, is cut into windows by a task of its own.  History that reaches
over a block's border counts from that border.

Edge cases: null texts and roles are empty; null ids form one conversation of null id; turns
of equal number are ordered by role and text, nulls first; repeated rows are turns of their own; very long texts are written whole; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import batches_of, checkpoint, groups_of, values

BUDGET, HISTORY, SYSTEM, OVERHEAD = 1024, 0.25, 0.5, 4
#: Budgets of a block of turns.
BLOCK = 64
#: Windows of a block at most, from which the next block's are numbered.
STRIDE = 1 << 20

#: role, text and cost
Turn = tuple[str, str, int]

OPEN, MIDDLE, CLOSE = "### ", ":\n", "\n</turn>\n"
#: Where a text could be read as control: either string, with any backslashes before it.
_CONTROL = re.compile(r"(\\*)(###|</turn>)")

SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()), ("n_kept", pa.int64()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("tokens", pa.int64()),
])
DDL = "conv_id long, window long, text string, n_kept long, loss array<struct<start:long,end:long>>, tokens long"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[1] * 2 + "\\" + m[2], text)


def unescape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)


def words_of(text: str) -> int:
    return len(text.split())


def _role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A").replace(":", "%3A")


def _unrole(role: str) -> str:
    return unescape(role.replace("%3A", ":").replace("%0A", "\n").replace("%25", "%"))


def write(kept: list[tuple[str, str]], fresh: list[tuple[str, str]]) -> tuple[str, list[dict]]:
    """A window's text, and the spans of the new assistant texts in it."""
    parts, loss, at = [], [], 0
    for i, (role, text) in enumerate([*kept, *fresh]):
        head, body = OPEN + _role(role) + MIDDLE, escape(text)
        if i >= len(kept) and role == "assistant":
            loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), loss


def read(text: str) -> list[tuple[str, str]]:
    """The turns of a window's text: the inverse of write(). Inside a turn every control string is escaped, so the next CLOSE ends it."""
    out = []
    at = 0
    while at < len(text):
        colon = text.index(MIDDLE, at + len(OPEN))
        end = text.index(CLOSE, colon + len(MIDDLE))
        out.append((_unrole(text[at + len(OPEN) : colon]), unescape(text[colon + len(MIDDLE) : end])))
        at = end + len(CLOSE)
    return out


def windows(turns: Sequence[Turn], budget: int = BUDGET, history: float = HISTORY, system: Turn | None = None, past: Sequence[Turn] = ()) -> Iterator[tuple[list, list, int]]:
    """(kept turns, new turns, tokens) of each window of a block's turns.

    system: the conversation's, if the block doesn't begin with it; past: the turns before the block that may be repeated.
    """
    every = [*past, *turns]
    sums = np.concatenate(([0], np.cumsum([c for _, _, c in every]))).astype(np.int64)
    leads = system is None and not past and bool(turns) and keeps(turns[0], budget)
    if leads:
        system = turns[0]
    at = len(past)
    while at < len(every):
        kept, base = [], 0
        if at or not leads:
            kept, base = ([system], system[2]) if system else ([], 0)
            first = max(int(np.searchsorted(sums, sums[at] - int(history * budget))), int(leads))
            more = int(sums[at] - sums[first])
            if base + more + every[at][2] <= budget:  # a dear turn comes before the history
                kept, base = [*kept, *every[first:at]], base + more
        end = max(at + 1, int(np.searchsorted(sums, sums[at] + budget - base, "right")) - 1)
        yield [t[:2] for t in kept], [t[:2] for t in every[at:end]], base + int(sums[end] - sums[at])
        at = end


def keeps(turn: Turn, budget: int) -> bool:
    """Whether a leading turn is a system turn that is repeated."""
    return turn[0] == "system" and turn[2] <= SYSTEM * budget


_TURNS = pa.schema([("conv_id", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("cost", pa.int64())])
_DEALT = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("place", pa.int64()), *list(_TURNS)[1:]])


def _rows(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple]:
    for b in batches:
        for i in range(0, b.num_rows, 512):
            yield from zip(*(values(b.column(c).slice(i, 512)) for c in range(columns)))


def prefixed(turns: DataFrame, budget: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]:
    """A function from the rows of a partition of turns (checkpointed, sorted) to (id, prefix sum before the turn, system turn, role, text, cost)."""

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, now, total, single, lead = None, None, 0, True, None
        n = 0
        for conv, role, text, cost in _rows(batches, 4):
            if not n:
                first = now = conv
            elif conv != now:
                now, total, single, lead = conv, 0, False, None
            if not total:
                lead = (role, text, cost)
            total += cost
            n += 1
        if n:
            role, text, cost = lead if keeps(lead, budget) else (None, None, None)
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "first": [first], "now": [now], "total": [total], "single": [single], "role": [role], "text": [text], "cost": [cost]}, pa.schema([("part", pa.int64()), ("first", pa.int64()), ("now", pa.int64()), ("total", pa.int64()), ("single", pa.bool_()), *list(_TURNS)[1:]]))

    carried: dict[int, tuple[int, Turn | None]] = {}  # by partition: what its first conversation has cost before it, and its system turn
    before = None
    for r in sorted(turns.mapInArrow(last, "part long, first long, now long, total long, single boolean, role string, text string, cost long").collect()):
        spent, lead = 0, (r["role"], r["text"], r["cost"]) if r["role"] is not None else None
        if before is not None and before[0] == r["first"]:
            carried[r["part"]] = before[1], before[2]
            if r["single"]:
                spent, lead = before[1], before[2]
        before = r["now"], spent + r["total"], lead
    sent = turns.sparkSession.sparkContext.broadcast(carried)  # an entry for each partition, with a system turn of at most SYSTEM of the budget

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, total, lead, n = None, 0, None, 0
        for conv, role, text, cost in _rows(batches, 4):
            if not n and (found := sent.value.get(TaskContext.get().partitionId())):
                now, (total, lead) = conv, found
            elif not n or conv != now:
                now, total, lead = conv, 0, None
            if not total and keeps((role, text, cost), budget):
                lead = role, text, cost
            n += 1
            yield conv, total, lead, role, text, cost
            total += cost

    return run


def format_conversations(df: DataFrame, budget: int = BUDGET, history: float = HISTORY, count: Callable[[str], int] = words_of) -> DataFrame:
    """conv_id, window, text, n_kept (leading repeated turns), loss (spans of text), tokens; windows rise in order, from 0, a block's from STRIDE times its number."""
    keys = ["conv_id", "turn", "role", "text"]
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array([count(t) + OVERHEAD for t in values(b.column(3))], pa.int64())], schema=_TURNS)

    turns = checkpoint(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(measure, "conv_id long, role string, text string, cost long"))
    sums = prefixed(turns, budget)
    size, reach = BLOCK * budget, int(history * budget)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for conv, start, lead, role, text, cost in sums(batches):
                block = (start + cost - 1) // size
                if start and lead and (start - 1) // size < block:
                    yield conv, block, 0, -1, *lead
                yield conv, block, 2, start, role, text, cost
                if start >= (block + 1) * size - reach:
                    yield conv, block + 1, 1, start, role, text, cost

        yield from batches_of(out(), _DEALT)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for (conv, block), own in groups_of(batches, ["conv_id", "block"]):
                parts: list[list[Turn]] = [[], [], []]
                for r in own:
                    parts[r["kind"]].append((r["role"], r["text"], r["cost"]))
                system, past, new = parts
                for i, (kept, fresh, tokens) in enumerate(windows(new, budget, history, system[0] if system else None, past)):
                    text, loss = write(kept, fresh)
                    yield conv, block * STRIDE + i, text, len(kept), loss, tokens

        yield from batches_of(out(), SCHEMA)

    dealt = turns.mapInArrow(deal, "conv_id long, block long, kind int, place long, role string, text string, cost long")
    return dealt.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "kind", "place").mapInArrow(cut, DDL)


def digest(formatted: DataFrame) -> DataFrame:
    """What the windows of format_conversations() hold, read back: a row for each conversation.

    A digest reads a conversation's windows in order, so one task streams them, a window at a time.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for (conv,), own in groups_of(batches, ["conv_id"]):
                turns = hashlib.sha256()
                loss = hashlib.sha256()
                n = chars = size = count = 0
                for w in own:
                    for role, text in read(w["text"])[w["n_kept"] :]:
                        turns.update(f"{role}\n{text}\n".encode())
                        n += 1
                    for span in w["loss"]:
                        text = unescape(w["text"][span["start"] : span["end"]])
                        loss.update(text.encode())
                        chars += len(text)
                    size += len(w["text"])
                    count += 1
                yield conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, count

        yield from batches_of(out(), schema)

    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")
