"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from four patterns.  The field's nodes are the white-space tokens that
hold a digit, an @ or a spelled-out one (`(at)`); the tokens of one base span are one node, and so are neighbouring tokens
that together repeat the digits of one.  Its labels are the four kinds and none.  Chain edges join neighbouring tokens.  Skip
edges join, at any distance, repeated tokens (the same last DIGITS digits, or the same address however its signs are written), and
similar ones (as many digits and the same first STEM of them, the same first three numbers of an IP address, or the same name before the @): each token to
the last one before it, and to the nearest observed one on either side.  Weights are learned in numpy by pseudo-likelihood from the base labels of a
bounded sample: SAMPLE runs of at most RUN nodes, from whole texts that hold candidates, the ones of smallest hash.  In a document, tokens of base
spans are observed; loopy belief propagation over all edges labels the others, so that a
mention in another notation takes the label of the mentions it repeats.  Tokens whose
belief in a kind reaches BELIEF add spans; base spans always stay.

Edge cases: null and empty texts have no spans; texts of any length are read whole, in time
linear in their length; repeated rows and null ids are kept, each row by itself; ties of hash are ordered by the run itself; without candidates in the sample, or
in an empty table, the field adds nothing; other columns are ignored (redact keeps them as they are).
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import batches_of, map_rows, values

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
SAMPLE, RUN, SHAPES, DIGITS, STEM, BELIEF, ROUNDS = 4000, 256, 400, 7, 6, 0.8, 100
#: Kinds of edges, and where the priors of the weights of two tokens of one kind lie; data without repeats leave them there.
CHAIN, REPEAT, SIMILAR = 0, 1, 2
AGREE = (0.0, 3.0, 1.0)
#: Digits of a card or phone at most, and leading ones that a repeat may write in another way.
LONGEST, TRUNK = 19, 2
#: Tokens of more characters have one shape.
LONG = 64

Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMERIC = re.compile(r"[(\[+]{0,2}[0-9][0-9().+/_\]-]{0,40}[,;:!?]?")
_TOKEN = re.compile(r"(?<!\S)(?:[^\s0-9@(\[{]|[(\[{](?!at[)\]}]))*+(?:[0-9@]|[(\[{]at[)\]}])\S*")
_AT = re.compile(r"[(\[{]at[)\]}]", re.I)
_DOT = re.compile(r"[(\[{]dot[)\]}]", re.I)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from each @ so that no run is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)  # nothing before this @ can reach a later one
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """By kind, then start; code points, end exclusive."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", i, j) for i, j in emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) < 3 or len(p) == 3 and p <= "255" for x in m.groups()):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = "".join(_DIGIT.findall(m[0]))
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def tokens(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)] if "@" in text or _DIGIT.search(text) or _AT.search(text) else []


def nodes(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """The tokens, with those of a base span joined, and those in a row that repeat the digits of a joined or single one."""
    spans = tokens(text)
    if not spans or not base:
        return spans
    starts, ends = [i for i, _ in spans], [j for _, j in spans]
    last = list(range(len(spans)))  # the last token of the node that begins at a token
    inside = [False] * len(spans)
    endings: set[str] = set()  # of all mentions' digits
    for kind, i, j in base:
        low, high = bisect_right(ends, i), bisect_left(starts, j) - 1
        if low > high:
            continue
        last[low] = max(last[low], high)
        inside[low : high + 1] = [True] * (high + 1 - low)
        if kind in ("card", "phone"):
            digits = "".join(_DIGIT.findall(text[i:j]))
            endings.update(digits[n:] for n in range(len(digits) - DIGITS + 1))
    k = len(spans) - 1
    while endings and k >= 0:
        first, joined = k, ""
        found = k
        while first >= 0 and not inside[first] and len(joined) <= LONGEST and (first == k or starts[first + 1] - ends[first] == 1) and _NUMERIC.fullmatch(text, *spans[first]):
            joined = "".join(_DIGIT.findall(text[starts[first] : ends[first]])) + joined
            if any(joined[n:] in endings for n in range(TRUNK + 1)):
                found = first
            first -= 1
        last[found] = max(last[found], k)
        k = found - 1
    out, k = [], 0
    while k < len(spans):
        end, at = last[k], k
        while at < end:
            at += 1
            end = max(end, last[at])
        out.append((starts[k], ends[end]))
        k = end + 1
    return out


def shape(token: str) -> str:
    """Digits as 0, runs of letters as a, spelled-out signs of addresses as those signs, other characters as they are; tokens of over LONG characters are alike."""
    if len(token) > LONG:
        return "long"
    if "@" not in token:
        token = _DOT.sub(".", _AT.sub("@", token))
    return re.sub(r"[0-9]", "0", re.sub(r"[^\W\d_]+", "a", token))


def keys_of(token: str) -> tuple[str | None, str | None, str]:
    """What repeated tokens share, what similar ones share, and the last digits, last first."""
    plain = _AT.sub("@", token)
    if "@" in plain:
        address = _DOT.sub(".", plain).strip(".,;:()<>[]{}\"'").lower()
        name = re.sub(r"[^a-z0-9]", "", address.partition("@")[0])
        return address, "@" + name if len(name) > 3 else None, ""
    digits = "".join(_DIGIT.findall(token))
    if m := _IP.search(token):
        return digits[-DIGITS:] if len(digits) >= DIGITS else None, ".".join(m.groups()[:3]), digits[: -2 * LONGEST : -1]
    if len(digits) < DIGITS:
        return None, None, ""
    return digits[-DIGITS:], f"{len(digits)}:{digits[:STEM]}", digits[: -2 * LONGEST : -1]


def features(text: str, spans: list[tuple[int, int]]) -> list[list[str]]:
    shapes = [shape(text[i:j]) for i, j in spans]
    out = []
    for k, (i, j) in enumerate(spans):
        numbers = "".join(_DIGIT.findall(text[i:j]))
        sound = f"l:{luhn(numbers)}" if 13 <= len(numbers) <= LONGEST else "-l"  # a card's check digit
        near = lambda o: abs(o - k) == 1 and 0 <= o < len(spans) and min(abs(spans[o][0] - j), abs(i - spans[o][1])) <= 1
        out.append(["bias", "s:" + shapes[k], "c:" + re.sub(r"0+", "0", shapes[k]), f"n:{min(len(numbers), 20)}", sound, "@" if "@" in shapes[k] else "-@", "p:" + (shapes[k - 1] if near(k - 1) else ""), "f:" + (shapes[k + 1] if near(k + 1) else "")])
    return out


def edges(text: str, spans: list[tuple[int, int]], known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of nodes, earlier first, the kind of each edge, and its strength: of repeated digits where one is
    observed, shared last digits in DIGITS; unobserved neighbours of the list have no skip edge."""
    found: dict[tuple[int, int], tuple[int, float]] = {}
    all_keys = [keys_of(text[i:j]) for i, j in spans]
    seen = (known != NONE).tolist()

    def join(a: int, b: int, kind: int) -> None:
        observed_ = seen[a] or seen[b]
        if (a, b) in found or not observed_ and b - a == 1:
            return
        digits = kind == REPEAT and observed_ and "@" not in (all_keys[a][0] or "")
        found[a, b] = kind, min(LONGEST, len(commonprefix((all_keys[a][2], all_keys[b][2])))) / DIGITS if digits else 1.0

    for kind, at in ((REPEAT, 0), (SIMILAR, 1)):
        last: dict[str, int] = {}
        mark: dict[str, int] = {}  # the last observed one
        waiting: dict[str, list[int]] = {}  # those before the first observed one
        for k, own in enumerate(all_keys):
            if (key := own[at]) is None:
                continue
            if key in last:
                join(last[key], k, kind)
            if seen[k]:
                for w in waiting.pop(key, ()):
                    join(w, k, kind)
                mark[key] = k
            elif key in mark:
                join(mark[key], k, kind)
            else:
                waiting.setdefault(key, []).append(k)
            last[key] = k
    chain = [(k - 1, k) for k in range(1, len(spans)) if spans[k][0] - spans[k - 1][1] <= 1]
    out = np.array([*chain, *found], np.int64).reshape(-1, 2)
    return out, np.array([CHAIN] * len(chain) + [k for k, _ in found.values()], np.int64), np.array([1.0] * len(chain) + [s for _, s in found.values()])


def observed(spans: list[tuple[int, int]], base: list[Span]) -> np.ndarray:
    """The label of each token: the kind of the first base span that overlaps it, else NONE."""
    out = np.full(len(spans), NONE)
    starts, ends = [i for i, _ in spans], [j for _, j in spans]
    for kind, i, j in reversed(base):
        out[bisect_right(ends, i) : bisect_left(starts, j)] = KINDS.index(kind)
    return out


@dataclass
class Field:
    index: dict[str, int]
    unary: np.ndarray
    pair: np.ndarray  # by kind of edge, label of the earlier node, label of the later node

    def marginals(self, text: str, spans: list[tuple[int, int]], known: np.ndarray) -> np.ndarray:
        """Beliefs by loopy sum-product; known labels are observed."""
        unary = np.zeros((len(spans), NONE + 1))
        for k, own in enumerate(features(text, spans)):
            for f in own:
                if (at := self.index.get(f)) is not None:
                    unary[k] += self.unary[at]
        seen = known != NONE
        unary[seen] = -30.0
        unary[np.flatnonzero(seen), known[seen]] = 0.0
        ends, kind, strength = edges(text, spans, known)
        if not len(ends):
            return _softmax(unary)
        pair = np.exp(self.pair[kind] * strength[:, None, None])
        right = np.zeros((len(ends), NONE + 1))  # message to the later node
        left = np.zeros((len(ends), NONE + 1))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, ends[:, 1], right)
            np.add.at(belief, ends[:, 0], left)
            a = _softmax(belief[ends[:, 0]] - left)
            b = _softmax(belief[ends[:, 1]] - right)
            new_right = np.log(np.einsum("ei,eij->ej", a, pair) + 1e-30)
            new_left = np.log(np.einsum("ej,eij->ei", b, pair) + 1e-30)
            new_right -= new_right.max(axis=1, keepdims=True)
            new_left -= new_left.max(axis=1, keepdims=True)
            moved = max(np.abs(new_right - right).max(), np.abs(new_left - left).max())
            right, left = 0.5 * (right + new_right), 0.5 * (left + new_left)
            if moved < 1e-4:
                break
        np.add.at(unary, ends[:, 1], right)
        np.add.at(unary, ends[:, 0], left)
        return _softmax(unary)

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Spans of tokens outside base spans that the field labels, neighbours of a kind joined."""
        spans = nodes(text, base)
        if not spans or not self.index:
            return []
        known = observed(spans, base)
        if (known != NONE).all():
            return []
        belief = self.marginals(text, spans, known)
        label = np.where(belief[:, :NONE].max(axis=1) >= BELIEF, belief[:, :NONE].argmax(axis=1), NONE)
        label[known != NONE] = NONE
        out: list[Span] = []
        for k, (i, j) in enumerate(spans):
            if label[k] == NONE:
                continue
            while i < j and not (text[i].isalnum() or text[i] in "+("):
                i += 1
            while i < j and not (text[j - 1].isalnum() or text[j - 1] == ")"):
                j -= 1
            if i == j:
                continue
            if out and out[-1][0] == KINDS[label[k]] and k and label[k - 1] == label[k] and i - out[-1][2] <= 1:
                out[-1] = (out[-1][0], out[-1][1], j)
            else:
                out.append((KINDS[label[k]], i, j))
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


#: A run of nodes: features and labels of each, and edges inside it.
Example = tuple[list[list[str]], list[int], np.ndarray, np.ndarray, np.ndarray]


def examples(text: str) -> Iterator[Example]:
    """The text's nodes with their base labels, in runs of RUN."""
    base = base_spans(text)
    alone, joined = tokens(text), nodes(text, base)
    # Both as joined nodes and as tokens: a mention that no pattern finds is read by token.
    for spans in (joined, alone) if alone != joined else (joined,):
        if not spans:
            continue
        known, own = observed(spans, base), features(text, spans)
        ends, kind, strength = edges(text, spans, known)
        order = np.argsort(ends[:, 1], kind="stable")
        ends, kind, strength = ends[order], kind[order], strength[order]
        for i in range(0, len(spans), RUN):
            part = slice(*np.searchsorted(ends[:, 1], (i, i + RUN)))
            both = ends[part, 0] >= i
            yield own[i : i + RUN], known[i : i + RUN].tolist(), ends[part][both] - i, kind[part][both], strength[part][both]


def train(found: Iterable[Example], steps: int = 150, rate: float = 0.3, ridge: float = 1e-3) -> Field:
    """Weights by pseudo-likelihood: each label given its features and the labels at its edges."""
    rows, labels, context = [], [], []
    kinds = len(AGREE)
    for own, known, ends, kind, strength in found:
        rows += own
        labels += known
        near = np.zeros((len(own), 2 * kinds, NONE + 1))  # by kind of edge: before, after
        for (a, b), e, w in zip(ends.tolist(), kind.tolist(), strength.tolist()):
            near[b, 2 * e, known[a]] += w
            near[a, 2 * e + 1, known[b]] += w
        context.append(near)
    if not labels or set(labels) == {NONE}:
        return Field({}, np.zeros((0, NONE + 1)), np.zeros((kinds, NONE + 1, NONE + 1)))
    times: dict[str, int] = {}
    for own in rows:
        for f in own:
            times[f] = times.get(f, 0) + 1
    chosen = sorted((f for f, n in times.items() if n >= 3), key=lambda f: (-times[f], f))[: 8 * SHAPES]
    index = {f: i for i, f in enumerate(chosen)}
    at = [(k, index[f]) for k, own in enumerate(rows) for f in own if f in index]
    node, column = np.array([k for k, _ in at]), np.array([i for _, i in at])
    near = np.concatenate(context)
    want = np.eye(NONE + 1)[labels]
    unary = np.zeros((len(index), NONE + 1))
    prior = np.zeros((kinds, NONE + 1, NONE + 1))
    for e, w in enumerate(AGREE):
        prior[e, range(NONE), range(NONE)] = w
    pair = prior.copy()
    sums = [np.full_like(unary, 1e-8), np.full_like(pair, 1e-8)]
    n = len(labels)
    for _ in range(steps):
        score = np.zeros((n, NONE + 1))
        np.add.at(score, node, unary[column])
        for e in range(kinds):
            score += near[:, 2 * e] @ pair[e] + near[:, 2 * e + 1] @ pair[e].T
        miss = (want - _softmax(score)) / n
        grad = np.zeros_like(unary)
        np.add.at(grad, column, miss[node])
        grad -= ridge * unary / n
        slope = np.stack([near[:, 2 * e].T @ miss + miss.T @ near[:, 2 * e + 1] for e in range(kinds)]) - ridge * (pair - prior) / n
        for w, g, s in ((unary, grad, sums[0]), (pair, slope, sums[1])):
            s += g * g
            w += rate * g / np.sqrt(s)
    return Field(index, unary, pair)


def fit(df: DataFrame) -> Field:
    """The field of the rows of text: the SAMPLE runs of smallest hash among those of about SAMPLE texts that hold candidates."""
    rows = df.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("h")).where(F.col("text").rlike("[0-9@]"))
    n = rows.count()
    if not n:
        return train([])
    rate = min(1.0, SAMPLE / n)
    got = rows.where(F.pmod("h", F.lit(1 << 30)) <= int(rate * (1 << 30))).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only features of nodes go to the driver, of bounded length each.
        def out() -> Iterator[tuple]:
            for b in batches:
                for text in values(b.column(0)):
                    for own in examples(text):
                        data = pickle.dumps(own)
                        yield xxhash.xxh64_intdigest(data) >> 1, data

        yield from batches_of(out(), pa.schema([("h", pa.int64()), ("run", pa.binary())]))

    kept = got.mapInArrow(run, "h long, run binary").orderBy("h", "run").limit(SAMPLE)
    return train(pickle.loads(r["run"]) for r in kept.collect())


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{i}:{j}" for k, i, j in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find(df: DataFrame, field: Field) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end in code points) for every row of doc_id, text."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    sent = df.sparkSession.sparkContext.broadcast(field)  # at most 8 * SHAPES features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                for doc_id, text in zip(values(b.column(0)), values(b.column(1))):
                    base = base_spans(text or "")
                    every = base + sent.value.added(text or "", base)
                    yield doc_id, *([{"kind": k, "start": i, "end": j} for k, i, j in sorted(own, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))] for own in (base, every))

        yield from batches_of(rows(), pa.schema([("doc_id", pa.int64()), ("base", span), ("spans", span)]))

    kind = "array<struct<kind:string,start:long,end:long>>"
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, base {kind}, spans {kind}")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digest of base spans, all spans as a string, and their number."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [number(k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones as one, replaced by its kind in angle brackets."""
    out, at = [], 0
    for kind, i, j in sorted(spans, key=lambda s: (s[1], -s[2])):
        if i >= at:
            out += [text[at:i], f"<{kind.upper()}>"]
        at = max(at, j)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, field: Field) -> DataFrame:
    """df, all columns, with spans masked in text; null texts stay null."""
    names, sent = df.columns, df.sparkSession.sparkContext.broadcast(field)
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = []
            for text in values(b.column(at)):
                base = base_spans(text or "")
                spans = base + sent.value.added(text or "", base)
                new.append(masked(text, spans) if spans else text)
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    return map_rows(df, run)
