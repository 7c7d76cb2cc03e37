"""Toxicity from a weighted lexicon, matched by an Aho-Corasick automaton over folded text.

Folding: lower case, compatibility forms and accented letters to plain ones, invisible characters out, homoglyphs to Latin letters, letters
spelled with signs between them joined, digits and signs that stand for
letters inside a word to those letters, words between single spaces.  The lexicon
holds whole words and beginnings of words; the weight of an entry is its smoothed
log odds between toxic and clean texts.  A match counts nothing inside an exception
phrase (two words, one of them an entry, seen in clean texts more than in toxic
ones, or given).  A logistic curve over the summed weight, and that weight divided
by the logarithm of the length in words, gives the score.

Everything learned comes from a bounded sample: about SAMPLE labelled rows of
either class, chosen by a hash of the id; equal texts count once.  The lexicon keeps the ENTRIES entries with most toxic texts.

Edge cases: null and empty texts score as a text without matches; texts of any length are read whole, in time linear in length and matches; several labels for
an id count as toxic if one of them does; null labels and ids teach nothing; with no toxic
or no clean row every score is 0, as with empty tables; ties between entries go to the alphabetically first; repeated rows are scored each by itself; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import checkpoint, values

SAMPLE = 6000
#: Entries need so many toxic texts, and so many times the clean rate; letters of word beginnings.
SUPPORT, ODDS = 4, 12.0
BEGINNINGS = (4, 5, 6)
#: Largest lexicon and list of exceptions.
ENTRIES = 20_000

# Letters that look like Latin ones, and signs used in place of letters.
HOMOGLYPHS = str.maketrans({
    # Cyrillic
    "\u0430": "a", "\u0435": "e", "\u043e": "o", "\u0440": "p", "\u0441": "c", "\u0443": "y", "\u0445": "x", "\u0456": "i", "\u0458": "j", "\u0455": "s", "\u04bb": "h",
    "\u0501": "d", "\u04cf": "l", "\u043a": "k", "\u043c": "m", "\u0442": "t", "\u0432": "b", "\u043d": "h", "\u051b": "q", "\u051d": "w", "\u0475": "v", "\u04af": "y", "\u044c": "b",
    # Greek
    "\u03b1": "a", "\u03b2": "b", "\u03b5": "e", "\u03b7": "n", "\u03b9": "i", "\u03ba": "k", "\u03bd": "v", "\u03bf": "o", "\u03c1": "p", "\u03c4": "t", "\u03c5": "u", "\u03c7": "x", "\u03b3": "y", "\u03c9": "w", "\u03f2": "c", "\u03f3": "j",
    # Latin and Armenian letters without a decomposition
    "\u0131": "i", "\u0237": "j", "\u0251": "a", "\u0261": "g", "\u0269": "i", "\u026a": "i", "\u0274": "n", "\u0280": "r", "\u028f": "y", "\u0299": "b", "\u029c": "h", "\u029f": "l", "\u1d00": "a", "\u1d04": "c", "\u1d05": "d", "\u1d07": "e",
    "\u1d0a": "j", "\u1d0b": "k", "\u1d0d": "m", "\u1d0f": "o", "\u1d18": "p", "\u1d1b": "t", "\u1d1c": "u", "\u1d20": "v", "\u1d21": "w", "\u1d22": "z", "\u0142": "l", "\u00f8": "o", "\u0111": "d", "\u0127": "h", "\u0167": "t", "\u0585": "o", "\u057d": "u", "\u0578": "n",
})
SUBSTITUTES = str.maketrans("013457@$!", "oieastasi")

_MARKS = re.compile("[\u0300-\u036f]")
_UNSEEN = re.compile("[\u00ad\u034f\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]")
_SPELLED = re.compile(r"(?<![^\W_])[^\W_](?:([.*_~|-])[^\W_])(?:\1[^\W_])+(?![^\W_])")
_MIXED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[013457@$!]++(?=[^\W\d_])|(?<!\w)[013457@$]++(?=[^\W\d_]{2})")
_APART = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """' word word ... ' of the text; a single space for no words."""
    low = (text or "").lower()
    if not low.isascii():
        low = _MARKS.sub("", unicodedata.normalize("NFKD", _UNSEEN.sub("", low))).lower().translate(HOMOGLYPHS)
    low = _SPELLED.sub(lambda m: m[0].replace(m[1], ""), low)
    low = _MIXED.sub(lambda m: m[0].translate(SUBSTITUTES), low)
    return " " + _APART.sub(" ", low).strip() + " " if low else " "


def entries(folded: str) -> set[str]:
    """Whole words as ' word ', beginnings as ' begin'."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        for n in BEGINNINGS:
            if len(w) > n:
                out.add(f" {w[:n]}")
    return out


def pairs(folded: str) -> set[str]:
    w = folded.split()
    return {f" {a} {b} " for a, b in zip(w, w[1:])}


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    usable: bool = False

    def automaton(self):
        if (own := getattr(self, "_automaton", None)) is None:
            import ahocorasick

            own = ahocorasick.Automaton()
            for x, w in self.weights.items():
                own.add_word(x, (len(x), w))
            for x in self.exceptions:
                own.add_word(x, (len(x), 0.0))
            if len(own):
                own.make_automaton()
            self._automaton = own
        return own

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_automaton"}

    def weigh(self, text: str | None) -> tuple[float, float]:
        """The summed weight of matches (the heaviest at each place), and that sum normalised by length."""
        folded = fold(text)
        own = self.automaton()
        best: dict[int, float] = {}
        barred: list[tuple[int, int]] = []
        if len(own):
            for end, (n, w) in own.iter(folded):
                start = end - n + 1
                if w:
                    best[start] = max(w, best.get(start, 0.0))
                else:
                    barred.append((start, end))
        if barred:
            starts, reach = [], []  # of exceptions in order, and how far those up to each reach
            for a, b in sorted(barred):
                starts.append(a)
                reach.append(max(b, reach[-1]) if reach else b)
            best = {s: w for s, w in best.items() if not (at := bisect_right(starts, s)) or reach[at - 1] <= s}
        total = sum(best.values())
        return total, total / math.log(8.0 + folded.count(" "))

    def score(self, text: str | None) -> float:
        if not self.usable:
            return 0.0
        a, b = self.weigh(text)
        z = self.curve[0] + self.curve[1] * a + self.curve[2] * b
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method with a small ridge; the first column of x is 1."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(df: DataFrame, labels: DataFrame, given: tuple[str, ...] = ()) -> Model:
    """The model of rows doc_id, text and labels doc_id, toxic; given: exception phrases besides those learned."""
    own = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    size = {int(r[0] > 0): r[1] for r in own.groupBy(F.col("toxic")).count().collect()}
    if len(size) < 2:
        return Model()
    rate = F.when(F.col("toxic") > 0, min(1.0, SAMPLE / size[1])).otherwise(min(1.0, SAMPLE / size[0]))
    chosen = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20) < rate).select(F.col("doc_id").alias("_id"), "toxic")
    # About 2 * SAMPLE rows of 16 bytes: a proven bound.
    rows = df.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(chosen), "_id")
    texts = rows.groupBy(F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):  # a few texts' names at a time
                names, kinds, marks = [], [], []
                for text, toxic in zip(*(values(c.slice(i, 64)) for c in b.columns)):
                    folded = fold(text)
                    for kind, got in ((1, entries(folded)), (2, pairs(folded))):
                        names += got
                        kinds += [kind] * len(got)
                        marks += [toxic] * len(got)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(kinds, pa.int32()), pa.array(marks, pa.int32())], ["name", "kind", "toxic"])

    kept = checkpoint(texts)
    seen = kept.select("text", "toxic").mapInArrow(found, "name string, kind int, toxic int")
    n = {r[0]: r[1] for r in kept.groupBy("toxic").count().collect()}
    nt, nc = max(1, n.get(1, 0)), max(1, n.get(0, 0))
    counts = seen.groupBy("kind", "name").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    odds = ((F.col("t") + 0.5) / (nt + 1)) / ((F.col("c") + 0.5) / (nc + 1))
    top = counts.where("kind = 1").where((F.col("t") >= SUPPORT) & (odds >= ODDS)).orderBy(F.desc("t"), "name").limit(ENTRIES)
    weights = {r["name"]: math.log((r["t"] + 0.5) / (nt + 1)) - math.log((r["c"] + 0.5) / (nc + 1)) for r in top.collect()}
    # An exception: two words seen in clean texts, at least thrice as often as in toxic ones, one of which is a whole-word entry.
    words = [x for x in weights if x.endswith(" ")]
    barred = set(given)
    if words:
        w = F.split(F.trim("name"), " ")
        known = F.broadcast(df.sparkSession.createDataFrame([(x.strip(),) for x in words], "entry string"))  # at most ENTRIES words
        clean = counts.where("kind = 2 AND c >= 3 AND c >= 3 * t").select("name", "c", F.explode(F.array_distinct(F.array(w[0], w[1]))).alias("entry"))
        clean = clean.join(known, "entry", "left_semi").groupBy("name").agg(F.max("c").alias("c"))
        barred |= {r["name"] for r in clean.orderBy(F.desc("c"), "name").limit(ENTRIES).collect()}
    model = Model(weights, frozenset(fold(x) for x in barred), usable=True)
    sent = df.sparkSession.sparkContext.broadcast(model)  # at most 2 * ENTRIES entries

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [sent.value.weigh(t) for t in values(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.float64()), pa.array([x for _, x in got], pa.float64()), b.column(1)], ["a", "b", "toxic"])

    got = kept.select("text", "toxic").mapInArrow(weighed, "a double, b double, toxic int").toPandas()
    if len(got):
        x = np.column_stack([np.ones(len(got)), got["a"], got["b"]])
        model.curve = tuple(logistic(x, got["toxic"].to_numpy(float)).tolist())
    return model


def score(df: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of doc_id, text."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([own.score(t) for t in values(b.column(1))], pa.float64())], ["doc_id", "score"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
