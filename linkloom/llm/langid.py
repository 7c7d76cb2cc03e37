"""Language identification with bit-sliced Bloom filters over character n-grams.

Position i of the filter holds one bit for each language (the bit slices of as
many Bloom filters of equal size and hashing), in as many 64-bit words as there are languages for.  The AND of an n-gram's positions is
a mask of all languages whose profile may contain it; the popcounts of a document's
masks by language, corrected for each filter's rate of false positives, decide.

A language's profile holds the n-grams that are at least RELATIVE times as frequent
in it as in the language where they are most frequent, and not rarer than LEAST
occurrences in the sample; they are counted and chosen in Spark.  The sample is bounded: about SAMPLE rows of each
language, chosen by a hash of the id.  The filter has at least 2 ** BITS positions, and so many that the largest profile fills at most FILL of it.

Edge cases: null texts and texts without letters (marks alone are none) give `und` and score 0; rows with
null lang teach nothing; without any labelled row, as in an empty table, everything is `und`; texts of any length are read whole; ties go to the
alphabetically first language; repeated rows are labelled each by itself; other
columns, also of clashing names, are ignored or kept as asked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.common import PLACES, code_points, fresh, map_rows, mix, named, values, word_table

SAMPLE = 1500
SIZES = (1, 2, 3, 4)
#: Positions of the filter, as a power of two, and probes of an n-gram.
BITS, PROBES, FILL = 21, 3, 0.5
RELATIVE, LEAST = 0.5, 3

_SPACE = 32


_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """For each code point 2 if it is a letter, 1 if a mark, which words may hold, else 0."""
    import unicodedata

    if not _LETTER:
        t = word_table().astype(np.uint8)
        for cp in np.flatnonzero(t).tolist():
            t[cp] = {"L": 2, "M": 1}.get(unicodedata.category(chr(cp))[0], 0)
        _LETTER.append(t)
    return _LETTER[0]


def grams(text: str | None) -> np.ndarray:
    """Hashes of the n-grams of the lower-cased words, each word between two spaces; empty without letters."""
    cps = code_points((text or "").lower())
    kind = letter_table()[cps]
    if not (kind == 2).any():
        return np.zeros(0, np.uint64)
    letter = kind > 0
    keep = letter | np.concatenate(([False], letter[:-1]))  # one space after each word
    own = np.concatenate(([_SPACE], np.where(letter, cps, _SPACE)[keep], [_SPACE])).astype(np.uint64)
    out, h = [], np.zeros(len(own), np.uint64)
    for j in range(SIZES[-1]):
        h = h[: len(own) - j] + (own[j:] + np.uint64(1)) * PLACES[j]
        if j + 1 in SIZES:
            found = mix(h + np.uint64(j))
            out.append(found[own != _SPACE] if j == 0 else found)
    return np.concatenate(out)


def probes(hashes: np.ndarray, bits: int = BITS) -> Iterator[np.ndarray]:
    step = (hashes >> np.uint64(40)) | np.uint64(1)
    for i in range(PROBES):
        yield ((hashes + step * np.uint64(i)) & np.uint64((1 << bits) - 1)).astype(np.int64)


@dataclass
class Model:
    """languages by bit; slices: by word of 64 languages, a mask for each position; wrong: each language's false-positive rate."""

    languages: list[str]
    slices: list[np.ndarray]
    wrong: np.ndarray

    def counts(self, text: str | None) -> tuple[int, np.ndarray]:
        """The number of n-grams, and for each language the corrected number of those in its profile."""
        hashes = grams(text)
        if not len(hashes) or not self.languages:
            return 0, np.zeros(len(self.languages))
        places = list(probes(hashes, len(self.slices[0]).bit_length() - 1))
        raw = np.zeros(len(self.languages))
        for w, slices in enumerate(self.slices):
            mask = slices[places[0]]
            for at in places[1:]:
                mask &= slices[at]
            here = range(64 * w, min(64 * w + 64, len(self.languages)))
            if len(here) <= 16:
                times = np.bincount(mask.astype(np.int64))
                kinds = np.flatnonzero(times).astype(np.uint64)
                times = times[kinds.astype(np.int64)]
            else:
                kinds, times = np.unique(mask.astype(np.uint64), return_counts=True)
            for i in here:
                raw[i] = times[(kinds >> np.uint64(i - 64 * w)) & np.uint64(1) == 1].sum()
        return len(hashes), np.maximum(0.0, (raw - len(hashes) * self.wrong) / (1.0 - self.wrong))

    def predict(self, text: str | None) -> tuple[str, float]:
        n, found = self.counts(text)
        if not n:
            return "und", 0.0
        best = int(found.argmax())
        return self.languages[best], float(min(1.0, found[best] / n))


def build(profiles: dict[str, np.ndarray]) -> Model:
    """profiles: the n-gram hashes of each language."""
    languages = sorted(profiles)
    most = max((len(x) for x in profiles.values()), default=0)
    bits = BITS
    while most * PROBES > FILL * (1 << bits):
        bits += 1
    # The narrowest numbers that hold a word's languages, as the filter is read at random.
    width = lambda n: next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if n <= 8 * k().itemsize)
    slices = [np.zeros(1 << bits, width(min(64, len(languages) - i))) for i in range(0, len(languages), 64)]
    wrong = np.zeros(len(languages))
    for i, x in enumerate(languages):
        own = slices[i // 64]
        bit = own.dtype.type(1 << (i % 64))
        for p in probes(profiles[x], bits):
            own[p] |= bit
        wrong[i] = min(0.5, np.count_nonzero(own & bit) / len(own)) ** PROBES
    return Model(languages, slices, wrong)


def fit(df: DataFrame) -> Model:
    """The model of the rows of doc_id, text, lang given."""
    rows = df.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang", F.xxhash64("doc_id").alias("h"))
    per = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not per:
        return build({})
    known = F.broadcast(df.sparkSession.createDataFrame([tuple(r) for r in per], "lang string, n long"))  # a row for each language
    sample = rows.join(known, "lang").where(F.pmod("h", F.lit(1 << 20)) / float(1 << 20) < SAMPLE / F.col("n")).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 128):  # a few texts' n-grams at a time
                texts: dict[str, list] = {}
                for text, lang in zip(*(values(c.slice(i, 128)) for c in b.columns)):
                    texts.setdefault(lang, []).append(grams(text))
                for lang, found in texts.items():
                    h, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(h), np.int64))), pa.array(h.view(np.int64)), pa.array(n)], ["lang", "g", "n"])

    counted = sample.mapInArrow(count, "lang string, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    chosen = counted.withColumn("share", share).withColumn("most", F.max("share").over(Window.partitionBy("g"))).where((F.col("n") >= LEAST) & (F.col("share") >= RELATIVE * F.col("most")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, g = b.column(0).to_pylist(), b.column(1).to_numpy()
            order = sorted(range(len(lang)), key=lang.__getitem__)
            for x, own in groupby(order, key=lang.__getitem__):
                yield pa.RecordBatch.from_pydict({"lang": [x], "found": [g[list(own)].tobytes()]})

    profiles: dict[str, list] = {r["lang"]: [] for r in per}
    for r in chosen.select("lang", "g").mapInArrow(pack, "lang string, found binary").toLocalIterator():
        profiles[r["lang"]].append(np.frombuffer(r["found"], np.uint64))
    return build({x: np.concatenate([np.zeros(0, np.uint64), *own]) for x, own in profiles.items()})


def predict(df: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns to keep, the predicted language and its score of every row; the rows need a text column."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # 8 bytes at most for each position and 64 languages
    at = keep.index("text") if "text" in keep else len(keep)
    plain = fresh("text", keep)
    rows = df.select(*named(keep), *([] if "text" in keep else [F.col("text").alias(plain)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            found = [own.predict(t) for t in values(b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], [str(i) for i in range(b.num_columns + 2)])

    out = map_rows(rows, run, [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return out.select(*named([*keep, *names]))
