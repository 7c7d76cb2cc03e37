"""Benchmark decontamination by the CGK random-walk embedding and bit-sampling LSH.

Symbols are words.  The CGK walk reads a window from its start and, at each step, writes the
word under it and moves on by a random bit of that step and word; equal windows write equal
sequences.  Every word of an item is an anchor: k edits leave one of its m words' runs of
ceil((m - k) / (k + 1)) words whole, wherever the edits are, so a window of that many words
somewhere in the item agrees with the text in every step taken inside it.  The sampled steps of
several independent walks, none of which can leave the window, make an anchor's key; no occurrence is
lost, of items of any length.

Windows that share too few n-word runs with the items of their size class are passed
over without loss: k edits destroy at most k * n of an item's m - n + 1 runs (q-gram lemma).  So are
items with too few agreeing anchors near one diagonal.  Every candidate left is verified by the exact edit
distance between the item and the best substring of the text around its diagonals.

Items are handled in blocks of at most BLOCK_ITEMS items and BLOCK_WORDS words, the only data broadcast;
each block is matched against all texts.  Words are compared lower-cased.

Edge cases: null or empty texts and items match nothing; repeated items and rows are
matched each by itself; null ids stay null; texts and items of any length are read whole; an empty benchmark finds nothing; other columns, also of clashing names, are ignored
(drop keeps them); an item occurs at most
once for each row, with its smallest distance and, of equals, the first place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import PLACES, batches_of, map_rows, mix, values, word_hashes, written

SIMILARITY = 0.8
#: Walks whose sampled steps make a key, and the steps of a walk sampled at most.
WALKS, SAMPLED = 6, 4
BLOCK_ITEMS, BLOCK_WORDS = 4096, 400_000
#: Bits of the table of the items' runs: a collision only lets a window through.
SEED_BITS = 22
#: Agreeing anchors of a text and a size class held at a time; beyond them an item is verified against the whole text.
PAIRS = 2_000_000

SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64())])


def repetitions() -> int:
    return WALKS


def allowed(words: int) -> int:
    """Edits of an item of so many words."""
    return int((1 - SIMILARITY) * words + 1e-9)


def whole_run(words: int) -> int:
    """The run that an item keeps under its allowed edits, wherever they are."""
    k = allowed(words)
    return max(1, -(-(words - k) // (k + 1)))


def seed_words(words: int) -> int:
    """The same, 3 at most."""
    return min(3, whole_run(words))


def size_class(words: int) -> int:
    return 1 << (words.bit_length() - 1)


def walk(words: np.ndarray, starts: np.ndarray, size: int, rep: int, steps: np.ndarray) -> np.ndarray:
    """The words written at the given steps by repetition rep's walks from each start, mixed to one key."""
    at = starts.copy()
    key = np.full(len(starts), rep * 1024 + size, np.uint64)
    padded = np.concatenate([words, np.zeros(int(steps[-1]) + 2, np.uint64)])
    for step in range(int(steps[-1]) + 1):
        now = padded[np.minimum(at, len(padded) - 1)]
        if step in steps:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + now)
        at = at + (mix(now + np.uint64((rep * 100_003 + step + 1) * 0x2545F4914F6CDD1D & (1 << 64) - 1)) >> np.uint64(63)).astype(np.int64)
    return key


def sampled_steps(size: int, rep: int) -> np.ndarray:
    """Sorted steps of a walk, sampled among those that cannot leave a window of so many words."""
    rng = np.random.default_rng((size, rep, 7))
    return np.sort(rng.choice(size, min(SAMPLED, size), replace=False))


def keys_of(words: np.ndarray, starts: np.ndarray, size: int, repeats: int) -> np.ndarray:
    """A key for the window of size words at each start, from the sampled steps of all walks."""
    out = np.zeros(len(starts), np.uint64)
    for rep in range(repeats):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + walk(words, starts, size, rep, sampled_steps(size, rep)))
    return out


def runs(words: np.ndarray, n: int) -> np.ndarray:
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(m, n, np.uint64)
    for j in range(n):
        h += words[j : j + m] * PLACES[j]
    return mix(h)


def substring_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(the least edit distance between the item and any substring of the text, where the first best one ends)."""
    row = np.zeros(len(text) + 1, np.int64)
    ramp = np.arange(len(text) + 1)
    for i, w in enumerate(item.tolist()):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != w), row[1:] + 1)
        row = np.minimum.accumulate(new - ramp) + ramp
    end = int(row.argmin())
    return int(row[end]), end


@dataclass
class Index:
    """A block of items: words of each, and by size class seeds and a table of the keys of all anchors."""

    ids: list[int]
    items: list[np.ndarray]
    repeats: int

    def __post_init__(self) -> None:
        self.classes: dict[int, dict] = {}
        by: dict[int, list[int]] = {}
        for i, w in enumerate(self.items):
            by.setdefault(size_class(len(w)), []).append(i)
        for size, own in by.items():
            n = min(seed_words(len(self.items[i])) for i in own)
            longest = max(len(self.items[i]) for i in own)
            needed = min(len(self.items[i]) - n + 1 - n * allowed(len(self.items[i])) for i in own)
            seeds = np.zeros(1 << SEED_BITS, bool)
            for i in own:
                seeds[(runs(self.items[i], n) >> np.uint64(64 - SEED_BITS)).astype(np.int64)] = True
            run = min(whole_run(len(self.items[i])) for i in own)
            anchors = [np.arange(len(self.items[i]) - run + 1) for i in own]
            keys = np.concatenate([keys_of(self.items[i], a, run, self.repeats) for i, a in zip(own, anchors)])
            order = np.argsort(keys, kind="stable")
            table = (keys[order], np.repeat(own, [len(a) for a in anchors])[order], np.concatenate(anchors)[order])
            self.classes[size] = {"n": n, "run": run, "longest": longest, "edits": allowed(longest), "needed": max(1, needed), "seeds": seeds, "table": table}

    def candidates(self, words: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(item, its ranges of diagonals) of agreeing pairs; a diagonal is where the item's first word would lie."""
        places: dict[int, np.ndarray] = {}
        for c in self.classes.values():
            n, run = c["n"], c["run"]
            if n not in places:
                places[n] = (runs(words, n) >> np.uint64(64 - SEED_BITS)).astype(np.int64)
            hit = c["seeds"][places[n]]
            if np.count_nonzero(hit) < c["needed"]:
                continue
            # Hits among the places that an occurrence starting near each word can cover.
            total = np.concatenate(([0], np.cumsum(hit)))
            here = np.arange(len(words))
            low = np.clip(here - c["edits"], 0, len(hit))
            high = np.clip(here + c["longest"] + 2 * c["edits"], 0, len(hit))
            near = np.concatenate(([0], np.cumsum(total[high] - total[low] >= c["needed"])))
            # Windows inside an occurrence that starts at one of those words.
            at = np.flatnonzero(near[here + 1] > near[np.maximum(0, here - c["longest"] - c["edits"])])
            at = at[at <= len(words) - run]
            if not len(at):
                continue
            keys, owner, anchor = c["table"]
            key = keys_of(words, at, run, self.repeats)
            i, j = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            found = np.flatnonzero(j > i)
            if not len(found):
                continue
            at, i, times = at[found], i[found], (j - i)[found]
            if times.sum() > PAIRS:
                held = np.zeros(len(keys) + 1, np.int64)
                np.add.at(held, i, 1)
                np.add.at(held, i + times, -1)
                for item in np.unique(owner[np.cumsum(held[:-1]) > 0]).tolist():
                    yield item, [(0, len(words))]
                continue
            entry = np.repeat(i - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
            item, diagonal, place = owner[entry], np.repeat(at, times) - anchor[entry], anchor[entry]
            order = np.lexsort((diagonal, item))
            item, diagonal, place = item[order], diagonal[order], place[order]
            cuts = np.flatnonzero(np.diff(item, prepend=-1, append=-1))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                m = len(self.items[item[a]])
                k = allowed(m)
                least = max(1, m - run + 1 - run * k)
                if b - a < least:
                    continue
                # The anchors of an occurrence agree on diagonals at most 2 * k apart.
                ends = [*(np.flatnonzero(np.diff(diagonal[a:b]) > 2 * k) + a + 1).tolist(), b]
                ranges = [(int(diagonal[x]), int(diagonal[y - 1])) for x, y in zip([a, *ends], ends) if y - x >= least and len(np.unique(place[x:y])) >= least]
                if ranges:
                    yield int(item[a]), ranges

    def matches(self, text: str | None) -> Iterator[tuple[int, int, float, int]]:
        """(item id, distance, similarity, first word) of each item found."""
        words = word_hashes(text)
        if not len(words):
            return
        best: dict[int, tuple[int, int]] = {}
        for item, ranges in self.candidates(words):
            own = self.items[item]
            m, k = len(own), allowed(len(own))
            for first, last in ranges:
                low = max(0, first - k)
                part = words[low : last + m + 2 * k]
                if np.count_nonzero(np.isin(own, part)) < m - k:  # each edit costs the item one word at most
                    continue
                d, end = substring_distance(own, part)
                if d > k:
                    continue
                begin = len(part[:end]) - substring_distance(own[::-1], part[:end][::-1])[1]
                best[item] = min((d, low + begin), best.get(item, (d, low + begin)))
                if d == 0:
                    break
        for item, (d, first) in best.items():
            yield self.ids[item], d, 1 - d / len(self.items[item]), first


def blocks(benchmark: DataFrame) -> Iterator[Index]:
    """The items with words, a bounded block at a time."""
    ids, items, size = [], [], 0
    for r in benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long"), "text").toLocalIterator():
        words = word_hashes(r[1])
        if not len(words):
            continue
        if ids and (len(ids) >= BLOCK_ITEMS or size + len(words) > BLOCK_WORDS):
            yield Index(ids, items, repetitions())
            ids, items, size = [], [], 0
        ids.append(r[0])
        items.append(words)
        size += len(words)
    if ids:
        yield Index(ids, items, repetitions())


def find(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, distance, similarity, first_word for each row of df and item that it holds."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for index in blocks(benchmark):
        sent = df.sparkSession.sparkContext.broadcast(index)  # at most BLOCK_WORDS words

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[tuple]:
                for b in batches:
                    for doc_id, text in zip(values(b.column(0)), values(b.column(1))):
                        for got in sent.value.matches(text):
                            yield doc_id, *got

            yield from batches_of(rows(), SCHEMA)

        part = docs.mapInArrow(run, "doc_id long, item_id long, distance long, similarity double, first_word long")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance long, similarity double, first_word long")
    return out


def drop(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of df, all columns, that hold no item: the same matching inside the row's own task, without a join.

    Each block of items is one pass over what is left; further passes read it from the shared folder, and a block's broadcast goes with its pass.
    """
    at = df.columns.index("text")
    out, last = df, None
    for index in blocks(benchmark):
        if last is not None:
            out = written(out)
            last.unpersist()
        last = df.sparkSession.sparkContext.broadcast(index)  # at most BLOCK_WORDS words

        def run(batches: Iterator[pa.RecordBatch], sent=last) -> Iterator[pa.RecordBatch]:
            for b in batches:
                clean = pa.array([next(sent.value.matches(t), None) is None for t in values(b.column(at))], pa.bool_())
                yield b.filter(clean)

        out = map_rows(out, run)
    return out
