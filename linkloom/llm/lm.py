"""Masked pseudo-likelihood by a bidirectional window network, trained and applied in numpy.

Tokens are words.  All words of the corpus are counted in Spark; the most frequent ones
are tokens of their own, every other word belongs to one of OTHERS buckets by its hash.  The network
predicts each token from the SIDE tokens on either side (the token itself is masked): embeddings by
position are summed, squashed, and a two-level softmax (CLASSES frequency classes, then the class's members) gives the
conditional probability.  A word of a bucket has a third level: its share of the bucket's occurrences in the whole corpus,
those of the scored document itself masked, smoothed by PRIOR for each word.  A document's score is the sum of its tokens'
log-probabilities.

Training takes every row of the corpus once, copies included, so it grows with the input: ROUNDS rounds over disjoint
parts of the rows (by a hash of the text).  In a round each partition of the input trains a network of its own from the
common start as it is read; the weights are averaged, by tokens, in two streamed steps whose memory does not grow.

The counts of rare words are not broadcast: documents are scored in chunks of about CHUNK tokens, the distinct rare
words of a chunk are sent to the parts of the corpus counts that hold them (of about PART words each), and the answers meet the chunk again in a task of
that bounded size.

Edge cases: null and empty texts, and texts without words, have no tokens, sum 0 and a null mean; a text of
one word has an empty context; texts of any length are read whole, in time linear in their length; repeated rows train and are
scored each by itself; null ids stay null; an empty corpus gives the uniform network; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import batches_of, checkpoint, groups_of, hashed, mix, values, written

CLASSES, MEMBERS, OTHERS = 64, 64, 512
SIZE = CLASSES * MEMBERS
SIDE, WIDTH = 2, 16
ROUNDS, STEP, BATCH = 2, 0.1, 32768
#: Occurrences that a rare word has besides those counted.
PRIOR = 0.1
#: Parts that the weights are cut into while they are averaged.
PARTS = 32
#: Tokens scored at a time, tokens that batches are drawn from, and tokens of a chunk of documents.
SCORED, DRAWN, CHUNK = 1 << 15, 1 << 18, 1 << 22
#: Counted words of a part, and parts at least.
PART, LEAST_PARTS = 1 << 19, 32
#: Rows of a softmax computed at a time.
CACHED = 1024


def _place(words: np.ndarray, table: int) -> np.ndarray:
    return (words if not table else mix(words + np.uint64(table))).astype(np.uint16)


class Vocabulary:
    """The most frequent words, most frequent first; how often all tokens occur, and the distinct words of each bucket."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray, kinds: np.ndarray | None = None):
        self.counts = counts
        self.kinds = np.zeros(OTHERS) if kinds is None else kinds
        # Tables by 16 bits of the word each; a word whose place is taken goes to the next table.
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        rest = np.arange(len(frequent))
        while len(rest):
            place = _place(frequent[rest], len(self.tables))
            _, first = np.unique(place, return_index=True)
            held, token = np.zeros(1 << 16, np.uint64), np.full(1 << 16, -1, np.int32)
            held[place[first]], token[place[first]] = frequent[rest[first]], rest[first]
            self.tables.append((held, token))
            rest = np.delete(rest, first)

    def ids(self, words: np.ndarray) -> np.ndarray:
        out = ((words >> np.uint64(20)) & np.uint64(OTHERS - 1)).astype(np.uint16) + np.uint16(SIZE - OTHERS)
        for i, (held, token) in enumerate(self.tables):
            place = _place(words, i)
            hit = np.flatnonzero(held[place] == words)
            token = token[place[hit]]
            out[hit[token >= 0]] = token[token >= 0]
        return out

    def rare(self, words: np.ndarray, own: np.ndarray, corpus: np.ndarray) -> np.ndarray:
        """Log-probabilities of a document's distinct rare words (own: their occurrences in it) inside their buckets; corpus: in all documents."""
        bucket = ((words >> np.uint64(20)) & np.uint64(OTHERS - 1)).astype(np.int64)
        others = self.counts[SIZE - OTHERS :][bucket] - np.bincount(bucket, own, OTHERS)[bucket]
        return np.log((np.maximum(0, corpus - own) + PRIOR) / (np.maximum(0, others) + PRIOR * (self.kinds[bucket] + 1)))


class Network:
    """context: an embedding for each position and token (the last row: outside); outer and inner softmax."""

    names = ("context", "outer", "outer_bias", "inner", "inner_bias")

    def __init__(self, counts: np.ndarray):
        rng = np.random.default_rng(11)
        self.context = (rng.standard_normal((2 * SIDE, SIZE + 1, WIDTH)) * 0.1).astype(np.float32)
        self.outer = (rng.standard_normal((CLASSES, WIDTH)) * 0.1).astype(np.float32)
        self.inner = (rng.standard_normal((CLASSES, MEMBERS, WIDTH)) * 0.1).astype(np.float32)
        own = counts.reshape(CLASSES, MEMBERS) + 0.1
        self.outer_bias = np.log(own.sum(axis=1) / own.sum()).astype(np.float32)
        self.inner_bias = np.log(own / own.sum(axis=1, keepdims=True)).astype(np.float32)
        self.seen = {n: np.full((x := getattr(self, n)).shape[: x.ndim - (not n.endswith("bias"))], 1e-6, np.float32) for n in self.names}

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.names])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for n in self.names:
            own = getattr(self, n)
            setattr(self, n, flat[at : at + own.size].reshape(own.shape).astype(np.float32))
            at += own.size
        return self

    def hidden(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = self.context[0][padded[at]]
        for j in range(1, 2 * SIDE):
            total += self.context[j][padded[at + j + (j >= SIDE)]]
        return np.tanh(total, out=total)

    @staticmethod
    def _logs(weights: np.ndarray, bias: np.ndarray, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probabilities of a softmax's targets, a part of the rows of h at a time that fits a processor's cache."""
        out = np.empty(len(h))
        for i in range(0, len(h), CACHED):
            own = target[i : i + CACHED]
            x = weights @ h[i : i + CACHED].T
            x += bias[:, None]
            x -= x.max(axis=0)
            out[i : i + CACHED] = x[own, np.arange(len(own))] - np.log(np.exp(x, out=x).sum(axis=0)) if len(own) else 0
        return out

    @staticmethod
    def _slopes(weights: np.ndarray, bias: np.ndarray, h: np.ndarray, target: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slopes of a softmax's loss by weights and bias; those by h are added to back."""
        by_weights, by_bias = np.zeros_like(weights), np.zeros_like(bias)
        for i in range(0, len(h), CACHED):
            own, part = target[i : i + CACHED], h[i : i + CACHED]
            x = weights @ part.T
            x += bias[:, None]
            x -= x.max(axis=0)
            np.exp(x, out=x)
            x /= x.sum(axis=0)
            x[own, np.arange(len(own))] -= 1
            back[i : i + CACHED] += x.T @ weights
            by_weights += x @ part
            by_bias += x.sum(axis=1)
        return by_weights, by_bias

    @staticmethod
    def by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An order by token, and where each class begins in it."""
        order = np.argsort(target, kind="stable")
        return order, np.searchsorted(target[order], np.arange(CLASSES + 1) * MEMBERS)

    def log_probabilities(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the tokens padded[at + SIDE], given those around them."""
        order, cuts = self.by_class(padded[at + SIDE])
        at = at[order]
        target = padded[at + SIDE].astype(np.int64)
        h = self.hidden(padded, at)
        found = self._logs(self.outer, self.outer_bias, h, target // MEMBERS)
        for g in range(CLASSES):
            i, j = cuts[g], cuts[g + 1]
            if i < j:
                found[i:j] += self._logs(self.inner[g], self.inner_bias[g], h[i:j], target[i:j] % MEMBERS)
        out = np.empty(len(at))
        out[order] = found
        return out

    def step(self, padded: np.ndarray, at: np.ndarray, rate: float) -> None:
        """One Adagrad step on the tokens padded[at + SIDE]; a row of weights shares its pace."""
        order, cuts = self.by_class(padded[at + SIDE])
        at = at[order]
        target = padded[at + SIDE].astype(np.int64)
        h = self.hidden(padded, at)
        back = np.zeros_like(h)
        by_weights, by_bias = self._slopes(self.outer, self.outer_bias, h, target // MEMBERS, back)
        self._descend("outer", ..., by_weights, rate)
        self._descend("outer_bias", ..., by_bias, rate)
        for g in range(CLASSES):
            i, j = cuts[g], cuts[g + 1]
            if i < j:
                by_weights, by_bias = self._slopes(self.inner[g], self.inner_bias[g], h[i:j], target[i:j] % MEMBERS, back[i:j])
                self._descend("inner", g, by_weights, rate)
                self._descend("inner_bias", g, by_bias, rate)
        h *= h
        back *= 1 - h
        for j in range(2 * SIDE):
            token = padded[at + j + (j >= SIDE)]
            order = np.argsort(token, kind="stable")
            token = token[order]
            first = np.flatnonzero(np.diff(token, prepend=np.uint16(0xFFFF)))
            self._descend("context", (j, token[first]), np.add.reduceat(back[order], first, axis=0), rate)

    def _descend(self, name: str, at, slope: np.ndarray, rate: float) -> None:
        seen = self.seen[name]
        if name.endswith("bias"):
            seen[at] += slope * slope
            getattr(self, name)[at] -= rate * slope / np.sqrt(seen[at])
        else:
            seen[at] += np.einsum("ij,ij->i", slope, slope) / WIDTH
            getattr(self, name)[at] -= slope * (rate / np.sqrt(seen[at]))[:, None]


def pad(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in a row with SIDE outside tokens around each; where each token's window starts; tokens of each text."""
    length = np.array([len(x) for x in ids], np.int64)
    padded = np.full(int(length.sum()) + SIDE * (len(ids) + 1), SIZE, np.uint16)
    at = np.arange(length.sum()) + np.repeat(SIDE * np.arange(len(ids)), length)
    if len(at):
        padded[at + SIDE] = np.concatenate(ids)
    return padded, at, length


def score_texts(net: Network, ids: list[np.ndarray]) -> np.ndarray:
    """The summed log-probabilities of each text's tokens; a rare word counts as its bucket."""
    padded, at, length = pad(ids)
    out = np.zeros(len(ids))
    which = np.repeat(np.arange(len(ids)), length)
    for i in range(0, len(at), SCORED):
        part = net.log_probabilities(padded, at[i : i + SCORED])
        out += np.bincount(which[i : i + SCORED], part, len(ids))
    return out


def learn_texts(net: Network, ids: list[np.ndarray], rate: float = STEP) -> int:
    """Trains on every token of the texts once, each batch drawn from all of them; the number of tokens."""
    padded, at, _ = pad(ids)
    batches = max(1, round(len(at) / BATCH))
    for j in range(batches if len(at) else 0):
        net.step(padded, at[j::batches], rate)
    return len(at)


def bucket_of(h: F.Column) -> F.Column:
    return F.shiftrightunsigned(h, 20).bitwiseAND(F.lit(OTHERS - 1))


def count_words(df: DataFrame) -> DataFrame:
    """h, n: how often every word occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

        for b in batches:
            for own in hashed(values(b.column(0))):
                held.append(own)
                size += len(own)
                if size >= CHUNK:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    return checkpoint(df.where("text IS NOT NULL").select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))


def vocabulary(counted: DataFrame) -> Vocabulary:
    """Of count_words(); only the frequent words and a row for each bucket come to the driver."""
    rows = counted.orderBy(F.desc("n"), "h").limit(SIZE - OTHERS).collect()
    frequent = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    counts, kinds = np.zeros(SIZE), np.zeros(OTHERS)
    counts[: len(rows)] = [r["n"] for r in rows]
    if rows:
        known = F.broadcast(counted.sparkSession.createDataFrame([(r["h"],) for r in rows], "h long"))  # at most SIZE words
        rest = counted.join(known, "h", "left_anti").groupBy(bucket_of(F.col("h")).alias("b")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
        for r in rest.collect():
            counts[SIZE - OTHERS + r["b"]], kinds[r["b"]] = r["n"], r["kinds"]
    return Vocabulary(frequent, counts, kinds)


def train(df: DataFrame, words: Vocabulary) -> Network:
    """The network of all texts, copies included."""
    spark = df.sparkSession
    net = Network(words.counts)
    texts = df.where("text IS NOT NULL").select("text")
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("weight", pa.float64()), ("data", pa.binary())])
    ddl = "part int, shard long, weight double, data binary"

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for (part, shard), own in groups_of(batches, ["part", "shard"]):
                total, weight = None, 0.0
                for r in own:
                    more = np.frombuffer(r["data"], np.float32) * np.float64(r["weight"])
                    total = more if total is None else total + more
                    weight += r["weight"]
                yield part, shard, weight, (total / weight).astype(np.float32).tobytes()

        yield from batches_of(out(), schema)

    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast((words, net.flat()))  # a fixed number of weights

        def learn(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            words, flat = sent.value
            own = Network(words.counts).load(flat)
            seen, held, size = 0, [], 0
            for b in batches:
                for own_words in hashed(values(b.column(0))):
                    held.append(words.ids(own_words))
                    size += len(held[-1])
                    if size >= DRAWN:
                        seen += learn_texts(own, held)
                        held, size = [], 0
            seen += learn_texts(own, held)
            if seen:
                flat = own.flat()
                step = -(-len(flat) // PARTS)
                at = TaskContext.get().partitionId()
                yield from batches_of(((p, at, float(seen), flat[p * step : (p + 1) * step].tobytes()) for p in range(PARTS)), schema)

        learned = texts.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn).mapInArrow(learn, ddl)
        for fold in (64, 1):  # many networks, then few, then one
            learned = learned.withColumn("shard", F.pmod("shard", F.lit(fold))).repartition("part", "shard").sortWithinPartitions("part", "shard").mapInArrow(average, ddl)
        got = learned.collect()
        if got:
            net.load(np.concatenate([np.frombuffer(r["data"], np.float32) for r in sorted(got, key=lambda r: r["part"])]))
    return net


_HELD = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64()), ("n_rare", pa.int64()),
    ("rare", pa.binary()), ("own", pa.binary()), ("part", pa.int64()), ("asked", pa.binary()),
])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64()), ("mean_log_prob", pa.float64()), ("n_rare", pa.int64()), ("rare_log_prob", pa.float64()), ("n_unseen", pa.int64())])


def part_of(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def score(df: DataFrame, words: Vocabulary, net: Network, counted: DataFrame) -> DataFrame:
    """doc_id, n_tokens, log_prob, mean_log_prob, n_rare, rare_log_prob, n_unseen for every row of doc_id, text.

    n_rare: tokens outside the frequent words; rare_log_prob: the part of log_prob that their third level has; n_unseen: those
    of them whose word no other row of the corpus holds, so that the masked level has nothing but its prior.
    """
    sent = df.sparkSession.sparkContext.broadcast((words, net))  # a fixed number of weights
    # The counted words lie in parts of about PART; a chunk sends each part its own words at once.  Words counted once need no answer.
    again = counted.where("n > 1")
    parts = max(LEAST_PARTS, -(-again.count() // PART))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, net = sent.value
        chunk = TaskContext.get().partitionId() << 32

        def rows(ids: list, found: list[np.ndarray]) -> Iterator[tuple]:
            coded = [words.ids(w) for w in found]
            total = score_texts(net, coded)
            every = []
            for doc_id, w, own, s in zip(ids, found, coded, total.tolist()):
                rare, times = np.unique(w[own >= SIZE - OTHERS], return_counts=True)
                every.append(rare)
                yield chunk, doc_id, len(own), s, int(times.sum()), rare.tobytes(), times.astype("<u4").tobytes(), None, None
            asked = np.unique(np.concatenate(every))
            part = part_of(asked, parts)
            order = np.argsort(part, kind="stable")
            asked, part = asked[order], part[order]
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            for i, j in zip(cuts[:-1], cuts[1:]):
                yield chunk, None, None, None, None, None, None, int(part[i]), asked[i:j].tobytes()

        def out() -> Iterator[tuple]:
            nonlocal chunk
            ids, found, size = [], [], 0
            for b in batches:
                for doc_id, own in zip(values(b.column(0)), hashed(values(b.column(1)))):
                    ids.append(doc_id)
                    found.append(own)
                    size += len(own)
                    if size >= CHUNK:
                        yield from rows(ids, found)
                        chunk += 1
                        ids, found, size = [], [], 0
            if ids:
                yield from rows(ids, found)

        yield from batches_of(out(), _HELD)

    held = written(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "chunk long, doc_id long, n_tokens long, log_prob double, n_rare long, rare binary, own binary, part long, asked binary"))
    none = lambda kind, *names: [F.lit(None).cast(kind).alias(c) for c in names]
    known = again.select(F.pmod(F.shiftrightunsigned("h", 32), F.lit(parts)).alias("part"), F.lit(0).alias("kind"), "h", "n", *none("long", "chunk"), *none("binary", "asked"))
    asking = held.where("asked IS NOT NULL").select("part", F.lit(1).alias("kind"), *none("long", "h", "n"), "chunk", "asked")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            at, table = None, None
            for (part, kind), got in _runs(batches, 0, 1):
                if kind == 0:
                    found, times = zip(*((b.column(2).to_numpy(), b.column(3).to_numpy()) for b in got))
                    found, times = np.concatenate(found).view(np.uint64), np.concatenate(times)
                    order = np.argsort(found)
                    at, table = part, (found[order], times[order])
                    continue
                for b in got if part == at else ():
                    for chunk, data in zip(values(b.column(4)), values(b.column(5))):
                        asked = np.frombuffer(data, np.uint64)
                        at = np.minimum(np.searchsorted(table[0], asked), len(table[0]) - 1)
                        hit = table[0][at] == asked
                        yield chunk, asked[hit].tobytes(), table[1][at[hit]].astype(np.int64).tobytes()

        yield from batches_of(out(), pa.schema([("chunk", pa.int64()), ("h", pa.binary()), ("n", pa.binary())]))

    told = known.unionByName(asking).repartition("part").sortWithinPartitions("part", "kind").mapInArrow(answer, "chunk long, h binary, n binary")
    told = told.select("chunk", F.lit(0).alias("kind"), *none("long", "doc_id", "n_tokens"), *none("double", "log_prob"), *none("long", "n_rare"), F.col("h").alias("rare"), F.col("n").alias("own"))
    docs = held.where("asked IS NULL").select("chunk", F.lit(1).alias("kind"), "doc_id", "n_tokens", "log_prob", "n_rare", "rare", "own")
    dealt = told.unionByName(docs).repartition("chunk").sortWithinPartitions("chunk", "kind")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, _ = sent.value

        def out() -> Iterator[tuple]:
            at, table = None, None
            for (chunk, kind), got in _runs(batches, 0, 1):
                if kind == 0:
                    got = [x for b in got for x in zip(values(b.column(6)), values(b.column(7)))]
                    found, times = (np.concatenate([np.frombuffer(x[c], k) for x in got]) for c, k in ((0, np.uint64), (1, np.int64)))
                    order = np.argsort(found)
                    at, table = chunk, (found[order], times[order])
                    continue
                if chunk != at or not len(table[0]):
                    at, table = chunk, (np.zeros(1, np.uint64), np.ones(1, np.int64))
                for b in got:
                    for doc_id, n, s, n_rare, rare, own in zip(*(values(b.column(c)) for c in range(2, 8))):
                        rare, own = np.frombuffer(rare, np.uint64), np.frombuffer(own, "<u4")
                        place = np.minimum(np.searchsorted(table[0], rare), len(table[0]) - 1)
                        corpus = np.where(table[0][place] == rare, table[1][place], 1)
                        more = float(words.rare(rare, own, corpus) @ own) if n_rare else 0.0
                        yield doc_id, n, s + more, (s + more) / n if n else None, n_rare, more, int(own[corpus <= own].sum())

        yield from batches_of(out(), _OUT)

    return dealt.mapInArrow(finish, "doc_id long, n_tokens long, log_prob double, mean_log_prob double, n_rare long, rare_log_prob double, n_unseen long")


def _runs(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """Consecutive rows of equal whole numbers in the columns, as streamed batches."""
    from itertools import groupby

    def parts() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for b in batches:
            keys = [b.column(c).to_numpy() for c in columns]
            cuts = [0, *(np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1).tolist(), b.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                if i < j:
                    yield tuple(int(k[i]) for k in keys), b.slice(i, j - i)

    for key, own in groupby(parts(), key=lambda p: p[0]):
        yield key, (b for _, b in own)
