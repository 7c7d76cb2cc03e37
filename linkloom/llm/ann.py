"""Approximate nearest neighbours by inner product, by multi-index hashing.

Codes: ITQ rotations, learned on at most SAMPLE directions chosen by a hash of the id, give BITS
sign bits of each vector; a code doesn't change with its vector's length.  A code is cut into substrings of CHUNK bits.  Rows are dealt to
blocks of about BLOCK rows; a block's rows are sorted by length and cut into BANDS bands, each with an
index for each substring that lists its rows by the substring's value.  By the pigeonhole principle, every
code within Hamming radius r differs in at most floor(r / chunks) bits in some
substring (in one less for the substrings beyond the first r % chunks + 1), so probing the values within
that distance finds all of them; where the values probed would be more than the band's rows, its codes are compared
one by one, which gives the same rows.

The radius is a query's own: the rows of smallest distance (about FIRST times k, with cosines as their distances suggest) are scored first, and their k-th best score
bounds it from above.  A row of a band can only beat that score at a cosine of at least the score over
the product of lengths, and the band's radius is the Hamming distance that codes at that cosine stay within in RECALL of the
cases, by the sample's pairs and by the binomial spread of sign bits, whichever is larger; a band too short for the cosine is passed over, which
loses nothing.  All rows within the radius are reranked by the inner product in doubles.

Each query meets each block once, streamed, and each block returns its best k; a grouped top-k merges them.  Every row is indexed and
no candidate within the radius is left out.

Edge cases: vectors that are null, empty, zero, or
hold null or non-finite components take no part, nor do null ids; vectors of each size are searched among themselves; rows of equal id and vector are
counted, and a query leaves out one of them, its own; rows of equal id and different vectors are queries and candidates of their own; equal scores go to
the smaller id; fewer candidates than k are all returned; very long vectors make smaller blocks; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, groupby
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE, BITS, CHUNK = 8192, 256, 16
BLOCK, BLOCK_VALUES, BANDS = 8192, 1 << 22, 8
#: Share of the rows at a cosine that lie within its radius, and the normal deviate of that share.
RECALL, DEVIATE = 0.75, 0.68
#: Rows, in multiples of k, whose scores first bound a query's radius.
FIRST = 4
#: Cosines that radii are learned for.
STEPS = 80
#: Queries held, and of them those answered, at a time while a block is probed.
QUERIES, GROUP = 1024, 32


TINY = 1e-300
_COSINE = np.cos(np.pi * np.arange(BITS + 1) / BITS).astype(np.float32)


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def itq(sample: np.ndarray, bits: int, seed: int, rounds: int = 25) -> np.ndarray:
    """A rotation (columns) whose signs lose least of the sample's shape."""
    rng = np.random.default_rng(seed)
    d = sample.shape[1]
    rotation, _ = np.linalg.qr(rng.standard_normal((d, d)))
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.sign(sample @ rotation).T @ sample)
        rotation = (u @ v).T
    return rotation[:, :bits]


class Coder:
    """The rotations and, for each of STEPS + 1 cosines from -1 to 1, the radius."""

    def __init__(self, sample: np.ndarray, bits: int = BITS):
        d = sample.shape[1]
        own = sample / np.maximum(lengths(sample), TINY)[:, None]
        self.rotation = np.concatenate([itq(own, min(d, bits - at), seed) for seed, at in enumerate(range(0, bits, d))], axis=1)
        share = np.arccos(np.linspace(-1, 1, STEPS + 1)) / np.pi
        self.radius = np.minimum(bits, np.ceil(bits * share + DEVIATE * np.sqrt(bits * share * (1 - share)) + 1))
        words = self.words(own)
        cosine, far = [], []
        for q in range(min(256, len(own))):
            cosine.append(own @ own[q])
            far.append(np.bitwise_count(words ^ words[q]).sum(axis=1))
        step = np.floor((np.concatenate(cosine) + 1) / 2 * STEPS).astype(np.int64).clip(0, STEPS - 1)
        far = np.concatenate(far)
        for s in range(STEPS):
            if np.count_nonzero(seen := step == s) >= 100:
                self.radius[s] = max(self.radius[s], np.quantile(far[seen], RECALL))
        self.radius = np.maximum.accumulate(self.radius[::-1])[::-1].astype(np.int64)  # not smaller for a smaller cosine

    def words(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of 64-bit words, four substrings each."""
        return np.packbits(vectors @ self.rotation > 0, axis=1).view(np.uint64)

    def radius_at(self, cosine: np.ndarray) -> np.ndarray:
        """-1 where no vector has the cosine."""
        step = np.floor((np.clip(cosine, -1, 1) + 1) / 2 * STEPS).astype(np.int64)
        return np.where(cosine > 1 + 1e-9, -1, self.radius[step])


class Band:
    """Rows of similar length and their substring indexes."""

    def __init__(self, words: np.ndarray, longest: float):
        self.words, self.longest = np.ascontiguousarray(words), longest
        chunks = self.words.view(np.uint16)
        self.tables = []
        for c in range(chunks.shape[1]):
            rows = np.argsort(chunks[:, c], kind="stable")
            self.tables.append((np.searchsorted(chunks[rows, c], np.arange((1 << CHUNK) + 1)), rows))
        # Substrings by the number of bits set, as many as it can pay to probe, and how many have at most so many bits.
        self.flips, self.upto = np.zeros(0, np.uint16), [0]
        for bits in range(CHUNK + 1):
            if (self.upto[-1] + comb(CHUNK, bits)) * len(self.tables) > max(len(words), len(self.tables)):
                break
            self.flips = np.append(self.flips, np.array([sum(1 << i for i in c) for c in combinations(range(CHUNK), bits)], np.uint16))
            self.upto.append(len(self.flips))
        #: The largest radius that is probed; beyond it the values probed are more than the rows.
        self.probed = (len(self.upto) - 1) * len(self.tables) - 1

    def far(self, codes: np.ndarray) -> np.ndarray:
        """The distance of every row from each code."""
        out = np.zeros((len(codes), len(self.words)), np.uint16)
        for w in range(codes.shape[1]):
            out += np.bitwise_count(codes[:, w][:, None] ^ self.words[None, :, w])
        return out

    def probe(self, codes: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code, row) of all pairs within the codes' radii, probed at most, from the substring indexes."""
        seen = np.zeros((len(codes), len(self.words)), bool)
        upto = np.array(self.upto)
        full, rest = np.divmod(radius, len(self.tables))
        chunks = np.ascontiguousarray(codes).view(np.uint16)
        for c, (starts, rows) in enumerate(self.tables):
            times = upto[np.maximum(0, np.where(c <= rest, full, full - 1) + 1)]
            q = np.repeat(np.arange(len(codes)), times)
            value = (chunks[q, c] ^ self.flips[_ranges(np.zeros(len(codes), np.int64), times)]).astype(np.int64)
            length = starts[value + 1] - starts[value]
            seen[np.repeat(q, length), rows[_ranges(starts[value], length)]] = True
        q, row = np.nonzero(seen)
        near = np.bitwise_count(codes[q] ^ self.words[row]).sum(axis=1) <= radius[q]
        return q[near], row[near]

    def within(self, codes: np.ndarray, radius: np.ndarray, far: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(code, row) of all pairs within the codes' radii (none below 0), probed or, beyond what is probed, compared one by one."""
        if far is not None:
            return np.nonzero(far <= radius[:, None])
        few = np.flatnonzero((radius >= 0) & (radius <= self.probed))
        many = np.flatnonzero(radius > self.probed)
        a, b = self.probe(codes[few], radius[few])
        c, d = np.nonzero(self.far(codes[many]) <= radius[many][:, None])
        return np.concatenate((few[a], many[c])), np.concatenate((b, d))


def _ranges(starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    return np.repeat(starts - np.concatenate(([0], np.cumsum(length)[:-1])).astype(np.int64), length) + np.arange(length.sum())


class Block:
    """Rows by length, longest first; copies: how many rows each stands for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray, coder: Coder):
        length = lengths(vectors)
        order = np.argsort(-length, kind="stable")
        self.ids, self.vectors, self.copies, self.coder = ids[order], vectors[order], copies[order], coder
        words, length = coder.words(self.vectors), length[order]
        self.starts = np.unique(np.linspace(0, len(ids), BANDS + 1).astype(np.int64))
        self.bands = [Band(words[i:j], float(length[i])) for i, j in zip(self.starts, self.starts[1:])]

    def scored(self, ids: np.ndarray, queries: np.ndarray, q: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of pairs, a row for each copy but the query's own, k at most."""
        score = np.concatenate([(self.vectors[row[i : i + 65536]] * queries[q[i : i + 65536]]).sum(axis=1) for i in range(0, len(row), 65536)] or [np.zeros(0)])
        times = self.copies[row]
        same = np.flatnonzero(self.ids[row] == ids[q])
        own = same[(self.vectors[row[same]] == queries[q[same]]).all(axis=1)]
        times[own] -= 1
        return tuple(np.repeat(x, np.minimum(times, k)) for x in (q, self.ids[row], score))

    def nearest(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of each query's k best rows besides its own."""
        parts = []
        for i in range(0, len(ids), GROUP):
            q, found, score = self._nearest(ids[i : i + GROUP], queries[i : i + GROUP], k)
            parts.append((q + i, found, score))
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _nearest(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, length = self.coder.words(queries), lengths(queries)
        first = FIRST * k
        # First the rows of smallest radius: their k-th score bounds the radius that is needed.
        found = [band.probe(codes, np.full(len(ids), band.probed)) if band.probed >= 0 else (np.zeros(0, np.int64),) * 2 for band in self.bands]
        q, row = (np.concatenate(x) for x in zip(*((q, row + s) for (q, row), s in zip(found, self.starts))))
        seen = np.bincount(q, minlength=len(ids))
        far: list[np.ndarray | None] = [None] * len(self.bands)
        if (seen < first).any():
            far = [band.far(codes) for band in self.bands]
            like = np.concatenate([np.float32(band.longest) * _COSINE[f] for band, f in zip(self.bands, far)], axis=1)
            step = max(1, like.shape[1] // 1024)
            sample = np.sort(like[:, ::step], axis=1)
            bound = sample[:, -min(sample.shape[1], -(-first // step))]
            q, row = np.nonzero(like >= bound[:, None])
        least = np.full(len(ids), -np.inf)  # the k-th best score so far
        q, _, score = self._best(*self.scored(ids, queries, q, row, k), k)
        at = _places(q, len(ids)) == k - 1
        least[q[at]] = score[at]
        radius = [self.coder.radius_at(np.maximum(-1.0, least / np.maximum(length * band.longest, TINY))) for band in self.bands]
        found = [band.within(codes, r, f) for band, r, f in zip(self.bands, radius, far)]
        q, row = (np.concatenate(x) for x in zip(*((q, row + s) for (q, row), s in zip(found, self.starts))))
        return self._best(*self.scored(ids, queries, q, row, k), k)

    @staticmethod
    def _best(q: np.ndarray, found: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((found, -score, q))
        q, found, score = q[order], found[order], score[order]
        kept = _places(q, int(q[-1]) + 1 if len(q) else 0) < k
        return q[kept], found[kept], score[kept]


def _places(q: np.ndarray, n: int) -> np.ndarray:
    """The place of each of sorted values among its equals."""
    return np.arange(len(q)) - np.searchsorted(q, np.arange(n))[q] if len(q) else q


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """id, v (doubles), copies of the distinct rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    rows = rows.where("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(v, x -> x != 0)")
    return rows.groupBy("id", "v").agg(F.count("*").alias("copies"))


SCHEMA = "query_id long, rank int, vec_id long, score double"


def search(df: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row whose vec_id is divisible by every."""
    rows = usable(df)
    sizes = sorted(rows.groupBy(F.size("v").alias("d")).count().collect())
    parts = [_search(rows.where(F.size("v") == d), n, d, every, k) for d, n in sizes]
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], SCHEMA)


def _search(rows: DataFrame, n: int, d: int, every: int, k: int) -> DataFrame:
    """search() of n distinct rows of d components."""
    spark = rows.sparkSession
    key = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30))
    sample = rows.where(key <= int(min(1.0, 2 * SAMPLE / n) * (1 << 30))).select(key.alias("key"), "id", "v").orderBy("key", "id", "v").limit(SAMPLE).select("v").collect()
    if not sample:  # few rows, none of small hash
        sample = rows.orderBy("id", "v").limit(SAMPLE).select("v").collect()
    sent = spark.sparkContext.broadcast(Coder(np.array([r[0] for r in sample], float)))  # BITS * d doubles
    blocks = max(1, -(-n // max(1, min(BLOCK, BLOCK_VALUES // d))))
    # Rows go to one block; queries to every block, after its rows.
    held = rows.select(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "v", "copies")
    asked = rows.where(F.col("id") % every == 0).select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "v", "copies")
    dealt = held.unionByName(asked).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple]:
            for b in batches:
                if not b.num_rows:
                    continue
                block, kind, ids, copies = (b.column(i).to_numpy() for i in (0, 1, 2, 4))
                v = b.column(3).flatten().to_numpy().reshape(b.num_rows, -1)
                cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
                for i, j in zip([0, *cuts], [*cuts, len(ids)]):
                    yield (int(block[i]), int(kind[i])), ids[i:j], v[i:j], copies[i:j]

        own = None
        for (block, kind), got in groupby(parts(), key=lambda p: p[0]):
            if kind == 0:
                own = (block, Block(*(np.concatenate(x) for x in list(zip(*got))[1:]), sent.value))
                continue
            if own is None or own[0] != block:
                continue
            for _, ids, v, copies in got:
                for at in range(0, len(ids), QUERIES):
                    asked = ids[at : at + QUERIES]
                    q, found, score = own[1].nearest(asked, v[at : at + QUERIES], k)
                    yield pa.RecordBatch.from_arrays([pa.array(asked[q]), pa.array(copies[at : at + QUERIES][q]), pa.array(_key(v[at : at + QUERIES])[q]), pa.array(found), pa.array(score)], ["query_id", "copies", "vector", "vec_id", "score"])

    best = dealt.mapInArrow(run, "query_id long, copies long, vector long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id"))
    best = best.withColumn("rank", rank).where(F.col("rank") <= k)
    # Rows of equal id and vector ask alike: each gets its own answer.
    best = best.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    return best


def _key(vectors: np.ndarray) -> np.ndarray:
    """A hash of each vector, which tells queries of equal id apart."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest(v.tobytes()) - (1 << 63) for v in np.ascontiguousarray(vectors)], np.int64)
