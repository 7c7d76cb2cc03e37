"""N-gram Jaccard self-join by MinHash banding, with exact verification on full shingle sets.

Texts with equal shingle sets form one class of copies, which takes part once.  Rows
of the signature are cut into bands; classes are shuffled on band hashes; the classes of
a bucket are compared on their full sets.  Neither copies nor buckets are expanded to
pairs of rows: a bucket's task counts each class's links and returns a star for each of its
components.  A bucket of more than BLOCK classes (or BLOCK_BYTES of sets) is cut into
blocks, and each pair of blocks is a task of bounded size, so that nothing is
dropped.  A pair that meets in several buckets counts in its first band alone; a bucket with the
same members as one of an earlier band is left out, as all its pairs were counted there.

Edge cases: null texts and texts without words have no shingles, link to nothing and are their
own class; texts with fewer than n words have one shingle; rows with a null id link to
nothing and have a null class; repeated rows are copies of each other; ties in the
least id of a class are broken by the fingerprint; texts of any length are read whole; an empty table gives no rows;
other columns, also of clashing names, are ignored (keep_one keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.common import batches_of, checkpoint, groups_of, hashed, map_rows, mix, shingles, values, word_hashes
from linkloom.llm.graph import components

WORDS, THRESHOLD, RECALL, HASHES = 5, 0.8, 0.999, 128
#: Classes, and bytes of shingle sets, that one side of a task holds.
BLOCK, BLOCK_BYTES = 512, 3 << 20
#: Bytes of a shingle's hash that are shuffled.
WIDTH = 6
#: Bits of a bitmap of ids for each id, and in all at most.
MARKS, MOST_MARKS = 16, 1 << 26


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose least number of bands for the recall fits into hashes."""
    best = (1, 1)
    for rows in range(1, 17):
        missed = 1.0 - threshold**rows
        bands = max(1, int(np.ceil(np.log(1.0 - recall) / np.log(missed)))) if missed > 0 else 1
        if bands * rows <= hashes:
            best = (bands, rows)
    return best


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of WIDTH bytes."""
    return set_of(word_hashes(text), n)


def set_of(words: np.ndarray, n: int) -> np.ndarray:
    return np.unique(shingles(words, n) >> np.uint64(64 - 8 * WIDTH))


def fingerprint(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def signature(own: np.ndarray, bands: int, rows: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    wide = mix(own)
    for at in range(0, len(wide), 2048):
        np.minimum(least, (wide[None, at : at + 2048] * a[:, None] + b[:, None]).min(axis=1), out=least)
    h = np.zeros(bands, np.uint64)
    for j in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + least.reshape(bands, rows)[:, j])
    return h.view(np.int64).tolist()


def sketch(df: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, fp (null without shingles), size, bands for every row."""
    bands, rows = bands_for(threshold, recall)
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.binary()), ("size", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _permutations(bands * rows)

        def out() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, words in zip(values(batch.column(0)), hashed(values(batch.column(1)))):
                    own = set_of(words, n)
                    if len(own) and doc_id is not None:
                        yield doc_id, fingerprint(own), len(own), signature(own, bands, rows, a, b)
                    else:
                        yield doc_id, None, len(own), None

        yield from batches_of(out(), schema)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp binary, size long, bands array<long>")


def _pack(own: np.ndarray) -> bytes:
    return own.view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // WIDTH, 8), np.uint8)
    out[:, :WIDTH] = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    return out.view(np.uint64).ravel()


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairwise intersections (exact in float32 below 2**24), by products of blocks of the incidence matrix."""
    kinds, at = np.unique(np.concatenate(sets), return_inverse=True)
    at = at.astype(np.int32)
    times = np.bincount(at, minlength=len(kinds))
    del kinds
    place = (np.cumsum(times > 1) - 1).astype(np.int32)
    often = times[at] > 1
    row = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])[often]
    col = place[at[often]]
    del at, often, times, place
    order = np.argsort(col, kind="stable").astype(np.int32)
    row, col = row[order], col[order]
    del order
    out = np.zeros((len(sets), len(sets)), np.float32)
    step = max(64, (2 << 20) // max(1, len(sets)))
    part = np.zeros((len(sets), step), np.float32)
    for start in range(0, int(col[-1]) + 1 if len(col) else 0, step):
        i, j = np.searchsorted(col, (start, start + step))
        part[:] = 0
        part[row[i:j], col[i:j] - start] = 1
        out += part @ part.T
    return out


def links(sets: list[np.ndarray], bands: np.ndarray, band: int, block: np.ndarray, split: bool, threshold: float) -> np.ndarray:
    """Whether each pair is similar and counts here: no earlier band in common, and of different blocks where split."""
    size = np.array([len(x) for x in sets], np.float64)
    may = np.zeros((len(sets), len(sets)), bool)
    for i in range(0, len(sets), 256):
        a = size[i : i + 256, None]
        may[i : i + 256] = np.minimum(a, size) >= threshold * np.maximum(a, size) - 1e-9
    np.fill_diagonal(may, False)
    if split:
        may &= block[:, None] != block[None, :]
    for t in range(band):
        may &= bands[:, t][:, None] != bands[:, t][None, :]
    if not may.any():
        return may
    if len(sets) == 2:
        inter = np.full((2, 2), len(np.intersect1d(sets[0], sets[1], assume_unique=True)), np.float32)
    else:
        inter = shared(sets)
    for i in range(0, len(sets), 256):
        may[i : i + 256] &= inter[i : i + 256].astype(float) * (1.0 + threshold) >= threshold * (size[i : i + 256, None] + size) - 1e-9
    return may


def roots(linked: np.ndarray) -> np.ndarray:
    """For each row the first row of its component."""
    out = np.full(len(linked), -1)
    for i in range(len(linked)):
        if out[i] < 0:
            out[i] = i
            front = [i]
            while front:
                near = np.flatnonzero(linked[front].any(axis=0) & (out < 0))
                out[near] = i
                front = near.tolist()
    return out


def join(df: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, n_copies, fp, root_fp for every row of doc_id, text.

    class_id is the least id of the component of linked documents, n_links the number
    of other rows whose Jaccard similarity is at least the threshold, n_copies the number of other rows
    with an equal shingle set (part of n_links).
    """
    own, classes, found, nodes = _linked(df, n, threshold, recall)
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    info = (
        classes.select("node", "copies").join(nodes, "node", "left").join(counted, "node", "left")
        .select(F.col("node.fp").alias("fp"), F.coalesce(F.col("root.id"), F.col("node.id")).alias("class_id"), F.coalesce(F.col("root.fp"), F.col("node.fp")).alias("root_fp"), (F.col("copies") - 1).alias("n_copies"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    return own.select("doc_id", "fp").join(info, "fp", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(0)).alias("n_copies"), "fp", "root_fp")


def _linked(df: DataFrame, n: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows; classes of copies (node: least id and fingerprint); counted links of nodes; each linked node's root."""
    own = checkpoint(sketch(df, n, threshold, recall))
    classes = checkpoint(
        own.where("fp IS NOT NULL").groupBy("fp").agg(F.min(F.struct("doc_id", "size", "bands")).alias("x"), F.count("*").alias("copies"))
        .select(F.struct(F.col("x.doc_id").alias("id"), "fp").alias("node"), "copies", "x.size", "x.bands")
    )
    met = classes.select("node", "size", F.posexplode("bands").alias("band", "h"))
    buckets = met.groupBy("band", "h").agg(F.count("*").alias("g"), F.sum("size").alias("total"), F.bit_xor(F.xxhash64("node")).alias("m1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("m2"))
    first = buckets.where("g > 1").groupBy("g", "total", "m1", "m2").agg(F.min(F.struct("band", "h")).alias("x"))
    parts = F.ceil(F.greatest(F.col("g") / BLOCK, F.col("total") * WIDTH / BLOCK_BYTES)).cast("int")
    wanted = first.select("x.band", "x.h", parts.alias("parts"))
    # At most one entry for each band.
    at = met.join(wanted, ["band", "h"]).groupBy("node").agg(F.collect_list(F.struct("band", "h", "parts")).alias("at"))
    ready = classes.join(at, "node").select(F.col("node.id").alias("_id"), "node", "copies", "bands", "at")
    ready = checkpoint(ready)
    # Most texts are in no bucket with others: they aren't moved.
    texts = df.select(F.col("doc_id").cast("long").alias("_id"), "text")
    texts = marked(texts, F.col("_id"), ready.select(F.col("_id").alias("id")), "_may").where("_may").drop("_may").join(ready, "_id")
    found = checkpoint(_compare(texts, n, threshold))
    nodes = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    return own, classes, found, nodes.withColumnRenamed("u", "node")


def _compare(texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """node, root, links from rows _id, text, node, copies, bands, at: a row for each class with links in a task."""
    cells = pa.schema([("band", pa.int32()), ("h", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("block", pa.int32()), ("id", pa.int64()), ("fp", pa.binary()), ("copies", pa.int64()), ("bands", pa.list_(pa.int64())), ("own", pa.binary())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for b in batches:
                for row in zip(*(values(c) for c in b.columns)):
                    _, text, node, copies, bands, at = row
                    own = shingle_set(text, n)
                    if not len(own) or fingerprint(own) != node["fp"]:
                        continue  # another row with a repeated id
                    data = _pack(own)
                    for x in at:
                        block = int.from_bytes(node["fp"][:8], "little") % x["parts"]
                        for other in range(x["parts"]):
                            yield x["band"], x["h"], min(block, other), max(block, other), block, node["id"], node["fp"], copies, bands, data

        yield from batches_of(out(), cells)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for (band, _, i, j), rows in groups_of(batches, ["band", "h", "i", "j"]):
                held = {(r["id"], r["fp"]): r for r in rows}  # repeated rows once
                if len(held) < 2:
                    continue
                keys = sorted(held)
                group = [held[k] for k in keys]
                linked = links([_unpack(r["own"]) for r in group], np.array([r["bands"] for r in group]), band, np.array([r["block"] for r in group]), i != j, threshold)
                if not linked.any():
                    continue
                copies = np.array([r["copies"] for r in group])
                count, root = linked @ copies, roots(linked)
                for k in np.flatnonzero(count):
                    yield keys[k][0], keys[k][1], keys[root[k]][0], keys[root[k]][1], int(count[k])

        yield from batches_of(out(), pa.schema([("id", pa.int64()), ("fp", pa.binary()), ("rid", pa.int64()), ("rfp", pa.binary()), ("links", pa.int64())]))

    keyed = texts.mapInArrow(spread, "band int, h long, i int, j int, block int, id long, fp binary, copies long, bands array<long>, own binary")
    dealt = keyed.repartition("band", "h", "i", "j").sortWithinPartitions("band", "h", "i", "j")
    found = dealt.mapInArrow(compare, "id long, fp binary, rid long, rfp binary, links long")
    return found.select(F.struct("id", "fp").alias("node"), F.struct(F.col("rid").alias("id"), F.col("rfp").alias("fp")).alias("root"), "links")


def marked(rows: DataFrame, key: F.Column, ids: DataFrame, name: str) -> DataFrame:
    """rows with a boolean column of that name: whether the key may be among the ids (of column id); false is certain, as are null keys.

    A bitmap of MARKS bits for each id, MOST_MARKS at most, broadcast as 64-bit words: beyond that more rows are marked, none fewer.
    """
    size = 1 << max(10, min(MOST_MARKS, MARKS * max(1, ids.count()) - 1).bit_length())
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(size))
    bit = place(F.col("id"))
    bits = ids.select(bit.alias("bit")).select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit % 64 AS int))").alias("b"))
    bits = F.broadcast(bits.groupBy("word").agg(F.bit_or("b").alias("bits")))  # MOST_MARKS bits at most
    own = rows.withColumn("bit", place(key)).withColumn("word", F.shiftright("bit", 6)).join(bits, "word", "left")
    hit = F.expr("shiftrightunsigned(bits, cast(bit % 64 AS int)) & 1") == 1
    return own.withColumn(name, F.coalesce(hit & key.isNotNull(), F.lit(False))).drop("bit", "word", "bits")


def keep_one(df: DataFrame) -> DataFrame:
    """The rows of df, all columns, without all but one of each class: its row of least id; texts without words and rows without id stay."""
    names = df.columns
    id_at, text_at = names.index("doc_id"), names.index("text")
    plain = df.toDF(*(f"c{i}" for i in range(len(names))))  # own columns may have any names
    key = F.col(f"c{id_at}").cast("long")
    sketches, classes, _, nodes = _linked(df, WORDS, THRESHOLD, RECALL)
    # Copies are their class's node already, so nothing is joined by a class that may hold a third of all rows.
    others = nodes.where("node != root").select("node")
    kept = classes.join(others, "node", "left_anti").select(F.col("node.id").alias("id"), F.col("node.fp").alias("fp"))
    bare = sketches.where("fp IS NULL AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "fp")
    kept = checkpoint(kept.unionByName(bare).distinct())
    # Ids given to several rows: their fingerprints tell which rows are meant.
    many = sketches.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n")).where("n > 1").select("id")
    many = checkpoint(many)
    gone = sketches.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct().join(kept.select("id").distinct(), "id", "left_anti")
    # Only rows that may go, or whose id isn't their own, are moved.
    split = marked(plain, key, checkpoint(gone.unionByName(many).distinct()), "may")
    sure = split.where("NOT may").drop("may")
    rest = split.where("may").drop("may")
    once = sure.unionByName(rest.join(kept.select("id").distinct(), key == F.col("id"), "left_semi").join(many, key == F.col("id"), "left_anti"))
    if many.isEmpty():
        return once.toDF(*names)

    def fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(own) if len(own := set_of(words, WORDS)) else None for words in hashed(values(b.column(text_at)))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps, pa.binary())], [*b.schema.names, "mark"])

    again = map_rows(rest.join(many, key == F.col("id"), "left_semi"), fingerprinted, [T.StructField("mark", T.BinaryType())])
    again = again.join(kept, (key == F.col("id")) & F.col("mark").eqNullSafe(F.col("fp")), "left_semi")
    texts = again.where("mark IS NOT NULL").withColumn("key", key).dropDuplicates(["key", "mark"]).drop("key")
    return once.unionByName(again.where("mark IS NULL").drop("mark")).unionByName(texts.drop("mark")).toDF(*names)
