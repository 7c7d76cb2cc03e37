"""Shared pieces: shared-folder checkpoints, Arrow streaming by key, hashing of words and n-grams."""

from __future__ import annotations

import tempfile
import unicodedata
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK = (1 << 64) - 1
#: Odd multiplier of the rolling polynomial, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch, unless the session says otherwise: ten thousand whole texts are too many to hold at once on either side.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":  # Spark's own default
        spark.conf.set(key, BATCH_ROWS)


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; one of this machine only where that is unset and the session has no other machines."""
    if found := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-"))
    return spark.sparkContext.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: smaller than a checkpoint, and its columns can be pruned."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a table that this program has written."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


def fold_of(doc_id) -> F.Column:
    """crc32 of the id's decimal text modulo 4; fold 2 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def named(columns: Iterable[str]) -> list[F.Column]:
    """Columns by their whole names, dots included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def fresh(name: str, taken: Iterable[str]) -> str:
    """A name like the one given that none of those taken equals, whatever the case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def map_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], more: Iterable[T.StructField] = ()) -> DataFrame:
    """df.mapInArrow(run) to df's own columns, whatever their names, and more; run must go by places."""
    names, more = df.columns, list(more)
    plain = df.toDF(*(f"c{i}" for i in range(len(names))))
    kept = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields)]
    added = [T.StructField(f"m{i}", f.dataType) for i, f in enumerate(more)]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(batches):
            yield pa.RecordBatch.from_arrays(b.columns, [f.name for f in (*kept, *added)])

    return plain.mapInArrow(placed, T.StructType([*kept, *added])).toDF(*names, *(f.name for f in more))


def values(column: pa.ChunkedArray | pa.Array) -> Iterator:
    for x in column:
        yield x.as_py()


def batches_of(rows: Iterator[tuple], schema: pa.Schema, most: int = 2048, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows to Arrow batches bounded in rows and, roughly, in bytes."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (str, bytes, list)))
        if len(held) >= most or size >= most_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Consecutive rows of equal key, streamed: rows of a group are never held here."""
    from itertools import groupby

    def rows() -> Iterator[dict]:
        for b in batches:
            names = b.schema.names
            for start in range(0, b.num_rows, 512):
                part = b.slice(start, 512)
                for row in zip(*(c.to_pylist() for c in part.columns)):
                    yield dict(zip(names, row))

    return groupby(rows(), key=lambda r: tuple(r[k] for k in keys))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    if len(_Powers.up) < n:
        size = max(n, 4096)
        with np.errstate(over="ignore"):
            for name, base in (("up", BASE), ("down", BASE_INV)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(_Powers, name, np.multiply.accumulate(steps))
    return _Powers.up[:n], _Powers.down[:n]


_WORD: list[np.ndarray] = []


def word_table() -> np.ndarray:
    """For each code point, whether it belongs to a word: letters, digits and combining marks."""
    if not _WORD:
        t = np.zeros(0x110000, bool)
        for cp in [*range(0xD800), *range(0xE000, 0x32000)]:
            t[cp] = unicodedata.category(chr(cp))[0] in "LNM"
        _WORD.append(t)
    return _WORD[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word of the lower-cased text, in order; words are runs of word_table() code points."""
    return next(hashed([text]))


#: Characters hashed at a time.
HASHED = 1 << 16


def hashed(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """word_hashes() of each text; short texts are hashed together."""
    held: list[str] = []
    size = 0
    for text in texts:
        low = (text or "").lower()
        if held and size + len(low) > HASHED:
            yield from _hash(held)
            held, size = [], 0
        held.append(low)
        size += len(low) + 1
    if held:
        yield from _hash(held)


def _hash(texts: list[str]) -> Iterator[np.ndarray]:
    cps = code_points(" ".join(texts))
    inside = np.zeros(len(cps) + 2, bool)
    np.take(word_table(), cps, out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    up, down = powers(len(cps) + 1)
    total = np.zeros(len(cps) + 1, np.uint64)
    np.multiply(cps + np.uint32(1), up[: len(cps)], out=total[1:])
    np.cumsum(total, out=total)
    h = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    at = 0
    cuts = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])).tolist()
    for cut in cuts:
        yield h[at:cut]
        at = cut


#: Odd multipliers that keep the place of a word in its shingle.
PLACES = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) | 1 for i in range(64)], np.uint64)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word shingles in order; a shorter non-empty text has one shingle of all its words."""
    k = min(n, len(words))
    if not k:
        return np.zeros(0, np.uint64)
    m = len(words) - k + 1
    h = np.full(m, k, np.uint64)
    for j in range(k):
        h += words[j : j + m] * PLACES[j]
    return mix(h)
