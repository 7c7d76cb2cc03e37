"""Top-k fuzzy search inside blocks.

Names are scored once, however many rows share them.  The distinct names of a block's targets are dealt to
chunks of bounded size; each distinct name asked for in the block meets each chunk once, streamed, and each
chunk returns its best rows only.  A name is bounded against all of a chunk's names at once, and only those that can be
among the best are scored one by one, which loses none.  So a block with a third of all rows is spread over many
tasks, pairs are never written out, and a task holds one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.functions.fuzzy import Names, pair_score
from linkloom.functions.scores import CELLS

CHUNK = 2048
#: Names asked for that are held at once, and that a task meets with a chunk, about.
ASKED, MET = 256, 1024


class _Chunk:
    """The names of a chunk's targets, form by form."""

    def __init__(self, forms: list[list[str]], ids: list[list[int]]):
        self.forms, self.ids = forms, ids
        self.sizes = np.array([len(x) for x in ids], np.int64)
        self.by_place = [Names([f[i] for f in forms]) for i in range(len(forms[0]))]

    def every_best(self, asked: list[list[str]], keep: int, floor: float) -> Iterator[list[tuple[float, int]]]:
        """For each of asked the keep best (-score, id); only rows that can be among them are scored one by one."""
        step = max(1, CELLS // len(self.ids))
        for i in range(0, len(asked), step):
            part = asked[i : i + step]
            low, high = (np.maximum.reduce(x) for x in zip(*(names.every_bounds(a) for names, a in zip(self.by_place, zip(*part)))))
            yield from (self._best(*x, keep, floor) for x in zip(part, low, high, self._least(low, keep, floor)))

    def _least(self, low: np.ndarray, keep: int, floor: float) -> np.ndarray:
        """For each row of lower bounds what keep targets reach at least; a name counts as often as it has targets."""
        n = low.shape[1]
        top = np.argpartition(low, n - keep, axis=1)[:, n - keep :] if n > keep else np.broadcast_to(np.arange(n), low.shape)
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(low, top, 1), axis=1), 1)
        full = np.cumsum(self.sizes[top], axis=1) >= keep
        first = np.take_along_axis(low, np.take_along_axis(top, full.argmax(axis=1)[:, None], 1), 1)[:, 0]
        return np.where(full.any(axis=1), np.maximum(first, floor), floor)

    def _best(self, forms: list[str], low: np.ndarray, high: np.ndarray, least: float, keep: int, floor: float) -> list[tuple[float, int]]:
        found = []
        for i in np.flatnonzero(high >= least - 1e-9).tolist():
            score = float(low[i]) if low[i] == high[i] else max(pair_score(a, b) for a, b in zip(forms, self.forms[i]))
            # Not against least: a bound and the score itself may differ in their last digit.
            if score >= floor:
                found += [(-score, x) for x in self.ids[i]]
        found.sort()
        return found[:keep]


def best_in_blocks(queries: DataFrame, targets: DataFrame, keep: int, floor: float = 0.0) -> DataFrame:
    """query, block, target, score: best_of_names for each row of queries (query, block, forms)."""
    best = best_of_names(queries, targets, keep, floor)
    return queries.select(F.col("query").cast("long").alias("query"), "block", "forms").distinct().join(best, ["block", "forms"]).select("query", "block", "target", "score")


def best_of_names(queries: DataFrame, targets: DataFrame, keep: int, floor: float = 0.0) -> DataFrame:
    """block, forms, target, score: for each block and forms of queries, once, the keep best rows of targets (target, block, forms).

    forms are arrays of equal length; a pair's score is the best pair_score of its forms at equal places. Ties
    go to the smaller target.
    """
    # Rows of equal forms score alike, and of those only the keep smallest targets can be among the best.
    alike = F.row_number().over(Window.partitionBy("block", "forms").orderBy("target"))
    held = targets.select("block", "forms", F.col("target").cast("long").alias("target")).distinct().withColumn("_n", alike).where(F.col("_n") <= keep)
    held = held.groupBy("block", "forms").agg(F.array_sort(F.collect_list("target")).alias("ids"))
    chunks = held.groupBy("block").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    names = queries.select("block", "forms").distinct()
    parts = names.groupBy("block").agg(F.ceil(F.count("*") / MET).cast("int").alias("parts"))
    among = lambda n: F.pmod(F.xxhash64("forms"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = held.join(chunks, "block").join(parts, "block").select("block", among("chunks").alias("chunk"), each("parts").alias("part"), F.lit(0).alias("kind"), "forms", "ids")
    asked = names.join(chunks, "block").join(parts, "block").select("block", each("chunks").alias("chunk"), among("parts").alias("part"), F.lit(1).alias("kind"), "forms", F.lit(None).cast("array<bigint>").alias("ids"))
    # A number, as few bytes may be much work: else adaptive plans join the parts to one task.
    dealt = own.unionByName(asked).repartition(partitions(queries.sparkSession), "block", "chunk", "part").sortWithinPartitions("block", "chunk", "part", "kind")
    schema = pa.schema([("block", pa.string()), ("forms", pa.list_(pa.string())), ("target", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        def out() -> Iterator[tuple]:
            own, at = None, None
            for (*place, kind), group in groupby(rows(), key=lambda r: r[:4]):
                if kind == 0:
                    held = list(group)
                    own, at = _Chunk([r[4] for r in held], [r[5] for r in held]), place
                    continue
                while own and at == place and (asked := [r[4] for r in islice(group, ASKED)]):
                    for texts, found in zip(asked, own.every_best(asked, keep, floor)):
                        for score, target in found:
                            yield place[0], texts, target, -score

        ready: list[tuple] = []
        for row in out():
            ready.append(row)
            if len(ready) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), schema.types)], schema=schema)
                ready = []
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), schema.types)], schema=schema)

    found = dealt.mapInArrow(run, "block string, forms array<string>, target long, score double")
    rank = F.row_number().over(Window.partitionBy("block", "forms").orderBy(F.desc("score"), "target"))
    return found.withColumn("_n", rank).where(F.col("_n") <= keep).drop("_n")


def partitions(spark: SparkSession) -> int:
    """Partitions for rows that are few but take long."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def with_fallback(queries: DataFrame, targets: DataFrame, every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries none of whose blocks has targets meet all targets (every: target, forms) in a block of their own.

    The second copy of the targets is made only if there is such a query.
    """
    blocks = targets.select("block").distinct()
    placed = queries.where("block IS NOT NULL").join(blocks, "block", "left_semi")
    lost = queries.drop("block").distinct().join(placed.select("query").distinct(), "query", "left_anti")
    if lost.isEmpty():
        return placed, targets
    return placed.unionByName(lost.withColumn("block", F.lit("*"))), targets.unionByName(every.withColumn("block", F.lit("*")))
