"""Files in and out: delimited text, Parquet, workbooks; and the replayable extract."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from linkloom.operators.pool import CANONICAL, IDS, MissingColumns
from linkloom.sources import xlsx


def separator(spark: SparkSession, path: str) -> str:
    """The separator that the first line suggests; comma if none does."""
    first = spark.read.text(path).limit(1).collect()
    try:
        return csv.Sniffer().sniff(first[0][0], delimiters=",;\t|").delimiter if first else ","
    except csv.Error:
        return ","


def read_any(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Any export as strings, so that leading zeros stay; only the columns asked for are read."""
    low = path.lower()
    if low.endswith((".xlsx", ".xlsm")):
        df = xlsx.read(spark, path)
    elif low.endswith((".parquet", ".pq")):
        df = spark.read.parquet(path)
    else:
        df = spark.read.csv(path, header=True, sep=separator(spark, path), multiLine=True, escape='"')
    return df.select(*columns) if columns else df


def read_roles(spark: SparkSession, block: dict, roles: dict[str, str | Sequence[str] | None]) -> DataFrame:
    """ref_id, name, addr1, addr2, city, state, zip from the columns that a block's roles name; absent ones are null."""
    from pyspark.sql import functions as F

    lines = list(roles.get("address") or [])[:2]
    source = {"ref_id": roles["id"], "name": roles.get("name"), "addr1": lines[0] if lines else None, "addr2": lines[1] if len(lines) > 1 else None, "city": roles.get("city"), "state": roles.get("state"), "zip": roles.get("zip")}
    df = read_any(spark, block["path"])
    have = lambda c: c if c in df.columns else None
    return df.select(*(F.col(f"`{c}`").cast("string").alias(k) if (c := have(v)) else F.lit(None).cast("string").alias(k) for k, v in source.items()))


def replay(spark: SparkSession, path: str, ids: Sequence[str] = IDS) -> DataFrame:
    """A saved extract, with the canonical columns checked."""
    df = read_any(spark, path)
    if missing := [c for c in (*CANONICAL, *ids) if c not in df.columns]:
        raise MissingColumns(f"{path} lacks {missing}")
    return df.select(*CANONICAL, *ids) if "ord" not in df.columns else df


def snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path) if path.endswith(".parquet") else df.write.mode("overwrite").option("header", True).csv(path)


def lead(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The columns named that exist, then the others."""
    own = [c for c in first if c in df.columns]
    return df.select(*own, *(c for c in df.columns if c not in own))
