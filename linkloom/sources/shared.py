"""Tables kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of this machine only where that is unset and the session has no other machines."""
    if found := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-"))
    return spark.sparkContext.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """df written once as Parquet to the shared folder and read from there.

    Plans that meet df several times compute it once, its expressions aren't planned again, and columns and filters
    still reach the scan.
    """
    path = f"{folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
