"""What a session shares: its folder, and the number of its partitions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; one of our own only on a single machine, where none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="attestry-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Rows moved by key into ``spark.sql.shuffle.partitions`` parts.

    Adaptive execution merges parts by their compressed bytes, so rows that compress well
    would meet in a few tasks, each with the memory of all of them; a given number stays.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def if_small(df: DataFrame, most: int = 500_000) -> DataFrame:
    """Rows that go to every executor if a count finds no more than ``most``, so that what is joined with them stays where it is."""
    return F.broadcast(df) if df.count() <= most else df


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder, by columns, for steps that each take a few of them."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
