"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A side is broadcast only after its rows were counted and found to be at most this many.
BROADCAST_ROWS = 1_000_000
#: Edges that one task takes in a round of :func:`connected_components`.
EDGES = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names; one of our own only on a single machine, where none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="attestry-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage through files that every executor can read, so lost executors cost nothing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The same for large tables: written as Parquet in the shared folder and read again, so that each use reads only its columns."""
    folder = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small_side(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` (narrow) rows, else as it is."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_per_key(rows: DataFrame, per_key: DataFrame, key: list[str], least: int = 10_000) -> DataFrame:
    """``rows`` joined with the one row that ``per_key`` has for each key.

    Keys with more than their share of the rows get theirs by broadcast, so none lands
    in one task; they are fewer than four for each shuffle partition.
    """
    limit = max(least, rows.count() // (4 * partitions(rows.sparkSession)))
    hot = F.broadcast(cut(rows.groupBy(*key).agg(F.count("*").alias("__n")).where(F.col("__n") > limit).drop("__n")))
    few = F.broadcast(per_key.join(hot, key, "left_semi"))
    return rows.join(few, key).unionByName(rows.join(hot, key, "left_anti").join(per_key, key))


def lower_ascii(col):
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); component = smallest node reached.

    Alternating large-star and small-star: every round is two shuffles of the edge
    list, hot nodes are pre-aggregated with ``min``, and no list of neighbours is
    ever collected.  A round runs on as many tasks as its edges need (EDGES each), so
    the last rounds, with few edges left, are windows in one task and need no shuffle
    or broadcast at all.  Nulls and loops are dropped; an empty input gives an empty
    result.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = cut(e)
    n, total = e.count(), None
    for _ in range(max_rounds):
        if n == 0:
            break
        e = e.coalesce(-(-n // EDGES))
        one = n <= EDGES

        def least(df: DataFrame, one: bool = one) -> DataFrame:
            """``df`` with ``m``, the smallest v of each u."""
            return df.withColumn("m", F.min("v").over(W.partitionBy("u"))) if one else df.join(df.groupBy("u").agg(F.min("v").alias("m")), "u")

        # large-star: neighbours above a node move to the smallest neighbour (or the node itself)
        both = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        large = least(both).select("u", "v", F.least("u", "m").alias("m")).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small-star: a node and its neighbours below it move to the smallest of them
        moved = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        nxt = cut(least(large).select(moved.alias("e")).select("e.*").where("u <> v").distinct())
        stats = (nxt.coalesce(1) if one else nxt).agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        e, n = nxt, stats[0]
        if total == tuple(stats):
            break
        total = tuple(stats)
    else:
        raise RuntimeError("connected_components did not converge")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
