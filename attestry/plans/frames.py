"""The driver's tables in the shapes that the operators take, in Spark and as SQL with the same content.

The supplied tables hold no sequences, so each query applies its operator to an
analogous shape: events are evidence about user-days, order lines are interval calls
on their order, hits of their order on a part, and members of a part by supplier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOOLS = ("marker", "quality", "hallmark", "advisory")
RANKS = ["region", "nation", "supplier"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "error", "cellular").when((F.col("event_type") == "signup") & (F.col("value") < 30), "plasmid").otherwise("virus")
    strength = F.when(F.col("value") >= 100, "strong").when(F.col("value") >= 40, "qualified").otherwise("weak")
    return e.select(
        F.lit("S").alias("sample_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("@"), F.date_format("ts", "yyyy-MM-dd HH")).alias("sequence_id"),
        F.lit(None).cast("string").alias("parent_sequence_id"),
        F.col("event_type").alias("tool"),
        kind.alias("classification"),
        (F.col("value") < 5).alias("review"),
        strength.alias("evidence_strength"),
        "event_id", "user_id", "value", "ts",
    )


EVIDENCE = """evidence AS (
  SELECT 'S' AS sample_id, user_id || '@' || strftime(ts, '%Y-%m-%d %H') AS sequence_id, event_type AS tool,
    CASE WHEN event_type = 'error' THEN 'cellular' WHEN event_type = 'signup' AND value < 30 THEN 'plasmid' ELSE 'virus' END AS classification,
    value < 5 AS review, CASE WHEN value >= 100 THEN 'strong' WHEN value >= 40 THEN 'qualified' ELSE 'weak' END AS evidence_strength,
    event_id, user_id, value, ts
  FROM events)"""


def header(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = evidence(spark, sf_dir)
    extra = e.select("sample_id", F.concat(F.col("user_id").cast("string"), F.lit("@none")).alias("sequence_id"))
    return e.select("sample_id", "sequence_id").unionByName(extra).distinct()


HEADER = "header AS (SELECT DISTINCT sample_id, sequence_id FROM evidence UNION SELECT DISTINCT sample_id, user_id || '@none' FROM evidence)"


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem")
    tool = F.element_at(F.array(*[F.lit(t) for t in TOOLS]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    start = F.col("l_partkey") % 100 + 1
    return x.select(F.col("l_orderkey").alias("parent"), F.lit(160).cast("long").alias("length"), tool.alias("tool"), start.alias("start"), (start + F.col("l_quantity").cast("long") - 1).alias("end"), F.col("l_linenumber").cast("long").alias("line"), F.col("l_extendedprice").alias("score"))


CALLS = """calls AS (
  SELECT l_orderkey AS parent, 160 AS length, CASE l_linenumber % 4 WHEN 0 THEN 'marker' WHEN 1 THEN 'quality' WHEN 2 THEN 'hallmark' ELSE 'advisory' END AS tool,
    l_partkey % 100 + 1 AS "start", l_partkey % 100 + CAST(l_quantity AS BIGINT) AS "end", CAST(l_linenumber AS BIGINT) AS line, l_extendedprice AS score
  FROM lineitem)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("parent"), F.lit(160).cast("long").alias("length"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    out = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return out.select(F.col("s_suppkey").alias("path_id"), F.col("r_name").alias("region"), F.col("n_name").alias("nation"), F.col("s_name").alias("supplier"))


CATALOG = "catalog AS (SELECT s_suppkey AS path_id, r_name AS region, n_name AS nation, s_name AS supplier FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    out = x.join(p, x.l_partkey == p.p_partkey)
    kind = F.when(F.col("p_size") % 2 == 0, "viral").otherwise("cellular")
    return out.select(F.col("l_orderkey").alias("qseqid"), F.col("l_partkey").alias("sseqid"), (F.col("l_extendedprice") / 100).alias("bitscore"), (F.col("l_quantity") * 2).alias("qcovhsp"), kind.alias("reference_class"), F.col("p_type").alias("subject_class"), F.col("l_suppkey").alias("path_id"), F.col("l_linenumber").cast("long").alias("line"))


HITS = "hits AS (SELECT l_orderkey AS qseqid, l_partkey AS sseqid, l_extendedprice / 100 AS bitscore, l_quantity * 2 AS qcovhsp, CASE WHEN p_size % 2 = 0 THEN 'viral' ELSE 'cellular' END AS reference_class, p_type AS subject_class, l_suppkey AS path_id, CAST(l_linenumber AS BIGINT) AS line FROM lineitem JOIN part ON l_partkey = p_partkey)"


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem")
    return x.select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("path_id"), F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("price")).join(catalog(spark, sf_dir), "path_id")
