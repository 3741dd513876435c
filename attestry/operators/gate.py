"""Routing gate (GATE-1 to GATE-4): which records go on, by the evidence of all sources about them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import set_text


@dataclass(frozen=True)
class GatePolicy:
    """Names of the classes, and the source whose viral rows may report opposing loci of their own."""

    viral: str = "virus"
    opposing: tuple[str, ...] = ("cellular", "plasmid")
    cellular: str = "cellular"
    mixed_source: str = ""
    mixed_column: str = "cellular_supported_loci"


def expand_internal_conflicts(evidence: DataFrame, policy: GatePolicy) -> DataFrame:
    """GATE-2: a viral row of the mixed source that holds cellular loci also counts as cellular."""
    if not policy.mixed_source or policy.mixed_column not in evidence.columns:
        return evidence
    mixed = (F.lower("tool") == policy.mixed_source) & (F.col("classification") == policy.viral) & (F.coalesce(F.col(policy.mixed_column).try_cast("long"), F.lit(0)) > 0)
    classes = F.when(mixed, F.array("classification", F.lit(policy.cellular))).otherwise(F.array("classification"))
    return evidence.withColumn("classification", F.explode(classes))


def gate(header: DataFrame, evidence: DataFrame, policy: GatePolicy = GatePolicy()) -> DataFrame:
    """GATE-1, 3, 4: one audit row for each record of ``header`` (sample_id, sequence_id).

    ``evidence`` has sample_id, sequence_id, parent_sequence_id (null or empty: itself),
    tool, classification and review (rows that don't vote).  Records without evidence
    are unresolved.  Aggregation runs on the evidence alone, by record, and partial
    counts are combined before the shuffle; the header is joined once.
    """
    parent = F.nullif(F.trim("parent_sequence_id"), F.lit(""))
    votes = evidence.where(~F.coalesce("review", F.lit(False))).withColumn("root", F.coalesce(parent, "sequence_id"))
    votes = expand_internal_conflicts(votes, policy)
    classes = (policy.viral, *policy.opposing)
    counts = [c for k in classes for c in (F.count_if(F.col("classification") == k).alias(f"{k}_rows"), F.collect_set(F.when(F.col("classification") == k, F.col("tool"))).alias(f"{k}_tools"))]
    seen = votes.groupBy("sample_id", F.col("root").alias("sequence_id")).agg(*counts)
    out = header.select("sample_id", "sequence_id").join(seen, ["sample_id", "sequence_id"], "left")
    n = {k: F.coalesce(F.size(f"{k}_tools"), F.lit(0)) for k in classes}
    n = {k: F.greatest(v, F.lit(0)) for k, v in n.items()}
    opposed = sum((n[k] for k in policy.opposing), F.lit(0)) > 0
    status = (
        F.when((n[policy.viral] > 0) & opposed, "ambiguous")
        .when(n[policy.viral] >= 2, "viral")
        .when(n[policy.viral] == 1, "likely_viral")
        .when(opposed, "likely_nonviral")
        .otherwise("unresolved")
    )
    columns = [F.coalesce(f"{k}_rows", F.lit(0)).alias(f"{k}_rows") for k in classes] + [set_text(F.coalesce(f"{k}_tools", F.array().cast("array<string>"))).alias(f"{k}_tools") for k in classes]
    return out.select("sample_id", "sequence_id", *columns, status.alias("status")).withColumn("advance", F.col("status").isin("viral", "likely_viral", "ambiguous"))


def candidates(audit: DataFrame) -> tuple[DataFrame, DataFrame]:
    """GATE-4: the records that go on, and the others."""
    return audit.where("advance"), audit.where("not advance")


def gate_summary(audit: DataFrame) -> DataFrame:
    """GATE-4: records by status for each sample."""
    names = ["viral", "likely_viral", "ambiguous", "likely_nonviral", "unresolved"]
    return audit.groupBy("sample_id").agg(F.count("*").alias("records"), *[F.count_if(F.col("status") == s).alias(s) for s in names], F.count_if("advance").alias("advanced"))
