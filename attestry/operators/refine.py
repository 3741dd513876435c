"""Boundary refinement (RFN-1 to RFN-8): which of several overlapping region calls a record keeps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import overlap, set_text
from ..functions.shared import spread
from .contracts import enforce


@dataclass(frozen=True)
class RefinePolicy:
    """Sources by their role: markers decide alone, hallmarks with quality support, advisory calls only support."""

    marker: str = "marker"
    quality: str = "quality"
    hallmark: str = "hallmark"
    advisory: str = "advisory"
    hallmark_alone: bool = False
    advisory_overlap: float = 0.5
    consensus: tuple[str, ...] = ()

    @property
    def tools(self) -> tuple[str, ...]:
        return self.marker, self.quality, self.hallmark, self.advisory


def boundary_calls(evidence: DataFrame, records: DataFrame, policy: RefinePolicy, strict: bool = True) -> DataFrame:
    """RFN-1: localized viral calls of the known tools, inside their parent, without duplicates.

    ``evidence``: parent, tool, start, end; ``records``: parent, length.  Repeated calls,
    and calls outside their parent or of unknown parents, raise; they are left out
    only if ``strict`` is off.
    """
    calls = evidence.where(F.col("tool").isin(*policy.tools) & F.col("start").isNotNull() & F.col("end").isNotNull())
    calls = spread(calls.select("parent", "tool", "start", "end"), "parent").join(records.select("parent", "length"), "parent", "left")
    inside = F.coalesce(F.expr("start >= 1 and start <= end and end <= length"), F.lit(False))
    if strict:
        enforce(calls.where(~inside), "calls outside their parent")
        enforce(calls.groupBy("parent", "tool", "start", "end").count().where("count > 1"), "repeated calls")
    return calls.where(inside).select("parent", "length", "tool", "start", "end").distinct()


def group_calls(calls: DataFrame, policy: RefinePolicy) -> DataFrame:
    """RFN-2, 3: loci of overlapping calls.  Advisory calls join every locus they overlap but never merge loci; the rest form their own.

    Calls of a locus chain, so they cover its span without a gap, and an advisory call
    overlaps the loci whose start isn't after its end, but for those that end before it.
    Windows by parent count them: no call meets another in a join, and no row moves again.
    """
    firm = F.col("tool") != policy.advisory
    by = W.partitionBy("parent")
    along = by.orderBy("start", F.col("tool") == policy.advisory, "end", "tool")
    earlier, until = along.rowsBetween(W.unboundedPreceding, -1), along.rowsBetween(W.unboundedPreceding, 0)
    out = calls.select("parent", "length", "tool", "start", "end").withColumn("__reach", F.max(F.when(firm, F.col("end"))).over(earlier))
    met = F.coalesce(F.col("start") <= F.col("__reach"), F.lit(False))
    out = out.withColumn("__new", (firm & ~met).cast("long")).withColumn("__at", F.sum("__new").over(until))
    # loci that start up to the end of an advisory call
    ends = by.orderBy(F.when(firm, F.col("start")).otherwise(F.col("end")), ~firm).rowsBetween(W.unboundedPreceding, 0)
    out = out.withColumn("__last", F.sum("__new").over(ends)).withColumn("__first", F.when(met, F.col("__at")).otherwise(F.col("__at") + 1))
    alone = ~firm & (F.col("__last") < F.col("__first"))
    out = out.withColumn("__own", F.when(alone, 1).otherwise(0))
    out = out.withColumn("__reach", F.max(F.when(alone, F.col("end"))).over(earlier))
    opens = alone & ~F.coalesce(F.col("start") <= F.col("__reach"), F.lit(False))
    out = out.withColumn("__opens", opens.cast("long")).withColumn("__number", F.sum("__opens").over(until))
    ids = F.when(alone, F.array("__number")).when(firm, F.array("__at")).otherwise(F.sequence("__first", "__last"))
    # a locus is numbered by all loci that start up to its own calls; advisory calls take the number of the loci they join
    out = out.select("parent", "length", "tool", "start", "end", "__own", F.when(firm | alone, F.col("__at") + F.col("__number")).alias("__number"), F.explode(ids).alias("__locus"))
    number = F.min("__number").over(W.partitionBy("parent", "__own", "__locus"))
    return out.select("parent", "length", "tool", "start", "end", number.alias("locus"))


def select_boundaries(grouped: DataFrame, policy: RefinePolicy = RefinePolicy(), strict: bool = True) -> DataFrame:
    """RFN-4, 5: one row for each locus: selected call (or null), status and supporting tools.

    A deciding tool with several calls in one locus is ambiguous and raises; with
    ``strict`` off, ``clashing`` marks such loci and the first call stands.
    """
    p = policy
    call = F.struct("start", "end")
    locus = W.partitionBy("parent", "length", "locus")
    calls = grouped.withColumns({f"c_{t}": F.min(F.when(F.col("tool") == t, call)).over(locus) for t in p.tools})
    # whether an advisory call supports a tool's first call
    backs = lambda t: (F.col("tool") == p.advisory) & (overlap(F.col(f"c_{t}.start"), F.col(f"c_{t}.end"), F.col("start"), F.col("end")) / (F.col("end") - F.col("start") + 1) >= p.advisory_overlap)
    loci = calls.groupBy("parent", "length", "locus").agg(
        *[F.min(f"c_{t}").alias(f"c_{t}") for t in p.tools],
        *[F.count_if(F.col("tool") == t).alias(f"n_{t}") for t in p.tools],
        *[F.bool_or(F.coalesce(backs(t), F.lit(False))).alias(f"b_{t}") for t in p.tools],
        F.count("*").alias("calls"),
        (F.min(call) == F.max(call)).alias("agree"),
    )
    loci = loci.withColumn("tools", F.array_compact(F.array(*[F.when(F.col(f"n_{t}") > 0, F.lit(t)) for t in sorted(p.tools)])))
    has = {t: F.col(f"n_{t}") > 0 for t in p.tools}

    chosen = (
        F.when(has[p.marker], F.lit(p.marker))
        .when(has[p.quality] & has[p.hallmark], F.lit(p.quality))
        .when(has[p.hallmark], F.lit(p.hallmark) if p.hallmark_alone else F.lit(None).cast("string"))
        .when(has[p.quality] & F.col(f"b_{p.quality}"), F.lit(p.quality))
    )
    loci = loci.withColumn("selected_tool", chosen)
    loci = loci.withColumn("selected", F.coalesce(*[F.when(F.col("selected_tool") == t, F.col(f"c_{t}")) for t in p.tools]))
    loci = loci.withColumn("clashing", F.coalesce(*[F.when(F.col("selected_tool") == t, F.col(f"n_{t}") > 1) for t in p.tools], F.lit(False)))
    if strict:
        enforce(loci.where("clashing").select("parent", "locus", "selected_tool"), "several calls of the deciding tool in one locus")
    only = lambda *t: F.col("tools") == F.array(*[F.lit(x) for x in sorted(t)])
    none = F.col("selected").isNull()
    status = (
        F.when(only(p.advisory), "not_selected_advisory_only")
        .when(none & only(p.quality), "not_selected_quality_only")
        .when(none & only(p.quality, p.advisory), "not_selected_advisory_overlap_below_threshold")
        .when(none, "not_selected_hallmark_only")
        .when(only(p.quality, p.advisory), "selected_quality_with_advisory_support")
        .when(F.col("calls") == 1, "selected_single_tool")
        .when(F.col("agree"), "selected_exact_agreement")
        .otherwise("selected_boundary_conflict")
    )
    firm = F.array_remove("tools", p.advisory)
    backed = F.coalesce(*[F.when(F.col("selected_tool") == t, F.col(f"b_{t}")) for t in p.tools], F.lit(False))
    support = F.when(has[p.advisory] & (none | backed), F.col("tools")).otherwise(firm)
    return loci.select("parent", "length", "locus", "calls", "tools", "selected_tool", F.col("selected.start").alias("selected_start"), F.col("selected.end").alias("selected_end"), status.alias("status"), set_text(support, "").alias("supporting_tools"), "clashing")


def consensus_parents(evidence: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """RFN-6: parents for which every source has a row that meets its rule."""
    hits = evidence.groupBy("parent").agg(*[F.bool_or(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    for name in rules:
        hits = hits.where(name)
    return hits.select("parent")


def region_map(records: DataFrame, loci: DataFrame, policy: RefinePolicy = RefinePolicy(), consensus: DataFrame | None = None) -> DataFrame:
    """RFN-6 to RFN-8: the final regions: one row per selected locus, or the intact record.

    Several regions that rest on hallmarks alone (which a policy with
    ``hallmark_alone`` selects) give way to a whole-record consensus; one call that
    spans the record keeps the record's identity.
    """
    p = policy
    by = W.partitionBy("parent")
    own = loci.select("parent", "selected_tool", "selected_start", "selected_end", F.col("status").alias("__status"), F.row_number().over(by.orderBy("locus")).alias("__row"), *[c.over(by).alias(name) for name, c in {
        "n": F.count("selected_start"),
        "__hallmark": F.every(F.coalesce(F.col("selected_tool") == p.hallmark, F.lit(True))),
        "__advisory": F.every(F.col("tools") == F.array(F.lit(p.advisory))),
        "__quality": F.bool_or(F.array_contains("tools", p.quality)),
    }.items()])
    # every record with its loci; those whose record stays intact leave one row of them
    both = records.select("parent", "length").join(own, "parent", "left")
    if consensus is not None:
        both = both.join(consensus.select("parent", F.lit(True).alias("agreed")), "parent", "left")
    else:
        both = both.withColumn("agreed", F.lit(False))
    veto = (F.col("n") >= 2) & F.col("__hallmark") & F.coalesce("agreed", F.lit(False))
    both = both.withColumn("veto", F.coalesce(veto, F.lit(False)))
    whole_status = (
        F.when(F.col("n").isNull(), "unchanged_no_boundary_call")
        .when(F.col("veto"), "preserved_whole_record_consensus")
        .when(F.col("__advisory"), "unchanged_advisory_only")
        .when(F.col("__quality"), "unchanged_quality_candidate_not_corroborated")
        .otherwise("unchanged_hallmark_only_not_allowed")
    )
    intact = F.coalesce(F.col("n"), F.lit(0)).eqNullSafe(0) | F.col("veto")
    both = both.withColumn("intact", intact).where(F.when(F.col("intact"), F.coalesce("__row", F.lit(1)) == 1).otherwise(F.col("selected_start").isNotNull()))
    parent, start, end = F.col("parent").cast("string"), F.col("selected_start"), F.col("selected_end")
    full = ~F.col("intact") & (F.col("n") == 1) & (start == 1) & (end == F.col("length"))
    whole = F.col("intact") | full
    name = F.concat(parent, F.lit("|region_"), start.cast("string"), F.lit("_"), end.cast("string"))
    return both.select(
        "parent",
        F.when(whole, parent).otherwise(name).alias("sequence_id"),
        F.when(whole, "input_record").otherwise("region").alias("record_type"),
        F.when(F.col("intact"), 1).otherwise(start).cast("long").alias("start"),
        F.when(F.col("intact"), F.col("length")).otherwise(end).cast("long").alias("end"),
        F.when(F.col("intact"), whole_status).when(full, "selected_full_span_preserved_record").otherwise(F.col("__status")).alias("status"),
    )


def refine_summary(loci: DataFrame, regions: DataFrame) -> DataFrame:
    """RFN-8: counts by status of loci and of regions, long form."""
    a = loci.groupBy(F.lit("locus").alias("level"), "status").agg(F.count("*").alias("n"))
    return a.unionByName(regions.groupBy(F.lit("region").alias("level"), "status").agg(F.count("*").alias("n")))


def run_summary(records: DataFrame, calls: DataFrame, loci: DataFrame, regions: DataFrame, policy: RefinePolicy, sample_id: str, input_type: str, evidence_files: int) -> DataFrame:
    """RFN-8: the 19 figures of a run as one row.

    ``calls`` as :func:`boundary_calls` gives them, ``loci`` of :func:`select_boundaries`
    (so figures of loci are those before a veto), ``regions`` of :func:`region_map`.
    Empty inputs count 0.
    """
    p = policy
    only = lambda *t: F.col("tools") == F.array(*[F.lit(x) for x in sorted(t)])
    status = lambda *names: F.count_if(F.col("status").isin(*names))
    whole = F.col("record_type") == "input_record"
    of_regions = regions.agg(
        F.count_if(whole).alias("unchanged_candidate_count"),
        F.count_distinct(F.when(~whole, F.col("parent"))).alias("refined_parent_count"),
        F.count_if(~whole).alias("refined_region_count"),
        status("selected_full_span_preserved_record").alias("full_span_call_preserved_count"),
        status("preserved_whole_record_consensus").alias("whole_record_consensus_veto_count"),
    )
    of_loci = loci.agg(
        status("selected_boundary_conflict").alias("boundary_conflict_count"),
        F.coalesce(F.sum(F.when(only(p.hallmark), F.col("calls"))), F.lit(0)).alias("hallmark_only_boundary_call_count"),
        status("not_selected_hallmark_only").alias("hallmark_only_locus_skipped_count"),
        status("not_selected_advisory_only").alias("advisory_only_locus_skipped_count"),
        status("not_selected_quality_only", "not_selected_advisory_overlap_below_threshold").alias("quality_only_locus_skipped_count"),
        status("selected_quality_with_advisory_support").alias("quality_advisory_supported_locus_count"),
    )
    of_calls = calls.agg(F.count("*").alias("boundary_call_count"), F.count_if(F.col("tool") == p.advisory).alias("advisory_boundary_call_count"))
    one = records.agg(F.count("*").alias("input_candidate_count"))
    for part in (of_regions, of_calls, of_loci):  # one row each
        one = one.crossJoin(F.broadcast(part))
    return one.select(
        F.lit(sample_id).alias("sample_id"), F.lit(input_type).alias("input_type"), "input_candidate_count", "unchanged_candidate_count", "refined_parent_count", "refined_region_count", "full_span_call_preserved_count", "whole_record_consensus_veto_count",
        "boundary_call_count", "boundary_conflict_count", "hallmark_only_boundary_call_count", "hallmark_only_locus_skipped_count", "advisory_boundary_call_count", "advisory_only_locus_skipped_count", "quality_only_locus_skipped_count", "quality_advisory_supported_locus_count",
        F.lit(p.advisory_overlap).alias("advisory_min_overlap_fraction"), F.lit(p.hallmark_alone).alias("hallmark_alone_allowed"), F.lit(evidence_files).cast("long").alias("evidence_file_count"),
    )
