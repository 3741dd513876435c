"""RFN-6 to RFN-8: the veto, records that a call spans, and the run's figures, on calls made by hand."""

from pyspark.sql import functions as F

from attestry.operators import refine


def test_veto_full_span_and_figures(spark):
    policy = refine.RefinePolicy(hallmark_alone=True)
    records = spark.createDataFrame([(p, 100) for p in ("veto", "one", "span", "none", "mixed", "adv", "quality")], "parent string, length long")
    calls = [
        ("veto", "hallmark", 1, 20), ("veto", "hallmark", 50, 70),  # two fragments that hallmarks alone carry
        ("one", "hallmark", 10, 30),  # a single one is never vetoed
        ("span", "marker", 1, 100),
        ("mixed", "hallmark", 1, 20), ("mixed", "marker", 50, 70), ("mixed", "quality", 55, 80),
        ("adv", "advisory", 5, 9),
        ("quality", "quality", 5, 50), ("quality", "advisory", 10, 40),
    ]
    evidence = spark.createDataFrame(calls, "parent string, tool string, start long, end long")
    found = refine.boundary_calls(evidence, records, policy)
    loci = refine.select_boundaries(refine.group_calls(found, policy), policy)
    votes = spark.createDataFrame([(p, t, s) for p in ("veto", "one", "mixed") for t, s in (("a", "strong"), ("b", "qualified"))] + [("span", "a", "strong")], "parent string, source string, strength string")
    agreed = refine.consensus_parents(votes, {"a": (F.col("source") == "a") & (F.col("strength") == "strong"), "b": (F.col("source") == "b") & F.col("strength").isin("strong", "qualified")})
    regions = refine.region_map(records, loci, policy, agreed)
    got = {(r.sequence_id, r.record_type, r.start, r.end, r.status) for r in regions.collect()}
    assert got == {
        ("veto", "input_record", 1, 100, "preserved_whole_record_consensus"),
        ("one|region_10_30", "region", 10, 30, "selected_single_tool"),
        ("span", "input_record", 1, 100, "selected_full_span_preserved_record"),
        ("none", "input_record", 1, 100, "unchanged_no_boundary_call"),
        ("mixed|region_1_20", "region", 1, 20, "selected_single_tool"),
        ("mixed|region_50_70", "region", 50, 70, "selected_boundary_conflict"),
        ("adv", "input_record", 1, 100, "unchanged_advisory_only"),
        ("quality|region_5_50", "region", 5, 50, "selected_quality_with_advisory_support"),
    }
    one = refine.run_summary(records, found, loci, regions, policy, "S", "rna", 4).first().asDict()
    assert len(one) == 19
    assert one == {
        "sample_id": "S", "input_type": "rna", "input_candidate_count": 7, "unchanged_candidate_count": 4, "refined_parent_count": 3, "refined_region_count": 4, "full_span_call_preserved_count": 1, "whole_record_consensus_veto_count": 1,
        "boundary_call_count": 10, "boundary_conflict_count": 1, "hallmark_only_boundary_call_count": 4, "hallmark_only_locus_skipped_count": 0, "advisory_boundary_call_count": 2, "advisory_only_locus_skipped_count": 1, "quality_only_locus_skipped_count": 0,
        "quality_advisory_supported_locus_count": 1, "advisory_min_overlap_fraction": 0.5, "hallmark_alone_allowed": True, "evidence_file_count": 4,
    }
    # without leave to decide alone, hallmarks select nothing and nothing is left to veto
    strict = refine.RefinePolicy()
    held = refine.region_map(records, refine.select_boundaries(refine.group_calls(found, strict), strict), strict, agreed)
    assert {r.status for r in held.where("parent in ('veto', 'one')").collect()} == {"unchanged_hallmark_only_not_allowed"}
    empty = records.limit(0)
    none = refine.run_summary(empty, found.limit(0), loci.limit(0), regions.limit(0), policy, "S", "dna", 0).first()
    assert none.input_candidate_count == 0 and none.hallmark_only_boundary_call_count == 0
