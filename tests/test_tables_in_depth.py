"""Contracts of intervals, region lists, group tables, headers, compressed files, scopes and the final table, on rows made by hand."""

import gzip

import pytest
from pyspark.sql import functions as F

from attestry.operators import contracts as dq
from attestry.operators import harmonize as hz
from attestry.operators import reference, standardize, taxonomy
from attestry.sources import readers


def df(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


# DQ-7


def test_wrapped_intervals(spark):
    parents = df(spark, "p string, length long", ("a", 100), ("b", 100))
    calls = df(spark, "p string, start long, end long, circular boolean", ("a", 1, 100, False), ("a", 60, 140, True), ("a", 60, 160, True), ("a", 60, 161, True), ("a", 60, 140, False), ("a", 0, 5, True), ("a", 7, 3, False), ("b", 101, 120, True), ("c", 1, 2, False), ("a", None, 5, None))
    bad = dq.violations_interval(calls, parents, ["p"], "start", "end", "length", F.col("circular"))
    assert sorted((r.p, r.start, r.end, r.circular) for r in bad.where("start is not null").collect()) == [("a", 0, 5, True), ("a", 7, 3, False), ("a", 60, 140, False), ("a", 60, 161, True), ("b", 101, 120, True), ("c", 1, 2, False)]
    assert bad.where("start is null").count() == 1
    cut = dq.split_wrapped(calls.where("start = 60 and end = 140 and circular").withColumn("length", F.lit(100)), "start", "end", "length")
    assert sorted((r.piece, r.start, r.end) for r in cut.collect()) == [(1, 60, 100), (2, 1, 40)]


def test_lengths_and_sums(spark):
    records = df(spark, "p string, length long", ("a", 10), ("b", 20))
    sources = {"x": df(spark, "p string, length long", ("a", 10)), "y": df(spark, "p string, length long", ("a", 10), ("b", 21), ("z", 3), ("a", None))}
    bad = dq.violations_lengths(sources, records, ["p"], "length", complete=("x",))
    assert {(r.p, r.source, r.declared, r.expected) for r in bad.collect()} == {("b", "x", None, 20), ("b", "y", 21, 20), ("z", "y", 3, None), ("a", "y", None, 10)}
    regions = df(spark, "p string, start long, end long, length long", ("a", 6, 13, 10), ("b", 1, 5, 20), ("b", 8, 9, 20), ("w", 5, 15, 10))
    reported = df(spark, "p string, total long", ("a", 8), ("b", 8), ("c", 0), ("d", 4), ("w", 10))
    assert {(r.p, r.total, r.covered) for r in dq.violations_region_sum(regions, reported, ["p"], "start", "end", "length", "total").collect()} == {("b", 8, 7), ("d", 4, 0)}


# STD-8

LISTS = "id string, types string, spans string, length long, total long"


def test_viral_regions_from_parallel_lists(spark):
    good = df(spark, LISTS, ("a", "host, Viral ,host,viral", "1-10,11-30, 31-40,41-50", 50, 30), ("b", "viral", "5-9", 9, 5))
    got = {(r.sequence_id, r.coordinates, r.region_length, r.record_type, r.parent_sequence_id) for r in standardize.viral_regions(good, "id", "types", "spans", "length", "total").collect()}
    assert got == {("a|provirus_11_30", "11-30", 20, "provirus", "a"), ("a|provirus_41_50", "41-50", 10, "provirus", "a"), ("b|provirus_5_9", "5-9", 5, "provirus", "b")}
    bad = {
        "no_regions": ("NA", "1-2", 9, 2),
        "lists_differ_in_length": ("viral,host", "1-2", 9, 2),
        "bad_coordinate": ("viral,host", "1-2,x-9", 9, 2),
        "beyond_record": ("viral", "1-10", 9, 10),
        "out_of_order": ("viral,viral", "5-6,1-2", 9, 4),
        "no_viral_region": ("host", "1-2", 9, None),
        "sum_differs_from_reported": ("viral", "1-2", 9, 3),
    }
    rows = df(spark, LISTS, *[(k, *v) for k, v in bad.items()])
    assert {r.id: r.fault for r in standardize.region_faults(rows, "id", "types", "spans", "length", "total").collect()} == {k: k for k in bad}
    assert standardize.viral_regions(rows, "id", "types", "spans", "length", "total", strict=False).count() == 0
    for k in bad:
        with pytest.raises(Exception, match=k):
            standardize.viral_regions(rows.where(F.col("id") == k), "id", "types", "spans", "length", "total").collect()


# STD-11

ASSIGNED = "id string, database_domain string, reference string, realm_prediction string, family_prediction string, family_evidence string, subfamily_prediction string, subfamily_evidence string"


def test_group_table(spark):
    regions = df(spark, "id string, length long", ("a", 1), ("b", 2), ("c", 3))
    assigned = df(
        spark, ASSIGNED,
        ("a", "D1", "False", "Ribo", "Fam", "reference", "Subfam", "reference"),
        ("a", "D2", None, "Ribo", "Fam", "network", "novel_sub_1", "reference"),
        ("b", "D1", None, "novel_realm_0", "unplaced_x", "reference", "", None),
        ("b", "D2", "false", "Singleton", "A|B", "reference", None, None),
        ("zz", "D1", "True", "R", "F", "reference", "S", "reference"),  # the database's own
    )
    got = {(r.id, r.database_domain): (r.assignment_status, r.realm, r.family, r.deepest_rank, r.deepest_reference_rank, r.novel_group_ranks, r.unplaced_group_ranks, r.decision) for r in standardize.group_table(regions, assigned, ["D1", "D2"], "id", ["realm", "family", "subfamily"]).collect()}
    missing = ("not_reported", None, None, "", "", "", "", "not_reported")
    assert got == {
        ("a", "D1"): ("clustered", "Ribo", "Fam", "family", "subfamily", "", "", "reference_supported_taxonomy"),
        ("a", "D2"): ("assigned_without_reference_flag", "Ribo", None, "realm", "", "subfamily", "", "realm_only_taxonomy"),
        ("b", "D1"): ("assigned_without_reference_flag", None, None, "", "", "realm", "family", "novel_group_only"),
        ("b", "D2"): ("singleton", None, None, "", "", "", "", "singleton"),
        ("c", "D1"): missing,
        ("c", "D2"): missing,
    }
    for extra in (("a", "D1", None, "", "", None, "", None), ("c", "D1", "1", "", "", None, "", None)):
        with pytest.raises(Exception, match="repeated assignment|reference row"):
            standardize.group_table(regions, assigned.unionByName(df(spark, ASSIGNED, extra)), ["D1"], "id", ["realm", "family", "subfamily"]).collect()


# TAX-9

RANKS = ["domain", "realm", "family", "genus", "species"]


def test_groups_against_strict_rank_and_parents(spark):
    strict = df(spark, "final_id string, length long, strict_domain string, strict_realm string, strict_family string, strict_genus string, strict_species string", *[(i, n, "Viruses", "R", f, None, None) for i, n, f in (("ok", 500, "F"), ("short", 9, "F"), ("taken", 500, "F"), ("two", 500, "F"), ("other", 500, "F"), ("none", 500, "F"), ("mixed", 500, None))])
    groups = df(
        spark, "final_id string, domain_prediction string, realm_prediction string, family_prediction string, genus_prediction string, species_prediction string",
        ("ok", "Viruses", "R", "F", "novel_g1", ""), ("short", "Viruses", "R", "F", "novel_g1", ""), ("taken", "Viruses", "R", "novel_f1", "", ""),
        ("two", "Viruses", "R", "F", "novel_g1", ""), ("two", "Viruses", "R", "F", "Unplaced_g2", ""), ("other", "Viruses", "R", "X", "novel_g1", ""),
        ("none", "Viruses", "default", "Singleton", "novel_g1", "novel_s"), ("mixed", "Viruses", "R", "novel_f2", "novel_g3", None), ("gone", "Viruses", "R", "F", "novel_g1", ""),
    )
    report = taxonomy.group_report(groups, strict, RANKS, 100)
    got = {(r.final_id, r.rank, r.taxon): (r.reason, r.accepted) for r in report.collect()}
    assert got == {
        ("ok", "genus", "novel_g1"): ("reported_compatible_project_group", True),
        ("short", "genus", "novel_g1"): ("below_minimum_length", False),
        ("taken", "family", "novel_f1"): ("strict_rank_already_classified", False),
        ("two", "genus", "novel_g1"): ("ambiguous_groups", False),
        ("two", "genus", "Unplaced_g2"): ("ambiguous_groups", False),
        ("other", "genus", "novel_g1"): ("incompatible_or_unknown_parent_context", False),
        ("none", "genus", "novel_g1"): ("incompatible_or_unknown_parent_context", False),
        ("mixed", "family", "novel_f2"): ("reported_compatible_project_group", True),
        ("mixed", "genus", "novel_g3"): ("reported_compatible_project_group", True),
        ("gone", "genus", "novel_g1"): ("below_minimum_length", False),
    }
    finals = strict.select("final_id").unionByName(df(spark, "final_id string", ("bare",)))
    summary = {r.final_id: (r.labels, r.statuses) for r in taxonomy.group_summary(finals, report).collect()}
    assert summary["bare"] == ([], ["no_project_group"]) and summary["two"] == (["genus:Unplaced_g2", "genus:novel_g1"], ["ambiguous_groups"])


# REF-13, SRC-9, SRC-1


def test_headers(spark):
    wanted = ["Virus GENBANK accession", "Species", "Genus"]
    for headers in (["virus-genbank ACCESSION", "species ", " Genus"], ["Virus GENBANK accession(s) [old]", "SPECIES", "genus"]):
        out = reference.by_headers(df(spark, ", ".join(f"`{h}` string" for h in headers), (" X1 ", None, "g")), wanted, (wanted[0],))
        assert out.columns == wanted and tuple(out.first()) == ("X1", "", "g")
    for headers in (["Virus GENBANK accession", "Species"], ["Virus GENBANK accession", "Species", "species", "Genus"], ["Virus GENBANK accession x", "Virus GENBANK accession y", "Species", "Genus"]):
        with pytest.raises(ValueError, match="expected one column"):
            reference.resolve_columns(headers, wanted, (wanted[0],))
    sheet = df(spark, "at long, value string", (0, "A title"), (1, ""), (2, 'x,"Genus",Species,virus genbank accession'), (3, '1,"a, b",s,Q1'), (4, "2,g"))
    assert sorted(map(tuple, reference.by_first_headers(sheet, wanted).collect())) == [("", "", "g"), ("Q1", "s", "a, b")]
    with pytest.raises(ValueError, match="first 2"):
        reference.by_first_headers(sheet, wanted, within=2)


def test_compression_by_first_bytes(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "plain.gz").write_text("﻿id\tname\r\n1\ta\\tb\r\n2\t\r\n", encoding="utf-8")
    (folder / "packed.txt").write_bytes(gzip.compress(b"name\\tid\nx\\t3\n"))
    got = readers.read_repaired(spark, str(folder), ["id"]).collect()
    assert sorted((r["id"], r["name"]) for r in got) == [("1", "a\\tb"), ("2", ""), ("3", "x")]
    big = tmp_path / "big"
    big.write_text("".join(f"{i}\n" for i in range(20_000)))
    lines = readers.read_lines(spark, str(big))
    split = spark.read.format("magic_text").option("splitBytes", 1000).load(f"file://{big}")
    assert split.rdd.getNumPartitions() > 50
    assert sorted(int(r.value) for r in split.collect()) == list(range(20_000)) and lines.count() == 20_000
    for text, why in (("", "empty"), ("a b\n1\n", "delimited"), ("id\tid\n1\t2\n", "repeated"), ("x\ty\n1\t2\n", "lacks"), ("id\tx\n", "no rows")):
        (tmp_path / "bad").write_text(text)
        with pytest.raises(ValueError, match=why):
            readers.read_repaired(spark, str(tmp_path / "bad"), ["id"])
    (tmp_path / "bad").write_text("id\tx\n1\t2\t3\n")
    with pytest.raises(Exception, match="more values"):
        readers.read_repaired(spark, str(tmp_path / "bad"), ["id"]).collect()


def test_records_of_sequences(spark, tmp_path):
    path = tmp_path / "a.fa"
    path.write_text(">a one\nAC\nGT\n>b\n A C \n")
    assert {(r.id, r.header, r.sequence) for r in readers.read_fasta(spark, str(path)).collect()} == {("a", "a one", "ACGT"), ("b", "b", "AC")}
    for text, why in (("junk\n>a\nAC\n", "before the first"), (">a\nAC\n>a\nGT\n", "repeated"), (">a\n>b\nAC\n", "without id or sequence")):
        path.write_text(text)
        with pytest.raises(ValueError, match=why):
            readers.read_fasta(spark, str(path))


# HRM-2, HRM-3, HRM-14, HRM-18


def test_scope_of_one_source(spark):
    rows = [
        ("r", "p", "p", "Homology ", None, "virus", "provirus", "superseded"),  # a region, no row of its own
        ("r", "p", "p", "marker", None, "virus", "provirus", "used"),
        ("r", "p", "p", "marker", None, "cellular", "provirus", "context"),
        ("r", "p", "r", "marker", None, "plasmid", "provirus", "used"),  # the region itself
        ("r", "p", "p", "homology", None, "cellular", "provirus", "superseded"),
        ("r", "p", "p", "marker", None, "retroelement", "provirus", "used"),  # neither cellular nor plasmid
        ("w", "w", "w", "homology", "", "virus", "input_contig", "used"),
        ("v", "v", "v", "homology", "refined_region", "virus", "input_contig", "used"),
        ("v", "v", "v", "homology", "parent_discovery", "virus", "input_contig", "superseded"),
        ("v", "v", "v", "marker", None, "cellular", "input_contig", "used"),
        ("u", "u", "x", "homology", "refined_region", "virus", "input_contig", "used"),  # another record's region
        ("u", "u", "u", "homology", None, "virus", "input_contig", "used"),
    ]
    e = df(spark, "final_id string, final_parent string, exact_id string, tool string, evidence_scope string, classification string, final_type string, want string", *rows).withColumn("review", F.lit(None).cast("boolean"))
    got = hz.application(hz.prefer_region_scope(e, "homology"))
    assert got.where("not (evidence_application <=> want)").collect() == []


def test_reasons_in_their_order(spark):
    schema = "final_id string, record_type string, confidence string, generic_override boolean, cellular_tools array<string>, plasmid_tools array<string>, parent_viral boolean, region_viral boolean, boundary_disputed boolean, taxonomy_conflict boolean, group_statuses array<string>, sequence_interpretation string, strict_rank string"
    d = df(
        spark, schema,
        ("all", "provirus", "provisional", False, ["x"], ["y"], True, False, True, True, ["ambiguous_groups", "incompatible_or_unknown_parent_context"], "likely_retroelement", "domain"),
        ("none", "input_contig", "high", False, [], [], True, False, False, False, None, "viral_candidate", "genus"),
        ("over", "input_contig", "high", True, ["x"], [], None, None, None, None, [], None, None),
    )
    got = {r.final_id: r.review_reasons for r in hz.review_reasons(d).collect()}
    assert got["none"] == "" and got["over"] == "generic_cellular_conflict_overridden"
    assert got["all"].split(",") == ["region_boundary_homology_discordance", "disputed_boundary_provisional", "single_qualified_viral_tool", "cellular_conflict", "plasmid_conflict", "taxonomy_conflict", "group_ambiguity", "group_context_conflict", "likely_retroelement", "taxonomy_unclassified"]


def test_final_table(spark):
    assert len(hz.METADATA) == 61
    final = df(spark, "final_id string, final_parent string, original_name string, record_type string, coordinates string, original_length int, refined_length long, discovery_status string", ("p|1", "p", "orig", "provirus", "3-9", 20, 7, "viral"), ("q", "q", "o2", "input_contig", "", 5, 5, None))
    decision = df(spark, "final_id string, decision string, confidence string, strong_tools array<string>, qualified_tools string, generic_override boolean, entity string", ("p|1", "retained_provirus", "high", ["b", "a", "b", ""], "z, y", True, "provirus"))
    homology = df(spark, "final_id string, viral_loci string, patterns array<string>, source string", ("p|1", "3.0", ["k"], "clash"))
    rows = {r.final_sequence_id: r.asDict() for r in hz.final_metadata({"final": final, "decision": decision, "homology": homology}).collect()}
    one, two = rows["p|1"], rows["q"]
    assert list(one) == list(hz.METADATA)
    assert (one["normalized_name"], one["region_coordinates"], one["refined_length"], one["viral_decision"]) == ("p", "3-9", "7", "retained_provirus")
    assert (one["strong_tools"], one["qualified_tools"], one["generic_cellular_conflict_overridden"], one["viral_entity_interpretation"]) == ("a,b", "y,z", "true", "provirus")
    assert (one["homology_viral_supported_loci"], one["homology_cellular_supported_loci"], one["homology_origin_pattern"], one["boundary_source"]) == ("3", "0", "k", "NA")
    assert (two["viral_decision"], two["region_coordinates"], two["discovery_status"], two["group_status"], two["taxonomy_conflict"], two["homology_viral_supported_loci"]) == ("NA", "NA", "NA", "no_project_group", "false", "0")
    with pytest.raises(Exception, match="repeats"):
        hz.final_metadata({"final": final, "decision": decision.unionByName(decision)}).collect()
