"""How often an operator moves its rows: the bytes on disk grow with that."""

import contextlib
import io

from pyspark.sql import functions as F

from attestry.operators import contracts, emission, lineage, normalize, refine, standardize, taxonomy


def exchanges(df) -> int:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue().count("Exchange hashpartitioning")


def test_taxonomy_shuffles_matched_claims_once(spark):
    schema = "claim long, final_id long, tool string, family string, tier int, x string, y string"
    claims = spark.createDataFrame([(1, 1, "t", "f", 2, "A", "p"), (2, 1, "u", "g", 2, "A", None), (3, 1, "v", "h", 3, "Z", None), (4, 2, "t", "f", 3, None, "p")], schema)
    nodes = taxonomy.catalog_nodes(spark.createDataFrame([(1, "A", "p"), (2, "A", "q"), (3, "B", "p")], "p long, x string, y string"), "p", ["x", "y"])
    matched = taxonomy.match_claims(claims, nodes, ["x", "y"]).localCheckpoint()
    # a claim without a node stays, and one with several leads once
    assert sorted((r.claim, r.node is None) for r in matched.where("lead").collect()) == [(1, False), (2, False), (3, True), (4, False)]
    assert matched.where("claim = 4").count() == 2
    resolved = taxonomy.resolve_matched(matched, ["x", "y"])
    assert exchanges(resolved) == 1
    assert exchanges(taxonomy.confidence(resolved, ["x", "y"])) == 1
    got = {r.final_id: r for r in resolved.collect()}
    assert (got[1].exploratory_x, got[1].exploratory_y, got[1].species_status) == ("A", "p", "exploratory_single_moderate")
    assert (got[2].exploratory_x, got[2].exploratory_y, got[2].best_paths, got[2].ambiguous_rank) == (None, "p", 2, 1)
    assert [(s.rank, s.tools, s.families, s.tier) for s in got[1].support] == [(1, ["t", "u"], ["f", "g"], 2), (2, ["t"], ["f"], 2)]
    assert resolved.where(F.col("final_id") == 2).first().support[0].tools == ["t"]


def test_vote_shuffles_once(spark):
    rows = [("k", "A", "p", 2.0, False), ("k", "A", "q", 1.0, False), ("k", "B", None, 0.5, True), ("n", None, None, 3.0, False)]
    votes = spark.createDataFrame(rows, "k string, x string, y string, w double, flag boolean")
    won = lineage.hierarchical_vote(votes, ["k"], ["x", "y"], "w", inherited="flag")
    assert exchanges(won) == 1
    got = {r.k: r for r in won.collect()}
    assert (got["k"].path, round(got["k"].support, 6), got["k"].supporting, got["k"].eligible, got["k"].conflict) == (["A", "p"], round(2 / 3, 6), 2.0, 3.0, True)
    assert (got["n"].path, got["n"].depth, got["n"].support, got["n"].supporting, got["n"].eligible, got["n"].conflict) == ([], 0, 1.0, 3.0, 3.0, False)


def test_scored_loci_are_read_from_one_copy(spark):
    """Every step took its loci through all that made them; now that is done once, and steps read what they need."""
    schema = "sample_id string, sequence_id string, locus long, start long, end long, classification string, callers array<string>, reference_id string, bitscore double, evalue double, identity double, qcov double, scov double, margin double, opposing_class string, x string, call_conflict boolean, reference_conflict boolean"
    row = lambda i, s: ("S", "r", i, s, s + 50, "viral_supported", ["c"], "ref", 100.0, 0.0, 90.0, 80.0, 80.0, 0.7, None, "A", False, False)
    seen = spark.sparkContext.accumulator(0)
    loci = spark.createDataFrame([row(1, 10), row(2, 100), row(3, 900)], schema)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    lengths = spark.createDataFrame([("S", "r", 1000)], "sample_id string, sequence_id string, length long")
    got = emission.emit(loci.mapInArrow(count, loci.schema), lengths, ["x"]).where("output = 'evidence'").collect()
    assert seen.value == 3
    assert [(r.sequence_id, r.viral_supported_loci, r.path) for r in got] == [("r", 3, ["A"])]


def test_lengths_of_all_sources_move_once(spark):
    records = spark.createDataFrame([("a", 10), ("b", 20), (None, 5)], "p string, length long")
    x = spark.createDataFrame([("a", 10), ("a", 10), ("z", 3), (None, 5)], "p string, length long")
    bad = contracts.violations_lengths({"x": x, "y": x.where("p = 'a'")}, records, ["p"], "length", complete=("x", "y"))
    assert exchanges(bad) == 1
    want = [("b", "x", None, 20), ("b", "y", None, 20), ("z", "x", 3, None), (None, "x", 5, None), (None, "x", None, 5), (None, "y", None, 5)]
    assert sorted(map(str, (tuple(r) for r in bad.collect()))) == sorted(map(str, want))


def test_refinement_moves_calls_once(spark):
    """Loci, their numbers and what they select come from windows by parent; advisory calls join all loci they touch, in order."""
    policy = refine.RefinePolicy()
    records = spark.createDataFrame([("p", 500), ("q", 500)], "parent string, length long").localCheckpoint()
    rows = [("marker", 10, 20), ("quality", 20, 30), ("hallmark", 60, 70), ("advisory", 35, 40), ("advisory", 30, 65), ("advisory", 41, 42), ("advisory", 42, 44), ("advisory", 200, 210)]
    evidence = spark.createDataFrame([("p", *r) for r in rows], "parent string, tool string, start long, end long").localCheckpoint()
    grouped = refine.group_calls(refine.boundary_calls(evidence, records, policy, strict=False), policy)
    loci = refine.select_boundaries(grouped, policy, strict=False)
    regions = refine.region_map(records, loci, policy)
    assert exchanges(loci) <= 2  # calls, and records unless they are broadcast
    assert exchanges(regions) <= 3
    got = {}
    for r in grouped.collect():
        got.setdefault(r.locus, set()).add((r.tool, r.start, r.end))
    assert got == {1: {rows[0], rows[1], rows[4]}, 2: {rows[3]}, 3: {rows[5], rows[6]}, 4: {rows[2], rows[4]}, 5: {rows[7]}}
    assert {(r.sequence_id, r.status) for r in regions.collect()} == {("p|region_10_20", "selected_boundary_conflict"), ("q", "unchanged_no_boundary_call")}


def test_window_names_move_once(spark):
    windows = spark.createDataFrame([("a|1", 1, 100), ("a|1", 1, 100), ("b|1", 2, 200), ("b_1", 3, 300), ("c|1", 4, 0), ("c|1", 4, 50), (None, 9, 9)], "window_id string, parent long, offset long")
    results = spark.createDataFrame([(n, 1, 2) for n in ("a|1", "a_1", "b|1", "b_1", "c|1", "c_1", "d", None)], "name string, start long, end long")
    mapped, unclear = normalize.window_to_parent(results, windows, "name")
    assert exchanges(mapped) == 1
    assert {tuple(r) for r in mapped.collect()} == {("a|1", 101, 102, 1, 100), ("a_1", 101, 102, 1, 100), ("b|1", 201, 202, 2, 200)}
    assert {(r["name"], r.n) for r in unclear.collect()} == {("b_1", 2), ("c|1", 2), ("c_1", 2)}


def test_lineages_are_looked_up_in_place(spark, monkeypatch):
    claims = spark.createDataFrame([(1, "A", "p"), (2, "A", "z"), (3, None, "p"), (4, "p", None), (None, "A", "p")], "id long, x string, y string")
    index = spark.createDataFrame([(1, "A"), (1, "A"), (2, "p"), (2, None)], "rank int, taxon string")
    want = {(1, "A", "p", 0), (2, "A", None, 1), (3, None, "p", 0), (4, None, None, 1), (None, "A", "p", 0)}
    got = standardize.best_lineages(claims, index, "id", ["x", "y"])
    assert exchanges(got) <= 2  # the names of each rank only, no claims
    assert {tuple(r) for r in got.collect()} == want
    monkeypatch.setattr(standardize, "BROADCAST_NAMES", 0)
    assert {tuple(r) for r in standardize.best_lineages(claims, index, "id", ["x", "y"]).collect()} == want


def test_region_lists_are_taken_apart_once(spark):
    rows = spark.createDataFrame([("a", "viral,host", "1-5,7-9", 10, 5), ("b", "viral", "1-5", 10, 4)], "id string, types string, spans string, length long, total long").localCheckpoint()
    for df in (standardize.region_faults(rows, "id", "types", "spans", "length", "total"), standardize.viral_regions(rows, "id", "types", "spans", "length", "total", strict=False)):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain()
        taken = [line for line in text.getvalue().splitlines() if "split(" in line]
        assert len(taken) == 1 and taken[0].count("split(") == 2 and "Generate inline" in taken[0]
