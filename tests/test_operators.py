"""Operators on small inline tables, empty ones, and random data against sequential versions."""

import random

import pytest
from pyspark.sql import functions as F

from attestry.functions import scalars
from attestry.operators import contracts, gate, harmonize, hits, intervals, lineage, normalize, near_identity, reference, refine, standardize, taxonomy
from attestry.operators import evaluate as ev
from attestry.streaming import completeness


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


EVIDENCE = "sample_id string, sequence_id string, parent_sequence_id string, tool string, classification string, review boolean"


def test_gate_statuses(spark):
    header = table(spark, "sample_id string, sequence_id string", *[("s", x) for x in "abcdef"])
    e = table(
        spark, EVIDENCE,
        ("s", "a", None, "t1", "virus", False), ("s", "a", "", "t2", "virus", False),
        ("s", "b1", "b", "t1", "virus", False), ("s", "b", None, "t1", "virus", False),
        ("s", "c", None, "t1", "virus", False), ("s", "c", None, "t2", "plasmid", False),
        ("s", "d", None, "t1", "cellular", None), ("s", "e", None, "t1", "virus", True),
    )
    got = {r.sequence_id: (r.status, r.advance) for r in gate.gate(header, e).collect()}
    assert got == {"a": ("viral", True), "b": ("likely_viral", True), "c": ("ambiguous", True), "d": ("likely_nonviral", False), "e": ("unresolved", False), "f": ("unresolved", False)}
    assert gate.gate(header.limit(0), e.limit(0)).count() == 0


def test_islands_and_overlap_join_match_sequential(spark):
    rng = random.Random(1)
    rows = [(k, s, s + rng.randrange(30)) for k in range(20) for s in [rng.randrange(300) for _ in range(12)]]
    df = table(spark, "k long, start long, end long", *rows)
    want = {}
    for k in range(20):
        n, reach = 0, -1
        for s, e in sorted((s, e) for kk, s, e in rows if kk == k):
            n += s > reach
            reach = max(reach, e)
            want.setdefault((k, n), []).append((s, e))
    got = {}
    for r in intervals.overlap_groups(df, ["k"]).collect():
        got.setdefault((r.k, r.locus), []).append((r.start, r.end))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    b = df.select("k", F.col("start").alias("s2"), F.col("end").alias("e2"))
    n = intervals.overlap_join(df, b, ["k"], ("start", "end"), ("s2", "e2"), 7).count()
    assert n == sum(1 for a in rows for c in rows if a[0] == c[0] and a[1] <= c[2] and c[1] <= a[2])


def test_gap_clusters_match_sequential(spark):
    rng = random.Random(2)
    rows = [(k, i, rng.choice(["viral", "viral", "neutral", "cellular"])) for k in range(40) for i in range(12)]
    want = set()
    for k in range(40):
        runs, current, gap = [], [], 0
        for _, i, s in (r for r in rows if r[0] == k):
            if s == "viral":
                current.append(i)
                gap = 0
            elif s == "neutral":
                gap += 1
            if s == "cellular" or gap > 1:
                runs.append(current)
                current, gap = [], 0
        runs.append(current)
        want |= {(k, r[0], len(r)) for r in runs if len(r) >= 2}
    out = intervals.gap_clusters(table(spark, "k long, i long, s string", *rows), ["k"], ["i"], F.col("s"))
    assert {(r.k, r.lo, r.viral_count) for r in out.groupBy("k", "cluster", "viral_count").agg(F.min("i").alias("lo")).collect()} == want


def test_vote_matches_sequential(spark):
    rng = random.Random(3)
    rows = [(k, *(x if j < d else None for j, x in enumerate((rng.choice("ab"), rng.choice("pq"), rng.choice("xy")))), float(rng.randrange(1, 9))) for k in range(60) for _ in range(rng.randrange(1, 6)) for d in [rng.randrange(4)]]
    want = {}
    for k in {r[0] for r in rows}:
        path, mine = [], [r for r in rows if r[0] == k]
        while len(path) < 3:
            w = {}
            for r in mine:
                if list(r[1 : 1 + len(path)]) == path and r[1 + len(path)] is not None:
                    w[r[1 + len(path)]] = w.get(r[1 + len(path)], 0) + r[4]
            if not w:
                break
            best = max(w, key=lambda t: (w[t], t))
            if w[best] / sum(w.values()) + 1e-12 < 0.6:
                break
            path.append(best)
        want[k] = path
    df = table(spark, "k long, a string, b string, c string, w double", *rows)
    assert {r.k: r.path for r in lineage.hierarchical_vote(df, ["k"], ["a", "b", "c"], "w").collect()} == want


def test_refine_ladder(spark):
    calls = table(spark, "parent string, length long, tool string, start long, end long", *[
        ("a", 100, "marker", 10, 50), ("a", 100, "quality", 12, 60),
        ("b", 100, "quality", 10, 50), ("b", 100, "hallmark", 40, 60),
        ("c", 100, "hallmark", 1, 30), ("d", 100, "quality", 1, 50), ("d", 100, "advisory", 42, 60),
        ("e", 100, "quality", 1, 50), ("e", 100, "advisory", 31, 60), ("f", 100, "advisory", 1, 9), ("g", 100, "marker", 1, 100),
    ])
    loci = refine.select_boundaries(refine.group_calls(calls, refine.RefinePolicy()))
    got = {r.parent: (r.selected_tool, r.status) for r in loci.collect()}
    assert got["a"] == ("marker", "selected_boundary_conflict")
    assert got["b"][0] == "quality"
    assert got["c"] == (None, "not_selected_hallmark_only")
    assert got["d"] == (None, "not_selected_advisory_overlap_below_threshold")
    assert got["e"] == ("quality", "selected_quality_with_advisory_support")
    assert got["f"] == (None, "not_selected_advisory_only")
    regions = {r.parent: r for r in refine.region_map(calls.select("parent", "length").distinct(), loci).collect()}
    assert regions["g"].record_type == "input_record" and regions["a"].sequence_id == "a|region_10_50"


def test_balanced_lca(spark):
    m = table(spark, "rep string, grp string, x string, y string", ("r", "1", "A", "p"), ("r", "1", "A", "p"), ("r", "2", "A", "q"), ("s", "1", "A", None), ("s", "2", "A", "p"))
    got = {r.rep: (r.x, r.y, r.conflict_rank) for r in lineage.balanced_lca(m, "rep", "grp", ["x", "y"]).collect()}
    assert got == {"r": ("A", None, 2), "s": ("A", "p", 0)}


def test_origin_patterns(spark):
    v, c = "viral_supported", "cellular_supported"
    loci = table(spark, "k string, classification string, score double, qcov double, scov double, margin double, opposing_class string",
                 ("a", v, 50.0, 50.0, 50.0, 1.0, None), ("a", v, 50.0, 50.0, 50.0, 1.0, None), ("b", v, 150.0, 80.0, 80.0, 0.9, None), ("c", v, 90.0, 80.0, 80.0, 0.9, None), ("d", c, 9.0, 9.0, 9.0, -1.0, "P"), ("d", c, 9.0, 9.0, 9.0, -1.0, "Q"))
    got = {r.k: (r.pattern, r.dominant_class) for r in hits.origin_patterns(loci, loci.select("k").limit(0), ["k"]).collect()}
    assert got == {"a": ("predominantly_viral", ""), "b": ("single_locus_viral_rescue", ""), "c": ("isolated_viral_locus", ""), "d": ("predominantly_cellular", "TIED")}


def test_components_of_long_chain(spark):
    edges = table(spark, "a long, b long", *[(i, i + 1) for i in range(40)])
    nodes = spark.range(43).select(F.col("id").alias("node"))
    assert {r.component for r in hits.smallest_labels(edges, nodes).collect()} == {0, 41, 42}


def test_adjudicate_order(spark):
    schema = "final_id string, record_type string, strong_tools array<string>, qualified_tools array<string>, cellular_tools array<string>, plasmid_tools array<string>, sequence_interpretation string, discovery_status string"
    rows = [
        ("a", "input_contig", ["x", "y"], [], ["g"], [], "viral_candidate", "viral"),
        ("b", "provirus", ["x", "y"], [], [], ["p"], "viral_candidate", "viral"),
        ("c", "input_contig", ["x", "y"], [], [], ["p"], "viral_candidate", "viral"),
        ("d", "input_contig", [], ["x"], ["g"], [], "viral_candidate", "ambiguous"),
        ("e", "provirus", [], ["x"], [], [], "viral_candidate", "viral"),
        ("f", "input_contig", ["x"], [], [], [], "likely_retroelement", "viral"),
    ]
    got = {r.final_id: r.decision for r in harmonize.adjudicate(table(spark, schema, *rows), harmonize.DecisionPolicy(generic=("g",))).collect()}
    assert got == {"a": "retained_viral", "b": "ambiguous_review", "c": "retained_viral", "d": "likely_nonviral", "e": "provisional_provirus", "f": "likely_retroelement"}


def test_contracts(spark):
    df = table(spark, "k string, v long", ("a", 1), ("a", 2), ("", 3), ("b", 4))
    assert {r.k for r in contracts.violations_unique(df, ["k"]).collect()} == {"a", ""}
    assert contracts.violations_domain(df, {"small": F.col("v") < 4}).count() == 1
    assert contracts.violations_unique(df.limit(0), ["k"]).count() == 0


def test_tiers_are_nested_and_balanced(spark):
    df = table(spark, "id long, g string", *[(i, "big" if i % 4 else "small") for i in range(80)])
    out = reference.nested_tiers(df, "id", "g", [10, 30], "x").collect()
    assert sorted(r.position for r in out) == list(range(1, 31))
    assert sum(r.g == "small" for r in out if r.tier == 10) == 5


def test_ids_do_not_depend_on_partitions(spark):
    df = spark.range(500).select((F.col("id") % 3).cast("string").alias("s"), F.xxhash64("id").alias("o"))
    want = sorted(map(tuple, normalize.assign_ids(df, "s", ["o"]).select("o", "sequence_id").collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        assert sorted(map(tuple, normalize.assign_ids(df.repartition(int(n)), "s", ["o"]).select("o", "sequence_id").collect())) == want
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_quality_and_argmax(spark):
    df = table(spark, "viral_genes int, host_genes int, quality string, confident boolean, record_type string", (0, 1, "Complete", True, "x"), (0, 0, None, None, "x"), (2, 0, "complete", True, "x"), (2, 3, "low", False, "provirus"), (2, 3, "low", None, "x"))
    assert [r.evidence_strength for r in standardize.quality_ladder(df).collect()] == ["qualified", "weak", "strong", "qualified", "weak"]
    probs = table(spark, "id int, a double, b double", (1, 0.5, 0.5), (2, 0.9, 0.1), (3, 0.3, 0.7))
    assert [r.id for r in standardize.argmax_by_class(probs, ["a", "b"], {"a": 0.8, "b": 0.8}, {"a": "virus", "b": "cellular"}, "t").collect()] == [2]


def test_taxonomy_prefers_backed_paths(spark):
    catalog = table(spark, "p long, x string, y string", (1, "A", "p"), (2, "A", "q"))
    claims = table(spark, "claim long, final_id long, tool string, family string, tier int, x string, y string", (1, 1, "t", "f", 2, "A", "p"), (2, 1, "u", "g", 2, "A", "p"), (3, 1, "v", "h", 3, "A", "q"), (4, 2, "t", "f", 3, "Z", None))
    nodes = taxonomy.catalog_nodes(catalog, "p", ["x", "y"])
    m = taxonomy.match_claims(claims, nodes, ["x", "y"])
    assert {(r.claim, r.first_path) for r in m.join(nodes, "node").collect()} == {(1, 1), (2, 1), (3, 2)}
    r = taxonomy.resolve(claims, m, nodes, ["x", "y"]).first()
    assert (r.exploratory_y, r.conflict_rank, r.strict_x, r.strict_y, r.species_status) == ("q", 2, "A", None, "withheld_species_conflict")


def test_run_diff_and_scalars(spark):
    a, b = table(spark, "k string, v long", ("x", 1), ("y", 1), ("z", 1)), table(spark, "k string, v long", ("x", 1), ("y", 2), ("w", 1))
    assert {r.k: r.change for r in ev.run_diff(a, b, ["k"], ["v"]).collect()} == {"x": "unchanged", "y": "changed", "z": "lost", "w": "gained"}
    one = spark.range(1).select(scalars.interval(F.lit("7-3")).alias("bad"), scalars.interval(F.lit(" 3-7 ")).alias("good"), scalars.first_conflict(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a"), F.lit("c"))).alias("c"), scalars.clean_missing(F.lit(" NA ")).alias("m")).first()
    assert one.bad is None and tuple(one.good) == (3, 7) and one.c == 2 and one.m is None


def test_stream_releases_once(spark, tmp_path):
    src = tmp_path / "in"
    rows = [("a", "x", "k"), ("a", "y", "k"), ("a", "y", "k"), ("b", "x", "k"), ("a", "z", "k")]
    for i, r in enumerate(rows):
        table(spark, "key string, item string, kind string", r).coalesce(1).write.mode("append").parquet(str(src / f"p={i}"))
    stream = spark.readStream.schema("key string, item string, kind string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(src))
    q = completeness.completeness_gate(stream, "key", "item", "kind", {"k": 2}).writeStream.format("memory").queryName("released").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("released").collect()
    assert len(got) == 1 and got[0].key == "a"


def test_near_representatives(spark):
    rng = random.Random(7)
    make = lambda: "".join(rng.choice("ACGT") for _ in range(400))
    a, b = make(), make()
    rows = [(1, a, "x"), (2, a[:200] + "T" + a[201:], "x"), (3, b, "x"), (4, a, "y"), (5, a, "x"), (6, None, "x"), (7, "ACG", "x"), (8, b[4:], "x")]
    out = near_identity.dedup_near(table(spark, "id long, s string, c string", *rows), "id", "s", "c")
    assert {r.id: r.representative for r in out.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1, 6: 6, 7: 7, 8: 3}


def test_near_representatives_by_identity_and_coverage(spark):
    rng = random.Random(11)
    make = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    swap = {"A": "C", "C": "G", "G": "T", "T": "A"}
    edit = lambda s, every: "".join(swap[c] if i % every == every // 2 else c for i, c in enumerate(s))
    a, b, c, frame = make(1000), make(1000), make(1000), make(300)
    rows = [(1, a, "x"), (2, edit(a, 50), "x"), (3, edit(a, 4), "x"), (4, b, "x"), (5, b[:850], "x"), (6, c, "x"), (7, c[:600], "x")]
    # a template: all share wording, some are copies of each other, the smallest is a copy of none
    own = [make(700) for _ in range(8)]
    rows += [(10, frame + make(700), "x")] + [(11 + i, frame + (own[i // 2] if i % 2 == 0 else edit(own[i // 2], 70)), "x") for i in range(16)]
    out = near_identity.dedup_near(table(spark, "id long, s string, c string", *rows), "id", "s", "c")
    want = {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 10: 10} | {11 + i: 11 + i // 2 * 2 for i in range(16)}
    assert {r.id: r.representative for r in out.collect()} == want


def test_bad_boundaries_raise(spark):
    policy = refine.RefinePolicy()
    records = spark.createDataFrame([("p", 100)], "parent string, length long")
    calls = lambda *rows: spark.createDataFrame([("p", *r) for r in rows], "parent string, tool string, start long, end long")
    for bad in ([("marker", 5, 101)], [("marker", 5, 50), ("marker", 5, 50)], [("quality", 0, 9)], [("quality", 9, 8)]):
        with pytest.raises(ValueError):
            refine.boundary_calls(calls(*bad), records, policy)
        assert refine.boundary_calls(calls(*bad), records, policy, strict=False).count() <= 1
    with pytest.raises(ValueError):
        refine.boundary_calls(calls(("marker", 5, 50)), records.where("length < 0"), policy)
    two = refine.group_calls(refine.boundary_calls(calls(("marker", 10, 50), ("marker", 40, 60)), records, policy), policy)
    with pytest.raises(ValueError):
        refine.select_boundaries(two, policy)
    assert refine.select_boundaries(two, policy, strict=False).first().clashing


def test_best_paths_over_nodes(spark):
    """Nodes give the paths and lineages that scoring every catalog path by hand gives, with gaps in claims and in the catalog."""
    rng = random.Random(5)
    ranks = ["x", "y", "z"]
    paths = [(p, f"x{rng.randrange(2)}", rng.choice([None, "y0", "y1", "y2"]), rng.choice([None, f"z{rng.randrange(6)}"])) for p in range(60)]
    claims = [(c, c // 3, f"t{rng.randrange(3)}", f"f{rng.randrange(2)}", rng.randrange(1, 4), *(rng.choice([None, v]) for v in paths[rng.randrange(60)][1:])) for c in range(180)]
    want = {}
    for final in {c[1] for c in claims}:
        scores = {}
        for p in paths:
            backing = [c for c in claims if c[1] == final and any(c[5:]) and all(n is None or n == q for n, q in zip(c[5:], p[1:], strict=True))]
            depths = [max(i + 1 for i in range(3) if c[5 + i]) for c in backing]
            if backing:
                scores[p] = (max(c[4] for c in backing), len({c[3] for c in backing}), sum(c[4] * d for c, d in zip(backing, depths, strict=True)), len({c[2] for c in backing})), max(depths)
        if scores:
            best = [p for p, v in scores.items() if v[0] == max(w[0] for w in scores.values())]
            deep = max(scores[p][1] for p in best)
            want[final] = (len(best), *(best[0][i + 1] if i < deep and len({p[i + 1] for p in best}) == 1 else None for i in range(3)))
    claims = spark.createDataFrame(claims, "claim int, final_id int, tool string, family string, tier int, x string, y string, z string")
    nodes = taxonomy.catalog_nodes(spark.createDataFrame(paths, "p int, x string, y string, z string"), "p", ranks)
    got = taxonomy.resolve(claims, taxonomy.match_claims(claims, nodes, ranks), nodes, ranks).collect()
    assert {r.final_id: (r.best_paths, r.exploratory_x, r.exploratory_y, r.exploratory_z) for r in got} == want
