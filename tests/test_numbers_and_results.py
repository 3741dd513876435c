"""FN-9, EVL-8, EVL-9, SNK-6 and TAX-3 on rows made by hand."""

import hashlib

import pytest
from pyspark.sql import functions as F

from attestry.functions import scalars as sc
from attestry.operators import evaluate as ev
from attestry.operators import taxonomy
from attestry.sources import writers


def test_six_digits(spark):
    values = [0.0, 1.0, -12.5, 100.0, 120000.0, 123456.0, 1234567.0, 999999.7, 0.0001, 0.00001234, -1e-300, 3.14159265, 1e100, 99999.96, float("inf"), float("-inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = [r[0] for r in df.select(sc.significant(F.col("v"))).collect()]
    assert got == [f"{v:.6g}" for v in values] + [None]


def test_close(spark):
    df = spark.createDataFrame([(1.0, 1.0 + 1e-10), (1.0, 1.1), (0.0, 1e-12), (1e12, 1e12 + 1), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(sc.close(F.col("a"), F.col("b"))).collect()] == [True, False, False, True, None]
    assert [r[0] for r in df.select(sc.close(F.col("a"), F.col("b"), 0.0, 1e-9)).collect()] == [True, False, True, False, None]


def test_holdout_groups(spark):
    rows = [(1, "F", "O"), (2, " unclassified ", "O"), (3, "", None), (4, None, "F"), (5, "F", None)]
    out = {r.id: (r.heldout_group, r.split) for r in ev.holdout(spark.createDataFrame(rows, "id long, family string, order string"), ["family", "order"], "id").collect()}
    want = {1: "family:F", 2: "order:O", 3: "sequence:3", 4: "order:F", 5: "family:F"}
    split = lambda g: "heldout" if int.from_bytes(hashlib.sha256(g.encode()).digest()[:8], "big") % 5 == 0 else "development"
    assert out == {i: (g, split(g)) for i, g in want.items()}
    with pytest.raises(ValueError):
        ev.holdout(spark.createDataFrame(rows, "id long, family string, order string"), ["family"], "id", 1)


def test_results_of_every_rank(spark):
    rows = [("dna", "heldout", "A", "A", "NA", "a", "", "a"), ("dna", "heldout", "A", None, "B", "unclassified", "x", "y"), ("dna", "development", "B", "B", "B", None, None, None)]
    df = spark.createDataFrame(rows, "type string, split string, truth_genus string, strict_genus string, exploratory_genus string, truth_species string, strict_species string, exploratory_species string")
    got = {(r.split, r["rank"], r.mode): (r.eligible, r.called, r.correct, r.incorrect, r.coverage, r.precision) for r in ev.rank_results(df, "type", "split", ["genus", "species"]).collect()}
    assert got == {
        ("all", "genus", "strict"): (3, 2, 2, 0, 2 / 3, 1.0), ("all", "genus", "exploratory"): (3, 2, 1, 1, 2 / 3, 0.5), ("heldout", "genus", "strict"): (2, 1, 1, 0, 0.5, 1.0), ("heldout", "genus", "exploratory"): (2, 1, 0, 1, 0.5, 0.0),
        ("development", "genus", "strict"): (1, 1, 1, 0, 1.0, 1.0), ("development", "genus", "exploratory"): (1, 1, 1, 0, 1.0, 1.0), ("all", "species", "strict"): (1, 0, 0, 0, 0.0, None), ("all", "species", "exploratory"): (1, 1, 1, 0, 1.0, 1.0),
        ("heldout", "species", "strict"): (1, 0, 0, 0, 0.0, None), ("heldout", "species", "exploratory"): (1, 1, 1, 0, 1.0, 1.0),
    }


def test_manifest_is_verified(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "i long, s string")
    recorded = writers.manifest({"a": a, "b": a, "c": a, "gone": a}, {"k": "v"})
    swapped = spark.createDataFrame([(1, None), (2, "x")], "i long, s string")
    got = {r.output: r.status for r in writers.verify_manifest({"a": a.repartition(3), "b": a.limit(1), "c": swapped, "new": a}, recorded).collect()}
    assert got == {"a": "unchanged", "b": "changed", "c": "changed", "gone": "missing", "new": "unrecorded"}


def test_tiers_by_rule(spark):
    df = spark.createDataFrame([("net", "High", 0), ("net", "medium", 0), ("net", None, 0), ("loci", None, 2), ("loci", None, None)], "tool string, level string, loci int")
    rules = [((F.col("tool") == "net") & F.lower("level").contains("high"), "high"), ((F.col("tool") == "net") & F.lower("level").contains("medium"), "moderate"), (F.col("loci") >= 2, "moderate")]
    tier = taxonomy.claim_tier(rules)
    assert [tuple(r) for r in df.select(tier, taxonomy.tier_score(tier)).collect()] == [("high", 3), ("moderate", 2), ("provisional", 1), ("moderate", 2), ("provisional", 1)]


def test_six_digits_at_a_tie(spark):
    """Half way by its shortest decimal form, a number went up; C goes by its binary value."""
    values = [1.000005, 2.000005, 1.000015, 100000.5, 100001.5, -0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(sc.significant(F.col("v"))).collect()] == [f"{v:.6g}" for v in values[:-1]] + ["0"]
