"""LOC-10 and PRJ-1 (F2, F3, F5, F6): loci move once by record, and queries do no more than they return."""

import contextlib
import io

from attestry.operators import emission
from attestry.plans import registry

SCHEMA = "sample_id string, sequence_id string, locus long, start long, end long, classification string, callers array<string>, reference_id string, bitscore double, evalue double, identity double, qcov double, scov double, margin double, opposing_class string, x string, call_conflict boolean, reference_conflict boolean"
SMALL = "/root/testdata/sf0.001"


def row(i, start, end, kind="viral_supported", x="A"):
    return ("S", "r", i, start, end, kind, ["c"], "ref", 100.0, 0.0, 90.0, 80.0, 80.0, 0.7, None, x, False, False)


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_emitted_loci_move_once(spark):
    loci = spark.createDataFrame([row(1, 10, 60), row(2, 100, 150)], SCHEMA)
    lengths = spark.createDataFrame([("S", "r", 1000)], "sample_id string, sequence_id string, length long")
    assert plan(emission.emit(loci, lengths, ["x"])).count("Exchange hashpartitioning") <= 2  # loci, and lengths unless they are broadcast
    assert plan(registry.QUERIES["locus_emission"](spark, SMALL)).count("Exchange hashpartitioning") <= 5
    gate = plan(registry.QUERIES["emission_gate"](spark, SMALL))
    assert gate.count("Exchange hashpartitioning") <= 5 and "p_name" not in gate


def test_relations_score_nothing(spark, monkeypatch):
    monkeypatch.setattr(emission, "_scored", None)
    assert registry.QUERIES["project_relations"](spark, SMALL).count() > 0


def test_rescored_regions_move_loci_once(spark):
    assert plan(registry.QUERIES["project_rescored"](spark, SMALL)).count("Exchange hashpartitioning") <= 8


def test_a_cluster_votes_by_its_own_loci(spark):
    """A viral locus after a cellular one starts another cluster, even where the last one still reaches over it."""
    rows = [row(1, 10, 60), row(2, 50, 500), row(3, 120, 150, "cellular_supported"), row(4, 200, 210, x="B")]
    lengths = spark.createDataFrame([("S", "r", 1000)], "sample_id string, sequence_id string, length long")
    got = emission.emit(spark.createDataFrame(rows, SCHEMA), lengths, ["x"]).where("output = 'cluster'").collect()
    assert [(r.coordinates, r.hit_loci, r.eligible_loci, r.path, r.taxonomy_conflict) for r in got] == [("10-500", 2, 2, ["A"], False)]
