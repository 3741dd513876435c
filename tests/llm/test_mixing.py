"""Mixing when a value is too rare for its target, and against iterative proportional fitting in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from attestry.llm import mixing

DOCS = "doc_id long, text string, lang string, source string"


def fitted(cells, targets, keep, rounds=3000):
    """p of each cell by raking with cells bounded at 1 / keep, targets within reach."""
    total = sum(cells.values())
    share = {c: n / total for c, n in cells.items()}
    goals = []
    for i, target in enumerate(targets):
        now = {v: sum(s for c, s in share.items() if c[i] == v) for v in target}
        full = set()
        while True:
            taken, free = sum(now[v] / keep for v in full), sum(t for v, t in target.items() if v not in full)
            scale = (1 - taken) / free if free else 0
            more = {v for v, t in target.items() if v not in full and t * scale > now[v] / keep}
            if not more:
                break
            full |= more
        goals.append({v: now[v] / keep if v in full else t * scale for v, t in target.items()})
    g = dict.fromkeys(cells, 1.0)
    for _ in range(rounds):
        for i, goal in enumerate(goals):
            for v, want in goal.items():
                own = [c for c in cells if c[i] == v]
                sure = sum(share[c] / keep for c in own if g[c] >= 1 / keep)
                free = sum(share[c] * g[c] for c in own if g[c] < 1 / keep)
                f = (want - sure) / free if want > sure and free > 0 else want / (sure + free) if want < sure + free else 1.0
                for c in own:
                    g[c] *= f
    return {c: min(1.0, keep * x) for c, x in g.items()}


def shares(df, margin):
    rows = df.groupBy(margin).agg(F.sum(F.col("p") * F.col("tokens")), F.sum("tokens")).collect()
    total = sum(r[1] for r in rows)
    return {r[0]: (r[1] / total, r[1] / r[2]) for r in rows}, total


def test_one_row_of_a_rare_source(spark):
    rows = [(i, "some words of a text " * 30, "en", "big" if i else "rare") for i in range(3001)]
    df = spark.createDataFrame(rows, DOCS)
    out = mixing.mix(df, with_weights=True).persist()
    kept = out.where("kept").count()
    assert 0.57 * 3001 < kept < 0.63 * 3001
    assert out.where("source = 'rare'").first().p == 1.0
    cells = mixing.cells_of(df)
    targets = {m: mixing.flattened(cells, m, 0.7) for m in mixing.MARGINS}
    told = {(r.margin, r.value): r for r in mixing.report(mixing.calibrated(cells, targets, 0.6), targets).collect()}
    rare = told["source", "rare"]
    assert rare.kept == pytest.approx(1) and rare.shortfall > 0.002 and told["source", "big"].shortfall == 0.0
    # exact targets shrink the whole mixture to the rare value, on demand only
    assert mixing.mix(df, with_weights=True, exact=True).where("kept").count() < 0.2 * 3001


def test_against_plain_fitting(spark):
    rng = random.Random(4)
    texts = {"prose": "a word or two " * 50, "short": "a few words here", "table": "a | b"}
    pick = lambda values: rng.choices(values, [70, 25, 5])[0]
    rows = [(i, texts[pick(["prose", "short", "table"])], pick(["en", "de", "fr"]), pick(["s0", "s1", "s2"])) for i in range(4000)]
    df = spark.createDataFrame(rows, DOCS)
    cells = {(r.source, r.lang, r.topic): r.tokens for r in mixing.cells_of(df).collect()}
    wanted = [{"s0": 0.5, "s1": 0.3, "s2": 0.2}, {"en": 0.6, "de": 0.3, "fr": 0.1}]
    targets = {m: spark.createDataFrame(list(t.items()), f"{m} string, target double") for m, t in zip(("source", "lang"), wanted, strict=True)}
    got = {(r.source, r.lang, r.topic): r.p for r in mixing.calibrated(mixing.cells_of(df), targets, 0.5).collect()}
    want = fitted(cells, wanted, 0.5)
    assert {c: round(p, 2) for c, p in got.items()} == pytest.approx({c: round(p, 2) for c, p in want.items()}, abs=0.02)


def test_contradicting_targets_are_told(spark, caplog):
    rows = [(i, "x " * 20, "en" if i % 2 else "de", "a" if i % 2 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, DOCS)
    targets = {"source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, target double"), "lang": spark.createDataFrame([("en", 0.1), ("de", 0.9)], "lang string, target double")}
    out = mixing.mix(df, targets, keep=0.3, with_weights=True)
    assert "aren't met together" in caplog.text and out.count() == 400
    by_source, total = shares(out, "source")
    assert total > 0 and set(by_source) == {"a", "b"}


def test_values_without_a_target_go(spark):
    rows = [(i, "x " * 20, "en", "ab"[i % 2]) for i in range(200)]
    targets = {"source": spark.createDataFrame([("a", 1.0)], "source string, target double")}
    out = mixing.mix(spark.createDataFrame(rows, DOCS), targets, keep=0.9, with_weights=True)
    assert {(r.source, r.p) for r in out.select("source", "p").distinct().collect()} == {("a", 1.0), ("b", 0.0)}
