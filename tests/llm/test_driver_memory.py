"""What the driver holds: small rounds move and broadcast nothing, and the kernel is summed up some columns at a time."""

import random
import tracemalloc

from attestry.llm import common, mixing, toxicity


def watched(monkeypatch, module):
    """The plan of each table that ``module`` cuts from now on."""
    plans = []

    def cut(df, keep=module.cut):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)

    monkeypatch.setattr(module, "cut", cut)
    return plans


def test_rounds_of_few_cells_stay_in_one_task(spark, monkeypatch):
    rows = [(i, "some words of a text " * (1 + i % 7), "ab"[i % 2], "xyz"[i % 3]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(8)
    cells = mixing.cells_of(docs)
    targets = {m: common.cut(mixing.flattened(cells, m, 0.7)) for m in mixing.MARGINS}
    plans = watched(monkeypatch, mixing)
    few = {(r.source, r.lang, r.topic): r.p for r in mixing.calibrated(cells, targets, 0.6).collect()}
    rounds = [p for p in plans if "Window" in p]
    assert rounds and not any("Exchange" in p for p in rounds)
    monkeypatch.setattr(mixing, "ONE_TASK", 0)
    many = {(r.source, r.lang, r.topic): r.p for r in mixing.calibrated(cells, targets, 0.6).collect()}
    assert few.keys() == many.keys() and all(abs(few[k] - many[k]) < 1e-9 for k in few)


def test_last_rounds_of_components_move_nothing(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(200) if i % 10] + [(500, 501), (501, 500), (7, 7)]
    plans = watched(monkeypatch, common)
    got = dict(common.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect())
    assert len(plans) > 2 and not any("Exchange" in p for p in plans[1:])
    assert got == {i: (i - 1) // 10 * 10 + 1 for i in range(1, 201)} | {500: 500, 501: 500}


def test_kernel_holds_some_columns_at_a_time():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123", k=rng.randint(2, 28))) for _ in range(600)]
    tracemalloc.start()
    try:
        got = toxicity.kernel(words, words[:192])
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert peak < 60
    assert abs(got[:192] - got[:192].T).max() < 1e-9 and abs(got[range(192), range(192)] - 1).max() < 1e-9
    assert abs(toxicity.kernel(words, words[5:22]) - got[:, 5:22]).max() < 1e-9
