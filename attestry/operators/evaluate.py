"""Evaluation (EVL-1 to EVL-14) against labelled panels, and between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hash_modulus


def detection_rates(panel: DataFrame, calls: DataFrame, methods: list[str], applicable: DataFrame | None = None) -> DataFrame:
    """EVL-1: detected inputs over all inputs, by panel and method; null where a method doesn't apply to a panel.

    ``panel``: panel, id; ``calls``: method, id.
    """
    sizes = panel.groupBy("panel").agg(F.count_distinct("id").alias("n"))
    seen = panel.join(calls.select("method", "id").distinct(), "id").groupBy("panel", "method").agg(F.count_distinct("id").alias("detected"))
    grid = sizes.withColumn("method", F.explode(F.array(*[F.lit(m) for m in methods])))
    out = grid.join(seen, ["panel", "method"], "left").withColumn("detected", F.coalesce("detected", F.lit(0)))
    if applicable is not None:
        out = out.join(applicable.select("panel", "method", F.lit(True).alias("ok")), ["panel", "method"], "left").withColumn("detected", F.when(F.col("ok"), F.col("detected"))).drop("ok")
    return out.select("panel", "method", "n", "detected", (F.col("detected") / F.col("n")).alias("rate"))


def paired(panel: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """EVL-2: inputs that both, one or neither of two methods call, by panel."""
    out = panel.join(a.select("id", F.lit(1).alias("a")).distinct(), "id", "left").join(b.select("id", F.lit(1).alias("b")).distinct(), "id", "left")
    x, y = F.col("a").isNotNull(), F.col("b").isNotNull()
    return out.groupBy("panel").agg(F.count_if(x & y).alias("both"), F.count_if(x & ~y).alias("only_a"), F.count_if(~x & y).alias("only_b"), F.count_if(~x & ~y).alias("neither"))


def call_matrix(panel: DataFrame, calls: DataFrame, methods: list[str]) -> DataFrame:
    """EVL-3: 0/1 for every input and method."""
    grid = panel.withColumn("method", F.explode(F.array(*[F.lit(m) for m in methods])))
    return grid.join(calls.select("method", "id", F.lit(1).alias("called")).distinct(), ["method", "id"], "left").select("panel", "id", "method", F.coalesce("called", F.lit(0)).alias("called"))


def retention(panel: DataFrame, kept: DataFrame) -> DataFrame:
    """EVL-4: inputs retained intact or as regions, by panel (``kept``: id, record_type)."""
    per = kept.groupBy("id").agg(F.bool_or(F.col("record_type") == "region").alias("as_region"))
    out = panel.join(per, "id", "left")
    got = F.col("as_region").isNotNull()
    return out.groupBy("panel").agg(F.count("*").alias("n"), F.count_if(got).alias("retained"), F.count_if(got & F.col("as_region")).alias("as_region")).withColumn("rate", F.col("retained") / F.col("n"))


def concordance(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """EVL-5: keys that two tables share, or only one has."""
    x, y = a.select(*key).distinct(), b.select(*key).distinct()
    one = x.withColumn("__a", F.lit(1)).join(y.withColumn("__b", F.lit(1)), key, "full")
    return one.agg(F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("shared"), F.count_if(F.col("__b").isNull()).alias("only_a"), F.count_if(F.col("__a").isNull()).alias("only_b"))


def score_distribution(df: DataFrame, group: list[str], fields: list[str]) -> DataFrame:
    """EVL-6: n, smallest, median and largest of each field, long form."""
    pairs = ", ".join(f"'{f}', cast(`{f}` as double)" for f in fields)
    long = df.selectExpr(*group, f"stack({len(fields)}, {pairs}) as (field, value)").where("value is not null")
    return long.groupBy(*group, "field").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.percentile("value", 0.5).alias("median"), F.max("value").alias("high"))


def exclusion_rates(panel: DataFrame, retained: DataFrame, excluded: DataFrame) -> DataFrame:
    """EVL-7: rate of retained inputs before and after a list of inputs is set aside."""
    out = panel.join(retained.select("id", F.lit(1).alias("r")).distinct(), "id", "left").join(excluded.select("id", F.lit(1).alias("x")).distinct(), "id", "left")
    r, x = F.col("r").isNotNull(), F.col("x").isNotNull()
    out = out.groupBy("panel").agg(F.count("*").alias("n"), F.count_if(r).alias("retained"), F.count_if(x).alias("excluded"), F.count_if(r & x).alias("excluded_retained"))
    return out.withColumn("rate", F.col("retained") / F.col("n")).withColumn("adjusted_rate", (F.col("retained") - F.col("excluded_retained")) / F.nullif(F.col("n") - F.col("excluded"), F.lit(0)))


def holdout(df: DataFrame, ranks: list[str], id_col: str, modulus: int = 5) -> DataFrame:
    """EVL-8: ``heldout_group`` and ``split`` (heldout or development), so that groups stay together.

    The group is ``<rank>:<name>`` of the first of ``ranks`` that has a name, so equal
    names of different ranks are different groups; ``unclassified`` is no name, and a row
    without any is a group of its own, ``sequence:<id>``.  The split is the group's hash
    modulo ``modulus`` (2 at least).
    """
    if modulus < 2:
        raise ValueError("a modulus of 2 at least splits")
    named = [F.trim(F.col(r).cast("string")) for r in ranks]
    groups = [F.when((n != "") & (F.lower(n) != "unclassified"), F.concat(F.lit(f"{r}:"), n)) for r, n in zip(ranks, named, strict=True)]
    group = F.coalesce(*groups, F.concat(F.lit("sequence:"), F.col(id_col).cast("string")))
    out = df.withColumn("heldout_group", group)
    return out.withColumn("split", F.when(hash_modulus(F.col("heldout_group"), modulus) == 0, "heldout").otherwise("development"))


def coverage_precision(pred: DataFrame, by: str, split: str, mode: str) -> DataFrame:
    """EVL-9: coverage and precision by type and mode, over all splits and each (``pred``: truth, predicted)."""
    made, right = F.col("predicted").isNotNull(), F.col("predicted") == F.col("truth")
    out = pred.groupingSets([[F.col(by), F.col(mode)], [F.col(by), F.col(split), F.col(mode)]], by, split, mode).agg(F.count("*").alias("n"), F.count_if(made).alias("predicted"), F.count_if(right).alias("correct"))
    out = out.withColumn(split, F.coalesce(split, F.lit("all")))
    return out.withColumn("coverage", F.col("predicted") / F.col("n")).withColumn("precision", F.col("correct") / F.nullif("predicted", F.lit(0)))


def rank_results(pred: DataFrame, by: str, split: str, ranks: list[str], modes: tuple[str, ...] = ("strict", "exploratory")) -> DataFrame:
    """EVL-9: for each type, split (and all), rank and mode: eligible, called, correct, incorrect, coverage, precision.

    ``pred``: ``truth_<rank>`` and ``<mode>_<rank>``.  A row is eligible at a rank whose
    truth is named; empty, ``NA`` and ``unclassified`` are no names.  One pass: rows are
    unfolded by rank and mode, and both levels of splits are grouped together.
    """

    def name(c: str) -> Column:
        text = F.trim(F.col(c).cast("string"))
        return F.when(~F.lower(text).isin("", "na", "unclassified"), text)

    cells = [F.struct(F.lit(r).alias("rank"), F.lit(m).alias("mode"), name(f"truth_{r}").alias("truth"), name(f"{m}_{r}").alias("called")) for r in ranks for m in modes]
    each = pred.select(by, split, F.explode(F.array(*cells)).alias("c")).select(by, split, "c.*").where("truth is not null")
    keys = [F.col(c) for c in (by, "rank", "mode")]
    out = each.groupingSets([keys, [*keys, F.col(split)]], *keys, F.col(split)).agg(F.count("*").alias("eligible"), F.count("called").alias("n_called"), F.count_if(F.col("called") == F.col("truth")).alias("correct"), F.grouping(split).alias("__all"))
    out = out.withColumn(split, F.when(F.col("__all") == 1, "all").otherwise(F.col(split)))
    called = F.col("n_called")
    return out.select(by, split, "rank", "mode", "eligible", called.alias("called"), "correct", (called - F.col("correct")).alias("incorrect"), (called / F.col("eligible")).alias("coverage"), F.try_divide("correct", called).alias("precision"))


def threshold_screen(df: DataFrame, tiers: dict[str, dict[str, float]], group: list[str]) -> DataFrame:
    """EVL-10: rows that pass each tier of minimum values, in one pass over the data."""
    passed = {name: _all([F.col(c) >= v for c, v in mins.items()]) for name, mins in tiers.items()}
    one = df.groupBy(*group).agg(F.count("*").alias("n"), *[F.count_if(p).alias(name) for name, p in passed.items()])
    pairs = ", ".join(f"'{t}', `{t}`" for t in tiers)
    return one.selectExpr(*group, "n", f"stack({len(tiers)}, {pairs}) as (tier, passed)")


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def reconcile(target: DataFrame, source: DataFrame, key: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """EVL-11: the target with the source's missing rows, and (key, column) of values that contradict (missing agrees with all)."""
    out = target.select(*key, *columns).unionByName(source.join(target, key, "left_anti").select(*key, *columns))
    both = target.alias("t").join(source.alias("s"), key)
    text = lambda side, c: F.nullif(F.trim(F.col(f"{side}.{c}").cast("string")), F.lit(""))
    clash = [F.when(text("t", c).isNotNull() & text("s", c).isNotNull() & (text("t", c) != text("s", c)), F.lit(c)) for c in columns]
    return out, both.select(*key, F.explode(F.array_compact(F.array(*clash))).alias("column"))


def run_diff(a: DataFrame, b: DataFrame, key: list[str], signature: list[str]) -> DataFrame:
    """EVL-12: keys gained, lost, changed or unchanged between two runs, by their sorted rows."""
    rows = lambda df, n: df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*signature))).alias(n))
    both = rows(a, "__a").join(rows(b, "__b"), key, "full")
    change = F.when(F.col("__a").isNull(), "gained").when(F.col("__b").isNull(), "lost").when(F.col("__a") == F.col("__b"), "unchanged").otherwise("changed")
    return both.select(*key, change.alias("change"))


def integrity(records: DataFrame, declared: DataFrame, id_col: str, seq: str) -> DataFrame:
    """EVL-13: records whose hash isn't the declared one, or that are missing (``declared``: id, sha256)."""
    seen = records.select(id_col, F.sha2(F.col(seq), 256).alias("now"))
    both = declared.join(seen, id_col, "left")
    return both.where(~F.col("sha256").eqNullSafe(F.col("now"))).select(id_col, F.when(F.col("now").isNull(), "missing").otherwise("changed").alias("problem"))


def totals(rates: DataFrame, kind: Column) -> DataFrame:
    """EVL-14: sensitivity and false-positive rate over all panels of a kind."""
    out = rates.groupBy(kind.alias("kind"), "method").agg(F.sum("detected").alias("detected"), F.sum("n").alias("n"))
    return out.withColumn("rate", F.col("detected") / F.col("n"))
