"""Data-quality contracts (DQ-1 to DQ-10): every check is a DataFrame of violations, empty when all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.shared import spread


def enforce(violations: DataFrame, message: str) -> None:
    """Raise with a few of the violations if there are any."""
    if rows := violations.limit(3).collect():
        raise ValueError(f"{message}: {[r.asDict() for r in rows]}")


def assert_columns(df: DataFrame, required: list[str], source: str = "table") -> DataFrame:
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{source} lacks columns: {', '.join(missing)}")
    return df


def violations_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """DQ-1: keys that repeat or are empty, with their number of rows."""
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "") for k in key])
    return df.groupBy(*key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | empty)


def violations_ref(child: DataFrame, parent: DataFrame, key: list[str]) -> DataFrame:
    """DQ-2: child rows whose key the parent lacks."""
    return child.join(parent.select(*key).distinct(), key, "left_anti")


def violations_two_sided(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """DQ-3: keys that only one side has (``side`` says which)."""
    left, right = a.select(*key).distinct(), b.select(*key).distinct()
    return left.join(right, key, "left_anti").withColumn("side", F.lit("left")).unionByName(right.join(left, key, "left_anti").withColumn("side", F.lit("right")))


def violations_count(df: DataFrame, declared: DataFrame, group: list[str], n_col: str) -> DataFrame:
    """DQ-4: groups whose declared number of rows isn't the observed one."""
    seen = df.groupBy(*group).agg(F.count("*").alias("observed"))
    both = declared.select(*group, F.col(n_col).alias("declared")).join(seen, group, "full")
    return both.where(~F.coalesce("declared", F.lit(0)).eqNullSafe(F.coalesce("observed", F.lit(0))))


def violations_domain(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """DQ-5: rows that break a rule, with the first rule broken; a null result of a rule breaks it."""
    broken = F.coalesce(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("rule", broken).where(F.col("rule").isNotNull())


def violations_probabilities(df: DataFrame, classes: list[str], label: str, tolerance: float = 5e-4) -> DataFrame:
    """DQ-6: probabilities that don't sum to 1, or a label that isn't the most likely class."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in classes])
    top = F.greatest(*classes)
    named = F.coalesce(*[F.when(F.col(label) == c, F.col(c)) for c in classes])
    return df.where((F.abs(total - 1) > tolerance) | named.isNull() | (F.abs(named - top) > 1e-12))


def wraps(start: Column, end: Column, length: Column, circular: Column) -> Column:
    """DQ-7: whether an interval runs over the origin of a circular record and meets its own start at most."""
    return F.coalesce(circular & (start >= 1) & (start <= length) & (end > length) & (end - length <= start), F.lit(False))


def violations_interval(regions: DataFrame, parents: DataFrame, key: list[str], start: str, end: str, length: str, circular: Column | None = None) -> DataFrame:
    """DQ-7: regions that leave their parent or have none; ``circular`` tells which may wrap around it."""
    both = regions.join(parents.select(*key, length), key, "left")
    s, e, n = F.col(start), F.col(end), F.col(length)
    inside = (s >= 1) & (s <= e) & (e <= n)
    return both.where(~(F.coalesce(inside, F.lit(False)) | wraps(s, e, n, circular if circular is not None else F.lit(False))))


def split_wrapped(regions: DataFrame, start: str, end: str, length: str) -> DataFrame:
    """DQ-7: regions that run over the origin as two pieces, up to the end and from 1 on, with ``piece`` 1 and 2; others as piece 1."""
    s, e, n = F.col(start), F.col(end), F.col(length)
    cell = lambda p, a, b: F.struct(F.lit(p).alias("piece"), a.cast("long").alias("a"), b.cast("long").alias("b"))
    pieces = F.when(e > n, F.array(cell(1, s, n), cell(2, F.lit(1), e - n))).otherwise(F.array(cell(1, s, e)))
    out = regions.withColumn("__p", F.explode(pieces))
    return out.withColumns({start: F.col("__p.a"), end: F.col("__p.b"), "piece": F.col("__p.piece")}).drop("__p")


def violations_lengths(sources: dict[str, DataFrame], records: DataFrame, key: list[str], length: str, complete: tuple[str, ...] = ()) -> DataFrame:
    """DQ-7: (key, source, declared, expected) where a source's length isn't the record's.

    Records that a source doesn't name are violations for the sources in ``complete``
    only; names without a record always are.
    """
    kind = records.schema[length].dataType
    rows = records.select(*key, F.lit(None).cast("string").alias("source"), F.lit(None).cast(kind).alias("declared"), F.col(length).alias("expected"))
    for name, df in sources.items():
        rows = rows.unionByName(df.select(*key, F.lit(name).alias("source"), F.col(length).alias("declared"), F.lit(None).cast(kind).alias("expected")))
    # one move by key; all that a key has is compared where it then lies
    w = W.partitionBy(*key)
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])  # a key with a null names no record
    record = F.col("source").isNull()
    lacks = [F.when(~(named & F.coalesce(F.bool_or(F.col("source") == name).over(w), F.lit(False))), F.lit(name)) for name in complete]
    seen = spread(rows, *key).withColumns({"__want": F.max("expected").over(w), "__lacks": F.array(*lacks) if lacks else F.array().cast("array<string>")})
    seen = seen.withColumn("expected", F.when(record | named, F.col("__want")))
    # a record stands for itself under every source that lacks it
    bad = F.when(record, F.array_compact("__lacks")).when(~F.coalesce(F.col("declared") == F.col("expected"), F.lit(False)), F.array("source"))
    return seen.withColumn("source", F.explode(bad)).select(*key, "source", "declared", "expected").distinct()


def violations_region_sum(regions: DataFrame, reported: DataFrame, key: list[str], start: str, end: str, length: str, total: str) -> DataFrame:
    """DQ-7: (key, total, covered) where the regions of a record, wrapped ones modulo its length, don't sum to what is reported.

    ``regions`` has the record's ``length``; a record with a reported total but no regions covers 0.
    """
    s, e, n = F.col(start), F.col(end), F.col(length)
    size = F.least(e - s + 1, n)  # a wrap that meets its start covers the record once
    seen = regions.groupBy(*key).agg(F.sum(size).alias("covered"))
    both = reported.select(*key, total).join(seen, key, "left").withColumn("covered", F.coalesce("covered", F.lit(0)))
    return both.where(~F.col(total).eqNullSafe(F.col("covered")))


def producer_gaps(df: DataFrame, group: list[str], producer: str, expected: DataFrame) -> DataFrame:
    """DQ-8: producers missing from, or unexpected in, each group (``expected``: group, producers)."""
    seen = df.groupBy(*group).agg(F.collect_set(producer).alias("seen"))
    both = expected.join(seen, group, "full")
    none = F.array().cast("array<string>")
    seen, want = F.coalesce("seen", none), F.coalesce("producers", none)
    out = both.select(*group, F.array_sort(F.array_except(want, seen)).alias("missing"), F.array_sort(F.array_except(seen, want)).alias("unexpected"))
    return out.where((F.size("missing") > 0) | (F.size("unexpected") > 0))


def eligible_coverage(records: DataFrame, predictions: DataFrame, key: list[str], length: str, minimum: int) -> DataFrame:
    """DQ-9: records of at least the minimum length without exactly one prediction, and predictions for others."""
    need = records.where(F.col(length) >= minimum).select(*key, F.lit(1).alias("need"))
    have = predictions.groupBy(*key).agg(F.count("*").alias("have"))
    both = need.join(have, key, "full").select(*key, F.coalesce("need", F.lit(0)).alias("need"), F.coalesce("have", F.lit(0)).alias("have"))
    return both.where(F.col("need") != F.col("have"))


def child_counts(parents: DataFrame, children: DataFrame, parent_id: str, child_id: str, n_col: str) -> DataFrame:
    """DQ-10: parents whose declared number of children (``<parent>_<number>``) isn't the observed one."""
    owner = F.regexp_extract(F.col(child_id), r"^(.*)_\d+$", 1)
    seen = children.groupBy(owner.alias(parent_id)).agg(F.count("*").alias("observed"))
    both = parents.select(parent_id, F.col(n_col).alias("declared")).join(seen, parent_id, "left")
    return both.select(parent_id, "declared", F.coalesce("observed", F.lit(0)).alias("observed")).where("declared <> observed")
