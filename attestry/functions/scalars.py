"""Column functions shared by the operators (FN-1 to FN-11)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
MISSING = ("", "na", "nan", "none", "null", "-", r"\n", "unclassified")
# Ranks from the top down, and the prefix of each in lineage text.
RANKS = ("domain", "realm", "kingdom", "phylum", "class", "order", "family", "genus", "species")
PREFIXES = ("d__", "r__", "k__", "p__", "c__", "o__", "f__", "g__", "s__")


def clean_missing(col: Column, missing: tuple[str, ...] = MISSING) -> Column:
    """FN-1: trimmed text, or null for any of the texts that mean nothing."""
    text = F.trim(col)
    return F.when(~F.lower(text).isin(*missing), text)


def rank_value(lineage: Column, prefix: str) -> Column:
    """FN-2: the name that follows ``prefix`` in a ``;``-separated lineage, or null."""
    return F.nullif(F.trim(F.regexp_extract(lineage, f"(?:^|;) *{prefix}([^;]*)", 1)), F.lit(""))


def interval(text: Column) -> Column:
    """FN-3: ``start-end`` as a struct; null unless both are whole numbers with 1 <= start <= end."""
    start = F.regexp_extract(text, r"^\s*(\d+)\s*-\s*(\d+)\s*$", 1).try_cast("long")
    end = F.regexp_extract(text, r"^\s*(\d+)\s*-\s*(\d+)\s*$", 2).try_cast("long")
    return F.when((start >= 1) & (start <= end), F.struct(start.alias("start"), end.alias("end")))


def interval_text(start: Column, end: Column) -> Column:
    return F.concat(start.cast("string"), F.lit("-"), end.cast("string"))


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """FN-4: positions that two inclusive intervals share."""
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2) + 1)


def reciprocal_overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared positions over the longer interval's length."""
    return overlap(s1, e1, s2, e2) / F.greatest(e1 - s1 + 1, e2 - s2 + 1)


def lineage_text(ranks: list[Column], prefixes: tuple[str, ...] = PREFIXES) -> Column:
    """FN-5: prefixed lineage text from rank columns; null ranks keep only their prefix."""
    return F.concat_ws(";", *[F.concat(F.lit(p), F.coalesce(r, F.lit(""))) for p, r in zip(prefixes, ranks, strict=False)])


def deepest_rank(ranks: dict[str, Column]) -> Column:
    """Name of the deepest rank that has a value, or null."""
    return F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in reversed(ranks.items())])


def truncate_at(path: Column, depth: Column) -> Column:
    """The first ``depth`` ranks of a lineage array."""
    return F.slice(path, 1, F.greatest(depth, F.lit(0)))


def first_conflict(a: Column, b: Column) -> Column:
    """1-based rank at which two lineage arrays first name different taxa; 0 if none (null agrees with all)."""
    return F.coalesce(F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x != y, F.lit(False))), True), F.lit(0)).cast("int")


def set_text(values: Column, empty: str = "NA") -> Column:
    """FN-7: a set as sorted, comma-joined text."""
    return F.coalesce(F.nullif(F.array_join(F.array_sort(F.array_distinct(values)), ","), F.lit("")), F.lit(empty))


def hash_modulus(key: Column, modulus: int) -> Column:
    """FN-8: the first 8 bytes of SHA-256, as an unsigned number, modulo ``modulus``."""
    return (F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)") % F.lit(modulus)).cast("int")


def significant(value: Column) -> Column:
    """FN-9: six significant digits as C's ``%.6g`` writes them: without trailing zeros, and in powers of ten below 1e-4 and from 1e6 on; -0 is 0."""

    @F.pandas_udf("string")
    def text(numbers: pd.Series) -> pd.Series:
        return pd.Series(["%.6g" % (x + 0.0) for x in numbers.tolist()], dtype=object)

    v = value.cast("double")
    return F.when(v.isNotNull(), text(v))


def close(a: Column, b: Column, relative: float = 1e-9, absolute: float = 0.0) -> Column:
    """FN-9: whether two numbers differ by at most ``relative`` of the larger, or by ``absolute``; null if either is."""
    return F.abs(a - b) <= F.greatest(F.lit(relative) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


def split_suffix(identifier: Column, mark: str) -> tuple[Column, Column]:
    """FN-10: (base, suffix) of an id at the first ``mark``; the suffix is null if there is none."""
    at = F.instr(identifier, mark)
    return F.when(at > 0, F.substring(identifier, F.lit(1), at - 1)).otherwise(identifier), F.when(at > 0, F.substring(identifier, at + len(mark), F.length(identifier)))


def zip_lists(names: list[str], columns: list[Column], sep: str = ",") -> Column:
    """FN-11: parallel lists in text as array<struct>; raises if their lengths differ."""
    parts = [F.split(c, sep) for c in columns]
    same = F.lit(True)
    for p in parts[1:]:
        same = same & (F.size(p) == F.size(parts[0]))
    zipped = F.arrays_zip(*[p.alias(n) for n, p in zip(names, parts, strict=True)])
    return F.when(same, zipped).otherwise(F.raise_error(F.lit("parallel lists differ in length")))
