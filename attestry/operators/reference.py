"""Reference-table building (REF-1, REF-3 to REF-13; REF-2 is in ``near_identity``)."""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import clean_missing, deepest_rank, lineage_text, rank_value


def dedup_exact(df: DataFrame, id_col: str, seq_col: str) -> DataFrame:
    """REF-1: members with their representative, the smallest id of the same sequence.

    Groups are formed by hash and sequence; hot sequences are combined before the
    shuffle, and the join back splits them.
    """
    keyed = df.select(id_col, F.sha2(F.col(seq_col), 256).alias("h"))
    reps = keyed.groupBy("h").agg(F.min(id_col).alias("representative"), F.count("*").alias("members"))
    return keyed.join(reps, "h").select(id_col, "representative", "members")


def normalize_metadata(df: DataFrame, id_cols: list[str], lineage: str, ranks: dict[str, str]) -> DataFrame:
    """REF-3: missing values cleaned, the first id that is there as ``key``, ranks taken out of the lineage text."""
    key = F.coalesce(*[clean_missing(F.col(c).cast("string")) for c in id_cols])
    return df.withColumn("key", key).withColumns({name: clean_missing(rank_value(F.col(lineage), prefix)) for name, prefix in ranks.items()})


def lookup_projection(lca: DataFrame, ranks: list[str], prefixes: tuple[str, ...]) -> DataFrame:
    """REF-5: lineage text, deepest rank and the conflicting rank's name."""
    names = F.array(*[F.lit(r) for r in ranks])
    return lca.withColumns({
        "lineage": lineage_text([F.col(r) for r in ranks], prefixes),
        "deepest_rank": F.coalesce(deepest_rank({r: F.col(r) for r in ranks}), F.lit("unclassified")),
        "conflict_name": F.when(F.col("conflict_rank") > 0, F.element_at(names, F.col("conflict_rank"))).otherwise(""),
    })


def long_metrics(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """REF-6, REF-8: one aggregate, as rows (metric, value)."""
    one = df.agg(*[m.cast("double").alias(k) for k, m in metrics.items()])
    pairs = ", ".join(f"'{k}', `{k}`" for k in metrics)
    return one.selectExpr(f"stack({len(metrics)}, {pairs}) as (metric, value)")


def classify_by_occurrence(occurrences: DataFrame, id_col: str, label: Column) -> DataFrame:
    """REF-7: one label if all occurrences agree, SHARED if several, UNSUPPORTED if any has no label."""
    seen = occurrences.withColumn("__l", label).groupBy(id_col).agg(F.array_sort(F.collect_set("__l")).alias("labels"), F.bool_or(F.col("__l").isNull()).alias("gap"))
    out = F.when(F.col("gap"), "UNSUPPORTED").when(F.size("labels") == 1, F.element_at("labels", 1)).when(F.size("labels") > 1, "SHARED").otherwise("UNPLACED")
    return seen.select(id_col, out.alias("reference_class"), F.array_join("labels", ",").alias("labels"))


def representative_metadata(members: DataFrame, metadata: DataFrame, rep: str, member: str) -> DataFrame:
    """REF-9: metadata of each representative with its number of members."""
    sizes = members.groupBy(rep).agg(F.count("*").alias("member_count"))
    return sizes.join(metadata, sizes[rep] == metadata[member]).drop(member) if rep != member else sizes.join(metadata, rep)


def retained(members: DataFrame, rep: str, group: str) -> DataFrame:
    """REF-9: inputs, representatives and the share retained (%), by class."""
    out = members.groupBy(group).agg(F.count("*").alias("inputs"), F.count_distinct(rep).alias("representatives"))
    return out.withColumn("retained_percent", F.round(100 * F.col("representatives") / F.col("inputs"), 4))


def competitive_manifest(viral: DataFrame, other: DataFrame, id_col: str) -> DataFrame:
    """REF-10: both kinds of references with labelled ids; columns that one lacks are null."""
    label = lambda df, k: df.withColumn("reference_class", F.lit(k.lower())).withColumn(id_col, F.concat(F.lit(f"{k}|"), F.col(id_col).cast("string")))
    return label(viral, "VIRAL").unionByName(label(other, "CELLULAR"), allowMissingColumns=True)


def nested_tiers(df: DataFrame, id_col: str, group: str, sizes: list[int], seed: str) -> DataFrame:
    """REF-11: deterministic, group-balanced tiers, each a prefix of the next.

    Within a group rows are in hash order; tiers take the first of every group, then
    the second, and so on.  The global position is found from counts of each round,
    not from a sort of all rows in one task: rows before a round are summed on the
    small table of rounds, and only a round's own rows are ranked.
    """
    h = F.sha2(F.concat_ws("\t", F.lit(seed), F.col(id_col).cast("string")), 256)
    k = df.withColumn("k", F.row_number().over(W.partitionBy(group).orderBy(h, id_col))).where(F.col("k") <= max(sizes))  # later rows of a group reach no tier
    rounds = k.groupBy("k").agg(F.count("*").alias("n"))
    before = rounds.withColumn("before", F.sum("n").over(W.orderBy("k").rowsBetween(W.unboundedPreceding, -1))).where(F.coalesce("before", F.lit(0)) < max(sizes))
    ranked = k.join(before, "k").withColumn("position", (F.coalesce("before", F.lit(0)) + F.row_number().over(W.partitionBy("k").orderBy(group, id_col))).cast("long"))
    tier = F.coalesce(*[F.when(F.col("position") <= s, F.lit(s)) for s in sorted(sizes)])
    return ranked.withColumn("tier", tier).where("tier is not null").select(id_col, group, "position", "tier")


def build_catalog(records: DataFrame, manifest: DataFrame, assembly: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """REF-12: records with ids prefixed by their assembly, and manifest entries without records."""
    out = records.join(manifest.select(assembly).distinct(), assembly, "left_semi").withColumn("catalog_id", F.concat_ws("|", F.col(assembly).cast("string"), F.col(id_col).cast("string")))
    return out, manifest.join(records.select(assembly).distinct(), assembly, "left_anti")


def accession_audit(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """REF-13: entries of a ``;``-separated accession list: all, labelled, with coordinates, malformed."""
    entry = df.select(id_col, F.explode(F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: x != "")).alias("e"))
    label = F.col("e").contains(":")
    value = F.trim(F.when(label, F.substring_index("e", ":", -1)).otherwise(F.col("e")))
    coordinates = value.rlike(r"\(\d+\.\d+\)$")
    good = F.regexp_replace(value, r"\s*\(\d+\.\d+\)$", "").rlike(r"^[A-Za-z0-9_.]+$")
    return entry.groupBy(id_col).agg(F.count("*").alias("entries"), F.count_if(label).alias("labelled"), F.count_if(coordinates).alias("with_coordinates"), F.count_if(~good).alias("malformed"))


def _tokens(name: str) -> str:
    return re.sub("[^a-z0-9]+", " ", name.lower()).strip()


def resolve_columns(headers: list[str], wanted: list[str], longer: tuple[str, ...] = ()) -> dict[str, str]:
    """REF-13: the header of each wanted column, compared by lower-case letters and digits alone.

    For those in ``longer`` a header that begins with the name's words also counts if
    none is equal.  A column that no header, or more than one, matches raises.
    """
    found = {}
    for name in wanted:
        hits = [h for h in headers if _tokens(h) == _tokens(name)]
        if not hits and name in longer:
            hits = [h for h in headers if _tokens(h).startswith(_tokens(name))]
        if len(hits) != 1:
            raise ValueError(f"expected one column for {name!r}, found {len(hits)}: {hits}")
        found[name] = hits[0]
    return found


def by_headers(df: DataFrame, wanted: list[str], longer: tuple[str, ...] = ()) -> DataFrame:
    """REF-13: ``df`` in the wanted columns, trimmed text; nulls are empty."""
    if len(set(df.columns)) != len(df.columns):
        raise ValueError(f"repeated columns: {df.columns}")
    found = resolve_columns(df.columns, wanted, longer)
    return df.select(*[F.coalesce(F.trim(F.col("`" + h.replace("`", "``") + "`").cast("string")), F.lit("")).alias(name) for name, h in found.items()])


def by_first_headers(lines: DataFrame, wanted: list[str], longer: tuple[str, ...] = (), sep: str = ",", within: int = 30) -> DataFrame:
    """REF-13: the same for a sheet whose header is one of its first ``within`` lines; ``lines``: at (order), value.

    Only those lines pass through the driver.
    """
    failure = "no lines"
    for row in lines.orderBy("at").limit(within).collect():
        headers = next(csv.reader([row.value], delimiter=sep), [])
        try:
            found = resolve_columns(headers, wanted, longer)
        except ValueError as e:
            failure = str(e)
            continue
        schema = ", ".join(f"c{i} string" for i in range(len(headers)))
        cells = lines.where(F.col("at") > row.at).select(F.from_csv("value", schema, {"sep": sep}).alias("r"))
        return cells.select(*[F.coalesce(F.trim(f"r.c{headers.index(h)}"), F.lit("")).alias(name) for name, h in found.items()])
    raise ValueError(f"no line of the first {within} names the columns: {failure}")
