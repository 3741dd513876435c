"""Sinks (SNK-1 to SNK-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, columns: list[str], mode: str = "errorifexists") -> None:
    """SNK-1, SNK-7: the columns named, in order; an empty table still writes its header."""
    df.select(*columns).write.mode(mode).option("header", True).option("sep", "\t").csv(path)


def fasta_lines(id_col: Column, seq: Column, width: int = 80) -> Column:
    """SNK-2: a record as text, wrapped."""
    return F.concat(F.lit(">"), id_col, F.lit("\n"), F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", ""))


def write_fasta(df: DataFrame, path: str, id_col: str = "id", seq: str = "sequence", mode: str = "errorifexists") -> None:
    df.select(fasta_lines(F.col(id_col), F.col(seq)).alias("value")).write.mode(mode).text(path)


def write_sorted(df: DataFrame, path: str, key: list[str], mode: str = "errorifexists") -> None:
    """SNK-3: Parquet with zstd, range-partitioned and sorted, so readers can skip by key."""
    df.repartitionByRange(*key).sortWithinPartitions(*key).write.mode(mode).option("compression", "zstd").parquet(path)


def write_classes(df: DataFrame, path: str, by: str, mode: str = "errorifexists") -> None:
    """SNK-4: a folder for each class."""
    df.write.mode(mode).partitionBy(by).parquet(path)


def write_audits(audits: dict[str, DataFrame], path: str, level: str) -> list[str]:
    """SNK-5: audit tables for ``none``, ``compact`` (those named so) or ``full``; others are never computed."""
    if level not in ("none", "compact", "full"):
        raise ValueError(f"unknown level: {level}")
    wanted = [n for n in audits if level == "full" or (level == "compact" and n.startswith("compact_"))]
    for n in wanted:
        audits[n].write.parquet(f"{path}/{n}")
    return wanted


def content_hash(df: DataFrame) -> DataFrame:
    """(n, checksum) of a table's rows, whatever their order."""
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"))


def manifest(outputs: dict[str, DataFrame], settings: dict[str, str]) -> DataFrame:
    """SNK-6: one row of JSON for each output: settings, rows and checksum."""
    out = None
    for name, df in outputs.items():
        row = content_hash(df).select(F.lit(name).alias("output"), "n", "checksum", F.lit(str(sorted(settings.items()))).alias("settings"))
        out = row if out is None else out.unionByName(row)
    return out.select("output", F.to_json(F.struct("output", "n", "checksum", "settings")).alias("manifest"))


def verify_manifest(outputs: dict[str, DataFrame], recorded: DataFrame) -> DataFrame:
    """SNK-6: (output, recorded_n, n, status) of every output against a recorded manifest: unchanged, changed, missing or unrecorded.

    Rows and checksum must agree; order and partitions don't matter.
    """
    parts = [F.get_json_object("manifest", f"$.{c}").alias(c) for c in ("n", "checksum")]
    before = recorded.select("output", *parts).select("output", F.col("n").cast("long").alias("recorded_n"), F.col("checksum").alias("__was"))
    now = manifest(outputs, {}).select("output", *parts).select("output", F.col("n").cast("long").alias("n"), F.col("checksum").alias("__is"))
    status = F.when(F.col("__was").isNull(), "unrecorded").when(F.col("__is").isNull(), "missing").when((F.col("n") == F.col("recorded_n")) & (F.col("__is") == F.col("__was")), "unchanged").otherwise("changed")
    return before.join(now, "output", "full").select("output", "recorded_n", "n", status.alias("status"))
