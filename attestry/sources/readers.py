"""Sources (SRC-1 to SRC-10)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.contracts import assert_columns, enforce

# The columns of an alignment-hit table, in order.
HITS = T.StructType([T.StructField(n, T.StringType() if n in ("qseqid", "sseqid") else T.DoubleType() if n in ("pident", "evalue", "bitscore", "qcovhsp", "scovhsp") else T.LongType()) for n in ("qseqid", "sseqid", "pident", "length", "qlen", "slen", "qstart", "qend", "sstart", "send", "evalue", "bitscore", "qcovhsp", "scovhsp")])
# The columns of a feature file.
GFF = "seqid string, source string, type string, start long, end long, score string, strand string, phase string, attributes string"


def read_fasta(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """SRC-1: (id, header, sequence), a row per record however many lines it has.

    The file is split at record marks by the reader itself, so one file can be read by
    many tasks.  Text before a file's first mark, records without id or sequence, and
    repeated ids raise; without ``check`` they are kept as they are.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    body = raw.select(F.regexp_replace("value", r"^\s*>", "").alias("v"))
    header = F.trim(F.regexp_extract("v", r"^([^\r\n]*)", 1))
    out = body.select(F.regexp_extract(header, r"^(\S*)", 1).alias("id"), header.alias("header"), F.regexp_replace(F.regexp_replace("v", r"^[^\n]*\n?", ""), r"\s+", "").alias("sequence"))
    if check:
        # of a file's records only the first keeps its mark; where none has one, the first is leading text
        enforce(raw.groupBy("file").agg(F.bool_or(F.col("value").rlike(r"^\s*>")).alias("marked")).where("not marked").select("file"), "text before the first record")
        enforce(out.where("id = '' or sequence = ''").select("id", "header"), "records without id or sequence")
        enforce(out.groupBy("id").count().where("count > 1"), "repeated ids")
    return out


def read_gff(spark: SparkSession, path: str, kind: str = "CDS") -> DataFrame:
    """SRC-2: features of one kind with their attributes as a map."""
    raw = spark.read.schema(GFF).option("sep", "\t").option("comment", "#").csv(path).where(F.col("type") == kind)
    pairs = F.filter(F.split(F.regexp_replace("attributes", r";\s*$", ""), r";\s*"), lambda x: x.contains("="))
    attributes = F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.substring_index(x, "=", 1), F.regexp_replace(x, "^[^=]*=", ""))))
    out = raw.withColumn("attributes", attributes)
    return out.select(F.element_at("attributes", "ID").alias("feature_id"), F.col("seqid").alias("parent"), "start", "end", "strand", F.coalesce(F.element_at("attributes", "transl_table"), F.lit("11")).alias("table"), "attributes")


def read_table(spark: SparkSession, path: str, required: list[str], sep: str = "\t") -> DataFrame:
    """SRC-3: a delimited table, all text; byte-order marks and spaces in names are dropped, and names are checked."""
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    return assert_columns(df.toDF(*[c.lstrip("﻿").strip() for c in df.columns]), required, path)


def read_hits(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SRC-4: hit tables with the sample taken from the file's name."""
    df = spark.read.schema(HITS).option("sep", "\t").option("header", True).csv(paths)
    return df.withColumn("sample_id", F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^/.]+)*$", 1))


def read_reference(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """SRC-5: a Parquet reference table; only the columns asked for are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_features(spark: SparkSession, glob: str) -> DataFrame:
    """SRC-6: (accession, protein, seq_type, replicon) of the CDS rows of (compressed) feature tables."""
    df = spark.read.option("header", True).option("sep", "\t").csv(glob)
    df = df.toDF(*[c.lstrip("# ").strip() for c in df.columns])
    return df.where("feature = 'CDS' and coalesce(product_accession, '-') <> '-'").select(F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1).alias("accession"), F.col("product_accession").alias("protein"), "seq_type", "chromosome")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: a sample sheet (prefix, type, fasta); bad or repeated prefixes and unknown types raise."""
    df = assert_columns(spark.read.option("header", True).csv(path), ["prefix", "type", "fasta"], path)
    enforce(df.where(~F.col("prefix").rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$") | ~F.lower("type").isin("dna", "rna") | F.col("fasta").isNull()), "bad sample rows")
    enforce(df.groupBy("prefix").count().where("count > 1"), "repeated prefixes")
    return df.withColumn("type", F.lower("type"))


def read_catalog(spark: SparkSession, path: str, ranks: list[str]) -> DataFrame:
    """SRC-8: distinct catalog paths with an id that depends on their names alone."""
    df = spark.read.option("header", True).csv(path)
    names = {c.strip().lower(): c for c in df.columns}
    out = df.select(*[F.nullif(F.trim(F.col(f"`{names[r]}`")), F.lit("")).alias(r) for r in ranks]).distinct()
    return out.withColumn("path_id", F.sha2(F.concat_ws("\t", *[F.coalesce(r, F.lit("")) for r in ranks]), 256))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-9: (path, at, value) lines of files whose compression is told by their first bytes, not their names."""
    from .magic import MagicText

    spark.dataSource.register(MagicText)
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    return spark.read.format("magic_text").load(re.sub("^file:/+", "file:///", uri))


def read_repaired(spark: SparkSession, path: str, required: list[str], sep: str = "\t") -> DataFrame:
    r"""SRC-9: all-text tables with real tabs or with ``\t`` written out, by each file's header, plain or gzip under any name.

    Headers may differ in the order of their columns; names are trimmed.  Raises for a
    header without separators, repeated or missing columns, headers that name different
    columns, rows with more values than their header, and tables without rows.  Values
    that a row lacks are empty.
    """
    lines = read_lines(spark, path)
    heads = {r.path: r.value for r in lines.where("at = 0").collect()}
    if not heads:
        raise ValueError(f"{path} is empty")
    literal = {p: sep not in h for p, h in heads.items()}
    columns = {p: [c.strip() for c in h.replace("\\t", sep).split(sep)] for p, h in heads.items()}
    first = next(iter(columns.values()))
    for p, names in columns.items():
        if len(names) < 2:
            raise ValueError(f"{p} is not delimited: {heads[p]!r}")
        if len(set(names)) != len(names) or set(names) != set(first):
            raise ValueError(f"{p} has repeated or differing columns: {names}")
        if missing := set(required) - set(names):
            raise ValueError(f"{p} lacks columns: {sorted(missing)}")
    kinds: dict[tuple, list[str]] = {}
    for p, names in columns.items():
        kinds.setdefault((tuple(names), literal[p]), []).append(p)
    body, out = lines.where("at > 0 and value <> ''"), None
    for (names, repair), paths in kinds.items():
        value = F.replace("value", F.lit("\\t"), F.lit(sep)) if repair else F.col("value")
        schema = ", ".join(f"`{c}` string" for c in (*names, "__more"))
        rows = body.where(F.col("path").isin(paths)).select("path", "at", F.from_csv(value, schema, {"sep": sep}).alias("r"))
        guard = F.when(F.col("r.__more").isNotNull(), F.raise_error(F.concat(F.lit("more values than the header has at "), F.col("path"), F.lit(":"), F.col("at").cast("string"))).cast("string"))
        part = rows.select(*[F.coalesce(guard, F.col(f"r.`{c}`"), F.lit("")).alias(c) for c in first])
        out = part if out is None else out.unionByName(part)
    enforce(spark.createDataFrame([(path,)], "path string").where(F.lit(out.limit(1).count() == 0)), "a header but no rows")
    return out


def file_inventory(spark: SparkSession, glob: str) -> DataFrame:
    """SRC-10: (name, size, sha256) of input files, hashed where they are read."""
    return spark.read.format("binaryFile").load(glob).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def inventory_changes(now: DataFrame, recorded: DataFrame) -> DataFrame:
    """SRC-10: files added, removed or changed since the recorded inventory."""
    both = now.alias("n").join(recorded.alias("r"), "name", "full")
    change = F.when(F.col("r.sha256").isNull(), "added").when(F.col("n.sha256").isNull(), "removed").when(F.col("n.sha256") != F.col("r.sha256"), "changed")
    return both.select("name", change.alias("change")).where("change is not null")
