"""Record normalization and reshaping (NRM-1 to NRM-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.shared import if_small, shared_folder, spread, stored


def assign_ids(df: DataFrame, sample: str, order: list[str], out: str = "sequence_id", fmt: str = "%s__c%06d") -> DataFrame:
    """NRM-1: ``<sample>__c<number>`` in order within each sample; rows without a sample have no id.

    Rows move once, into ranges of sample and order whose bounds Spark draws from all of
    the table, so a sample that holds most rows isn't sorted in one task.  Each is written
    with its place in its range, and the counts of a sample's earlier ranges are added.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, sample, *order).sortWithinPartitions(sample, *order)
    placed = stored(ranged.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)  # how the function makes its numbers: the partition, then the row in it
    sizes = placed.groupBy(sample, part.alias("__p")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    earlier = W.partitionBy(sample).orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select(F.col(sample).alias("__of"), "__p", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__add"))
    shared_folder(df.sparkSession)
    numbered = placed.join(if_small(before.checkpoint()), F.col(sample).eqNullSafe(F.col("__of")) & (part == F.col("__p")))
    name = F.when(F.col(sample).isNotNull(), F.format_string(fmt, F.col(sample).cast("string"), F.col("__at") + F.col("__add")))
    return numbered.withColumn(out, name).drop("__at", "__of", "__p", "__add")


def split_windows(df: DataFrame, id_col: str, seq: str, size: int = 270_000, overlap: int = 30_000) -> DataFrame:
    """NRM-2: (id, window, start, sequence): overlapping windows; the last is clipped at the end of the record."""
    step = size - overlap
    n = F.length(seq)
    last = F.greatest(F.ceil((n - size) / step), F.lit(0)).cast("int")
    return df.select(id_col, F.col(seq).alias("__s"), F.explode(F.sequence(F.lit(0), last)).alias("window")).select(id_col, "window", (F.col("window") * step + 1).alias("start"), F.substring("__s", F.col("window") * step + 1, F.lit(size)).alias(seq))


def window_to_parent(results: DataFrame, windows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """NRM-3: results (``name``, start, end) mapped to their parent; ids match with ``|`` written as ``_`` too.

    Returns the mapped rows, and the aliases that stand for several windows.  Both names
    of a window are one text with ``|`` written as ``_``: windows and results move once,
    by that text, and a window function tells what a name stands for.
    """
    alias = windows.select(F.col("window_id").alias(name), "parent", "offset").unionByName(windows.select(F.translate("window_id", "|", "_").alias(name), "parent", "offset")).distinct()
    unclear = alias.groupBy(name).agg(F.count("*").alias("n")).where("n > 1")
    place = F.struct("parent", "offset")
    a = windows.where("window_id is not null").select(F.col("window_id").alias(name), place.alias("__place"))
    both = a.unionByName(results.where(F.col(name).isNotNull()).withColumn("__result", F.lit(True)), allowMissingColumns=True)
    both = spread(both.withColumn("__both", F.translate(name, "|", "_")), "__both")
    exact, either = W.partitionBy("__both", name), W.partitionBy("__both")
    own = lambda f: F.when(F.col(name) == F.col("__both"), f.over(either)).otherwise(f.over(exact))
    both = both.withColumns({"__least": own(F.min("__place")), "__most": own(F.max("__place"))})
    mapped = both.where(F.col("__result") & F.col("__least").isNotNull() & (F.col("__least") == F.col("__most")))
    mapped = mapped.select(*results.columns, F.col("__least.parent").alias("parent"), F.col("__least.offset").alias("offset"))
    return mapped.withColumns({"start": F.col("start") + F.col("offset"), "end": F.col("end") + F.col("offset")}), unclear


def consolidate(calls: DataFrame, key: list[str], caller: str, order: list[str], sample: Column, fmt: str = "%s_orf%09d") -> DataFrame:
    """NRM-4: identical calls collapse and keep the set of their callers; ids follow the order."""
    one = calls.groupBy(*key).agg(F.array_sort(F.collect_set(caller)).alias("callers"))
    return assign_ids(one.withColumn("__sample", sample), "__sample", order, "orf_id", fmt).drop("__sample")


def join_features(proteins: DataFrame, features: DataFrame) -> DataFrame:
    """NRM-5: each protein with its feature: by record id, else attribute id, else the one feature with its coordinates.

    ``proteins``: protein_id, parent, start, end, strand; ``features``: feature_id,
    attribute_id, parent, start, end, strand.
    """
    by_id = features.select(F.col("feature_id").alias("protein_id"), F.col("feature_id").alias("f1"))
    by_attr = features.where("attribute_id is not null").groupBy(F.col("attribute_id").alias("protein_id")).agg(F.min("feature_id").alias("f2"))
    spot = ["parent", "start", "end", "strand"]
    by_spot = features.groupBy(*spot).agg(F.min("feature_id").alias("f3"), F.count("*").alias("k")).where("k = 1").drop("k")
    out = proteins.join(by_id, "protein_id", "left").join(by_attr, "protein_id", "left").join(by_spot, spot, "left")
    how = F.when(F.col("f1").isNotNull(), "record").when(F.col("f2").isNotNull(), "attribute").when(F.col("f3").isNotNull(), "coordinates").otherwise("none")
    return out.select(*proteins.columns, F.coalesce("f1", "f2", "f3").alias("feature_id"), how.alias("matched_by"))


def extract(records: DataFrame, regions: DataFrame, key: str, seq: str) -> DataFrame:
    """NRM-6: the slices of parent sequences that regions (key, start, end) name."""
    return regions.join(records.select(key, seq), key).withColumn(seq, F.substring(seq, F.col("start"), F.col("end") - F.col("start") + 1))


def compact(df: DataFrame, required: list[str], optional: list[str]) -> DataFrame:
    """NRM-7: required columns and those optional ones that are there."""
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*required, *[c for c in optional if c in df.columns])
