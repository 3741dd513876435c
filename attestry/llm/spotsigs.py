"""Document fingerprints: SpotSigs.

A signature is a common word (the anchor) with the chain of content words that
follows it; a text's fingerprint is its set of signatures.  Text without an anchor
has one signature, the hash of its words, so equal texts always agree.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions

# Common words that serve as anchors (English, German, French, Spanish).
ANCHORS = frozenset(
    "a an and are as at be but by for from has have he in is it its not of on or that the this to was were will with "
    "auf das dem den der des die ein eine es für ich ist mit nicht sich sie und von zu "
    "au aux avec ce dans de du elle en est et il la le les ne par pas pour que qui sur un une "
    "al con como del el los las lo más no para por se su una y".split()
)
#: Content words in a chain.
CHAIN = 3


def signatures(text: str, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> frozenset[int]:
    """32-bit hashes of the signatures of a whole text; empty for a text without words."""
    content, spots = [], set()
    for w in text.lower().split():
        w = w.strip(".,;:!?\"'()[]")
        if w in anchors:
            spots.add((w, len(content)))
        elif w:
            content.append(w)
    found = {zlib.crc32(" ".join((w, *content[i : i + chain])).encode("utf-8", "replace")) for w, i in spots if i + chain <= len(content)}
    if not found and (words := text.split()):
        found = {zlib.crc32(" ".join(words).encode("utf-8", "replace"))}
    return frozenset(found)


def written(signs: frozenset[int]) -> str:
    return "".join(f"{s:08x}" for s in sorted(signs))


def likeness(a: frozenset[int], b: frozenset[int]) -> float:
    """Jaccard likeness; two empty sets are alike."""
    if not a and not b:
        return 1.0
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def _signed(text: Column) -> Column:
    @F.pandas_udf("array<long>")
    def signed(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(signatures(t)) if t else [] for t in texts])

    return signed(text)


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "signatures") -> DataFrame:
    """``docs`` with ``out_col``: array<long> of signatures, sorted; null and wordless texts have none."""
    return docs.withColumn(out_col, _signed(F.col(text_col).cast("string")))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_signatures, component_id): classes of texts whose fingerprints have Jaccard >= ``threshold``.

    Sets are partitioned by length, so that only sets whose lengths allow the
    threshold meet, and compared through the pruned Jaccard join of
    :mod:`.ngram_jaccard`; equal sets are one class beforehand.
    """
    from .ngram_jaccard import link_sets

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("key", F.xxhash64("text"))
    return link_sets(rows, _signed(F.col("text")), *_ratio(threshold)).withColumnRenamed("n_tokens", "n_signatures")


def _ratio(threshold: float) -> tuple[int, int]:
    return round(threshold * 1000), 1000


def with_next(docs: DataFrame, run, schema: str) -> DataFrame:
    """``run(rows)`` over the documents in descending doc_id, each row with the one after it; after the last comes the first.

    ``run`` gets an iterator of ((doc_id, text), (doc_id, text) of the next).  The
    texts are shuffled once: sampled splitters cut the ids into ranges, and the head
    of each range goes to the range before it too.  Only the splitters and each
    range's head id (one small row for each range) pass through the driver.  Repeated
    ids are ordered by text; null ids come last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    parts = max(2, 3 * partitions(spark))
    cuts = sorted({int(x) for x in rows.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.002)})
    # descending: range 0 holds the largest ids; ids equal to a splitter belong above it
    bounds = F.array(*[F.lit(x) for x in reversed(cuts)]) if cuts else F.array().cast("array<long>")
    last = len(cuts) + 1
    bucket = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(F.size(F.filter(bounds, lambda b: b > F.col("doc_id"))))
    heads = rows.select("doc_id", bucket.alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy("bucket").collect()  # one row a range
    if not heads:
        return rows.mapInPandas(lambda batches: (run(iter(())) for _ in batches), schema)
    before = {h.bucket: heads[i - 1].bucket for i, h in enumerate(heads)}
    to = F.element_at(F.create_map(*[F.lit(x) for h in heads for x in (h.bucket, before[h.bucket])]), F.col("bucket"))
    head = F.element_at(F.create_map(*[F.lit(x) for h in heads for x in (h.bucket, h.head if h.head is not None else 0)]), F.col("bucket"))
    is_head = F.coalesce(F.col("doc_id") == head, F.lit(True)) & (F.col("doc_id").isNotNull() | (F.col("bucket") == last))
    own = F.struct(F.col("bucket").alias("b"), F.lit(0).alias("tail"))
    places = F.when(is_head, F.array(own, F.struct(to.alias("b"), F.lit(1).alias("tail")))).otherwise(F.array(own))
    placed = rows.withColumn("bucket", bucket).withColumn("place", F.explode(places)).select("doc_id", "text", "place.b", "place.tail")
    placed = placed.repartition(partitions(spark), "b").sortWithinPartitions(F.col("b"), F.col("tail"), F.desc_nulls_last("doc_id"), F.col("text"))

    def ordered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def pairs():
            held = None
            closed = False
            for batch in batches:
                for doc_id, text, b, tail in zip(batch["doc_id"], batch["text"], batch["b"], batch["tail"], strict=True):
                    row = (None if pd.isna(doc_id) else int(doc_id), text)
                    if held is not None and held[0] != b:
                        held, closed = None, False
                    if held is not None and not closed:
                        yield held[1], row
                    if tail:
                        closed = True  # the first tail row in order is the next range's head
                    held = (b, row)

        yield from run(pairs())

    return placed.mapInPandas(ordered, schema)


def digests(docs: DataFrame) -> DataFrame:
    """Per document: fingerprints of the text and of its edit, whose last half is the first of the next document's."""
    import hashlib

    def run(pairs) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        kept: tuple[str, frozenset[int]] | None = None
        for (doc_id, text), (_, following) in pairs:
            mine = kept[1] if kept and kept[0] == text else signatures(text)
            other = signatures(following)
            kept = (following, other)
            half = len(text) // 2
            edited = text[: len(text) - half] + following[:half]
            changed = mine if edited == text else signatures(edited)
            out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(mine), written(changed), likeness(mine, changed), likeness(mine, other)))
            size += len(text)
            if size > 4_000_000:
                yield pd.DataFrame(out, columns=_COLUMNS)
                out, size = [], 0
        yield pd.DataFrame(out, columns=_COLUMNS)

    return with_next(docs, run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
