"""Suffix-array dedup: bytes of long strings that also start earlier in the corpus are removed.

The suffix array is sparse.  Of the grams in every window of LENGTH bytes, the one
with the smallest hash (leftmost on ties) is the window's anchor, so equal windows
have equal anchors at equal places and only suffixes around anchors need sorting.

1. Every anchor becomes a row: hash of its gram, hash of its context (the bytes of
   all windows it anchors), document and place.  Splitters sampled from the corpus
   cut these rows into ranges; document and place are part of the key, so a gram that
   a third of the corpus holds spreads over many ranges.  In a sorted range all but
   the first of equal contexts are repeats.
2. Contexts that share their gram with different contexts are read from the texts.
   Their suffixes are range-partitioned by gram, and each bucket sorts them by
   multikey quicksort, eight bytes at a time; equal neighbours over the whole LENGTH
   are repeats.  Grams with many contexts are spread window by window over sampled
   ranges as in 1, where the last row of a range is compared with the first of the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions

LENGTH, GRAM = 100, 24
#: Contexts of one gram that a bucket sorts together; beyond it, windows are spread.
TOGETHER = 2000
#: Documents whose anchors place the splitters (at most; they only balance the ranges).
SAMPLE = 2000
#: Bytes that are hashed at once.
CHUNK = 1 << 20

_U = np.uint64
_MULT = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]
_BASE = _U(0x5851F42D4C957F2D)


@lru_cache
def _bytes_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64) | _U(1)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = _U(pow(int(_BASE), -1, 1 << 64))
    return tuple(np.concatenate([np.ones(1, _U), np.cumprod(np.full(n, x, dtype=_U))]) for x in (_BASE, inverse))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def grams(b: np.ndarray) -> np.ndarray:
    """Hash of the 24 bytes from each place on, by doubling."""
    h = _bytes_table(1)[b]
    kept = {}
    for i, s in enumerate((1, 2, 4, 8)):
        kept[s] = h
        h = h[:-s] * _MULT[i] + h[s:]
        h ^= h >> _U(29)
    h = h[: len(h) - 8] * _MULT[4] + kept[8][16:]
    return _mix(h)


def anchors(b: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gram hash, context hash, anchor, first and last window start) over texts that lie one after the other in ``b``.

    ``ends``: end of the text to which each byte belongs; windows never cross it.
    """
    none = np.empty(0, np.int64)
    if len(b) < LENGTH:
        return none, none, none, none, none
    g = grams(b)
    place = np.arange(len(g), dtype=_U)
    m = (g & ~_U(0xFFFFFF)) | place
    width, s = LENGTH - GRAM + 1, 1
    while 2 * s <= width:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    if s < width:
        m = np.minimum(m[: len(m) - (width - s)], m[width - s :])
    starts = np.flatnonzero(np.arange(len(m)) + LENGTH <= ends[: len(m)])
    if not len(starts):
        return none, none, none, none, none
    p = (m[starts] & _U(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
    lo, hi, p = starts[first], starts[np.r_[first[1:], len(starts)] - 1], p[first]
    return g[p].view(np.int64), _context(b, lo, hi + LENGTH, p - lo), p, lo, hi


def _sums(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(16, int(len(b)).bit_length()))
    return np.concatenate([np.zeros(1, _U), np.cumsum(_bytes_table(2)[b] * up[: len(b)])]), down


def _context(b: np.ndarray, start: np.ndarray, end: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Hash of b[start:end] and of the anchor's place in it."""
    sums, down = _sums(b)
    return _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(_U) * _MULT[1] + offset.astype(_U) * _MULT[3]).view(np.int64)


def _rows_of(texts: list[bytes], uids: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of some texts as columns g, c, uid, pos (anchor, its place in the context and the windows after it, packed)."""
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("g", "c", "uid", "pos")}

    def add(b: np.ndarray, ends: np.ndarray, begin: np.ndarray, uid: np.ndarray) -> None:
        g, c, p, lo, hi = anchors(b, ends)
        out["g"].append(g)
        out["c"].append(c)
        out["uid"].append(uid[p])
        out["pos"].append((p - begin[p]) << 14 | (p - lo) << 7 | (hi - lo))

    held, size = [], 0

    def flush() -> None:
        nonlocal size
        if held:
            n = np.array([len(t) for t, _ in held])
            stop = np.cumsum(n)
            add(np.frombuffer(b"".join(t for t, _ in held), dtype=np.uint8), np.repeat(stop, n), np.repeat(stop - n, n), np.repeat(np.array([u for _, u in held], dtype=np.int64), n))
        held.clear()
        size = 0

    for text, uid in zip(texts, uids.tolist(), strict=True):
        if len(text) < LENGTH:
            continue
        if len(text) > CHUNK:  # windows that start in each part of a very long text
            for s in range(0, len(text) - LENGTH + 1, CHUNK):
                part = np.frombuffer(text[s : s + CHUNK + LENGTH - 1], dtype=np.uint8)
                add(part, np.full(len(part), len(part)), np.full(len(part), -s), np.full(len(part), uid, dtype=np.int64))
            continue
        held.append((text, uid))
        size += len(text)
        if size > CHUNK:
            flush()
    flush()
    return {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in out.items()}


def _anchor_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 500):
                batch = whole.slice(s, 500)
                rows = _rows_of([x.encode() if x else b"" for x in batch.column("text").to_pylist()], batch.column("uid").to_numpy())
                if len(rows["g"]):
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in rows.values()], names=list(rows))

    return docs.mapInArrow(run, "g long, c long, uid long, pos long")


def _splitters(sample: DataFrame, n: int, limit: int = 200_000) -> list[tuple]:
    """n - 1 rows of a bounded sample, at equal distances in order."""
    rows = sorted(tuple(r) for r in sample.select("g", "c", "uid", "pos").limit(limit).collect())
    return [rows[len(rows) * i // n] for i in range(1, n)] if len(rows) >= n else rows


def _ranged(rows: DataFrame, splitters: list[tuple], n: int) -> DataFrame:
    """``rows`` dealt to n ranges of (g, c, uid, pos), each sorted."""
    cols = ["g", "c", "uid", "pos"]
    shared = rows.sparkSession.sparkContext.broadcast(splitters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = [np.array(x, dtype=np.int64) for x in zip(*shared.value, strict=True)] if shared.value else None
        for batch in batches:
            part = np.zeros(batch.num_rows, dtype=np.int32)
            if marks is not None:
                own = [batch.column(c).to_numpy() for c in cols]
                part = np.searchsorted(marks[0], own[0], "left").astype(np.int32)
                tied = np.flatnonzero(np.isin(own[0], marks[0]))
                if len(tied):  # splitters within one gram: the whole key decides
                    keys = [np.concatenate([m, o[tied]]) for m, o in zip(marks, own, strict=True)]
                    kind = np.concatenate([np.zeros(len(marks[0])), np.ones(len(tied))])
                    order = np.lexsort((kind, *reversed(keys)))
                    before = np.cumsum(kind[order] == 0)
                    at = np.empty(len(order), dtype=np.int64)
                    at[order] = before
                    part[tied] = at[len(marks[0]) :]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), pa.array(part)], names=[*cols, "part"])

    dealt = rows.select(*cols).mapInArrow(run, "g long, c long, uid long, pos long, part int")
    return dealt.repartitionById(n, "part").sortWithinPartitions(*cols)


def _whole(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray] | None:
    """One range as columns; ranges hold a bounded share of the rows."""
    t = [b for b in batches if b.num_rows]
    if not t:
        return None
    whole = pa.Table.from_batches(t)
    return {c: whole.column(c).to_numpy() for c in whole.column_names}


def _repeats(ranged: DataFrame) -> DataFrame:
    """(uid, start, size, g): ``size`` > 0 are repeats; 0 are first contexts (``start`` is their packed place) that need a closer look."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = _whole(batches)
        if x is None:
            return
        g, c, uid, pos = x["g"], x["c"], x["uid"], x["pos"]
        new_gram = np.r_[True, g[1:] != g[:-1]]
        new = new_gram | np.r_[True, c[1:] != c[:-1]]
        runs = np.flatnonzero(new_gram)
        several = np.add.reduceat(new.astype(np.int64), runs) > 1
        several[[0, -1]] = True  # the gram may go on in the next range
        look = new & np.repeat(several, np.diff(np.r_[runs, len(g)]))
        p, before, windows = pos >> 14, pos >> 7 & 127, pos & 127
        rep = ~new
        for pick, start, size in ((rep, p - before, windows + LENGTH), (look, pos, np.zeros_like(pos))):
            yield pa.RecordBatch.from_arrays([pa.array(v[pick]) for v in (uid, start, size, g)], names=["uid", "start", "size", "g"])

    return ranged.mapInArrow(run, "uid long, start long, size long, g long")


def multikey_order(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte strings (rows of big-endian words) within groups, and each one's class of equals.

    Multikey quicksort, breadth first: all strings that still tie are split by their
    next word at once, and only ties go on to the word after it.
    """
    rank = np.unique(group, return_inverse=True)[1]
    tied = np.arange(len(rank))
    for d in range(words.shape[1]):
        count = np.bincount(rank, minlength=1)
        tied = tied[count[rank[tied]] > 1]
        if not len(tied):
            break
        order = np.lexsort((words[tied, d], rank[tied]))
        t = tied[order]
        new = np.r_[True, (rank[t][1:] != rank[t][:-1]) | (words[t[1:], d] != words[t[:-1], d])]
        fresh = rank.max() + 1 + np.cumsum(new)  # ranks name classes; their order within the group doesn't matter for equality
        rank = rank.copy()
        rank[t] = fresh
        rank = np.unique(rank, return_inverse=True)[1]
    return np.argsort(rank, kind="stable"), rank


def _windows(x: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all windows of some contexts (104 a row), their contexts' row, place in the anchor's gram order and start."""
    blob = np.frombuffer(b"".join(x["ctx"]) + bytes(8), dtype=np.uint8)
    size = x["ctx"].map(len).to_numpy()
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    n = size - LENGTH + 1
    row = np.repeat(np.arange(len(x)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = begin[row] + step
    view = np.lib.stride_tricks.sliding_window_view(blob, 104)[at].copy()
    view[:, LENGTH:] = 0
    return view, row, x["before"].to_numpy()[row] - step, x["lo"].to_numpy()[row] + step


def _spans(uid: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    """Repeated windows as runs of neighbouring starts."""
    order = np.lexsort((start, uid))
    uid, start = uid[order], start[order]
    first = np.flatnonzero(np.r_[True, (uid[1:] != uid[:-1]) | (start[1:] != start[:-1] + 1)]) if len(uid) else np.empty(0, int)
    last = np.r_[first[1:], len(uid)] - 1 if len(uid) else first
    return pd.DataFrame({"uid": uid[first], "start": start[first], "size": start[last] - start[first] + LENGTH})


def _bucket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sort the suffixes of a bucket's contexts, some grams at a time, and give the repeats."""
    whole = [b for b in batches if len(b)]
    if not whole:
        return
    x = pd.concat(whole).sort_values("g", kind="stable").reset_index(drop=True)
    n = np.cumsum(x["ctx"].map(len).to_numpy() - LENGTH + 1)
    s = 0
    while s < len(x):
        stop = int(np.searchsorted(n, (n[s - 1] if s else 0) + 60_000, "right"))
        stop = max(stop, s + 1)
        while stop < len(x) and x["g"].iat[stop] == x["g"].iat[stop - 1]:
            stop += 1
        part = x.iloc[s:stop].reset_index(drop=True)
        s = stop
        view, row, offset, start = _windows(part)
        gram = np.unique(part["g"].to_numpy(), return_inverse=True)[1][row]
        words = view.view(">u8").astype(np.uint64)
        _, rank = multikey_order(words, gram * 128 + offset)
        uid = part["uid"].to_numpy()[row]
        order = np.lexsort((start, uid, rank))
        again = order[np.r_[False, rank[order][1:] == rank[order][:-1]]]
        yield _spans(uid[again], start[again])


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows of contexts as rows of two independent hashes, document and start."""
    for whole in batches:
        for s in range(0, len(whole), 500):
            part = whole.iloc[s : s + 500].reset_index(drop=True)
            view, row, _, start = _windows(part)
            words = view.view(">u8").astype(np.uint64)
            h = [np.full(len(words), seed, dtype=_U) for seed in (3, 5)]
            for d in range(words.shape[1]):
                h = [_mix((a ^ words[:, d]) * m) for a, m in zip(h, _MULT, strict=False)]
            yield pd.DataFrame({"g": h[0].view(np.int64), "c": h[1].view(np.int64), "uid": part["uid"].to_numpy()[row], "pos": start})


def _exact_runs(ranged: DataFrame) -> DataFrame:
    """Repeated windows (uid, start, size): all but the first of equal keys, over the borders of ranges too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = _whole(batches)
        if x is None:
            return
        same = np.r_[False, (x["g"][1:] == x["g"][:-1]) & (x["c"][1:] == x["c"][:-1])]
        found = _spans(x["uid"][same], x["pos"][same])
        n = len(found)
        ends = [(x["uid"][i], x["pos"][i], -1 - k, x["g"][i], x["c"][i], x["part"][i]) for k, i in enumerate((0, len(same) - 1))]
        cols = [np.concatenate([found["uid"], [e[0] for e in ends]]), np.concatenate([found["start"], [e[1] for e in ends]]), np.concatenate([found["size"], [e[2] for e in ends]])]
        cols += [np.concatenate([np.zeros(n, np.int64), [e[k] for e in ends]]) for k in (3, 4, 5)]
        yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in cols], names=["uid", "start", "size", "g", "c", "part"])

    out = cut(ranged.mapInArrow(run, "uid long, start long, size long, g long, c long, part long"))
    heads = out.where("size = -1").select("uid", "start", "g", "c", "part")
    tails = out.where("size = -2").select("g", "c", F.col("part").alias("earlier"))
    more = heads.join(tails, ["g", "c"]).where("earlier < part").select("uid", "start", F.lit(LENGTH).cast("long").alias("size")).distinct()
    return out.where("size > 0").select("uid", "start", "size").unionByName(more)


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(uid, doc_id, text): ``uid`` orders the rows by id, and repeated ids by their place in the input; null ids come last."""
    ids = docs.select(F.col(id_col).alias("doc_id"))
    n, distinct = ids.agg(F.count("*"), F.count_distinct("doc_id")).first()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if n == distinct and dict(ids.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint"):
        return rows.select(F.col("doc_id").cast("long").alias("uid"), "doc_id", "text")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = rows.select("row", "doc_id").repartitionByRange(partitions(docs.sparkSession), F.asc_nulls_last("doc_id"), F.asc("row")).sortWithinPartitions(F.asc_nulls_last("doc_id"), F.asc("row"))
    order = cut(order.select("row", F.monotonically_increasing_id().alias("uid")))
    return rows.join(order, "row").select("uid", "doc_id", "text")


def repeated_spans(named: DataFrame, n_docs: int) -> DataFrame:
    """(uid, start, size) of byte spans of repeated windows; they may overlap."""
    spark = named.sparkSession
    n = partitions(spark)
    texts = named.select("uid", "text")
    some = texts.where(F.pmod(F.xxhash64("uid"), F.lit(max(1, n_docs // SAMPLE))) == 0).limit(2 * SAMPLE)
    ranged = _ranged(_anchor_rows(texts), _splitters(_anchor_rows(some), n), n)
    marked = cut(_repeats(ranged))
    look = marked.where("size = 0").select("uid", F.col("start").alias("pos"), "g")
    places = look.groupBy("uid").agg(F.collect_list(F.struct("pos", "g")).alias("places"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for s in range(0, len(whole), 200):
                out = []
                for uid, text, places in zip(*(whole[c].iloc[s : s + 200] for c in ("uid", "text", "places")), strict=True):
                    b = text.encode()
                    for x in places:
                        p, before, windows = x["pos"] >> 14, x["pos"] >> 7 & 127, x["pos"] & 127
                        out.append((x["g"], uid, p - before, before, b[p - before : p - before + windows + LENGTH]))
                yield pd.DataFrame(out, columns=["g", "uid", "lo", "before", "ctx"])

    contexts = texts.join(places, "uid").mapInPandas(read, "g long, uid long, lo long, before long, ctx binary")
    many = look.groupBy("g").count().where(F.col("count") > TOGETHER).select("g")
    many = cut(many)
    n_many = many.count()
    spans = marked.where("size > 0").select("uid", "start", "size")
    if n_many:
        few = F.broadcast(many) if n_many <= 100_000 else many
        contexts = cut(contexts)
        hot = contexts.join(few, "g", "left_semi").mapInPandas(_spread, "g long, c long, uid long, pos long")
        hot = cut(hot)
        share = min(1.0, 50_000 / max(1, hot.count()))
        spans = spans.unionByName(_exact_runs(_ranged(hot, _splitters(hot.sample(share, 1), n), n)))
        contexts = contexts.join(few, "g", "left_anti")
    local = contexts.repartition(n, "g").mapInPandas(_bucket, "uid long, start long, size long")
    return spans.unionByName(local)


def _merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of packed spans."""
    s = np.sort(np.asarray(spans, dtype=np.int64))
    start, end = s >> 8, (s >> 8) + (s & 255)
    top = np.maximum.accumulate(end)
    first = np.flatnonzero(np.r_[True, start[1:] > top[:-1]])
    return list(zip(start[first].tolist(), top[np.r_[first[1:], len(s)] - 1].tolist(), strict=True))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (doc_id, n_bytes, spans, kept).

    ``spans`` are the maximal byte runs (start, end) covered by strings of LENGTH
    bytes that also start earlier: in a row with a smaller id (repeated ids: earlier
    in the input; null ids: last) or before in the same text.  ``kept`` are the
    remaining bytes, in order.  Null texts count as empty, shorter texts are kept whole.
    """
    named = _named(docs, id_col, text_col)
    found = repeated_spans(named, docs.count())
    # start and size fit one number once long spans are cut into pieces of 200
    packed = found.select("uid", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(200).cast("long"))).alias("k"), "start", "size")
    packed = packed.select("uid", ((F.col("start") + F.col("k")) * 256 + F.least(F.col("size") - F.col("k"), F.lit(200).cast("long"))).alias("s"))
    lists = packed.groupBy("uid").agg(F.collect_list("s").alias("packed"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for s in range(0, len(whole), 500):
                out = []
                for doc_id, text, packed in zip(*(whole[c].iloc[s : s + 500] for c in ("doc_id", "text", "packed")), strict=True):
                    b = text.encode() if text else b""
                    runs = _merged(packed) if packed is not None and len(packed) else []
                    kept, at = [], 0
                    for x, y in runs:
                        kept.append(b[at:x])
                        at = y
                    kept.append(b[at:])
                    out.append((None if doc_id is None or doc_id != doc_id else doc_id, len(b), [{"start": x, "end": y} for x, y in runs], b"".join(kept)))
                yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return named.join(lists, "uid", "left").select("doc_id", "text", "packed").mapInPandas(run, f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    found = remove_repeats(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
