"""Byte-level BPE encoding and decoding.

Every match of the split pattern is merged on its own: a segment tree over its byte
positions holds the leftmost minimum pair rank, so a merge is one read of the root
and three logarithmic point updates (the merged pair and its two live neighbours).
Short pieces are merged side by side, one numpy row each; long ones by a scalar tree
of the same form, so that one piece of n bytes costs O(n log n).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pieces up to this many bytes are merged in rows of one array.
ROW_BYTES = 64
#: Distinct pieces a worker remembers; when full, it forgets all and goes on.
MEMORY = 100_000
#: A rank file larger than this isn't broadcast.
MAX_RANK_FILE = 64 << 20
_BIG = np.int64(1) << 40


class Codec:
    """Encoder and decoder for one rank file; built once in each Python worker."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.split_all = regex.compile(pattern)
        self.split_bmp = re.compile(_bmp_pattern(pattern))
        top = max(self.ranks.values(), default=0) + 1
        words = [b""] * top
        for w, r in self.ranks.items():
            words[r] = w
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.blob = np.frombuffer(b"".join(words), dtype=np.uint8)
        self.byte_id = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int64)
        if (self.byte_id < 0).any():
            raise ValueError("the rank file lacks single bytes")
        pairs = {}
        for w, r in self.ranks.items():
            for k in range(1, len(w)):
                a, b = self.ranks.get(w[:k]), self.ranks.get(w[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in sorted(pairs)], dtype=np.int64)
        self.seen: dict[str, tuple[int, ...]] = {}

    # -- merging -------------------------------------------------------------
    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.pair_keys):
            return np.full(len(a), _BIG)
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _BIG)

    def _merge_rows(self, words: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Merge many words of at most ``width`` (a power of two) bytes side by side."""
        n = len(words)
        size = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(n, width)
        ids = self.byte_id[raw]
        col = np.arange(width)
        nxt = np.tile(col + 1, (n, 1))
        prv = np.tile(col - 1, (n, 1))
        # leaf i: rank of the pair that starts at i, times the width, plus i; the minimum is the leftmost
        tree = np.full((n, 2 * width), _BIG)
        if width > 1:
            r = self._rank_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
            live = (col[1:] < size[:, None]) & (r < _BIG)
            tree[:, width : 2 * width - 1] = np.where(live, r * width + col[:-1], _BIG)
        for k in range(width - 1, 0, -1):
            tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])
        dead = col >= size[:, None]
        rows = np.flatnonzero(tree[:, 1] < _BIG)

        def update(who: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            k = at + width
            tree[who, k] = value
            while k[0] > 1:  # all leaves are on one level
                k = k >> 1
                tree[who, k] = np.minimum(tree[who, 2 * k], tree[who, 2 * k + 1])

        while len(rows):
            root = tree[rows, 1]
            at, rank = root % width, root // width
            gone = nxt[rows, at]
            after = nxt[rows, gone]
            ids[rows, at] = rank
            dead[rows, gone] = True
            nxt[rows, at] = after
            update(rows, gone, np.full(len(rows), _BIG))
            inside = after < size[rows]
            prv[rows[inside], after[inside]] = at[inside]
            value = np.full(len(rows), _BIG)
            r = self._rank_of(rank[inside], ids[rows[inside], after[inside]])
            value[inside] = np.where(r < _BIG, r * width + at[inside], _BIG)
            update(rows, at, value)
            before = prv[rows, at]
            left = before >= 0
            if left.any():
                who, p = rows[left], before[left]
                r = self._rank_of(ids[who, p], rank[left])
                update(who, p, np.where(r < _BIG, r * width + p, _BIG))
            rows = rows[tree[rows, 1] < _BIG]
        keep = ~dead
        flat, cuts = ids[keep].tolist(), np.concatenate([[0], np.cumsum(keep.sum(1))]).tolist()
        return [tuple(flat[cuts[i] : cuts[i + 1]]) for i in range(n)]

    def _merge_one(self, word: bytes) -> tuple[int, ...]:
        """The same tree for one long piece, in plain integers."""
        n = len(word)
        width = 1 << (n - 1).bit_length()
        big, get = int(_BIG), self.pairs.get
        ids = [int(self.byte_id[b]) for b in word]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [big] * (2 * width)
        for i in range(n - 1):
            r = get(ids[i] << 32 | ids[i + 1])
            if r is not None:
                tree[width + i] = r * width + i
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def update(at: int, value: int) -> None:
            k = at + width
            tree[k] = value
            while k > 1:
                k >>= 1
                value = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == value:
                    break
                tree[k] = value

        alive = bytearray(b"\1") * n
        while tree[1] < big:
            rank, at = divmod(tree[1], width)
            gone = nxt[at]
            after = nxt[at] = nxt[gone]
            ids[at], alive[gone] = rank, 0
            update(gone, big)
            value = big
            if after < n:
                prv[after] = at
                r = get(rank << 32 | ids[after])
                value = big if r is None else r * width + at
            update(at, value)
            p = prv[at]
            if p >= 0:
                r = get(ids[p] << 32 | rank)
                update(p, big if r is None else r * width + p)
        return tuple(i for i, a in zip(ids, alive, strict=True) if a)

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that aren't remembered yet."""
        if len(self.seen) > MEMORY:
            self.seen.clear()
        groups: dict[int, tuple[list[str], list[bytes]]] = {}
        for p in pieces:
            if p in self.seen:
                continue
            w = p.encode()
            if (whole := self.ranks.get(w)) is not None:
                self.seen[p] = (whole,)
            elif len(w) > ROW_BYTES:
                self.seen[p] = self._merge_one(w)
            else:
                names, words = groups.setdefault(1 << (len(w) - 1).bit_length(), ([], []))
                names.append(p)
                words.append(w)
        for width, (names, words) in groups.items():
            for k in range(0, len(names), 16_384):
                self.seen.update(zip(names[k : k + 16_384], self._merge_rows(words[k : k + 16_384], width), strict=True))

    # -- texts ---------------------------------------------------------------
    def pieces(self, text: str) -> Iterator[list[str]]:
        """Matches of the pattern, in lists of bounded length."""
        astral = len(text.encode("utf-16-le")) != 2 * len(text)
        split = self.split_all if astral else self.split_bmp
        if len(text) < 1_000_000:
            yield split.findall(text)
            return
        found = (m.group() for m in split.finditer(text))
        while some := list(islice(found, 200_000)):
            yield some

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            self.learn(set(chain.from_iterable(p for _, p in held)))
            look = self.seen.__getitem__
            for i, p in held:
                out[i].append(np.fromiter(chain.from_iterable(map(look, p)), dtype=np.int32))
            held.clear()

        for i, text in enumerate(texts):
            for p in self.pieces(text):
                held.append((i, p))
                size += len(p)
                if size > 200_000:
                    flush()
                    size = 0
        flush()
        return [np.concatenate(x) if x else np.empty(0, np.int32) for x in out]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids one after the other, and the end of each id's bytes among them."""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[ids] - (ends - size), size) + np.arange(total)
        return self.blob[at], ends


def _bmp_pattern(pattern: str) -> str:
    r"""``pattern`` for ``re``: \p{L}, \p{N}, \s and \S spelled out for the basic plane."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    spelled = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        runs = (m.group() for m in regex.finditer(f"(?:{name})+", every))
        spelled[name] = "".join(f"\\u{ord(x[0]):04x}-\\u{ord(x[-1]):04x}" for x in runs)
    if "[^\\s\\p{L}\\p{N}]" in pattern:
        pattern = pattern.replace("[^\\s\\p{L}\\p{N}]", "[^" + "".join(spelled[k] for k in (r"\s", r"\p{L}", r"\p{N}")) + "]")
    for name, chars in spelled.items():
        pattern = pattern.replace(name, f"[{chars}]")
    return pattern.replace(r"\S", f"[^{spelled[chr(92) + 's']}]")


_codecs: dict[str, Codec] = {}


def _codec(shared, pattern: str) -> Codec:
    raw = shared.value
    key = hashlib.sha256(raw + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(raw, pattern)
    return _codecs[key]


def _share(df: DataFrame, ranks_path: str):
    with open(ranks_path, "rb") as f:
        raw = f.read(MAX_RANK_FILE + 1)
    if len(raw) > MAX_RANK_FILE:
        raise ValueError(f"{ranks_path} has over {MAX_RANK_FILE} bytes")
    return df.sparkSession.sparkContext.broadcast(raw)


def _replaced(schema: T.StructType, name: str, kind: T.DataType, drop: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([f for f in schema if f.name != name and f.name not in drop] + [T.StructField(name, kind)])


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out_col: str = "ids", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``out_col``: the token ids (array<int>) of each whole text.

    Null and empty texts give an empty array; rows, repeats included, stay one to
    one; a column that is already named ``out_col`` is replaced.  The rank file is
    read on the driver from ``ranks_path`` and broadcast (its size is checked).
    """
    shared = _share(docs, ranks_path)
    drop = () if keep_text else (text_col,)
    schema = _replaced(docs.schema, out_col, T.ArrayType(T.IntegerType()), drop)
    names = schema.fieldNames()[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                ids = codec.encode([x or "" for x in batch.column(text_col).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                col = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), col], names=[*names, out_col])
        codec.seen.clear()  # workers live on, with other tasks' memory beside this

    return docs.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the bytes (binary) that the ids stand for; null ids give empty bytes."""
    shared = _share(df, ranks_path)
    schema = _replaced(df.schema, out_col, T.BinaryType())
    names = schema.fieldNames()[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                lists = batch.column(ids_col).fill_null([]) if batch.column(ids_col).null_count else batch.column(ids_col)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = np.array([len(x) for x in lists], dtype=np.int64)
                blob, ends = codec.decode(flat)
                last = np.cumsum(sizes)
                at = np.concatenate([[0], np.where(last > 0, ends[np.maximum(last, 1) - 1] if len(ends) else 0, 0)]).astype(np.int32)
                col = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(blob.tobytes())])
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), col], names=[*names, out_col])

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per document: token count and hashes of the ids and of the decoded bytes."""
    ids = encode(docs.select("doc_id", "text"), ranks_path, pattern, keep_text=False)
    both = decode(ids, ranks_path, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
