"""Approximate nearest neighbours: multiprobe p-stable hashing, reranked exactly.

Each table cuts K random projections (Gaussian, so 2-stable) into cells of width w.
A query visits, beside its own bucket, the buckets of perturbed codes in the order
of their estimated success (sum of squared distances to the cell borders crossed,
whose expected order is a fixed template), and every candidate there is scored with
its original vector.  Candidates of all tables are merged by best score.  Where
lengths differ, points get one more coordinate that lifts them all to the same length,
and queries a zero there, so that nearness in the tables is the inner product.
Queries whose probes find too few are scored against all points.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, small_side

#: Projections and cell width (for vectors of unit length), tables, and probes in each table.
K, WIDTH, TABLES, PROBES = 16, 4.0, 2, 2400
#: Queries that are scored against all points together.
EXACT_QUERIES = 4096
#: Buckets that share their first codes are scored together; beyond this many rows in several parts.
CHUNK_CODES, CHUNK_ROWS = 2, 16_384
SEED = 7


def usable(v: Column) -> Column:
    """True for vectors that take part: not null, not zero, all components finite."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def template(k: int, probes: int) -> np.ndarray:
    """Perturbations in estimated success order: rows of places among the 2k borders sorted by distance; -1 is none.

    The expected squared distance of the j-th nearest border has a closed form; sets
    are generated by increasing sum through shift and expand, and those that would
    cross both borders of one projection are left out.
    """
    j = np.arange(1, 2 * k + 1)
    m = 2 * k + 1 - j
    z = np.where(j <= k, j * (j + 1) / (4 * (k + 1) * (k + 2)), 1 - m / (k + 1) + m * (m + 1) / (4 * (k + 1) * (k + 2)))
    out, heap = [()], [(z[0], (0,))]
    while heap and len(out) < probes:
        total, s = heapq.heappop(heap)
        if all(2 * k - 1 - x not in s for x in s):
            out.append(s)
        if (last := s[-1]) + 1 < 2 * k:
            heapq.heappush(heap, (total - z[last] + z[last + 1], (*s[:-1], last + 1)))
            heapq.heappush(heap, (total + z[last + 1], (*s, last + 1)))
    return np.array([[*s, *[-1] * (k - len(s))] for s in out if len(s) <= k])


class Tables:
    def __init__(self, dim: int, k: int, width: float, tables: int, probes: int, chunk: int, seed: int):
        rng = np.random.default_rng(seed)
        self.k, self.width, self.chunk = k, width, chunk
        self.a = rng.normal(size=(tables, dim, k))
        self.b = rng.uniform(0, width, size=(tables, k))
        self.up = rng.normal(size=(tables, k))
        self.sets = template(k, probes)

    def cells(self, t: int, x: np.ndarray, longest: float | None = None) -> np.ndarray:
        """Places in units of cells: of queries scaled to unit length, of points scaled by the ``longest`` and lifted to unit length."""
        if longest is None:
            return (x / np.linalg.norm(x, axis=1, keepdims=True) @ self.a[t] + self.b[t]) / self.width
        u = x / longest
        lift = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", u, u)))
        return (u @ self.a[t] + lift[:, None] * self.up[t] + self.b[t]) / self.width

    def codes(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One number for the first codes and one for all, mixed so that any number of projections fits 64 bits."""
        h = np.clip(h.astype(np.int64) + 32, 0, 63).astype(np.uint64)
        chunk, code = np.zeros(h.shape[:-1], dtype=np.uint64), np.zeros(h.shape[:-1], dtype=np.uint64)
        for i in range(self.k):
            code = (code + h[..., i] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
            if i < self.chunk:
                chunk = chunk * np.uint64(64) + h[..., i]
        return chunk.view(np.int64), code.view(np.int64)

    def probes(self, t: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunk and bucket of each probe of each vector."""
        p = self.cells(t, x)
        h = np.floor(p)
        down = p - h  # distance to the lower border; the upper one is 1 - down away
        order = np.argsort(np.concatenate([down, 1 - down], axis=1), axis=1, kind="stable")
        step = np.zeros((len(x), len(self.sets), self.k), dtype=np.int64)
        rows = np.arange(len(x))[:, None]
        for j in range(self.sets.shape[1]):
            on = np.flatnonzero(self.sets[:, j] >= 0)
            at = order[:, self.sets[on, j]]
            step[rows, on[None], at % self.k] = np.where(at < self.k, -1, 1)
        return self.codes(h[:, None, :] + step)


def search(
    vectors: DataFrame,
    queries: Column,
    top: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    width: float = WIDTH,
    tables: int = TABLES,
    probes: int = PROBES,
    chunk_codes: int = CHUNK_CODES,
    chunk_rows: int = CHUNK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows where ``queries`` holds, their nearest others by inner product.

    Vectors that are null, zero, or hold null or non-finite components take no part;
    vectors are only compared with others of their length.  Equal vectors are one
    point with its ``top + 1`` smallest ids, which is all that a result can show, so
    copies cost nothing.  Ties go to the smaller id.  Queries whose probes find fewer
    than ``top`` others, or all if there are fewer, are scored against all points; repeated ids are one row.  Empty in, empty out.
    """
    rows = vectors.where(usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), queries.alias("q")).where("id is not null")
    rows = rows.dropDuplicates(["id"])
    nth = W.partitionBy("v").orderBy("id")
    points = rows.withColumn("n", F.row_number().over(nth)).where(F.col("n") <= top + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = points.select(F.element_at("ids", 1).alias("point"), "v", "ids").persist()
    asked = rows.where("q").select(F.col("id").alias("query_id"), "v").join(points.select("v", "point"), "v").select("query_id", "point").persist()
    ask = points.join(asked.select("point").distinct(), "point", "left_semi").select("point", "v")
    settings = (k, width, tables, probes, chunk_codes, seed)
    # of each length of vectors (one small row): the longest norm, points, and ids
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    known = {r.dim: r for r in points.groupBy(F.size("v").alias("dim")).agg(F.max(norm).alias("longest"), F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids")).collect()}
    longest = {dim: r.longest for dim, r in known.items()}

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[int, Tables] = {}
        for whole in batches:
            for dim, batch in whole.groupby(whole["v"].map(len)):
                made.setdefault(dim, Tables(dim, *settings))
                x = np.vstack(batch["v"])
                for t in range(tables):
                    chunk, code = made[dim].codes(np.floor(made[dim].cells(t, x, longest[dim])))
                    yield pd.DataFrame({"dim": dim, "t": t, "chunk": chunk, "code": code, "point": batch["point"].to_numpy(), "v": list(x)})

    def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[int, Tables] = {}
        for whole in batches:
            for dim, some in whole.groupby(whole["v"].map(len)):
                made.setdefault(dim, Tables(dim, *settings))
                for s in range(0, len(some), 64):
                    batch = some.iloc[s : s + 64]
                    x = np.vstack(batch["v"])
                    for t in range(tables):
                        chunk, code = made[dim].probes(t, x)
                        out = []
                        for i, point in enumerate(batch["point"]):
                            by = np.argsort(chunk[i], kind="stable")
                            first = np.flatnonzero(np.r_[True, np.diff(chunk[i][by]) > 0])
                            out += [(c, np.unique(codes), point, x[i]) for c, codes in zip(chunk[i][by][first], np.split(code[i][by], first[1:]), strict=True)]
                        c, codes, point, v = zip(*out, strict=True)
                        yield pd.DataFrame({"dim": dim, "t": t, "chunk": c, "codes": codes, "point": point, "v": v})

    index = points.select("point", "v").mapInPandas(hashed, "dim int, t int, chunk long, code long, point long, v array<double>").persist()
    sizes = index.groupBy("dim", "t", "chunk").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("parts"))
    sizes = small_side(sizes.persist())
    key = ["dim", "t", "chunk"]
    left = index.join(sizes, key).withColumn("part", F.expr("pmod(xxhash64(point), parts)").cast("int")).drop("parts")
    right = ask.mapInPandas(probed, "dim int, t int, chunk long, codes array<long>, point long, v array<double>").join(sizes, key)
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def scored(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"query": [], "point": [], "score": []})
        x = x.sort_values("point")
        c, ids, own, found = np.vstack(x["v"]), x["point"].to_numpy(), x["code"].to_numpy(), []
        for query, codes, v in zip(y["point"], y["codes"], y["v"], strict=True):
            seen = np.flatnonzero(np.isin(own, codes))  # only what the probes visit is scored
            if not len(seen):
                continue
            row = c[seen] @ v
            n = min(top + 2, len(row))
            least = np.partition(row, len(row) - n)[len(row) - n]
            at = np.flatnonzero(row >= least)  # all that tie with the last, smaller ids first
            at = at[np.argsort(-row[at], kind="stable")][: top + 2]
            found.append(pd.DataFrame({"query": query, "point": ids[seen[at]], "score": row[at]}))
        if not found:
            return pd.DataFrame({"query": [], "point": [], "score": []})
        return pd.concat(found)

    def best(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
        near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(scored, "query long, point long, score double")
        near = near.groupBy("query", "point").agg(F.max("score").alias("score"))
        order = W.partitionBy("query").orderBy(F.desc("score"), "point")
        return near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= top + 2).drop("n")

    def listed(near: DataFrame) -> DataFrame:
        each = near.join(points.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("vec_id"))
        order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        each = each.withColumn("n", F.row_number().over(order)).where(F.col("n") <= top + 1)
        lists = each.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
        out = asked.join(lists, asked.point == lists["query"], "left")
        return out.select("query_id", "point", F.filter("near", lambda x: x.vec_id != F.col("query_id")).alias("near"))

    near = cut(best(left, right, [*key, "part"]))
    if known:
        of = lambda values: F.element_at(F.create_map(*[F.lit(x) for dim, n in values.items() for x in (dim, n)]), F.col("dim"))
        every = points.select(F.size("v").alias("dim"), "point", "v")
        others = every.select("point", F.least(F.lit(top), of({dim: r.ids - 1 for dim, r in known.items()})).alias("others"))
        found = listed(near).select("point", F.coalesce(F.size("near"), F.lit(0)).alias("found")).join(others, "point")
        short = cut(found.where("greatest(found, 0) < others").select("point").distinct())
        n_short = short.count()
        if n_short:
            groups, parts = -(-n_short // EXACT_QUERIES), {dim: -(-r.n // chunk_rows) for dim, r in known.items()}
            left = every.withColumn("part", F.expr("xxhash64(point)")).withColumn("part", F.pmod("part", of(parts)).cast("int"))
            left = left.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("code", F.lit(0).cast("long"))
            right = every.join(short, "point", "left_semi").select(*[F.col(c).alias(f"q_{c}") for c in every.columns]).toDF(*every.columns).withColumn("group", F.pmod(F.xxhash64("point", F.lit(1)), F.lit(groups)).cast("int"))
            right = right.withColumn("part", F.explode(F.sequence(F.lit(0), (of(parts) - 1).cast("int")))).withColumn("codes", F.array(F.lit(0).cast("long")))
            near = near.join(short, near["query"] == short.point, "left_anti").unionByName(best(left, right, ["dim", "group", "part"]))
    out = listed(near).select("query_id", F.posexplode(F.slice("near", 1, top)).alias("i", "x"))
    return out.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
