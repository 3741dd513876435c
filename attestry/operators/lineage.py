"""Hierarchical labels: weighted votes down a tree, conservative ancestors, catalog consensus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.shared import spread


def distinct_lineages(hits: DataFrame, key: list[str], ranks: list[str], score: str, subject: str) -> DataFrame:
    """LOC-3: one vote for each distinct full lineage of a key, its best hit, weighted by score / best score.

    Repeated references of one lineage add no support.  Equal scores go to the smallest
    ``subject``; null ranks are part of a lineage.  Returns key, ranks, ``subject``,
    ``score`` and ``vote_weight``; keys whose scores are all null or zero weigh nothing.
    """
    best = hits.groupBy(*key, *ranks).agg(F.min(F.struct((-F.col(score)).alias("minus"), F.col(subject).alias("subject"))).alias("__b"))
    top = best.groupBy(*key).agg(F.min("__b.minus").alias("__top"))
    both = best.join(top.select(*[F.col(k).alias(f"__{k}") for k in key], "__top"), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]).drop(*[f"__{k}" for k in key])
    return both.select(*key, *ranks, F.col("__b.subject").alias(subject), (-F.col("__b.minus")).alias(score), F.coalesce(F.try_divide("__b.minus", "__top"), F.lit(0.0)).alias("vote_weight"))


def hierarchical_vote(votes: DataFrame, key: list[str], ranks: list[str], weight: str, threshold: float = 0.60, inherited: str | None = None) -> DataFrame:
    """LOC-3, LOC-7: descend from the top while the heaviest child holds ``threshold`` of its siblings' weight.

    Null ranks abstain: they neither support nor oppose below their last name.  Ties
    go to the largest name.  Returns key, path, depth, support (share of the deepest
    accepted rank), supporting and eligible (the weights of that share; all votes where
    no rank is accepted) and conflict: whether the descent stopped at a contested rank,
    or any vote brought one (``inherited``, a flag of votes).  Keys without an accepted
    rank have depth 0.

    One row per prefix of a lineage (the empty one holds all votes), one aggregate and
    one window over siblings; a node counts only if all of its prefixes won, so no
    iteration is needed.  Votes are shuffled once, by key, before prefixes multiply them.
    """
    path = F.array(*[F.col(r).cast("string") for r in ranks])
    each = votes.select(*key, path.alias("p"), F.col(weight).cast("double").alias("w"), (F.coalesce(inherited, F.lit(False)) if inherited else F.lit(False)).alias("__inherited"))
    depth = F.coalesce(F.nullif(F.array_position(F.transform("p", lambda x: x.isNull()), True), F.lit(0)) - 1, F.lit(len(ranks)))
    each = each.withColumn("d", depth.cast("int"))
    each = spread(each, *key)
    prefix = each.select(*key, "w", "__inherited", F.explode(F.transform(F.sequence(F.lit(0), F.col("d")), lambda i: F.slice("p", 1, i))).alias("prefix"))
    named = F.size("prefix") > 0
    node = prefix.groupBy(*key, "prefix").agg(F.sum("w").alias("w"), F.bool_or("__inherited").alias("__inherited")).withColumn("parent", F.when(named, F.slice("prefix", 1, F.size("prefix") - 1)))
    siblings = W.partitionBy(*key, "parent")
    node = node.withColumn("total", F.sum("w").over(siblings)).withColumn("share", F.coalesce(F.try_divide("w", "total"), F.lit(0.0))).withColumn("n", F.count("*").over(siblings))
    node = node.withColumn("r", F.row_number().over(siblings.orderBy(F.desc("w"), F.desc("prefix")))).where("r = 1")
    node = node.withColumn("won", F.col("share") + 1e-12 >= threshold)
    best = F.map_from_entries(F.collect_list(F.when(named, F.struct("parent", F.struct("prefix", "share", "won", "n", "w", "total")))))
    lists = node.groupBy(*key).agg(best.alias("best"), F.max(F.when(~named, F.col("w"))).alias("__all"), F.bool_or(F.when(~named, F.col("__inherited"))).alias("__inherited"))
    none = F.lit(None).cast("double")
    start = F.struct(F.array().cast("array<string>").alias("path"), F.lit(1.0).alias("support"), none.alias("supporting"), none.alias("eligible"), F.lit(False).alias("conflict"), F.lit(True).alias("open"))

    def step(a, _):
        found = F.element_at("best", a.path)
        go = a.open & F.coalesce(found.won, F.lit(False))
        return F.struct(
            F.when(go, found.prefix).otherwise(a.path).alias("path"),
            F.when(go, found.share).otherwise(a.support).alias("support"),
            F.when(go, found.w).otherwise(a.supporting).alias("supporting"),
            F.when(go, found.total).otherwise(a.eligible).alias("eligible"),
            F.when(a.open & ~F.coalesce(found.won, F.lit(True)), found.n > 1).otherwise(a.conflict).alias("conflict"),
            go.alias("open"),
        )

    out = lists.withColumn("v", F.aggregate(F.sequence(F.lit(1), F.lit(len(ranks))), start, step))
    every = out.select(*key, "__all", "__inherited", *[F.col(f"v.{c}").alias(c) for c in ("path", "support", "supporting", "eligible", "conflict")])
    return every.select(
        *key,
        "path",
        F.size("path").alias("depth"),
        "support",
        F.coalesce("supporting", "__all").alias("supporting"),
        F.coalesce("eligible", "__all").alias("eligible"),
        (F.col("conflict") | F.col("__inherited")).alias("conflict"),
    )


def balanced_lca(members: DataFrame, rep: str, group: str, ranks: list[str]) -> DataFrame:
    """REF-4: conservative common lineage of a representative's members, each group counted once.

    Level one finds each (representative, group)'s own consensus, level two that of a
    representative's groups.  A rank survives while no rank so far has two names;
    conflict_rank is the first rank at which either level disagrees (0: none).
    """
    n = len(ranks)

    def level(df: DataFrame, keys: list[str], conflict: str) -> DataFrame:
        aggs = [a for r in ranks for a in (F.min(r).alias(f"__v_{r}"), F.max(r).alias(f"__m_{r}"))]
        extra = [F.min(F.nullif("__c", F.lit(0))).alias("__below")] if "__c" in df.columns else []
        out = df.groupBy(*keys).agg(*aggs, F.count("*").alias("__rows"), *extra)
        same = [F.coalesce(F.col(f"__v_{r}") == F.col(f"__m_{r}"), F.lit(True)) for r in ranks]
        at = F.coalesce(*[F.when(~s, F.lit(i + 1)) for i, s in enumerate(same)], F.lit(0))
        keep = [F.when(reduce(lambda a, b: a & b, same[: i + 1]), F.col(f"__v_{r}")).alias(r) for i, r in enumerate(ranks)]
        return out.select(*keys, *keep, at.alias(conflict), "__rows", *(["__below"] if extra else []))

    first = level(members, [rep, group], "__c")
    second = level(first.drop("__rows"), [rep], "__own")
    sizes = first.groupBy(rep).agg(F.sum("__rows").alias("members"), F.count_if(F.col("__c") > 0).alias("groups_in_conflict"))
    low = F.least(F.coalesce(F.nullif("__own", F.lit(0)), F.lit(n + 1)), F.coalesce("__below", F.lit(n + 1)))
    out = second.withColumn("conflict_rank", F.when(low > n, 0).otherwise(low))
    cut = [F.when((F.col("conflict_rank") == 0) | (F.col("conflict_rank") > i + 1), F.col(r)).alias(r) for i, r in enumerate(ranks)]
    return out.select(rep, *cut, F.col("__rows").alias("groups"), "conflict_rank").join(sizes, rep)


def catalog_consensus(catalog: DataFrame, ranks: list[str]) -> DataFrame:
    """TAX-2: for each (rank, taxon) the lineage that all its catalog paths share; ranks that differ are null."""
    each = catalog.select(*ranks, F.posexplode(F.array(*ranks)).alias("i", "taxon")).where("taxon is not null")
    shared = [F.when(F.count_distinct(r) == 1, F.min(r)).alias(r) for r in ranks]
    return each.groupBy((F.col("i") + 1).alias("rank"), "taxon").agg(*shared, F.count("*").alias("paths"))
