"""Mixing sources to target weights: iterative proportional fitting over token counts.

DataFrame functions only.  Tokens are summed by cell (source, language, topic); each
round rakes the cells' weights to one marginal after the other until all marginals
meet their targets, where no cell can be kept more than whole; documents are then
sampled by the cells' probabilities.  A value too rare for its target is kept whole,
its shortfall is shared out among the others and reported.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

_LOG = logging.getLogger(__name__)

MARGINS = ("source", "lang", "topic")
#: Share of all tokens that the mixture keeps if its targets allow, and the deviation that ends the rounds.
KEEP, TOLERANCE = 0.6, 1e-3
#: Rounds that no longer lower the deviation by this factor are stalled; the kept share then falls by the second.
STALLED, LOWER = 0.98, 0.8
SEED = 17
#: Up to so many cells, rounds run in one task, without a shuffle or broadcast in any of them.
ONE_TASK = 100_000


def topic_of(text: Column) -> Column:
    """A coarse topic from the form of a text: empty, table, notes (noisy marks), shouting, short or prose."""
    return (
        F.when(F.length(F.trim(text)) == 0, "empty")
        .when(text.contains(" | "), "table")
        .when(text.rlike(r"[#%&$*]{3}"), "notes")
        .when(~text.rlike(r"\p{Ll}"), "shouting")
        .when(F.length(text) < 400, "short")
        .otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    """Number of words, at least one, so that an empty document still has a weight."""
    return F.greatest(F.size(F.split(F.trim(text), r"\s+")), F.lit(1)).cast("double")


def flattened(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Default targets: shares in proportion to the observed ones to ``power`` (below 1: hot sources shrink)."""
    seen = cells.groupBy(margin).agg(F.sum("tokens").alias("t"))
    total = seen.agg(F.sum(F.pow("t", F.lit(power))).alias("all"))
    return seen.crossJoin(F.broadcast(total)).select(margin, (F.pow("t", F.lit(power)) / F.col("all")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], keep: float, tolerance: float = TOLERANCE, few: bool = False) -> tuple[DataFrame, float, bool]:
    """``cells`` (margins, tokens, share) with ``g``, the largest deviation from the targets, and whether ``keep`` bounds any cell.

    A cell's part of the mixture is share * min(g, 1 / keep): at the bound it is kept
    whole.  Each step multiplies the g of a marginal's value so that its cells below
    the bound make up for those at it.  Values that a target table lacks get no weight.
    ``few``: the cells fit one task (ONE_TASK); they then carry their targets, and sums
    by value are windows over them, so that a round moves and broadcasts nothing.
    """
    bound = F.lit(1 / keep)
    whole, part = F.col("g") >= bound, F.least("g", bound) * F.col("share")
    w, before = cells.withColumn("g", F.lit(1.0)), None
    if few:
        for margin, target in targets.items():
            w = w.join(target.select(margin, F.struct("target").alias(f"__{margin}")), margin, "left")
        w = cut(w.coalesce(1)).coalesce(1)
    while True:
        for margin, target in targets.items():
            sums = (F.sum(F.when(whole, part).otherwise(0.0)), F.sum(F.when(whole, 0.0).otherwise(part)))
            want, sure, free = F.col("target"), F.col("fixed"), F.col("free")
            f = F.when((want > sure) & (free > 0), (want - sure) / free).when(want < sure + free, want / (sure + free)).otherwise(1.0)
            if few:
                by = W.partitionBy(margin)
                w = w.select("*", sums[0].over(by).alias("fixed"), sums[1].over(by).alias("free"), F.col(f"__{margin}.target").alias("target"))
                w = w.withColumn("g", F.col("g") * F.when(F.col(f"__{margin}").isNull(), 0.0).otherwise(f)).drop("fixed", "free", "target")
                continue
            now = w.groupBy(margin).agg(sums[0].alias("fixed"), sums[1].alias("free"))
            w = w.join(now.join(target, margin).select(margin, f.alias("f")), margin, "left").withColumn("g", F.col("g") * F.coalesce("f", F.lit(0.0))).drop("f")
        w = cut(w).coalesce(1) if few else cut(w)
        off = None
        for margin, target in targets.items():
            if few:
                each = w.groupBy(margin).agg(F.sum(part).alias("now"), F.first(f"__{margin}.target").alias("target"))
            else:
                each = w.groupBy(margin).agg(F.sum(part).alias("now")).join(target, margin)
            each = each.select(F.abs(F.col("now") - F.col("target")).alias("off"))
            off = each if off is None else off.unionAll(each)
        off = off.coalesce(1) if few else off
        worst = off.agg(F.max("off")).first()[0] or 0.0
        if worst <= tolerance or (before is not None and worst > STALLED * before):
            return w.drop(*[f"__{m}" for m in targets]), worst, w.where(whole).limit(1).count() > 0
        before = worst


def within_reach(seen: DataFrame, keep: float) -> DataFrame:
    """``seen`` (now, target, shares that sum to 1) with ``goal``: the target, or now / ``keep`` where that is less.

    What such values fall short of is shared out among the others in proportion to
    their targets, which may bring others to their limit; rounds end with the last.
    """
    room = F.col("now") / F.lit(keep)
    now, n = seen.withColumn("full", F.col("target") <= 0), -1
    while True:
        taken, free, full = now.agg(F.sum(F.when(F.col("full") & (F.col("target") > 0), room).otherwise(0.0)), F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("target"))), F.count_if("full")).first()
        scale = F.lit(max(0.0, 1 - (taken or 0.0)) / free if free else 0.0)
        if full == n or not free:
            goal = F.when(F.col("target") <= 0, 0.0).when(F.col("full"), room).otherwise(F.col("target") * scale)
            return now.withColumn("goal", goal).drop("full")
        now, n = cut(now.withColumn("full", F.col("full") | (F.col("target") * scale > room))), full


def calibrated(cells: DataFrame, targets: dict[str, DataFrame], keep: float, tolerance: float = TOLERANCE, exact: bool = False) -> DataFrame:
    """``cells`` (margins, tokens) with ``weight``, the cell's part of the mixture, and ``p``, the share of it that is kept.

    Expected tokens are ``keep`` of all, or all that have a target if those are fewer.
    Values that are too rare for their target at that share are kept whole, and the
    others meet theirs among each other (:func:`within_reach`).  With ``exact`` less is
    kept instead, until all targets are met: one rare value then bounds the whole
    mixture.  Targets that contradict each other aren't met by any share; the last
    round stands and its deviation is logged.
    """
    total, n = cells.agg(F.sum("tokens"), F.count("*")).first()
    few = n <= ONE_TASK
    if not total:
        return cells.withColumns({"weight": F.lit(0.0), "p": F.lit(1.0)})
    cells = cells.withColumn("share", F.col("tokens") / F.lit(float(total)))
    cells = cut(cells.coalesce(1)).coalesce(1) if few else cut(cells)
    margins, room = {}, None
    for margin, target in targets.items():
        seen = cells.groupBy(margin).agg(F.sum("share").alias("now")).join(target, margin)
        seen = seen.coalesce(1) if few else seen  # no more rows than cells
        all_of = F.broadcast(seen.agg(F.sum("target").alias("all")))
        margins[margin] = cut(seen.crossJoin(all_of).select(margin, "now", F.when(F.col("all") > 0, F.col("target") / F.col("all")).otherwise(0.0).alias("target")))
        allowed = margins[margin].where("target > 0").agg(F.sum("now"), F.min(F.col("now") / F.col("target"))).first()
        keep = min(keep, allowed[0] or keep)
        room = min(x for x in (room, allowed[1], 1.0) if x is not None)
    if exact:
        keep = min(keep, room)
    here = {m: within_reach(seen, keep).select(m, F.col("goal").alias("target")) for m, seen in margins.items()}
    while True:
        w, worst, bounded = rake(cells, here, keep, tolerance, few)
        if worst <= tolerance or not bounded or not exact:
            break
        keep *= LOWER
    if worst > tolerance:
        _LOG.warning("mixing: the targets aren't met together; the largest deviation of a share is %.4f at a kept share of %.3f", worst, keep)
    p = F.least(F.lit(1.0), F.lit(keep) * F.col("g"))
    return w.withColumns({"weight": F.col("share") * F.least("g", F.lit(1 / keep)), "p": p}).drop("share", "g")


def report(weighted: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """(margin, value, target, share, shortfall, kept) of every value, from what :func:`calibrated` gives: its share of the mixture against its target, and the part of its tokens that is kept."""
    out, total = None, F.broadcast(weighted.agg(F.sum(F.col("p") * F.col("tokens")).alias("all")))
    for margin, target in targets.items():
        each = weighted.groupBy(margin).agg(F.sum(F.col("p") * F.col("tokens")).alias("got"), F.sum("tokens").alias("tokens")).join(target, margin, "left").crossJoin(total)
        share, want = F.coalesce(F.try_divide("got", "all"), F.lit(0.0)), F.coalesce("target", F.lit(0.0))
        rows = each.select(F.lit(margin).alias("margin"), F.col(margin).alias("value"), want.alias("target"), share.alias("share"), F.greatest(want - share, F.lit(0.0)).alias("shortfall"), F.coalesce(F.try_divide("got", "tokens"), F.lit(0.0)).alias("kept"))
        out = rows if out is None else out.unionByName(rows)
    return out


def cells_of(docs: DataFrame, text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(source, lang, topic, tokens) summed over ``docs``, nulls as ''."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = {"source": F.coalesce(F.col(source_col).cast("string"), F.lit("")), "lang": F.coalesce(F.col(lang_col).cast("string"), F.lit("")), "topic": topic_of(text)}
    narrow = docs.select(*[c.alias(k) for k, c in key.items()], tokens_of(text).alias("tokens"))
    return cut(narrow.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")))


def mix(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    keep: float = KEEP,
    power: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    seed: int = SEED,
    with_weights: bool = False,
    exact: bool = False,
) -> DataFrame:
    """The rows of ``docs`` that the mixture samples, columns unchanged (``with_weights``: all rows, narrow).

    ``targets`` maps source, lang and topic to tables (value, target) of shares that
    sum to 1; by default the observed shares to ``power``.  ``keep`` of all tokens are
    kept; values too rare for their target stay whole and fall short of it, or with
    ``exact`` less of everything is kept (see :func:`calibrated`; :func:`report` tells by how much).  A row stays if the hash of
    its id and the seed, as a number in [0, 1), is below its cell's probability, so a
    repeated id has one fate.  Null sources, languages and texts are cells of their
    own (as ''); an empty table gives an empty result.

    The probabilities are one small row per cell, joined to the documents by cell:
    broadcast when Spark measures them as small, else by a join that splits hot cells.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = {"source": F.coalesce(F.col(source_col).cast("string"), F.lit("")), "lang": F.coalesce(F.col(lang_col).cast("string"), F.lit("")), "topic": topic_of(text)}
    cells = cells_of(docs, text_col, source_col, lang_col)
    targets = targets or {m: flattened(cells, m, power) for m in MARGINS}
    n_cells = cells.count()
    weights = calibrated(cells, targets, keep, exact=exact).select(*[F.col(m).alias(f"__{m}") for m in MARGINS], "weight", "p")
    weights = F.broadcast(weights) if n_cells <= 100_000 else weights
    u = (F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)) / F.lit(2.0**64)) + 0.5
    on = [c.alias(f"__k_{k}") for k, c in key.items()]
    if with_weights:
        rows = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(k) for k, c in key.items()], tokens_of(text).cast("long").alias("tokens"), u.alias("u"))
        out = rows.join(weights, [F.col(m) == F.col(f"__{m}") for m in MARGINS])
        return out.select("doc_id", *MARGINS, "tokens", F.round("p", 6).alias("p"), (F.col("u") < F.col("p")).alias("kept"))
    rows = docs.select("*", *on, u.alias("__u"))
    out = rows.join(weights, [F.col(f"__k_{m}") == F.col(f"__{m}") for m in MARGINS]).where(F.col("__u") < F.col("p"))
    return out.select(*[docs[c] for c in docs.columns])
