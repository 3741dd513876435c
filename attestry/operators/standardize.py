"""Standardizers (STD-1 to STD-12): a source's own table as rows of the evidence schema.

Each takes the native columns by plain names, keeps the rows its source qualifies,
and adds classification, evidence_strength and strength_basis.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import RANKS, clean_missing, interval, interval_text

# The core columns of the evidence schema.
CORE = ("sample_id", "sequence_id", "parent_sequence_id", "record_type", "coordinates", "tool", "classification", "score", "score_type", "length", "topology", "n_genes", "n_hallmarks")


def union_evidence(*frames: DataFrame) -> DataFrame:
    """STD-12: all sources in one schema; columns that a source lacks are null, unnamed ranks stay null."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    missing = [c for c in (*CORE, *RANKS) if c not in out.columns]
    return out.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else out


def _strength(strong: Column, basis: tuple[str, str], tool: str) -> dict[str, Column]:
    good = F.coalesce(strong, F.lit(False))
    return {"tool": F.lit(tool), "evidence_strength": F.when(good, "strong").otherwise("qualified"), "strength_basis": F.when(good, basis[0]).otherwise(basis[1])}


def marker_calls(virus: DataFrame, plasmid: DataFrame, genes: DataFrame, tool: str = "marker", min_score: float = 0.80, max_fdr: float = 0.05, min_enrichment: float = 1.5, max_uscg: int = 2) -> DataFrame:
    """STD-1: marker-gene calls for both classes; strong needs score, fdr, genes, enrichment, hallmarks and few universal genes."""
    both = virus.withColumn("classification", F.lit("virus")).unionByName(plasmid.withColumn("classification", F.lit("plasmid")))
    per = genes.groupBy(F.regexp_extract("gene", r"^(.*)_\d+$", 1).alias("sequence_id")).agg(F.count("*").alias("gene_rows"), F.count_if("hallmark").alias("hallmark_rows"), F.count_if("uscg").alias("uscg_rows"))
    out = both.join(per, "sequence_id", "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    strong = (F.col("score") >= min_score) & (F.col("fdr").isNull() | (F.col("fdr") <= max_fdr)) & (n("gene_rows") >= 1) & (F.col("enrichment") >= min_enrichment) & (n("hallmark_rows") >= 1) & (n("uscg_rows") <= max_uscg)
    return out.withColumns(_strength(strong, ("marker_conservative_filters", "marker_reported_call"), tool))


def classifier_scores(df: DataFrame, tool: str = "classifier", strong: float = 0.90, qualified: float = 0.50) -> DataFrame:
    """STD-2: scores over two cut-offs; unscored hallmark rows are for review; the rest is dropped."""
    review = F.col("score").isNull() & (F.col("hallmarks") > 0)
    out = df.where((F.col("score") >= qualified) | review).withColumn("review", F.coalesce(review, F.lit(False)))
    level = F.when(F.col("review"), "review").when(F.col("score") >= strong, "strong").otherwise("qualified")
    basis = F.when(F.col("review"), "hallmark_without_score").when(F.col("score") >= strong, "score_strong").otherwise("score_qualified")
    return out.withColumns({"tool": F.lit(tool), "classification": F.lit("virus"), "evidence_strength": level, "strength_basis": basis})


def hallmark_counts(hits: DataFrame, record_cols: list[str], tool: str = "hallmark") -> DataFrame:
    """STD-3: distinct hallmark genes of a record; strong with two or more, unless an end feature marks the whole record.

    ``hits``: record columns, gene, start, stop, region (bool), end_feature (bool).
    """
    per = hits.groupBy(*record_cols).agg(F.count_distinct("gene", "start", "stop").alias("n_hallmarks"), F.bool_or("region").alias("region"), F.bool_or("end_feature").alias("end_feature")).where("n_hallmarks >= 1")
    strong = (F.col("region") | ~F.col("end_feature")) & (F.col("n_hallmarks") >= 2)
    return per.withColumn("classification", F.lit("virus")).withColumns(_strength(strong, ("multiple_hallmarks", "single_hallmark"), tool))


def _top(classes: list[str]) -> tuple[Column, Column]:
    """(highest value, its class if unique else null)."""
    values = F.array(*[F.struct(F.col(c).cast("double").alias("v"), F.lit(c).alias("c")) for c in classes])
    top = F.greatest(*[F.col(c).cast("double") for c in classes])
    best = F.filter(values, lambda x: F.abs(x.v - top) <= 1e-12)
    return top, F.when(F.size(best) == 1, best[0]["c"])


def argmax_by_class(df: DataFrame, classes: list[str], thresholds: dict[str, float], origin: dict[str, str], tool: str) -> DataFrame:
    """STD-4: the one most likely class, if it reaches its own threshold."""
    top, name = _top(classes)
    out = df.withColumn("score", top).withColumn("class", name).where("class is not null")
    look = lambda m: F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.col("class"))
    return out.where(F.col("score") >= look(thresholds)).withColumns({"classification": look(origin), "tool": F.lit(tool), "evidence_strength": F.lit("qualified"), "strength_basis": F.lit("top_class_threshold")})


def argmax_by_median(df: DataFrame, classes: list[str], origin: dict[str, str], tool: str, minimum: float = 0.7, multiplier: float = 1.25) -> DataFrame:
    """STD-5: the one highest score, at least ``minimum`` and ``multiplier`` times the median of all."""
    top, name = _top(classes)
    ordered = F.array_sort(F.array(*[F.col(c).cast("double") for c in classes]))
    n = len(classes)
    median = ordered[n // 2] if n % 2 else (ordered[n // 2 - 1] + ordered[n // 2]) / 2
    out = df.withColumn("score", top).withColumn("class", name).where((F.col("score") >= minimum) & (F.col("score") >= multiplier * median) & F.col("class").isNotNull())
    look = F.element_at(F.create_map(*[F.lit(x) for kv in origin.items() for x in kv]), F.col("class"))
    return out.withColumns({"classification": look, "tool": F.lit(tool), "evidence_strength": F.lit("qualified"), "strength_basis": F.lit("top_score_and_median")})


def model_calls(df: DataFrame, consensus: DataFrame, rank: str, prefix: tuple[str, str], ranks: list[str], tool: str, minimum_length: int = 3000) -> DataFrame:
    """STD-6: positive calls of sufficient length whose taxon the catalog places under a fixed name.

    ``df``: length, positive, taxon; ``consensus``: rank, taxon, the ranks; ``prefix``: (rank, name).
    """
    good = df.where(F.col("positive") & (F.col("length") >= minimum_length))
    place = consensus.where(F.col("rank") == ranks.index(rank) + 1).where(F.col(prefix[0]) == prefix[1]).select("taxon", *ranks)
    out = good.join(place, "taxon", "left")
    return out.withColumns({"classification": F.lit("virus"), "tool": F.lit(tool), "evidence_strength": F.lit("qualified"), "strength_basis": F.when(F.col(prefix[0]).isNotNull(), "model_with_taxon").otherwise("model_only")})


def deepest_taxon(df: DataFrame, consensus: DataFrame, id_col: str, tokens: str, ranks: list[str]) -> DataFrame:
    """STD-7: the lineage of the deepest token that the catalog knows, in any case; ids without one have nulls."""
    each = df.select(id_col, F.explode(tokens).alias("t")).select(id_col, F.lower(F.trim("t")).alias("t"))
    known = consensus.select(F.lower("taxon").alias("t"), F.col("rank").alias("__rank"), F.struct(*ranks).alias("__l"))
    best = each.join(known, "t").groupBy(id_col).agg(F.max(F.struct("__rank", "t", "__l")).alias("__b"))
    return df.join(best, id_col, "left").select(*df.columns, F.col("__b.__rank").alias("rank"), *[F.col(f"__b.__l.{r}").alias(r) for r in ranks])


def quality_ladder(df: DataFrame, tool: str = "quality") -> DataFrame:
    """STD-8: gene content decides the origin, completeness its strength.

    ``df``: viral_genes, host_genes, quality, confident (bool), record_type.
    """
    v, h = F.col("viral_genes"), F.col("host_genes")
    high = F.lower("quality").isin("complete", "high-quality")
    medium = F.lower("quality") == "medium-quality"
    ladder = [
        ((v == 0) & (h > 0), "cellular", "qualified", "host_genes_without_viral_genes"),
        (v == 0, "unclassified", "weak", "no_informative_genes"),
        (high & F.col("confident"), "virus", "strong", "high_quality_confident"),
        (F.col("record_type") == "provirus", "virus", "qualified", "provirus_boundary_with_viral_genes"),
        (high & (h == 0), "virus", "qualified", "high_quality_viral_genes"),
        (medium & (h == 0), "virus", "qualified", "medium_quality_viral_genes"),
        (h == 0, "virus", "weak", "low_quality_viral_genes"),
    ]
    rest = ("virus", "weak", "mixed_host_and_viral_genes")
    out = {}
    for i, name in enumerate(("classification", "evidence_strength", "strength_basis")):
        c = F.when(ladder[0][0], ladder[0][i + 1])
        for step in ladder[1:]:
            c = c.when(F.coalesce(step[0], F.lit(False)), step[i + 1])
        out[name] = c.otherwise(rest[i])
    return df.withColumns({**out, "tool": F.lit(tool)})


def mobile_domains(df: DataFrame, viral_like: tuple[str, ...], unclear: tuple[str, ...], tool: str = "mobile") -> DataFrame:
    """STD-9: category by labels, strength by direct evidence and completeness.

    ``df``: labels (array), domain_count, complete.
    """
    labels = F.transform("labels", lambda x: F.lower(F.trim(x)))
    hit = lambda names: F.arrays_overlap(labels, F.array(*[F.lit(n) for n in names]))
    category = F.when(hit(viral_like), "viral_like_mobile_element").when(hit(unclear), "ambiguous_mobile_element").otherwise("retroelement")
    direct = F.col("domain_count") > 0
    strength = F.when(~direct, "weak").when(F.lower("complete") == "yes", "strong").otherwise("qualified")
    return df.withColumns({"category": category, "evidence_strength": strength, "assignment_method": F.when(direct, "direct").otherwise("second_pass"), "tool": F.lit(tool)})


#: Names of one rank are broadcast only after they were counted and found to be at most this many.
BROADCAST_NAMES = 1_000_000
#: Parts into which the rows of one name are dealt where the names of a rank are joined by a shuffle.
DEALT = 32


def best_lineages(df: DataFrame, index: DataFrame, id_col: str, ranks: list[str]) -> DataFrame:
    """STD-10: named ranks that the catalog has at that rank stay, others become null; ``unknown`` counts them.

    Each row is judged by itself.  A rank's names are looked up by broadcast; more than
    ``BROADCAST_NAMES`` are joined, with every name's rows dealt into ``DEALT`` parts, as
    the upper ranks have few names.
    """
    out, known = df, []
    names = index.select("rank", "taxon").where("taxon is not null").distinct()
    sizes = {r["rank"]: r["count"] for r in names.groupBy("rank").count().where(F.col("rank").between(1, len(ranks))).collect()}
    for i, r in enumerate(ranks):
        own = names.where(F.col("rank") == i + 1).select(F.col("taxon").alias(f"__t{i}"), F.lit(True).alias(f"__k{i}"))
        if sizes.get(i + 1, 0) <= BROADCAST_NAMES:
            out = out.join(F.broadcast(own), F.col(r) == F.col(f"__t{i}"), "left")
        else:
            own = own.withColumn(f"__d{i}", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
            out = out.join(own, (F.col(r) == F.col(f"__t{i}")) & (F.pmod(F.xxhash64(id_col), F.lit(DEALT)) == F.col(f"__d{i}")), "left")
        known.append(F.coalesce(F.col(f"__k{i}"), F.lit(False)))
    kept = [F.when(k, F.col(r)).alias(r) for k, r in zip(known, ranks, strict=True)]
    unknown = reduce(lambda a, b: a + b, [(F.col(r).isNotNull() & ~k).cast("long") for k, r in zip(known, ranks, strict=True)])
    return out.select(*[c for c in df.columns if c not in ranks], *kept, unknown.alias("unknown"))


def _region_lists(df: DataFrame, types: str, coordinates: str, length: str, total: str) -> DataFrame:
    """STD-8: ``df`` with ``regions`` (type, start, end in the order of both lists) and ``fault``, the first thing wrong with them."""
    # each step is named once and used by the next, so that no list is taken apart twice
    let = lambda value, body: F.transform(F.array(value), body)[0]

    def parsed(text: Column, piece) -> Column:
        return F.transform(F.split(clean_missing(text), ","), piece)

    def judged(k: Column, s: Column) -> Column:
        same = F.size(k) == F.size(s)
        zipped = F.when(same, F.zip_with(k, s, lambda k, s: F.struct(k.alias("type"), s.start.alias("start"), s.end.alias("end"))))
        return let(zipped, lambda r: F.struct(r.alias("regions"), fault(k, s, same, r).alias("fault")))

    def fault(k: Column, s: Column, same: Column, regions: Column) -> Column:
        # (viral regions, their sum, whether all follow each other, end of the last), over the list once
        first = F.struct(F.lit(0).cast("long").alias("viral"), F.lit(0).cast("long").alias("covered"), F.lit(True).alias("ordered"), F.lit(0).cast("long").alias("at"))
        viral = lambda r: F.coalesce(r.type == "viral", F.lit(False))
        walk = F.aggregate(regions, first, lambda a, r: F.struct(
            (a.viral + viral(r).cast("long")).alias("viral"),
            (a.covered + F.when(viral(r), r.end - r.start + 1).otherwise(0)).alias("covered"),
            (a.ordered & (r.start > a.at)).alias("ordered"),
            r.end.alias("at"),
        ))
        return (
            F.when(k.isNull() | s.isNull(), "no_regions")
            .when(~same, "lists_differ_in_length")
            .when(F.exists(s, lambda x: x.isNull()), "bad_coordinate")
            .when(F.exists(regions, lambda r: r.end > F.col(length)), "beyond_record")
            .otherwise(let(walk, lambda w: F.when(~w.ordered, "out_of_order").when(w.viral == 0, "no_viral_region").when(~F.col(total).eqNullSafe(w.covered), "sum_differs_from_reported")))
        )

    kinds = parsed(F.col(types), lambda x: F.lower(F.trim(x)))
    spans = parsed(F.col(coordinates), interval)
    both = let(F.struct(kinds.alias("k"), spans.alias("s")), lambda x: judged(x.k, x.s))
    # a generator: filters on what it yields don't bring the parsing back below it
    return df.select("*", F.inline(F.array(both)))


def region_faults(df: DataFrame, id_col: str, types: str, coordinates: str, length: str, total: str) -> DataFrame:
    """STD-8: (id, fault) of records whose parallel lists don't make regions."""
    return _region_lists(df, types, coordinates, length, total).where("fault is not null").select(id_col, "fault")


def viral_regions(df: DataFrame, id_col: str, types: str, coordinates: str, length: str, total: str, strict: bool = True) -> DataFrame:
    """STD-8: one row for each viral region of a record's parallel lists of types and coordinates.

    Adds sequence_id (``<id>|provirus_<start>_<end>``), parent_sequence_id, record_type,
    coordinates, start, end and region_length.  Both lists must be of one length and in
    ascending, disjoint order, lie within ``length``, hold a viral region, and the viral
    ones sum to ``total``; a record that breaks this raises, or with ``strict`` off has
    no regions here and a row in :func:`region_faults`.
    """
    lists = _region_lists(df, types, coordinates, length, total)
    if strict:
        message = F.concat(F.lit("regions of "), F.col(id_col).cast("string"), F.lit(": "), F.col("fault"))
        lists = lists.withColumn("regions", F.when(F.col("fault").isNotNull(), F.raise_error(message).cast(lists.schema["regions"].dataType)).otherwise(F.col("regions")))
    else:
        lists = lists.where("fault is null")
    each = lists.select(*df.columns, F.explode(F.filter("regions", lambda r: r.type == "viral")).alias("__r"))
    start, end = F.col("__r.start"), F.col("__r.end")
    return each.withColumns({
        "sequence_id": F.concat(F.col(id_col).cast("string"), F.lit("|provirus_"), start.cast("string"), F.lit("_"), end.cast("string")),
        "parent_sequence_id": F.col(id_col).cast("string"),
        "record_type": F.lit("provirus"),
        "coordinates": interval_text(start, end),
        "start": start,
        "end": end,
        "region_length": end - start + 1,
    }).drop("__r")


# Predictions that name no taxon.
UNNAMED = ("", "default", "singleton", "unclassified")


def group_table(regions: DataFrame, assignments: DataFrame, domains: list[str], id_col: str, ranks: list[str], informal: tuple[str, ...] = ("subfamily",)) -> DataFrame:
    """STD-11: every region for every database domain, with what its group predictions support.

    ``assignments``: id, database_domain, reference (text flag), ``<rank>_prediction``
    and, below the first rank, ``<rank>_evidence``.  A name is accepted at the first rank
    if it isn't synthetic (placeholders, ``novel_``, ``unplaced_``, joined by ``|``), below
    it if its evidence is also ``reference``; informal ranks count as support, not as
    taxonomy.  The grid is as large as regions times the given domains, and a pair
    without an assignment is ``not_reported``.  A repeated assignment, and one marked as
    a reference's own, raises.
    """
    key = [id_col, "database_domain"]
    grid = regions.withColumn("database_domain", F.explode(F.array(*[F.lit(d) for d in domains])))
    cells = F.struct(*[F.col(c) for c in assignments.columns if c not in key])
    own = assignments.join(regions.select(id_col).distinct(), id_col, "left_semi").groupBy(*key).agg(F.first(cells).alias("a"), F.count("*").alias("__n"))
    flag = F.lower(F.trim(F.coalesce(F.col("a.reference").cast("string"), F.lit(""))))
    bad = F.when(F.col("__n") > 1, "repeated assignment of ").when(flag.isin("true", "1"), "reference row for ")
    own = own.withColumn("__n", F.when(bad.isNotNull(), F.raise_error(F.concat(bad, F.col(id_col).cast("string"))).cast("long")).otherwise(F.col("__n")))
    out = grid.join(own, key, "left")
    text = {r: F.coalesce(F.trim(F.col(f"a.{r}_prediction")), F.lit("")) for r in ranks}
    lower = {r: F.lower(c) for r, c in text.items()}
    named = {r: ~lower[r].isin(*UNNAMED) & ~lower[r].rlike("^(novel_|unplaced_)") & ~text[r].contains("|") for r in ranks}
    backed = {r: named[r] & (F.lower(F.trim(F.coalesce(F.col(f"a.{r}_evidence"), F.lit("")))) == "reference") for r in ranks[1:]}
    accepted = {ranks[0]: named[ranks[0]], **{r: c for r, c in backed.items() if r not in informal}}
    deepest = lambda rules: F.coalesce(*[F.when(c, F.lit(r)) for r, c in reversed(list(rules.items()))], F.lit(""))
    listed = lambda start: F.array_join(F.array_compact(F.array(*[F.when(lower[r].startswith(start), F.lit(r)) for r in ranks])), ",")
    some = reduce(lambda a, b: a | b, [c != "" for c in text.values()])
    seen = F.col("__n").isNotNull()
    status = F.when(~seen, "not_reported").when(lower[ranks[0]] == "singleton", "singleton").when(flag.isin("false", "0"), "clustered").when(some, "assigned_without_reference_flag").otherwise("unassigned")
    reference = deepest(backed)
    decision = (
        F.when(~seen, "not_reported")
        .when(reference != "", "reference_supported_taxonomy")
        .when(named[ranks[0]], "realm_only_taxonomy")
        .when(listed("novel_") != "", "novel_group_only")
        .when(lower[ranks[0]] == "singleton", "singleton")
        .otherwise("no_qualified_taxonomy")
    )
    return out.select(
        *[c for c in regions.columns if c not in {*ranks, "database_domain"}],
        "database_domain",
        status.alias("assignment_status"),
        *[F.when(c, text[r]).alias(r) for r, c in accepted.items()],
        deepest(accepted).alias("deepest_rank"),
        reference.alias("deepest_reference_rank"),
        listed("novel_").alias("novel_group_ranks"),
        listed("unplaced_").alias("unplaced_group_ranks"),
        decision.alias("decision"),
    )
