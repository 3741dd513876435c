"""Harmonization (HRM-1 to HRM-18): all evidence about a final record becomes one decision."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import set_text

REGION_TYPES = ("provirus", "viral_region")


@dataclass(frozen=True)
class DecisionPolicy:
    """Sources by their role in the decision."""

    origin: tuple[str, ...] = ()
    generic: tuple[str, ...] = ()
    quality: str = "quality"
    hallmark: str = "hallmark"
    homology: str = "homology"
    supporters: tuple[str, ...] = ()
    pair: tuple[str, str] = ("generic", "homology")
    input_type: str = "dna"


def apply_evidence(evidence: DataFrame, finals: DataFrame) -> DataFrame:
    """HRM-1: which evidence rows apply to which final records, as equi-joins by branch.

    ``evidence``: row, exact_id, parent_id, record_type, start, end (nullable);
    ``finals``: final_id, final_parent, final_type, final_start, final_end, final_length.
    A row whose exact id is a final id applies to it alone; an unlocalized short
    hallmark applies to the intact parent only; a localized region row to overlapping
    siblings, or to the intact parent if it spans it; every other row to all finals of
    its parent.
    """
    names = finals.select(F.col("final_id").alias("__id")).distinct()
    known = evidence.join(names, evidence.exact_id == names["__id"], "left")
    exact = known.where("__id is not null").drop("__id").join(finals, F.col("exact_id") == F.col("final_id"))
    rest = known.where("__id is null").drop("__id")
    local = F.col("start").isNotNull() & F.col("end").isNotNull()
    region = F.col("record_type").isin(*REGION_TYPES) & local
    short = (F.col("record_type") == "short_hallmark_region") & ~local
    kind = F.when(region, "region").when(F.coalesce(short, F.lit(False)), "short").otherwise("inherit")
    near = rest.withColumn("__k", kind).join(finals, F.col("parent_id") == F.col("final_parent"))
    intact = F.col("final_type") == "input_contig"
    spans = (F.col("start") == 1) & (F.col("end") == F.col("final_length"))
    touches = (F.col("start") <= F.col("final_end")) & (F.col("final_start") <= F.col("end"))
    ok = F.when(F.col("__k") == "inherit", True).when(F.col("__k") == "short", intact).otherwise(F.when(intact, spans).otherwise(touches))
    by_exact_parent = rest.withColumn("__k", kind).where("__k = 'inherit' and not (exact_id <=> parent_id)").join(finals, F.col("exact_id") == F.col("final_parent")).where("not (parent_id <=> final_parent)")
    return exact.unionByName(near.where(ok).drop("__k")).unionByName(by_exact_parent.drop("__k"))


def prefer_region_scope(applied: DataFrame, source: str, parent_scope: str = "parent_discovery", region_scope: str = "refined_region") -> DataFrame:
    """HRM-2: the parent-scoped rows of one source are ``superseded`` where its region rows count instead.

    That is for every final that is a region (its id isn't its parent's), with or
    without rows of its own, and for an intact final that the source has scored anew.
    Rows of other sources, and rows without a scope of another source, aren't touched; a
    missing scope of the source is its parent scope.  ``applied``: final_id,
    final_parent, exact_id, tool, evidence_scope.
    """
    own = F.lower(F.trim("tool")) == source
    scope = F.coalesce(F.nullif(F.trim("evidence_scope"), F.lit("")), F.lit(parent_scope))
    anew = F.bool_or(F.coalesce(own & (scope == region_scope) & (F.col("exact_id") == F.col("final_id")), F.lit(False))).over(W.partitionBy("final_id"))
    suppress = (F.col("final_id") != F.col("final_parent")) | anew
    return applied.withColumn("superseded", F.coalesce(suppress & own & (scope == parent_scope), F.lit(False)))


def application(applied: DataFrame) -> DataFrame:
    """HRM-3, 4: how a row is used: review, superseded, context or used.

    Context is a cellular or plasmid row about a region that names another record than
    the region itself: a call on the parent, whose flanks the region no longer holds.
    """
    elsewhere = ~F.col("exact_id").eqNullSafe(F.col("final_id"))
    context = F.lower(F.trim("final_type")).isin(*REGION_TYPES) & F.lower(F.trim("classification")).isin("cellular", "plasmid") & elsewhere
    return applied.withColumn("evidence_application", F.when(F.coalesce("review", F.lit(False)), "review").when(F.col("superseded"), "superseded").when(context, "context").otherwise("used"))


def summarize_support(applied: DataFrame) -> DataFrame:
    """HRM-5, 7: tool sets by strength and class, and the confidence tier, for each final record."""
    used = F.col("evidence_application") == "used"
    strength = F.coalesce(F.nullif(F.trim("evidence_strength"), F.lit("")), F.lit("qualified"))
    viral = used & (F.col("classification") == "virus")

    def tools(when: Column, name: str) -> Column:
        return F.array_sort(F.collect_set(F.when(when, F.col("tool")))).alias(name)

    out = applied.groupBy("final_id").agg(
        tools(viral & (strength == "strong"), "strong_tools"),
        tools(viral & strength.isin("strong", "qualified"), "supported"),
        tools(used & (F.col("classification") == "cellular") & (strength != "weak"), "cellular_tools"),
        tools(used & (F.col("classification") == "plasmid") & (strength != "weak"), "plasmid_tools"),
        tools((F.col("evidence_application") == "context") & (F.col("classification") == "cellular"), "context_cellular_tools"),
        tools((F.col("evidence_application") == "context") & (F.col("classification") == "plasmid"), "context_plasmid_tools"),
    )
    out = out.withColumn("qualified_tools", F.array_except("supported", "strong_tools")).drop("supported")
    n = F.size(F.array_union("strong_tools", "qualified_tools"))
    tier = F.when((F.size("strong_tools") >= 2), "high").when((F.size("strong_tools") >= 1) | (n >= 2), "supported").otherwise("provisional")
    return out.withColumn("confidence", tier)


def complete_record_support(applied: DataFrame, quality: str) -> DataFrame:
    """HRM-6: final records that the quality source calls complete, viral and free of host genes."""
    good = (F.col("tool") == quality) & (F.col("classification") == "virus") & F.lower("quality").isin("complete", "high-quality") & (F.lower("provirus") == "no") & (F.col("viral_genes") > 0) & (F.col("host_genes") == 0) & (F.col("final_type") == "input_contig")
    return applied.groupBy("final_id").agg(F.bool_or(F.coalesce(good, F.lit(False))).alias("complete_support"))


def mobile_interpretation(support: DataFrame) -> DataFrame:
    """HRM-8: interpretation of mobile-element evidence.

    ``support``: mobile (array of struct<category, strength>), viral_support (bool),
    high_consensus (bool).
    """
    order = lambda s: F.when(s == "strong", 3).when(s == "qualified", 2).when(s == "weak", 1).otherwise(0)
    retro = F.array_max(F.transform(F.filter("mobile", lambda m: m.category == "retroelement"), lambda m: order(m.strength)))
    has = lambda c: F.exists("mobile", lambda m: m.category == c)
    firm, weak = F.coalesce(retro >= 2, F.lit(False)), F.coalesce(retro == 1, F.lit(False))
    like, unclear = has("viral_like_mobile_element"), has("ambiguous_mobile_element")
    viral, high = F.col("viral_support"), F.col("high_consensus")
    out = (
        F.when(F.coalesce(F.size("mobile"), F.lit(0)) <= 0, "viral_candidate")
        .when(like & viral, "retrovirus_compatible")
        .when((firm | unclear) & high, "viral_with_mobile_element_features")
        .when(firm & viral, "viral_retroelement_conflict")
        .when(firm, "likely_retroelement")
        .when(like, "viral_like_mobile_element")
        .when(unclear, "ambiguous_mobile_element")
        .when(weak & viral, "viral_candidate_with_weak_retroelement_signal")
        .when(weak, "weak_retroelement_signal")
        .otherwise("viral_candidate")
    )
    return support.withColumn("sequence_interpretation", out)


def adjudicate(support: DataFrame, policy: DecisionPolicy) -> DataFrame:
    """HRM-9: the decision, conflicts before support.

    ``support``: discovery_status, record_type, strong_tools, qualified_tools,
    cellular_tools, plasmid_tools, sequence_interpretation.
    """
    region = F.col("record_type").isin(*REGION_TYPES)
    strong, qualified = F.size("strong_tools"), F.size("qualified_tools")
    cell, plasmid = F.size("cellular_tools") > 0, F.size("plasmid_tools") > 0
    generic = F.array(*[F.lit(g) for g in policy.generic]).cast("array<string>")
    overridden = (strong >= 2) & cell & (F.size(F.array_except("cellular_tools", generic)) == 0) & ~plasmid
    keep = F.when(region, "retained_provirus").otherwise("retained_viral")
    maybe = F.when(region, "provisional_provirus").otherwise("provisional_viral")
    out = (
        F.when(F.col("sequence_interpretation") == "likely_retroelement", "likely_retroelement")
        .when(F.col("sequence_interpretation").isin("viral_retroelement_conflict", "ambiguous_mobile_element"), "ambiguous_review")
        .when(overridden, keep)
        .when(~region & plasmid & ~cell & (strong >= 2), "retained_viral")
        .when((cell | plasmid) & (F.col("discovery_status") == "ambiguous") & (strong == 0) & (qualified <= 1), "likely_nonviral")
        .when(cell | plasmid, "ambiguous_review")
        .when((strong > 0) | (qualified >= 2), keep)
        .when(qualified > 0, maybe)
        .otherwise("ambiguous_review")
    )
    return support.withColumn("generic_override", overridden).withColumn("decision", out)


def sole_conflict_exception(decisions: DataFrame, loci: DataFrame, policy: DecisionPolicy) -> DataFrame:
    """HRM-10: an RNA record under review is kept if the quality source alone objects, all supporters agree and one long locus carries it.

    ``loci``: final_id, classification, protein_length, score, identity, qcov, scov, share (of the record's length).
    """
    p = policy
    blocked = loci.where(F.col("classification").isin("cellular_supported", "ambiguous")).select("final_id").distinct()
    good = loci.where("classification = 'viral_supported' and protein_length >= 100 and score >= 100 and identity >= 50 and least(qcov, scov) >= 80 and share >= 0.70").select("final_id").distinct()
    able = good.join(blocked, "final_id", "left_anti").withColumn("locus_ok", F.lit(True))
    want = F.array(*[F.lit(s) for s in p.supporters]).cast("array<string>")
    agreed = F.size(F.array_except(want, F.array_union("strong_tools", "qualified_tools"))) == 0
    fits = F.lit(p.input_type == "rna") & (F.col("decision") == "ambiguous_review") & ~F.col("record_type").isin(*REGION_TYPES) & (F.col("cellular_tools") == F.array(F.lit(p.quality))) & (F.size("plasmid_tools") == 0) & agreed
    fits = fits & ~F.col("sequence_interpretation").isin("likely_retroelement", "viral_retroelement_conflict", "ambiguous_mobile_element")
    out = decisions.join(able, "final_id", "left").withColumn("exception", fits & F.coalesce("locus_ok", F.lit(False))).drop("locus_ok")
    return out.withColumn("decision", F.when(F.col("exception"), "retained_viral").otherwise(F.col("decision")))


def disputed_boundary(decisions: DataFrame) -> DataFrame:
    """HRM-11: a region whose hallmark boundary the homology source disputes stays primary only with support of its own.

    ``decisions``: disputed, hallmark_strong, viral_loci, cellular_loci.
    """
    v, c = F.coalesce("viral_loci", F.lit(0)), F.coalesce("cellular_loci", F.lit(0))
    enough = (v >= 2) & (v / F.nullif(v + c, F.lit(0)) >= 0.60)
    basis = F.when(~F.coalesce("disputed", F.lit(False)), "not_disputed").when(F.coalesce("hallmark_strong", F.lit(False)), "strong_hallmark_rescue").when(F.coalesce(enough, F.lit(False)), "regional_support").otherwise("provisional_disputed_boundary")
    out = decisions.withColumn("retention_basis", basis)
    return out.withColumn("decision", F.when((F.col("decision") == "retained_provirus") & (F.col("retention_basis") == "provisional_disputed_boundary"), "provisional_provirus").otherwise(F.col("decision")))


def pair_floor(decisions: DataFrame, loci: DataFrame, policy: DecisionPolicy) -> DataFrame:
    """HRM-12: a primary RNA call that rests on one pair of sources needs a solid homology locus inside its interval.

    ``decisions``: parent_id, start, end (null: whole record); ``loci``: sequence_id,
    start, end, classification, protein_length, score, qcov, scov.
    """
    good = loci.where("classification = 'viral_supported' and protein_length >= 100 and score >= 100 and qcov >= 50 and scov >= 50").select(F.col("sequence_id").alias("parent_id"), F.col("start").alias("ls"), F.col("end").alias("le"))
    hit = decisions.select("final_id", "parent_id", "start", "end").join(good, "parent_id").where("start is null or (ls >= start and ls <= le and le <= end)").select("final_id").distinct().withColumn("has_locus", F.lit(True))
    pair = F.array_sort(F.array(*[F.lit(x) for x in policy.pair]))
    needs = F.lit(policy.input_type == "rna") & (F.size("strong_tools") == 0) & (F.array_sort("qualified_tools") == pair) & F.col("decision").isin("retained_viral", "retained_provirus")
    out = decisions.join(hit, "final_id", "left").withColumn("pair_floor", F.when(~needs, "not_applicable").when(F.coalesce("has_locus", F.lit(False)), "passed").otherwise("demoted")).drop("has_locus")
    low = F.when(F.col("decision") == "retained_provirus", "provisional_provirus").otherwise("provisional_viral")
    return out.withColumn("decision", F.when(F.col("pair_floor") == "demoted", low).otherwise(F.col("decision")))


def entity(decisions: DataFrame) -> DataFrame:
    """HRM-13: what the retained record is."""
    region = F.col("record_type").isin(*REGION_TYPES)
    primary, maybe = F.col("decision").isin("retained_viral", "retained_provirus"), F.col("decision").isin("provisional_viral", "provisional_provirus")
    plasmid = (F.size("plasmid_tools") > 0) | (F.coalesce(F.size("context_plasmid_tools"), F.lit(0)) > 0)
    out = (
        F.when(region & plasmid & primary, "plasmid_associated_provirus")
        .when(region & plasmid & maybe, "provisional_plasmid_associated_provirus")
        .when(region & plasmid, "nonprimary_plasmid_associated_region")
        .when(~region & primary & (F.size("strong_tools") >= 2) & (F.size("plasmid_tools") > 0), "virus_plasmid_hybrid_candidate")
        .when(region & primary, "provirus")
        .when(region & maybe, "provisional_provirus")
        .when(primary, "viral_contig")
        .when(maybe, "provisional_viral_contig")
        .otherwise("nonprimary_or_review")
    )
    return decisions.withColumn("entity", out)


def review_reasons(decisions: DataFrame) -> DataFrame:
    """HRM-14: the ordered reasons why a final record is reviewed, as text ('' for none).

    Columns that ``decisions`` lacks count as null, and a null is no reason:
    parent_viral and region_viral (the homology source's calls), boundary_disputed,
    taxonomy_conflict, group_statuses (array), sequence_interpretation, strict_rank.
    """
    col = lambda c, t: F.col(c) if c in decisions.columns else F.lit(None).cast(t)
    flag = lambda c: F.coalesce(col(c, "boolean"), F.lit(False))
    groups, mobile = col("group_statuses", "array<string>"), col("sequence_interpretation", "string")
    region = col("record_type", "string").isin(*REGION_TYPES)
    cell = F.size("cellular_tools") > 0
    reasons = {
        "region_boundary_homology_discordance": region & flag("parent_viral") & ~flag("region_viral"),
        "disputed_boundary_provisional": flag("boundary_disputed"),
        "single_qualified_viral_tool": F.col("confidence") == "provisional",
        "generic_cellular_conflict_overridden": F.col("generic_override"),
        "cellular_conflict": ~F.col("generic_override") & cell,
        "plasmid_conflict": F.size("plasmid_tools") > 0,
        "taxonomy_conflict": flag("taxonomy_conflict"),
        "group_ambiguity": F.array_contains(groups, "ambiguous_groups"),
        "group_context_conflict": F.array_contains(groups, "incompatible_or_unknown_parent_context"),
        "viral_retroelement_conflict": mobile == "viral_retroelement_conflict",
        "mobile_element_annotation": mobile == "viral_with_mobile_element_features",
        "likely_retroelement": mobile == "likely_retroelement",
        "ambiguous_mobile_element": mobile == "ambiguous_mobile_element",
        "taxonomy_unclassified": col("strict_rank", "string") == "domain",
    }
    return decisions.withColumn("review_reasons", F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in reasons.items()])), ","))


def route(decisions: DataFrame) -> DataFrame:
    """HRM-15: the set of each final record."""
    d = F.col("decision")
    return decisions.withColumn("route", F.when(d.isin("retained_viral", "retained_provirus"), "primary").when(d.isin("provisional_viral", "provisional_provirus"), "provisional").otherwise("review"))


def unique_names(df: DataFrame, name: str, parent: str, out: str = "unique_name") -> DataFrame:
    """HRM-16: names made unique: later holders of a name (by parent) get ``|dup_<parent>``."""
    n = F.row_number().over(W.partitionBy(name).orderBy(parent))
    return df.withColumn("__n", n).withColumn(out, F.when(F.col("__n") == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit("|dup_"), F.col(parent).cast("string")))).drop("__n")


def dispositions(inputs: DataFrame, decisions: DataFrame) -> DataFrame:
    """HRM-17: one outcome for every input.

    ``inputs``: sequence_id, status, advance; ``decisions``: parent_id, final_id, record_type, decision.
    """
    d = F.col("decision")
    primary, maybe, region = d.isin("retained_viral", "retained_provirus"), d.isin("provisional_viral", "provisional_provirus"), F.col("record_type").isin(*REGION_TYPES)
    ids = lambda c, n: F.array_sort(F.collect_list(F.when(c, F.col("final_id")))).alias(n)
    per = decisions.groupBy(F.col("parent_id").alias("sequence_id")).agg(ids(primary, "final_ids"), ids(maybe, "provisional_ids"), F.bool_or(primary & region).alias("pr"), F.bool_or(maybe & region).alias("mr"), F.bool_or(d == "likely_nonviral").alias("nonviral"), F.bool_or(d == "likely_retroelement").alias("retro"))
    out = inputs.join(per, "sequence_id", "left")
    has = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    outcome = (
        F.when(has("final_ids"), F.when(F.col("pr"), "retained_as_provirus").otherwise("retained_contig"))
        .when(has("provisional_ids"), F.when(F.col("mr"), "provisional_provirus_after_harmony").otherwise("provisional_viral_after_harmony"))
        .when(F.col("advance") & F.coalesce("nonviral", F.lit(False)), "likely_nonviral_after_harmony")
        .when(F.col("advance") & F.coalesce("retro", F.lit(False)), "likely_retroelement_after_harmony")
        .when(F.col("advance"), "ambiguous_review_after_harmony")
        .when(F.col("status") == "likely_nonviral", "discovery_noncandidate_conflicting_origin")
        .otherwise("discovery_noncandidate_insufficient_support")
    )
    none = F.array().cast("array<string>")
    return out.select("sequence_id", outcome.alias("disposition"), set_text(F.coalesce(F.col("final_ids").cast("array<string>"), none)).alias("final_sequence_ids"), set_text(F.coalesce(F.col("provisional_ids").cast("array<string>"), none)).alias("provisional_sequence_ids"))


@dataclass(frozen=True)
class Field:
    """A column of the final table: where it comes from, how it is written, and what stands for nothing.

    Formats: ``text`` (as it is), ``set`` (an array, sorted and without repeats, joined
    by commas), ``flag`` (true or false), ``count`` (a whole number).
    """

    frame: str
    column: str
    format: str = "text"
    default: str = "NA"


def _fields(frame: str, format: str = "text", default: str = "NA", **columns: str) -> dict[str, Field]:
    return {name: Field(frame, column, format, default) for name, column in columns.items()}


#: HRM-18: the final table's columns in their order.
METADATA: dict[str, Field] = {
    **_fields("final", original_name="original_name", normalized_name="final_parent", final_sequence_id="final_id", record_type="record_type", region_coordinates="coordinates"),
    **_fields("final", "count", original_length="original_length", refined_length="refined_length"),
    **_fields("final", discovery_status="discovery_status"),
    **_fields("decision", viral_decision="decision", viral_confidence="confidence"),
    **_fields("decision", "set", strong_tools="strong_tools", qualified_tools="qualified_tools", cellular_conflict_tools="cellular_tools", parent_cellular_context_tools="context_cellular_tools", parent_plasmid_context_tools="context_plasmid_tools"),
    **_fields("quality", "flag", "false", quality_complete_support="complete_support"),
    **_fields("decision", "flag", "false", generic_cellular_conflict_overridden="generic_override"),
    **_fields("decision", "set", plasmid_conflict_tools="plasmid_tools"),
    **_fields("taxonomy", strict_taxonomy="strict_taxonomy", strict_taxonomy_rank="strict_rank", strict_taxonomy_confidence="strict_confidence"),
    **_fields("taxonomy", "set", strict_taxonomy_supporting_tools="strict_tools", strict_taxonomy_supporting_method_families="strict_families"),
    **_fields("taxonomy", strict_taxonomy_stop_reason="stop_reason", strict_taxonomy_conflict_rank="conflict_rank_name"),
    **_fields("taxonomy", "set", strict_taxonomy_conflicting_taxa="conflicting_taxa"),
    **_fields("taxonomy", exploratory_taxonomy="exploratory_taxonomy", exploratory_taxonomy_rank="exploratory_rank", exploratory_taxonomy_confidence="exploratory_confidence"),
    **_fields("taxonomy", "set", exploratory_taxonomy_supporting_tools="exploratory_tools", exploratory_taxonomy_supporting_method_families="exploratory_families"),
    **_fields("taxonomy", exploratory_taxonomy_status="exploratory_status", strict_species="strict_species", exploratory_species="exploratory_species", species_assignment_status="species_status", species_assignment_basis="species_basis"),
    **_fields("taxonomy", "set", species_conflicting_taxa="species_conflicting_taxa"),
    **_fields("taxonomy", "flag", "false", taxonomy_conflict="taxonomy_conflict"),
    **_fields("groups", "set", group_labels="labels"),
    **_fields("groups", "set", "no_project_group", group_status="statuses"),
    **_fields("mobile", default="viral_candidate", sequence_interpretation="sequence_interpretation"),
    **_fields("mobile", mobile_status="status", mobile_evidence_strength="strength"),
    **_fields("mobile", "set", mobile_categories="categories", mobile_orders="orders", mobile_superfamilies="superfamilies", mobile_assignment_methods="methods"),
    **_fields("homology", "set", homology_origin_pattern="patterns"),
    **_fields("homology", default="none", homology_region_status="region_status"),
    **_fields("homology", "set", homology_evidence_scope="scopes"),
    **_fields("homology", "count", "0", homology_viral_supported_loci="viral_loci", homology_cellular_supported_loci="cellular_loci"),
    **_fields("homology", "set", homology_opposing_classes="opposing_classes", homology_dominant_class="dominant_classes"),
    **_fields("boundary", boundary_source="source", boundary_status="status"),
    **_fields("boundary", "set", boundary_supporting_tools="tools"),
    **_fields("decision", default="not_applicable", region_retention_basis="retention_basis"),
    **_fields("decision", viral_entity_interpretation="entity"),
    **_fields("exception", "flag", "false", conflict_exception="exception"),
    **_fields("exception", "set", conflict_exception_supporting_loci="loci"),
}


def _written(value: Column, kind: str, field: Field) -> Column:
    if field.format == "set":
        items = value.cast("array<string>") if kind.startswith("array") else F.split(value.cast("string"), ",")
        text = F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != ""))), ",")
    elif field.format == "flag":
        text = F.when(value.cast("boolean"), "true").otherwise(F.when(value.isNotNull(), "false"))
    elif field.format == "count":
        text = value.cast("double").cast("long").cast("string")
    else:
        text = F.trim(value.cast("string"))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(field.default))


def final_metadata(frames: dict[str, DataFrame], fields: dict[str, Field] = METADATA) -> DataFrame:
    """HRM-18: one row for each row of ``frames["final"]``, in the declared columns, all text.

    Every frame has one row for each final_id at most and is joined once; a frame, a
    column or a value that is missing is written as its field's default.  Only the
    declared columns are read, so frames may share names.  A frame that repeats an id
    raises: it would repeat the record.
    """
    out = frames["final"].select("final_id", *[F.col(f.column).alias(f"final.{f.column}") for f in {f.column: f for f in fields.values() if f.frame == "final"}.values() if f.column in frames["final"].columns])
    kinds = {f"final.{c}": t for c, t in frames["final"].dtypes}
    for name in dict.fromkeys(f.frame for f in fields.values() if f.frame != "final"):
        if name not in frames:
            continue
        wanted = [c for c in dict.fromkeys(f.column for f in fields.values() if f.frame == name) if c in frames[name].columns]
        kinds |= {f"{name}.{c}": t for c, t in frames[name].dtypes}
        cells = F.struct(*[F.col(c).alias(f"{name}.{c}") for c in wanted]) if wanted else F.struct(F.lit(1).alias(f"{name}.none"))
        once = frames[name].groupBy("final_id").agg(F.first(cells).alias("__f"), F.count("*").alias("__n"))
        once = once.select(F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit(f"frame {name} repeats "), F.col("final_id").cast("string"))).cast("string")).otherwise(F.col("final_id")).alias("final_id"), "__f.*")
        out = out.join(once, "final_id", "left")
    have = set(out.columns)
    cell = lambda f: _written(F.col(f"`{f.frame}.{f.column}`"), kinds[f"{f.frame}.{f.column}"], f) if f"{f.frame}.{f.column}" in have else F.lit(f.default)
    return out.select(*[cell(f).alias(name) for name, f in fields.items()])
