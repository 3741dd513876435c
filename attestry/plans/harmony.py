"""Queries of the standardizers, harmonization and taxonomy resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..functions.shared import shared_folder
from ..operators import harmonize as hz
from ..operators import lineage, standardize, taxonomy
from . import frames as fr
from .registry import query

POLICY = hz.DecisionPolicy(generic=("error",), quality="error", supporters=("click", "view"), pair=("click", "view"), input_type="rna")

# evidence of a user-day, applied to the user-day itself
APPLIED = f"""WITH {fr.EVIDENCE}, used AS (SELECT *, CASE WHEN review THEN 'review' ELSE 'used' END AS application FROM evidence),
support AS (SELECT sequence_id AS final_id, coalesce(list_sort(list(DISTINCT tool) FILTER (application = 'used' AND classification = 'virus' AND evidence_strength = 'strong')), []) AS strong,
  coalesce(list_sort(list(DISTINCT tool) FILTER (application = 'used' AND classification = 'virus' AND evidence_strength IN ('strong', 'qualified'))), []) AS supported,
  coalesce(list_sort(list(DISTINCT tool) FILTER (application = 'used' AND classification = 'cellular' AND evidence_strength <> 'weak')), []) AS cellular,
  coalesce(list_sort(list(DISTINCT tool) FILTER (application = 'used' AND classification = 'plasmid' AND evidence_strength <> 'weak')), []) AS plasmid, min(user_id) AS user_id FROM used GROUP BY 1),
s AS (SELECT *, list_sort(list_filter(supported, lambda x: NOT list_contains(strong, x))) AS qualified, user_id % 4 = 0 AS region, CASE user_id % 9 WHEN 0 THEN 'likely_retroelement' WHEN 1 THEN 'ambiguous_mobile_element' ELSE 'viral_candidate' END AS interp,
  CASE WHEN user_id % 2 = 0 THEN 'ambiguous' ELSE 'viral' END AS status FROM support),
o AS (SELECT *, len(strong) >= 2 AND len(cellular) > 0 AND len(list_filter(cellular, lambda x: x <> 'error')) = 0 AND len(plasmid) = 0 AS over FROM s),
d AS (SELECT *, CASE WHEN interp = 'likely_retroelement' THEN 'likely_retroelement' WHEN interp = 'ambiguous_mobile_element' THEN 'ambiguous_review' WHEN over THEN CASE WHEN region THEN 'retained_provirus' ELSE 'retained_viral' END
  WHEN NOT region AND len(plasmid) > 0 AND len(cellular) = 0 AND len(strong) >= 2 THEN 'retained_viral' WHEN len(cellular) + len(plasmid) > 0 AND status = 'ambiguous' AND len(strong) = 0 AND len(qualified) <= 1 THEN 'likely_nonviral'
  WHEN len(cellular) + len(plasmid) > 0 THEN 'ambiguous_review' WHEN len(strong) > 0 OR len(qualified) >= 2 THEN CASE WHEN region THEN 'retained_provirus' ELSE 'retained_viral' END WHEN len(qualified) > 0 THEN CASE WHEN region THEN 'provisional_provirus' ELSE 'provisional_viral' END ELSE 'ambiguous_review' END AS decision,
  CASE WHEN len(strong) >= 2 THEN 'high' WHEN len(strong) = 1 OR len(supported) >= 2 THEN 'supported' ELSE 'provisional' END AS confidence FROM o)
"""


def _applied(spark: SparkSession, d: str) -> DataFrame:
    same = F.col("sequence_id")
    e = fr.evidence(spark, d).withColumns({"final_id": same, "final_parent": same, "exact_id": same, "evidence_scope": F.lit(None).cast("string"), "final_type": F.lit("input_contig")})
    return hz.application(hz.prefer_region_scope(e, "click"))


def _support(spark: SparkSession, d: str) -> DataFrame:
    return hz.summarize_support(_applied(spark, d)).withColumn("user_id", F.substring_index("final_id", "@", 1).cast("long"))


def _decisions(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("user_id")
    x = _support(spark, d).withColumns({
        "record_type": F.when(u % 4 == 0, "provirus").otherwise("input_contig"),
        "sequence_interpretation": F.when(u % 9 == 0, "likely_retroelement").when(u % 9 == 1, "ambiguous_mobile_element").otherwise("viral_candidate"),
        "discovery_status": F.when(u % 2 == 0, "ambiguous").otherwise("viral"),
    })
    return hz.adjudicate(x, POLICY)


TEXT = "coalesce(nullif(array_to_string({0}, ','), ''), 'NA')"


@query(APPLIED + f"SELECT final_id, {TEXT.format('strong')} AS strong_tools, {TEXT.format('qualified')} AS qualified_tools, {TEXT.format('cellular')} AS cellular_tools, {TEXT.format('plasmid')} AS plasmid_tools, confidence FROM d")
def harmony_support(spark: SparkSession, d: str) -> DataFrame:
    """HRM-4, 5, 7."""
    sets = ("strong_tools", "qualified_tools", "cellular_tools", "plasmid_tools")
    return _support(spark, d).select("final_id", *[sc.set_text(F.col(c)).alias(c) for c in sets], "confidence")


@query(APPLIED + "SELECT final_id, decision, over AS generic_override FROM d")
def harmony_decision(spark: SparkSession, d: str) -> DataFrame:
    """HRM-9."""
    return _decisions(spark, d).select("final_id", "decision", "generic_override")


@query(APPLIED + """SELECT final_id, CASE WHEN decision IN ('retained_viral', 'retained_provirus') THEN 'primary' WHEN decision IN ('provisional_viral', 'provisional_provirus') THEN 'provisional' ELSE 'review' END AS route,
  CASE WHEN region AND len(plasmid) > 0 THEN CASE WHEN decision IN ('retained_viral', 'retained_provirus') THEN 'plasmid_associated_provirus' WHEN decision LIKE 'provisional%' THEN 'provisional_plasmid_associated_provirus' ELSE 'nonprimary_plasmid_associated_region' END
    WHEN NOT region AND decision LIKE 'retained%' AND len(strong) >= 2 AND len(plasmid) > 0 THEN 'virus_plasmid_hybrid_candidate' WHEN region AND decision LIKE 'retained%' THEN 'provirus' WHEN region AND decision LIKE 'provisional%' THEN 'provisional_provirus' WHEN decision LIKE 'retained%' THEN 'viral_contig' WHEN decision LIKE 'provisional%' THEN 'provisional_viral_contig' ELSE 'nonprimary_or_review' END AS entity,
  array_to_string(list_filter([CASE WHEN region AND user_id % 3 = 0 AND user_id % 5 > 0 THEN 'region_boundary_homology_discordance' END, CASE WHEN user_id % 7 = 0 THEN 'disputed_boundary_provisional' END, CASE WHEN confidence = 'provisional' THEN 'single_qualified_viral_tool' END, CASE WHEN over THEN 'generic_cellular_conflict_overridden' END, CASE WHEN NOT over AND len(cellular) > 0 THEN 'cellular_conflict' END, CASE WHEN len(plasmid) > 0 THEN 'plasmid_conflict' END,
    CASE WHEN user_id % 6 = 0 THEN 'taxonomy_conflict' END, CASE WHEN user_id % 8 = 1 THEN 'group_ambiguity' END, CASE WHEN user_id % 8 IN (1, 2) THEN 'group_context_conflict' END, CASE WHEN interp = 'likely_retroelement' THEN 'likely_retroelement' END, CASE WHEN interp = 'ambiguous_mobile_element' THEN 'ambiguous_mobile_element' END, CASE WHEN user_id % 11 = 0 THEN 'taxonomy_unclassified' END], lambda x: x IS NOT NULL), ',') AS review_reasons FROM d""")
def harmony_routes(spark: SparkSession, d: str) -> DataFrame:
    """HRM-13, 14, 15: with all the reasons for review."""
    u = F.col("user_id")
    conflict = F.lit("incompatible_or_unknown_parent_context")
    x = _decisions(spark, d).withColumns({
        "parent_viral": u % 3 == 0, "region_viral": u % 5 == 0, "boundary_disputed": u % 7 == 0, "taxonomy_conflict": u % 6 == 0,
        "group_statuses": F.when(u % 8 == 1, F.array(F.lit("ambiguous_groups"), conflict)).when(u % 8 == 2, F.array(conflict)),
        "strict_rank": F.when(u % 11 == 0, "domain").otherwise("genus"),
    })
    return hz.review_reasons(hz.entity(hz.route(x))).select("final_id", "route", "entity", "review_reasons")


@query(APPLIED + """, l AS (SELECT sequence_id AS final_id, bool_or(value >= 20 AND value < 30 AND tool = 'purchase') AS blocked, bool_or(tool = 'view' AND value >= 60) AS good FROM evidence GROUP BY 1)
SELECT final_id, decision = 'ambiguous_review' AND NOT region AND cellular = ['error'] AND len(plasmid) = 0 AND list_contains(supported, 'click') AND list_contains(supported, 'view') AND interp = 'viral_candidate' AND good AND NOT blocked AS exception,
  CASE WHEN decision = 'ambiguous_review' AND NOT region AND cellular = ['error'] AND len(plasmid) = 0 AND list_contains(supported, 'click') AND list_contains(supported, 'view') AND interp = 'viral_candidate' AND good AND NOT blocked THEN 'retained_viral' ELSE decision END AS decision FROM d JOIN l USING (final_id)""")
def harmony_exception(spark: SparkSession, d: str) -> DataFrame:
    """HRM-10."""
    e = fr.evidence(spark, d)
    kind = F.when((F.col("tool") == "purchase") & (F.col("value") >= 20) & (F.col("value") < 30), "ambiguous").when(F.col("tool") == "view", "viral_supported").otherwise("other")
    big = F.when(F.col("value") >= 60, 200.0).otherwise(0.0)
    loci = e.select(F.col("sequence_id").alias("final_id"), kind.alias("classification"), big.alias("protein_length"), big.alias("score"), F.lit(90.0).alias("identity"), F.lit(90.0).alias("qcov"), F.lit(90.0).alias("scov"), F.lit(0.8).alias("share"))
    return hz.sole_conflict_exception(_decisions(spark, d), loci, POLICY).select("final_id", "exception", "decision")


@query(APPLIED + """, x AS (SELECT *, user_id % 3 = 0 AS disputed, user_id % 5 = 0 AS hs, user_id % 7 AS v, user_id % 4 AS c FROM d), b AS (SELECT *, CASE WHEN NOT disputed THEN 'not_disputed' WHEN hs THEN 'strong_hallmark_rescue' WHEN v >= 2 AND v / nullif(v + c, 0) >= 0.6 THEN 'regional_support' ELSE 'provisional_disputed_boundary' END AS retention_basis FROM x)
SELECT final_id, retention_basis, CASE WHEN decision = 'retained_provirus' AND retention_basis = 'provisional_disputed_boundary' THEN 'provisional_provirus' ELSE decision END AS decision FROM b""")
def harmony_disputed(spark: SparkSession, d: str) -> DataFrame:
    """HRM-11."""
    u = F.col("user_id")
    x = _decisions(spark, d).withColumns({"disputed": u % 3 == 0, "hallmark_strong": u % 5 == 0, "viral_loci": u % 7, "cellular_loci": u % 4})
    return hz.disputed_boundary(x).select("final_id", "retention_basis", "decision")


@query(APPLIED + """, g AS (SELECT DISTINCT sequence_id AS final_id FROM evidence WHERE value >= 100)
SELECT final_id, CASE WHEN len(strong) > 0 OR qualified <> ['click', 'view'] OR decision NOT LIKE 'retained%' THEN 'not_applicable' WHEN g.final_id IS NOT NULL THEN 'passed' ELSE 'demoted' END AS pair_floor FROM d LEFT JOIN g USING (final_id)""")
def harmony_pair_floor(spark: SparkSession, d: str) -> DataFrame:
    """HRM-12."""
    x = _decisions(spark, d).withColumns({"parent_id": F.col("final_id"), "start": F.lit(None).cast("long"), "end": F.lit(None).cast("long")})
    v = F.when(F.col("value") >= 100, 100.0).otherwise(1.0)
    loci = fr.evidence(spark, d).select("sequence_id", F.lit(1).alias("start"), F.lit(9).alias("end"), F.lit("viral_supported").alias("classification"), v.alias("protein_length"), v.alias("score"), F.lit(60.0).alias("qcov"), F.lit(60.0).alias("scov"))
    return hz.pair_floor(x, loci, POLICY).select("final_id", "pair_floor")


@query(f"""WITH {fr.CALLS}, f AS (SELECT parent, line, "start", "end", CAST(parent AS VARCHAR) || '|' || line AS final_id FROM calls WHERE tool = 'marker'), w AS (SELECT DISTINCT parent FROM calls WHERE parent NOT IN (SELECT parent FROM f)),
finals AS (SELECT final_id, CAST(parent AS VARCHAR) AS final_parent, 'provirus' AS final_type, "start" AS fs, "end" AS fe FROM f UNION ALL SELECT CAST(parent AS VARCHAR), CAST(parent AS VARCHAR), 'input_contig', 1, 160 FROM w),
ev AS (SELECT CAST(parent AS VARCHAR) || '.' || line AS row, CAST(parent AS VARCHAR) AS parent_id, tool, CASE WHEN tool = 'marker' THEN CAST(parent AS VARCHAR) || '|' || line WHEN tool = 'quality' THEN CAST(parent AS VARCHAR) || '.q' ELSE CAST(parent AS VARCHAR) END AS exact_id,
  CASE tool WHEN 'quality' THEN 'provirus' WHEN 'hallmark' THEN 'short_hallmark_region' ELSE 'input_contig' END AS record_type, CASE WHEN tool = 'quality' THEN "start" END AS s, CASE WHEN tool = 'quality' THEN "end" END AS e FROM calls)
SELECT row, final_id FROM ev JOIN finals ON CASE WHEN exact_id IN (SELECT final_id FROM finals) THEN exact_id = final_id WHEN record_type = 'short_hallmark_region' THEN final_type = 'input_contig' AND parent_id = final_parent
  WHEN record_type = 'provirus' THEN parent_id = final_parent AND CASE WHEN final_type = 'input_contig' THEN s = 1 AND e = 160 ELSE s <= fe AND fs <= e END ELSE parent_id = final_parent OR exact_id = final_parent END AND parent_id = final_parent""")
def harmony_applicability(spark: SparkSession, d: str) -> DataFrame:
    """HRM-1."""
    c = fr.calls(spark, d).withColumn("p", F.col("parent").cast("string"))
    f = c.where("tool = 'marker'").select(F.concat_ws("|", "p", F.col("line").cast("string")).alias("final_id"), F.col("p").alias("final_parent"), F.lit("provirus").alias("final_type"), F.col("start").alias("final_start"), F.col("end").alias("final_end"), F.lit(160).cast("long").alias("final_length"))
    whole = c.select("p").distinct().join(f.select(F.col("final_parent").alias("p")), "p", "left_anti")
    f = f.unionByName(whole.select(F.col("p").alias("final_id"), F.col("p").alias("final_parent"), F.lit("input_contig").alias("final_type"), F.lit(1).cast("long").alias("final_start"), F.lit(160).cast("long").alias("final_end"), F.lit(160).cast("long").alias("final_length")))
    line, q = F.col("line").cast("string"), F.col("tool") == "quality"
    ev = c.select(
        F.concat_ws(".", "p", line).alias("row"), F.col("p").alias("parent_id"),
        F.when(F.col("tool") == "marker", F.concat_ws("|", "p", line)).when(q, F.concat("p", F.lit(".q"))).otherwise(F.col("p")).alias("exact_id"),
        F.when(q, "provirus").when(F.col("tool") == "hallmark", "short_hallmark_region").otherwise("input_contig").alias("record_type"),
        F.when(q, F.col("start")).alias("start"), F.when(q, F.col("end")).alias("end"),
    )
    return hz.apply_evidence(ev, f).select("row", "final_id")


@query(f"""WITH {fr.EVIDENCE}, x AS (SELECT event_id, sequence_id, tool, classification, review, user_id % 3 > 0 AS region, event_id % 3 = 0 AS own, event_id % 4 = 0 AS refined FROM evidence),
w AS (SELECT *, bool_or(tool = 'click' AND refined AND own) OVER (PARTITION BY sequence_id) AS anew FROM x)
SELECT event_id, CASE WHEN review THEN 'review' WHEN tool = 'click' AND NOT refined AND (region OR anew) THEN 'superseded' WHEN region AND classification IN ('cellular', 'plasmid') AND NOT own THEN 'context' ELSE 'used' END AS evidence_application FROM w""")
def harmony_application(spark: SparkSession, d: str) -> DataFrame:
    """HRM-2, 3, 4: two of three user-days are regions; a third of the rows name the final record itself, a quarter were scored anew."""
    e, region = fr.evidence(spark, d), F.col("user_id") % 3 > 0
    own = F.col("event_id") % 3 == 0
    e = e.withColumns({
        "final_id": F.col("sequence_id"),
        "final_parent": F.when(region, F.concat("sequence_id", F.lit("^"))).otherwise(F.col("sequence_id")),
        "exact_id": F.when(own, F.col("sequence_id")).otherwise(F.concat("sequence_id", F.lit("^"))),
        "final_type": F.when(region, "provirus").otherwise("input_contig"),
        "evidence_scope": F.when(F.col("event_id") % 4 == 0, "refined_region"),
    })
    return hz.application(hz.prefer_region_scope(e, "click")).select("event_id", "evidence_application")


@query(f"""WITH {fr.EVIDENCE} SELECT sequence_id AS final_id, bool_or(tool = 'view' AND classification = 'virus' AND value > 50 AND event_id % 2 = 0) AS complete_support FROM evidence GROUP BY 1""")
def harmony_complete(spark: SparkSession, d: str) -> DataFrame:
    """HRM-6."""
    e = fr.evidence(spark, d).withColumns({"final_id": F.col("sequence_id"), "quality": F.lit("Complete"), "provirus": F.lit("No"), "final_type": F.lit("input_contig"), "viral_genes": F.when(F.col("value") > 50, 3).otherwise(0), "host_genes": F.col("event_id") % 2})
    return hz.complete_record_support(e, "view")


@query(f"""WITH {fr.EVIDENCE}, m AS (SELECT sequence_id AS final_id, max(CASE WHEN event_type = 'view' THEN CASE evidence_strength WHEN 'strong' THEN 3 WHEN 'qualified' THEN 2 ELSE 1 END END) AS retro, bool_or(event_type = 'click') AS lk, bool_or(event_type = 'error') AS unclear, bool_or(value > 60) AS viral, bool_or(value > 150) AS high FROM (SELECT *, tool AS event_type FROM evidence) WHERE tool IN ('view', 'click', 'error') GROUP BY 1)
SELECT final_id, CASE WHEN lk AND viral THEN 'retrovirus_compatible' WHEN (coalesce(retro, 0) >= 2 OR unclear) AND high THEN 'viral_with_mobile_element_features' WHEN coalesce(retro, 0) >= 2 AND viral THEN 'viral_retroelement_conflict' WHEN coalesce(retro, 0) >= 2 THEN 'likely_retroelement' WHEN lk THEN 'viral_like_mobile_element' WHEN unclear THEN 'ambiguous_mobile_element' WHEN retro = 1 AND viral THEN 'viral_candidate_with_weak_retroelement_signal' WHEN retro = 1 THEN 'weak_retroelement_signal' ELSE 'viral_candidate' END AS sequence_interpretation FROM m""")
def harmony_mobile(spark: SparkSession, d: str) -> DataFrame:
    """HRM-8."""
    e = fr.evidence(spark, d).where("tool in ('view', 'click', 'error')")
    kind = F.when(F.col("tool") == "view", "retroelement").when(F.col("tool") == "click", "viral_like_mobile_element").otherwise("ambiguous_mobile_element")
    s = e.groupBy(F.col("sequence_id").alias("final_id")).agg(F.collect_set(F.struct(kind.alias("category"), F.col("evidence_strength").alias("strength"))).alias("mobile"), F.bool_or(F.col("value") > 60).alias("viral_support"), F.bool_or(F.col("value") > 150).alias("high_consensus"))
    return hz.mobile_interpretation(s).select("final_id", "sequence_interpretation")


@query("SELECT c_custkey, CASE WHEN row_number() OVER (PARTITION BY c_mktsegment || c_nationkey ORDER BY c_custkey) = 1 THEN c_mktsegment || c_nationkey ELSE c_mktsegment || c_nationkey || '|dup_' || c_custkey END AS unique_name FROM customer")
def harmony_unique_names(spark: SparkSession, d: str) -> DataFrame:
    """HRM-16."""
    x = fr.table(spark, d, "customer").select("c_custkey", F.concat("c_mktsegment", F.col("c_nationkey").cast("string")).alias("name"))
    return hz.unique_names(x, "name", "c_custkey").select("c_custkey", "unique_name")


@query(APPLIED + """, h AS (SELECT DISTINCT sequence_id FROM evidence UNION SELECT DISTINCT user_id || '@none' FROM evidence), x AS (SELECT h.sequence_id, d.final_id, d.region, d.decision, coalesce(CAST(split_part(h.sequence_id, '@', 1) AS BIGINT) % 3 > 0, false) AS adv, CASE WHEN CAST(split_part(h.sequence_id, '@', 1) AS BIGINT) % 2 = 0 THEN 'likely_nonviral' ELSE 'viral' END AS st FROM h LEFT JOIN d ON d.final_id = h.sequence_id)
SELECT sequence_id, CASE WHEN decision LIKE 'retained%' THEN CASE WHEN region THEN 'retained_as_provirus' ELSE 'retained_contig' END WHEN decision LIKE 'provisional%' THEN CASE WHEN region THEN 'provisional_provirus_after_harmony' ELSE 'provisional_viral_after_harmony' END
  WHEN adv THEN CASE WHEN decision = 'likely_nonviral' THEN 'likely_nonviral_after_harmony' WHEN decision = 'likely_retroelement' THEN 'likely_retroelement_after_harmony' ELSE 'ambiguous_review_after_harmony' END WHEN st = 'likely_nonviral' THEN 'discovery_noncandidate_conflicting_origin' ELSE 'discovery_noncandidate_insufficient_support' END AS disposition,
  CASE WHEN decision LIKE 'retained%' THEN final_id ELSE 'NA' END AS final_sequence_ids, CASE WHEN decision LIKE 'provisional%' THEN final_id ELSE 'NA' END AS provisional_sequence_ids FROM x""")
def harmony_dispositions(spark: SparkSession, d: str) -> DataFrame:
    """HRM-17."""
    u = F.substring_index("sequence_id", "@", 1).cast("long")
    inputs = fr.header(spark, d).select("sequence_id", F.when(u % 2 == 0, "likely_nonviral").otherwise("viral").alias("status"), (u % 3 > 0).alias("advance"))
    return hz.dispositions(inputs, _decisions(spark, d).withColumn("parent_id", F.col("final_id")))


CLAIMS = f"""{fr.CATALOG}, claims AS (SELECT o.l_orderkey * 10 + o.l_linenumber AS claim, o.l_orderkey AS final_id, 't' || (o.l_linenumber % 4) AS tool, 'f' || (o.l_linenumber % 3) AS family, CAST(o.l_partkey % 3 + 1 AS INTEGER) AS tier,
  region, CASE WHEN o.l_partkey % 4 > 0 THEN nation END AS nation, CASE WHEN o.l_partkey % 4 > 1 THEN CASE WHEN o.l_partkey % 40 = 2 THEN 'no such' ELSE supplier END END AS supplier FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2) o JOIN catalog ON path_id = l_suppkey)"""


def _claims(spark: SparkSession, d: str) -> DataFrame:
    one = fr.table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))
    x = one.join(fr.catalog(spark, d), F.col("l_suppkey") == F.col("path_id"))
    m, third = F.col("l_partkey") % 4, F.col("l_partkey") % 3
    tier = taxonomy.tier_score(taxonomy.claim_tier([(third == 2, "high"), (third == 1, "moderate")]))
    return x.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("claim"), F.col("l_orderkey").alias("final_id"), F.concat(F.lit("t"), (F.col("l_linenumber") % 4).cast("string")).alias("tool"), F.concat(F.lit("f"), (F.col("l_linenumber") % 3).cast("string")).alias("family"), tier.alias("tier"), "region", F.when(m > 0, F.col("nation")).alias("nation"), F.when(m > 1, F.when(F.col("l_partkey") % 40 == 2, "no such").otherwise(F.col("supplier"))).alias("supplier"))


MATCHES = CLAIMS + ", matches AS (SELECT claim, path_id FROM claims c JOIN catalog p ON c.region = p.region AND (c.nation IS NULL OR c.nation = p.nation) AND (c.supplier IS NULL OR c.supplier = p.supplier))"


@query(f"WITH {MATCHES} SELECT claim, count(*) AS paths, min(path_id) AS first_path FROM matches GROUP BY 1")
def tax_matches(spark: SparkSession, d: str) -> DataFrame:
    """TAX-1."""
    nodes = taxonomy.catalog_nodes(fr.catalog(spark, d), "path_id", fr.RANKS)
    m = taxonomy.match_claims(_claims(spark, d), nodes, fr.RANKS).where("node is not null")
    return m.groupBy("claim").agg(F.sum("node_paths").alias("paths"), F.min("node_first").alias("first_path"))


RESOLVED = f"""WITH {MATCHES}, valid AS (SELECT *, CASE WHEN supplier IS NOT NULL THEN 3 WHEN nation IS NOT NULL THEN 2 ELSE 1 END AS depth FROM claims WHERE claim IN (SELECT claim FROM matches)),
sc AS (SELECT final_id, path_id, max(tier) AS t, count(DISTINCT family) AS f, sum(tier * depth) AS s, count(DISTINCT tool) AS k, max(depth) AS deep FROM matches JOIN valid USING (claim) GROUP BY 1, 2),
best AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY final_id ORDER BY t DESC, f DESC, s DESC, k DESC) AS r FROM sc) WHERE r = 1),
sh AS (SELECT final_id, count(*) AS best_paths, max(deep) AS deep, CASE WHEN count(DISTINCT region) = 1 THEN min(region) END AS r, CASE WHEN max(deep) >= 2 AND count(DISTINCT nation) = 1 THEN min(nation) END AS n, CASE WHEN max(deep) >= 3 AND count(DISTINCT supplier) = 1 THEN min(supplier) END AS s FROM best JOIN catalog USING (path_id) GROUP BY 1),
e AS (SELECT final_id, family, tier, unnest([1, 2, 3]) AS rank, unnest([region, nation, supplier]) AS taxon FROM valid), taxa AS (SELECT final_id, rank, taxon, count(DISTINCT family) AS families, max(tier) AS tier FROM e WHERE taxon IS NOT NULL GROUP BY 1, 2, 3),
own AS (SELECT final_id, unnest([1, 2, 3]) AS rank, unnest([r, n, s]) AS own FROM sh),
cl AS (SELECT final_id, min(rank) AS c FROM taxa JOIN own USING (final_id, rank) WHERE taxon <> own AND families >= 2 GROUP BY 1),
la AS (SELECT t.final_id, max(families) FILTER (taxon = own) AS sf, max(tier) FILTER (taxon = own) AS st, count(*) FILTER (own IS NULL OR taxon <> own) AS others FROM taxa t JOIN own USING (final_id, rank) WHERE rank = 3 GROUP BY 1),
j AS (SELECT sh.*, coalesce(c, 0) AS conf, coalesce(sf, 0) AS sf, coalesce(st, 0) AS st, coalesce(others, 0) AS others, CASE WHEN r IS NULL THEN 1 WHEN deep >= 2 AND n IS NULL THEN 2 WHEN deep >= 3 AND s IS NULL THEN 3 ELSE 0 END AS amb FROM sh LEFT JOIN cl USING (final_id) LEFT JOIN la USING (final_id)),
sp AS (SELECT *, CASE WHEN s IS NOT NULL AND sf >= 2 AND conf = 0 THEN 'strict_consensus' WHEN s IS NOT NULL AND st = 3 AND others = 0 AND conf = 0 THEN 'strict_single_high' WHEN conf > 0 AND conf < 3 THEN 'withheld_lineage_conflict' WHEN s IS NULL AND amb = 3 THEN 'ambiguous_species' WHEN s IS NULL AND amb > 0 THEN 'withheld_lineage_conflict' WHEN others > 0 OR conf = 3 THEN 'withheld_species_conflict' WHEN s IS NOT NULL AND st = 2 THEN 'exploratory_single_moderate' WHEN s IS NOT NULL THEN 'exploratory_single_provisional' ELSE 'unresolved' END AS species_status FROM j),
res AS (SELECT final_id, CASE WHEN conf = 0 OR conf > 1 THEN r END AS strict_region, CASE WHEN conf = 0 OR conf > 2 THEN n END AS strict_nation, CASE WHEN (conf = 0 OR conf > 3) AND species_status IN ('strict_consensus', 'strict_single_high') THEN s END AS strict_supplier, r AS exploratory_region, n AS exploratory_nation, s AS exploratory_supplier, best_paths, CAST(amb AS INTEGER) AS ambiguous_rank, CAST(conf AS INTEGER) AS conflict_rank, species_status FROM sp)
"""


def _matches(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.match_claims(_claims(spark, d), taxonomy.catalog_nodes(fr.catalog(spark, d), "path_id", fr.RANKS), fr.RANKS)


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.resolve_matched(_matches(spark, d), fr.RANKS)


@query(RESOLVED + "SELECT * FROM res")
def tax_resolved(spark: SparkSession, d: str) -> DataFrame:
    """TAX-3 to TAX-6."""
    return _resolved(spark, d).drop("support")


CONFIDENCE = """, dd AS (SELECT *, CASE WHEN strict_supplier IS NOT NULL THEN 3 WHEN strict_nation IS NOT NULL THEN 2 WHEN strict_region IS NOT NULL THEN 1 ELSE 0 END AS sd, CASE WHEN exploratory_supplier IS NOT NULL THEN 3 WHEN exploratory_nation IS NOT NULL THEN 2 WHEN exploratory_region IS NOT NULL THEN 1 ELSE 0 END AS ed FROM res),
bk AS (SELECT dd.final_id, string_agg(DISTINCT tool, ',' ORDER BY tool) FILTER (here) AS st, string_agg(DISTINCT family, ',' ORDER BY family) FILTER (here) AS sf, count(DISTINCT family) FILTER (here) AS nf, max(tier) FILTER (here) AS tt,
  string_agg(DISTINCT tool, ',' ORDER BY tool) FILTER (there) AS xt, string_agg(DISTINCT family, ',' ORDER BY family) FILTER (there) AS xf, max(tier) FILTER (there) AS xx FROM (SELECT dd.*, tool, family, tier,
    sd > 0 AND [v.region, v.nation, v.supplier][sd] = [strict_region, strict_nation, strict_supplier][sd] AS here, ed > 0 AND [v.region, v.nation, v.supplier][ed] = [exploratory_region, exploratory_nation, exploratory_supplier][ed] AS there FROM dd JOIN valid v ON v.final_id = dd.final_id) dd GROUP BY 1),
conf AS (SELECT dd.*, coalesce(st, '') AS strict_tools, coalesce(sf, '') AS strict_families, coalesce(xt, '') AS exploratory_tools, coalesce(xf, '') AS exploratory_families, CASE WHEN nf >= 2 THEN 'multi_method_consensus' WHEN tt = 3 THEN 'single_method_high' WHEN sd = 0 THEN 'unclassified' ELSE 'moderate_supported' END AS strict_confidence,
  CASE xx WHEN 3 THEN 'high' WHEN 2 THEN 'moderate' WHEN 1 THEN 'provisional' ELSE 'ambiguous' END AS exploratory_confidence, CASE WHEN conflict_rank > 0 THEN 'independent_method_conflict' WHEN sd <> ed THEN 'insufficient_rank_support' WHEN ambiguous_rank > 0 THEN 'ambiguous_catalog_paths' ELSE 'deepest_supported_rank' END AS stop_reason,
  CASE WHEN strict_region IS NOT DISTINCT FROM exploratory_region AND strict_nation IS NOT DISTINCT FROM exploratory_nation AND strict_supplier IS NOT DISTINCT FROM exploratory_supplier THEN 'matches_strict' WHEN conflict_rank > 0 THEN 'alternative_at_conflict' WHEN sd = 0 THEN 'exploratory_only' ELSE 'extends_strict' END AS exploratory_status FROM dd LEFT JOIN bk USING (final_id))
"""


@query(RESOLVED + CONFIDENCE + "SELECT final_id, CAST(sd AS INTEGER) AS strict_depth, strict_tools, strict_families, strict_confidence, exploratory_tools, exploratory_families, exploratory_confidence, stop_reason, exploratory_status FROM conf")
def tax_confidence(spark: SparkSession, d: str) -> DataFrame:
    """TAX-7."""
    sets = ("strict_tools", "strict_families", "exploratory_tools", "exploratory_families")
    return taxonomy.confidence(_resolved(spark, d), fr.RANKS).select("final_id", "strict_depth", *[F.array_join(c, ",").alias(c) for c in sets], "strict_confidence", "exploratory_confidence", "stop_reason", "exploratory_status")


@query(RESOLVED + """, e2 AS (SELECT claim, final_id, tool, CAST(unnest([1, 2, 3]) AS INTEGER) AS rank, unnest([region, nation, supplier]) AS taxon FROM claims), s2 AS (SELECT final_id, unnest([1, 2, 3]) AS rank, unnest([strict_region, strict_nation, strict_supplier]) AS own FROM res)
SELECT claim, e2.final_id, tool, e2.rank, taxon, CASE WHEN claim NOT IN (SELECT claim FROM matches) THEN 'not_in_catalog' WHEN own IS NULL THEN 'rank_not_resolved' WHEN own = taxon THEN 'accepted' ELSE 'other_taxon_accepted' END AS reason FROM e2 LEFT JOIN s2 ON e2.final_id = s2.final_id AND e2.rank = s2.rank WHERE taxon IS NOT NULL""")
def tax_vote_audit(spark: SparkSession, d: str) -> DataFrame:
    """TAX-8."""
    matches = _matches(spark, d)
    return taxonomy.vote_audit(matches, taxonomy.resolve_matched(matches, fr.RANKS), fr.RANKS)


GROUPS = """gr AS (SELECT l_orderkey AS final_id, CASE WHEN l_partkey % 10 = 0 THEN 'unplaced_' || l_suppkey % 2 WHEN l_partkey % 10 = 1 THEN 'default' ELSE region END AS rp, CASE WHEN l_partkey % 4 = 0 THEN 'Novel_n' || l_partkey % 3 ELSE nation END AS np FROM lineitem JOIN catalog ON path_id = l_suppkey),
le AS (SELECT o_orderkey AS final_id, max(CAST(o_totalprice AS BIGINT)) AS length FROM orders GROUP BY 1),
gs AS (SELECT gr.final_id, unnest([{'k': 'region', 't': rp, 'agrees': false, 'taken': strict_region IS NOT NULL}, {'k': 'nation', 't': np, 'agrees': rp NOT LIKE 'unplaced%' AND rp <> 'default' AND coalesce(rp = strict_region, false), 'taken': strict_nation IS NOT NULL}]) AS g, coalesce(length, 0) AS length
  FROM gr LEFT JOIN res ON res.final_id = gr.final_id LEFT JOIN le ON le.final_id = gr.final_id),
gp AS (SELECT final_id, g.k AS rank, list_distinct(list(g.t)) AS taxa, bool_or(g.agrees) AS agrees, bool_or(g.taken) AS taken, max(length) AS length FROM gs WHERE lower(g.t) LIKE 'novel\\_%' ESCAPE '\\' OR lower(g.t) LIKE 'unplaced\\_%' ESCAPE '\\' GROUP BY 1, 2),
gq AS (SELECT *, CASE WHEN length < 100000 THEN 'below_minimum_length' WHEN len(taxa) > 1 THEN 'ambiguous_groups' WHEN taken THEN 'strict_rank_already_classified' WHEN agrees THEN 'reported_compatible_project_group' ELSE 'incompatible_or_unknown_parent_context' END AS reason FROM gp)"""


def _groups(spark: SparkSession, d: str, resolved: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Project groups that order lines predict for their order, and the orders' strict lineages and lengths."""
    x = fr.table(spark, d, "lineitem").join(fr.catalog(spark, d), F.col("l_suppkey") == F.col("path_id"))
    part = F.col("l_partkey")
    region = F.when(part % 10 == 0, F.concat(F.lit("unplaced_"), (F.col("l_suppkey") % 2).cast("string"))).when(part % 10 == 1, "default").otherwise(F.col("region"))
    nation = F.when(part % 4 == 0, F.concat(F.lit("Novel_n"), (part % 3).cast("string"))).otherwise(F.col("nation"))
    groups = x.select(F.col("l_orderkey").alias("final_id"), F.lit("Viruses").alias("domain_prediction"), region.alias("region_prediction"), nation.alias("nation_prediction"), F.lit("").alias("supplier_prediction"))
    length = fr.table(spark, d, "orders").groupBy(F.col("o_orderkey").alias("final_id")).agg(F.max(F.col("o_totalprice").cast("decimal(20,0)").cast("long")).alias("length"))
    resolved = (_resolved(spark, d) if resolved is None else resolved).drop("support")
    strict = length.join(resolved.withColumn("strict_domain", F.lit("Viruses")), "final_id", "full")
    return groups, strict


@query(RESOLVED + ", " + GROUPS + " SELECT final_id, rank, unnest(taxa) AS taxon, reason, reason = 'reported_compatible_project_group' AS accepted FROM gq")
def tax_groups(spark: SparkSession, d: str) -> DataFrame:
    """TAX-9: synthetic groups against the strict lineage and its parents."""
    return taxonomy.group_report(*_groups(spark, d), ["domain", *fr.RANKS], 100_000)


@query(RESOLVED + ", " + GROUPS + """ SELECT o_orderkey AS final_id, coalesce(labels, '') AS labels, coalesce(statuses, 'no_project_group') AS statuses FROM (SELECT DISTINCT o_orderkey FROM orders)
  LEFT JOIN (SELECT final_id, string_agg(DISTINCT rank || ':' || t, ',' ORDER BY rank || ':' || t) AS labels, string_agg(DISTINCT reason, ',' ORDER BY reason) AS statuses FROM (SELECT *, unnest(taxa) AS t FROM gq) GROUP BY 1) ON final_id = o_orderkey""")
def tax_group_summary(spark: SparkSession, d: str) -> DataFrame:
    """TAX-9: labels and statuses of every order."""
    finals = fr.table(spark, d, "orders").select(F.col("o_orderkey").alias("final_id")).distinct()
    out = taxonomy.group_summary(finals, taxonomy.group_report(*_groups(spark, d), ["domain", *fr.RANKS], 100_000))
    return out.select("final_id", F.array_join("labels", ",").alias("labels"), F.array_join("statuses", ",").alias("statuses"))


_SET = "coalesce(nullif(array_to_string({0}, ','), ''), 'NA')"
METADATA_SQL = RESOLVED + CONFIDENCE + ", " + GROUPS + ", " + APPLIED[len("WITH ") :] + f""", dd2 AS (SELECT d.*, CASE WHEN NOT (user_id % 3 = 0) THEN 'not_disputed' WHEN user_id % 5 = 0 THEN 'strong_hallmark_rescue' WHEN user_id % 7 >= 2 AND (user_id % 7) / nullif(user_id % 7 + user_id % 4, 0) >= 0.6 THEN 'regional_support' ELSE 'provisional_disputed_boundary' END AS basis FROM d),
gg AS (SELECT final_id, string_agg(DISTINCT rank || ':' || t, ',' ORDER BY rank || ':' || t) AS labels, string_agg(DISTINCT reason, ',' ORDER BY reason) AS statuses FROM (SELECT *, unnest(taxa) AS t FROM gq) GROUP BY 1),
ho AS (SELECT sequence_id AS final_id, list_sort(list(DISTINCT classification)) AS patterns, count(*) FILTER (classification = 'virus') AS v, count(*) FILTER (classification = 'cellular') AS c FROM evidence WHERE tool = 'click' GROUP BY 1)
SELECT d.final_id AS final_sequence_id, d.final_id AS normalized_name, CASE WHEN d.region THEN 'provirus' ELSE 'input_contig' END AS record_type, CASE WHEN d.region THEN '5-95' ELSE 'NA' END AS region_coordinates, '100' AS original_length, CASE WHEN d.region THEN '91' ELSE '100' END AS refined_length, d.status AS discovery_status,
  decision AS viral_decision, confidence AS viral_confidence, {_SET.format("strong")} AS strong_tools, {_SET.format("qualified")} AS qualified_tools, {_SET.format("cellular")} AS cellular_conflict_tools, {_SET.format("plasmid")} AS plasmid_conflict_tools, CAST(over AS VARCHAR) AS generic_cellular_conflict_overridden,
  coalesce(strict_region || ';' || coalesce(strict_nation, '') || ';' || coalesce(strict_supplier, ''), 'NA') AS strict_taxonomy, coalesce(strict_confidence, 'NA') AS strict_taxonomy_confidence, coalesce(nullif(strict_tools, ''), 'NA') AS strict_taxonomy_supporting_tools, coalesce(nullif(exploratory_families, ''), 'NA') AS exploratory_taxonomy_supporting_method_families, coalesce(species_status, 'NA') AS species_assignment_status, CASE WHEN coalesce(conflict_rank, 0) > 0 THEN 'true' ELSE 'false' END AS taxonomy_conflict,
  coalesce(labels, 'NA') AS group_labels, coalesce(statuses, 'no_project_group') AS group_status, interp AS sequence_interpretation, coalesce(array_to_string(patterns, ','), 'NA') AS homology_origin_pattern, coalesce(v, 0)::VARCHAR AS homology_viral_supported_loci, coalesce(c, 0)::VARCHAR AS homology_cellular_supported_loci, basis AS region_retention_basis, 'NA' AS mobile_status, 'false' AS conflict_exception
FROM dd2 d LEFT JOIN conf ON conf.final_id = d.user_id LEFT JOIN gg ON gg.final_id = d.user_id LEFT JOIN ho ON ho.final_id = d.final_id"""


@query(METADATA_SQL)
def harmony_metadata(spark: SparkSession, d: str) -> DataFrame:
    """HRM-18: the final table of all user-days; a user's taxonomy and groups are those of the order of its number."""
    u = F.col("user_id")
    x = hz.entity(hz.disputed_boundary(_decisions(spark, d).withColumns({"disputed": u % 3 == 0, "hallmark_strong": u % 5 == 0, "viral_loci": u % 7, "cellular_loci": u % 4, "kept": F.col("decision")})).withColumn("decision", F.col("kept")))
    region = F.col("record_type") == "provirus"
    finals = x.select("final_id", F.col("final_id").alias("final_parent"), F.col("final_id").alias("original_name"), "record_type", "discovery_status", F.when(region, "5-95").alias("coordinates"), F.lit(100).alias("original_length"), F.when(region, 91).otherwise(100).alias("refined_length"))
    by_user = x.select("final_id", "user_id")
    path = F.when(F.col("strict_region").isNotNull(), F.concat_ws(";", *[F.coalesce(f"strict_{r}", F.lit("")) for r in fr.RANKS]))
    shared_folder(spark)
    resolved = _resolved(spark, d).checkpoint()  # taken twice below
    taxa = taxonomy.confidence(resolved, fr.RANKS).withColumns({"strict_taxonomy": path, "taxonomy_conflict": F.col("conflict_rank") > 0}).withColumnRenamed("final_id", "user_id")
    groups = taxonomy.group_report(*_groups(spark, d, resolved), ["domain", *fr.RANKS], 100_000)
    groups = taxonomy.group_summary(groups.select("final_id").distinct(), groups).withColumnRenamed("final_id", "user_id")
    e = fr.evidence(spark, d).where("tool = 'click'").groupBy(F.col("sequence_id").alias("final_id"))
    homology = e.agg(F.collect_set("classification").alias("patterns"), F.count_if(F.col("classification") == "virus").alias("viral_loci"), F.count_if(F.col("classification") == "cellular").alias("cellular_loci"))
    frames = {"final": finals, "decision": x, "taxonomy": by_user.join(taxa, "user_id"), "groups": by_user.join(groups, "user_id"), "mobile": x.select("final_id", "sequence_interpretation"), "homology": homology}
    out = hz.final_metadata(frames)
    assert len(out.columns) == 61
    return out.select(
        "final_sequence_id", "normalized_name", "record_type", "region_coordinates", "original_length", "refined_length", "discovery_status", "viral_decision", "viral_confidence", "strong_tools", "qualified_tools", "cellular_conflict_tools", "plasmid_conflict_tools", "generic_cellular_conflict_overridden",
        "strict_taxonomy", "strict_taxonomy_confidence", "strict_taxonomy_supporting_tools", "exploratory_taxonomy_supporting_method_families", "species_assignment_status", "taxonomy_conflict", "group_labels", "group_status", "sequence_interpretation", "homology_origin_pattern", "homology_viral_supported_loci", "homology_cellular_supported_loci", "region_retention_basis", "mobile_status", "conflict_exception",
    )


SIX = [f"c{i}" for i in range(6)]
EMB = "e AS (SELECT vec_id, " + ", ".join(f"CAST(abs(embedding[{i + 1}]) AS DOUBLE) AS c{i}" for i in range(6)) + " FROM embeddings)"


def _six(spark: SparkSession, d: str) -> DataFrame:
    return fr.table(spark, d, "embeddings").select("vec_id", *[F.abs(F.get("embedding", F.lit(i)).cast("double")).alias(f"c{i}") for i in range(6)])


ARG = "greatest(c0, c1, c2, c3, c4, c5) AS score, CASE greatest(c0, c1, c2, c3, c4, c5) WHEN c0 THEN 'c0' WHEN c1 THEN 'c1' WHEN c2 THEN 'c2' WHEN c3 THEN 'c3' WHEN c4 THEN 'c4' ELSE 'c5' END AS class"


@query(f"WITH {EMB}, t AS (SELECT vec_id, {ARG} FROM e) SELECT vec_id, class, score, CASE WHEN class IN ('c0', 'c1', 'c2') THEN 'virus' ELSE 'cellular' END AS classification FROM t WHERE score >= CASE class WHEN 'c0' THEN 0.1 WHEN 'c1' THEN 0.15 ELSE 0.2 END")
def std_argmax_class(spark: SparkSession, d: str) -> DataFrame:
    """STD-4."""
    out = standardize.argmax_by_class(_six(spark, d), SIX, {c: {"c0": 0.1, "c1": 0.15}.get(c, 0.2) for c in SIX}, {c: "virus" if c < "c3" else "cellular" for c in SIX}, "six")
    return out.select("vec_id", "class", "score", "classification")


@query(f"WITH {EMB}, t AS (SELECT vec_id, {ARG}, list_sort([c0, c1, c2, c3, c4, c5]) AS o FROM e) SELECT vec_id, class, score FROM t WHERE score >= 0.1 AND score >= 1.25 * (o[3] + o[4]) / 2")
def std_argmax_median(spark: SparkSession, d: str) -> DataFrame:
    """STD-5."""
    return standardize.argmax_by_median(_six(spark, d), SIX, {c: "virus" for c in SIX}, "six", minimum=0.1).select("vec_id", "class", "score")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN v = 0 AND h > 0 THEN 'cellular' WHEN v = 0 THEN 'unclassified' ELSE 'virus' END AS classification,
  CASE WHEN v = 0 AND h > 0 THEN 'qualified' WHEN v = 0 THEN 'weak' WHEN q IN ('complete', 'high-quality') AND conf THEN 'strong' WHEN rt = 'provirus' THEN 'qualified' WHEN q IN ('complete', 'high-quality') AND h = 0 THEN 'qualified' WHEN q = 'medium-quality' AND h = 0 THEN 'qualified' ELSE 'weak' END AS evidence_strength
FROM (SELECT l_orderkey, l_linenumber, l_partkey % 4 AS v, l_suppkey % 3 AS h, CASE l_returnflag WHEN 'A' THEN 'complete' WHEN 'N' THEN 'medium-quality' ELSE 'low-quality' END AS q, l_discount > 0.05 AS conf, CASE WHEN l_linenumber % 2 = 0 THEN 'provirus' ELSE 'input_contig' END AS rt FROM lineitem)""")
def std_quality(spark: SparkSession, d: str) -> DataFrame:
    """STD-8."""
    x = fr.table(spark, d, "lineitem").withColumns({"viral_genes": F.col("l_partkey") % 4, "host_genes": F.col("l_suppkey") % 3, "quality": F.when(F.col("l_returnflag") == "A", "Complete").when(F.col("l_returnflag") == "N", "Medium-quality").otherwise("Low-quality"), "confident": F.col("l_discount") > 0.05, "record_type": F.when(F.col("l_linenumber") % 2 == 0, "provirus").otherwise("input_contig")})
    return standardize.quality_ladder(x).select("l_orderkey", "l_linenumber", "classification", "evidence_strength")


@query("""WITH g AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_discount > 0.05) AS h, count(*) FILTER (l_tax > 0.06) AS u FROM lineitem GROUP BY 1)
SELECT o_orderkey AS sequence_id, CASE WHEN o_orderstatus = 'P' THEN 'plasmid' ELSE 'virus' END AS classification, CASE WHEN o_totalprice / 500000 >= 0.2 AND coalesce(n, 0) >= 1 AND o_custkey % 10 / 2.0 >= 1.5 AND coalesce(h, 0) >= 1 AND coalesce(u, 0) <= 2 THEN 'strong' ELSE 'qualified' END AS evidence_strength FROM orders LEFT JOIN g ON l_orderkey = o_orderkey""")
def std_marker(spark: SparkSession, d: str) -> DataFrame:
    """STD-1, DQ-10."""
    o = fr.table(spark, d, "orders")
    x = o.select(F.col("o_orderkey").cast("string").alias("sequence_id"), "o_orderstatus", (F.col("o_totalprice") / 500000).alias("score"), F.lit(None).cast("double").alias("fdr"), (F.col("o_custkey") % 10 / 2.0).alias("enrichment"))
    genes = fr.table(spark, d, "lineitem").select(F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("gene"), (F.col("l_discount") > 0.05).alias("hallmark"), (F.col("l_tax") > 0.06).alias("uscg"))
    out = standardize.marker_calls(x.where("o_orderstatus <> 'P'"), x.where("o_orderstatus = 'P'"), genes, min_score=0.2)
    return out.select(F.col("sequence_id").cast("long").alias("sequence_id"), "classification", "evidence_strength")


@query("SELECT event_id, CASE WHEN s IS NULL THEN 'review' WHEN s >= 0.9 THEN 'strong' ELSE 'qualified' END AS evidence_strength FROM (SELECT event_id, CASE WHEN event_id % 10 > 0 THEN value / 100 END AS s, event_id % 4 AS h FROM events) WHERE s >= 0.5 OR (s IS NULL AND h > 0)")
def std_classifier(spark: SparkSession, d: str) -> DataFrame:
    """STD-2."""
    x = fr.table(spark, d, "events").withColumns({"score": F.when(F.col("event_id") % 10 > 0, F.col("value") / 100), "hallmarks": F.col("event_id") % 4})
    return standardize.classifier_scores(x).select("event_id", "evidence_strength")


@query("SELECT l_orderkey AS record, count(DISTINCT (l_partkey % 5, l_suppkey % 3, l_linenumber % 2)) AS n_hallmarks, CASE WHEN (bool_or(l_tax > 0.04) OR NOT bool_or(l_discount > 0.05)) AND count(DISTINCT (l_partkey % 5, l_suppkey % 3, l_linenumber % 2)) >= 2 THEN 'strong' ELSE 'qualified' END AS evidence_strength FROM lineitem GROUP BY 1")
def std_hallmarks(spark: SparkSession, d: str) -> DataFrame:
    """STD-3."""
    x = fr.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record"), (F.col("l_partkey") % 5).alias("gene"), (F.col("l_suppkey") % 3).alias("start"), (F.col("l_linenumber") % 2).alias("stop"), (F.col("l_tax") > 0.04).alias("region"), (F.col("l_discount") > 0.05).alias("end_feature"))
    return standardize.hallmark_counts(x, ["record"]).select("record", "n_hallmarks", "evidence_strength")


@query(f"""WITH {fr.CATALOG} SELECT o_orderkey AS record, n AS nation, CASE WHEN r = 'ASIA' THEN 'model_with_taxon' ELSE 'model_only' END AS strength_basis FROM orders JOIN customer ON o_custkey = c_custkey JOIN (SELECT n_nationkey, n_name AS n, r_name AS r FROM nation JOIN region ON n_regionkey = r_regionkey) ON n_nationkey = c_nationkey WHERE o_totalprice >= 100000 AND o_orderstatus = 'F'""")
def std_model(spark: SparkSession, d: str) -> DataFrame:
    """STD-6."""
    n, r = fr.table(spark, d, "nation"), fr.table(spark, d, "region")
    cat = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
    cons = lineage.catalog_consensus(cat, ["region", "nation"])
    o = fr.table(spark, d, "orders").join(fr.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    x = o.select(F.col("o_orderkey").alias("record"), F.col("n_name").alias("taxon"), F.col("o_totalprice").alias("length"), (F.col("o_orderstatus") == "F").alias("positive"))
    out = standardize.model_calls(x, cons, "nation", ("region", "ASIA"), ["region", "nation"], "model", 100_000)
    return out.select("record", F.col("taxon").alias("nation"), "strength_basis")


@query(f"""WITH {fr.CATALOG}, t AS (SELECT s_suppkey AS id, [CASE WHEN s_suppkey % 2 = 0 THEN upper(s_name) ELSE 'nothing' END, n_name, lower(r_name)] AS toks FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT id, CAST(CASE WHEN id % 2 = 0 THEN 3 ELSE 2 END AS INTEGER) AS rank, region, nation, CASE WHEN id % 2 = 0 THEN supplier WHEN c = 1 THEN supplier END AS supplier FROM t JOIN catalog ON path_id = id JOIN (SELECT nation AS nn, count(*) AS c FROM catalog GROUP BY 1) ON nn = nation""")
def std_deepest_taxon(spark: SparkSession, d: str) -> DataFrame:
    """STD-7."""
    cat = fr.catalog(spark, d)
    x = cat.select(F.col("path_id").alias("id"), F.array(F.when(F.col("path_id") % 2 == 0, F.upper("supplier")).otherwise("nothing"), F.col("nation"), F.lower("region")).alias("toks"))
    return standardize.deepest_taxon(x, lineage.catalog_consensus(cat, fr.RANKS), "id", "toks", fr.RANKS).drop("toks")


@query("""SELECT p_partkey AS part, CASE WHEN lower(p_type) = 'economy' THEN 'viral_like_mobile_element' WHEN lower(p_brand) = 'brand#1' THEN 'ambiguous_mobile_element' ELSE 'retroelement' END AS category, CASE WHEN p_size % 3 = 0 THEN 'weak' WHEN p_size % 2 = 0 THEN 'strong' ELSE 'qualified' END AS evidence_strength FROM part""")
def std_mobile(spark: SparkSession, d: str) -> DataFrame:
    """STD-9."""
    x = fr.table(spark, d, "part").select(F.col("p_partkey").alias("part"), F.array("p_type", "p_brand").alias("labels"), (F.col("p_size") % 3).alias("domain_count"), F.when(F.col("p_size") % 2 == 0, "Yes").otherwise("No").alias("complete"))
    return standardize.mobile_domains(x, ("economy",), ("brand#1",)).select("part", "category", "evidence_strength")


@query(f"WITH {CLAIMS} SELECT claim, region, nation, CASE WHEN supplier <> 'no such' THEN supplier END AS supplier, CAST(CASE WHEN supplier = 'no such' THEN 1 ELSE 0 END AS BIGINT) AS unknown FROM claims")
def std_best_lineage(spark: SparkSession, d: str) -> DataFrame:
    """STD-10."""
    x = _claims(spark, d).select("claim", *fr.RANKS)
    return standardize.best_lineages(x, taxonomy.catalog_index(fr.catalog(spark, d), "path_id", fr.RANKS), "claim", fr.RANKS).select("claim", *fr.RANKS, "unknown")


@query("""WITH c AS (SELECT c_custkey AS id, dom, c_mktsegment = dom AS seen, c_custkey AS k, CASE c_custkey % 7 WHEN 0 THEN 'novel_r1' WHEN 1 THEN 'Singleton' WHEN 2 THEN '' ELSE r_name END AS realm, CASE c_custkey % 4 WHEN 0 THEN 'novel_f' || c_custkey % 3 WHEN 1 THEN '' ELSE n_name END AS family, CASE c_custkey % 5 WHEN 0 THEN 'unplaced_s' ELSE n_name || 'inae' END AS sub
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey CROSS JOIN (VALUES ('BUILDING'), ('HOUSEHOLD'), ('none')) t(dom)),
t AS (SELECT *, seen AND k % 7 > 2 AS nr, seen AND k % 4 > 1 AND k % 3 = 0 AS bf, seen AND k % 5 > 0 AND k % 2 = 0 AS bs FROM c)
SELECT id, dom AS database_domain, CASE WHEN NOT seen THEN 'not_reported' WHEN k % 7 = 1 THEN 'singleton' WHEN k % 2 = 0 THEN 'clustered' WHEN realm || family || sub <> '' THEN 'assigned_without_reference_flag' ELSE 'unassigned' END AS assignment_status,
  CASE WHEN nr THEN realm END AS realm, CASE WHEN bf THEN family END AS family, CASE WHEN bf THEN 'family' WHEN nr THEN 'realm' ELSE '' END AS deepest_rank, CASE WHEN bs THEN 'subfamily' WHEN bf THEN 'family' ELSE '' END AS deepest_reference_rank,
  CASE WHEN seen THEN concat_ws(',', CASE WHEN k % 7 = 0 THEN 'realm' END, CASE WHEN k % 4 = 0 THEN 'family' END) ELSE '' END AS novel_group_ranks, CASE WHEN seen AND k % 5 = 0 THEN 'subfamily' ELSE '' END AS unplaced_group_ranks,
  CASE WHEN NOT seen THEN 'not_reported' WHEN bs OR bf THEN 'reference_supported_taxonomy' WHEN nr THEN 'realm_only_taxonomy' WHEN k % 7 = 0 OR k % 4 = 0 THEN 'novel_group_only' WHEN k % 7 = 1 THEN 'singleton' ELSE 'no_qualified_taxonomy' END AS decision FROM t""")
def std_groups(spark: SparkSession, d: str) -> DataFrame:
    """STD-11: customers as regions, their segment as the database that reports them."""
    c, n, r = (fr.table(spark, d, t) for t in ("customer", "nation", "region"))
    x = c.join(n, F.col("n_nationkey") == F.col("c_nationkey")).join(r, F.col("r_regionkey") == F.col("n_regionkey"))
    k = F.col("c_custkey")
    realm = F.when(k % 7 == 0, "novel_r1").when(k % 7 == 1, "Singleton").when(k % 7 == 2, "").otherwise(F.col("r_name"))
    family = F.when(k % 4 == 0, F.concat(F.lit("novel_f"), (k % 3).cast("string"))).when(k % 4 == 1, "").otherwise(F.col("n_name"))
    sub = F.when(k % 5 == 0, "unplaced_s").otherwise(F.concat("n_name", F.lit("inae")))
    a = x.select(k.alias("id"), F.col("c_mktsegment").alias("database_domain"), F.when(k % 2 == 0, "False").alias("reference"), realm.alias("realm_prediction"), family.alias("family_prediction"), F.when(k % 3 == 0, " Reference").otherwise("network").alias("family_evidence"), sub.alias("subfamily_prediction"), F.when(k % 2 == 0, "reference").alias("subfamily_evidence"))
    return standardize.group_table(c.select(k.alias("id")), a, ["BUILDING", "HOUSEHOLD", "none"], "id", ["realm", "family", "subfamily"])


REGION_LISTS = """li AS (SELECT l_orderkey AS id, list({'n': l_linenumber, 's': l_linenumber * 100 + l_partkey % 50, 'e': l_linenumber * 100 + l_partkey % 50 + CAST(l_quantity AS BIGINT), 'v': l_suppkey % 2 = 0} ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS r FROM lineitem GROUP BY 1),
lr AS (SELECT id, r, len(r) AS n, list_sum(list_transform(list_filter(r, lambda x: x.v), lambda x: x.e - x.s + 1)) AS total FROM li),
lf AS (SELECT *, CASE WHEN id % 11 = 0 THEN 'no_regions' WHEN id % 13 = 0 THEN 'lists_differ_in_length' WHEN id % 17 = 0 THEN 'bad_coordinate' WHEN len(list_filter(r, lambda x: x.e > 700)) > 0 THEN 'beyond_record' WHEN len(list_filter(range(1, n), lambda i: r[i].e >= r[i + 1].s)) > 0 THEN 'out_of_order' WHEN total IS NULL THEN 'no_viral_region' WHEN id % 19 = 0 THEN 'sum_differs_from_reported' END AS fault FROM lr)"""


def _region_lists(spark: SparkSession, d: str) -> DataFrame:
    """The lines of an order as two parallel lists; some orders break their contract."""
    x = fr.table(spark, d, "lineitem")
    g = x.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))).alias("r"))
    start = lambda c: (c.l_linenumber * 100 + c.l_partkey % 50).cast("long")
    cell = lambda c: F.struct(start(c).alias("s"), (start(c) + c.l_quantity.cast("long")).alias("e"), (c.l_suppkey % 2 == 0).alias("v"))
    g = g.withColumn("r", F.transform("r", cell))
    viral = F.aggregate(F.filter("r", lambda c: c.v), F.lit(0).cast("long"), lambda a, c: a + c.e - c.s + 1)
    types = F.array_join(F.transform("r", lambda c: F.when(c.v, " Viral").otherwise("host")), ",")
    spans = F.array_join(F.transform("r", lambda c: F.concat_ws("-", c.s.cast("string"), c.e.cast("string"))), ",")
    i = F.col("id")
    spans = F.when(i % 11 == 0, "NA").when(i % 13 == 0, F.concat(spans, F.lit(",1-2"))).when(i % 17 == 0, F.concat(F.lit("x"), spans)).otherwise(spans)
    return g.select("id", types.alias("types"), spans.alias("spans"), F.lit(700).alias("length"), F.when(i % 19 == 0, viral + 1).otherwise(viral).alias("total"))


@query(f"WITH {REGION_LISTS} SELECT id, fault FROM lf WHERE fault IS NOT NULL")
def std_region_faults(spark: SparkSession, d: str) -> DataFrame:
    """STD-8: orders whose lists don't make regions."""
    return standardize.region_faults(_region_lists(spark, d), "id", "types", "spans", "length", "total")


@query(f"WITH {REGION_LISTS} SELECT id || '|provirus_' || x.s || '_' || x.e AS sequence_id, id::VARCHAR AS parent_sequence_id, x.s || '-' || x.e AS coordinates, x.e - x.s + 1 AS region_length FROM (SELECT id, unnest(r) AS x FROM lf WHERE fault IS NULL) WHERE x.v")
def std_viral_regions(spark: SparkSession, d: str) -> DataFrame:
    """STD-8: the viral regions of the other orders, as rows."""
    out = standardize.viral_regions(_region_lists(spark, d), "id", "types", "spans", "length", "total", strict=False)
    return out.select("sequence_id", "parent_sequence_id", "coordinates", "region_length")


@query("SELECT tool, count(*) AS n, count(length) AS with_length, count(genus) AS with_genus FROM (SELECT 'orders' AS tool, o_totalprice AS length, NULL AS genus FROM orders UNION ALL SELECT 'part', NULL, p_type FROM part) GROUP BY 1")
def std_union(spark: SparkSession, d: str) -> DataFrame:
    """STD-12."""
    a = fr.table(spark, d, "orders").select(F.lit("orders").alias("tool"), F.col("o_totalprice").alias("length"))
    b = fr.table(spark, d, "part").select(F.lit("part").alias("tool"), F.col("p_type").alias("genus"))
    return standardize.union_evidence(a, b).groupBy("tool").agg(F.count("*").alias("n"), F.count("length").alias("with_length"), F.count("genus").alias("with_genus"))
