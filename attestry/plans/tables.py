"""Queries of the routing gate, interval logic, refinement and reference building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.shared import stored
from ..operators import gate, intervals, lineage, near_identity, reference, refine
from . import frames as fr
from .registry import query

GATE_SQL = f"""
WITH {fr.EVIDENCE}, {fr.HEADER},
seen AS (
  SELECT sample_id, sequence_id,
    count(*) FILTER (classification = 'virus') AS v, count(*) FILTER (classification = 'cellular') AS c, count(*) FILTER (classification = 'plasmid') AS p,
    count(DISTINCT tool) FILTER (classification = 'virus') AS nv,
    string_agg(DISTINCT tool, ',' ORDER BY tool) FILTER (classification = 'virus') AS tv, string_agg(DISTINCT tool, ',' ORDER BY tool) FILTER (classification = 'cellular') AS tc, string_agg(DISTINCT tool, ',' ORDER BY tool) FILTER (classification = 'plasmid') AS tp
  FROM evidence WHERE NOT review GROUP BY ALL),
audit AS (
  SELECT sample_id, sequence_id, coalesce(v, 0) AS virus_rows, coalesce(c, 0) AS cellular_rows, coalesce(p, 0) AS plasmid_rows,
    coalesce(tv, 'NA') AS virus_tools, coalesce(tc, 'NA') AS cellular_tools, coalesce(tp, 'NA') AS plasmid_tools,
    CASE WHEN coalesce(nv, 0) > 0 AND coalesce(c, 0) + coalesce(p, 0) > 0 THEN 'ambiguous' WHEN nv >= 2 THEN 'viral' WHEN nv = 1 THEN 'likely_viral' WHEN coalesce(c, 0) + coalesce(p, 0) > 0 THEN 'likely_nonviral' ELSE 'unresolved' END AS status
  FROM header LEFT JOIN seen USING (sample_id, sequence_id))
"""


@query(GATE_SQL + "SELECT *, status IN ('viral', 'likely_viral', 'ambiguous') AS advance FROM audit")
def gate_audit(spark: SparkSession, d: str) -> DataFrame:
    """GATE-1, 3, 4."""
    return gate.gate(fr.header(spark, d), fr.evidence(spark, d))


@query(GATE_SQL + "SELECT sample_id, count(*) AS records, count(*) FILTER (status = 'viral') AS viral, count(*) FILTER (status = 'likely_viral') AS likely_viral, count(*) FILTER (status = 'ambiguous') AS ambiguous, count(*) FILTER (status = 'likely_nonviral') AS likely_nonviral, count(*) FILTER (status = 'unresolved') AS unresolved, count(*) FILTER (status IN ('viral', 'likely_viral', 'ambiguous')) AS advanced FROM audit GROUP BY 1")
def gate_summary(spark: SparkSession, d: str) -> DataFrame:
    """GATE-4."""
    return gate.gate_summary(gate_audit(spark, d))


@query(f"WITH {fr.EVIDENCE}, x AS (SELECT sequence_id, classification FROM evidence UNION ALL SELECT sequence_id, 'cellular' FROM evidence WHERE tool = 'purchase' AND classification = 'virus' AND event_id % 3 > 0) SELECT classification, count(*) AS n, count(DISTINCT sequence_id) AS records FROM x GROUP BY 1")
def gate_internal_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """GATE-2."""
    e = fr.evidence(spark, d).withColumn("cellular_supported_loci", (F.col("event_id") % 3).cast("string"))
    out = gate.expand_internal_conflicts(e, gate.GatePolicy(mixed_source="purchase"))
    return out.groupBy("classification").agg(F.count("*").alias("n"), F.count_distinct("sequence_id").alias("records"))


ISLANDS = """islands AS (
  SELECT *, sum(new) OVER (PARTITION BY parent ORDER BY "start", "end" RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS locus FROM (
    SELECT *, CASE WHEN "start" <= max("end") OVER (PARTITION BY parent ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM calls))"""


@query(f'WITH {fr.CALLS}, {ISLANDS} SELECT parent, CAST(locus AS BIGINT) AS locus, count(*) AS calls, CAST(min("start") AS BIGINT) AS locus_start, CAST(max("end") AS BIGINT) AS locus_end FROM islands GROUP BY 1, 2')
def interval_islands(spark: SparkSession, d: str) -> DataFrame:
    """RFN-2."""
    out = intervals.overlap_groups(fr.calls(spark, d), ["parent"])
    return out.groupBy("parent", "locus").agg(F.count("*").alias("calls"), F.min("start").alias("locus_start"), F.max("end").alias("locus_end"))


@query(f"""WITH {fr.CALLS} SELECT a.parent, a.line AS line_a, b.line AS line_b, CAST(least(a."end", b."end") - greatest(a."start", b."start") + 1 AS BIGINT) AS shared FROM calls a JOIN calls b ON a.parent = b.parent AND a."start" <= b."end" AND b."start" <= a."end" AND a.line < b.line""")
def interval_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    """FN-4 and the bucketed overlap join."""
    c = fr.calls(spark, d).select("parent", "line", "start", "end")
    a, b = (c.select("parent", *[F.col(x).alias(f"{x}_{k}") for x in ("line", "start", "end")]) for k in "ab")
    both = intervals.overlap_join(a, b, ["parent"], ("start_a", "end_a"), ("start_b", "end_b"), 50).where("line_a < line_b")
    return both.select("parent", "line_a", "line_b", (F.least("end_a", "end_b") - F.greatest("start_a", "start_b") + 1).alias("shared"))


def _selected(spark: SparkSession, d: str) -> DataFrame:
    calls = refine.boundary_calls(fr.calls(spark, d), fr.records(spark, d), refine.RefinePolicy(), strict=False)
    return refine.select_boundaries(refine.group_calls(calls, refine.RefinePolicy()), strict=False)


SELECT_SQL = f"""WITH {fr.CALLS}, ok AS (SELECT DISTINCT parent, length, tool, "start", "end" FROM calls WHERE "end" <= length),
firm AS (SELECT *, sum(new) OVER (PARTITION BY parent ORDER BY "start", "end" RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM (
    SELECT *, CASE WHEN "start" <= max("end") OVER (PARTITION BY parent ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM ok WHERE tool <> 'advisory')),
adv AS (SELECT * FROM ok WHERE tool = 'advisory'),
near AS (SELECT DISTINCT a.*, f.g FROM adv a JOIN firm f ON a.parent = f.parent AND a."start" <= f."end" AND f."start" <= a."end"),
own AS (SELECT *, sum(new) OVER (PARTITION BY parent ORDER BY "start", "end" RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM (
    SELECT *, CASE WHEN "start" <= max("end") OVER (PARTITION BY parent ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM adv a WHERE NOT EXISTS (SELECT 1 FROM near n WHERE n.parent = a.parent AND n."start" = a."start" AND n."end" = a."end"))),
grouped AS (SELECT parent, length, tool, "start", "end", 0 AS own, g FROM firm UNION ALL SELECT parent, length, tool, "start", "end", 0, g FROM near UNION ALL SELECT parent, length, tool, "start", "end", 1, g FROM own),
per AS (SELECT parent, own, g, count(*) AS calls, count(DISTINCT ("start", "end")) AS boundaries, string_agg(DISTINCT tool, ',' ORDER BY tool) AS tools,
    min(("start", "end")) FILTER (tool = 'marker') AS cm, min(("start", "end")) FILTER (tool = 'quality') AS cq, min(("start", "end")) FILTER (tool = 'hallmark') AS ch, list(("start", "end")) FILTER (tool = 'advisory') AS advised,
    coalesce(min("start") FILTER (tool <> 'advisory'), min("start")) AS pos FROM grouped GROUP BY ALL),
chosen AS (SELECT *, CASE WHEN cm IS NOT NULL THEN 'marker' WHEN cq IS NOT NULL AND ch IS NOT NULL THEN 'quality' WHEN ch IS NOT NULL THEN NULL
    WHEN cq IS NOT NULL AND advised IS NOT NULL AND len(list_filter(advised, lambda a: greatest(0, least(cq[2], a[2]) - greatest(cq[1], a[1]) + 1) / (a[2] - a[1] + 1) >= 0.5)) > 0 THEN 'quality' END AS sel FROM per),
loci AS (SELECT *, CASE WHEN sel = 'marker' THEN cm WHEN sel = 'quality' THEN cq END AS c FROM chosen)
"""

STATUS_SQL = """CASE WHEN tools = 'advisory' THEN 'not_selected_advisory_only' WHEN sel IS NULL AND tools = 'quality' THEN 'not_selected_quality_only' WHEN sel IS NULL AND tools = 'advisory,quality' THEN 'not_selected_advisory_overlap_below_threshold'
    WHEN sel IS NULL THEN 'not_selected_hallmark_only' WHEN tools = 'advisory,quality' THEN 'selected_quality_with_advisory_support' WHEN calls = 1 THEN 'selected_single_tool' WHEN boundaries = 1 THEN 'selected_exact_agreement' ELSE 'selected_boundary_conflict' END"""


@query(SELECT_SQL + f"SELECT parent, row_number() OVER (PARTITION BY parent ORDER BY pos, own, g) AS locus, calls, tools, sel AS selected_tool, CAST(c[1] AS BIGINT) AS selected_start, CAST(c[2] AS BIGINT) AS selected_end, {STATUS_SQL} AS status FROM loci")
def refine_select(spark: SparkSession, d: str) -> DataFrame:
    """RFN-1, 3, 4, 5."""
    out = _selected(spark, d)
    return out.select("parent", "locus", "calls", F.array_join("tools", ",").alias("tools"), "selected_tool", "selected_start", "selected_end", "status")


@query(SELECT_SQL + f""", s AS (SELECT parent, c, sel, tools, {STATUS_SQL} AS status FROM loci),
p AS (SELECT parent, count(c) AS n, bool_and(coalesce(sel = 'hallmark', true)) AS hall, bool_and(tools = 'advisory') AS only_adv, bool_or(contains(tools, 'quality')) AS q FROM s GROUP BY 1)
SELECT o.o_orderkey AS parent, CAST(o.o_orderkey AS VARCHAR) AS sequence_id, 'input_record' AS record_type, CAST(1 AS BIGINT) AS "start", CAST(160 AS BIGINT) AS "end",
  CASE WHEN n IS NULL THEN 'unchanged_no_boundary_call' WHEN only_adv THEN 'unchanged_advisory_only' WHEN q THEN 'unchanged_quality_candidate_not_corroborated' ELSE 'unchanged_hallmark_only_not_allowed' END AS status
FROM orders o LEFT JOIN p ON o.o_orderkey = p.parent WHERE coalesce(n, 0) = 0
UNION ALL SELECT parent, parent || '|region_' || c[1] || '_' || c[2], 'region', CAST(c[1] AS BIGINT), CAST(c[2] AS BIGINT), status FROM s WHERE c IS NOT NULL""")
def refine_region_map(spark: SparkSession, d: str) -> DataFrame:
    """RFN-6, 7, 8."""
    agreed = refine.consensus_parents(fr.calls(spark, d), {"marker": (F.col("tool") == "marker") & (F.col("score") > 50_000), "quality": F.col("tool") == "quality", "hallmark": F.col("tool") == "hallmark"})
    return refine.region_map(fr.records(spark, d), _selected(spark, d), consensus=agreed)


ALONE = refine.RefinePolicy(hallmark_alone=True)
ALONE_SQL = SELECT_SQL.replace("WHEN ch IS NOT NULL THEN NULL", "WHEN ch IS NOT NULL THEN 'hallmark'").replace("WHEN sel = 'quality' THEN cq END AS c", "WHEN sel = 'quality' THEN cq WHEN sel = 'hallmark' THEN ch END AS c")
VETO_SQL = ALONE_SQL + f""", s AS (SELECT parent, c, sel, tools, calls, {STATUS_SQL} AS status FROM loci), agreed AS (SELECT parent FROM calls GROUP BY 1 HAVING bool_or(score > 20000) AND bool_or(line >= 3)),
p AS (SELECT s.parent, count(c) AS n, count(c) >= 2 AND bool_and(coalesce(sel = 'hallmark', true)) AND bool_or(agreed.parent IS NOT NULL) AS veto, bool_and(tools = 'advisory') AS only_adv, bool_or(contains(tools, 'quality')) AS q FROM s LEFT JOIN agreed ON agreed.parent = s.parent GROUP BY 1),
m AS (SELECT o.o_orderkey AS parent, CAST(o.o_orderkey AS VARCHAR) AS sequence_id, 'input_record' AS record_type, CAST(1 AS BIGINT) AS "start", CAST(160 AS BIGINT) AS "end",
  CASE WHEN n IS NULL THEN 'unchanged_no_boundary_call' WHEN veto THEN 'preserved_whole_record_consensus' WHEN only_adv THEN 'unchanged_advisory_only' WHEN q THEN 'unchanged_quality_candidate_not_corroborated' ELSE 'unchanged_hallmark_only_not_allowed' END AS status
FROM orders o LEFT JOIN p ON o.o_orderkey = p.parent WHERE coalesce(n, 0) = 0 OR veto
UNION ALL SELECT s.parent, s.parent || '|region_' || c[1] || '_' || c[2], 'region', CAST(c[1] AS BIGINT), CAST(c[2] AS BIGINT), status FROM s JOIN p ON p.parent = s.parent AND NOT veto WHERE c IS NOT NULL)"""


def _vetoed(spark: SparkSession, d: str, once=lambda loci: loci) -> tuple[DataFrame, DataFrame, DataFrame]:
    calls = refine.boundary_calls(fr.calls(spark, d), fr.records(spark, d), ALONE, strict=False)
    loci = once(refine.select_boundaries(refine.group_calls(calls, ALONE), ALONE, strict=False))
    agreed = refine.consensus_parents(fr.calls(spark, d), {"dear": F.col("score") > 20_000, "later": F.col("line") >= 3})
    return calls, loci, refine.region_map(fr.records(spark, d), loci, ALONE, agreed)


@query(VETO_SQL + " SELECT * FROM m")
def refine_veto(spark: SparkSession, d: str) -> DataFrame:
    """RFN-6, 7: regions where hallmarks decide alone, unless the sources agree on the whole record."""
    return _vetoed(spark, d)[2]


@query(VETO_SQL + """ SELECT 'S' AS sample_id, 'dna' AS input_type, (SELECT count(*) FROM orders) AS input_candidate_count, (SELECT count(*) FROM m WHERE record_type = 'input_record') AS unchanged_candidate_count, (SELECT count(DISTINCT parent) FROM m WHERE record_type = 'region') AS refined_parent_count, (SELECT count(*) FROM m WHERE record_type = 'region') AS refined_region_count,
  0 AS full_span_call_preserved_count, (SELECT count(*) FROM m WHERE status = 'preserved_whole_record_consensus') AS whole_record_consensus_veto_count, (SELECT count(*) FROM ok) AS boundary_call_count, count(*) FILTER (status = 'selected_boundary_conflict') AS boundary_conflict_count, CAST(coalesce(sum(calls) FILTER (tools = 'hallmark'), 0) AS BIGINT) AS hallmark_only_boundary_call_count,
  count(*) FILTER (status = 'not_selected_hallmark_only') AS hallmark_only_locus_skipped_count, (SELECT count(*) FROM ok WHERE tool = 'advisory') AS advisory_boundary_call_count, count(*) FILTER (status = 'not_selected_advisory_only') AS advisory_only_locus_skipped_count, count(*) FILTER (status IN ('not_selected_quality_only', 'not_selected_advisory_overlap_below_threshold')) AS quality_only_locus_skipped_count,
  count(*) FILTER (status = 'selected_quality_with_advisory_support') AS quality_advisory_supported_locus_count, 0.5::DOUBLE AS advisory_min_overlap_fraction, true AS hallmark_alone_allowed, 1::BIGINT AS evidence_file_count FROM s""")
def refine_run_summary(spark: SparkSession, d: str) -> DataFrame:
    """RFN-8: the run's figures."""
    calls, loci, regions = _vetoed(spark, d, once=stored)
    return refine.run_summary(fr.records(spark, d), calls, loci, regions, ALONE, "S", "dna", 1)


@query(SELECT_SQL + f", s AS (SELECT {STATUS_SQL} AS status FROM loci) SELECT status, count(*) AS n FROM s GROUP BY 1")
def refine_summary(spark: SparkSession, d: str) -> DataFrame:
    """RFN-8."""
    return _selected(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@query(f"""WITH {fr.EVIDENCE} SELECT sequence_id AS parent FROM evidence GROUP BY 1 HAVING bool_or(tool = 'view' AND evidence_strength = 'strong') AND bool_or(tool = 'click' AND evidence_strength <> 'weak')""")
def refine_consensus(spark: SparkSession, d: str) -> DataFrame:
    """RFN-6."""
    e = fr.evidence(spark, d).withColumnRenamed("sequence_id", "parent")
    return refine.consensus_parents(e, {"a": (F.col("tool") == "view") & (F.col("evidence_strength") == "strong"), "b": (F.col("tool") == "click") & (F.col("evidence_strength") != "weak")})


LCA_SQL = f"""WITH {fr.CATALOG}, members AS (SELECT l_partkey AS part, l_suppkey, region, nation, supplier FROM lineitem JOIN catalog ON l_suppkey = path_id),
g AS (SELECT part, l_suppkey % 7 AS grp, min(region) AS r1, max(region) AS r2, min(nation) AS n1, max(nation) AS n2, min(supplier) AS s1, max(supplier) AS s2, count(*) AS rows FROM members GROUP BY 1, 2),
h AS (SELECT part, rows, CASE WHEN r1 = r2 THEN r1 END AS r, CASE WHEN r1 = r2 AND n1 = n2 THEN n1 END AS n, CASE WHEN r1 = r2 AND n1 = n2 AND s1 = s2 THEN s1 END AS s, CASE WHEN r1 <> r2 THEN 1 WHEN n1 <> n2 THEN 2 WHEN s1 <> s2 THEN 3 END AS c FROM g),
i AS (SELECT part, min(r) AS r, max(r) AS rx, min(n) AS n, max(n) AS nx, min(s) AS s, max(s) AS sx, min(c) AS below, count(*) AS groups, CAST(sum(rows) AS BIGINT) AS members, count(c) AS gic FROM h GROUP BY 1),
j AS (SELECT *, least(coalesce(CASE WHEN r <> rx THEN 1 WHEN n <> nx THEN 2 WHEN s <> sx THEN 3 END, 9), coalesce(below, 9)) AS low FROM i),
lca AS (SELECT part, CASE WHEN low > 1 THEN r END AS region, CASE WHEN low > 2 THEN n END AS nation, CASE WHEN low > 3 THEN s END AS supplier, groups, CAST(CASE WHEN low = 9 THEN 0 ELSE low END AS INTEGER) AS conflict_rank, members, gic AS groups_in_conflict FROM j)
"""


def _lca(spark: SparkSession, d: str) -> DataFrame:
    return lineage.balanced_lca(fr.members(spark, d).withColumn("grp", F.col("path_id") % 7), "part", "grp", fr.RANKS)


@query(LCA_SQL + "SELECT * FROM lca")
def ref_balanced_lca(spark: SparkSession, d: str) -> DataFrame:
    """REF-4."""
    return _lca(spark, d)


@query(LCA_SQL + """SELECT part, 'r__' || coalesce(region, '') || ';n__' || coalesce(nation, '') || ';s__' || coalesce(supplier, '') AS lineage, CASE WHEN supplier IS NOT NULL THEN 'supplier' WHEN nation IS NOT NULL THEN 'nation' WHEN region IS NOT NULL THEN 'region' ELSE 'unclassified' END AS deepest_rank,
CASE conflict_rank WHEN 1 THEN 'region' WHEN 2 THEN 'nation' WHEN 3 THEN 'supplier' ELSE '' END AS conflict_name FROM lca""")
def ref_lookup(spark: SparkSession, d: str) -> DataFrame:
    """REF-5, FN-5."""
    return reference.lookup_projection(_lca(spark, d), fr.RANKS, ("r__", "n__", "s__")).select("part", "lineage", "deepest_rank", "conflict_name")


@query(LCA_SQL + """SELECT 'representatives' AS metric, CAST(count(*) AS DOUBLE) AS value FROM lca UNION ALL SELECT 'members', CAST(sum(members) AS DOUBLE) FROM lca UNION ALL SELECT 'conflicts', CAST(count(*) FILTER (conflict_rank > 0) AS DOUBLE) FROM lca""")
def ref_summary(spark: SparkSession, d: str) -> DataFrame:
    """REF-6, 8."""
    return reference.long_metrics(_lca(spark, d), {"representatives": F.count("*"), "members": F.sum("members"), "conflicts": F.count_if(F.col("conflict_rank") > 0)})


@query(f"""WITH {fr.CATALOG}, e AS (SELECT region, nation, supplier, CAST(unnest([1, 2, 3]) AS INTEGER) AS rank, unnest([region, nation, supplier]) AS taxon FROM catalog)
SELECT rank, taxon, CASE WHEN count(DISTINCT region) = 1 THEN min(region) END AS region, CASE WHEN count(DISTINCT nation) = 1 THEN min(nation) END AS nation, CASE WHEN count(DISTINCT supplier) = 1 THEN min(supplier) END AS supplier, count(*) AS paths FROM e GROUP BY 1, 2""")
def tax_catalog_consensus(spark: SparkSession, d: str) -> DataFrame:
    """TAX-2."""
    return lineage.catalog_consensus(fr.catalog(spark, d), fr.RANKS)


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS representative, count(*) OVER (PARTITION BY text) AS members FROM documents")
def ref_dedup_exact(spark: SparkSession, d: str) -> DataFrame:
    """REF-1."""
    return reference.dedup_exact(fr.table(spark, d, "documents"), "doc_id", "text")


@query("""WITH o AS (SELECT l_partkey AS part, CASE l_returnflag WHEN 'A' THEN 'CHROMOSOME' WHEN 'N' THEN CASE WHEN l_linestatus = 'O' THEN 'PLASMID' ELSE 'CHROMOSOME' END WHEN 'R' THEN CASE WHEN l_quantity < 49 THEN 'CHROMOSOME' END END AS label FROM lineitem)
SELECT part, CASE WHEN bool_or(label IS NULL) THEN 'UNSUPPORTED' WHEN count(DISTINCT label) = 1 THEN min(label) WHEN count(DISTINCT label) > 1 THEN 'SHARED' ELSE 'UNPLACED' END AS reference_class, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels FROM o GROUP BY 1""")
def ref_classify(spark: SparkSession, d: str) -> DataFrame:
    """REF-7."""
    x = fr.table(spark, d, "lineitem").withColumnRenamed("l_partkey", "part")
    label = F.when(F.col("l_returnflag") == "A", "CHROMOSOME").when(F.col("l_returnflag") == "N", F.when(F.col("l_linestatus") == "O", "PLASMID").otherwise("CHROMOSOME")).when(F.col("l_returnflag") == "R", F.when(F.col("l_quantity") < 49, "CHROMOSOME"))
    return reference.classify_by_occurrence(x, "part", label)


@query("SELECT l_returnflag AS flag, count(*) AS inputs, count(DISTINCT l_partkey) AS representatives, round(100 * count(DISTINCT l_partkey) / count(*), 4) AS retained_percent FROM lineitem GROUP BY 1")
def ref_retained(spark: SparkSession, d: str) -> DataFrame:
    """REF-9."""
    return reference.retained(fr.members(spark, d), "part", "flag")


@query("SELECT p_partkey AS part, p_brand AS brand, n AS member_count FROM part JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON p_partkey = l_partkey")
def ref_member_counts(spark: SparkSession, d: str) -> DataFrame:
    """REF-9."""
    x = fr.table(spark, d, "lineitem").select(F.col("l_partkey").alias("part"))
    return reference.representative_metadata(x, fr.table(spark, d, "part").select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("brand")), "part", "part").select("part", "brand", "member_count")


@query("SELECT 'VIRAL|' || p_partkey AS id, 'viral' AS reference_class, p_name AS name, CAST(NULL AS DOUBLE) AS balance FROM part UNION ALL SELECT 'CELLULAR|' || s_suppkey, 'cellular', NULL, s_acctbal FROM supplier")
def ref_manifest(spark: SparkSession, d: str) -> DataFrame:
    """REF-10."""
    a = fr.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    b = fr.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return reference.competitive_manifest(a, b, "id").select("id", "reference_class", "name", "balance")


@query("""WITH k AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('seed' || chr(9) || c_custkey), c_custkey) AS k FROM customer),
p AS (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY k, c_mktsegment, c_custkey) AS position FROM k)
SELECT c_custkey, c_mktsegment, position, CAST(CASE WHEN position <= 10 THEN 10 WHEN position <= 50 THEN 50 ELSE 200 END AS INTEGER) AS tier FROM p WHERE position <= 200""")
def ref_nested_tiers(spark: SparkSession, d: str) -> DataFrame:
    """REF-11, FN-8."""
    return reference.nested_tiers(fr.table(spark, d, "customer"), "c_custkey", "c_mktsegment", [10, 50, 200], "seed")


@query("SELECT l_suppkey || '|' || l_orderkey AS catalog_id, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1")
def ref_catalog(spark: SparkSession, d: str) -> DataFrame:
    """REF-12."""
    x = fr.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("assembly"), F.col("l_orderkey").alias("record"))
    m = fr.table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("assembly"))
    return reference.build_catalog(x, m, "assembly", "record")[0].groupBy("catalog_id").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT p_partkey AS part, CASE p_size % 4 WHEN 0 THEN 'A:' || p_brand WHEN 1 THEN p_name || '; X1 (1.20)' WHEN 2 THEN 'X' || p_size || '; ; Y2' ELSE '' END AS t FROM part),
e AS (SELECT part, trim(unnest(string_split(t, ';'))) AS e FROM a), f AS (SELECT part, e, contains(e, ':') AS lab, trim(CASE WHEN contains(e, ':') THEN list_last(string_split(e, ':')) ELSE e END) AS v FROM e WHERE e <> '')
SELECT part, count(*) AS entries, count(*) FILTER (lab) AS labelled, count(*) FILTER (regexp_matches(v, '\\(\\d+\\.\\d+\\)$')) AS with_coordinates, count(*) FILTER (NOT regexp_matches(regexp_replace(v, '\\s*\\(\\d+\\.\\d+\\)$', ''), '^[A-Za-z0-9_.]+$')) AS malformed FROM f GROUP BY 1""")
def ref_accessions(spark: SparkSession, d: str) -> DataFrame:
    """REF-13."""
    m = F.col("p_size") % 4
    text = F.when(m == 0, F.concat(F.lit("A:"), "p_brand")).when(m == 1, F.concat("p_name", F.lit("; X1 (1.20)"))).when(m == 2, F.concat(F.lit("X"), F.col("p_size").cast("string"), F.lit("; ; Y2"))).otherwise("")
    return reference.accession_audit(fr.table(spark, d, "part").select(F.col("p_partkey").alias("part"), text.alias("t")), "part", "t")


@query("SELECT CAST(p_partkey AS VARCHAR) AS accession, trim(p_name) AS species, CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END AS genus FROM part")
def ref_headers(spark: SparkSession, d: str) -> DataFrame:
    """REF-13: a table with headers in other spellings."""
    p = fr.table(spark, d, "part")
    x = p.select(F.col("p_partkey").alias("Virus GENBANK accession(s), all"), F.concat(F.lit(" "), "p_name").alias("SPECIES_"), F.when(F.col("p_size") % 2 > 0, F.col("p_brand")).alias(" genus"), F.col("p_type").alias("Sub-genus"))
    out = reference.by_headers(x, ["Virus GENBANK accession", "Species", "Genus"], ("Virus GENBANK accession",))
    return out.toDF("accession", "species", "genus")


@query("""WITH t AS (SELECT p_partkey AS part, 'f__' || p_brand || CASE WHEN p_size % 3 = 0 THEN ';g__NA' ELSE ';g__' || p_type END AS lin, CASE WHEN p_size % 2 = 0 THEN 'NA' ELSE p_name END AS a FROM part)
SELECT part, coalesce(CASE WHEN a <> 'NA' THEN a END, CAST(part AS VARCHAR)) AS key, regexp_extract(lin, 'f__([^;]*)', 1) AS family, nullif(regexp_extract(lin, 'g__([^;]*)', 1), 'NA') AS genus FROM t""")
def ref_metadata(spark: SparkSession, d: str) -> DataFrame:
    """REF-3, FN-1, FN-2."""
    p = fr.table(spark, d, "part")
    lin = F.concat(F.lit("f__"), "p_brand", F.when(F.col("p_size") % 3 == 0, ";g__NA").otherwise(F.concat(F.lit(";g__"), "p_type")))
    x = p.select(F.col("p_partkey").alias("part"), F.when(F.col("p_size") % 2 == 0, "NA").otherwise(F.col("p_name")).alias("a"), lin.alias("lin"))
    return reference.normalize_metadata(x, ["a", "part"], "lin", {"family": "f__", "genus": "g__"}).select("part", "key", "family", "genus")


@query()
def ref_dedup_near(spark: SparkSession, d: str) -> DataFrame:
    """REF-2: texts of each language by alignment, longest first (no SQL; tested against full alignment of all pairs)."""
    return near_identity.dedup_near(fr.table(spark, d, "documents"), "doc_id", "text", "lang")
