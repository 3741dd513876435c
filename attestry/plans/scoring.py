"""Queries of hit preparation, locus scoring and hierarchical votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hits as h
from ..operators import intervals, lineage
from . import frames as fr
from .registry import query


@query("SELECT reference_id, p_name AS name, p_brand AS brand FROM (SELECT DISTINCT l_partkey AS reference_id FROM lineitem) LEFT JOIN part ON p_partkey = reference_id")
def hit_reference_subset(spark: SparkSession, d: str) -> DataFrame:
    """HIT-1."""
    x = fr.table(spark, d, "lineitem").select(F.col("l_partkey").alias("sseqid"))
    m = fr.table(spark, d, "part").select(F.col("p_partkey").alias("reference_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return h.reference_subset(x, m)


@query("SELECT reference_class, count(*) AS n, count(brand) AS with_brand, count(balance) AS with_balance FROM (SELECT 'viral' AS reference_class, p_brand AS brand, NULL AS balance FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'O' UNION ALL SELECT 'cellular', NULL, s_acctbal FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_linestatus <> 'O') GROUP BY 1")
def hit_prepared(spark: SparkSession, d: str) -> DataFrame:
    """HIT-2."""
    x = fr.table(spark, d, "lineitem")
    a = x.where("l_linestatus = 'O'").select(F.col("l_partkey").alias("reference_id"), "l_orderkey")
    b = x.where("l_linestatus <> 'O'").select(F.col("l_suppkey").alias("reference_id"), "l_orderkey")
    am = fr.table(spark, d, "part").select(F.col("p_partkey").alias("reference_id"), F.col("p_brand").alias("brand"))
    bm = fr.table(spark, d, "supplier").select(F.col("s_suppkey").alias("reference_id"), F.col("s_acctbal").alias("balance"))
    return h.prepare_hits(a, am, b, bm).groupBy("reference_class").agg(F.count("*").alias("n"), F.count("brand").alias("with_brand"), F.count("balance").alias("with_balance"))


@query(f"WITH {fr.HITS}, ok AS (SELECT *, max(bitscore) OVER (PARTITION BY qseqid) AS best FROM hits WHERE bitscore >= 50 AND qcovhsp >= 30) SELECT qseqid, sseqid, line, bitscore FROM ok WHERE bitscore >= (1 - 5 / 100) * best")
def hit_prefilter(spark: SparkSession, d: str) -> DataFrame:
    """HIT-3."""
    return h.prefilter(fr.hits(spark, d)).select("qseqid", "sseqid", "line", "bitscore")


@query(f"WITH {fr.HITS}, r AS (SELECT *, row_number() OVER (PARTITION BY qseqid, reference_class ORDER BY bitscore DESC, qcovhsp DESC, sseqid) AS n FROM hits) SELECT qseqid, reference_class, sseqid, bitscore, qcovhsp FROM r WHERE n = 1")
def hit_best(spark: SparkSession, d: str) -> DataFrame:
    """HIT-4."""
    return h.best_hit(fr.hits(spark, d), ["qseqid", "reference_class"])


BEST_SQL = f"""WITH {fr.HITS}, best AS (SELECT qseqid, line, max(bitscore) FILTER (reference_class = 'viral') AS viral_score, max(bitscore) FILTER (reference_class = 'cellular') AS cellular_score FROM (SELECT *, line % 3 AS g FROM hits) GROUP BY qseqid, line),
pair AS (SELECT qseqid, line % 3 AS locus, max(viral_score) AS viral_score, max(cellular_score) AS cellular_score FROM best GROUP BY ALL),
called AS (SELECT *, CASE WHEN viral_score IS NULL AND cellular_score IS NULL THEN NULL WHEN cellular_score IS NULL THEN 1.0 WHEN viral_score IS NULL THEN -1.0 ELSE (viral_score - cellular_score) / greatest(viral_score, cellular_score) END AS margin FROM pair),
loci AS (SELECT *, CASE WHEN margin IS NULL THEN 'uninformative' WHEN viral_score IS NOT NULL AND cellular_score IS NOT NULL AND abs(margin) + 1e-12 < 0.05 THEN 'ambiguous' WHEN margin > 0 THEN 'viral_supported' ELSE 'cellular_supported' END AS classification FROM called)
"""


def _loci(spark: SparkSession, d: str) -> DataFrame:
    x = fr.hits(spark, d).groupBy("qseqid", (F.col("line") % 3).alias("locus")).agg(F.max(F.when(F.col("reference_class") == "viral", F.col("bitscore"))).alias("viral_score"), F.max(F.when(F.col("reference_class") == "cellular", F.col("bitscore"))).alias("cellular_score"))
    return h.competitive_call(x)


@query(BEST_SQL + "SELECT qseqid, locus, classification, round(margin, 9) AS margin FROM loci")
def locus_competitive(spark: SparkSession, d: str) -> DataFrame:
    """LOC-2."""
    return _loci(spark, d).select("qseqid", "locus", "classification", F.round("margin", 9).alias("margin"))


@query(f"""WITH RECURSIVE {fr.CALLS}, o AS (SELECT parent * 10 + line AS orf, parent, line % 2 AS strand, min("start") AS "start", min("start") + 30 + line % 3 AS "end", tool FROM calls GROUP BY parent, line, tool),
e AS (SELECT a.orf AS a, b.orf AS b FROM o a JOIN o b ON a.parent = b.parent AND a.strand = b.strand AND a.tool <> b.tool AND a.orf <> b.orf AND a."start" <= b."end" AND b."start" <= a."end"
  AND (CASE WHEN a.strand = 0 THEN a."start" = b."start" ELSE a."end" = b."end" END OR (least(a."end", b."end") - greatest(a."start", b."start") + 1) / greatest(a."end" - a."start" + 1, b."end" - b."start" + 1) >= 0.8)),
w AS (SELECT orf, orf AS root FROM o UNION SELECT e.b, w.root FROM w JOIN e ON e.a = w.orf)
SELECT orf, min(root) AS locus FROM w GROUP BY 1""")
def locus_components(spark: SparkSession, d: str) -> DataFrame:
    """LOC-1: calls of different tools on one strand of an order."""
    c = fr.calls(spark, d).groupBy("parent", "line", "tool").agg(F.min("start").alias("start"))
    c = c.withColumn("end", F.col("start") + 30 + F.col("line") % 3)
    o = c.select((F.col("parent") * 10 + F.col("line")).alias("orf"), F.col("parent").alias("sequence_id"), F.when(F.col("line") % 2 == 0, "-").otherwise("+").alias("strand"), "start", "end", F.array("tool").alias("callers"))
    return h.build_loci(o).select("orf", "locus")


@query(f"""WITH {fr.CALLS}, s AS (SELECT parent, line, score, "start", CASE WHEN score < 15000 THEN 'cellular' WHEN score < 30000 THEN 'neutral' ELSE 'viral' END AS state FROM calls),
r AS (SELECT *, sum(CASE WHEN state = 'cellular' THEN 1 ELSE 0 END) OVER w AS c, sum(CASE WHEN state = 'neutral' THEN 1 ELSE 0 END) OVER w AS n FROM s WINDOW w AS (PARTITION BY parent ORDER BY "start", line, score ROWS UNBOUNDED PRECEDING)),
v AS (SELECT *, CASE WHEN c = lag(c) OVER x AND n - lag(n) OVER x <= 1 THEN 0 ELSE 1 END AS b FROM r WHERE state = 'viral' WINDOW x AS (PARTITION BY parent ORDER BY "start", line, score)),
k AS (SELECT *, sum(b) OVER (PARTITION BY parent ORDER BY "start", line, score ROWS UNBOUNDED PRECEDING) AS cluster FROM v)
SELECT parent, CAST(cluster AS BIGINT) AS cluster, count(*) AS viral_count, CAST(min("start") AS BIGINT) AS cluster_start FROM k GROUP BY 1, 2 HAVING count(*) >= 2""")
def locus_clusters(spark: SparkSession, d: str) -> DataFrame:
    """LOC-5."""
    state = F.when(F.col("score") < 15000, "cellular").when(F.col("score") < 30000, "neutral").otherwise("viral")
    out = intervals.gap_clusters(fr.calls(spark, d), ["parent"], ["start", "line", "score"], state)
    return out.groupBy("parent", "cluster", "viral_count").agg(F.min("start").alias("cluster_start"))


@query(f"""WITH {fr.CALLS}, k AS (SELECT parent, min("start") AS cs, max("end") AS ce FROM calls WHERE tool IN ('marker', 'quality') GROUP BY 1)
SELECT k.parent, CAST(cs AS BIGINT) AS cluster_start, CAST(ce AS BIGINT) AS cluster_end, count(*) FILTER (c."end" < cs) AS left_loci, count(*) FILTER (c."start" > ce) AS right_loci,
  CASE WHEN count(*) FILTER (c."end" < cs) > 0 AND count(*) FILTER (c."start" > ce) > 0 THEN 'both_sides' WHEN count(*) FILTER (c."end" < cs) > 0 THEN 'left_only' WHEN count(*) FILTER (c."start" > ce) > 0 THEN 'right_only' ELSE 'none' END AS flank_status
FROM k LEFT JOIN calls c ON c.parent = k.parent AND c.tool = 'hallmark' GROUP BY k.parent, cs, ce""")
def locus_flanks(spark: SparkSession, d: str) -> DataFrame:
    """LOC-6."""
    c = fr.calls(spark, d)
    k = c.where("tool in ('marker', 'quality')").groupBy("parent").agg(F.min("start").alias("cluster_start"), F.max("end").alias("cluster_end"))
    return intervals.flank_counts(k, c, ["parent"], F.col("tool") == "hallmark")


VOTE_SQL = """v AS ({votes}),
n1 AS (SELECT k, region AS x, sum(w) AS w FROM v GROUP BY 1, 2),
s1 AS (SELECT *, sum(w) OVER (PARTITION BY k) AS t, w / sum(w) OVER (PARTITION BY k) AS share, count(*) OVER (PARTITION BY k) AS n, row_number() OVER (PARTITION BY k ORDER BY w DESC, x DESC) AS r FROM n1),
w1 AS (SELECT * FROM s1 WHERE r = 1),
n2 AS (SELECT v.k, v.region, v.nation AS x, sum(v.w) AS w FROM v JOIN w1 ON v.k = w1.k AND v.region = w1.x AND w1.share + 1e-12 >= 0.6 WHERE v.nation IS NOT NULL GROUP BY 1, 2, 3),
s2 AS (SELECT *, sum(w) OVER (PARTITION BY k) AS t, w / sum(w) OVER (PARTITION BY k) AS share, count(*) OVER (PARTITION BY k) AS n, row_number() OVER (PARTITION BY k ORDER BY w DESC, x DESC) AS r FROM n2),
w2 AS (SELECT * FROM s2 WHERE r = 1),
n3 AS (SELECT v.k, v.supplier AS x, sum(v.w) AS w FROM v JOIN w2 ON v.k = w2.k AND v.region = w2.region AND v.nation = w2.x AND w2.share + 1e-12 >= 0.6 WHERE v.supplier IS NOT NULL GROUP BY 1, 2),
s3 AS (SELECT *, sum(w) OVER (PARTITION BY k) AS t, w / sum(w) OVER (PARTITION BY k) AS share, count(*) OVER (PARTITION BY k) AS n, row_number() OVER (PARTITION BY k ORDER BY w DESC, x DESC) AS r FROM n3),
w3 AS (SELECT * FROM s3 WHERE r = 1),
every AS (SELECT k, sum(w) AS whole, bool_or(inherited) AS inherited FROM v GROUP BY 1),
a AS (SELECT w1.k, w1.w AS q1, w1.t AS t1, w2.w AS q2, w2.t AS t2, w3.w AS q3, w3.t AS t3, w1.x AS x1, w1.share AS p1, w1.n AS m1, w2.x AS x2, w2.share AS p2, w2.n AS m2, w3.x AS x3, w3.share AS p3, w3.n AS m3, w1.share + 1e-12 >= 0.6 AS a1, coalesce(w2.share + 1e-12 >= 0.6, false) AS a2, coalesce(w3.share + 1e-12 >= 0.6, false) AS a3
  FROM w1 LEFT JOIN w2 ON w1.k = w2.k LEFT JOIN w3 ON w1.k = w3.k)
SELECT k AS {key}, CASE WHEN NOT a1 THEN '' WHEN NOT a2 THEN x1 WHEN NOT a3 THEN x1 || ';' || x2 ELSE x1 || ';' || x2 || ';' || x3 END AS path, CAST(CASE WHEN NOT a1 THEN 0 WHEN NOT a2 THEN 1 WHEN NOT a3 THEN 2 ELSE 3 END AS INTEGER) AS depth,
  round(CASE WHEN NOT a1 THEN 1.0 WHEN NOT a2 THEN p1 WHEN NOT a3 THEN p2 ELSE p3 END, 9) AS support, round(CASE WHEN NOT a1 THEN whole WHEN NOT a2 THEN q1 WHEN NOT a3 THEN q2 ELSE q3 END, 6) AS supporting, round(CASE WHEN NOT a1 THEN whole WHEN NOT a2 THEN t1 WHEN NOT a3 THEN t2 ELSE t3 END, 6) AS eligible,
  coalesce(CASE WHEN NOT a1 THEN m1 > 1 WHEN NOT a2 THEN m2 > 1 WHEN NOT a3 THEN m3 > 1 ELSE false END, false) OR inherited AS conflict FROM a JOIN every USING (k)"""


def _flat(df: DataFrame) -> DataFrame:
    rounded = {c: F.round(c, n) for c, n in (("support", 9), ("supporting", 6), ("eligible", 6))}
    return df.withColumns({"path": F.array_join("path", ";"), **rounded})


@query(f"WITH {fr.CATALOG}, d AS (SELECT l_partkey AS k, region, nation, CASE WHEN l_suppkey % 5 > 0 THEN supplier END AS supplier, max(l_extendedprice) AS best FROM lineitem JOIN catalog ON l_suppkey = path_id GROUP BY 1, 2, 3, 4), " + VOTE_SQL.format(key="part", votes="SELECT *, best / max(best) OVER (PARTITION BY k) AS w, false AS inherited FROM d"))
def locus_weighted_vote(spark: SparkSession, d: str) -> DataFrame:
    """LOC-3: order lines as hits of their part; one vote for each distinct lineage, weighted by its best price."""
    x = fr.table(spark, d, "lineitem").join(fr.catalog(spark, d), F.col("l_suppkey") == F.col("path_id"))
    x = x.select(F.col("l_partkey").alias("part"), "region", "nation", F.when(F.col("l_suppkey") % 5 > 0, F.col("supplier")).alias("supplier"), F.col("l_extendedprice").alias("score"), "l_orderkey")
    return _flat(lineage.hierarchical_vote(lineage.distinct_lineages(x, ["part"], fr.RANKS, "score", "l_orderkey"), ["part"], fr.RANKS, "vote_weight"))


@query(f"WITH {fr.CATALOG}, " + VOTE_SQL.format(key="orderkey", votes="SELECT l_orderkey AS k, region, nation, supplier, 1.0::DOUBLE AS w, l_discount > 0.09 AS inherited FROM lineitem JOIN catalog ON l_suppkey = path_id"))
def locus_count_vote(spark: SparkSession, d: str) -> DataFrame:
    """LOC-7: every order line one vote; eligible and supporting votes, and the conflict that a vote may bring."""
    x = fr.table(spark, d, "lineitem").join(fr.catalog(spark, d), F.col("l_suppkey") == F.col("path_id")).select(F.col("l_orderkey").alias("orderkey"), *fr.RANKS, F.lit(1.0).alias("w"), (F.col("l_discount") > 0.09).alias("inherited"))
    return _flat(lineage.hierarchical_vote(x, ["orderkey"], fr.RANKS, "w", inherited="inherited"))


@query(f"""WITH {fr.CATALOG}, {fr.HITS}, r AS (SELECT *, row_number() OVER (PARTITION BY qseqid ORDER BY bitscore DESC, line) AS n, max(bitscore) OVER (PARTITION BY qseqid) AS top FROM hits JOIN catalog USING (path_id)),
b AS (SELECT qseqid, region, nation, supplier, bitscore FROM r WHERE n = 1),
c AS (SELECT r.qseqid, min(CASE WHEN r.region <> b.region THEN 1 WHEN r.nation <> b.nation THEN 2 WHEN r.supplier <> b.supplier THEN 3 END) AS c FROM r JOIN b ON r.qseqid = b.qseqid AND r.n > 1 AND r.bitscore >= 0.95 * b.bitscore GROUP BY 1)
SELECT b.qseqid, CAST(coalesce(c, 0) AS INTEGER) AS conflict_rank, CASE coalesce(c, 0) WHEN 0 THEN region || ';' || nation || ';' || supplier WHEN 1 THEN '' WHEN 2 THEN region ELSE region || ';' || nation END AS path FROM b LEFT JOIN c ON b.qseqid = c.qseqid""")
def locus_caller_conflict(spark: SparkSession, d: str) -> DataFrame:
    """LOC-4."""
    from pyspark.sql import Window as W

    x = fr.hits(spark, d).join(fr.catalog(spark, d), "path_id").withColumn("n", F.row_number().over(W.partitionBy("qseqid").orderBy(F.desc("bitscore"), "line")))
    path = F.array(*fr.RANKS)
    best = x.where("n = 1").select("qseqid", path.alias("path"), F.col("bitscore").alias("score"))
    out = h.caller_conflict(best, x.where("n > 1").select("qseqid", path.alias("alt_path"), F.col("bitscore").alias("alt_score")), ["qseqid"])
    return out.select("qseqid", "conflict_rank", F.array_join("path", ";").alias("path"))


@query(f"""WITH {fr.HITS}, l AS (SELECT qseqid, CASE WHEN reference_class = 'viral' THEN 'viral_supported' ELSE 'cellular_supported' END AS classification, bitscore AS score, qcovhsp AS qcov, qcovhsp AS scov, 0.7 AS margin, subject_class FROM hits),
s AS (SELECT qseqid, count(*) AS loci, count(*) FILTER (classification = 'viral_supported') AS v, count(*) FILTER (classification = 'cellular_supported') AS c, bool_or(classification = 'viral_supported' AND score >= 100 AND qcov >= 70) AS strict FROM l GROUP BY 1),
k AS (SELECT qseqid, count(*) AS k FROM l WHERE classification = 'viral_supported' AND score >= 300 GROUP BY 1),
cc AS (SELECT qseqid, subject_class, count(*) AS n FROM l WHERE classification = 'cellular_supported' GROUP BY 1, 2),
t AS (SELECT qseqid, string_agg(subject_class || ':' || n, ',' ORDER BY subject_class || ':' || n) AS oc, CASE WHEN count(*) FILTER (n = m) = 1 THEN min(subject_class) FILTER (n = m) ELSE 'TIED' END AS dom FROM (SELECT *, max(n) OVER (PARTITION BY qseqid) AS m FROM cc) GROUP BY 1),
p AS (SELECT s.*, coalesce(k, 0) AS k, coalesce(oc, '') AS oc, coalesce(dom, '') AS dom, CASE WHEN v >= 2 AND c = 0 THEN 'predominantly_viral' WHEN v = 1 AND c = 0 AND strict THEN 'single_locus_viral_rescue' WHEN coalesce(k, 0) > 0 AND c > 0 THEN 'localized_viral_cluster' WHEN v = 1 THEN 'isolated_viral_locus' WHEN v >= 2 THEN 'mixed_distributed' WHEN c > 0 THEN 'predominantly_cellular' ELSE 'unresolved' END AS pattern FROM s LEFT JOIN k USING (qseqid) LEFT JOIN t USING (qseqid))
SELECT qseqid, loci, v AS viral_loci, c AS cellular_loci, k AS clusters, pattern, CASE WHEN pattern IN ('predominantly_viral', 'single_locus_viral_rescue', 'localized_viral_cluster') THEN 'virus' WHEN c > 0 THEN 'cellular' ELSE '' END AS classification, oc AS opposing_classes, dom AS dominant_class FROM p""")
def locus_origin_patterns(spark: SparkSession, d: str) -> DataFrame:
    """LOC-8, 9, 10."""
    x = fr.hits(spark, d).select("qseqid", F.when(F.col("reference_class") == "viral", "viral_supported").otherwise("cellular_supported").alias("classification"), F.col("bitscore").alias("score"), F.col("qcovhsp").alias("qcov"), F.col("qcovhsp").alias("scov"), F.lit(0.7).alias("margin"), F.col("subject_class").alias("opposing_class"))
    clusters = x.where("classification = 'viral_supported' and score >= 300").select("qseqid")
    return h.origin_patterns(x, clusters, ["qseqid"])


@query(f"WITH {fr.HITS}, a AS (SELECT qseqid, line, bitscore / max(bitscore) OVER (PARTITION BY qseqid) AS rel, row_number() OVER (PARTITION BY qseqid, path_id ORDER BY bitscore DESC, sseqid) = 1 AS votes FROM hits) SELECT qseqid, line, votes, round(rel, 9) AS relative_score, round(CASE WHEN votes THEN rel ELSE 0.0 END, 9) AS vote_weight FROM a")
def locus_hit_audit(spark: SparkSession, d: str) -> DataFrame:
    """LOC-11."""
    out = h.hit_audit(fr.hits(spark, d), ["qseqid"], ["path_id"])
    return out.select("qseqid", "line", "votes", F.round("relative_score", 9).alias("relative_score"), F.round("vote_weight", 9).alias("vote_weight"))


@query(f"""WITH {fr.CALLS}, r AS (SELECT parent, line AS rid, "start" AS rs, "end" + 10 AS re FROM calls WHERE tool = 'marker'), l AS (SELECT parent, line AS locus, "start" AS s, "end" AS e FROM calls WHERE tool <> 'marker'),
t AS (SELECT l.parent, locus, rid || '' AS sequence_id, CASE WHEN s >= rs AND e <= re THEN 'contained' ELSE 'crosses' END AS relation, CAST(greatest(s, rs) - rs + 1 AS BIGINT) AS "start", CAST(least(e, re) - rs + 1 AS BIGINT) AS "end" FROM l JOIN r ON l.parent = r.parent AND s <= re AND rs <= e)
SELECT * FROM t UNION ALL SELECT parent, locus, NULL, 'outside', CAST(s AS BIGINT), CAST(e AS BIGINT) FROM l WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.parent = l.parent AND t.locus = l.locus)""")
def project_loci(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-1."""
    c = fr.calls(spark, d)
    regions = c.where("tool = 'marker'").select("parent", F.col("line").cast("string").alias("sequence_id"), F.col("start").alias("region_start"), (F.col("end") + 10).alias("region_end"))
    return h.project_loci(c.where("tool <> 'marker'").select("parent", F.col("line").alias("locus"), "start", "end"), regions, 50)
