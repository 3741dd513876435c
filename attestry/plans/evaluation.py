"""Queries of the evaluation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from . import frames as fr
from .registry import query

METHODS = ["short", "clean", "hashed"]


def _panel(spark: SparkSession, d: str) -> DataFrame:
    return fr.table(spark, d, "documents").select(F.col("lang").alias("panel"), F.col("doc_id").alias("id"))


def _calls(spark: SparkSession, d: str) -> DataFrame:
    x = fr.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "n_chars", "source")
    out = x.where("n_chars < 800").select(F.lit("short").alias("method"), "id")
    return out.unionByName(x.where("source in ('src1', 'src2', 'src3', 'src4')").select(F.lit("clean").alias("method"), "id")).unionByName(x.where("id % 3 = 0").select(F.lit("hashed").alias("method"), "id"))


BASE = """panel AS (SELECT lang AS panel, doc_id AS id FROM documents),
calls AS (SELECT 'short' AS method, doc_id AS id FROM documents WHERE n_chars < 800 UNION ALL SELECT 'clean', doc_id FROM documents WHERE source IN ('src1', 'src2', 'src3', 'src4') UNION ALL SELECT 'hashed', doc_id FROM documents WHERE doc_id % 3 = 0),
methods(method) AS (VALUES ('short'), ('clean'), ('hashed'))"""
RATES = f"""WITH {BASE}, rates AS (SELECT p.panel, m.method, n, coalesce(detected, 0) AS detected, coalesce(detected, 0) / n AS rate FROM (SELECT panel, count(DISTINCT id) AS n FROM panel GROUP BY 1) p CROSS JOIN methods m
LEFT JOIN (SELECT panel, method, count(DISTINCT id) AS detected FROM panel JOIN calls USING (id) GROUP BY 1, 2) s ON p.panel = s.panel AND m.method = s.method)"""


@query(RATES + " SELECT panel, method, n, detected, rate FROM rates")
def eval_detection(spark: SparkSession, d: str) -> DataFrame:
    """EVL-1."""
    return ev.detection_rates(_panel(spark, d), _calls(spark, d), METHODS)


@query(RATES + " SELECT CASE WHEN panel = 'en' THEN 'sensitivity' ELSE 'false_positive' END AS kind, method, CAST(sum(detected) AS BIGINT) AS detected, CAST(sum(n) AS BIGINT) AS n, sum(detected) / sum(n) AS rate FROM rates GROUP BY 1, 2")
def eval_totals(spark: SparkSession, d: str) -> DataFrame:
    """EVL-14."""
    return ev.totals(eval_detection(spark, d), F.when(F.col("panel") == "en", "sensitivity").otherwise("false_positive"))


@query(f"WITH {BASE}, x AS (SELECT panel, id IN (SELECT id FROM calls WHERE method = 'short') AS a, id IN (SELECT id FROM calls WHERE method = 'clean') AS b FROM panel) SELECT panel, count(*) FILTER (a AND b) AS both, count(*) FILTER (a AND NOT b) AS only_a, count(*) FILTER (NOT a AND b) AS only_b, count(*) FILTER (NOT a AND NOT b) AS neither FROM x GROUP BY 1")
def eval_paired(spark: SparkSession, d: str) -> DataFrame:
    """EVL-2."""
    c = _calls(spark, d)
    return ev.paired(_panel(spark, d), c.where("method = 'short'"), c.where("method = 'clean'"))


@query(f"WITH {BASE} SELECT panel, id, m.method, CAST(CASE WHEN c.id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS called FROM panel p CROSS JOIN methods m LEFT JOIN (SELECT DISTINCT method, id FROM calls) c USING (method, id)")
def eval_call_matrix(spark: SparkSession, d: str) -> DataFrame:
    """EVL-3."""
    return ev.call_matrix(_panel(spark, d), _calls(spark, d), METHODS)


@query(f"WITH {BASE}, k AS (SELECT id, bool_or(method = 'hashed') AS reg FROM calls WHERE method <> 'clean' GROUP BY 1) SELECT panel, count(*) AS n, count(k.id) AS retained, count(*) FILTER (reg) AS as_region, count(k.id) / count(*) AS rate FROM panel LEFT JOIN k USING (id) GROUP BY 1")
def eval_retention(spark: SparkSession, d: str) -> DataFrame:
    """EVL-4."""
    kept = _calls(spark, d).where("method <> 'clean'").select("id", F.when(F.col("method") == "hashed", "region").otherwise("input_record").alias("record_type"))
    return ev.retention(_panel(spark, d), kept)


@query("SELECT count(*) FILTER (a.text IS NOT NULL AND b.text IS NOT NULL) AS shared, count(*) FILTER (b.text IS NULL) AS only_a, count(*) FILTER (a.text IS NULL) AS only_b FROM (SELECT DISTINCT text FROM documents WHERE lang = 'en') a FULL JOIN (SELECT DISTINCT text FROM documents WHERE source <> 'src0') b ON a.text = b.text")
def eval_concordance(spark: SparkSession, d: str) -> DataFrame:
    """EVL-5."""
    x = fr.table(spark, d, "documents")
    return ev.concordance(x.where("lang = 'en'"), x.where("source <> 'src0'"), ["text"])


@query("WITH l AS (SELECT l_returnflag AS flag, 'price' AS field, l_extendedprice AS value FROM lineitem UNION ALL SELECT l_returnflag, 'quantity', l_quantity FROM lineitem) SELECT flag, field, count(*) AS n, min(value) AS low, quantile_cont(value, 0.5) AS median, max(value) AS high FROM l GROUP BY 1, 2")
def eval_scores(spark: SparkSession, d: str) -> DataFrame:
    """EVL-6."""
    x = fr.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"))
    return ev.score_distribution(x, ["flag"], ["price", "quantity"])


@query(f"WITH {BASE}, x AS (SELECT panel, id IN (SELECT id FROM calls WHERE method = 'short') AS r, id IN (SELECT id FROM calls WHERE method = 'clean') AS x FROM panel), y AS (SELECT panel, count(*) AS n, count(*) FILTER (r) AS retained, count(*) FILTER (x) AS excluded, count(*) FILTER (r AND x) AS excluded_retained FROM x GROUP BY 1) SELECT *, retained / n AS rate, (retained - excluded_retained) / nullif(n - excluded, 0) AS adjusted_rate FROM y")
def eval_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """EVL-7."""
    c = _calls(spark, d)
    return ev.exclusion_rates(_panel(spark, d), c.where("method = 'short'"), c.where("method = 'clean'"))


SPLIT = "CASE WHEN CAST('0x' || substr(sha2, 1, 16) AS UBIGINT) % 5 = 0 THEN 'heldout' ELSE 'development' END"


@query(f"""WITH g AS (SELECT doc_id, CASE WHEN doc_id % 5 > 0 AND trim(source) <> '' THEN 'source:' || trim(source) WHEN doc_id % 2 = 0 AND trim(lang) <> '' THEN 'lang:' || trim(lang) ELSE 'sequence:' || doc_id END AS heldout_group FROM documents), k AS (SELECT *, sha256(heldout_group) AS sha2 FROM g)
SELECT doc_id, heldout_group, {SPLIT} AS split FROM k""")
def eval_holdout(spark: SparkSession, d: str) -> DataFrame:
    """EVL-8, FN-8: documents by source, else by language, else alone."""
    i = F.col("doc_id")
    x = fr.table(spark, d, "documents").select("doc_id", F.when(i % 5 > 0, F.col("source")).otherwise("Unclassified").alias("source"), F.when(i % 2 == 0, F.col("lang")).alias("lang"))
    return ev.holdout(x, ["source", "lang"], "doc_id").select("doc_id", "heldout_group", "split")


@query(f"""WITH {fr.CATALOG}, t AS (SELECT DISTINCT l_orderkey AS id, l_linenumber % 2 AS type, l_suppkey, l_partkey FROM lineitem), p AS (SELECT id, 't' || type AS type, c.region AS tr, CASE WHEN l_partkey % 3 > 0 THEN c.nation END AS tn, c.region AS sr, CASE WHEN l_partkey % 2 = 0 THEN c.nation END AS sn, e.region AS er, e.nation AS en, sha256('nation:' || c.nation) AS sha2
  FROM t JOIN catalog c ON c.path_id = l_suppkey LEFT JOIN catalog e ON e.path_id = l_suppkey - l_partkey % 2),
x AS (SELECT type, {SPLIT} AS split, unnest([{{'r': 'region', 'm': 'strict', 't': tr, 'c': sr}}, {{'r': 'nation', 'm': 'strict', 't': tn, 'c': sn}}, {{'r': 'region', 'm': 'exploratory', 't': tr, 'c': er}}, {{'r': 'nation', 'm': 'exploratory', 't': tn, 'c': en}}]) AS u FROM p)
SELECT type, coalesce(split, 'all') AS split, u.r AS rank, u.m AS mode, count(*) AS eligible, count(u.c) AS called, count(*) FILTER (u.c = u.t) AS correct, count(u.c) - count(*) FILTER (u.c = u.t) AS incorrect, count(u.c) / count(*) AS coverage, count(*) FILTER (u.c = u.t) / nullif(count(u.c), 0) AS precision
FROM x WHERE u.t IS NOT NULL GROUP BY GROUPING SETS ((type, u.r, u.m), (type, split, u.r, u.m))""")
def eval_rank_results(spark: SparkSession, d: str) -> DataFrame:
    """EVL-9: results of every rank, type and split."""
    c = fr.catalog(spark, d)
    t = fr.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), (F.col("l_linenumber") % 2).alias("type"), "l_suppkey", "l_partkey").distinct()
    own = c.select(F.col("path_id").alias("l_suppkey"), "region", "nation")
    other = c.select(F.col("path_id").alias("o"), F.col("region").alias("exploratory_region"), F.col("nation").alias("exploratory_nation"))
    x = t.join(own, "l_suppkey").join(other, F.col("l_suppkey") - F.col("l_partkey") % 2 == F.col("o"), "left")
    x = ev.holdout(x, ["nation"], "id").withColumns({
        "type": F.concat(F.lit("t"), F.col("type").cast("string")),
        "truth_region": F.col("region"), "truth_nation": F.when(F.col("l_partkey") % 3 > 0, F.col("nation")).otherwise("unclassified"),
        "strict_region": F.col("region"), "strict_nation": F.when(F.col("l_partkey") % 2 == 0, F.col("nation")).otherwise("NA"),
    })
    return ev.rank_results(x, "type", "split", ["region", "nation"])


@query("""WITH p AS (SELECT lang AS type, CASE WHEN doc_id % 5 = 0 THEN 'holdout' ELSE 'train' END AS split, CASE WHEN doc_id % 2 = 0 THEN 'strict' ELSE 'exploratory' END AS mode, toxic AS truth, CASE WHEN n_chars % 3 > 0 THEN CAST(n_chars % 2 AS INTEGER) END AS predicted FROM documents JOIN labels USING (doc_id))
SELECT type, coalesce(split, 'all') AS split, mode, count(*) AS n, count(predicted) AS predicted, count(*) FILTER (predicted = truth) AS correct, count(predicted) / count(*) AS coverage, count(*) FILTER (predicted = truth) / nullif(count(predicted), 0) AS precision FROM p GROUP BY GROUPING SETS ((type, mode), (type, split, mode))""")
def eval_coverage_precision(spark: SparkSession, d: str) -> DataFrame:
    """EVL-9."""
    x = fr.table(spark, d, "documents").join(fr.table(spark, d, "labels"), "doc_id")
    x = x.select(F.col("lang").alias("type"), F.when(F.col("doc_id") % 5 == 0, "holdout").otherwise("train").alias("split"), F.when(F.col("doc_id") % 2 == 0, "strict").otherwise("exploratory").alias("mode"), F.col("toxic").alias("truth"), F.when(F.col("n_chars") % 3 > 0, (F.col("n_chars") % 2).cast("int")).alias("predicted"))
    return ev.coverage_precision(x, "type", "split", "mode")


@query("WITH g AS (SELECT l_returnflag AS flag, count(*) AS n, count(*) FILTER (l_quantity >= 10 AND l_extendedprice >= 1000) AS permissive, count(*) FILTER (l_quantity >= 20 AND l_extendedprice >= 20000) AS balanced, count(*) FILTER (l_quantity >= 40 AND l_extendedprice >= 60000) AS strict FROM lineitem GROUP BY 1) SELECT flag, n, tier, passed FROM (SELECT flag, n, unnest(['permissive', 'balanced', 'strict']) AS tier, unnest([permissive, balanced, strict]) AS passed FROM g)")
def eval_thresholds(spark: SparkSession, d: str) -> DataFrame:
    """EVL-10."""
    x = fr.table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "flag")
    tiers = {"permissive": (10, 1000), "balanced": (20, 20000), "strict": (40, 60000)}
    return ev.threshold_screen(x, {k: {"l_quantity": q, "l_extendedprice": p} for k, (q, p) in tiers.items()}, ["flag"])


@query("SELECT doc_id, 'lang' AS \"column\" FROM documents WHERE doc_id % 3 = 0 AND doc_id % 7 = 0 AND lang <> 'en' UNION ALL SELECT doc_id, 'source' FROM documents WHERE doc_id % 3 = 0 AND doc_id % 11 = 0 AND source <> 'src0'")
def eval_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """EVL-11."""
    x = fr.table(spark, d, "documents").select("doc_id", "lang", "source")
    other = x.where("doc_id % 3 = 0").withColumn("lang", F.when(F.col("doc_id") % 7 == 0, "en").otherwise(F.col("lang"))).withColumn("source", F.when(F.col("doc_id") % 11 == 0, "src0").when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("source")))
    return ev.reconcile(x, other, ["doc_id"], ["lang", "source"])[1]


@query("""WITH a AS (SELECT l_orderkey AS k, list(l_partkey ORDER BY l_partkey) AS s FROM lineitem WHERE l_orderkey % 7 > 0 GROUP BY 1), b AS (SELECT l_orderkey AS k, list(l_partkey ORDER BY l_partkey) AS s FROM lineitem WHERE l_orderkey % 5 > 0 AND NOT (l_orderkey % 3 = 0 AND l_linenumber = 1) GROUP BY 1)
SELECT coalesce(a.k, b.k) AS orderkey, CASE WHEN a.k IS NULL THEN 'gained' WHEN b.k IS NULL THEN 'lost' WHEN a.s = b.s THEN 'unchanged' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.k = b.k""")
def eval_run_diff(spark: SparkSession, d: str) -> DataFrame:
    """EVL-12."""
    x = fr.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_partkey", "l_linenumber")
    return ev.run_diff(x.where("orderkey % 7 > 0"), x.where("orderkey % 5 > 0 and not (orderkey % 3 = 0 and l_linenumber = 1)"), ["orderkey"], ["l_partkey"])


@query("SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'missing' ELSE 'changed' END AS problem FROM documents WHERE doc_id % 13 = 0 OR doc_id % 17 = 0")
def eval_integrity(spark: SparkSession, d: str) -> DataFrame:
    """EVL-13."""
    x = fr.table(spark, d, "documents").select("doc_id", "text")
    declared = x.select("doc_id", F.sha2("text", 256).alias("sha256"))
    now = x.where("doc_id % 13 > 0").withColumn("text", F.when(F.col("doc_id") % 17 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return ev.integrity(now, declared, "doc_id", "text")
