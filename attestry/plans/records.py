"""Queries of normalization, contracts, scans and sinks, and streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import contracts as dq
from ..operators import normalize as nrm
from ..sources import readers, writers
from ..streaming import completeness
from ..functions.shared import shared_folder, spread
from . import frames as fr
from .registry import query


def _folder(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder for what a query writes and reads again."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT l_orderkey, l_linenumber, l_returnflag || '__c' || format('{:06d}', row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS sequence_id FROM lineitem")
def norm_ids(spark: SparkSession, d: str) -> DataFrame:
    """NRM-1."""
    x = fr.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey")
    return nrm.assign_ids(x, "l_returnflag", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "sequence_id")


@query("""WITH n AS (SELECT doc_id, text, CAST(greatest(ceil((length(text) - 300) / 200.0), 0) AS BIGINT) AS last FROM documents), w AS (SELECT doc_id, text, CAST(unnest(range(0, last + 1)) AS INTEGER) AS w FROM n)
SELECT doc_id, w AS "window", CAST(w * 200 + 1 AS INTEGER) AS "start", sha256(substr(text, w * 200 + 1, 300)) AS sha FROM w""")
def norm_windows(spark: SparkSession, d: str) -> DataFrame:
    """NRM-2."""
    out = nrm.split_windows(fr.table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", 300, 100)
    return out.select("doc_id", "window", "start", F.sha2("text", 256).alias("sha"))


@query("""SELECT l_orderkey AS parent, CAST(l_quantity AS BIGINT) + l_linenumber * 1000 AS "start", CAST(l_quantity AS BIGINT) + 5 + l_linenumber * 1000 AS "end" FROM lineitem""")
def norm_window_parents(spark: SparkSession, d: str) -> DataFrame:
    """NRM-3: half of the results name their window with ``_`` for ``|``."""
    x = fr.table(spark, d, "lineitem")
    wid = F.concat_ws("|", F.col("l_orderkey").cast("string"), F.concat(F.lit("w"), F.col("l_linenumber").cast("string"), F.lit("p"), F.col("l_partkey").cast("string"), F.lit("s"), F.col("l_suppkey").cast("string")))
    w = x.select(wid.alias("window_id"), F.col("l_orderkey").alias("parent"), (F.col("l_linenumber") * 1000).cast("long").alias("offset"))
    r = x.select(F.when(F.col("l_partkey") % 2 == 0, wid).otherwise(F.translate(wid, "|", "_")).alias("name"), F.col("l_quantity").cast("long").alias("start"), (F.col("l_quantity").cast("long") + 5).alias("end"))
    return nrm.window_to_parent(r, w, "name")[0].select("parent", "start", "end")


@query(f"""WITH {fr.CALLS}, k AS (SELECT parent % 500 AS parent, "start", "end", string_agg(DISTINCT tool, ',' ORDER BY tool) AS callers FROM calls GROUP BY 1, 2, 3)
SELECT parent, "start", "end", callers, 'S_orf' || format('{{:09d}}', row_number() OVER (ORDER BY parent, "start", "end")) AS orf_id FROM k""")
def norm_consolidated(spark: SparkSession, d: str) -> DataFrame:
    """NRM-4."""
    c = fr.calls(spark, d).withColumn("parent", F.col("parent") % 500)
    out = nrm.consolidate(c, ["parent", "start", "end"], "tool", ["parent", "start", "end"], F.lit("S"))
    return out.select("parent", "start", "end", F.array_join("callers", ",").alias("callers"), "orf_id")


@query(f"""WITH {fr.CALLS}, f AS (SELECT parent || '.' || line AS fid, CASE WHEN line % 3 = 0 THEN 'a' || parent || '.' || line END AS aid, parent, "start" AS s, "end" AS e FROM calls),
p AS (SELECT CASE line % 3 WHEN 0 THEN 'a' || parent || '.' || line WHEN 1 THEN parent || '.' || line ELSE 'x' || parent || '.' || line END AS pid, parent, "start" AS s, "end" AS e FROM calls),
spot AS (SELECT parent, s, e, min(fid) AS f3 FROM f GROUP BY 1, 2, 3 HAVING count(*) = 1), att AS (SELECT aid, min(fid) AS f2 FROM f WHERE aid IS NOT NULL GROUP BY 1)
SELECT pid AS protein_id, coalesce(f.fid, f2, f3) AS feature_id, CASE WHEN f.fid IS NOT NULL THEN 'record' WHEN f2 IS NOT NULL THEN 'attribute' WHEN f3 IS NOT NULL THEN 'coordinates' ELSE 'none' END AS matched_by FROM p LEFT JOIN f ON f.fid = pid LEFT JOIN att ON att.aid = pid LEFT JOIN spot ON spot.parent = p.parent AND spot.s = p.s AND spot.e = p.e""")
def norm_features(spark: SparkSession, d: str) -> DataFrame:
    """NRM-5."""
    c = fr.calls(spark, d)
    name = F.concat_ws(".", F.col("parent").cast("string"), F.col("line").cast("string"))
    spot = [F.col("parent"), F.col("start"), F.col("end"), F.lit("+").alias("strand")]
    f = c.select(name.alias("feature_id"), F.when(F.col("line") % 3 == 0, F.concat(F.lit("a"), name)).alias("attribute_id"), *spot)
    p = c.select(F.when(F.col("line") % 3 == 0, F.concat(F.lit("a"), name)).when(F.col("line") % 3 == 1, name).otherwise(F.concat(F.lit("x"), name)).alias("protein_id"), *spot)
    return nrm.join_features(p, f).select("protein_id", "feature_id", "matched_by")


@query("SELECT doc_id, substr(text, 5 + doc_id % 20, 30) AS slice FROM documents")
def norm_extract(spark: SparkSession, d: str) -> DataFrame:
    """NRM-6, 7."""
    x = nrm.compact(fr.table(spark, d, "documents"), ["doc_id", "text"], ["n_chars", "absent"])
    r = x.select("doc_id", (F.col("doc_id") % 20 + 5).cast("int").alias("start"), (F.col("doc_id") % 20 + 34).cast("int").alias("end"))
    return nrm.extract(x, r, "doc_id", "text").select("doc_id", F.col("text").alias("slice"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def check_unique(spark: SparkSession, d: str) -> DataFrame:
    """DQ-1."""
    return dq.violations_unique(fr.table(spark, d, "documents"), ["source"])


@query("SELECT o_orderkey AS k FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def check_reference(spark: SparkSession, d: str) -> DataFrame:
    """DQ-2."""
    return dq.violations_ref(fr.table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), fr.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), ["k"])


@query("SELECT doc_id, 'left' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT doc_id, 'right' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def check_two_sided(spark: SparkSession, d: str) -> DataFrame:
    """DQ-3."""
    return dq.violations_two_sided(fr.table(spark, d, "documents"), fr.table(spark, d, "labels"), ["doc_id"])


@query("SELECT o_orderkey AS k, o_custkey % 8 AS declared, n AS observed FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_custkey % 8 <> coalesce(n, 0)")
def check_counts(spark: SparkSession, d: str) -> DataFrame:
    """DQ-4."""
    o = fr.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 8).alias("n"))
    x = fr.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")).join(o.select("k"), "k", "left_semi")
    return dq.violations_count(x, o, ["k"], "n").select("k", "declared", "observed")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 48 THEN 'quantity' ELSE 'flag' END AS rule FROM lineitem WHERE l_quantity > 48 OR l_returnflag = 'R'")
def check_domain(spark: SparkSession, d: str) -> DataFrame:
    """DQ-5."""
    return dq.violations_domain(fr.table(spark, d, "lineitem"), {"quantity": F.col("l_quantity").between(0, 48), "flag": F.col("l_returnflag").isin("A", "N")}).select("l_orderkey", "l_linenumber", "rule")


@query("WITH e AS (SELECT event_id, value / 500 AS a, 1 - value / 500 AS b, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS label FROM events) SELECT event_id FROM e WHERE abs(a + b - 1) > 5e-4 OR abs(CASE label WHEN 'a' THEN a ELSE b END - greatest(a, b)) > 1e-12")
def check_probabilities(spark: SparkSession, d: str) -> DataFrame:
    """DQ-6."""
    x = fr.table(spark, d, "events").select("event_id", (F.col("value") / 500).alias("a"), (1 - F.col("value") / 500).alias("b"), F.when(F.col("event_id") % 2 == 0, "a").otherwise("b").alias("label"))
    return dq.violations_probabilities(x, ["a", "b"], "label").select("event_id")


@query(f"""WITH {fr.CALLS} SELECT parent, line FROM calls WHERE "end" > 120 AND NOT (tool = 'marker' AND "start" <= 120 AND "end" - 120 <= "start")""")
def check_intervals(spark: SparkSession, d: str) -> DataFrame:
    """DQ-7: calls beyond a record of 120, unless a marker call wraps around it."""
    parents = fr.records(spark, d).withColumn("length", F.lit(120).cast("long"))
    return dq.violations_interval(fr.calls(spark, d).drop("length"), parents, ["parent"], "start", "end", "length", F.col("tool") == "marker").select("parent", "line")


@query(f"""WITH {fr.CALLS}, w AS (SELECT parent, line, tool, "start" AS s, "end" AS e FROM calls WHERE tool = 'marker' AND "start" <= 120 AND "end" - 120 <= "start")
SELECT parent, line, 1 AS piece, s AS "start", least(e, 120) AS "end" FROM w UNION ALL SELECT parent, line, 2, 1, e - 120 FROM w WHERE e > 120""")
def check_wrapped(spark: SparkSession, d: str) -> DataFrame:
    """DQ-7: marker calls of circular records of 120, split at the origin."""
    c = fr.calls(spark, d).where("tool = 'marker'").withColumn("length", F.lit(120).cast("long"))
    ok = c.where((F.col("end") <= F.col("length")) | dq.wraps(F.col("start"), F.col("end"), F.col("length"), F.lit(True)))
    return dq.split_wrapped(ok, "start", "end", "length").select("parent", "line", "piece", "start", "end")


@query("""WITH r AS (SELECT o_orderkey AS parent, max(CAST(floor(o_totalprice) AS BIGINT)) AS n FROM orders GROUP BY 1), l AS (SELECT DISTINCT l_orderkey AS parent, CASE WHEN l_linenumber = 7 THEN CAST(floor(l_extendedprice) AS BIGINT) ELSE n END AS declared FROM lineitem LEFT JOIN r ON parent = l_orderkey),
o AS (SELECT DISTINCT o_orderkey AS parent, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE n END AS declared FROM orders JOIN r ON parent = o_orderkey)
SELECT coalesce(l.parent, r.parent) AS parent, 'lines' AS source, declared, n AS expected FROM l FULL JOIN r ON l.parent = r.parent WHERE NOT coalesce(declared = n, false) UNION ALL SELECT o.parent, 'orders', declared, n FROM o LEFT JOIN r USING (parent) WHERE NOT coalesce(declared = n, false)""")
def check_lengths(spark: SparkSession, d: str) -> DataFrame:
    """DQ-7: lengths that order lines and orders declare against those of the records; every record must have lines."""
    whole = lambda c: F.floor(c)
    o = spread(fr.table(spark, d, "orders").select(F.col("o_orderkey").alias("parent"), "o_totalprice", "o_orderstatus"), "parent")
    r = o.groupBy("parent").agg(F.max(whole("o_totalprice")).alias("length"))
    x = spread(fr.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("parent"), "l_linenumber", "l_extendedprice"), "parent")
    lines = x.join(r, "parent", "left").withColumn("length", F.when(F.col("l_linenumber") == 7, whole("l_extendedprice")).otherwise(F.col("length")))
    other = o.join(r, "parent").withColumn("length", F.when(F.col("o_orderstatus") != "P", F.col("length")))
    return dq.violations_lengths({"lines": lines, "orders": other}, r, ["parent"], "length", complete=("lines",))


@query(f"""WITH {fr.CALLS}, t AS (SELECT parent, sum(least("end" - "start" + 1, 120)) AS covered FROM calls GROUP BY 1), r AS (SELECT DISTINCT o_orderkey AS parent, (o_orderkey % 7) * 60 AS total FROM orders)
SELECT r.parent, total, CAST(coalesce(covered, 0) AS BIGINT) AS covered FROM r LEFT JOIN t ON t.parent = r.parent WHERE total <> coalesce(covered, 0)""")
def check_region_sum(spark: SparkSession, d: str) -> DataFrame:
    """DQ-7: sums of an order's calls, none counted beyond a whole record of 120, against a reported total."""
    c = fr.calls(spark, d).withColumn("length", F.lit(120).cast("long"))
    r = fr.table(spark, d, "orders").select(F.col("o_orderkey").alias("parent"), ((F.col("o_orderkey") % 7) * 60).alias("total")).distinct()
    return dq.violations_region_sum(c, r, ["parent"], "start", "end", "length", "total")


@query("""WITH s AS (SELECT user_id, list(DISTINCT event_type) AS seen FROM events WHERE value > 60 GROUP BY 1), u AS (SELECT DISTINCT user_id FROM events), x AS (SELECT user_id, list_sort(list_filter(['click', 'error', 'view'], lambda t: NOT list_contains(coalesce(seen, []), t))) AS m, list_sort(list_filter(coalesce(seen, []), lambda t: NOT list_contains(['click', 'error', 'view'], t))) AS u FROM u LEFT JOIN s USING (user_id))
SELECT user_id, array_to_string(m, ',') AS missing, array_to_string(u, ',') AS unexpected FROM x WHERE len(m) > 0 OR len(u) > 0""")
def check_producers(spark: SparkSession, d: str) -> DataFrame:
    """DQ-8."""
    e = fr.table(spark, d, "events")
    want = e.select("user_id").distinct().withColumn("producers", F.array(*[F.lit(x) for x in ("click", "error", "view")]))
    out = dq.producer_gaps(e.where("value > 60"), ["user_id"], "event_type", want)
    return out.select("user_id", F.array_join("missing", ",").alias("missing"), F.array_join("unexpected", ",").alias("unexpected"))


@query("WITH n AS (SELECT doc_id, 1 AS need FROM documents WHERE n_chars >= 500), h AS (SELECT doc_id, count(*) AS have FROM labels GROUP BY 1) SELECT doc_id, CAST(coalesce(need, 0) AS INTEGER) AS need, coalesce(have, 0) AS have FROM n FULL JOIN h USING (doc_id) WHERE coalesce(need, 0) <> coalesce(have, 0)")
def check_coverage(spark: SparkSession, d: str) -> DataFrame:
    """DQ-9."""
    return dq.eligible_coverage(fr.table(spark, d, "documents"), fr.table(spark, d, "labels"), ["doc_id"], "n_chars", 500)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS k, o_custkey % 8 AS declared, coalesce(n, 0) AS observed FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_custkey % 8 <> coalesce(n, 0)")
def check_children(spark: SparkSession, d: str) -> DataFrame:
    """DQ-10."""
    o = fr.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("k"), (F.col("o_custkey") % 8).alias("n"))
    genes = fr.table(spark, d, "lineitem").select(F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("gene"))
    return dq.child_counts(o, genes, "k", "gene", "n")


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey % 50 AS a, l_partkey % 50 + CAST(l_quantity AS BIGINT) - 10 AS b, l_suppkey % 50 AS c, l_suppkey % 50 + 20 AS d, l_extendedprice AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN a >= 1 AND a <= b THEN a || '-' || b END AS span, CAST(greatest(0, least(b, d) - greatest(a, c) + 1) AS BIGINT) AS shared FROM x""")
def scalar_intervals(spark: SparkSession, d: str) -> DataFrame:
    """FN-3, FN-4."""
    x = fr.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 50).alias("a"), (F.col("l_partkey") % 50 + F.col("l_quantity").cast("long") - 10).alias("b"), (F.col("l_suppkey") % 50).alias("c"), (F.col("l_suppkey") % 50 + 20).alias("d"))
    span = sc.interval(sc.interval_text(F.col("a"), F.col("b")))
    return x.select("l_orderkey", "l_linenumber", sc.interval_text(span.start, span.end).alias("span"), sc.overlap(F.col("a"), F.col("b"), F.col("c"), F.col("d")).cast("long").alias("shared"))


@query("""SELECT p_partkey AS part, CASE WHEN contains(p_name, ' ') THEN split_part(p_name, ' ', 1) ELSE p_name END AS base, CASE WHEN contains(p_name, ' ') THEN substr(p_name, instr(p_name, ' ') + 1) END AS suffix, CAST(p_size AS VARCHAR) || ':' || p_brand AS zipped FROM part""")
def scalar_text(spark: SparkSession, d: str) -> DataFrame:
    """FN-6, FN-7, FN-10, FN-11."""
    p = fr.table(spark, d, "part")
    base, suffix = sc.split_suffix(F.col("p_name"), " ")
    zipped = sc.zip_lists(["n", "b"], [F.concat(F.col("p_size").cast("string"), F.lit(",9")), F.concat("p_brand", F.lit(",z"))])
    return p.select(F.col("p_partkey").alias("part"), base.alias("base"), suffix.alias("suffix"), F.concat_ws(":", zipped[0]["n"], zipped[0]["b"]).alias("zipped"))


@query("SELECT doc_id, length(replace(replace(replace(replace(replace(replace(replace(coalesce(text, ''), '>', ''), chr(10), ''), ' ', ''), chr(9), ''), chr(13), ''), chr(11), ''), chr(12), '')) AS n, '>d' || doc_id || ' ' || lang AS header FROM documents")
def scan_fasta(spark: SparkSession, d: str) -> DataFrame:
    """SRC-1, SNK-2: documents, without white space and record marks, written as records wrapped at 80, and read again."""
    path = _folder(spark, "fasta")
    x = fr.table(spark, d, "documents")
    records = x.select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(" "), "lang").alias("id"), F.regexp_replace(F.coalesce("text", F.lit("")), r"[\s>]+", "").alias("sequence"))
    writers.write_fasta(records.where("sequence <> ''"), path)
    out = readers.read_fasta(spark, path)
    return out.select(F.substring("id", 2, 20).cast("long").alias("doc_id"), F.length("sequence").cast("long").alias("n"), F.concat(F.lit(">"), "header").alias("header"))


@query("SELECT l_returnflag AS flag, count(*) AS n, count(DISTINCT l_orderkey) AS keys FROM lineitem GROUP BY 1")
def scan_tables(spark: SparkSession, d: str) -> DataFrame:
    """SRC-3, SRC-5, SNK-1, SNK-3, SNK-4, SNK-7: a table through text, sorted Parquet and class folders."""
    x = fr.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("flag"))
    a, b, c = (_folder(spark, n) for n in ("tsv", "sorted", "classes"))
    writers.write_tsv(x, a, ["l_orderkey", "l_linenumber", "flag"])
    writers.write_sorted(readers.read_table(spark, a, ["l_orderkey", "flag"]), b, ["l_orderkey"])
    writers.write_classes(readers.read_reference(spark, b), c, "flag")
    return spark.read.parquet(c).groupBy("flag").agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("keys"))


@query("SELECT l_orderkey || '.' || l_linenumber AS feature_id, l_suppkey || 's' AS parent, CAST(l_partkey + 1 AS BIGINT) AS \"start\", CAST(l_partkey + l_quantity AS BIGINT) AS \"end\", '11' AS \"table\" FROM lineitem WHERE l_linenumber = 1")
def scan_features(spark: SparkSession, d: str) -> DataFrame:
    """SRC-2."""
    x = fr.table(spark, d, "lineitem")
    line = F.concat_ws("\t", F.concat(F.col("l_suppkey").cast("string"), F.lit("s")), F.lit("src"), F.when(F.col("l_linenumber") == 1, "CDS").otherwise("gene"), (F.col("l_partkey") + 1).cast("string"), (F.col("l_partkey") + F.col("l_quantity")).cast("long").cast("string"), F.lit("."), F.lit("+"), F.lit("0"), F.concat(F.lit("ID="), F.col("l_orderkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string"), F.lit(";note=a=b;")))
    path = _folder(spark, "gff")
    x.select(line.alias("value")).write.text(path)
    return readers.read_gff(spark, path).select("feature_id", "parent", "start", "end", "table")


#: Rows of a file that one task has to read whole, since it is compressed.
FILE_ROWS = 500_000


@query("SELECT l_orderkey AS a, l_partkey AS b FROM lineitem")
def scan_repaired(spark: SparkSession, d: str) -> DataFrame:
    """SRC-9: one table in files of three kinds, plain and gzip under names that tell nothing, with real and with written-out tabs."""
    path = _folder(spark, "repaired")
    x = fr.table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("a"), F.col("l_partkey").cast("string").alias("b"), (F.col("l_orderkey") % 3).alias("file"))
    for k, (sep, gz) in enumerate((("\t", False), ("\\t", True), ("\t", True))):
        # one column, named like the header: each file gets a header of its own, and holds a bounded number of rows
        text = x.where(F.col("file") == k).select(F.concat_ws(sep, "a", "b").alias(sep.join((" key ", "part"))))
        plain = {"header": True, "sep": "\x01", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "maxRecordsPerFile": FILE_ROWS}
        text.write.options(**plain, compression="gzip" if gz else "none").csv(f"{path}/{k}")
    names = _renamed(spark, path)
    out = readers.read_repaired(spark, names, ["key", "part"])
    return out.select(F.col("key").cast("long").alias("a"), F.col("part").cast("long").alias("b"))


def _renamed(spark: SparkSession, path: str) -> str:
    """``path`` with all endings of compressed files taken from their names."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
        if info.type == fs.FileType.File and info.path.endswith(".gz"):
            system.move(info.path, info.path.removesuffix(".gz"))
    return path


@query("SELECT r_name AS region, n_name AS nation FROM nation JOIN region ON n_regionkey = r_regionkey")
def scan_catalog(spark: SparkSession, d: str) -> DataFrame:
    """SRC-8, SRC-10: a catalog as text whose files keep their recorded hashes."""
    path = _folder(spark, "catalog")
    n, r = fr.table(spark, d, "nation"), fr.table(spark, d, "region")
    n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("Region"), F.col("n_name").alias(" NATION")).write.option("header", True).csv(path)
    stamp = readers.file_inventory(spark, path)
    dq.enforce(readers.inventory_changes(readers.file_inventory(spark, path), stamp), "files changed")
    return readers.read_catalog(spark, path, ["region", "nation"]).select("region", "nation")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS qseqid, count(*) AS n, max(l_extendedprice) AS best FROM lineitem GROUP BY 1")
def scan_hits(spark: SparkSession, d: str) -> DataFrame:
    """SRC-4: order lines written as hit tables and read by their fixed schema."""
    path = _folder(spark, "hits")
    x = fr.table(spark, d, "lineitem")
    named = {"qseqid": F.col("l_orderkey"), "sseqid": F.col("l_partkey"), "bitscore": F.col("l_extendedprice"), "qcovhsp": F.col("l_quantity")}
    x.select(*[named.get(f.name, F.lit(0)).alias(f.name) for f in readers.HITS]).write.option("sep", "\t").option("header", True).csv(path)
    return readers.read_hits(spark, [path]).groupBy("qseqid").agg(F.count("*").alias("n"), F.max("bitscore").alias("best"))


@query("SELECT CAST(l_partkey AS VARCHAR) AS protein, l_returnflag AS seq_type, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' AND l_tax > 0.01 GROUP BY 1, 2")
def scan_feature_tables(spark: SparkSession, d: str) -> DataFrame:
    """SRC-6: compressed feature tables whose first header has a mark."""
    path = _folder(spark, "features")
    x = fr.table(spark, d, "lineitem")
    rows = x.select(F.when(F.col("l_linestatus") == "O", "CDS").otherwise("gene").alias("# feature"), F.when(F.col("l_tax") > 0.01, F.col("l_partkey").cast("string")).otherwise("-").alias("product_accession"), F.col("l_returnflag").alias("seq_type"), F.lit("1").alias("chromosome"))
    rows.write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)
    return readers.read_features(spark, path).groupBy("protein", "seq_type").agg(F.count("*").alias("n"))


@query("SELECT 'c' || c_custkey AS prefix, CASE WHEN c_nationkey % 2 = 0 THEN 'dna' ELSE 'rna' END AS type FROM customer")
def scan_samples(spark: SparkSession, d: str) -> DataFrame:
    """SRC-7: a sample sheet, checked."""
    path = _folder(spark, "samples")
    c = fr.table(spark, d, "customer")
    c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("prefix"), F.when(F.col("c_nationkey") % 2 == 0, "DNA").otherwise("rna").alias("type"), F.col("c_name").alias("fasta")).write.option("header", True).csv(path)
    return readers.read_samples(spark, path).select("prefix", "type")


@query("SELECT 'orders' AS output, count(*) AS n FROM orders UNION ALL SELECT 'part', count(*) FROM part")
def sink_manifest(spark: SparkSession, d: str) -> DataFrame:
    """SNK-5, SNK-6."""
    tables = {t: fr.table(spark, d, t) for t in ("orders", "part")}
    writers.write_audits({"compact_part": tables["part"], "orders": tables["orders"]}, _folder(spark, "audit"), "compact")
    out = writers.manifest(tables, {"policy": "default"})
    return out.select("output", F.get_json_object("manifest", "$.n").cast("long").alias("n"))


EXPECTED = {"0": 3, "1": 4, "2": 5, "3": 9}


@query("""WITH k AS (SELECT user_id || '@' || strftime(ts, '%Y-%m-%d') AS key, CAST(user_id % 4 AS VARCHAR) AS kind, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS items, count(DISTINCT event_type) AS n FROM events GROUP BY 1, 2)
SELECT key, kind, items FROM k WHERE n >= CASE kind WHEN '0' THEN 3 WHEN '1' THEN 4 WHEN '2' THEN 5 ELSE 9 END""")
def stream_complete_batch(spark: SparkSession, d: str) -> DataFrame:
    """STR-1 over a finished input, STR-2, STR-4, STR-5."""
    e = _keyed(fr.table(spark, d, "events"))
    return completeness.completeness_batch(completeness.mix(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1")), "key", "event_type", "kind", EXPECTED)


def _keyed(events: DataFrame) -> DataFrame:
    return events.withColumns({"key": F.concat(F.col("user_id").cast("string"), F.lit("@"), F.date_format("ts", "yyyy-MM-dd")), "kind": (F.col("user_id") % 4).cast("string")})


@query("""WITH k AS (SELECT user_id || '@' || strftime(ts, '%Y-%m-%d') AS key, CAST(user_id % 4 AS VARCHAR) AS kind, count(DISTINCT event_type) AS n FROM events GROUP BY 1, 2)
SELECT key, kind FROM k WHERE n >= CASE kind WHEN '0' THEN 3 WHEN '1' THEN 4 WHEN '2' THEN 5 ELSE 9 END""")
def stream_complete(spark: SparkSession, d: str) -> DataFrame:
    """STR-1: the events as a file stream, each key released once."""
    source = fr.table(spark, d, "events")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(f"{d}/events.parquet*")
    out, marks = _folder(spark, "released"), _folder(spark, "state")
    gate = completeness.completeness_gate(_keyed(stream), "key", "event_type", "kind", EXPECTED)
    return completeness.run_to_end(gate, out, marks).select("key", "kind")


@query("""SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase' AND b.ts BETWEEN a.ts - INTERVAL 30 MINUTES AND a.ts + INTERVAL 30 MINUTES""")
def stream_join(spark: SparkSession, d: str) -> DataFrame:
    """STR-3 over finished inputs (the same join as between streams)."""
    e = fr.table(spark, d, "events")
    a = e.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("a"))
    b = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("b"))
    return completeness.keyed_join(a, b, "user_id", "ts", "30 minutes").select("a", "b")


def _event_stream(spark: SparkSession, d: str, kind: str, name: str) -> DataFrame:
    schema = fr.table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(f"{d}/events.parquet*")
    return stream.where(F.col("event_type") == kind).select("user_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias(name))


@query("""WITH c AS (SELECT event_id AS a, user_id, ts FROM events WHERE event_type = 'click'), p AS (SELECT event_id AS b, user_id, ts FROM events WHERE event_type = 'purchase'),
mark AS (SELECT least((SELECT max(ts) FROM c) - INTERVAL 20 MINUTES, (SELECT max(ts) FROM p) - INTERVAL 40 MINUTES) - INTERVAL 30 MINUTES AS closed),
j AS (SELECT a, b, c.ts AS ta, p.ts AS tb FROM c FULL JOIN p ON c.user_id = p.user_id AND p.ts BETWEEN c.ts - INTERVAL 30 MINUTES AND c.ts + INTERVAL 30 MINUTES)
SELECT a, b FROM j, mark WHERE (a IS NOT NULL AND b IS NOT NULL) OR coalesce(ta, tb) < closed""")
def stream_join_remainder(spark: SparkSession, d: str) -> DataFrame:
    """STR-3 between two file streams: pairs, and the remainder of both sides as far as the watermarks have passed it."""
    both = completeness.keyed_join(_event_stream(spark, d, "click", "a"), _event_stream(spark, d, "purchase", "b"), "user_id", "ts", "30 minutes", "full_outer", ("20 minutes", "40 minutes"))
    return completeness.run_to_end(both.select("a", "b"), _folder(spark, "joined"), _folder(spark, "state"))


@query("SELECT 'orders' AS output, count(*) AS recorded_n, count(*) AS n, 'unchanged' AS status FROM orders UNION ALL SELECT 'part', count(*), count(*), CASE WHEN count(*) > 0 THEN 'changed' ELSE 'unchanged' END FROM part UNION ALL SELECT 'nation', count(*), NULL, 'missing' FROM nation UNION ALL SELECT 'region', NULL, count(*), 'unrecorded' FROM region")
def sink_verified(spark: SparkSession, d: str) -> DataFrame:
    """SNK-6: tables written and read again against their manifest; one of them has one cell changed."""
    tables = {t: fr.table(spark, d, t) for t in ("orders", "part", "nation")}
    recorded = writers.manifest(tables, {"policy": "default"})
    path = _folder(spark, "outputs")
    first = tables["part"].agg(F.min("p_partkey")).first()[0]
    edited = tables["part"].withColumn("p_size", F.when(F.col("p_partkey") == first, F.col("p_size") + 1).otherwise(F.col("p_size")))
    tables["orders"].repartition(3).write.parquet(f"{path}/orders")
    edited.write.parquet(f"{path}/part")
    now = {t: spark.read.parquet(f"{path}/{t}") for t in ("orders", "part")}
    return writers.verify_manifest({**now, "region": fr.table(spark, d, "region")}, recorded)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, printf('%.6g', sqrt(l_extendedprice) / 3) AS a, printf('%.6g', -(l_discount + 0.01) / 1e5) AS b, printf('%.6g', sqrt(l_extendedprice) * 1e4) AS c,
  abs(l_discount - l_tax) <= greatest(0.2 * greatest(abs(l_discount), abs(l_tax)), 0.011) AS near FROM lineitem""")
def scalar_numbers(spark: SparkSession, d: str) -> DataFrame:
    """FN-9."""
    x = fr.table(spark, d, "lineitem")
    price = F.col("l_extendedprice")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sc.significant(F.sqrt(price) / 3).alias("a"), sc.significant(-(F.col("l_discount") + 0.01) / 1e5).alias("b"), sc.significant(F.sqrt(price) * 1e4).alias("c"), sc.close(F.col("l_discount"), F.col("l_tax"), 0.2, 0.011).alias("near"))
