"""URL filters: a broadcast trie over reversed host labels and path segments."""

from __future__ import annotations

from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

#: Rules up to this many go into the broadcast trie; more are matched by a join.
MAX_TRIE_RULES = 200_000
NO_RULE = "allow"


class Rule(NamedTuple):
    """``host`` and its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str


class Trie:
    """Reversed host labels, then whole path segments; a node keeps the open-ended last segments."""

    def __init__(self, rules: list[Rule]):
        self.root: dict = {}
        for i, r in enumerate(rules):
            node = self.root
            for label in reversed(r.host.split(".")):
                node = node.setdefault(("h", label), {})
            segments = r.path.split("/")
            for s in segments[:-1]:
                node = node.setdefault(("p", s), {})
            node.setdefault("ends", []).append((segments[-1], i, _weight(r)))

    def find(self, host: str, path: str) -> int | None:
        best, won = None, None
        node, segments = self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get(("h", label))
            if node is None:
                break
            at = node
            for s in segments:
                for end, i, weight in at.get("ends", ()):
                    if s.startswith(end) and (won is None or weight > won):
                        best, won = i, weight
                at = at.get(("p", s))
                if at is None:
                    break
        return best


def _weight(r: Rule) -> tuple:
    """Longest rule first; then the longer host; a block before an allow of the same length."""
    return len(r.host) + len(r.path), len(r.host), r.verdict == "block"


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = NO_RULE, trie_rules: int = MAX_TRIE_RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (text of the rule that won, or null) and ``verdict``.

    The longest matching rule wins, whether it allows or blocks; urls that no rule
    matches get ``default``.  A null url, or one without ``://``, has empty host and
    path and matches nothing.  Rows stay one to one; columns of those four names are
    replaced.  Beyond ``trie_rules`` rules, which would make the broadcast too large,
    the host's suffixes are joined with the rules instead, with the same result.
    """
    rules = sorted({Rule(v, h.lower(), p) for v, h, p in rules})
    if bad := [r for r in rules if r.verdict not in ("allow", "block")]:
        raise ValueError(f"unknown verdict: {bad[0]}")
    parsed = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    if len(rules) > trie_rules:
        return _judge_by_join(parsed, rules, default)
    shared = pages.sparkSession.sparkContext.broadcast(rules)
    tries: dict[str, Trie] = {}

    @F.pandas_udf("rule string, verdict string")
    def match(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        if "trie" not in tries:
            tries["trie"] = Trie(shared.value)
        found = [tries["trie"].find(h, p) for h, p in zip(host, path, strict=True)]
        won = [None if i is None else shared.value[i] for i in found]
        return pd.DataFrame({"rule": [None if r is None else r.host + r.path for r in won], "verdict": [default if r is None else r.verdict for r in won]}, dtype=object)

    out = parsed.withColumn("__m", match("host", "path"))
    return out.withColumns({"rule": F.col("__m.rule"), "verdict": F.col("__m.verdict")}).drop("__m")


def _judge_by_join(parsed: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    """For rule lists of any length: equi-join on the host's suffixes, then the longest path prefix."""
    spark = parsed.sparkSession
    side = spark.createDataFrame([(*r, len(r.host) + len(r.path)) for r in rules], "r_verdict string, r_host string, r_path string, r_size int")
    keys = parsed.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hits = keys.withColumn("r_host", F.explode(hosts)).join(side, "r_host").where("startswith(path, r_path)")
    rank = F.struct("r_size", F.length("r_host").alias("hl"), (F.col("r_verdict") == "block").alias("b"), "r_verdict", "r_path", "r_host")
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("__m"))
    out = parsed.join(best, ["host", "path"], "left").withColumns({"rule": F.concat("__m.r_host", "__m.r_path"), "verdict": F.coalesce("__m.r_verdict", F.lit(default))})
    return out.drop("__m").select(*[c for c in parsed.columns if c not in ("rule", "verdict")], "rule", "verdict")
