"""Secret scans: candidates by pattern, told apart by how widely the corpus owns them.

DataFrame functions only.  Positions come from the pieces between the matches: the
lengths of pieces and matches, summed up in blocks, are the matches' places, so a
text with n matches costs about n steps and no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, join_per_key

# The patterns of the base kinds, in the order of their kinds.
KINDS = ("assign", "access", "hex")
ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a shorter run has no longer one inside, so nothing is lost by asking for 18 here
HEX = r"[0-9a-f]{16,}"
#: Unlabelled candidates: long runs that mix both cases and digits.
LOOSE = r"[A-Za-z0-9_-]{20,}"
#: A value held by more owners, or in more repositories, than this is an example that people copy, not one owner's secret.
MAX_OWNERS, MAX_REPOS = 2, 3

_BLOCK = 64
_SPAN = "array<struct<start:long,end:long,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def find_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points, end exclusive."""

    def placed(hits: Column, gaps: Column) -> Column:
        sizes = F.transform(hits, lambda h, i: (F.length(F.get(gaps, i)) + F.length(h)).cast("long"))

        def with_sizes(n: Column) -> Column:
            sums = F.transform(F.sequence(F.lit(0), F.floor(F.size(n) / _BLOCK).cast("int")), lambda b: _sum(F.slice(n, b * _BLOCK + 1, F.lit(_BLOCK))))
            before = F.aggregate(sums, F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
            return let(
                before,
                lambda base: F.transform(
                    hits,
                    lambda h, i: let(
                        F.get(base, F.floor(i / _BLOCK).cast("int")) + _sum(F.slice(n, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK + 1)),
                        lambda end: F.struct((end - F.length(h)).alias("start"), end.alias("end"), (F.regexp_extract(h, pattern, group) if group else h).alias("value")),
                    ),
                ),
            )

        return let(sizes, with_sizes)

    none = F.array().cast(_SPAN)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda hits: F.when(F.size(hits) > 0, let(F.split(text, pattern, -1), lambda gaps: placed(hits, gaps))).otherwise(none))


def _typed(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.lit(rank).alias("rank"), s.end.alias("end"), F.lit(kind).alias("kind"), s.value.alias("value")))


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``loose``: arrays of struct<start, rank, end, kind, value>, sorted.

    A null text counts as empty; a text without matches has empty arrays.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(find_spans(text, ASSIGN, 1), lambda s: F.length(s.value) >= 12)
    base = F.array_sort(F.concat(_typed(assign, "assign", 0), _typed(find_spans(text, ACCESS), "access", 1), _typed(find_spans(text, HEX), "hex", 2)))
    mixed = F.filter(find_spans(text, LOOSE), lambda s: s.value.rlike("[0-9]") & s.value.rlike("[A-Z]") & s.value.rlike("[a-z]"))
    out = docs.withColumn("base", base).withColumn("loose", _typed(mixed, "live", 3))
    free = F.filter("loose", lambda x: ~F.exists("base", lambda b: (b.start < x.end) & (x.start < b.end)))
    return out.withColumn("loose", free)


def ownership(found: DataFrame, owner_col: str = "owner", repo_col: str = "repo") -> DataFrame:
    """(h, n_owners, n_repos) of every candidate value; ``h`` is its SHA-256.

    Values are first made distinct by owner and repository, so a value that a third
    of all rows hold is collapsed in every map task before anything is shuffled.
    """
    pairs = found.select(F.explode(F.concat("base", "loose")).alias("s"), owner_col, repo_col)
    pairs = pairs.select(F.sha2("s.value", 256).alias("h"), F.col(owner_col).alias("o"), F.col(repo_col).alias("r")).distinct()
    by_owner = pairs.groupBy("h", "o").agg(F.count("*").alias("n"))
    return by_owner.groupBy("h").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repos"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang"), max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row for each row of ``docs``: its id as ``doc_id``, ``base`` and ``live`` spans.

    ``base`` are the spans of the patterns, each with ``live`` (true where at most
    ``max_owners`` owners in at most ``max_repos`` repositories hold the value anywhere
    in the corpus), ``n_owners`` and ``n_repos``; ``loose`` are further spans that only
    ownership makes likely: mixed runs held by few owners in few repositories.  A value
    that one owner copies into many repositories counts as an example too.  Null owners and repositories count as one unnamed owner; repeated
    rows give repeated results; an empty table gives an empty one.
    """
    repo = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repo_cols])
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        repo.alias("repo"),
    )
    found = cut(candidates(rows).drop("text"))
    has = F.size("base") + F.size("loose") > 0
    each = found.where(has).select("row", F.explode(F.concat("base", "loose")).alias("s"))
    owned = join_per_key(each.withColumn("h", F.sha2("s.value", 256)), ownership(found.where(has)), ["h"])
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    mark = F.struct("s.start", "s.rank", "s.end", "s.kind", live.alias("live"), "n_owners", "n_repos")
    marked = owned.groupBy("row").agg(F.array_sort(F.collect_list(mark)).alias("all"))
    with_any = found.where(has).select("row", "doc_id").join(marked, "row").drop("row")
    none = found.where(~has).select("doc_id", F.array().cast(marked.schema["all"].dataType).alias("all"))
    out = with_any.unionByName(none)
    return out.select("doc_id", F.filter("all", lambda s: s["rank"] < 3).alias("base"), F.filter("all", lambda s: (s["rank"] == 3) & s.live).alias("loose"))


def digests(docs: DataFrame, **options) -> DataFrame:
    """One row per document: counts of the base kinds, their hash, all spans, how many base values look live, and the most repositories that hold one.

    Null and empty texts have no spans (``max_repos`` 0); repeated rows give repeated
    results, null ids keep their rows, and an empty table gives an empty one.
    """
    found = scan(docs, **options)
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(text(F.col("base")), 256).alias("base_sha256"),
        text(F.array_sort(F.concat("base", "loose"))).alias("spans"),
        F.size(F.filter("base", lambda s: s.live)).cast("long").alias("n_live"),
        F.coalesce(F.array_max(F.transform("base", lambda s: s.n_repos)), F.lit(0)).cast("long").alias("max_repos"),
    )
