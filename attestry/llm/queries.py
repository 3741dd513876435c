"""The training-data queries, registered by ``__spark_entry__`` and run over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, collocations, conversations, line_cleaning, mixing, ngram_jaccard, pii, secrets, spotsigs, suffix_dedup, toxicity, url_filter
from .common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data and of words that disclose them, for every whole text of ``documents``; see :func:`pii.digests`."""
    return pii.digests(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of each document's set of 3-word shingles and the smallest id linked with it at 90 %; see :func:`ngram_jaccard.components`."""
    return ngram_jaccard.components(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every url of ``pages``; null urls have an empty host and path; see :func:`url_filter.judge`."""
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness; see :func:`spotsigs.digests`."""
    return spotsigs.digests(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document without strings of 100 bytes that start earlier; see :func:`suffix_dedup.digests`."""
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their round trip; see :func:`bpe.digests`."""
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chance that each document is toxic, learned outside the held-out fifth; see :func:`toxicity.judge`."""
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and fate of every document in the mixture that meets the targets; see :func:`mixing.mix`."""
    return mixing.mix(table(spark, sf_dir, "documents"), with_weights=True)


def op9_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest others of every 20th vector by inner product; see :func:`ann.search`."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, told apart by who holds them; see :func:`secrets.digests`."""
    return secrets.digests(table(spark, sf_dir, "documents"))


def op11_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of words, symbols and repeats of every document, and whether enough of its lines pass the rules; see :func:`line_cleaning.digests`."""
    return line_cleaning.digests(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, the cheapest edits that repair it and the hash of what they leave; see :func:`conversations.digests`."""
    return conversations.digests(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two to five words of every language of ``documents``, by how much they occur beyond chance; see :func:`collocations.collocations`."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_url_filter": op3_url_filter,
    "op4_spotsigs": op4_spotsigs,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_toxicity": op7_toxicity,
    "op8_mixing": op8_mixing,
    "op9_multiprobe": op9_multiprobe,
    "op10_secrets": op10_secrets,
    "op11_line_cleaning": op11_line_cleaning,
    "op12_conversations": op12_conversations,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {}

SQL["op3_url_filter"] = r"""
WITH parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
),
rules(r_verdict, r_host, r_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
best AS (
  SELECT page_id, host, path, r_verdict, r_host || r_path AS rule,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r_host) + length(r_path) DESC NULLS LAST, length(r_host) DESC, r_verdict DESC) AS n
  FROM parsed LEFT JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM best WHERE n = 1
"""

_ASSIGN = secrets.ASSIGN.replace("'", "''")


def _duck_spans(pattern: str, group: int, kind: str, rank: int, test: str) -> str:
    """DuckDB: spans of the matches of ``pattern`` as list of structs, from the pieces between the matches."""
    value = f"regexp_extract(hits[i], '{pattern}', {group})" if group else "hits[i]"
    return f"""(SELECT list(s ORDER BY s) FROM (
      SELECT unnest(list_transform(range(1, len(hits) + 1), lambda i: {{'start': ends[i] - length(hits[i]), 'rank': {rank}, 'end': ends[i], 'kind': '{kind}', 'value': {value}}})) AS s
      FROM (SELECT hits, list_transform(range(1, len(hits) + 1), lambda i: list_sum(list_transform(hits[1:i], lambda h: length(h))) + list_sum(list_transform(gaps[1:i], lambda g: length(g)))) AS ends
            FROM (SELECT regexp_extract_all(t, '{pattern}') AS hits, string_split_regex(t, '{pattern}') AS gaps))
    ) WHERE {test})"""


SQL["op10_secrets"] = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner, coalesce(source, '') || '/' || coalesce(lang, '') AS repo FROM documents),
found AS (
  SELECT row, doc_id, owner, repo,
    list_sort(list_concat(coalesce({_duck_spans(_ASSIGN, 1, "assign", 0, "length(s.value) >= 12")}, []),
                coalesce({_duck_spans(secrets.ACCESS, 0, "access", 1, "true")}, []),
                coalesce({_duck_spans(secrets.HEX, 0, "hex", 2, "true")}, []))) AS base,
    coalesce({_duck_spans(secrets.LOOSE, 0, "live", 3, "regexp_matches(s.value, '[0-9]') AND regexp_matches(s.value, '[A-Z]') AND regexp_matches(s.value, '[a-z]')")}, []) AS mixed
  FROM docs
),
free AS (SELECT row, doc_id, owner, repo, base, list_filter(mixed, lambda x: len(list_filter(base, lambda b: b.start < x."end" AND x.start < b."end")) = 0) AS loose FROM found),
each AS (SELECT row, owner, repo, unnest(list_concat(base, loose)) AS s FROM free),
owned AS (SELECT s.value AS value, count(DISTINCT owner) AS n_owners, count(DISTINCT repo) AS n_repos FROM each GROUP BY 1),
marked AS (SELECT row, s, n_repos, n_owners <= {secrets.MAX_OWNERS} AND n_repos <= {secrets.MAX_REPOS} AS live FROM each JOIN owned ON s.value = owned.value),
spans AS (
  SELECT row,
    string_agg(s.kind || ':' || s.start || ':' || s."end", ',' ORDER BY s.start, s.rank, s."end") FILTER (s.rank < 3) AS base,
    string_agg(s.kind || ':' || s.start || ':' || s."end", ',' ORDER BY s.start, s.rank, s."end") FILTER (s.rank < 3 OR live) AS spans,
    count(*) FILTER (s.kind = 'assign') AS n_assign, count(*) FILTER (s.kind = 'access') AS n_access, count(*) FILTER (s.kind = 'hex') AS n_hex,
    count(*) FILTER (s.rank < 3 AND live) AS n_live, max(n_repos) FILTER (s.rank < 3) AS max_repos
  FROM marked GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(max_repos, 0) AS max_repos
FROM docs LEFT JOIN spans USING (row)
"""

_quoted = lambda s: "'" + s.replace("'", "''") + "'"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_drop = lambda x, chars: f"length({x}) - length(translate({x}, {_quoted(chars)}, ''))"

SQL["op11_line_cleaning"] = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT row, list_filter(string_split_regex(t, '{line_cleaning.GAP}'), lambda x: x <> '') AS w FROM d),
grams AS (SELECT row, i, array_to_string(w[i : i + 7], ' ') AS g FROM (SELECT row, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS n FROM grams) WHERE n > 1),
reach AS (SELECT row, sum(k)::BIGINT AS n_repeat_words FROM (SELECT row, least(8, coalesce(lead(i) OVER (PARTITION BY row ORDER BY i) - i, 8)) AS k FROM twice) GROUP BY row),
lines AS (SELECT row, i, line, trim(line, {_SPACES}) AS t FROM (SELECT row, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d)),
worded AS (
  SELECT row, i, line, t, row_number() OVER (PARTITION BY row, line ORDER BY i) AS copy, len(string_split_regex(t, '{line_cleaning.GAP}')) AS n
  FROM lines WHERE t <> ''
),
judged AS (
  SELECT *, CASE
      WHEN 5 * ({_drop("t", line_cleaning.SEPARATORS)}) >= n THEN 'navigation'
      WHEN 2 * ({_drop("t", line_cleaning.NOISE)}) >= n THEN 'symbols'
      WHEN 3 * ((length(t) - length(replace(t, '!!', ''))) + (length(t) - length(replace(t, '??', '')))) / 2 >= n THEN 'shouting'
      WHEN n <= {line_cleaning.BOILERPLATE_WORDS} AND regexp_matches(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_quoted(line_cleaning.BOILERPLATE)}) THEN 'boilerplate'
      WHEN NOT regexp_matches(t, {_quoted(line_cleaning.SENTENCE_END)}) THEN 'punctuation' END AS rule
  FROM worded
),
per_doc AS (
  SELECT row, count(*) FILTER (copy > 1) AS n_dup_lines, count(*) FILTER (copy = 1 AND rule IS NOT NULL) AS n_failed_lines,
         string_agg(line, chr(10) ORDER BY i) FILTER (copy = 1 AND rule IS NULL) AS cleaned
  FROM judged GROUP BY row
),
everything AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(translate(t, {_SPACES}, ''))::BIGINT AS word_chars, ({_drop("t", line_cleaning.SYMBOLS)})::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_failed_lines, 0) AS n_failed_lines, coalesce(cleaned, '') AS cleaned
  FROM d JOIN w USING (row) LEFT JOIN reach USING (row) LEFT JOIN per_doc USING (row)
),
lost AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, (word_chars - length(translate(cleaned, {_SPACES}, '')))::BIGINT AS lost_chars FROM everything)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {line_cleaning.MAX_LOST[1]} * lost_chars <= {line_cleaning.MAX_LOST[0]} * word_chars AND cleaned <> '' AS kept,
       n_failed_lines, lost_chars, sha256(cleaned) AS cleaned_sha256
FROM lost
"""

SQL["op13_collocations"] = r"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, list_filter(string_split_regex(p, '[ \x09]+'), lambda w: w <> '') AS w FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0),
f AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM spots, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL
),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
cuts AS (
  SELECT c.lang, c.phrase, c.a, n.n, c.j, x.f AS l, y.f AS r, (1000 * c.a * n.n) // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN n USING (lang)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.j], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.j + 1 : ], ' ')
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM c), (SELECT unnest([2, 3, 4]) AS m) WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
left_ AS (SELECT best.* FROM best LEFT JOIN inner_ USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
