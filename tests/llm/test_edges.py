"""Nulls, empty and long texts, repeats, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attestry.llm import ann, bpe, mixing, ngram_jaccard, pii, queries, secrets, spotsigs, suffix_dedup, toxicity, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30_000
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, "a b", "en", "s", 3),
    (4, LONG, "en", "s", len(LONG)),
    (5, "the same text of some words that repeats here and there until it has a good length for windows of bytes and more", "en", "s", 110),
    (5, "the same text of some words that repeats here and there until it has a good length for windows of bytes and more", "en", "s", 110),
    (None, "no id \U0001f600 token = 'AbcdefghijklmN1' mail me.x@y.org", "de", "t", 40),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, None), (3, None, 1), (4, 0, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")


QUERIES = {
    "op1": lambda d: pii.digests(d),
    "op2": lambda d: ngram_jaccard.components(d),
    "op4": lambda d: spotsigs.digests(d),
    "op5": lambda d: suffix_dedup.digests(d),
    "op6": lambda d: bpe.digests(d, queries.RANKS, queries.PATTERN),
    "op8": lambda d: mixing.mix(d, with_weights=True),
    "op10": lambda d: secrets.digests(d),
}


@pytest.mark.parametrize("name", QUERIES)
def test_one_row_for_each_row(docs, name):
    clash = docs.withColumns({c: F.lit("x") for c in ("ids", "spans", "base", "score", "row", "p", "tokens_", "key", "h")})
    got = QUERIES[name](clash).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_table(docs, name):
    assert QUERIES[name](docs.limit(0)).count() == 0


def test_toxicity_edges(docs, labels):
    got = toxicity.judge(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.judge(docs, labels.limit(0)).count() == len(ROWS)
    assert toxicity.judge(docs.limit(0), labels).count() == 0


def test_url_edges(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Org"), (5, "http://example.org/en/1x?q"), (5, "http://example.org/en/1x?q"), (6, "x://com/de/")], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages.withColumn("rule", F.lit("old")), queries.URL_RULES).collect()}
    assert got == {1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("a.org", "", None, "allow"), 5: ("example.org", "/en/1x", "example.org/en/1", "block"), 6: ("com", "/de/", "com/de/", "block")}
    assert url_filter.judge(pages.limit(0), queries.URL_RULES).count() == 0
    a = url_filter.judge(pages, queries.URL_RULES).select("page_id", "rule", "verdict").collect()
    b = url_filter.judge(pages, queries.URL_RULES, trie_rules=0).select("page_id", "rule", "verdict").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (40, [1.0]), (None, [1.0, 1.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") % 20 == 0).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0][:2] == [(1, 1), (2, 2)]
    assert not [r for r in got if r.query_id == 40]
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stage_edges(spark, docs, labels, tmp_path, stage):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    name, f = corpus_pipeline.STAGES[stage]
    out = f(spark, docs.withColumn("score", F.lit(1)), str(tmp_path))
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == list(corpus_pipeline.COLUMNS)
    out.collect()
    assert f(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_keep_one_of_repeated_ids(docs):
    kept = [r.doc_id for r in ngram_jaccard.keep_one(docs).collect()]
    assert kept.count(5) == 1 and {1, 2, 3, 4} <= set(kept)


def test_keep_one_tells_rows_apart_by_text(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (None, text("c")), (1, text("a")), (2, text("d")), (2, text("e")), (3, text("e")), (4, text("f")), (4, text("f")), (5, ""), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in ngram_jaccard.keep_one(df).collect()), key=str)
    want = [(None, text("b")), (None, text("c")), (1, text("a")), (2, text("d")), (2, text("e")), (4, text("f")), (5, ""), (5, "")]
    assert got == sorted(want, key=str)
