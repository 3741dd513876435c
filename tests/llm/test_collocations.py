"""Collocations against brute force, with one trie, many tries and no trie."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from attestry.llm import collocations as cl

DOCS = "doc_id long, text string, lang string"


def brute(rows, min_count, max_words=5, top=2000):
    f = defaultdict(Counter)
    for _, text, lang in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                f[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        found = []
        many = {g: a for g, a in c.items() if len(g) > 1 and a >= min_count}
        inside = defaultdict(int)
        for g, a in many.items():
            for i in range(len(g)):
                for j in range(i + 2, len(g) + 1):
                    if j - i < len(g):
                        inside[g[i:j]] = max(inside[g[i:j]], a)
        for g, a in many.items():
            if inside[g] < a:
                score, k = min((1000 * a * n // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n, -s) for r, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(12)] + ["Éa", "ÜB", "The", "THE", "x\x0by", "a\tb", " ", "z\x00"]
    rows = []
    for d in range(150):
        text = "".join(rng.choice(words[: rng.randint(4, 20)]) + rng.choice([" ", " ", " ", "  ", ". ", "\n", ",", "\r"]) for _ in range(rng.randint(0, 60)))
        rows.append((d, text, rng.choice(["en", "en", "en", "de", None])))
    return [*rows, *rows[:20], (None, None, "en"), (1, "", "fr"), (2, "und hier", "und"), (3, "a b " * 30_000, "long")]


@pytest.mark.parametrize("limits", [{}, {"TRIE": 7}, {"VOCABULARY": 0}, {"MAX_PHRASES": 3}])
def test_against_brute_force(spark, monkeypatch, rows, limits):
    for name, value in limits.items():
        monkeypatch.setattr(cl, name, value)
    got = cl.collocations(spark.createDataFrame(rows, DOCS), min_count=6).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 6)


def test_top_and_exact_scores(spark, rows):
    got = cl.collocations(spark.createDataFrame(rows, DOCS), min_count=4, top=5).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4, top=5)
    found = spark.createDataFrame([("en", "a", 1, 3_000_000_000_000), ("en", "b", 1, 2_000_000_000_001), ("en", "a b", 2, 1_999_999_999_999)], "lang string, phrase string, k int, f long")
    score = cl._scored(found, spark.createDataFrame([("en", 9_000_000_000_007)], "lang string, n long")).first().score
    assert score == 1000 * 1_999_999_999_999 * 9_000_000_000_007 // (3_000_000_000_000 * 2_000_000_000_001)


def test_trie_holds_what_was_put_in():
    rng = np.random.default_rng(1)
    n = 300
    pairs = np.unique(np.r_[rng.integers(0, n * n, 4000), np.arange(n)])  # word 0 is followed by all
    triples = np.unique(rng.integers(0, len(pairs) * n, 5000))
    trie, nodes = cl.build_trie(n, [(pairs // n, pairs % n), (triples // n, triples % n)])
    assert len({*nodes[0], *nodes[1]}) == len(pairs) + len(triples) and min(nodes[0].min(), nodes[1].min()) >= n
    parents, numbers = np.divmod(np.arange(n * n), n)
    reached = trie.advance(parents, numbers)
    assert (np.flatnonzero(reached >= 0) == pairs).all() and (trie.name[reached[pairs]] == np.arange(len(pairs))).all()
    deeper = trie.advance(np.repeat(nodes[0], n), np.tile(np.arange(n), len(pairs)))
    assert (np.flatnonzero(deeper >= 0) == triples).all()


def test_empty(spark):
    assert cl.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert cl.collocations(spark.createDataFrame([(1, "a b c", None, 5, "x")], DOCS + ", rank long, phrase string")).count() == 0
