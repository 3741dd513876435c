"""Line cleaning against brute force, the rules line by line, and edge cases."""

import random
import re
from collections import Counter

import pytest

from attestry.llm import line_cleaning as lc

DOCS = "doc_id long, text string"
SENTENCE = "It was a fine day and the sun stood high above the hills when they left. "


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def test_counts_against_brute_force(spark):
    rng = random.Random(2)
    words = ["a", "b", "été", "|", "#x", "\U0001f600", "<b>", "c."]
    texts = [None, "", " \n\t", "a" * 100_000, "x y " * 20_000, "\x0b a\x0cb\rc \x85 d\xa0e"]
    texts += ["".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\t", "  ", "\r\n"]) for _ in range(rng.randint(0, 90))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(None, "a b c"), (1, "a b c")] * 2
    got = lc.clean(spark.createDataFrame(rows, DOCS)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[n] for n in names) == brute(r.text), r.text


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("Home | Shop | About us", "navigation"),
        ("the&&& end*** of### it%%%.", "symbols"),
        ("BUY!! NOW!! CHEAP!!", "shouting"),
        ("Copyright 2024 by the owner.", "boilerplate"),
        ("Please Read More.", "boilerplate"),
        ("The dialog inside the box was short.", None),
        ("a heading without an end", "punctuation"),
        ("He said: “no.”", None),
        ("今日は晴れです。", None),
    ],
)
def test_rules(spark, line, rule):
    r = lc.clean(spark.createDataFrame([(1, line)], DOCS)).first()
    assert r.removed == ([rule] if rule else []) and r.cleaned == ("" if rule else line)


def test_documents_go_by_what_they_lose(spark):
    prose = "\n".join(f"On day{i} the guest{i} saw place{i} and wrote word{i} about thing{i} in book{i}." for i in range(8))
    menu = "\n".join(f"Page{i} | Next{i} | Imprint{i} | Contact{i} | Search{i} | Help{i} | Map{i}" for i in range(20))
    rows = [(1, prose), (2, prose + "\nHome | Shop\n" + prose.split("\n")[0]), (3, prose + "\n" + menu), (4, SENTENCE)]
    got = {r.doc_id: r for r in lc.clean(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, True, False, False]
    assert got[2].cleaned == prose and got[2].n_dup_lines == 1 and got[3].removed == ["navigation"] * 20
    assert got[1].lost_chars == 0 and not got[3].base_failed and got[4].base_failed


def test_empty_and_clashing_columns(spark):
    assert lc.digests(spark.createDataFrame([], DOCS)).count() == 0
    df = lc.clean(spark.createDataFrame([(1, SENTENCE * 3, "no", 7)], DOCS + ", kept string, n_words int"))
    assert df.columns.count("kept") == 1 and df.first().n_words == 48
    assert df.columns == ["doc_id", "text", *lc.ADDED]
