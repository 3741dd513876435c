"""Quality rules, line first: rules judge every line, failures go, and documents that lose too much text are rejected.

DataFrame functions only, and no shuffle: a text is split once into words and once into
lines.  Windows of words are compared by 64-bit hashes made by doubling (1, 2, 4, 8
words), so a text of n words costs about n log n steps whatever its length, and only
texts with a repeated window sort their windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

# White space, the symbols that are counted, the window of repeated words.
SPACE = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Separators of menus, marks of mark-up and noise, ends of sentences, and what boilerplate lines say.
SEPARATORS = "|»›•·>"
NOISE = "#*$%&<>{}~^_\\"
SENTENCE_END = r"[.!?…。！？][\"'”’»)\]]*(?:[\x20\x09-\x0D]|\z)"
BOILERPLATE = (
    r"(?:^|[^a-z])(?:all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|accept (?:all )?cookies|uses cookies|click here|read more|sign up|sign in|log in|"
    r"subscribe to|share (?:this )?on|enable javascript|lorem ipsum|licensed under|copyright (?:\(c\)|©|[0-9]{4}))(?:[^a-z]|\z)"
)
BOILERPLATE_WORDS = 20
#: A document that loses more than 30 of 100 word characters with its failing lines is rejected.
MAX_LOST = (30, 100)
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "cleaned", "removed", "lost_chars", "kept")


def _trim(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACE))


def _chars(x: Column) -> Column:
    """Code points that aren't white space."""
    return F.length(F.translate(x, SPACE, "")).cast("long")


def _count_of(x: Column, chars: str) -> Column:
    return (F.length(x) - F.length(F.translate(x, chars, ""))).cast("long")


def _joined(hashes: Column, step: int) -> Column:
    """Hashes of windows twice as long, from those that start ``step`` apart; the last ``step`` are of no use."""
    return F.zip_with(hashes, F.slice(hashes, step + 1, F.size(hashes)), lambda a, b: F.xxhash64(a, b))


def failed_rule(line: Column, n_words: Column) -> Column:
    """Name of the first rule that a trimmed line of ``n_words`` words fails; null if it passes.

    navigation: a separator for every five words or more; symbols: a mark of noise for
    every two words or more; shouting: doubled ``!`` or ``?`` for every three words or
    more; boilerplate: at most 20 words that hold a known phrase; punctuation: no
    sentence ends in the line.
    """
    doubled = sum((F.length(line) - F.length(F.replace(line, F.lit(m * 2), F.lit(""))) for m in "!?"), F.lit(0)) / 2
    return (
        F.when(5 * _count_of(line, SEPARATORS) >= n_words, "navigation")
        .when(2 * _count_of(line, NOISE) >= n_words, "symbols")
        .when(3 * doubled >= n_words, "shouting")
        .when((n_words <= BOILERPLATE_WORDS) & lower_ascii(line).rlike(BOILERPLATE), "boilerplate")
        .when(~line.rlike(SENTENCE_END), "punctuation")
    )


def clean(docs: DataFrame, text_col: str = "text", max_lost: tuple[int, int] = MAX_LOST) -> DataFrame:
    """``docs`` with the columns of ADDED; columns of these names are replaced.

    ``cleaned`` is the text without lines that fail a rule, repeat an earlier line or
    hold no word; ``removed`` names the rule of every failing line (repeats aside) and
    ``lost_chars`` counts the word characters of all removed lines.  ``kept`` is false
    where ``base_failed`` is (fewer than 20 words, or more than 30 of 100 words in
    repeated windows), where more than ``max_lost`` of the word characters go, and
    where nothing is left.  Null and empty texts have zeros, an empty ``cleaned`` and
    aren't kept.  Rows stay one to one, repeats included; an empty table gives an empty one.
    """
    own = [c for c in docs.columns if c not in ADDED]
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("__t", text).withColumn("__w", F.when(_trim(F.col("__t")) != "", F.split(_trim(F.col("__t")), GAP, -1)).otherwise(F.array().cast("array<string>")))
    # repeated windows
    df = df.withColumn("__n", F.size("__w").cast("long")).withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w))).drop("__w")
    for step in (1, 2, 4):
        df = df.withColumn("__h", _joined(F.col("__h"), step))
    df = df.withColumn("__h", F.slice("__h", 1, F.greatest(F.col("__n") - (WINDOW - 1), F.lit(0)).cast("int")))
    df = df.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, y: F.coalesce(x.h == y.h, F.lit(False))
    df = df.withColumn("__p", F.sort_array(F.transform(F.filter("__s", lambda x, i: same(x, F.get("__s", i - 1)) | same(x, F.get("__s", i + 1))), lambda x: x.i))).drop("__h", "__s")
    reach = F.transform("__p", lambda p, i: F.coalesce(F.least(F.get("__p", i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    repeated = F.coalesce(F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    # lines: of equal ones the first is judged
    df = df.withColumn("__r", repeated).withColumn("__l", F.filter(F.split("__t", "\n", -1), lambda x: _trim(x) != "")).withColumn("__d", F.array_distinct("__l"))
    df = df.withColumn("__j", F.transform("__d", lambda x: F.struct(x.alias("line"), _trim(x).alias("t"), F.size(F.split(_trim(x), GAP, -1)).cast("long").alias("n"))))
    df = df.withColumn("__j", F.transform("__j", lambda x: F.struct(x.line.alias("line"), failed_rule(x.t, x.n).alias("rule"))))
    good = F.transform(F.filter("__j", lambda x: x.rule.isNull()), lambda x: x.line)
    all_chars = _chars(F.col("__t"))
    df = df.select(
        *own,
        F.col("__n").alias("n_words"),
        all_chars.alias("word_chars"),
        _count_of(F.col("__t"), SYMBOLS).alias("n_symbols"),
        (F.size("__l") - F.size("__d")).cast("long").alias("n_dup_lines"),
        F.col("__r").alias("n_repeat_words"),
        ((F.col("__n") < 20) | (100 * F.col("__r") > 30 * F.col("__n"))).alias("base_failed"),
        F.array_join(good, "\n").alias("cleaned"),
        F.filter(F.transform("__j", lambda x: x.rule), lambda r: r.isNotNull()).alias("removed"),
    )
    df = df.withColumn("lost_chars", F.col("word_chars") - _chars(F.col("cleaned")))
    most, of = max_lost
    return df.withColumn("kept", ~F.col("base_failed") & (of * F.col("lost_chars") <= most * F.col("word_chars")) & (F.col("cleaned") != ""))


def digests(docs: DataFrame, **options) -> DataFrame:
    """One row per document: its counts, both verdicts, and hash, removed lines and lost characters of the cleaned text.

    Null and empty texts have zeros; repeated rows and null ids keep their rows; an
    empty table gives an empty one.
    """
    found = clean(docs.select("doc_id", "text"), **options)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select("doc_id", *counts, F.size("removed").cast("long").alias("n_failed_lines"), "lost_chars", F.sha2("cleaned", 256).alias("cleaned_sha256"))
