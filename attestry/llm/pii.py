"""PII: information-theoretic sanitisation.

Personal data are found by pattern.  The corpus then says which words give them
away: for a protected entity e and a word t of the same document, PMI(e; t) / IC(e) is
the share of e's information that t discloses, from document frequencies over all
documents and whole texts.  An entity is a single value, or a kind of value ("some
phone number").  Words over the upper threshold are removed, words between the two
generalised, in the documents that hold the entity.

A frequency of few documents says little, so a word is judged only if that many of
the entity's contexts would hold it by chance with less than ALPHA over all words
judged (Chernoff's bound on a Poisson count, corrected for the number of pairs).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, join_per_key

# The base kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W\d_]{3,}")

#: Code points on either side of a value that tell its contexts apart: copies of one document are one context.
AROUND = 60
#: Chance, over all pairs judged, that any word passes for a disclosing one though it isn't.
ALPHA = 0.05
#: Disclosed share from which a word is generalised, and from which it is removed.
GENERALISE, REMOVE = 0.6, 0.9
#: With more words, values or pairs than these, joins take the place of broadcast look-ups.
MAX_TERMS, MAX_RISKS = 200_000, 200_000


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of the personal data in a whole text, sorted."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:  # from each @ back over the local part, never behind the match before
        left = at
        while left > done and text[left - 1] in LOCAL:
            left -= 1
        if left < at and (m := DOMAIN.match(text, at + 1)):
            done = m.end()
            out.append((left, 0, done))
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if 14 <= m.end() - m.start():
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def entities(text: str, base: list[tuple[int, int, int]]) -> dict[str, int]:
    """The protected entities of a text, kinds and values, each with a hash of what stands around its first place."""
    out: dict[str, int] = {}
    for a, kind, b in base:
        around = f"{text[max(0, a - AROUND):a]}\0{text[b:b + AROUND]}"
        context = int.from_bytes(hashlib.blake2b(around.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)
        for e in (KINDS[kind], f"{KINDS[kind]}:{text[a:b].lower()}"):
            out.setdefault(e, context)
    return out


def free_words(text: str, base: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """The words of a whole text that overlap no base span."""
    at = 0
    top = 0
    spans = [(x, top := max(top, y)) for x, _, y in base]  # ends so far, so that both sides ascend
    for m in WORD.finditer(text):
        while at < len(spans) and spans[at][1] <= m.start():
            at += 1
        if at == len(spans) or m.end() <= spans[at][0]:
            yield m


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("text"))


def values(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(entity, n_e, k_e): documents and distinct contexts of each protected value and kind."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            count: Counter = Counter()
            for text in batch["text"]:
                if text and (base := base_spans(text)):
                    count.update(entities(text, base).items())
            yield pd.DataFrame([(*k, n) for k, n in count.items()], columns=["entity", "context", "n"])

    found = _texts(docs, text_col).mapInPandas(run, "entity string, context long, n long")
    each = found.groupBy("entity", "context").agg(F.sum("n").alias("n"))
    return each.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count("*").alias("k_e"))


def pairs(docs: DataFrame, wanted: DataFrame, n_wanted: int, text_col: str = "text") -> DataFrame:
    """(entity, word, n_et, k_et): documents and distinct contexts that hold both, for the entities ``wanted``.

    Kinds are few and taken always; ``wanted`` values are looked up in a broadcast set
    if they are at most MAX_RISKS, else the pairs of all values are made and joined.
    """
    shared = docs.sparkSession.sparkContext.broadcast({r.entity for r in wanted.collect()}) if n_wanted <= MAX_RISKS else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            count: Counter = Counter()
            for text in batch["text"]:
                if text and (base := base_spans(text)):
                    held = {e: c for e, c in entities(text, base).items() if shared is None or e in shared.value}
                    words = {m.group().lower() for m in free_words(text, base)} if held else ()
                    count.update((e, w, c) for e, c in held.items() for w in words)
                if len(count) > 200_000:
                    yield pd.DataFrame([(*k, n) for k, n in count.items()], columns=["entity", "word", "context", "n"])
                    count.clear()
            yield pd.DataFrame([(*k, n) for k, n in count.items()], columns=["entity", "word", "context", "n"])

    found = _texts(docs, text_col).mapInPandas(run, "entity string, word string, context long, n long")
    if shared is None:
        found = found.join(wanted.select("entity"), "entity", "left_semi")
    each = found.groupBy("entity", "word", "context").agg(F.sum("n").alias("n"))
    return each.groupBy("entity", "word").agg(F.sum("n").alias("n_et"), F.count("*").alias("k_et"))


def document_words(docs: DataFrame, wanted=None, text_col: str = "text") -> DataFrame:
    """(words): a row for each document with its distinct words, those of the broadcast set ``wanted`` only if there is one.

    Counts are left to the aggregate that follows, so the rows made grow with the
    documents, not with tasks times words.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only = wanted.value if wanted else None
        for batch in batches:
            here = [{w.lower() for w in WORD.findall(text or "")} for text in batch["text"]]
            yield pd.DataFrame({"words": pd.Series([list(h if only is None else only.intersection(h)) for h in here], dtype=object)})

    return _texts(docs, text_col).mapInPandas(run, "words array<string>")


def document_frequency(docs: DataFrame, words: DataFrame, n_words: int, text_col: str = "text", limit: int | None = None) -> DataFrame:
    """(word, n_t) over all documents of the words asked for; one rule for words, whichever way they are looked up."""
    few = n_words <= (MAX_TERMS if limit is None else limit)
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(r.word for r in words.collect())) if few else None  # n_words <= MAX_TERMS
    found = document_words(docs, shared, text_col).select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n_t"))
    return found if few else found.join(words, "word", "left_semi")


def disclosure(docs: DataFrame, text_col: str = "text", alpha: float = ALPHA, generalise: float = GENERALISE) -> DataFrame:
    """(entity, word, share): the words that disclose at least ``generalise`` of a protected entity's information.

    With n documents, a word in n_t of them and an entity in k_e contexts, chance puts
    the word into k_e * n_t / n of these; k_et are observed.  One context can't tell a
    word's rarity from its tie to the entity, so two are needed at least.
    """
    n = docs.count()
    entity = cut(values(docs, text_col).where("k_e > 1"))
    n_wanted = entity.count()
    nothing = docs.sparkSession.createDataFrame([], "entity string, word string, share double")
    if not n_wanted:
        return nothing
    every = cut(pairs(docs, entity, n_wanted, text_col))
    m = every.count()
    pair = every.where("k_et > 1").join(entity, "entity")
    # no word is in fewer documents than it shares with any kind or value, so this bound leaves few words to be counted in all
    low = every.groupBy("word").agg(F.max("n_et").alias("low"))
    chance = lambda n_t: _log_chance(F.col("k_et"), F.col("k_e") * n_t / F.lit(float(max(n, 1))))
    bound = F.lit(math.log(alpha / max(m, 1)))
    pair = cut(join_per_key(cut(pair.where(chance(F.col("n_et")) <= bound)), low, ["word"]).where(chance(F.col("low")) <= bound).drop("low"))
    words = pair.select("word").distinct()
    n_words = words.count()
    if not n_words:
        return nothing
    df = document_frequency(docs, words, n_words, text_col)
    ic = F.log2(F.lit(float(n)) / F.col("n_e"))
    pmi = F.log2(F.least("n_et", "n_e", "n_t") * F.lit(float(n)) / (F.col("n_e") * F.col("n_t")))
    share = F.when(ic > 0, pmi / ic).otherwise(F.lit(0.0))
    judged = pair.join(df, "word").where(chance(F.greatest("n_t", "n_et")) <= bound)
    return judged.select("entity", "word", share.alias("share")).where(F.col("share") >= generalise)


def _log_chance(k, mean):
    """Upper bound of log P(a Poisson count with this mean is k or more)."""
    return F.when(k > mean, k - mean + k * F.log(mean / k)).otherwise(F.lit(0.0))


def find(docs: DataFrame, text_col: str = "text", risks: DataFrame | None = None, remove: float = REMOVE) -> DataFrame:
    """``docs`` with ``spans``: array<struct<start, rank, end, kind>>, sorted.

    Base kinds come first (ranks 0 to 3); words that disclose an entity of their own
    document are ``term`` (rank 4, to be removed) or ``general`` (rank 5, to be generalised).
    A null text counts as empty and has no spans; rows stay one to one; a column that
    is already named ``spans`` is replaced.
    """
    risks = disclosure(docs, text_col) if risks is None else risks
    risks = cut(risks)
    n = risks.count()
    spans_of = _spans(None, remove)
    docs = docs.drop("spans")
    if n <= MAX_RISKS:
        shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in risks.select("entity", "word", "share").collect()])
        return docs.withColumn("spans", _spans(shared, remove)(F.col(text_col).cast("string")))
    return _find_by_join(docs, text_col, risks, remove, spans_of)


def _spans(shared, remove: float):
    @F.pandas_udf("array<struct<start:long,rank:int,end:long,kind:string>>")
    def spans(texts: pd.Series) -> pd.Series:
        known: dict[str, list[tuple[str, float]]] = {}
        for e, w, s in shared.value if shared else ():
            known.setdefault(e, []).append((w, s))
        out = []
        for text in texts:
            base = base_spans(text or "")
            found = [(a, k, b, KINDS[k]) for a, k, b in base]
            if base and known:
                mine: dict[str, float] = {}
                for e in entities(text, base):
                    for w, s in known.get(e, ()):
                        mine[w] = max(s, mine.get(w, 0))
                for m in free_words(text, base) if mine else ():
                    if (s := mine.get(m.group().lower())) is not None:
                        found.append((m.start(), 4, m.end(), "term") if s >= remove else (m.start(), 5, m.end(), "general"))
            out.append([dict(zip(("start", "rank", "end", "kind"), x, strict=True)) for x in sorted(found)])
        return pd.Series(out)

    return spans


def _find_by_join(docs: DataFrame, text_col: str, risks: DataFrame, remove: float, spans_of) -> DataFrame:
    """The same for any number of risky words: the words near protected values are joined with them."""

    @F.pandas_udf("array<struct<entity:string,start:long,end:long,word:string>>")
    def near(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            base = base_spans(t or "")
            held = entities(t, base) if base else {}
            out.append([{"entity": e, "start": m.start(), "end": m.end(), "word": m.group().lower()} for m in (free_words(t, base) if base else ()) for e in held])
        return pd.Series(out)

    rows = docs.withColumn("__row", F.monotonically_increasing_id())
    text = F.col(text_col).cast("string")
    each = rows.where(text.rlike("[0-9@]")).select("__row", F.explode(near(text)).alias("x")).select("__row", "x.*")
    hit = each.join(risks, ["entity", "word"]).groupBy("__row", "start", "end").agg(F.max("share").alias("s"))
    more = hit.select("__row", F.struct("start", F.when(F.col("s") >= remove, 4).otherwise(5).alias("rank"), "end", F.when(F.col("s") >= remove, "term").otherwise("general").alias("kind")).alias("x"))
    more = more.groupBy("__row").agg(F.collect_list("x").alias("__more"))
    out = rows.withColumn("spans", spans_of(text)).join(more, "__row", "left")
    return out.withColumn("spans", F.array_sort(F.when(F.col("__more").isNull(), F.col("spans")).otherwise(F.concat("spans", "__more")))).drop("__row", "__more")


def redact_text(text: str, spans) -> str:
    """``text`` with base values as ``[KIND]``, disclosing words removed, and others as a general class."""
    out, at = [], 0
    for s in spans:
        a, b, kind = s["start"], s["end"], s["kind"]
        if a < at:  # what overlaps a value that is already gone
            at = max(at, b)
            continue
        out.append(text[at:a])
        if kind == "general":
            out.append("[Name]" if text[a].isupper() else "[word]")
        elif kind != "term":
            out.append(f"[{kind.upper()}]")
        at = b
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``text_col`` redacted; columns and rows otherwise unchanged, null texts stay null."""

    @F.pandas_udf("string")
    def redacted(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or s is None or not len(s) else redact_text(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    kept = docs.withColumnRenamed("spans", "__spans") if "spans" in docs.columns else docs
    out = find(kept, text_col, **options).withColumn(text_col, redacted(F.col(text_col), F.col("spans"))).drop("spans")
    return out.withColumnRenamed("__spans", "spans").select(docs.columns)


def digests(docs: DataFrame, **options) -> DataFrame:
    """One row per document: counts of the base kinds, their hash, and all spans as text.

    Null and empty texts have no spans (the hash of an empty string); repeated rows give
    repeated results, null ids keep their rows, and an empty table gives an empty one.
    """
    found = find(docs.select("doc_id", "text"), **options).drop("text")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
