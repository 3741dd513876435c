"""Phrase collocation mining: Apriori levels counted by broadcast double-array tries.

Texts are tokenised once: frequent words become numbers, and runs of them are stored as
packed arrays in the shared folder; nothing else of the text is needed again.  Each level
makes two passes over these arrays in numpy:

1. every position whose first words and whose last words are frequent phrases (so the
   phrase may be one, and no other can) adds to a bucket chosen by the phrase's hash; the
   bucket sums bound the count of each phrase from above, and the phrases in buckets with
   enough occurrences are the candidates;
2. the candidates' double-array trie is broadcast; all positions advance one level at a
   time, accepting states are counted by ``bincount`` and summed over shards.

Vocabulary, buckets and tries are broadcast only within counted bounds: buckets have a
fixed upper number, more candidates than a trie may hold take several tries, and beyond
VOCABULARY words (or MAX_PHRASES phrases of a level) levels are counted by a shuffle instead, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_per_key, lower_ascii, small_side, stored

# What ends a piece, what parts words.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
MAX_WORDS, MIN_COUNT, TOP, SCALE = 5, 100, 2_000, 1_000
#: Words, and phrases of a level, that a task may hold; candidates of one trie.
VOCABULARY, MAX_PHRASES, TRIE = 2_000_000, 2_000_000, 500_000
#: Buckets of a level: one for every 16 words within these bounds, so that rare phrases don't fill them together.
FEWEST_BUCKETS, MOST_BUCKETS, WORDS_PER_BUCKET = 1 << 16, 1 << 22, 16
#: Numbers in a row of the stored arrays (at least), and bytes of text that are tokenised at once (a longer text is taken whole).
_CHUNK, _BYTES = 1 << 18, 2 << 20
#: Bytes of an Arrow batch.
BATCH, _BATCH_KEY = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
#: Numbers that a task of a pass takes.
_TASK = 16 << 20
#: Salts for the first cut of a language's ranking.
_SALTS = 32

_BYTE = np.arange(256, dtype=np.uint8)
_BYTE[ord("A") : ord("Z") + 1] += 32
_BYTE[[ord(c) for c in PIECE_ENDS]] = 10
_BYTE[9] = 32


def words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, word, f): occurrences of every word; null languages are ``und``."""
    text = F.translate(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), PIECE_ENDS + "\t", " " * (len(PIECE_ENDS) + 1))
    each = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.explode(F.split(text, " +")).alias("word"))
    return each.where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("f"))


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of BATCH bytes for what runs inside; texts and arrays are large, and both sides hold a batch whole."""
    before = spark.conf.get(_BATCH_KEY, None)
    spark.conf.set(_BATCH_KEY, str(BATCH))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_KEY) if before is None else spark.conf.set(_BATCH_KEY, before)


@dataclass
class Trie:
    """Double array: the child of node ``s`` by number ``c`` is ``t = base[s] + c`` if ``check[t] = s``.

    Nodes 0 to n - 1 are the words themselves (the root's children), so that a position's
    first state is its number; ``name[t]`` is the number that a deeper node was given.
    """

    base: np.ndarray
    check: np.ndarray
    name: np.ndarray
    n: int

    def advance(self, states: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The states one word on; -1 where no phrase of the trie goes on."""
        t = self.base[states] + numbers
        ok = (states >= 0) & (numbers >= 0) & (t >= 0) & (t < len(self.check))
        t = np.where(ok, t, 0)
        return np.where(ok & (self.check[t] == states), t, -1)


def build_trie(n: int, levels: list[tuple[np.ndarray, np.ndarray]]) -> tuple[Trie, list[np.ndarray]]:
    """The trie of ``n`` words and, level by level, of children: (number of the parent in its level, word).

    Returns it with the node of every child by level.  Parents with most children are
    placed first, each at the next base where all its children fall on free places
    (families of about one size search on from each other); parents with one child fill the gaps.
    """
    size = 2 * n + 2 * sum(len(p) for p, _ in levels) + 1024
    check = np.full(size, -1, dtype=np.int64)
    used = np.zeros(size, dtype=bool)
    used[:n] = True
    base = np.zeros(size, dtype=np.int64)
    name = np.arange(size, dtype=np.int64)
    nodes, above = [], np.arange(n, dtype=np.int64)
    for parents, numbers in levels:
        at = np.empty(len(parents), dtype=np.int64)
        order = np.lexsort((numbers, parents))
        starts = np.flatnonzero(np.r_[True, np.diff(parents[order]) != 0]) if len(order) else np.array([], dtype=np.int64)
        sizes = np.diff(np.r_[starts, len(order)])
        first, scale = n, 0
        for g in np.argsort(-sizes, kind="stable"):
            if sizes[g] == 1:
                break
            if int(sizes[g]).bit_length() != scale:  # smaller families look for gaps from the start again
                first, scale = n, int(sizes[g]).bit_length()
            rows = order[starts[g] : starts[g] + sizes[g]]
            cs = numbers[rows]
            steps = cs - cs[0]
            while True:
                if first + steps[-1] + 4096 >= len(used):
                    more = len(used) + int(steps[-1]) + 4096
                    used, check, base, name = np.r_[used, np.zeros(more, bool)], np.r_[check, np.full(more, -1)], np.r_[base, np.zeros(more, np.int64)], np.r_[name, np.zeros(more, np.int64)]
                fit = first + np.flatnonzero(~used[first : first + 4096])
                for d in steps[1:]:
                    fit = fit[~used[fit + d]]
                    if not len(fit):
                        break
                if len(fit):
                    break
                first += 4096
            at[rows] = fit[0] + steps
            used[at[rows]] = True
        single = order[starts[sizes == 1]]
        free = n + np.flatnonzero(~used[n:])[: len(single)]
        if len(free) < len(single):
            more = len(single)
            free = np.r_[free, len(used) + np.arange(len(single) - len(free))]
            used, check, base, name = np.r_[used, np.zeros(more, bool)], np.r_[check, np.full(more, -1)], np.r_[base, np.zeros(more, np.int64)], np.r_[name, np.zeros(more, np.int64)]
        at[single] = free
        used[free] = True
        check[at], name[at] = above[parents], np.arange(len(parents))
        base[above[parents]] = at - numbers
        nodes.append(at)
        above = at
    end = int(np.flatnonzero(used)[-1]) + 1 if used.any() else 0
    return Trie(base[:end].copy(), check[:end].copy(), name[:end].copy(), n), nodes


def _runs(batch: pa.RecordBatch, vocabularies: dict[str, tuple[pa.Array, np.ndarray]]) -> Iterator[np.ndarray]:
    """Numbers of the frequent words of texts of a batch (lang, text), in runs of two or more parted by -1."""
    langs = batch.column("lang")
    for lang in langs.unique().to_pylist():
        if lang not in vocabularies:
            continue
        values, numbers = vocabularies[lang]
        texts = batch.column("text").filter(pc.equal(langs, lang)).cast(pa.large_binary())
        at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.array([], np.uint8)
        k = 0
        while k < len(texts):
            to = max(k + 1, int(np.searchsorted(at, at[k] + _BYTES, side="right")) - 1)
            data = _BYTE[raw[at[k] : at[to]]]
            # each text ends its last piece: a mark between texts
            data = np.insert(data, at[k + 1 : to + 1] - at[k], 10)
            k = to
            inside = (data != 32) & (data != 10)
            edge = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
            begins, ends = edge[::2], edge[1::2]
            if not len(begins):
                continue
            offsets = np.r_[0, np.cumsum(ends - begins)].astype(np.int64)
            found = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[inside].tobytes())])
            place = pc.index_in(found, value_set=values).fill_null(-1).to_numpy(zero_copy_only=False)
            ids = np.where(place >= 0, numbers[np.maximum(place, 0)], -1).astype(np.int32)
            # a -1 before each word that begins a piece
            marks = np.cumsum(data == 10)
            fresh = np.r_[True, np.diff(marks[begins]) > 0]
            ids = np.insert(ids, np.flatnonzero(fresh), -1)
            known = ids >= 0
            beside = known & (np.r_[False, known[:-1]] | np.r_[known[1:], False])
            keep = beside | ((ids < 0) & np.r_[False, beside[:-1]])
            yield ids[keep]


def encode(docs: DataFrame, vocabulary: list[tuple[str, str, int]], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(ids: binary) runs of the frequent words ``vocabulary`` (lang, word, number) as packed int32, with -1 between runs, written to the shared folder."""
    spark, by_lang = docs.sparkSession, {}
    for lang, word, number in vocabulary:
        by_lang.setdefault(lang, ([], []))
        by_lang[lang][0].append(word.encode())
        by_lang[lang][1].append(number)
    shared = spark.sparkContext.broadcast(by_lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {lang: (pa.array(w, pa.large_binary()), np.array(n, dtype=np.int64)) for lang, (w, n) in shared.value.items()}
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            parted = [x for ids in held for x in (ids, [-1])]
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(parted).astype(np.int32).tobytes()], pa.binary())], names=["ids"])

        for batch in batches:
            for ids in _runs(batch, tables):
                held.append(ids)
                size += len(ids)
                if size >= _CHUNK:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    return stored(docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text).mapInArrow(run, "ids binary"))


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch.column("ids"):
            yield np.frombuffer(x.as_buffer(), dtype=np.int32).astype(np.int64)


def _extensions(ids: np.ndarray, trie: Trie, k: int) -> np.ndarray:
    """Codes (prefix, word) of all phrases of ``k`` words in the text whose first and last k - 1 words are frequent."""
    states = ids
    for j in range(1, k - 1):
        states = trie.advance(states[:-1], ids[j:])
    ok = (states[:-1] >= 0) & (states[1:] >= 0)
    return trie.name[states[:-1][ok]] * trie.n + ids[k - 1 :][ok]


def _buckets(total: int) -> int:
    return min(max(1 << (total // WORDS_PER_BUCKET).bit_length(), FEWEST_BUCKETS), MOST_BUCKETS)


def _bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int64) & (buckets - 1)


_PART = 1 << 16


def _frequent_buckets(stored_ids: DataFrame, trie, k: int, buckets: int, min_count: int) -> np.ndarray:
    """Mask of the buckets whose phrases occur ``min_count`` times or more together.

    Tasks send their counts in parts of fixed size, sparse or dense; parts are summed
    in two steps, so the tasks' number doesn't decide what one group holds.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(buckets, dtype=np.int32)
        for ids in _arrays(batches):
            if len(ids) >= k:
                np.add.at(total, _bucket(_extensions(ids, trie.value, k), buckets), 1)
                np.minimum(total, min_count, out=total)  # more doesn't matter, and can't overflow
        yield from parts(total, TaskContext.get().partitionId() // 256)

    def parts(total: np.ndarray, group: int) -> Iterator[pa.RecordBatch]:
        for part in np.unique(np.flatnonzero(total) // _PART):
            own = total[part * _PART : (part + 1) * _PART]
            at = np.flatnonzero(own)
            data = np.r_[at.astype(np.int32), own[at]] if 2 * len(at) < _PART else own
            yield pa.RecordBatch.from_arrays([pa.array([int(part)], pa.int64()), pa.array([group], pa.int64()), pa.array([data.tobytes()], pa.binary())], names=["part", "g", "data"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(_PART, dtype=np.int64)
        for x in table.column("data"):
            own = np.frombuffer(x.as_buffer(), dtype=np.int32)
            if len(own) == _PART:
                total += own
            else:
                total[own[: len(own) // 2]] += own[len(own) // 2 :]
        return pa.table([table.column("part").slice(0, 1), pa.array([0], pa.int64()), pa.array([np.minimum(total, min_count).astype(np.int32).tobytes()], pa.binary())], names=["part", "g", "data"])

    schema = "part long, g long, data binary"
    sums = stored_ids.mapInArrow(count, schema)
    for keys in (("part", "g"), ("part",)):
        sums = sums.groupBy(*keys).applyInArrow(add, schema)
    mask = np.zeros(buckets, dtype=bool)
    for row in sums.select("part", "data").collect():
        mask[row.part * _PART : (row.part + 1) * _PART] = np.frombuffer(bytes(row.data), dtype=np.int32) >= min_count
    return mask


def _candidates(stored_ids: DataFrame, trie, k: int, mask: np.ndarray, tasks: int, min_count: int) -> DataFrame:
    """(code) distinct phrases of frequent buckets.

    Of ``tasks`` tasks (at most) one holds at least its share of a frequent phrase's
    occurrences, so a task names only the phrases that reach that share in it.
    """
    shared, share = stored_ids.sparkSession.sparkContext.broadcast(mask), -(-min_count // tasks)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.array([], dtype=np.int64), np.array([], dtype=np.int64)
        for ids in _arrays(batches):
            if len(ids) >= k:
                codes = _extensions(ids, trie.value, k)
                codes, more = np.unique(codes[shared.value[_bucket(codes, len(shared.value))]], return_counts=True)
                held, where = np.unique(np.r_[held, codes], return_inverse=True)
                n = np.bincount(where, weights=np.r_[n, more], minlength=len(held)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(held[n >= share], pa.int64())], names=["code"])

    return stored(stored_ids.mapInArrow(find, "code long").distinct())


def _counts(stored_ids: DataFrame, trie, k: int, n: int, min_count: int) -> DataFrame:
    """(child, f) of the children of level ``k`` that occur ``min_count`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, total = trie.value, np.zeros(n, dtype=np.int64)
        for ids in _arrays(batches):
            if len(ids) >= k:
                states = ids
                for j in range(1, k):
                    states = t.advance(states[:-1], ids[j:])
                total += np.bincount(t.name[states[states >= 0]], minlength=n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["child", "f"])

    return stored_ids.mapInArrow(count, "child long, f long").groupBy("child").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def _phrases_by_tries(docs: DataFrame, vocabulary: list, buckets: int, min_count: int, max_words: int) -> DataFrame | None:
    """(lang, phrase, k, f) of phrases of two words or more; None where a level is too large to be held."""
    spark, n = docs.sparkSession, len(vocabulary)
    sc = spark.sparkContext
    tasks = max(1, -(-sum(f for _, _, f in vocabulary) // _TASK))
    ids = encode(docs, [(lang, word, number) for number, (lang, word, _) in enumerate(vocabulary)]).coalesce(tasks)
    names, levels, out = [w for _, w, _ in vocabulary], [], []
    langs = np.array([lang for lang, _, _ in vocabulary], dtype=object)
    words_ = names
    first = np.arange(n)
    for k in range(2, max_words + 1):
        trie = sc.broadcast(build_trie(n, levels)[0])
        found = _candidates(ids, trie, k, _frequent_buckets(ids, trie, k, buckets, min_count), tasks, min_count)
        slices = -(-found.count() // TRIE)
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for part in range(slices):
            code = found.where(F.pmod(F.xxhash64("code"), F.lit(slices)) == part).toArrow().column("code").to_numpy()
            code = np.sort(code)
            whole = sc.broadcast(build_trie(n, [*levels, (code // n, code % n)])[0])
            counts = _counts(ids, whole, k, len(code), min_count).toArrow()
            kept.append((code[counts.column("child").to_numpy()], counts.column("f").to_numpy()))
            whole.unpersist()
            if sum(len(c) for c, _ in kept) > MAX_PHRASES:
                return None
        trie.unpersist()
        if not kept:
            break
        code, f = (np.concatenate(x) for x in zip(*kept, strict=True))
        if not len(code):
            break
        order = np.argsort(code)
        code, f = code[order], f[order]
        parents, numbers = code // n, code % n
        levels.append((parents, numbers))
        names = [f"{names[p]} {words_[c]}" for p, c in zip(parents.tolist(), numbers.tolist(), strict=True)]
        first = first[parents]
        out.append(pa.table({"lang": pa.array(langs[first], pa.string()), "phrase": pa.array(names, pa.string()), "k": pa.array(np.full(len(f), k), pa.int32()), "f": pa.array(f, pa.int64())}))
    schema = "lang string, phrase string, k int, f long"
    return spark.createDataFrame(pa.concat_tables(out), schema) if out else spark.createDataFrame([], schema)


def _phrases_by_shuffle(docs: DataFrame, min_count: int, max_words: int) -> DataFrame:
    """The same by one shuffle of all phrases of each length, for vocabularies that no task can hold."""
    marks = "[" + "".join(f"\\x{ord(c):02x}" for c in PIECE_ENDS) + "]"
    pieces = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(lower_ascii(F.coalesce("text", F.lit(""))), marks)).alias("p"))
    pieces = pieces.select("lang", F.filter(F.split("p", "[ \\t]+"), lambda w: w != "").alias("w"))
    level = lambda k: (
        pieces.where(F.size("w") >= k)
        .select("lang", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - (k - 1)), lambda i: F.array_join(F.slice("w", i, k), " "))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.lit(k).alias("k"), F.count("*").alias("f"))
    )
    out = level(2)
    for k in range(3, max_words + 1):
        out = out.unionByName(level(k))
    return out.where(F.col("f") >= min_count)


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases of 1 to ``max_words`` words with at least ``min_count`` occurrences, and (lang, n) words of each language.

    Phrases lie within pieces, overlaps count.  Null texts are empty, null languages
    are ``und``, repeated rows count again, and an empty table gives empty results.
    """
    own = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counted = stored(words(own))
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counted.where(F.col("f") >= min_count)
    longer = None
    if frequent.count() <= VOCABULARY:
        vocabulary = sorted((r.lang, r.word, r.f) for r in frequent.collect())
        # frequent words get low numbers, which keeps the arrays of tries short
        buckets = _buckets(counted.agg(F.sum("f")).first()[0] or 0)
        with _small_batches(docs.sparkSession):
            longer = _phrases_by_tries(own, sorted(vocabulary, key=lambda x: -x[2]), buckets, min_count, max_words)
    if longer is None:
        longer = _phrases_by_shuffle(own, min_count, max_words)
    single = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), "f")
    return stored(single.unionByName(longer)), totals


def _scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases of two words or more, with their lowest-scoring cut."""
    part = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    per = found.select("lang", "phrase", F.col("f"))
    cuts = found.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w")).withColumn("j", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "j", part(F.lit(1), F.col("j")).alias("left"), part(F.col("j") + 1, F.col("k") - F.col("j")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = join_per_key(cuts, per.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    cuts = cuts.join(small_side(totals), "lang")
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.withColumn("over", exact("a") * exact("n") * F.lit(SCALE).cast("decimal(4,0)")).withColumn("under", exact("l") * exact("r")).withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "j", "l", "r", "a", "n")).alias("b"))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")


def _inside_longer(found: DataFrame) -> DataFrame:
    """(lang, phrase, most): the greatest count of a longer phrase that holds ``phrase``."""
    df = found.where("k > 2").select("lang", "f", "k", F.split("phrase", " ").alias("w"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    return df.select("lang", "f", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases.

    The score is floor(1000 a n / (l r)) at the lowest-scoring cut (ties: the shortest
    first part), in exact decimals; phrases inside a longer one that occurs as often are
    left out.  Ranks go by score and count, then by the phrase's bytes, first within
    salts of a language, so no task sorts all of a frequent one.  Nulls as in :func:`phrases`.
    """
    found, totals = phrases(docs, text_col, lang_col, min_count, max_words)
    df = stored(_scored(found, totals)).join(_inside_longer(found), ["lang", "phrase"], "left").where(F.col("most").isNull() | (F.col("most") < F.col("a"))).drop("most")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    df = df.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    df = df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    df = df.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return df.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
