"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams (their 64-bit hashes) is cut into fragments, and with it
every document's sorted set.  Overlaps are counted fragment by fragment: a fragment's
segments of the compared sets meet in a group of their own, each group gives partial
counts, and these are shuffled by pair and summed.

Which pairs are counted follows from the fragments too.  Two sets over the threshold
differ in at most D n-grams, so of D + r finer fragments at least r are the same in
both, and r is more than the fragments that are empty by chance: sets that share a
whole segment stand in one list.

Classes are found without listing all pairs of a group: in every list one pivot is
compared first; sets that are left outside the list's main class are compared with
more members of it; and what is still apart is at last compared with everything in
the list that isn't in its class yet, so no link is lost.  For what is open after the
pivots, the n-grams are ordered anew, rare ones first, and the lists are those of the
n-grams in each set's prefix, which any link must share; the places of the first
common n-gram bound the overlap, and a bitmap of each set (the parity of its n-grams
in 1,024 bins) bounds the difference from below, so most pairs of members that are
almost alike enough are never counted.
Texts are never shuffled: of a set that has to be compared, one text is shingled again
where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, exp, sqrt
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import connected_components, cut, lower_ascii, partitions, small_side, stored
from .secrets import let

#: Ranges of the n-gram order in which the overlaps of a pair are counted.
FRAGMENTS = 8
#: A block with more members than this, and than its share of all, meets them in several groups.
PARTNERS = 2000
#: Sets of a list that are compared with all others are held in blocks of about this many.
BLOCK = 256
#: Rounds of comparing strays with members of the main class, and members in each.
ROUNDS, MEMBERS = 2, 8
#: 64-bit words of the bitmap that bounds how much two sets differ.
WORDS = 16

_LEFT, _RIGHT = np.uint64(33), np.uint64(31)


def shingles(text: Column, n: int) -> Column:
    """array<long>, sorted: hashes of the distinct n-word shingles of the lower-cased (A-Z) text.

    Fewer than n words are one shingle; no words, or null, are none.
    """
    words = F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def hashed(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.array_join(F.slice(w, i, n), " ")))
        few = F.array(F.xxhash64(F.array_join(w, " ")))
        return F.when(F.size(w) >= n, many).when(F.size(w) > 0, few).otherwise(F.array().cast("array<long>"))

    return F.sort_array(F.array_distinct(let(words, hashed)))


def _classes(num: int, den: int, top: int = 1 << 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower bounds of the size classes, the fragments of each, and how many of them are equal in every link.

    Sizes in one class differ by at most (den / num) ** 2.  A pair belongs to the class of its smaller set, of at most s n-grams; the larger
    has at most s * den / num, and they differ in at most (den - num) / (den + num) of both sizes.
    """
    bounds, counts, same = [1], [], []
    while bounds[-1] < top:
        low = bounds[-1]
        bounds.append(max(low + 1, low * den * den // (num * num)))
        s = bounds[-1] - 1
        differ = (s + s * den // num) * (den - num) // (den + num)
        r = 3
        for _ in range(20):  # four deviations above the number of empty fragments of the smallest set
            empty = (differ + r) * exp(-low / (differ + r))
            r = min(3 + ceil(empty + 4 * sqrt(empty)), 3 + 2 * differ)
        counts.append(differ + r)
        same.append(r)
    return np.array(bounds[:-1], dtype=np.int64), np.array(counts, dtype=np.int64), np.array(same, dtype=np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _signatures(flat: np.ndarray, sizes: np.ndarray, bounds: np.ndarray, counts: np.ndarray, same: np.ndarray, num: int, den: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Signatures of the equal-fragment test for many sets at once (``flat``: their n-grams, one set after the other).

    The second result is how many of them each set shares with any partner at least:
    the fragments that are equal in every link, without those that are empty in it.
    """
    found: list[list[np.ndarray]] = [[] for _ in sizes]
    least = np.full(len(sizes), 1 << 30, dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    top = np.searchsorted(bounds, sizes, "right") - 1
    low = np.searchsorted(bounds, -(-sizes * num // den), "right") - 1
    for back in range(int((top - low).max(initial=0)) + 1):
        some = np.flatnonzero((sizes > 0) & (top - back >= low))
        if not len(some):
            continue
        k = top[some] - back
        n = counts[k]
        sz = sizes[some]
        at = np.repeat(starts[some] - np.concatenate([[0], np.cumsum(sz)[:-1]]), sz) + np.arange(sz.sum())
        token = flat[at].astype(np.uint64)
        owner = np.repeat(np.arange(len(some)), sz)
        frag = ((token >> _LEFT) * n[owner].astype(np.uint64) >> _RIGHT).astype(np.int64)
        base = np.concatenate([[0], np.cumsum(n)])
        place = base[owner] + frag
        order = np.argsort(place, kind="stable")
        place, mixed = place[order], _mix(token[order])
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        total = np.add.reduceat(mixed, first)
        place = place[first]
        owner = np.searchsorted(base, place, "right") - 1
        frag = place - base[owner]
        sig = _mix(total + _mix((k[owner] << 32 | frag).astype(np.uint64)))
        cuts = np.searchsorted(owner, np.arange(len(some) + 1))
        for i, doc in enumerate(some):
            mine = sig[cuts[i] : cuts[i + 1]]
            least[doc] = min(least[doc], same[k[i]] - (n[i] - len(mine)))
            if n[i] - len(mine) >= same[k[i]]:  # only such sets can be linked by empty fragments alone: one list for them
                mine = np.append(mine, _mix(np.array([(int(k[i]) << 32) + 0xFFFFFFFF], dtype=np.uint64)))
            found[doc].append(mine)
    return [np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64) for x in found], np.maximum(least, 1)


def _signed(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(doc_id, key, cls, n_tokens, least, sigs): ``cls`` names the set, equal for equal sets."""
    bounds, counts, same = _classes(num, den)
    rows = _sized(sets).select("doc_id", "key", "cls", "n_tokens", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # equal sets of a task are signed once
        for whole in batches:
            for s in range(0, whole.num_rows, 250):
                batch = whole.slice(s, 250)
                sizes = batch.column("n_tokens").to_numpy()
                flat = batch.column("tokens").flatten().to_numpy(zero_copy_only=False)
                new = np.array([c not in seen and not seen.add(c) for c in batch.column("cls").to_pylist()], dtype=bool)
                sigs, least = _signatures(flat[np.repeat(new, sizes)], np.where(new, sizes, 0), bounds, counts, same, num, den)
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in sigs])]).astype(np.int32))
                col = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sigs) if sigs else np.empty(0, np.int64)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "key", "cls", "n_tokens")), pa.array(least), col], names=["doc_id", "key", "cls", "n_tokens", "least", "sigs"])

    return rows.mapInArrow(run, f"doc_id {sets.schema['doc_id'].dataType.simpleString()}, key long, cls long, n_tokens long, least long, sigs array<long>")


def _segments(rows: DataFrame) -> DataFrame:
    """``rows`` (block, salt, partners, cls, n, tokens) with the sets cut into FRAGMENTS ranges ``f`` of the n-gram order; empty segments are left out."""
    names = ["block", "salt", "partners", "cls", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int, int, bool]] = set()  # repeated rows of a task are cut once
        for whole in batches:
            for s in range(0, whole.num_rows, 250):
                batch = whole.slice(s, 250)
                keys = zip(*(batch.column(c).to_pylist() for c in ("block", "salt", "cls")), batch.column("partners").is_null().to_pylist(), strict=True)
                batch = batch.filter(pa.array([x not in seen and not seen.add(x) for x in keys]))
                if not batch.num_rows:
                    continue
                flat = batch.column("tokens").flatten().to_numpy(zero_copy_only=False)
                sizes = batch.column("n").to_numpy()
                part = ((flat.astype(np.uint64) >> _LEFT) * np.uint64(FRAGMENTS) >> _RIGHT).astype(np.int64)
                place = np.repeat(np.arange(len(sizes)), sizes) * FRAGMENTS + part
                order = np.argsort(place, kind="stable")
                first = np.flatnonzero(np.r_[True, np.diff(place[order]) > 0])
                row, f = np.divmod(place[order][first], FRAGMENTS)
                segments = pa.ListArray.from_arrays(pa.array(np.r_[first, len(flat)].astype(np.int32)), pa.array(flat[order]))
                kept = batch.select(names).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(f.astype(np.int32)), segments], names=[*names, "f", "tokens"])

    return rows.select(*names, "tokens").mapInArrow(run, "block long, salt int, partners array<long>, cls long, n long, f int, tokens array<long>")


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, na, nb, overlap) of the segments of each group: its block (rows without partners) comes first and is held, members pass by one at a time."""
    group, last, held = None, None, {}
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("block", "salt", "f", "partners", "cls", "n")), strict=True)
        tokens, out = batch.column("tokens"), []
        for i, (block, salt, f, partners, cls, n) in enumerate(keys):
            if (block, salt, f) != group:
                group, last, held = (block, salt, f), None, {}
            x = tokens[i].values.to_numpy()
            if partners is None:
                held[cls] = (np.sort(x), n)
            elif cls != last:
                last = cls
                for a in partners:
                    if (y := held.get(a)) is not None:
                        at = np.minimum(np.searchsorted(y[0], x), len(y[0]) - 1)
                        if both := int((y[0][at] == x).sum()):
                            out.append((a, cls, y[1], n, both))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [()] * 5)], names=["a", "b", "na", "nb", "overlap"])


def _links(pairs: DataFrame, tokens_of, num: int, den: int) -> DataFrame:
    """The pairs (block, a, b) that reach the threshold: overlaps are counted in each fragment apart, and summed by pair.

    A block holds some sets a (a few, about BLOCK at most) that are compared with each
    of its members b, so a member travels once for all of them.  ``tokens_of`` adds
    ``n`` and ``tokens`` to rows that name a set (cls).  Blocks with many members are
    dealt to several groups; they are fewer than four for each shuffle partition, so
    their list is broadcast.
    """
    parts = partitions(pairs.sparkSession)
    members = cut(pairs.groupBy("block", "b").agg(F.collect_set("a").alias("partners")))
    limit = max(PARTNERS, members.count() // (4 * parts))
    hot = F.broadcast(cut(members.groupBy("block").agg(F.count("*").alias("k")).where(F.col("k") > limit).select("block", F.ceil(F.col("k") / limit).cast("int").alias("salts"))))
    salts = F.coalesce("salts", F.lit(1))
    member = members.join(hot, "block", "left").select("block", F.pmod(F.xxhash64("b"), salts).cast("int").alias("salt"), "partners", F.col("b").alias("cls"))
    first = members.select("block", F.explode("partners").alias("cls")).distinct().join(hot, "block", "left")
    first = first.select("block", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(None).cast("array<long>").alias("partners"), "cls")
    segments = _segments(tokens_of(member.unionByName(first)))
    key = ["block", "salt", "f"]
    ordered = segments.repartition(parts, *key).sortWithinPartitions(*key, F.col("partners").isNotNull(), "cls")
    counted = ordered.mapInArrow(_partial, "a long, b long, na long, nb long, overlap long")
    summed = counted.groupBy("a", "b").agg(F.sum("overlap").alias("i"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    return summed.where(den * F.col("i") >= num * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def _lists(signed: DataFrame) -> DataFrame:
    """(sig, cls, pivot): segments that at least two different sets share.

    A set that shares fewer of its segments than any link of it would has no link and is left out.
    """
    sig = signed.select(F.explode("sigs").alias("sig"), "cls", "least").repartition(partitions(signed.sparkSession), "sig")
    whole = W.partitionBy("sig")
    ends = (F.min("cls").over(whole).alias("pivot"), F.max("cls").over(whole).alias("last"))
    shared = stored(sig.select("sig", "cls", "least", *ends).where("pivot < last").select("sig", "cls", "least").distinct())
    enough = shared.groupBy("cls").agg(F.count("*").alias("k"), F.max("least").alias("least")).where("k >= least").select("cls")
    return stored(shared.join(small_side(cut(enough)), "cls", "left_semi").select("sig", "cls", *ends).where("pivot < last").drop("last"))


def _named(sets: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the sets (doc_id, key, cls, n_tokens), kept, and the same with their signatures."""
    rows = _signed(sets, num, den)
    if 100 * num >= 85 * den:
        rows = stored(rows)
        return rows.drop("least", "sigs"), rows
    # signatures are then half as many as the n-grams; making them twice beats keeping them
    return cut(_sized(sets).select("doc_id", "key", "cls", "n_tokens")), rows


def _sized(sets: DataFrame) -> DataFrame:
    return sets.select("doc_id", "key", F.xxhash64("tokens").alias("cls"), F.size("tokens").cast("long").alias("n_tokens"), "tokens")


def link_sets(rows: DataFrame, tokens: Column, num: int, den: int) -> DataFrame:
    """(doc_id, n_tokens, component_id) of each of ``rows`` (doc_id, key, and what ``tokens``, a sorted array<long>, is made from).

    Rows link where num * union <= den * intersection; ``component_id`` is the
    smallest doc_id reachable (nulls aside).  Rows with equal sets are one class from
    the start.  Empty and null sets link with nothing.  ``key`` is a cheap hash of
    what the tokens are made from, so that only rows that are looked at again are
    turned into tokens again.
    """
    return _linked(rows, tokens, num, den).select("doc_id", "n_tokens", F.when(F.col("n_tokens") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _linked(source: DataFrame, tokens: Column, num: int, den: int) -> DataFrame:
    """(doc_id, key, n_tokens, component, component_id): ``component`` names the group also where no row has an id; null for empty sets."""
    tokens = F.coalesce(tokens, F.array().cast("array<long>")).alias("tokens")
    rows, signed = _named(source.select("doc_id", "key", tokens), num, den)
    lists = _lists(signed)
    # one row for each different set: the row that stands for it, its smallest id and its rows
    classes = cut(rows.groupBy("cls").agg(F.min(F.struct("key", "doc_id")).alias("rep"), F.min("doc_id").alias("doc"), F.max("n_tokens").alias("n"), F.count("*").alias("n_rows")))

    def from_texts(which: DataFrame) -> DataFrame:
        named = cut(which.join(classes.select("cls", "rep"), "cls").select(*which.columns, F.col("rep.key").alias("__key"), F.col("rep.doc_id").alias("__id")))
        found = source.join(small_side(named), (F.col("key") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id")))
        return found.select(*which.columns, tokens).withColumn("n", F.size("tokens").cast("long"))

    pivots = lists.where("cls <> pivot").groupBy("cls", "pivot").agg(F.count("*").alias("k")).groupBy("cls").agg(F.max_by("pivot", F.struct("k", "pivot")).alias("pivot"))
    links = cut(_links(pivots.select(F.col("pivot").alias("block"), F.col("pivot").alias("a"), F.col("cls").alias("b")), from_texts, num, den))
    comp = connected_components(links)
    # sets of lists that hold more than one component
    now = lists.select("sig", "cls").join(comp.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    apart = now.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_sets = cut(lists.join(apart.select("sig"), "sig", "left_semi").select("cls").distinct())
    left_n = open_sets.count()
    if left_n:
        again = stored(_bitmaps(from_texts(open_sets).dropDuplicates(["cls"])))
        prefixes = _prefixes(again, num, den)
        lists = stored(prefixes.select(F.posexplode("prefix").alias("i", "sig"), "cls", "n", "own").select("sig", "cls", "n", (F.col("own") + F.col("i")).alias("at")))
        left, left_n = _open_lists(lists, comp)

    def from_again(which: DataFrame) -> DataFrame:
        return which.join(again, "cls")

    for turn in range(ROUNDS):
        if not left_n:
            break
        stray = left.where("comp <> main").select("sig", "cls", "n", "at")
        pick = [F.min(F.struct(F.xxhash64("cls", F.lit(turn * MEMBERS + j)), F.struct("cls", "n", "at").alias("c")))["c"].alias(f"m{j}") for j in range(MEMBERS)]
        picked = left.where("comp = main").groupBy("sig").agg(*pick)
        tried = stray.join(picked, "sig").select("cls", "n", "at", F.explode(F.array(*[f"m{j}" for j in range(MEMBERS)])).alias("m"))
        tried = tried.where(_possible(F.col("n"), F.col("at"), F.col("m.n"), F.col("m.at"), num, den))
        more = _links(tried.select(F.col("m.cls").alias("block"), F.col("m.cls").alias("a"), F.col("cls").alias("b")).distinct(), from_again, num, den)
        links = cut(links.unionByName(more).distinct())
        comp = connected_components(links)
        left, left_n = _open_lists(lists, comp)
    if left_n:
        one = left.where("comp <> main").select("sig", F.col("cls").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"), F.col("at").alias("ax"))
        other = left.select("sig", F.col("cls").alias("y"), F.col("comp").alias("cy"), F.col("comp").eqNullSafe(F.col("main")).alias("in_main"), F.col("n").alias("ny"), F.col("at").alias("ay"))
        able = _possible(F.col("nx"), F.col("ax"), F.col("ny"), F.col("ay"), num, den)
        meet = F.array_intersect("px", "py")[0] == F.col("sig")  # a pair is made in the first list that it shares
        near = _near(F.col("bx"), F.col("by"), F.col("nx"), F.col("ny"), num, den)
        one = one.join(prefixes.select(F.col("cls").alias("x"), F.col("prefix").alias("px"), F.col("bits").alias("bx")), "x")
        other = other.join(prefixes.select(F.col("cls").alias("y"), F.col("prefix").alias("py"), F.col("bits").alias("by")), "y")
        blocks = one.groupBy("sig").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        one = one.join(blocks, "sig").withColumn("block", F.xxhash64("sig", F.pmod(F.xxhash64("x"), F.col("blocks"))))
        rest = one.join(other, "sig").where(F.expr("cx <> cy and (in_main or x < y)") & able & near & meet).select("block", F.col("x").alias("a"), F.col("y").alias("b"))
        links = cut(links.unionByName(_links(rest, from_again, num, den)).distinct())
        comp = connected_components(links)
    # smallest doc_id of each component; classes with very many rows get their names by broadcast
    named = classes.join(comp.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    low = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    names = cut(named.where("n > 0").join(low, "component").select("cls", "component", "component_id", "n_rows"))
    limit = max(PARTNERS, rows.count() // (4 * partitions(source.sparkSession)))  # fewer than four such classes for each shuffle partition
    hot = F.broadcast(names.where(F.col("n_rows") > limit).drop("n_rows"))
    rest = rows.join(hot, "cls", "left_anti").join(names.where(F.col("n_rows") <= limit).drop("n_rows"), "cls", "left")
    return rows.join(hot, "cls").unionByName(rest).drop("cls")


def _possible(na: Column, at_a: Column, nb: Column, at_b: Column, num: int, den: int) -> Column:
    """Whether two sets of sizes n, whose first common n-gram stands at these places of the order, can reach the threshold.

    It needs an overlap of num * (na + nb) / (num + den), and at most what follows is in it.
    """
    return (num + den) * F.least(na - at_a, nb - at_b) >= num * (na + nb)


def _bitmaps(sets: DataFrame) -> DataFrame:
    """``sets`` (cls, n, tokens) with ``bits``: WORDS words that hold, for each bin of n-grams, whether their number is odd."""
    bins = 64 * WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, 250):
                batch = whole.slice(s, 250)
                tokens = batch.column("tokens")
                flat = tokens.flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(batch.num_rows), np.diff(tokens.offsets.to_numpy()))
                odd = np.bincount(row * bins + (_mix(flat.astype(np.uint64)) % np.uint64(bins)).astype(np.int64), minlength=batch.num_rows * bins) & 1
                words = np.packbits(odd.astype(np.uint8)).view(np.int64)
                bits = pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, WORDS, dtype=np.int32)), pa.array(words))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cls", "n", "tokens")), bits], names=["cls", "n", "tokens", "bits"])

    return sets.select("cls", "n", "tokens").mapInArrow(run, "cls long, n long, tokens array<long>, bits array<long>")


def _near(bits_a: Column, bits_b: Column, na: Column, nb: Column, num: int, den: int) -> Column:
    """Whether two sets with these bitmaps can reach the threshold.

    A bin whose parity differs holds an n-gram of one set alone at least, and linked
    sets differ in at most (den - num) / (den + num) of both sizes.
    """
    differ = reduce(add, [F.bit_count(bits_a[i].bitwiseXOR(bits_b[i])) for i in range(WORDS)])
    return (num + den) * differ <= (den - num) * (na + nb)


def _prefixes(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(cls, n, own, prefix, bits) of ``sets``: the n-grams of the prefix that other sets hold too, and how many are before them.

    N-grams are ordered by how many of the sets hold them, rare ones first.  A set of n
    links only if its first n - num * n / den + 1 n-grams hold the first common one;
    those that no other set holds take part in the count but make no list.  Sets with
    more of these than that are out before any order is made of the rest.
    """
    token = sets.select("cls", "n", F.explode("tokens").alias("sig"))
    many = token.groupBy("sig").agg(F.count("*").alias("df")).where("df > 1")
    token = token.join(many, "sig")
    length = F.floor((den - num) * F.col("n") / den) + 1
    ordered = token.groupBy("cls", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("all"))
    own = F.col("n") - F.size("all")
    ordered = ordered.where(own < length).select("cls", "n", own.alias("own"), F.slice(F.col("all.sig"), F.lit(1), (length - own).cast("int")).alias("prefix"))
    return stored(ordered.join(sets.select("cls", "bits"), "cls"))


def _open_lists(lists: DataFrame, comp: DataFrame) -> tuple[DataFrame, int]:
    """(sig, cls, comp, main) of the lists that hold more than one component, and their number of rows."""
    now = lists.join(comp.select(F.col("node").alias("cls"), F.col("component").alias("comp")), "cls", "left")
    now = now.withColumn("comp", F.coalesce("comp", "cls"))
    sizes = now.groupBy("sig", "comp").agg(F.count("*").alias("n"))
    main = sizes.groupBy("sig").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"), F.count("*").alias("k")).where("k > 1").select("sig", "main")
    out = cut(now.join(main, "sig"))
    return out, out.count()


def _sets(docs: DataFrame, n: int, id_col: str, text_col: str) -> tuple[DataFrame, Column]:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text")), shingles(F.col("text"), n)


def components(docs: DataFrame, n: int = 3, ratio: tuple[int, int] = (90, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs``; see :func:`link_sets`."""
    return link_sets(*_sets(docs, n, id_col, text_col), *ratio).withColumnRenamed("n_tokens", "n_shingles")


def keep_one(docs: DataFrame, n: int = 5, ratio: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of rows that are linked, directly or not.

    Columns are unchanged.  The row with the smallest id stays (those without one come
    last), among equal ids the one whose text has the smallest hash; rows that share
    id and text are copies too, so one of them stays.  Rows are told apart by id and
    text, never by id alone: a row without an id, or with the id of another row, goes
    only if its own text is linked.  Texts without words are linked with nothing.
    """
    found = cut(_linked(*_sets(docs, n, id_col, text_col), *ratio).where("component is not null").select("doc_id", "key", "component"))
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")).alias("best"), F.count("*").alias("n")).where("n > 1")
    rest = found.join(best, "component").select("doc_id", "key", (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("key") == F.col("best.key"))).alias("stays"))
    rest = cut(rest.groupBy("doc_id", "key").agg(F.first("stays").alias("stays"), F.count("*").alias("n")).where("not stays or n > 1"))
    named = rest.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "stays")
    gone, repeated = named.where("not stays").drop("stays"), named.where("stays").drop("stays")
    same = (F.xxhash64(text_col) == F.col("__key")) & F.col(id_col).eqNullSafe(F.col("__id"))
    out = docs.join(small_side(gone), same, "left_anti")
    if repeated.limit(1).count():
        repeated = small_side(repeated)
        once = out.join(repeated, same, "left_semi").dropDuplicates([id_col, text_col])
        out = out.join(repeated, same, "left_anti").unionByName(once)
    return out
