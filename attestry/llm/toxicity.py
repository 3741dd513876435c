"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel compares words by their common subsequences of three characters; each
character that lies between them costs a factor, so gapped spellings and inserted
characters stay near the plain word.  Words are the instances, the most toxic word
speaks for its sentence and text (multiple-instance training on labelled texts).

A Nyström model is linear in the kernel against the landmarks, and that kernel is a
product of sparse subsequence profiles.  So after training the landmarks fold into
one table of subsequence weights of fixed size, which is what the tasks get.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class that training reads at most, chosen by the hash of their id.
SAMPLE = 2000
LANDMARKS = 192
#: Weight of a subsequence: DECAY to the power of its span; spans over SPAN are left out.
DECAY, SPAN = 0.6, 6
#: Words longer than this are judged in overlapping parts.
LONGEST = 28
MEMORY = 100_000
#: Landmarks that the kernel of a list of words is summed up for at once.
COLUMNS = 16

_LETTERS = {c: i + 1 for i, c in enumerate("^$abcdefghijklmnopqrstuvwxyz0123456789")}
_ALPHABET = 64
_SPLIT = re.compile(r"[^\W_]+(?:[^\w\s]+[^\W_]+)*")
_JOINTS = re.compile(r"[\W_]+")


def units(text: str) -> set[str]:
    """The distinct words of a text, without the marks inside them; spelled-out words are put together."""
    out, run = set(), []
    for w in _SPLIT.findall(text.lower()):
        if not w.isalnum():
            w = _JOINTS.sub("", w)
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) >= 3:
            out.add("".join(run))
        run.clear()
        out.add(w)
    if len(run) >= 3:
        out.add("".join(run))
    return out


def parts(word: str) -> list[str]:
    return [word] if len(word) <= LONGEST else [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def _offsets() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pairs = [(j, k) for k in range(2, SPAN) for j in range(1, k)]
    return np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), DECAY ** np.array([p[1] + 1.0 for p in pairs])


def _code(c: str) -> int:
    return _LETTERS.get(c) or 40 + ord(c) % 24


def profiles(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subsequence number, value and word of each entry of the words' profiles, each of length 1."""
    j, k, weight = _offsets()
    if not words:
        return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
    width = LONGEST + 2 + SPAN
    grid = np.zeros((len(words), width), dtype=np.int64)
    for i, w in enumerate(words):
        codes = [_LETTERS["^"], *map(_code, w[:LONGEST]), _LETTERS["$"]]
        grid[i, : len(codes)] = codes
    start = np.arange(int((grid > 0).sum(1).max()))
    a, b, c = grid[:, start, None], grid[:, start[:, None] + j], grid[:, start[:, None] + k]
    key = ((a * _ALPHABET + b) * _ALPHABET + c).reshape(len(words), -1)
    key = np.where((c > 0).reshape(len(words), -1), key, -1)
    value = np.broadcast_to(weight, (len(words), len(start), len(weight))).reshape(len(words), -1)
    row = np.repeat(np.arange(len(words)), key.shape[1])
    flat = row * np.int64(_ALPHABET**3) + key.ravel()
    ok = key.ravel() >= 0
    uniq, inv = np.unique(flat[ok], return_inverse=True)
    total = np.bincount(inv, weights=value.ravel()[ok])
    row, key = uniq // _ALPHABET**3, uniq % _ALPHABET**3
    norm = np.sqrt(np.bincount(row, weights=total**2, minlength=len(words)))
    return key, total / norm[row], row


def kernel(x: list[str], y: list[str]) -> np.ndarray:
    """The normalised subsequence kernel between two lists of words."""
    out = np.zeros((len(x), len(y)))
    key, value, row = profiles(y)
    known, place = np.unique(key, return_inverse=True)
    table = np.zeros((len(known) + 1, len(y)))  # a row for each subsequence of y's words, and one of zeros
    table[place, row] = value
    for s in range(0, len(x), 200):
        key, value, row = profiles(x[s : s + 200])
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        at = np.where(known[at] == key, at, len(known))
        hit = at < len(known)
        first = np.searchsorted(row[hit], np.arange(len(x[s : s + 200]) + 1))
        value, at = value[hit], at[hit]
        sums = np.zeros((len(at) + 1, COLUMNS))
        for c in range(0, len(y), COLUMNS):  # some columns at a time, in one place: all would take hundreds of MB
            some = table[:, c : c + COLUMNS]
            here = sums[:, : some.shape[1]]
            np.multiply(value[:, None], some[at], out=here[1:])
            np.cumsum(here, axis=0, out=here)
            out[s : s + 200, c : c + COLUMNS] = here[first[1:]] - here[first[:-1]]
    return out


@dataclass
class Model:
    """``table``: weight of each subsequence; a word scores its profile times it plus ``bias``; then a sigmoid."""

    table: np.ndarray
    bias: float
    slope: float
    shift: float

    def words(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words))
        for s in range(0, len(words), 500):
            part = words[s : s + 500]
            key, value, row = profiles(part)
            out[s : s + 500] = np.bincount(row, weights=value * self.table[key], minlength=len(part)) + self.bias
        return out

    def chance(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the points inside the margin."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    reg = np.eye(len(w))
    reg[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (x1 @ w) < 1
        xs, cs = x1[inside], c * weight[inside]
        new = np.linalg.solve(reg + xs.T @ (cs[:, None] * xs), xs.T @ (cs * y[inside]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = (w + new) / 2 if _ > 30 else new
    return w[:-1], float(w[-1])


def fit(bags: Iterable[list[str]], labels: list[int], landmarks: int = LANDMARKS, rounds: int = 2) -> Model:
    """Train on texts as sets of words.  Without both labels, every text gets the share of toxic ones."""
    y = np.array(labels, dtype=np.int64)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    if not (y == 1).any() or not (y == 0).any():
        return Model(np.zeros(_ALPHABET**3), 0.0, 0.0, float(np.log(rate / (1 - rate))))
    place: dict[str, int] = {}
    member = [np.array(sorted({place.setdefault(p, len(place)) for w in b for p in parts(w)}), dtype=np.int64) for b in bags]
    vocab = list(place)
    hot, cold = np.zeros(len(vocab)), np.zeros(len(vocab))
    for m, label in zip(member, y, strict=True):
        (hot if label else cold)[m] += 1
    odds = np.log((hot + 0.1) / (cold + 0.1)) - np.log((y == 1).sum() / (y == 0).sum())
    often = hot >= max(2, 0.005 * (y == 1).sum())  # seeds: the three most telling words of each toxic text
    first = np.where(often, odds, -np.inf)
    seeds = {int(i) for m, label in zip(member, y, strict=True) if label for i in m[np.argsort(-first[m], kind="stable")[:3]] if first[i] > 2}
    common = np.argsort(-(cold + hot * (odds < 1)), kind="stable")
    by_odds = sorted(seeds, key=lambda i: (-hot[i], i))[: landmarks * 2 // 3]
    plain = [int(i) for i in common if int(i) not in seeds][: landmarks - len(by_odds)]
    marks = [vocab[i] for i in [*by_odds, *plain]]
    k = kernel(marks, marks)
    val, vec = np.linalg.eigh(k + 1e-6 * np.eye(len(k)))
    root = vec / np.sqrt(np.maximum(val, 1e-9))
    positive = np.array(sorted(seeds), dtype=np.int64)
    clean = np.unique(np.concatenate([m for m, label in zip(member, y, strict=True) if not label] or [np.empty(0, np.int64)]))
    rng = np.random.default_rng(0)
    negative = clean if len(clean) <= 8000 else np.union1d(rng.choice(clean, 8000, replace=False), common[:1000][cold[common[:1000]] > 0])
    model = None
    for _ in range(rounds):
        if not len(positive):
            break
        negative = np.setdiff1d(negative, positive)
        idx = np.concatenate([positive, negative])
        feats = kernel([vocab[i] for i in idx], marks) @ root
        target = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        share = np.sqrt(hot[positive])
        weight = np.concatenate([0.5 * len(negative) * share / share.sum(), np.ones(len(negative))])
        w, b = _svm(feats, target, weight)
        beta = root @ w
        table = np.zeros(_ALPHABET**3)
        key, value, row = profiles(marks)
        np.add.at(table, key, value * beta[row])
        model = Model(table, b, 1.0, 0.0)
        score = model.words(vocab)
        hard = np.unique([m[np.argmax(score[m])] for m, label in zip(member, y, strict=True) if not label and len(m)])
        negative = np.union1d(negative, hard)
        fresh = [int(m[np.argmax(score[m])]) for m, label in zip(member, y, strict=True) if label and len(m)]
        positive = np.union1d(positive, [i for i in fresh if score[i] > 0 and odds[i] > 0]).astype(np.int64)
    if model is None:
        return Model(np.zeros(_ALPHABET**3), 0.0, 0.0, float(np.log(rate / (1 - rate))))
    score = model.words(vocab)
    margin = np.array([score[m].max() if len(m) else -1.0 for m in member])
    model.slope, model.shift = _platt(margin, y)
    return model


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Sigmoid by Newton steps; the cut of 0.5 is then put where training errors are fewest."""
    order = np.argsort(margin)
    m, t = margin[order], y[order]
    errors = np.concatenate([[0], np.cumsum(t)]) + ((1 - t).sum() - np.concatenate([[0], np.cumsum(1 - t)]))
    least = np.flatnonzero(errors == errors.min())
    at = int(least[len(least) // 2])
    cut = (m[max(at - 1, 0)] + m[min(at, len(m) - 1)]) / 2
    spread = max(float(np.std(m)), 1e-6)
    slope = 4.0 / spread
    return slope, -slope * float(cut)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> Model:
    """Fit on at most ``sample`` labelled texts of each class (those whose id hashes lowest); null labels and texts are left out.

    Only the sampled texts reach the driver, as their distinct words.
    """
    marked = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropDuplicates(["id"])
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = None
    for label in (0, 1):
        some = marked.where(F.col("y") == label).orderBy(order, "id").limit(sample)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    found = texts.join(F.broadcast(chosen), "id").mapInPandas(_bags, "id string, y int, words string").orderBy("id", "words")
    bags, y = [], []
    for row in found.toLocalIterator():  # at most two samples of rows, one part at a time
        bags.append(row.words)
        y.append(row.y)
    return fit((b.split() for b in bags), y, **options)


def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"id": batch["id"].astype(str), "y": batch["y"], "words": [" ".join(sorted(units(t))) for t in batch["text"]]})


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with ``out_col``: the chance (0 to 1) that a whole text is toxic.

    Null, empty and wordless texts get the model's score of a text without toxic
    words.  Rows stay one to one; a column already named ``out_col`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one table of fixed size
    calm = -1.0

    @F.pandas_udf("double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, seen = shared.value, {}
        for texts in batches:
            out = []
            for s in range(0, len(texts), 200):
                bags = [units(t) if t else set() for t in texts.iloc[s : s + 200]]
                if len(seen) > MEMORY:
                    seen.clear()
                new = list({w for b in bags for w in b if w not in seen})
                flat = [(w, p) for w in new for p in parts(w)]
                for (w, _), v in zip(flat, m.words([p for _, p in flat]).tolist(), strict=True):
                    seen[w] = max(v, seen.get(w, v))
                out += [m.chance(max(map(seen.__getitem__, b), default=calm)) for b in bags]
            yield pd.Series(out, dtype=float)

    return docs.withColumn(out_col, judged(F.col(text_col).cast("string")))


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; trained without the held-out ids."""
    model = train(docs, labels.where(~held_out()), **options)
    out = score(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
