"""Toxicity by a string-kernel support vector machine.

The kernel of two words counts the letter triples they share as subsequences, each weighted by decay
to the power of the letters it spans, so an insult with letters put in between still shares its
triples, only weaker. Landmarks are words of the training sentences; a word's Nyström features are
its kernels with the landmarks, whitened by those among the landmarks. A linear support vector
machine on these features separates the worst word of toxic documents from the worst of clean
sentences. Because the kernel is a product of triple weights, the trained function is a sum over the
triples of a word: one table, one pass over the letters, whatever the number of landmarks. A second,
small machine judges a document by its TOP worst words, as an insult seldom comes alone and a chance
likeness does.

Marks inside a word are dropped (i.d.i.o.t), and single letters in a row are one word (i d i o t).
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from skein.llm.common import below, written

#: Bound of the training sample: so many documents of each label, none longer than so many characters.
DOCS_PER_LABEL = 1500
TRAINING_CHARS = 6000
LANDMARKS = 96
DECAY = 0.75
#: Gaps (letters from the first to the second, and to the third) of the triples that count.
GAPS = [(1, 1), (1, 2), (2, 1), (1, 3), (2, 2), (3, 1), (1, 4), (2, 3), (3, 2), (4, 1)]
#: Words whose margins make a document's, and the bound of each of these.
TOP, REACH = 3, 3.0
#: A document is rejected from this score on.
TOXIC = 0.5

#: Letter codes: a-z 1 to 26, other letters by five bits of their last UTF-8 bytes, which leaves
#: case aside for Latin ones; first bytes are dropped, 0 parts words.
_CODES = np.zeros(256, np.uint8)
for _c in range(26):
    _CODES[97 + _c] = _CODES[65 + _c] = 1 + _c
for _c in range(128, 192):
    _CODES[_c] = 27 + (_c & 31)
_SIDE = 59
_SPACE = bytes([9, 10, 11, 12, 13, 32])
_DROP = bytes(c for c in range(256) if c >= 192 or c < 128 and not chr(c).isalpha() and c not in _SPACE)
_SENTENCE = re.compile(rb"[.!?]+\s|\n")


def letters(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of the words of UTF-8 text, each followed by a 0, and where words start."""
    c = _CODES[np.frombuffer(b" ".join(data.translate(None, _DROP).split()) + b" ", np.uint8)]
    ends = np.flatnonzero(c == 0)
    sizes = np.diff(np.r_[-1, ends]) - 1
    single = sizes == 1
    glue = single[:-1] & single[1:]
    if glue.any():
        keep = np.ones(c.size, bool)
        keep[ends[:-1][glue]] = False
        c = c[keep]
        ends = np.flatnonzero(c == 0)
    return c, np.r_[0, ends[:-1] + 1]


def _triples(c: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(places of first letters, triple numbers, weight) for each pair of gaps, within words."""
    x = c.astype(np.int32)
    run = np.cumsum(c == 0)
    for g, h in GAPS:
        s = g + h
        if c.size <= s:
            continue
        inside = np.flatnonzero((run[:-s] == run[s:]) & (c[:-s] != 0) & (c[s:] != 0))
        yield inside, (x[inside] * _SIDE + x[inside + g]) * _SIDE + x[inside + s], DECAY ** (s + 1)


def _norm(sizes: np.ndarray) -> np.ndarray:
    """Of words by length: the root of the kernel of a word of different letters with itself. Words too
    short for a triple have kernel 0 with everything."""
    own = sum(np.maximum(sizes - g - h, 0) * DECAY ** (2 * (g + h + 1)) for g, h in GAPS)
    return np.sqrt(np.maximum(own, 1e-9))


def features(word: bytes) -> dict[int, float]:
    c, _ = letters(word)
    out: dict[int, float] = defaultdict(float)
    for _, triple, weight in _triples(c):
        for t in triple.tolist():
            out[t] += weight
    norm = float(_norm(np.array([c.size - 1]))[0])
    return {t: w / norm for t, w in out.items()}


def kernels(words: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    each = [features(z) for z in landmarks]
    # Row 0 is for triples that no landmark has.
    used = sorted({t for f in each for t in f})
    row = np.zeros(_SIDE**3, np.int32)
    row[used] = np.arange(1, len(used) + 1)
    table = np.zeros((len(used) + 1, len(landmarks)))
    for j, f in enumerate(each):
        for t, w in f.items():
            table[row[t], j] = w
    out = np.zeros((len(words), len(landmarks)))
    for i in range(0, len(words), 4096):
        c, starts = letters(b" ".join(words[i : i + 4096]))
        total = np.zeros((c.size, len(landmarks)))
        for at, triple, weight in _triples(c):
            total[at] += table[row[triple]] * weight
        sizes = np.diff(np.r_[starts, c.size]) - 1
        out[i : i + 4096] = np.add.reduceat(total, starts) / _norm(sizes)[:, None]
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 3.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the points inside the margin."""
    a = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(a.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(a.shape[1])
    for i in range(rounds):
        active = y * (a @ w) < 1
        aw = a[active] * (c * weight[active, None])
        new = np.linalg.solve(ridge + aw.T @ a[active], aw.T @ y[active])
        if np.allclose(new, w, atol=1e-7):
            break
        w = 0.5 * (w + new) if i > 20 else new
    return w[:-1], float(w[-1])


class Model:
    """weights by triple and bias of the machine for words; of, the weights of a document's worst
    words in turn, and offset, of the machine for documents."""

    def __init__(self, weights: np.ndarray, bias: float, of: np.ndarray, offset: float, landmarks: list[bytes]):
        self.weights, self.bias, self.of, self.offset, self.landmarks = weights, bias, of, offset, landmarks

    def margins(self, data: bytes) -> np.ndarray:
        """The machine's value for every word."""
        c, starts = letters(data)
        total = np.zeros(c.size)
        for at, triple, weight in _triples(c):
            total[at] += self.weights[triple] * weight
        sizes = np.diff(np.r_[starts, c.size]) - 1
        return np.add.reduceat(total, starts) / _norm(sizes) + self.bias

    def worst(self, data: bytes | None) -> np.ndarray:
        """The margins of the TOP worst words. Words that a text lacks are like no landmark."""
        m = self.margins(data) if data and data.strip() else np.zeros(0)
        m = np.sort(np.partition(m, m.size - TOP)[m.size - TOP :] if m.size > TOP else m)[::-1]
        return np.clip(np.r_[m, np.full(TOP - m.size, self.bias)], -REACH, REACH)

    def score(self, data: bytes | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(4 * (self.worst(data) @ self.of + self.offset), -30, 30))))


def _sentences(text: str) -> list[bytes]:
    return [s for s in _SENTENCE.split(text.encode("utf-8", "replace")) if s.strip()]


#: What stands for each code in a word: any byte that gives the same code again.
_SPELLED = np.frombuffer(b" abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 160)), np.uint8)


def _words(sentence: bytes) -> list[bytes]:
    c, _ = letters(sentence)
    return [x for x in _SPELLED[c].tobytes().split(b" ") if x]


def _covering(bags: list[set[bytes]], lift) -> list[bytes]:
    """Toxic landmarks, one by one: the word that tells most about the toxic documents that have few
    landmarks so far, so that rare insults and small languages get theirs."""
    share = [1.0] * len(bags)
    having: dict[bytes, list[int]] = defaultdict(list)
    for i, words in enumerate(bags):
        for w in words:
            having[w].append(i)
    odds = {w: lift(w) / len(i) for w, i in having.items() if lift(w) > 0}
    value = {w: odds[w] * len(having[w]) for w in odds}
    out: list[bytes] = []
    while value and len(out) < LANDMARKS // 2:
        w = min(value, key=lambda w: (-value[w], w))
        out.append(w)
        del value[w]
        for i in having[w]:
            for other in bags[i] & value.keys():
                value[other] -= odds[other] * share[i] * 0.7
            share[i] *= 0.3
    return out


def train(rows: list[tuple[str, int]]) -> Model:
    """From (text, label) rows. Repeated sentences count once, so copies of a document do not weigh
    more. Without words of three letters under
    both labels every text scores 0."""
    bags: list[tuple[list[list[bytes]], int]] = []
    seen: set[bytes] = set()
    for text, label in rows:
        sentences = [s for s in dict.fromkeys(_sentences(text)) if s not in seen]
        seen.update(sentences)
        if sentences:
            bags.append(([_words(s) for s in sentences], label))
    bags = [(w, label) for s, label in bags if (w := [x for x in s if any(len(y) > 2 for y in x)])]
    n = Counter(label for _, label in bags)
    if len(n) < 2:
        return Model(np.zeros(_SIDE**3), -1.0, np.zeros(TOP), -5.0, [])
    toxic, clean = Counter(), Counter()
    for sentences, label in bags:
        (toxic if label else clean).update({w for s in sentences for w in s if len(w) > 3})
    odds = lambda w: log((toxic[w] + 0.5) / n[1] / ((clean[w] + 0.5) / n[0]))
    lift = lambda w: toxic[w] / n[1] * odds(w)
    worst = _covering([{w for s in sentences for w in s if toxic[w] >= 3} for sentences, y in bags if y], lift)

    vocabulary = sorted({w for sentences, _ in bags for s in sentences for w in s if len(w) > 2})
    place = {w: i for i, w in enumerate(vocabulary)}
    near = kernels(vocabulary, worst or vocabulary[:1]).max(axis=1)
    # The other half of the landmarks are clean words, often met and most like the toxic ones.
    often = np.array([log(1 + clean[w]) if not toxic[w] or lift(w) < 0 else 0.0 for w in vocabulary])
    landmarks = list(dict.fromkeys([*worst, *(vocabulary[i] for i in np.argsort(-near * often, kind="stable")[: LANDMARKS // 2])]))
    k = kernels(landmarks, landmarks)
    values, vectors = np.linalg.eigh((k + k.T) / 2)
    whiten = vectors / np.sqrt(np.maximum(values, 1e-6 * values.max()))
    phi = kernels(vocabulary, landmarks) @ whiten
    where = [([i for i in ([place[w] for w in s if w in place] for s in sentences) if i], y) for sentences, y in bags]
    where = [(s, y) for s, y in where if s]

    # The worst word stands for a clean sentence; which word that is follows from the machine so far, at
    # first from how much more often it is in toxic documents. Most words of a toxic document are clean,
    # and labels err: of toxic documents only the words worse than most clean documents count.
    value = np.array([max(0.0, odds(x)) if toxic[x] >= 3 else 0.0 for x in vocabulary]) + near / 100
    # Words that toxic documents have ten times as often, by more than chance, count whatever the
    # machine says, as several insults in one document else stand in for each other.
    error = np.array([(1 / (toxic[x] + 0.5) + 1 / (clean[x] + 0.5)) ** 0.5 for x in vocabulary])
    sure = (value > 2.3) & (value > 3 * error)
    w, b = np.zeros(phi.shape[1]), 0.0
    for _ in range(8):
        usual = np.quantile([max(value[i] for s in sentences for i in s) for sentences, label in where if not label], 0.9)
        at, y, weight = [], [], []
        for sentences, label in where:
            best = [max(s, key=lambda i: (value[i], -i)) for s in sentences]
            top = max(best, key=lambda i: (value[i], -i))
            if label:
                bad = {i for s in sentences for i in s if value[i] > usual or sure[i]}
                at += sorted(bad)
                y += [1] * len(bad)
                weight += [1.0] * len(bad)
            else:
                at += [top, *best]
                y += [-1] * (1 + len(best))
                weight += [1.0] + [1.0 / len(best)] * len(best)
        # A word that stands for many sentences is one point with their weights.
        points, of = np.unique(np.array(at) * 2 + (np.array(y) > 0), return_inverse=True)
        w, b = _svm(phi[points // 2], np.where(points % 2, 1.0, -1.0), np.bincount(of, weight))
        new = phi @ w + b
        if np.allclose(new, value, atol=1e-6):
            break
        value = new
    weights = np.zeros(_SIDE**3)
    for z, x in zip(landmarks, whiten @ w):
        for t, f in features(z).items():
            weights[t] += x * f
    model = Model(weights, b, np.zeros(TOP), 0.0, landmarks)
    worst = np.array([model.worst(text.encode("utf-8", "replace")) for text, _ in rows])
    label = np.array([1.0 if y else -1.0 for _, y in rows])
    model.of, _ = _svm(worst, label, np.ones(len(rows)), c=1.0)
    model.offset = -_cut(worst @ model.of, label)
    return model


def _cut(margin: np.ndarray, y: np.ndarray) -> float:
    """The threshold that errs least on the training documents, in the middle of its gap."""
    order = np.argsort(margin, kind="stable")
    m, t = margin[order], y[order]
    # Errors if documents from place i on count as toxic.
    errors = np.r_[0, np.cumsum(t > 0)] + np.r_[(t < 0).sum(), (t < 0).sum() - np.cumsum(t < 0)]
    edge = np.r_[True, m[1:] > m[:-1], True]
    i = int(np.flatnonzero(edge & (errors == errors[edge].min()))[0])
    if i in (0, m.size):
        return float(m[0] - 1 if i == 0 else m[-1] + 1)
    return float((m[i - 1] + m[i]) / 2)


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Model:
    """From labelled rows of docs where usable holds: a bounded sample, the documents with the
    smallest text hashes of each label. Null labels and texts are left out, and so, from training
    alone, are documents longer than TRAINING_CHARS. Only ids and hashes are shuffled to choose the
    sample; its texts, at most DOCS_PER_LABEL of each label, are then picked out of the documents."""
    usable = F.lit(True) if usable is None else usable
    known = labels.where("toxic in (0, 1)").select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__toxic"))
    mine = docs.where(usable & F.col("text").isNotNull() & (F.length("text") <= TRAINING_CHARS))
    hashed = mine.select("doc_id", F.xxhash64("text").alias("h"))
    joined = written(hashed.join(known, F.col("doc_id") == F.col("__id")).select(F.col("__toxic").alias("toxic"), "h", F.col("doc_id").alias("id")), "toxicity-labels")
    # Ranked is only what the counts of the labels cannot rule out.
    joined = below(joined, ["toxic"], "h", DOCS_PER_LABEL).groupBy("toxic", "h").agg(F.min("id").alias("id"))
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy("h"))
    chosen = joined.withColumn("r", rank).where(F.col("r") <= DOCS_PER_LABEL).drop("r")
    texts = mine.select("doc_id", "text").join(F.broadcast(chosen), F.expr("doc_id = id and xxhash64(text) = h"))
    rows = texts.groupBy("toxic", "h").agg(F.min("text").alias("text")).collect()
    return train([(r.text, r.toxic) for r in sorted(rows, key=lambda r: (r.toxic, r.h))])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from TOXIC on) added; such columns are replaced.

    Defined results: null and empty texts, and texts without letters, get the score of a word that is
    like no landmark; very long texts are read whole; repeated rows score alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in texts:
            yield pd.Series([sent.value.score(x) for x in text], dtype=float)

    out = docs.drop("score", "predicted").withColumn("score", judge(F.col("text").cast("binary")))
    return out.withColumn("predicted", F.when(F.col("score") >= TOXIC, 1).otherwise(0).cast("int"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that training never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out())
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
