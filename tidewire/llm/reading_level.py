"""Reading level of English documents, on a graders' scale.

Features of length, vocabulary, syntax and cohesion, most of them of the distribution over a text's sentences, are read from each whole
text; gradient-boosted regression trees are fitted to the graders' mean level of a bounded number of labelled documents; predictions
for documents of held-out sources calibrate the grade (isotonic) and place the cuts between levels. The error is measured apart, on
sources that neither trees nor calibration have seen (nested_error). Fitting uses at most max_labels documents on the driver: 20 000 by
default, of 33 numbers each, some 6 MB; everything else covers all rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LABELS = 20_000
BINS = 64

_TAG = re.compile(r"</?[A-Za-z][^<>]*>|&#?\w{2,8};|https?://\S+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_SENTENCE = re.compile(r"[.!?]+[\"”’')\]]*\s+|\n+")
_VOWELS = re.compile(r"[aeiouy]+")

#: Function words that tell languages apart, and word classes.
ENGLISH = frozenset("the a an of and to in is it that for on with as was were are be by this not no my your our their they we he she i you at from but or if so do does did has had have would which its every each under after before though yet while".split())
FOREIGN = frozenset("und der das ist nicht ein eine für mit auf von zu den dem des sich auch aber nach über el la los las de del que y en un una por con para no se su es pero tras sobre le les des et est une du dans pour pas qui sur il lo gli di che e per non sono o os as um uma não com".split()) - ENGLISH
SUBORDINATE = frozenset("that which who whom whose because since although though unless until while whereas whether if when where after before as than lest provided".split())
PRONOUNS = frozenset("i me my mine you your yours he him his she her hers it its we us our ours they them their theirs".split())
CONNECTIVES = frozenset("however therefore moreover furthermore consequently accordingly nevertheless nonetheless thus hence meanwhile additionally notwithstanding whereby thereby correspondingly subsequently".split())


def features(text: str | None) -> np.ndarray | None:
    """The features of an English text; null for one that is not English (too few English function words, or more of other
    languages'), blank or null."""
    if not text:
        return None
    clean = _TAG.sub(" ", text) if "<" in text or "&" in text or "http" in text else text
    low = clean.lower()
    words = _WORD.findall(low)
    n = len(words)
    if n < 3:
        return None
    counts = Counter(words)
    total = lambda s: sum([c for w, c in counts.items() if w in s])
    english = total(ENGLISH)
    if english < 0.1 * n or english <= 1.5 * total(FOREIGN):
        return None
    if not low.isascii() and sum([c for w, c in counts.items() if w.isascii()]) < 0.7 * n:
        return None
    by_size = Counter()
    for w, c in counts.items():
        by_size[len(w)] += c
    letters = sum([k * c for k, c in by_size.items()])
    at_least = lambda k: sum([c for size, c in by_size.items() if size >= k]) / n
    sentences = [s for s in _SENTENCE.split(low) if s and not s.isspace()] or [low]
    m = len(sentences)
    lengths, clauses, overlaps, last = [], [], [], None
    for s in sentences:
        parts = s.split()
        lengths.append(len(parts))
        clauses.append(s.count(",") + s.count(";"))
        own = {w for w in parts if len(w) > 3}
        if last is not None:
            overlaps.append(len(own & last) / max(1, min(len(own), len(last))))
        last = own
    overlap, clause = sum(overlaps) / max(1, len(overlaps)), sum(clauses) / m
    lengths.sort()
    total_length, mean_length = sum(lengths), sum(lengths) / m
    long = sum([x for x in lengths if x > 30])
    raw = clean.encode()
    without = lambda drop: len(raw) - len(raw.translate(None, drop))
    syllables = len(_VOWELS.findall(low))
    chars = max(1, len(clean))
    rate = lambda c: clean.count(c) / m
    mean = n / m
    return np.array([
        mean, (sum([(x - mean_length) ** 2 for x in lengths]) / m) ** 0.5, lengths[-1], lengths[min(m - 1, m * 9 // 10)], lengths[m // 2],
        letters / n, max(0.0, sum([k * k * c for k, c in by_size.items()]) / n - (letters / n) ** 2) ** 0.5,
        at_least(7), at_least(10), at_least(13), len(counts) / (2 * n) ** 0.5, sum(map(len, counts)) / len(counts),
        rate(","), rate(";") + rate(":"), rate("?") + rate("!"), rate("“") + rate('"'), rate("-"), without(b"0123456789") / chars,
        without(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars, english / n, total(SUBORDINATE) / n, total(PRONOUNS) / n, total(CONNECTIVES) / n, syllables / n,
        sum([x > 30 for x in lengths]) / m, long / max(1, total_length), clean.count(",") / n,
        0.39 * mean + 11.8 * syllables / n - 15.59, overlap,
        (sum([(x - overlap) ** 2 for x in overlaps]) / max(1, len(overlaps))) ** 0.5, sum([x == 0 for x in overlaps]) / max(1, len(overlaps)),
        (sum([(x - clause) ** 2 for x in clauses]) / m) ** 0.5, max(clauses),
    ], dtype=float)


@dataclass
class Trees:
    """Gradient-boosted regression trees of one depth over binned features; squared loss."""

    count: int = 120
    depth: int = 4
    rate: float = 0.1
    edges: np.ndarray | None = None
    base: float = 0.0
    splits: list = field(default_factory=list)  # of each tree: (feature, bin) by node, then the leaves' values

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(self.edges[f], x[:, f], side="right") for f in range(x.shape[1])], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "Trees":
        self.edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.copy()
        b = self._bin(x)
        n, f = b.shape
        cell = b + np.arange(f) * BINS
        least = max(min(8.0, weight.sum() / 4), weight.sum() / 50)  # large leaves: graders err
        self.base = float(np.average(y, weights=weight))
        pred = np.full(n, self.base)
        for _ in range(self.count):
            grad = (y - pred) * weight
            node, chosen = np.zeros(n, dtype=np.int64), []
            for level in range(self.depth):
                k = 1 << level
                at = (node[:, None] * (f * BINS) + cell).ravel()
                g = np.bincount(at, np.repeat(grad, f), k * f * BINS).reshape(k, f, BINS).cumsum(axis=2)
                w = np.bincount(at, np.repeat(weight, f), k * f * BINS).reshape(k, f, BINS).cumsum(axis=2)
                right_g, right_w = g[:, :, -1:] - g, w[:, :, -1:] - w
                gain = np.where((w >= least) & (right_w >= least), g**2 / np.maximum(w, 1e-9) + right_g**2 / np.maximum(right_w, 1e-9), -1.0)
                best = gain.reshape(k, -1).argmax(axis=1)
                feature, cut = best // BINS, best % BINS
                cut = np.where(gain.reshape(k, -1).max(axis=1) > 0, cut, BINS)  # no split: all go left
                chosen.append((feature, cut))
                node = node * 2 + (b[np.arange(n), feature[node]] > cut[node])
            k = 1 << self.depth
            leaf = self.rate * np.bincount(node, grad, k) / (np.bincount(node, weight, k) + 1.0)
            pred = pred + leaf[node]
            self.splits.append((chosen, leaf))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        b, n = self._bin(x), len(x)
        out = np.full(n, self.base)
        for chosen, leaf in self.splits:
            node = np.zeros(n, dtype=np.int64)
            for feature, cut in chosen:
                node = node * 2 + (b[np.arange(n), feature[node]] > cut[node])
            out += leaf[node]
        return out


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step fit (pool adjacent violators), to be interpolated between."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, sum of x*weight
    for xi, yi, wi in zip(x[order], y[order], weight[order]):
        blocks.append([yi, wi, xi * wi])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            w = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / w, w, a[2] + b[2]])
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] for b in blocks])


@dataclass
class Grader:
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]
    cuts: np.ndarray  # grade from which each next level is read, least level first
    levels: np.ndarray
    labelled: int

    def grade(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.trees.predict(x), *self.knots)

    def level(self, grade: np.ndarray) -> np.ndarray:
        return self.levels[np.searchsorted(self.cuts, grade, side="right")]


def best_cut(grade: np.ndarray, above: np.ndarray, weight: np.ndarray) -> float:
    """The grade that parts the labels above a level from the rest with the least weighted error; of equals the widest gap's middle."""
    order = np.argsort(grade, kind="stable")
    g, w = grade[order], np.where(above, weight, -weight)[order]
    errors = np.r_[0.0, np.cumsum(w)]  # of a cut before each place, but for a constant
    ends = np.r_[g[:1] - 1e-6, g, g[-1:] + 1e-6]
    gap = ends[1:] - ends[:-1]
    good = (errors <= errors.min() + 1e-9) & (gap > 0)
    k = int(np.argmax(np.where(good, gap, -1.0)))
    return float((ends[k] + ends[k + 1]) / 2)


def fit_grader(x: np.ndarray, y: np.ndarray, weight: np.ndarray, source: np.ndarray, folds: int = 5) -> Grader:
    """Folds hold whole sources, so calibration is for sources that the trees have not seen."""
    names = np.unique(source)
    fold = np.searchsorted(names, source) % max(2, min(folds, len(names)))
    raw = np.full(len(y), np.nan)
    for k in np.unique(fold):
        if (fold != k).sum() >= 4:
            raw[fold == k] = Trees().fit(x[fold != k], y[fold != k], weight[fold != k]).predict(x[fold == k])
    trees = Trees().fit(x, y, weight)
    raw = np.where(np.isnan(raw), trees.predict(x), raw)
    knots = isotonic(raw, y, weight)
    held_out = np.interp(raw, *knots)
    levels = np.arange(int(np.floor(y.min())), int(np.ceil(y.max())) + 1, dtype=np.int32)
    cuts = np.array([best_cut(held_out, y > (a + b) / 2, weight) for a, b in zip(levels, levels[1:])])
    return Grader(trees, knots, np.maximum.accumulate(cuts), levels, len(y))


def nested_error(x: np.ndarray, y: np.ndarray, weight: np.ndarray, source: np.ndarray, folds: int = 5) -> tuple[float, float]:
    """(mean absolute error of the grade, share of wrong levels) over documents of sources that were left out of everything: of each
    outer fold of whole sources, grades by a grader that was fitted and calibrated on the others."""
    fold = np.searchsorted(np.unique(source), source) % max(2, min(folds, len(np.unique(source))))
    off, wrong = [], []
    for k in np.unique(fold):
        rest, mine = fold != k, fold == k
        grade = (grader := fit_grader(x[rest], y[rest], weight[rest], source[rest], folds)).grade(x[mine])
        off.append(np.abs(grade - y[mine]))
        wrong.append(grader.level(grade) != np.rint(y[mine]))
    return float(np.concatenate(off).mean()), float(np.concatenate(wrong).mean())


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for t in batch.column(1).to_pylist()]
        keep = pa.array([r is not None for r in rows])
        part = batch.filter(keep)
        flat = pa.array([r.tolist() for r in rows if r is not None], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([part.column(0), flat, *[part.column(i) for i in range(2, batch.num_columns)]], names=["key", "x", *batch.schema.names[2:]])


def labelled_features(docs: DataFrame, key: str, text: str, source: str, labels: DataFrame, label_key: str, level: str, max_labels: int = MAX_LABELS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Features, mean level, number of labels and source of each labelled English document; null levels don't count. At most
    max_labels documents (those with the smallest hash of the key), so what is joined by broadcast and collected is bounded."""
    by = labels.where(F.col(label_key).isNotNull() & F.col(level).isNotNull()).groupBy(F.col(label_key).alias("__k")).agg(F.avg(level).alias("__y"), F.count(F.lit(1)).alias("__w"))
    by = by.orderBy(F.xxhash64("__k"), "__k").limit(max_labels)
    kind = docs.schema[key].dataType.simpleString()
    chosen = docs.join(F.broadcast(by), F.col(key) == F.col("__k")).select(F.col(key).alias("key"), F.col(text).alias("t"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), "__y", "__w")
    rows = chosen.mapInArrow(_feature_rows, f"key {kind}, x array<double>, source string, y double, w bigint").dropDuplicates(["key"]).toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values("key")
    return np.stack(rows["x"].to_numpy()), rows["y"].to_numpy(float), rows["w"].to_numpy(float), rows["source"].to_numpy(str)


def learn(docs: DataFrame, key: str, text: str, source: str, labels: DataFrame, label_key: str, level: str, max_labels: int = MAX_LABELS) -> Grader | None:
    """A grader of labelled_features; none without labels."""
    rows = labelled_features(docs, key, text, source, labels, label_key, level, max_labels)
    return None if rows is None else fit_grader(*rows)


def reading_levels(docs: DataFrame, key: str, text: str, grader: Grader | None) -> DataFrame:
    """`key`, grade (calibrated, on the graders' scale) and level (by cuts that part the graders' levels best) of every English document, told by its
    words, not by any language column. Null, blank and other texts give no row; repeated rows a row each; no grader, no rows."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, grade double, level int"
    if grader is None:
        return docs.sparkSession.createDataFrame([], schema)
    model = docs.sparkSession.sparkContext.broadcast(grader)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = [features(t) for t in part.column(1).to_pylist()]
                keep = [i for i, r in enumerate(rows) if r is not None]
                grade = model.value.grade(np.stack([rows[i] for i in keep])) if keep else np.zeros(0)
                level = model.value.level(grade).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep, pa.int64())), pa.array(grade), pa.array(level)], names=[key, "grade", "level"])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)
