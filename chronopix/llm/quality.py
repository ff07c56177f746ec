"""Quality by naive Bayes support vectors.

A document's n-gram indicators are words, pairs of word shapes, and how large a part of the text each shape n-gram, repeated word and
repeated line makes. Each indicator is scaled by its class log-count ratio; a linear model is fitted to the scaled
indicators by dual coordinate descent on the hinge loss; its margin becomes a probability by a logistic fitted to the same rows.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm.common import bucket, forget, only, texts, written

#: Indicators are hashed to so many bits.
BITS = 18
#: The model is fitted on a sample, by hash of the id, of about this many labelled rows (all, if fewer).
SAMPLE = 12_000
#: The sample's indicators, in all, that go to the driver: beyond that the sample is thinned once more, so that very long texts cannot fill it.
INDICATORS = 40_000_000
#: Bytes of a word's shape that count: runs are one byte, so only words that change kind of character that often are alike beyond.
SHAPE = 8
#: Passes of the descent, and the penalty's weight.
PASSES, C = 15, 1.0
#: Scores from here on predict 1.
THRESHOLD = 0.3

_SHAPE = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))
_MASK = (1 << BITS) - 1


def _part(x: float) -> int:
    """Halvings from the whole: 0 for over a half, up to 9 for less than a 512th."""
    return min(9, int(-math.log2(x))) if x > 0 else 10


class Featuriser:
    """Hashed indicators of whole texts; keeps the shapes and hashes of words met before, up to a bound."""

    def __init__(self, most: int = 200_000):
        self.shapes: dict[bytes, bytes] = {}
        self.hashes: dict[bytes, int] = {}
        self.most = most

    def _shape(self, word: bytes) -> bytes:
        out = bytearray()
        for b in word:
            if not out or out[-1] != b:
                out.append(b)
        s = bytes(out[:SHAPE])
        if len(self.shapes) > self.most:
            self.shapes.clear()
        self.shapes[word] = s
        return s

    def __call__(self, text: bytes) -> np.ndarray:
        """Distinct hashed indicators; an empty text has only those of its size."""
        words = text.lower().split()
        known = self.shapes
        shapes = [known[w] if w in known else self._shape(w) for w in text.translate(_SHAPE).split()]
        n = len(words)
        out = {crc32(b"n%d" % n.bit_length()) & _MASK}
        if n:
            for s, k in Counter(shapes).items():
                out.add(crc32(b"s%d " % _part(k / n) + s) & _MASK)
            for (s, t), k in Counter(zip(shapes, shapes[1:], strict=False)).items():
                out.add(crc32(b"p%d " % _part(k / n) + s + b" " + t) & _MASK)
            same = sum(map(operator.eq, words, words[1:]))
            out.add(crc32(b"r%d" % _part(same / n)) & _MASK)
            distinct = set(words)
            out.add(crc32(b"d%d" % int(10 * len(distinct) / n)) & _MASK)
            lines = text.split(b"\n")
            out.add(crc32(b"l%d" % _part(1 - len(set(lines)) / len(lines))) & _MASK)
            hashes = self.hashes
            if len(hashes) > self.most:
                hashes.clear()
            for w in distinct:
                h = hashes.get(w)
                if h is None:
                    h = hashes[w] = crc32(w, 119) & _MASK
                out.add(h)
        return np.fromiter(out, np.int32, len(out))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Weights by hashed indicator, and the logistic of the margin. Margins are divided by the root of the number of indicators."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def margin(self, features: np.ndarray) -> float:
        return float(self.weights[features].sum()) / math.sqrt(max(1, len(features))) + self.bias

    def score(self, features: np.ndarray) -> float:
        return float(_sigmoid(np.array(self.slope * self.margin(features) + self.shift)))


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Without rows the score is a half everywhere; with one class alone it is near that class's label everywhere."""
    size, y = 1 << BITS, np.where(labels > 0, 1.0, -1.0)
    if not rows or (y > 0).all() or (y < 0).all():
        return Model(np.zeros(size, np.float32), 0.0, 1.0, 0.0 if not rows else 4.0 * float(y[0]))
    flat, lengths = np.concatenate(rows), np.array([len(r) for r in rows])
    side = np.repeat(y, lengths)
    pos, neg = np.bincount(flat[side > 0], minlength=size) + 1.0, np.bincount(flat[side < 0], minlength=size) + 1.0
    # Document frequencies of a class over its documents: with very unequal classes, counts over counts would drown small ones.
    ratio = np.log(pos / ((y > 0).sum() + 2)) - np.log(neg / ((y < 0).sum() + 2))
    ratio[(pos + neg) < 4] = 0.0  # indicators of a single document say nothing of others
    values = [ratio[r] / math.sqrt(len(r)) for r in rows]
    square = np.array([v @ v + 1.0 for v in values])
    # The rarer class weighs as much as the other.
    upper = np.where(y > 0, C * len(y) / (2 * (y > 0).sum()), C * len(y) / (2 * (y < 0).sum()))
    w, b, alpha, rng = np.zeros(size), 0.0, np.zeros(len(y)), np.random.default_rng(7)
    for _ in range(PASSES):
        moved = 0.0
        for i in rng.permutation(len(y)):
            r, v = rows[i], values[i]
            g = y[i] * (w[r] @ v + b) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * v
                b += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    m = np.array([w[r] @ v for r, v in zip(rows, values, strict=True)]) + b
    slope, shift = 1.0, 0.0
    t = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    for _ in range(50):  # Newton steps of the logistic
        p = _sigmoid(slope * m + shift)
        e, h = p - t, p * (1 - p) + 1e-9
        a11, a12, a22 = (h * m * m).sum() + 1e-6, (h * m).sum(), h.sum() + 1e-6
        g1, g2, det = (e * m).sum(), e.sum(), a11 * a22 - a12 * a12
        d1, d2 = (a22 * g1 - a12 * g2) / det, (a11 * g2 - a12 * g1) / det
        slope, shift = slope - d1, shift - d2
        if abs(d1) + abs(d2) < 1e-9:
            break
    slope = max(slope, 1e-3)
    return Model((w * ratio).astype(np.float32), float(b), float(slope), float(shift))


def sample(documents: DataFrame, labels: DataFrame, label: str, bound: int, skip) -> DataFrame:
    """doc_id, text, label of about ``bound`` labelled rows by hash of the id, all if there are fewer: the labels are thinned before the join, so they can be broadcast and documents stay where they are.

    Of an id's several labels the least counts; labels that are null or have no id are none. Documents that share an id all have its label.
    """
    kept = only(labels, doc_id="bigint", **{label: "int"}).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~skip(F.col("doc_id"))).groupBy("doc_id").agg(F.min(label).alias(label))
    share = min(1.0, bound / max(1, kept.count()))
    kept = kept.where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))
    return only(documents, doc_id="bigint", text="string").join(F.broadcast(kept), "doc_id").select("doc_id", "text", F.col(label).alias("label"))


def train(documents: DataFrame, labels: DataFrame, skip) -> Model:
    """A model from a sample of the labelled rows that ``skip`` leaves. Sampled rows' hashed indicators, INDICATORS in all at most, not texts, go to the driver, in order of id and text: reruns agree to the bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Featuriser()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), b.column(2), pa.array([f(t) for t in texts(b.column(1))], pa.list_(pa.int32()))], names=["doc_id", "hash", "label", "features"])

    rows = sample(documents, labels, "quality", SAMPLE, skip).withColumn("hash", F.xxhash64("text"))
    rows = written(rows.mapInArrow(run, "doc_id bigint, hash bigint, label int, features array<int>"), "indicators")
    total = rows.agg(F.sum(F.size("features").cast("bigint"))).first()[0] or 0
    share = min(1.0, INDICATORS / max(1, total))
    table, rows = rows, rows.where(F.pmod(F.xxhash64(F.lit(13), "doc_id", "hash"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0)).toArrow()
    forget(table)
    by = np.lexsort((rows["hash"].to_numpy(), rows["doc_id"].to_numpy()))
    column = rows["features"].combine_chunks()
    ends, flat = column.offsets.to_numpy(), column.flatten().to_numpy()
    ends = ends - ends[0]
    return fit([np.sort(flat[ends[i] : ends[i + 1]]) for i in by], rows["label"].to_numpy()[by])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row; null texts are as empty ones, which have the score of a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Featuriser()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model.score(f(t)) for t in texts(b.column(1))], pa.float64())], names=["doc_id", "score"])

    return only(documents, doc_id="bigint", text="string").mapInArrow(run, "doc_id bigint, score double")


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; learns from labelled rows that are not held out.

    Null texts are as empty ones, which have the score of a text without words; whole texts count, however long. Repeated rows and ids are
    rows of their own. Without labels every score is a half. An empty table gives an empty one; columns but doc_id, text and quality are not read.
    """
    held = lambda c: bucket(c, 5) == 0
    out = score(documents, train(documents, labels, held))
    return out.select("doc_id", held(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
