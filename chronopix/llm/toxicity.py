"""Toxicity by weak supervision.

Voters are lexicon words and word-beginning patterns, met once or repeatedly in a text: a beginning that clean texts have
now and then marks a toxic one by how often it comes. Labels choose them: those for toxic to cover the labelled toxic documents several times
over, and then all others of high lift; those against it, if any are as sure. A generative label model estimates, without any label, from how
voters agree over labelled and unlabelled documents alike, how often each fires on toxic and on other documents, and how far voters
fire together given the class: one that repeats what others say weighs less. Its evidence becomes a posterior by a logistic fitted to the
labelled documents, and the posteriors of all of them train a linear classifier over the voters and how many fire.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm.common import bucket, forget, only, written
from chronopix.llm.quality import _sigmoid, sample

#: The models are fitted on a sample, by hash of the id, of about this many labelled rows (all, if fewer), and as many more without a label.
SAMPLE = 24_000
#: Features of high lift that may become voters: the ones that most toxic documents of the sample have. Rarer ones, beyond so many, are not looked at.
CANDIDATES = 20_000
#: Letters of a word-beginning pattern.
BEGINNINGS = (4, 5, 6)
#: Times that a word or beginning is met in a text, at least, each a feature of its own.
REPEATS = (1, 2, 4)
#: Documents that a voter must fire on; times that the first voters should cover a toxic document; voters at most, of either kind: further ones, which
#: fire on fewer documents or where others fire already, are not used.
SUPPORT, COVER, VOTERS = 5, 3, 400
#: A voter's least rate on toxic documents over its rate on others; and the least of it that the label model may find, as voters were chosen for it.
LIFT, FLOOR = 20.0, 5.0
#: A voter against toxicity must be one that chance would put into so many of the toxic documents.
CERTAIN = 10.0
#: Scores from here on predict 1.
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> Counter[str]:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def patterns(word: str) -> list[str]:
    """What can vote for a word: itself, and its beginnings, marked with a star."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) > n]]


def features(text: str | None) -> set[str]:
    """The patterns of a text's words, and each with a number after it where the text has it so many times: no word has a digit."""
    n: Counter[str] = Counter()
    for w, k in words(text).items():
        for p in patterns(w):
            n[p] += k
    return {p if r == 1 else f"{p}{r}" for p, k in n.items() for r in REPEATS if k >= r}


def _counts(rows: DataFrame) -> DataFrame:
    """feature, toxic, other: distinct texts of each class that have the feature, of those with any toxic one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yes: Counter[str] = Counter()
        no: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            keys = list(yes.keys() | no.keys())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([yes[k] for k in keys], pa.int64()), pa.array([no[k] for k in keys], pa.int64())], names=["feature", "toxic", "other"])

        for b in batches:
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                (yes if label else no).update(features(text))
            if len(yes) + len(no) > 400_000:
                yield out()
                yes.clear()
                no.clear()
        yield out()

    seen = rows.select("text", "label").mapInArrow(run, "feature string, toxic bigint, other bigint")
    return seen.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _fires(rows: DataFrame, names: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels (-1: none), and which features each row has, in order of the rows' ids."""
    known = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = [sorted(known[p] for p in features(t) if p in known) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(hits, pa.list_(pa.int32())), b.column(3)], names=["doc_id", "label", "hits", "h"])

    got = rows.select("doc_id", "text", "label", "h").mapInArrow(run, "doc_id bigint, label int, hits array<int>, h bigint").toArrow()
    by = np.lexsort((got["h"].to_numpy(), got["doc_id"].to_numpy()))
    hits = got["hits"].to_pylist()
    return got["label"].to_numpy()[by], [np.array(hits[i], np.int64) for i in by]


def choose(names: list[str], lift: np.ndarray, hits: list[np.ndarray], labels: np.ndarray, least: int = SUPPORT) -> list[str]:
    """Voters, greedily: the feature that covers most toxic documents still covered under COVER times, while it covers ``least`` of them; then the others that fire on most toxic documents.

    Ties to the larger lift, then to the longer feature, then by code point. Of features that fire on the same documents one is taken.
    """
    has: list[list[int]] = [[] for _ in names]
    for d, h in enumerate(hits):
        for f in h.tolist():
            has[f].append(d)
    wanted = np.where(labels > 0, COVER, 0)
    same = [np.array(x, np.int64).tobytes() for x in has]
    where = [(d := np.array(x, np.int64))[labels[d] > 0] for x in has]
    gain = np.array([len(x) for x in where], float)
    order, chosen, met = sorted(range(len(names)), key=lambda f: (-lift[f], -len(names[f]), names[f])), [], set()
    place = np.empty(len(names))
    place[order] = np.arange(len(names))
    while len(chosen) < VOTERS and len(gain):
        f = int(np.lexsort((place, -gain))[0])
        if gain[f] < 0:
            break
        now = float((wanted[where[f]] > 0).sum())  # gains only fall, so a gain that still holds is the largest
        if now < gain[f]:
            gain[f] = now
            continue
        if now < least:
            break
        gain[f] = -1
        if same[f] in met:
            continue
        met.add(same[f])
        chosen.append(f)
        wanted[where[f]] -= wanted[where[f]] > 0
    for f in sorted(range(len(names)), key=lambda f: (-len(where[f]), place[f])):
        if len(chosen) < VOTERS and len(where[f]) >= least and same[f] not in met:
            met.add(same[f])
            chosen.append(f)
    return [names[f] for f in chosen]


class LabelModel:
    """How often voters fire on either class, and weights that discount those which fire together given the class, by expectation maximisation without labels.

    votes: distinct rows of votes, each met ``weight`` times; sign: 1 for voters for the class, -1 for those against it; prior: the class's share.
    """

    def __init__(self, votes: np.ndarray, weight: np.ndarray, sign: np.ndarray, prior: float, rounds: int = 60):
        n = weight.sum()
        q = np.clip(0.02 + 0.48 * np.maximum(votes @ sign, 0), 0.02, 0.95)
        for _ in range(rounds):
            qw, rw = q * weight, (1 - q) * weight
            on, off = (qw @ votes + 0.5) / (qw.sum() + 1), (rw @ votes + 0.5) / (rw.sum() + 1)
            on, off = np.where(sign > 0, np.maximum(on, np.minimum(FLOOR * off, 0.5)), on), np.where(sign < 0, np.maximum(off, np.minimum(FLOOR * on, 0.5)), off)
            rest = votes - (q[:, None] * on[None, :] + (1 - q[:, None]) * off[None, :])
            cov = (rest * weight[:, None]).T @ rest / n
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            self.correlation = np.abs(cov / sd[:, None] / sd[None, :])
            np.fill_diagonal(self.correlation, 1.0)
            self.weights = 1 / np.where(self.correlation > 0.2, self.correlation, 0).sum(axis=1)
            self.on, self.off, self.prior = np.clip(on, 1e-6, 1 - 1e-6), np.clip(off, 1e-6, 1 - 1e-6), prior
            new = _sigmoid(self.logit(votes))
            moved, q = np.abs(new - q).max(), new
            if moved < 1e-4:
                break

    def logit(self, votes: np.ndarray) -> np.ndarray:
        fire, quiet = np.log(self.on / self.off), np.log((1 - self.on) / (1 - self.off))
        return math.log(self.prior / (1 - self.prior)) + votes @ (self.weights * (fire - quiet)) + (self.weights * quiet).sum()


def calibrated(evidence: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Posteriors from the label model's evidence, by a logistic through how many labelled documents of each class have it; its slope is held near 1 where they say little."""
    slope, shift, n = 1.0, 0.0, toxic + other
    for _ in range(100):
        p = _sigmoid(slope * evidence + shift)
        e, h = n * p - toxic, n * p * (1 - p) + 1e-9
        hess = np.array([[(h * evidence**2).sum() + 1.0, (h * evidence).sum()], [(h * evidence).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, np.array([(e * evidence).sum() + slope - 1.0, e.sum()]))
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return _sigmoid(max(slope, 0.05) * evidence + shift)


class Classifier:
    def __init__(self, voters: list[str], weights: np.ndarray, bias: float, against: int = 0):
        """voters: those for toxicity, then ``against`` of them that speak against it."""
        self.known, self.weights, self.bias, self.speaking = {v: i for i, v in enumerate(voters)}, weights, bias, len(voters) - against
        self.bases = {p: n for n, p in enumerate(dict.fromkeys(v.rstrip("0123456789") for v in voters))}
        self.levels = [[(r, self.known[v]) for r in REPEATS if (v := p if r == 1 else f"{p}{r}") in self.known] for p in self.bases]
        self.met: dict[str, tuple[int, ...]] = {}

    def hits(self, text: str | None) -> set[int]:
        """The voters that fire; the patterns of a word are kept, for a bounded number of words."""
        met, bases, n = self.met, self.bases, Counter()
        if len(met) > 300_000:
            met.clear()
        for w, k in words(text).items():
            mine = met.get(w)
            if mine is None:
                mine = met[w] = tuple(bases[p] for p in patterns(w) if p in bases)
            for p in mine:
                n[p] += k
        return {i for p, k in n.items() for r, i in self.levels[p] if k >= r}

    def score(self, text: str | None) -> float:
        """Every text of one set of firing voters scores the same; a text without words has the score of a text on which none fires."""
        known, hits = self.known, self.hits(text)
        x = self.bias + sum(self.weights[i] for i in sorted(hits)) + self.weights[len(known) + min(sum(i < self.speaking for i in hits), 3)]
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def _rows(votes: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Votes, and as indicators how many fire for toxicity: 0, 1, 2, or more."""
    many = np.minimum(votes[:, sign > 0].sum(axis=1).astype(int), 3)
    return np.hstack([votes, np.eye(4)[many]])


def linear(votes: np.ndarray, sign: np.ndarray, weight: np.ndarray, target: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels of weighted rows by Newton steps with a ridge."""
    x = np.hstack([_rows(votes, sign), np.ones((len(votes), 1))])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(30):
        p = _sigmoid(x @ w)
        g = x.T @ (weight * (p - target)) + ridge * w
        h = (x * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _unlabelled(documents: DataFrame, labels: DataFrame, skip) -> DataFrame:
    """doc_id, text, label (-1) of about SAMPLE rows, by hash of the id, that skip leaves and no label names."""
    d = only(documents, doc_id="bigint", text="string").where(F.col("doc_id").isNotNull() & ~skip(F.col("doc_id")))
    share = min(1.0, SAMPLE / max(1, d.select("doc_id").count()))
    d = d.where(F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))
    told = only(labels, doc_id="bigint", toxic="int").where(F.col("toxic").isNotNull())
    return d.join(told, "doc_id", "left_anti").select("doc_id", "text", F.lit(-1).alias("label"))


def train(documents: DataFrame, labels: DataFrame, skip) -> Classifier:
    """A classifier from a sample of the rows that ``skip`` leaves, labelled ones and as many others. Without toxic rows nothing is toxic; of an id's several labels the least counts. Equal texts count once, by their least id."""
    rows = sample(documents, labels, "toxic", SAMPLE, skip).unionByName(_unlabelled(documents, labels, skip))
    mine = F.struct((F.col("label") < 0).alias("none"), "doc_id", "label", "text")
    rows = rows.withColumn("h", F.xxhash64("text")).groupBy("h").agg(F.min(mine).alias("r")).select("r.doc_id", "r.text", "r.label", "h")
    rows = written(rows, "labelled")
    told = rows.where("label >= 0")
    total = {r["label"]: r["count"] for r in told.groupBy("label").count().collect()}
    toxic, other = sum(v for k, v in total.items() if k), total.get(0, 0)
    if not toxic:
        forget(rows)
        return Classifier([], np.zeros(4), -6.0)
    seen = _counts(told)
    yes, no = F.col("toxic") / F.lit(float(toxic + 1)), F.col("other") / F.lit(float(other + 1))
    least = max(2, min(SUPPORT, toxic // 10))
    lift = yes / ((F.col("other") + F.lit(0.5)) / F.lit(float(other + 1)))
    top = seen.where(F.col("toxic") >= least).withColumn("lift", lift).where(F.col("lift") >= min(LIFT, (other + 1) / 2)).orderBy(F.desc("toxic"), F.desc("lift"), "feature").limit(CANDIDATES)
    lift = no / ((F.col("toxic") + F.lit(0.5)) / F.lit(float(toxic + 1)))
    low = seen.withColumn("lift", lift).where((no * toxic >= CERTAIN) & (F.col("lift") >= LIFT)).orderBy(F.desc("other"), F.desc("lift"), "feature").limit(CANDIDATES)
    found = [(r["kind"], r["feature"], r["lift"]) for r in top.select(F.lit(1).alias("kind"), "feature", "lift", "toxic").union(low.select(F.lit(-1), "feature", "lift", "other")).orderBy(F.desc("kind"), F.desc("toxic"), F.desc("lift"), "feature").collect()]
    names = [f for _, f, _ in found]
    y, hits = _fires(rows, names)
    forget(rows)
    voters, sign = [], []
    for kind, bound in ((1, least), (-1, int(CERTAIN))):
        at = np.array([k == kind for k, _, _ in found], bool)
        to = np.where(at, np.cumsum(at) - 1, -1)
        own = [t[t >= 0] for d, h in enumerate(hits) if y[d] >= 0 for t in [to[h]]]
        wanted = (y[y >= 0] > 0) == (kind > 0)
        chosen = choose([f for f, x in zip(names, at, strict=True) if x], np.array([v for _, _, v in found])[at], own, wanted.astype(int), bound) if at.any() else []
        voters += chosen
        sign += [kind] * len(chosen)
    if not voters:
        return Classifier([], np.zeros(4), math.log(toxic / (other + 1)))
    place, sign = {f: i for i, f in enumerate(voters)}, np.array(sign)
    to = np.array([place.get(f, -1) for f in names], np.int64)
    votes = np.zeros((len(y), len(voters)), bool)
    for d, h in enumerate(hits):
        h = to[h]
        votes[d, h[h >= 0]] = True
    votes, which, weight = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    votes, weight = votes.astype(float), weight.astype(float)
    tally = lambda rows: np.bincount(which[rows], minlength=len(votes)).astype(float)
    posterior = calibrated(LabelModel(votes, weight, sign, toxic / (toxic + other)).logit(votes), tally(y > 0), tally(y == 0)) if other else np.ones(len(votes))
    weights, bias = linear(votes, sign, weight, posterior)
    return Classifier(voters, weights, bias, int((sign < 0).sum()))


def score(documents: DataFrame, model: Classifier, name: str = "toxicity") -> DataFrame:
    """The rows of documents, all their columns, with toxicity under that name; a column that has it is replaced. Null texts are as empty ones."""
    documents = documents.drop(name)
    text = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([model.score(t) for t in b.column(text).to_pylist()], pa.float64())], names=[*b.schema.names, name])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(run, f"{ddl}, `{name}` double")


def held_out(doc_id):
    return bucket(doc_id, 4) == 2


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; learns from labelled rows that are not held out.

    Null, empty and wordless texts have the score of a text on which no voter fires; whole texts count, however long. Repeated rows and ids are
    rows of their own. Without toxic labels nothing is toxic. An empty table gives an empty one; columns but doc_id, text and toxic are not read.
    """
    out = score(only(documents, doc_id="bigint", text="string"), train(documents, labels, held_out))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
