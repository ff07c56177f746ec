"""Language-model scoring over a subword lattice.

The vocabulary is that of an existing tokenizer file, with its bytes as a last resort, and the words of the training texts
as whole pieces. A word's probability is the sum over all its segmentations of the product of their unigram scores, by a
forward recursion in log space; no piece goes over a word's end, so a document's is the product over its words and its end.

Scores: the file's own are the start (a ranked file's by Zipf's law). Every training word gives a discount d of its
count to its segmentations, and keeps the rest as a whole piece; d is n1 / (n1 + 2 n2), of words met once and twice. The
expected piece counts of those segmentations under the start (forward-backward over every distinct training word), with
one word end each, become the pieces' scores. So the pieces spell a word with their sum's share of all training counts.

Each distinct word is scored once. Frequent words' scores, a bounded number, are sent to where the texts are; the
counts of the others go to their scores by a join on the word.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm.common import bucket, forget, frequent, only, texts, written

#: Most frequent words whose scores are sent to the executors, each of HEAD_BYTES at most; the rest are joined.
HEAD, HEAD_BYTES = 200_000, 64
#: Distinct words a task counts at once, and their bytes; memory only.
KEPT, KEPT_BYTES = 300_000, 32 << 20
#: Words of one length go through the recursion together: marked words of at most LONG characters, CELLS characters at a time; fewer than FEW, and longer ones, go one by one.
LONG, CELLS, FEW = 64, 400_000, 16
#: Added to every piece's expected count.
FLOOR = 0.1
MARK = "▁"


class Lattice:
    """Pieces with natural log scores, by which words are segmented. Every byte is a piece, so every word has a segmentation."""

    def __init__(self, names: list[str], logs: list[float], byte_names: list[str]):
        self.names, self.bytes = names, byte_names
        self.index = {n: i for i, n in enumerate(names)}
        self.logs = logs
        special = set(byte_names)
        self.score = {n: s for n, s in zip(names, logs, strict=True) if n not in special}
        self.longest = max(map(len, self.score), default=1)
        self.byte = [logs[self.index[b]] for b in byte_names]
        self._trie()

    def _trie(self) -> None:
        """The pieces as a trie: sorted (node, character) pairs, the nodes they lead to, and the piece that ends at a node."""
        step: dict[int, int] = {}
        ends = [-1]
        for n in self.score:
            node = 0
            for ch in n:
                node = step.setdefault(node << 21 | ord(ch), len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = self.index[n]
        pairs = sorted(step)
        self.pairs, self.leads = np.array([*pairs, np.iinfo(np.int64).max], np.int64), np.array([*(step[k] for k in pairs), 0], np.int64)
        self.ends, self.piece_logs = np.array(ends, np.int64), np.array(self.logs)

    def _together(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Places of words that go through the recursion together, with their characters as a matrix; None for one that goes alone."""
        by_length: dict[int, list[int]] = {}
        for at, w in enumerate(words):
            by_length.setdefault(len(w) + 1, []).append(at)
        for length, places in by_length.items():
            size = CELLS // length if length <= LONG else 1
            for k in range(0, len(places), max(1, size)):
                some = places[k : k + max(1, size)]
                if length > LONG or len(some) < FEW:
                    yield from ((np.array([at]), None) for at in some)
                else:
                    text = "".join([MARK + words[at] for at in some])
                    yield np.array(some), np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64).reshape(len(some), length)

    def _arcs(self, codes: np.ndarray, i: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """The arcs from character i of every row: their end, rows, log scores and pieces (-1 - character where it is a character by its bytes)."""
        rows = np.arange(len(codes))
        node = np.zeros(len(codes), np.int64)
        for j in range(i + 1, codes.shape[1] + 1):
            pair = node << 21 | codes[rows, j - 1]
            at = np.searchsorted(self.pairs, pair)
            there = self.pairs[at] == pair
            if j == i + 1:
                spelled = np.ones(len(codes), bool)
                spelled[there] = self.ends[self.leads[at[there]]] < 0
                if spelled.any():
                    chars, which = np.unique(codes[spelled, i], return_inverse=True)
                    logs = np.array([sum(self.byte[b] for b in chr(c).encode()) for c in chars.tolist()])
                    yield j, np.nonzero(spelled)[0], logs[which], -1 - chars[which]
            rows, node = rows[there], self.leads[at[there]]
            if not len(rows):
                return
            piece = self.ends[node]
            if (ends := piece >= 0).any():
                yield j, rows[ends], self.piece_logs[piece[ends]], piece[ends]

    def forwards(self, words: list[str]) -> np.ndarray:
        """forward(word) of every word."""
        out = np.empty(len(words))
        for places, codes in self._together(words):
            if codes is None:
                out[places] = self.forward(words[places[0]])
                continue
            alpha = np.full((codes.shape[1] + 1, len(codes)), -np.inf)
            alpha[0] = 0.0
            for i in range(codes.shape[1]):
                for j, rows, logs, _ in self._arcs(codes, i):
                    alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + logs)
            out[places] = alpha[-1]
        return out

    def expectations(self, words: list[str], weight: float, into: np.ndarray) -> None:
        """expected(word, weight, into) of every word."""
        alone: dict[int, float] = {}
        for places, codes in self._together(words):
            if codes is None:
                self.expected(words[places[0]], weight, alone)
                continue
            length = codes.shape[1]
            alpha, beta = np.full((2, length + 1, len(codes)), -np.inf)
            alpha[0] = beta[length] = 0.0
            arcs = []
            for i in range(length):
                arcs.append(list(self._arcs(codes, i)))
                for j, rows, logs, _ in arcs[i]:
                    alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + logs)
            for i in range(length - 1, -1, -1):
                for j, rows, logs, pieces in arcs[i]:
                    rest = logs + beta[j, rows]
                    beta[i, rows] = np.logaddexp(beta[i, rows], rest)
                    e = weight * np.exp(alpha[i, rows] + rest - alpha[length, rows])
                    if pieces[0] >= 0:
                        into += np.bincount(pieces, e, len(into))
                    else:
                        chars, which = np.unique(-1 - pieces, return_inverse=True)
                        for c, x in zip(chars.tolist(), np.bincount(which, e).tolist(), strict=True):
                            for b in chr(c).encode():
                                into[self.index[self.bytes[b]]] += x
        for k, e in alone.items():
            into[k] += e

    @classmethod
    def from_file(cls, path: str, ranked: bool = False) -> Lattice:
        """The normal pieces and bytes of a sentencepiece file. Scores of a ranked (BPE) file are ranks below zero; they become 1 / (rank + 2), over their sum."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        names = [sp.id_to_piece(i) for i in ids]
        byte_names = [f"<0x{b:02X}>" for b in range(256)]
        scores = {n: sp.get_score(i) for n, i in zip(names, ids, strict=True) if n not in set(byte_names)}
        names = [*scores, *byte_names]
        raw = [1 / (2.0 - scores[n]) if ranked else math.exp(scores[n]) for n in scores]
        least = min(raw, default=1.0) / 16
        raw += [least] * 256
        total = math.log(sum(raw))
        return cls(names, [math.log(x) - total for x in raw], byte_names)

    def _alphas(self, word: str) -> array:
        """By end, the log of the sum over all segmentations of the marked word up to there."""
        s, get, longest, exp, log = MARK + word, self.score.get, self.longest, math.exp, math.log
        alpha = array("d", [0.0])
        for j in range(1, len(s) + 1):
            p = get(s[j - 1 : j])
            terms = [alpha[j - 1] + (sum(self.byte[b] for b in s[j - 1].encode()) if p is None else p)]
            for i in range(max(0, j - longest), j - 1):
                p = get(s[i:j])
                if p is not None:
                    terms.append(alpha[i] + p)
            m = max(terms)
            alpha.append(terms[0] if len(terms) == 1 else m + log(sum([exp(t - m) for t in terms])))
        return alpha

    def forward(self, word: str) -> float:
        """Log of the sum over all segmentations."""
        return self._alphas(word)[-1]

    def expected(self, word: str, weight: float, into: dict[int, float]) -> None:
        """Adds weight times the expected number of each piece over the word's segmentations. Memory is two numbers a character."""
        s, get, longest, exp, log = MARK + word, self.score.get, self.longest, math.exp, math.log
        alpha, n = self._alphas(word), len(word) + 1
        beta = array("d", bytes(8 * (n + 1)))
        for i in range(n - 1, -1, -1):
            terms, pieces = [], []
            for j in range(i + 1, min(n, i + longest) + 1):
                p = get(s[i:j])
                if p is not None:
                    terms.append(p + beta[j])
                    pieces.append([self.index[s[i:j]]])
                elif j == i + 1:
                    terms.append(sum(self.byte[b] for b in s[i].encode()) + beta[j])
                    pieces.append([self.index[self.bytes[b]] for b in s[i].encode()])
            m = max(terms)
            beta[i] = m + log(sum([exp(t - m) for t in terms]))
            for t, ks in zip(terms, pieces, strict=True):
                e = weight * exp(alpha[i] + t - alpha[n])
                for k in ks:
                    into[k] = into.get(k, 0.0) + e


def _types(documents: DataFrame) -> DataFrame:
    """word, n (occurrences), c (those in training texts). documents: text, held_out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: Counter[bytes] = Counter()
        held: Counter[bytes] = Counter()
        met = 0

        def out() -> pa.RecordBatch:
            keys = list(every)
            n = np.fromiter(every.values(), np.int64, len(keys))
            h = np.fromiter((held.get(k, 0) for k in keys), np.int64, len(keys))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()).cast(pa.string()), pa.array(n), pa.array(n - h)], names=["word", "n", "c"])

        for b in batches:
            for text, out_of in zip(texts(b.column(0)), b.column(1).to_pylist(), strict=True):
                words = text.lower().split()
                every.update(words)
                if out_of:
                    held.update(words)
                met += len(text)
                if len(every) > KEPT or met > KEPT_BYTES and (met := sum(map(len, every))) > KEPT_BYTES:
                    yield out()
                    every.clear()
                    held.clear()
                    met = 0
        yield out()

    return documents.select("text", "held_out").mapInArrow(run, "word string, n bigint, c bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


class Scores:
    """What scores a word, given its training count."""

    def __init__(self, lattice: Lattice, spelled: float, z: float, discount: float, base: float):
        """spelled: log of the share of words that are spelled by pieces, times that of a word's end among pieces."""
        self.lattice, self.spelled, self.z, self.discount, self.base = lattice, spelled, z, discount, base

    def word(self, word: str, c: int) -> float:
        """log10 of the sum over the word's segmentations, itself as a whole piece among them."""
        p = self.spelled + self.lattice.forward(word)
        if c > self.discount:
            whole = math.log((c - self.discount) / self.z)
            m = max(p, whole)
            p = m + math.log(math.exp(p - m) + math.exp(whole - m))
        return p / math.log(10)

    def words(self, words: list[str], c: np.ndarray) -> np.ndarray:
        """word(word, c) of every word."""
        p = self.spelled + self.lattice.forwards(words)
        whole = np.log(np.maximum(c - self.discount, 0), out=np.full(len(words), -np.inf), where=c > self.discount) - math.log(self.z)
        return np.logaddexp(p, whole) / math.log(10)


def fit(types: DataFrame, train_docs: int, start: Lattice) -> tuple[Scores, dict]:
    """Scores from the distinct words of the training texts, and the counts that the base model needs."""
    t = types.where("c > 0").agg(F.sum("c").alias("words"), F.count("*").alias("v"), F.sum((F.col("c") == 1).cast("bigint")).alias("n1"), F.sum((F.col("c") == 2).cast("bigint")).alias("n2")).first()
    words, v, n1, n2 = t["words"] or 0, t["v"], t["n1"] or 0, t["n2"] or 0
    discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = np.zeros(len(start.names))
        for b in batches:
            start.expectations(b.column(0).to_pylist(), discount, into)
        met = np.nonzero(into)[0]
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(into[met])], names=["piece", "e"])

    counts = np.full(len(start.names), FLOOR)
    for r in types.where("c > 0").select("word").mapInArrow(expect, "piece int, e double").groupBy("piece").agg(F.sum("e").alias("e")).collect():
        counts[r["piece"]] += r["e"]
    end, spelled = train_docs + 0.5, discount * max(v, 1)
    z = words - discount * v + spelled + end
    pieces = float(counts.sum()) + spelled
    tuned = Lattice(start.names, np.log(counts / pieces).tolist(), start.bytes)
    n, distinct = words + train_docs, v + (train_docs > 0)
    base = n + 0.5 * (distinct + 1)
    return Scores(tuned, math.log(spelled / z) + math.log(spelled / pieces), z, discount, base), {"train_tokens": n, "end": math.log10(end / z), "base_end": math.log10((train_docs + 0.5) / base), "train_docs": train_docs}


def score(documents: DataFrame, tokenizer_file: str, held_out, ranked: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, vocabulary_score of every row; learns from rows that held_out leaves.

    Tokens are the words of the lower-cased (A-Z) text and one end. score: log10 of the text's probability under the fitted pieces and
    the training words, its end included; vocabulary_score: that of its words under the file's own scores alone, which has no end. ranked: whether
    the file's scores are ranks. Null, empty and blank texts are one end; whole texts count, however long. Repeated rows
    are scored each; with nothing to learn from, scores come from the file's pieces alone and no token is known. An empty table gives
    an empty one; columns but doc_id and text are not read. The input's plan must give the same rows in the same partitions each time it
    runs, as a scan does: rows are numbered by partition and place, within one job.
    """
    d = only(documents, doc_id="bigint", text="string").select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    types = written(_types(d), "types")
    train_docs = d.where(~F.col("held_out")).count()
    start = Lattice.from_file(tokenizer_file, ranked)
    scores, told = fit(types, train_docs, start)

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column(0).to_pylist()
            lp, lv = scores.words(words, b.column(2).to_numpy()), start.forwards(words) / math.log(10)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(lp, pa.float64()), pa.array(lv, pa.float64())], names=["word", "n", "c", "lp", "lv"])

    valued = written(types.mapInArrow(value, "word string, n bigint, c bigint, lp double, lv double"), "scores")
    forget(types)
    top = frequent(valued.where(F.octet_length("word") <= HEAD_BYTES), "n", HEAD).select("word", "c", "lp", "lv").toArrow()
    base, ten = scores.base, math.log10
    head = dict(zip(top["word"].cast(pa.binary()).to_pylist(), zip(top["c"].to_pylist(), top["lp"].to_pylist(), top["lv"].to_pylist(), strict=True), strict=True))
    head = {w: (c > 0, ten((c + 0.5) / base), lp, lv) for w, (c, lp, lv) in head.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = (TaskContext.get().partitionId() << 40) - 1
        for b in batches:
            rows, ids, outs, tokens, known, bases, lps, lvs, rest, times = [], [], [], [], [], [], [], [], [], []
            for doc_id, text, out in zip(b.column(0).to_pylist(), texts(b.column(1)), b.column(2).to_pylist(), strict=True):
                row += 1
                n = own = 0
                s_base = s = v = 0.0
                tail: list[tuple[bytes, int]] = []
                for w, k in Counter(text.lower().split()).items():
                    n += k
                    h = head.get(w)
                    if h is None:
                        tail.append((w, k))
                    else:
                        own += k * h[0]
                        s_base += k * h[1]
                        s += k * h[2]
                        v += k * h[3]
                rows += [row] * (1 + len(tail))
                ids += [doc_id, *[None] * len(tail)]
                outs += [out, *[None] * len(tail)]
                tokens += [n, *[None] * len(tail)]
                known += [own, *[0] * len(tail)]
                bases += [s_base, *[0.0] * len(tail)]
                lps += [s, *[0.0] * len(tail)]
                lvs += [v, *[0.0] * len(tail)]
                rest.append(b"\n%d" % row)  # no word: spreads the rows of documents over the join's partitions
                times.append(0)
                rest += [w for w, _ in tail]
                times += [k for _, k in tail]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in ((rows, pa.int64()), (ids, pa.int64()), (outs, pa.bool_()), (tokens, pa.int64()), (known, pa.int64()), (bases, pa.float64()), (lps, pa.float64()), (lvs, pa.float64()))] + [pa.array(rest, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())],
                names=["row", "doc_id", "held_out", "n", "known", "base", "lp", "lv", "word", "k"],
            )

    parts = d.mapInArrow(run, "row bigint, doc_id bigint, held_out boolean, n bigint, known bigint, base double, lp double, lv double, word string, k bigint")
    own = valued.select("word", F.col("c").alias("wc"), F.col("lp").alias("wl"), F.col("lv").alias("wv"))
    met, k = F.col("wc").isNotNull(), F.col("k")
    summed = parts.join(own, "word", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        (F.max("n") + 1).alias("n_tokens"),
        (F.sum(F.col("known") + F.when(met & (F.col("wc") > 0), k).otherwise(0)) + int(told["train_docs"] > 0)).alias("n_known"),
        (F.sum(F.col("base") + F.when(met, k * F.log10((F.col("wc") + 0.5) / F.lit(base))).otherwise(0.0)) + F.lit(told["base_end"])).alias("base_score"),
        (F.sum(F.col("lp") + F.when(met, k * F.col("wl")).otherwise(0.0)) + F.lit(told["end"])).alias("score"),
        F.sum(F.col("lv") + F.when(met, k * F.col("wv")).otherwise(0.0)).alias("vocabulary_score"),
    )
    return summed.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(told["train_tokens"]).cast("bigint").alias("train_tokens"), "base_score", "score", "vocabulary_score")


def held_out(doc_id):
    return bucket(doc_id, 5) == 1


def report(documents: DataFrame, tokenizer_file: str, ranked: bool = False) -> DataFrame:
    """What ``score`` gives, with every fifth document, by crc32 of its id, held out of the training."""
    return score(documents, tokenizer_file, held_out, ranked)
