"""Language identification by rank order of n-grams.

A profile is the most frequent n-grams (1 to 3 letters, word ends marked) in order. A document's own most frequent n-grams
are compared with every language's profile: each adds how far its place is out of the place it has there, or the largest
distance if the profile lacks it. The language that is least out of place is predicted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronopix.llm.common import bucket, only

#: Longest n-gram; n-grams of a language's profile; n-grams of a document's.
LONGEST, PROFILE, OWN = 3, 1_000, 300
#: N-grams that a task keeps numbers of; memory only.
KEPT = 600_000
#: Counts that a task keeps, over all its languages; memory only.
CELLS = 16_000_000
#: Languages that profiles are kept for; more are an error, for profiles are sent to every executor.
LANGUAGES = 2_000


def grams(text: str) -> list[str]:
    """The n-grams of a text's words, with repeats. Words are runs of letters of the lower-cased text; an end is marked _."""
    out = []
    for letters, run in groupby(text.lower(), str.isalpha):
        if letters:
            w = f"_{''.join(run)}_"
            out += [w[i : i + n] for n in range(1, LONGEST + 1) for i in range(len(w) - n + 1) if n > 1 or w[i] != "_"]
    return out


class Numbers:
    """Numbers the n-grams of texts. Texts whose letters are among the first 127 met go by array operations: a letter has 7 bits,
    an n-gram's bits are its place in a table of numbers. Other texts go by their strings, to the same numbers."""

    BITS = 7
    UNSET, RARE = 255, 254

    def __init__(self) -> None:
        self.char = np.full(0x110000, self.UNSET, np.uint8)
        self.letters = ["_"]
        self.start = [0, 1 << self.BITS, (1 << self.BITS) + (1 << 2 * self.BITS)]
        self.clear()

    def clear(self) -> None:
        self.table = np.full(sum(1 << self.BITS * n for n in (1, 2, 3)), -1, np.int32)
        self.ids: dict[str, int] = {}

    def number(self, gram: str) -> int:
        return self.ids.setdefault(gram, len(self.ids))

    def _meet(self, codes: np.ndarray) -> None:
        for c in np.unique(codes).tolist():
            if not chr(c).isalpha():
                self.char[c] = 0
            elif len(self.letters) < 1 << self.BITS:
                self.char[c] = len(self.letters)
                self.letters.append(chr(c))
            else:
                self.char[c] = self.RARE

    def __call__(self, text: str) -> np.ndarray:
        """The numbers of a text's n-grams, with repeats."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        c = self.char[codes]
        if (fresh := c == self.UNSET).any():
            self._meet(codes[fresh])
            c = self.char[codes]
        if (c == self.RARE).any():
            return np.fromiter(map(self.number, grams(text)), np.int64)
        padded = np.zeros(len(c) + 2, np.int32)
        padded[1:-1] = c
        a, b, d = padded[:-2], padded[1:-1], padded[2:]
        middle = b != 0
        pairs = (padded[:-1] | padded[1:]) != 0
        two = (padded[:-1][pairs] << self.BITS) | padded[1:][pairs]
        three = (a[middle] << 2 * self.BITS) | (b[middle] << self.BITS) | d[middle]
        places = np.concatenate([b[middle], two + self.start[1], three + self.start[2]])
        out = self.table[places]
        if (new := out < 0).any():
            for p in np.unique(places[new]).tolist():
                self.table[p] = self.number(self._gram(p))
            out = self.table[places]
        return out

    def _gram(self, place: int) -> str:
        n = 1 if place < self.start[1] else 2 if place < self.start[2] else 3
        place -= self.start[n - 1]
        return "".join(self.letters[place >> self.BITS * (n - 1 - i) & (1 << self.BITS) - 1] for i in range(n))


def profiles(documents: DataFrame, longest: int = PROFILE) -> dict[str, list[str]]:
    """The profile of every language from the text and lang of all rows with a lang: n-grams by count, ties by code point. No row with letters: no language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, seen, cells = Numbers(), {}, 0

        def out() -> Iterator[pa.RecordBatch]:
            names = np.array(list(numbers.ids), dtype=object)
            for lang, total in seen.items():
                there = np.nonzero(total)[0]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(there), pa.string()), pa.array(names[there], pa.string()), pa.array(total[there].astype(np.int64))], names=["lang", "gram", "n"])
            seen.clear()
            numbers.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                own = np.bincount(numbers(text))
                total = seen.get(lang)
                if total is None or len(total) < len(own):
                    grown = np.zeros(max(1 << 10, 2 * len(own)), np.int64)
                    cells += len(grown) - (0 if total is None else len(total))
                    if total is not None:
                        grown[: len(total)] = total
                    total = seen[lang] = grown
                total[: len(own)] += own
                if len(numbers.ids) > KEPT or cells > CELLS:
                    yield from out()
                    cells = 0
        yield from out()

    counted = documents.where(F.col("lang").isNotNull()).select("text", "lang").mapInArrow(count, "lang string, gram string, n bigint")
    total = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = total.select("lang", "gram", place.alias("place")).where(F.col("place") <= longest)
    rows = top.orderBy("lang", "place").limit(LANGUAGES * longest + 1).collect()
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["lang"], []).append(r["gram"])
    if len(out) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    return out


class Ranker:
    """Predicts by out-of-place distance."""

    def __init__(self, known: dict[str, list[str]], own: int = OWN, unlearned: str = "und"):
        self.names, self.own, self.unlearned = sorted(known), own, unlearned
        self.far = max([own, *map(len, known.values())], default=own)
        self.profile = {n: {g: i for i, g in enumerate(known[n])} for n in self.names}
        self.numbers = Numbers()
        self.clear()

    def clear(self) -> None:
        self.numbers.clear()
        self.told = 0
        self.tie = np.zeros(1 << 12, np.int64)  # by n-gram: its crc32, and its place in every profile
        self.places = np.zeros((1 << 12, len(self.names)), np.int32)

    def _tell(self) -> None:
        fresh = list(islice(self.numbers.ids, self.told, None))
        while len(self.tie) < self.told + len(fresh):
            self.tie, self.places = np.concatenate([self.tie, self.tie]), np.concatenate([self.places, self.places])
        for i, g in enumerate(fresh, self.told):
            self.tie[i] = zlib.crc32(g.encode())
            self.places[i] = [self.profile[n].get(g, -1) for n in self.names]
        self.told += len(fresh)

    def predict(self, text: str | None) -> tuple[str, float]:
        """A language and 1 - its distance over the largest possible; 'und' and 0 without letters, ``unlearned`` and 0 for letters without languages. Ties of counts go by crc32 of the n-gram, of languages by code point."""
        if not text:
            return "und", 0.0
        if not self.names:
            return self.unlearned if any(map(str.isalpha, text.lower())) else "und", 0.0
        if len(self.numbers.ids) > KEPT:
            self.clear()
        ids = self.numbers(text)
        if not len(ids):
            return "und", 0.0
        if len(self.numbers.ids) > self.told:
            self._tell()
        total = np.bincount(ids)
        there = np.nonzero(total)[0]
        key = (total[there] << 32) | (0xFFFFFFFF - self.tie[there])
        if len(key) > self.own:
            top = np.argpartition(-key, self.own - 1)[: self.own]
            there, key = there[top], key[top]
        there = there[np.argsort(-key, kind="stable")]
        at = self.places[there]
        out = np.where(at >= 0, np.abs(at - np.arange(len(there))[:, None]), self.far).sum(axis=0)
        best = int(np.argmin(out))
        return self.names[best], float(1 - out[best] / (self.far * len(there)))


def identify(documents: DataFrame, known: dict[str, list[str]], unlearned: str = "und", names: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """The rows of documents, all their columns, with lang_pred and lang_score, or under other names, by the known profiles.

    Null, empty and letterless texts are 'und' with score 0. If no language is known, texts with letters are ``unlearned``, with
    score 0. Columns of the names of the new ones are replaced.
    """
    documents = documents.drop(*names)
    text = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(known, unlearned=unlearned)
        for batch in batches:
            found = [ranker.predict(t) for t in batch.column(text).to_pylist()]
            new = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(run, f"{ddl}, `{names[0]}` string, `{names[1]}` double")


def held_out(doc_id: str = "doc_id"):
    return bucket(F.col(doc_id), 4) == 2


def report(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from the rows that are not held out and have a lang.

    Null, empty and letterless texts are 'und' with score 0, as all are where nothing can be learned; whole texts count, however long. Repeated
    rows and ids are rows of their own. An empty table gives an empty one; columns but doc_id, text and lang are not read.
    """
    d = only(documents, doc_id="bigint", text="string", lang="string")
    found = identify(d.select("doc_id", "text"), profiles(d.where(~held_out()).select("text", "lang")))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
