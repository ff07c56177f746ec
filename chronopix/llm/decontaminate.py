"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton accepts every run of words of any item. A document's words are streamed through it; at each word the
state gives the longest run that ends there and occurs in an item. Runs of a window's length or more are hits, as are
whole items that are shorter. Hits make spans; spans are what ``remove`` cuts, where the length and coverage limits say so.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm.common import fresh, only, texts

#: Words of a window.
WINDOW = 13
#: Words of items in one automaton, which bounds what is sent to the executors; more items make more automata.
AUTOMATON_WORDS = 200_000
#: Bytes of texts that a task takes through the automata together, and automata that it keeps in memory; no results depend on them.
RUN_BYTES, KEPT = 32 << 20, 2
#: A document is contaminated if hit words times this reach its words.
COVERAGE = 20

#: A word as SQL says it.
_ITEM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NORM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def normalised(text: bytes) -> list[bytes]:
    """Words: runs of ASCII letters and digits and of anything that is not ASCII, A-Z in lower case."""
    return text.translate(_NORM).split()


class Automaton:
    """A generalised suffix automaton over the words of many items."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW):
        self.window, self.vocabulary = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for i, words in items if words]
        for _, words in coded:
            last = 0
            for c in words:
                last = self._extend(last, c)
        n = len(self.next)
        #: By state: the items of its window; its short items, as (words, item), and those of its suffixes.
        self.items: list[set] = [set() for _ in range(n)]
        short: list[set] = [set() for _ in range(n)]
        for i, words in coded:
            at, width = 0, min(window, len(words))
            for k, c in enumerate(words):
                at = self.next[at][c]
                while self.length[self.link[at]] >= width and at:
                    at = self.link[at]
                if k + 1 >= width:
                    (self.items[at] if width == window else short[at]).add(i if width == window else (width, i))
        #: By state: the ancestor that holds its last window, the short items that end there, the least match that is a hit.
        self.short: list[tuple] = [()] * n
        self.last, self.needs = [0] * n, [1 << 60] * n
        for s in sorted(range(n), key=self.length.__getitem__):
            up = self.link[s]
            self.last[s] = self.last[up] if s and self.length[up] >= window else s
            self.short[s] = tuple(short[s]) + (self.short[up] if s else ())
            self.needs[s] = min([window] * (self.length[s] >= window) + [w for w, _ in self.short[s]], default=1 << 60)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:  # the run is there already
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, q, c)
        new = self._state(length[last] + 1, {})
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return new

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        twin = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[twin], self.link[q] = self.link[q], twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Spans [start, end) of hit words, in order and apart, and the items whose windows occur."""
        nxt, link, length, needs, window = self.next, self.link, self.length, self.needs, self.window
        state = matched = 0
        spans: list[list[int]] = []
        found: set = set()
        for i, c in enumerate(map(self.vocabulary.get, words)):
            to = nxt[state].get(c)
            if to is None:
                if c is None:
                    state = matched = 0
                    continue
                while state and to is None:
                    state = link[state]
                    to = nxt[state].get(c)
                matched = length[state] if to is not None else 0
                if to is None:
                    state = 0
                    continue
            state = to
            matched += 1
            if matched >= needs[state]:
                width = matched if matched >= window else 0
                if width:
                    found |= self.items[self.last[state]]
                for w, item in self.short[state]:
                    if w <= matched:
                        found.add(item)
                        width = max(width, w)
                start = i + 1 - width
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
        return spans, found


def _automata(benchmark: DataFrame, window: int) -> list[Broadcast]:
    """The automata of all items, each built in a task and sent to the executors, pickled; the driver holds one at a time. Equal items are one."""
    most, spark = AUTOMATON_WORDS, benchmark.sparkSession
    items = only(benchmark, item_id="bigint", text="string").distinct()
    words = items.agg(F.sum(F.regexp_count("text", F.lit(_ITEM_WORD)))).first()[0] or 0

    def build(table: pa.Table) -> pa.Table:
        out, part, size = [], [], 0
        for i, text in zip(table["item_id"].to_pylist(), texts(table["text"]), strict=True):
            own = normalised(text)
            if part and size + len(own) > most:
                out.append(pickle.dumps(Automaton(part, window), 5))
                part, size = [], 0
            part.append((i, own))
            size += len(own)
        return pa.table({"automaton": pa.array([*out, pickle.dumps(Automaton(part, window), 5)], pa.binary())})

    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, math.ceil(words / most))))
    built = items.where(F.col("text").isNotNull()).select("item_id", "text", block.alias("block")).groupBy("block").applyInArrow(build, "automaton binary")
    return [spark.sparkContext.broadcast(bytes(r["automaton"])) for r in built.toLocalIterator()]


_RESULT = pa.schema([("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64()))])
_TYPES = ("array<struct<start:bigint,end:bigint>>", "bigint", "bigint", "array<bigint>")


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _runs(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches, so many at once as have RUN_BYTES of text."""
    run, size = [], 0
    for b in batches:
        run.append(b)
        size += b.column(text).nbytes
        if size >= RUN_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


def find(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, names: tuple[str, str, str, str] = ("spans", "n_words", "n_hit", "items")) -> DataFrame:
    """The rows of documents, all their columns, with spans (of words, apart), n_words, n_hit, items (ids in order), or under other names.

    A hit word is inside an occurrence of a window: `window` words in a row of an item, or all words of a shorter item.
    Null, empty and wordless texts have no words and no hits; wordless items make no window; items with a null id
    hit but aren't listed; repeated items and rows count as they are. Whole texts count, however long. Columns of documents with the names of the
    new ones are replaced. An empty table gives an empty one. One automaton holds at most AUTOMATON_WORDS words of items (or one item). Documents are
    read once: a task holds RUN_BYTES of texts, or one batch, and takes them through all automata, of which it keeps KEPT in memory.
    """
    out = documents.drop(*names)
    text = out.columns.index("text")
    parts = _automata(benchmark, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, Automaton] = {}
        for some in _runs(batches, text):
            words = [normalised(t) for b in some for t in texts(b.column(text))]
            spans: list[list[list[int]]] = [[] for _ in words]
            items: list[set] = [set() for _ in words]
            for k, part in enumerate(parts):
                if (automaton := kept.get(k)) is None:
                    automaton = pickle.loads(part.value)
                    vars(part).pop("_value", None)  # the pickled form needn't stay
                    if len(kept) < KEPT:
                        kept[k] = automaton
                for i, w in enumerate(words):
                    s, found = automaton.match(w)
                    spans[i] = _merged(spans[i] + s) if spans[i] and s else spans[i] or s
                    items[i] |= found
            at = 0
            for b in some:
                here = slice(at, at + b.num_rows)
                at += b.num_rows
                new = ([[{"start": x, "end": y} for x, y in s] for s in spans[here]], [len(w) for w in words[here]], [sum(y - x for x, y in s) for s in spans[here]], [sorted(f - {None}) for f in items[here]])
                yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x, f.type) for x, f in zip(new, _RESULT, strict=True))], names=[*b.schema.names, *names])

    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema] + [f"`{n}` {t}" for n, t in zip(names, _TYPES, strict=True)])
    return out.mapInArrow(run, ddl)


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    return (F.col(n_hit) > 0) & (F.lit(COVERAGE) * F.col(n_hit) >= F.col(n_words))


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of documents."""
    found = find(only(documents, doc_id="bigint", text="string"), benchmark)
    listed = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(listed.cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and the separators between them."""
    flags = text.translate(_NORM)
    at, bounds = 0, []
    for w in flags.split():
        a = flags.index(w, at)
        at = a + len(w)
        bounds.append((a, at))
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : bounds[a][0]])
        last = bounds[b - 1][1]
    return b"".join([*out, text[last:]])


def remove(documents: DataFrame, benchmark: DataFrame, longest: int | None = None, drop: bool = True) -> DataFrame:
    """Documents with their columns: contaminated ones go (drop) or lose their spans; of the others, spans of more than ``longest`` words are cut, none if that is None.

    Only text changes, and n_chars where there is such a column; columns of any name are left alone otherwise.
    """
    columns, names = documents.columns, fresh(documents, "spans", "n_words", "n_hit", "items")
    found, bad = find(documents, benchmark, names=names), contaminated(names[2], names[1])
    long = F.filter(names[0], lambda s: s["end"] - s["start"] > longest) if longest is not None else F.filter(names[0], lambda s: F.lit(False))
    if drop:
        found = found.where(~bad)
        if longest is None:
            return found.select(*[F.col(f"`{c}`") for c in columns])
        cuts = long
    else:
        cuts = F.when(bad, F.col(names[0])).otherwise(long)
    found = found.withColumn(names[0], cuts).drop(*names[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, k = batch.schema.get_field_index("text"), batch.schema.get_field_index(names[0])
            spans = batch.column(k).to_pylist()
            new = [cut(t, [(x["start"], x["end"]) for x in s]).decode() if s else None for t, s in zip(texts(batch.column(i)), spans, strict=True)]
            old = batch.column(i).to_pylist()
            changed = list(batch.columns)
            changed[i] = pa.array([o if n is None else n for n, o in zip(new, old, strict=True)], pa.string())
            if "n_chars" in batch.schema.names:
                c = batch.schema.get_field_index("n_chars")
                changed[c] = pa.array([o if n is None else len(n) for n, o in zip(new, batch.column(c).to_pylist(), strict=True)], batch.schema.field(c).type)
            yield pa.RecordBatch.from_arrays(changed, names=batch.schema.names)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
    return found.mapInArrow(run, ddl).select(*[F.col(f"`{c}`") for c in columns])
