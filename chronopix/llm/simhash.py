"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at 3 or fewer differing bits. Two that link differ by at most 1 bit in one of their two
halves of 32. For a half, the anchors are a covering code: the words whose first 31 bits are in the [31, 26] Hamming
code, which has covering radius 1, with any last bit. If x and y differ by at most 1 bit in a half, x's nearest anchor
is within 1 of x and so within 1 + 1 = 2 of y. So every fingerprint is replicated, per half, to each anchor within
covering radius plus threshold (17 at most per half), and any two that link meet at an anchor. At an anchor, they are
compared; a spanning forest of the links found there is kept, which leaves connected what was. Components
come from the forests' edges by rounds of hooking to the smallest neighbour, each round a written table.

For a similarity, texts link whose sets of shingles have that Jaccard similarity. Fingerprints are wider (WIDE bits, of distinct shingles): at similarity s two texts of a size differ in
acos(2 s / (1 + s)) / pi of their bits, on average, and that share of the bits is the threshold. The same anchors are laid over each run of 32 bits.
No code that is as short covers that many bits, so this finds most links only, and some that are none: its classes are checked on the sets. What it left out is
found by prefixes: in any one order of all shingles, two sets of similarity s share one of the first |x| - ceil(s |x|) + 1 of each. Frequent shingles come last in
that order. Pairs that meet so and are not joined yet are checked on the sets, after bounds by size and by parities of shingles, which exclude no link. There are
about as many parities as shingles, so that long texts too are told apart by them, and few sets have to be moved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopix.llm.common import arrow_map, forget, frequent, fresh, swept, texts, written

THRESHOLD = 3
#: Bits of the fingerprints that a similarity is judged by.
WIDE = 256
#: Votes are summed over so many shingles at once.
CHUNK = 65_536
#: Members of an anchor that one task compares. Crowded anchors, found on one fingerprint in SAMPLED, are compared in pairs of blocks; what is found does not depend on it.
BLOCK, SAMPLED = 16_384, 1_024
#: Shingles are counted in one of FREQUENT rows; at most MOST of those met 4 times there come last, by their counts. It changes the work, not the links.
FREQUENT, MOST = 32, 100_000
#: Parities of shingles kept of a text at least (of more shingles, the next power of 2), and, folded, where prefixes meet.
PARITIES, FOLDED = 512, 128
#: Bits by which rows that are not looked for are left out before texts are moved; with more rows than this, fewer are.
MARKS = 1 << 23
#: Rows of one fingerprint, from which on it is joined by broadcast: there are fewer such fingerprints than rows over HOT.
HOT = 100_000


def fingerprint(text: bytes) -> int:
    """The unsigned fingerprint: a bit is 1 if it is 1 in over half of the shingles' XXH64 (seed 42)."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < 3:
        return xxh64_intdigest(b" ".join(words), 42)
    n, votes = len(words) - 2, np.zeros(64, np.int64)
    for a in range(0, n, CHUNK):
        w = words[a : a + CHUNK + 2]
        h = np.fromiter((xxh64_intdigest(b"%b %b %b" % t, 42) for t in zip(w, w[1:], w[2:], strict=False)), np.uint64, len(w) - 2)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for b in range(0, len(bits), 255):  # sums of 255 ones fit the bytes
            votes += np.add.reduce(bits[b : b + 255], axis=0, dtype=np.uint8)
    ones = np.packbits(votes * 2 > n, bitorder="little")
    return int(ones.view(np.uint64)[0])


def wide_fingerprint(text: bytes, width: int) -> list[int]:
    """WIDE bits as unsigned numbers of 64: a bit is 1 if it is 1 in over half of the distinct shingles' XXH3 hashes; all 0 without words."""
    from xxhash import xxh3_128_digest

    shingles, votes = _shingles(text, width), np.zeros(WIDE, np.int64)
    if not shingles:
        return [0] * (WIDE // 64)
    for a in range(0, len(shingles), CHUNK // 4):
        some = shingles[a : a + CHUNK // 4]
        flat = b"".join([xxh3_128_digest(x, seed) for x in some for seed in range(42, 42 + WIDE // 128)])
        bits = np.unpackbits(np.frombuffer(flat, np.uint8).reshape(len(some), -1), axis=1, bitorder="little")
        for b in range(0, len(bits), 255):
            votes += np.add.reduce(bits[b : b + 255], axis=0, dtype=np.uint8)
    return np.packbits(votes * 2 > len(shingles), bitorder="little").view(np.uint64).tolist()


def _shingles(text: bytes, width: int) -> list[bytes]:
    """The distinct shingles of width words, of a shorter text the whole; none without words."""
    words = text.lower().split()
    return list({b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}) if words else []


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The distinct shingles as ascending XXH64 hashes (seed 42)."""
    from xxhash import xxh64_intdigest

    shingles = _shingles(text, width)
    return np.unique(np.fromiter((xxh64_intdigest(x, 42) for x in shingles), np.uint64, len(shingles)))


def fingerprints(documents: DataFrame, row: Column | None = None, width: int | None = None) -> DataFrame:
    """doc_id, row (any long that the caller wants kept, else 0) and the fingerprint of every row as signed longs, f0 and, if it is wide (of shingles of width words), more. Null, empty and blank texts have 0."""
    n = 1 if width is None else WIDE // 64

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([[fingerprint(t)] if width is None else wide_fingerprint(t, width) for t in texts(batch.column(2))], np.uint64).reshape(-1, n).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(fp[:, i]) for i in range(n))], names=["doc_id", "row", *(f"f{i}" for i in range(n))])

    d = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.lit(0) if row is None else row).cast("bigint").alias("row"), F.col("text").cast("string").alias("text"))
    return arrow_map(d, one, "doc_id bigint, row bigint, " + ", ".join(f"f{i} bigint" for i in range(n)))


def _flips() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome of the Hamming code, the changes of at most 2 bits, in 32, that lead to an anchor, padded with the first; and how many there are."""
    by: dict[int, set[int]] = {s: set() for s in range(32)}
    column = lambda bit: bit + 1  # noqa: E731  column of the parity check matrix: the bit's number from 1, in binary
    ones = [(1 << b, column(b)) for b in range(31)]
    for last in (0, 1 << 31):
        by[0].add(last)
        for m, c in ones:
            by[c].add(m | last)
    for i, (m, c) in enumerate(ones):
        for k, d in ones[:i]:
            by[c ^ d].add(m | k)
    by = {s: {m for m in v if m.bit_count() <= 2} for s, v in by.items()}
    most = max(map(len, by.values()))
    rows = [sorted(by[s]) for s in range(32)]
    return np.array([r + [r[0]] * (most - len(r)) for r in rows], np.uint32), np.array([len(r) for r in rows])


def _syndrome(half: np.ndarray) -> np.ndarray:
    out = np.zeros(len(half), np.int64)
    for bit in range(31):
        out ^= np.where((half >> np.uint32(bit)) & np.uint32(1), bit + 1, 0)
    return out


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index into fp, and the anchor (its half in bit 32), for each anchor within 2 of a half of a fingerprint."""
    flips, count = _flips()
    where, keys = [], []
    for half in (0, 1):
        x = ((fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        s = _syndrome(x)
        valid = np.arange(flips.shape[1])[None, :] < count[s][:, None]
        near = (x[:, None] ^ flips[s])[valid]
        where.append(np.nonzero(valid)[0])
        keys.append(near.astype(np.int64) | (half << 32))
    return np.concatenate(where), np.concatenate(keys)


class Forest:
    """Union by the smaller index."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y

    def roots(self) -> np.ndarray:
        while True:
            again = self.up[self.up]
            if (again == self.up).all():
                return again
            self.up = again


def spanning(fp: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """Index pairs of a spanning forest of the links among distinct fingerprints, rows of numbers of 64 bits.

    One breadth-first sweep: a member taken off the front is compared with all that no tree has yet, and those it
    links to leave the rest. A cluster of near copies thus costs few comparisons; memory is linear in the members. Members
    that do not link are compared each with each: that time is quadratic in them.
    """
    left, edges = np.arange(len(fp)), []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(fp[left] ^ fp[x]).sum(axis=1, dtype=np.int64) <= threshold
            if near.any():
                hit = left[near]
                edges += [(int(x), int(y)) for y in hit]
                front += hit.tolist()
                left = left[~near]
    return edges


def _replicated(distinct: DataFrame, n: int) -> DataFrame:
    """anchor, node, f0, ...: every fingerprint at its anchors, those of each run of 32 bits apart."""
    words = [f"f{i}" for i in range(n)]

    def replicate(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp, own = [batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(n)], batch.column(0).to_numpy(zero_copy_only=False)
        where, keys = zip(*(anchors(f.view(np.uint64)) for f in fp), strict=True)
        keys, where = np.concatenate([k + (i << 33) for i, k in enumerate(keys)]), np.concatenate(where)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[where]), *(pa.array(f[where]) for f in fp)], names=["anchor", "node", *words])

    return arrow_map(distinct.select("node", *words), replicate, "anchor bigint, node bigint, " + ", ".join(f"{w} bigint" for w in words))


def links(distinct: DataFrame, n: int = 1, threshold: int = THRESHOLD) -> DataFrame:
    """a, b: edges between nodes whose connected components are those of all links found at the anchors. distinct has node and f0, ..., each fingerprint once."""
    words, block, sampled = [f"f{i}" for i in range(n)], BLOCK, SAMPLED

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: np.ndarray | None = None  # of the group that may go on in the next batch
        tail: list[tuple[np.ndarray, np.ndarray]] = []

        def out(groups: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            edges = [(nodes[x], nodes[y]) for nodes, fps in groups if len(nodes) > 1 for x, y in spanning(fps, threshold)]
            if edges:
                ab = np.array(edges, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0].copy()), pa.array(ab[:, 1].copy())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, part, nodes = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fps = np.stack([batch.column(3 + i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(n)], axis=1)
            same = (anchor[1:] == anchor[:-1]) & (part[1:] == part[:-1])
            starts = np.concatenate([[0], np.nonzero(~same)[0] + 1, [batch.num_rows]])
            sizes = np.diff(starts)
            if keys is not None and (keys[0], keys[1]) != (anchor[0], part[0]):
                yield from out([(np.concatenate([x for x, _ in tail]), np.concatenate([y for _, y in tail]))])
                tail = []
            if len(sizes) > 1:
                first = slice(0, starts[1])
                tail.append((nodes[first], fps[first]))
                yield from out([(np.concatenate([x for x, _ in tail]), np.concatenate([y for _, y in tail]))])
                tail = []
                inner = np.nonzero(sizes[:-1] == 2)[0]
                at = starts[inner[inner > 0]]  # groups of two need no forest
                near = np.bitwise_count(fps[at] ^ fps[at + 1]).sum(axis=1, dtype=np.int64) <= threshold
                if near.any():
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[at][near]), pa.array(nodes[at + 1][near])], names=["a", "b"])
                more = np.nonzero(sizes[:-1] > 2)[0]
                yield from out([(nodes[starts[i] : starts[i + 1]], fps[starts[i] : starts[i + 1]]) for i in more[more > 0].tolist()])
            last = slice(starts[-2], starts[-1])
            tail.append((nodes[last].copy(), fps[last].copy()))
            keys = np.array([anchor[-1], part[-1]])
        if tail:
            yield from out([(np.concatenate([x for x, _ in tail]), np.concatenate([y for _, y in tail]))])

    placed = _replicated(distinct, n)
    some = distinct.where(F.pmod(F.xxhash64(F.lit(5), *words), F.lit(sampled)) == 0)
    crowded = written(_replicated(some, n).groupBy("anchor").agg((F.count("*") * sampled).alias("members")).where(F.col("members") > block), "crowded")
    if crowded.isEmpty():
        placed = placed.withColumn("part", F.lit(0).cast("bigint"))
        forget(crowded)
    else:  # a member of block i goes to the pairs of blocks (i, 0), (i, 1), ..., so that any two members meet
        blocks = crowded.select("anchor", F.ceil(F.col("members") / block).cast("bigint").alias("blocks"))
        placed = placed.join(blocks, "anchor", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        placed = placed.withColumn("mine", F.pmod(F.xxhash64(F.lit(6), *words), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        placed = placed.withColumn("part", F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other"))
    placed = placed.select("anchor", "part", "node", *words).repartition("anchor", "part").sortWithinPartitions("anchor", "part", "node")
    return placed.mapInArrow(compare, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: for every node of a or b, the smallest node of its component, both columns of type long.

    Rounds of the alternating scheme of large stars and small stars: each hooks the larger neighbours, then the smaller
    ones, of every node to the smallest of them. Neighbourhoods are never collected: the smallest neighbour is an
    aggregate, joined back to the edges, so a node with very many edges costs one row more per edge. It ends when a round
    changes nothing, after a number of rounds of the order of the logarithm of the nodes.
    """

    def large(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()

    def small(e: DataFrame) -> DataFrame:
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        hooked = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return hooked.union(least.select("a", F.col("m").alias("b"))).distinct()

    sums = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = now.agg(*sums).first()
    while state[0]:
        then = written(small(large(now)), "edges")
        after = then.agg(*sums).first()
        forget(now)
        now = then
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _labelled(rows: DataFrame, n: int = 1, threshold: int = THRESHOLD) -> DataFrame:
    """The rows (f0, ..., doc_id, maybe more) with the root of their component and component_id."""
    words = [f"f{i}" for i in range(n)]
    counted = rows.groupBy(*words).agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    distinct = written(counted.withColumn("node", F.monotonically_increasing_id()), "distinct")  # numbers that stay, as they are written
    roots = components(links(distinct, n, threshold))
    classes = distinct.join(roots, "node", "left").select(*words, "rows", "least", F.coalesce("root", "node").alias("root"))
    best = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = classes.join(best, "root").select(*words, "rows", "root", "component_id")
    hot = distinct.where(F.col("rows") > HOT)
    if hot.isEmpty():
        return rows.join(classes.drop("rows"), words)
    few = F.broadcast(classes.where(F.col("rows") > HOT).drop("rows"))
    rest = rows.join(F.broadcast(hot.select(*words)), words, "left_anti").join(classes.where(F.col("rows") <= HOT).drop("rows"), words)
    return rest.unionByName(rows.join(few, words))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    component_id is the smallest doc_id reachable over links, its own included. Rows of one fingerprint are one class,
    so copies, null, empty and blank texts among them, are never paired. Repeated doc_ids are rows of their own. Rows
    whose doc_id is null get the component's smallest id, null if it has none. An empty table gives an empty one. Whole texts count,
    however long: votes are summed by runs of shingles. Columns but doc_id and text are not read.
    """
    rows = written(fingerprints(documents), "fingerprints")
    return _labelled(rows).select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def bits_apart(similarity: float) -> int:
    """The bits of WIDE in which two texts of a size and that Jaccard similarity differ, on average."""
    return round(WIDE * math.acos(2 * similarity / (1 + similarity)) / math.pi)


def _first(size: np.ndarray | int, similarity: float) -> np.ndarray | int:
    """How many of a set's shingles, the first in any common order, hold one of every set of that similarity."""
    return size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1


def _parities(h: np.ndarray) -> bytes:
    """Of how many shingles fall in each of PARITIES buckets, or as many more as there are shingles, whether it is odd."""
    n = max(PARITIES, 1 << (len(h) - 1).bit_length())
    return np.packbits(np.bincount((h >> np.uint64(20)).astype(np.int64) & (n - 1), minlength=n) & 1 > 0).tobytes()


def _folded(parities: bytes, n: int) -> np.ndarray:
    """Parities of n buckets, a power of 2 and no more than there are, as numbers of 64."""
    return np.bitwise_xor.reduce(np.frombuffer(parities, np.uint64).reshape(-1, n // 64), axis=0)


def _differing(x: bytes, y: bytes) -> int:
    """How many parities differ, of as many as both have."""
    n = 8 * min(len(x), len(y))
    return int(np.bitwise_count(_folded(x, n) ^ _folded(y, n)).sum(dtype=np.int64))


def _excluded(differing: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Where differing parities show that sets are less similar: each takes a shingle that only one has."""
    return differing > sizes * ((1 - similarity) / (1 + similarity)) + 1e-6


def _frequent(documents: DataFrame, key: Column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending hashes of shingles that many texts have, and their counts, from some of the rows."""

    def every(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = [shingle_set(t, width) for t in texts(batch.column(0))]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *hashes]).view(np.int64))], names=["h"])

    some = documents.where(F.pmod(key, F.lit(FREQUENT)) == 0).select(F.col("text").cast("string").alias("text"))
    counted = written(arrow_map(some, every, "h bigint").groupBy("h").agg(F.count("*").alias("n")).where("n >= 4"), "frequent")
    rows = np.array([(r["h"], r["n"]) for r in frequent(counted, "n", MOST).collect()], np.int64).reshape(-1, 2)
    forget(counted)
    hashes = rows[:, 0].copy().view(np.uint64)
    order = hashes.argsort()
    return hashes[order], rows[order, 1]


def _sketches(documents: DataFrame, key: Column, width: int, similarity: float) -> DataFrame:
    """Of every row doc_id, row, its wide fingerprint, and of its set of shingles node (a digest of 64 bits, which stands for the set), size, parities and the first shingles."""
    hot, counts = _frequent(documents, key, width)
    n = WIDE // 64

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        from xxhash import xxh3_64_intdigest

        fps, nodes, sizes, parities, firsts = [], [], [], [], []
        for t in texts(batch.column(2)):
            h = shingle_set(t, width)
            fps.append(wide_fingerprint(t, width))
            nodes.append(xxh3_64_intdigest(h.tobytes(), 42))
            sizes.append(len(h))
            parities.append(_parities(h))
            if len(h):
                often = np.zeros(len(h), np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
                    often = np.where(hot[at] == h, counts[at], 0)
                h = h[np.lexsort((h, often))[: int(_first(np.int64(len(h)), similarity))]]
            firsts.append(h.tobytes())
        fp = np.array(fps, np.uint64).reshape(-1, n).view(np.int64)
        more = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(parities, pa.binary()), pa.array(firsts, pa.binary())]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(fp[:, i]) for i in range(n)), *more], names=["doc_id", "row", *(f"f{i}" for i in range(n)), "node", "size", "parities", "first"])

    d = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("row"), F.col("text").cast("string").alias("text"))
    return arrow_map(d, one, "doc_id bigint, row bigint, " + ", ".join(f"f{i} bigint" for i in range(n)) + ", node bigint, size bigint, parities binary, first binary")


def _meetings(nodes: DataFrame, similarity: float) -> DataFrame:
    """a, b: pairs of nodes of different classes (node, root, size, parities, first) that share one of their first shingles and may be that similar."""
    least = 1e-9

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        first = batch.column(4).to_pylist()
        many = np.array([len(x) // 8 for x in first], np.int64)
        fold = np.array([_folded(x, FOLDED) for x in batch.column(3).to_pylist()], np.uint64).reshape(-1, FOLDED // 64).view(np.int64)
        own = [np.repeat(c, many) for c in (batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), fold[:, 0], fold[:, 1])]
        return pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(first), np.int64)), *map(pa.array, own)], names=["h", "node", "root", "size", "p0", "p1"])

    def pairs(c: list[np.ndarray], i: np.ndarray, k: np.ndarray) -> np.ndarray:
        h, node, root, size, p0, p1 = c
        ok = (h[i] == h[k]) & (root[i] != root[k]) & (size[i] >= similarity * size[k] - least)
        i, k = i[ok], k[ok]
        differing = np.bitwise_count((p0[i] ^ p0[k]).view(np.uint64)).astype(np.int64) + np.bitwise_count((p1[i] ^ p1[k]).view(np.uint64))
        ok = ~_excluded(differing, size[i] + size[k], similarity)
        return np.stack([node[i[ok]], node[k[ok]]], axis=1)

    def meet(c: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Whole groups of one shingle each, by ascending size."""
        starts = np.concatenate([[0], np.nonzero(c[0][1:] != c[0][:-1])[0] + 1, [len(c[0])]])
        sizes, found = np.diff(starts), []
        small = np.repeat(sizes <= 64, sizes)
        own = np.nonzero(small & np.repeat(sizes > 1, sizes))[0]
        for d in range(1, int(sizes[sizes <= 64].max(initial=1))):
            own = own[own + d < len(c[0])]
            own = own[c[0][own] == c[0][own + d]]
            found.append(pairs(c, own, own + d))
        for g in np.nonzero(sizes > 64)[0].tolist():
            a, b = starts[g], starts[g + 1]
            if (c[2][a:b] == c[2][a]).all():
                continue
            for i in range(a, b - 1):
                end = a + np.searchsorted(c[3][a:b], c[3][i] / similarity + least, "right")
                k = np.arange(i + 1, end)
                found.append(pairs(c, np.full(len(k), i), k))
                if sum(map(len, found)) > 100_000:
                    yield from out(found)
                    found = []
        yield from out(found)

    def out(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if sum(map(len, found)):
            ab = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0].copy()), pa.array(ab[:, 1].copy())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            c = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
            if tail and tail[0][0][0] != c[0][0]:
                yield from meet([np.concatenate(x) for x in zip(*tail, strict=True)])
                tail = []
            last = int(np.searchsorted(c[0], c[0][-1]))
            if last:
                yield from meet([np.concatenate(x) for x in zip(*tail, [x[:last] for x in c], strict=True)])
                tail = []
            tail.append([x[last:].copy() for x in c])
        if tail:
            yield from meet([np.concatenate(x) for x in zip(*tail, strict=True)])

    placed = arrow_map(nodes.select("node", "root", "size", "parities", "first"), spread, "h bigint, node bigint, root bigint, size bigint, p0 bigint, p1 bigint")
    met = placed.repartition("h").sortWithinPartitions("h", "size", "node").mapInArrow(run, "a bigint, b bigint").distinct()

    def bound(batch: pa.RecordBatch) -> pa.RecordBatch:
        differing = np.array([_differing(x, y) for x, y in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True)], np.int64)
        gone = _excluded(differing, batch.column(2).to_numpy() + batch.column(4).to_numpy(), similarity)
        return batch.select(["a", "b"]).filter(pa.array(~gone))

    sides = [nodes.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("parities").alias(f"parities_{c}")) for c in "ab"]
    met = met.join(sides[0], "a").join(sides[1], "b").select("a", "b", "size_a", "parities_a", "size_b", "parities_b")
    return arrow_map(met, bound, "a bigint, b bigint")


def _marked(rows: DataFrame, row: str, used: DataFrame, of: str) -> DataFrame:
    """The rows whose hash may be one of used: all that are, and few others while those are fewer than MARKS. What is broadcast is bounded by MARKS."""
    word, marks = fresh(rows, "_word", "_marks")
    spot = lambda c: F.pmod(F.col(f"`{c}`"), F.lit(MARKS))
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"), (spot(c) % 64).cast("int"))
    bits = used.groupBy(F.floor(spot(of) / 64).alias(word)).agg(F.bit_or(bit(of)).alias(marks))
    return rows.withColumn(word, F.floor(spot(row) / 64)).join(F.broadcast(bits), word).where(F.col(marks).bitwiseAND(bit(row)) != 0).drop(word, marks)


def _similar(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, key: Column, width: int, similarity: float) -> DataFrame:
    """Of pairs of nodes (a, b) those whose sets of shingles are that similar, from the texts of the nodes' rows (m)."""
    row, node, doc, of = fresh(documents, "_row", "_node", "_doc", "_of")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t, width).tobytes() for t in texts(batch.column(1))], pa.binary())], names=["node", "hashes"])

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(x) + len(y) - len(np.union1d(x, y))
            ok.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
        return batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    used = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    used = nodes.join(used, "node").select(F.col("node").alias(node), F.col("m.doc_id").alias(doc), F.col("m.row").alias(of))
    keyed = _marked(documents.withColumn(row, key), row, used, of)
    found = keyed.join(used, keyed["doc_id"].cast("bigint").eqNullSafe(used[doc]) & (keyed[row] == used[of])).select(F.col(node).alias("node"), F.col("text").cast("string").alias("text"))
    made = written(arrow_map(found, sets, "node bigint, hashes binary").dropDuplicates(["node"]), "sets")
    sides = [made.select(F.col("node").alias(c), F.col("hashes").alias(f"hashes_{c}")) for c in "ab"]
    out = written(arrow_map(pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "hashes_a", "hashes_b"), check, "a bigint, b bigint"), "similar")
    forget(made)
    return out


def _classes(documents: DataFrame, key: Column, width: int, similarity: float) -> DataFrame:
    """root, m (none, doc_id, row: the least row), copies (of that row), for every different set of shingles: root is the same for all sets that links of the similarity lead to."""
    words = [f"f{i}" for i in range(WIDE // 64)]
    rows = written(_sketches(documents, key, width, similarity), "sketches")
    mine = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    best = rows.groupBy("node", mine.alias("m")).agg(F.count("*").alias("copies")).groupBy("node").agg(F.min(F.struct("m", "copies")).alias("b")).select("node", "b.m", "b.copies")
    kept = rows.groupBy("node").agg(*[F.first(c).alias(c) for c in (*words, "size", "parities", "first")])
    nodes = written(best.join(kept, "node"), "nodes")
    forget(rows)

    distinct = written(nodes.groupBy(*words).agg(F.min("node").alias("node")), "distinct")
    roots = components(links(distinct, len(words), bits_apart(similarity)))
    centre = distinct.join(roots, "node", "left").select(*words, F.coalesce("root", "node").alias("b"))
    stars = written(nodes.join(centre, words).select(F.col("node").alias("a"), "b").where("a <> b"), "stars")
    near = components(_similar(stars, nodes, documents, key, width, similarity))
    joined = written(nodes.join(near, "node", "left").withColumn("root", F.coalesce("root", "node")), "joined")
    met = written(_meetings(joined, similarity), "met")
    more = _similar(met, nodes, documents, key, width, similarity)
    last = components(more.union(near.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    return nodes.join(last, "node", "left").select(F.coalesce("root", "node").alias("root"), "m", "copies")


def keep_one(documents: DataFrame, width: int | None = None, similarity: float = 0.8) -> DataFrame:
    """Of each component, one row of documents with all its columns, whatever their names: the smallest id (nulls last), then the least hash of the row.

    Components are those of near_duplicates; or, with a width, of all pairs of texts whose sets of shingles of so many words (of a shorter text, the
    whole), as hashes of 64 bits, have at least that Jaccard similarity. Which rows stay is decided on ids, texts and hashes alone. Rows equal in
    id and hash are copies of each other. Null, empty and blank texts are one component. An empty table gives an empty one.
    """
    key = F.xxhash64(*[F.col(f"`{c}`") for c in documents.columns])
    if width is None:
        rows = written(fingerprints(documents, key), "fingerprints")
        mine = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
        labelled = _labelled(rows).groupBy("root", mine.alias("m")).agg(F.count("*").alias("copies"))
    else:
        with swept(documents.sparkSession):
            labelled = _classes(documents, key, width, similarity)
    best = labelled.groupBy("root").agg(F.min(F.struct("m", "copies")).alias("b"))
    row, kept, kept_row, copies = fresh(documents, "_row", "_kept", "_kept_row", "copies")
    best = written(best.select(F.col("b.m.doc_id").alias(kept), F.col("b.m.row").alias(kept_row), F.col("b.copies").alias(copies)), "kept")
    if width is None:
        forget(rows)
    keyed = documents.withColumn(row, key)
    same = keyed["doc_id"].eqNullSafe(best[kept]) & (keyed[row] == best[kept_row])
    out = keyed.join(best.where(F.col(copies) == 1), same, "left_semi").drop(row)
    again = best.where(F.col(copies) > 1)
    if not again.isEmpty():  # exact copies of rows, ids and all: only they are grouped
        out = out.unionByName(keyed.join(again, same, "left_semi").dropDuplicates(["doc_id", row]).drop(row))
    return out
