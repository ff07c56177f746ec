"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. The first pivots also part the index into cells: a vector lies
in the cell of the nearest of them, so cells grow in number, not in size, with the rows. Every cell posts its vectors in
inverted files, one per pivot: (vector, place of the pivot in its order). A query visits the cells of the first
pivots nearest to it; there it goes through the files of its own nearest pivots and adds up, per vector, the footrule
distance of the two orders, a pivot that is missing from one counting as if it came right after the last. The best by
footrule are reranked by exact cosine in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronopix.llm.common import only, written

#: Pivots at least and at most (four for each cell, in between), and how many, nearest first, represent a vector.
PIVOTS, MOST_PIVOTS, ORDERED = 512, 8_192, 64
#: Distinct vectors of a cell, on average. One of over four times as many is dealt out by hash to parts of about twice as many, which are all visited.
CELL = 2_048
#: Share of nearest neighbours that should lie in the cells a query visits, and the rows it is found out on: so many, so many of which are queries.
REACH, TUNE, TUNE_QUERIES = 0.97, 4_096, 512
#: Vectors of a cell, best by footrule, that are reranked.
RERANK = 384
#: Queries that meet a cell at once.
QUERIES = 2_048


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (array of doubles): rows that take part, which are those whose vector is not null, empty or zero, with finite components only."""
    v = only(embeddings, vec_id="bigint", embedding="array<double>").select("vec_id", F.col("embedding").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)  # so that no square overflows
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def order(unit: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The k nearest pivots of each row, nearest first; ties to the smaller pivot."""
    out = np.empty((len(unit), k), np.int16)
    for a in range(0, len(unit), 2_048):  # bounds the matrix of similarities
        far = -(unit[a : a + 2_048] @ pivots.T)
        near = np.sort(np.argpartition(far, k - 1, axis=1)[:, :k], axis=1)
        out[a : a + 2_048] = np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable"), 1)
    return out


def files(orders: np.ndarray, n_pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inverted files of a cell: where each pivot's begins, and of all files the vectors and the places."""
    flat = orders.ravel()
    by = np.argsort(flat, kind="stable")
    return np.searchsorted(flat[by], np.arange(n_pivots + 1)), by // orders.shape[1], (by % orders.shape[1]).astype(np.int32)


def footrule(queries: np.ndarray, orders: np.ndarray, n_pivots: int) -> Iterator[np.ndarray]:
    """For each query's order in turn, the footrule distance to every order of the cell, by way of the files of its own pivots."""
    n, k = orders.shape
    starts, rows, places = files(orders, n_pivots)
    # Two orders without a pivot in common are 2 * (k + ... + 1) apart. A shared pivot at places i and j adds |i - j|
    # in place of (k - i) + (k - j), which takes off 2 * (k - max(i, j)).
    for q in queries:
        first, sizes = starts[q], starts[q + 1] - starts[q]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(first - ends + sizes, sizes)  # the query's files, one after the other
        shared = np.bincount(rows[at], k - np.maximum(places[at], np.repeat(np.arange(len(q), dtype=np.int32), sizes)), n)
        yield k * (k + 1) - 2 * shared.astype(np.int64)


def _best(ids: list[np.ndarray], score: np.ndarray, most: int) -> list[tuple[int, float]]:
    """The ``most`` best vec_ids of candidates, each with the ids of its vector: by score, ties by id, each id once."""
    if len(score) > most:
        top = np.nonzero(score >= np.partition(score, len(score) - most)[len(score) - most])[0]
    else:
        top = np.arange(len(score))
    out: dict[int, float] = {}
    for s, i in sorted((-float(score[x]), int(i)) for x in top for i in ids[x]):
        if len(out) == most:
            break
        out.setdefault(i, -s)
    return list(out.items())


def _compare(left: pa.Table, right: pa.Table, pivots: np.ndarray, k: int, rerank: int | None, most: int) -> pa.Table:
    found: list[tuple] = []
    if len(left) and len(right):
        keys = list(zip(right["a"].to_pylist(), right["b"].to_pylist(), strict=True))
        ids, unit, queries = left["ids"].to_pylist(), _unit(_matrix(left["v"])), _unit(_matrix(right["v"]))
        by = sorted(range(len(ids)), key=lambda x: (ids[x][0], left["h"][x].as_py()))  # rows come in any order
        ids, unit = [ids[x] for x in by], unit[by]
        if rerank is None or rerank >= len(ids):
            candidates = (np.arange(len(ids)) for _ in keys)
        else:
            far = footrule(order(queries, pivots, k), order(unit, pivots, k), len(pivots))
            # By footrule, ties to the smaller id: the key holds both.
            candidates = (np.sort(np.argpartition(f.astype(np.int64) * len(ids) + np.arange(len(ids)), rerank - 1)[:rerank]) for f in far)
        for at, c in enumerate(candidates):
            score = (unit[c] * queries[at]).sum(axis=1)
            found += [(*keys[at], i, s) for i, s in _best([ids[x] for x in c], score, most)]
    a, b, v, s = zip(*found, strict=True) if found else ((), (), (), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})


def _near_cells(df: DataFrame, pivots: np.ndarray, probes: int) -> DataFrame:
    """df, whose column v has vectors, with the numbers of the nearest cells, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(b.schema.get_field_index("v"))
            near = order(_unit(_matrix(pa.chunked_array([v]))), pivots, probes) if len(v) else np.empty((0, probes), np.int16)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(near.astype(np.int32)), pa.list_(pa.int32()))], names=[*b.schema.names, "cells"])

    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", cells array<int>")


def probes_for(sample: np.ndarray, pivots: np.ndarray, nearest: int, reach: float = REACH) -> int:
    """The least number of cells, nearest first, that hold ``reach`` of the nearest neighbours, within a sample of unit vectors.

    Neighbours in the whole table are nearer than those in a sample, and nearer ones lie in nearer cells, so this errs on the side of more cells.
    Data in clusters need few cells at any size; without any structure, as of independent normal components, over half of all.
    """
    if len(sample) <= nearest or len(pivots) == 1:
        return len(pivots)
    asked, home = sample[:TUNE_QUERIES], np.argmax(sample @ pivots.T, axis=1)
    near = asked @ sample.T
    near[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    found = home[np.argpartition(-near, nearest - 1, axis=1)[:, :nearest]]
    place = np.argsort(np.argsort(-(asked @ pivots.T), axis=1, kind="stable"), axis=1)
    ranks = np.sort(place[np.arange(len(asked))[:, None], found].ravel())
    return int(ranks[min(len(ranks) - 1, math.ceil(reach * len(ranks)) - 1)]) + 1


def search(embeddings: DataFrame, queries: DataFrame, nearest: int = 5, probes: int | None = None, rerank: int = RERANK, exact: bool = False, n_pivots: int = PIVOTS, ordered: int = ORDERED) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each query its nearest found, by cosine, ties to the smaller vec_id.

    Every usable row is indexed; a query's own vec_id is no candidate for it. Rows with a null, empty or zero vector, a
    null or non-finite component, a null id, or another length than the most frequent one (ties: the shorter) take
    no part. A vec_id that several rows have is indexed with each of its distinct vectors, and the best counts. Equal vectors
    are one with the ``nearest`` + 1 least of their ids, which no query can tell from all. Columns but vec_id and embedding are not
    read; an empty table gives an empty one. Pivots: distinct vectors among the 2 * MOST_PIVOTS + TUNE rows, at most, of least hash;
    that sample is bounded whatever the table's size. probes, the cells that a query visits, is found out on that sample if it isn't given. probes
    and rerank trade time for recall; ``exact`` visits every cell and reranks every vector.
    """
    rows, asked = usable(embeddings), usable(queries)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    spark = embeddings.sparkSession
    if lengths is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows, asked = rows.where(F.size("v") == lengths["n"]), asked.where(F.size("v") == lengths["n"])
    cells = max(1, min(math.ceil(lengths["count"] / CELL), MOST_PIVOTS // 4))
    n_pivots = max(n_pivots, 4 * cells)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(2 * n_pivots + TUNE).collect()
    distinct = _unit(np.array(list(dict.fromkeys(tuple(r["v"]) for r in sample))))
    pivots = distinct[:n_pivots]
    cells, most, kept = min(cells, len(pivots)), nearest + 1, None if exact else rerank
    probes, k = cells if exact else min(probes or probes_for(distinct[cells:][-TUNE:], pivots[:cells], nearest), cells), min(ordered, len(pivots))

    # Equal vectors are one, with their least ids; a vector that very many rows have is thinned before the shuffle.
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    one = rows.groupBy("v", "vec_id").agg(F.lit(1).alias("one")).select("v", "vec_id", place.alias("place")).where(F.col("place") <= most)
    one = one.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select("v", "ids", F.xxhash64("v").alias("h"))
    index = written(_near_cells(one, pivots[:cells], 1).select("v", "ids", "h", F.col("cells")[0].alias("cell")), "index")
    # At most MOST_PIVOTS / 4 rows: the parts of each cell.
    sizes = [(r["cell"], r["count"]) for r in index.groupBy("cell").count().collect()]
    parts = F.broadcast(spark.createDataFrame([(c, math.ceil(n / (2 * CELL)) if n > 4 * CELL else 1) for c, n in sizes], "cell int, parts int"))
    index = index.join(parts, "cell").select("cell", F.pmod("h", "parts").cast("int").alias("part"), "v", "ids", "h")

    keyed = asked.select("vec_id", "v", F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b"))
    probing = _near_cells(keyed.groupBy("a", "b").agg(F.first("v").alias("v")), pivots[:cells], probes)
    probing = probing.select("a", "b", "v", F.explode("cells").alias("cell")).join(parts, "cell").select("a", "b", "v", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    # A cell meets so many queries at once; where more come, as to a crowded one, it meets them block by block.
    blocks = probing.groupBy("cell", "part").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
    index = index.join(blocks, ["cell", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    probing = probing.join(blocks, ["cell", "part"]).withColumn("block", F.pmod("a", "blocks").cast("int"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        return _compare(left, right, pivots, k, kept, most)

    group = ["cell", "part", "block"]
    found = index.select(*group, "v", "ids", "h").groupBy(*group).cogroup(probing.select(*group, "a", "b", "v").groupBy(*group)).applyInArrow(compare, "a bigint, b bigint, vec_id bigint, score double")
    found = found.groupBy("a", "b", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("a", "b").orderBy(F.desc("score"), "vec_id"))
    found = found.select("a", "b", "vec_id", "score", place.alias("place")).where(F.col("place") <= most)
    found = keyed.select(F.col("vec_id").alias("query_id"), "a", "b").join(found, ["a", "b"]).where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= nearest)
