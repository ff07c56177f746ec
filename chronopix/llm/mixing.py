"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

Each source's weight is a schedule over training progress t in [0, 1]: mean * (1 + tilt * (1 - 2 t)), which falls for a
positive tilt and rises for a negative one and has the mean as its integral. Integrals become targets in words,
no target above ``most`` times its source; what is above is shared out again by weight. A source's documents are taken in
an order by digest, whole passes first, then up to the target, where the last document taken is cut. The words that a
source has given before a document are that document's cumulative demand; inverting the schedule's integral there
gives t. As schedules of several sources need not add up to the same at every t, t becomes the share of all tokens that
all sources have given by then: that is the training position of the document, and positions range-sort the result. A document
taken in several passes has a position in each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronopix.llm.common import WORD, only, written

#: Mean weights, and tilts, of the sources in code point order, repeating.
WEIGHTS, TILTS = (3.0, 1.0, 2.0), (0.5, 0.0, -0.5)
#: Rows of one source and digest prefix, on average, at most.
GROUP = 5_000
#: Rows equal in source, id and size are one until they have their places; this many at once become rows again.
COPIES = 65_536


def progress(share: Column, tilt: Column) -> Column:
    """t at which a schedule of that tilt has given ``share`` of its demand: the inverse of t + tilt * (t - t * t)."""
    a = F.lit(1.0) + tilt
    return F.when(tilt == 0, share).otherwise((a - F.sqrt(F.greatest(a * a - F.lit(4.0) * tilt * share, F.lit(0.0)))) / F.when(tilt != 0, F.lit(2.0) * tilt))


def _of(values: tuple[float, ...], i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (i % len(values)).cast("int") + 1)


def targets(sizes: DataFrame, share: float, most: float, weights: tuple[float, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS) -> DataFrame:
    """source, source_size -> source, source_size, tilt, target, lean: one row a source, so one task holds them all. lean: the tilt of all sources together, by target.

    With sources in order of most * size / weight, those before some place stop at most * size and the others share what
    is left by weight; that place is the first where the level, left over weight left, is under the source's own ratio.
    """
    i = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = sizes.select("source", "source_size", _of(weights, i).alias("weight"), _of(tilts, i).alias("tilt"))
    up = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    before = F.coalesce(F.sum("source_size").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double")
    s = s.select("*", (F.lit(share) * total - F.lit(most) * before).alias("left"), F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)).alias("weights"))
    free = F.col("left") * F.col("weight") < F.lit(most) * F.col("source_size") * F.col("weights")
    first = F.min(F.when(free, F.struct((F.col("source_size") / F.col("weight")).alias("ratio"), F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none"), "left", "weights"))).over(Window.partitionBy())
    s = s.select("*", free.alias("free"), first.alias("first"))
    shared = F.col("weight") * F.col("first.left") / F.col("first.weights")
    s = s.select("source", "source_size", "tilt", F.when(F.col("free"), shared).otherwise(F.lit(most) * F.col("source_size")).alias("target"))
    every = Window.partitionBy()
    return s.withColumn("lean", F.coalesce(F.sum(F.col("target") * F.col("tilt")).over(every) / F.nullif(F.sum("target").over(every), F.lit(0.0)), F.lit(0.0)))


def curriculum(documents: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, position, positions of every row, sorted by position.

    size: words of the whole text, however long, 0 for null and empty ones, which are taken with 0 words. A position is a share
    of all tokens, in [0, 1]. position: of the first word taken, null where none is. positions: of the first word taken in each
    pass over the source, empty where none is. A null source is one source, the last. Order within a source: md5 of the id as
    text, id, size; rows equal in these are copies of each other to the mix. Reruns agree. An empty table gives an empty one;
    columns but doc_id, text and source are not read.
    Work per task is bounded: running sums are over distinct rows of a digest prefix of a source, and a prefix's start is a running
    sum over the prefixes' totals. One task handles one row per source, to set the targets.
    """
    d = only(documents, doc_id="bigint", text="string", source="string")
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = written(d.select("doc_id", "source", words.alias("size"), digest.alias("digest")), "sizes")
    n = rows.count()
    digits = max(1, math.ceil(math.log(max(n, 1) / GROUP, 16))) if n > GROUP else 1
    rows = rows.withColumn("prefix", F.substring("digest", 1, digits))

    groups = rows.groupBy("source", "prefix").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select(F.col("source").alias("s"), F.col("prefix").alias("p"), F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("start"))
    goals = targets(groups.groupBy("source").agg(F.sum("words").alias("source_size")), share, most, weights, tilts).withColumnRenamed("source", "s")
    starts = starts.alias("a").join(goals.alias("b"), F.col("a.s").eqNullSafe(F.col("b.s"))).select("a.s", "p", "start", "source_size", "tilt", "lean", "target")

    rows = rows.groupBy("source", "prefix", "digest", "doc_id", "size").agg(F.count("*").alias("copies"))
    own = Window.partitionBy("source", "prefix").orderBy("digest", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(own), F.lit(0)).alias("within"))
    rows = rows.join(starts, rows.source.eqNullSafe(starts.s) & (rows.prefix == starts.p))
    # Copies become rows again, in runs that are dealt out, so that no task makes more than a run of one group's at a time.
    run = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {COPIES}"))).alias("run")
    rows = rows.select("*", run).repartition("digest", "doc_id", "run")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.col("run") * COPIES, F.least(F.col("copies"), (F.col("run") + 1) * COPIES) - 1)))
    before, goal = F.col("start") + F.col("within") + F.col("copy") * F.col("size"), F.col("target")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rest = F.floor(goal).cast("bigint") - passes * F.col("source_size")
    taken = passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "tilt", "lean", before.alias("before"), taken.cast("bigint").alias("taken"), passes.alias("passes"))

    def at(word: Column) -> Column:
        t = progress(F.least(word / F.when(goal > 0, goal), F.lit(1.0)), F.col("tilt"))
        return F.round(t + F.col("lean") * (t - t * t), 6) + F.lit(0.0)  # never -0

    begins = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("passes")), lambda k: F.col("before") + k * F.col("source_size"))
    begins = F.when(F.col("taken") > 0, F.filter(begins, lambda word: word < F.floor(goal))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("position", F.when(F.col("taken") > 0, at(F.col("before")))).withColumn("positions", F.transform(begins, at))
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken", "position", "positions").orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mix(documents: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS) -> DataFrame:
    """The curriculum with its positions folded to their number, passes, beside the first, position, and the last, last_position."""
    plan = curriculum(documents, share, most, weights, tilts)
    return plan.select("doc_id", "source", "size", "source_size", "target", "taken", "position", F.size("positions").cast("bigint").alias("passes"), F.try_element_at("positions", F.lit(-1)).alias("last_position"))


def schedule(plan: DataFrame) -> DataFrame:
    """doc_id, source, pass (from 0), words, position: a row for each document and pass of a curriculum, sorted by position."""
    left = F.col("taken") - F.col("pass") * F.col("size")  # whole passes come first
    rows = plan.select("doc_id", "source", "size", "taken", F.posexplode("positions").alias("pass", "position"))
    return rows.select("doc_id", "source", "pass", F.least("size", left).alias("words"), "position").orderBy("position", "doc_id", "pass")


def sql(table: str = "documents", share: float = 1.5, most: float = 2.0) -> str:
    """The mix's query in DuckDB's SQL, without prefixes: plain running sums."""
    return f"""WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM {table}),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CAST(row_number() OVER (ORDER BY source NULLS LAST) - 1 AS BIGINT) AS i FROM s0),
s2 AS (SELECT source, source_size, [3.0::DOUBLE, 1.0, 2.0][i % 3 + 1] AS weight, [0.5::DOUBLE, 0.0, -0.5][i % 3 + 1] AS tilt FROM s1),
s3 AS (SELECT *, row_number() OVER up AS nr,
    {share}::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) - {most}::DOUBLE * CAST(coalesce(sum(source_size) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS room,
    sum(weight) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM s2 WINDOW up AS (ORDER BY source_size / weight, source NULLS LAST)),
s4 AS (SELECT *, room * weight < {most}::DOUBLE * source_size * weights AS free FROM s3),
f AS (SELECT room AS r, weights AS w FROM s4 WHERE free ORDER BY nr LIMIT 1),
s5 AS (SELECT source, source_size, tilt, CASE WHEN free THEN weight * (SELECT r FROM f) / (SELECT w FROM f) ELSE {most}::DOUBLE * source_size END AS target FROM s4),
s AS (SELECT *, coalesce(sum(target * tilt) OVER () / nullif(sum(target) OVER (), 0), 0) AS lean FROM s5),
b AS (SELECT *, row_number() OVER () AS nr, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY digest, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM d),
j AS (SELECT nr, doc_id, size, source_size, target, tilt, lean, before, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes
  FROM b JOIN s ON b.source IS NOT DISTINCT FROM s.source),
t AS (SELECT *, passes * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - passes * source_size - before)) AS taken FROM j),
k AS (SELECT *, unnest(range(0, passes + 1)) AS k FROM t WHERE taken > 0),
u AS (SELECT nr, lean, tilt, least((before + k * source_size) / target, 1.0) AS share FROM k WHERE before + k * source_size < floor(target)),
w AS (SELECT nr, lean, CASE WHEN tilt = 0 THEN share ELSE ((1 + tilt) - sqrt(greatest((1 + tilt) * (1 + tilt) - 4.0::DOUBLE * tilt * share, 0))) / (2.0::DOUBLE * tilt) END AS v FROM u),
p AS (SELECT nr, count(*) AS passes, round(min(v + lean * (v - v * v)), 6) + 0.0 AS position, round(max(v + lean * (v - v * v)), 6) + 0.0 AS last_position FROM w GROUP BY nr)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken, position, CAST(coalesce(p.passes, 0) AS BIGINT) AS passes, last_position
FROM t LEFT JOIN p USING (nr)"""
