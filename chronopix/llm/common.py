"""What the training-data operators share: word rules, splits by document, written tables, Arrow helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but space and the ASCII white space from tab to carriage return.
#: ``bytes.split()`` without an argument splits on exactly the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; an id that is null counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares for intermediate tables: spark.checkpoint.dir. Only a local master, whose executors all see one disk, may leave it unset."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return where or os.path.join(tempfile.gettempdir(), "chronopix-shared")


#: Open scopes, innermost last: the tables that each has to delete.
_SCOPES: list[list[DataFrame]] = []


def _file_system(df: DataFrame) -> tuple[Any, Any]:
    p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._chronopix_path)
    return p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()), p


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df from a Parquet table in the shared folder: computed once, lineage cut, safe against lost executors.

    The table goes with ``forget``, at the end of the scope it was made in, or when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/chronopix/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._chronopix_path = path
    files, p = _file_system(back)
    files.deleteOnExit(p)
    if _SCOPES:
        _SCOPES[-1].append(back)
    return back


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of each query go when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def forget(df: DataFrame) -> None:
    """Deletes the table behind ``written(...)``; only for one that no plan still to run reads."""
    if getattr(df, "_chronopix_path", None):
        files, p = _file_system(df)
        files.delete(p, True)
        files.cancelDeleteOnExit(p)


@contextmanager
def scope() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end the tables written inside it, but those that were given to the function it yields."""
    made: list[DataFrame] = []
    _SCOPES.append(made)

    def keep(df: DataFrame) -> DataFrame:
        made[:] = [t for t in made if t is not df]
        return df

    try:
        yield keep
    finally:
        _SCOPES.remove(made)
        for t in made:
            forget(t)


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, each with as many underscores as make it unlike every column of df, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return tuple(out)


def frequent(df: DataFrame, n: str, limit: int) -> DataFrame:
    """The rows of the highest n, ``limit`` at most: those from the least power of 2 ** (1 / 8) on that leaves no more. No sort, no single task."""
    step = F.floor(F.log2(F.col(n)) * 8)
    least = 1 << 20
    for s, rows in sorted(df.where(F.col(n) > 0).groupBy(step).count().collect(), reverse=True):
        if rows > limit:
            break
        limit, least = limit - rows, s
    return df.where((F.col(n) > 0) & (step >= least))


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of every text, b'' for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def arrow_map(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow by batches that need nothing of each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = f(b)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns alone, name=type, cast to that type; extra columns, whatever they are called, go."""
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])
