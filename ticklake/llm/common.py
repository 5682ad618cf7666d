"""Helpers shared by the operators: reading tables, writing intermediate
tables to the shared folder, and distributed connected components."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.session import scratch_dir

# White space of the word contracts: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows in a batch that Spark sends to a Python worker.
BATCH_ROWS = 2000

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, so
    that they need not have it on their path.  Also lowers Spark's batches for
    Python, 10,000 rows unless the session says otherwise, to BATCH_ROWS:
    documents are long rows, and a worker holds a batch several times."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == 10_000:
        spark.conf.set(key, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        tmp = tempfile.mkdtemp()  # the driver serves the archive from here while the application runs
        atexit.register(shutil.rmtree, tmp, ignore_errors=True)
        sources = os.path.join(tmp, "sources", os.path.basename(top))
        shutil.copytree(top, sources, ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tmp, "ticklake_package"), "zip", os.path.dirname(sources)))
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: it cuts the lineage,
    is computed once, and outlives any executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Work:
    """Intermediate tables of one run of an operator, removed at its end: the
    result must not read them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(scratch_dir(self.spark, name))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def end(self) -> None:
        while self.paths:
            dropped(self.spark, self.paths.pop())


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """`df`, with a broadcast hint if it is counted to hold at most `rows`
    rows; a larger side is left to the shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def sliced(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The batches in frames of at most `rows` rows, so that little of what is
    made of them is held at once."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


#: (module, cached function) of what a worker keeps from task to task.
_caches: list[tuple[str, Callable]] = []


def kept_by_operator(cached: Callable) -> Callable:
    """Marks an lru_cache whose values a worker keeps for further tasks of its
    module, until a task of another one (handing_back) comes."""
    _caches.append((cached.__module__, cached))
    return cached


def drop_kept(but: str) -> None:
    """Forget what operators other than the module `but` keep in this worker."""
    for module, cached in _caches:
        if module != but:
            cached.cache_clear()


def trim() -> None:
    """Give freed memory of Arrow and the C library back to the system."""
    pa.default_memory_pool().release_unused()
    if freed := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        freed(0)


def handing_back(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`task` (batches to batches) with memory that it no longer needs given back
    to the system: before it what other operators keep, Arrow's after each
    batch, at the end also what the C library keeps.  A worker lives on after its tasks, and all that it keeps counts as
    its executor's memory, also in stages without Python."""

    @wraps(task)
    def run(batches: Iterator) -> Iterator:
        drop_kept(task.__module__)
        release = pa.default_memory_pool().release_unused
        for done in task(batches):
            yield done
            del done
            release()
        trim()

    return run


def _starts(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    values = frame[keys].to_numpy()
    return np.flatnonzero(np.r_[True, (values[1:] != values[:-1]).any(axis=1)])


def whole_runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of a partition that is sorted by the keys, batch by batch, but
    with all rows of equal keys in one frame."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        if not len(batch):
            continue
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        last = _starts(batch, keys)[-1]  # its run may go on
        if last:
            yield batch.iloc[:last]
        rest = batch.iloc[last:]
    if rest is not None:
        yield rest


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The runs of rows with equal keys, each as one frame."""
    for frame in whole_runs(batches, keys):
        starts = _starts(frame, keys)
        for a, b in zip(starts, [*starts[1:], len(frame)]):
            yield frame.iloc[a:b]


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = staged) -> DataFrame:
    """Connected components of the edges (columns `a`, `b`, any orderable
    type): one row (node, component) per node that has an edge to another
    node; the component is its smallest node.

    Alternating large-star and small-star steps (Kiveris et al., 2014).  A
    step is a min per node, combined before the shuffle, and a join on the
    node, whose large partitions Spark can split: a hub costs no task more
    than its share.  Each round is a written table, so rounds don't chain.
    Null nodes and self-loops are ignored; an empty input gives no rows.
    `keep` writes the result (Work: until the caller ends).
    """
    a, b = F.col("a"), F.col("b")
    work = Work(edges.sparkSession)
    current = work(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    before = _fingerprint(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = work(large.where("u != v").distinct(), "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        current = work(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        after = _fingerprint(current)
        for path in work.paths[:-1]:  # rounds before
            dropped(work.spark, path)
        del work.paths[:-1]
        if after == before:
            break
        before = after
    stars = current.groupBy("u").agg(F.min("v").alias("component"))
    roots = current.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct()
    out = keep(stars.unionByName(roots).withColumnRenamed("u", "node"), "components")
    work.end()
    return out


def words(text: str | Column) -> Column:
    """Number of words of a text; null counts none."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")
