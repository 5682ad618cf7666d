"""Exact top-k by inner product, pruned by multi-resolution segment statistics.

A vector is cut into segments; of each its mean and its deviation (the norm of
what is left without the mean) are known.  With L components in a segment,

    <q, x>  <=  sum over segments of  L * mean(q) * mean(x) + dev(q) * dev(x)

(Cauchy-Schwarz; with |q| and |x| it is a lower bound of the distance).  Finer
segments bound closer.  Queries meet all rows in blocks: a block of queries is
broadcast, each task keeps the k best so far for each of them, bounds its rows at 4 and
then at 16 segments, and computes exact products only for the pairs that could still
enter.  What tasks have kept, k rows a query each, is merged by a ranking and
written before the next block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.session import scratch_dir

#: Queries in a block: with d components a broadcast of at most 8 * (d + 1) * QUERIES bytes.
QUERIES = 8192
#: Segments, coarse to fine.
SEGMENTS = (4, 16)
#: Rows and queries whose bounds are held at once.
ROWS, ROUND = 2048, 512
#: Pairs whose components are held at once.
PAIRS = 1 << 15


def segment_bounds(vectors: np.ndarray, segments: int) -> np.ndarray:
    """A row for each vector, such that the inner product of two rows bounds
    the inner product of the two vectors."""
    cuts = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    parts = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = vectors[:, a:b]
        mean = part.mean(axis=1)
        parts += [mean * np.sqrt(b - a), np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(parts, axis=1)


def products(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of rows x of a with rows y of b (float64 arrays of
    integers): all at once if most are asked for, else pair by pair."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53 and 16 * len(x) > len(a) * len(b):
        return (a @ b.T)[x, y].astype(np.int64)  # sums of integers under 2**53 are exact in any order
    if most >= 2**53:
        kind = np.int64 if most < 2**63 else object
        a, b = (np.array([[int(v) for v in row] for row in m], dtype=kind).reshape(m.shape) for m in (a, b))
    found = [(a[x[i : i + PAIRS]] * b[y[i : i + PAIRS]]).sum(axis=1) for i in range(0, len(x), PAIRS)]
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)


class _Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.bounds = [segment_bounds(vectors, s) for s in SEGMENTS]
        self.query = np.empty(0, np.int64)  # row in ids
        self.row, self.score = np.empty(0, np.int64), np.empty(0, np.int64)
        self.least = np.full(len(ids), -np.inf)  # score to reach: the k-th so far

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        bounds = [segment_bounds(vectors, s) for s in SEGMENTS]
        found = [(self.query, self.row, self.score)]
        for at in range(0, len(self.ids), ROUND):
            part = slice(at, at + ROUND)
            least = self.least[part, None]
            slack = 1e-9 * np.linalg.norm(self.vectors[part], axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :]
            near = self.bounds[0][part] @ bounds[0].T + slack >= least
            for mine, theirs in zip(self.bounds[1:], bounds[1:]):
                some = np.flatnonzero(near.any(axis=0))  # rows that the coarser bound leaves to a query
                near[:, some] &= mine[part] @ theirs[some].T + slack[:, some] >= least
            near &= self.ids[part, None] != ids[None, :]
            q, x = np.nonzero(near)
            found.append((at + q, ids[x], products(self.vectors[part], vectors, q, x)))
        query, row, score = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((row, -score, query))
        query, row, score = query[order], row[order], score[order]
        starts = np.searchsorted(query, np.arange(len(self.ids)))
        rank = np.arange(len(query)) - starts[query]
        keep = rank < self.k
        self.query, self.row, self.score = query[keep], row[keep], score[keep]
        full = rank == self.k - 1
        self.least[query[full]] = score[full].astype(float)

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame({"query_id": self.ids[self.query], "vec_id": self.row, "score": self.score})


def _whole(row_ids: pd.Series, vectors: pd.Series, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors by dimension."""
    by_dim: dict[int, tuple[list, list]] = {}
    for key, vector in zip(row_ids, vectors):
        ids, stack = by_dim.setdefault(len(vector), ([], []))
        ids.append(key)
        stack.append(np.floor(np.asarray(vector, np.float64) * scale))
    for ids, stack in by_dim.values():
        yield np.array(ids, np.int64), np.stack(stack)


def _search(rows: DataFrame, held: Broadcast, k: int, scale: float) -> DataFrame:
    """The k best of each partition of `rows` for the broadcast queries."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = {q.shape[1]: _Best(ids, q, k) for ids, q in held.value}
        for batch in batches:
            for ids, vectors in _whole(batch["id"], batch["vec"], scale):
                if vectors.shape[1] in best:
                    for at in range(0, len(ids), ROWS):
                        best[vectors.shape[1]].add(ids[at : at + ROWS], vectors[at : at + ROWS])
        for x in best.values():
            yield x.rows()

    return rows.mapInPandas(search, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows of largest inner product for each query: one row (query_id,
    rank from 1, vec_id, score) each, all other rows if there are fewer than k.

    Components are floor(scale * x) with x as double; queries are the rows
    whose id is divisible by `every`, candidates all rows of another id and
    the same dimension; ties go to the smaller id.  Rows with a null id or a
    vector that is null, empty or holds null or non-finite components take no
    part.  Of rows that repeat a query's id one is the query; rows that repeat
    a candidate's id are candidates each.  Scores must fit 64 bits.  Extra
    columns are ignored; an empty table gives no rows.
    """
    whole = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))) & ~F.isnan(x.cast("double")))
    rows = vectors.where(F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & whole)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    queries = rows.where(F.col("id") % every == 0).dropDuplicates(["id"])
    blocks = max(1, -(-queries.count() // (QUERIES // 2)))  # blocks by hash: half full on average, so none runs over
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    spark = vectors.sparkSession
    path = scratch_dir(spark, "top_k")
    for i in range(blocks):  # one block of queries is held at a time
        block = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).toPandas()
        held = spark.sparkContext.broadcast(list(_whole(block["id"], block["vec"], scale)))
        best = _search(rows, held, k, scale).withColumn("rank", rank).where(F.col("rank") <= k)
        best.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        held.destroy()
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(path)
