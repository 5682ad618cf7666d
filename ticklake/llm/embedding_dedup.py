"""Near-duplicate embeddings by random-hyperplane sign hashing.

Each of TABLES tables has BITS random hyperplanes; the signs of a vector are its
key there, and two vectors at angle t share it with probability
(1 - t / pi) ** BITS.  Vectors of one label that share a key are compared exactly
in double precision, each pair in the first table where it meets only.

Equal vectors are one class with a count from the start.  A bucket of more than
BLOCK classes is cut into blocks and every pair of blocks is a cell of its own, so
no task holds more than two blocks of one bucket.  A cell returns a link count per class
and one edge to the smallest class of its local component, never its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import Work, broadcast_if_small, connected_components, runs, staged

#: At cosine 0.98 a pair shares no key with probability 5e-7.  More bits make
#: buckets smaller (for more vectors per label) and need more tables.
TABLES, BITS = 24, 12
#: Classes of a bucket that are compared in one piece.
BLOCK = 1024
#: Large buckets (20 bytes each) that may be broadcast.
BROADCAST_BUCKETS = 1_000_000


def hyperplanes(dim: int) -> np.ndarray:
    return np.random.default_rng([20240115, dim]).standard_normal((dim, TABLES * BITS))


def sign_keys(vectors: np.ndarray) -> np.ndarray:
    """The key of each row in each table (n x TABLES)."""
    signs = (vectors @ hyperplanes(vectors.shape[1]) > 0).reshape(len(vectors), TABLES, BITS)
    return (signs * (1 << np.arange(BITS))).sum(axis=2).astype("<i4")


def _signed(vectors: DataFrame) -> DataFrame:
    """id, and for rows that can link: label, vec (float64 bytes), node (128
    bits for label and vector) and keys (int32 bytes)."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = len(batch)
            out = pd.DataFrame({"id": batch["id"].astype("Int64"), "vec": [None] * n, "node": [None] * n, "keys": [None] * n})
            usable: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i, (key, label, vector) in enumerate(zip(batch["id"], batch["label"], batch["vec"])):
                if pd.isna(key) or pd.isna(label) or vector is None or not len(vector):
                    continue
                x = np.array([np.nan if c is None else c for c in vector], np.float64)
                if np.isfinite(x).all() and x.any():
                    usable.setdefault(len(x), []).append((i, x + 0.0))  # -0.0 is 0.0
            for rows in usable.values():
                at, stack = [i for i, _ in rows], np.stack([x for _, x in rows])
                keys = sign_keys(stack / np.abs(stack).max(axis=1, keepdims=True))
                for i, x, key in zip(at, stack, keys):
                    data = x.tobytes()
                    label = int(batch["label"].iat[i]).to_bytes(8, "big", signed=True)
                    out.at[i, "vec"], out.at[i, "keys"] = data, key.tobytes()
                    out.at[i, "node"] = hashlib.blake2b(label + data, digest_size=16).digest()
            out["label"] = batch["label"].astype("Int64")
            yield out[["id", "label", "vec", "node", "keys"]]

    return vectors.mapInPandas(sign, "id long, label long, vec binary, node binary, keys binary")


def _cell_links(cell: pd.DataFrame, threshold: float) -> pd.DataFrame | None:
    """Link count and smallest class of the local component, per class."""
    vectors = np.stack([np.frombuffer(x) for x in cell["vec"]])
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    linked = vectors @ vectors.T >= threshold
    np.fill_diagonal(linked, False)
    low, high, block = cell["low"].iat[0], cell["high"].iat[0], cell["block"].to_numpy()
    if low != high:
        linked &= block[:, None] != block[None, :]
    x, y = np.nonzero(linked)
    if not len(x):
        return None
    keys = np.stack([np.frombuffer(k, "<i4") for k in cell["keys"]])
    first = (keys[x] == keys[y]).argmax(axis=1) == cell["table"].iat[0]
    x, y = x[first], y[first]
    if not len(x):
        return None
    counts = np.bincount(x, cell["n"].to_numpy(float)[y], len(cell)).astype(np.int64)
    order = np.argsort(np.argsort(cell["node"].to_numpy()))
    low_to = order.copy()
    while True:  # the smallest class spreads along links
        before = low_to.copy()
        np.minimum.at(low_to, x, before[y])
        if (low_to == before).all():
            break
    nodes = cell["node"].to_numpy()[np.argsort(order)]
    some = np.unique(x)
    return pd.DataFrame({"node": cell["node"].to_numpy()[some], "links": counts[some], "to": nodes[low_to[some]]})


def _linked(cells: DataFrame, threshold: float) -> DataFrame:
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in runs(batches, ["cell", "low", "high"]):
            if len(cell) > 1 and (found := _cell_links(cell, threshold)) is not None:
                yield found

    return cells.mapInPandas(compare, "node binary, links long, to binary")


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row (id_col, n_links, component_id, kept) per row of `vectors`:
    rows of equal, not null label (and dimension) whose cosine is at least
    `threshold` are linked; n_links counts the other rows linked directly.

    Vectors that are null, empty or zero or hold null, infinite or NaN
    components, and rows without id or label, link with nothing (no links,
    their own component, kept; a null id has a null component).  Repeated
    rows link with each other; rows that repeat an id count as other rows.
    Extra columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vec"))
    work = Work(vectors.sparkSession)
    signed = work(_signed(rows), "vectors_signed")
    classes = signed.where("node is not null").groupBy("node").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec"), F.first("keys").alias("keys")
    )
    classes = work(classes, "vectors_classes")

    tables = F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1))).alias("table")
    keyed = classes.select("node", "n", "label", "vec", "keys", tables)
    key = F.xxhash64("label", F.octet_length("vec"), "table", F.substring("keys", F.col("table") * 4 + 1, F.lit(4)))
    keyed = keyed.withColumn("cell", key)
    large = keyed.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK)
    large = large.select("cell", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    keyed = keyed.join(broadcast_if_small(work(large, "vectors_large"), BROADCAST_BUCKETS), "cell", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    block = F.pmod(F.xxhash64("node", F.lit(7)), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    cells = keyed.withColumn("block", block).withColumn("other", other)
    cells = cells.select("cell", "table", "node", "n", "vec", "keys", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    cells = cells.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
    links = work(_linked(cells, threshold), "vectors_links")

    component = connected_components(links.select(F.col("node").alias("a"), F.col("to").alias("b")), work)
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.select("node", "rep", "n").join(counted, "node", "left").join(component, "node", "left")
    known = known.select("node", "rep", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "node").alias("component"))
    smallest = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = known.join(smallest, "component").select("node", "links", "component_id")
    out = signed.select("id", "node").join(known, "node", "left")
    reached = F.coalesce("component_id", "id")
    out = out.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), reached.alias("component_id"),
        F.coalesce(F.col("id") == reached, F.lit(True)).alias("kept"),
    )
    out = staged(out, "vectors_result")
    work.end()
    return out
