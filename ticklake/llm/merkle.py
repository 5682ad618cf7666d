"""A Merkle manifest of a dataset, with incremental witnesses.

A leaf is the SHA-256 of a row's fields.  Each tree (one per value of a column)
takes its leaves in id order; every FAN consecutive nodes, the last run maybe
fewer, become the hash of theirs, level by level, while there are several.  The
trees' roots, in the order of the column's values, are the leaves of one more
tree, whose root stands for the whole dataset.

Nodes are appended one by one to the open runs of an `Append`.  A node that
joins a run gets a partial witness, its siblings so far, and each later sibling
extends the witnesses of those before it; a run that is complete is appended to
the level above, whose partial witness is that of the whole subtree: leaves
share the witnesses of their ancestors, so an append costs a few operations.

On Spark a tree is cut into aligned blocks of FAN ** LEVELS leaves.  A task
streams the leaves of its blocks; block roots are then treated as further
appends, in blocks again, until a tree has one node.  What comes back down is
the witness of each block root, and it extends those of the block's leaves.  So
no task sees more than a block of a tree at once, however large the tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import Work, broadcast_if_small, staged

FAN, LEVELS = 8, 4
#: Runs of a tree in a part (about 100 bytes each) and trees that may be broadcast.
BROADCAST_RUNS = 500_000
#: Rows in a batch that a task returns.
ROWS = 1000


def hashed(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class _Witness:
    """Siblings of a node in its run, those before it and (so far) after it,
    and the witness of the run's own node on the level above."""

    __slots__ = ("left", "right", "up")

    def __init__(self, left: str):
        self.left, self.right, self.up = left, "", None


class Append:
    """A tree that grows by appends.  `levels` fixes its height (an aligned
    block of a larger tree); otherwise it ends where one node is left."""

    def __init__(self, levels: int | None = None):
        self.levels = levels
        self.open: list[list[tuple[str, _Witness]]] = [[]]  # the open run of each level
        self.count = [0]  # nodes appended to each level
        self.root: str | None = None

    def append(self, digest: str) -> _Witness:
        """Append a leaf; its witness is extended by later appends."""
        return self._append(0, digest)

    def _append(self, level: int, digest: str) -> _Witness:
        if level == len(self.open):
            self.open.append([])
            self.count.append(0)
        run = self.open[level]
        witness = _Witness("".join([d for d, _ in run]))
        for _, earlier in run:
            earlier.right += digest
        run.append((digest, witness))
        self.count[level] += 1
        if len(run) == FAN:
            self._close(level)
        return witness

    def _close(self, level: int) -> None:
        run = self.open[level]
        up = self._append(level + 1, hashed("".join([d for d, _ in run])))
        for _, witness in run:
            witness.up = up
        self.open[level] = []

    def finish(self) -> str:
        """Close the runs that are still open; returns the root."""
        level = 0
        while level < self.levels if self.levels is not None else self.count[level] > 1:
            if self.open[level]:
                self._close(level)
            level += 1
        self.root = self.open[level][0][0]
        return self.root

    @staticmethod
    def siblings(witness: _Witness) -> tuple[list[str], list[str]]:
        """Left and right siblings of a leaf, as joined hex, level by level."""
        left, right = [], []
        while witness.up is not None:
            left.append(witness.left)
            right.append(witness.right)
            witness = witness.up
        return left, right


# --- expressions ---------------------------------------------------------------


def field(c: Column) -> Column:
    """A field of a leaf: `-` if null, else its UTF-8 byte count, `:` and it."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def proof(lefts: str = "lefts", rights: str = "rights") -> Column:
    """SHA-256 of a witness: all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(lefts, rights, lambda a, b: F.concat(a, b)), ""), 256)


def folded(digest: Column, lefts: str = "lefts", rights: str = "rights") -> Column:
    """The root that a leaf and its witness give."""
    level = F.zip_with(lefts, rights, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.aggregate(level, digest, lambda d, x: F.sha2(F.concat(x["a"], d, x["b"]), 256))


def tree_key(c: Column) -> Column:
    """A text whose order is that of the values, null first (UTF-8 bytewise)."""
    return F.when(c.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), c.cast("string")))


# --- trees on Spark ---------------------------------------------------------------


def _numbered(work: Work, rows: DataFrame, keys: list) -> DataFrame:
    """`rows` (with `tree`) with pos (from 0 in its tree, by the keys) and n
    (rows of its tree), by range partitions: the rows' places inside a part
    come with the sort, only counts by part and tree are added up."""
    order = ["tree", *keys, "spread"]  # equal rows needn't meet in one part
    rows = rows.withColumn("spread", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("spread")
    rows = work(rows.withColumn("at", F.monotonically_increasing_id()), "merkle_sorted")
    part = F.shiftright("at", 33)
    runs = rows.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumns({"before": F.coalesce(before, F.lit(0)), "n": F.sum("rows").over(Window.partitionBy("tree"))})
    runs = broadcast_if_small(work(runs.drop("rows"), "merkle_runs"), BROADCAST_RUNS)
    out = rows.withColumn("part", part).join(runs, ["tree", "part"])
    return out.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def _dealt(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _block(levels: int) -> Column:
    return F.shiftright("pos", 3 * levels).alias("block")  # FAN is 2**3


def _block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (tree, pos, n, digest) -> the roots of their blocks as nodes."""
    block_size = FAN**levels

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree, size = None, Append(), 0
        rows: list[tuple] = []

        def done() -> None:
            if key is not None:
                rows.append((*key, -(-size // block_size), tree.finish()))

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 4
            rows.clear()
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["tree", "pos", "n", "digest"])

        for b in batches:
            for name, block, n, digest in zip(*(b[c].to_pylist() for c in ("tree", "block", "n", "digest"))):
                if (name, block) != key:
                    done()
                    key, tree, size = (name, block), Append(levels if n > block_size else None), n
                tree.append(digest)
            if len(rows) >= ROWS:
                yield batch()
        done()
        yield batch()

    rows = _dealt(nodes.select("tree", _block(levels), "pos", "n", "digest"))
    return rows.mapInArrow(stream, "tree string, pos long, n long, digest string")


def _upper(work: Work, nodes: DataFrame, levels: int) -> DataFrame:
    """Of each block of nodes (tree, pos, n, digest): tree, block, and the
    witness (lefts, rights) and tree root (root) of the block's root."""
    roots = work(_block_roots(nodes, levels), "merkle_blocks")
    none = F.array().cast("array<string>")
    out = roots.where("n <= 1").select("tree", F.col("pos").alias("block"), none.alias("lefts"), none.alias("rights"), F.col("digest").alias("root"))
    larger = roots.where("n > 1")
    if not larger.isEmpty():
        above = _witnessed(larger, _upper(work, larger, levels), [], levels)
        out = out.unionByName(above.select("tree", F.col("pos").alias("block"), "lefts", "rights", "root"))
    return work(out, "merkle_upper")


def _witnessed(nodes: DataFrame, upper: DataFrame, carried: list[str], levels: int) -> DataFrame:
    """Nodes (tree, pos, n, digest, carried columns) with the witness (lefts,
    rights) up to the root of their tree and the columns of `upper`."""
    beside = [c for c in upper.columns if c not in ("tree", "block", "lefts", "rights")]
    row = F.struct(F.lit(0).alias("_"), *carried).alias("row")
    given = [F.lit(None).cast("array<string>").alias(c) for c in ("lefts", "rights")] + [F.lit(None).cast("string").alias(c) for c in beside]
    own = nodes.select("tree", _block(levels), "pos", "n", "digest", row, *given)
    none = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("n", "digest", "row")]
    heads = upper.select("tree", "block", F.lit(-1).cast("long").alias("pos"), *none, "lefts", "rights", *beside)
    rows = _dealt(own.unionByName(heads))
    names = ["tree", "pos", "digest", "lefts", "rights", *beside]
    block_size = FAN**levels

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, tree, leaves = None, None, []

        def done() -> Iterator[pa.RecordBatch]:
            if tree is None:
                return
            tree.finish()
            for at in range(0, len(leaves), ROWS):
                part = leaves[at : at + ROWS]
                found = [Append.siblings(witness) for *_, witness in part]
                columns = {
                    "tree": [head["tree"]] * len(part),
                    "pos": [x[0] for x in part],
                    "digest": [x[1] for x in part],
                    "lefts": [a + head["lefts"] for a, _ in found],
                    "rights": [b + head["rights"] for _, b in found],
                }
                types = {"pos": pa.int64(), "lefts": pa.list_(pa.string()), "rights": pa.list_(pa.string())}
                arrays = [pa.array(columns.get(c, [head[c]] * len(part) if c in head else None), types.get(c, pa.string())) for c in names]
                yield pa.RecordBatch.from_arrays([*arrays, pa.concat_arrays([x[2] for x in part])], [*names, "row"])

        for b in batches:
            keys = [b[c].to_pylist() for c in ("pos", "n", "digest")]
            for i, (pos, n, digest) in enumerate(zip(*keys)):
                if pos < 0:  # a block begins: the witness of its root
                    yield from done()
                    head = {c: b[c][i].as_py() for c in ("tree", "lefts", "rights", *beside)}
                    tree, leaves = None, []
                    continue
                if tree is None:
                    tree = Append(levels if n > block_size else None)
                leaves.append((pos, digest, b["row"].slice(i, 1), tree.append(digest)))
        yield from done()

    row = own.schema["row"].dataType.simpleString()
    schema = ", ".join(f"{c} {dict(pos='long', lefts='array<string>', rights='array<string>').get(c, 'string')}" for c in names)
    out = rows.mapInArrow(stream, f"{schema}, row {row}")
    return out.select(*names, *[F.col("row")[c].alias(c) for c in carried])


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", tree_col: str = "lang", carry: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of `docs`: id, leaf, subroot (of its tree), root, the
    witness from the leaf to the root as `lefts` and `rights` (joined digests
    of the siblings before and after, level by level), and the columns of
    `carry` (expressions over `docs`).  A block has FAN ** `levels` leaves.

    A leaf hashes `fields` in turn (see field()).  Trees are the values of
    `tree_col`, null one of them; leaves ascend by id, null first; rows that
    repeat an id go by their leaf's digest, and equal rows are leaves each
    (which of them has which witness is left open).  Texts count whole.  An
    empty table gives no rows (and has no root).  Other columns are ignored.
    """
    carry = carry or {}
    work = Work(docs.sparkSession)
    try:
        rows = docs.select(
            tree_key(F.col(f"`{tree_col}`")).alias("tree"), F.col(f"`{id_col}`").alias("id"),
            leaf(*[F.col(f"`{c}`") for c in fields]).alias("digest"), F.struct(F.lit(0).alias("_"), *[c.alias(name) for name, c in carry.items()]).alias("carry"),
        )
        rows = work(rows, "merkle_leaves")
        nodes = work(_numbered(work, rows, [F.col("id").asc_nulls_first(), "digest"]), "merkle_nodes")
        upper = _upper(work, nodes, levels)

        subroots = upper.where("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("root").alias("digest"))
        subroots = work(_numbered(work, subroots, ["of"]), "merkle_subroots")
        top = _witnessed(subroots, _upper(work, subroots, levels), ["of"], levels).select(
            F.col("of").alias("tree"), "root", F.col("lefts").alias("more_lefts"), F.col("rights").alias("more_rights")
        )
        upper = upper.withColumnRenamed("root", "subroot").join(broadcast_if_small(work(top, "merkle_top"), BROADCAST_RUNS), "tree")
        upper = upper.select(
            "tree", "block", F.concat("lefts", "more_lefts").alias("lefts"), F.concat("rights", "more_rights").alias("rights"), "subroot", "root"
        )
        out = _witnessed(nodes, upper, ["id", "carry"], levels)
        out = out.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "lefts", "rights", *[F.col("carry")[c].alias(c) for c in carry])
        return staged(out, "merkle_manifest")
    finally:
        work.end()


__all__ = ["Append", "field", "folded", "hashed", "leaf", "manifest", "proof", "tree_key"]
