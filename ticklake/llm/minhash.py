"""Near-duplicate documents by MinHash with SetSketch registers.

Each of m registers is a truncated minimum on an exponential scale (Ertl,
SetSketch, 2021): with h the smallest hash of the set as an exponential
variable of rate a, the register is clip(floor(1 - log_b h), 0, q + 1).  Registers of a
union are the maxima of the registers, and two sets agree in a register about
as often as their Jaccard similarity says.

1. One pass over the texts makes registers and a digest of the shingle set;
   rows of equal sets are one class from here on (copies are never paired).
2. Runs of ROWS registers are band keys.  In a bucket each class is paired
   with one hub, not with every other.
3. The similarity of a pair is first estimated by joint likelihood from the
   register order counts; pairs that can't reach the threshold go, the rest
   are confirmed on full shingle sets.
4. Connected components.  Classes that share a bucket but no component are then
   compared on full sets, block by block, so no link between components is
   lost; pairs within a component can't change it and are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import Work, broadcast_if_small, connected_components, handing_back, runs, sliced, staged
from ticklake.llm.shingles import WordHashes, mixed, shingle_set, word_array

#: SetSketch scale: base, rate, largest register; and bands x rows registers.
#: At similarity 0.8 a pair shares no band with probability 3e-6.
BASE, RATE, LARGEST = 1.001, 20.0, 65_534
BANDS, ROWS = 32, 5
#: Six standard errors of the estimate from BANDS * ROWS registers at 0.8.
MARGIN = 0.19
#: Size of a block of a bucket (shingles, and ROW_SIZE for each class), and
#: shingles whose matrix is held at once.
BLOCK, ROW_SIZE, COLUMNS = 1 << 16, 64, 1 << 11
#: Texts whose results are handed to Spark together.
SLICE = 1000
#: Ids (8 bytes each) that may be broadcast to pick their texts.
BROADCAST_IDS = 2_000_000

_rng = np.random.default_rng(20240115)
_MULTIPLY = _rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32)


def registers(shingles: np.ndarray, block: int = 256) -> np.ndarray:
    """The registers of a set that is not empty."""
    low = np.full(len(_MULTIPLY), np.iinfo(np.uint32).max, np.uint32)
    top = (shingles >> np.uint64(32)).astype(np.uint32)[:, None]
    values = np.empty((min(block, len(top)), len(low)), np.uint32)
    for at in range(0, len(top), block):
        part = top[at : at + block]
        out = np.multiply(part, _MULTIPLY, out=values[: len(part)])
        out += _ADD
        np.minimum(low, out.min(axis=0), out=low)
    return register_values(low)


def register_values(low: np.ndarray) -> np.ndarray:
    """Smallest 32-bit hashes as exponential variables, then on the scale."""
    h = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, LARGEST + 1).astype(np.int32)


def estimated_jaccard(n_a, n_b, more, less, m) -> np.ndarray:
    """Joint maximum-likelihood similarity, given the set sizes and in how
    many of m registers a is above and below b."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        above, below = p(u - v * j), p(v - u * j)
        same = np.clip(1 - above - below, 1e-300, 1)
        tiny = 1e-300
        return more * np.log(np.maximum(above, tiny)) + less * np.log(np.maximum(below, tiny)) + (m - more - less) * np.log(same)

    low, high, golden = np.zeros_like(u), np.minimum(u / v, v / u), (5**0.5 - 1) / 2
    for _ in range(40):  # the likelihood has one maximum
        x, y = high - golden * (high - low), low + golden * (high - low)
        left = likelihood(x) >= likelihood(y)
        low, high = np.where(left, low, x), np.where(left, y, high)
    return (low + high) / 2


def _estimate(n_a: pd.Series, n_b: pd.Series, regs_a: pd.Series, regs_b: pd.Series) -> pd.Series:
    if not len(n_a):
        return pd.Series([], dtype=float)
    a, b = np.stack(regs_a), np.stack(regs_b)
    out = estimated_jaccard(n_a.to_numpy(float), n_b.to_numpy(float), (a > b).sum(1), (a < b).sum(1), a.shape[1])
    return pd.Series(out)


def _node(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    one = mixed(shingles).sum(dtype=np.uint64)
    two = mixed(shingles ^ np.uint64(0xA5A5A5A5DEADBEEF)).sum(dtype=np.uint64)
    return int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big")


def _signatures(docs: DataFrame, k: int) -> DataFrame:
    """id, n, node (null for empty sets and null ids), registers; and the
    texts' digests if `docs` has them."""
    extra = [c for c in docs.columns if c == "digest"]

    @handing_back
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in sliced(batches, SLICE):
            rows = []
            for key, text in zip(batch["id"], batch["text"]):
                shingles = shingle_set(word_array(text, hashes), k)
                linked = len(shingles) and not pd.isna(key)
                rows.append((len(shingles), _node(shingles) if linked else None, registers(shingles) if linked else None))
            out = pd.DataFrame(rows, columns=["n", "node", "regs"])
            out["id"] = batch["id"].astype("Int64").to_numpy()
            for c in extra:
                out[c] = batch[c].to_numpy()
            yield out[["id", "n", "node", "regs", *extra]]

    return docs.mapInPandas(sign, "id long, n long, node binary, regs array<int>" + "".join(f", {c} long" for c in extra))


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """node and its whole set, one row for each text given."""

    @handing_back
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in sliced(batches, SLICE):
            found = [x for x in (shingle_set(word_array(t, hashes), k) for t in batch["text"]) if len(x)]
            yield pd.DataFrame({"node": [_node(x) for x in found], "shingles": [x.view(np.int64) for x in found]})

    return docs.select("text").mapInPandas(sets, "node binary, shingles array<long>")


def _sets_of(work: Work, nodes: DataFrame, classes: DataFrame, docs: DataFrame, k: int, name: str) -> DataFrame:
    """node and its whole set for the given nodes (and maybe some others)."""
    needed = work(nodes.join(classes.select("node", "rep"), "node").select(F.col("rep").alias("id")).distinct(), f"{name}_ids")
    # of a repeated id all texts are read; a set that nobody needs joins with nothing
    sets = _sets(docs.join(broadcast_if_small(needed, BROADCAST_IDS), "id", "left_semi"), k)
    return work(sets, f"{name}_sets").dropDuplicates(["node"])


def _confirmed(work: Work, pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets reach the threshold."""
    near = pairs
    for side in ("a", "b"):
        near = near.join(classes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("regs").alias(f"regs_{side}")), side)
    near = near.where(_sizes_allow("n_a", "n_b", percent))
    near = near.withColumn("estimate", F.pandas_udf(_estimate, "double")("n_a", "n_b", "regs_a", "regs_b")).where(F.col("estimate") >= percent / 100 - MARGIN)
    near = work(near.select("a", "b", "n_a", "n_b"), f"{name}_near")
    sets = _sets_of(work, near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes, docs, k, name)
    for side in ("a", "b"):
        near = near.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    both = F.size(F.array_intersect("set_a", "set_b"))
    return work(near.where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b"), f"{name}_links")


def _sizes_allow(a, b, percent: int):
    """Sets of sizes a and b can reach the threshold at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _cell_links(cell: pd.DataFrame, percent: int) -> pd.DataFrame | None:
    """Links that join the components of a cell: a forest of pairs whose full
    sets reach the threshold.  Intersections of all rows come from products of
    row-by-shingle matrices."""
    component = pd.factorize(cell["component"])[0]
    sets = [np.asarray(x, np.int64) for x in cell["shingles"]]
    sizes = np.array([len(x) for x in sets])
    rows = np.flatnonzero(cell["outside"].to_numpy() & (cell["block"] == cell["low"]).to_numpy())
    cols = np.flatnonzero((cell["block"] == cell["high"]).to_numpy())
    if not len(rows) or not len(cols):
        return None
    hashes, place = np.unique(np.concatenate(sets), return_inverse=True)
    of = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(place, kind="stable")
    place, of = place[order], of[order]
    both = np.zeros((len(rows), len(cols)))
    for at in range(0, len(hashes), COLUMNS):
        a, b = np.searchsorted(place, (at, at + COLUMNS))
        held = np.zeros((len(sets), min(COLUMNS, len(hashes) - at)), np.float32)
        held[of[a:b], place[a:b] - at] = 1
        both += held[rows] @ held[cols].T
    linked = 100 * both >= percent * (sizes[rows][:, None] + sizes[cols][None, :] - both)
    linked &= component[rows][:, None] != component[cols][None, :]
    root, nodes, forest = list(range(len(cell))), cell["node"].to_numpy(), []
    for x, y in zip(*np.nonzero(linked)):
        ends = [component[rows[x]], component[cols[y]]]
        for i in (0, 1):
            while root[ends[i]] != ends[i]:
                root[ends[i]] = root[root[ends[i]]]
                ends[i] = root[ends[i]]
        if ends[0] != ends[1]:
            root[ends[0]] = ends[1]
            forest.append((nodes[rows[x]], nodes[cols[y]]))
    return pd.DataFrame(forest, columns=["a", "b"]) if forest else None


def _rest(work: Work, banded: DataFrame, classes: DataFrame, component: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between components whose classes share a bucket.

    Of each bucket, classes outside its largest component meet all classes.
    A bucket is cut into blocks of about size BLOCK, apart for those
    outside and the others, and each pair of blocks with an outside one is a
    cell: bounded work for a task, and only joining links leave it."""
    members = banded.join(classes.select("node", "n"), "node").join(component, "node", "left")
    members = members.withColumn("component", F.coalesce("component", "node"))
    sizes = members.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("n") + ROW_SIZE).alias("shingles"))
    main = sizes.groupBy("band").agg(
        F.max_by(F.struct("component", "shingles"), F.struct("size", "component")).alias("main"), F.sum("shingles").alias("shingles"), F.count(F.lit(1)).alias("components")
    )
    inside, outer = F.col("main.shingles"), F.col("shingles") - F.col("main.shingles")
    blocks = [F.ceil(x / BLOCK).cast("int") for x in (outer, inside)]
    main = main.where("components > 1").select("band", F.col("main.component").alias("main"), blocks[0].alias("outer"), blocks[1].alias("inner"))
    members = members.join(main, "band").withColumn("outside", F.col("component") != F.col("main"))
    hashed = F.xxhash64("node", F.lit(3))
    block = F.when(F.col("outside"), F.pmod(hashed, "outer")).otherwise(F.col("outer") + F.pmod(hashed, "inner")).cast("int")
    members = work(members.select("band", "node", "component", "outside", block.alias("block"), "outer", "inner"), "minhash_members")

    sets = _sets_of(work, members.select("node").distinct(), classes, docs, k, "minhash_outside")
    members = members.join(sets, "node")
    last = F.when(F.col("outside"), F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1
    cells = members.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    cells = cells.select("band", "node", "component", "outside", "block", "shingles", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    cells = cells.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")

    @handing_back
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in runs(batches, ["band", "low", "high"]):
            if len(cell) > 1 and (found := _cell_links(cell, percent)) is not None:
                yield found

    return cells.mapInPandas(compare, "a binary, b binary").distinct()


def text_digest(text: Column) -> Column:
    """Tells apart the texts of one id."""
    return F.coalesce(F.xxhash64(text), F.lit(0))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, by_row: bool = False) -> DataFrame:
    """One row (id_col, n_shingles, component_id, kept) per row of `docs`:
    texts whose shingle sets have 100 * intersection >= percent * union are
    linked, component_id is the smallest id that links reach, kept marks it.

    Words are runs without ASCII white space, A-Z lower-cased; a text with
    fewer words than a shingle is one shingle; texts without words (empty or
    null) link with nothing.  Rows without id link with nothing: their
    component is null and they are kept.  Rows that repeat an id are all
    returned.  Extra columns are ignored; an empty table gives no rows.

    With by_row there are two more columns, for ids that repeat: digest, the
    text_digest of the row's text, and component, which is null for rows that
    link with nothing by rule; unlike component_id it differs between
    components that have the same smallest id.
    """
    text = F.col(text_col)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), *[text_digest(text).alias("digest")] * by_row)
    work = Work(docs.sparkSession)
    signed = work(_signatures(docs, shingle), "minhash_signatures")
    classes = signed.where("node is not null").groupBy("node").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("regs").alias("regs"))
    classes = work(classes, "minhash_classes")

    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.slice("regs", i * ROWS + 1, ROWS)))
    in_bands = classes.select("node", F.explode(keys).alias("band"))
    shared = in_bands.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("band")
    banded = work(in_bands.join(shared, "band"), "minhash_bands")

    hub = F.min_by(F.struct("node", "n"), F.xxhash64("node")).alias("hub")
    pairs = banded.join(classes.select("node", "n"), "node")
    pairs = pairs.join(pairs.groupBy("band").agg(hub), "band").where((F.col("node") != F.col("hub.node")) & _sizes_allow("n", "hub.n", percent))
    pairs = pairs.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()
    first = _confirmed(work, pairs, classes, docs, shingle, percent, "minhash_hubs")

    component = connected_components(first, work)
    second = work(_rest(work, banded, classes, component, docs, shingle, percent), "minhash_rest")
    component = connected_components(first.unionByName(second), work)

    named = classes.select("node", "rep").join(component, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    more = ["digest", "component"] if by_row else []
    named = named.join(smallest, "component").select("node", "component_id", *more[1:])
    out = signed.select("id", "n", "node", *more[:1]).join(named, "node", "left")
    reached = F.coalesce("component_id", "id")
    out = out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), reached.alias("component_id"), F.coalesce(F.col("id") == reached, F.lit(True)).alias("kept"), *more
    )
    out = staged(out, "minhash_result")
    work.end()
    return out
