"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text are one group and stay together.  Groups, largest first,
enter the bin with the least remaining capacity that still holds them, found in
a balanced tree of the bins by remaining capacity.  Either the capacity is given
and the number of bins is what comes out, or the number of bins is given and
the capacity is the smallest at which it is enough.

Groups of equal size are interchangeable, so what is packed is the histogram
(size, number of groups): the result is that of packing each group, and the
packing holds one entry a distinct size.  That is done on the driver for any
input: distinct sizes are at most the square root of twice all bytes (245,000
of 30 GB, each of which would have to occur).  The groups of a size then take
its places by their rank among them, on the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import Work, staged

SHARDS = 16
#: No longer looked at, as results depended on them: every input is packed exactly.
MAX_SIZES, BUNDLES = 100_000, 8192
#: A group with 1 / LARGE_SHARE of the rows is sent to all of them, as at most so many are.
LARGE_SHARE = 8192
#: Parts of a shard that are numbered apart from each other.
PARTS = 1024
#: Groups of a size that are numbered together.
PART_GROUPS = 100_000
#: Rows of a table that is broadcast.
BROADCAST_ROWS = 1 << 20

#: Places of some items of one size: `n` of them, `per` to a bin, in the bins from `bin` on.
Run = tuple[int, int, int]


class _Tree:
    """Bins by remaining capacity: a treap of (capacity, bin) with insert,
    remove and the smallest entry of at least a given capacity."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        return hash((key[0] * 0x9E3779B1 + 0x7F4A7C15, key[1] * 0x85EBCA6B + 1))

    def _split(self, node, key):
        if node is None:
            return None, None
        k, p, left, right = node
        if k < key:
            a, b = self._split(right, key)
            return (k, p, left, a), b
        a, b = self._split(left, key)
        return a, (k, p, b, right)

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return a[0], a[1], a[2], self._join(a[3], b)
        return b[0], b[1], self._join(a, b[2]), b[3]

    def insert(self, capacity: int, name: int) -> None:
        key = (capacity, name)
        a, b = self._split(self.root, key)
        self.root = self._join(self._join(a, (key, self._priority(key), None, None)), b)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return the smallest entry of capacity >= least."""
        a, b = self._split(self.root, (least, -1))
        if b is None:
            self.root = a
            return None
        node = b
        while node[2] is not None:
            node = node[2]
        key = node[0]
        _, b = self._split(b, (key[0], key[1] + 1))
        self.root = self._join(a, b)
        return key


def best_fit(sizes: list[tuple[int, int]], capacity: int, bins: int | None = None) -> list[list[Run]] | None:
    """For each (size, count), largest size first, the runs (n, per, bin) that
    place its items: n items, per of them to a bin, in bins numbered from `bin`
    on.  None if `bins` bins of this capacity aren't enough or a size is over
    it.  The bin that is tightest for an item stays so for the next one of its
    size while it holds it, so a bin takes all it holds of a size at once."""
    tree, out, opened = _Tree(), [], 0
    for size, count in sizes:
        if size > capacity:
            return None
        runs = []
        while count and (found := tree.take(size)) is not None:
            n = min(count, found[0] // size)
            runs.append((n, n, found[1]))
            tree.insert(found[0] - n * size, found[1])
            count -= n
        if count:
            per = capacity // size
            new = -(-count // per)
            if bins is not None and opened + new > bins:
                return None
            runs.append((count, per, opened))
            for i in range(new):
                tree.insert(capacity - size * min(per, count - i * per), opened + i)
            opened += new
        out.append(runs)
    return out


def pack(sizes: list[tuple[int, int]], bins: int) -> list[list[Run]]:
    """Runs for each (size, count), largest size first.  An item of at least a
    fair share of what is left gets a bin of its own; the rest go to the other
    bins at the smallest capacity at which best fit needs no more of them."""
    rest, left, alone = sum(s * n for s, n in sizes), bins, []
    for size, count in sizes:
        n = 0
        while n < count and left > 1 and size * left >= rest:
            n, rest, left = n + 1, rest - size, left - 1
        alone.append(n)
        if n < count:
            break
    alone += [0] * (len(sizes) - len(alone))
    items = [(s, n - a) for (s, n), a in zip(sizes, alone) if n > a]
    packed = iter(_tightest(items, left, -(-rest // left)) if items else [])
    out, used = [], 0
    for (_, n), a in zip(sizes, alone):
        runs = [(a, 1, used)] if a else []
        used += a
        out.append(runs + ([(k, per, bins - left + b) for k, per, b in next(packed)] if n > a else []))
    return out


def _tightest(items: list[tuple[int, int]], bins: int, share: int) -> list[list[Run]]:
    low = max(items[0][0], share)
    high = low + items[0][0]
    best = best_fit(items, high, bins)
    while best is None:  # can't happen often: a fair share and the largest item more
        high += items[0][0]
        best = best_fit(items, high, bins)
    while low < high:
        middle = (low + high) // 2
        found = best_fit(items, middle, bins)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    return best


def pack_into(sizes: list[tuple[int, int]], capacity: int) -> list[list[Run]]:
    """Runs for each (size, count), largest size first, in as many bins of
    this capacity as best fit takes; an item over it has a bin of its own."""
    over = [(s, n) for s, n in sizes if s > capacity]
    out, used = [], 0
    for _, n in over:
        out.append([(n, 1, used)])
        used += n
    packed = best_fit(sizes[len(over) :], capacity)
    return out + [[(n, per, used + b) for n, per, b in runs] for runs in packed]


def bins_of(packed: list[list[Run]]) -> int:
    return max((b + -(-n // per) for runs in packed for n, per, b in runs), default=0)


def _sizes(groups: DataFrame) -> list[tuple[int, int]]:
    """The sizes of the groups with their counts, largest first."""
    found = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).toArrow()  # at most the square root of twice all bytes
    return sorted(zip(found["bytes"].to_pylist(), found["n"].to_pylist()), reverse=True)


def _if_bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _placed(groups: DataFrame, sizes: list[tuple[int, int]], packed: list[list[Run]]) -> DataFrame:
    """The groups with their shard: those of a size are ranked by their number,
    in parts of about PART_GROUPS, and the ranks are dealt to the size's runs."""
    rows = []
    for (size, count), runs in zip(sizes, packed):
        ends, at = [], 0
        for n, per, first in runs:
            ends.append((at, at + n, per, first))
            at += n
        rows.append((size, -(-count // PART_GROUPS), ends))
    runs = "array<struct<start:bigint,stop:bigint,per:bigint,first:int>>"
    plan = groups.sparkSession.createDataFrame(rows, f"bytes long, parts long, runs {runs}")
    n_parts = sum(r[1] for r in rows)
    dealt = groups.join(_if_bounded(plan, sum(len(r[2]) for r in rows)), "bytes")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("group", F.lit(2)), F.col("parts")))
    counts = dealt.groupBy("bytes", "part").agg(F.count(F.lit(1)).alias("in_part"))
    earlier = Window.partitionBy("bytes").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("bytes", "part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("bytes", "part").orderBy("group")) - 1
    ranked = dealt.withColumn("rank", rank).join(_if_bounded(before, n_parts), ["bytes", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    run = F.filter("runs", lambda r: F.col("rank") < r["stop"])[0]
    shard = run["first"] + F.floor((F.col("rank") - run["start"]) / run["per"])
    return ranked.select("group", "n", shard.cast("int").alias("shard"))


def sharded(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None
) -> DataFrame:
    """One row (id_col, size, text_crc32, law, shard, slot, grown_shard) per
    row of `docs`.  The law is `bytes`: the shards' summed sizes (UTF-8 bytes of
    the text and one more) are nearly equal and rows of equal text share a
    shard; slots number a shard's rows from 0 by part and id.  With `capacity`
    (a size) there are as many shards as best fit takes so that none is over it
    (`shards` is then not looked at; law `capacity`).

    Null and empty texts are one group of size 1 each row, CRC 0.  A group of
    over a fair share (or over the capacity) is alone in its shard and the
    others share the rest.  Repeated rows get a slot each; which of them gets
    which is left open, as they are equal.  Extra columns are ignored; an empty
    table gives no rows.
    """
    if capacity is not None and capacity < 1:
        raise ValueError("capacity must be positive")
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("group"),  # groups whose hashes meet travel together: still whole
    )
    work = Work(docs.sparkSession)
    try:
        digests = work(digests, "sharding_digests")
        groups = digests.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        groups = work(groups, "sharding_groups")
        sizes = _sizes(groups)
        packed = pack(sizes, shards) if capacity is None else pack_into(sizes, capacity)
        placed = work(_placed(groups, sizes, packed), "sharding_placed")
        out = _numbered(_sharded_rows(digests, placed), bins_of(packed))
        return staged(
            out.select(
                F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                F.lit("bytes" if capacity is None else "capacity").alias("law"), "shard", "slot",
                F.lit(None).cast("int").alias("grown_shard"),
            ),
            "sharding_result",
        )
    finally:
        work.end()


def _sharded_rows(digests: DataFrame, placed: DataFrame) -> DataFrame:
    """The rows with the shard of their group.  Groups that hold many of the
    rows are sent to all of them, so that the join on the group has no hot key."""
    many = F.col("n") * LARGE_SHARE >= (placed.agg(F.sum("n")).first()[0] or 0)  # at most LARGE_SHARE groups
    hot = F.broadcast(placed.where(many).select("group", F.col("shard").alias("hot")))
    known = digests.join(hot, "group", "left")
    rest = known.where("hot is null").join(placed.where(~many).select("group", "shard"), "group")
    columns = ["id", "size", "crc", "shard"]
    return known.where("hot is not null").withColumn("shard", F.col("hot")).select(columns).unionByName(rest.select(columns))


def _numbered(rows: DataFrame, shards: int) -> DataFrame:
    """The rows with their slot: parts of a shard are numbered apart and begin
    where the parts before them end."""
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", "crc"), F.lit(PARTS)).cast("int"))
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = _if_bounded(counts.select("shard", "part", F.coalesce(before, F.lit(0)).alias("first")), shards * PARTS)
    slot = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "size", "crc")) - 1
    return rows.withColumn("slot", slot).join(first, ["shard", "part"]).withColumn("slot", (F.col("slot") + F.col("first")).cast("long"))
