"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed hash.  A source takes each of its documents a
whole number of times (the same for all) and once more those whose hash lies
under the source's threshold, so that the words taken meet the target.  The
threshold is found without sorting documents: words are summed by source and
hash bucket, the bucket in which the budget ends is found from the running
sum, and only the documents of that bucket are summed again by finer buckets,
until a bucket is a single hash value.  Thresholds are nested: a larger budget
takes the documents of a smaller one and more.  DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import Work, staged, words

#: A document's hash has LEVELS * LEVEL_BITS bits; a histogram has 2**LEVEL_BITS buckets.
LEVELS, LEVEL_BITS = 4, 12
HASH_BITS = LEVELS * LEVEL_BITS
WEIGHTS = (1, 2, 3)
#: Sources (under 200 bytes each) whose thresholds may be broadcast.
BROADCAST_SOURCES = 100_000
MOST_REPEATS = 3


def document_hash(doc_id: Column) -> Column:
    """48 bits of the MD5 of the id as text (a null id counts as empty)."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row (source, source_size, target) per source, from (source, size).

    Sources in code-point order, null last, weigh `weights` in turn and share
    the sum of all sizes by weight; a target stops at `most` times its
    source's size and the excess is shared again.  That ends where every
    source has min(cap, level * weight) with one common level; sources reach
    their caps in order of cap / weight, so running sums in that order give it.
    The windows run over one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weighed = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    ratio = F.col("source_size") / F.col("weight")
    by_ratio = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weighed = weighed.withColumns(
        {
            "before": F.coalesce(F.sum("source_size").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * most,
            "weight_left": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
            "total": F.sum("source_size").over(everything),
        }
    )
    # a source is capped if, with those before it capped, its share is over its cap
    share_left = F.col("total") - F.col("before")
    capped = F.col("weight") * share_left > F.col("source_size") * most * F.col("weight_left")
    weighed = weighed.withColumn("capped", capped).withColumns(
        {
            "level_sum": F.max(F.when(~F.col("capped"), share_left)).over(everything),
            "level_weight": F.max(F.when(~F.col("capped"), F.col("weight_left"))).over(everything),
        }
    )
    target = F.when(F.col("capped"), F.col("source_size").cast("double") * most).otherwise(
        F.coalesce((F.col("weight") * F.col("level_sum")).cast("double") / F.col("level_weight").cast("double"), F.lit(0.0))
    )
    return weighed.select("source", "source_size", target.alias("target"))


def thresholds(work: Work, sized: DataFrame, plans: DataFrame, hint: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row (source, source_size, target, base, threshold) per source: its
    documents are taken `base` times, those with hash < threshold once more.
    `sized` has (source, size, hash); `plans` is the result of targets(),
    `hint` marks a table with a row for each source for its joins."""
    size = F.col("source_size")
    base = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    state = plans.withColumn("base", base).withColumns(
        {
            "budget": F.col("target") - F.col("base") * size,  # words that the bucket found so far may still take
            "prefix": F.lit(0).cast("long"),  # the hash bits found so far
        }
    )
    for level in range(LEVELS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        found = hint(state.select(F.col("source").alias("of"), "prefix"))
        inside = sized.join(found, F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")))
        buckets = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        joined = buckets.withColumn("upto", upto).join(hint(state.select(F.col("source").alias("of"), "budget")), F.col("source").eqNullSafe(F.col("of")))
        # the first bucket that the budget doesn't cover, and what goes before it
        first = joined.where(F.col("upto") > F.col("budget")).groupBy("of").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("gone"), "words")).alias("end"))
        nxt = state.join(first, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        beyond = F.shiftleft(F.col("prefix") + 1, LEVEL_BITS)  # the whole bucket is covered (only at level 0: all hashes)
        state = nxt.select(
            "source", "source_size", "target", "base",
            (F.col("budget") - F.coalesce("end.gone", F.lit(0))).alias("budget"),
            F.coalesce("end.bucket", beyond).alias("prefix"),
            F.coalesce("end.words", F.lit(0)).alias("words"),
        )
        state = work(state, "mixing_level")
    # the last bucket is one hash value: it is taken if that is nearer to the budget
    nearer = (F.col("words") > 0) & (F.col("words") - F.col("budget") < F.col("budget"))
    return state.select("source", "source_size", "target", "base", (F.col("prefix") + nearer.cast("long")).alias("threshold"))


def mixture(docs: DataFrame, size: Column | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """`docs` with size, source_size, target and taken (in words, 1 to
    MOST_REPEATS times the size or 0); `size` defaults to the words of the
    text.  Columns of these names are replaced, all rows are returned.

    Null texts have size 0 and take nothing; null sources are one source, the
    last; rows of one id in a source are all taken or all left, so a source
    ends nearer to its target than its largest id; an empty table gives none.
    """
    names = ("size", "source_size", "target", "taken")
    out = _mixed(docs, size, id_col, text_col, source_col)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return out.select(*kept, *[F.col(f"__{c}").alias(c) for c in names])


def _mixed(docs: DataFrame, size: Column | None, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """`docs` with __size, __source_size, __target and __taken."""
    size = words(F.col(f"`{text_col}`")) if size is None else size
    id_of, source = F.col(f"`{id_col}`"), F.col(f"`{source_col}`")
    full = docs.select(*[F.col(f"`{c}`") for c in docs.columns], size.cast("long").alias("__size"), document_hash(id_of).alias("__hash"))
    work = Work(docs.sparkSession)
    try:
        sized = work(full.select(source.alias("source"), F.col("__size").alias("size"), F.col("__hash").alias("hash")), "mixing_sizes")
        plans = work(targets(sized), "mixing_targets")
        hint = F.broadcast if plans.count() <= BROADCAST_SOURCES else lambda df: df
        found = staged(thresholds(work, sized, plans, hint), "mixing_thresholds")
    finally:
        work.end()
    found = hint(found.select(*[F.col(c).alias(f"__{c}") for c in found.columns]))
    times = F.col("__base") + (F.col("__hash") < F.col("__threshold")).cast("long")
    return full.join(found, source.eqNullSafe(F.col("__source"))).withColumn("__taken", F.col("__size") * times)


def mixed_documents(docs: DataFrame, size: Column | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of `docs` as often as the mix takes them (none to
    MOST_REPEATS times), with their own columns only, whatever their names."""
    out = _mixed(docs, size, id_col, text_col, source_col)
    times = F.when(F.col("__size") > 0, (F.col("__taken") / F.col("__size")).cast("int")).otherwise(0)
    repeated = out.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
