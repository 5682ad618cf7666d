"""Serving layer: the column contract, an idempotent keyed insert, and the
dashboard queries.

Serving tables have a fixed column order and decimal(20,8) metrics, and a
primary key.  Rows are inserted only when their key is absent: the first
write of a key wins, later versions are ignored (no update).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone
from typing import Union

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ticklake.functions.parsing import utc_wall_clock
from ticklake.schemas import SERVING_TABLES
from ticklake.sources.layers import DEFAULT_FORMAT, read_snapshot, table_available, try_read_snapshot


@dataclass(frozen=True)
class JdbcTarget:
    """A serving table in a database reached over JDBC (needs the driver
    jar).  ``properties`` holds user, password, driver class, etc."""

    url: str
    dbtable: str
    properties: dict[str, str] = field(default_factory=dict)


Target = Union[str, JdbcTarget]


# File targets are partitioned by the UTC day of window_start.
DAY = "window_day"
# Days of a batch whose folders are named one by one.
LISTED_DAYS = 400
# Connections that read a database target's keys at once, at most.
JDBC_SLICES = 16


class DuplicateKeyError(ValueError):
    """A batch holds the same key twice, or a NULL key (the target's primary
    key forbids both); nothing was written."""


def contract_of(table: str) -> tuple[StructType, tuple[str, ...]]:
    return SERVING_TABLES[table]


def to_serving_contract(gold: DataFrame, table: str) -> DataFrame:
    """Project ``gold`` onto the serving table's columns, in order, cast to
    the contract types.  A column that has its contract type passes through
    as it is, so filters on it reach the scan.  A value that does not fit its column (a metric
    beyond decimal(20,8)) fails the job, as the serving database would,
    whatever the session's ANSI setting (a plain cast would turn it into
    NULL with ANSI off)."""
    schema, _ = contract_of(table)
    return gold.select(
        *[
            F.col(f.name) if gold.schema[f.name].dataType == f.dataType else _fit(f.name, f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _fit(name: str, dtype) -> Column:
    value = F.col(name)
    narrowed = value.try_cast(dtype)
    return F.when(
        value.isNotNull() & narrowed.isNull(),
        F.raise_error(F.concat(F.lit(f"{name} does not fit {dtype.simpleString()}: "), value.cast("string"))),
    ).otherwise(narrowed)


def _batch_stats(rows: DataFrame, keys: tuple[str, ...]):
    """One pass (one shuffle on the keys, partially aggregated): max rows per
    key, NULL-key rows, and the window_start range of the batch."""
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in keys])
    per_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.unix_micros("window_start")).alias("ws")
    )
    # The range travels as epoch microseconds: no driver-local time zone
    # (and no DST ambiguity) between the batch and the target filter.
    return per_key.agg(
        F.max("n").alias("max_per_key"),
        F.sum(F.when(null_key == 1, F.col("n")).otherwise(0)).alias("null_keys"),
        F.min("ws").alias("lo"),
        F.max("ws").alias("hi"),
    ).first()


def absent_rows(
    rows: DataFrame, target_keys: DataFrame | None, keys: Iterable[str]
) -> DataFrame:
    """Rows whose key is not in ``target_keys`` (``NOT EXISTS`` on equality:
    a left-anti join; NULL keys never match)."""
    if target_keys is None:
        return rows
    return rows.join(target_keys.select(*keys), list(keys), "left_anti")


def _target_keys(
    spark: SparkSession,
    target: Target,
    schema: StructType,
    keys: tuple[str, ...],
    lo_micros: int,
    hi_micros: int,
    fmt: str,
) -> DataFrame | None:
    """Keys already in the target with ``window_start`` in
    ``[lo, hi]`` (epoch microseconds); None when a file target does not
    exist yet."""
    if isinstance(target, JdbcTarget):
        cols = ", ".join(keys)
        lo, hi = _utc_literal(lo_micros), _utc_literal(hi_micros)
        table = f"(SELECT {cols} FROM {target.dbtable} WHERE window_start BETWEEN '{lo}' AND '{hi}') keys"
        return spark.read.jdbc(target.url, table, predicates=key_slices(lo_micros, hi_micros), properties=target.properties)
    existing = _read_days(spark, target, schema, fmt, *(_utc(m).date() for m in (lo_micros, hi_micros)))
    if existing is None:
        return None
    bounds = F.timestamp_micros(F.lit(lo_micros)), F.timestamp_micros(F.lit(hi_micros))
    return existing.filter(F.col("window_start").between(*bounds)).select(*keys)


def _read_days(spark: SparkSession, path: str, schema: StructType, fmt: str, first: date, last: date) -> DataFrame | None:
    """The rows of a file table whose window starts on the given days, None if
    there is no such table.  Of a Parquet table only those days' folders are
    listed and opened; a longer range is a partition filter on the table."""
    with_day = StructType([*schema.fields, StructField(DAY, DateType())])
    n = (last - first).days + 1
    if fmt == "parquet" and n <= LISTED_DAYS:
        days = ",".join(str(first + timedelta(days=i)) for i in range(n))
        try:
            return spark.read.schema(with_day).option("basePath", path).parquet(f"{path}/{DAY}={{{days}}}")
        except AnalysisException as err:
            if err.getCondition() == "PATH_NOT_FOUND":  # none of these days, or no table yet
                return None
            raise
    existing = try_read_snapshot(spark, path, with_day, fmt)
    return existing and existing.filter(F.col(DAY).between(F.lit(first), F.lit(last)))


def read_serving(spark: SparkSession, path: str, table: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A serving table kept in files, with its contract's columns."""
    schema, _ = contract_of(table)
    return read_snapshot(spark, path, StructType([*schema.fields, StructField(DAY, DateType())]), fmt).select(*schema.fieldNames())


def key_slices(lo_micros: int, hi_micros: int, slices: int = JDBC_SLICES) -> list[str]:
    """Predicates that cut ``[lo, hi]`` into time slices, one connection and
    task each, that together hold every window once."""
    step = max(1, -(-(hi_micros + 1 - lo_micros) // slices))
    starts = range(lo_micros, hi_micros + 1, step)
    return [f"window_start >= '{_utc_literal(s)}' AND window_start < '{_utc_literal(s + step)}'" for s in starts]


def _utc(micros: int) -> datetime:
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def _utc_literal(micros: int) -> str:
    return _utc(micros).isoformat(sep=" ")


def _append(rows: DataFrame, target: Target, fmt: str) -> None:
    if isinstance(target, JdbcTarget):
        rows.write.format("jdbc").option("url", target.url).option("dbtable", target.dbtable).options(
            **target.properties
        ).mode("append").save()
    else:
        day = F.to_date(utc_wall_clock("window_start")).alias(DAY)
        rows.select("*", day).write.format(fmt).partitionBy(DAY).mode("append").save(target)


def insert_absent(
    spark: SparkSession,
    batch: DataFrame,
    target: Target,
    table: str,
    fmt: str = DEFAULT_FORMAT,
) -> bool:
    """Append the rows of ``batch`` whose key is not yet in the target.

    ``target`` is a table path (format ``fmt``) or a ``JdbcTarget``.
    Idempotent: replaying the same batch adds nothing, and a retry after a
    partly written attempt only adds the missing keys.  The target's keys are
    read only for the batch's ``window_start`` range (of a file target the
    folders of its days, and a filter pushed into the scan; time slices of a
    bounded query on a database), and joined on the keys without a broadcast hint: the planner
    broadcasts them only when their estimated (or, with AQE, measured) size
    is under the broadcast threshold, else it is a sort-merge join.
    A duplicate or NULL key inside the batch raises ``DuplicateKeyError``
    before anything is written.  Returns False for an empty batch.  One
    writer per target table.
    """
    schema, keys = contract_of(table)
    # dealt by key once: the duplicate check and the anti-join both use it
    rows = to_serving_contract(batch, table).repartition(*keys).persist()
    try:
        stats = _batch_stats(rows, keys)
        if stats["null_keys"]:
            raise DuplicateKeyError(f"{table}: {stats['null_keys']} row(s) with a NULL key")
        if stats["max_per_key"] is None:
            return False
        if stats["max_per_key"] > 1:
            raise DuplicateKeyError(f"{table}: a key occurs {stats['max_per_key']} times in one batch")
        existing = _target_keys(spark, target, schema, keys, stats["lo"], stats["hi"], fmt)
        _append(absent_rows(rows, existing, keys), target, fmt)
        return True
    finally:
        rows.unpersist()


def sync_table(
    spark: SparkSession,
    gold_path: str,
    target: Target,
    table: str,
    gold_schema: StructType | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> bool:
    """Batch sync of a whole Gold table into its serving table.  False (and
    nothing written) while the Gold table does not exist yet."""
    if gold_schema is not None:
        gold = try_read_snapshot(spark, gold_path, gold_schema, fmt)  # one listing
    elif table_available(spark, gold_path, None, fmt):
        gold = read_snapshot(spark, gold_path, None, fmt)
    else:
        gold = None
    if gold is None:
        return False
    insert_absent(spark, gold, target, table, fmt)
    return True


# --- Dashboard queries -------------------------------------------------------


def _series(
    df: DataFrame,
    symbols: Iterable[str] | None,
    start: datetime | None,
    end: datetime | None,
) -> DataFrame:
    if symbols is not None:
        df = df.filter(F.col("symbol").isin(*list(symbols)))
    if start is not None:
        df = df.filter(F.col("window_start") >= _instant(start))
    if end is not None:
        df = df.filter(F.col("window_start") < _instant(end))
    return df


def _instant(dt: datetime) -> Column:
    """A Python datetime as a TIMESTAMP literal; naive means UTC (never the
    driver's local zone)."""
    aware = dt if dt.tzinfo is not None else dt.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(round(aware.timestamp() * 1_000_000)))


def _pg_concat(*parts):
    """SQL ``CONCAT`` as the serving database defines it: NULL parts count
    as empty strings (Spark's ``concat`` would return NULL)."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def dashboard_symbols(volatility: DataFrame) -> DataFrame:
    """Distinct symbols of the volatility table, sorted (the symbol picker)."""
    return volatility.select("symbol").distinct().orderBy("symbol")


def volatility_series(
    volatility: DataFrame,
    symbols: Iterable[str] | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """``(time, symbol, stddev_price)`` for the chosen symbols, by window;
    optional ``[start, end)`` on ``window_start`` (naive datetimes are UTC)."""
    return (
        _series(volatility, symbols, start, end)
        .select(F.col("window_start").alias("time"), "symbol", "stddev_price")
        .orderBy("time")
    )


def spread_series(
    spread: DataFrame,
    symbols: Iterable[str] | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """``(time, symbol, avg_spread)`` for the chosen symbols, by window."""
    return (
        _series(spread, symbols, start, end)
        .select(F.col("window_start").alias("time"), "symbol", "avg_spread")
        .orderBy("time")
    )


def liquidity_series(
    liquidity: DataFrame,
    symbols: Iterable[str] | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """``(time, metric = "<symbol> - <side>", avg_depth_quantity)`` for the
    chosen symbols, by window."""
    return (
        _series(liquidity, symbols, start, end)
        .select(
            F.col("window_start").alias("time"),
            _pg_concat(F.col("symbol"), F.lit(" - "), F.col("side")).alias("metric"),
            "avg_depth_quantity",
        )
        .orderBy("time")
    )
