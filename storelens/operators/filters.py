"""Time filters, lookups and capped lists (P-07..P-12, L-02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _ts(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")


def last_days(df: DataFrame, ts_col: str, days: int, as_of) -> DataFrame:
    """P-07: rows with ``ts >= as_of - INTERVAL days DAY``.

    A plain range predicate on the raw column, so it becomes a parquet
    pushed filter and a partition filter when the table is partitioned
    on the day of ``ts_col``.
    """
    return df.where(F.col(ts_col) >= _ts(as_of) - F.make_interval(days=F.lit(days)))


def on_day(df: DataFrame, col: str, day: str) -> DataFrame:
    """P-08: rows of one calendar day, written as a half-open range on the
    column so pruning still applies (``to_date(ts) = day`` would not push)."""
    start = F.lit(day).cast("date")
    dtype = dict(df.dtypes)[col]
    if dtype == "date":
        return df.where(F.col(col) == start)
    lo = start.cast(dtype)
    return df.where((F.col(col) >= lo) & (F.col(col) < F.date_add(start, 1).cast(dtype)))


def lookup_purchase(df: DataFrame, **keys) -> DataFrame:
    """P-09: equality lookup by any of transaction_id / customer_id /
    store_id / payment_method (all given keys must match)."""
    if not keys:
        raise ValueError("lookup_purchase needs at least one key")
    cond = None
    for k, v in keys.items():
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    return df.where(cond)


CHECKOUT_COLUMNS = ("transaction_id", "event_timestamp", "store_id", "pos_terminal_id",
                    "cashier_id", "payment_method", "total_amount_usd")


def checkout_log(df: DataFrame, cashier_id=None, limit: int | None = 10,
                 days: int | None = None, as_of=None) -> DataFrame:
    """P-10/L-02: one cashier's checkout rows, 7 columns, time ascending,
    transaction id as tie-break, first ``limit`` rows (the limit is the
    feature). ``cashier_id`` may be a literal or a Column."""
    out = df
    if cashier_id is not None:
        out = out.where(F.col("cashier_id") == (cashier_id if isinstance(cashier_id, Column)
                                                else F.lit(cashier_id)))
    if days is not None:
        out = last_days(out, "event_timestamp", days, as_of)
    out = out.select(*CHECKOUT_COLUMNS).orderBy(F.col("event_timestamp").asc_nulls_last(),
                                                F.col("transaction_id").asc_nulls_last())
    return out.limit(limit) if limit else out


def bound_sql(spark: SparkSession, sql: str, **params) -> DataFrame:
    """P-11: user values travel as named parameter markers (``:name``),
    never spliced into the SQL text. DataFrame arguments are referenced
    as ``{name}`` and planned as sub-queries (no temp view, no collect)."""
    frames = {k: v for k, v in params.items() if isinstance(v, DataFrame)}
    values = {k: v for k, v in params.items() if not isinstance(v, DataFrame)}
    return spark.sql(sql, args=values, **frames)


def cap_rows(df: DataFrame, n: int = 100) -> DataFrame:
    """P-12: row cap on a returned answer."""
    return df.limit(n)
