"""Size checks behind every explicit broadcast (G-10 uses the same stats)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a block of vectors that was raised to send fewer copies, and copies of a side at least.
SPAN_BYTES, MIN_COPIES = 64 << 20, 16


def plan_size_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate of ``df`` (no job is run)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def scan_bytes(df: DataFrame) -> int:
    """Bytes the file scans of ``df``'s plan would read, known before any
    job: for each scan, the files left after partition pruning, scaled by
    the share of the row width taken by the columns it reads. Plans
    without file scans fall back to ``plan_size_bytes``."""
    total, seen = 0, False
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves().iterator()
    while leaves.hasNext():
        node = leaves.next()
        if not node.nodeName().startswith(("Scan ", "BatchScan")):
            continue
        try:
            files = int(node.selectedPartitions().totalFileSize())
            read_w = int(node.requiredSchema().defaultSize())
            full_w = int(node.relation().dataSchema().defaultSize())
        except Exception:  # a scan that does not tell its files: the plan's own estimate counts for it
            total += plan_size_bytes(df)
            continue
        seen = True
        total += files if full_w <= 0 else (files * min(read_w, full_w)) // full_w
    return total if seen else plan_size_bytes(df)


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000,
                       max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Broadcast ``df`` only when it is measured to be small: one aggregate
    over the (already filtered) side gives its rows and the bytes of their
    text form. Plan estimates are not trusted, as they can be far too low
    behind a generator or a selective filter. A side over either bound is
    returned unchanged and joins by shuffle.
    """
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width + 16 * len(df.columns)), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


# Plan nodes above a scan that run inside its tasks: no exchange, hence no job when partitions are counted.
_NARROW = ("Scan ", "FileScan", "Project", "Filter", "Generate", "ColumnarToRow", "MapInPandas", "MapInArrow")


def is_narrow(df: DataFrame) -> bool:
    """Whether ``df`` is scans with row-wise steps above them. Reads the
    physical plan before exchanges are added and runs nothing."""
    todo = [df._jdf.queryExecution().sparkPlan()]
    while todo:
        node = todo.pop()
        if not node.nodeName().startswith(_NARROW):
            return False
        it = node.children().iterator()
        while it.hasNext():
            todo.append(it.next())
    return True


def spread(df: DataFrame, min_partitions: int | None = None, min_bytes: int = 0) -> DataFrame:
    """Round-robin repartition ``df`` only when it has fewer partitions than
    the cluster's default parallelism (a single large file with one row
    group scans as one task) and, with ``min_bytes``, only when the plan
    estimate says it is big enough for one task to be the bottleneck.
    Well-partitioned inputs pass through unchanged, so no shuffle is added
    at scale. A plan with an exchange (a join, an aggregate) also passes
    through: counting its partitions would run its shuffle stages. Planning
    only, no job."""
    if (min_bytes and plan_size_bytes(df) < min_bytes) or not is_narrow(df):
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.rdd().getNumPartitions() < target:
        return df.repartition(target)
    return df


def span_rows(rows: int, dim: int, copies: int, least: int) -> int:
    """Rows of a side that one group holds: ``least``, or more where a side of so many ``rows`` would then be
    sent out more than ``copies`` times, as far as a matrix of ``SPAN_BYTES`` goes."""
    return max(least, min(math.ceil(rows / copies), SPAN_BYTES // (8 * max(dim, 1))))


def span_copies(spark: SparkSession) -> int:
    """Blocks of a side that give every core several groups of two blocks."""
    return max(MIN_COPIES, math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism)))
