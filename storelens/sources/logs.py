"""Day-partitioned log tables and schema-evolving appends (S-04, S-05, S-08, S-09)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_logs(df: DataFrame, path: str, ts_col: str = "timestamp", mode: str = "append", batch_id: int | None = None) -> None:
    """S-04: write log rows partitioned by the UTC day of ``ts_col``.

    Rows are rebalanced by day first: each task writes few files per day
    folder, and a day too large for one task is split between several. A later read with
    a filter on ``log_date`` prunes folders. With ``batch_id`` the rows of a micro-batch go to a
    folder of their own below each day, and a replay of the batch replaces just those."""
    out = df.withColumn("log_date", F.to_date(ts_col)).hint("rebalance", "log_date")
    if batch_id is None:
        out.write.mode(mode).partitionBy("log_date").parquet(path)
    else:
        (out.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("log_date", "batch").parquet(path))


def read_logs(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Read the day-partitioned table, pruning to [start, end] days."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    if start is not None:
        df = df.where(F.col("log_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("log_date") <= F.lit(end).cast("date"))
    return df


def append_evolving(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """S-05: append rows whose schema may have gained columns; older files
    keep their columns and read back with the new ones as null."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """S-05: read all appends with the union of their schemas."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def export_results(df: DataFrame, path: str, run_date: str, mode: str = "append") -> None:
    """S-08: persist scan results (profiles, quality rules) to a governance
    table partitioned by run date."""
    (df.withColumn("run_date", F.lit(run_date).cast("date"))
       .write.mode(mode).partitionBy("run_date").parquet(path))


def write_chunks(df: DataFrame, path: str, buckets: int | None = None,
                 table: str | None = None) -> None:
    """S-09: persist the chunk/embedding table. With ``table`` and
    ``buckets`` it is saved bucketed and sorted by document, so later
    neighbour joins on the document need no shuffle."""
    if table and buckets:
        (df.write.mode("overwrite").option("path", path).bucketBy(buckets, "document_filename")
           .sortBy("document_filename", "chunk_index").saveAsTable(table))
    else:
        df.repartition("document_filename").write.mode("overwrite").parquet(path)
