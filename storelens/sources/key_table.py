"""Key-value tables with column families on range-clustered files (S-06).

A row is a binary key and, for each family, a map of its cells; a cell without a
value is absent. Files are range-partitioned and sorted by key, so a
prefix becomes a key range that file and row-group statistics prune: a read
opens the files around the prefix, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_GROUP_BYTES = 16 << 20


def as_cells(df: DataFrame, key: Column, families: dict[str, list[str]]) -> DataFrame:
    """(row_key binary, one map<string, string> per family): columns become cells named after them;
    null columns become no cell, so a family may be empty but is never null. Rows with a
    null key are left out, as a key-value table cannot hold them."""
    def family(names: list[str]) -> Column:
        cells = F.array(*[F.struct(F.lit(n).alias("k"), F.col(f"`{n}`").cast("string").alias("v")) for n in names])
        return F.map_from_entries(F.filter(cells, lambda c: c["v"].isNotNull()))
    return (df.select(F.encode(key, "UTF-8").alias("row_key"), *[family(n).alias(f) for f, n in families.items()])
              .where(F.col("row_key").isNotNull()))


def write_key_table(df: DataFrame, path: str, key_col: str = "row_key", mode: str = "overwrite",
                    row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write ``df`` clustered by key: one range shuffle, files sorted by key, row groups small enough for
    their statistics to be narrow. Appends add files with ranges of their own, which
    reads prune alike."""
    (df.repartitionByRange(key_col).sortWithinPartitions(key_col)
       .write.mode(mode).option("parquet.block.size", row_group_bytes).parquet(path))


def next_prefix(prefix: bytes) -> bytes | None:
    """The smallest key above all keys that start with ``prefix``; None if there is none (no byte
    below 0xFF)."""
    head = prefix.rstrip(b"\xff")
    return head[:-1] + bytes([head[-1] + 1]) if head else None


def starts_with(key_col: str, prefix: bytes) -> Column:
    """Binary keys that start with the literal ``prefix``, as a key range that reaches the parquet reader
    (``startswith`` on bytes or on a decoded key does not). The empty prefix fits every key."""
    k, end = F.col(key_col), next_prefix(prefix)
    low = k >= F.lit(bytearray(prefix))
    return low if end is None else low & (k < F.lit(bytearray(end)))


def read_key_prefix(spark: SparkSession, path: str, prefix: str, limit: int | None = 5, key_col: str = "row_key") -> DataFrame:
    """S-06: the rows under a literal key prefix, in key order, the first ``limit`` (all without one), the
    key as text."""
    out = spark.read.parquet(path).where(starts_with(key_col, prefix.encode())).orderBy(key_col)
    if limit is not None:
        out = out.limit(limit)
    return out.withColumn(key_col, F.col(key_col).cast("string"))
