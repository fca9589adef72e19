"""Row isolation and key-prefix reads (J-11, S-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.operators.sizing import broadcast_if_small
from storelens.sources.key_table import starts_with


def apply_row_policy(df: DataFrame, entitlements: DataFrame, user: str,
                     user_col: str = "user", key: str = "store_id") -> DataFrame:
    """J-11: rows of ``df`` whose ``key`` the user is entitled to.

    A left-semi join: each row is kept at most once, whatever the number
    of matching grants. The user's grants are broadcast only after their
    size is checked; otherwise the semi join shuffles."""
    grants = entitlements.where(F.col(user_col) == F.lit(user)).select(F.col(key).alias("_grant")).distinct()
    grants = broadcast_if_small(grants, max_rows=1_000_000)
    return df.join(grants, F.col(key) == F.col("_grant"), "left_semi")


def read_prefix(df: DataFrame, prefix: str, limit: int = 5, key_col: str = "row_key") -> DataFrame:
    """S-06: rows whose key (bytes or string, read as UTF-8) starts with
    the *literal* prefix, in key order, first ``limit``. ``startswith`` is
    literal, so ``_`` in ``STORE_048`` is not a wildcard as in LIKE; on binary
    keys the prefix is a range of bytes. Either form reaches the scan."""
    if dict(df.dtypes)[key_col] == "binary":
        out = df.where(starts_with(key_col, prefix.encode()))
        return out.orderBy(key_col).limit(limit).withColumn(key_col, F.col(key_col).cast("string"))
    return df.where(F.col(key_col).startswith(F.lit(prefix))).orderBy(key_col).limit(limit)


def prefix_heads(df: DataFrame, prefix_of, limit: int = 5, key_col: str = "row_key") -> DataFrame:
    """S-06 for every prefix at once: the first ``limit`` keys of each prefix
    group (``prefix_of`` maps a key Column to its prefix). A ranked window
    with a group limit, so a hot prefix ships at most ``limit`` rows per
    map task."""
    k = F.col(key_col)
    x = df.withColumn("key_prefix", prefix_of(k))
    w = Window.partitionBy("key_prefix").orderBy(k)
    return x.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")
