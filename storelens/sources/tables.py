"""S-01 / S-02: scans of the declared warehouse tables.

Schemas are fixed and declared, so a scan never infers (no footer
sampling job) and a drifted file fails loudly instead of silently
changing types downstream.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _S, _D = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()
_TS = T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Declared inventory of the input tables (column, type).
SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I),
                        ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
    "documents": _schema(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S),
                         ("n_chars", _L)),
    "embeddings": _schema(("vec_id", _L), ("embedding", T.ArrayType(T.FloatType())),
                          ("label", _I)),
    "pages": _schema(("page_id", _L), ("url", _S), ("html", _S)),
    "benchmark": _schema(("item_id", _L), ("text", _S)),
    "labels": _schema(("doc_id", _L), ("quality", _I), ("toxic", _I)),
    "conversations": _schema(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S)),
}

TABLE_NAMES = tuple(SCHEMAS)

# Scans estimated below this size stay as they are, whatever their split count.
SPREAD_MIN_BYTES = 8 * 1024 * 1024


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """S-01: scan one declared table under ``root`` (``{root}/{name}.parquet``)."""
    if name not in SCHEMAS:
        raise KeyError(f"unknown table {name!r}; declared: {', '.join(TABLE_NAMES)}")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_federated(spark: SparkSession, uri: str, schema: T.StructType | None = None) -> DataFrame:
    """S-02: scan an external object-store parquet copy (``s3a://``, ``gs://``,
    ``abfss://`` or a local path). Filters and projections written against
    the result reach the parquet reader as ``PushedFilters`` / ``ReadSchema``.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(uri)


class Tables:
    """Lazy accessor for the declared tables of one data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            # A large table stored as few row groups scans in fewer tasks
            # than there are cores; such a scan is spread right after the
            # read. Tables with enough splits (any table at cluster scale)
            # and small dimensions are returned as scanned.
            from storelens.operators.sizing import spread
            df = spread(read_table(self.spark, self.root, name), min_bytes=SPREAD_MIN_BYTES)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)

    @cached_property
    def names(self) -> tuple[str, ...]:
        return TABLE_NAMES
