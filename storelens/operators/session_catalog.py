"""S-07 on the session's own catalogue: tables registered with a comment, contract
values as table properties, row counts from the catalogue's statistics.

Reading the snapshot touches metadata alone: no table is scanned. Statistics are
collected once, when a table is registered or refreshed (``ANALYZE TABLE``), and hold until
then; a table without them has a null row count.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from storelens.operators.governance import CATALOG_SCHEMA

#: Table properties that hold contract values.
PREFIX = "contract."
_FIELDS = ("table_type", "pii_included", "data_owner_team")


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def _text(value) -> str:
    plain = str(value).lower() if isinstance(value, bool) else str(value)
    return "'" + plain.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession, database: str, name: str, path: str, description: str | None = None,
             contract: dict | None = None, source: str = "parquet") -> None:
    """Register the files at ``path`` as ``database.name`` with its comment and contract, and collect its row count."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    table = _quoted(database, name)
    spark.catalog.createTable(table, path=path, source=source, schema=spark.read.format(source).load(path).schema,
                              description=description or "")
    if contract:
        values = ", ".join(f"{_text(PREFIX + k)} = {_text(v)}" for k, v in contract.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({values})")
    refresh(spark, database, name)


def refresh(spark: SparkSession, database: str, name: str) -> None:
    """Collect the table's statistics again."""
    spark.sql(f"ANALYZE TABLE {_quoted(database, name)} COMPUTE STATISTICS")


def session_snapshot(spark: SparkSession, database: str) -> DataFrame:
    """One row per column of the database's tables, as ``catalog_snapshot`` gives them; its rows are
    bounded by the schemas. A database without tables has none."""
    rows = []
    for t in spark.catalog.listTables(_quoted(database)):
        if t.isTemporary:
            continue
        said = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(database, t.name)} AS JSON").first()[0])
        held = {k: said.get("table_properties", {}).get(PREFIX + k) for k in _FIELDS}
        pii = None if held["pii_included"] is None else held["pii_included"] == "true"
        count = said.get("statistics", {}).get("num_rows")
        for i, f in enumerate(spark.table(_quoted(database, t.name)).schema.fields):
            rows.append((t.name, None if count is None else int(count), i, f.name, f.dataType.simpleString(), f.nullable,
                         said.get("comment") or None, held["table_type"], pii, held["data_owner_team"]))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)
