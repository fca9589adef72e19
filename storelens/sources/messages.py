"""S-03: NDJSON message-file scan with explicit schema and a bad-record limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.operators.telemetry import MESSAGE_SCHEMA, decode_path, normalise_path

CORRUPT = "_corrupt_record"


class TooManyBadRecords(RuntimeError):
    pass


def read_messages(spark: SparkSession, path: str, max_bad: int = 1000, schema: T.StructType = MESSAGE_SCHEMA,
                  check: bool = True, file_column: str | None = None) -> DataFrame:
    """Read message files: declared schema (unknown fields ignored),
    malformed lines kept aside in ``_corrupt_record`` (PERMISSIVE), the
    message file's uri exposed as ``file_name`` (see ``normalise_path``).

    ``file_column`` names a field of the lines that holds the uri of the
    message file they belong to; many message files then lie together in few large
    files, which spares a listing of one folder or object per model call. Without it the uri
    is that of the file scanned.

    With ``check`` the bad lines are counted in one distributed aggregate (only the count
    reaches the driver, nothing is kept) and the read fails when there
    are more than ``max_bad``, as an external table with that limit
    would; good rows are returned either way.
    """
    extra = [T.StructField(file_column, T.StringType())] if file_column else []
    s = T.StructType(schema.fields + extra + [T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(s).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    uri = F.col(file_column) if file_column else decode_path(F.col("_metadata.file_path"))
    raw = raw.withColumn("file_name", normalise_path(uri))
    if check:
        # a data column is named beside the corrupt record, as Spark refuses a scan of that alone
        bad = raw.agg(F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"), F.count("role")).first()["bad"]
        if bad > max_bad:
            raise TooManyBadRecords(f"{bad} malformed records in {path} (limit {max_bad})")
    # a bad line's data columns are null; naming one lets a caller count without reading others
    good = F.when(F.col(CORRUPT).isNull(), True).otherwise(F.length("role") < 0)
    return raw.where(good).select("file_name", *schema.fieldNames())


def write_messages(df: DataFrame, path: str) -> None:
    """Write (file_name, role, index, parts) rows as NDJSON, one file per task; each line names
    its message file, as ``read_messages(..., file_column="file_name")`` expects."""
    df.write.mode("overwrite").json(path)
