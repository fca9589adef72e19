"""File sources and sinks: NDJSON messages, day partitions, evolving appends."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from storelens.operators import telemetry as tel
from storelens.plans import fixtures as fx
from storelens.sources import logs as lg
from storelens.sources.messages import TooManyBadRecords, read_messages
from storelens.sources.tables import Tables, read_federated, read_table
from tests.conftest import SF001


def _write_message_files(spark, t, root):
    """One NDJSON file per message file name, plus one malformed line."""
    comp = fx.completions(t).collect()  # sf0.001: a few hundred rows
    by_file = {}
    import base64
    import json
    for r in comp:
        parts = [dict(p.asDict(), data=base64.b64encode(p["data"]).decode() if p["data"] else None)
                 for p in r["parts"]]
        by_file.setdefault(r["file_name"], []).append(
            json.dumps({"parts": parts, "role": r["role"], "index": r["index"], "extra_field": 1}))
    for name, lines in by_file.items():
        p = root + name
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
    with open(os.path.join(root, "logs/completions/bad.jsonl"), "w") as f:
        f.write("{not json\n")
    return len(comp)


def test_read_messages_and_mart_from_files(spark):
    t = Tables(spark, SF001)
    root = tempfile.mkdtemp(prefix="storelens-msg-")
    n = _write_message_files(spark, t, root)
    msgs = read_messages(spark, root + "/logs/completions/", max_bad=1000)
    assert msgs.count() == n
    # paths become the log's ref form after stripping the folder prefix
    msgs = msgs.withColumn("file_name", F.regexp_replace("file_name", "^" + root, ""))
    from_files = tel.completions_mart(fx.inference_logs(t), msgs)
    in_memory = tel.completions_mart(fx.inference_logs(t), fx.completions(t))
    assert sorted(from_files.collect()) == sorted(in_memory.collect())
    with pytest.raises(TooManyBadRecords):
        read_messages(spark, root + "/logs/completions/", max_bad=0)


def test_day_partitioned_logs_prune(spark):
    t = Tables(spark, SF001)
    path = tempfile.mkdtemp(prefix="storelens-logs-") + "/logs"
    logs = tel.extract_refs(fx.inference_logs(t))
    lg.write_logs(logs, path)
    back = lg.read_logs(spark, path, "2026-01-01", "2026-01-01")
    assert back.count() == logs.count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "log_date" in plan
    assert lg.read_logs(spark, path, "2026-01-02").count() == 0


def test_evolving_append(spark):
    path = tempfile.mkdtemp(prefix="storelens-evo-") + "/t"
    a = spark.range(3).withColumn("x", F.col("id") * 2)
    b = spark.range(3, 5).withColumn("x", F.col("id") * 2).withColumn("y", F.lit("new"))
    lg.append_evolving(a, path)
    lg.append_evolving(b, path)
    rows = {r["id"]: r for r in lg.read_evolving(spark, path).collect()}
    assert rows[0]["y"] is None and rows[4]["y"] == "new" and len(rows) == 5


def test_declared_schema_and_federated_pushdown(spark):
    df = read_table(spark, SF001, "orders")
    assert dict(df.dtypes)["o_orderdate"] == "timestamp_ntz"
    fed = read_federated(spark, SF001 + "/orders.parquet").where(F.col("o_custkey") == 7).select("o_orderkey")
    plan = fed._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_custkey" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_write_chunks_and_cap(spark):
    from storelens.operators.chunking import manual_chunks
    from storelens.operators.filters import cap_rows
    t = Tables(spark, SF001)
    c = manual_chunks(t.documents)
    path = tempfile.mkdtemp(prefix="storelens-ch-") + "/chunks"
    lg.write_chunks(c, path)
    assert spark.read.parquet(path).count() == c.count()
    assert cap_rows(c, 100).count() == 100
