"""The mart as a stream: bounded state, replayed batches; values inside tool calls."""

import tempfile

from pyspark.sql import functions as F

from storelens.operators import telemetry as tel
from storelens.plans import fixtures as fx
from storelens.sources.tables import Tables
from storelens.streaming import jobs as S
from storelens.streaming import mart as live
from tests.conftest import SF001


def _inputs(spark):
    t = Tables(spark, SF001)
    logs = fx.inference_logs(t).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    turn = F.regexp_extract("file_name", r"/(\d+)_", 1).cast("long") % 1000000
    msgs = fx.completions(t).withColumn("written_at", F.timestamp_add("MINUTE", turn, F.lit(fx.TELEMETRY_BASE).cast("timestamp")))
    return logs, msgs


def test_state_ends_behind_the_watermark_and_the_mart_equals_the_batch(spark):
    logs, msgs = _inputs(spark)
    base = tempfile.mkdtemp(prefix="storelens-mart-")
    hours = 3
    for h in range(hours):                                    # the same traffic, three hours apart, each under ids of its own
        own = logs.withColumn("timestamp", F.timestamp_add("HOUR", F.lit(3 * h), "timestamp")).withColumn(
            "trace", F.concat("trace", F.lit(f"-{h}"))).withColumn("labels", F.col("labels").withField(
                "gen_ai_conversation_id", F.concat("labels.gen_ai_conversation_id", F.lit(f"-{h}"))))
        for c in ("gen_ai_input_messages_ref", "gen_ai_output_messages_ref"):
            own = own.withColumn("labels", F.col("labels").withField(c, F.replace(F.col(f"labels.{c}"), F.lit("/logs/"), F.lit(f"/logs{h}/"))))
        own.coalesce(1).write.mode("append").parquet(f"{base}/logs")
        (msgs.withColumn("written_at", F.timestamp_add("HOUR", F.lit(3 * h), "written_at"))
         .withColumn("file_name", F.replace("file_name", F.lit("/logs/"), F.lit(f"/logs{h}/")))
         .coalesce(1).write.mode("append").parquet(f"{base}/messages"))

    def folder(name):
        schema = spark.read.parquet(f"{base}/{name}").schema
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/{name}")

    S.use_rocksdb(spark)
    q = (live.stream_parts(folder("logs"), folder("messages")).writeStream.foreachBatch(live.keep_parts(f"{base}/t", 2))
         .option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start())
    q.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert held[-1] < max(held) and max(held) < 3 * held[0]   # older hours leave the state

    whole = tel.completions_mart(spark.read.parquet(f"{base}/logs"), spark.read.parquet(f"{base}/messages"))
    got = live.read_mart(spark, f"{base}/t")
    assert got.count() == whole.count() > 0
    assert got.exceptAll(whole).isEmpty()


def test_replayed_batches_and_any_order_of_batches(spark):
    logs, msgs = _inputs(spark)
    flat = tel.flatten_parts(tel.join_messages(tel.unpivot_refs(tel.extract_refs(logs)), msgs)).cache()
    whole = tel.completions_mart(logs, msgs)
    path = tempfile.mkdtemp(prefix="storelens-parts-") + "/t"
    keep, parts = live.keep_parts(path, fold_every=3), 5
    for k in range(parts):
        some = flat.where(F.pmod(F.hash("insert_id", "part_idx"), F.lit(parts)) == parts - 1 - k)
        keep(some, k)
        keep(some, k)                                         # replayed
    got = live.read_mart(spark, path)
    assert got.count() == whole.count() and got.exceptAll(whole).isEmpty()
    flat.unpersist()


def test_values_inside_tool_calls(spark):
    rows = [(1, '{"a":{"b":[1,{"c":"x"}]},"d":null}', None), (2, "{bad", "7"), (3, None, None), (4, "{}", "[]"),
            (5, '{"a":{"b":{"c":{"d":{"e":1}}}}}', '"text"'), (6, "", None)]
    flat = spark.createDataFrame(rows, "path long, tool_args string, tool_response string").withColumnRenamed("path", "id")
    got = {(r.id, r.tool_side, r.path, r.kind, r.value, r.malformed) for r in tel.tool_values(flat).collect()}
    assert got == {
        (1, "arguments", "$.a.b[0]", "BIGINT", "1", False), (1, "arguments", "$.a.b[1].c", "STRING", "x", False),
        (1, "arguments", "$.d", "VOID", None, False), (2, "arguments", None, None, None, True), (2, "response", "$", "BIGINT", "7", False),
        (4, "arguments", "$", "OBJECT", "{}", False), (4, "response", "$", "ARRAY", "[]", False),
        (5, "arguments", "$.a.b.c.d", "OBJECT", '{"e":1}', False), (5, "response", "$", "STRING", "text", False),
        (6, "arguments", None, None, None, True)}
