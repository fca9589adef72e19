"""The message mart kept by a stream (J-05, M-03, M-04, W-01, W-02, continuously).

Two streams, log records and message files, meet in a stream-stream join on
the file's path. Both carry a watermark, and a message must have been
written within ``span`` of the call that logs it, so the state of either side
ends ``span`` and the delays after its event time; what arrives later than its
``delay`` is dropped, as with any watermark.

Every micro-batch keeps its latest copy of each part within a trace (W-01); the
latest of the batches' latest copies is the latest of all, in any order of arrival.
W-02 is not applied while writing: a copy that W-01 drops later must not have displaced another
trace's. It runs on read, over W-01's rows. A batch writes its own folder (a replay
overwrites it); every ``fold_every``-th batch also folds all before it.

Defined cases: a record without references, or whose file never comes, gives no rows; a
null event time joins nothing; a null path joins nothing; a repeated record or message is one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators import telemetry as tel
from storelens.streaming.jobs import _current


def stream_parts(logs: DataFrame, messages: DataFrame, delay: str = "10 minutes", span: str = "10 minutes") -> DataFrame:
    """Flattened message parts of two streams: log records with ``timestamp`` and messages
    with ``written_at``, both session-zone timestamps."""
    refs = tel.unpivot_refs(tel.extract_refs(logs.withWatermark("timestamp", delay)))
    refs = refs.withColumn("_path", tel.normalise_path(F.col("messages_ref_uri")))
    m = messages.withWatermark("written_at", delay).select(
        tel.normalise_path(F.col("file_name")).alias("_file"), "role", "parts", F.col("index").alias("message_idx"), "written_at")
    near = F.expr(f"written_at BETWEEN timestamp - INTERVAL {span} AND timestamp + INTERVAL {span}")
    joined = refs.join(m, (F.col("_path") == F.col("_file")) & near).drop("_path", "_file", "written_at")
    return tel.flatten_parts(joined.withColumn("api_call_id", tel.api_call_id(F.col("messages_ref_uri"))))


def keep_parts(path: str, fold_every: int = 10):
    """``foreachBatch`` function that keeps each batch's W-01 rows below ``path``."""
    def run(df: DataFrame, batch_id: int) -> None:
        new = tel.dedup_within_trace(df)
        full = (batch_id + 1) % fold_every == 0
        if full and batch_id:
            before = _current(df.sparkSession, path, batch_id).drop("batch")
            new = tel.dedup_within_trace(before.unionByName(new))
        new.write.mode("overwrite").parquet(f"{path}/full={int(full)}/batch={batch_id}")
    return run


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The mart of all batches so far, equal to ``completions_mart`` over what has arrived."""
    return tel.settled(_current(spark, path).drop("batch"))
