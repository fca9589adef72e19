"""Registered streaming queries (F4, telemetry routing, feedback).

Each runs a Structured Streaming job over everything available
(``availableNow``) from files Spark derived from the input tables, into
an idempotent per-batch sink under the shared checkpoint folder, and
returns the sink read back as a DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from storelens.plans import fixtures as fx
from storelens.plans.oracle import exact_ratio, with_views
from storelens.plans.q_retail import ALERT_EVENTS, TRAILING_SQL
from storelens.plans.q_telemetry import LOGS_SQL, MART_SQL
from storelens.plans.q_governance import FAILING_SQL, QUALITY_SQL
from storelens.plans.registry import query
from storelens.session import scratch_path
from storelens.streaming import jobs as S
from storelens.streaming import mart as live
from storelens.streaming import quality as checked

PROJECT = "retail-ops"
SERVICE = "operations-agent"


def _scratch(t, name: str) -> str:
    return scratch_path(t.spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")


def _trailing(t):
    events = S.stream_events(t.spark, t.root)
    return S.stream_trailing(S.alerts_stream(events))


@query("stream_trailing_metrics", "T-01 T-02 A-04",
       with_views(TRAILING_SQL, extra={"alert_events": ALERT_EVENTS}))
def stream_trailing_metrics(t):
    """Per-event trailing-hour cashier metrics computed by a stateful stream."""
    base = _scratch(t, "trailing")
    S.run_available(_trailing(t), S.parquet_sink(f"{base}/out"), f"{base}/ckpt")
    return t.spark.read.parquet(f"{base}/out").drop("batch")


LATEST_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key_prefix ORDER BY event_ts DESC, row_key DESC) AS rn FROM (
    SELECT *, regexp_extract(row_key, '^([^#]*#[^#]*)', 1) AS row_key_prefix,
      CASE WHEN override_rate_pct >= 50.0 THEN 'flagged' WHEN override_rate_pct >= 25.0 THEN 'review'
        ELSE 'clear' END AS audit_status
    FROM ({TRAILING_SQL})))
WHERE rn = 1"""


@query("stream_latest_audit", "T-04 T-05 S-06", with_views(LATEST_SQL, extra={"alert_events": ALERT_EVENTS}))
def stream_latest_audit(t):
    """Latest audit state per STORE#CASHIER key, kept by a streaming upsert."""
    base = _scratch(t, "latest")
    m = S.audit_status(_trailing(t)).withColumn(
        "row_key_prefix", F.regexp_extract("row_key", r"^([^#]*#[^#]*)", 1))
    S.run_available(m, S.upsert_latest(f"{base}/table"), f"{base}/ckpt")
    return S.read_latest(t.spark, f"{base}/table")


SLIDING_SQL = f"""
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, cashier_id, count(*) AS txn_count,
  count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse') AS override_count,
  count(*) FILTER (WHERE alert_type = 'purchase') AS promo_count,
  {exact_ratio("count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse')", 'count(*)', 2, 100)} AS override_rate_pct,
  sum(discount_usd) AS total_discount_usd
FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, alert_ts) - k * INTERVAL 5 MINUTE AS window_start
      FROM alert_events, range(0, 12) AS r(k))
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
GROUP BY window_start, cashier_id"""


@query("stream_sliding_windows", "T-03 T-01", with_views(SLIDING_SQL, extra={"alert_events": ALERT_EVENTS}))
def stream_sliding_windows(t):
    """1-hour windows sliding by 5 minutes per cashier, closed by the watermark."""
    base = _scratch(t, "sliding")
    events = S.stream_events(t.spark, t.root)
    S.run_available(S.stream_sliding(S.alerts_stream(events)), S.parquet_sink(f"{base}/out"), f"{base}/ckpt")
    return t.spark.read.parquet(f"{base}/out").drop("batch")


def _log_records(t):
    """Inference log records and feedback records in one log stream."""
    logs = fx.inference_logs(t)
    refs = F.struct(
        F.col("labels.gen_ai_conversation_id").alias("gen_ai_conversation_id"),
        F.concat(F.lit(f"gs://{PROJECT}-logs"), F.col("labels.gen_ai_input_messages_ref")).alias("gen_ai_input_messages_ref"),
        F.concat(F.lit(f"gs://{PROJECT}-logs"), F.col("labels.gen_ai_output_messages_ref")).alias("gen_ai_output_messages_ref"))
    null_fb = F.lit(None).cast("struct<log_type:string,service_name:string,score:double,text:string>")
    genai = logs.select(
        "insertId", "timestamp",
        F.lit(f"projects/{PROJECT}/logs/gen_ai.client.inference.operation.details").alias("log_name"),
        refs.alias("labels"), null_fb.alias("json_payload"))
    conv = t.conversations.where(F.col("role") == "assistant")
    fb = conv.select(
        F.concat(F.lit("fb-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("insertId"),
        F.timestamp_add("MINUTE", F.col("turn"), F.lit(fx.TELEMETRY_BASE).cast("timestamp_ntz")).alias("timestamp"),
        F.lit(f"projects/{PROJECT}/logs/feedback").alias("log_name"),
        F.lit(None).cast("struct<gen_ai_conversation_id:string,gen_ai_input_messages_ref:string,"
                         "gen_ai_output_messages_ref:string>").alias("labels"),
        F.struct(F.lit("feedback").alias("log_type"),
                 F.when(F.col("conv_id") % 4 == 0, F.lit("other-service")).otherwise(F.lit(SERVICE)).alias("service_name"),
                 (F.length("text") % 5 + 1).cast("double").alias("score"),
                 F.col("text").alias("text")).alias("json_payload"))
    return genai.unionByName(fb)


ROUTED_SQL = f"""
SELECT 'genai' AS route, insert_id AS insertId, timestamp, CAST(timestamp AS DATE) AS log_date,
  'projects/{PROJECT}/logs/gen_ai.client.inference.operation.details' AS log_name
FROM logs
WHERE regexp_matches(coalesce('gs://{PROJECT}-logs' || input_ref, ''), '.*{PROJECT}.*')
   OR regexp_matches(coalesce('gs://{PROJECT}-logs' || output_ref, ''), '.*{PROJECT}.*')
UNION ALL
SELECT 'feedback', 'fb-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR),
  TIMESTAMP '{fx.TELEMETRY_BASE}' + turn * INTERVAL 1 MINUTE,
  CAST(TIMESTAMP '{fx.TELEMETRY_BASE}' + turn * INTERVAL 1 MINUTE AS DATE), 'projects/{PROJECT}/logs/feedback'
FROM conversations WHERE role = 'assistant' AND conv_id % 4 <> 0"""


@query("stream_routed_logs", "T-06 S-04", with_views(ROUTED_SQL, "log_refs", extra={"logs": LOGS_SQL}))
def stream_routed_logs(t):
    """Log stream routed to the inference-log and feedback tables (day partitions)."""
    base = _scratch(t, "routes")
    recs = _log_records(t)
    recs.write.mode("overwrite").parquet(f"{base}/source")
    stream = t.spark.readStream.schema(recs.schema).parquet(f"{base}/source")
    routes = {"genai": (S.genai_route(PROJECT, PROJECT), f"{base}/genai"),
              "feedback": (S.feedback_route(SERVICE), f"{base}/feedback")}
    S.run_available(stream, S.route_logs(routes), f"{base}/ckpt")
    g = t.spark.read.parquet(f"{base}/genai").withColumn("route", F.lit("genai"))
    f = t.spark.read.parquet(f"{base}/feedback").withColumn("route", F.lit("feedback"))
    return g.unionByName(f).select("route", "insertId", "timestamp", "log_date", "log_name")


def _late_files(t, base: str, files: int = 4) -> None:
    """Events in ``files`` files that each cover a part of the time line, in arrival order; an event arrives up
    to ``LATE_US`` late (by its id), so many come in the file after their time."""
    ev = t.events
    lo, hi = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("lo", "hi"))
    ends = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).select(lo.alias("lo"), hi.alias("hi")).first()
    step = (ends["hi"] - ends["lo"]) // files + 1
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.col("event_id") * 7919, F.lit(LATE_US // 10**6)) * 10**6
    part = F.least(F.floor((arrival - F.lit(ends["lo"])) / F.lit(step)), F.lit(files - 1))
    for k in range(files):
        ev.where(part == k).coalesce(1).write.mode("append").parquet(f"{base}/events")


LATE_US = 3 * 24 * 3600 * 10**6
WATERMARK_SQL = f"""
SELECT * FROM ({TRAILING_SQL}) WHERE event_ts <= (SELECT max(ts) FROM events) - INTERVAL 3 DAY"""


@query("stream_trailing_out_of_order", "T-02 T-01", with_views(WATERMARK_SQL, extra={"alert_events": ALERT_EVENTS}))
def stream_trailing_out_of_order(t):
    """Trailing metrics over four micro-batches whose events arrive up to three days late: exact
    for every event that the final watermark has passed."""
    base = _scratch(t, "late")
    _late_files(t, base)
    events = S.stream_events(t.spark, f"{base}/events", "*.parquet", max_files_per_trigger=1)
    st = S.stream_trailing(S.alerts_stream(events), delay="3 days", delay_us=LATE_US, emit="watermark")
    S.run_available(st, S.parquet_sink(f"{base}/out"), f"{base}/ckpt")
    return t.spark.read.parquet(f"{base}/out").drop("batch")


@query("stream_latest_folded", "T-05 T-04", with_views(f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key_prefix ORDER BY event_ts DESC, row_key DESC) AS rn FROM (
    SELECT row_key, regexp_extract(row_key, '^([^#]*#[^#]*)', 1) AS row_key_prefix, event_ts, discount_usd FROM (
      SELECT concat_ws('#', store_id, cashier_id, CAST(alert_id AS VARCHAR)) AS row_key, alert_ts AS event_ts, discount_usd FROM alert_events)))
WHERE rn = 1""", extra={"alert_events": ALERT_EVENTS}))
def stream_latest_folded(t):
    """Latest event per STORE#CASHIER key over four micro-batches, folded every second batch."""
    base = _scratch(t, "folded")
    _late_files(t, base)
    a = S.alerts_stream(S.stream_events(t.spark, f"{base}/events", "*.parquet", max_files_per_trigger=1))
    rows = a.select(F.concat_ws("#", "store_id", "cashier_id", F.col("alert_id").cast("string")).alias("row_key"),
                    F.concat_ws("#", "store_id", "cashier_id").alias("row_key_prefix"),
                    F.col("alert_ts").cast("timestamp_ntz").alias("event_ts"), "discount_usd")
    S.run_available(rows, S.upsert_latest(f"{base}/table", fold_every=2), f"{base}/ckpt")
    return S.read_latest(t.spark, f"{base}/table")


FEEDBACK_SQL = f"""
SELECT CASE WHEN turn % 11 <> 5 THEN CAST(length(text) % 5 + 1 AS DOUBLE) END AS score,
  CASE WHEN turn % 3 <> 0 THEN text ELSE '' END AS text, 'feedback' AS log_type, '{SERVICE}' AS service_name,
  CASE WHEN conv_id % 2 = 0 THEN 'user-' || CAST(conv_id % 10 AS VARCHAR) ELSE 'generated' END AS user_id,
  'session-' || CAST(conv_id AS VARCHAR) AS session_id, turn % 11 <> 5 AS valid
FROM conversations WHERE role <> 'system'"""


@query("stream_feedback", "T-07", FEEDBACK_SQL)
def stream_feedback(t):
    """Feedback JSON lines parsed with schema, defaults and validity."""
    base = _scratch(t, "feedback")
    conv = t.conversations.where(F.col("role") != "system")
    rec = F.to_json(F.struct(
        F.when(F.col("turn") % 11 != 5, (F.length("text") % 5 + 1)).alias("score"),
        F.when(F.col("turn") % 3 != 0, F.col("text")).alias("text"),
        F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("user-"), (F.col("conv_id") % 10).cast("string"))).alias("user_id"),
        F.concat(F.lit("session-"), F.col("conv_id").cast("string")).alias("session_id")))
    conv.select(rec.alias("value")).write.mode("overwrite").text(f"{base}/source")
    stream = t.spark.readStream.text(f"{base}/source")
    S.run_available(S.ingest_feedback(stream, SERVICE), S.parquet_sink(f"{base}/out"), f"{base}/ckpt")
    out = t.spark.read.parquet(f"{base}/out").drop("batch")
    generated = F.col("user_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return out.withColumn("user_id", F.when(generated, "generated").otherwise(F.col("user_id")))


def _arrivals(t, base: str, steps: int = 4) -> int:
    """Log records and message files as two folders, written in ``steps`` of arrival: a record comes up to four minutes
    late, a message up to six, each by its call's id, so either may come first. Returns the files of a step (a step
    of few rows may have fewer, and then shares its micro-batch with rows that arrive next)."""
    files = t.spark.sparkContext.defaultParallelism
    logs = fx.inference_logs(t).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    call = F.regexp_extract("file_name", r"/(\d+)_", 1).cast("long")
    start = F.lit(fx.TELEMETRY_BASE).cast("timestamp")
    msgs = fx.completions(t).withColumn("written_at", F.timestamp_add("MINUTE", call % 1000000, start))
    last = t.conversations.agg(F.max("turn")).first()[0] or 0
    step = (last * 60) // steps + 1
    insert = F.regexp_extract("insertId", r"(\d+)", 1).cast("long")
    for df, name, ts, late in ((logs, "logs", "timestamp", F.pmod(insert * 7919, F.lit(5))),
                               (msgs, "messages", "written_at", F.pmod(call * 31, F.lit(7)))):
        at = F.unix_timestamp(ts) - F.unix_timestamp(start) + late * 60
        part = F.least(F.floor(at / step), F.lit(steps - 1))
        made = df.withColumn("_step", part).persist(StorageLevel.MEMORY_AND_DISK)
        for k in range(steps):
            made.where(F.col("_step") == k).drop("_step").repartition(files).write.mode("append").parquet(f"{base}/{name}")
        made.unpersist()
    return files


@query("stream_completions_mart", "J-05 M-03 M-04 W-01 W-02 U-01",
       with_views(MART_SQL, "log_refs", "messages", extra={"logs": LOGS_SQL}))
def stream_completions_mart(t):
    """The mart kept by a stream-stream join over micro-batches whose records and message files arrive late and in
    either order, folded every second batch: equal to the batch mart."""
    base = _scratch(t, "mart")
    files = _arrivals(t, base)

    def folder(name):
        return (t.spark.readStream.schema(t.spark.read.parquet(f"{base}/{name}").schema).option("maxFilesPerTrigger", files)
                .parquet(f"{base}/{name}"))

    S.run_available(live.stream_parts(folder("logs"), folder("messages")), live.keep_parts(f"{base}/table", fold_every=2), f"{base}/ckpt")
    return live.read_mart(t.spark, f"{base}/table").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _checked_ledger(t) -> str:
    """The checkout ledger through the streaming quality sink, in four micro-batches; the sink's folder."""
    base = _scratch(t, "quality")
    fx.pos_tx(t).repartition(4).write.parquet(f"{base}/ledger")
    schema = t.spark.read.parquet(f"{base}/ledger").schema
    ledger = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/ledger")
    S.run_available(ledger, checked.quality_sink(f"{base}/checked"), f"{base}/ckpt")
    return f"{base}/checked"


@query("stream_quality_totals", "G-04", with_views(QUALITY_SQL, "pos_tx"))
def stream_quality_totals(t):
    """Totals of the ledger's quality rules over micro-batches, observed while the rows are written."""
    return checked.quality_totals(t.spark, _checked_ledger(t))


@query("stream_quarantined_rows", "G-04", with_views(FAILING_SQL, "pos_tx"))
def stream_quarantined_rows(t):
    """Ledger rows that the stream set aside, once per failed rule."""
    bad = checked.quality_rows(t.spark, _checked_ledger(t), quarantined=True)
    return bad.select("tx_no", "transaction_id", F.explode("failed_rules").alias("failed_rule"))
