"""Structured Streaming jobs: event ingest, per-event trailing metrics with
state, sliding-window metrics, latest-state upserts, log routing and
feedback ingest (T-01..T-07).

Sinks are idempotent per micro-batch: every ``foreachBatch`` writes into
a folder named by the batch id with overwrite, so a batch replayed after
a lost executor or driver restart replaces its own output instead of
duplicating it. Checkpoints live under the shared checkpoint folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from storelens.functions.metrics import PROMO_ABUSE, exact_ratio
from storelens.operators.offenders import PROMO_EVENT, audit_status
from storelens.sources.logs import write_logs
from storelens.session import ship_package
from storelens.sources.tables import SCHEMAS

HOUR_US = 3600 * 1_000_000


# ------------------------------------------------------------- T-01
#: Bytes of event files that one micro-batch takes, at most (a single larger file is taken whole).
BATCH_BYTES = 1 << 30


def stream_events(spark: SparkSession, folder: str, file_glob: str = "events*.parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """T-01: the POS event files of ``folder`` (those matching ``file_glob``)
    as an append stream with the declared schema, in micro-batches of at most
    ``BATCH_BYTES`` or so many files; ``ts`` becomes a
    session-zone timestamp so it can carry a watermark (timestamp_ntz
    cannot)."""
    r = spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", file_glob)
    r = r.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else r.option("maxBytesPerTrigger", BATCH_BYTES)
    return r.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def alerts_stream(events: DataFrame) -> DataFrame:
    """The alert view over a stream of events (same mapping as the batch view)."""
    return events.select(
        F.col("event_id").alias("alert_id"), F.col("ts").alias("alert_ts"),
        F.concat(F.lit("STORE_"), F.lpad((F.col("user_id") % 10).cast("string"), 3, "0")).alias("store_id"),
        F.concat(F.lit("CASH_"), (F.lit(1000) + F.col("user_id")).cast("string")).alias("cashier_id"),
        F.when(F.col("event_type") == "error", F.lit(PROMO_ABUSE)).otherwise(F.col("event_type")).alias("alert_type"),
        F.col("value").cast("decimal(18,2)").alias("discount_usd"))


# ------------------------------------------------------------- T-02
#: One row of state for each event that a later window may still hold.
_EVENT = T.StructType([
    T.StructField("us", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("cents", T.LongType()),
    T.StructField("alert_id", T.LongType()), T.StructField("store_id", T.StringType()), T.StructField("pending", T.BooleanType())])
_OUT = T.StructType([
    T.StructField("cashier_id", T.StringType()), T.StructField("store_id", T.StringType()),
    T.StructField("event_id", T.LongType()), T.StructField("event_us", T.LongType()),
    T.StructField("txn_count", T.LongType()), T.StructField("override_count", T.LongType()),
    T.StructField("promo_count", T.LongType()), T.StructField("cents_sum", T.LongType())])
_EVENT_COLS = _EVENT.fieldNames()


def trailing_counts(us: np.ndarray, kind: np.ndarray, cents: np.ndarray, at: np.ndarray, window_us: int) -> dict[str, np.ndarray]:
    """Counts and sums over [t - window, t], peers at t included, for every t of ``at``; ``us`` is sorted."""
    lo, hi = np.searchsorted(us, at - window_us, side="left"), np.searchsorted(us, at, side="right")

    def between(x: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(x, dtype=np.int64)))
        return total[hi] - total[lo]

    return {"txn_count": (hi - lo).astype(np.int64), "override_count": between(kind == 1),
            "promo_count": between(kind == 2), "cents_sum": between(cents)}


class _Trailing(StatefulProcessor):
    """Keyed state of a cashier: the events that a window of a later event can still hold, as a list.

    A call gets all of a micro-batch's events of the cashier, so state is read and written
    once, however many they are. Event-time timers end the state of cashiers that fall silent."""

    def __init__(self, window_us: int, delay_us: int):
        self.window_us, self.delay_us = window_us, delay_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", _EVENT)

    def close(self) -> None:
        pass

    def _held(self) -> pd.DataFrame:
        rows = list(self.events.get())
        return _frame(dict(zip(_EVENT_COLS, zip(*rows))) if rows else {c: () for c in _EVENT_COLS})

    def _keep(self, events: pd.DataFrame) -> None:
        if events.empty:
            self.events.clear()
        else:
            self.events.put(list(zip(*(events[c].tolist() for c in _EVENT_COLS))))

    def _answers(self, cashier: str, events: pd.DataFrame, asked: np.ndarray) -> pd.DataFrame:
        """Rows of the events marked in ``asked``; ``events`` are sorted by time."""
        us = events["us"].to_numpy(np.int64)
        out = trailing_counts(us, events["kind"].to_numpy(), events["cents"].to_numpy(np.int64), us[asked], self.window_us)
        return pd.DataFrame({"cashier_id": cashier, "store_id": events["store_id"].to_numpy()[asked],
                             "event_id": events["alert_id"].to_numpy(np.int64)[asked], "event_us": us[asked], **out})


def _frame(columns) -> pd.DataFrame:
    return pd.DataFrame({c: np.asarray(columns[c], dtype=t) for c, t in zip(
        _EVENT_COLS, (np.int64, np.int32, np.int64, np.int64, object, bool))})


class _AnswerOnArrival(_Trailing):
    """Every event is answered in the batch that brings it. State: the last window + delay."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True).assign(pending=True)
        events = pd.concat([self._held(), _frame(new)], ignore_index=True).sort_values("us", kind="stable", ignore_index=True)
        yield self._answers(key[0], events, events["pending"].to_numpy())
        last = int(events["us"].iloc[-1])
        self._keep(events[events["us"] >= last - self.window_us - self.delay_us].assign(pending=False))
        self.handle.registerTimer((last + self.window_us + self.delay_us) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        events = self._held()
        if len(events) and int(events["us"].iloc[-1]) + self.window_us + self.delay_us <= expiredTimerInfo.getExpiryTimeInMs() * 1000 + 999:
            self.events.clear()                      # no event has come since the timer was set
        return iter(())


class _AnswerOnWatermark(_Trailing):
    """Events wait in state until a timer finds the watermark past them. Every earlier event
    has then arrived (Spark drops later ones), so answers are final and equal the
    batch RANGE window whatever the order of arrival. State: window + delay."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = _frame(pd.concat(list(rows), ignore_index=True).assign(pending=True))
        self.events.appendList(list(zip(*(new[c].tolist() for c in _EVENT_COLS))))
        self.handle.registerTimer(int(new["us"].min()) // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        events = self._held().sort_values("us", kind="stable", ignore_index=True)
        ready = (events["pending"] & (events["us"] <= now)).to_numpy()
        if ready.any():
            yield self._answers(key[0], events, ready)
        events["pending"] &= ~ready
        waiting = events.loc[events["pending"], "us"]
        # what waits, and the history of events that wait or may still come (none before the watermark)
        floor = min(int(waiting.min()) if len(waiting) else now, now) - self.window_us
        kept = events[events["pending"] | (events["us"] >= floor)]
        if ready.any() or len(kept) < len(events):
            self._keep(kept)
        if len(waiting):
            self.handle.registerTimer(int(waiting.min()) // 1000)
        elif len(kept):
            self.handle.registerTimer((int(kept["us"].max()) + self.window_us) // 1000 + 1)


def stream_trailing(alerts: DataFrame, window_us: int = HOUR_US, delay: str = "10 minutes",
                    delay_us: int = 600 * 1_000_000, emit: str = "arrival") -> DataFrame:
    """T-02: per-event trailing-window cashier metrics on a stream: keyed state
    with event-time timers (``transformWithStateInPandas``), one call per cashier and micro-batch.

    ``emit="arrival"`` answers at once (the live view): late events within
    the watermark delay are counted in the windows of events that arrive
    after them. On in-order input the output equals the batch RANGE window (A-04).
    ``emit="watermark"`` holds each event until the watermark passes it and
    is then exact for any arrival order, one watermark delay later.

    Either way a cashier's state is what arrived in the last ``window + delay``, so a hot
    cashier's does not grow with the stream, and a call holds that and one micro-batch, which the
    source bounds (``stream_events``)."""
    ship_package(alerts.sparkSession)
    use_rocksdb(alerts.sparkSession)
    x = (alerts.withWatermark("alert_ts", delay)
         .withColumn("us", F.unix_micros("alert_ts"))
         .withColumn("kind", F.when(F.col("alert_type") == PROMO_ABUSE, 1)
                     .when(F.col("alert_type") == PROMO_EVENT, 2).otherwise(0))
         .withColumn("cents", (F.col("discount_usd") * 100).cast("long"))
         .select("cashier_id", "store_id", "alert_id", "alert_ts", "us", "kind", "cents"))
    answer = (_AnswerOnWatermark if emit == "watermark" else _AnswerOnArrival)(window_us, delay_us)
    out = x.groupBy("cashier_id").transformWithStateInPandas(answer, _OUT, "append", "eventtime")
    return out.select(
        F.concat_ws("#", "store_id", "cashier_id", F.col("event_id").cast("string")).alias("row_key"),
        "store_id", "cashier_id", "event_id",
        F.timestamp_micros("event_us").cast("timestamp_ntz").alias("event_ts"),
        "txn_count", "override_count", "promo_count",
        exact_ratio("override_count", "txn_count", 2, scale=100).alias("override_rate_pct"),
        exact_ratio("promo_count", "txn_count", 2, scale=100).alias("promo_rate_pct"),
        (F.col("cents_sum").cast("decimal(20,0)") / 100).cast("decimal(18,2)").alias("total_discount_usd"),
        exact_ratio("cents_sum", F.col("txn_count") * 100, 2).alias("avg_discount_usd"))


# ------------------------------------------------------------- T-03
_SUMS = ("txn_count", "override_count", "promo_count", "valued", "high", "low")
#: One row of state for each pane (the grid's greatest common step) that holds events of an open window.
_PANE = T.StructType([T.StructField(c, T.LongType()) for c in ("pane", *_SUMS, "after")])
_WINDOWS = T.StructType([T.StructField("cashier_id", T.StringType())] + [T.StructField(c, T.LongType()) for c in ("start_us", *_SUMS)])


def _summed(key: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their rows."""
    order = np.argsort(key, kind="stable")
    key, first = np.unique(key[order], return_index=True)
    return key, np.add.reduceat(sums[order], first, axis=0) if len(key) else sums


class _Sliding(StatefulProcessor):
    """Keyed state of a cashier: sums of each pane that an open window covers. A timer at the end of the
    first of these windows gives all that the watermark has closed, each once.

    A row counts in the windows that end behind the watermark of its arrival (``after``), so an event that is later
    than the delay does not open a closed window again."""

    def __init__(self, length: int, slide: int):
        self.length, self.slide, self.step = length, slide, math.gcd(length, slide)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getListState("panes", _PANE)

    def close(self) -> None:
        pass

    def _last(self, pane: np.ndarray) -> np.ndarray:
        """The end of the last window over each pane."""
        return pane * self.step // self.slide * self.slide + self.length

    def _wake(self, pane: np.ndarray, after: int, past: int = -1 << 62) -> None:
        """A timer, later than ``past``, for the first window over the panes that ends behind ``after``."""
        if len(pane):
            over = -((self.length - (int(pane.min()) + 1) * self.step) // self.slide)      # first window over the first pane
            end = max(over, (after - self.length) // self.slide + 1) * self.slide + self.length
            self.handle.registerTimer(max((end + 999) // 1000 - 1, past + 1))               # timers fire behind their time

    def _put(self, pane: np.ndarray, sums: np.ndarray, after: int) -> list[tuple]:
        return [(p, *s, after) for p, s in zip(pane.tolist(), sums.tolist())]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        parts = [_summed(x["us"].to_numpy(np.int64) // self.step, x[list(_SUMS)].to_numpy(np.int64)) for x in rows]
        pane, sums = _summed(np.concatenate([p for p, _ in parts]), np.concatenate([s for _, s in parts]))
        open_ = self._last(pane) > now
        if open_.any():
            self.panes.appendList(self._put(pane[open_], sums[open_], now))
            self._wake(pane[open_], now)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = np.array([tuple(r) for r in self.panes.get()], dtype=np.int64).reshape(-1, len(_PANE))
        pane, sums, after = held[:, 0], held[:, 1:-1], held[:, -1]
        k = (pane * self.step // self.slide)[:, None] - np.arange(-(-self.length // self.slide))
        end = k * self.slide + self.length
        row, col = np.nonzero((end > pane[:, None] * self.step) & (end > after[:, None]) & (end <= now))
        if len(row):
            window, total = _summed(k[row, col], sums[row])
            yield pd.DataFrame({"cashier_id": pd.Series([key[0]] * len(window), dtype=object), "start_us": window * self.slide,
                                **dict(zip(_SUMS, total.T))})
        open_ = self._last(pane) > now
        if len(row) or not open_.all():
            pane, sums = _summed(pane[open_], sums[open_])
            if len(pane):
                self.panes.put(self._put(pane, sums, now))
            else:
                self.panes.clear()
        self._wake(pane, now, expiredTimerInfo.getExpiryTimeInMs())


def stream_sliding(alerts: DataFrame, length: str = "1 hour", slide: str = "5 minutes",
                   delay: str = "10 minutes") -> DataFrame:
    """T-03: cashier metrics on a fixed sliding grid; a window is emitted
    once the watermark passes its end (append mode).

    State is a row for each cashier and pane with events, not one for each of the windows over it, and ends
    with its last window. An event that is later than ``delay`` counts in the windows that are open still."""
    spark = alerts.sparkSession
    ship_package(spark)
    use_rocksdb(spark)
    length_us, slide_us, delay_us = spark.sql("SELECT " + ", ".join(
        f"unix_micros(timestamp_micros(0) + INTERVAL {x})" for x in (length, slide, delay))).first()
    cents = (F.col("discount_usd").cast("decimal(18,2)") * 100).cast("long")
    split = F.lit(1_000_000_000).cast("long")                    # sums of cents in two parts, so that neither overflows

    def flag(c: Column) -> Column:
        return F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    # rows stay until their last window is closed, behind the same watermark: the latest alert_ts less the delay
    x = (alerts.where(F.col("alert_ts").isNotNull())
         .withColumn("_open", F.timestamp_micros(F.unix_micros("alert_ts") + F.lit(length_us)))
         .withWatermark("_open", f"{(length_us + delay_us) // 1000} milliseconds")
         .select("cashier_id", "_open", F.unix_micros("alert_ts").alias("us"), F.lit(1).cast("long").alias("txn_count"),
                 flag(F.col("alert_type") == PROMO_ABUSE).alias("override_count"),
                 flag(F.col("alert_type") == PROMO_EVENT).alias("promo_count"),
                 cents.isNotNull().cast("long").alias("valued"),
                 F.coalesce((cents - F.pmod(cents, split)) / split, F.lit(0)).cast("long").alias("high"),
                 F.coalesce(F.pmod(cents, split), F.lit(0)).cast("long").alias("low")))
    g = x.groupBy("cashier_id").transformWithStateInPandas(_Sliding(length_us, slide_us), _WINDOWS, "append", "eventtime")
    total = ((F.col("high").cast("decimal(18,0)") * F.lit(1_000_000_000).cast("decimal(10,0)") + F.col("low").cast("decimal(18,0)"))
             * F.lit(Decimal("0.01"))).cast("decimal(28,2)")
    # window bounds as wall-clock UTC (timestamp_ntz), like event_ts of the trailing stream
    return g.select(F.timestamp_micros("start_us").cast("timestamp_ntz").alias("window_start"),
                    F.timestamp_micros(F.col("start_us") + F.lit(length_us)).cast("timestamp_ntz").alias("window_end"), "cashier_id",
                    "txn_count", "override_count", "promo_count",
                    exact_ratio("override_count", "txn_count", 2, scale=100).alias("override_rate_pct"),
                    F.when(F.col("valued") > 0, total).alias("total_discount_usd"))


# ------------------------------------------------------------- T-05
def upsert_latest(path: str, key: str = "row_key_prefix", ts: str = "event_ts", fold_every: int = 10):
    """T-05: a ``foreachBatch`` function keeping the latest row per key.

    Each batch writes its own latest-per-key rows to ``{path}/full=0/batch={id}``
    (overwrite, so a replay is idempotent). Every ``fold_every``-th batch also folds all
    earlier state into its own folder, ``{path}/full=1/batch={id}``, so a read needs the
    newest such folder and the few batches after it, however long the stream has run.
    The newest row is the one with the latest ``ts``, then the largest row key, then the latest batch."""
    def run(df: DataFrame, batch_id: int) -> None:
        new = _newest(df.withColumn("batch", F.lit(batch_id).cast("long")), key, ts)
        full = (batch_id + 1) % fold_every == 0
        if full and batch_id:
            new = _newest(_current(df.sparkSession, path, batch_id).unionByName(new), key, ts)
        new.drop("batch").write.mode("overwrite").parquet(f"{path}/full={int(full)}/batch={batch_id}")
    return run


def _newest(df: DataFrame, key: str, ts: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.col(ts).desc(), F.col("row_key").desc(), F.col("batch").desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _current(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Rows of the newest folded batch and of the batches after it (of those before ``before``)."""
    df = spark.read.parquet(path).withColumn("batch", F.col("batch").cast("long"))
    if before is not None:
        df = df.where(F.col("batch") < before)
    base = df.where("full = 1").agg(F.max("batch")).first()[0]          # partition columns alone
    return (df if base is None else df.where(F.col("batch") >= base)).drop("full")


def read_latest(spark: SparkSession, path: str, key: str = "row_key_prefix", ts: str = "event_ts") -> DataFrame:
    """Newest row per key across all written batches, by the rule of ``upsert_latest``."""
    return _newest(_current(spark, path), key, ts).drop("batch")


# ------------------------------------------------------------- T-06
def route_logs(routes: dict[str, tuple[Column, str]], ts_col: str = "timestamp"):
    """T-06: a ``foreachBatch`` function sending each record to every route
    whose condition holds; each route is a day-partitioned table. The
    batch is persisted once and read by all routes."""
    def run(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for name, (cond, path) in routes.items():
                part = df.where(F.coalesce(cond, F.lit(False)))
                write_logs(part, path, ts_col, batch_id=batch_id)
        finally:
            df.unpersist()
    return run


def genai_route(project: str, project_name: str) -> Column:
    """The inference-log route: log name match and a message reference
    mentioning the service."""
    log = F.col("log_name") == F.lit(f"projects/{project}/logs/gen_ai.client.inference.operation.details")
    pat = f".*{project_name}.*"
    refs = (F.col("labels.gen_ai_input_messages_ref").rlike(pat) |
            F.col("labels.gen_ai_output_messages_ref").rlike(pat))
    return log & refs


def feedback_route(service_name: str) -> Column:
    return (F.col("json_payload.log_type") == "feedback") & (F.col("json_payload.service_name") == service_name)


# ------------------------------------------------------------- T-07
FEEDBACK_SCHEMA = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("text", T.StringType()),
    T.StructField("log_type", T.StringType()), T.StructField("service_name", T.StringType()),
    T.StructField("user_id", T.StringType()), T.StructField("session_id", T.StringType())])


def ingest_feedback(raw: DataFrame, service_name: str, value_col: str = "value") -> DataFrame:
    """T-07: parse feedback JSON with its schema and defaults (text "",
    log_type "feedback", the service name, generated user/session ids);
    records without a score or with another log type/service are marked
    invalid, as a typed endpoint would reject them."""
    p = raw.select(F.from_json(F.col(value_col), FEEDBACK_SCHEMA).alias("f")).select("f.*")
    valid = (F.col("score").isNotNull() & F.coalesce(F.col("log_type") == "feedback", F.lit(True)) &
             F.coalesce(F.col("service_name") == service_name, F.lit(True)))
    return p.select(
        "score", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("log_type", F.lit("feedback")).alias("log_type"),
        F.coalesce("service_name", F.lit(service_name)).alias("service_name"),
        F.coalesce("user_id", F.expr("uuid()")).alias("user_id"),
        F.coalesce("session_id", F.expr("uuid()")).alias("session_id"),
        valid.alias("valid"))


# ------------------------------------------------------------- runner
def use_rocksdb(spark: SparkSession) -> None:
    """State in RocksDB, unless the session chose a provider of its own (an unset one reads as Spark's default)."""
    from storelens.session import ROCKSDB_PROVIDER
    conf = spark.conf
    if conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider"):
        conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def run_available(df: DataFrame, sink_fn, checkpoint: str, name: str | None = None) -> None:
    """Run a stream over everything available now, then stop."""
    use_rocksdb(df.sparkSession)
    w = df.writeStream.foreachBatch(sink_fn).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def parquet_sink(path: str):
    """foreachBatch sink: each batch to ``{path}/batch={id}`` (overwrite)."""
    def run(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return run


__all__ = ["stream_events", "alerts_stream", "stream_trailing", "stream_sliding", "audit_status",
           "upsert_latest", "read_latest", "route_logs", "genai_route", "feedback_route",
           "ingest_feedback", "run_available", "parquet_sink"]
