"""Streams against their batch twins, across several micro-batches."""

import tempfile

from pyspark.sql import functions as F

from storelens.operators.offenders import rt_metrics
from storelens.plans import fixtures as fx
from storelens.sources.tables import Tables
from storelens.streaming import jobs as S
from tests.conftest import SF001


def _day_files(spark, root):
    """events split into one parquet file per day (in time order)."""
    ev = Tables(spark, SF001).events
    folder = tempfile.mkdtemp(prefix="storelens-ev-")
    days = [r[0] for r in ev.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]
    for i, d in enumerate(days):
        ev.where(F.to_date("ts") == d).coalesce(1).write.parquet(f"{folder}/tmp{i}")
        import glob
        import shutil
        src = glob.glob(f"{folder}/tmp{i}/*.parquet")[0]
        shutil.copy(src, f"{folder}/events_{i:03d}.parquet")
    _pin_arrival_order(folder)
    return folder, len(days)


def _pin_arrival_order(folder):
    """The file source takes new files in modification-time order at
    millisecond precision; copies made within one millisecond would tie
    and arrive in any order. Space them one second apart, in name order."""
    import os
    import time
    base = int(time.time()) - 10_000
    for i, f in enumerate(sorted(x for x in os.listdir(folder) if x.startswith("events_"))):
        os.utime(f"{folder}/{f}", (base + i, base + i))


def test_trailing_stream_multi_batch_equals_batch(spark):
    folder, n = _day_files(spark, SF001)
    out = tempfile.mkdtemp(prefix="storelens-st-")
    ev = S.stream_events(spark, folder, "events_*.parquet", max_files_per_trigger=1)
    S.run_available(S.stream_trailing(S.alerts_stream(ev)), S.parquet_sink(f"{out}/o"), f"{out}/ck")
    got = spark.read.parquet(f"{out}/o")
    assert got.select("batch").distinct().count() > 1          # state crossed batches
    want = rt_metrics(fx.alert_events(Tables(spark, SF001)))
    cols = sorted(want.columns)
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_sliding_stream_matches_batch_closed_windows(spark):
    t = Tables(spark, SF001)
    out = tempfile.mkdtemp(prefix="storelens-sl-")
    ev = S.stream_events(spark, SF001)
    S.run_available(S.stream_sliding(S.alerts_stream(ev)), S.parquet_sink(f"{out}/o"), f"{out}/ck")
    got = spark.read.parquet(f"{out}/o").drop("batch")
    batch_alerts = S.alerts_stream(t.events.withColumn("ts", F.col("ts").cast("timestamp")))
    w = F.window("alert_ts", "1 hour", "5 minutes")
    want = batch_alerts.groupBy(w.alias("w"), "cashier_id").agg(F.count(F.lit(1)).alias("txn_count"))
    wm = t.events.agg(F.max("ts")).collect()[0][0]
    import datetime as dt
    closed = want.where(F.col("w.end") <= F.lit(wm - dt.timedelta(minutes=10)))
    g = {(r["window_start"], r["cashier_id"]): r["txn_count"] for r in got.collect()}
    c = {(r["w"]["start"], r["cashier_id"]): r["txn_count"] for r in closed.collect()}
    assert g == c and len(g) > 0


def test_trailing_watermark_mode_is_exact_out_of_order(spark):
    """Watermark mode equals the batch window for every event the final
    watermark has passed (later ones wait for a later watermark)."""
    import datetime as dt
    folder, n = _day_files(spark, SF001)
    import os
    import shutil
    rev = tempfile.mkdtemp(prefix="storelens-rev-")
    names = sorted(f for f in os.listdir(folder) if f.startswith("events_"))
    # swap neighbouring days so each second file arrives late, within the delay
    order = [j for i in range(0, len(names), 2) for j in (i + 1, i) if j < len(names)]
    for i, f in enumerate(names[j] for j in order):
        shutil.copy(f"{folder}/{f}", f"{rev}/events_{i:03d}.parquet")
    _pin_arrival_order(rev)
    out = tempfile.mkdtemp(prefix="storelens-wm-")
    ev = S.stream_events(spark, rev, "events_*.parquet", max_files_per_trigger=1)
    # files are up to two days out of order: a three-day delay keeps them all
    st = S.stream_trailing(S.alerts_stream(ev), delay="3 days", delay_us=3 * 24 * 3600 * 10**6, emit="watermark")
    S.run_available(st, S.parquet_sink(f"{out}/o"), f"{out}/ck")
    got = spark.read.parquet(f"{out}/o").drop("batch")
    t = Tables(spark, SF001)
    wm = t.events.agg((F.max("ts") - F.expr("INTERVAL 3 DAYS")).alias("wm"))
    want = (rt_metrics(fx.alert_events(t)).join(F.broadcast(wm), F.col("event_ts") <= F.col("wm"))
            .drop("wm"))
    cols = sorted(want.columns)
    assert got.count() > 0
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_state_of_a_hot_cashier_is_bounded(spark):
    """A third of all events are one cashier's: its state holds the last window and delay, whatever came
    before, and answers equal the batch windows in both modes."""
    import datetime as dt
    base = tempfile.mkdtemp(prefix="storelens-hot-")
    start, n = dt.datetime(2024, 1, 1), 3000
    rows = [(k, start + dt.timedelta(minutes=3 * k), 7 if k % 3 == 0 else k, ["error", "purchase", "view"][k % 7 % 3], float(k % 11))
            for k in range(n)]
    for i in range(5):
        part = spark.createDataFrame(rows[i * n // 5:(i + 1) * n // 5], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
        part.coalesce(1).write.mode("append").parquet(f"{base}/events")
    names = sorted(((r.f, r.t) for r in spark.read.parquet(f"{base}/events").selectExpr("_metadata.file_path f", "ts t")
                    .groupBy("f").agg(F.min("t").alias("t")).collect()), key=lambda x: x[1])
    import os
    for i, (f, _) in enumerate(names):                   # arrival in order of time
        os.utime(f[len("file:"):].replace("//", "/", 1) if f.startswith("file:") else f, (1_700_000_000 + i, 1_700_000_000 + i))
    alerts = S.alerts_stream(spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double"))
    want = rt_metrics(alerts.withColumn("alert_ts", F.col("alert_ts").cast("timestamp_ntz")))
    cols = sorted(want.columns)
    for mode in ("arrival", "watermark"):
        st = S.stream_trailing(S.alerts_stream(S.stream_events(spark, f"{base}/events", "*.parquet", max_files_per_trigger=1)), emit=mode)
        S.run_available(st, S.parquet_sink(f"{base}/{mode}"), f"{base}/ck-{mode}")
        got = spark.read.parquet(f"{base}/{mode}")
        assert got.select("batch").distinct().count() >= 4
        due = want if mode == "arrival" else want.where(F.col("event_ts") <= F.lit(rows[-1][1] - dt.timedelta(minutes=10)))
        assert sorted(got.select(*cols).collect()) == sorted(due.select(*cols).collect())
        state = spark.read.format("statestore").option("stateVarName", "events").load(f"{base}/ck-{mode}")
        per = state.groupBy("key.cashier_id").count().collect()
        hot = [r["count"] for r in per if r["cashier_id"] == "CASH_1007"]
        assert hot and hot[0] <= 70 // 9 + 2             # an event every nine minutes, 70 minutes kept
        assert sum(r["count"] for r in per) <= 2 * (70 // 3 + 2)   # silent cashiers' state has gone


def test_trailing_runs_where_the_session_names_no_state_store(spark):
    """A plain session leaves the provider unset, which means Spark's default; keyed state then still goes to RocksDB."""
    import __spark_entry__ as E
    from storelens.session import ROCKSDB_PROVIDER
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.unset(key)
    try:
        assert E.queries()["stream_trailing_metrics"](spark, SF001).count() == Tables(spark, SF001).events.count()
    finally:
        spark.conf.set(key, ROCKSDB_PROVIDER)


class _List:
    def __init__(self):
        self.rows, self.timers = [], set()

    def getListState(self, name, schema):
        return self

    def registerTimer(self, ms):
        self.timers.add(ms)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def appendList(self, rows):
        self.rows += rows

    def clear(self):
        self.rows = []


class _At:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms


def test_sliding_state_is_a_row_for_each_pane_and_windows_come_once():
    """Batches of late and early events against a plain count: an event counts in the windows that end behind the
    watermark of its arrival."""
    import random

    import pandas as pd
    rnd, minute = random.Random(5), 60_000_000
    for length, slide in ((60 * minute, 5 * minute), (7 * minute, 3 * minute), (5 * minute, 5 * minute)):
        state = _List()
        p = S._Sliding(length, slide)
        p.init(state)
        got, want, top, now = {}, {}, 0, 0
        for batch in range(40):
            at = [max(0, top + rnd.randint(-90, 40) * minute + rnd.randint(0, minute)) for _ in range(rnd.randint(1, 30))] if batch % 4 else []
            for us in at:
                for k in range((us - length) // slide + 1, us // slide + 1):
                    if k * slide + length > now:
                        want[k * slide] = want.get(k * slide, 0) + 1
            if at:
                rows = pd.DataFrame({"us": at, **{c: [1] * len(at) for c in S._SUMS}})
                list(p.handleInputRows(("c",), iter([rows[:3], rows[3:]]), _At(now // 1000)))
            assert len(state.rows) <= 2 * (2 * 90 + 40 + length // minute)
            for ms in sorted(t for t in state.timers if t * 1000 < now):
                state.timers.discard(ms)
                for df in p.handleExpiredTimer(("c",), _At(now // 1000), _At(ms)):
                    for s, n in zip(df["start_us"], df["txn_count"]):
                        assert s not in got and s + length <= now
                        got[s] = n
            top = max([top, *at])
            now = max(now, (top - 10 * minute) // 1000 * 1000)
        closed = {s: n for s, n in want.items() if s in got or s + length <= now - 200 * minute}
        assert got == closed and len(got) > 50


def test_sliding_stream_over_batches_with_nulls_and_large_sums(spark):
    import datetime as dt
    from decimal import Decimal
    out = tempfile.mkdtemp(prefix="storelens-sl-")
    start, big = dt.datetime(2024, 1, 1), Decimal("9999999999999999.99")
    rows = [("a", start + dt.timedelta(minutes=i // 4), "purchase" if i % 3 else "cashier_promo_abuse", big if i % 2 else -big / 3) for i in range(240)]
    rows += [(None, start + dt.timedelta(minutes=9 * i), None, None) for i in range(20)] + [("b", None, "purchase", Decimal(1))]
    schema = "cashier_id string, alert_ts timestamp, alert_type string, discount_usd decimal(18,2)"
    rows.sort(key=lambda r: r[1] or start)
    for k in range(3):
        spark.createDataFrame(rows[k * 90:(k + 1) * 90], schema).coalesce(1).write.mode("append").parquet(f"{out}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    S.run_available(S.stream_sliding(stream), S.parquet_sink(f"{out}/o"), f"{out}/ck")
    got = spark.read.parquet(f"{out}/o").drop("batch")
    w = F.window("alert_ts", "1 hour", "5 minutes")
    want = (spark.read.parquet(f"{out}/in").groupBy(w.alias("w"), "cashier_id")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("alert_type") == "cashier_promo_abuse").alias("o"),
                 F.sum("discount_usd").alias("d")).where(F.col("w.end") <= F.lit(max(r[1] for r in rows if r[1]) - dt.timedelta(minutes=10))))
    g = {(r.window_start, r.cashier_id): (r.txn_count, r.override_count, r.total_discount_usd) for r in got.collect()}
    assert g == {(r.w.start, r.cashier_id): (r.n, r.o, r.d) for r in want.collect()}
    assert got.count() == len(g) and any(k[1] is None for k in g) and max(v[2] or 0 for v in g.values()) > 10 ** 17
