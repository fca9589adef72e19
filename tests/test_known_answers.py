"""Known answers quoted by the reference, and guardrail / contract cases."""

import tempfile

import pytest
from pyspark.sql import functions as F

from storelens.functions import metrics as M
from storelens.functions.text import browser_link, search_terms
from storelens.operators import governance as gov
from storelens.operators.access import apply_row_policy, read_prefix
from storelens.operators.filters import lookup_purchase, on_day
from storelens.sources.logs import export_results
from storelens.plans import fixtures as fx
from storelens.sources.tables import Tables
from tests.conftest import SF001, SF01


def one(spark, col, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols.keys()))
    return df.select(col.alias("v")).collect()[0]["v"]


def test_rates_and_differences(spark):
    assert one(spark, M.exact_ratio("a", "b", 2, 100), a=17, b=32) == 53.13
    assert one(spark, M.exact_ratio("a", "b", 2, 100), a=19, b=32) == 59.38
    assert one(spark, M.exact_ratio("a", "b", 2, 100), a=35, b=37) == 94.59
    assert one(spark, M.round_half_up(F.lit(53.13) - F.lit(94.59), 2)) == -41.46
    assert one(spark, M.exact_ratio("a", "b", 2, 100), a=1, b=0) is None


def test_on_hand_and_bands(spark):
    assert one(spark, M.total_on_hand(), shelf_qty=29, backroom_qty=17) == 46
    for cover, band in ((4.5, "CRITICAL_BURN_SPIKE"), (6.0, "CRITICAL_BURN_SPIKE"),
                        (6.4, "MONITOR_VELOCITY"), (15.2, "NORMAL")):
        assert one(spark, M.risk_band("c"), c=cover) == band
    assert one(spark, M.cover_hours(), shelf_qty=1, backroom_qty=1, total_units_sold_intraday=0) is None


def test_month_boundaries(spark):
    assert one(spark, M.month_diff(F.lit("2026-03-31").cast("date"), F.lit("2026-04-01").cast("date"))) == 1


def test_link_and_terms(spark):
    assert one(spark, browser_link("u"), u="gs://bucket/x.pdf") == "https://storage.cloud.google.com/bucket/x.pdf"
    q = "ERR-PAY-4001 EMV reader freeze on the printer, ERR-PAY-4001 again, freeze"
    assert one(spark, search_terms("q"), q=q) == ["ERR-PAY-4001", "EMV", "freeze", "printer"]


GUARD_BLOCK = ["Show transactions in pos_transactions_gold", "List active promo abuse alerts for cashiers",
               "Retrieve checkout logs from pos_transactions"]
GUARD_PASS = ["Show cashiers with active cashier promo abuse alerts in the last 7 days",
              "Check transaction details for TXN-20260312-0015811",
              "What is Cashier CASH_1190's 7-day historical override baseline?",
              "Show transactions from pos_transactions_gold for 2026-09-10",
              "Retrieve checkout logs between 2026-03-01 and 2026-03-07",
              "What is the estimated cover hours remaining for store inventory positions under 20h?",
              "Show the warranty coverage policy for Samsung Galaxy Watch4",
              "Show inventory positions for prod_4691 at Store 15"]


def test_guardrail_cases(spark):
    df = spark.createDataFrame([(q, q in GUARD_BLOCK) for q in GUARD_BLOCK + GUARD_PASS], "text string, want boolean")
    for r in gov.classify_questions(df).collect():
        assert r["needs_clarification"] == r["want"], r["text"]


def test_table_contracts(spark):
    rows = [("pos_transactions_gold", "STREAMING_TABLE", "true", "store-ops"),
            ("pos_anomaly_alerts", "STREAMING_TABLE", "false", "loss-prevention"),
            ("gold_inventory_reconciliation_ledger", "BATCH_TABLE", "false", "inventory-mgmt"),
            ("historical_transactional_data", "BATCH_TABLE", "true", "store-ops"),
            ("warranty_generic_sections_extracted", "BATCH_TABLE", "false", "store-ops"),
            ("bad_enum", "LIVE_TABLE", "true", "store-ops"),
            ("missing_owner", "BATCH_TABLE", "false", None),
            ("bad_bool", "BATCH_TABLE", "maybe", "store-ops")]
    df = spark.createDataFrame(rows, "table_name string, table_type string, pii_included string, data_owner_team string")
    v = {r["table_name"]: r["violations"] for r in gov.validate_records(df).collect()}
    assert all(v[n] == [] for n, *_ in rows[:5])
    assert v["bad_enum"] == ["table_type: not in enum: LIVE_TABLE"]
    assert v["missing_owner"] == ["data_owner_team: missing"]
    assert v["bad_bool"] == ["pii_included: not boolean: maybe"]
    hits = gov.search_contract(df, table_type="STREAMING_TABLE", pii_included=True).collect()
    assert [r["table_name"] for r in hits] == ["pos_transactions_gold"]


def test_scan_guards(spark):
    t = Tables(spark, SF001)
    with pytest.raises(gov.MissingDateRange):
        gov.scan_fact(fx.alerts(t), "alert_ts", None, "2024-01-31")
    with pytest.raises(gov.ScanBudgetExceeded):
        gov.check_scan_budget(t.lineitem, 1024)
    assert gov.check_scan_budget(t.region, 10 ** 9) is not None


def test_lookups_policy_prefix(spark):
    t = Tables(spark, SF01)
    h = fx.history(t)
    tx = h.select("transaction_id").orderBy("transaction_id").first()[0]
    assert lookup_purchase(h, transaction_id=tx).count() == 1
    pos = fx.pos_tx(t)
    ent = spark.createDataFrame([("ann", "STORE_001"), ("ann", "STORE_002"), ("bob", "STORE_003")],
                                "user string, store_id string")
    seen = apply_row_policy(pos, ent, "ann")
    assert set(r[0] for r in seen.select("store_id").distinct().collect()) == {"STORE_001", "STORE_002"}
    assert seen.count() == pos.where(F.col("store_id").isin("STORE_001", "STORE_002")).count()
    kv = spark.createDataFrame([(b"STORE_048#CASH_1190#1",), (b"STORE_048#CASH_1190#2",), (b"STOREX048#CASH_1",),
                                (b"STORE_048#CASH_1191#1",)], "row_key binary")
    got = [r["row_key"] for r in read_prefix(kv, "STORE_048#CASH_1190").collect()]
    assert got == ["STORE_048#CASH_1190#1", "STORE_048#CASH_1190#2"]
    assert read_prefix(kv, "STORE_048").count() == 3       # '_' is literal, not a wildcard
    day = on_day(fx.alerts(t), "alert_ts", "2024-01-15")
    assert day.count() == fx.alerts(t).where(F.to_date("alert_ts") == "2024-01-15").count() > 0


def test_export_results(spark):
    t = Tables(spark, SF001)
    path = tempfile.mkdtemp(prefix="storelens-dq-") + "/dq"
    export_results(gov.quality_scan(fx.pos_tx(t)), path, "2026-01-01")
    back = spark.read.parquet(path)
    assert back.count() == 3 and back.where("run_date = DATE'2026-01-01'").count() == 3


def test_trailing_buckets_do_not_change_results(spark):
    """Hot-key splitting by time bucket is exact, also at bucket edges."""
    from storelens.operators.offenders import HOUR_MICROS, rt_metrics
    t = Tables(spark, SF001)
    ev = fx.alert_events(t)
    # add events exactly on bucket boundaries and one window apart
    edge = spark.createDataFrame(
        [(10**9 + i, f"2024-01-0{d} {h}", "STORE_001", "CASH_1001", "cashier_promo_abuse", 0.5, 1.25)
         for i, (d, h) in enumerate([(2, "00:00:00"), (2, "01:00:00"), (1, "23:00:00"), (2, "06:00:00"),
                                     (2, "05:00:00"), (2, "05:59:59.999999")])],
        "alert_id long, alert_ts string, store_id string, cashier_id string, alert_type string, "
        "risk_score double, discount_usd double")
    edge = edge.select("alert_id", F.col("alert_ts").cast("timestamp_ntz").alias("alert_ts"), "store_id",
                       "cashier_id", "alert_type", "risk_score", F.col("discount_usd").cast("decimal(18,2)"))
    ev = ev.unionByName(edge)
    ref = rt_metrics(ev, bucket_micros=10_000 * 24 * HOUR_MICROS).collect()
    for b in (HOUR_MICROS, 6 * HOUR_MICROS):
        assert sorted(rt_metrics(ev, bucket_micros=b).collect()) == sorted(ref)


def test_profile_mean_is_exact_half_up(spark):
    """The profile mean is rounded half-up from the exact decimal sum, so a
    mean lying on a 4-place half rounds up whatever the summation order."""
    from decimal import ROUND_FLOOR, Decimal

    from storelens.operators.profiling import profile
    cases = {
        "tie_up": [0.01, 0.02, 0.02, 0.02] * 250,                     # 17.5 / 1000 = 0.0175
        "neg_tie": [-0.00005, -0.00005],                              # -0.00005 -> 0.0
        "pos_tie": [0.00005, 0.00005],                                # 0.00005 -> 0.0001
        "mixed": [-976.02, 9988.03, 4583.8, 12.34, -0.01, 3.0],
    }
    for name, vals in cases.items():
        df = spark.createDataFrame([(float(v),) for v in vals], "x double")
        got = profile(df, exact=True).collect()[0]["mean"]
        mean = sum(Decimal(repr(v)) for v in vals) / len(vals)
        want = float((mean * 10000 + Decimal("0.5")).to_integral_value(ROUND_FLOOR) / 10000)
        assert got == want, (name, got, want)


def test_scan_budget_counts_pruned_partitions_and_columns(spark):
    """G-10 measures what the scans would read: a day range on a
    day-partitioned table and a narrow projection both lower it."""
    from storelens.operators.sizing import scan_bytes
    ev = Tables(spark, SF01).events.withColumn("d", F.to_date("ts"))
    path = tempfile.mkdtemp(prefix="storelens-g10-") + "/ev"
    ev.write.partitionBy("d").parquet(path)
    full = spark.read.parquet(path)
    week = full.where(F.col("d") >= F.lit("2024-01-24").cast("date"))
    assert 0 < scan_bytes(week) < scan_bytes(full)
    assert scan_bytes(full.select("event_id")) < scan_bytes(full)
    budget = scan_bytes(week)
    assert gov.check_scan_budget(week, budget) is not None
    with pytest.raises(gov.ScanBudgetExceeded):
        gov.check_scan_budget(full, budget)
