"""Registered retail-analytics queries (F1, F6) with their DuckDB twins."""

from __future__ import annotations

from storelens.functions.metrics import round_half_up
from storelens.operators import inventory as inv_ops
from storelens.plans import fixtures as fx
from storelens.plans.oracle import r4, with_views
from storelens.plans.registry import query

COVER = ("CAST(shelf_qty + backroom_qty AS DOUBLE) / "
         "(CAST(total_units_sold_intraday AS DOUBLE) / 12.0::DOUBLE)")
COVER_SAFE = f"(CASE WHEN total_units_sold_intraday <> 0 THEN {COVER} END)"
BAND = (f"CASE WHEN {COVER_SAFE} <= 6.0 THEN 'CRITICAL_BURN_SPIKE' "
        f"WHEN {COVER_SAFE} <= 12.0 THEN 'MONITOR_VELOCITY' "
        f"WHEN {COVER_SAFE} IS NOT NULL THEN 'NORMAL' END")


@query("stockout_risk", "P-01 P-02 P-03 P-04 L-01", with_views(f"""
SELECT store_id, store_name, city, item_id, shelf_qty, backroom_qty,
  shelf_qty + backroom_qty AS total_on_hand_inventory,
  CAST(intraday_gross_revenue_usd AS DECIMAL(18,2)) AS intraday_gross_revenue_usd,
  {r4(COVER_SAFE)} AS est_cover_hours_remaining,
  {BAND} AS risk_band, reconciliation_status
FROM inventory
WHERE {COVER_SAFE} < 20.0
ORDER BY intraday_gross_revenue_usd DESC NULLS LAST, est_cover_hours_remaining ASC NULLS LAST, store_id, item_id
LIMIT 20""", "inventory"))
def stockout_risk(t):
    """Stockout list: cover < 20 h, revenue desc, cover asc, top 20."""
    return inv_ops.stockout_risk(fx.inventory(t))


@query("inventory_risk_bands", "P-01 P-02 P-03 P-06", with_views(f"""
SELECT {BAND} AS risk_band, count(*) AS positions, sum(shelf_qty + backroom_qty) AS on_hand_units
FROM inventory GROUP BY 1""", "inventory"))
def inventory_risk_bands(t):
    """Positions and on-hand units per cover-hour risk band, whole ledger."""
    return inv_ops.risk_band_counts(fx.inventory(t))


@query("shelf_ratios", "P-06", with_views(f"""
SELECT store_id, item_id, {r4('CAST(shelf_qty AS DOUBLE) / CAST(shelf_qty + backroom_qty AS DOUBLE) * 100.0::DOUBLE')} AS shelf_stock_ratio
FROM inventory WHERE shelf_qty + backroom_qty <> 0
UNION ALL
SELECT store_id, item_id, NULL FROM inventory WHERE shelf_qty + backroom_qty = 0""", "inventory"))
def shelf_ratios(t):
    """Share of the on-hand stock that stands on the shelf, per position."""
    led = inv_ops.with_ledger_metrics(fx.inventory(t))
    return led.select("store_id", "item_id", round_half_up("shelf_stock_ratio", 4).alias("shelf_stock_ratio"))


# ---------------------------------------------------------------- alerts
from pyspark.sql import functions as F  # noqa: E402

from storelens.operators import offenders as off  # noqa: E402
from storelens.operators import revenue as rev  # noqa: E402
from storelens.operators import warranty as war  # noqa: E402
from storelens.operators.access import apply_row_policy, prefix_heads, read_prefix  # noqa: E402
from storelens.operators.filters import bound_sql  # noqa: E402
from storelens.plans.oracle import VIEWS, exact_ratio  # noqa: E402

AS_OF = f"TIMESTAMP '{fx.ALERTS_AS_OF}'"
ALERT_EVENTS = VIEWS["alerts"].replace(
    "AS risk_score\nFROM events", "AS risk_score, CAST(value AS DECIMAL(18,2)) AS discount_usd\nFROM events")
RANKING_SQL = f"""
SELECT store_id, cashier_id, count(alert_id) AS alert_count,
  round(avg(risk_score), 4) AS avg_risk_score,
  max(risk_score) AS max_risk_score, max(alert_ts) AS latest_alert_ts
FROM alerts
WHERE alert_type = 'cashier_promo_abuse' AND alert_ts >= {AS_OF} - INTERVAL 7 DAY
GROUP BY store_id, cashier_id
ORDER BY alert_count DESC, avg_risk_score DESC NULLS LAST, store_id, cashier_id"""


@query("offender_ranking", "A-01 P-07 L-01", with_views(RANKING_SQL + "\nLIMIT 20", "alerts"))
def offender_ranking(t):
    """Top 20 promo-abuse offenders of the last 7 days."""
    return off.rank_offenders(fx.alerts(t), 7, fx.ALERTS_AS_OF, 20)


@query("offender_ranking_bound_sql", "P-11 A-01", with_views(RANKING_SQL + "\nLIMIT 20", "alerts"))
def offender_ranking_bound_sql(t):
    """The reference ranking SQL with user values as bound parameters."""
    avg = "CAST(ROUND(AVG(CAST(risk_score AS DECIMAL(28,18))), 4) AS DOUBLE)"
    return bound_sql(t.spark, f"""
        SELECT store_id, cashier_id, count(alert_id) AS alert_count, {avg} AS avg_risk_score,
               max(risk_score) AS max_risk_score, max(alert_ts) AS latest_alert_ts
        FROM {{alerts}}
        WHERE alert_type = :alert_type
          AND alert_ts >= CAST(:as_of AS TIMESTAMP_NTZ) - make_interval(0, 0, 0, :days)
        GROUP BY store_id, cashier_id
        ORDER BY alert_count DESC, avg_risk_score DESC NULLS LAST, store_id, cashier_id
        LIMIT :n""", alert_type="cashier_promo_abuse", as_of=fx.ALERTS_AS_OF, days=7, n=20,
        alerts=fx.alerts(t))


@query("override_rate_daily", "A-02", with_views(f"""
SELECT store_id, CAST(alert_ts AS DATE) AS alert_date, count(*) AS alerts,
  count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse') AS promo_abuse_alerts,
  {exact_ratio("count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse')", 'count(*)', 2, 100)} AS override_rate_pct
FROM alerts GROUP BY 1, 2""", "alerts"))
def override_rate_daily(t):
    """Promo-override rate (percent) per store and calendar day."""
    return off.override_rate(fx.alerts(t), by=("store_id",), as_pct=True, daily=True)


@query("cashier_baseline", "A-03 P-07", with_views(f"""
SELECT cashier_id, count(*) AS alerts,
  count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse') AS promo_abuse_alerts,
  {exact_ratio("count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse')", 'count(*)', 2, 100)} AS baseline_rate_pct
FROM alerts WHERE alert_ts >= {AS_OF} - INTERVAL 7 DAY GROUP BY 1""", "alerts"))
def cashier_baseline(t):
    """7-day alert baseline per cashier."""
    return off.cashier_baseline(fx.alerts(t), 7, fx.ALERTS_AS_OF)


TRAILING_SQL = f"""
SELECT concat_ws('#', store_id, cashier_id, CAST(alert_id AS VARCHAR)) AS row_key, store_id, cashier_id,
  alert_id AS event_id, alert_ts AS event_ts, txn_count, override_count, promo_count,
  {exact_ratio('override_count', 'txn_count', 2, 100)} AS override_rate_pct,
  {exact_ratio('promo_count', 'txn_count', 2, 100)} AS promo_rate_pct,
  CAST(CAST(cents AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS total_discount_usd,
  {exact_ratio('cents', 'txn_count * 100', 2)} AS avg_discount_usd
FROM (
  SELECT *, count(*) OVER w AS txn_count,
    sum(CASE WHEN alert_type = 'cashier_promo_abuse' THEN 1 ELSE 0 END) OVER w AS override_count,
    sum(CASE WHEN alert_type = 'purchase' THEN 1 ELSE 0 END) OVER w AS promo_count,
    sum(CAST(discount_usd * 100 AS BIGINT)) OVER w AS cents
  FROM alert_events
  WINDOW w AS (PARTITION BY cashier_id ORDER BY alert_ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW))"""


@query("cashier_trailing_metrics", "A-04 W-04", with_views(TRAILING_SQL, extra={"alert_events": ALERT_EVENTS}))
def cashier_trailing_metrics(t):
    """Trailing-hour cashier metrics at every event."""
    return off.rt_metrics(fx.alert_events(t))


@query("latest_cashier_snapshots", "W-05", with_views(f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY cashier_id ORDER BY event_ts DESC, event_id DESC) AS rn
  FROM ({TRAILING_SQL})) WHERE rn <= 5""", extra={"alert_events": ALERT_EVENTS}))
def latest_cashier_snapshots(t):
    """Latest five trailing snapshots per cashier."""
    return off.latest_rt_metrics(fx.alert_events(t), 5)


@query("store_prefix_heads", "S-06", with_views(f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY key_prefix ORDER BY row_key) AS rn
  FROM (SELECT *, regexp_extract(row_key, '^([^#]*#[^#]*)', 1) AS key_prefix FROM ({TRAILING_SQL})))
WHERE rn <= 5""", extra={"alert_events": ALERT_EVENTS}))
def store_prefix_heads(t):
    """Key-prefix read (first 5 keys, key order) for every STORE#CASHIER prefix."""
    return prefix_heads(off.rt_metrics(fx.alert_events(t)),
                        lambda k: F.regexp_extract(k, r"^([^#]*#[^#]*)", 1), 5)


KEY_PREFIX = "STORE_001#CASH_10"


@query("key_prefix_read", "S-06", with_views(f"""
SELECT row_key, cashier_id, event_ts, txn_count FROM ({TRAILING_SQL}) WHERE starts_with(row_key, '{KEY_PREFIX}') ORDER BY row_key LIMIT 5""",
                                           extra={"alert_events": ALERT_EVENTS}))
def key_prefix_read(t):
    """The first five rows, in key order, whose binary key starts with a literal prefix."""
    m = off.rt_metrics(fx.alert_events(t)).select(F.encode("row_key", "UTF-8").alias("row_key"), "cashier_id", "event_ts", "txn_count")
    return read_prefix(m, KEY_PREFIX, 5)


@query("audit_status_counts", "T-04 A-04", with_views(f"""
SELECT store_id, CASE WHEN override_rate_pct >= 50.0 THEN 'flagged' WHEN override_rate_pct >= 25.0 THEN 'review'
  ELSE 'clear' END AS audit_status, count(*) AS snapshots
FROM ({TRAILING_SQL}) GROUP BY 1, 2""", extra={"alert_events": ALERT_EVENTS}))
def audit_status_counts(t):
    """Trailing snapshots per store and audit flag."""
    m = off.audit_status(off.rt_metrics(fx.alert_events(t)))
    return m.groupBy("store_id", "audit_status").agg(F.count(F.lit(1)).alias("snapshots"))


@query("live_vs_baseline", "J-07 A-03 A-04 W-05", with_views(f"""
WITH live AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY cashier_id ORDER BY event_ts DESC, event_id DESC) AS rn
  FROM ({TRAILING_SQL})) WHERE rn = 1),
base AS (
  SELECT cashier_id, count(*) AS alerts, count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse') AS promo_abuse_alerts,
    {exact_ratio("count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse')", 'count(*)', 2, 100)} AS baseline_rate_pct
  FROM alerts WHERE alert_ts >= {AS_OF} - INTERVAL 7 DAY GROUP BY 1)
SELECT coalesce(l.cashier_id, b.cashier_id) AS cashier_id, l.event_ts AS live_event_ts, l.txn_count, l.override_count,
  l.override_rate_pct, l.promo_rate_pct, b.alerts AS baseline_alerts, b.promo_abuse_alerts AS baseline_promo_abuse_alerts,
  b.baseline_rate_pct, {r4('l.override_rate_pct - b.baseline_rate_pct', 2)} AS rate_difference_pct
FROM live l FULL OUTER JOIN base b ON l.cashier_id = b.cashier_id""", "alerts", extra={"alert_events": ALERT_EVENTS}))
def live_vs_baseline(t):
    """Latest live trailing metrics vs the 7-day baseline, per cashier."""
    live = off.latest_rt_metrics(fx.alert_events(t), 1)
    return off.live_vs_baseline(live, off.cashier_baseline(fx.alerts(t), 7, fx.ALERTS_AS_OF))


TOP_SQL = f"SELECT cashier_id FROM ({RANKING_SQL}) LIMIT 1"


@query("offender_checkout_audit", "J-06 P-10", with_views(f"""
SELECT transaction_id, event_timestamp, store_id, pos_terminal_id, cashier_id, payment_method, total_amount_usd
FROM silver WHERE cashier_id IN ({TOP_SQL})""", "alerts", "silver"))
def offender_checkout_audit(t):
    """All checkout rows of the top offender (rank, then drill down)."""
    return off.audit_top_offender(fx.alerts(t), fx.silver(t), 7, fx.ALERTS_AS_OF)


@query("offender_checkout_log", "J-06 P-10 L-02", with_views(f"""
SELECT transaction_id, event_timestamp, store_id, pos_terminal_id, cashier_id, payment_method, total_amount_usd
FROM silver WHERE cashier_id IN ({TOP_SQL})
ORDER BY event_timestamp ASC NULLS LAST, transaction_id ASC NULLS LAST LIMIT 10""", "alerts", "silver"))
def offender_checkout_log(t):
    """First 10 checkout rows (time ascending) of the top offender."""
    return off.audit_top_offender(fx.alerts(t), fx.silver(t), 7, fx.ALERTS_AS_OF, limit=10)


# ------------------------------------------------------------ purchases
@query("store_revenue", "P-05 A-06", with_views("""
SELECT store_id, business_date, payment_method,
  CAST(sum(CAST(subtotal_amount - discount + tax_amount AS DECIMAL(18,2))) AS DECIMAL(22,2)) AS net_revenue_usd,
  count(*) AS transactions, sum(total_quantity) AS units
FROM pos_tx WHERE total > 0 GROUP BY 1, 2, 3""", "pos_tx"))
def store_revenue(t):
    """Net revenue and transactions per store, day and payment method."""
    return rev.store_revenue(fx.pos_tx(t))


WARRANTY_SQL = f"""
SELECT h.transaction_id, h.business_date, h.customer_loyalty_tier, h.store_id, h.customer_id, h.payment_method, h.line_no, h.item_id AS product_id,
  h.item_name AS product_name, h.unit_price, w.warranty_duration_months, w.service_level, w.coverage_scope_details,
  w.exclusions_and_limitations, w.official_retailer_guarantee_and_sla, w.support_url,
  (year(DATE '{fx.PURCHASE_AS_OF}') - year(h.business_date)) * 12 + month(DATE '{fx.PURCHASE_AS_OF}') - month(h.business_date) AS months_since_purchase,
  (year(DATE '{fx.PURCHASE_AS_OF}') - year(h.business_date)) * 12 + month(DATE '{fx.PURCHASE_AS_OF}') - month(h.business_date)
    <= w.warranty_duration_months AS in_warranty
FROM history_lines h JOIN warranty w ON h.item_id = w.product_id"""


@query("warranty_triage", "J-01 J-02", with_views(WARRANTY_SQL, "history_lines", "warranty"))
def warranty_triage(t):
    """Every purchased item with its warranty policy and coverage verdict."""
    return war.warranty_triage(fx.history(t), fx.warranty(t), fx.PURCHASE_AS_OF)


@query("warranty_by_customer", "J-03 J-02", with_views(f"""
SELECT customer_id, count(*) AS items, count(*) FILTER (WHERE in_warranty) AS items_in_warranty,
  count(*) FILTER (WHERE NOT in_warranty) AS items_out_of_warranty
FROM ({WARRANTY_SQL}) GROUP BY 1""", "history_lines", "warranty"))
def warranty_by_customer(t):
    """Covered and expired items per customer."""
    return war.coverage_by_customer(war.warranty_triage(fx.history(t), fx.warranty(t), fx.PURCHASE_AS_OF))


@query("entitled_store_revenue", "J-11 A-06", with_views("""
WITH grants AS (SELECT DISTINCT cashier_id AS user_id, store_id FROM silver),
rev AS (SELECT store_id, sum(CAST(subtotal_amount - discount + tax_amount AS DECIMAL(18,2))) AS net, count(*) AS n
        FROM pos_tx WHERE total > 0 GROUP BY 1)
SELECT g.user_id, count(*) AS entitled_stores, CAST(sum(r.net) AS DECIMAL(22,2)) AS net_revenue_usd, sum(r.n) AS transactions
FROM grants g JOIN rev r ON g.store_id = r.store_id GROUP BY 1""", "silver", "pos_tx"))
def entitled_store_revenue(t):
    """Revenue each user may see under per-store row isolation: the
    ledger is aggregated per store first, then joined to the grants."""
    grants = fx.silver(t).select(F.col("cashier_id").alias("user_id"), "store_id").distinct()
    per_store = rev.store_revenue(fx.pos_tx(t), by=("store_id",))
    return (grants.join(per_store, "store_id").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("entitled_stores"),
        F.sum("net_revenue_usd").cast("decimal(22,2)").alias("net_revenue_usd"),
        F.sum("transactions").alias("transactions")))


ROW_POLICY_USER = "CASH_1007"


@query("row_policy_ledger", "J-11", with_views(f"""
SELECT tx_no, store_id, total FROM pos_tx
WHERE store_id IN (SELECT store_id FROM silver WHERE cashier_id = '{ROW_POLICY_USER}')""", "silver", "pos_tx"))
def row_policy_ledger(t):
    """The ledger rows one user may see under per-store row isolation."""
    grants = fx.silver(t).select(F.col("cashier_id").alias("user"), "store_id")
    return apply_row_policy(fx.pos_tx(t), grants, ROW_POLICY_USER).select("tx_no", "store_id", "total")
