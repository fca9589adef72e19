"""Registered queries for sources, sinks, filters and caps (S-02, S-05,
S-06, S-08, S-09, P-08, P-09, P-12, G-10) with their DuckDB twins.

The sink queries write what Spark derives from the input tables into a
fresh folder under the shared checkpoint folder (overwrite, so a retried
job replaces its own output) and return the table read back, so the
oracle checks the round trip: types, partition columns, merged schemas.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from storelens.operators import chunking as ch
from storelens.operators import governance as gov
from storelens.operators import offenders as off
from storelens.operators import revenue as rev
from storelens.operators import telemetry as tel
from storelens.operators import warranty as war
from storelens.operators.filters import cap_rows, checkout_log, lookup_purchase, on_day
from storelens.plans import fixtures as fx
from storelens.plans.oracle import with_views
from storelens.plans.q_governance import QUALITY_SQL
from storelens.plans.q_retail import ALERT_EVENTS, RANKING_SQL, TRAILING_SQL, WARRANTY_SQL
from storelens.plans.q_retrieval import CHUNKS_SQL
from storelens.plans.q_telemetry import LOGS_SQL
from storelens.plans.registry import query
from storelens.session import scratch_path
from storelens.sources import key_table as kt
from storelens.sources import logs as lg
from storelens.sources.tables import read_federated


def _fresh(t, name: str) -> str:
    return scratch_path(t.spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")


# ------------------------------------------------------------- P-08
ALERT_DAY = "2024-01-15"
PURCHASE_DAY = "1995-06-17"


@query("alerts_on_day", "P-08 A-02", with_views(f"""
SELECT store_id, count(*) AS alerts,
  count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse') AS promo_abuse_alerts,
  max(risk_score) AS max_risk_score
FROM alerts WHERE CAST(alert_ts AS DATE) = DATE '{ALERT_DAY}' GROUP BY 1""", "alerts"))
def alerts_on_day(t):
    """Alerts per store on one calendar day (a half-open range on the
    timestamp, so it reaches the scan as a pushed filter)."""
    a = on_day(fx.alerts(t), "alert_ts", ALERT_DAY)
    return a.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_if(F.col("alert_type") == "cashier_promo_abuse").alias("promo_abuse_alerts"),
        F.max("risk_score").alias("max_risk_score"))


@query("purchases_on_day", "P-08 P-05 A-06", with_views(f"""
SELECT store_id, payment_method,
  CAST(sum(CAST(subtotal_amount - discount + tax_amount AS DECIMAL(18,2))) AS DECIMAL(22,2)) AS net_revenue_usd,
  count(*) AS transactions, sum(total_quantity) AS units
FROM pos_tx WHERE total > 0 AND business_date = DATE '{PURCHASE_DAY}' GROUP BY 1, 2""", "pos_tx"))
def purchases_on_day(t):
    """Today's net revenue per store and payment method (date column)."""
    return rev.store_revenue(on_day(fx.pos_tx(t), "business_date", PURCHASE_DAY),
                             by=("store_id", "payment_method"))


# ------------------------------------------------------------- P-09
LOOKUP_CUSTOMER = "CUST_1"


@query("purchase_lookup_warranty", "P-09 J-03 J-01 J-02", with_views(
    f"SELECT * FROM ({WARRANTY_SQL}) WHERE customer_id = '{LOOKUP_CUSTOMER}'", "history_lines", "warranty"))
def purchase_lookup_warranty(t):
    """One customer's purchases (equality lookup) with warranty verdicts;
    the lookup is a filter on the grouping key, so it is applied below the
    per-transaction nesting."""
    found = lookup_purchase(fx.history(t), customer_id=LOOKUP_CUSTOMER)
    return war.warranty_triage(found, fx.warranty(t), fx.PURCHASE_AS_OF)


# ------------------------------------------------------------- P-12
@query("largest_transactions_capped", "P-12 L-01", with_views("""
SELECT tx_no, transaction_id, store_id, business_date, total FROM pos_tx
ORDER BY total DESC NULLS LAST, tx_no LIMIT 100""", "pos_tx"))
def largest_transactions_capped(t):
    """Largest checkout totals, answer capped at 100 rows (the cap is the
    feature; a unique tie-break keeps the cut deterministic)."""
    x = fx.pos_tx(t).select("tx_no", "transaction_id", "store_id", "business_date", "total")
    return cap_rows(x.orderBy(F.col("total").desc_nulls_last(), F.col("tx_no").asc()), 100)


# ------------------------------------------------------------- S-02
FEDERATED_CASHIER = "CASH_1007"


@query("federated_checkout_log", "S-02 P-10 L-02", with_views(f"""
SELECT transaction_id, event_timestamp, store_id, pos_terminal_id, cashier_id, payment_method, total_amount_usd
FROM silver WHERE cashier_id = '{FEDERATED_CASHIER}'
ORDER BY event_timestamp ASC NULLS LAST, transaction_id ASC NULLS LAST LIMIT 10""", "silver"))
def federated_checkout_log(t):
    """The checkout log read from its object-store parquet copy. The copy
    is laid out by store, sorted by cashier and time inside each file, so
    the cashier predicate is pushed into the reader and skips row groups
    by their min/max statistics."""
    path = _fresh(t, "silver")
    (fx.silver(t).hint("rebalance", "store_id").sortWithinPartitions("cashier_id", "event_timestamp")
       .write.mode("overwrite").partitionBy("store_id").parquet(path))
    fed = read_federated(t.spark, path)
    return checkout_log(fed, FEDERATED_CASHIER, limit=10)


# ------------------------------------------------------------- S-06
TXN_PREFIX = "STORE_001#TXN"
CASHIER_PREFIX = "STORE_001#CASH_10"


def _cell(family: str, name: str):
    return F.col(family)[name].alias(name)


@query("enriched_prefix_read", "S-06", with_views(f"""
SELECT * FROM enriched WHERE starts_with(row_key, '{TXN_PREFIX}') ORDER BY row_key LIMIT 5""", "alerts", "silver", "enriched"))
def enriched_prefix_read(t):
    """The first five enriched checkouts of a store from the key-clustered table, their cells as columns."""
    path = _fresh(t, "enriched")
    kt.write_key_table(fx.enriched_transactions(t), path)
    return kt.read_key_prefix(t.spark, path, TXN_PREFIX).select(
        "row_key", *[_cell("alerts", c) for c in ("alert_count", "promo_abuse_count")],
        *[_cell("tx", c) for c in ("cashier_id", "pos_terminal_id", "payment_method", "total_amount_usd")])


@query("enriched_store_cells", "S-06 A-06", with_views("""
SELECT regexp_extract(row_key, '^([^#]*)', 1) AS store_id, count(*) AS row_keys, count(alert_count) + count(promo_abuse_count) AS alert_cells,
  count(cashier_id) + count(pos_terminal_id) + count(payment_method) + count(total_amount_usd) AS tx_cells,
  CAST(sum(CAST(total_amount_usd AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_amount_usd, min(row_key) AS first_key, max(row_key) AS last_key
FROM enriched GROUP BY 1""", "alerts", "silver", "enriched"))
def enriched_store_cells(t):
    """Every store of the key-clustered table: its keys, the cells of each family, and a sum over a cell."""
    path = _fresh(t, "enriched")
    kt.write_key_table(fx.enriched_transactions(t), path)
    x = kt.read_key_prefix(t.spark, path, "", limit=None)
    return x.groupBy(F.regexp_extract("row_key", "^([^#]*)", 1).alias("store_id")).agg(
        F.count(F.lit(1)).alias("row_keys"), F.sum(F.size("alerts")).alias("alert_cells"), F.sum(F.size("tx")).alias("tx_cells"),
        F.sum(F.col("tx")["total_amount_usd"].cast("decimal(18,2)")).alias("total_amount_usd"),
        F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"))


@query("cashier_families_read", "S-06 T-04", with_views(f"""
SELECT row_key, CASE WHEN override_rate_pct >= 50 THEN 'flagged' WHEN override_rate_pct >= 25 THEN 'review' ELSE 'clear' END AS audit_status,
  CAST(txn_count AS VARCHAR) AS txn_count, CAST(override_count AS VARCHAR) AS override_count, CAST(promo_count AS VARCHAR) AS promo_count,
  CASE WHEN override_count > 0 THEN CAST(CAST(override_rate_pct AS DECIMAL(5,2)) AS VARCHAR) END AS override_rate_pct
FROM ({TRAILING_SQL}) WHERE starts_with(row_key, '{CASHIER_PREFIX}') ORDER BY row_key""", extra={"alert_events": ALERT_EVENTS}))
def cashier_families_read(t):
    """All rows under a cashier prefix from the key-clustered table, flags and stats as columns."""
    path = _fresh(t, "realtime_alerts")
    kt.write_key_table(fx.realtime_alerts(t), path)
    return kt.read_key_prefix(t.spark, path, CASHIER_PREFIX, limit=None).select(
        "row_key", _cell("flags", "audit_status"),
        *[_cell("stats", c) for c in ("txn_count", "override_count", "promo_count", "override_rate_pct")])


# ------------------------------------------------------------- S-05
SCHEMA_CHANGE_AT = f"TIMESTAMP '{fx.TELEMETRY_BASE}' + INTERVAL 10 MINUTE"


@query("evolving_log_export", "S-05 M-01", with_views(f"""
SELECT *, CASE WHEN timestamp >= {SCHEMA_CHANGE_AT} THEN 'v2' END AS schema_version
FROM logs WHERE input_ref IS NOT NULL OR output_ref IS NOT NULL""", "log_refs", extra={"logs": LOGS_SQL}))
def evolving_log_export(t):
    """The log export appended in two steps; the later rows carry a column
    the earlier files lack. Reading with merged schemas returns every row,
    the new column null for the older files."""
    path = _fresh(t, "log_export")
    refs = tel.extract_refs(fx.inference_logs(t))
    cut = F.timestamp_add("MINUTE", F.lit(10), F.lit(fx.TELEMETRY_BASE).cast("timestamp_ntz"))
    lg.append_evolving(refs.where(F.col("timestamp") < cut), path)
    lg.append_evolving(refs.where(F.col("timestamp") >= cut).withColumn("schema_version", F.lit("v2")), path)
    return lg.read_evolving(t.spark, path)


# ------------------------------------------------------------- S-08
RUN_DATE = "2024-01-31"


@query("exported_quality_results", "S-08 G-04", with_views(
    f"SELECT *, DATE '{RUN_DATE}' AS run_date FROM ({QUALITY_SQL})", "pos_tx"))
def exported_quality_results(t):
    """Quality-rule results persisted to a governance table partitioned by
    run date, read back."""
    path = _fresh(t, "quality_results")
    lg.export_results(gov.quality_scan(fx.pos_tx(t)), path, RUN_DATE, mode="overwrite")
    return t.spark.read.parquet(path)


# ------------------------------------------------------------- S-09
PRUNED_SQL = """
SELECT insertId, timestamp, log_date FROM (
  SELECT insert_id AS insertId, timestamp + CAST(conversation_id AS BIGINT) % 9 * INTERVAL 1 DAY AS timestamp,
    CAST(timestamp + CAST(conversation_id AS BIGINT) % 9 * INTERVAL 1 DAY AS DATE) AS log_date FROM logs)
WHERE log_date BETWEEN DATE '2026-01-03' AND DATE '2026-01-05'"""


@query("log_days_read", "S-04", with_views(PRUNED_SQL, "log_refs", extra={"logs": LOGS_SQL}))
def log_days_read(t):
    """The day-partitioned log table (nine days) written and read back pruned to three days."""
    path = _fresh(t, "log_days")
    days = F.col("labels.gen_ai_conversation_id").cast("long") % 9
    lg.write_logs(fx.inference_logs(t).select("insertId", F.timestamp_add("DAY", days, F.col("timestamp")).alias("timestamp")),
                  path, mode="overwrite")
    return lg.read_logs(t.spark, path, "2026-01-03", "2026-01-05")


@query("persisted_manual_chunks", "S-09 R-01", CHUNKS_SQL)
def persisted_manual_chunks(t):
    """The chunk table written clustered by document (one folder write,
    each document's chunks in one file) and scanned back."""
    path = _fresh(t, "chunks")
    lg.write_chunks(ch.manual_chunks(t.documents), path)
    return t.spark.read.parquet(path)


@query("persisted_chunk_vectors", "S-09 J-08", with_views("SELECT * FROM vchunks", "vchunks"))
def persisted_chunk_vectors(t):
    """The chunk table with its embeddings written clustered by document and scanned back."""
    path = _fresh(t, "chunk_vectors")
    lg.write_chunks(fx.vchunks(t), path)
    return t.spark.read.parquet(path)


# ------------------------------------------------------------- G-10
SCAN_BUDGET_BYTES = 8 * 1024 ** 3


@query("budgeted_offender_ranking", "G-10 A-01", with_views(RANKING_SQL + "\nLIMIT 20", "alerts"))
def budgeted_offender_ranking(t):
    """The offender ranking, admitted only when the scans of its own plan (the last
    7 days of alerts: pruned partitions on a day-partitioned table, and
    only the columns read) are within the byte budget; the check runs
    before any job."""
    return gov.check_scan_budget(off.rank_offenders(fx.alerts(t), 7, fx.ALERTS_AS_OF, 20), SCAN_BUDGET_BYTES)
