"""Registered governance queries (F2) with their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.operators import governance as gov
from storelens.operators import session_catalog
from storelens.operators import profile_states as ps
from storelens.operators import profiling as prof
from storelens.operators import warranty as war
from storelens.operators.join_mining import join_candidates as mine_joins
from storelens.plans import fixtures as fx
from storelens.plans.oracle import exact_ratio, r4, with_views
from storelens.plans.registry import query
from storelens.session import scratch_path
from storelens.sources.tables import SCHEMAS, TABLE_NAMES

def _exact_mean(c: str) -> str:
    """DuckDB twin of ``profiling.exact_mean_sql``: half-up 4-place mean from
    the exact decimal sum (HUGEINT floor arithmetic)."""
    d6 = f"TRY_CAST({c} AS DECIMAL(38,6))"
    s6 = f"(CASE WHEN count({d6}) = count({c}) THEN sum({d6}) END)"
    u = f"CAST({s6} * 1000000 AS HUGEINT)"
    a, b = f"(2 * {u} + 100 * count({c}))", f"(CAST(200 AS HUGEINT) * count({c}))"
    q = f"(({a} - ((({a}) % {b}) + {b}) % {b}) // {b})"
    return (f"(CASE WHEN {s6} IS NOT NULL AND abs({s6}) < 1e25 THEN CAST({q} AS DOUBLE) / 10000.0 "
            f"ELSE {r4(f'avg(CAST({c} AS DOUBLE))')} END)")


def _profile_sql(table: str) -> str:
    parts = []
    for f in SCHEMAS[table].fields:
        c, dt = f'"{f.name}"', f.dataType
        num = isinstance(dt, (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType))
        cx = isinstance(dt, T.ArrayType)
        if isinstance(dt, T.TimestampNTZType):
            mn, mx = f"strftime(min({c}), '%Y-%m-%d %H:%M:%S.%f')", f"strftime(max({c}), '%Y-%m-%d %H:%M:%S.%f')"
        elif num or cx:
            mn = mx = "CAST(NULL AS VARCHAR)"
        else:
            mn, mx = f"CAST(min({c}) AS VARCHAR)", f"CAST(max({c}) AS VARCHAR)"
        parts.append(f"""SELECT '{table}' AS table_name, '{f.name}' AS column_name, '{dt.simpleString()}' AS data_type,
  count(*) AS row_count, count(*) - count({c}) AS null_count,
  {exact_ratio(f'count(*) - count({c})', 'count(*)', 4)} AS null_ratio,
  {'CAST(NULL AS BIGINT)' if cx else f'count(DISTINCT {c})'} AS distinct_count,
  {mn} AS min_value, {mx} AS max_value,
  {f'CAST(min({c}) AS DOUBLE)' if num else 'CAST(NULL AS DOUBLE)'} AS min_number,
  {f'CAST(max({c}) AS DOUBLE)' if num else 'CAST(NULL AS DOUBLE)'} AS max_number,
  {_exact_mean(c) if num else 'CAST(NULL AS DOUBLE)'} AS mean,
  {r4(f'stddev_samp(CAST({c} AS DOUBLE))') if num else 'CAST(NULL AS DOUBLE)'} AS stddev
FROM {table}""")
    return "\nUNION ALL\n".join(parts)


# Parts that the merged profile covers: a range of days and a range of months.
STATE_DAYS = ("2024-01-05", "2024-01-20")
STATE_MONTHS = ("1993-07", "1996-02")
_STATE_COLUMNS = ("table_name", "column_name", "data_type", "row_count", "null_count", "null_ratio", "min_value", "max_value",
                  "min_number", "max_number", "mean")
_MERGED_SQL = "\nUNION ALL\n".join([
    _profile_sql("events").replace("FROM events", "FROM (SELECT * FROM events WHERE strftime(ts, '%Y-%m-%d') "
                                   f"BETWEEN '{STATE_DAYS[0]}' AND '{STATE_DAYS[1]}')"),
    _profile_sql("orders").replace("FROM orders", "FROM (SELECT * FROM orders WHERE strftime(o_orderdate, '%Y-%m') "
                                   f"BETWEEN '{STATE_MONTHS[0]}' AND '{STATE_MONTHS[1]}')")])


@query("merged_profiles", "G-01 G-02", f"""
SELECT {', '.join(_STATE_COLUMNS)}, true AS sketch_ok FROM ({_MERGED_SQL})""")
def merged_profiles(t):
    """Profiles of a range of days and of months from stored states, one small row per part and column; the
    state of one day is written twice, as by a replay. ``sketch_ok``: the merged distinct count lies within
    a tenth of the exact one."""
    path = scratch_path(t.spark, f"tables/profile-states-{uuid.uuid4().hex[:12]}")
    day, month = F.to_date("ts").cast("string"), F.date_format("o_orderdate", "yyyy-MM")
    ps.write_states(ps.profile_states(t.events, day, "events"), path)
    ps.write_states(ps.profile_states(t.events.where(day == STATE_DAYS[0]), day, "events"), path)
    ps.write_states(ps.profile_states(t.orders, month, "orders"), path)
    states = (ps.read_states(t.spark, path, "events", *STATE_DAYS)
              .unionByName(ps.read_states(t.spark, path, "orders", *STATE_MONTHS)))
    exact = prof.profile_all({"events": t.events.where(day.between(*STATE_DAYS)),
                              "orders": t.orders.where(month.between(*STATE_MONTHS))}, exact=True)
    exact = exact.select("table_name", "column_name", F.col("distinct_count").alias("_d"))
    near = F.abs(F.col("distinct_count") - F.col("_d")) <= F.col("_d") * 0.1 + 1
    return (ps.merge_states(states).join(exact, ["table_name", "column_name"])
            .select(*_STATE_COLUMNS, near.alias("sketch_ok")))


@query("table_profiles", "G-01 G-02", "\nUNION ALL\n".join(_profile_sql(t) for t in TABLE_NAMES))
def table_profiles(t):
    """Exact column profiles of every input table, one union."""
    return prof.profile_all({n: getattr(t, n) for n in TABLE_NAMES}, exact=True)


@query("table_profiles_approx", "G-01 G-02")
def table_profiles_approx(t):
    """Default (one-pass, sketch-based) profiles with quantiles, all tables."""
    return prof.profile_all({n: getattr(t, n) for n in TABLE_NAMES})


@query("sampled_lineitem_profile", "G-03 G-01")
def sampled_lineitem_profile(t):
    """Profile of a 10 percent sample of lineitem (sampling is the feature)."""
    return prof.profile(prof.sample_or_full(t.lineitem, 10.0))


SAMPLE_SQL = "SELECT * FROM lineitem WHERE ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 8))::BIGINT % 100 < 10"


def _top_sql(table: str) -> str:
    parts = []
    for f in SCHEMAS[table].fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.ArrayType)):
            continue
        v = f"strftime({f.name}, '%Y-%m-%d %H:%M:%S.%f')" if isinstance(f.dataType, T.TimestampNTZType) else f"CAST({f.name} AS VARCHAR)"
        parts.append(f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, CASE WHEN length({v}) > 64 THEN 'md5:' || md5({v}) ELSE {v} END AS value FROM {table}")
    return "\nUNION ALL\n".join(parts)


@query("table_value_profiles", "G-01 G-02", f"""
SELECT table_name, column_name, value, frequency, row_count FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, column_name ORDER BY frequency DESC, value ASC NULLS FIRST) AS rank,
    CAST(sum(frequency) OVER (PARTITION BY table_name, column_name) AS BIGINT) AS row_count
  FROM (SELECT table_name, column_name, value, count(*) AS frequency FROM ({" UNION ALL ".join(_top_sql(n) for n in TABLE_NAMES)}) GROUP BY 1, 2, 3))
WHERE rank <= 3""")
def table_value_profiles(t):
    """The three most frequent values in the profile of every column of every table."""
    out = None
    for n in TABLE_NAMES:
        p = prof.value_profile(getattr(t, n), 3).select(F.lit(n).alias("table_name"), "column_name", "row_count",
                                                         F.explode("top_values").alias("v"))
        p = p.select("table_name", "column_name", "v.value", "v.frequency", "row_count")
        out = p if out is None else out.unionByName(p)
    return out


@query("hash_sampled_lineitem_profile", "G-03 G-01", with_views(
    _profile_sql("lineitem").replace("FROM lineitem", "FROM sampled"), extra={"sampled": SAMPLE_SQL}))
def hash_sampled_lineitem_profile(t):
    """Exact profile of a repeatable 10 percent sample of lineitem (sampling is the feature)."""
    p = prof.profile(prof.hash_sample(t.lineitem, 10, "l_orderkey", "l_linenumber"), exact=True)
    return p.withColumn("table_name", F.lit("lineitem"))


@query("profile_sketch_errors", "G-01", "\nUNION ALL\n".join(
    f"SELECT 'orders' AS table_name, '{f.name}' AS column_name, count(DISTINCT {f.name}) AS distinct_count, true AS sketch_ok FROM orders"
    for f in SCHEMAS["orders"].fields))
def profile_sketch_errors(t):
    """Exact distinct counts of orders, and whether the sketches of the default profile come within a tenth."""
    return prof.approximation_errors(t.orders).withColumn("table_name", F.lit("orders"))


@query("conversation_top_values", "G-01", """
SELECT column_name, value, frequency, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY frequency DESC, value ASC NULLS FIRST) AS rank
  FROM (SELECT column_name, value, count(*) AS frequency FROM (
      SELECT 'conv_id' AS column_name, CAST(conv_id AS VARCHAR) AS value FROM conversations
      UNION ALL SELECT 'turn', CAST(turn AS VARCHAR) FROM conversations
      UNION ALL SELECT 'role', role FROM conversations
      UNION ALL SELECT 'text', text FROM conversations) GROUP BY 1, 2))
WHERE rank <= 5""")
def conversation_top_values(t):
    """Five most frequent values of every conversations column."""
    return prof.top_values(t.conversations, 5)


QUALITY_SQL = f"""
SELECT rule_name, dimension, column_name, rule_expr, threshold, passed, evaluated, evaluated - passed AS failed,
  {exact_ratio('passed', 'evaluated', 4)} AS pass_ratio,
  CASE WHEN evaluated = 0 OR passed >= ceil(threshold * evaluated) THEN 'PASSED' ELSE 'FAILED' END AS status
FROM (
  SELECT 'transaction_id_not_null' AS rule_name, 'COMPLETENESS' AS dimension, 'transaction_id' AS column_name,
    '`transaction_id` IS NOT NULL' AS rule_expr, CAST(1.0 AS DOUBLE) AS threshold,
    count(*) FILTER (WHERE transaction_id IS NOT NULL) AS passed, count(*) AS evaluated FROM pos_tx
  UNION ALL
  SELECT 'total_matches_parts', 'INTEGRITY', NULL, 'total = subtotal_amount - discount + tax_amount', 1.0,
    count(*) FILTER (WHERE coalesce(total = subtotal_amount - discount + tax_amount, false)), count(*) FROM pos_tx
  UNION ALL
  SELECT 'items_within_quantity', 'INTEGRITY', NULL, 'item_count <= total_quantity', 1.0,
    count(*) FILTER (WHERE coalesce(item_count <= total_quantity, false)), count(*) FROM pos_tx)"""


@query("quality_scan", "G-04", with_views(QUALITY_SQL, "pos_tx"))
def quality_scan(t):
    """The three checkout-ledger quality rules in one pass."""
    return gov.quality_scan(fx.pos_tx(t))


FAILING_SQL = """
SELECT tx_no, transaction_id, 'transaction_id_not_null' AS failed_rule FROM pos_tx WHERE transaction_id IS NULL
UNION ALL
SELECT tx_no, transaction_id, 'total_matches_parts' FROM pos_tx
WHERE NOT coalesce(total = subtotal_amount - discount + tax_amount, false)
UNION ALL
SELECT tx_no, transaction_id, 'items_within_quantity' FROM pos_tx WHERE NOT coalesce(item_count <= total_quantity, false)"""


@query("quality_failing_rows", "G-04", with_views(FAILING_SQL, "pos_tx"))
def quality_failing_rows(t):
    """Every failing ledger row, once per failed rule."""
    bad = gov.failing_rows(fx.pos_tx(t))
    return bad.select("tx_no", "transaction_id", F.explode("failed_rules").alias("failed_rule"))


# Record contract for checkout-ledger records as they arrive, all text (our design, same form as the table spec).
POS_RECORD_SPEC = (
    gov.FieldSpec("transaction_id", "string", True),
    gov.FieldSpec("loyalty_flag", "bool", True),
    gov.FieldSpec("payment_method", "enum", True, ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")),
    gov.FieldSpec("customer_loyalty_tier", "enum", True,
                  ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
    gov.FieldSpec("item_count", "int", True),
)


@query("ledger_contract_violations", "G-05", with_views("""
SELECT tx_no, v AS violation FROM (
  SELECT tx_no, CASE WHEN transaction_id IS NULL THEN 'transaction_id: missing' END AS v FROM pos_records
  UNION ALL SELECT tx_no, CASE WHEN loyalty_flag IS NULL THEN 'loyalty_flag: missing' END FROM pos_records
  UNION ALL SELECT tx_no, CASE WHEN lower(loyalty_flag) NOT IN ('true', 'false')
    THEN 'loyalty_flag: not boolean: ' || loyalty_flag END FROM pos_records
  UNION ALL SELECT tx_no, CASE WHEN item_count IS NOT NULL AND TRY_CAST(item_count AS BIGINT) IS NULL
    THEN 'item_count: not integer: ' || item_count END FROM pos_records
  UNION ALL SELECT tx_no, CASE WHEN payment_method IS NULL THEN 'payment_method: missing' END FROM pos_records
  UNION ALL SELECT tx_no, CASE WHEN payment_method NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
    THEN 'payment_method: not in enum: ' || payment_method END FROM pos_records
  UNION ALL SELECT tx_no, CASE WHEN customer_loyalty_tier IS NULL THEN 'customer_loyalty_tier: missing' END FROM pos_records
  UNION ALL SELECT tx_no, CASE WHEN customer_loyalty_tier NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
    THEN 'customer_loyalty_tier: not in enum: ' || customer_loyalty_tier END FROM pos_records
  UNION ALL SELECT tx_no, CASE WHEN item_count IS NULL THEN 'item_count: missing' END FROM pos_records)
WHERE v IS NOT NULL""", "pos_tx", "pos_records"))
def ledger_contract_violations(t):
    """Contract violations of every checkout-ledger record (one row each)."""
    v = gov.validate_records(fx.pos_records(t), POS_RECORD_SPEC)
    return v.select("tx_no", F.explode("violations").alias("violation"))


# Table bindings of the reference's contract (fixed values), keyed by our bound views.
CONTRACTS = {
    "pos_tx": {"table_type": "STREAMING_TABLE", "pii_included": True, "data_owner_team": "store-ops"},
    "alerts": {"table_type": "STREAMING_TABLE", "pii_included": False, "data_owner_team": "loss-prevention"},
    "inventory": {"table_type": "BATCH_TABLE", "pii_included": False, "data_owner_team": "inventory-mgmt"},
    "history": {"table_type": "BATCH_TABLE", "pii_included": True, "data_owner_team": "store-ops"},
    "warranty": {"table_type": "BATCH_TABLE", "pii_included": False, "data_owner_team": "store-ops"},
}
DESCRIPTIONS = {
    "pos_tx": "Real-time intraday POS checkout ledger",
    "alerts": "Real-time anomaly alert ledger",
    "inventory": "Daily reconciled store inventory ledger",
    "history": "Historical transaction ledger",
    "warranty": "AI-extracted unstructured warranty policies",
    "silver": "Federated checkout log",
}


def _bound(t):
    return {"pos_tx": fx.pos_tx(t), "alerts": fx.alerts(t), "inventory": fx.inventory(t),
            "history": fx.history(t), "warranty": fx.warranty(t), "silver": fx.silver(t)}


# The bound tables' columns: name, type, whether a value can be missing.
CATALOG_COLUMNS = {
    "pos_tx": (("transaction_id", "string", True), ("tx_no", "bigint", True), ("business_date", "date", True), ("store_id", "string", True),
               ("cashier_id", "string", True), ("customer_id", "string", True), ("customer_loyalty_tier", "string", True),
               ("payment_method", "string", True), ("subtotal_amount", "decimal(18,2)", True), ("discount", "decimal(18,2)", True),
               ("tax_amount", "decimal(18,2)", True), ("total", "decimal(18,2)", True), ("item_count", "bigint", False),
               ("total_quantity", "bigint", True)),
    "alerts": (("alert_id", "bigint", True), ("alert_ts", "timestamp_ntz", True), ("store_id", "string", True), ("cashier_id", "string", True),
               ("alert_type", "string", True), ("risk_score", "double", False)),
    "inventory": (("store_id", "string", True), ("store_name", "string", True), ("city", "string", True), ("item_id", "string", True),
                  ("shelf_qty", "bigint", True), ("backroom_qty", "bigint", True), ("total_units_sold_intraday", "bigint", True),
                  ("intraday_gross_revenue_usd", "decimal(28,2)", True), ("reconciliation_status", "string", False)),
    "history": (("transaction_id", "string", True), ("business_date", "date", True), ("store_id", "string", True), ("customer_id", "string", True),
                ("customer_loyalty_tier", "string", True), ("payment_method", "string", True),
                ("items", "array<struct<line_no:int,item_id:string,item_name:string,unit_price:decimal(18,2)>>", False)),
    "warranty": (("product_id", "string", True), ("warranty_duration_months", "int", True), ("service_level", "string", True),
                 ("coverage_scope_details", "string", True), ("exclusions_and_limitations", "string", True),
                 ("official_retailer_guarantee_and_sla", "string", True), ("support_url", "string", True)),
    "silver": (("transaction_id", "string", True), ("event_timestamp", "timestamp_ntz", True), ("store_id", "string", True),
               ("pos_terminal_id", "string", True), ("cashier_id", "string", True), ("payment_method", "string", True),
               ("total_amount_usd", "decimal(18,2)", True)),
}


def _catalog_sql() -> str:
    def lit(v):
        return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else "'" + v + "'"
    parts = []
    for name, cols in CATALOG_COLUMNS.items():
        c = CONTRACTS.get(name, {})
        source = "(SELECT DISTINCT transaction_id FROM history_lines)" if name == "history" else name
        missing = "[]" if c else "['table_type: missing', 'pii_included: missing', 'data_owner_team: missing']"
        for i, (col, kind, nullable) in enumerate(cols):
            parts.append(f"""SELECT '{name}' AS table_name, count(*) AS row_count, {i} AS ordinal, '{col}' AS column_name, '{kind}' AS data_type,
  {lit(nullable)} AS nullable, {lit(DESCRIPTIONS.get(name))} AS description, CAST({lit(c.get('table_type'))} AS VARCHAR) AS table_type,
  CAST({lit(c.get('pii_included'))} AS BOOLEAN) AS pii_included, CAST({lit(c.get('data_owner_team'))} AS VARCHAR) AS data_owner_team,
  CAST({missing} AS VARCHAR[]) AS violations, {lit(bool(c))} AS valid FROM {source}""")
    return "\nUNION ALL\n".join(parts)


_CATALOG_VIEWS = ("pos_tx", "alerts", "inventory", "history_lines", "warranty", "silver")


@query("catalog_snapshot", "S-07 G-05", with_views(_catalog_sql(), *_CATALOG_VIEWS))
def catalog_snapshot(t):
    """Columns, types, row counts and validated contract values of the bound tables."""
    snap = gov.catalog_snapshot(_bound(t), CONTRACTS, DESCRIPTIONS)
    return gov.validate_records(snap)


@query("catalog_snapshot_file", "S-07", with_views(
    f"SELECT table_name, row_count, ordinal, column_name, data_type FROM ({_catalog_sql()})", *_CATALOG_VIEWS))
def catalog_snapshot_file(t):
    """The catalogue written as JSON and read back."""
    path = scratch_path(t.spark, f"tables/catalog-{uuid.uuid4().hex[:12]}")
    gov.write_catalog(gov.catalog_snapshot(_bound(t), CONTRACTS, DESCRIPTIONS), path)
    return gov.read_catalog(t.spark, path).select("table_name", "row_count", "ordinal", "column_name", "data_type")


@query("session_catalog_snapshot", "S-07 G-05", with_views(
    f"SELECT * EXCLUDE (nullable) FROM ({_catalog_sql()})", *_CATALOG_VIEWS))
def session_catalog_snapshot(t):
    """The bound tables registered in the session's catalogue with comments and properties; the snapshot and
    its row counts come from there, without a scan."""
    database = f"storelens_{uuid.uuid4().hex[:12]}"
    for name, df in _bound(t).items():
        path = scratch_path(t.spark, f"tables/{database}/{name}")
        df.write.parquet(path)
        session_catalog.register(t.spark, database, name, path, DESCRIPTIONS.get(name), CONTRACTS.get(name))
    return gov.validate_records(session_catalog.session_snapshot(t.spark, database)).drop("nullable")


@query("streaming_store_ops_tables", "G-06 S-07", with_views(f"""
SELECT 'pos_tx' AS table_name, count(*) AS row_count, '{DESCRIPTIONS["pos_tx"]}' AS description FROM pos_tx""", "pos_tx"))
def streaming_store_ops_tables(t):
    """Contract search: streaming tables owned by store-ops, with PII."""
    snap = gov.catalog_snapshot(_bound(t), CONTRACTS, DESCRIPTIONS)
    hits = gov.search_contract(snap, table_type="STREAMING_TABLE", data_owner_team="store-ops", pii_included=True)
    return hits.select("table_name", "row_count", "description").distinct()


@query("store_metrics", "G-07 P-01 P-02 P-03 P-05 A-02 J-02", with_views(f"""
SELECT 'net-transaction-revenue' AS term_id, store_id AS group_key,
  CAST(sum(CAST(subtotal_amount - discount + tax_amount AS DECIMAL(18,2))) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS band
FROM pos_tx WHERE total > 0 GROUP BY store_id
UNION ALL
SELECT 'total-on-hand-inventory', store_id, CAST(sum(shelf_qty + backroom_qty) AS DOUBLE), NULL FROM inventory GROUP BY store_id
UNION ALL
SELECT 'inventory-cover-hours', store_id, {r4('c')}, CASE WHEN c <= 6.0 THEN 'CRITICAL_BURN_SPIKE'
  WHEN c <= 12.0 THEN 'MONITOR_VELOCITY' WHEN c IS NOT NULL THEN 'NORMAL' END
FROM (SELECT store_id, CASE WHEN sum(total_units_sold_intraday) <> 0 THEN
        CAST(sum(shelf_qty + backroom_qty) AS DOUBLE) / (CAST(sum(total_units_sold_intraday) AS DOUBLE) / 12.0::DOUBLE) END AS c
      FROM inventory GROUP BY store_id)
UNION ALL
SELECT 'cashier-override-rate', store_id,
  {exact_ratio("count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse')", 'count(*)', 4)}, NULL FROM alerts GROUP BY store_id
UNION ALL
SELECT 'warranty-policy-duration', payment_method, {exact_ratio('count(*) FILTER (WHERE ok)', 'count(*)', 4)}, NULL
FROM (SELECT h.payment_method, (year(DATE '{fx.PURCHASE_AS_OF}') - year(h.business_date)) * 12
        + month(DATE '{fx.PURCHASE_AS_OF}') - month(h.business_date) <= w.warranty_duration_months AS ok
      FROM history_lines h JOIN warranty w ON h.item_id = w.product_id) GROUP BY payment_method""",
                                                 "pos_tx", "inventory", "alerts", "history_lines", "warranty"))
def store_metrics(t):
    """The five glossary terms applied through the metric registry."""
    def run(term, df, key):
        out = gov.metric(term).apply(df, [key])
        band = F.col("band") if "band" in out.columns else F.lit(None).cast("string")
        return out.select(F.lit(term).alias("term_id"), F.col(key).alias("group_key"),
                          F.col("value").cast("double").alias("value"), band.alias("band"))
    tri = war.warranty_triage(fx.history(t), fx.warranty(t), fx.PURCHASE_AS_OF)
    parts = [run("net-transaction-revenue", fx.pos_tx(t), "store_id"),
             run("total-on-hand-inventory", fx.inventory(t), "store_id"),
             run("inventory-cover-hours", fx.inventory(t), "store_id"),
             run("cashier-override-rate", fx.alerts(t), "store_id"),
             run("warranty-policy-duration", tri, "payment_method")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("question_guardrail", "G-08", with_views(f"""
SELECT conv_id, turn, regexp_matches(lower(text), '{gov.FACT_REGEX}') AS targets_fact,
  regexp_matches(lower(text), '{gov.TEMPORAL_REGEX}') AS has_date,
  regexp_matches(lower(text), '{gov.FACT_REGEX}') AND NOT regexp_matches(lower(text), '{gov.TEMPORAL_REGEX}')
    AS needs_clarification
FROM asked""", "asked"))
def question_guardrail(t):
    """Date guardrail verdict for every conversation turn with its planted question."""
    c = gov.classify_questions(fx.asked(t))
    return c.select("conv_id", "turn", "targets_fact", "has_date", "needs_clarification")


@query("alerts_week_scan", "G-09 P-07", with_views("""
SELECT * FROM alerts WHERE alert_ts >= TIMESTAMP '2024-01-24 00:00:00' AND alert_ts < TIMESTAMP '2024-01-31 00:00:00'""",
                                                   "alerts"))
def alerts_week_scan(t):
    """Guarded fact scan: alerts of one week (the range is mandatory)."""
    return gov.scan_fact(fx.alerts(t), "alert_ts", "2024-01-24 00:00:00", "2024-01-31 00:00:00")


def _join_candidates_sql() -> str:
    parts = []
    for tname in TABLE_NAMES:
        for f in SCHEMAS[tname].fields:
            fam = ("int" if isinstance(f.dataType, (T.IntegerType, T.LongType))
                   else "str" if isinstance(f.dataType, T.StringType) else None)
            if fam:
                parts.append(f"SELECT '{tname}' AS t, '{f.name}' AS c, '{fam}' AS fam, CAST({f.name} AS VARCHAR) AS v "
                             f"FROM {tname}")
    vals = "\nUNION ALL\n".join(parts)
    return f"""
WITH vals AS (SELECT DISTINCT * FROM ({vals}) WHERE v IS NOT NULL),
sizes AS (SELECT t, c, count(*) AS left_distinct FROM vals GROUP BY 1, 2),
ov AS (SELECT a.t AS lt, a.c AS lc, b.t AS rt, b.c AS rc, count(*) AS overlap
       FROM vals a JOIN vals b ON a.fam = b.fam AND a.v = b.v WHERE a.t <> b.t OR a.c <> b.c GROUP BY 1, 2, 3, 4)
SELECT lt AS left_table, lc AS left_column, rt AS right_table, rc AS right_column, left_distinct, overlap,
  {exact_ratio('overlap', 'left_distinct', 4)} AS containment
FROM ov JOIN sizes ON ov.lt = sizes.t AND ov.lc = sizes.c
WHERE {exact_ratio('overlap', 'left_distinct', 4)} >= 0.9"""


@query("join_candidates", "J-09", _join_candidates_sql())
def join_candidates(t):
    """Column pairs of all tables whose values are >= 90 % contained."""
    return mine_joins({n: getattr(t, n) for n in TABLE_NAMES}, 0.9)
