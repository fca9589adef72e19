"""DuckDB oracle SQL: the bound views as CTEs plus SQL helpers.

The view texts are the ones in FIXTURES.md (valid in both engines).
"""

from __future__ import annotations

from storelens.plans.fixtures import ASKED, PLANTED_MANUAL, PLANTED_QUESTION


def planted(i: str, notes: tuple[str, ...], every: int = 11) -> str:
    """SQL twin of the planted sentences."""
    return "CASE " + " ".join(f"WHEN {i} % {every} = {k} THEN '{n}'" for k, n in enumerate(notes)) + " ELSE '' END"


VIEWS: dict[str, str] = {
    "inventory": """
SELECT concat('STORE_', lpad(cast(l_suppkey AS VARCHAR(20)), 3, '0')) AS store_id, s_name AS store_name, n_name AS city,
  concat('prod_', cast(l_partkey AS VARCHAR(20))) AS item_id,
  CAST(max(p_size) AS BIGINT) AS shelf_qty,
  CAST((l_partkey * 7 + l_suppkey * 3) % 60 AS BIGINT) AS backroom_qty,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END) AS BIGINT) AS total_units_sold_intraday,
  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS intraday_gross_revenue_usd,
  CASE WHEN (l_partkey + l_suppkey) % 13 = 0 THEN 'DISCREPANCY' ELSE 'RECONCILED' END AS reconciliation_status
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY l_suppkey, l_partkey, s_name, n_name""",
    "pos_tx": """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('TXN-', cast(o_orderkey AS VARCHAR(20))) END AS transaction_id,
  o_orderkey AS tx_no, CAST(o_orderdate AS DATE) AS business_date,
  concat('STORE_', lpad(cast(c_nationkey AS VARCHAR(20)), 3, '0')) AS store_id,
  concat('CASH_', cast(1000 + o_custkey % 150 AS VARCHAR(20))) AS cashier_id,
  concat('CUST_', cast(o_custkey AS VARCHAR(20))) AS customer_id, c_mktsegment AS customer_loyalty_tier, o_orderpriority AS payment_method,
  CAST(subtotal AS DECIMAL(18,2)) AS subtotal_amount, CAST(disc AS DECIMAL(18,2)) AS discount, CAST(tax AS DECIMAL(18,2)) AS tax_amount,
  CAST(CAST(subtotal AS DECIMAL(18,2)) - CAST(disc AS DECIMAL(18,2)) + CAST(tax AS DECIMAL(18,2))
    + CASE WHEN o_orderkey % 97 = 0 THEN CAST(0.01 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS total,
  item_count, CASE WHEN o_orderkey % 89 = 0 THEN 0 ELSE total_quantity END AS total_quantity
FROM orders JOIN customer ON o_custkey = c_custkey JOIN (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS subtotal,
    sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS disc,
    sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))) AS tax,
    count(DISTINCT l_partkey) AS item_count, CAST(sum(l_quantity) AS BIGINT) AS total_quantity
  FROM lineitem GROUP BY l_orderkey) t ON o_orderkey = l_orderkey""",
    "pos_records": """
SELECT tx_no, transaction_id, CASE WHEN tx_no % 71 = 0 THEN 'maybe' WHEN tx_no % 73 <> 0 THEN CAST(tx_no % 2 = 0 AS VARCHAR) END AS loyalty_flag,
  CASE WHEN tx_no % 61 = 0 THEN lower(payment_method) ELSE payment_method END AS payment_method,
  CASE WHEN tx_no % 67 = 0 THEN 'GOLD' ELSE customer_loyalty_tier END AS customer_loyalty_tier,
  CASE WHEN tx_no % 59 = 0 THEN 'three' ELSE CAST(item_count AS VARCHAR) END AS item_count
FROM pos_tx""",
    "asked": f"SELECT conv_id, turn, role, concat(text, {planted('(conv_id + turn)', ASKED, 8)}) AS text FROM conversations",
    "warranty": """
SELECT concat('prod_', cast(p_partkey AS VARCHAR(20))) AS product_id, p_size AS warranty_duration_months, p_type AS service_level,
  p_brand AS coverage_scope_details, concat('Excludes misuse of ', p_type) AS exclusions_and_limitations,
  concat('Repair within ', cast(p_partkey % 9 + 1 AS VARCHAR(20)), ' days') AS official_retailer_guarantee_and_sla, concat('https://support.example/', cast(p_partkey AS VARCHAR(20))) AS support_url
FROM part WHERE p_partkey % 4 <> 0""",
    "history_lines": """
SELECT concat('TXN-', cast(o_orderkey AS VARCHAR(20))) AS transaction_id, CAST(o_orderdate AS DATE) AS business_date,
  concat('STORE_', lpad(cast(c_nationkey AS VARCHAR(20)), 3, '0')) AS store_id, concat('CUST_', cast(o_custkey AS VARCHAR(20))) AS customer_id,
  c_mktsegment AS customer_loyalty_tier, o_orderpriority AS payment_method, l_linenumber AS line_no,
  concat('prod_', cast(l_partkey AS VARCHAR(20))) AS item_id, p_name AS item_name, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey""",
    "alerts": """
SELECT event_id AS alert_id, ts AS alert_ts, concat('STORE_', lpad(cast(user_id % 10 AS VARCHAR(20)), 3, '0')) AS store_id,
  concat('CASH_', cast(1000 + user_id AS VARCHAR(20))) AS cashier_id,
  CASE event_type WHEN 'error' THEN 'cashier_promo_abuse' ELSE event_type END AS alert_type,
  least(value / CAST(97.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) AS risk_score
FROM events""",
    "silver": """
SELECT concat('TXN-', cast(o_orderkey AS VARCHAR(20))) AS transaction_id, o_orderdate AS event_timestamp,
  concat('STORE_', lpad(cast(o_custkey % 10 AS VARCHAR(20)), 3, '0')) AS store_id, concat('POS_', lpad(cast(o_orderkey % 10 + 1 AS VARCHAR(20)), 2, '0')) AS pos_terminal_id,
  concat('CASH_', cast(1000 + o_custkey % 150 AS VARCHAR(20))) AS cashier_id, o_orderpriority AS payment_method, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount_usd
FROM orders""",
    "enriched": """
SELECT x.store_id || '#' || x.transaction_id AS row_key, CAST(a.alert_count AS VARCHAR) AS alert_count,
  CAST(nullif(a.promo_abuse_count, 0) AS VARCHAR) AS promo_abuse_count, x.cashier_id, x.pos_terminal_id, x.payment_method,
  CAST(x.total_amount_usd AS VARCHAR) AS total_amount_usd
FROM silver x LEFT JOIN (
  SELECT store_id, cashier_id, count(*) AS alert_count, count(*) FILTER (WHERE alert_type = 'cashier_promo_abuse') AS promo_abuse_count
  FROM alerts GROUP BY 1, 2) a ON x.store_id = a.store_id AND x.cashier_id = a.cashier_id""",
    "log_refs": """
SELECT conv_id * 1000000 + turn AS call_id, concat('ins-', cast(conv_id * 1000000 + turn AS VARCHAR(20))) AS insert_id, conv_id AS conversation_id, turn AS call_turn,
  concat('trace-', cast(conv_id AS VARCHAR(20)), '-', cast(turn AS VARCHAR(20))) AS trace, concat('span-', cast(turn AS VARCHAR(20))) AS span_id,
  CASE WHEN (conv_id * 1000000 + turn) % 7 <> 0 THEN concat('/logs/completions/', cast(conv_id * 1000000 + turn AS VARCHAR(20)), '_inputs.jsonl') END AS input_ref,
  concat('/logs/completions/', cast(conv_id * 1000000 + turn AS VARCHAR(20)), '_outputs.jsonl') AS output_ref,
  cast(length(text) AS VARCHAR(20)) AS usage_output_tokens
FROM conversations WHERE role = 'assistant'""",
    "messages": """
SELECT concat('/logs/completions/', cast(a.conv_id * 1000000 + a.turn AS VARCHAR(20)), '_inputs.jsonl') AS file_name, b.role, b.turn AS idx, b.text AS content
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn < a.turn WHERE a.role = 'assistant'
UNION ALL
SELECT concat('/logs/completions/', cast(conv_id * 1000000 + turn AS VARCHAR(20)), '_outputs.jsonl'), role, CAST(0 AS BIGINT), text FROM conversations WHERE role = 'assistant'""",
    "vchunks": f"""
SELECT i AS vec_id, concat('doc_', cast(i // 10 AS VARCHAR(20)), '.pdf') AS document_filename,
  CAST(i % 10 + CASE WHEN i % 10 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS chunk_index,
  CASE WHEN i % 3 <> 0 THEN source END AS document_title, lang AS equipment_covered,
  concat(text, {planted('i', PLANTED_MANUAL)}) AS chunk_content, concat('gs://manuals/doc_', cast(i // 10 AS VARCHAR(20)), '.pdf') AS source_pdf_uri,
  CASE WHEN (i // (SELECT count(*) FROM embeddings)) % 2 = 1 AND i % 3 <> 0 THEN list_reverse(embedding) ELSE embedding END AS embedding
FROM (SELECT doc_id AS i FROM documents UNION ALL SELECT vec_id FROM embeddings WHERE vec_id >= (SELECT count(*) FROM documents)) r
JOIN documents ON doc_id = i % (SELECT count(*) FROM documents) JOIN embeddings ON vec_id = i % (SELECT count(*) FROM embeddings)""",
    "manuals": f"SELECT doc_id, concat(text, {planted('doc_id', PLANTED_MANUAL)}) AS text, lang, source FROM documents",
    "questions": f"SELECT doc_id AS query_id, concat(text, {planted('doc_id', PLANTED_QUESTION)}) AS text FROM documents",
    "vquestions": f"SELECT vec_id AS query_id, concat(chunk_content, {planted('(vec_id + 5)', PLANTED_QUESTION)}) AS text, embedding FROM vchunks",
}


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with CTEs for the named bound views (and extra CTEs)."""
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in names]
    parts += [f"{n} AS ({s.strip()})" for n, s in (extra or {}).items()]
    body = sql.strip()
    if not parts:
        return body
    if body[:5].upper() == "WITH ":
        # merge the query's own CTE list after the view CTEs
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


def r4(expr: str, places: int = 4) -> str:
    """SQL twin of ``round_half_up``."""
    s = float(10 ** places)
    return f"(CAST(floor(({expr}) * {s!r} + 0.5) AS DOUBLE) / {s!r})"


def exact_ratio(num: str, den: str, places: int, scale: int = 1) -> str:
    """SQL twin of ``metrics.exact_ratio``."""
    m = scale * 10 ** places
    n, d = f"CAST(({num}) AS BIGINT)", f"CAST(({den}) AS BIGINT)"
    return (f"(CASE WHEN {d} <> 0 THEN CAST(((2 * {m} * {n} + {d}) // (2 * {d})) AS DOUBLE) "
            f"/ {float(10 ** places)!r} END)")
