"""Bound views: the reference's tables expressed over the driver's tables.

Each builder takes a ``Tables`` accessor and returns a DataFrame; the
same views are written as SQL in ``storelens.plans.oracle`` for DuckDB.
Fault planting (null ids, off-by-a-cent totals, zero quantities) and
left-out rows are part of the view definitions, not row caps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.operators.offenders import audit_status, rt_metrics
from storelens.sources.key_table import as_cells
from storelens.sources.tables import Tables

# Fixed as-of instants used by every time filter (never current_date).
ALERTS_AS_OF = "2024-01-31 00:00:00"
PURCHASE_AS_OF = "2001-08-01"
TELEMETRY_BASE = "2026-01-01 00:00:00"


def _padded(prefix: str, c, width: int):
    return F.concat(F.lit(prefix), F.lpad(c.cast("string"), width, "0"))


def _tagged(prefix: str, c):
    return F.concat(F.lit(prefix), c.cast("string"))


def inventory(t: Tables) -> DataFrame:
    """gold_inventory_reconciliation_ledger: one row per (store, item).

    Lineitem is aggregated to (supplier, part) *before* the dimension
    joins, so the big shuffle carries one partial row per key and map
    task instead of every line; part/supplier/nation then join on the
    much smaller aggregate (p_partkey, s_suppkey, n_nationkey are keys).
    """
    li = (t.lineitem
          .groupBy("l_suppkey", "l_partkey")
          .agg(F.sum(F.when(F.col("l_returnflag") == "R", F.lit(0.0))
                     .otherwise(F.col("l_quantity"))).cast("long").alias("total_units_sold_intraday"),
               F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("intraday_gross_revenue_usd")))
    part = t.part.select("p_partkey", "p_size")
    sup = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    nat = F.broadcast(t.nation.select("n_nationkey", "n_name"))  # 25 rows by definition
    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(sup, F.col("l_suppkey") == sup.s_suppkey)
           .join(nat, F.col("s_nationkey") == nat.n_nationkey))
    return j.select(
        _padded("STORE_", F.col("l_suppkey"), 3).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"),
        _tagged("prod_", F.col("l_partkey")).alias("item_id"),
        F.col("p_size").cast("long").alias("shelf_qty"),
        ((F.col("l_partkey") * 7 + F.col("l_suppkey") * 3) % 60).cast("long").alias("backroom_qty"),
        "total_units_sold_intraday",
        "intraday_gross_revenue_usd",
        F.when((F.col("l_partkey") + F.col("l_suppkey")) % 13 == 0, F.lit("DISCREPANCY")).otherwise(F.lit("RECONCILED"))
         .alias("reconciliation_status"),
    )


def _order_money(t: Tables) -> DataFrame:
    money = F.col("l_extendedprice").cast("decimal(12,2)")
    return (t.lineitem.groupBy("l_orderkey").agg(
        F.sum(money).alias("subtotal"),
        F.sum(money * F.col("l_discount").cast("decimal(4,2)")).alias("disc"),
        F.sum(money * F.col("l_tax").cast("decimal(4,2)")).alias("tax"),
        F.count_distinct("l_partkey").alias("item_count"),
        F.sum("l_quantity").cast("long").alias("total_quantity")))


def pos_tx(t: Tables) -> DataFrame:
    """pos_transactions_gold with planted quality faults."""
    k = F.col("o_orderkey")
    d2 = "decimal(18,2)"
    sub, disc, tax = (F.col(c).cast(d2) for c in ("subtotal", "disc", "tax"))
    cust = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    j = (t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
         .join(cust, F.col("o_custkey") == cust.c_custkey)
         .join(_order_money(t), k == F.col("l_orderkey")))
    return j.select(
        F.when(k % 101 == 0, F.lit(None)).otherwise(_tagged("TXN-", k)).alias("transaction_id"),
        k.alias("tx_no"),
        F.col("o_orderdate").cast("date").alias("business_date"),
        _padded("STORE_", F.col("c_nationkey"), 3).alias("store_id"),
        _tagged("CASH_", F.lit(1000) + F.col("o_custkey") % 150).alias("cashier_id"),
        _tagged("CUST_", F.col("o_custkey")).alias("customer_id"),
        F.col("c_mktsegment").alias("customer_loyalty_tier"),
        F.col("o_orderpriority").alias("payment_method"),
        sub.alias("subtotal_amount"), disc.alias("discount"), tax.alias("tax_amount"),
        (sub - disc + tax + F.when(k % 97 == 0, F.lit(0.01).cast(d2)).otherwise(F.lit(0).cast(d2)))
        .cast(d2).alias("total"),
        "item_count",
        F.when(k % 89 == 0, F.lit(0).cast("long")).otherwise(F.col("total_quantity")).alias("total_quantity"),
    )


def pos_records(t: Tables) -> DataFrame:
    """Checkout-ledger records as they arrive (all text), with planted contract faults."""
    k = F.col("tx_no")
    return pos_tx(t).select(
        k, "transaction_id",
        F.when(k % 71 == 0, F.lit("maybe")).when(k % 73 != 0, (k % 2 == 0).cast("string")).alias("loyalty_flag"),
        F.when(k % 61 == 0, F.lower("payment_method")).otherwise(F.col("payment_method")).alias("payment_method"),
        F.when(k % 67 == 0, F.lit("GOLD")).otherwise(F.col("customer_loyalty_tier")).alias("customer_loyalty_tier"),
        F.when(k % 59 == 0, F.lit("three")).otherwise(F.col("item_count").cast("string")).alias("item_count"))


ASKED = (" Show promo abuse by cashier.", " Which transactions came in the last 7 days?", " List checkout anomalies on 2024-01-15.",
         " How much stock has store 4?", " Any override since yesterday?", " Transactions of CASH_1007, please.")


def asked(t: Tables) -> DataFrame:
    """Conversation turns with a planted question (by conversation and turn), with and without a date."""
    note = F.lit("")
    for k, q in enumerate(ASKED):
        note = F.when((F.col("conv_id") + F.col("turn")) % 8 == k, F.lit(q)).otherwise(note)
    return t.conversations.withColumn("text", F.concat("text", note))


def warranty(t: Tables) -> DataFrame:
    """warranty_generic_sections_extracted: every fourth product has no policy."""
    k = F.col("p_partkey")
    return t.part.where(k % 4 != 0).select(
        _tagged("prod_", k).alias("product_id"),
        F.col("p_size").alias("warranty_duration_months"),
        F.col("p_type").alias("service_level"),
        F.col("p_brand").alias("coverage_scope_details"),
        F.concat(F.lit("Excludes misuse of "), F.col("p_type")).alias("exclusions_and_limitations"),
        F.concat(F.lit("Repair within "), (k % 9 + 1).cast("string"), F.lit(" days")).alias("official_retailer_guarantee_and_sla"),
        _tagged("https://support.example/", k).alias("support_url"),
    )


def _history_rows(t: Tables) -> DataFrame:
    """Lines with their order's key. The parts join first, while a line is narrow; the rows then lie by order."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    p = t.part.select("p_partkey", "p_name", "p_retailprice")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(li.join(p, F.col("l_partkey") == F.col("p_partkey")), F.col("o_orderkey") == F.col("l_orderkey")))
    return j.select(
        "o_orderkey",
        _tagged("TXN-", F.col("o_orderkey")).alias("transaction_id"),
        F.col("o_orderdate").cast("date").alias("business_date"),
        _padded("STORE_", F.col("c_nationkey"), 3).alias("store_id"),
        _tagged("CUST_", F.col("o_custkey")).alias("customer_id"),
        F.col("c_mktsegment").alias("customer_loyalty_tier"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("l_linenumber").alias("line_no"),
        _tagged("prod_", F.col("l_partkey")).alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"),
    )


def history_lines(t: Tables) -> DataFrame:
    """Line form of historical_transactional_data."""
    return _history_rows(t).drop("o_orderkey")


def history(t: Tables) -> DataFrame:
    """Nested historical_transactional_data: ``items`` is a repeated record.

    One row per transaction; the collect is per transaction, never per
    customer or store, so an array is as long as one basket. The order's key, which the transaction's id
    spells, is among the keys, so the lines are collected where their join left them.
    """
    return (_history_rows(t)
            .groupBy("o_orderkey", "transaction_id", "business_date", "store_id", "customer_id", "customer_loyalty_tier", "payment_method")
            .agg(F.array_sort(F.collect_list(F.struct("line_no", "item_id", "item_name", "unit_price")))
                 .alias("items")).drop("o_orderkey"))


def alerts(t: Tables, with_discount: bool = False) -> DataFrame:
    """pos_anomaly_alerts over events."""
    extra = [F.col("value").cast("decimal(18,2)").alias("discount_usd")] if with_discount else []
    return t.events.select(
        F.col("event_id").alias("alert_id"),
        F.col("ts").alias("alert_ts"),
        _padded("STORE_", F.col("user_id") % 10, 3).alias("store_id"),
        _tagged("CASH_", F.lit(1000) + F.col("user_id")).alias("cashier_id"),
        F.when(F.col("event_type") == "error", F.lit("cashier_promo_abuse"))
         .otherwise(F.col("event_type")).alias("alert_type"),
        F.least(F.col("value") / F.lit(97.0), F.lit(1.0)).alias("risk_score"),
        *extra,
    )


def alert_events(t: Tables) -> DataFrame:
    """Alerts plus the event value as the checkout discount (rt_metrics input)."""
    return alerts(t, with_discount=True)


def silver(t: Tables) -> DataFrame:
    """silver_pos_transactions (the federated checkout log) over orders."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return t.orders.select(
        _tagged("TXN-", k).alias("transaction_id"),
        F.col("o_orderdate").alias("event_timestamp"),
        _padded("STORE_", c % 10, 3).alias("store_id"),
        _padded("POS_", k % 10 + 1, 2).alias("pos_terminal_id"),
        _tagged("CASH_", F.lit(1000) + c % 150).alias("cashier_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount_usd"),
    )


def enriched_transactions(t: Tables) -> DataFrame:
    """pos_transactions_enriched: each checkout of the log with the alerts that its cashier has in the store."""
    seen = alerts(t).groupBy(F.col("store_id").alias("_s"), F.col("cashier_id").alias("_c")).agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.expr("nullif(count_if(alert_type = 'cashier_promo_abuse'), 0)").alias("promo_abuse_count"))
    x = silver(t)
    return as_cells(
        x.join(seen, (x["store_id"] == seen["_s"]) & (x["cashier_id"] == seen["_c"]), "left"),
        F.concat_ws("#", "store_id", "transaction_id"),
        {"alerts": ["alert_count", "promo_abuse_count"],
         "tx": ["cashier_id", "pos_terminal_id", "payment_method", "total_amount_usd"]})


def realtime_alerts(t: Tables) -> DataFrame:
    """cashier_realtime_alerts: trailing metrics in the families ``flags`` and ``stats``; a cashier without
    overrides in the hour has no rate."""
    m = audit_status(rt_metrics(alert_events(t)))
    m = m.withColumn("override_rate_pct", F.when(F.col("override_count") > 0, F.col("override_rate_pct").cast("decimal(5,2)")))
    return as_cells(m, F.col("row_key"), {"flags": ["audit_status"],
                                          "stats": ["txn_count", "override_count", "promo_count", "override_rate_pct"]})


def log_refs(t: Tables) -> DataFrame:
    """Flattened inference-log rows: one call per assistant turn."""
    call = F.col("conv_id") * 1000000 + F.col("turn")
    return t.conversations.where(F.col("role") == "assistant").select(
        call.alias("call_id"),
        _tagged("ins-", call).alias("insert_id"),
        F.col("conv_id").alias("conversation_id"),
        F.col("turn").alias("call_turn"),
        F.concat(F.lit("trace-"), F.col("conv_id").cast("string"), F.lit("-"),
                 F.col("turn").cast("string")).alias("trace"),
        _tagged("span-", F.col("turn")).alias("span_id"),
        F.when(call % 7 != 0, F.concat(F.lit("/logs/completions/"), call.cast("string"),
                                         F.lit("_inputs.jsonl"))).alias("input_ref"),
        F.concat(F.lit("/logs/completions/"), call.cast("string"), F.lit("_outputs.jsonl")).alias("output_ref"),
        F.length("text").cast("string").alias("usage_output_tokens"),
    )


def messages(t: Tables) -> DataFrame:
    """Message-file rows: input files repeat the earlier conversation.

    The earlier-turn fan-out is an equi-join on ``conv_id`` with a
    ``turn <`` residual, bounded by the turns of one conversation.
    """
    a = t.conversations.where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("a_conv"), F.col("turn").alias("a_turn"))
    b = t.conversations.select("conv_id", "turn", "role", "text")
    inputs = a.join(b, (F.col("a_conv") == F.col("conv_id")) & (F.col("turn") < F.col("a_turn"))).select(
        F.concat(F.lit("/logs/completions/"), (F.col("a_conv") * 1000000 + F.col("a_turn")).cast("string"),
                 F.lit("_inputs.jsonl")).alias("file_name"),
        "role", F.col("turn").alias("idx"), F.col("text").alias("content"))
    outputs = t.conversations.where(F.col("role") == "assistant").select(
        F.concat(F.lit("/logs/completions/"), (F.col("conv_id") * 1000000 + F.col("turn")).cast("string"),
                 F.lit("_outputs.jsonl")).alias("file_name"),
        "role", F.lit(0).cast("long").alias("idx"), F.col("text").alias("content"))
    return inputs.unionByName(outputs)


# Diagnostic sentences planted in manual texts and questions (by row number), so that every
# keyword, code and hyphen case of the fallback search occurs.
def _planted(i, kind: str):
    notes = (PLANTED_MANUAL if kind == "manual" else PLANTED_QUESTION)
    out = F.lit("")
    for k, note in enumerate(notes):
        out = F.when(i % 11 == k, F.lit(note)).otherwise(out)
    return out


PLANTED_MANUAL = (" Printer offline after reboot.", " See code ERR-42 in the log.", " Part A--77-B- is worn.", " The TCx drawer solenoid.")
PLANTED_QUESTION = (" the PRINTER beeps", " code ERR-42- again", " what is A-77-B", " frozen TCx lane", " XYZ-0-1 unknown")


def manuals(t: Tables) -> DataFrame:
    """Documents as manual texts with planted diagnostic sentences."""
    return t.documents.withColumn("text", F.concat("text", _planted(F.col("doc_id"), "manual")))


def questions(t: Tables) -> DataFrame:
    """Documents as fault descriptions with planted codes and keywords."""
    return t.documents.select(F.col("doc_id").alias("query_id"),
                              F.concat("text", _planted(F.col("doc_id"), "question")).alias("text"))


def vchunks(t: Tables) -> DataFrame:
    """pos_manual_chunk_embeddings with vectors: one row per document and per
    vector, whichever are more. Row i holds document i and vector i, each
    modulo the counted total; a table's every second repeat turns two thirds of the vectors
    around, so that some rows have an equal twin and others have not. Ten
    rows make a manual, with a gap in the middle of its chunk indexes."""
    n_docs = t.documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    n_vecs = t.embeddings.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = (t.documents.select(F.col("doc_id").alias("i"))
            .unionByName(t.embeddings.where(F.col("vec_id") >= n_docs).select(F.col("vec_id").alias("i"))))
    rows = rows.select("i", (F.col("i") % n_docs).alias("_d"), (F.col("i") % n_vecs).alias("_v"),
                       F.call_function("div", F.col("i"), n_vecs).alias("_turn"))
    d = t.documents.select("doc_id", "source", "lang", "text")
    e = t.embeddings.select("vec_id", "embedding")
    # the texts last, so that they are shuffled once
    j = rows.join(e, F.col("vec_id") == F.col("_v")).join(d, F.col("doc_id") == F.col("_d"))
    i = F.col("i")
    manual = F.call_function("div", i, F.lit(10).cast("long")).cast("string")
    return j.select(
        i.alias("vec_id"),
        F.concat(F.lit("doc_"), manual, F.lit(".pdf")).alias("document_filename"),
        (i % 10 + F.when(i % 10 >= 5, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("chunk_index"),
        F.when(i % 3 != 0, F.col("source")).alias("document_title"),
        F.col("lang").alias("equipment_covered"),
        F.concat("text", _planted(i, "manual")).alias("chunk_content"),   # the whole document text, never a prefix
        F.concat(F.lit("gs://manuals/doc_"), manual, F.lit(".pdf")).alias("source_pdf_uri"),
        F.when((F.col("_turn") % 2 == 1) & (i % 3 != 0), F.reverse("embedding")).otherwise(F.col("embedding")).alias("embedding"),
    )


def vquestions(t: Tables) -> DataFrame:
    """Each manual chunk as a question: its text with planted codes, and its vector."""
    return vchunks(t).select(F.col("vec_id").alias("query_id"),
                             F.concat("chunk_content", _planted(F.col("vec_id") + 5, "question")).alias("text"), "embedding")


def inference_logs(t: Tables) -> DataFrame:
    """gen_ai_client_inference_operation_details: camelCase top level and
    a nested ``labels`` struct of strings. Calls with ``call_id % 5 = 0``
    are exported twice, one second apart under a new insert id, which is
    what the within-trace de-dup must remove; every 13th call has an
    unparsable input-token count."""
    r = log_refs(t)
    base = F.timestamp_add("MINUTE", F.col("call_turn"), F.lit(TELEMETRY_BASE).cast("timestamp_ntz"))
    copies = F.when(F.col("call_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    x = r.withColumn("_copy", F.explode(copies))
    return x.select(
        F.when(F.col("_copy") == 0, F.col("insert_id"))
         .otherwise(F.concat(F.col("insert_id"), F.lit("-dup"))).alias("insertId"),
        F.timestamp_add("SECOND", F.col("_copy"), base).alias("timestamp"),
        "trace", F.col("span_id").alias("spanId"),
        F.struct(
            F.col("conversation_id").cast("string").alias("gen_ai_conversation_id"),
            F.col("input_ref").alias("gen_ai_input_messages_ref"),
            F.col("output_ref").alias("gen_ai_output_messages_ref"),
            F.when(F.col("call_id") % 13 == 0, F.lit("n/a"))
             .otherwise((F.col("call_turn") * 100).cast("string")).alias("gen_ai_usage_input_tokens"),
            F.col("usage_output_tokens").alias("gen_ai_usage_output_tokens"),
            F.lit("operations_agent").alias("gen_ai_agent_name"),
            F.lit('["STOP"]').alias("gen_ai_response_finish_reasons"),
            F.concat(F.lit("user-"), (F.col("conversation_id") % 10).cast("string")).alias("user_id"),
        ).alias("labels"))


def completions(t: Tables) -> DataFrame:
    """Message files as rows: (file_name, role, index, parts). Each line of a
    message is one part; by its place it is text (with its UTF-8 bytes as payload), a
    tool call with arguments, a tool's response, or a media uri."""
    def part(line, i):
        kind = (F.col("idx") + i) % 5
        text = ~kind.isin(1, 2, 3)
        chars = F.length(line).cast("string")
        return F.struct(
            F.when(kind == 1, "tool_call").when(kind == 2, "tool_call_response").when(kind == 3, "uri").otherwise("text").alias("type"),
            F.when(text, line).alias("content"), F.when(kind == 3, F.lit("image/png")).alias("mime_type"),
            F.when(kind == 3, F.concat(F.lit("gs://media/"), F.md5(line))).alias("uri"),
            F.when(text, F.encode(line, "UTF-8")).alias("data"),
            F.when(kind.isin(1, 2), F.concat(F.lit("call-"), i.cast("string"))).alias("id"),
            F.when(kind.isin(1, 2), F.lit("lookup_store")).alias("name"),
            F.when(kind == 1, F.concat(F.lit('{"chars":'), chars, F.lit("}"))).alias("arguments"),
            F.when(kind == 2, F.concat(F.lit('{"found":'), chars, F.lit("}"))).alias("response"))
    parts = F.transform(F.split(F.col("content"), "\n"), part)
    return messages(t).select("file_name", "role", F.col("idx").alias("index"), parts.alias("parts"))
