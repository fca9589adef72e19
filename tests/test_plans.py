"""Plan-time behaviour and reached branches of the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from storelens.operators import chunking, profiling, retrieval, sizing
from storelens.operators.join_mining import join_candidates
from storelens.plans.registry import registry
from storelens.sources import tables
from tests.conftest import SF001, SF01


def test_spread_runs_no_job(spark, monkeypatch):
    """While every registered query is built, ``spread`` itself starts no job."""
    tracker = spark.sparkContext.statusTracker()
    started, calls = [], []
    real = sizing.spread

    def watched(df, *a, **k):
        before = set(tracker.getJobIdsForGroup(None))
        out = real(df, *a, **k)
        started.extend(set(tracker.getJobIdsForGroup(None)) - before)
        calls.append(1)
        return out

    for module in (sizing, chunking, profiling, retrieval):
        monkeypatch.setattr(module, "spread", watched)
    # the streams and sinks run whole jobs while they are built; they read tables, which is where spread acts
    for name in registry():
        if not name.startswith("stream_"):
            E.queries()[name](spark, SF001)
    big = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()
    watched(big)
    assert calls and not started


def test_spread_leaves_exchanges_alone_and_splits_scans(spark):
    agg = spark.range(10).groupBy("id").count()
    assert not sizing.is_narrow(agg) and sizing.spread(agg) is agg
    scan = tables.read_table(spark, SF001, "documents")
    assert sizing.is_narrow(scan.where("doc_id > 3").select("text"))
    assert sizing.spread(scan).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_broadcast_is_measured(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("s"))
    assert "broadcast" not in sizing.broadcast_if_small(wide, max_bytes=100_000)._jdf.queryExecution().logical().toString()
    assert "broadcast" in sizing.broadcast_if_small(wide)._jdf.queryExecution().logical().toString()


@pytest.mark.parametrize("name,column,values", [
    ("runbook_answers", "route", {"vector", "fallback", "decline"}),
    ("retrieval_gate", "accepted", {True, False}),
    ("question_guardrail", "needs_clarification", {True, False}),
    ("completions_mart", "part_type", {"text", "tool_call", "tool_call_response", "uri"}),
])
def test_every_branch_occurs(spark, name, column, values):
    got = {r[0] for r in E.queries()[name](spark, SF01).select(column).distinct().collect()}
    assert got == values


def test_every_violation_occurs(spark):
    v = E.queries()["ledger_contract_violations"](spark, SF01)
    kinds = {r[0] for r in v.select(F.regexp_extract("violation", r"^\w+: ([a-z ]+)", 1)).distinct().collect()}
    assert {k.strip() for k in kinds} == {"missing", "not boolean", "not integer", "not in enum"}


def test_keywords_and_codes_are_matched(spark):
    terms = {r[0] for r in E.queries()["keyword_fallback"](spark, SF01).select("matched_term").distinct().collect()}
    assert {"ERR-42-", "A-77-B"} <= terms and terms & {"printer", "TCx", "beep"}


def test_long_values_count_in_join_candidates(spark):
    a = spark.createDataFrame([("x" * 100,), ("y" * 200,), ("z",)], "v string")
    b = spark.createDataFrame([("x" * 100,), ("q",)], "w string")
    rows = join_candidates({"a": a, "b": b}, 0.3).collect()
    assert {(r["left_table"], r["left_distinct"], r["overlap"]) for r in rows} == {("a", 3, 1), ("b", 2, 1)}


def test_baskets_are_collected_where_their_join_left_the_lines(spark):
    """The nested history adds no shuffle to its joins: the order's key, by which the lines lie, is a grouping key."""
    from storelens.plans import fixtures as fx
    from storelens.sources.tables import Tables
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        h = fx.history(Tables(spark, SF001))
        plan = h._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(transaction_id" not in plan and plan.count("Exchange hashpartitioning(") == 6
        flat = h.select("transaction_id", F.explode("items").alias("i")).select("transaction_id", "i.*")
        lines = fx.history_lines(Tables(spark, SF001)).select(*flat.columns)
        assert flat.exceptAll(lines).count() == lines.exceptAll(flat).count() == 0 and flat.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
