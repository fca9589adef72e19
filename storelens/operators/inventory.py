"""Inventory operators: ledger metrics and the stockout list (P-01..P-04, P-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.metrics import (cover_hours, risk_band, round_half_up,
                                         shelf_ratio, total_on_hand)


def with_ledger_metrics(inv: DataFrame) -> DataFrame:
    """Add on-hand, cover hours, risk band and shelf ratio (narrow, no shuffle)."""
    return (inv
            .withColumn("total_on_hand_inventory", total_on_hand())
            .withColumn("est_cover_hours_remaining", cover_hours())
            .withColumn("risk_band", risk_band("est_cover_hours_remaining"))
            .withColumn("shelf_stock_ratio", shelf_ratio()))


def stockout_risk(inv: DataFrame, max_hours: float = 20.0, limit: int | None = 20) -> DataFrame:
    """P-04: positions with cover < ``max_hours``, revenue desc then cover asc.

    The limit is the feature (a top-k list). With a limit the plan is a
    per-partition top-k (TakeOrderedAndProject) with no full sort; store
    and item break ties so the list is deterministic.
    """
    led = with_ledger_metrics(inv).where(F.col("est_cover_hours_remaining") < F.lit(float(max_hours)))
    out = led.select(
        "store_id", "store_name", "city", "item_id", "shelf_qty", "backroom_qty",
        "total_on_hand_inventory",
        F.col("intraday_gross_revenue_usd").cast("decimal(18,2)").alias("intraday_gross_revenue_usd"),
        round_half_up("est_cover_hours_remaining", 4).alias("est_cover_hours_remaining"),
        "risk_band", *[c for c in ("reconciliation_status",) if c in inv.columns])
    ordered = out.orderBy(F.col("intraday_gross_revenue_usd").desc_nulls_last(),
                          F.col("est_cover_hours_remaining").asc_nulls_last(),
                          "store_id", "item_id")
    return ordered.limit(limit) if limit else ordered


def risk_band_counts(inv: DataFrame) -> DataFrame:
    """Positions per risk band (null band = no sales)."""
    return (with_ledger_metrics(inv).groupBy("risk_band")
            .agg(F.count(F.lit(1)).alias("positions"),
                 F.sum("total_on_hand_inventory").alias("on_hand_units")))
