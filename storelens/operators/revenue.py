"""Revenue KPIs over the checkout ledger (P-05, A-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.metrics import net_revenue, valid_transaction


def store_revenue(pos_tx: DataFrame, by=("store_id", "business_date", "payment_method")) -> DataFrame:
    """A-06: net transaction revenue (subtotal - discount + tax) and
    transaction count per group, valid transactions (total > 0) only.
    Decimal sums are exact; partial sums combine map-side."""
    v = pos_tx.where(valid_transaction()).withColumn("_net", net_revenue())
    return v.groupBy(*by).agg(
        F.sum("_net").cast("decimal(22,2)").alias("net_revenue_usd"),
        F.count(F.lit(1)).alias("transactions"),
        F.sum("total_quantity").alias("units"))
