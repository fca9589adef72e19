"""Warranty triage over nested purchase records (J-01..J-03, Q-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.metrics import in_warranty, month_diff
from storelens.operators.filters import lookup_purchase


def warranty_triage(tx: DataFrame, terms: DataFrame, as_of) -> DataFrame:
    """J-01/J-02: unnest ``items``, inner equi-join ``item_id = product_id``,
    project the policy and the coverage verdict as of ``as_of``.

    All items are returned (the reference's LIMIT 1 is not kept). The
    explode is narrow; the join is planned from measured sizes: the
    policy table is broadcast while it stays under the broadcast
    threshold, and sort-merge joined when it grows with the catalogue.
    """
    as_of_c = F.lit(as_of).cast("date")
    keep = [c for c in ("transaction_id", "business_date", "customer_loyalty_tier", "store_id",
                        "customer_id", "payment_method") if c in tx.columns]
    items = tx.select(*keep, F.explode("items").alias("item")).select(
        *keep, F.col("item.item_id").alias("product_id"), F.col("item.item_name").alias("product_name"),
        F.col("item.unit_price").alias("unit_price"), F.col("item.line_no").alias("line_no"))
    j = items.join(terms, "product_id")
    return j.select(
        *keep, "line_no", "product_id", "product_name", "unit_price", "warranty_duration_months",
        *[c for c in ("service_level", "coverage_scope_details", "exclusions_and_limitations",
                      "official_retailer_guarantee_and_sla", "support_url") if c in terms.columns],
        month_diff("business_date", as_of_c).alias("months_since_purchase"),
        in_warranty("business_date", "warranty_duration_months", as_of_c).alias("in_warranty"))


def warranty_for(tx: DataFrame, terms: DataFrame, as_of, **keys) -> DataFrame:
    """J-03: the same triage for one transaction or one customer
    (+ store / payment method); the lookup filter runs before the explode."""
    return warranty_triage(lookup_purchase(tx, **keys), terms, as_of)


def coverage_by_customer(triage: DataFrame) -> DataFrame:
    """Items in and out of coverage per customer."""
    return triage.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if("in_warranty").alias("items_in_warranty"),
        F.count_if(~F.col("in_warranty")).alias("items_out_of_warranty"))
