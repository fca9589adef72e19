"""Loss-prevention operators: offender ranking, override rates, baselines,
trailing-hour cashier metrics, the rank-then-drill audit and live vs
baseline (A-01..A-04, W-04, W-05, J-06, J-07, T-04).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.metrics import PROMO_ABUSE, exact_ratio, round_half_up
from storelens.operators.filters import checkout_log, last_days

PROMO_EVENT = "purchase"   # fixture: promo redemptions
HOUR_MICROS = 3600 * 1_000_000


def mean_risk(c="risk_score") -> Column:
    """``ROUND(AVG(risk_score), 4)``: the scores are summed as wide decimals, so the mean does
    not depend on the order of the partial sums; it is rounded once, at the end."""
    return F.round(F.avg(F.col(c).cast("decimal(28,18)")), 4).cast("double")


def rank_offenders(alerts: DataFrame, days: int = 7, as_of=None, limit: int | None = 20,
                   alert_type: str = PROMO_ABUSE) -> DataFrame:
    """A-01: promo-abuse alerts of the last ``days`` per (store, cashier):
    count, mean risk rounded to 4, max risk, latest alert; count desc,
    mean desc. Partial aggregation runs map-side, so the shuffle carries
    one row per key and task; the ranked list is a top-k, not a sort."""
    a = last_days(alerts.where(F.col("alert_type") == alert_type), "alert_ts", days, as_of)
    g = a.groupBy("store_id", "cashier_id").agg(
        F.count("alert_id").alias("alert_count"),
        mean_risk().alias("avg_risk_score"),
        F.max("risk_score").alias("max_risk_score"),
        F.max("alert_ts").alias("latest_alert_ts"))
    out = g.orderBy(F.col("alert_count").desc(), F.col("avg_risk_score").desc_nulls_last(),
                      "store_id", "cashier_id")
    return out.limit(limit) if limit else out


def override_rate(alerts: DataFrame, by=("store_id",), as_pct: bool = True,
                  daily: bool = True) -> DataFrame:
    """A-02: countif(promo abuse) / count per group (and calendar day),
    as a fraction (4 places) or a percentage (2 places); null on 0."""
    keys = [F.col(k) for k in by]
    if daily:
        keys.append(F.to_date("alert_ts").alias("alert_date"))
    g = alerts.groupBy(*keys).agg(F.count(F.lit(1)).alias("alerts"),
                                  F.count_if(F.col("alert_type") == PROMO_ABUSE).alias("promo_abuse_alerts"))
    rate = (exact_ratio("promo_abuse_alerts", "alerts", 2, scale=100) if as_pct
            else exact_ratio("promo_abuse_alerts", "alerts", 4))
    return g.withColumn("override_rate_pct" if as_pct else "override_rate", rate)


def cashier_baseline(alerts: DataFrame, days: int = 7, as_of=None) -> DataFrame:
    """A-03: per cashier over the last ``days``: alerts, promo-abuse alerts,
    promo-abuse share in percent (the "baseline override rate")."""
    a = last_days(alerts, "alert_ts", days, as_of)
    return override_rate(a, by=("cashier_id",), as_pct=True, daily=False).withColumnRenamed(
        "override_rate_pct", "baseline_rate_pct")


def _with_time_buckets(df: DataFrame, ts_col: str, window_micros: int, bucket_micros: int) -> DataFrame:
    """Split each key's timeline into buckets so no window task holds a
    whole hot key. A row in the last ``window`` of its bucket is copied
    into the next bucket as context (never emitted there); every row's
    trailing window then lies inside its own bucket's partition."""
    if bucket_micros < window_micros:
        raise ValueError("bucket must be at least as wide as the window")
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    b = F.floor(us / F.lit(bucket_micros)).cast("long")
    tail = (us - b * F.lit(bucket_micros)) >= F.lit(bucket_micros - window_micros)
    copies = F.when(tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (df.withColumn("_us", us).withColumn("_b", b)
              .withColumn("_shift", F.explode(copies))
              .withColumn("_bucket", F.col("_b") + F.col("_shift")))


def trailing(df: DataFrame, key: str, ts_col: str, aggs: dict[str, Column],
             window_micros: int = HOUR_MICROS, bucket_micros: int = 6 * HOUR_MICROS) -> DataFrame:
    """W-04: per-event trailing aggregates over ``[ts - window, ts]``, peers at
    ``ts`` included (RANGE frame). Partitioned by (key, time bucket)."""
    x = _with_time_buckets(df, ts_col, window_micros, bucket_micros)
    w = (Window.partitionBy(key, "_bucket").orderBy("_us")
         .rangeBetween(-window_micros, Window.currentRow))
    for name, agg in aggs.items():
        x = x.withColumn(name, agg.over(w))
    return x.where(F.col("_shift") == 0).drop("_us", "_b", "_shift", "_bucket")


def rt_metrics(alerts: DataFrame, window_micros: int = HOUR_MICROS,
               bucket_micros: int = 6 * HOUR_MICROS) -> DataFrame:
    """A-04: trailing-hour metrics per cashier at every event: transactions,
    overrides (promo abuse), promos, their rates, total and mean discount.
    ``row_key`` is ``STORE#CASHIER#event`` as in the key-value table.
    Needs a ``discount_usd`` column beside the alert columns."""
    disc_cents = (F.col("discount_usd").cast("decimal(18,2)") * 100).cast("long")
    base = alerts
    m = trailing(base.withColumn("_cents", disc_cents), "cashier_id", "alert_ts", {
        "txn_count": F.count(F.lit(1)),
        "override_count": F.count_if(F.col("alert_type") == PROMO_ABUSE),
        "promo_count": F.count_if(F.col("alert_type") == PROMO_EVENT),
        "_cents_sum": F.sum("_cents"),
    }, window_micros, bucket_micros)
    return m.select(
        F.concat_ws("#", "store_id", "cashier_id", F.col("alert_id").cast("string")).alias("row_key"),
        "store_id", "cashier_id", F.col("alert_id").alias("event_id"), F.col("alert_ts").alias("event_ts"),
        "txn_count", "override_count", "promo_count",
        exact_ratio("override_count", "txn_count", 2, scale=100).alias("override_rate_pct"),
        exact_ratio("promo_count", "txn_count", 2, scale=100).alias("promo_rate_pct"),
        (F.col("_cents_sum").cast("decimal(20,0)") / 100).cast("decimal(18,2)").alias("total_discount_usd"),
        exact_ratio("_cents_sum", F.col("txn_count") * 100, 2).alias("avg_discount_usd"),
    )


def audit_status(metrics: DataFrame, review_at: float = 25.0, flag_at: float = 50.0,
                 rate_col: str = "override_rate_pct") -> DataFrame:
    """T-04: clear / review / flagged from the trailing override rate
    (thresholds are parameters; the reference does not define them)."""
    r = F.col(rate_col)
    return metrics.withColumn("audit_status", F.when(r >= flag_at, "flagged")
                              .when(r >= review_at, "review").otherwise("clear"))


def latest_n(df: DataFrame, key: str, ts_col: str, n: int = 5, tie: str | None = None) -> DataFrame:
    """W-05: the latest ``n`` rows per key (row_number desc <= n). Spark
    plans this with a per-partition group limit before the shuffle, so
    a hot key ships at most ``n`` rows per map task."""
    order = [F.col(ts_col).desc()] + ([F.col(tie).desc()] if tie else [])
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def latest_rt_metrics(alerts: DataFrame, n: int = 1, window_micros: int = HOUR_MICROS) -> DataFrame:
    """W-05 over A-04: the latest ``n`` trailing snapshots per cashier, from the events that
    those windows cover alone; a cashier's earlier history is dropped before the window is sorted."""
    heads = (latest_n(alerts.select("cashier_id", "alert_ts", "alert_id"), "cashier_id", "alert_ts", n, tie="alert_id")
             .groupBy("cashier_id").agg(F.min("alert_ts").alias("_first")))
    reach = F.make_interval(secs=F.lit(window_micros / 1e6))
    recent = alerts.join(heads, "cashier_id").where(F.col("alert_ts") >= F.col("_first") - reach).drop("_first")
    return latest_n(rt_metrics(recent, window_micros), "cashier_id", "event_ts", n, tie="event_id")


def top_offender(alerts: DataFrame, days: int = 7, as_of=None) -> DataFrame:
    """The single highest-ranked (store, cashier) as a one-row DataFrame."""
    return rank_offenders(alerts, days, as_of, limit=1).select(
        F.col("cashier_id").alias("_top_cashier"), F.col("store_id").alias("_alert_store"))


def audit_top_offender(alerts: DataFrame, silver: DataFrame, days: int = 7, as_of=None,
                       limit: int | None = None) -> DataFrame:
    """J-06: rank offenders, then drill into the top one's checkout rows in
    the federated log, in one plan. The top-1 row (size 1 by construction)
    is broadcast; nothing is collected. No offender -> empty result."""
    top = F.broadcast(top_offender(alerts, days, as_of))
    rows = silver.join(top, silver.cashier_id == top._top_cashier, "left_semi")
    return checkout_log(rows, None, limit)


def live_vs_baseline(live: DataFrame, baseline: DataFrame) -> DataFrame:
    """J-07: latest trailing metrics per cashier beside the 7-day baseline.

    ``override_rate_pct`` (overrides / transactions) and
    ``baseline_rate_pct`` (promo-abuse alerts / alerts) have different
    denominators; the difference is shown as in the reference, with that
    caveat. Full outer join: cashiers on one side only keep their row."""
    l = live.select("cashier_id", "event_ts", "txn_count", "override_count", "override_rate_pct",
                    "promo_rate_pct")
    b = baseline.select(F.col("cashier_id").alias("_b_cashier"), F.col("alerts").alias("baseline_alerts"),
                        F.col("promo_abuse_alerts").alias("baseline_promo_abuse_alerts"),
                        "baseline_rate_pct")
    j = l.join(b, l.cashier_id == b._b_cashier, "full_outer")
    return j.select(
        F.coalesce("cashier_id", "_b_cashier").alias("cashier_id"),
        F.col("event_ts").alias("live_event_ts"), "txn_count", "override_count",
        "override_rate_pct", "promo_rate_pct", "baseline_alerts", "baseline_promo_abuse_alerts",
        "baseline_rate_pct",
        round_half_up(F.col("override_rate_pct") - F.col("baseline_rate_pct"), 2).alias("rate_difference_pct"))
