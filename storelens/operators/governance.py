"""Governance: data-quality rules, typed record contracts, contract search,
business-metric registry, question guardrail, guarded fact scans, scan
budget and catalog snapshots (G-04..G-10, S-07).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions import metrics as M
from storelens.operators.sizing import plan_size_bytes, scan_bytes


# ------------------------------------------------------------- G-04
@dataclass(frozen=True)
class Rule:
    name: str
    dimension: str
    expr: str                      # SQL condition a good row satisfies
    column: str | None = None
    threshold: float = 1.0         # minimum pass ratio for the rule to pass

    @staticmethod
    def not_null(column: str, name: str | None = None) -> "Rule":
        return Rule(name or f"{column}_not_null", "COMPLETENESS", f"`{column}` IS NOT NULL", column)

    @staticmethod
    def row_condition(expr: str, name: str, dimension: str = "INTEGRITY") -> "Rule":
        return Rule(name, dimension, expr)


# Rules of the reference's quality spec for the checkout ledger (fixed values).
POS_TX_RULES = (
    Rule.not_null("transaction_id"),
    Rule.row_condition("total = subtotal_amount - discount + tax_amount", "total_matches_parts"),
    Rule.row_condition("item_count <= total_quantity", "items_within_quantity"),
)


def passes(rule: Rule) -> Column:
    # a condition that evaluates to null counts as failed
    return F.coalesce(F.expr(rule.expr), F.lit(False))


def quality_scan(df: DataFrame, rules=POS_TX_RULES) -> DataFrame:
    """G-04: all rules in one aggregation pass: evaluated, passed, failed,
    pass ratio (4 places) and PASSED/FAILED against the rule threshold."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(passes(r)).alias(f"_p{i}") for i, r in enumerate(rules)]
    return judged(df.agg(*aggs), rules)


def judged(one: DataFrame, rules=POS_TX_RULES) -> DataFrame:
    """One row per rule from one row of counts: ``_n`` rows evaluated, ``_p0``, ``_p1``... passed."""
    rows = [F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.dimension).alias("dimension"),
                     F.lit(r.column).cast("string").alias("column_name"), F.lit(r.expr).alias("rule_expr"),
                     F.lit(float(r.threshold)).alias("threshold"), F.col(f"_p{i}").alias("passed"))
            for i, r in enumerate(rules)]
    out = one.select("_n", F.explode(F.array(*rows)).alias("r")).select("_n", "r.*")
    out = (out.withColumn("evaluated", F.col("_n")).withColumn("failed", F.col("_n") - F.col("passed"))
              .withColumn("pass_ratio", M.exact_ratio("passed", "evaluated", 4)).drop("_n"))
    ok = (F.col("evaluated") == 0) | (F.col("passed") >= F.ceil(F.col("threshold") * F.col("evaluated")))
    return out.withColumn("status", F.when(ok, "PASSED").otherwise("FAILED"))


def failing_rows(df: DataFrame, rules=POS_TX_RULES) -> DataFrame:
    """G-04: the rows failing at least one rule, with the failed rule names."""
    failed = F.array_compact(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]))
    return df.withColumn("failed_rules", failed).where(F.size("failed_rules") > 0)


# ------------------------------------------------------------- G-05/06
@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str                       # "enum" | "bool" | "string" | "int"
    required: bool = True
    values: tuple[str, ...] = ()


# The reference's table-operational-spec (fixed values).
TABLE_OPERATIONAL_SPEC = (
    FieldSpec("table_type", "enum", True, ("STREAMING_TABLE", "BATCH_TABLE")),
    FieldSpec("pii_included", "bool", True),
    FieldSpec("data_owner_team", "enum", True, ("store-ops", "inventory-mgmt", "loss-prevention")),
)


def validate_records(df: DataFrame, spec=TABLE_OPERATIONAL_SPEC) -> DataFrame:
    """G-05: per record, the list of contract violations (empty = valid):
    missing required fields, values outside an enum, non-boolean flags."""
    checks = []
    cols = set(df.columns)
    for f in spec:
        if f.name not in cols:
            if f.required:
                checks.append(F.lit(f"{f.name}: missing"))
            continue
        c = F.col(f.name)
        if f.required:
            checks.append(F.when(c.isNull(), F.lit(f"{f.name}: missing")))
        if f.type == "enum":
            checks.append(F.when(c.isNotNull() & ~c.cast("string").isin(*f.values),
                                 F.concat(F.lit(f"{f.name}: not in enum: "), c.cast("string"))))
        elif f.type == "bool":
            if dict(df.dtypes)[f.name] != "boolean":
                checks.append(F.when(c.isNotNull() & ~F.lower(c.cast("string")).isin("true", "false"),
                                     F.concat(F.lit(f"{f.name}: not boolean: "), c.cast("string"))))
        elif f.type == "int":
            checks.append(F.when(c.isNotNull() & c.cast("string").try_cast("long").isNull(),
                                 F.concat(F.lit(f"{f.name}: not integer: "), c.cast("string"))))
    v = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return df.withColumn("violations", v).withColumn("valid", F.size("violations") == 0)


def search_contract(df: DataFrame, **values) -> DataFrame:
    """G-06: records whose contract fields equal all given values."""
    cond = F.lit(True)
    for k, v in values.items():
        cond = cond & (F.col(k).cast("string") == F.lit(str(v).lower() if isinstance(v, bool) else v))
    return df.where(cond)


# ------------------------------------------------------------- G-07
@dataclass(frozen=True)
class MetricTerm:
    term_id: str
    name: str
    category: str
    target: str
    formula: str
    build: Callable[[DataFrame, list[str]], DataFrame]
    filter: str | None = None
    bands: tuple = field(default_factory=tuple)

    def apply(self, df: DataFrame, by=()) -> DataFrame:
        return self.build(df, list(by))


def _net_revenue(df, by):
    v = df.where(M.valid_transaction()).withColumn("_v", M.net_revenue())
    return v.groupBy(*by).agg(F.sum("_v").cast("decimal(22,2)").alias("value"))


def _on_hand(df, by):
    return df.groupBy(*by).agg(F.sum(M.total_on_hand()).cast("decimal(22,2)").alias("value"))


def _cover(df, by):
    """Cover hours of the summed position: sum(on hand) / (sum(sold) / 12)."""
    g = df.groupBy(*by).agg(F.sum(M.total_on_hand()).alias("_oh"),
                            F.sum("total_units_sold_intraday").alias("_sold"))
    return g.select(*by, M.round_half_up(M.cover_hours("_oh", "_sold"), 4).alias("value"),
                    M.risk_band(M.cover_hours("_oh", "_sold")).alias("band"))


def _override(df, by):
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"),
                            F.count_if(F.col("alert_type") == M.PROMO_ABUSE).alias("_p"))
    return g.select(*by, M.exact_ratio("_p", "_n", 4).alias("value"))


def _warranty_share(df, by):
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.count_if("in_warranty").alias("_c"))
    return g.select(*by, M.exact_ratio("_c", "_n", 4).alias("value"))


# The reference's business glossary terms (fixed values).
METRICS: dict[str, MetricTerm] = {t.term_id: t for t in (
    MetricTerm("net-transaction-revenue", "Net Transaction Revenue", "store-ops", "pos_transactions_gold",
               "subtotal_amount - discount + tax_amount", _net_revenue, "total > 0"),
    MetricTerm("total-on-hand-inventory", "Total On-Hand Inventory", "inventory-mgmt",
               "gold_inventory_reconciliation_ledger", "(shelf_qty + backroom_qty)", _on_hand),
    MetricTerm("inventory-cover-hours", "Estimated Inventory Cover Hours", "inventory-mgmt",
               "gold_inventory_reconciliation_ledger",
               "SAFE_DIVIDE((shelf_qty + backroom_qty), (total_units_sold_intraday / 12.0))", _cover,
               bands=((6.0, "CRITICAL_BURN_SPIKE"), (12.0, "MONITOR_VELOCITY"))),
    MetricTerm("cashier-override-rate", "Cashier Promo Override Rate", "loss-prevention", "pos_anomaly_alerts",
               "SAFE_DIVIDE(COUNTIF(alert_type = 'cashier_promo_abuse'), COUNT(*))", _override),
    MetricTerm("warranty-policy-duration", "Warranty Policy Duration", "store-ops",
               "warranty_generic_sections_extracted.warranty_duration_months",
               "DATE_DIFF(CURRENT_DATE(), purchase_date, MONTH) <= warranty_duration_months", _warranty_share),
)}


def metric(term_id: str) -> MetricTerm:
    return METRICS[term_id]


def glossary(spark: SparkSession) -> DataFrame:
    """The registry as a DataFrame (one row per term)."""
    rows = [(t.term_id, t.name, t.category, t.target, t.formula, t.filter) for t in METRICS.values()]
    return spark.createDataFrame(rows, "term_id string, name string, category string, target string, "
                                       "formula string, filter string")


# ------------------------------------------------------------- G-08/09/10
# Guardrail patterns of the reference (fixed values), applied to lower-cased text.
PARTITIONED_FACT_PATTERNS = (
    r"\bpos_transactions\b",
    r"\bpos_transactions_gold\b",
    r"\btransactions?\b",
    r"\bcheckout\b",
    r"\bpos_anomaly_alerts\b",
    r"\banomal(?:y|ies)\b",
    r"\bpromo abuse\b",
    r"\boverride\b",
)
TEMPORAL_PATTERNS = (
    r"\b(?:last|past|next)\s+\d+\s+(?:day|hour|week|month|year)s?\b",
    r"\b\d+[- ](?:day|hour|week|month)s?\b",
    r"\b(?:today|yesterday|tomorrow)\b",
    r"\b\d{4}[-/]\d{1,2}[-/]\d{1,2}\b",
    r"\b\d{8}\b",
    r"\b(?:january|february|march|april|may|june|july|august|september|october|november|december)\b",
    r"\b202\d\b",
    r"\b(?:between|from\s+\d|since|until|before|after|rolling)\b",
    r"\bdate\b",
)
# What a question without a time range gets as its answer (wording of this library).
CLARIFICATION_TEXT = (
    "Which days do you mean? This table is kept by day: name a day, a range of days or a "
    "span such as 'the past two weeks', so that only those days are read.")
FACT_REGEX = "|".join(f"(?:{p})" for p in PARTITIONED_FACT_PATTERNS)
TEMPORAL_REGEX = "|".join(f"(?:{p})" for p in TEMPORAL_PATTERNS)


def classify_questions(df: DataFrame, text: str = "text") -> DataFrame:
    """G-08: a question that names a partitioned fact table but no time
    range needs clarification. Two ``rlike`` alternations per row."""
    q = F.lower(F.col(text))
    fact = q.rlike(FACT_REGEX)
    dated = q.rlike(TEMPORAL_REGEX)
    return (df.withColumn("targets_fact", fact).withColumn("has_date", dated)
              .withColumn("needs_clarification", fact & ~dated)
              .withColumn("guardrail_message", F.when(fact & ~dated, F.lit(CLARIFICATION_TEXT))))


class MissingDateRange(ValueError):
    pass


def scan_fact(df: DataFrame, ts_col: str, start: str | None, end: str | None) -> DataFrame:
    """G-09: a partitioned fact can only be read with a [start, end) range on
    its event time; the range is a plain predicate on the partition column,
    so the scan prunes partitions and row groups."""
    if not start or not end:
        raise MissingDateRange(f"a date range on {ts_col} is required to scan this fact table")
    dtype = dict(df.dtypes)[ts_col]
    lo, hi = F.lit(start).cast(dtype), F.lit(end).cast(dtype)
    return df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


class ScanBudgetExceeded(RuntimeError):
    pass


def check_scan_budget(df: DataFrame, max_bytes: int) -> DataFrame:
    """G-10: refuse to run a plan whose scans would read more than
    ``max_bytes``: files left after partition pruning, scaled to the
    columns read (``sizing.scan_bytes``), checked before any job runs."""
    est = scan_bytes(df)
    if est > max_bytes:
        raise ScanBudgetExceeded(f"estimated {est} bytes > budget {max_bytes}")
    return df


# ------------------------------------------------------------- S-07
def catalog_snapshot(tables: dict[str, DataFrame], contracts: dict[str, dict] | None = None,
                     descriptions: dict[str, str] | None = None) -> DataFrame:
    """S-07: one row per (table, column): position, type, nullability, the
    table's description and contract values, and its row count (one
    count per table, computed by Spark)."""
    contracts = contracts or {}
    descriptions = descriptions or {}
    out = None
    for tname, df in tables.items():
        c = contracts.get(tname, {})
        meta = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
                                  F.lit(f.dataType.simpleString()).alias("data_type"),
                                  F.lit(f.nullable).alias("nullable"))
                         for i, f in enumerate(df.schema.fields)])
        x = (df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(tname).alias("table_name"), "row_count", F.explode(meta).alias("m"))
               .select("table_name", "row_count", "m.*")
               .withColumn("description", F.lit(descriptions.get(tname)).cast("string"))
               .withColumn("table_type", F.lit(c.get("table_type")).cast("string"))
               .withColumn("pii_included", F.lit(c.get("pii_included")).cast("boolean"))
               .withColumn("data_owner_team", F.lit(c.get("data_owner_team")).cast("string")))
        out = x if out is None else out.unionByName(x)
    return out


CATALOG_SCHEMA = ("table_name string, row_count long, ordinal int, column_name string, data_type string, nullable boolean, "
                  "description string, table_type string, pii_included boolean, data_owner_team string")


def write_catalog(snapshot: DataFrame, path: str) -> None:
    """S-07: the snapshot as one JSON document per column line (rows are bounded by the schema)."""
    snapshot.coalesce(1).write.mode("overwrite").json(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOG_SCHEMA).json(path)
