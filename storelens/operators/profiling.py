"""Column profiles, sampled scans and top values (G-01..G-03).

A profile is one aggregation pass over the table (partial aggregates
combine map-side; only one row per task crosses the shuffle) followed
by a narrow ``stack`` into one row per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.metrics import exact_ratio, round_half_up
from storelens.operators.sizing import spread

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, _NUMERIC):
        return "numeric"
    if isinstance(dt, _TEMPORAL):
        return "temporal"
    if isinstance(dt, (T.StringType, T.BooleanType, T.BinaryType)):
        return "scalar"
    return "complex"


def _as_text(c, dt: T.DataType):
    if isinstance(dt, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, TS_FORMAT)
    if isinstance(dt, T.BinaryType):
        return F.hex(c)
    return c.cast("string")


# The profile is written as SQL expression text and handed to Spark in one
# ``selectExpr`` call per stage: building it from Column objects costs one
# driver round trip per expression node (tens of thousands for a wide
# table set), while a string is parsed JVM-side in one call.

def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _text_sql(e: str, dt: T.DataType) -> str:
    if isinstance(dt, T.DateType):
        return f"date_format({e}, 'yyyy-MM-dd')"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format({e}, '{TS_FORMAT}')"
    if isinstance(dt, T.BinaryType):
        return f"hex({e})"
    return f"CAST({e} AS STRING)"


def _round_sql(e: str, places: int) -> str:
    """SQL form of ``round_half_up`` (double literals, as the Column form)."""
    s = f"{float(10 ** places)!r}D"
    return f"(CAST(floor(({e}) * {s} + 0.5D) AS DOUBLE) / {s})"


def exact_mean_sql(s6: str, n: str, dbl_mean: str, places: int = 4) -> str:
    """Mean rounded half-up to ``places`` from an exact DECIMAL(38,6) sum
    ``s6`` of ``n`` values: floor((2*U + 10^6/10^p * n) / (2 * 10^6/10^p * n))
    in integer decimal arithmetic (U = the sum in millionths), so the result
    does not depend on summation order. A mean lying exactly on a rounding
    half (2-decimal data over 1,000 rows, say) is common, and a double sum
    lands on either side of it. ``dbl_mean`` (double average) is used when
    some value does not fit the decimal type (or the sum is huge)."""
    k = 10 ** (6 - places)
    u = f"CAST({s6} * 1000000 AS DECIMAL(38,0))"
    a = f"(2 * {u} + {k} * {n})"
    b = f"(CAST({2 * k} AS DECIMAL(38,0)) * {n})"
    q = f"CAST(({a} - pmod({a}, {b})) / {b} AS DECIMAL(38,0))"
    return (f"CASE WHEN {s6} IS NOT NULL AND abs({s6}) < 1e25BD THEN CAST({q} AS DOUBLE) / {float(10 ** places)!r}D "
            f"ELSE {_round_sql(dbl_mean, places)} END")


def profile(df: DataFrame, exact: bool = False, quantiles=(0.25, 0.5, 0.75),
            accuracy: int = 10000) -> DataFrame:
    """G-01: per column: rows, nulls, null ratio, distinct values, min and
    max (numbers as doubles, other types as text), and for numbers mean,
    standard deviation and quantiles.

    ``exact`` counts distinct values exactly (one extra shuffle of
    de-duplicated (column, value) pairs) and skips quantiles; the default
    uses HyperLogLog++ and ``percentile_approx``, which stay one pass at
    any size."""
    aggs = ["count(1) AS _rows"]
    rows = []
    qs = "array(" + ", ".join(f"{float(q)!r}D" for q in quantiles) + ")" if quantiles else None
    for i, f in enumerate(df.schema.fields):
        kind = _kind(f.dataType)
        c = _ident(f.name)
        has, num = kind != "complex", kind == "numeric"
        aggs.append(f"count({c}) AS _{i}_nn")
        if has and not exact:
            aggs.append(f"approx_count_distinct({c}) AS _{i}_nd")
        if num:   # numbers stay numbers (text forms differ between engines)
            d6 = f"try_cast({c} AS DECIMAL(38,6))"
            aggs += [f"CAST(min({c}) AS DOUBLE) AS _{i}_min", f"CAST(max({c}) AS DOUBLE) AS _{i}_max",
                     f"avg(CAST({c} AS DOUBLE)) AS _{i}_mean", f"stddev_samp(CAST({c} AS DOUBLE)) AS _{i}_sd",
                     # exact sum, kept only when every value fitted the decimal type
                     f"CASE WHEN count({d6}) = count({c}) THEN sum({d6}) END AS _{i}_s6"]
            if not exact and qs:
                aggs.append(f"percentile_approx(CAST({c} AS DOUBLE), {qs}, {int(accuracy)}) AS _{i}_q")
        elif has:
            aggs += [f"{_text_sql(f'min({c})', f.dataType)} AS _{i}_min",
                     f"{_text_sql(f'max({c})', f.dataType)} AS _{i}_max"]
        null_s, null_d = "CAST(NULL AS STRING)", "CAST(NULL AS DOUBLE)"
        rows.append("named_struct(" + ", ".join([
            "'column_name'", _str(f.name), "'data_type'", _str(f.dataType.simpleString()),
            "'non_null'", f"_{i}_nn", "'_ci'", str(i), "'_has'", "true" if has else "false",
            "'distinct_count'", f"_{i}_nd" if has and not exact else "CAST(NULL AS BIGINT)",
            "'min_value'", f"_{i}_min" if has and not num else null_s,
            "'max_value'", f"_{i}_max" if has and not num else null_s,
            "'min_number'", f"_{i}_min" if num else null_d,
            "'max_number'", f"_{i}_max" if num else null_d,
            "'mean'", exact_mean_sql(f"_{i}_s6", f"_{i}_nn", f"_{i}_mean") if num else null_d,
            "'stddev'", _round_sql(f"_{i}_sd", 4) if num else null_d,
            "'quantiles'", f"_{i}_q" if num and not exact and qs else "CAST(NULL AS ARRAY<DOUBLE>)"]) + ")")
    src = spread(df)
    one = src.selectExpr(*aggs)   # aggregate functions only: one global aggregation
    out = one.selectExpr("_rows", f"explode(array({', '.join(rows)})) AS p").select("_rows", "p.*")
    stats = ["min_value", "max_value", "min_number", "max_number", "mean", "stddev"]
    if exact:
        # one row per column on both sides; the equi-join is on the column index
        nd = exact_distinct(src, [f.name for f in df.schema.fields if _kind(f.dataType) != "complex"])
        out = out.join(F.broadcast(nd), "_ci", "left")
        head = ["column_name", "data_type", *stats,
                F.when(F.col("_has"), F.coalesce(F.col("_nd"), F.lit(0))).cast("long").alias("distinct_count")]
    else:
        head = ["column_name", "data_type", "distinct_count", *stats, "quantiles"]
    nulls = F.col("_rows") - F.col("non_null")
    # one projection for the tail (each extra DataFrame call re-analyses the plan)
    return out.select(*head, F.col("_rows").alias("row_count"), nulls.alias("null_count"),
                      exact_ratio(nulls, F.col("_rows"), 4).alias("null_ratio"))


def exact_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact distinct counts of many columns in one shuffle: (column,
    value) pairs are de-duplicated map-side, shuffled once, then counted
    per column. Returns (_ci, _nd) for columns with at least one value;
    the caller fills 0 for the rest. At most one row per column, so the
    result is bounded by the schema, not the data."""
    idx = {f.name: i for i, f in enumerate(df.schema.fields)}
    if not columns:
        return df.sparkSession.range(0).selectExpr("CAST(id AS INT) AS _ci", "id AS _nd")
    # long values (texts, pages) travel as 128-bit digests
    def value(c):
        v = f"CAST({_ident(c)} AS STRING)"
        return f"CASE WHEN length({v}) > 64 THEN concat('md5:', md5({v})) ELSE {v} END"
    pairs = ", ".join(f"named_struct('_ci', {idx[c]}, 'v', {value(c)})" for c in columns)
    x = df.selectExpr(f"explode(array({pairs})) AS p").select("p.*").where("v IS NOT NULL")
    return x.distinct().groupBy("_ci").agg(F.count(F.lit(1)).alias("_nd"))


def profile_all(tables: dict[str, DataFrame], exact: bool = False, **kw) -> DataFrame:
    """G-02: profiles of many tables, one union with a ``table_name`` column."""
    out = None
    for name, df in tables.items():
        p = profile(df, exact=exact, **kw).withColumn("table_name", F.lit(name))
        out = p if out is None else out.unionByName(p)
    return out


def sample_or_full(df: DataFrame, pct: float, seed: int = 42) -> DataFrame:
    """G-03: a ``pct`` percent Bernoulli sample; a streaming source cannot
    be sampled this way, so it is scanned in full."""
    if df.isStreaming or pct >= 100.0:
        return df
    return df.sample(withReplacement=False, fraction=pct / 100.0, seed=seed)


def hash_sample(df: DataFrame, pct: int, *keys: str) -> DataFrame:
    """G-03: a sample of about ``pct`` percent that any run and engine repeats: rows whose key's MD5
    (first 32 bits, modulo 100) is below ``pct``."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.where(F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(100)) < pct)


def approximation_errors(df: DataFrame, within: float = 0.1) -> DataFrame:
    """G-01: the exact distinct count of each column, and whether the sketch's count is ``within`` that
    share of it (one row either way allowed)."""
    exact = profile(df, exact=True).select("column_name", F.col("distinct_count"))
    sketch = profile(df).select("column_name", F.col("distinct_count").alias("_d"))
    off = F.abs(F.col("_d") - F.col("distinct_count")) <= F.col("distinct_count") * within + 1
    return exact.join(sketch, "column_name").select("column_name", "distinct_count", F.coalesce(off, F.col("_d").isNull()).alias("sketch_ok"))


def top_values(df: DataFrame, k: int = 5, columns=None, digest_over: int | None = None) -> DataFrame:
    """Most frequent values per column (ties by value). One shuffle for all
    columns: (column, value) pairs are counted with map-side combining, so
    a value held by a third of the rows is one partial count per task. With ``digest_over``
    values of more characters are counted and shown by their MD5, so no long text is shuffled."""
    fields = [f for f in df.schema.fields if (columns is None or f.name in columns)
              and _kind(f.dataType) != "complex"]

    def shown(f):
        v = _as_text(F.col(f"`{f.name}`"), f.dataType)
        if digest_over is None:
            return v
        return F.when(F.length(v) > digest_over, F.concat(F.lit("md5:"), F.md5(v))).otherwise(v)
    pairs = F.array(*[F.struct(F.lit(f.name).alias("column_name"), shown(f).alias("value")) for f in fields])
    x = df.select(F.explode(pairs).alias("p")).select("p.*")
    counts = x.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("frequency"))
    w = Window.partitionBy("column_name").orderBy(F.col("frequency").desc(), F.col("value").asc_nulls_first())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def value_profile(df: DataFrame, k: int = 5) -> DataFrame:
    """G-01 with value distributions: the default profile and, for columns that are not floating-point
    numbers (whose distribution the quantiles give), the k most frequent values."""
    floats = ("float", "double")
    names = [f.name for f in df.schema.fields if f.dataType.simpleString() not in floats and _kind(f.dataType) != "complex"]
    one = F.array_sort(F.collect_list(F.struct("rank", "value", "frequency")))         # k entries
    top = top_values(df, k, names, digest_over=64).groupBy("column_name").agg(
        F.transform(one, lambda x: F.struct(x["value"].alias("value"), x["frequency"].alias("frequency"))).alias("top_values"))
    return profile(df).join(top, "column_name", "left")
