"""Join-candidate mining over the distinct values of columns (J-09).

Two passes. The first reads every column once into a theta sketch: one
global aggregation per table, so only sketches leave the tasks. Estimated
containments of all column pairs follow from the sketches alone, and a
pair is left out where even the estimate plus its margin stays below the
wanted containment. The second pass counts the exact overlap of the pairs
that remain: only the values of their columns are shuffled, once.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions import metrics as M
from storelens.operators.sizing import broadcast_if_small

LONG_VALUE = 64        # longer strings are compared by digest
SKETCH_LOG2 = 12       # 2^12 hashes a sketch
MISS = 1e-9            # chance that a sketch leaves out a pair it should keep
PROBE_ABOVE = 10_000_000    # distinct values of large columns from which they are filtered before the shuffle
_WORD = 62             # column marks a 64-bit word holds


def _family(f: T.StructField) -> str | None:
    if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType)):
        return "int"
    if isinstance(f.dataType, T.StringType):
        return "str"
    return None


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def column_sketches(tables: dict[str, DataFrame], log2_entries: int = SKETCH_LOG2) -> DataFrame:
    """(table_name, column_name, family, sketch): one theta sketch of the distinct values of each integer
    and string column. Nulls are left out; the empty string is a value. Sketches of parts of a table
    combine with ``theta_union_agg``."""
    out = None
    for tname, df in tables.items():
        fields = [(f.name, _family(f)) for f in df.schema.fields if _family(f)]
        if not fields:
            continue

        def value(n: str, family: str) -> Column:
            # a sketch ignores empty strings, hence the mark before the value
            return _column(n).cast("long") if family == "int" else F.concat(F.lit("v"), _column(n))
        one = df.agg(*[F.theta_sketch_agg(value(n, fam), log2_entries).alias(f"s{i}") for i, (n, fam) in enumerate(fields)])
        rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(fam).alias("family"), F.col(f"s{i}").alias("sketch"))
                         for i, (n, fam) in enumerate(fields)])
        x = one.select(F.lit(tname).alias("table_name"), F.explode(rows).alias("p")).select("table_name", "p.*")
        out = x if out is None else out.unionByName(x)
    return out


def estimated_containment(sketches: DataFrame, log2_entries: int = SKETCH_LOG2) -> DataFrame:
    """(left_table, left_column, right_table, right_column, left_values, right_values, estimate, margin) for
    all pairs of columns of one family, the values being estimated distinct numbers; as many rows as the schema has pairs, whatever the tables hold.

    Both sketches sample the left column's values by one hash, so the estimate is a mean over a sample of
    ``hits`` values and its margin Hoeffding's, ``sqrt(ln(1 / MISS) / (2 * hits))``: 0 while both
    columns fit their sketches, 1 where the sample is empty (a few values beside very many)."""
    size = float(1 << log2_entries)
    a = sketches.select(F.col("table_name").alias("left_table"), F.col("column_name").alias("left_column"), "family",
                        F.col("sketch").alias("ls"))
    b = sketches.select(F.col("table_name").alias("right_table"), F.col("column_name").alias("right_column"), "family",
                        F.col("sketch").alias("rs"))
    other = (F.col("left_table") != F.col("right_table")) | (F.col("left_column") != F.col("right_column"))
    both = a.join(b, "family").where(other).select(
        "left_table", "left_column", "right_table", "right_column", F.theta_sketch_estimate("ls").cast("double").alias("nl"),
        F.theta_sketch_estimate("rs").cast("double").alias("nr"),
        F.theta_sketch_estimate(F.theta_intersection("ls", "rs")).cast("double").alias("ni"))
    larger = F.greatest("nl", "nr")
    hits = F.greatest(F.floor(F.lit(0.9 * size) * F.col("nl") / larger), F.lit(0)).cast("double")
    margin = F.when(larger <= size, F.lit(0.0)).when(hits < 1, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.sqrt(F.lit(math.log(1 / MISS) / 2) / F.greatest(hits, F.lit(1.0)))))
    return both.where("nl > 0 AND nr > 0").select(
        "left_table", "left_column", "right_table", "right_column", F.col("nl").alias("left_values"), F.col("nr").alias("right_values"),
        F.least(F.lit(1.0), F.col("ni") / F.col("nl")).alias("estimate"), margin.alias("margin"))


def _values(tables: dict[str, DataFrame], ids: dict[tuple[str, str], int], wanted: set[tuple[str, str]]) -> DataFrame | None:
    """(fam, v, i): the values of the wanted columns, row by row."""
    def value(n: str) -> Column:
        v = _column(n).cast("string")
        return F.when(F.length(v) > LONG_VALUE, F.concat(F.lit("md5:"), F.md5(v))).otherwise(v)
    parts = None
    for tname, df in tables.items():
        rows = [F.struct(F.lit(_family(f)).alias("fam"), value(f.name).alias("v"), F.lit(ids[tname, f.name]).alias("i"))
                for f in df.schema.fields if (tname, f.name) in wanted]
        if rows:
            x = df.select(F.explode(F.array(*rows)).alias("p")).select("p.*").where(F.col("v").isNotNull())
            parts = x if parts is None else parts.unionByName(x)
    return parts


def _marks(rows: DataFrame, n_columns: int) -> DataFrame:
    """(fam, v, w0, w1, ...): each distinct value once, with a bit for every column that holds it. Marks of
    fixed size combine map-side: a value of a third of the rows is one partial row per task."""
    bit = F.expr(f"shiftleft(1L, i % {_WORD})")
    return rows.groupBy("fam", "v").agg(
        *[F.bit_or(F.when(F.floor(F.col("i") / _WORD) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{w}")
          for w in range((n_columns - 1) // _WORD + 1)])


def exact_overlaps(tables: dict[str, DataFrame], pairs: list[tuple[str, str, str, str]],
                   few: set[tuple[str, str]] = frozenset()) -> DataFrame:
    """(left_table, left_column, right_table, right_column, left_distinct, overlap) of the given pairs that
    share a value. One shuffle of the distinct values of the columns named; the fan-out of a value is
    bounded by the number of pairs, never by rows. ``few`` names columns of few values: a column that
    is asked for beside such columns only sends the values that they hold (their set is broadcast if
    its measured size allows, else joined)."""
    columns = sorted({p[:2] for p in pairs} | {p[2:] for p in pairs})
    ids = {c: i for i, c in enumerate(columns)}
    rights: dict[str, list[int]] = {}
    for p in pairs:
        rights.setdefault(str(ids[p[:2]]), [ids[p[:2]]]).append(ids[p[2:]])          # with itself: its own size
    whole = {p[:2] for p in pairs} | {p[2:] for p in pairs if p[:2] not in few}
    rows, probed = _values(tables, ids, whole), _values(tables, ids, set(columns) - whole)
    if probed is not None:
        asked = _values(tables, ids, {p[:2] for p in pairs if p[:2] in few}).select("fam", "v").distinct()
        rows = rows.unionByName(probed.join(broadcast_if_small(asked, max_rows=1_000_000), ["fam", "v"], "left_semi"))
    marks = _marks(rows, len(columns))
    words = F.array(*[F.col(c) for c in marks.columns if c.startswith("w")])
    held = F.filter(F.sequence(F.lit(0), F.lit(len(columns) - 1)),
                    lambda i: F.getbit(F.element_at(words, F.floor(i / _WORD).cast("int") + 1), (i % _WORD).cast("int")) == 1)
    partners = F.from_json(F.lit(json.dumps(rights)), "map<string, array<int>>")
    met = (marks.select(held.alias("held")).select("held", F.explode("held").alias("l"))
           .select("l", F.explode(F.array_intersect(F.element_at(partners, F.col("l").cast("string")), "held")).alias("r")))
    counts = met.groupBy("l", "r").agg(F.count(F.lit(1)).alias("overlap"))            # as many rows as pairs
    sizes = counts.where("l = r").select(F.col("l").alias("of"), F.col("overlap").alias("left_distinct"))
    names = F.from_json(F.lit(json.dumps([{"t": t, "c": c} for t, c in columns])), "array<struct<t: string, c: string>>")
    out = counts.where("l <> r").join(sizes, F.col("l") == F.col("of"))
    left, right = F.element_at(names, F.col("l") + 1), F.element_at(names, F.col("r") + 1)
    return out.select(left["t"].alias("left_table"), left["c"].alias("left_column"), right["t"].alias("right_table"),
                      right["c"].alias("right_column"), "left_distinct", "overlap")


def join_candidates(tables: dict[str, DataFrame], min_containment: float = 0.9, log2_entries: int = SKETCH_LOG2,
                    probe_above: int = PROBE_ABOVE) -> DataFrame:
    """J-09: column pairs (A, B) of the same type family where at least ``min_containment`` of A's
    distinct values also occur in B, with exact counts.

    The sketches are built when the operator is called (one pass over the key-like columns); what
    the driver takes are the names of surviving pairs, whose number the schema bounds. Strings over
    ``LONG_VALUE`` characters travel as 128-bit digests in the exact pass, so whole texts
    count and yet no text is shuffled. Tables without rows or key-like columns give no pair."""
    schema = ("left_table string, left_column string, right_table string, right_column string, left_distinct long, "
              "overlap long, containment double")
    spark = next(iter(tables.values())).sparkSession
    sketches = column_sketches(tables, log2_entries)
    if sketches is None:
        return spark.createDataFrame([], schema)
    sketches = sketches.persist()
    # half a unit of the fourth place, as the exact ratio is rounded before it is compared
    reach = F.col("estimate") + F.col("margin") + F.lit(0.00005) >= F.lit(min_containment)
    near = [tuple(r) for r in estimated_containment(sketches, log2_entries).where(reach)
            .select("left_table", "left_column", "right_table", "right_column", "left_values", "right_values").collect()]
    sketches.unpersist()
    if not near:
        return spark.createDataFrame([], schema)
    few = {r[:2] for r in near if r[4] <= 1 << log2_entries}
    large = {r[2:4]: r[5] for r in near if r[5] > 1 << log2_entries}
    if sum(large.values()) <= probe_above:
        few = set()                               # another scan would cost more than it saves in the shuffle
    out = exact_overlaps(tables, [r[:4] for r in near], few).withColumn("containment", M.exact_ratio("overlap", "left_distinct", 4))
    return out.where(F.col("containment") >= F.lit(min_containment)).select(
        "left_table", "left_column", "right_table", "right_column", "left_distinct", "overlap", "containment")
