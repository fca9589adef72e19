"""G-01: profiles merged from the states of parts against profiles of the whole."""

import pytest
from pyspark.sql import functions as F

from storelens.operators.profile_states import merge_states, profile_states, read_states, write_states
from storelens.operators.profiling import profile

EXACT = ["data_type", "row_count", "null_count", "null_ratio", "min_value", "max_value", "min_number", "max_number", "mean"]


@pytest.fixture(scope="module")
def table(spark):
    """Nine days, the first with a third of the rows, 500 rows without a day."""
    i = F.col("id")
    return spark.range(12_000).select(
        F.when(i < 11_500, F.date_add(F.lit("2024-03-01").cast("date"), F.when(i % 3 == 0, 0).otherwise(i % 12).cast("int"))).alias("day"),
        i.alias("n"), F.when(i % 7 != 0, (i * 37 % 1000) / 4).alias("x"), (i % 100).cast("decimal(12,2)").alias("d"),
        F.when(i % 4 == 0, "").when(i % 4 == 1, "often").otherwise(F.concat(F.lit("v"), (i % 50).cast("string"))).alias("word"),
        F.repeat(F.lit("long"), 100).alias("text"), F.lit(None).cast("string").alias("none"), F.array(i).alias("a"),
        (i % 2 == 0).alias("flag"), F.when(i == 3, "x").alias("_part"))


@pytest.fixture(scope="module")
def path(table, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("states") / "s")
    part = F.col("day").cast("string")
    write_states(profile_states(table, part, "t"), p)
    write_states(profile_states(table.limit(10), part, "other"), p)
    write_states(profile_states(table.where("day = '2024-03-01'"), part, "t"), p)       # written again
    return p


def _rows(df, names):
    return {r["column_name"]: tuple(r[c] for c in names) for r in df.collect()}


def test_merged_equals_one_pass(spark, table, path):
    whole = _rows(profile(table, exact=True), [*EXACT, "distinct_count"])
    merged = _rows(merge_states(read_states(spark, path, "t")), [*EXACT, "distinct_count"])
    assert {c: r[:-1] for c, r in merged.items()} == {c: r[:-1] for c, r in whole.items()}
    for c, r in whole.items():
        if c != "a":
            assert abs(merged[c][-1] - r[-1]) <= 0.06 * r[-1], c


def test_a_range_of_days(spark, table, path):
    states = read_states(spark, path, "t", "2024-03-02", "2024-03-05")
    assert "PartitionFilters: [isnotnull" in states._jdf.queryExecution().executedPlan().toString()
    want = _rows(profile(table.where("day BETWEEN '2024-03-02' AND '2024-03-05'"), exact=True), EXACT)
    assert _rows(merge_states(states), EXACT) == want
    assert {r["part"] for r in states.select("part").distinct().collect()} == {"2024-03-02", "2024-03-03", "2024-03-05"}


def test_sketches(spark, table, path):
    rows = {r["column_name"]: r for r in merge_states(read_states(spark, path, "t"), (0.1, 0.5, 0.9), 2).collect()}
    for got, q in zip(rows["n"]["quantiles"], (0.1, 0.5, 0.9)):
        assert abs(got / 12_000 - q) < 0.03
    assert [tuple(v) for v in rows["word"]["top_values"]] == [("", 3000), ("often", 3000)] or \
        {tuple(v) for v in rows["word"]["top_values"]} == {("", 3000), ("often", 3000)}
    assert rows["text"]["top_values"][0][0].startswith("md5:") and rows["text"]["top_values"][0][1] == 12_000
    assert rows["none"]["top_values"] is None and rows["none"]["distinct_count"] == 0
    assert rows["a"]["distinct_count"] is None and rows["word"]["quantiles"] is None


def test_states_are_small_and_merge_in_any_grouping(spark, table, path):
    states = read_states(spark, path, "t")
    assert states.count() == 10 * len(table.columns)
    assert max(r[0] for r in states.select(F.length("distinct") + F.length("quantiles")).where("1 = 1").collect() if r[0]) < 40_000


def test_empty_table(spark, tmp_path):
    empty = profile_states(spark.createDataFrame([], "day date, v string"), F.col("day"), "e")
    assert merge_states(empty).count() == 0


def test_text_parts_keep_their_type(spark, tmp_path):
    p = str(tmp_path / "s")
    write_states(profile_states(spark.createDataFrame([(7, "01"), (8, "02")], "v int, p string"), F.col("p"), "t"), p)
    assert {r["part"] for r in read_states(spark, p, "t", "01", "01").collect()} == {"01"}
