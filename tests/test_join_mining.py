"""J-09: sketches leave out pairs only where the exact count would too."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

from storelens.operators.join_mining import column_sketches, estimated_containment, exact_overlaps, join_candidates


@pytest.fixture(scope="module")
def columns(spark):
    """Columns of 3 to 30,000 values that overlap by 0 to 100 %."""
    big = spark.range(30_000).select(F.col("id").alias("all_ids"), (F.col("id") * 2).alias("even"),
                                     F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    part = spark.range(9_000).select((F.col("id") * 3).alias("thirds"), (F.col("id") + 25_000).alias("late"),
                                     F.when(F.col("id") < 3_000, F.lit("")).otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("name"))
    few = spark.createDataFrame([(1, "n1", 2), (2, "", 1), (None, None, 4), (29_999, "n3", 1), (1, "n1", 2)], "k int, tag string, near int")
    return {"big": big, "part": part, "few": few}


def _brute(tables):
    sets = {(t, f.name): ({r[0] for r in df.select(f.name).collect()} - {None}, f.dataType.simpleString() == "string")
            for t, df in tables.items() for f in df.schema.fields}
    return {(*a, *b): (len(sets[a][0]), len(sets[a][0] & sets[b][0])) for a, b in permutations(sets, 2)
            if sets[a][1] == sets[b][1] and sets[a][0]}


@pytest.mark.parametrize("least", [0.05, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("log2_entries, probe_above", [(6, 10 ** 7), (12, 0)])
def test_same_pairs_as_brute_force(columns, least, log2_entries, probe_above):
    got = {tuple(r)[:4]: tuple(r)[4:6] for r in join_candidates(columns, least, log2_entries, probe_above).collect()}
    want = {p: (n, o) for p, (n, o) in _brute(columns).items() if o and int(o * 10_000 / n + 0.5) >= least * 10_000}
    assert got == want


def test_estimates_lie_within_their_margin(columns):
    exact = _brute(columns)
    rows = estimated_containment(column_sketches(columns, 10), 10).collect()
    assert len(rows) == len(exact)
    for r in rows:
        n, o = exact[tuple(r)[:4]]
        assert abs(r["estimate"] - o / n) <= r["margin"] + 1e-9
    assert any(0 < r["margin"] < 0.2 for r in rows) and any(r["margin"] == 0 for r in rows)


def test_far_pairs_are_left_out_before_the_exact_pass(columns):
    rows = estimated_containment(column_sketches(columns)).collect()
    kept = [r for r in rows if r["estimate"] + r["margin"] >= 0.9]
    assert len(kept) < len(rows) / 2


def test_many_columns_fill_several_words(spark):
    wide = spark.range(40).select(*[(F.col("id") + i).cast("int").alias(f"c{i}") for i in range(70)])
    pairs = [("w", "c0", "w", "c69"), ("w", "c61", "w", "c62"), ("w", "c62", "w", "c65"), ("w", "c69", "w", "c0")]
    got = {tuple(r)[:4]: tuple(r)[4:] for r in exact_overlaps({"w": wide}, pairs).collect()}
    assert got == {pairs[1]: (40, 39), pairs[2]: (40, 37)}


def test_nothing_to_join(spark):
    empty = spark.createDataFrame([], "k int, v string")
    assert join_candidates({"a": empty, "b": spark.range(3)}).count() == 0
    assert join_candidates({"a": spark.createDataFrame([(1.5,)], "x double")}).count() == 0
    odd = spark.createDataFrame([(1, 1)], "`a.b` int, `c``d` int")
    assert {r["left_column"] for r in join_candidates({"o": odd}).collect()} == {"a.b", "c`d"}
