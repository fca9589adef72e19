"""S-06: key-clustered tables, prefixes as key ranges."""

import glob

import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storelens.operators.access import read_prefix
from storelens.sources.key_table import as_cells, next_prefix, read_key_prefix, starts_with, write_key_table

KEYS = ["", "a", "a#", "a#1", "a#10", "a#2", "aé", "a\U0001f600", "b_1", "b%1", "bx1", "b", "\x7f", "￿"]


@given(st.binary(max_size=4), st.binary(max_size=5))
def test_range_is_the_prefix(prefix, key):
    end = next_prefix(prefix)
    assert key.startswith(prefix) == (key >= prefix and (end is None or key < end))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keys") / "t")
    rows = [(k, i, None if i % 2 else f"n{i}") for i, k in enumerate(KEYS)] + [(None, 99, "lost")]
    write_key_table(as_cells(spark.createDataFrame(rows, "k string, n int, tag string"), F.col("k"), {"f": ["n", "tag"], "g": ["tag"]}), path)
    return path


@pytest.mark.parametrize("prefix", ["", "a", "a#", "a#1", "b_", "b%", "a\U0001f600", "zz", "￿"])
def test_prefix_reads(spark, table, prefix):
    want = sorted((k for k in KEYS if k.startswith(prefix)), key=str.encode)
    assert [r["row_key"] for r in read_key_prefix(spark, table, prefix, None).collect()] == want
    assert [r["row_key"] for r in read_key_prefix(spark, table, prefix, 2).collect()] == want[:2]
    assert [r["row_key"] for r in read_prefix(spark.read.parquet(table), prefix, 3).collect()] == want[:3]


def test_null_cells_are_absent(spark, table):
    rows = {r["row_key"]: r for r in read_key_prefix(spark, table, "", None).collect()}
    assert len(rows) == len(KEYS)
    assert rows["a"]["f"] == {"n": "1"} and rows["a"]["g"] == {}
    assert rows["a#"]["f"] == {"n": "2", "tag": "n2"}


def test_range_reaches_the_reader_and_files_do_not_overlap(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).select(F.encode(F.format_string("STORE_%03d#%05d", F.col("id") % 10, "id"), "UTF-8").alias("row_key"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_key_table(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = spark.read.parquet(path).where(starts_with("row_key", b"STORE_004#"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key" in plan and "LessThan(row_key" in plan
    spans = []
    for f in glob.glob(path + "/*.parquet"):
        s = pq.ParquetFile(f).metadata
        spans += [(s.row_group(i).column(0).statistics.min, s.row_group(i).column(0).statistics.max) for i in range(s.num_row_groups)]
    spans.sort()
    assert len(spans) > 2 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert sum(lo < b"STORE_004$" and hi >= b"STORE_004#" for lo, hi in spans) < len(spans)
    assert read_key_prefix(spark, path, "STORE_004#", None).count() == 2_000


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_key_table(as_cells(spark.createDataFrame([], "k string, v int"), F.col("k"), {"f": ["v"]}), path)
    assert read_key_prefix(spark, path, "a").collect() == []
