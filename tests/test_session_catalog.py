"""Contract values, comments and row counts through the session's catalogue."""

import tempfile
import uuid

from storelens.operators import session_catalog as sc


def test_round_trip_quotes_statistics_and_bare_tables(spark):
    base, db = tempfile.mkdtemp(prefix="storelens-cat-"), f"cat_{uuid.uuid4().hex[:8]}"
    spark.range(7).selectExpr("id", "array(named_struct('x', id)) AS nested").write.parquet(f"{base}/a")
    spark.range(0).write.parquet(f"{base}/b")
    contract = {"table_type": "BATCH_TABLE", "pii_included": False, "data_owner_team": "o'neil \\ team"}
    sc.register(spark, db, "a", f"{base}/a", "a 'quoted' table", contract)
    sc.register(spark, db, "b", f"{base}/b")
    rows = {(r.table_name, r.column_name): r for r in sc.session_snapshot(spark, db).collect()}
    r = rows["a", "nested"]
    assert (r.row_count, r.ordinal, r.data_type, r.description) == (7, 1, "array<struct<x:bigint>>", "a 'quoted' table")
    assert (r.table_type, r.pii_included, r.data_owner_team) == ("BATCH_TABLE", False, "o'neil \\ team")
    b = rows["b", "id"]
    assert (b.row_count, b.description, b.table_type, b.pii_included) == (0, None, None, None)
    spark.range(5).write.mode("append").parquet(f"{base}/a")
    spark.catalog.refreshTable(f"`{db}`.`a`")
    assert {x.row_count for x in sc.session_snapshot(spark, db).where("table_name = 'a'").collect()} == {7}   # until refreshed
    sc.refresh(spark, db, "a")
    assert {x.row_count for x in sc.session_snapshot(spark, db).where("table_name = 'a'").collect()} == {12}
