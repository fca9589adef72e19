"""Quality rules on a stream: totals, quarantine, replayed and empty batches."""

import tempfile

from pyspark.sql import functions as F

from storelens.operators import governance as gov
from storelens.plans import fixtures as fx
from storelens.sources.tables import Tables
from storelens.streaming import quality as checked
from tests.conftest import SF001


def test_totals_and_rows_with_a_replayed_and_an_empty_batch(spark):
    ledger = fx.pos_tx(Tables(spark, SF001))
    path = tempfile.mkdtemp(prefix="storelens-quality-")
    sink, parts = checked.quality_sink(path), 3
    for k in range(parts):
        part = ledger.where(F.pmod(F.hash("tx_no"), F.lit(parts)) == k)
        sink(part, k)
        if k == 1:
            sink(part, k)                                     # replayed
    sink(ledger.where("false"), parts)
    whole = gov.quality_scan(ledger).collect()
    assert sorted(checked.quality_totals(spark, path).collect()) == sorted(whole) and any(r.failed for r in whole)
    bad, good = checked.quality_rows(spark, path, True), checked.quality_rows(spark, path, False)
    want = gov.failing_rows(ledger)
    assert bad.count() == want.count() and bad.count() + good.count() == ledger.count()
    assert bad.select(want.columns).exceptAll(want).isEmpty()
    assert set(good.columns) == set(ledger.columns)
