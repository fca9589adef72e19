"""Quality rules on a stream (G-04): counted, and bad rows set aside, in the pass that writes the batch.

A micro-batch is written once, split into the folders of good and of quarantined
rows. The counts of its rules are observed metrics of that same write (no second scan) and are then written
as one row. Both go to places named by the batch, so a replayed batch overwrites
its own rows and counts and totals are never counted twice. If a batch fails between the two
writes it is replayed as a whole.

Defined cases: a condition that evaluates to null fails; a batch without rows counts 0; before any
batch there is nothing to read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storelens.operators import governance as gov


def _counts(rules) -> str:
    return ", ".join(["_n long", *(f"_p{i} long" for i in range(len(rules)))])


def quality_sink(path: str, rules=gov.POS_TX_RULES):
    """``foreachBatch`` function: rows to ``{path}/rows`` with the names of the rules they fail, counts to ``{path}/counts``."""
    def run(df: DataFrame, batch_id: int) -> None:
        seen = Observation(f"quality-{batch_id}")
        rows = df.observe(seen, F.count(F.lit(1)).alias("_n"),
                          *(F.count_if(gov.passes(r)).alias(f"_p{i}") for i, r in enumerate(rules)))
        failed = F.array_compact(F.array(*(F.when(~gov.passes(r), F.lit(r.name)) for r in rules)))
        rows = rows.withColumn("failed_rules", failed).withColumn("quarantined", F.size("failed_rules") > 0)
        rows.write.mode("overwrite").partitionBy("quarantined").parquet(f"{path}/rows/batch={batch_id}")
        got = seen.get
        one = df.sparkSession.createDataFrame([tuple(got[c] for c in ["_n", *(f"_p{i}" for i in range(len(rules)))])], _counts(rules))
        one.write.mode("overwrite").parquet(f"{path}/counts/batch={batch_id}")
    return run


def quality_totals(spark: SparkSession, path: str, rules=gov.POS_TX_RULES) -> DataFrame:
    """The rules' verdicts over all batches so far, as ``quality_scan`` gives them: reads one row per batch."""
    counts = spark.read.schema(_counts(rules)).parquet(f"{path}/counts")
    names = ["_n", *(f"_p{i}" for i in range(len(rules)))]
    return gov.judged(counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names)), rules)


def quality_rows(spark: SparkSession, path: str, quarantined: bool) -> DataFrame:
    """Good rows, or those set aside with ``failed_rules``; the other folder is not read."""
    rows = spark.read.parquet(f"{path}/rows").where(F.col("quarantined") == quarantined).drop("quarantined", "batch")
    return rows if quarantined else rows.drop("failed_rules")
