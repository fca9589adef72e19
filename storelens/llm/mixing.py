"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in an order shuffled by a digest of
the id, gone through ``passes`` times at most. A document finishes at a
virtual time: the words of its source up to and with it, divided by the
source's target. Sorted by that time all sources advance together, and
at time 1 the budget is spent, each source at its target; the mix ends there.

Targets: sources in order of code points (null last) weigh as ``weights``
says, repeating, and share ``share`` times all words; none gets more than ``passes`` times
its words, the excess goes to the others by weight.

DataFrame functions only. The running totals take two levels (totals
of digest ranges, then rows inside a range), so that no task holds a source.

Defined cases: a null text has no words; documents without words are
taken 0 words; a source without words has target 0; repeated rows are
documents of their own; a null id is shuffled as an empty string. Other
columns pass through unread.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import held, tasks, whole_row

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2


def words(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(id_col: str) -> Column:
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   passes: int = PASSES) -> DataFrame:
    """(source, size) rows -> one row per source: _source, _rank, source_size, target."""
    per = sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())      # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    per = (per.withColumn("_rank", F.row_number().over(by_name)).withColumn("_w", weight)
           .withColumn("_cap", F.col("source_size") * passes))
    by_fill = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) * F.lit(share)
              - F.coalesce(F.sum("_cap").over(before), F.lit(0)).cast("double"))
             / F.sum("_w").over(after))
    per = (per.withColumn("_level", level).withColumn("_place", F.row_number().over(by_fill))
           .withColumn("_open", F.col("_cap") > F.col("_w") * F.col("_level")))
    first = F.min(F.when(F.col("_open"), F.col("_place"))).over(every)
    water = F.min(F.when(F.col("_place") == F.col("_first"), F.col("_level"))).over(every)
    per = per.withColumn("_first", first).withColumn("_water", water)
    target = F.when(F.col("_first").isNull() | (F.col("_place") < F.col("_first")),
                    F.col("_cap").cast("double")).otherwise(F.col("_w") * F.col("_water"))
    return per.select("_source", "_rank", "source_size", target.alias("target"))


def queued(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """One row per document: _id, _key, _text (digest of the text), size, source_size, target,
    and _before, the words of its source ahead of it in a pass."""
    sized = held(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
                             shuffle_key(id_col).alias("_key"), F.xxhash64(text_col).alias("_text"),
                             words(text_col).alias("size")), "sized")
    sources = held(source_targets(sized, weights, share, passes), "sources").alias("s")
    digits = max(2, math.ceil(math.log(max(sized.count(), 1) / 100_000, 16)))
    ranged = (sized.alias("d").join(sources, F.col("d._source").eqNullSafe(F.col("s._source")))
              .select("_id", "_key", "_text", "size", "_rank", "source_size", "target")
              .withColumn("_range", F.substring("_key", 1, digits)))
    totals = ranged.groupBy("_rank", "_range").agg(F.sum("size").alias("_sum"))
    up_to = Window.partitionBy("_rank").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = held(totals.select("_rank", "_range", F.coalesce(F.sum("_sum").over(up_to), F.lit(0)).alias("_start")), "range-starts")
    inside = (Window.partitionBy("_rank", "_range").orderBy("_key", "size", "_text")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (ranged.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(start, ["_rank", "_range"])
            .withColumn("_before", F.col("_start") + F.col("_inside")))


def _taken(k: int) -> Column:
    """Words taken of a document in pass ``k``: those served before virtual time 1."""
    left = F.floor("target") - (F.col("_before") + F.col("source_size") * k)
    return F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long")


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words, repeats
    counted), finish (virtual time of its first pass; null without a target)."""
    q = queued(docs, id_col, text_col, source_col, weights, share, passes)
    taken = sum((_taken(k) for k in range(passes)), F.lit(0))
    return q.select(F.col("_id").alias(id_col), "size", "source_size", "target", taken.cast("long").alias("taken"),
                    F.try_divide((F.col("_before") + F.col("size")).cast("double"), F.col("target")).alias("finish"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """The mixed documents in order of virtual finish time, all columns of ``docs``
    unchanged: a document stands there once for each pass that takes it. The
    one document of a source at which the mix ends is whole, if at least half of it is taken."""
    q = queued(docs, id_col, text_col, source_col, weights, share, passes)
    finish = F.try_divide((F.col("_before") + F.col("size") + F.col("_k") * F.col("source_size")).cast("double"),
                          F.col("target"))
    takes = F.filter(F.array(*[F.when((_taken(k) > 0) & (_taken(k) * 2 >= F.col("size")), F.lit(k))
                               for k in range(passes)]), lambda k: k.isNotNull())
    # rows alike in id, source, text are one row here, with how often it is taken in each place
    served = (q.withColumn("_ks", takes).where(F.size("_ks") > 0)
              .withColumn("_twin", F.row_number().over(
                  Window.partitionBy("_rank", "_range", "_key", "_text").orderBy("_before"))))
    served = served.select("_id", "_text", "_rank", "_twin", "_before", "size", "source_size", "target",
                           F.explode("_ks").alias("_k"))
    served = held(served.select("_id", "_text", "_twin", F.col("_rank").alias("_src"), finish.alias("_finish")), "served")
    own = docs.select(F.col(id_col).alias("own_id"), F.xxhash64(text_col).alias("own_text"), whole_row(docs))
    match = (own["own_text"] == served["_text"]) & own["own_id"].eqNullSafe(served["_id"])
    if not served.where("_twin > 1").isEmpty():      # repeated rows: number them as above
        order = Window.partitionBy("own_text", "own_id").orderBy(F.xxhash64(F.to_json("row")))      # maps cannot be hashed
        own = own.withColumn("own_twin", F.row_number().over(order))
        match = ((own["own_text"] == served["_text"]) & own["own_id"].eqNullSafe(served["_id"])
                 & (own["own_twin"] == served["_twin"]))
    out = own.join(served.hint("shuffle_hash"), match).select("row", "_finish")
    return (out.repartitionByRange(tasks(docs.sparkSession), "_finish").sortWithinPartitions("_finish").select("row.*"))


#: The same rows by DuckDB; the queue order is that of md5 digests in both.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rnk FROM src),
capped AS (
  SELECT *, CASE (rnk - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
         source_size * 2 AS cap FROM weighed),
leveled AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, rnk) AS place,
    (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / w, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(w) OVER (ORDER BY cap / w, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM capped),
firsts AS (
  SELECT *, min(CASE WHEN cap > w * lvl THEN place END) OVER () AS first_open FROM leveled),
targets AS (
  SELECT source, source_size, CASE WHEN first_open IS NULL OR place < first_open THEN cap::DOUBLE
    ELSE w * min(CASE WHEN place = first_open THEN lvl END) OVER () END AS target FROM firsts),
queued AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, floor(target)::BIGINT - before))
   + greatest(0, least(size, floor(target)::BIGINT - before - source_size)))::BIGINT AS taken
FROM queued
"""
