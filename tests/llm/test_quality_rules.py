"""Quality rules: statistics against a plain version, held-out labels, compiled rules, defined cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF01

pytest.importorskip("storelens.llm")
from storelens.llm import common, quality_rules as qr, queries  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402


def _plain(text):
    text = text or ""
    kind = {b: k for k, bs in qr.KINDS.items() for b in bs}
    c = Counter(kind.get(b) for b in text.encode())
    words = [w for w in text.translate({i: " " for i in b"\t\n\x0b\x0c\r"}).split(" ") if w]
    lines = [x for x in text.split("\n") if x]
    share = lambda x, n: x / n if n else 0.0
    solid = len(text) - c["space"] - c["feed"]
    top = Counter(words).most_common(1)
    return [math.log1p(len(text)), math.log1p(len(words)), math.log1p(len(lines)), share(solid, len(words)), share(len(words), len(lines)),
            share(c["upper"], c["upper"] + c["lower"] + c["wide"]), *(share(c[k], solid) for k in ("digit", "stop", "exclaim", "comma", "bar", "symbol")),
            share(sum(kind.get(w.encode()[-1]) in ("symbol", "bar", "exclaim") for w in words), len(words)),
            share(len(set(words)), len(words)), share(top[0][1] if top else 0, len(words)),
            share(sum(a == b for a, b in zip(words, words[1:])), len(words)), share(len(set(lines)), len(lines)),
            share(sum(x[-1] in ".?!" for x in lines), len(lines))]


def test_statistics_against_plain_version(monkeypatch):
    rnd = random.Random(9)
    some = ["a", "a", "Bé", "x###", "|", "!!", "ok.", "12", "\n", "\n\n", "\t", "ß日", "$$$", "", "end?\n"]
    batches = [[None, "", "\n", " ", "one", "one\n", ". .\n."]]
    batches += [[rnd.choice([" ", ""]).join(rnd.choice(some) for _ in range(rnd.choice([0, 3, 30]))) for _ in range(rnd.randint(1, 6))]
                for _ in range(150)]
    for size in (common.SEGMENT, 64):
        monkeypatch.setattr(common, "SEGMENT", size)
        for texts in batches:
            if size == 64 and any(len(w.encode()) > 60 for t in texts for w in (t or "").split("\n")):
                continue                                 # longer lines and words than a piece are hashed in parts
            got = qr.statistics(pa.array(texts, pa.string()))
            np.testing.assert_allclose(got, [_plain(t) for t in texts], rtol=1e-12)


def _hash(i):
    return zlib.crc32(str(i).encode()) % 3


def test_held_out_labels(spark):
    got = {r.doc_id: r for r in queries.op12_quality_classifier(spark, SF01).collect()}
    docs = {r.doc_id for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id").collect()}
    assert set(got) == docs
    assert all(r.held_out == (_hash(d) == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for d, r in got.items())
    truth = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{SF01}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert len(truth) > 80 and sum(r.predicted == q for r, q in truth) / len(truth) >= 0.97
    good, bad = ([r.score for r, q in truth if q == v] for v in (1, 0))
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) >= 0.97


def test_held_out_labels_are_never_read(spark):
    """The other rows' scores do not change when the held-out labels are turned round."""
    prepare(spark)
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    apart = F.crc32(F.col("id").cast("string")) % 3 == 1
    flip = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("quality", F.when(flip, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, rules_a = qr.score_quality(docs.select("doc_id", "text"), labels, ~apart)
    b, rules_b = qr.score_quality(docs.select("doc_id", "text"), turned, ~apart)
    assert rules_a == rules_b and sorted(a.collect()) == sorted(b.collect())
    # the compiled expression gives what the rules say
    stats = {r["row"]["doc_id"]: r for r in qr.with_statistics(docs.select("doc_id", "text")).collect()}
    for r in a.collect():
        odds = rules_a.base + sum(w for w, rule in rules_a.weights
                                  if all((stats[r.doc_id][s] > x) == above for s, above, x in rule.conditions))
        assert r.quality_score == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-9)
    assert rules_a.weights and all(rule.conditions for _, rule in rules_a.weights)


def test_cases(spark):
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("row", T.StringType()), T.StructField("upper", T.MapType(T.StringType(), T.LongType())),
                           T.StructField("quality_score", T.StringType())])
    good, bad = "This is a fine sentence of words.", "||| ### ||| ###"
    rows = [(i, f"{good} number {i}." if i % 2 else f"{bad} {i}") for i in range(60)] + [(None, good), (100, None), (101, ""), (102, "word " * 300_000)]
    rows += [(7, f"{good} number 7.")] * 200                 # a hot copy
    make = lambda rs: spark.createDataFrame([(a, b, "r", {"k": 1}, "q") for a, b in rs], schema)
    labels = [(i, i % 2) for i in range(60)] + [(7, 1), (None, 0), (8, None), (200, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    out, rules = qr.score_quality(make(rows), lab, F.lit(True))
    assert out.columns == ["doc_id", "row", "upper", "quality_score"] and rules.weights
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.quality_score <= 1 for r in got)
    assert all((r.quality_score >= 0.5) == bool(r.doc_id % 2) for r in got if r.doc_id is not None and r.doc_id < 60)
    assert qr.score_quality(make([]), lab, F.lit(True))[0].count() == 0
    for only, want in ((0, 0.0), (1, 1.0), (None, 0.5)):
        scored, rules = qr.score_quality(make(rows[:9]), lab.where(F.lit(False) if only is None else F.col("quality") == only), F.lit(True))
        assert not rules.weights and all(r.quality_score == pytest.approx(want, abs=1e-12) for r in scored.collect())


def test_sample_is_of_distinct_rows_in_proportion(spark):
    prepare(spark)
    rows = [(1.0, *[float(i % 300)] * len(qr.STATS)) for i in range(3000)] + [(0.0, *[float(i)] * len(qr.STATS)) for i in range(100)]
    df = spark.createDataFrame(rows, ["label", *qr.STATS])
    got = qr.sampled(df, 40).collect()
    assert Counter(r.label for r in got) == {1.0: 30, 0.0: 10}
    assert sorted(qr.sampled(df, 40).collect()) == sorted(got)
