"""Secret scans: candidates by brute force, planted secrets, defined cases."""

import random
import re

import pytest
from pyspark.sql import types as T

from tests.conftest import SF01

pytest.importorskip("storelens.llm")
from storelens.llm import queries, secret_scan  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402


def _plain(text):
    out = []
    for i, w in enumerate(re.split(r"[\x20\x09-\x0D]+", text or "")):
        out += [(i, v) for v in re.findall(secret_scan.VALUE, w)]
    return out


def test_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    want = sorted((r.doc_id, *x) for r in docs.collect() for x in _plain(r.text))
    got = secret_scan.scan((prepare(spark), docs)[1]).collect()
    assert sorted((r.doc_id, r.word_no, r.value) for r in got) == want and len(want) > 100
    for r in got:                                          # the corpus's secrets are 40 hexadecimal digits
        assert r.is_secret == bool(re.fullmatch(r"[0-9a-fA-F]{40}", r.value)), r
    rows = queries.op6_secret_scan(spark, SF01)
    assert rows.columns == ["doc_id", "word_no", "length", "value_sha256", "probability", "is_secret"]
    assert sorted(map(str, rows.collect())) == sorted(map(str, queries.op6_secret_scan(spark, SF01).collect()))


def _docs(spark, rows):
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("value", T.StringType()), T.StructField("features", T.StringType()),
                           T.StructField("words", T.LongType())])
    return spark.createDataFrame([(*r, "v", "f", 1) for r in rows], schema)


def test_unlabelled_secret_is_told_from_long_words(spark):
    rnd = random.Random(5)
    key = lambda: "".join(rnd.choice("abcdef0123456789") for _ in range(40))
    word = lambda n: "".join(rnd.choice(["ta", "re", "lo", "mi", "ne", "su"]) for _ in range(n))
    rows = [(i, " ".join(word(rnd.randint(1, 4)) for _ in range(60)) + f" {word(9)} and token = \"{key()}\" then http://site.example/{word(9)}")
            for i in range(80)]
    bare, long = key(), word(10)
    rows += [(900, f"see {bare} there"), (901, f"see {long} there"), (902, None), (903, ""), (None, f"password: {key()}"),
             (904, f"password: {bare}"), (904, f"password: {bare}"), (905, "x " * 100_000 + f"secret={key()}")]
    got = secret_scan.scan(_docs(spark, rows)).collect()
    flags = {}
    for r in got:
        flags.setdefault(r.doc_id, []).append(r.is_secret)
    assert flags[900] == [True] and flags[901] == [False] and flags[None] == [True] and flags[905] == [True]
    assert flags[904] == [True, True] and 902 not in flags and 903 not in flags
    assert secret_scan.scan(_docs(spark, rows).limit(0)).count() == 0
    only = secret_scan.scan(_docs(spark, [(1, "a plainverylongwordhere")])).collect()
    assert [r.is_secret for r in only] == [False]


def test_copies_do_not_push_values_out_of_training(spark, monkeypatch):
    prepare(spark)
    kept = []
    monkeypatch.setattr(secret_scan, "held", lambda df, name: kept.append(df.collect()) or df)
    row = lambda value, label, x: (value, label, *[float(x)] * len(secret_scan.FEATURES))
    rows = [row(f"secret{i}", 1, i % 7) for i in range(20)] + [row("hot", 1, 3)] * 20_000
    rows += [row(f"word{i}", 0, 9 + i % 5) for i in range(20)] + [row("hot word", 0, 9)] * 20_000
    schema = "value string, label int, " + ", ".join(f"{c} double" for c in secret_scan.FEATURES)
    model = secret_scan.train(spark.createDataFrame(rows, schema), sample=100)
    assert not isinstance(model, float)
    assert len({r.value for r in kept[0] if r.label == 1}) == len({r.value for r in kept[0] if r.label == 0}) == 21
    secret_scan.train(spark.createDataFrame(rows, schema), sample=1)
    assert {r.label for r in kept[1]} == {0, 1}
