"""Extra columns under any name, of any type, come through unchanged."""

import pytest
from pyspark.sql import functions as F

from storelens.llm import url_filter
from storelens.llm.line_dedup import line_dedup
from storelens.llm.mixing import mix
from storelens.llm.near_dedup import near_dedup
from storelens.llm.substring_dedup import substring_dedup

# names that the operators use inside, or used once
NAMES = ["_gone", "gone", "_dig", "dig", "_id", "id", "_own", "own_id", "own_dig", "own_text", "row", "_finish", "_own_text", "_twin",
         "_key", "_rank", "_range", "size", "target", "component", "n", "m", "first", "at", "start_byte"]
PROSE = " ".join(f"word{i * 7919 % 1009}" for i in range(120))


@pytest.fixture(scope="module")
def docs(spark):
    """Near copies, exact copies, repeated rows (equal in all columns, and in id and text alone), nulls."""
    texts = [PROSE, PROSE, PROSE + " end", "\n".join([PROSE, "other line"]), None, "", "short one"]
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], rows[0]]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, source string, k int")
    df = df.withColumn("k", F.when(F.col("k") == 8, 7).otherwise(F.col("k")))
    return df.select("doc_id", "text", "source", *[F.concat(F.lit(n + "-"), F.col("k").cast("string")).alias(n) for n in NAMES],
                     F.create_map(F.lit("k"), "k").alias("a_map"))


def _pieces(df):
    """Each row's extra columns, which name the input row they came from."""
    out = []
    for r in df.collect():
        k = r["a_map"]["k"]
        assert [r[n] for n in NAMES if n in df.columns] == [f"{n}-{k}" for n in NAMES if n in df.columns]
        out.append((k, r["doc_id"], r["text"]))
    return sorted(out, key=str)


def test_near_dedup(docs):
    out = near_dedup(docs)
    assert out.columns == docs.columns
    rows = _pieces(out)
    ids = [d for _, d, _ in rows]
    assert len(ids) == len(set(ids)) and {0, 6} <= set(ids)
    assert sum(t == PROSE for _, _, t in rows) == 1
    inputs = set(_pieces(docs))
    assert set(rows) <= inputs


def test_mix(docs):
    out = mix(docs)
    assert out.columns == docs.columns
    rows, inputs = _pieces(out), set(_pieces(docs))
    assert rows and set(rows) <= inputs
    plain = mix(docs.select("doc_id", "text", "source"))
    assert sorted((d, t) for _, d, t in rows) == sorted((r["doc_id"], r["text"]) for r in plain.collect())


def test_substring_dedup(docs):
    out = substring_dedup(docs)
    assert out.columns == docs.columns
    plain = substring_dedup(docs.select("doc_id", "text"))
    assert sorted(((d, t) for _, d, t in _pieces(out)), key=str) == sorted(((r[0], r[1]) for r in plain.collect()), key=str)
    assert out.count() == docs.count()


def test_line_dedup(docs):
    out = line_dedup(docs)
    assert set(out.columns) == set(docs.columns)
    plain = line_dedup(docs.select("doc_id", "text"))
    kept = out.where("true").select([c for c in docs.columns if c != "_gone"])
    assert sorted(((d, t) for _, d, t in _pieces(kept)), key=str) == sorted(((r["doc_id"], r["text"]) for r in plain.collect()), key=str)


@pytest.mark.parametrize("bits", [1 << 20, 0])
def test_filter_urls(spark, monkeypatch, bits):
    monkeypatch.setattr(url_filter, "MAX_BITS", bits)
    pages = spark.createDataFrame([(1, "http://a.net/x", "b", "l", "k"), (2, "http://b.net/y", "b", "l", "k")],
                                  "page_id long, url string, _block string, listed string, key string")
    listed = spark.createDataFrame([("a.net/x",)], "key string")
    out = url_filter.filter_urls(pages, listed, [])
    assert [c for c in out.columns if c in pages.columns] == pages.columns
    assert {(r["page_id"], r["_block"], r["listed"], r["key"], r["verdict"]) for r in out.collect()} == {
        (1, "b", "l", "k", "block"), (2, "b", "l", "k", "allow")}
