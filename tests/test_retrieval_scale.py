"""Retrieval at size: sparse vectors against the dense search, chunks and keys against plain Python."""

import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storelens.functions.text import CODE_PATTERN, token_runs
from storelens.functions.vectors import md5_embed
from storelens.operators import chunking as ch
from storelens.operators import retrieval as rt


def _vectors(spark, rng, n, id_col, dim=300):
    rows = []
    for i in range(n):
        v = np.zeros(dim)
        at = rng.choice(dim // 3 if i % 2 else dim, rng.integers(0, 9), replace=False)
        v[at] = rng.integers(-1, 4, len(at))
        if i % 17 == 3:
            v[0] = np.nan
        rows.append((int(i * 7 % n), [float(x) for x in v]))
    rows += [(n + j, rows[j][1]) for j in range(0, 40, 3)] + [(n + 100, None)]
    return spark.createDataFrame(rows, f"{id_col} long, embedding array<double>")


@pytest.mark.parametrize("k,own", [(1, False), (3, True), (60, False)])
def test_sparse_search_equals_dense(spark, monkeypatch, k, own):
    rng = np.random.default_rng(5)
    q, b = _vectors(spark, rng, 90, "query_id"), _vectors(spark, rng, 150, "vec_id")
    want = rt.vector_search(q, b, k, exclude_self=own, strategy="base")
    monkeypatch.setattr(rt, "SPARSE_BYTES", 4_000)              # several blocks a side
    got = rt.vector_search(q, b, k, exclude_self=own, max_broadcast_rows=10, sparse=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert rt.vector_search(q.limit(0), b, k, max_broadcast_rows=-1, sparse=True).count() == 0


def test_entities_move_as_entries(spark, monkeypatch):
    """Rows sent to blocks hold the trigrams of a name, not all 2,048 places."""
    sent = []
    rows_of = rt._sparse_rows
    monkeypatch.setattr(rt, "_sparse_rows", lambda *a: sent.append(rows_of(*a)) or sent[-1])
    search = rt.vector_search
    monkeypatch.setattr(rt, "vector_search", lambda *a, **kw: search(*a, **kw, max_broadcast_rows=5))
    names = spark.createDataFrame([(f"STORE_{i:03d}", f"Supplier#{i:09d}") for i in range(30)], "sid string, name string")
    asked = spark.createDataFrame([(i, f"supplier {i}") for i in range(30)] + [(99, "!!")], "qid long, text string")
    got = {r.query_id: r.entity_id for r in rt.resolve_entity(asked, names, "qid", "text", "sid", "name").collect()}
    assert all(got[i] == f"STORE_{i:03d}" for i in range(30)) and len(got) == 31
    assert len(sent) == 2 and max(r[0] for x in sent for r in x.select(F.size("v")).collect()) < 40


def test_windows_of_texts(spark):
    texts = [None, "", "é" * 31, "ab cd " * 70, "xyz\U0001f600 " * 2_000, "a" * 400, "b" * 6_400, "c" * 6_401, "d" * 6_431, " " * 900 + "e" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = sorted(map(tuple, ch.chunk(df, meta=("id",)).collect()))
    want = [(i, k, t[s:s + 500]) for i, t in enumerate(texts) if t is not None
            for k, s in enumerate(range(0, max(len(t), 1), 400)) if len(t[s:s + 500].strip(" ")) > 30]
    assert got == sorted(want)
    small = sorted(map(tuple, ch.chunk(df, size=3, step=5, min_len=1, meta=("id",)).collect()))
    assert small == sorted((i, k, t[s:s + 3]) for i, t in enumerate(texts) if t is not None
                           for k, s in enumerate(range(0, max(len(t), 1), 5)) if len(t[s:s + 3].strip(" ")) > 1)


def test_long_text_is_not_read_for_each_window(spark):
    df = spark.range(1).select("id", F.repeat(F.lit("words of a long manual "), 200_000).alias("text"))
    start = time.perf_counter()
    assert ch.chunk(df, meta=("id",)).count() == 11_500
    assert time.perf_counter() - start < 60                     # minutes where every window read the text from its start


@pytest.mark.parametrize("own", [True, False])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_rows_among_themselves_equal_two_sides(spark, own, kind):
    rng = np.random.default_rng(8)
    x = np.vstack([rng.integers(-2, 3, (500, 6)), np.zeros((2, 6)), np.full((1, 6), np.nan)]).astype(float)
    rows = [(int(i * 5 % 503), [float(f) for f in v]) for i, v in enumerate(x)] + [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 2.0])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    q = df.select(F.col("vec_id").alias("query_id"), "embedding")
    want = rt.vector_search(q, df, 4, exclude_self=own, strategy="base")
    got = rt.vector_search(q, df, 4, exclude_self=own, strategy="blocked", block_rows=100, same_rows=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_two_blocks_meet_once(spark, monkeypatch):
    """A pair of rows is multiplied once for both of them, and every group has a task of its own."""
    pairs = []
    matmul = np.matmul
    monkeypatch.setattr(np, "matmul", lambda x, y, out: pairs.append(len(x) * y.shape[1]) or matmul(x, y, out=out))
    x = np.random.default_rng(9).standard_normal((6000, 8)).astype(np.float32)
    half = [rt._Block(np.arange(lo, lo + 3000), pa.array(list(x[lo:lo + 3000]))) for lo in (0, 3000)]
    a, b = rt._meet(*half, 3, True)
    assert sum(pairs) <= 3000 * 3000
    exact = x / np.linalg.norm(x, axis=1, keepdims=True)
    far = exact[:3000] @ exact[3000:].T
    assert (a.match[:, 0] == 3000 + far.argmax(axis=1)).mean() > 0.99 and (b.match[:, 0] == far.argmax(axis=0)).mean() > 0.99
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:800])], "match_id long, bv array<double>")
    found = rt._self_topk(df, 3, True, block_rows=100)
    assert found.rdd.getNumPartitions() == 36
    assert sorted(rt._task_numbers(spark, 36)) == sorted(set(rt._task_numbers(spark, 36)))
    assert found.count() == 800 * 8 * 3


def test_texts_are_shuffled_once_for_stitching(spark):
    chunks = [(d, i, f"{d}{i}") for d in "ab" for i in range(-3, 50) if i % 11] + [("a", 15, "twice"), ("a", None, "none"), (None, 4, "no document")]
    asked = [(n, "ab"[n % 2], n - 2) for n in range(60)] + [(70, "a", None), (71, None, 3), (72, "c", 1), (3, "b", 1)]
    c = spark.createDataFrame(chunks, "document_filename string, chunk_index long, chunk_content string")
    m = spark.createDataFrame(asked, "match_id long, document_filename string, chunk_index long")
    for radius in (1, 2, 7):
        want = {}
        for a in asked:
            near = [(i, x) for d, i, x in chunks if d == a[1] and None not in (d, i, a[2]) and abs(i - a[2]) <= radius] * asked.count(a)
            if near:
                want[a] = ("\n".join(x for _, x in sorted(near)), len(near))
        got = rt.stitch(m, c, radius)
        assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == want
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert rt.stitch(m, c)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_answers_of_long_documents(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((40, 8))
    chunks = spark.createDataFrame([(i, "m.pdf", i, "T" if i % 3 else None, "E", "gs://m", f"text {i}", [float(f) for f in x[i]]) for i in range(40) if i != 20],
                                   "vec_id long, document_filename string, chunk_index long, document_title string, equipment_covered string, "
                                   "source_pdf_uri string, chunk_content string, embedding array<double>")
    q = spark.createDataFrame([(100 + i, "ask", [float(f) for f in x[i]]) for i in range(40)] + [(7, "nothing", None), (8, None, [0.0] * 8)],
                              "query_id long, text string, embedding array<double>")
    out = {r.query_id: r for r in rt.answer(q, chunks).collect()}
    assert len(out) == 42 and out[7].route == out[8].route == "decline"
    for i in (0, 14, 15, 16, 17, 19, 21, 31, 32, 39):
        r = out[100 + i]
        near = [j for j in (i - 1, i, i + 1) if 0 <= j < 40 and j != 20]
        assert r.route == "vector" and r.chunk_index == i
        assert r.answer_text.endswith("Instructions:\n" + "\n".join(f"text {j}" for j in near) + "\n")
        assert f"**Document Title:** {'T' if i % 3 else 'm.pdf'}\n" in r.answer_text


def _keys(text, lengths):
    out = set()
    for run in re.findall(r"[a-z0-9]+(?:-+[a-z0-9]+)*", text.lower()):
        parts = re.split("-+", run)
        out |= {"-".join(parts[i:i + k]) for k in lengths for i in range(len(parts) - k + 1)}
    return out


@pytest.mark.parametrize("lengths", [[1], [2], [1, 3], [2, 3, 4], []])
def test_token_runs(spark, lengths):
    texts = ["", "plain words, no hyphen 42", "A--77-B- is ERR-42 x-", "-a-b-c-d e-f", "a-b a-b-c É-x-y", "--", "one - two-three"]
    df = spark.createDataFrame([(t, lengths) for t in texts], "text string, n array<int>")
    got = df.select(token_runs("text", F.col("n")).alias("k")).collect()
    for t, r in zip(texts, got):
        assert len(r.k) == len(set(r.k)) and set(r.k) == _keys(t, lengths)
    assert spark.createDataFrame([(None,)], "text string").select(
        F.explode(token_runs("text", F.array(F.lit(1), F.lit(2))))).count() == 0


def test_terms_are_extracted_once(spark):
    q = spark.createDataFrame([(1, "code ERR-42 and printer"), (2, "nothing")], "query_id long, text string")
    c = spark.createDataFrame([("d", 0, "See err-42."), ("c", 3, "the printer")], "document_filename string, chunk_index long, chunk_content string")
    out = rt.fallback_search(q, c)
    assert CODE_PATTERN not in out._jdf.queryExecution().toString()
    assert [tuple(r) for r in out.collect()] == [(1, "ERR-42", "d", 0)]


def test_portable_vectors_hash_words_once(spark):
    texts = ["b a a", "", None, "Zeta, beta; a", "ü-x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    out = md5_embed(df, "text", dim=8)
    assert "md5(" not in out._jdf.queryExecution().toString()
    import hashlib
    for r in out.collect():
        v = np.zeros(8)
        for w in re.findall("[a-z0-9]+", (r.text or "").lower()):
            v[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 8] += 1
        assert r.embedding == [float(x) for x in (v / np.sqrt((v * v).sum()) if v.any() else v)]
