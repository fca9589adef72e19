"""Substring dedup: chunk borders, planted passages, rebuilt texts."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tests.conftest import SF001

pytest.importorskip("storelens.llm")
from storelens.llm import common, queries  # noqa: E402
from storelens.llm import substring_dedup as sd  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402


def _words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklmnoé") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def _chunked(texts):
    data, off = common.text_buffer(pa.array(texts, pa.string()))
    starts, digests, at = sd.chunk_texts(data, off)
    return [(starts[a:b], digests[a:b]) for a, b in zip(at[:-1], at[1:])]


def test_chunks_depend_on_the_text_alone(monkeypatch):
    rnd = random.Random(6)
    texts = [_words(rnd, rnd.randint(0, 300)) for _ in range(40)] + ["", "x", "é" * 500, "a" * 200_000]
    alone = [_chunked([t])[0] for t in texts]
    for a, b in zip(alone, _chunked(texts)):
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
    monkeypatch.setattr(sd, "SEGMENT", 1 << 10)           # the long way round
    monkeypatch.setattr(sd, "_digests", lambda d, f, la: np.zeros(len(f), np.uint64))
    for t, a in zip(texts, alone):
        assert (_chunked([t])[0][0] == a[0]).all()
    for t, (starts, _) in zip(texts, alone):
        raw = t.encode()
        edges = [*starts, len(raw)]
        assert b"".join(raw[x:y].decode().encode() for x, y in zip(edges, edges[1:])) == raw


def test_insertion_moves_near_chunks_only():
    rnd = random.Random(7)
    t = _words(rnd, 2000)
    a, b = (set(x[1].tolist()) for x in _chunked([t, t[:5000] + " new words here " + t[5000:]]))
    assert len(a - b) <= 4 and len(b - a) <= 5


def _docs(spark, rows):
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("at", T.StringType()), T.StructField("first", T.LongType())])
    return spark.createDataFrame([(*r, "x", 1) for r in rows], schema)


def _covered(rows, width=50):
    """Plain version: bytes of every document within runs of ``width`` words that documents of smaller id hold."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        at = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", raw)]
        runs = [tuple(raw[x:y] for x, y in at[k:k + width]) for k in range(len(at) - width + 1)]
        out[i] = np.zeros(len(raw), bool)
        for k, run in enumerate(runs):
            if run in seen:
                out[i][at[k][0]:at[k + width - 1][1]] = True
        seen.update(runs)
    return out


def _compared(rows, found):
    """(bytes wanted, found, both) over all documents, and the two sets of documents."""
    want, got = _covered(rows), {i: np.zeros(len((t or "").encode()), bool) for i, t in rows}
    for r in found:
        if r.removed:
            got[r.id][r.start_byte:r.start_byte + r.n_bytes] = True
    sums = [sum(int(x.sum()) for x in y.values()) for y in (want, got)]
    both = sum(int((want[i] & got[i]).sum()) for i in want)
    return sums[0], sums[1], both, {i for i in want if want[i].any()}, {i for i in got if got[i].any()}


def test_planted_passages_are_found_to_their_ends_and_clean_documents_left(spark):
    rnd = random.Random(9)
    passages = [_words(rnd, 51 + k % 5) for k in range(150)]
    rows, planted = [], {}
    for i in range(600):
        text = _words(rnd, rnd.randint(30, 200))
        if i % 2 == 0:
            p = i // 2 % 150
            text = text[:50 + i % 17] + " " + passages[p] + " " + _words(rnd, 20)
            planted.setdefault(p, []).append(i)
        rows.append((i, text))
    found = sd.repeated_passages(_docs(spark, rows)).collect()
    want, got, both, in_want, in_got = _compared(rows, found)
    assert in_want == in_got and both >= 0.98 * want and both >= 0.98 * got
    assert {r.id for r in found if not r.removed} == {v[0] for v in planted.values()}
    for r in found:
        raw = dict(rows)[r.id].encode()[r.start_byte:r.start_byte + r.n_bytes]
        p = next(p for p, v in planted.items() if r.id in v)
        if not r.removed:
            assert passages[p].encode() in raw
    out = {r.doc_id: r.text for r in sd.substring_dedup(_docs(spark, rows)).collect()}
    gone = {i for v in planted.values() for i in v[1:]}
    for i, text in rows:
        assert (out[i] == text) == (i not in gone)
        if i in gone:
            p = next(p for p, v in planted.items() if i in v)
            assert out[i].split() == text.replace(passages[p], " ").split()


def test_repeats_below_fifty_words_stay_and_scripts_without_spaces_count_bytes(spark):
    rnd = random.Random(10)
    licence, wide = _words(rnd, 40), "".join(chr(rnd.randint(0x4e00, 0x9000)) for _ in range(300))
    rows = [(i, _words(rnd, 60) + " " + licence + " " + _words(rnd, 60)) for i in range(50)]
    rows += [(100, wide), (101, "".join(chr(rnd.randint(0x4e00, 0x9000)) for _ in range(80)) + wide)]
    found = sd.repeated_passages(_docs(spark, rows)).collect()
    assert {(r.id, r.removed) for r in found} == {(100, False), (101, True)}
    out = {r.doc_id: r.text for r in sd.substring_dedup(_docs(spark, rows)).collect()}
    assert out[101] == rows[-1][1][:80] and out[7] == rows[7][1]


def test_digests_that_collide_remove_nothing(spark, monkeypatch):
    rnd = random.Random(11)
    rows = [(i, _words(rnd, 120)) for i in range(40)]
    base = [(i, [s.encode()[x:] for x in _chunked([s])[0][0]]) for i, s in rows]
    assert all(len(x) > 5 for _, x in base)
    raw = rows[0][1].encode()
    starts = _chunked([rows[0][1]])[0][0]
    around = {"digest": 5, "holder": 0, "holder_dig": 0, "own_start": int(starts[2]), "own_stop": int(starts[3]),
              "before": raw[:int(starts[2])], "behind": raw[int(starts[3]):]}
    other = rows[1][1]
    ends = [{"start": 100, "stop": 160, "first": 0, "side": k, **around} for k in (0, 1)]
    kind = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("first", pa.int64()), ("side", pa.int32()), ("digest", pa.int64()),
                      ("holder", pa.int64()), ("holder_dig", pa.int64()), ("own_start", pa.int64()), ("own_stop", pa.int64()),
                      ("before", pa.binary()), ("behind", pa.binary())])
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([9]), pa.array([other]), pa.array([ends], pa.list_(kind))],
                                       names=["id", "dig", "text", "sides"])
    assert [b.num_rows for b in sd._passages(iter([batch]))] == [0]


def test_cases(spark):
    rnd = random.Random(3)
    long = _words(rnd, 150)
    rows = [(1, None), (2, ""), (3, "short"), (4, "short"), (6, long), (5, long), (5, long), (None, long), (None, long),
            (7, long + " " + long), (8, _words(rnd, 200_000))]
    found = sd.repeated_passages(_docs(spark, rows)).collect()
    assert {(r.id, r.removed) for r in found} == {(5, False), (6, True), (None, True), (7, True)}
    out = sd.substring_dedup(_docs(spark, rows))
    assert out.columns == ["doc_id", "text", "at", "first"]
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert len(got) == len(rows)
    texts = dict(got)
    assert texts[1] is None and texts[2] == "" and texts[3] == texts[4] == "short" and texts[5] == long
    assert texts[6] == "" and texts[None] == "" and len(texts[7]) < 200 and texts[8] == rows[-1][1]
    assert sd.repeated_passages(_docs(spark, [])).count() == 0


def test_query_against_brute_force(spark):
    """Whole result on the table: the bytes that earlier documents hold in runs of 50 words, and nothing else but the
    borders of passages."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    found = queries.op4_substring_dedup(spark, SF001).withColumnRenamed("doc_id", "id").collect()
    want, got, both, in_want, in_got = _compared(rows, found)
    assert want and in_want == in_got and both >= 0.995 * want and both >= 0.995 * got
    docs = {i: (t or "").encode() for i, t in rows}
    for r in found:
        docs[r.id][r.start_byte:r.start_byte + r.n_bytes].decode()
        assert (r.first_doc_id < r.id) == r.removed


def test_chunks_are_dropped_when_read(spark):
    import os

    from storelens.session import scratch_path
    prepare(spark)
    rnd = random.Random(9)
    passage = _words(rnd, 80)
    rows = [(None if i == 3 else i, f"{_words(rnd, 40)} {passage} {_words(rnd, 40)}") for i in range(6)] + [(7, _words(rnd, 100)), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = scratch_path(spark, "llm").removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    got = sd.repeated_passages(docs).where("removed").collect()
    assert {r.id for r in got} == {None, 1, 2, 4, 5} and all(r.first_id == 0 for r in got)
    left = set(os.listdir(folder)) - before
    assert not [f for f in left if f.startswith(("chunks-", "shared-chunks-"))]
