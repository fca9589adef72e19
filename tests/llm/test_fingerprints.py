"""Fingerprints: edited texts, likeness and containment against plain versions."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tests.conftest import SF001

pytest.importorskip("storelens.llm")
from storelens.llm import fingerprints as fp  # noqa: E402
from storelens.llm import queries  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402


def _plain(rows):
    """rows: (id, text) -> {id: (n, sha of edited, edited, next)} by falling id, null last."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: -r[0] if r[0] is not None else float("inf"))
    out = {}
    for k, (d, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 3
        edited = t[:len(t) - cut] + after[:cut]
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), edited, after)
    return out


def _runs(t):
    w = t.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want, text = _plain(rows), dict(rows)
    got = queries.op10_document_fingerprints(spark, SF001).collect()
    assert sorted(r.doc_id for r in got) == sorted(text)
    prints, off = {}, []
    for r in got:
        n, sha, edited, after = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert prints.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        a, b = _runs(text[r.doc_id] or ""), _runs(edited)
        if len(a | b) > 100:
            off.append(abs(len(a & b) / len(a | b) - r.near_edited))
    assert len(off) > 50 and np.mean(off) < 0.06
    assert {r.fingerprint for r in fp.fingerprint(spark.read.parquet(f"{SF001}/documents.parquet")).collect()} == set(prints.values())


def test_cases(spark):
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("bucket", T.LongType()), T.StructField("h", T.StringType())])
    make = lambda rs: spark.createDataFrame([(a, b, 1, "x") for a, b in rs], schema)
    rows = [(5, "äöü\U0001F600 five"), (-3, None), (9, ""), (2, "w " * 400_000), (None, "null id"), (7, "one"), (8, "two")]
    got = {r.doc_id: r for r in fp.edited_likeness(make(rows)).collect()}
    want = _plain(rows)
    assert {d: (r.n_chars, r.edited_sha256) for d, r in got.items()} == {d: w[:2] for d, w in want.items()}
    assert got[8].near_next == 0.0                        # short texts hold no hash, yet differ
    same = fp.edited_likeness(make([(1, "a b c")] * 5)).collect()
    assert len(same) == 5 and {r.near_next for r in same} == {1.0}
    assert fp.edited_likeness(make([(1, "alone")])).collect()[0].near_next == 1.0
    assert fp.edited_likeness(make([])).count() == 0


def test_merge_and_containment():
    words = [f"w{i}" for i in range(9000)]
    texts = [" ".join(words), " ".join(words[:600]), " ".join(words[4000:4700]), "other " * 3 + " ".join(f"v{i}" for i in range(700))]
    a, b, c, d = (fp._write(s) for s in fp._sketches(pa.array(texts)))
    assert fp.containment(b, a) == 1.0 and fp.containment(d, a) < 0.02
    assert fp.likeness(a, b) == pytest.approx(596 / 8996, abs=0.03)
    both = fp.merge([b, c])
    assert fp.containment(c, both) == 1.0 and fp.merge([b, c, both]) != b
    assert fp.containment(a, both) == pytest.approx(1292 / 8996, abs=0.03)
