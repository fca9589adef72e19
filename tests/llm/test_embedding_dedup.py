"""Embedding near-dedup: links and components against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

pytest.importorskip("storelens.llm")
from storelens.llm import embedding_dedup as ed  # noqa: E402
from storelens.llm import queries  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402

SF1 = "/root/testdata/sf0.1"


def _brute(rows, dim=None):
    """[(id, vector or None)] -> per position (links, component)."""
    ok = [i for i, (_, v) in enumerate(rows) if v and None not in v and len(v) == dim and all(map(math.isfinite, v)) and any(v)]
    x = np.array([rows[i][1] for i in ok], dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    hit = x @ x.T >= 0.9
    np.fill_diagonal(hit, False)
    root = list(range(len(ok)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in zip(*np.nonzero(hit)):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    low = defaultdict(list)
    for k, i in enumerate(ok):
        low[find(k)].append(rows[i][0])
    out = {i: (0, rows[i][0]) for i in range(len(rows))}
    for k, i in enumerate(ok):
        out[i] = (int(hit[k].sum()), min((x for x in low[find(k)] if x is not None), default=None))
    return out, hit


def test_all_vectors_against_brute_force(spark):
    """The whole table, and with it vectors turned to the threshold's neighbourhood, as the table holds few links."""
    table = [tuple(r) for r in spark.read.parquet(f"{SF1}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {r.vec_id: r for r in queries.op2_embedding_near_dedup(spark, SF1).collect()}
    want, _ = _brute(table, 64)
    assert len(got) == len(table) and all((got[d].n_links, got[d].component_id) == want[i] for i, (d, _) in enumerate(table))
    rnd = np.random.RandomState(4)
    planted = []
    for k, (d, v) in enumerate(table):
        x, turn = np.array(v, dtype=np.float64), rnd.standard_normal(64)
        turn -= (turn @ x) / (x @ x) * x
        c = rnd.uniform(0.86, 0.99)                      # about a third just below, the rest above
        near = c * x / np.linalg.norm(x) + math.sqrt(1 - c * c) * turn / np.linalg.norm(turn)
        planted.append((10 ** 6 + d, near.astype(np.float32).tolist()))
    rows = table + planted
    want, hit = _brute(rows, 64)
    got = {r.vec_id: r for r in ed.near_vectors(_frame(spark, rows)).collect()}
    assert hit.sum() > len(table)
    assert 0.97 * hit.sum() <= sum(r.n_links for r in got.values()) <= hit.sum()
    assert all(got[d].n_links <= want[i][0] for i, (d, _) in enumerate(rows))
    assert np.mean([got[d].component_id == want[i][1] for i, (d, _) in enumerate(rows)]) > 0.97


def _frame(spark, rows):
    prepare(spark)
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("node", T.StringType()), T.StructField("dig", T.LongType())])
    return spark.createDataFrame([(a, b, "x", 1) for a, b in rows], schema)


def test_recall_and_counts_with_many_cells(spark, monkeypatch):
    monkeypatch.setattr(ed, "NODES_PER_CELL", 4)
    monkeypatch.setattr(ed, "BLOCK", 32)                   # hot cells in several blocks and parts
    rnd = np.random.RandomState(5)
    base = rnd.standard_normal((60, 16))
    rows = [(i, (base[i % 60] + 0.2 * rnd.standard_normal(16)).astype(np.float32).tolist()) for i in range(900)]
    hot = base[0]
    rows += [(1000 + i, (hot + 0.1 * rnd.standard_normal(16)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(2000 + i, hot.astype(np.float32).tolist()) for i in range(300)]
    want, hit = _brute(rows, 16)
    got = {r.vec_id: r for r in ed.near_vectors(_frame(spark, rows)).collect()}
    found = sum(r.n_links for r in got.values())
    assert 0.97 * hit.sum() <= found <= hit.sum()
    assert all(got[d].n_links <= want[i][0] for i, (d, _) in enumerate(rows))
    assert np.mean([got[d].component_id == want[i][1] for i, (d, _) in enumerate(rows)]) > 0.99


def test_traversal_skips_most_cells():
    rnd = np.random.RandomState(1)
    x = ed._unit(rnd.standard_normal((4000, 64)))
    index = ed.MultiIndex(x, 200_000)
    row, cell = index.visits(x[:500])
    assert len(cell) / 500 < 0.25 * index.cells
    assert set(zip(range(500), index.cell(x[:500]))) <= set(zip(row, cell))


def test_cases(spark):
    v = [1.0, 2.0, 0.0, 1.0]
    rows = [(5, v), (3, [2.0, 4.0, 0.0, 2.0]), (9, None), (10, []), (11, [0.0] * 4), (12, [1.0, None, 1.0, 1.0]),
            (13, [float("nan"), 1.0, 1.0, 1.0]), (14, [float("inf"), 1.0, 1.0, 1.0]), (15, [1.0, 1.0]), (7, v), (7, v),
            (None, v), (20, [-1.0, -2.0, 0.0, -1.0]),
            (21, [1e-30, 2e-30, 0.0, 1e-30]), (22, [1e38, 2e38, 0.0, 1e38])]
    want, _ = _brute(rows, 4)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.near_vectors(_frame(spark, rows)).collect()), key=str)
    assert got == sorted(((d, *want[i], d == want[i][1]) for i, (d, _) in enumerate(rows)), key=str)
    assert ed.near_vectors(_frame(spark, [])).count() == 0
    assert [tuple(r) for r in ed.near_vectors(_frame(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]


def test_every_length_is_compared(spark):
    rnd = np.random.RandomState(2)
    rows = [(i, rnd.standard_normal(3).tolist()) for i in range(5)] + [(10 + i, [1.0, 2.0]) for i in range(3)]
    rows += [(20 + i, [1.0, 2.0 + i / 100, 0.5, 0.1, 0.0]) for i in range(4)] + [(30, [1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in ed.near_vectors(_frame(spark, rows)).collect()}
    assert all(got[10 + i] == (2, 10) for i in range(3)) and all(got[20 + i] == (3, 20) for i in range(4)) and got[30] == (0, 30)
