"""Ranked lexical search against scoring every document, and the bounds of the tree."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.conftest import SF001, SF01

pytest.importorskip("storelens.llm")
from storelens.llm import lexical_search as ls, queries  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return [re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), t) for t in TERM.findall(text or "")]


def _brute(docs, items, top=10):
    """docs: [(id, text)], items: {(item, text)} -> rows (item, rank, id, score)."""
    bags = [(d, Counter(_terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        want = Counter(_terms(text))
        scored = []
        for d, b in bags:
            m = 100 - 75 + (75 * sum(b.values()) * n) // total
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 8 * m))
                    for t, c in want.items() if t in b)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(scored)[:top])]
    return out


def _key(r):
    return tuple(map(str, r))


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_items_against_brute_force(spark, sf, monkeypatch):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(c, "text").collect()]
                   for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    want = sorted(_brute(docs, items))
    got = queries.op11_lexical_search(spark, sf)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == want and len(want) == 10 * len(items)
    monkeypatch.setattr(ls, "ITEMS", 7)                  # several passes
    assert sorted(map(tuple, queries.op11_lexical_search(spark, sf).collect())) == want


def test_cases(spark):
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("salt", T.StringType()), T.StructField("score", T.LongType())])
    copy = "Alpha beta, ÄRGER x1"
    docs = [(i, copy if i % 3 else f"own{i} beta") for i in range(400)] + [
        (1000, None), (1001, ""), (1002, "?!"), (None, copy), (1003, "alpha " * 200_000), (1004, "é́a\x00alpha"), (7, copy), (-5, copy)]
    items = [(1, "ALPHA ärger"), (2, "ÄRGER\nalpha alpha"), (3, None), (4, ""), (5, "nowhere"), (6, "own3 beta own6"), (1, "ALPHA ärger")]
    make = lambda rs: spark.createDataFrame([(a, b, "s", 1) for a, b in rs], schema)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = ls.rank_documents(make(docs), bench)
    want = _brute(docs, set(items))
    assert sorted(map(tuple, got.collect()), key=_key) == sorted(want, key=_key)
    assert {r[0] for r in want} == {1, 2, 6}
    assert ls.rank_documents(make([]), bench).count() == 0
    assert ls.rank_documents(make(docs), bench.limit(0)).count() == 0
    long = ls.rank_documents(make(docs), bench, top=500).collect()   # null ids come last among equals
    assert sorted(map(tuple, long), key=_key) == sorted(_brute(docs, set(items), 500), key=_key)


def _tree(rnd, n, width):
    off, cols, vals = [0], [], []
    for _ in range(n):
        k = sorted(rnd.sample(range(width), rnd.randint(1, 9)))
        cols += k
        vals += [rnd.choice([1, 50, 10 ** 6]) * rnd.randint(1, 30_000) for _ in k]
        off.append(len(cols))
    rows = ls.Rows(np.array(cols), np.array(vals, dtype=np.int64), np.array(off))
    cuts = np.unique(np.linspace(0, width, 6).astype(int))
    return rows, ls.Tree(rows, np.array(rnd.sample(range(10 * n), n)), np.zeros(n, bool), width, cuts)


def test_no_document_is_above_the_bounds_of_its_nodes():
    rnd = random.Random(6)
    for n in (1, 70, 700):
        rows, tree = _tree(rnd, n, 40)
        items = np.array([[rnd.choice([0, 0, 0, 1, 2]) for _ in range(40)] for _ in range(30)], dtype=float)
        bounds = tree.bounds(items)
        for q, item in enumerate(items.astype(np.int64)):
            score = tree.rows.dot(item)
            assert sorted(score) == sorted(rows.dot(item))
            for node, (a, b) in enumerate(tree.spans):
                assert score[a:b].max() <= bounds[q, node]
        assert sorted(tree.order) == list(range(n))


def test_subtrees_are_left_out(spark):
    """Most leaves are never scored where documents have little in common."""
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    off, cols, vals = [0], [], []
    for i in range(4000):
        c = sorted({300 * (i % 10) + rnd.randint(0, 299) for _ in range(12)})
        cols, vals, off = cols + c, vals + [10 ** 6 + rnd.randint(0, 9)] * len(c), off + [off[-1] + len(c)]
    rows = ls.Rows(np.array(cols), np.array(vals, dtype=np.int64), np.array(off))
    tree = ls.Tree(rows, np.arange(4000), np.zeros(4000, bool), len(words), np.linspace(0, 3000, 11).astype(int))
    items = np.zeros((20, 3000))
    for q in range(20):
        items[q, rows.cols[rows.off[q]:rows.off[q + 1]]] = 1
    best = [ls.Best(10) for _ in items]
    scored = ls.search(tree, items, best)
    leaves = sum(not c for c in tree.children)
    assert scored < 0.5 * leaves * len(items)
    for q, b in enumerate(best):
        s = rows.dot(items[q].astype(np.int64))
        order = np.lexsort((np.arange(4000), -s))[:10]
        assert b.id.tolist() == order.tolist() and b.score.tolist() == s[order].tolist()
