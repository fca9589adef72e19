"""Near duplicates: the document frequency of every run, also of those below one text in twenty."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("storelens.llm")
from storelens.llm import near_dedup  # noqa: E402
from storelens.llm.common import prepare, shingle_hashes, text_buffer, word_hashes  # noqa: E402


def _runs(text):
    w = (text or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def _groups(rows, level=False):
    """All pairs: {id: smallest id of its group}; ``level``: as if no text held runs of less than a twentieth of the texts."""
    texts = {t or "": _runs(t) for _, t in rows}
    df = Counter(x for r in texts.values() for x in r)
    idf = {x: math.log1p(len(texts) / (max(n, len(texts) / 20) if level else n)) for x, n in df.items()}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t
    keys = [t for t in texts if texts[t]]
    for k, s in enumerate(keys):
        for t in keys[:k]:
            a, b = texts[s], texts[t]
            both = sum(min(a[x], b[x]) * idf[x] for x in a.keys() & b.keys())
            if both and both / (sum(a[x] * idf[x] for x in a) + sum(b[x] * idf[x] for x in b) - both) >= 0.8:
                root[find(s)] = find(t)
    least = {}
    for d, t in rows:
        g = find(t or "")
        least[g] = min(d, least.get(g, d))
    return {d: least[find(t or "")] for d, t in rows}


def _rows():
    """400 texts; families of six share most of their words, so their runs are held by six texts at most."""
    rng, rows = random.Random(3), []
    new = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    for f in range(50):
        base = new(150)
        for k in range(6):
            rows.append(base + new(12 + (3 * f + k) % 14))
    rows += [new(60) for _ in range(100)]
    texts = [" ".join(r) for r in rows]
    texts += texts[:40] + texts[:10] + [None, "", "one two", "one two"]
    return list(enumerate(texts))


def _frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def _classes(df):
    return {r.doc_id: r.class_id for r in near_dedup.document_groups(df).collect()}


def test_rare_runs_weigh_by_their_frequency(spark):
    rows = _rows()
    want = _groups(rows)
    assert want != _groups(rows, level=True)
    assert _classes(_frame(spark, rows)) == want


@pytest.mark.parametrize("most", [0, near_dedup.MAX_FREQUENT])
def test_counts_of_all_runs(spark, monkeypatch, most):
    """Many frequent runs go the way of the rare ones; repeated rows count once."""
    monkeypatch.setattr(near_dedup, "MAX_FREQUENT", most)
    monkeypatch.setattr(near_dedup, "PART_RUNS", 700)
    monkeypatch.setattr(near_dedup, "DEALT", 900)
    rows = [(d, (t or "") + " a b c d e f a b c d e f" * (d % 3 == 0)) for d, t in _rows()]
    docs = _frame(spark, rows)
    texts = {t for _, t in rows}

    def hashed(t):
        return np.unique(shingle_hashes(*word_hashes(*text_buffer(pa.array([t]))), 5)[0])
    want = Counter(x for t in texts for x in hashed(t).tolist())
    frequent, counts, total = near_dedup.frequent_runs(docs, "text", len(texts))
    got = dict(zip(frequent.tolist(), counts.tolist()))
    assert bool(got) == bool(most) and total == sum(sum(_runs(t).values()) for _, t in rows)
    for r in near_dedup.shared_runs(docs, "text", frequent, total).collect():
        for x, n in zip(r.runs, r.counts):
            assert got.setdefault(x % 2**64, n) == n
    assert got == {x: n for x, n in want.items() if n > 1}
