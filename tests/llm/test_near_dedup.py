"""Near duplicates: groups against all pairs compared by brute force."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from tests.conftest import SF001

pytest.importorskip("storelens.llm")
from storelens.llm import near_dedup, queries  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402


def _runs(text):
    w = [x for x in text.replace("\x0b", " ").replace("\x0c", " ").split() if x]
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def _groups(rows):
    """Brute force: {position: component}, and the smallest similarity gap to the threshold."""
    texts = {t: _runs(t or "") for _, t in rows}
    n = len({t or "" for _, t in rows})
    df = Counter(x for t in {t or "" for _, t in rows} for x in _runs(t))
    idf = {x: math.log1p(n / max(c, n / 20)) if c >= max(2, math.ceil(n / 20)) else math.log1p(20) for x, c in df.items()}
    keys = [t for t in texts if texts[t]]
    holders = defaultdict(set)
    for i, t in enumerate(keys):
        for x in texts[t]:
            holders[x].add(i)
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    sims = {}
    for i, t in enumerate(keys):
        for j in {j for x in texts[t] for j in holders[x] if j > i}:
            a, b = texts[t], texts[keys[j]]
            lo = sum(min(a[x], b[x]) * idf[x] for x in a if x in b)
            sim = lo / (sum(a[x] * idf[x] for x in a) + sum(b[x] * idf[x] for x in b) - lo)
            sims[i, j] = sim
            if sim >= 0.8:
                root[find(i)] = find(j)
    at = {t: i for i, t in enumerate(keys)}
    ids = defaultdict(list)
    for d, t in rows:
        if t in at:
            ids[find(at[t])].append(d)
    return {d: min(ids[find(at[t])]) if t in at else None for d, t in rows}


def test_documents_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op8_minhash_near_dedup(spark, SF001).collect()
    want = _groups(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got} == {d: w if w is not None else d for d, w in want.items()}
    assert sum(r.kept for r in got) == len({r.class_id for r in got}) < len(rows)


def _docs(spark, rows):
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("dig", T.StringType()), T.StructField("component", T.LongType()),
                           T.StructField("node", T.LongType())])
    return spark.createDataFrame([(a, b, "x", 1, 2) for a, b in rows], schema)


def test_cases(spark):
    base = [f"w{i}" for i in range(400)]
    near = lambda *at: " ".join("zz" if i in at else w for i, w in enumerate(base))
    rows = [(10, near()), (4, near(7)), (11, near(390)), (12, near()), (12, near()),
            (20, None), (21, ""), (22, "  \n "), (23, "a b"), (24, "a b"), (25, "a c"),
            (None, "lone text of six words here"), (30, " ".join(f"v{i}" for i in range(60_000)))]
    got = near_dedup.document_groups(_docs(spark, rows)).collect()
    cls = defaultdict(set)
    for r in got:
        cls[r.doc_id].add(r.class_id)
    assert len(got) == len(rows)
    assert cls[10] == cls[4] == cls[11] == cls[12] == {4}
    assert cls[23] == cls[24] == {23} and cls[25] == {25} and cls[30] == {30} and cls[None] == {None}
    kept = near_dedup.near_dedup(_docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "dig", "component", "node"]
    assert sorted(kept.toPandas().doc_id.dropna()) == [4, 20, 22, 23, 25, 30] and kept.count() == 7
    assert cls[20] == cls[21] == {20} and cls[22] == {22}
    assert near_dedup.document_groups(_docs(spark, rows).limit(0)).count() == 0


def test_repeated_rows_keep_one(spark):
    rows = [(5, "one two three four five six")] * 7 + [(6, "other words than those up there")]
    assert near_dedup.near_dedup(_docs(spark, rows)).count() == 2


def test_chain_of_links_is_one_group(spark):
    # each text differs from the next by little, the ends differ by much
    words = [f"c{i}" for i in range(300)]
    rows = [(k, " ".join(words[10 * k:10 * k + 200])) for k in range(10)]
    want = _groups(rows)
    got = {r.doc_id: r.class_id for r in near_dedup.document_groups(_docs(spark, rows)).collect()}
    assert got == want and set(got.values()) == {0}
