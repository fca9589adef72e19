"""The set-similarity join against every pair, and how few pairs it compares."""

import math
import random

import pytest

from storelens.operators import name_match as nm


def _set(name):
    x = f" {name} "
    return {x[i:i + 3] for i in range(max(1, len(x) - 2))}


@pytest.mark.parametrize("min_score", [0.5, 0.7, 0.85, 1.0])
def test_pairs_against_every_pair(spark, min_score):
    rnd = random.Random(3)
    words = ["north", "market", "store", "mall", "plaza", "lake", "hill", "st", "a", "of", "12", "117", "5"]
    names = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 5))) for _ in range(220)]
    asked = [n[:k] + n[k + 1:] if k < len(n) else n for n in names for k in [rnd.randint(0, 20)]][:150] + ["", "?!", None, names[0], names[0]]
    q = spark.createDataFrame(list(enumerate(asked)), "qid long, q string")
    d = spark.createDataFrame(list(enumerate(names)), "eid long, e string")
    got = {(r.query_id, r.entity_id): r.score for r in nm.similar_names(q, d, "qid", "q", "eid", "e", min_score).collect()}
    want = {}
    for i, x in enumerate(asked):
        x = " ".join((x or "").replace("?!", "").split())
        for j, y in enumerate(names):
            if x:
                a, b = _set(x), _set(y)
                s = len(a & b) / math.sqrt(len(a) * len(b))
                if s >= min_score - 1e-9:
                    want[i, j] = math.floor(s * 10_000 + 0.5) / 10_000
    assert got == want and len(want) > 40


def test_ranks_and_limit(spark):
    q = spark.createDataFrame([(1, "lake mall")], "qid long, q string")
    d = spark.createDataFrame([(5, "Lake-Mall"), (3, "LAKE mall"), (9, "lake mall 7"), (8, "hill")], "eid long, e string")
    got = [(r.entity_id, r.rank) for r in nm.similar_names(q, d, "qid", "q", "eid", "e", 0.7).orderBy("rank").collect()]
    assert got == [(3, 1), (5, 2), (9, 3)]
    assert nm.similar_names(q, d, "qid", "q", "eid", "e", 0.7, k=1).count() == 1
    assert nm.similar_names(q.limit(0), d, "qid", "q", "eid", "e").count() == 0
    with pytest.raises(ValueError):
        nm.similar_names(q, d, "qid", "q", "eid", "e", 0.0)


def test_few_pairs_are_compared(spark):
    rnd = random.Random(4)
    names = [f"{rnd.choice(['market', 'store', 'plaza'])} {rnd.randint(0, 99999)} {rnd.choice(['north', 'south', 'lake'])}" for _ in range(1500)]
    d = spark.createDataFrame(list(enumerate(names)), "id long, text string")
    sets = nm._sets(d, "id", "text").select("id", "set")
    assert nm.candidate_pairs(sets, sets, 0.8).count() < 0.05 * 1500 * 1500


def test_names_are_not_broadcast(spark):
    """A table with a row for each name would be built whole in the driver."""
    d = spark.createDataFrame([(i, f"store {i} north") for i in range(300)], "id long, text string")
    df = nm.similar_names(d, d, "id", "text", "id", "text", 0.8)
    assert df.count() >= 300
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("SortMergeJoin [a_id") >= 2 and plan.count("SortMergeJoin [b_id") >= 2


def test_numbered_names_are_compared_in_many_tasks_once_each(spark):
    """Names that differ in digits share frequent trigrams only; few bytes of them make many pairs."""
    d = spark.createDataFrame([(i, f"Customer#{i:09d}") for i in range(800, 1700)], "id long, text string")
    sets = nm._sets(d, "id", "text").select("id", "set")
    pairs = nm.candidate_pairs(sets, sets, 0.8)
    assert pairs.rdd.getNumPartitions() >= 8
    rows = pairs.collect()
    names = {i: _set(f"customer {i}") for i in range(800, 1700)}
    want = {(i, j) for i, x in names.items() for j, y in names.items() if len(x & y) / math.sqrt(len(x) * len(y)) >= 0.8 - 1e-9}
    assert len(rows) == len(set(rows)) < 2 * len(want) and want <= {tuple(r) for r in rows}
