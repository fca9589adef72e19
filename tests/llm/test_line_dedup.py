"""Line dedup: lines, alignment and whole results against plain versions."""

import hashlib
import math
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tests.conftest import SF001, SF01

pytest.importorskip("storelens.llm")
from storelens.llm import common, line_dedup, queries  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402


def test_line_hashes_match_split(monkeypatch):
    monkeypatch.setattr(common, "SEGMENT", 48)
    rnd = random.Random(2)
    known = {}
    for _ in range(300):
        texts = ["\n".join(rnd.choice(["", "a", "bb é", "c" * rnd.choice([10, 60, 130])]) for _ in range(rnd.randint(1, 9)))
                 for _ in range(rnd.randint(1, 7))]
        h, off = line_dedup.line_hashes(*common.text_buffer(pa.array(texts)))
        for i, t in enumerate(texts):
            got = h[off[i]:off[i + 1]]
            assert len(got) == len(t.split("\n"))
            for x, y in zip(t.split("\n"), got):
                if len(x.encode()) <= 48:
                    assert known.setdefault(x, y) == y
                assert (y == 0) == (x == "")


def _lis(js):
    best = [1] * len(js)
    for k in range(len(js)):
        best[k] = 1 + max((best[p] for p in range(k) if js[p] < js[k]), default=0)
    return max(best, default=0)


def test_alignment_is_common_and_ordered():
    rnd = random.Random(4)
    for _ in range(400):
        a = [rnd.randint(0, 14) for _ in range(rnd.randint(0, 25))]
        b = [rnd.randint(0, 14) for _ in range(rnd.randint(0, 25))]
        got = line_dedup.aligned(a, b)
        assert got == sorted(set(got)) and all(a[i] for i in got)
        it = iter(b)                                     # the aligned lines are a subsequence of b
        assert all(any(a[i] == y for y in it) for i in got)
    for _ in range(100):                                 # all lines unique: as long as the longest common run
        a, b = rnd.sample(range(1, 40), 20), rnd.sample(range(1, 40), 20)
        common_j = [b.index(x) for x in a if x in b]
        assert len(line_dedup.aligned(a, b)) >= _lis(common_j) * 0.6
    same = [5, 0, 6, 7]
    assert line_dedup.aligned(same, same) == [0, 2, 3]


def test_cases(spark):
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lines", T.StringType()), T.StructField("first", T.LongType())])
    block = "alpha\nbeta\n\ngamma"
    rows = [(7, "x1\n" + block + "\nx2"), (3, block), (9, None), (10, ""), (11, "own line"), (12, "own line"), (12, "own line"),
            (None, "beta\ngamma\nnew"), (13, "\n\n"), (14, "long " * 500_000 + "\nend")]
    make = lambda rs: spark.createDataFrame([(a, b, "l", 1) for a, b in rs], schema)
    out = line_dedup.line_dedup(make(rows))
    assert out.columns == ["doc_id", "text", "lines", "first", "_gone"]
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r.text)
    assert got[3] == [block] and got[7] == ["x1\n\nx2"] and got[None] == ["new"]
    assert got[9] == [None] and got[10] == [""] and got[11] == ["own line"] and got[12] == ["", ""]
    assert got[13] == ["\n\n"] and got[14] == ["long " * 500_000 + "\nend"]
    assert line_dedup.line_dedup(make([])).count() == 0


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y and x else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_repeated_lines_between_differing_ends_are_aligned():
    assert line_dedup.aligned([1, 7, 8, 7, 8, 2], [3, 7, 8, 7, 8, 4]) == [1, 2, 3, 4]
    assert line_dedup.aligned([1, 7, 0, 7, 2], [3, 7, 0, 7, 7, 4]) == [1, 3]
    rnd = random.Random(8)
    for _ in range(300):
        a, b = ([rnd.randint(0, 5) for _ in range(rnd.randint(0, 40))] for _ in range(2))
        got = line_dedup._common(a, b)
        assert got == sorted(set(got)) and all(a[i] for i in got) and len(got) == _lcs(a, b)
        it = iter(b)
        assert all(any(a[i] == y for y in it) for i in got)
    a, b = ([n, *[5, 6, 6] * 2000, n + 1] for n in (10, 20))
    assert len(line_dedup.aligned(a, b)) == 6000


def _overlaps(rows):
    """rows: (id, text), ids distinct -> {id: earlier documents it overlaps}, every pair compared."""
    docs = {d: t.split("\n") for d, t in rows if t}
    holders = defaultdict(list)
    for d in sorted(docs):
        for x in set(docs[d]) - {""}:
            holders[x].append(d)
    rare = defaultdict(float)
    for x, ds in holders.items():
        for k, d in enumerate(ds):
            for e in ds[:k]:
                rare[d, e] += math.log(len(docs) / len(ds))
    least = min(math.log(100), math.log(max(len(docs), 3) / 2))
    out, lists = defaultdict(set), {}
    for (d, e), r in rare.items():
        if r >= least - 1e-9:
            out[d].add(e)
    for d in sorted(docs):
        whole = tuple(x for x in docs[d] if x)
        if whole and lists.setdefault(whole, d) != d:
            out[d].add(lists[whole])
    return docs, out


def _matched(a, b):
    """Positions in a of the lines of a longest common subsequence, by the plain table."""
    lo = 0
    out = []
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        out.append(lo)
        lo += 1
    a2, b2 = a[lo:], b[lo:]
    keep = set(b2) - {""}
    at = [i for i, x in enumerate(a2) if x in keep]
    b2 = [x for x in b2 if x in set(a2)]
    best = [[0] * (len(b2) + 1) for _ in range(len(at) + 1)]
    for i, x in enumerate(at):
        for j, y in enumerate(b2):
            best[i + 1][j + 1] = best[i][j] + 1 if a2[x] == y else max(best[i][j + 1], best[i + 1][j])
    i, j = len(at), len(b2)
    while i and j:
        if a2[at[i - 1]] == b2[j - 1] and best[i][j] == best[i - 1][j - 1] + 1:
            out.append(lo + at[i - 1])
            i, j = i - 1, j - 1
        elif best[i - 1][j] == best[i][j]:
            i -= 1
        else:
            j -= 1
    return {i for i in out if a[i]}


def check_against_all_pairs(rows, gone):
    """``gone``: {id: positions deleted}. Nearly all that aligning every overlapping pair deletes goes, and
    nothing that no overlapping earlier document holds."""
    docs, overlaps = _overlaps(rows)
    want = {d: set().union(*(_matched(docs[d], docs[e]) for e in es)) for d, es in overlaps.items()}
    total = sum(map(len, want.values()))
    # equally long alignments may take different lines, so lines are counted, not compared by place
    found = sum(min(len(want[d]), len(gone.get(d, ()))) for d in want)
    assert found >= 0.98 * total, (found, total)
    for d, at in gone.items():
        held_there = set().union(*(docs[e] for e in overlaps[d])) if at else set()
        assert {docs[d][i] for i in at} <= held_there
    assert sum(max(0, len(at) - len(want.get(d, ()))) for d, at in gone.items()) <= 0.01 * total
    return total


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_documents_against_every_pair(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.op9_line_dedup(spark, sf).collect()}
    assert len(got) == len(rows)
    assert check_against_all_pairs(rows, {d: set(r.lines_deleted) for d, r in got.items()}) > 150
    seen = set()
    for d, t in sorted(rows):
        lines = (t or "").split("\n")
        assert {lines[i] for i in got[d].lines_deleted} <= seen      # every line stays somewhere
        seen |= set(lines)
        left = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in set(got[d].lines_deleted))
        assert got[d].text_sha256 == (None if t is None else hashlib.sha256(left.encode()).hexdigest())
        assert got[d].lines_deleted == sorted(set(got[d].lines_deleted))


def test_scattered_common_lines_stay(spark):
    """Ten common lines a document, no two documents with more than one in common: nothing goes, though
    each document's lines are rare enough in sum."""
    prepare(spark)
    rows = [(17 * a + b, "\n".join(f"line {k} {(a + k * b) % 17}" for k in range(10))) for a in range(17) for b in range(17)]
    out = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted(rows)
    _, overlaps = _overlaps(rows)
    assert not overlaps


def test_repeated_rows_change_nothing_elsewhere(spark):
    prepare(spark)
    rows = [(i, f"own {i}\nshared {i // 3}\nend {i}") for i in range(300)]
    make = lambda rs: spark.createDataFrame(rs, "doc_id long, text string")
    once = {(r.doc_id, r.text) for r in line_dedup.line_dedup(make(rows)).collect()}
    again = [(r.doc_id, r.text) for r in line_dedup.line_dedup(make(rows + [rows[7]] * 400)).collect()]
    assert set(again) == once and len(again) == 700


def test_clashing_names_pass_through(spark):
    prepare(spark)
    names = ["_gone", "_dig", "_id", "_own", "id", "dig", "gone", "mask", "row", "own_id", "me", "line"]
    rows = [(i, "a\nb\nc", *range(len(names))) for i in range(3)]
    df = spark.createDataFrame(rows, ["doc_id", "text", *names])
    out = line_dedup.line_dedup(df, gone_col="deleted")
    assert out.columns == ["doc_id", "text", *names, "deleted"]
    assert sorted((tuple(r)[0], *tuple(r)[2:-1]) for r in out.collect()) == [(i, *range(len(names))) for i in range(3)]
    assert line_dedup.line_dedup(df).columns == ["doc_id", "text", *names[1:], "_gone"]


def test_a_first_holder_of_many_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MEMBERS", 8)
    prepare(spark)
    block = "\n".join(f"license line {k}" for k in range(30))
    rows = [(i, f"{block}\nown {i}" if i % 3 == 0 else f"own {i}") for i in range(600)]
    out = {r.doc_id: r.text for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: t if i == 0 else f"own {i}" for i, t in rows}


@pytest.mark.parametrize("text", ["one paragraph", "first\n\nsecond\nfirst", "a\nb\nc\nd"])
def test_copies_that_fill_a_third_of_the_rows(spark, text):
    prepare(spark)
    rows = [(i, text if i % 3 == 1 else f"own {i}\nbody {i}") for i in range(600)]
    rows[3] = (3, text.split("\n")[0] + "\nits own")     # holds a line, but has more: it stays whole
    rows[0] = (0, "first")                               # the first holder of a line has it once only
    out = {r.doc_id: r.text for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[3] == rows[3][1] and out[0] == "first"
    assert all((out[i] or "").strip() == "" for i in range(4, 600, 3))
    assert all(out[i] == rows[i][1] for i in range(600) if i % 3 != 1)
