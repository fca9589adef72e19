"""Mixing and url filters: DuckDB twins, plain versions, defined cases."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF01
from tests.oracle import compare

pytest.importorskip("storelens.llm")
from storelens.llm import mixing, queries, url_filter  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_oracle(spark, duck01, name):
    assert compare(queries.QUERIES[name](spark, SF01), duck01, queries.ORACLES[name]) > 100


# ------------------------------------------------------------------- mixing
def _fill(sizes, weights, budget):
    """Excess reshared by weight until no source is above twice its size."""
    capped, target = set(), {}
    while True:
        left = budget - sum(2 * sizes[s] for s in capped)
        w = sum(weights[s] for s in sizes if s not in capped)
        target = {s: 2 * sizes[s] if s in capped else left * weights[s] / w for s in sizes}
        over = {s for s in sizes if target[s] > 2 * sizes[s]} - capped
        if not over:
            return target
        capped |= over


def _docs(spark, rows):
    prepare(spark)
    schema = T.StructType([T.StructField(c, t) for c, t in (
        ("doc_id", T.LongType()), ("text", T.StringType()), ("source", T.StringType()),
        ("size", T.StringType()), ("_range", T.LongType()))])
    return spark.createDataFrame([(*r, "x", 3) for r in rows], schema)


def test_targets_and_takes(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 60)), rnd.choice(["a", "Z", "é", None, "b", "\U0001F600"])) for i in range(900)]
    rows += [(9000, " x  y", "b"), (9001, None, "a"), (9002, "", "empty"), (9003, "v " * 50_000, "b"),
             (9004, "same words", "Z"), (9004, "same words", "Z"), (None, "no id", "a")]
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(re.findall(mixing.WORD, t or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want = _fill(sizes, weights, 1.5 * sum(sizes.values()))
    df = _docs(spark, rows)
    got = mixing.mix_sizes(df).collect()
    assert len(got) == len(rows)
    src, taken = {r[0]: r[2] for r in rows}, Counter()
    for r in got:
        assert r.size == r.taken == 0 or 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(want[src[r.doc_id]])
        assert r.source_size == sizes[src[r.doc_id]]
        taken[src[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sizes(df).collect()))
    assert mixing.mix_sizes(df.limit(0)).count() == 0

    out = mixing.mix(df)
    assert out.columns == df.columns
    times = Counter(r.doc_id for r in out.collect())
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    for d, rs in by_id.items():
        lo = sum(r.taken // r.size for r in rs if r.size)
        assert lo <= times[d] <= lo + len(rs)


# --------------------------------------------------------------------- urls
def test_cascade_is_exact(spark):
    prepare(spark)
    keys = spark.range(20_000).select(F.concat(F.lit("host"), F.col("id").cast("string")).alias("key"))
    listed = keys.where(F.expr("pmod(hash(key), 9) = 0"))
    levels = url_filter.cascade(keys, listed)
    assert len(levels) > 2
    got = {r.key for r in keys.where(url_filter.is_listed(F.col("key"), levels)).collect()}
    assert got == {r.key for r in listed.collect()}


def _brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group(0)
    path = re.match(r"[^?#]*", rest[len(host):]).group(0)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


@pytest.mark.parametrize("bits", [1 << 26, 0])
def test_url_cases(spark, monkeypatch, bits):
    prepare(spark)
    monkeypatch.setattr(url_filter, "MAX_BITS", bits)
    urls = ["http://a.Example.ORG/es/x?q#f", "https://example.org/en/12", "http://notexample.org/es/", "http://x.com/fr/1",
            "http://com/de/2", "http://xcom/de/2", "http://y.net/z", "http://y.net/z?k=1", "http://y.net", "http://org", "org/",
            "", None, "://", "http://É.net/Ä#://", "http://y.net/z\nmore", "http://y.net/" + "p" * 70_000, "http://b.net/q", "http://b.net/q"]
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("host", T.LongType()), T.StructField("key", T.LongType())])
    pages = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(urls)] + [(None, "http://b.net/q", 1, 2)], schema)
    listed = spark.createDataFrame([("y.net/z",), ("b.net/q",), ("absent.net/",), (None,), ("",), ("example.org/en/12",)], "key string")
    got = url_filter.filter_urls(pages, listed, queries.URL_RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path) == _brute_url(r.url)
        fits = [(h + p, v) for v, h, p in queries.URL_RULES
                if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        best = max(fits, key=lambda x: len(x[0]), default=(None, None))
        own = "block" if r.host + r.path in ("y.net/z", "b.net/q", "example.org/en/12") else "allow"
        assert (r.rule, r.verdict) == (best[0], best[1] or own)
        assert r.key == 2
    assert url_filter.filter_urls(pages.limit(0), listed, queries.URL_RULES).count() == 0
