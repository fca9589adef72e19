"""The corpus pipeline: every stage on its own input against a plain version."""

from collections import Counter, defaultdict

import pytest

from tests.conftest import SF001

pytest.importorskip("storelens.llm")
import corpus_pipeline  # noqa: E402
from storelens.llm import common, language_id, line_dedup, mixing, queries  # noqa: E402
from tests.llm.test_line_dedup import check_against_all_pairs  # noqa: E402
from tests.llm.test_near_dedup import _groups as plain_groups  # noqa: E402
from tests.llm.test_packing import _check as check_packing  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark):
    common.prepare(spark)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(common.held(stage(spark, out[-1], SF001), f"test-{name.replace(' ', '-')}"))
    return out


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_columns_and_order(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "MinHash near-dedup", "source mixing",
                                                     "best-fit packing"]
    for df in steps[1:-1]:
        assert df.schema == steps[0].schema


def test_language_stage_drops_texts_without_letters_only(spark, steps):
    before, after = _rows(steps[0]), {d for d, _ in _rows(steps[1])}
    for d, t in before:
        assert (d in after) == any(c.isalpha() for c in t or "")
    extra = spark.createDataFrame([(10**6, "12 + 34 = 46 !!", None, "src0", 15), (10**6 + 1, None, None, "src0", 0)], steps[0].schema)
    kept = corpus_pipeline.known_language(spark, steps[0].unionByName(extra), SF001)
    assert {r.doc_id for r in kept.collect()} == after


def test_line_stage(spark, steps):
    before, after = _rows(steps[1]), dict(_rows(steps[2]))
    deduped = {r.doc_id: r for r in line_dedup.line_dedup(steps[1]).collect()}
    check_against_all_pairs(before, {d: set(r._gone) for d, r in deduped.items()})
    assert after == {d: deduped[d].text for d, t in before if deduped[d].text == t or deduped[d].text.strip()}
    assert len(after) < len(before)
    assert all(r.n_chars == len(r.text) for r in steps[2].collect() if r.text != dict(before)[r.doc_id])


def test_near_duplicate_stage(steps):
    before, after = _rows(steps[2]), _rows(steps[3])
    classes = plain_groups(before)
    assert sorted(d for d, _ in after) == sorted({c if c is not None else d for d, c in classes.items()})
    assert set(after) <= set(before)


def test_mixing_stage(steps):
    took = {r.doc_id: r for r in mixing.mix_sizes(steps[3]).collect()}
    times = Counter(r.doc_id for r in steps[4].collect())
    for d, r in took.items():
        assert abs(times[d] * r.size - r.taken) <= r.size / 2
    assert 1.3 < sum(times.values()) / len(took) < 1.7
    by_id = dict(_rows(steps[3]))
    assert all(by_id[d] == t for d, t in _rows(steps[4]))


def test_packing_stage(steps):
    rows = steps[5].collect()
    n = check_packing(rows, _rows(steps[4]))
    assert n <= -(-sum(r.length for r in rows) // 4096) + 1


def test_run_and_scores(spark, steps):
    whole = corpus_pipeline.run(spark, SF001)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, steps[5].select(*key).collect()))
    model = language_id.train(steps[0].where(~queries.held_out()))
    low = defaultdict(list)
    for r in language_id.identify(steps[0], model).collect():
        low[r.lang_pred].append(r.lang_score)
    assert all(min(v) > corpus_pipeline.LEAST_SCORE for k, v in low.items() if k != "und")
