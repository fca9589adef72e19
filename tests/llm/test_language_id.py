"""Language identification: held-out accuracy, presence rows, defined cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.conftest import SF01

pytest.importorskip("storelens.llm")
from storelens.llm import language_id as lid  # noqa: E402
from storelens.llm import queries  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op1_language_id(spark, SF01).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert set(got) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert all(0 <= r.score <= 1 for r in got.values())
    out = [d for d, r in got.items() if r.held_out and truth[d] is not None]
    assert len(out) > 100
    assert np.mean([got[d].lang_pred == truth[d] for d in out]) >= 0.97


def test_presence_ignores_case_order_and_piece_borders(monkeypatch):
    text = "Über die Straße, 12 cafés!  été\n" * 40 + "the end"
    whole, has = lid.presence([text, text.upper().replace("SS", "ß"), None, "", "12 ?!"])
    assert has.tolist() == [True, True, False, False, False]
    assert (whole[0] == whole[1]).all()
    monkeypatch.setattr(lid, "PIECE", 7)
    pieces, _ = lid.presence([text])
    assert (pieces[0] == whole[0]).all()


def _frame(spark, rows):
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("lang_pred", T.LongType()),
                           T.StructField("h", T.LongType())])
    return spark.createDataFrame([(*r, 1, 2) for r in rows], schema)


def test_cases(spark):
    en, de = "the quick brown fox and the lazy dog ", "der schnelle braune Fuchs und der faule Hund "
    rows = [(i, en + f"x{i}", "en") for i in range(30)] + [(100 + i, de + f"x{i}", "de") for i in range(30)]
    rows += [(1, en, "en")] * 500                          # repeated rows do not outweigh the others
    model = lid.train(_frame(spark, rows + [(7, None, "fr"), (8, "text", None)]))
    assert model.languages == ["de", "en"]
    ask = _frame(spark, [(1, "und der Hund", None), (2, None, None), (3, "", None), (4, "42 !!", None),
                         (None, "and the dog", None), (None, "and the dog", None), (6, "fox and the " * 200_000, None)])
    got = lid.identify(ask, model)
    assert got.columns == ["doc_id", "text", "lang", "h", "lang_pred", "lang_score"]
    out = sorted(((r.doc_id or 0, r.lang_pred) for r in got.collect()))
    assert out == [(0, "en"), (0, "en"), (1, "de"), (2, "und"), (3, "und"), (4, "und"), (6, "en")]
    empty = lid.train(_frame(spark, []))
    assert empty.languages == []
    assert {r.lang_pred for r in lid.identify(ask, empty).collect()} == {"und"}
    assert lid.identify(ask.limit(0), model).count() == 0


def test_copies_do_not_push_a_language_out(spark):
    words = {"aa": "the quick brown fox", "bb": "der schnelle Fuchs", "cc": "le renard brun", "dd": "el zorro rojo"}
    rows = [(i, f"{w} {'x' * i}", lang) for lang, w in words.items() for i in range(5)]
    rows += [(9, words["bb"], "bb")] * 20_000 + [(9, "12 !", "cc")] * 20_000 + [(9, f"{i}", "dd") for i in range(5_000)]
    rows += [(9, "42", "ee")]                              # no usable text
    model = lid.train(_frame(spark, rows), sample=16)
    assert model.languages == sorted(words)
    many = [(i, f"{chr(97 + i % 26) * 3}{chr(97 + i // 26)} {k}", f"l{i:03d}") for i in range(60) for k in "abcdefgh"]
    assert lid.train(_frame(spark, many), sample=60).languages == [f"l{i:03d}" for i in range(60)]
