"""Packing: ids, cuts and places against a plain re-computation."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.conftest import SF001

pytest.importorskip("storelens.llm")
from storelens.llm import packing, queries  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402


def _expected(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_path())
    out = []
    for doc_id, text in texts:
        ids = np.asarray(tok.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for p, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            out.append((doc_id, p, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=repr)


def _check(rows, texts):
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows),
                  key=repr) == _expected(texts)
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 4096
    return len(seqs)


def test_documents(spark):
    rows = queries.op3_best_fit_packing(spark, SF001).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    n = _check(rows, texts)
    assert n <= -(-sum(r.length for r in rows) // 4096) + 1


def test_cases(spark):
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("piece", T.StringType()), T.StructField("length", T.LongType())])
    texts = [(1, None), (2, ""), (3, "word " * 9000), (4, "a\tb c\n\nd  é <|endoftext|> it's"),
             (5, "same"), (5, "same"), (None, "no id"), (6, " \n \t ")]
    docs = spark.createDataFrame([(a, b, "x", 7) for a, b in texts], schema)
    _check(packing.pack_documents(docs, queries.tokenizer_path()).collect(), texts)
    assert packing.pack_documents(docs.limit(0), queries.tokenizer_path()).count() == 0


def test_plan_fills_exactly():
    counts = np.zeros(101, dtype=np.int64)
    counts[[60, 40, 50, 30, 20]] = [5, 5, 4, 3, 9]
    patterns = packing.plan(counts, 100)
    used = np.zeros(101, dtype=np.int64)
    for times, lengths in patterns:
        assert sum(lengths) <= 100
        for x in lengths:
            used[x] += times
    assert (used == counts).all()
    assert sum(t for t, _ in patterns) == 10          # 970 in sequences of 100


def test_plan_is_small_for_large_counts():
    rng = np.random.default_rng(5)
    counts = np.concatenate(([0], rng.integers(0, 10**9, 4096)))
    counts[2048:] //= 4                               # enough short pieces to fill the gaps of long ones
    patterns = packing.plan(counts)
    assert len(patterns) < 12000
    bound = -(-int((counts * np.arange(4097)).sum()) // 4096)
    assert sum(t for t, _ in patterns) < 1.001 * bound


def test_a_lower_case_word_is_remembered_as_one_string():
    """Both memories of a worker hold the same object; ids are the tokenizer's own."""
    from storelens.llm import queries
    from storelens.llm.packing import WordTokens
    tok = WordTokens(queries.tokenizer_path())
    text = "".join(["qu", "ixotic"]) + " Straße ǅungla ΣΑΣ naïve, x-1"
    raw = tok.batch([text])[0]
    assert np.frombuffer(raw, "<u4").tolist() == tok.tok.encode(text, add_special_tokens=False).ids
    word, piece = (next(k for k in held if k == "quixotic") for held in (tok.words, tok.pieces))
    assert word is piece


def test_remembered_words_are_bounded_and_ids_stay_right(monkeypatch):
    import random

    import public_tokenizers
    from tokenizers import Tokenizer
    from storelens.llm import packing as pk
    for limit in ("CACHE_WORDS", "CACHE_PIECES"):
        monkeypatch.setattr(pk, limit, 200, raising=False)
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, plain, rnd = pk.WordTokens(path), Tokenizer.from_file(path), random.Random(7)
    for _ in range(30):
        text = " ".join(["the", "", "Quixotic,", *("".join(rnd.choices("abcdeé1-", k=rnd.randint(1, 9))) for _ in range(50)), "the"])
        got = np.frombuffer(tok.batch([text])[0], dtype="<u4").tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids
    # 30 texts of some 50 new words: two halves, each full when one text more has come
    for held in (tok.words, tok.pieces):
        assert len(held.new) + len(held.old) <= 2 * (100 + 160)
    tok.batch(["x" * 5000])
    tok.batch(["y"])
    tok.batch(["z"])
    assert "x" * 5000 not in tok.words.new and "x" * 5000 in tok.words.old


def test_other_operators_drop_what_the_tokenizer_remembers():
    # a reused Python worker kept it for good, beside all that later stages need
    import pyarrow as pa

    from storelens.llm import common, language_id, near_dedup
    path = queries.tokenizer_path()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some words of a text"])], names=["doc_id", "text"])
    for other in (language_id._packed, near_dedup._deal(np.zeros(0, np.uint64), 1)):
        tok = packing.word_tokens(path)
        tok.batch(["some words"])
        assert packing.word_tokens(path) is tok and common._KEPT
        list(other(iter([batch])))
        assert not common._KEPT
