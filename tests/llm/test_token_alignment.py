"""Token alignment against a version that walks over every byte."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T

from tests.conftest import SF001

pytest.importorskip("storelens.llm")
from storelens.llm import queries, token_alignment as ta  # noqa: E402
from storelens.llm.common import prepare  # noqa: E402

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def _plain_tokens(text):
    """(ids, byte spans) of both sides from the two libraries alone, or None."""
    import sentencepiece
    from tokenizers import Tokenizer
    if "tok" not in _plain_tokens.__dict__:
        _plain_tokens.tok = Tokenizer.from_file(PATHS[0])
        _plain_tokens.tok.encode_special_tokens = True
        _plain_tokens.sp = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        _plain_tokens.byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}
    tok, sp, byte = _plain_tokens.tok, _plain_tokens.sp, _plain_tokens.byte
    want = (" " + (text or "")).encode()
    a = tok.encode(" " + (text or ""), add_special_tokens=False).ids
    b = sp.encode(text or "")
    raw_a = [bytes(byte[c] for c in tok.id_to_token(i)) for i in a]
    raw_b = []
    for i in b:
        p = sp.id_to_piece(i)
        raw_b.append(bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode())
    if not text or b"".join(raw_a) != want or b"".join(raw_b) != want:
        return None
    return a, raw_a, b, raw_b


def _brute(rows):
    docs, count = [], Counter()
    for d, text in rows:
        tokens = _plain_tokens(text)
        if tokens is None:
            docs.append((d, 0, 0, 0, Counter(), ""))
            continue
        a, raw_a, b, raw_b = tokens
        owner_a = [k for k, r in enumerate(raw_a) for _ in r]
        owner_b = [k for k, r in enumerate(raw_b) for _ in r]
        links = Counter((a[i], b[j]) for i, j in set(zip(owner_a, owner_b)))
        groups, ga, gb = [], [], []
        for at in range(len(owner_a)):
            last_a = at + 1 == len(owner_a) or owner_a[at + 1] != owner_a[at]
            last_b = at + 1 == len(owner_b) or owner_b[at + 1] != owner_b[at]
            ga += [a[owner_a[at]]] if last_a else []
            gb += [b[owner_b[at]]] if last_b else []
            if last_a and last_b:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                ga, gb = [], []
        docs.append((d, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        count += links
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(d, na, nb, g, sum(links.values()), sum(n for p, n in links.items() if count[p] == top[p[1]]),
             sum(n * count[p] for p, n in links.items()), sha) for d, na, nb, g, links, sha in docs]


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("spread", [False, True])
def test_documents_against_brute_force(spark, spread):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    if not spread:
        got = queries.op13_token_alignment(spark, SF001)
    else:
        prepare(spark)                                   # every task closes blocks of its own
        got = ta.aligned_documents(spark.read.parquet(f"{SF001}/documents.parquet").repartition(23), *PATHS)
    assert got.columns == COLS
    assert sorted(map(tuple, got.collect())) == sorted(_brute(rows))


def test_cases(spark):
    prepare(spark)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("block", T.StringType()), T.StructField("pairs", T.LongType())])
    long = "word été 日本 " * 60_000
    rows = [(1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "<|endoftext|><s></s><unk>"), (6, "<0x41> x"), (7, "a\x00b﻿\r\n\t "),
            (8, "é́ ﬁ　𝔘😀"), (9, "same text"), (9, "same text"), (None, "same text"), (10, "\n\n\n"), (11, long)]
    make = lambda rs: spark.createDataFrame([(a, b, "l", 1) for a, b in rs], schema)
    got = ta.aligned_documents(make(rows), *PATHS)
    assert got.columns == COLS
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(_brute(rows), key=key)
    assert ta.aligned_documents(make([]), *PATHS).count() == 0


def test_ranks_give_the_ids_of_the_tokenizer():
    own = ta.ByteLevel(PATHS[0])
    rnd = random.Random(5)
    draw = [lambda: rnd.randint(0, 0x24F), lambda: 32, lambda: 10, lambda: 39, lambda: rnd.randint(48, 122),
            lambda: rnd.randint(0x250, 0x2FFF), lambda: rnd.randint(0x3000, 0xD7FF), lambda: rnd.randint(0x10000, 0x1FFFF)]
    for k in range(6000):
        some = draw[:3 + k % 6]
        text = "".join(chr(rnd.choice(some)()) for _ in range(rnd.randint(1, 40)))
        assert own.encode(text).tolist() == own.tok.encode(text, add_special_tokens=False).ids
    assert own.encode("x" * 50_000).tolist() == own.tok.encode("x" * 50_000, add_special_tokens=False).ids
    assert b"".join(own.bytes[i] for i in own.encode(" é日")) == " é日".encode()


def test_links_of_random_cuts():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        n = int(rnd.integers(1, 40))
        a, b = (np.append(np.flatnonzero(rnd.random(n - 1) < p) + 1, n) if n > 1 else np.array([1]) for p in rnd.random(2))
        stop_a, stop_b = map(np.array, ta.shared_ends(a.tolist(), b.tolist()))
        assert (a[stop_a - 1] == b[stop_b - 1]).all() and set(a[stop_a - 1]) == set(a) & set(b)
        left, right = ta.slice_links(a, b, stop_a, stop_b)
        at = np.arange(n)
        want = set(zip(np.searchsorted(a, at, "right").tolist(), np.searchsorted(b, at, "right").tolist()))
        assert len(left) == len(want) and set(zip(left.tolist(), right.tolist())) == want
