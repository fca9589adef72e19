"""Vector helpers: the default hashed-n-gram embedder and one any SQL engine can repeat (R-02)."""

from __future__ import annotations

import hashlib

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, NGram, Normalizer, RegexTokenizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hashed_embedder(dim: int = 256, text_col: str = "embed_text", out_col: str = "embedding") -> Pipeline:
    """Default deterministic vectoriser: lower-case word unigrams and
    bigrams, hashed into ``dim`` buckets, L2-normalised. All stages are
    JVM Spark ML transformers (no Python per row)."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
        NGram(n=2, inputCol="_tok", outputCol="_bi"),
        SQLTransformer(statement="SELECT *, concat(_tok, _bi) AS _terms FROM __THIS__"),
        HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=dim),
        Normalizer(inputCol="_tf", outputCol="_unit", p=2.0),
    ])


def embed(df: DataFrame, text: Column | str, vectorizer=None, out_col: str = "embedding",
          dim: int = 256) -> DataFrame:
    """R-02: add ``out_col`` = vector of ``text`` as ``array<double>``.

    ``vectorizer`` may be any Spark ML ``Pipeline``/``Transformer`` that
    reads ``embed_text`` and writes ``_unit`` (a model served inside the
    tasks, for example); the default is ``hashed_embedder``. The hashing
    stages are stateless, so fitting reads no data. Tokenising is the
    CPU-heavy part, so an input with fewer partitions than cores is
    spread first (well-partitioned inputs pass through)."""
    from storelens.operators.sizing import spread
    x = spread(df).withColumn("embed_text", F.coalesce(F.col(text) if isinstance(text, str) else text,
                                                       F.lit("")))
    model = (vectorizer or hashed_embedder(dim)).fit(x.limit(0))
    y = model.transform(x)
    return (y.withColumn(out_col, vector_to_array("_unit"))
             .drop("embed_text", "_tok", "_bi", "_terms", "_tf", "_unit"))


def trigram_embedder(dim: int = 2048, text_col: str = "embed_text") -> Pipeline:
    """Character-trigram vectoriser for short names (entity resolution)."""
    return Pipeline(stages=[
        SQLTransformer(statement=f"SELECT *, split(concat('  ', lower({text_col}), ' '), '') AS _tok FROM __THIS__"),
        NGram(n=3, inputCol="_tok", outputCol="_bi"),
        SQLTransformer(statement="SELECT *, _bi AS _terms FROM __THIS__"),
        HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=dim),
        Normalizer(inputCol="_tf", outputCol="_unit", p=2.0),
    ])


def md5_embed(df: DataFrame, text: Column | str, out_col: str = "embedding", dim: int = 64,
              grams: int | None = None) -> DataFrame:
    """R-02 on functions that any engine has: ``out_col`` = counts of the text's tokens in ``dim``
    places, scaled to length 1 (all zero for a text without tokens). A token's place is the
    first 32 bits of its MD5 modulo ``dim``, so any engine gets the same vector. Tokens are
    lower-case alphanumeric words, or with ``grams`` the character n-grams of the text
    between blanks."""
    t = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    if grams is None:
        tokens = F.filter(F.split(t, "[^a-z0-9]+"), lambda w: w != "")
    else:
        padded = F.concat(F.lit(" "), t, F.lit(" "))
        tokens = F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (grams - 1), F.lit(1))),
                             lambda i: F.substring(padded, i, F.lit(grams)))
    return (df.withColumn("_tokens", tokens)
            .withColumn(out_col, _unit_counts(dim)(F.col("_tokens"))).drop("_tokens"))


def _unit_counts(dim: int):
    """An Arrow function: how often the tokens' places occur, scaled to length 1 (all zero without any). The
    tokens of a batch are hashed once each."""
    def place(word: bytes) -> int:
        return int(hashlib.md5(word).hexdigest()[:8], 16) % dim

    def run(tokens: pa.Array) -> pa.Array:
        n = len(tokens)
        coded = tokens.flatten().dictionary_encode()
        places = np.array([place(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], dtype=np.int64)
        rows = np.repeat(np.arange(n, dtype=np.int64), pc.list_value_length(tokens).to_numpy())
        counts = np.bincount(rows * dim + places[coded.indices.to_numpy()], minlength=n * dim).reshape(n, dim).astype(np.float64)
        length = np.sqrt((counts * counts).sum(axis=1))
        counts[length > 0] /= length[length > 0, None]
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dim), pa.array(counts.ravel()))
    return F.arrow_udf(run, "array<double>")
