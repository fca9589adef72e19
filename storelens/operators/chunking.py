"""Sliding-window chunking and embedding attachment (R-01, R-02, J-08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.vectors import embed
from storelens.operators.sizing import spread

BLOCK = 16     # windows cut out of a text at once

META = ("document_filename", "document_title", "equipment_covered", "source_pdf_uri")


def chunk(df: DataFrame, text_col: str = "text", size: int = 500, step: int = 400,
          min_len: int = 30, meta=META) -> DataFrame:
    """R-01: windows of ``size`` characters starting at 1, 1+step, ... up to
    max(length, 1); ``chunk_index`` is the 0-based window number, kept
    with gaps after windows whose trimmed length is <= ``min_len`` are
    dropped. Whole texts are chunked; the explodes are narrow (no shuffle).
    A window is taken out of a block of ``BLOCK`` windows, as taking characters
    from a string reads it from its start."""
    t = F.col(text_col)
    keep = [c for c in meta if c in df.columns]
    last = F.greatest(F.length(t), F.lit(1)) - 1
    blocks = F.transform(F.sequence(F.lit(0), last, F.lit(BLOCK * step)),
                         lambda s: F.substring(t, s + 1, F.lit((BLOCK - 1) * step + size)))
    x = spread(df).select(*keep, last.alias("_last"), F.posexplode(blocks).alias("_block", "_t"))
    here = F.least(F.floor((F.col("_last") - F.col("_block") * BLOCK * step) / step), F.lit(BLOCK - 1)).cast("int")
    windows = F.transform(F.sequence(F.lit(0), here), lambda k: F.substring(F.col("_t"), k * step + 1, F.lit(size)))
    x = x.select(*keep, "_block", F.posexplode(windows).alias("_window", "chunk_content"))
    x = x.select(*keep, (F.col("_block").cast("long") * BLOCK + F.col("_window")).alias("chunk_index"), "chunk_content")
    return x.where(F.length(F.trim("chunk_content")) > min_len)


def manual_chunks(documents: DataFrame, **kw) -> DataFrame:
    """The ``chunks`` fixture: documents as service manuals, chunked."""
    d = documents.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("document_filename"),
        F.col("source").alias("document_title"), F.col("lang").alias("equipment_covered"),
        F.concat(F.lit("gs://manuals/doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("source_pdf_uri"),
        "text")
    return chunk(d, **kw)


def embed_chunks(chunks: DataFrame, vectorizer=None, dim: int = 256, embedder=None) -> DataFrame:
    """R-02 on chunks: the embedded text is ``[title]\\n content``. ``embedder`` is a function
    of (frame, text column) that adds ``embedding``; without it ``vectorizer`` is used."""
    txt = F.concat(F.lit("["), F.coalesce(F.col("document_title"), F.lit("")), F.lit("]\n"),
                   F.col("chunk_content"))
    return embedder(chunks, txt) if embedder else embed(chunks, txt, vectorizer, dim=dim)


def attach_embeddings(chunks: DataFrame, emb: DataFrame) -> DataFrame:
    """J-08: left join generated vectors onto chunks by (document, index);
    chunks without a vector keep a null embedding."""
    e = emb.select("document_filename", "chunk_index", "embedding")
    return chunks.join(e, ["document_filename", "chunk_index"], "left")
