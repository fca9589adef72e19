"""Language identification with a string kernel.

Two texts are as alike as the n-grams of one to three characters they
both hold (presence, not counts; n-grams are hashed to ``DIM`` places,
the kernel is their cosine). The Nystroem method maps a text to its
kernel values with ``LANDMARKS`` training texts, and ridge regression on that map
scores each language against the rest. Spark draws the training
texts, turns whole texts into presence rows and scores them; the scores
of a batch are two matrix products (rows by landmarks, kernel values by weights).

Training is bounded by parameters: at most ``SAMPLE`` distinct texts,
spread evenly over the languages (their rates follow the distinct texts that
have a letter, and each language gets one text at least); the driver gets their presence rows
(``DIM`` bits each), not their texts.

Defined cases: letters are those of any script, lower-cased; all else
counts as one blank between words. A text that is null or has no
letter is ``und`` with score 0. Without any training text every text with
letters is ``und`` too. Rows with equal texts get equal results; repeated rows, null
ids and other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let_go

DIM = 1 << 15
SAMPLE = 2048
LANDMARKS = 128
RIDGE = 1e-2
UNKNOWN = "und"
#: Code points turned into n-grams at once; a longer text goes in overlapping pieces.
PIECE = 1 << 18
ROWS_AT_ONCE = 128

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def _mark(row: np.ndarray, text: str) -> bool:
    """Mark the n-grams of a text in ``row``; whether it has a letter."""
    letter, found, last = _letters(), False, np.array([32], np.uint32)
    for at in range(0, len(text), PIECE):
        c = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        c = np.where(letter[c], c, np.uint32(32))
        c = np.concatenate((last, c, np.array([32], np.uint32) if at + PIECE >= len(text) else c[:0]))
        blank = c == 32
        found = found or not blank.all()
        keep = np.ones(len(c), dtype=bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        c = c[keep]
        last = c[-2:]                                # a later piece goes on from here
        h = np.uint32(0)
        for n in range(3):
            if len(c) <= n:
                break
            h = (c if n == 0 else h[:-1] * np.uint32(0x01000193) + c[n:]) * np.uint32(0x9E3779B1)
            row[(h ^ (h >> np.uint32(15))) >> np.uint32(17)] = 1
    return found


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Presence rows (float32, one per text) and whether each text has a letter."""
    rows = np.zeros((len(texts), DIM), dtype=np.float32)
    has = np.array([bool(t) and _mark(rows[i], t) for i, t in enumerate(texts)], dtype=bool)
    return rows, has


class Model:
    """Landmarks (presence rows, scaled to length 1) and the weights of each language."""

    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.landmarks, self.weights = languages, landmarks, weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        length = np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))
        kernel = (rows @ self.landmarks.T) / length
        return kernel @ self.weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, values = [], []
        for lo in range(0, len(texts), ROWS_AT_ONCE):
            rows, has = presence(texts[lo:lo + ROWS_AT_ONCE])
            if not self.languages:
                has[:] = False
            s = self.scores(rows) if self.languages else np.zeros((len(rows), 1))
            best = s.argmax(axis=1)
            names += [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, has)]
            values.append(np.where(has, np.clip(s[np.arange(len(s)), best], 0, 1), 0.0))
        return names, np.concatenate(values).astype(np.float64) if values else np.zeros(0)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for b in batches:
        rows, has = presence(b.column(1).to_pylist())
        bits = [np.packbits(r > 0).tobytes() if ok else None for r, ok in zip(rows, has)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bits, pa.binary())], names=["lang", "bits"])


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text",
          sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """Fit on at most ``sample`` distinct texts of ``labelled``, chosen by a hash
    of the text, about as many of each language."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")) \
        .where("lang is not null and text is not null")
    mark = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30))
    usable = rows.where(F.col("text").rlike(r"\p{L}"))
    per_lang = {r["lang"]: (r["n"], r["least"]) for r in usable.select("lang", mark.alias("h")).groupBy("lang")
                .agg(F.countDistinct("h").alias("n"), F.min("h").alias("least"))
                .orderBy(F.desc("n"), "lang").limit(sample).collect()}
    if not per_lang:
        return Model([], np.zeros((0, DIM), np.float32), np.zeros((0, 0), np.float32))
    each = max(1, sample // len(per_lang))
    # the text of the least hash always passes, so no language is without one
    limits = F.create_map(*[F.lit(x) for lang, (n, least) in sorted(per_lang.items())
                            for x in (lang, max(int(min(1.0, 1.25 * each / n) * (1 << 30)), least) + 1)])
    chosen = (usable.withColumn("h", mark).where(F.col("h") < limits[F.col("lang")])
              .groupBy("lang", "h").agg(F.min("text").alias("text"))
              .orderBy("h", "lang").limit(2 * sample).select("lang", "text"))
    got = chosen.mapInArrow(_packed, "lang string, bits binary").where("bits is not null").toArrow()
    langs, bits = got.column("lang").to_pylist(), got.column("bits").to_pylist()
    order, count = [], dict.fromkeys(per_lang, 0)
    for i, lang in enumerate(langs):                  # in order of the hash
        if count[lang] < each:
            count[lang] += 1
            order.append(i)
    names = sorted({langs[i] for i in order})
    if not names:
        return Model([], np.zeros((0, DIM), np.float32), np.zeros((0, 0), np.float32))
    def unit_rows(places) -> np.ndarray:
        x = np.stack([np.unpackbits(np.frombuffer(bits[order[i]], np.uint8)) for i in places]).astype(np.float32)
        return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))

    y = np.array([names.index(langs[i]) for i in order])
    # landmarks: as many of each language
    share = max(1, landmarks // len(names))
    at = np.concatenate([np.flatnonzero(y == k)[:share] for k in range(len(names))])
    marks = unit_rows(at)
    # rows are unpacked a block at a time: the driver holds bits and LANDMARKS + ROWS_AT_ONCE rows
    k_nm = np.concatenate([unit_rows(range(i, min(i + ROWS_AT_ONCE, len(order)))) @ marks.T
                           for i in range(0, len(order), ROWS_AT_ONCE)]).astype(np.float64)
    value, vector = np.linalg.eigh(k_nm[at])
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])     # K_mm^(-1/2)
    z = k_nm @ root
    weight = 1.0 / np.bincount(y, minlength=len(names))[y]
    one = np.eye(len(names))[y]
    beta = np.linalg.solve((z * weight[:, None]).T @ z + RIDGE * len(names) / len(y) * np.eye(z.shape[1]),
                           (z * weight[:, None]).T @ one)
    return Model(names, marks, (root @ beta).astype(np.float32))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and lang_score (which replace columns of these names) from the whole text."""
    docs = docs.drop("lang_pred", "lang_score")
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)                     # LANDMARKS * DIM floats, whatever the corpus
    keep = docs.columns
    schema = T.StructType(list(docs.schema) + [T.StructField("lang_pred", T.StringType()),
                                               T.StructField("lang_score", T.DoubleType())])
    at = keep.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in batches:
            names, scores = shared.value.predict(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores)],
                                             names=[*keep, "lang_pred", "lang_score"])

    return docs.mapInArrow(run, schema)
