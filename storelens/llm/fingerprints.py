"""Threshold-scaled document fingerprints.

A fingerprint holds the hash of every run of five words that falls below
a fixed fraction of the hash range, so its size follows the text and the
same runs are held whatever the text they stand in. Hence fingerprints
can be merged by union, and a short text's containment in a very
long one is estimated as well as its likeness to an equal.

Written form: 16 hexadecimal digits of the text's word sequence, a colon,
and the sorted hashes in base 64 (8 big-endian bytes each). The first
part tells texts apart that are too short to hold a hash.

Defined cases: a null text counts as an empty one; a text of one to four words
has a single run of all of them; equal texts have equal fingerprints, and so
have texts that differ in white space alone; likeness of equal
fingerprints is 1, else that of the held hashes (0 if either holds none).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, shingle_hashes, tasks, text_buffer, word_hashes

WIDTH = 5
#: Hashes below 1/FRACTION of the range are held.
FRACTION = 4
_LIMIT = np.uint64((1 << 64) // FRACTION)
_EMPTY = "0" * 16


# ------------------------------------------------------------- the sketches
def _sketches(col: pa.Array) -> list[tuple[str, np.ndarray]]:
    """(digest of the words, sorted held hashes) of each text."""
    words, off = word_hashes(*text_buffer(col))
    turn = np.arange(len(words), dtype=np.uint64)
    s, s_off = shingle_hashes(words, off, WIDTH)
    low = s < _LIMIT
    out = []
    for i in range(len(off) - 1):
        a, b = off[i], off[i + 1]
        whole = mix64((words[a:b] * (mix64(turn[:b - a]) | np.uint64(1))).sum(keepdims=True)
                      + np.uint64(b - a))[0] if b > a else 0
        part = s[s_off[i]:s_off[i + 1]]
        out.append((f"{int(whole):016x}", np.unique(part[low[s_off[i]:s_off[i + 1]]])))
    return out


def _write(sketch: tuple[str, np.ndarray]) -> str:
    return sketch[0] + ":" + base64.b64encode(sketch[1].astype(">u8").tobytes()).decode()


def read_fingerprint(text: str) -> tuple[str, np.ndarray]:
    head, _, body = text.partition(":")
    return head, np.frombuffer(base64.b64decode(body), dtype=">u8").astype(np.uint64)


def _alike(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> tuple[float, float]:
    """Likeness (Jaccard) and the share of a that b contains."""
    if a[0] == b[0]:
        return 1.0, 1.0
    if not len(a[1]) or not len(b[1]):
        return 0.0, 0.0
    both = len(np.intersect1d(a[1], b[1], assume_unique=True))
    return both / (len(a[1]) + len(b[1]) - both), both / len(a[1])


def likeness(a: str, b: str) -> float:
    return _alike(read_fingerprint(a), read_fingerprint(b))[0]


def containment(a: str, b: str) -> float:
    """Estimated share of the runs of ``a`` that ``b`` holds."""
    return _alike(read_fingerprint(a), read_fingerprint(b))[1]


def merge(fingerprints: Iterable[str]) -> str:
    """The fingerprint of a collection of texts: what any of them holds."""
    parts = sorted({f for f in fingerprints})
    if len(parts) == 1:
        return parts[0]
    read = [read_fingerprint(f) for f in parts]
    head = hashlib.sha256(" ".join(r[0] for r in read).encode()).hexdigest()[:16] if parts else _EMPTY
    return _write((head, np.unique(np.concatenate([r[1] for r in read]))) if parts else (_EMPTY, np.zeros(0, np.uint64)))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([_write(s) for s in _sketches(b.column(1))], pa.string())],
            names=["id", "fingerprint"])


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every whole text."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (src.mapInArrow(_each, f"id {src.schema['id'].dataType.simpleString()}, fingerprint string")
            .withColumnRenamed("id", id_col))


# ---------------------------------------------------------- with successors
def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, ahead, id, text) sorted by falling id within tasks, such that every row
    with ``ahead`` false is followed by its successor, the last of all by the first.

    Ids are cut into ranges; a range's first row also goes, with ``ahead``
    true, behind the range before it. Integer ids; null ids come last, and equal ids
    in order of a hash of their texts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = 4 * tasks(spark)
    share = [(k + 1) / ranges for k in range(ranges - 1)]
    cuts = rows.agg(F.percentile_approx("id", share, 20 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))                          # a bounded number of ids
    at = F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(
        F.size(F.filter(F.lit(cuts) if cuts else F.array().cast("array<long>"), lambda c: c >= F.col("id"))))
    rows = rows.withColumns({"bucket": at, "h": F.xxhash64("text")})
    order = [F.col("id").desc_nulls_last(), F.col("h")]
    # the first row of each range: the largest id and then the smallest hash
    top = (rows.groupBy("bucket").agg(F.max(F.struct("id", (-F.col("h")).alias("h"))).alias("m"))
           .select("bucket", F.col("m.id").alias("id"), (-F.col("m.h")).alias("h")).orderBy("bucket").collect())
    if not top:
        return rows.select("bucket", F.lit(False).alias("ahead"), "id", "text")
    heads = spark.createDataFrame([(r["id"], r["h"], top[k - 1]["bucket"]) for k, r in enumerate(top)],
                                  "hid long, hh long, before int")     # one row per range
    marked = rows.join(F.broadcast(heads), rows["id"].eqNullSafe(heads["hid"]) & (rows["h"] == heads["hh"]), "left")
    both = F.array(F.struct(F.col("bucket"), F.lit(False).alias("ahead")),
                   F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("ahead"))))
    dealt = (marked.select("id", "text", "h", F.explode(F.filter(both, lambda x: x.isNotNull())).alias("to"))
             .select("to.bucket", "to.ahead", "id", "text", "h"))
    return (dealt.repartition(tasks(spark), "bucket").sortWithinPartitions("bucket", "ahead", *order)
            .select("bucket", "ahead", "id", "text"))


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_row = None
    for b in batches:
        bucket, ahead, ids, texts = (b.column(k).to_pylist() for k in range(4))
        if held_row is not None:
            for col, x in zip((bucket, ahead, ids, texts), held_row):
                col.insert(0, x)
        sketches = _sketches(pa.array(texts, pa.string()))
        todo = [i for i in range(len(ids) - 1) if not ahead[i]]
        if any(bucket[i] != bucket[i + 1] for i in todo):
            raise RuntimeError("a row lacks its successor")
        edited = []
        for i in todo:
            cut = len(texts[i]) // 3
            edited.append(texts[i][:len(texts[i]) - cut] + texts[i + 1][:cut])
        changed = _sketches(pa.array(edited, pa.string()))
        near = [_alike(sketches[i], e) for i, e in zip(todo, changed)]
        after = [_alike(sketches[i], sketches[i + 1]) for i in todo]
        yield pa.RecordBatch.from_arrays([
            pa.array([ids[i] for i in todo], pa.int64()), pa.array([len(texts[i]) for i in todo], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            pa.array([_write(sketches[i]) for i in todo], pa.string()), pa.array([_write(e) for e in changed], pa.string()),
            pa.array([x[0] for x in near], pa.float64()), pa.array([x[0] for x in after], pa.float64()),
            pa.array([x[1] for x in near], pa.float64()), pa.array([x[1] for x in after], pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                   "contained_edited", "contained_next"])
        held_row = (bucket[-1], ahead[-1], ids[-1], texts[-1]) if ids else None
    if held_row is not None and not held_row[1]:
        raise RuntimeError("a row lacks its successor")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its edited text (the last third replaced by the beginning
    of the next document, by falling id) and beside the next document."""
    return with_next(docs, id_col, text_col).mapInArrow(
        _edits, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, contained_edited double, contained_next double")
