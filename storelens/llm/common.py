"""Helpers shared by the operators: session set-up, held tables, text hashing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.session import checkpoint_dir, scratch_path, ship_package

#: Rows per Arrow batch handed to Python: texts are whole, so batches are short.
ARROW_ROWS = 256
#: Bytes hashed at once; a longer text is hashed in segments from its own start.
SEGMENT = 1 << 20

def prepare(spark: SparkSession) -> None:
    """Session state every operator relies on (UTC, shared folder, package on workers)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    checkpoint_dir(spark)
    ship_package(spark)


def held(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs the files nothing, and the
    rows (ids made while writing included) are the same on every read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_held(df: DataFrame) -> None:
    """Remove the files of a held table that no later step reads."""
    spark = df.sparkSession
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        if "/llm/" in f:
            p = spark._jvm.org.apache.hadoop.fs.Path(f)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def tasks(spark: SparkSession) -> int:
    """Shuffle partitions of this session: sized to the data by whoever runs it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What this Python worker keeps between its tasks: one thing at a time, made when it is first asked for."""
    if name not in _KEPT:
        let_go()
        _KEPT[name] = make()
    return _KEPT[name]


def let_go() -> None:
    """Drop what an earlier operator's tasks kept: a reused worker has it until it ends, beside what comes then."""
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()


# ------------------------------------------------------------------ hashing
_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C55          # odd, so it has an inverse modulo 2^64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word (uint64 in, new array out)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream64(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    i = np.arange(1, n + 1, dtype=np.uint64) + np.uint64((seed * 0xD1342543DE82EF95) & _M64)
    return mix64(i * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0], done = 1, 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if "byte" not in _TABLES:
        _TABLES["byte"] = stream64(11, 256)
    if len(_TABLES.get("up", ())) < n:
        size = max(n, SEGMENT + 1)
        _TABLES["up"] = _powers(_BASE, size)
        _TABLES["down"] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _TABLES["byte"], _TABLES["up"], _TABLES["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span ``data[starts[i]:ends[i]]`` in one pass
    (polynomial prefix sums modulo 2^64; spans lie within ``SEGMENT`` bytes)."""
    byte, up, down = _tables(len(data) + 1)
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(byte[data] * up[:len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix64(h + (ends - starts).astype(np.uint64))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string column (null: empty)."""
    if col.null_count:
        col = col.fill_null("")
    _, offsets, data = col.buffers()
    wide = np.int64 if pa.types.is_large_string(col.type) else np.int32
    off = np.frombuffer(offsets, dtype=wide)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def _spaces(sep: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(sep)] = True
    return t


WORD_SPACE = _spaces(b" \t\n\x0b\x0c\r")


def segments(data: np.ndarray, off: np.ndarray, stop: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Cut a batch into pieces of at most ``SEGMENT`` bytes: runs of whole rows, or
    parts of one long row that end behind a separator where it has one.
    Yields (first row, row after the last, first byte, byte after the last)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + SEGMENT, side="right")) - 1
        if j > i:
            yield i, j, int(off[i]), int(off[j])
            i = j
            continue
        a, end = int(off[i]), int(off[i + 1])
        while a < end:
            b = min(a + SEGMENT, end)
            if b < end:
                sep = np.flatnonzero(stop[data[a:b]])
                b = a + int(sep[-1]) + 1 if len(sep) else b
            yield i, i + 1, a, b
            a = b
        i += 1


def word_hashes(data: np.ndarray, off: np.ndarray, stop: np.ndarray = WORD_SPACE
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (maximal runs without a separator) of a batch of
    texts, and the offsets of each text's words."""
    hashes, counts = [], np.zeros(len(off) - 1, dtype=np.int64)
    for i, j, a, b in segments(data, off, stop):
        seg = data[a:b]
        if not len(seg):
            continue
        inside = ~stop[seg]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = off[i + 1:j] - a                      # row borders inside the piece
        cut = cut[(cut > 0) & (cut < len(seg))]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(s):
            hashes.append(span_hashes(seg, s, e))
            rows = np.searchsorted(off[i:j + 1] - a, s, side="right") - 1 if j > i + 1 else None
            if rows is None:
                counts[i] += len(s)
            else:
                counts[i:j] += np.bincount(rows, minlength=j - i)
    h = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    return h, np.concatenate(([0], np.cumsum(counts)))


_ORDER = stream64(23, 64) | np.uint64(1)


def shingle_hashes(words: np.ndarray, off: np.ndarray, width: int = 5
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each text, and their offsets.
    A text of fewer words, but one at least, has one shingle: all its words."""
    n = np.diff(off)
    out_n = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out_off = np.concatenate(([0], np.cumsum(out_n)))
    out = np.empty(int(out_off[-1]), dtype=np.uint64)
    if len(words) >= width:
        run = words[:len(words) - width + 1] * _ORDER[0]
        for k in range(1, width):
            run += words[k:len(words) - width + 1 + k] * _ORDER[k]
        run = mix64(run)
        long = n >= width
        keep = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(keep, off[:-1][long], 1)
        np.add.at(keep, off[1:][long] - width + 1, -1)
        ok = np.cumsum(keep)[:len(run)] > 0
        place = np.zeros(len(out) + 1, dtype=np.int64)
        short = (~long) & (n > 0)
        place[out_off[:-1][short]] = 1
        out[place[:-1] == 0] = run[ok]
    for i in np.flatnonzero((n < width) & (n > 0)):
        w = words[off[i]:off[i + 1]]
        with np.errstate(over="ignore"):
            out[out_off[i]] = mix64((w * _ORDER[:len(w)]).sum(keepdims=True)
                                    + np.uint64(len(w)))[0]
    return out, out_off


def whole_row(docs: DataFrame):
    """All columns of ``docs`` as one struct, so that no column beside it can clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or the first longer form that no column has."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def digest(col: str):
    """128-bit digest of a text as 16 bytes (null: of the empty text)."""
    return F.unhex(F.md5(F.coalesce(F.col(col), F.lit(""))))
