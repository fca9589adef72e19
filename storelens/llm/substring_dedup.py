"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where the hash is
the greatest within ``REACH`` bytes on either side, so borders depend on
the near bytes alone and an insertion moves only the chunks around it. Chunks
are joined by digest (64 bits, length mixed in); a chunk that several documents hold is
shared, and its first holder is the document of the smallest id.

Shared chunks in a row whose first holder is another document are a stretch. Both its
ends are extended, byte by byte, as far as the text before and behind is the
first holder's too, then moved to the word borders inside. A stretch of
``MIN_WORDS`` words then, or ``MIN_BYTES`` bytes (scripts without spaces), is a repeated passage and is removed. A
common passage ends less than a chunk and ``_NEAR`` bytes beyond the stretch (else the
next chunk would be shared as well), so that much of the first holder's text is all that is sent, and
only for stretches that can grow long enough. Two texts whose digests collide by chance
have no such passage around the chunk, and nothing goes.

Spark counts digests (two ids per digest and task, combined before the
shuffle), joins chunks to the shared ones and gathers the marks of each
document; texts move once to give the ends of first holders' chunks and once to be extended.

Defined cases: null and empty texts have no chunks; rows of equal id are
one document, whose own repeats stay; rows with a null id count as one document
behind all others; texts without a border are cut every ``MAX_CHUNK``
bytes, counted from their start; borders never split a character. Passages that overlap
are one. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SEGMENT, WORD_SPACE, drop_held, free_name, held, span_hashes, stream64, text_buffer, whole_row

REACH = 24
MIN_WORDS = 50
MIN_BYTES = 500
MAX_CHUNK = 1 << 16
_TAPS = 16                       # bytes the gear hash sees: two bits a byte
_PAD = 2 * (REACH + _TAPS)
_NEAR = REACH + _TAPS + 2         # bytes on which a border depends, on either side
_LONG_WORD = 64                  # bytes looked at for the end of a word that a passage's end falls into
_LAST = (1 << 63) - 1            # stands for a null id

_GEAR = (stream64(53, 256) >> np.uint64(32)).astype(np.uint32)
_GEAR[0] = 0


# ------------------------------------------------------------------ chunking
def _peaks(data: np.ndarray) -> np.ndarray:
    """Positions whose gear hash is above all others within ``REACH`` bytes. Bytes
    are read ``_TAPS - 1`` back; the ends count as zero bytes."""
    h = _GEAR[data]
    step = 1
    while step < _TAPS:                              # h[i] += h[i - step] << 2 * step
        h[step:] += h[:-step] << np.uint32(2 * step)
        step *= 2
    wide, width = h.copy(), 1                        # wide[i] = max(h[i:i + width])
    while width < REACH:
        more = min(width, REACH - width)
        wide[:-more] = np.maximum(wide[:-more], wide[more:])
        width += more
    n = len(h)
    peak = np.zeros(n, dtype=bool)
    if n > 2 * REACH:
        mid = h[REACH:n - REACH]
        peak[REACH:n - REACH] = (mid > wide[:n - 2 * REACH]) & (mid > wide[REACH + 1:n - REACH + 1])
    return np.flatnonzero(peak)


def _borders(text: np.ndarray) -> np.ndarray:
    """Chunk borders of one long text, found piece by piece."""
    found = []
    for a in range(0, len(text), SEGMENT):
        b = min(a + SEGMENT, len(text))
        lo, hi = max(0, a - _PAD), min(len(text), b + _PAD)
        piece = np.concatenate((np.zeros(_PAD, np.uint8), text[lo:hi], np.zeros(_PAD, np.uint8)))
        at = _peaks(piece) - _PAD + lo + 1           # a chunk ends behind the peak
        found.append(at[(at > a) & (at <= b)])
    return np.concatenate(found)


def chunk_texts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of a batch of texts: start byte in the text, digest, and offsets of each text's chunks."""
    rows, n = [], len(off) - 1
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + SEGMENT, side="right")) - 1)
        part = data[off[i]:off[j]]
        if j == i + 1 and len(part) > SEGMENT:
            cuts = [_borders(part)]
        else:                                        # texts apart by zero bytes
            size = np.diff(off[i:j + 1])
            base = off[i:j] - off[i] + _PAD * np.arange(1, j - i + 1)
            padded = np.zeros(len(part) + _PAD * (j - i + 1), dtype=np.uint8)
            padded[np.arange(len(part)) + np.repeat(_PAD * np.arange(1, j - i + 1), size)] = part
            at = _peaks(padded) + 1
            row = np.searchsorted(base, at, side="right") - 1
            at = at - base[np.maximum(row, 0)]
            ok = (row >= 0) & (at > 0) & (at < size[np.maximum(row, 0)])
            at, row = at[ok], row[ok]
            cuts = np.split(at, np.searchsorted(row, np.arange(1, j - i)))
        for k, c in enumerate(cuts):
            rows.append(_finish(data[off[i + k]:off[i + k + 1]], c))
        i = j
    starts = np.concatenate([r for r in rows]) if rows else np.zeros(0, np.int64)
    counts = np.array([len(r) for r in rows], dtype=np.int64)
    chunk_off = np.concatenate(([0], np.cumsum(counts)))
    where = np.repeat(off[:-1], counts)
    first, last = starts + where, np.empty(len(starts), dtype=np.int64)
    last[:-1] = first[1:]
    full = counts > 0
    last[chunk_off[1:][full] - 1] = off[1:][full]
    return starts, _digests(data, first, last), chunk_off


def _finish(text: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Starts of the chunks: borders moved behind the character they fall into, and
    long chunks cut."""
    if not len(text):
        return np.zeros(0, np.int64)
    cuts = cuts[(cuts > 0) & (cuts < len(text))]
    for _ in range(3):
        inside = (text[np.minimum(cuts, len(text) - 1)] & 0xC0) == 0x80
        cuts = cuts + inside
    starts = np.concatenate(([0], np.unique(cuts[cuts < len(text)])))
    length = np.diff(np.append(starts, len(text)))
    if length.max(initial=0) > MAX_CHUNK:
        more = [np.arange(a + MAX_CHUNK, a + n, MAX_CHUNK) for a, n in zip(starts, length) if n > MAX_CHUNK]
        more = np.concatenate(more)
        for _ in range(3):
            more = more + ((text[np.minimum(more, len(text) - 1)] & 0xC0) == 0x80)
        starts = np.unique(np.concatenate((starts, more[more < len(text)])))
    return starts


def _digests(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    out = np.empty(len(first), dtype=np.uint64)
    i = 0
    while i < len(first):
        j = int(np.searchsorted(last, first[i] + SEGMENT, side="right"))
        a = first[i]
        out[i:j] = span_hashes(data[a:last[j - 1]], first[i:j] - a, last[i:j] - a)
        i = j
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, off = text_buffer(b.column(2))
        starts, digests, at = chunk_texts(data, off)
        begins = ~WORD_SPACE[data]
        begins[1:] &= WORD_SPACE[data[:-1]] | (np.bincount(off[(off > 0) & (off < len(data))], minlength=len(data))[1:] > 0)
        words = np.concatenate(([0], np.cumsum(begins)))
        row = np.repeat(np.arange(len(off) - 1), np.diff(at))
        back = words[np.maximum(starts + off[row] - _NEAR, off[row])] - words[off[row]]
        ahead = words[np.minimum(starts + off[row] + _NEAR, off[row + 1])] - words[off[row]]
        size = words[off[1:]] - words[off[:-1]]
        at = pa.array(at, pa.int32())

        def lists(x, kind):
            return pa.ListArray.from_arrays(at, pa.array(x, kind))

        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(np.diff(off), pa.int64()), pa.array(size, pa.int64()), lists(starts, pa.int32()),
             lists(digests.view(np.int64), pa.int64()), lists(back, pa.int32()), lists(ahead, pa.int32())],
            names=["id", "dig", "bytes", "words", "starts", "digests", "back", "ahead"])


_CHUNKS = "id long, dig long, bytes long, words long, starts array<int>, digests array<long>, back array<int>, ahead array<int>"


# ------------------------------------------------------------------ stretches
_CHUNK = "digest: bigint, lo: bigint, start: bigint, stop: bigint, hi: bigint"
_STRETCHES = f"id long, dig long, start long, stop long, first long, ends array<long>, own array<struct<{_CHUNK}>>"


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of shared chunks of a document: those of earlier documents with the digests of their two ends (only
    if they can grow to a passage), those that it holds first with the places of their chunks."""
    for b in batches:
        out: list[list] = [[] for _ in range(7)]
        cols = [b.column(k).to_pylist() for k in range(10)]
        for own, dig, size, words, starts, digests, back, ahead, at, first in zip(*cols):
            edge = np.append(starts, size)
            digests = np.asarray(digests)
            order = np.argsort(at)
            pos, holder = np.asarray(at)[order], np.asarray(first)[order]
            earlier = holder != (_LAST if own is None else own)
            cut = np.flatnonzero((np.diff(pos) != 1) | (earlier[1:] != earlier[:-1])) + 1
            for p, h, e in zip(np.split(pos, cut), np.split(holder, cut), np.split(earlier, cut)):
                a, z = int(p[0]), int(p[-1])
                lo, hi = max(a - 1, 0), min(z + 2, len(edge) - 1)     # ends of the chunks around
                ends = places = smallest = None
                if e[0]:
                    most = (ahead[hi] if hi < len(ahead) else words) - back[lo] + 1
                    if most < MIN_WORDS and edge[hi] - edge[lo] + 2 * _NEAR < MIN_BYTES:
                        continue
                    ends, smallest = [int(digests[a]), int(digests[z])], int(h.min())
                else:
                    places = [{"digest": int(digests[k]), "lo": int(max(edge[max(k - 1, 0)] - _NEAR, 0)), "start": int(edge[k]),
                               "stop": int(edge[k + 1]), "hi": int(min(edge[min(k + 2, len(edge) - 1)] + _NEAR, size))} for k in p]
                for col, x in zip(out, (own, dig, int(edge[a]), int(edge[z + 1]), smallest, ends, places)):
                    col.append(x)
        chunk = pa.struct([(n, pa.int64()) for n in ("digest", "lo", "start", "stop", "hi")])
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in out[:5]), pa.array(out[5], pa.list_(pa.int64())), pa.array(out[6], pa.list_(chunk))],
            names=["id", "dig", "start", "stop", "first", "ends", "own"])


_AROUND = "digest long, holder long, holder_dig long, start long, stop long, before binary, behind binary"


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes before and behind the wanted chunks of their first holders."""
    for b in batches:
        out: list[list] = [[] for _ in range(7)]
        for own, dig, text, chunks in zip(*(b.column(k).to_pylist() for k in range(4))):
            raw = text.encode()
            for c in chunks:
                for col, x in zip(out, (c["digest"], own, dig, c["start"], c["stop"],
                                        raw[c["lo"]:c["start"]], raw[c["stop"]:c["hi"]])):
                    col.append(x)
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:5]), *(pa.array(c, pa.binary()) for c in out[5:])],
                                         names=["digest", "holder", "holder_dig", "start", "stop", "before", "behind"])


# ------------------------------------------------------------------ passages
def _alike(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def _space(raw: bytes, at: int) -> bool:
    return bool(WORD_SPACE[raw[at]])


def _trimmed(raw: bytes, start: int, stop: int) -> tuple[int, int]:
    """The span without the part of a word (or of a character) at either end, and without
    the white space before its first word, which keeps the words around it apart."""
    a, z = start, stop
    if 0 < a and not _space(raw, a - 1):
        near = [k for k in range(a, min(a + _LONG_WORD, z)) if _space(raw, k)]
        a = near[0] if near else a
        while near and a < z and _space(raw, a):
            a += 1
    if z < len(raw) and not _space(raw, z):
        near = [k for k in range(z, max(z - _LONG_WORD, a), -1) if _space(raw, k - 1)]
        z = near[0] if near else z
    while a < z and raw[a] & 0xC0 == 0x80:
        a += 1
    while a < z < len(raw) and raw[z] & 0xC0 == 0x80:
        z -= 1
    return a, z


_PASSAGES = "id long, dig long, start long, stop long, first long, removed boolean"


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches extended into passages, and the places of their ends in the first holders' texts."""
    for b in batches:
        out: list[list] = [[] for _ in range(6)]
        for own, dig, text, ends in zip(*(b.column(k).to_pylist() for k in range(4))):
            raw, met, found = text.encode(), {}, []
            for e in ends:
                met.setdefault((e["start"], e["stop"], e["first"]), {})[e["side"]] = e
            for (start, stop, first), sides in met.items():
                left, right = sides[0], sides[1]
                grow = _alike(raw[max(start - len(left["before"]), 0):start][::-1], left["before"][::-1])
                more = _alike(raw[stop:stop + len(right["behind"])], right["behind"])
                a, z = _trimmed(raw, start - grow, stop + more)
                if z - a < MIN_BYTES and len(raw[a:z].split()) < MIN_WORDS:
                    continue
                found.append((a, z, first))
                for h, x, y in ((left, left["own_start"] - (start - a), left["own_stop"]),
                                (right, right["own_start"], right["own_stop"] + (z - stop))):
                    for col, v in zip(out, (h["holder"], h["holder_dig"], x, y, h["holder"], False)):
                        col.append(v)
            joined: list[list] = []
            for a, z, first in sorted(found):
                if joined and a < joined[-1][1]:
                    joined[-1][1:] = [max(z, joined[-1][1]), min(first, joined[-1][2])]
                else:
                    joined.append([a, z, first])
            for a, z, first in joined:
                for col, v in zip(out, (own, dig, a, z, first, True)):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:5]), pa.array(out[5], pa.bool_())],
                                         names=["id", "dig", "start", "stop", "first", "removed"])


def _with_texts(src: DataFrame, lists: DataFrame, column: str) -> DataFrame:
    """(id, dig, text, column) for the documents that have lists; repeated rows once for each row."""
    own = lists.select(F.col("id").alias("id2"), F.col("dig").alias("dig2"), column)
    return (src.join(own, (F.col("dig") == F.col("dig2")) & F.col("id").eqNullSafe(F.col("id2")))
            .select("id", "dig", "text", column))


def _first_holders(passages: DataFrame, stretches: DataFrame) -> DataFrame:
    """Passages in their first holders: the chunks held first, joined with the ends that
    later documents' passages reach there. A document's places are bounded by its length."""
    ends = passages.where(~F.col("removed")).select("id", "dig", "start", "stop").distinct().withColumn("end", F.lit(1))
    own = stretches.where(F.col("own").isNotNull()).select("id", "dig", "start", "stop", F.lit(0).alias("end"))
    by_place = Window.partitionBy("id", "dig").orderBy("start", "stop")
    reach = F.max("stop").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") <= F.col("_reach"), 0).otherwise(1)).over(by_place.rowsBetween(Window.unboundedPreceding, 0))
    return (ends.unionByName(own.dropDuplicates()).withColumn("_reach", reach).withColumn("_island", island)
            .groupBy("id", "dig", "_island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.max("end").alias("end"))
            .where("end = 1").select("id", "dig", "start", "stop", F.col("id").alias("first"), F.lit(False).alias("removed")))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, dig, start_byte, n_bytes, first_id, removed): the passages that documents
    share, by document; ``removed`` tells later occurrences from first ones."""
    src = (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("dig"), F.col(text_col).alias("text"))
           .where(F.length("text") > 0))
    base = held(src.mapInArrow(_chunks, _CHUNKS), "chunks")
    own = F.coalesce("id", F.lit(_LAST))
    each = base.select("id", "dig", F.posexplode("digests").alias("at", "digest"))
    shared = held(each.groupBy("digest").agg(F.min(own).alias("first"), F.max(own).alias("last"))
                  .where(F.col("first") != F.col("last")).select("digest", "first"), "shared-chunks")
    # one key without nulls for the marks, the rows and their join, so that the chunks are dealt out once
    key = [own.alias("own"), F.col("id").isNull().alias("none"), F.col("dig")]
    marks = (each.join(shared, "digest").groupBy(*key).agg(F.collect_set(F.struct("at", "first")).alias("m"))
             .select("own", "none", "dig", F.col("m.at").alias("at"), F.col("m.first").alias("first")))
    whole = base.select(*key, *(c for c in base.columns if c != "dig")).dropDuplicates(["own", "none", "dig"])
    met = whole.join(marks, ["own", "none", "dig"]).select(*base.columns, "at", "first")
    stretches = held(met.mapInArrow(_stretches, _STRETCHES), "stretches")
    drop_held(base)
    drop_held(shared)

    ends = stretches.where(F.col("ends").isNotNull()).select("id", "dig", "start", "stop", "first",
                                                             F.posexplode("ends").alias("side", "digest"))
    wanted = ends.select("digest").distinct()
    places = (stretches.where(F.col("own").isNotNull()).select("id", "dig", F.inline("own")).join(wanted, "digest", "left_semi")
              .groupBy("digest").agg(F.min(F.struct("id", "dig", "start", "stop", "lo", "hi")).alias("p"))
              .groupBy("p.id", "p.dig").agg(F.collect_list(F.struct("digest", "p.lo", "p.start", "p.stop", "p.hi")).alias("places")))
    around = _with_texts(src, places, "places").mapInArrow(_around, _AROUND).dropDuplicates(["digest"])
    held_by = held(around, "chunk-ends").withColumnsRenamed({"start": "own_start", "stop": "own_stop"})
    sides = (ends.join(held_by, "digest").groupBy("id", "dig")
             .agg(F.collect_list(F.struct("start", "stop", "first", "side", "holder", "holder_dig", "own_start", "own_stop",
                                          "before", "behind")).alias("sides")))
    passages = held(_with_texts(src, sides, "sides").mapInArrow(_passages, _PASSAGES).dropDuplicates(), "passages")
    return (passages.where("removed").unionByName(_first_holders(passages, stretches))
            .select("id", "dig", F.col("start").alias("start_byte"), (F.col("stop") - F.col("start")).alias("n_bytes"),
                    F.col("first").alias("first_id"), "removed"))


def _cut_out(names: list[str], text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text_at).to_pylist()
            for k, gone in enumerate(b.column(len(names)).to_pylist()):
                if gone:
                    raw, out, at = texts[k].encode(), [], 0
                    for g in sorted(gone, key=lambda g: g["start_byte"]):
                        out.append(raw[at:g["start_byte"]])
                        at = g["start_byte"] + g["n_bytes"]
                    texts[k] = b"".join([*out, raw[at:]]).decode()
            cols = list(b.columns[:len(names)])
            cols[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the later occurrences of shared passages."""
    gone = (repeated_passages(docs, id_col, text_col).where("removed").groupBy("id", "dig")
            .agg(F.collect_list(F.struct("start_byte", "n_bytes")).alias("gone")))
    gone = held(gone, "removed-passages")
    rows = docs.select(F.col(id_col).cast("long").alias("own_id"), F.xxhash64(text_col).alias("own_dig"), whole_row(docs))
    met = (rows.join(gone.hint("shuffle_hash"), (rows["own_dig"] == gone["dig"]) & rows["own_id"].eqNullSafe(gone["id"]), "left")
           .select("row.*", F.col("gone").alias(free_name("gone", docs.columns))))
    return met.mapInArrow(_cut_out(docs.columns, docs.columns.index(text_col)), docs.schema)
