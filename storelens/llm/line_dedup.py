"""Line dedup by pairwise alignment.

Documents are ordered by id. A document overlaps an earlier one where the lines they
share are rare enough together: the sum of ln(N / holders) reaches ln(100), as
one line held by a hundredth of the documents does (or, in a table of
under 200 documents, one line with two holders); or where both have the same list of lines,
however common. N and holders count distinct documents. Evidence is that of a pair:
common lines scattered over many documents delete nothing.

Partners are found by key: every line, the second and later occurrences of a line, and
pairs of shared lines that stand within ``REACH`` shared lines of each other, in their order and
in any order (pairs of two lines that are rare enough alone are left out, as the lines name
partners themselves). A key names the first document that has it. The lines that a document is known to share
with a partner through its keys are evidence; a pair with enough of it is
aligned by patience diff (lines unique in both are anchors; the longest
increasing run of anchors stands; blocks grow from them; a stretch
without anchors gets an ordinary diff) over the lines that more than one document holds, and the aligned
lines go from the later document. Of all lines that
aligning every overlapping pair would delete, 99 % go (``tests/llm``), and none beyond; the rest
stand with their partners in another order or in one more distant partner only. A copy
of an earlier document's list loses all its lines without an alignment. The first holder of a line is never the later
document, so every line stays somewhere.

Spark joins lines to holders and pairs to line hashes; texts move
once, to meet the lines to delete. A document that many are paired with is replicated, so
that a task aligns at most ``MEMBERS`` documents with a copy of it.

Defined cases: a line is what stands between line feeds, equal by
bytes (64-bit hashes); blank lines never link documents. Null texts stay null, empty
texts empty; rows that repeat both id and text are one document and get
the same result; equal ids with different texts are ordered by
digest, null ids come last. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, mix64, segments, span_hashes, text_buffer

EVIDENCE = math.log(100)
#: How many shared lines ahead a line is paired with, and documents aligned with one copy of a partner.
REACH, MEMBERS = 16, 256
#: Parts in which a group of equal lists meets its first document.
SALTS = 16
_LINE_END = np.zeros(256, dtype=bool)
_LINE_END[10] = True


# -------------------------------------------------------------------- lines
def line_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every line of a batch of texts (0: an empty line) and the
    offsets of each text's lines; a text of n line feeds has n + 1 lines."""
    parts, counts, open_hash = [], np.zeros(len(off) - 1, dtype=np.int64), None
    for i, j, a, b in segments(data, off, _LINE_END):
        seg = data[a:b]
        feeds = np.flatnonzero(seg == 10)
        row_ends = off[i + 1:j + 1] - a
        whole = int(off[j]) == b                     # the piece ends where its last row ends
        ends = np.concatenate((row_ends, feeds)) if whole else feeds
        is_feed = np.concatenate((np.zeros(len(row_ends), bool), np.ones(len(feeds), bool)))[-len(ends):] \
            if len(ends) else np.zeros(0, bool)
        order = np.argsort(ends, kind="stable")
        ends, is_feed = ends[order], is_feed[order]
        starts = np.concatenate(([0], ends[:-1] + is_feed[:-1])) if len(ends) else ends
        tail = 0 if whole else len(seg) - (int(ends[-1]) + 1 if len(ends) else 0)
        if tail:                                     # a line longer than a piece goes on
            starts, ends = np.append(starts, len(seg) - tail), np.append(ends, len(seg))
        h = span_hashes(seg, starts, ends)
        h[starts == ends] = 0
        if open_hash is not None and len(h):
            h[0] = mix64(np.array([open_hash], np.uint64) * np.uint64(3) + h[:1])[0]
            open_hash = None
        if tail:
            open_hash, h = h[-1], h[:-1]
        parts.append(h)
        if j > i + 1:
            rows = np.cumsum(~is_feed) - ~is_feed
            counts[i:j] += np.bincount(rows, minlength=j - i)
        else:
            counts[i] += len(h)
    h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return h, np.concatenate(([0], np.cumsum(counts)))


def _whole(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Hash of each text's list of lines without blank ones (0: no line)."""
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[h != 0]
    h = h[h != 0]
    start = np.searchsorted(row, np.arange(len(off)))
    place = (np.arange(len(h)) - start[row]).astype(np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(h ^ mix64(place + np.uint64(1))))))
    out = mix64(total[start[1:]] - total[start[:-1]])
    out[start[1:] == start[:-1]] = 0
    return out


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h, off = line_hashes(*text_buffer(b.column(2)))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(h.view(np.int64))),
             pa.array(_whole(h, off).view(np.int64))], names=["id", "dig", "lines", "whole"])


def line_keys(h: np.ndarray, rare: np.ndarray, off: np.ndarray, least: float, reach: int
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each text besides its lines: (row, key, place of one line, place of the other).
    ``h`` are the hashes of its shared lines in order, ``rare`` their evidence."""
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((np.arange(len(h)), h, row))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (np.diff(h[order]) != 0) | (np.diff(row[order]) != 0)
    times = np.arange(len(h)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    again = order[times > 0]                             # k-th occurrences
    parts = [(row[again], mix64(h[again] + mix64(times[times > 0].astype(np.uint64))), again, again)]
    once = np.sort(order[new])                           # lines in the order in which they first occur
    alone = rare[once] >= least - 1e-9
    for ahead in range(1, reach + 1):
        i, j = np.arange(len(once) - ahead), np.arange(ahead, len(once))
        ok = (row[once[i]] == row[once[j]]) & ~(alone[i] & alone[j])
        x, y = once[i[ok]], once[j[ok]]
        low, high = np.minimum(h[x], h[y]), np.maximum(h[x], h[y])
        parts.append((row[x], mix64(mix64(h[x]) + h[y]), x, y))
        parts.append((row[x], mix64(mix64(low) + (high ^ np.uint64(0x5555555555555555))), x, y))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _keys(least: float, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines, rare = b.column(2), b.column(3).flatten().to_numpy()
            off = lines.offsets.to_numpy().astype(np.int64)
            h = lines.flatten().to_numpy()
            row, key, x, y = line_keys(h.view(np.uint64), rare, off - off[0], least, reach)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(key.view(np.int64)), pa.array(h[x]), pa.array(rare[x]),
                 pa.array(h[y]), pa.array(rare[y])], names=["id", "dig", "key", "line", "rare", "line2", "rare2"])
    return run


# ---------------------------------------------------------------- alignment
def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, in order of the first part, whose second parts increase."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        p = bisect.bisect_left(tops, j)
        back[k] = at[p - 1] if p else -1
        if p == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[p], at[p] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _once(lines: list[int], lo: int, hi: int) -> dict[int, int]:
    seen: dict[int, int] = {}
    for i in range(lo, hi):
        seen[lines[i]] = -1 if lines[i] in seen else i
    return {x: i for x, i in seen.items() if i >= 0 and x}


def _common(a: list[int], b: list[int]) -> list[int]:
    """The positions in ``a`` of a longest common subsequence (blank lines left out). A row
    of the table is an integer of bits; one row in every ``step`` is kept, the rest computed again."""
    both = (set(a) & set(b)) - {0}
    at, b = [i for i, x in enumerate(a) if x in both], [x for x in b if x in both]
    where = dict.fromkeys(both, 0)
    for j, x in enumerate(b):
        where[x] |= 1 << j
    full = (1 << len(b)) - 1

    def rows(row: int, lo: int, hi: int) -> Iterator[int]:
        for i in at[lo:hi]:                          # a bit is 0 where the length grows
            hit = row & where[a[i]]
            row = ((row + hit) | (row - hit)) & full
            yield row

    step, row, kept = math.isqrt(len(at)) + 1, full, []
    for lo in range(0, len(at), step):
        kept.append(row)
        for row in rows(row, lo, lo + step):
            pass
    out, j = [], len(b)
    for k in range(len(kept) - 1, -1, -1):
        block = [kept[k], *rows(kept[k], k * step, (k + 1) * step)]
        i = len(block) - 1
        while i and j:
            if block[i] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if (block[i] >> (j - 1)) & 1:
                    j -= 1
                    out.append(at[k * step + i])
    return out[::-1]


def aligned(a: list[int], b: list[int]) -> list[int]:
    """Patience diff: the positions in ``a`` of lines aligned with a line of ``b``."""
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append(alo)
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append(ahi)
        if alo >= ahi or blo >= bhi:
            continue
        mine, other = _once(a, alo, ahi), _once(b, blo, bhi)
        anchors = _increasing(sorted((i, other[x]) for x, i in mine.items() if x in other))
        if not anchors:                              # lines that repeat: an ordinary diff of the stretch
            out += [alo + i for i in _common(a[alo:ahi], b[blo:bhi])]
            continue
        for i, j in anchors:                         # each gap ends at an anchor, which its suffix takes
            todo.append((alo, i + 1, blo, j + 1))
            alo, blo = i + 1, j + 1
        todo.append((alo, ahi, blo, bhi))
    return sorted(i for i in out if a[i])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        gone = [[at[i] for i in aligned(x, y)] for x, at, y in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(gone, pa.list_(pa.int32()))],
                                         names=["id", "dig", "gone"])


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions once and in order, and whether each line up to the last of them goes."""
    for b in batches:
        gone = [sorted({i for part in parts for i in part}) for parts in b.column(2).to_pylist()]
        masks = []
        for at in gone:
            m = np.zeros(at[-1] + 1 if at else 0, dtype=bool)
            m[at] = True
            masks.append(m)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(gone, pa.list_(pa.int32())),
                                          pa.array(masks, pa.list_(pa.bool_()))], names=["id", "dig", "gone", "mask"])


# ------------------------------------------------------------------- dedup
def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, dig, gone, mask): for each document that loses lines, their positions from 0."""
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("dig"), F.col(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    base = held(src.where(F.length("text") > 0)
                .mapInArrow(_lines, f"id {id_type}, dig long, lines array<long>, whole long")
                .dropDuplicates(["id", "dig"]), "lines")
    n = base.count()
    least = min(EVIDENCE, math.log(max(n, 3) / 2))
    me = F.struct(F.col("id").isNull().alias("none"), "id", "dig")
    own = F.array_distinct(F.filter("lines", lambda x: x != 0))
    shared = held(base.select(me.alias("me"), F.explode(own).alias("line")).groupBy("line")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("me").alias("first")).where("n > 1")
                  .select("line", F.log(F.lit(float(max(n, 1))) / F.col("n")).alias("rare"), "first"), "shared-lines")
    # copies of an earlier list of lines: all of it goes, and they are nobody's first
    listed = base.where("whole <> 0")
    lists = (listed.groupBy("whole").agg(F.count(F.lit(1)).alias("n"), F.min(me).alias("first")).where("n > 1")
             .select("whole", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = listed.withColumn("salt", F.pmod(F.xxhash64("id", "dig"), F.lit(SALTS)).cast("int"))
    marked = held(salted.join(lists, ["whole", "salt"], "left").drop("salt").withColumn("copy", F.coalesce(F.col("first") != me, F.lit(False)))
                  .drop("first", "whole"), "marked-lines")
    every = F.filter(F.transform("lines", lambda x, i: F.when(x != 0, i)), lambda i: i.isNotNull())
    copies = marked.where("copy").select("id", "dig", every.alias("gone"))
    # the shared lines of all other documents, in order
    spots = (marked.where("NOT copy").select("id", "dig", F.posexplode("lines").alias("pos", "line")).where("line <> 0")
             .join(shared, "line").groupBy("id", "dig")
             .agg(F.array_sort(F.collect_list(F.struct("pos", "line", "rare", "first"))).alias("spots"),
                  F.sum("rare").alias("most")))
    spots = held(spots.select("id", "dig", "most", *(F.col(f"spots.{c}").alias(c) for c in ("pos", "line", "rare", "first"))), "shared-spots")
    able = spots.where(F.col("most") >= least - 1e-9)    # others have too little with anybody
    known = held(able.select("id", "dig", "line", "rare")
                 .mapInArrow(_keys(least, REACH), f"id {id_type}, dig long, key long, line long, rare double, line2 long, rare2 double"),
                 "line-keys").select(me.alias("me"), "key", "line", "rare", "line2", "rare2")
    named = known.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("me").alias("first")).where("n > 1").drop("n")
    by_key = known.join(named, "key").where(F.col("me") != F.col("first"))
    by_line = (able.select(me.alias("me"), F.explode(F.arrays_zip("line", "rare", "first")).alias("x"))
               .select("me", "x.*").where(F.col("me") != F.col("first")))
    evidence = (by_line.select("me", "first", "line", "rare").unionByName(by_key.select("me", "first", "line", "rare"))
                .unionByName(by_key.select("me", "first", F.col("line2").alias("line"), F.col("rare2").alias("rare"))))
    pairs = held(evidence.groupBy("me", "first", "line").agg(F.max("rare").alias("rare"))
                 .groupBy("me", "first").agg(F.sum("rare").alias("rare")).where(F.col("rare") >= least - 1e-9)
                 .select("me.id", "me.dig", F.col("first.id").alias("first_id"), F.col("first.dig").alias("first_dig")), "pairs")
    fan = pairs.groupBy("first_id", "first_dig").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("shares"))

    def same(a: DataFrame, b: DataFrame, id_b: str, dig_b: str):
        return (a["first_dig"] == b[dig_b]) & a["first_id"].eqNullSafe(b[id_b])

    others = spots.select(F.col("id").alias("of_id"), F.col("dig").alias("of_dig"), F.col("line").alias("others"))
    dealt = (fan.join(others, same(fan, others, "of_id", "of_dig"))
             .select("of_id", "of_dig", "others", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("of_share")))
    fan2 = fan.select(F.col("first_id").alias("f_id"), F.col("first_dig").alias("f_dig"), "shares")
    salted = (pairs.join(fan2, same(pairs, fan2, "f_id", "f_dig"))
              .select("id", "dig", "first_id", "first_dig", F.pmod(F.xxhash64("id", "dig"), F.col("shares")).cast("int").alias("share")))
    mine = spots.select(F.col("id").alias("my_id"), F.col("dig").alias("my_dig"), "line", "pos")
    with_own = (salted.join(mine, (salted["dig"] == mine["my_dig"]) & salted["id"].eqNullSafe(mine["my_id"]))
                .select("id", "dig", "line", "pos", "first_id", "first_dig", "share"))
    both = (with_own.join(dealt, same(with_own, dealt, "of_id", "of_dig") & (with_own["share"] == dealt["of_share"]))
            .select("id", "dig", "line", "pos", "others"))
    gone = both.mapInArrow(_align, f"id {id_type}, dig long, gone array<int>").unionByName(copies)
    return (gone.groupBy("id", "dig").agg(F.collect_list("gone").alias("parts"))
            .mapInArrow(_mask, f"id {id_type}, dig long, gone array<int>, mask array<boolean>"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gone_col: str = "_gone") -> DataFrame:
    """The documents without the lines that an earlier document holds: the columns of ``docs``
    with the new text, and the positions deleted as ``gone_col`` (a column of ``docs`` of that name is left out)."""
    gone = held(repeated_lines(docs, id_col, text_col), "gone")
    rows = docs.select(F.col(f"`{id_col}`").alias("own_id"), F.xxhash64(f"`{text_col}`").alias("own_dig"),
                       F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    joined = rows.join(gone.hint("shuffle_hash"), (rows["own_dig"] == gone["dig"]) & rows["own_id"].eqNullSafe(gone["id"]), "left")
    text = F.col(f"row.`{text_col}`")
    rest = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.coalesce(F.get("mask", i), F.lit(False))), "\n")
    text = F.when(F.size("gone") > 0, rest).otherwise(text)
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns if c != gone_col],
                         F.coalesce("gone", F.array().cast("array<int>")).alias(gone_col))
