"""Near duplicates by improved consistent weighted sampling.

A text is the multiset of its runs of five words; the weight of a run is
its count times an inverse document frequency over the distinct texts.
Equal texts are one node. Each node draws ``BANDS * ROWS`` consistent
samples (Ioffe's scheme: two nodes draw the same sample with a
probability equal to their weighted Jaccard similarity); nodes that
agree on all samples of a band meet in a bucket. A link holds where the
weighted Jaccard similarity of the whole texts is at least the
threshold. Groups are the connected components.

A bucket is searched in two steps, neither of which compares all with
all. First its hub (the node that meets most others in all its buckets)
is compared with each other node. Where a bucket's nodes then lie in
several components, those outside its largest component are compared
with the rest, inside tasks, in blocks of ``BLOCK`` nodes a side; a pair
whose components are joined already is skipped. One byte of each sample
goes ahead of the texts: a pair that agrees on fewer than ``LEAST`` of
the 36 is not near (at a similarity of 0.8 that happens once in ten
million pairs), and only nodes with a pair left get their texts moved.
So every candidate pair is linked or compared, and no pair is written
unless it is a link.

Inverse document frequency: ln(1 + N / df), with the exact number of
distinct texts that hold the run. What at least a twentieth of the
texts hold numbers at most 20 times the mean length of a text, so those
counts fit a broadcast that is checked before use; they are found
without shuffling all runs: a fixed array of bucket counts over all
texts bounds every run's count from above, and only runs in buckets
above that share are counted this way. All other runs are dealt out by
their hash and counted where equal ones meet; each text gets back the
counts of those that another text holds, too, and what then has no
count is its own alone.

Defined cases: a null text counts as an empty one; equal texts, empty
ones included, are one group; a text without words has no runs and
links with no other; repeated rows share a group and
only one of them is kept; the kept row of a group has its smallest id
(null ids last; among equal ids the smallest digest). Other columns
pass through unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (digest, drop_held, held, let_go, mix64, shingle_hashes, stream64, tasks, text_buffer,
                     whole_row, word_hashes)
from .components import connected_components

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 3
FLOOR = 20                      # runs in one text of FLOOR are counted by a broadcast, rarer ones by a shuffle
BUCKETS = 1 << 16               # of the bound on document frequencies
CHUNK = 1 << 12                 # counters in a row of that array
MEMBERS_PER_TASK = 500
LEAST = 15                      # samples that a near pair agrees on at least
CODES = -(-BANDS * ROWS // 8)   # longs that hold one byte of each sample
BLOCK = 256                     # nodes of a bucket's side that one group of the second step holds
MAX_FREQUENT = 8_000_000        # rows of the frequent-run table that may be broadcast; else the shuffle counts these, too
PART_RUNS = 1 << 21             # runs that one group of the shuffle holds on average
DEALT = 1 << 19                 # runs that a task gathers before it deals them out

_U32 = np.uint64(32)


# ------------------------------------------------------------- shared runs
def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for b in batches:
        s, _ = shingle_hashes(*word_hashes(*text_buffer(b.column(0))), WIDTH)
        total += np.bincount((s >> np.uint64(48)).astype(np.int64), minlength=BUCKETS)
    used = np.flatnonzero(total.reshape(-1, CHUNK).any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()),
         pa.array([total[i * CHUNK:(i + 1) * CHUNK] for i in used], pa.list_(pa.int64()))],
        names=["chunk", "counts"])


def frequent_runs(docs: DataFrame, text_col: str, texts: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes and document counts (over distinct texts) of the runs in
    at least 1/FLOOR of the texts, and how many runs all rows have."""
    least = max(2, math.ceil(texts / FLOOR))
    src = docs.select(F.col(text_col).alias("text"))
    counted = (src.mapInArrow(_bucket_counts, "chunk int, counts array<long>")
               .select("chunk", F.posexplode("counts").alias("at", "n"))
               .groupBy("chunk", "at").agg(F.sum("n").alias("n")).where("n > 0")
               .select((F.col("chunk") * CHUNK + F.col("at")).alias("bucket"), "n").toArrow())   # at most BUCKETS rows
    size = counted.column("n").to_numpy()
    hot, total = np.zeros(BUCKETS, dtype=bool), int(size.sum())
    hot[counted.column("bucket").to_numpy()[size >= least]] = True
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), total
    if not hot.any():
        return none

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, off = shingle_hashes(*word_hashes(*text_buffer(b.column(1))), WIDTH)
            at = np.flatnonzero(hot[(s >> np.uint64(48)).astype(np.int64)])
            rows = np.searchsorted(off, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(s[at].view(np.int64)), b.column(0).take(pa.array(rows))], names=["run", "dig"])

    # the digest as a long keeps both counts in hash aggregates; it only tells equal texts apart
    pairs = (docs.select(F.xxhash64(F.col(text_col)).alias("dig"), F.col(text_col).alias("text"))
             .mapInArrow(occurrences, "run long, dig long").groupBy("run", "dig").agg(F.lit(1).alias("x")))
    out = held(pairs.groupBy("run").agg(F.sum("x").alias("n")).where(F.col("n") >= least), "frequent-runs")
    if out.count() > MAX_FREQUENT:
        return none
    rows = out.toArrow()
    drop_held(out)
    run = rows.column("run").to_numpy().view(np.uint64)
    order = np.argsort(run)
    return run[order], rows.column("n").to_numpy()[order], total


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets of an Arrow list column without nulls."""
    off = col.offsets.to_numpy().astype(np.int64)
    return col.flatten().to_numpy(), off - off[0]


def _places(runs: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``runs`` are among the sorted ones, and the places of those there."""
    if not len(among):
        return np.zeros(len(runs), dtype=bool), np.zeros(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(among, runs), len(among) - 1)
    hit = among[at] == runs
    return hit, at[hit]


def _dealt(key: np.ndarray, text: np.ndarray, runs: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row for each part that these runs fall in: the keys of its texts, how many runs each has there, the runs."""
    part = (runs % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, text = part[order], text[order]
    row = np.flatnonzero(np.diff(part, prepend=-1))
    own = np.flatnonzero((np.diff(part, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    ends = lambda at, n: pa.array(np.append(at, n).astype(np.int32))
    owners = ends(np.searchsorted(own, row), len(own))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[row]), pa.ListArray.from_arrays(owners, pa.array(key[text[own]])),
         pa.ListArray.from_arrays(owners, pa.array(np.diff(np.append(own, len(part))).astype(np.int32))),
         pa.ListArray.from_arrays(ends(row, len(part)), pa.array(runs[order].view(np.int64)))],
        names=["part", "keys", "lens", "runs"])


def _deal(frequent: np.ndarray, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        keys, texts, runs, size, rows = [], [], [], 0, 0
        for b in batches:
            s, off = shingle_hashes(*word_hashes(*text_buffer(b.column(1))), WIDTH)
            s, _, off = _distinct(s, off)
            rare = ~_places(s, frequent)[0]
            keys.append(b.column(0).to_numpy())
            texts.append(np.repeat(np.arange(rows, rows + len(off) - 1), np.diff(off))[rare])
            runs.append(s[rare])
            size, rows = size + len(runs[-1]), rows + len(off) - 1
            if size >= DEALT:
                yield _dealt(*map(np.concatenate, (keys, texts, runs)), parts)
                keys, texts, runs, size, rows = [], [], [], 0, 0
        if size:
            yield _dealt(*map(np.concatenate, (keys, texts, runs)), parts)
    return run


def _shared(group: pa.Table) -> pa.Table:
    """Of all runs of a part: those that several texts hold, a row for each of these, and how many they are."""
    keys, lens, runs = (group.column(c).combine_chunks().flatten().to_numpy() for c in ("keys", "lens", "runs"))
    keys, first, text = np.unique(keys, return_index=True, return_inverse=True)
    once = np.zeros(len(text), dtype=bool)
    once[first] = True                                           # equal texts have equal runs: one counts
    owner = np.repeat(np.where(once, text, -1).astype(np.int32), lens)
    found = []
    for lo in range(0, 1 << 8, 1 << 5):                          # a slice of the hashes at a time
        at = np.flatnonzero((owner >= 0) & ((runs >> 48 & 0xE0) == lo))
        at = at[np.argsort(runs[at])]
        same = runs[at]
        cut = np.flatnonzero(np.append(True, same[1:] != same[:-1])) if len(same) else np.zeros(0, np.int64)
        n = np.diff(np.append(cut, len(same)))
        n = np.repeat(n, n)
        found.append((owner[at[n > 1]], same[n > 1], n[n > 1]))
    owner, runs, n = map(np.concatenate, zip(*found))
    return pa.Table.from_arrays([pa.array(keys[owner]), pa.array(runs), pa.array(n)], names=["key", "run", "n"])


def shared_runs(docs: DataFrame, text_col: str, frequent: np.ndarray, total: int) -> DataFrame:
    """key (xxhash64 of a text), runs, counts: the runs of each text that other texts hold, too, the
    frequent ones left out, and how many distinct texts hold them."""
    parts = max(1, math.ceil(total / PART_RUNS))
    found = (docs.select(F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
             .mapInArrow(_deal(frequent, parts), "part int, keys array<long>, lens array<int>, runs array<long>")
             .groupBy("part").applyInArrow(_shared, "key long, run long, n long"))
    return held(found.groupBy("key").agg(F.collect_list(F.struct("run", "n")).alias("x"))
                .select("key", F.col("x.run").alias("runs"), F.col("x.n").alias("counts")), "shared-runs")


class Weights:
    """Weight of runs: their times by ln(1 + N / df)."""

    def __init__(self, runs: np.ndarray, counts: np.ndarray, texts: int):
        self.runs, self.texts, self.level = runs, texts, math.log1p(texts)
        self.idf = np.log1p(texts / counts) if len(runs) else np.zeros(0)

    def of(self, runs: np.ndarray, times: np.ndarray, shared: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """``shared`` and ``counts`` are of the texts that ``runs`` are of."""
        w = np.full(len(runs), self.level)
        hit, at = _places(runs, self.runs)
        w[hit] = self.idf[at]
        order = np.argsort(shared)
        hit, at = _places(runs, shared[order])
        w[hit] = np.log1p(self.texts / counts[order][at])
        return w * times


def _distinct(s: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct runs of each text, their times, and the new offsets."""
    s = s.copy()
    for a, b in zip(off[:-1], off[1:]):
        s[a:b].sort()
    first = np.ones(len(s), dtype=bool)
    first[1:] = s[1:] != s[:-1]
    first[off[:-1][np.diff(off) > 0]] = True
    at = np.flatnonzero(first)
    return s[at], np.diff(np.append(at, len(s))), np.searchsorted(at, off)


# ----------------------------------------------------------------- sampling
class Sampler:
    """Improved consistent weighted sampling; the variates of a (run, sample)
    are picked by 16 bits of its hash from a fixed table, ties are
    broken by 32 more bits."""

    def __init__(self, samples: int, level: float):
        u = (stream64(37, 5 << 16) >> np.uint64(11)).astype(np.float64).reshape(5, -1)
        u = (u + 0.5) / (1 << 53)
        self.r, self.ln_c = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3]))
        self.beta = u[4]
        self.seeds = stream64(41, samples)
        self.plain = self.keys(np.arange(1 << 16), np.full(1 << 16, level))
        self.level = level

    def keys(self, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """ln a as the high half of an ordered 64-bit word."""
        r, beta = self.r[at], self.beta[at]
        t = np.floor(np.log(weight) / r + beta)
        a = (self.ln_c[at] - r * (t - beta) - r).astype(np.float32).view(np.uint32)
        a = np.where(a >> 31, ~a, a | np.uint32(1 << 31))
        return a.astype(np.uint64) << _U32

    def draw(self, runs: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Samples x texts: the word of the smallest a; ``starts`` are of texts with runs."""
        odd = np.flatnonzero(weight != self.level)
        out = np.empty((len(self.seeds), len(starts)), dtype=np.uint64)
        for k, seed in enumerate(self.seeds):
            h = (runs ^ seed) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> _U32
            h *= np.uint64(0xC4CEB9FE1A85EC53)
            at = (h >> np.uint64(48)).astype(np.int64)
            key = self.plain[at]
            if len(odd):
                key[odd] = self.keys(at[odd], weight[odd])
            key |= h & np.uint64(0xFFFFFFFF)
            out[k] = np.minimum.reduceat(key, starts)
        return out


def _signatures(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(BANDS * ROWS, weights.level)
        turn = stream64(43, ROWS) | np.uint64(1)
        for b in batches:
            s, off = shingle_hashes(*word_hashes(*text_buffer(b.column("text"))), WIDTH)
            s, times, off = _distinct(s, off)
            shared, counts = _lists(b.column("runs"))[0].view(np.uint64), _lists(b.column("counts"))[0]
            full = np.flatnonzero(np.diff(off))
            bands = np.zeros((BANDS, len(off) - 1), dtype=np.uint64)
            codes = np.zeros((len(off) - 1, 8 * CODES), dtype=np.uint8)
            if len(full):
                drawn = sampler.draw(s, weights.of(s, times, shared, counts), off[:-1][full])
                codes[full, :BANDS * ROWS] = (drawn & np.uint64(0xFF)).T
                for i in range(BANDS):
                    part = drawn[i * ROWS:(i + 1) * ROWS] * turn[:, None]
                    bands[i, full] = mix64(part.sum(axis=0) + np.uint64(i))
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array(np.diff(off) > 0)]
                + [pa.array(x.view(np.int64)) for x in bands]
                + [pa.array(np.ascontiguousarray(x)) for x in codes.view(np.int64).T],
                names=["node", "full", *(f"b{i}" for i in range(BANDS)), *(f"s{i}" for i in range(CODES))])
    return run


# ------------------------------------------------------------- verification
def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node's text once, where rows repeat id and text (they lie in one task)."""
    seen: set[int] = set()
    for b in batches:
        nodes = b.column(0).to_pylist()
        first = [n not in seen and not seen.add(n) for n in nodes]
        yield b.filter(pa.array(first, pa.bool_()))


class Vectors:
    """Weighted runs of texts, and their weighted Jaccard similarity."""

    def __init__(self, weights: Weights):
        self.weights = weights

    def of(self, b: pa.RecordBatch):
        """Of a batch with text, runs and counts: a function that gives the vector of a row."""
        data, off = text_buffer(b.column("text"))
        (shared, cut), (counts, _) = _lists(b.column("runs")), _lists(b.column("counts"))

        def row(i: int) -> tuple[np.ndarray, np.ndarray, float]:
            text, at = data[off[i]:off[i + 1]], slice(cut[i], cut[i + 1])
            s, ends = shingle_hashes(*word_hashes(text, np.array([0, len(text)])), WIDTH)
            s, times, _ = _distinct(s, ends)
            w = self.weights.of(s, times, shared[at].view(np.uint64), counts[at])
            return s, w, float(w.sum())
        return row

    @staticmethod
    def alike(a: tuple, b: tuple) -> float:
        _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
        both = float(np.minimum(a[1][x], b[1][y]).sum())
        return both / max(a[2] + b[2] - both, 1e-300)


_LINKS = "u long, v long"


def _links(u: list, v: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _hub_links(weights: Weights, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, group, hub = Vectors(weights), None, None
        for b in batches:
            vector = vectors.of(b)
            hubs, salts, nodes = (b.column(c).to_numpy() for c in ("hub", "salt", "node"))
            u, v = [], []
            for i in range(len(nodes)):
                own = vector(i)
                if nodes[i] == hubs[i]:                        # sorted first in its group
                    group, hub = (hubs[i], salts[i]), own
                    continue
                if group != (hubs[i], salts[i]):
                    raise RuntimeError("a group lacks its hub")
                if vectors.alike(hub, own) >= threshold - 1e-12:
                    u.append(hubs[i])
                    v.append(nodes[i])
            yield _links(u, v)
    return run


def hub_links(met: DataFrame, texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """Links (u, v) between each bucket's hub and its other nodes. A hub's members
    are dealt to tasks of bounded size, each of which gets the hub's text once."""
    best = F.max(F.struct("degree", (-F.col("node")).alias("node")))
    hub = held(met.groupBy("band", "hash").agg((-best["node"]).alias("hub")), "hubs")
    pairs = held(met.join(hub, ["band", "hash"]).where("node <> hub").select("hub", "node").distinct(), "hub-pairs")
    parts = F.ceil(F.count(F.lit(1)) / MEMBERS_PER_TASK).cast("int")
    sizes = held(pairs.groupBy("hub").agg(parts.alias("parts")), "hub-sizes")
    members = pairs.join(sizes, "hub").select(
        "hub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("salt"), "node")
    own = sizes.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"),
                       F.col("hub").alias("node"))
    dealt = (members.unionByName(own).join(texts, "node")
             .repartition(tasks(met.sparkSession), "hub", "salt")
             .sortWithinPartitions("hub", "salt", F.col("node") != F.col("hub"), "node")
             .select("hub", "salt", "node", "text", "runs", "counts"))
    return dealt.mapInArrow(_hub_links(weights, threshold), _LINKS)


class Group:
    """Nodes of one (band, hash, x, y): the rest's nodes first, each with the partners that may be near."""

    def __init__(self, band: int, rows: list[tuple]):
        self.rows = sorted(rows, key=lambda r: not r[4])          # (node, component, bands, codes, rest, ...)
        self.first = sum(r[4] for r in rows)
        self.component = np.array([r[1] for r in self.rows])
        self.bands = np.array([r[2] for r in self.rows])[:, :band]
        self.codes = np.array([r[3] for r in self.rows])

    def partners(self, i: int) -> np.ndarray:
        """Of row i: later rows of another component that it meets in no earlier band and agrees with on enough samples."""
        ok = self.component[i + 1:] != self.component[i]
        ok &= ~(self.bands[i + 1:] == self.bands[i]).any(axis=1)
        ok &= (self.codes[i + 1:] == self.codes[i]).sum(axis=1) >= LEAST
        return i + 1 + np.flatnonzero(ok)


_KEY = ("band", "hash", "x", "y")
_ROW = "band int, hash long, x int, y int, node long, component long, bands array<long>, codes array<long>, rest boolean"


def _groups(batches: Iterator[pa.RecordBatch], extra) -> Iterator[Group | None]:
    """The groups of a task in order of their keys; None at the end of each batch. ``extra`` gets
    (batch, row) and returns what else a row holds."""
    key, rows = None, []
    for b in batches:
        keys = list(zip(*(b.column(c).to_pylist() for c in _KEY)))
        node, component, rest = (b.column(c).to_pylist() for c in ("node", "component", "rest"))
        bands = np.asarray(b.column("bands").flatten()).reshape(len(node), BANDS)
        codes = np.ascontiguousarray(b.column("codes").flatten()).reshape(len(node), CODES).view(np.uint8)[:, :BANDS * ROWS]
        for i, k in enumerate(keys):
            if k != key:
                if rows:
                    yield Group(key[0], rows)
                key, rows = k, []
            rows.append((node[i], component[i], bands[i], codes[i], rest[i], *extra(b, i)))
        yield None
    if rows:
        yield Group(key[0], rows)
    yield None


def _hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of nodes that have a partner."""
    kept: list[pa.RecordBatch] = []
    for g in _groups(batches, lambda b, i: (b.slice(i, 1),)):
        if g is None:
            if kept:
                yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            kept = []
            continue
        keep = np.zeros(len(g.rows), dtype=bool)
        for i in range(g.first):
            near = g.partners(i)
            if len(near):
                keep[i] = keep[near] = True
        kept += [g.rows[i][5] for i in np.flatnonzero(keep)]


def _group_links(weights: Weights, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, buffers = Vectors(weights), {}

        def vector(b, i):
            if buffers.get("of") is not b:
                buffers["of"], buffers["row"] = b, vectors.of(b)
            return (buffers["row"](i),)

        u, v = [], []
        for g in _groups(batches, vector):
            if g is None:
                yield _links(u, v)
                u, v = [], []
                continue
            root: dict[int, int] = {}

            def find(c: int) -> int:
                while root.setdefault(c, c) != c:
                    c = root[c]
                return c
            for i in range(g.first):
                a = g.rows[i]
                for j in g.partners(i):
                    c = g.rows[j]
                    if find(a[1]) != find(c[1]) and vectors.alike(a[5], c[5]) >= threshold - 1e-12:
                        u.append(a[0])
                        v.append(c[0])
                        root[find(a[1])] = find(c[1])
    return run


def rest_links(met: DataFrame, label: DataFrame, texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """Links (u, v) across the components of a bucket: nodes outside its largest
    component (the rest, in blocks) are compared with the blocks of the largest and with each other."""
    pool = held(met.join(label, "node"), "labelled")
    who = [F.bit_xor(F.xxhash64("node", F.lit(k))) for k in range(2)]
    per = pool.groupBy("band", "hash", "component").agg(F.count(F.lit(1)).alias("n"), *(w.alias(f"w{k}") for k, w in enumerate(who)))
    top = F.max(F.struct("n", "component"))
    # buckets of several bands often hold the same nodes (told by two 64-bit hashes): the first one serves
    mixed = (per.groupBy("band", "hash").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), top.alias("top"),
                                             F.bit_xor("w0").alias("w0"), F.bit_xor("w1").alias("w1"))
             .where("parts > 1").groupBy("w0", "w1", "n").agg(F.min(F.struct("band", "hash", "top")).alias("b")))
    mixed = held(mixed.select("n", "b.*")
                 .select("band", "hash", F.col("top.component").alias("top"),
                         F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("nr"),
                         F.ceil(F.col("top.n") / BLOCK).cast("int").alias("nt")), "mixed")
    x = (pool.join(mixed, ["band", "hash"]).withColumn("rest", F.col("component") != F.col("top"))
         .withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("rest"), F.col("nr")).otherwise(F.col("nt"))).cast("int")))
    blocks = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # groups (x, y): x a block of the rest; y a block of the rest (y >= x, counted from 0) or of the largest (from -1 down)
    to = F.when(F.col("rest"), F.concat(
        F.transform(blocks("nr"), lambda y: F.struct(F.least(y, F.col("own")).alias("x"), F.greatest(y, F.col("own")).alias("y"))),
        F.transform(blocks("nt"), lambda y: F.struct(F.col("own").alias("x"), (-1 - y).alias("y")))
    )).otherwise(F.transform(blocks("nr"), lambda r: F.struct(r.alias("x"), (-1 - F.col("own")).alias("y"))))
    def grouped(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks(met.sparkSession), *_KEY).sortWithinPartitions(*_KEY, "node")
    rows = grouped(x.select("band", "hash", "node", "component", "bands", "codes", "rest", F.explode(to).alias("to"))
                   .select("band", "hash", "to.x", "to.y", "node", "component", "bands", "codes", "rest"))
    hopeful = held(rows.mapInArrow(_hopeful, _ROW), "near-nodes")
    return grouped(hopeful.join(texts, "node")).mapInArrow(_group_links(weights, threshold), _LINKS)


# ------------------------------------------------------------------- groups
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per distinct text: dig (its digest), id (its smallest document id),
    copies, group_dig and group_id (of the kept text of the group)."""
    own = docs.select(F.col(id_col).alias("id"), digest(text_col).alias("dig"), F.col(text_col).alias("text"))
    nodes = held(own.groupBy("dig").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"),
                                        F.min(F.xxhash64("text")).alias("key"))
                 .withColumn("node", F.monotonically_increasing_id()), "nodes")
    texts = nodes.count()
    runs, counts, total = frequent_runs(docs, text_col, texts)
    weights = Weights(runs, counts, texts)
    shared = shared_runs(docs, text_col, runs, total)
    none = F.array().cast("array<long>")
    known = held(nodes.join(shared, "key", "left").select(
        "node", F.col("dig").alias("d"), F.col("id").alias("i"),
        F.coalesce("runs", none).alias("runs"), F.coalesce("counts", none).alias("counts")), "node-runs")
    drop_held(shared)

    def bodies_of(some: DataFrame) -> DataFrame:
        return (own.join(some.hint("shuffle_hash"), (own["dig"] == some["d"]) & own["id"].eqNullSafe(some["i"]))
                .select("node", "text", "runs", "counts"))

    bands, codes = [f"b{i}" for i in range(BANDS)], [f"s{i}" for i in range(CODES)]
    sign = _signatures(weights)
    # one function, as each mapInArrow of a chain has Python workers of its own
    drawn = held(bodies_of(known).mapInArrow(lambda batches: sign(_once(batches)), "node long, full boolean, "
                                             + ", ".join(f"{b} long" for b in bands + codes)), "signatures")

    # nodes that meet others: their buckets, bands, and how many nodes they meet (the degree)
    rows = drawn.where("full").select("node", F.posexplode(F.array(*bands)).alias("band", "hash"))
    # held, so that both sides of the join below are plain exchanges that can be split
    count = held(rows.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bucket-sizes")
    meets = held(rows.join(count, ["band", "hash"]).groupBy("node")
                 .agg(F.sum("n").alias("degree"), F.collect_list(F.struct("band", "hash")).alias("at"))
                 .join(drawn.select("node", F.array(*bands).alias("bands"), F.array(*codes).alias("codes")), "node"),
                 "meeting-nodes")
    met = (meets.select("node", "bands", "codes", "degree", F.explode("at").alias("at"))
           .select("node", "bands", "codes", "degree", "at.band", "at.hash"))
    bodies = held(bodies_of(known.join(meets.select("node"), "node"))
                  .mapInArrow(_once, "node long, text string, runs array<long>, counts array<long>"), "texts")

    linked = connected_components(hub_links(met, bodies, weights, threshold))
    label = held(meets.select("node").join(linked, "node", "left")
                 .select("node", F.coalesce("component", "node").alias("component")), "labels")
    more = held(rest_links(met, label, bodies, weights, threshold), "rest-links")
    if not more.isEmpty():                           # they join components of the first step
        side = lambda c: label.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        joined = connected_components(more.join(side("u"), "u").join(side("v"), "v")
                                      .select(F.col("cu").alias("u"), F.col("cv").alias("v")))
        joined = joined.select(F.col("node").alias("component"), F.col("component").alias("joined"))
        label = held(label.join(joined, "component", "left")
                     .select("node", F.coalesce("joined", "component").alias("component")), "labels")

    grouped = held(nodes.select("node", "dig", "id", "copies").join(label, "node", "left")
                   .withColumn("component", F.coalesce("component", "node")), "grouped")
    # the kept text of a group: smallest id, null ids last
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "dig"))
    kept = held(grouped.groupBy("component").agg(first.alias("k"))
                .select("component", F.col("k.id").alias("group_id"), F.col("k.dig").alias("group_dig")), "kept")
    return grouped.join(kept, "component").select("dig", "id", "copies", "group_id", "group_dig")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The documents, one of each group: all columns of ``docs`` unchanged."""
    groups = near_duplicates(docs, id_col, text_col, threshold)
    best = held(groups.where(F.col("dig") == F.col("group_dig")).select("dig", F.col("id").alias("_id")), "kept")
    rows = docs.select(F.col(id_col).alias("own_id"), digest(text_col).alias("own_dig"), whole_row(docs))
    kept = rows.join(best.hint("shuffle_hash"), (rows["own_dig"] == best["dig"])
                     & rows["own_id"].eqNullSafe(best["_id"]), "left_semi")
    # rows that repeat both id and text: one of them stays
    twice = held(kept.groupBy("own_dig").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("own_dig"), "repeated-rows")
    if twice.isEmpty():
        return kept.select("row.*")
    # by their JSON form, as maps cannot be hashed
    one = (kept.join(twice, "own_dig", "left_semi").groupBy("own_dig")
           .agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row.*"))
    return kept.join(twice, "own_dig", "left_anti").select("row.*").unionByName(one)


def document_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its id, class_id (smallest id of its group), copies
    (documents with its text), kept (rows alike in id and text alike)."""
    groups = held(near_duplicates(docs, id_col, text_col, threshold), "groups")
    rows = docs.select(F.col(id_col).alias("_id"), digest(text_col).alias("dig"))
    return (rows.join(groups, "dig")
            .select(F.col("_id").alias(id_col), F.col("group_id").alias("class_id"), "copies",
                    ((F.col("dig") == F.col("group_dig")) & F.col("_id").eqNullSafe(F.col("group_id"))).alias("kept")))
