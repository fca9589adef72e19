"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length 1 and halved; each half has its own codebook, and the
product of both is a grid of cells. A vector lies in the cell of its
nearest two centroids and visits further cells in the order of the
multi-sequence traversal (rising sum of both halves' squared distances)
until the target recall: the sum at which that share of trial vectors, turned
away from sample vectors to just the threshold's cosine, had their cell
visited. In the visited cells it is compared with every vector by exact
cosine in double precision. Pairs at the threshold are the worst case, and
each pair has two chances (either may visit the other), so the recall is
above the target.

Equal vectors are one node with a count. A cell is dealt to tasks in blocks of
bounded size; a block holds its vectors and streams its visitors. Of the
links a task keeps counts per vector and a spanning forest, never all pairs.

Codebooks and the stopping sum are fitted on at most ``SAMPLE`` nodes; all nodes
are indexed.

Defined cases: null, empty or zero vectors, and vectors with null or
non-finite components, link with nothing (0 links, component and id alike, kept); vectors of different
lengths have no cosine, so each length has an index of its own. Repeated rows are vectors of their own, linked as
copies. Null ids come last in a component and yield a null component only if
it has no other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, tasks
from .components import connected_components

THRESHOLD = 0.9
TARGET_RECALL = 0.99
SAMPLE = 8192
MAX_CODES = 256                  # centroids of a half
NODES_PER_CELL = 512             # wished for; the codebooks grow with the table up to MAX_CODES
BLOCK = 2048                     # vectors held, and visitors streamed, by one group of a task


# ---------------------------------------------------------------- the index
def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)     # squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's rounds, from evenly spaced rows; an empty one takes the row farthest off."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        d = _distances(x, c)
        near = d.argmin(axis=1)
        for i in range(len(c)):
            own = near == i
            if own.any():
                c[i] = x[own].mean(axis=0)
            else:
                far = int(d[np.arange(len(x)), near].argmax())
                c[i], near[far] = x[far], i
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1), 0)


class MultiIndex:
    """Two codebooks and the sum of excess squared distances at which a traversal stops."""

    def __init__(self, sample: np.ndarray, nodes: int, threshold: float = THRESHOLD, target: float = TARGET_RECALL):
        self.split = max(1, sample.shape[1] // 2)
        least = 1 if nodes <= NODES_PER_CELL else 2      # few vectors are one cell, compared with each other
        k = int(min(MAX_CODES, len(sample), max(least, math.ceil(math.sqrt(nodes / NODES_PER_CELL)))))
        self.codes = [_codebook(sample[:, :self.split], k)]
        self.codes.append(_codebook(sample[:, self.split:], k) if sample.shape[1] > 1 else np.zeros((1, 0)))
        self.width = len(self.codes[1])
        self.cells = len(self.codes[0]) * self.width
        # trial vectors at the threshold's cosine, in random directions
        turn = np.random.RandomState(7).standard_normal(sample.shape)
        turn -= (turn * sample).sum(axis=1, keepdims=True) * sample
        norm = np.sqrt((turn * turn).sum(axis=1, keepdims=True))
        trial = threshold * sample + math.sqrt(1 - threshold ** 2) * turn / np.maximum(norm, 1e-12)
        e1, e2 = self._excess(sample)
        cell = self.cell(trial)
        at = np.arange(len(sample))
        cost = np.sort(e1[at, cell // self.width] + e2[at, cell % self.width])
        self.stop = float(cost[min(len(cost) - 1, math.ceil(target * len(cost)) - 1)]) + 1e-12

    def _excess(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d1, d2 = _distances(x[:, :self.split], self.codes[0]), _distances(x[:, self.split:], self.codes[1])
        return d1 - d1.min(axis=1, keepdims=True), d2 - d2.min(axis=1, keepdims=True)

    def cell(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = _distances(x[:, :self.split], self.codes[0]), _distances(x[:, self.split:], self.codes[1])
        return d1.argmin(axis=1) * self.width + d2.argmin(axis=1)

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every visit: cells by rising sum of both excesses up to the stop.

        Both halves' lists are sorted; against the first list's r-th centroid
        the second list is followed while the sum stays within the stop."""
        e1, e2 = self._excess(x)
        o1, o2 = e1.argsort(axis=1, kind="stable"), e2.argsort(axis=1, kind="stable")
        s1, s2 = np.take_along_axis(e1, o1, 1), np.take_along_axis(e2, o2, 1)
        rows, cells = [], []
        for r in range(s1.shape[1]):
            go = np.flatnonzero(s1[:, r] <= self.stop)
            if not len(go):
                break
            ok = s2[go] <= (self.stop - s1[go, r])[:, None]
            i, j = np.nonzero(ok)
            rows.append(go[i])
            cells.append(o1[go[i], r] * self.width + o2[go[i], j])
        return np.concatenate(rows), np.concatenate(cells)


# ------------------------------------------------------------------- nodes
def _vectors(col: pa.Array) -> list[np.ndarray | None]:
    """Usable vectors, others None."""
    out = []
    for v in col.to_pylist():
        x = None
        if v and None not in v:
            y = np.asarray(v, dtype=np.float64)
            if np.isfinite(y).all() and y.any():
                x = y
        out.append(x)
    return out


def _usable(kind: str):
    """Vectors travel in the type of their column (floats are half as wide) and are compared in double."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = _vectors(b.column(1))
            raw = [None if v is None else v.astype(kind).tobytes() for v in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([None if r is None else hashlib.md5(r).digest() for r in raw], pa.binary()),
                 pa.array([0 if v is None else len(v) for v in found], pa.int32()), pa.array(raw, pa.binary())],
                names=["id", "dig", "dim", "vec"])
    return run


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    raw = b"".join(col.to_pylist())
    return np.frombuffer(raw, dtype="<f4" if len(raw) == 4 * dim * len(col) else "<f8").reshape(len(col), dim)


# ----------------------------------------------------------------- postings
def _loads(index: MultiIndex, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = np.zeros(index.cells, np.int64), np.zeros(index.cells, np.int64)
        for b in batches:
            x = _unit(_matrix(b.column(0), dim))
            own += np.bincount(index.cell(x), minlength=index.cells)
            seen += np.bincount(index.visits(x)[1], minlength=index.cells)
        used = np.flatnonzero(own + seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(own[used]), pa.array(seen[used])],
                                         names=["cell", "own", "seen"])
    return run


_POSTING = "cell int, block int, part int, visitor boolean, node long, copies long, home int, visits array<int>, vec binary"


def _postings(index: MultiIndex, dim: int, blocks: np.ndarray, parts: np.ndarray):
    """A node goes to one block of its cell (in each part), a visitor to one part of the visited cell (in each block)."""
    schema = pa.schema([("cell", pa.int32()), ("block", pa.int32()), ("part", pa.int32()), ("visitor", pa.bool_()),
                        ("node", pa.int64()), ("copies", pa.int64()), ("home", pa.int32()), ("visits", pa.list_(pa.int32())),
                        ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, copies = b.column(0).to_numpy(), b.column(1).to_numpy()
            x = _unit(_matrix(b.column(2), dim))
            home = index.cell(x)
            row, cell = index.visits(x)
            salt = (node * 2654435761) >> 7 & 0x7FFFFFFF
            order = np.argsort(row, kind="stable")
            lists = np.split(cell[order], np.searchsorted(row[order], np.arange(1, len(node))))

            def emit(r, c, block, part, visitor):
                for lo in range(0, len(r), 4096):
                    k = slice(lo, lo + 4096)
                    own = pa.array([None if visitor else lists[i] for i in r[k]], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[k], pa.int32()), pa.array(block[k], pa.int32()), pa.array(part[k], pa.int32()),
                         pa.array(np.full(len(r[k]), visitor)), pa.array(node[r[k]]), pa.array(copies[r[k]]),
                         pa.array(home[r[k]], pa.int32()), own, b.column(2).take(pa.array(r[k]))], schema=schema)

            def spread(r, times):
                """Repeat each entry ``times`` times, numbered from 0."""
                return np.repeat(r, times), np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)

            r, part = spread(np.arange(len(node)), parts[home])
            yield from emit(r, home[r], salt[r] % blocks[home[r]], part, False)
            k, block = spread(np.arange(len(row)), blocks[cell])
            yield from emit(row[k], cell[k], block, salt[row[k]] % parts[cell[k]], True)
    return run


def _links(dim: int, threshold: float):
    """Per batch: (u, v, n): n links counted for node u, and u joined with v in the forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, base = None, None
        gathered: list[tuple] = []
        for b in batches:
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "block", "part", "visitor", "node", "copies", "home")]
            cell, block, part, visitor, node, copies, home = cols
            x = _unit(_matrix(b.column("vec"), dim))
            lists = b.column("visits")
            change = np.flatnonzero((np.diff(cell) != 0) | (np.diff(block) != 0) | (np.diff(part) != 0)
                                    | (np.diff(visitor.astype(np.int8)) != 0)) + 1
            u, v, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for lo, hi in zip([0, *change], [*change, len(cell)]):
                now = (cell[lo], block[lo], part[lo])
                if now != key:
                    key, gathered, base = now, [], None
                if not visitor[lo]:
                    seen = lists.slice(lo, hi - lo).to_pylist()
                    gathered.append((node[lo:hi], copies[lo:hi], home[lo:hi], x[lo:hi], seen))
                    base = None
                    continue
                if not gathered:
                    continue                          # a visited cell without vectors
                if base is None:
                    lists_b = [s for g in gathered for s in g[4]]
                    wide = max(map(len, lists_b))
                    seen_b = np.full((len(lists_b), wide), -1, np.int32)
                    for i, s in enumerate(lists_b):
                        seen_b[i, :len(s)] = s
                    base = (*(np.concatenate([g[k] for g in gathered]) for k in range(4)), seen_b)
                bn, bc, _, bx, bseen = base
                for s in range(lo, hi, BLOCK // 4):
                    e = min(hi, s + BLOCK // 4)
                    hit = (x[s:e] @ bx.T >= threshold) & (node[s:e, None] != bn)
                    q, y = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
                    if not len(q):
                        continue
                    hit = hit[np.ix_(q, y)]
                    qn, qc, qh = node[s:e][q], copies[s:e][q], home[s:e][q]
                    # y counts the visitor too, unless y visits that one's cell itself
                    homes, at = np.unique(qh, return_inverse=True)
                    visits = (bseen[y][:, :, None] == homes).any(axis=1)[:, at]
                    count_q = hit @ bc[y]
                    count_y = (hit.T & ~visits) @ qc
                    low, low_q = np.arange(len(y)), None
                    while True:                       # components of this block's links, by smallest label
                        low_q = np.where(hit, low, len(y)).min(axis=1)
                        new = np.minimum(low, np.where(hit, low_q[:, None], len(y)).min(axis=0))
                        if (new == low).all():
                            break
                        low = new
                    u += [qn, bn[y]]
                    v += [bn[y][low_q], bn[y][low]]
                    n += [count_q, count_y]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in (u, v, n)], names=["u", "v", "n"])
    return run


# --------------------------------------------------------------------- dedup
def _length_links(nodes: DataFrame, dim: int, n: int, threshold: float, target_recall: float) -> DataFrame:
    """(u, v, n): links among ``n`` different vectors of one length."""
    spark = nodes.sparkSession
    least = min(1.0, 1.2 * SAMPLE / n)
    sample = (nodes.where(F.pmod(F.xxhash64("dig"), F.lit(1 << 30)) < int(least * (1 << 30)))
              .orderBy("dig").limit(SAMPLE).select("vec").toArrow().column("vec").combine_chunks())
    if not len(sample):
        sample = nodes.limit(SAMPLE).select("vec").toArrow().column("vec").combine_chunks()
    index = MultiIndex(_unit(_matrix(sample, dim)), n, threshold, target_recall)
    shared = spark.sparkContext.broadcast(index)       # 2 * MAX_CODES centroids at most
    loads = (nodes.select("vec").mapInArrow(lambda b: _loads(shared.value, dim)(b), "cell int, own long, seen long")
             .groupBy("cell").agg(F.sum("own").alias("own"), F.sum("seen").alias("seen")).collect())   # MAX_CODES^2 rows at most
    blocks, parts = np.ones(index.cells, np.int64), np.ones(index.cells, np.int64)
    for r in loads:
        blocks[r["cell"]] = max(1, -(-r["own"] // BLOCK))
        parts[r["cell"]] = max(1, -(-r["seen"] // (2 * BLOCK)))
    dealt = (nodes.select("node", "copies", "vec")
             .mapInArrow(lambda b: _postings(shared.value, dim, blocks, parts)(b), _POSTING)
             .repartition(tasks(spark), "cell", "block", "part")
             .sortWithinPartitions("cell", "block", "part", "visitor"))
    return held(dealt.mapInArrow(_links(dim, threshold), "u long, v long, n long"), "links")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row per vector: its id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    src = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    id_type = src.schema["id"].dataType.simpleString()
    kind = "<f4" if src.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"
    rows = held(src.mapInArrow(_usable(kind), f"id {id_type}, dig binary, dim int, vec binary"), "vectors")
    nodes = held(rows.where(F.col("dig").isNotNull()).groupBy("dig").agg(
        F.first("dim").alias("dim"), F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    # vectors of different lengths have no cosine: one index for each length
    found = spark.createDataFrame([], "u long, v long, n long")
    for r in nodes.groupBy("dim").count().orderBy("dim").collect():
        if r["count"] > 1:
            found = found.unionByName(_length_links(nodes.where(F.col("dim") == r["dim"]), r["dim"], r["count"], threshold, target_recall))
    counts = found.groupBy("u").agg(F.sum("n").alias("n")).withColumnRenamed("u", "node")
    label = connected_components(found.select("u", "v"))
    grouped = (nodes.select("node", "dig", "id", "copies").join(counts, "node", "left").join(label, "node", "left")
               .withColumn("component", F.coalesce("component", "node")))
    grouped = held(grouped, "grouped")
    first = held(grouped.groupBy("component").agg(F.min("id").alias("component_id")), "components")
    node_rows = held(grouped.join(first, "component").select(
        "dig", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "node-results")
    out = rows.select("id", "dig").join(node_rows, "dig", "left")
    alone = F.col("n_links").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
