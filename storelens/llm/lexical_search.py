"""Ranked lexical search: exact inner products through sparse ball trees.

A text's terms are the runs of ASCII letters, digits and all characters beyond
ASCII, with A-Z lowered. A document scores, for the terms of a query item with
repeats, the sum of weight(term) * ((10^9 * tf) div (1000 * tf + 8 * m)), where m
follows the document's length and weight the number of documents that hold the
term: an inner product of the item's term counts with a sparse vector of integers.

Documents keep the terms that some item holds, which changes no inner product.
Each task cuts its documents into blocks and builds a ball tree for each: a
node has its documents' centroid and, for each of a few bands of terms of like weight,
the radius of the documents around it. An item's product with any document of
a node is at most its product with the centroid plus, for each band, the length of the
item's terms that occur in the node times the radius (Cauchy-Schwarz). These
bounds are computed in doubles and widened by far more than their rounding errors. Subtrees are
visited best bound first and left out when their bound is below the k-th score found so far
(or equals it, and all their ids are larger); thresholds go on from block to block of a
task. Leaves are scored in 64-bit integers, so the result is exact whatever is pruned.

Items are a stated query set. They are read in passes of about ``ITEMS`` items and ``ITEM_CHARS``
characters, so the driver and tasks hold a bounded number of items' terms.

Defined cases: null texts and texts without a term are neither counted nor found;
items without a term, or whose terms no document holds, have no rows; every row of
documents is a document (repeated rows are ranked one by one), equal scores are ranked
by id, null ids last; repeated rows of an item are one item, and different texts under one
item id are ranked apart. Ids are integers. Empty tables give an empty result, other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held

TOP = 10
#: Items and their characters of one pass over the documents.
ITEMS, ITEM_CHARS = 256, 1 << 20
#: Documents of a tree, documents of a leaf, bands of terms with a radius each.
BLOCK, LEAF, BANDS = 8192, 64, 24
#: Groups that each item's candidates are cut down in before the last ranking.
SALTS = 64

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text in UTF-8, with repeats."""
    return text.encode().translate(_LOWER).split() if text else []


def _count_terms(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for b in batches:
            n, at, which, often = [], [0], [], []
            for text in b.column(1):
                found = terms(text.as_py())
                n.append(len(found))
                tf = Counter(filter(known.__contains__, found))
                which += map(known.__getitem__, tf)
                often += tf.values()
                at.append(len(which))
            off = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(off, pa.array(which, pa.int32())),
                 pa.ListArray.from_arrays(off, pa.array(often, pa.int64()))], names=["id", "n", "terms", "tf"])
    return run


# ------------------------------------------------------------------ the tree
class Rows:
    """Sparse rows of integers: ``values`` in columns ``cols``, row r from ``off[r]``."""

    def __init__(self, cols: np.ndarray, values: np.ndarray, off: np.ndarray):
        self.cols, self.values, self.off = cols, values, off
        self.n = len(off) - 1

    def pick(self, rows: np.ndarray) -> Rows:
        size = self.off[rows + 1] - self.off[rows]
        off = np.concatenate(([0], np.cumsum(size)))
        at = np.repeat(self.off[rows] - off[:-1], size) + np.arange(off[-1])
        return Rows(self.cols[at], self.values[at], off)

    def dot(self, vector: np.ndarray) -> np.ndarray:
        """Inner product of every row; integers stay integers."""
        total = np.concatenate(([0], np.cumsum(self.values * vector[self.cols])))
        return total[self.off[1:]] - total[self.off[:-1]]


class Tree:
    """A ball tree over ``rows`` whose columns are ordered by weight; ``cuts`` are the bands' borders."""

    def __init__(self, rows: Rows, ids: np.ndarray, null: np.ndarray, width: int, cuts: np.ndarray):
        order = np.lexsort((ids, null))
        self.cuts, self.width = cuts, width
        self.band = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        self.order = np.arange(rows.n)
        self.centres, self.present, self.radii, self.spans, self.children = [], [], [], [], []
        rows, ids, null = rows.pick(order), ids[order], null[order]
        self._grow(rows, np.arange(rows.n), 0)
        self.rows, self.ids, self.null = rows.pick(self.order), ids[self.order], null[self.order]
        self.first = [min(zip(self.null[a:b].tolist(), self.ids[a:b].tolist())) for a, b in self.spans]

    def _grow(self, part: Rows, places: np.ndarray, at: int) -> int:
        """A node for ``part`` (rows ``places``, in order of ids), whose documents stand from ``at`` on."""
        node, v = len(self.spans), part.values.astype(np.float64)
        centre = np.bincount(part.cols, v, self.width) / part.n
        row = np.repeat(np.arange(part.n), np.diff(part.off))
        bands = len(self.cuts) - 1
        cell = row * bands + self.band[part.cols]
        # squared distance to the centre by band: |x|^2 - 2xc + |c|^2, and what rounding may take from it
        own = np.bincount(cell, v * v, part.n * bands).reshape(part.n, bands)
        cross = np.bincount(cell, v * centre[part.cols], part.n * bands).reshape(part.n, bands)
        mid = np.add.reduceat(np.append(centre * centre, 0.0), self.cuts[:-1])
        away = np.maximum(own - 2 * cross + mid, 0.0) + 1e-10 * (own + mid)
        self.spans.append((at, at + part.n))
        self.centres.append(centre)
        self.present.append(centre > 0)
        self.radii.append(np.sqrt(away.max(axis=0)) * (1 + 1e-9))
        self.children.append(())
        if part.n <= LEAF:
            self.order[at:at + part.n] = places
            return node
        far = int(away.sum(axis=1).argmax())
        left = self._nearer(part, own.sum(axis=1), far)
        if not left.any() or left.all():                 # documents alike are halved by their ids
            left = np.arange(part.n) < part.n // 2
        a, b = np.flatnonzero(left), np.flatnonzero(~left)
        one = self._grow(part.pick(a), places[a], at)
        two = self._grow(part.pick(b), places[b], at + len(a))
        self.children[node] = (one, two)
        return node

    def _nearer(self, part: Rows, own: np.ndarray, far: int) -> np.ndarray:
        """Rows nearer to row ``far`` than to the row farthest from that."""
        def distance(k: int) -> np.ndarray:
            v = np.zeros(self.width)
            v[part.cols[part.off[k]:part.off[k + 1]]] = part.values[part.off[k]:part.off[k + 1]]
            return own - 2 * part.dot(v) + own[k]
        one = distance(far)
        other = int(one.argmax())
        return one < distance(other)

    def bounds(self, items: np.ndarray) -> np.ndarray:
        """(items, nodes): no document of the node has a higher product; 0 where no term of the item occurs."""
        out = items @ np.array(self.centres).T
        present, radii = np.array(self.present, dtype=np.float64), np.array(self.radii)
        for g, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            out += np.sqrt((items[:, a:b] ** 2) @ present[:, a:b].T) * radii[:, g]
        return np.where(out > 0, out * (1 + 1e-9) + 1, 0.0)


class Best:
    """The k best (score, id) that an item has met."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def useless(self, bound: float, first: tuple[bool, int]) -> bool:
        """Whether documents of at most this score, and ids from ``first`` on, change nothing."""
        if len(self.score) < self.k:
            return bound < 1
        last = int(self.score[-1])
        return int(bound) < last or (int(bound) == last and first >= (bool(self.null[-1]), int(self.id[-1])))

    def meet(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        good = score >= max(1, int(self.score[-1]) if len(self.score) == self.k else 1)
        if good.any():
            s, i, n = (np.concatenate(x) for x in ((self.score, score[good]), (self.id, ids[good]), (self.null, null[good])))
            order = np.lexsort((i, n, -s))[:self.k]
            self.score, self.id, self.null = s[order], i[order], n[order]


def search(tree: Tree, items: np.ndarray, best: list[Best]) -> int:
    """Improve every item's best documents by those of the tree; returns how many leaves were scored."""
    bounds, scored = tree.bounds(items), 0
    counts = items.astype(np.int64)
    leaves: dict[int, Rows] = {}
    for q, found in enumerate(best):
        heap = [(-bounds[q, 0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if found.useless(-bound, (False, -1 << 63)):
                break                                    # no bound in the heap is higher
            if found.useless(-bound, tree.first[node]):
                continue
            if tree.children[node]:
                for c in tree.children[node]:
                    heapq.heappush(heap, (-bounds[q, c], c))
                continue
            a, b = tree.spans[node]
            if node not in leaves:
                leaves[node] = tree.rows.pick(np.arange(a, b))
            found.meet(leaves[node].dot(counts[q]), tree.ids[a:b], tree.null[a:b])
            scored += 1
    return scored


# ------------------------------------------------------------------ in Spark
def document_values(terms: np.ndarray, tf: np.ndarray, off: np.ndarray, n: np.ndarray, weight: np.ndarray,
                    docs: int, total: int) -> Rows:
    """weight * ((10^9 * tf) div (1000 * tf + 8 * m)) of each document's terms."""
    if len(n) and 75 * int(n.max()) * docs < 1 << 63:
        m = 25 + (75 * n * docs) // max(total, 1)
    else:
        m = np.array([25 + 75 * x * docs // total for x in n.tolist()], dtype=np.int64)
    m = np.repeat(m, np.diff(off))
    return Rows(terms, weight[terms] * ((10 ** 9 * tf) // (1000 * tf + 8 * m)), off)


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, rank, cuts, docs, total, k = shared.value
        best = [Best(k) for _ in range(len(items))]
        waiting: list[pa.RecordBatch] = []

        def block() -> None:
            t = pa.Table.from_batches(waiting).combine_chunks()
            which, tf = (t.column(c).combine_chunks() for c in ("terms", "tf"))
            off = which.offsets.to_numpy().astype(np.int64)
            rows = document_values(which.values.to_numpy(), tf.values.to_numpy(), off, t.column("n").to_numpy(), weight, docs, total)
            rows.cols = rank[rows.cols]
            ids = t.column("id").combine_chunks()
            search(Tree(rows, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), len(rank), cuts),
                   items, best)
            waiting.clear()

        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                waiting.append(b.slice(lo, BLOCK))
                if sum(x.num_rows for x in waiting) >= BLOCK:
                    block()
        if sum(x.num_rows for x in waiting):
            block()
        size = [len(x.score) for x in best]
        if sum(size):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(best)), size), pa.int32()), pa.array(np.concatenate([x.score for x in best])),
                 pa.array(np.concatenate([x.id for x in best]), mask=np.concatenate([x.null for x in best]))],
                names=["item", "score", "id"])
    return run


def _bands(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each term's column by falling weight, and the borders of the bands."""
    rank = np.empty(len(weight), dtype=np.int64)
    rank[np.argsort(-weight, kind="stable")] = np.arange(len(weight))
    return rank, np.unique(np.linspace(0, len(weight), BANDS + 1).astype(np.int64))


def _ranked(docs: DataFrame, items: list[tuple], top: int) -> DataFrame:
    """item (position in ``items``), score and id of the best documents of a bounded list of items."""
    spark = docs.sparkSession
    found = [Counter(terms(text)) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*found)))}
    known = held(docs.mapInArrow(_count_terms(spark.sparkContext.broadcast(vocabulary)),
                                 "id long, n long, terms array<int>, tf array<long>").where("n > 0"), "term-counts")
    n, total = known.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)       # one number for each term of the items
    for r in known.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    weight = np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)
    rank, cuts = _bands(weight)
    counts = np.zeros((len(items), len(vocabulary)))
    for q, tf in enumerate(found):
        for t, c in tf.items():
            counts[q, rank[vocabulary[t]]] = c
    shared = spark.sparkContext.broadcast((counts, weight, rank, cuts, int(n), int(total or 0), top))
    return known.where(F.size("terms") > 0).mapInArrow(_search(shared), "item int, score long, id long")


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """The ``top`` best documents of every item: item, rank (from 1), id, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct()
    size, chars = items.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    passes = max(1, -(-size // ITEMS), -(-(chars or 0) // ITEM_CHARS))
    item_type = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_type}, rank int, {id_col} long, score long")
    for p in range(passes):
        part = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).collect()]
        part = [r for r in part if terms(r[1])]
        if not part:
            continue
        found = _ranked(docs, part, top)
        order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
        salted = found.withColumn("salt", F.spark_partition_id() % SALTS)
        for keys in (["item", "salt"], ["item"]):        # tasks' best, cut down in groups first
            salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, r[0]) for k, r in enumerate(part)], f"item int, item_id {item_type}")
        ranked = salted.join(F.broadcast(names), "item")  # at most a pass of items
        out = out.unionByName(ranked.select("item_id", "rank", F.col("id").alias(id_col), "score"))
    return out
