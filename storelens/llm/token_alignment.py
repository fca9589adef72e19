"""Alignment of two tokenizers' tokens, and how often their ids are linked.

A text is encoded by a byte-level BPE (A, with a blank put before the text)
and by a sentence-piece model (B, which adds that blank itself). The
cumulative ends of the tokens, in bytes, go into one dictionary a side from
end to token number; the keys that both hold, in order, cut the two id
lists into groups, and within each slice the tokens whose bytes overlap are
linked. Within a slice of p and q tokens no inner end is shared, so the links
are the p + q - 1 stretches between neighbouring ends of either side.

How often a pair of ids is linked in the whole corpus is counted in
two levels. Documents are gathered in blocks of a few MB; a block holds its
distinct pairs once, and a document only the places of its pairs in the
block's list. So what is shuffled are the distinct pairs of blocks, not
links, and a pair that occurs everywhere is one row a block. The counts go
back to the blocks, where documents look up their places.

Defined cases: null and empty texts, and texts whose tokens' bytes do not
join to blank + text (such as those with U+2581), have no tokens: zeros and an
empty group string. Strings of special tokens are plain text. Rows are
documents: repeated rows count each time. An empty table gives an empty
result; other columns are ignored. A text is encoded whole, so the longest one
bounds a task's memory; batches and blocks close behind it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held

#: Bytes of text that are aligned at once, and that share one list of pairs.
BATCH_BYTES, BLOCK_BYTES = 1 << 20, 4 << 20
_A_BITS, _B_BITS = 24, 24                            # a pair of ids as one integer
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


# --------------------------------------------------------------- tokenizers
def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable
    Latin-1 characters for themselves, the other bytes in order from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    rest = (b for b in range(256) if b not in set(shown))
    return out | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Ids and token bytes of a byte-level BPE file whose ids follow the order of its merges.

    Such a vocabulary is also a table of ranks, which tiktoken encodes with several times as
    fast to the same ids. Texts with characters beyond U+2FFF go to the tokenizer itself,
    as the two libraries need not know the same versions of the character tables.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        vocab = self.tok.get_vocab()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        ranks = {}
        for piece, i in vocab.items():
            self.bytes[i] = piece.encode() if piece in special else bytes(letters[c] for c in piece)
            if piece not in special:
                ranks[self.bytes[i]] = i
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.far = re.compile("[^\x00-⿿]").search

    def encode(self, text: str) -> np.ndarray:
        if text.isascii() or not self.far(text):
            return np.array(self.fast.encode_ordinary(text), dtype=np.int64)
        return np.array(self.tok.encode(text, add_special_tokens=False).ids)


class Pieces:
    """Ids and token bytes of a sentence-piece model."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece)
            self.bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), dtype=np.int64)


class Joined:
    """Byte strings by number in one buffer, so that many are joined by one gather."""

    def __init__(self, parts: list[bytes]):
        self.length = np.array([len(p) for p in parts], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined bytes of the strings with these numbers, and where each ends."""
        n = self.length[numbers]
        ends = np.cumsum(n)
        at = np.repeat(self.start[numbers] - (ends - n), n)
        at += np.arange(len(at))
        return self.data[at], ends


class Side:
    """One tokenizer with what the alignment looks up by id."""

    def __init__(self, tokens: ByteLevel | Pieces):
        self.encode, self.size, self.tokens = tokens.encode, len(tokens.bytes), Joined(tokens.bytes)


def _written(a: Side, b: Side) -> Joined:
    """Decimal ids with what follows them: ids of A inside and at the end of their group, then those of B."""
    return Joined([f"{i}{end}".encode() for side, ends in ((a, ",|"), (b, ",;")) for end in ends for i in range(side.size)])


_WORKER: dict[tuple[str, str], tuple[Side, Side, Joined]] = {}


def sides(path_a: str, path_b: str) -> tuple[Side, Side, Joined]:
    """Both tokenizers and the written ids, loaded once in a Python worker."""
    if (path_a, path_b) not in _WORKER:
        a, b = Side(ByteLevel(path_a)), Side(Pieces(path_b))
        _WORKER[path_a, path_b] = a, b, _written(a, b)
    return _WORKER[path_a, path_b]


# ---------------------------------------------------------------- alignment
def shared_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Behind how many tokens of either side each common end of a text lies, in order."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    both = list(filter(at_b.__contains__, at_a))         # in the order of the ends, which rise
    return list(map(at_a.__getitem__, both)), list(map(at_b.__getitem__, both))


def slice_links(ends_a: np.ndarray, ends_b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all links, slice by slice. The k-th link of a slice is the stretch
    between the k-th and the next of its inner ends, whichever side they belong to."""
    n = np.diff(stop_a, prepend=0) + np.diff(stop_b, prepend=0) - 1
    first = np.cumsum(n) - n
    inner_a, inner_b = np.ones(len(ends_a), bool), np.ones(len(ends_b), bool)
    inner_a[stop_a - 1] = False
    inner_b[stop_b - 1] = False
    ends = np.concatenate((ends_a[inner_a], ends_b[inner_b]))
    from_a = np.concatenate((np.ones(int(inner_a.sum()), bool), np.zeros(int(inner_b.sum()), bool)))
    from_a = from_a[np.argsort(ends, kind="stable")]  # slices follow each other, so do their inner ends
    step_a, step_b = np.zeros(int(n.sum()), np.int64), np.zeros(int(n.sum()), np.int64)
    later = np.ones(len(step_a), bool)
    later[first] = False                             # a slice's first link, then one step for each inner end
    step_a[later], step_b[later] = from_a, ~from_a
    step_a[first], step_b[first] = 1, 1
    return np.cumsum(step_a) - 1, np.cumsum(step_b) - 1


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    off = np.array([0, *accumulate(map(len, lists))], dtype=np.int64)
    return np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64), off


def _faithful(ids: np.ndarray, off: np.ndarray, tokens: Joined, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which texts (bytes ``data[at[k]:at[k + 1]]``) their tokens' bytes join to."""
    joined, ends = tokens.take(ids)
    ends = np.concatenate(([0], ends))[off]
    ok = np.diff(ends) == np.diff(at)
    if len(joined) == len(data) and ok.all() and np.array_equal(joined, data):
        return ok
    for k in np.flatnonzero(ok):
        ok[k] = np.array_equal(joined[ends[k]:ends[k + 1]], data[at[k]:at[k + 1]])
    return ok


class _Aligned:
    """Counts, written groups and linked pairs of a batch of texts."""

    def __init__(self, texts: list[str | None], a: Side, b: Side, written: Joined):
        self.n = len(texts)
        rows = [k for k, t in enumerate(texts) if t]
        ids_a, ids_b = [a.encode(" " + texts[k]) for k in rows], [b.encode(texts[k]) for k in rows]
        raw = [b" " + texts[k].encode() for k in rows]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        at = np.array([0, *accumulate(map(len, raw))], dtype=np.int64)
        (flat_a, off_a), (flat_b, off_b) = _flat(ids_a), _flat(ids_b)
        ok = _faithful(flat_a, off_a, a.tokens, data, at) & _faithful(flat_b, off_b, b.tokens, data, at)
        if not ok.all():
            keep = np.flatnonzero(ok)
            rows = [rows[k] for k in keep]
            (flat_a, off_a), (flat_b, off_b) = _flat([ids_a[k] for k in keep]), _flat([ids_b[k] for k in keep])
        del raw, data
        ends_a, ends_b = np.cumsum(a.tokens.length[flat_a]), np.cumsum(b.tokens.length[flat_b])
        stop_a, stop_b, n_groups = [], [], np.zeros(len(rows), np.int64)
        for k in range(len(rows)):                       # ends run on over the texts, so do token numbers
            x, y = shared_ends(ends_a[off_a[k]:off_a[k + 1]].tolist(), ends_b[off_b[k]:off_b[k + 1]].tolist())
            stop_a.append(np.array(x, dtype=np.int64) + off_a[k])
            stop_b.append(np.array(y, dtype=np.int64) + off_b[k])
            n_groups[k] = len(x)
        stop_a, stop_b = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (stop_a, stop_b))
        left, right = slice_links(ends_a, ends_b, stop_a, stop_b)
        text_of = np.repeat(np.array(rows, dtype=np.int64), np.diff(off_a))
        self.counts = np.zeros((4, self.n), np.int64)    # tokens of A and B, groups, links
        self.counts[0, rows], self.counts[1, rows], self.counts[2, rows] = np.diff(off_a), np.diff(off_b), n_groups
        self.counts[3] = np.bincount(text_of[left], minlength=self.n)
        self.groups = self._write(written, a.size, b.size, flat_a, flat_b, stop_a, stop_b)
        pair = (text_of[left] << (_A_BITS + _B_BITS)) | (flat_a[left] << _B_BITS) | flat_b[right]
        pair, self.times = np.unique(pair, return_counts=True)
        self.pairs = pair & ((1 << (_A_BITS + _B_BITS)) - 1)
        self.own = np.bincount(pair >> (_A_BITS + _B_BITS), minlength=self.n)

    def _write(self, written: Joined, size_a: int, size_b: int, flat_a, flat_b, stop_a, stop_b) -> pa.Array:
        """Written groups of all texts, without the mark behind a text's last one."""
        group_a = np.searchsorted(stop_a, np.arange(len(flat_a)), side="right")
        group_b = np.searchsorted(stop_b, np.arange(len(flat_b)), side="right")
        code_a, code_b = flat_a.copy(), flat_b + 2 * size_a
        code_a[stop_a - 1] += size_a
        code_b[stop_b - 1] += size_b
        code = np.empty(len(flat_a) + len(flat_b), np.int64)
        code[np.arange(len(flat_a)) + np.concatenate(([0], stop_b))[group_a]] = code_a
        code[np.arange(len(flat_b)) + stop_a[group_b]] = code_b
        data, ends = written.take(code)
        ends = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(self.counts[0] + self.counts[1])))]
        last = ends[1:][np.diff(ends) > 0] - 1
        data = np.delete(data, last)
        off = ends - np.searchsorted(last, ends)
        return pa.LargeStringArray.from_buffers(self.n, pa.py_buffer(off.astype(np.int64).tobytes()),
                                                pa.py_buffer(data.tobytes()))


def _runs(col: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """A column's texts in runs of at most BATCH_BYTES (a longer text alone)."""
    texts, lo, size = col.to_pylist(), 0, 0
    for k, t in enumerate(texts):
        n = len(t.encode()) if t else 0
        if k > lo and size + n > BATCH_BYTES:
            yield lo, texts[lo:k]
            lo, size = k, 0
        size += n
    if texts:
        yield lo, texts[lo:]


def _align(path_a: str, path_b: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = sides(path_a, path_b)
        task = TaskContext.get().partitionId() << 32
        block, size, ids, parts = 0, 0, [], []

        def close() -> pa.RecordBatch:
            """The block's documents, then its list of distinct pairs as a row of its own."""
            pairs, place = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
            times = np.concatenate([p.times for p in parts])
            total = np.bincount(place, times, minlength=len(pairs)).astype(np.int64)
            n = sum(p.n for p in parts)
            off = pa.array(np.concatenate(([0], np.cumsum(np.concatenate([p.own for p in parts])), [len(place)])), pa.int32())
            off2 = pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array([0, len(pairs)], pa.int32())])
            counts = np.concatenate([p.counts for p in parts], axis=1)
            id_col = pa.concat_arrays([*ids, pa.nulls(1, ids[0].type)])
            cols = [pa.array(np.full(n + 1, task + block)), pa.array([True] * n + [False]), id_col,
                    *(pa.array(np.append(c, 0)) for c in counts),
                    pa.concat_arrays([*(p.groups for p in parts), pa.array([""], pa.large_string())]).cast(pa.string()),
                    pa.ListArray.from_arrays(off, pa.array(place.astype(np.int32))),
                    pa.ListArray.from_arrays(off, pa.array(times.astype(np.int32))),
                    pa.ListArray.from_arrays(off2, pa.array(pairs)),
                    pa.ListArray.from_arrays(off2, pa.array(total))]
            return pa.RecordBatch.from_arrays(cols, names=names)

        for batch in batches:
            for lo, texts in _runs(batch.column(1)):
                parts.append(_Aligned(texts, *loaded))
                ids.append(batch.column(0).slice(lo, len(texts)))
                size += sum(map(len, texts)) if None not in texts else sum(len(t or "") for t in texts)
                if size >= BLOCK_BYTES:
                    yield close()
                    block, size, ids, parts = block + 1, 0, [], []
        if parts:
            yield close()
    return run


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Alignment of every whole text, in blocks of documents.

    A row with ``is_doc`` is a document: id, n_a, n_b, n_groups, n_links, groups
    (``a1,a2|b1;a3|b2``: decimal ids of A and B), and the linked id pairs as ``places`` in the
    list of its block and how many ``times`` each. The other row of a block has that list:
    ``pairs`` (A's id * 2^24 + B's id) and their ``totals`` in the block.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    long, ints, longs = T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("block", long), T.StructField("is_doc", T.BooleanType()), T.StructField("id", src.schema["id"].dataType),
        *(T.StructField(c, long) for c in ("n_a", "n_b", "n_groups", "n_links")), T.StructField("groups", T.StringType()),
        T.StructField("places", ints), T.StructField("times", ints), T.StructField("pairs", longs), T.StructField("totals", longs)])
    return src.mapInArrow(_align(path_a, path_b, schema.names), schema)


# ------------------------------------------------------------- corpus counts
def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, is_best): links of each id pair in the corpus; best are the pairs whose
    count is the highest of their B id, ties included."""
    rows = aligned.where("NOT is_doc").select(F.explode(F.arrays_zip("pairs", "totals")).alias("x"))
    count = rows.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.totals").alias("count"))
    top = count.groupBy(F.expr(f"pair & {(1 << _B_BITS) - 1}").alias("b")).agg(F.max("count").alias("top"))
    # one row for each id of B: bounded by its vocabulary
    return (count.join(F.broadcast(top), F.expr(f"pair & {(1 << _B_BITS) - 1}") == F.col("b"))
            .select("pair", "count", (F.col("count") == F.col("top")).alias("is_best")))


def _totals(names: list[str]):
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("pair")
        count = known.column("count").to_numpy()
        best = np.where(known.column("is_best").to_numpy(), 1, 0)
        cols = []
        places, times = (docs.column(c).combine_chunks() for c in ("places", "times"))
        off = places.offsets.to_numpy()
        at, n = places.values.to_numpy(), times.values.to_numpy().astype(np.int64)
        for value in (best, count):
            run_sum = np.concatenate(([0], np.cumsum(n * value[at])))
            cols.append(pa.array(run_sum[off[1:]] - run_sum[off[:-1]]))
        return pa.Table.from_arrays([docs.column(c) for c in names] + cols, names=[*names, "n_best", "count_sum"])
    return run


def link_totals(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents of ``aligned`` with n_best (links whose pair is a best one) and
    count_sum (the corpus counts of all links added up)."""
    listed = aligned.where("NOT is_doc").select(F.col("block").alias("of_block"), F.explode("pairs").alias("pair")).join(counts, "pair")
    docs = aligned.where("is_doc").drop("is_doc", "pairs", "totals")
    keep = [c for c in docs.columns if c not in ("block", "places", "times")]
    schema = T.StructType([docs.schema[c] for c in keep]
                          + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return docs.groupBy("block").cogroup(listed.groupBy("of_block")).applyInArrow(_totals(keep), schema)


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum and the SHA-256 of the written groups."""
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    names = ["block", "is_doc", "id", "n_a", "n_b", "n_groups", "n_links"]
    aligned = held(align(docs, path_a, path_b, id_col, text_col)
                   .select(*names, digest, "places", "times", "pairs", "totals"), "aligned-tokens")
    return link_totals(aligned, pair_counts(aligned)).select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
