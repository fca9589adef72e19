"""Best-fit packing by exact-complement hashing.

A document is its token ids and one end id; a document longer than the
capacity is cut into full pieces and a rest. How pieces fill sequences
depends on their lengths alone, so it is decided on the histogram of
lengths (``capacity`` counts, whatever the number of documents): the
sums of one, two and three available lengths are indexed, combinations
that exactly fill a gap are consumed as often as the counts allow, and
what then remains is placed best fit. Spark tokenizes, counts, numbers the pieces of each
length (in salted groups, so that a length that a third of the pieces
share is numbered by many tasks) and hands out the places.

Defined cases: null and empty texts are documents of the end id alone;
repeated rows are packed once for each row; an empty table gives an
empty result; other columns are ignored. ``piece``, ``start``,
``length``, ``ids_crc32`` depend on the text alone, places also on the
other rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held, kept, tasks

CAPACITY = 4096
END_ID = 1
#: Words, and pieces of words, whose ids a Python worker remembers at most (beside those of the texts at hand), and
#: letters of one on average. Pieces cost more to encode than words to put together.
CACHE_WORDS, CACHE_PIECES, CACHE_LETTERS = 500_000, 1_000_000, 16


# ---------------------------------------------------------------- tokenizing
#: The tokenizer's own rule for splitting a normalised word before its merges.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


class _Memory:
    """Ids of words, in two halves: when the newer is full, the older is forgotten, so words that keep coming stay."""

    def __init__(self, size: int) -> None:
        self.half = size // 2
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.letters = 0

    def __iter__(self) -> Iterator[str]:
        return iter({**self.old, **self.new})

    def unknown(self, words: set[str]) -> set[str]:
        """The words without ids; the ids of all others are in ``new`` then."""
        if len(self.new) > self.half or self.letters > self.half * CACHE_LETTERS:
            self.new, self.old, self.letters = {}, self.new, 0
        words = words.difference(self.new)
        self.letters += sum(map(len, words))
        if not self.old:
            return words
        fresh = words.difference(self.old)
        again = words.difference(fresh)
        self.new.update(zip(again, map(self.old.__getitem__, again)))
        return fresh


class WordTokens:
    """Ids of whole texts, word by word with a bounded memory.

    The tokenizer treats words between blanks and line ends separately, and
    within a word each piece of its split rule. Words are remembered as they
    stand, pieces in lower case; new pieces are encoded together and told apart
    by the ids that end a piece. Words beyond the Latin letters below
    U+0250, with marks to compose or with a special token go to
    the tokenizer as they are.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.split = regex.compile(PIECES).findall
        self.plain = regex.compile(r"[\x21-\x7E\xA1-\u012F\u0131-\u024F]+").fullmatch
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words, self.pieces = _Memory(CACHE_WORDS), _Memory(CACHE_PIECES)

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_pieces(self, new: list[str]) -> None:
        known = self.pieces.new
        for i in range(0, len(new), 2048):
            part = new[i:i + 2048]
            raw = self._encode(" ".join(part))
            stop = (4 * (np.flatnonzero(self.ends[np.frombuffer(raw, dtype="<u4")]) + 1)).tolist()
            if len(stop) == len(part):
                known.update(zip(part, (raw[a:b] for a, b in zip([0, *stop], stop))))
            else:
                known.update((p, self._encode(p)) for p in part)

    def batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        rows = [t.replace("\n", " ").split(" ") for t in texts]
        new = self.words.unknown(set().union(*rows))
        words = self.words.new
        if "" in new:
            new.remove("")
            words[""] = b""
        alone, ended, other = [], [], []                 # letters; letters and a mark; the rest
        for w in new:
            if not (w.isascii() or self.plain(w)):
                words[w] = self._encode(w)
            elif w.isalpha():
                alone.append(w)
            elif w[-1] in ".,!?;:" and w[:-1].isalpha():
                ended.append(w)
            elif self.plain(w) and "<|" not in w:
                other.append(w)
            else:
                words[w] = self._encode(w)
        # a word in lower case is its own piece: one string serves both memories
        low_alone, low_ended = [w if w.islower() else w.lower() for w in alone], [w[:-1].lower() for w in ended]
        cut = [self.split(w.lower()) for w in other]
        self._learn_pieces(list(self.pieces.unknown({*low_alone, *low_ended, *(w[-1] for w in ended), *(p for ps in cut for p in ps)})))
        get = self.pieces.new.__getitem__
        words.update(zip(alone, map(get, low_alone)))
        words.update((w, get(p) + get(w[-1])) for w, p in zip(ended, low_ended))
        words.update((w, b"".join(map(get, ps))) for w, ps in zip(other, cut))
        return [b"".join(map(words.__getitem__, ws)) for ws in rows]


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of this Python worker; what it remembers serves its later tasks too, until another operator's come."""
    return kept(f"words of {path}", lambda: WordTokens(path))


def _cut(path: str, id_type: pa.DataType, capacity: int, end_id: int):
    end = np.asarray([end_id], dtype="<u4").tobytes()
    size = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok = word_tokens(path)
        for b in batches:
            ids, col = b.column(0), b.column(1)
            take, piece, length, crc = [], [], [], []
            for lo in range(0, len(col), 64):
                texts = [t or "" for t in col.slice(lo, 64).to_pylist()]
                for k, raw in enumerate(tok.batch(texts)):
                    raw += end
                    for p, at in enumerate(range(0, len(raw), size)):
                        part = raw[at:at + size]
                        take.append(lo + k)
                        piece.append(p)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(take, pa.int64())).cast(id_type), pa.array(piece, pa.int32()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "length", "ids_crc32"])
    return run


def tokenize_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                    capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, length, ids_crc32."""
    from pyspark.sql.pandas.types import to_arrow_type
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()),
                           T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])
    return src.mapInArrow(_cut(tokenizer, to_arrow_type(kind), capacity, end_id), schema)


# ------------------------------------------------------------------ planning
def _complement(n: np.ndarray, gap: int, limit: int) -> tuple[int, ...] | None:
    """One, two or three available lengths, none above ``limit``, that sum to ``gap``."""
    if gap <= limit and n[gap]:
        return (gap,)
    top = min(limit, gap - 1)

    def pair(g: int, high: int) -> tuple[int, int] | None:
        lo, hi = (g + 1) // 2, min(high, g - 1)
        if hi < lo:
            return None
        a = np.arange(hi, lo - 1, -1)
        ok = (n[a] > 0) & (n[g - a] > 0) & ((2 * a != g) | (n[a] > 1))
        i = int(ok.argmax())
        return (int(a[i]), int(g - a[i])) if ok[i] else None

    if (two := pair(gap, top)) is not None:
        return two
    for a in np.flatnonzero(n[:min(top, gap - 2) + 1])[::-1]:
        a = int(a)
        if 3 * a < gap:
            break                                    # the largest of three is a third at least
        n[a] -= 1
        two = pair(gap - a, min(a, gap - a - 1))
        n[a] += 1
        if two is not None:
            return (a, *two)
    return None


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns (times, lengths): how often a sequence with these lengths is made.

    ``counts[L]`` is the number of pieces of length L. Each step uses up a
    length or leaves it too few for another step, so the patterns number
    in the order of ``capacity``, whatever the counts are.
    """
    n = counts.astype(np.int64).copy()
    out: list[tuple[int, tuple[int, ...]]] = []

    def use(pattern: tuple[int, ...]) -> None:
        parts, need = np.unique(pattern, return_counts=True)
        times = int((n[parts] // need).min())
        n[parts] -= times * need
        out.append((times, pattern))

    if n[capacity]:
        use((capacity,))
    for a in range(capacity - 1, 0, -1):             # exact fills, the longest first
        while n[a]:
            n[a] -= 1
            rest = _complement(n, capacity - a, a)
            n[a] += 1
            if rest is None:
                break
            use((a, *rest))
    # best fit for what is left: sequences alike are kept as (times, lengths) by their gap
    gaps: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    open_gaps = np.zeros(capacity + 1, dtype=bool)

    def put(times: int, pattern: tuple[int, ...], gap: int) -> None:
        if times:
            gaps.setdefault(gap, []).append((times, pattern))
            open_gaps[gap] = True

    for a in range(capacity - 1, 0, -1):
        left = int(n[a])
        while left:
            fit = np.flatnonzero(open_gaps[a:])
            if len(fit):
                g = a + int(fit[0])
                times, pattern = gaps[g].pop()
                open_gaps[g] = bool(gaps[g])
                used = min(times, left)
                put(times - used, pattern, g)
                put(used, (*pattern, a), g - a)
                left -= used
            else:
                each = capacity // a
                full, rest = divmod(left, each)
                put(full, (a,) * each, capacity - each * a)
                put(1 if rest else 0, (a,) * rest, capacity - rest * a)
                left = 0
    return out + [x for v in gaps.values() for x in v]


def _places(patterns, capacity: int):
    """For each length, in order of the piece's number: first number, sequence, its step, offset."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    at = 0
    for times, pattern in patterns:
        offset = 0
        for length in pattern:
            rows.setdefault(length, []).append((times, at, offset))
            offset += length
        at += times
    out = {}
    for length, parts in rows.items():
        p = np.asarray(parts, dtype=np.int64)
        out[length] = (np.concatenate(([0], np.cumsum(p[:, 0])[:-1])), p[:, 1], p[:, 2])
    return out


# -------------------------------------------------------------------- packing
def pack(pieces: DataFrame, capacity: int = CAPACITY, rows_per_group: int = 200_000) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...).

    ``pieces`` is read three times, so give a held table.
    """
    spark = pieces.sparkSession
    per_length = pieces.groupBy("length").count().collect()      # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in per_length:
        counts[r["length"]] = r["count"]
    places = _places(plan(counts, capacity), capacity)
    salts = int(max(tasks(spark), counts.sum() // rows_per_group + 1))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    group = Window.partitionBy("length", "_salt")
    before = (salted.groupBy("length", "_salt").count()
              .withColumn("_before", F.sum("count").over(
                  Window.partitionBy("length").orderBy("_salt")
                  .rowsBetween(Window.unboundedPreceding, -1)))
              .select("length", "_salt", F.coalesce("_before", F.lit(0)).alias("_before")))
    numbered = (salted.withColumn("_n", F.row_number().over(
                    group.orderBy("doc_id", "piece", "ids_crc32")) - 1)
                .join(before, ["length", "_salt"])
                .withColumn("_n", F.col("_n") + F.col("_before")).drop("_salt", "_before"))

    schema = T.StructType([f for f in numbered.schema if f.name != "_n"]
                          + [T.StructField("sequence_id", T.LongType()),
                             T.StructField("offset", T.LongType())])
    names = [f.name for f in schema]

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy()
            number = b.column("_n").to_numpy()
            seq = np.empty(len(length), dtype=np.int64)
            off = np.empty(len(length), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for idx in np.split(order, cuts):
                if len(idx):
                    first, start, offset = places[int(length[idx[0]])]
                    k = np.searchsorted(first, number[idx], side="right") - 1
                    seq[idx] = start[k] + number[idx] - first[k]
                    off[idx] = offset[k]
            cols = [b.column(c) for c in names[:-2]] + [pa.array(seq), pa.array(off)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return numbered.mapInArrow(give, schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset."""
    pieces = held(tokenize_pieces(docs, tokenizer, id_col, text_col, capacity, end_id), "pieces")
    return pack(pieces, capacity).select(
        "doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("start"), "length",
        "ids_crc32", "sequence_id", "offset")
