"""Quality classifier: a sparse ensemble of rules over statistics of the text.

A pass over the whole texts takes statistics (lengths, shares of kinds of
characters, repetition of words and lines), which are all a score sees. On a bounded sample of
labelled texts a random forest of shallow trees is grown; every path from a
root to a node is a rule, a conjunction of conditions on statistics. A logistic
regression with an L1 penalty weighs the rules' truth values, and most weights become zero. What is left
is compiled into one Spark expression, so scoring is a projection.

The sample holds at most ``sample`` distinct (statistics, label) pairs, of
each label in proportion and one at least, chosen by hash: copies neither
crowd it nor thin it out.

Defined cases: null and empty texts have statistics of zero and get a
score like any other; without labels of both kinds every score is the
share of label 1 (0.5 without any label). Repeated rows get equal scores,
several labels of one id are several examples, null labels are none; null ids meet no label. Other columns of
the documents pass through inside a struct, so their names cannot clash with the statistics; only one
called ``quality_score`` is replaced by the score. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held, segments, text_buffer, word_hashes

#: Labelled texts that the rules are learnt from, at most.
SAMPLE = 8192
TREES, DEPTH, PENALTY, SEED = 24, 3, 0.002, 7

# ---------------------------------------------------------------- statistics
#: Kinds of bytes that are counted; every other byte is of kind 0.
KINDS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
         "space": b" \t\r\x0b\x0c", "feed": b"\n", "stop": b".?", "exclaim": b"!", "comma": b",;:'\"-()",
         "bar": b"|", "symbol": b"#$%&*@^~_+=/\\<>{}[]`", "wide": bytes(range(192, 256)), "rest": bytes(range(128, 192))}
_KIND = np.zeros(256, dtype=np.int64)
for _k, _bytes in enumerate(KINDS.values(), 1):
    _KIND[list(_bytes)] = _k
_N = len(KINDS) + 1
_FEED = np.zeros(256, dtype=bool)
_FEED[10] = True

#: Names of the statistics, in order.
STATS = ["log_chars", "log_words", "log_lines", "word_length", "words_per_line", "upper", "digit", "stop", "exclaim", "comma", "bar",
         "symbol", "marked_words", "distinct_words", "top_word", "echo", "distinct_lines", "ended_lines"]


def _ends(data: np.ndarray, off: np.ndarray, kinds: list[str], before: list[str]) -> np.ndarray:
    """How many bytes of each text are of ``kinds`` and stand before one of ``before`` or the end."""
    names = list(KINDS)
    this, after = (np.isin(np.arange(_N), [names.index(k) + 1 for k in ks]) for ks in (kinds, before))
    out = np.zeros(len(off) - 1, dtype=np.int64)
    for i, j, a, b in segments(data, off, np.ones(256, bool)):
        kind = _KIND[data[a:b + 1]]                      # a piece's last byte sees the byte behind it
        close = np.append(after[kind[1:]], True)[:b - a]
        cut = off[i + 1:j + 1] - a
        close[cut[(cut > 0) & (cut <= b - a)] - 1] = True
        hit = np.flatnonzero(this[kind[:b - a]] & close)
        out[i:j] += np.bincount(np.searchsorted(off[i + 1:j + 1] - a, hit, side="right"), minlength=j - i)[:j - i]
    return out


def _repeats(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many different hashes each text has, and how often its most frequent one occurs."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(h)))
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, row[at], times)
    return np.bincount(row[at], minlength=n), top


def statistics(col: pa.Array) -> np.ndarray:
    """(texts, statistics) of whole texts; zero where a text has nothing to count."""
    data, off = text_buffer(col)
    n = len(off) - 1
    count = np.zeros((n, _N), dtype=np.int64)
    for i, j, a, b in segments(data, off, np.ones(256, bool)):
        row = np.repeat(np.arange(j - i), np.diff(np.clip(off[i:j + 1], a, b)))
        count[i:j] += np.bincount(row * _N + _KIND[data[a:b]], minlength=(j - i) * _N).reshape(j - i, _N)
    of = {k: count[:, i].astype(np.float64) for i, k in enumerate(KINDS, 1)}
    words, w_off = word_hashes(data, off)
    lines, l_off = word_hashes(data, off, _FEED)
    n_words, n_lines = np.diff(w_off), np.diff(l_off)
    chars = np.diff(off) - of["rest"]
    solid = chars - of["space"] - of["feed"]
    distinct, top = _repeats(words, w_off)
    different, _ = _repeats(lines, l_off)
    same = np.zeros(len(words) + 1, dtype=np.int64)
    same[2:] = np.cumsum(words[1:] == words[:-1]) if len(words) else 0
    last = np.maximum(w_off[1:], w_off[:-1] + 1).clip(max=len(words))
    echo = same[last] - same[np.minimum(w_off[:-1] + 1, len(words))]
    marked = _ends(data, off, ["symbol", "bar", "exclaim"], ["space", "feed"])
    ended = _ends(data, off, ["stop", "exclaim"], ["feed"])

    def share(x: np.ndarray, of_what: np.ndarray) -> np.ndarray:
        return np.divide(x, of_what, out=np.zeros(n), where=of_what > 0)

    return np.stack([
        np.log1p(chars), np.log1p(n_words), np.log1p(n_lines), share(solid, n_words), share(n_words, n_lines),
        share(of["upper"], of["upper"] + of["lower"] + of["wide"]), *(share(of[k], solid) for k in ("digit", "stop", "exclaim", "comma", "bar", "symbol")),
        share(marked, n_words), share(distinct, n_words), share(top, n_words), share(echo, n_words),
        share(different, n_lines), share(ended, n_lines)], axis=1)


def _each(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = statistics(b.column(at))
            cols = [c for k, c in enumerate(b.columns) if k != at]
            names = [x for k, x in enumerate(b.schema.names) if k != at]
            yield pa.RecordBatch.from_arrays([*cols, *(pa.array(s[:, k]) for k in range(len(STATS)))], names=[*names, *STATS])
    return run


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, and the statistics): ``row`` is a struct of all columns but the text."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    src = docs.select(F.struct(*rest).alias("row") if rest else F.lit(None).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([src.schema["row"], *(T.StructField(s, T.DoubleType()) for s in STATS)])
    return src.mapInArrow(_each(1), schema)


# --------------------------------------------------------------------- rules
@dataclass(frozen=True)
class Rule:
    """A conjunction: statistics above (True) or not above (False) a threshold."""
    conditions: tuple[tuple[str, bool, float], ...]

    def sql(self) -> str:
        return " AND ".join(f"{s} {'>' if above else '<='} {x!r}D" for s, above, x in self.conditions)


@dataclass(frozen=True)
class Rules:
    """The ensemble: log odds of label 1 are ``base`` plus the weights of the rules that hold."""
    base: float
    weights: tuple[tuple[float, Rule], ...]

    def score(self) -> Column:
        odds = " + ".join([f"{self.base!r}D", *(f"CASE WHEN {r.sql()} THEN {w!r}D ELSE 0D END" for w, r in self.weights)])
        return F.expr(f"1D / (1D + exp(-greatest(-700D, least(700D, {odds}))))")


def _paths(node, above: tuple = ()) -> list[Rule]:
    """Rules of the paths to all nodes below ``node`` of a Spark tree."""
    if node.numDescendants() == 0:
        return []
    name, x = STATS[node.split().featureIndex()], float(node.split().threshold())
    out = []
    for child, side in ((node.leftChild(), False), (node.rightChild(), True)):
        path = (*above, (name, side, x))
        out += [Rule(_tight(path)), *_paths(child, path)]
    return out


def _tight(path: tuple) -> tuple[tuple[str, bool, float], ...]:
    """A path with one condition for each statistic and side, the strictest."""
    best: dict[tuple[str, bool], float] = {}
    for s, above, x in path:
        known = best.get((s, above), x)
        best[s, above] = max(known, x) if above else min(known, x)
    return tuple(sorted((s, above, x) for (s, above), x in best.items()))


def sampled(labelled: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` distinct (statistics, label), each label in proportion."""
    distinct = labelled.select("label", *STATS).distinct()
    per = {r["label"]: r["count"] for r in distinct.groupBy("label").count().collect()}   # two labels
    total = sum(per.values())
    key = F.xxhash64("label", *STATS)
    parts = [distinct.where(F.col("label") == v).withColumn("key", key).orderBy("key", *STATS)
             .limit(max(1, sample * n // total)) for v, n in sorted(per.items())]
    out = parts[0] if parts else distinct.withColumn("key", key)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def learn(labelled: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Rules:
    """Rules from rows (label 0 or 1, statistics)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    # a bounded sample, in one order, so that a rerun grows the same trees
    some = held(sampled(labelled, sample).coalesce(1).sortWithinPartitions("key", *STATS), "labelled-statistics").coalesce(1)
    n, ones = some.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or ones in (0, n):
        odds = 0.0 if not n else 700.0 if ones else -700.0
        return Rules(odds, ())
    vectors = VectorAssembler(inputCols=STATS, outputCol="features").transform(some)
    forest = RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird",
                                    maxBins=64, seed=SEED).fit(vectors)
    rules = sorted({r for t in forest._java_obj.trees() for r in _paths(t.rootNode())}, key=lambda r: r.conditions)
    if not rules:
        return Rules(float(np.log(ones / (n - ones))), ())
    truth = some.selectExpr("label", f"array({', '.join(f'double({r.sql()})' for r in rules)}) AS truth")
    from pyspark.ml.functions import array_to_vector
    lasso = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=penalty, maxIter=200, standardization=True)
    fit = lasso.fit(truth.select("label", array_to_vector("truth").alias("features")))
    return Rules(float(fit.intercept), tuple((float(w), r) for w, r in zip(fit.coefficients.toArray(), rules) if w))


def score_quality(docs: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample: int = SAMPLE) -> tuple[DataFrame, Rules]:
    """The columns of ``docs`` but the text, with ``quality_score`` (0 to 1), and the rules.

    ``learn_from``: a condition on ``id`` for the rows whose labels may be learnt from."""
    stats = held(with_statistics(docs, text_col), "text-statistics")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).where("label IN (0, 1)")
    labelled = (stats.withColumn("id", F.col(f"row.{id_col}")).where(learn_from)
                .join(known.where(learn_from), "id").select("label", *STATS))
    rules = learn(labelled, sample)
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in (text_col, "quality_score")]
    return stats.select(*kept, rules.score().alias("quality_score")), rules
