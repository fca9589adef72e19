"""Secret scans: wide candidate search, false positives removed by a random forest.

A candidate is a run of 16 or more key characters within a word. The
forest sees its length, how often and between which kinds of characters it changes,
how much of it the corpus's own vocabulary covers, whether it stands in a path or address, and
its neighbouring words. It is trained on labelled findings; where a caller
has none, ``rule_labels`` labels the clear cases by rule: a value assigned to
a credential's name is a secret, a value without digits and one in a path
or address are not. Labelled secrets are shown a second time without
their neighbours, so that the characters have to decide too.

The vocabulary is the set of letter trigrams that at least one in 17,576 (26^3) trigrams
of all words equals, so at most 17,576; it is counted over all documents.

DataFrame functions and the DataFrame API of Spark ML only. The training set is bounded by
``SAMPLE`` distinct values a class, chosen by a hash of the value.

Defined cases: null and empty texts have no candidates; without any labelled
secret nothing is one, without any labelled non-secret everything is; repeated rows give
repeated findings; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held

MIN_LENGTH = 16
SAMPLE = 2000
TREES, DEPTH, SEED = 24, 6, 17
VALUE = r"[A-Za-z0-9+/_~.\-]{%d,}={0,2}" % MIN_LENGTH
BLANK = r"[\x20\x09-\x0D]+"
GRAMS = 26 ** 3
CREDENTIAL = r"(?i)token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|credential|bearer"
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

FEATURES = ["length", "changes", "digit_letter", "digits", "uppers", "marks", "distinct", "coverage", "path", "quoted",
            "assigned", "credential"]
NEIGHBOURS = ["quoted", "assigned", "credential"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word_no, value, word, before, before2, after): every candidate with its
    word, the word's number in the text, and the neighbouring words."""
    text = F.col(text_col)
    words = (docs.select(F.col(id_col).alias("id"), text.alias("text")).where(F.col("text").rlike(VALUE))
             .select("id", F.split("text", BLANK).alias("words")))
    near = words.select("id", F.explode(F.expr(
        "filter(transform(words, (w, i) -> named_struct('i', i, 'w', w, 'b', coalesce(get(words, i - 1), ''), "
        "'b2', coalesce(get(words, i - 2), ''), 'a', coalesce(get(words, i + 1), ''))), "
        f"x -> x.w rlike r'{VALUE}')")).alias("x"))
    return near.select("id", F.col("x.i").alias("word_no"), F.explode(F.regexp_extract_all("x.w", F.lit(VALUE), F.lit(0))).alias("value"),
                       F.col("x.w").alias("word"), F.col("x.b").alias("before"), F.col("x.b2").alias("before2"),
                       F.col("x.a").alias("after"))


def vocabulary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram): letter trigrams that are at least 1/GRAMS of all trigrams of the words of all texts."""
    words = (docs.select(F.explode(F.split(F.col(text_col), BLANK)).alias("w"))
             .select(F.lower(F.regexp_replace("w", r"[^\p{L}]+", "")).alias("w"))
             .where(F.length("w").between(3, MIN_LENGTH - 1)).groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    grams = (words.select("n", F.explode(F.expr("transform(sequence(1, length(w) - 2), i -> substring(w, i, 3))")).alias("gram"))
             .groupBy("gram").agg(F.sum("n").alias("n")))
    grams = held(grams, "grams")
    total = grams.agg(F.sum("n")).first()[0] or 0
    return grams.where(F.col("n") * GRAMS >= total).select("gram")


def _share(value: Column, chars: str) -> Column:
    """Share of the value's characters that are among ``chars``."""
    rest = F.translate(value, chars, "")
    return (F.length(value) - F.length(rest)) / F.length(value)


def features(found: DataFrame, grams: DataFrame) -> DataFrame:
    """Candidates with the columns of ``FEATURES``."""
    v = F.col("value")
    kinds = F.translate(v, _LOWER + _UPPER + _DIGITS, "a" * 26 + "A" * 26 + "0" * 10)
    lead = F.expr("substring_index(word, value, 1)")
    values = found.select("value").distinct()
    parts = values.select("value", F.explode(F.expr("transform(sequence(1, length(value) - 2), i -> lower(substring(value, i, 3)))")).alias("gram"))
    cover = held(parts.join(F.broadcast(grams.withColumn("hit", F.lit(1))), "gram", "left")      # GRAMS rows at most
                 .groupBy("value").agg((F.count("hit") / F.count(F.lit(1))).alias("coverage")), "coverage")
    flag = lambda c: c.cast("double")
    around = F.concat_ws(" ", "before2", "before", lead)
    out = found.join(cover, "value").select(
        "id", "word_no", "value", "coverage", F.length(v).cast("double").alias("length"),
        (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) / F.length(v)).alias("changes"),
        (F.regexp_count(kinds, F.lit("0(?=[aA])|[aA](?=0)")) / F.length(v)).alias("digit_letter"),
        _share(v, _DIGITS).alias("digits"), _share(v, _UPPER).alias("uppers"),
        (1 - _share(v, _LOWER + _UPPER + _DIGITS)).alias("marks"),
        (F.size(F.array_distinct(F.split(v, ""))) / F.length(v)).alias("distinct"),
        (flag(F.col("word").rlike(r"://|@|^[/~]|^[A-Za-z]:\\|\.[A-Za-z]{2,5}$")) + F.regexp_count(v, F.lit("/"))).alias("path"),
        flag(lead.rlike("[\"'`]$")).alias("quoted"),
        flag(lead.rlike("[:=>][\"'`]?$") | F.col("before").rlike("[:=>]$")).alias("assigned"),
        flag(around.rlike(CREDENTIAL)).alias("credential"))
    return out


def rule_labels(rows: DataFrame) -> DataFrame:
    """The clear cases among candidates, with a column label (1: a secret)."""
    secret = (F.col("credential") > 0) & (F.col("assigned") > 0) & (F.col("digits") > 0)
    harmless = (F.col("credential") == 0) & ((F.col("digits") == 0) | (F.col("path") > 0))
    return rows.withColumn("label", F.when(secret, 1).when(harmless, 0)).where("label is not null")


def train(labelled: DataFrame, sample: int = SAMPLE) -> PipelineModel | float:
    """A forest from rows with ``FEATURES``, value and label; a constant
    probability where the labels are not of two kinds."""
    mark = F.pmod(F.xxhash64("value"), F.lit(1 << 30))
    per = {r["label"]: r for r in labelled.select("label", mark.alias("h")).groupBy("label")
           .agg(F.countDistinct("h").alias("n"), F.min("h").alias("least")).collect()}
    if 1 not in per or 0 not in per:
        return 1.0 if 1 in per else 0.0
    # rates follow the distinct values; the value of the least hash always passes, so the sample has both classes
    rate = {k: max(int(min(1.0, sample / r["n"]) * (1 << 30)), r["least"]) for k, r in per.items()}
    limit = F.when(F.col("label") == 1, F.lit(rate[1])).otherwise(F.lit(rate[0]))
    one = (labelled.where(mark <= limit).groupBy("label", "value").agg(F.min(F.struct(*FEATURES)).alias("f"))
           .select("label", "value", "f.*").orderBy("label", "value").limit(4 * sample))
    again = one.where("label = 1").withColumns({c: F.lit(0.0) for c in NEIGHBOURS})
    rows = held(one.unionByName(again).orderBy("value", *FEATURES).coalesce(1), "labelled")   # a bounded sample, one file: bagging is the same on every run
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    gather = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return PipelineModel([gather, forest.fit(gather.transform(rows))])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate: id, word_no, value, probability, is_secret. ``labelled`` has
    ``FEATURES``, value and label; without it the rules label the corpus's own candidates."""
    found = held(candidates(docs, id_col, text_col), "candidates")
    rows = held(features(found, vocabulary(docs, text_col)), "candidate-features")
    model = train(rule_labels(rows) if labelled is None else labelled)
    if isinstance(model, float):
        judged = rows.withColumn("p", F.lit(model))
    else:
        judged = model.transform(rows).withColumn("p", vector_to_array("probability")[1])
    return judged.select(F.col("id").alias(id_col), "word_no", "value", F.round("p", 9).alias("probability"),
                         (F.col("p") >= 0.5).alias("is_secret"))
