"""J-10 as a set-similarity join: all pairs of names whose trigram sets have a cosine of at
least ``min_score``, exactly, without comparing every name with every other.

A name's set holds the character trigrams of its normalised form between blanks, as their places in the order of how many
names hold them, rarest first. Two sets x and y reach cosine t only if t^2 |x| <= |y| <= |x| / t^2 (length filter) and
they share ``need`` = ceil(t * sqrt(|x| |y|)) trigrams. Hence the first trigram that they share is among the first |x| - need + 1
of x, the second one among the next (prefix filter), and the same holds for y. A pair is looked for by its first shared
trigram where few names hold that, else by its first two, and for sets of each band of sizes apart, as the prefixes are shortest then.
It is met under one key only, and goes on if the trigrams that either lacks of the other, counted in 128 bits, leave
``need``. Pairs that pass are verified on the whole sets.

Nothing that grows with the names is broadcast (a broadcast is built in the driver); the trigrams are, of
which normalised names have 37^3 at most.

Defined cases: null names and names without a letter or digit match nothing; repeated
names on either side each match; equal scores rank by entity id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLACK = 1e-9
#: A trigram that no more sets hold is a key by itself.
RARE = 64


def normalised(c: Column | str) -> Column:
    """Lower case, punctuation as blanks, numbers without leading zeros."""
    x = F.lower(F.regexp_replace(F.col(c) if isinstance(c, str) else c, "[^A-Za-z0-9]+", " "))
    return F.trim(F.regexp_replace(x, r"\b0+(\d)", "$1"))


def grams(name: Column, n: int = 3) -> Column:
    """The set of character n-grams of a name between blanks."""
    padded = F.concat(F.lit(" "), name, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (n - 1), F.lit(1))),
                                        lambda i: F.substring(padded, i, F.lit(n))))


def _sets(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    name = normalised(text_col)
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), name.alias("name")).where("name <> ''").select(
        "id", "text", grams(F.col("name")).alias("set"))


def _coded(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, size, rare, m0, m1, o) of both sides: a set's trigrams by rarity, how many of them are rare, and 128 bits of them."""
    held = (a.select(F.explode("set").alias("w")).unionByName(b.select(F.explode("set").alias("w")))
            .groupBy("w").agg(F.count(F.lit(1)).alias("df")))
    ranked = F.broadcast(held.select("w", "df", F.row_number().over(Window.orderBy("df", "w")).alias("g")))
    bit = F.pmod(F.xxhash64("g"), F.lit(128)).cast("int")

    def mask(least: int):
        here = (bit >= least) & (bit < least + 64)
        return F.bit_or(F.when(here, F.call_function("shiftleft", F.lit(1).cast("long"), bit - least)).otherwise(F.lit(0).cast("long")))

    def one(s: DataFrame) -> DataFrame:
        return (s.select("id", F.size("set").alias("size"), F.explode("set").alias("w")).join(ranked, "w").groupBy("id", "size")
                .agg(F.count_if(F.col("df") <= RARE).cast("int").alias("rare"), mask(0).alias("m0"), mask(64).alias("m1"),
                     F.array_sort(F.collect_list("g")).alias("o")))
    return one(a), one(b)


def _band(size: Column) -> Column:
    """The least size of a size's band: itself below 16, then one of eight in each doubling."""
    step = F.pow(F.lit(2), F.greatest(F.floor(F.log2(size)) - 3, F.lit(0))).cast("int")
    return size - size % step


def _keys(coded: DataFrame, bands: DataFrame, min_score: float, side: str, first: str, second: str) -> DataFrame:
    """A row for each key of a set: bands of the two sides' sizes, first trigram in common, second one (-1 after a rare first one).
    ``bands``: those that the other side has."""
    t, size = min_score, F.col("size")
    least, most = F.greatest(F.ceil(F.lit(t * t) * size - _SLACK), F.lit(1)).cast("int"), F.floor(size / (t * t) + _SLACK).cast("int")
    x = coded.withColumn("own", _band(size)).withColumn("other", F.explode(
        F.array_distinct(F.transform(F.sequence(least, F.greatest(least, most)), _band))))
    x = x.withColumn("need", F.greatest(F.ceil(F.lit(t) * F.sqrt((F.col("own") * F.col("other")).cast("double")) - _SLACK), F.lit(1)).cast("int"))
    x = x.where("need <= size").join(F.broadcast(bands), "other", "left_semi").withColumn("_p", size - F.col("need") + 1)

    def of(i):
        g = F.get("o", i - 1)
        alone = F.array(F.struct(g.alias("g1"), F.lit(-1).alias("g2")))
        pairs = F.transform(F.slice("o", i + 1, F.col("_p") + 1 - i), lambda h: F.struct(g.alias("g1"), h.alias("g2")))
        return F.when((i <= F.col("rare")) | (F.col("need") == 1), alone).otherwise(pairs)
    x = x.withColumn("k", F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.col("_p")), of))))
    return x.select(F.col("own").alias(first), F.col("other").alias(second), "k.g1", "k.g2", *(F.col(c).alias(f"{side}_{c}") for c in ("id", "size", "m0", "m1")),
                    F.slice("o", F.lit(1), F.col("_p") + 1).alias(f"{side}_pre"))


def _pairs(a: DataFrame, b: DataFrame, min_score: float) -> DataFrame:
    spark, on, t = a.sparkSession, ["a_band", "b_band", "g1", "g2"], min_score ** 2
    # few bytes make many pairs: the number of tasks is not left to the sizes
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    of_a, of_b = (s.select(_band(F.col("size")).alias("other")).distinct() for s in (a, b))
    x, y = _keys(a, of_b, min_score, "a", "a_band", "b_band"), _keys(b, of_a, min_score, "b", "b_band", "a_band")
    both = x.repartition(n, *on).join(y.repartition(n, *on).hint("merge"), on)
    length = (F.col("b_size") >= t * F.col("a_size") - _SLACK) & (F.col("a_size") >= t * F.col("b_size") - _SLACK)
    need = F.ceil(F.lit(min_score) * F.sqrt((F.col("a_size") * F.col("b_size")).cast("double")) - _SLACK)

    def most(p: str, q: str):
        lacks = [F.bit_count(F.col(f"{p}_{m}").bitwiseAND(F.bitwise_not(F.col(f"{q}_{m}")))) for m in ("m0", "m1")]
        return F.col(f"{p}_size") - lacks[0] - lacks[1]
    shared = F.array_intersect("a_pre", "b_pre")
    first = (F.get(shared, F.lit(0)) == F.col("g1")) & ((F.col("g2") == -1) | (F.get(shared, F.lit(1)) == F.col("g2")))
    return both.where(length & (most("a", "b") >= need) & (most("b", "a") >= need) & first).select("a_id", "b_id")


def candidate_pairs(a: DataFrame, b: DataFrame, min_score: float) -> DataFrame:
    """(a_id, b_id): pairs that pass the filters, once each; a and b: (id, set), ids unique."""
    return _pairs(*_coded(a, b), min_score)


def similar_names(queries: DataFrame, directory: DataFrame, query_id: str, query_text: str, entity_id: str, entity_text: str,
                  min_score: float = 0.8, k: int | None = None) -> DataFrame:
    """J-10: (query_id, query_text, entity_id, entity_text, score, rank) of all directory entries whose trigram cosine is at
    least ``min_score`` (rounded to 4 places for output), the best ``k`` of each query if given."""
    if not 0 < min_score <= 1:
        raise ValueError("the filters need a score above 0")
    a, b = _sets(queries, query_id, query_text), _sets(directory, entity_id, entity_text)
    # names that are written alike are compared once
    key = F.xxhash64(F.array_join(F.array_sort("set"), "\x00")).alias("id")
    da, db = (s.select(key, "set").dropDuplicates(["id"]) for s in (a, b))
    ca, cb = _coded(da, db)
    pairs = _pairs(ca, cb, min_score)

    # a row for each name: joined by merging, as a broadcast of them (small while compressed) would be built in the driver
    def names(s: DataFrame, *columns: Column) -> DataFrame:
        return s.select(*columns).hint("merge")
    both = (pairs.join(names(ca, F.col("id").alias("a_id"), F.col("o").alias("a_set")), "a_id")
            .join(names(cb, F.col("id").alias("b_id"), F.col("o").alias("b_set")), "b_id"))
    raw = F.size(F.array_intersect("a_set", "b_set")) / F.sqrt((F.size("a_set") * F.size("b_set")).cast("double"))
    alike = both.select("a_id", "b_id", raw.alias("raw")).where(F.col("raw") >= F.lit(min_score) - _SLACK)
    left = names(a, key.alias("a_id"), F.col("id").alias("query_id"), F.col("text").alias("query_text"))
    right = names(b, key.alias("b_id"), F.col("id").alias("entity_id"), F.col("text").alias("entity_text"))
    out = alike.join(left, "a_id").join(right, "b_id").withColumn("score", F.floor(F.col("raw") * 10_000 + 0.5) / 10_000)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "entity_id")
    out = out.withColumn("rank", F.row_number().over(w))
    if k is not None:
        out = out.where(F.col("rank") <= k)
    return out.select("query_id", "query_text", "entity_id", "entity_text", "score", "rank")
