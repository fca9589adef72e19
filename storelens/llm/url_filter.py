"""URL filters: path rules, and a cascade of Bloom filters for listed keys.

The key of a url is its host and path. Level 1 of the cascade encodes the listed
keys; level 2 the other keys of the corpus that level 1 passes by
mistake; level 3 the listed keys that level 2 passes by mistake, and so on
until none is left. A key's last level in a row tells whether it is listed,
exactly, for every key of the corpus, by hashes alone: the filters are literals of the
plan and no key is joined.

The literals are bounded by ``MAX_BITS``; a list that needs more is looked
up by a shuffled join instead (the other way beyond the bound).

DataFrame functions only.

Defined cases: a url that is null or has no ``://`` has an empty host and
path, fits no rule, and is allowed; empty or null listed keys are
ignored; repeated rows are judged alike; other columns pass through
except those the operator adds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, held

MAX_BITS = 1 << 26                       # of one level: 8 MB
LATER_RATE = 1 / 16                      # false positives of the levels after the first

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII
    lower-cased; path: from there up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]], part: int) -> Column:
    """Of the rules (verdict, host, path) that fit, the longest: its text (part 0)
    or verdict (part 1); null where none fits."""
    out = F.lit(None).cast("string")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):     # the last one put on top is the longest
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(h + p if part == 0 else verdict)).otherwise(out)
    return out


# ------------------------------------------------------------------ cascade
class Level:
    """A Bloom filter as a literal: ``bits`` long, ``hashes`` probes."""

    def __init__(self, number: int, bits: int, hashes: int):
        self.number, self.bits, self.hashes, self.body = number, bits, hashes, b""

    def probes(self, key: Column) -> list[Column]:
        a = F.xxhash64(key, F.lit(2 * self.number))
        b = F.xxhash64(key, F.lit(2 * self.number + 1)).bitwiseOR(F.lit(1))
        wide = F.pmod(a, F.lit(self.bits)), F.pmod(b, F.lit(self.bits))
        return [F.pmod(wide[0] + wide[1] * i, F.lit(self.bits)) for i in range(self.hashes)]

    def build(self, keys: DataFrame) -> "Level":
        """Set the bits of ``keys`` (column key): combined per 64-bit word before and
        after the shuffle; one binary value of bounded length reaches the driver."""
        words = self.bits // 64
        set_bits = (keys.select(F.explode(F.array(*self.probes(F.col("key")))).alias("at"))
                    .groupBy(F.expr("at div 64").alias("word"))
                    .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("b")))
        # big-endian words side by side; words without a bit are zero
        all_words = keys.sparkSession.range(words).withColumnRenamed("id", "word").join(set_bits, "word", "left")
        text = F.lpad(F.hex(F.coalesce("b", F.lit(0))), 16, "0")
        one = all_words.agg(F.array_sort(F.collect_list(F.struct("word", text.alias("t")))).alias("w"))
        self.body = bytes(one.select(F.unhex(F.array_join(F.col("w.t"), ""))).first()[0])
        return self

    def passes(self, key: Column) -> Column:
        out = F.lit(True)
        for at in self.probes(key):
            # bit ``at`` stands in byte 7 - (at % 64) div 8 of its word
            byte = (F.floor(at / 64) * 8 + 7 - F.floor((at % 64) / 8) + 1).cast("int")
            value = F.conv(F.hex(F.substring(F.lit(self.body), byte, F.lit(1))), 16, 10).cast("int")
            out = out & (F.call_function("getbit", value, (at % 8).cast("int")) == 1)
        return out


def _sized(number: int, keys: int, rate: float) -> Level:
    bits = max(64, math.ceil(keys * math.log(1 / rate) / math.log(2) ** 2 / 64) * 64)
    return Level(number, bits, max(1, round(math.log2(1 / rate))))


def cascade(universe: DataFrame, listed: DataFrame) -> list[Level] | None:
    """Levels that tell the listed keys from all other keys of ``universe`` (both: distinct
    column key). None where a level would exceed ``MAX_BITS``."""
    inside = held(universe.join(listed, "key", "left_semi"), "listed")
    outside = held(universe.join(listed, "key", "left_anti"), "unlisted")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    encode, test, n = inside, outside, n_in
    while n:
        rate = LATER_RATE if levels else min(0.5, max(n_in / (math.sqrt(2) * max(n_out, 1)), 1e-9))
        level = _sized(len(levels), n, rate)
        if level.bits > MAX_BITS:
            return None
        levels.append(level.build(encode))
        wrong = held(test.where(level.passes(F.col("key"))), "false-positives")
        encode, test, n = wrong, encode, wrong.count()
    return levels


def is_listed(key: Column, levels: list[Level]) -> Column:
    """Whether ``key`` is listed: the number of levels passed in a row is odd."""
    out = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        out = F.when(levels[i].passes(key), out).otherwise(F.lit(i % 2 == 1))
    return out


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]],
                url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict (which replace columns of these
    names). ``listed`` has a column key (host and path) of the urls to block."""
    host, path = host_and_path(F.col(url_col))
    out = pages.drop(*[c for c in ("host", "path", "rule", "verdict") if c != url_col])
    out = out.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    key = F.concat("host", "path")
    universe = held(out.select(key.alias("key")).where("key <> ''").distinct(), "keys")
    chosen = listed.select("key").where("key <> ''").distinct()
    levels = cascade(universe, chosen)
    if levels is None:
        met = free_name("listed", [*out.columns, "rule", "verdict"])
        hit = universe.join(chosen, "key", "left_semi").select(F.col("key").alias(met))
        out = out.join(hit, key == F.col(met), "left")
        block, extra = F.col(met).isNotNull(), [met]
    else:
        block, extra = (key != "") & is_listed(key, levels), []
    own = F.when(block, F.lit("block")).otherwise(F.lit("allow"))
    return out.withColumns({"rule": fitting_rule(F.col("host"), F.col("path"), rules, 0),
                            "verdict": F.coalesce(fitting_rule(F.col("host"), F.col("path"), rules, 1), own)}).drop(*extra)
