"""Document fingerprints by consistent weighted sampling (native: no Python on the executors).

A document is a weighted set: its words (stretches between white space, as written) with their counts.
Each term draws, from its hash, a gamma(2,1) rate ``r``, a gamma(2,1) scale ``c`` and a uniform shift
``b``; with weight ``s`` it offers

    t = floor(ln s / r + b),   ln a = ln c - r (t - b + 1)

and the least ``a`` wins; the sample is (term, t).  Two weighted sets have the same sample with the
probability of their generalised Jaccard similarity, sum of minima over sum of maxima.  Here each term
competes in one of ``BINS`` bins chosen by its hash, so a fingerprint costs one draw per term instead
of one per term and sample; the likeness of two fingerprints is the share of equal samples among the
bins that either one fills.  (Bins weigh alike, so a word that makes up much of a text counts a
little less than its share; README has measured errors.)

The gamma draws are quantiles of a table of 4,096 steps each, taken by three disjoint stretches of
the hash.  Everything of a text is computed in its own row; nothing of it moves.

Defined results: null text is empty; a text without words has an empty fingerprint; two empty ones are
alike (1), an empty and another one are not (0); equal texts have equal fingerprints.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadra.llm.shared import if_small, range_bucket

BINS = 64
STEPS = 4096


def _quantiles() -> list[float]:
    """Gamma(2,1) at the middles of ``STEPS`` equal probabilities, by bisection of 1 - (1 + x) e^-x."""
    out = []
    for i in range(STEPS):
        p, lo, hi = (i + 0.5) / STEPS, 0.0, 40.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if 1 - (1 + mid) * math.exp(-mid) < p else (lo, mid)
        out.append(lo)
    return out


def _table(values: list[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


_GAMMA = _quantiles()


def _bits(h: Column, shift: int) -> Column:
    return F.shiftright(h, shift).bitwiseAND(F.lit(STEPS - 1)).cast("int")


def _offer(term: Column, weight: Column) -> Column:
    """bin (6 bits) | ln a (31 bits, order kept) | 26 bits of the hash of (term, t)."""
    h = F.xxhash64(term, F.lit(1))
    rate, scale, shift = F.get(_table(_GAMMA), _bits(h, 0)), F.get(_table([math.log(x) for x in _GAMMA]), _bits(h, 12)), _bits(h, 24) / F.lit(float(STEPS))
    one = F.shiftleft(_level(scale - rate * (F.lit(1.0) - shift)), 26) + F.shiftrightunsigned(h, 38)
    t = F.floor(F.log(weight.cast("double")) / rate + shift)
    many = F.shiftleft(_level(scale - rate * (t - shift + F.lit(1.0))), 26) + F.shiftrightunsigned(F.when(t == 0, h).otherwise(F.xxhash64(term, t)), 38)
    return F.shiftleft(term.bitwiseAND(F.lit(BINS - 1)), 57) + F.when(weight == 1, one).otherwise(many)


def _level(x: Column) -> Column:
    """A number of 31 bits that grows with x from -160 on."""
    return F.greatest(F.lit(0.0), F.least(F.lit(2147483647.0), (x + F.lit(160.0)) * F.lit(1.25e7))).cast("bigint")


def with_fingerprint(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` plus array<long> ``name``: per filled bin, in order, bin | sample."""
    w = F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), lambda x: x != "")
    kept = [F.col(f"`{c}`") for c in df.columns]
    df = df.select(*kept, F.sort_array(F.transform(w, lambda x: F.xxhash64(x))).alias("_h"))
    last = F.filter(F.sequence(F.lit(0), F.size("_h") - 1), lambda i: F.coalesce(F.get("_h", i + 1) != F.get("_h", i), F.lit(True)))
    df = df.select(*kept, "_h", F.when(F.size("_h") > 0, last).otherwise(F.array().cast("array<int>")).alias("_e"))
    offers = F.transform("_e", lambda e, i: _offer(F.get("_h", e), e - F.coalesce(F.get("_e", i - 1), F.lit(-1))))
    df = df.select(*kept, F.sort_array(offers).alias("_o"))
    best = F.filter("_o", lambda x, i: F.coalesce(F.shiftright(F.get("_o", i - 1), 57) != F.shiftright(x, 57), F.lit(True)))
    # code 57 bits down to the sample's 26, the bin above them
    sample = F.transform(best, lambda x: F.shiftleft(F.shiftrightunsigned(x, 57), 26) + x.bitwiseAND(F.lit((1 << 26) - 1)))
    return df.select(*kept, sample.alias(name))


def likeness(a: str, b: str) -> Column:
    """Equal samples among the bins that either fills."""
    bins = lambda c: F.transform(c, lambda x: F.shiftright(x, 26))
    filled = F.size(F.array_union(bins(a), bins(b)))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(filled, F.lit(1)))


def as_text(a: str) -> Column:
    return F.concat_ws(" ", F.transform(a, lambda x: F.lower(F.hex(x))))


def with_next(docs: DataFrame, key: str, text: str, extra: list[str], buckets: int) -> DataFrame:
    """(key, text, extra..., next_text, next_<extra>...): each row with the next by key (ties by text); after the last, the first.

    One range bucket per task; the first row of each bucket also goes, as a ghost, to the bucket
    before it (the first of all to the last), so a single exchange is enough and no order is global.
    """
    df = docs.withColumn("_b", range_bucket(docs, key, buckets))
    # the first key of each bucket, and the bucket before it: a row per bucket
    firsts = df.groupBy("_b").agg(F.min(F.struct(F.col(key).alias("k"))).alias("s"))
    firsts = firsts.select(F.col("_b").alias("_of"), F.col("s.k").alias("_first"), F.coalesce(F.lag("_b").over(Window.orderBy("_b")), F.max("_b").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_before"))
    df = df.join(if_small(firsts), (F.col("_b") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_first")), "left").drop("_of", "_first")
    own = F.struct(F.col("_b").alias("b"), F.lit(0).alias("g"))
    ghost = F.when(F.col("_before").isNotNull(), F.struct(F.col("_before").alias("b"), F.lit(1).alias("g")))
    df = df.withColumn("_to", F.explode(F.array_compact(F.array(own, ghost)))).drop("_before")
    order = Window.partitionBy("_to.b").orderBy("_to.g", key, text)
    df = df.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in [text, *extra]])
    return df.where(F.col("_to.g") == 0).drop("_to", "_b")


def fingerprint_edits(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: text, edited text (the last quarter replaced by the start of the next document), their fingerprints and the next one's."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    rows = with_fingerprint(rows, F.col("t"), "f")
    rows = with_next(rows, "k", "t", ["f"], int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = F.length("t")
    rows = rows.withColumn("n", n.cast("long")).withColumn("edited", F.concat(F.expr("left(t, length(t) - length(t) div 4)"), F.expr("left(next_t, cast(length(t) div 4 as int))"))).drop("next_t", "t")
    return with_fingerprint(rows, F.col("edited"), "fe")
