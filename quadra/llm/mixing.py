"""Mixing sources to target weights by hash-threshold histograms (native).

Targets: the sources share ``budget`` by weight; a target stops at ``epochs`` times its source's size
and the excess is shared again by weight until none is above.  Each source then takes ``q`` whole
passes and, of the rest, the documents whose hash lies below a threshold.  The threshold is found
without sorting: sizes are summed by (source, hash bucket), the bucket in which the budget ends is
the boundary, and only the documents of that bucket are summed again by the next bits of the hash,
level by level, until the boundary holds one hash value.  That last one is taken if the sum then
comes nearer to the target.  Thresholds of larger budgets contain those of smaller ones (nested).

Per level the work is one partial aggregate over a narrow stored table and a boundary per source;
one hot source is pre-aggregated in each task.  Sources are ranked by a distributed sort.

Defined results: null source is a source of its own (last in order); size 0 takes 0; rows equal in
key share a hash and fare alike; an empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadra.llm.shared import if_small, in_order, n_words, stored

WEIGHTS = (1, 2, 3)
EPOCHS = 3
BITS = 10
LEVELS = 6


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size); weights repeat along the code point order, null last."""
    ranked = stored(in_order(sizes, [F.col("source").asc_nulls_last()], "sources").withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_pos") % len(weights) + 1).cast("int"))).select("source", "source_size", "weight"), "weighted")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    # the level: every source gets level * weight or stops at its cap; each round only adds capped sources
    level, capped = 0.0, -1
    while True:
        full = (F.col("weight") * F.lit(level) >= epochs * F.col("source_size"))
        r = ranked.agg(F.sum(F.when(full, epochs * F.col("source_size")).otherwise(0)).alias("cap"), F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("w"), F.sum(full.cast("int")).alias("n")).first()
        if not r["w"] or r["n"] == capped:
            break
        level, capped = (total - r["cap"]) / r["w"], r["n"]
    return ranked.withColumn("target", F.round(F.least(F.lit(level) * F.col("weight"), (epochs * F.col("source_size")).cast("double")), 6))


def hash60(key: Column) -> Column:
    """60 bits of the MD5 of the key as text (null: of the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint")


def _bucket(level: int, h: str = "h") -> Column:
    """The bits of the hash down to ``level``."""
    return F.shiftright(h, 60 - BITS * (level + 1))


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> tuple[DataFrame, int]:
    """Per source (s) the target, whole passes ``q`` and the boundary of the rest, found on ``rows`` (source, size, h); and the depth."""
    rows = stored(rows, "sizes")
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    edge = stored(goal.select(F.col("source").alias("s"), "source_size", "target", passes.alias("q"))
                  .withColumn("rest", F.col("target") - F.col("q") * F.col("source_size"))
                  .withColumn("below", F.lit(0).cast("bigint")).withColumn("prefix", F.lit(0).cast("bigint")), "edge")
    for level in range(LEVELS):
        inside = F.lit(True) if level == 0 else _bucket(level - 1) == F.col("prefix")
        hist = rows.where("size > 0").join(if_small(edge), F.col("source").eqNullSafe(F.col("s"))).where(inside)
        hist = hist.groupBy("s", "rest", "below", _bucket(level).alias("b")).agg(F.sum("size").alias("n"), F.max("h").alias("hi"), F.min("h").alias("lo"))
        hist = hist.withColumn("upto", F.col("below") + F.sum("n").over(Window.partitionBy("s").orderBy("b")))
        cut = hist.where("upto > rest").groupBy(F.col("s").alias("s2")).agg(F.min(F.struct("b", "n", "upto", "hi", "lo")).alias("c"))
        known = edge.join(if_small(cut), F.col("s").eqNullSafe(F.col("s2")), "left")
        edge = stored(known.select(
            "s", "source_size", "target", "q", "rest",
            F.when(F.col("c").isNull(), F.col("below")).otherwise(F.col("c.upto") - F.col("c.n")).alias("below"),
            F.coalesce(F.col("c.b"), F.lit(-1).cast("bigint")).alias("prefix"),  # -1: nothing is left out
            F.coalesce(F.col("c.n"), F.lit(0)).alias("edge_size"),
            F.coalesce(F.col("c.hi") == F.col("c.lo"), F.lit(True)).alias("single")), "edge")
        if not edge.where(~F.col("single")).take(1):
            break
    nearer = F.abs(F.col("below") + F.col("edge_size") - F.col("rest")) < F.abs(F.col("below") - F.col("rest"))
    return stored(edge.select("s", "source_size", "target", "q", "rest", "prefix", nearer.alias("nearer")), "plan"), level


def mix(docs: DataFrame, size: Column, source: str = "source", key: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``docs`` plus ``size``, ``source_size``, ``target`` and ``copies``, how often the mix takes the row (0 to ``epochs``).

    Input columns of these names are replaced.  The rows stay where they are: the plan, one row per
    source, comes to them.
    """
    names = ("size", "source_size", "target", "copies")
    label = F.col(f"`{source}`").cast("string")
    sized = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names], size.cast("long").alias("size"), label.alias("_source"), hash60(F.col(f"`{key}`")).alias("_h"))
    by_source, level = plan(docs.select(label.alias("source"), size.cast("long").alias("size"), hash60(F.col(f"`{key}`")).alias("h")), weights, epochs)
    inner = ["s", "q", "rest", "prefix", "nearer"]
    by_source = by_source.select("source_size", "target", *[F.col(c).alias(f"_{c}") for c in inner])
    bucket = _bucket(level, "_h")
    extra = F.when(F.col("_rest") <= 0, 0).when(F.col("_prefix") < 0, 1).when(bucket < F.col("_prefix"), 1).when((bucket == F.col("_prefix")) & F.col("_nearer"), 1).otherwise(0)
    out = sized.join(if_small(by_source), F.col("_source").eqNullSafe(F.col("_s")))
    return out.withColumn("copies", F.when(F.col("size") > 0, F.col("_q") + extra).otherwise(0).cast("int")).drop("_source", "_h", *[f"_{c}" for c in inner])


def mix_documents(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The mix of ``docs`` by words."""
    return mix(docs, n_words(F.col(f"`{text}`").cast("string")), source, key)
