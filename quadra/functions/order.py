"""Orders and quantiles of a whole table without one task seeing all of it."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadra.session import stored

BINS = 4096
FEW = 2000


def ranked(df: DataFrame, order: list[Column], name: str = "rank", kind: str = "int") -> DataFrame:
    """``df`` with its position (from 1) in ``order``: a range sort, a count per range, and offsets.

    Only the counts, one per range, meet in one task.
    """
    table = stored(df.orderBy(*order).withColumn("_range", F.spark_partition_id()), "ranked")
    counts = table.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_range", before.alias("_before"))
    inner = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return table.withColumn("_in", inner).join(counts, "_range").withColumn(name, (F.col("_before") + F.col("_in")).cast(kind)).drop("_range", "_in", "_before")


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> tuple[list[float] | None, int]:
    """Exact linear quantiles of a stored column, and its number of values: :func:`column_quantiles` of one column."""
    return column_quantiles(df, [col], probs)[col]


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, tuple[list[float] | None, int]]:
    """Exact linear quantiles of some columns of a stored table, each with its number of values.

    All columns and ranks go together: one pass for counts and ranges, then values are counted in equal bins of every
    range that still holds a wanted rank, pass by pass, until few are left in each or all are equal, and one pass brings
    those few.  Bounded memory in every task and on the driver, whatever the number of values.  Null and NaN do not count.
    """
    each = [F.struct(F.lit(i).alias("g"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(cols)]
    rows = df.select(F.inline(F.array(*each))) if len(cols) > 1 else df.select(F.lit(0).alias("g"), F.col(f"`{cols[0]}`").cast("double").alias("x"))
    values = rows.where("x is not null and not isnan(x)")
    known = {r["g"]: r for r in values.groupBy("g").agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
    places = {g: [(r["n"] - 1) * p for p in probs] for g, r in known.items()}
    found: dict[tuple[int, int], float] = {}
    # (column, lowest and highest value, values below, values inside, wanted ranks)
    ranges = [(g, r["lo"], r["hi"], 0, r["n"], sorted({f(x) for x in places[g] for f in (math.floor, math.ceil)})) for g, r in known.items()]

    def number(of: list[tuple]) -> Column:
        """Which of the ranges a value lies in."""
        out = F.when(F.lit(False), -1)
        for i, (g, lo, hi, *_) in enumerate(of):
            out = out.when((F.col("g") == g) & (F.col("x") >= lo) & (F.col("x") <= hi), i)
        return out

    few = []
    while ranges:
        for g, lo, hi, before, n, ranks in ranges:
            if lo == hi:
                found |= {(g, r): lo for r in ranks}
        few += [r for r in ranges if r[1] < r[2] and r[4] <= FEW]
        ranges = [r for r in ranges if r[1] < r[2] and r[4] > FEW]
        if not ranges:
            break
        bins = max(64, BINS // len(ranges))
        cell = F.lit(0)
        for i, (_, lo, hi, *_) in enumerate(ranges):
            width = (hi - lo) / bins
            cell = F.when(F.col("i") == i, F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)) if 0 < width < math.inf else F.when(F.col("x") < lo / 2 + hi / 2, 0).otherwise(1)).otherwise(cell)
        counted = values.withColumn("i", number(ranges)).where("i is not null").groupBy("i", cell.alias("b")).agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        split = []
        cells = sorted(counted.collect(), key=lambda r: (r["i"], r["b"]))  # at most max(BINS, 64 a range) of them
        for i, (g, _, _, before, _, ranks) in enumerate(ranges):
            for r in cells:
                if r["i"] == i:
                    here = [k for k in ranks if before <= k < before + r["n"]]
                    if here:
                        split.append((g, r["lo"], r["hi"], before, r["n"], here))
                    before += r["n"]
        ranges = split
    if few:
        table = values.withColumn("i", number(few)).where("i is not null").select("i", "x").toArrow()  # at most FEW a range
        where, x = table.column("i").to_numpy(), table.column("x").to_numpy()
        for i, (g, _, _, before, _, ranks) in enumerate(few):
            inside = sorted(x[where == i].tolist())
            found |= {(g, r): inside[r - before] for r in ranks}
    out: dict[str, tuple[list[float] | None, int]] = {}
    for g, c in enumerate(cols):
        if g in known:
            ends = [(found[g, math.floor(p)], found[g, math.ceil(p)], p - math.floor(p)) for p in places[g]]
            out[c] = [a + (b - a) * t for a, b, t in ends], known[g]["n"]
        else:
            out[c] = None, 0
    return out


#: Bins a range, and values that may be gathered and sorted for one rank, where groups are many.
GROUP_BINS, GROUP_FEW = 256, 1000


def grouped_quantiles(df: DataFrame, groups: list[str], value: str, probs: list[float], name: str = "quantis") -> DataFrame:
    """(groups, ``name``: array of doubles): exact linear quantiles of each group, for any number and size of groups.

    As :func:`column_quantiles`, but the ranges are a table: values are counted by (group, bin), partial counts first, only the
    bins that hold a wanted rank are refined, and at most ``GROUP_FEW`` values of a rank's last bin meet in one place, so a group
    with a third of all rows is never in one task.  Null and NaN do not count; groups without values are absent.
    """
    x = F.col(value).cast("double")
    values = stored(df.select(*groups, x.alias("x")).where("x is not null and not isnan(x)"), "values")
    same = [F.col(f"v.{g}").eqNullSafe(F.col(f"r.{g}")) for g in groups]
    inside = [*same, F.col("v.x") >= F.col("r.lo"), F.col("v.x") <= F.col("r.hi")]
    span = stored(values.groupBy(*groups).agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")), "spans")
    place = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("n") - 1) * F.lit(float(p))).alias("p")) for i, p in enumerate(probs)]))
    wanted = span.select(*groups, place.alias("w")).select(*groups, "w.i", "w.p", F.floor("w.p").alias("a"), F.ceil("w.p").alias("b"))
    ranks = wanted.select(*groups, F.explode(F.array("a", "b")).alias("rank")).distinct()
    todo = ranks.join(span, groups) if all(f.nullable is False for f in span.schema if f.name in groups) else \
        ranks.alias("k").join(span.alias("s"), [F.col(f"k.{g}").eqNullSafe(F.col(f"s.{g}")) for g in groups]).select(*[f"k.{g}" for g in groups], "rank", "n", "lo", "hi")
    todo = stored(todo.withColumn("before", F.lit(0).cast("bigint")), "ranks")
    closed = None
    while True:
        over = (F.col("lo") == F.col("hi")) | (F.col("n") <= GROUP_FEW)
        end = todo.where(over)
        closed = end if closed is None else closed.unionByName(end)
        todo = todo.where(~over)
        if todo.isEmpty():
            break
        span_of = todo.select(*groups, "lo", "hi").distinct()
        width = (F.col("r.hi") - F.col("r.lo")) / GROUP_BINS
        cell = F.when((width > 0) & (width < float("inf")), F.least(F.floor((F.col("v.x") - F.col("r.lo")) / width), F.lit(GROUP_BINS - 1))).otherwise((F.col("v.x") > F.col("r.lo")).cast("bigint"))
        key = [*[F.col(f"r.{g}").alias(g) for g in groups], F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi")]
        counts = values.alias("v").join(span_of.alias("r"), inside).groupBy(*key, cell.alias("bin")).agg(F.count("v.x").alias("c"), F.min("v.x").alias("first"), F.max("v.x").alias("last"))
        below = Window.partitionBy(*groups, "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # GROUP_BINS rows at most
        counts = counts.withColumn("below", F.coalesce(F.sum("c").over(below), F.lit(0)))
        at = F.col("k.rank") - F.col("k.before") - F.col("c.below")
        match = [*[F.col(f"k.{g}").eqNullSafe(F.col(f"c.{g}")) for g in groups], F.col("k.lo") == F.col("c.lo"), F.col("k.hi") == F.col("c.hi"), at >= 0, at < F.col("c.c")]
        todo = stored(todo.alias("k").join(counts.alias("c"), match).select(
            *[F.col(f"k.{g}").alias(g) for g in groups], "k.rank", F.col("c.c").alias("n"), F.col("c.first").alias("lo"), F.col("c.last").alias("hi"), (F.col("k.before") + F.col("c.below")).alias("before")), "ranks")
    closed = stored(closed, "closed")
    even = closed.where("lo = hi").select(*groups, "rank", F.col("lo").alias("x"))
    last = closed.where("lo < hi")
    gathered = values.alias("v").join(last.select(*groups, "lo", "hi", "before").distinct().alias("r"), inside).select(*[F.col(f"r.{g}").alias(g) for g in groups], "r.lo", "r.hi", "r.before", "v.x")
    order = F.row_number().over(Window.partitionBy(*groups, "lo", "hi").orderBy("x")) - 1
    gathered = gathered.withColumn("rank", order + F.col("before")).select(*groups, "rank", "x")
    asked = last.select(*groups, "rank").distinct()
    picked = gathered.alias("g").join(asked.alias("k"), [*[F.col(f"g.{g}").eqNullSafe(F.col(f"k.{g}")) for g in groups], F.col("g.rank") == F.col("k.rank")]).select("g.*")
    at_rank = stored(even.unionByName(picked), "picked")
    for end in ("a", "b"):
        side = at_rank.select(*[F.col(g).alias(f"_{g}") for g in groups], F.col("rank").alias("_rank"), F.col("x").alias(f"x{end}"))
        wanted = wanted.join(side, [*[F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups], F.col(end) == F.col("_rank")]).drop("_rank", *[f"_{g}" for g in groups])
    q = F.when(F.col("a") == F.col("b"), F.col("xa")).otherwise((F.col("b") - F.col("p")) * F.col("xa") + (F.col("p") - F.col("a")) * F.col("xb"))
    lists = wanted.select(*groups, F.struct("i", q.alias("q")).alias("q")).groupBy(*groups).agg(F.array_sort(F.collect_list("q")).alias("q"))  # one a probability
    return lists.select(*groups, F.transform("q", lambda t: t["q"]).alias(name))
