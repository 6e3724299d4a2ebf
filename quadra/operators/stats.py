"""Descriptive statistics (A9-A23): grouped means, five-number summaries, correlation, histogram.

All are single-pass aggregates (partial aggregation map-side); quantiles are
found by counting in bins, all columns and ranks together.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra.functions.order import column_quantiles


def group_means(df: DataFrame, by: str, value: str = "valor", area: str = "area_m2") -> DataFrame:
    """Mean, sample std-dev and Σvalue/Σarea per group."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("media"), F.stddev_samp(value).alias("desvio"),
        F.try_divide(F.sum(value), F.sum(area)).alias("valor_m2"))


def summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, nulls, mean, std, min, quartiles, p90, max, IQR whiskers per column."""
    quantiles = column_quantiles(df, cols, [0.25, 0.5, 0.75, 0.9])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(x.isNull()).alias(f"z{i}"), F.avg(x).alias(f"a{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)

    def q(c: str, j: int):
        return F.lit(quantiles[c][0][j] if quantiles[c][0] else None).cast("double")

    rows = [F.struct(F.lit(c).alias("coluna"), F.col(f"n{i}").alias("n"), F.col(f"z{i}").alias("nulos"),
                     F.col(f"a{i}").alias("media"), F.col(f"s{i}").alias("desvio"), F.col(f"lo{i}").alias("minimo"),
                     q(c, 0).alias("q25"), q(c, 1).alias("mediana"), q(c, 2).alias("q75"),
                     q(c, 3).alias("p90"), F.col(f"hi{i}").alias("maximo")) for i, c in enumerate(cols)]
    long = wide.select(F.inline(F.array(*rows)))
    iqr = F.col("q75") - F.col("q25")
    return long.withColumns({"bigode_inf": F.col("q25") - 1.5 * iqr, "bigode_sup": F.col("q75") + 1.5 * iqr})


def correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pearson r and r² for each pair, one pass."""
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows))).withColumn("r2", F.pow(F.col("r"), 2))


def histogram(df: DataFrame, col: str, bins: int = 50, log10: bool = False) -> DataFrame:
    """Equal-width histogram between the column's min and max (max falls in the last bin)."""
    x = F.log10(F.col(col)) if log10 else F.col(col).cast("double")
    d = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    d = d.withColumn("__mm", d.select(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar())
    lo, hi = F.col("__mm.lo"), F.col("__mm.hi")
    b = F.when(hi == lo, 1).otherwise(F.least(F.floor((F.col("x") - lo) / (hi - lo) * bins) + 1, F.lit(bins)))
    return d.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x_min"),
                                                     F.max("x").alias("x_max"))
