"""Phases 3, 6 and 14 — reference prices, street supply, deed statistics.

Operators: A1 A2 A3 A4 A5 A6 J1 J2 J3 J4 J5 J6 J7 D2 D3 D4 D5 D6 F6 F7.

All group statistics are ``groupBy`` aggregates (partial aggregation happens
map-side, so a neighbourhood holding a third of the rows is pre-reduced in
every task) joined back on their keys; no ``Window.partitionBy(bairro)``,
which would funnel the hot neighbourhood through a single task.  The group
tables that listings join are stored first: their size is known when the join
is planned, so while they are small no listing is shuffled.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra import dims
from quadra.functions.order import grouped_quantiles
from quadra.session import stored


def street_stats(df: DataFrame, min_price_m2: float = 100.0) -> tuple[DataFrame, DataFrame]:
    """A1 + A2 (+F6): mean price/m² by bairro and mean + count by (bairro, rua)."""
    calc = df.filter(F.col("preco_m2_real") > min_price_m2)
    by_street = calc.groupBy("bairro", "rua").agg(
        F.avg("preco_m2_real").alias("media_rua_m2"), F.count(F.lit(1)).alias("qtd_amostras_rua"))
    by_bairro = calc.groupBy("bairro").agg(F.avg("preco_m2_real").alias("media_bairro_m2"))
    return by_bairro, by_street


def reference_price(df: DataFrame, min_street_samples: int = 3) -> DataFrame:
    """D2-D4 with J1/J2: hierarchical street -> neighbourhood reference and the % gap."""
    df = df.withColumn("preco_m2_real", F.when(F.col("area_m2") > 0, F.col("valor") / F.col("area_m2"))
                       .otherwise(F.lit(0.0)))
    by_bairro, by_street = (stored(x, "street_stats") for x in street_stats(df))
    df = df.join(by_bairro, "bairro", "left").join(by_street, ["bairro", "rua"], "left")
    invalid = F.col("rua").isin(*dims.INVALID_STREETS)
    valid = ~invalid & (F.col("qtd_amostras_rua") >= min_street_samples)
    valid = F.coalesce(valid, F.lit(False))
    ref = F.bround(F.when(valid, F.col("media_rua_m2")).otherwise(F.col("media_bairro_m2")), 2)
    origin = (F.when(valid, F.lit("Rua"))
              .when(invalid, F.lit("Bairro (Rua desconhecida)"))
              .otherwise(F.lit("Bairro (Amostra insuficiente na rua)")))
    return df.withColumns({"preco_m2_referencia": ref, "origem_referencia": origin}).withColumn(
        "diferenca_percentual",
        F.bround((F.col("preco_m2_real") - F.col("preco_m2_referencia")) / F.col("preco_m2_referencia") * 100, 1))


def street_supply(df: DataFrame) -> DataFrame:
    """A3 + A4 + J3 + J4 + D5: listings per street vs the neighbourhood's mean per street."""
    per_street = stored(df.groupBy("bairro", "rua").agg(F.count("url").alias("qtd_na_rua")), "per_street")
    per_bairro = stored(per_street.groupBy("bairro").agg(F.avg("qtd_na_rua").alias("media_ofertas_por_rua_no_bairro")), "per_bairro")
    df = df.join(per_street, ["bairro", "rua"], "left").join(per_bairro, "bairro", "left")
    qtd = F.coalesce(F.col("qtd_na_rua").cast("double"), F.lit(0.0))
    mean = F.coalesce(F.col("media_ofertas_por_rua_no_bairro"), F.lit(1.0))
    alert = (F.when(qtd < 3, "Normal")
             .when(qtd > mean * 3, "ALERTA: Fuga Possível (Oferta Muito Alta)")
             .when(qtd > mean * 1.5, "Oferta Elevada")
             .otherwise("Normal/Baixa"))
    return df.withColumn("alerta_oferta_rua", alert)


# --------------------------------------------------------------------------- deeds

def valid_deeds(deeds: DataFrame) -> DataFrame:
    """value > 10 000 and (when present) land area > 0; adds price/m² of the deed."""
    cond = F.col("media_valor_transacao") > 10_000
    has_area = "media_area_terreno" in deeds.columns
    if has_area:
        cond = cond & (F.col("media_area_terreno") > 0)
    out = deeds.filter(cond)
    pm2 = (F.col("media_valor_transacao") / F.col("media_area_terreno")) if has_area else F.lit(0.0)
    if "ano_transacao" not in out.columns:   # K10: NULL year instead of a failure
        out = out.withColumn("ano_transacao", F.lit(None).cast("int"))
    return out.withColumn("preco_m2_escritura", pm2)


def deed_stats(deeds: DataFrame) -> DataFrame:
    """A5 + A6 (+J7): per-bairro deed statistics with the appreciation trend.

    The trend needs the *global* latest year; it is a scalar subquery, and the
    recent/old means are two conditional averages of the same ``groupBy``
    (the source's full outer alignment of two grouped series).
    """
    v = valid_deeds(deeds)
    count_col = "total_transacoes" if "total_transacoes" in v.columns else "media_valor_transacao"
    v = v.withColumn("__max_year", v.select(F.max("ano_transacao")).scalar())
    max_year = F.col("__max_year")
    recent = F.col("ano_transacao") >= max_year - 3
    old = F.col("ano_transacao") < max_year - 3
    stats = v.groupBy("bairro").agg(
        # exact mean (decimal sum, one division): no dependence on the order partial sums arrive in
        F.avg(F.col("media_valor_transacao").cast("decimal(38,4)")).cast("double").alias("escritura_valor_medio"),
        F.coalesce(F.avg(F.when(F.col("preco_m2_escritura") > 0, F.col("preco_m2_escritura"))),
                   F.lit(0.0)).alias("escritura_preco_m2_medio"),
        F.count(count_col).alias("escritura_total_transacoes"),
        F.max("ano_transacao").alias("escritura_ano_mais_recente"),
        F.min("ano_transacao").alias("escritura_ano_mais_antigo"),
        F.avg(F.when(recent, F.col("media_valor_transacao"))).alias("_recent"),
        F.avg(F.when(old, F.col("media_valor_transacao"))).alias("_old"),
    )
    middle = grouped_quantiles(v, ["bairro"], "media_valor_transacao", [0.5])
    middle = middle.select(F.col("bairro").alias("_bairro"), F.get("quantis", 0).alias("escritura_valor_mediano"))
    stats = stats.join(middle, F.col("bairro").eqNullSafe(F.col("_bairro")), "left").drop("_bairro")
    trend = F.bround((F.col("_recent") - F.col("_old")) / F.col("_old") * 100, 1)
    r2 = {c: F.bround(c, 2) for c in ("escritura_valor_medio", "escritura_valor_mediano",
                                      "escritura_preco_m2_medio")}
    return stats.withColumn("escritura_valorizacao_pct", trend).withColumns(r2).drop("_recent", "_old")


def join_deeds(df: DataFrame, stats: DataFrame) -> DataFrame:
    """J5 + D6: drop earlier deed columns, left join on bairro, gap of the asking price."""
    old = [c for c in df.columns if c.startswith("escritura_") or c == "delta_escritura_pct"]
    df = df.drop(*old).join(stats, "bairro", "left")
    esc = F.coalesce(F.col("escritura_valor_medio"), F.lit(0.0))
    gap = F.when(esc > 0, F.bround((F.col("valor") - esc) / esc * 100, 1)).otherwise(F.lit(0.0))
    return df.withColumn("delta_escritura_pct", gap)
