"""Phase 5 — acquisition cost, housing-programme and market financing, cash flow.

The source loops over rows; here every quantity is a closed-form column.
Per-band constants (monthly rate, (1+j)^n) are folded in the driver once and
enter the plan as literals, so each row is a handful of multiplications.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra import dims


def monthly_rate(yearly: float) -> float:
    """(1 + aa)^(1/12) − 1."""
    return (1 + yearly) ** (1 / 12) - 1


def price_factors(yearly: float, months: int) -> tuple[float, float, float]:
    """(jm, jm·f, f−1) with f = (1+jm)^n — the Price instalment is fin·(jm·f)/(f−1)."""
    jm = monthly_rate(yearly)
    f = (1 + jm) ** months
    return jm, jm * f, f - 1


def sac(fin: Column, jm: float, n: int) -> tuple[Column, Column, Column]:
    """First and last SAC instalment and total interest (0 when nothing is financed)."""
    a = fin / n
    ok = fin > 0
    first = F.when(ok, F.bround(a + fin * jm, 2)).otherwise(0.0)
    last = F.when(ok, F.bround(a + a * jm, 2)).otherwise(0.0)
    total = F.when(ok, F.bround(F.lit(jm) * fin * (n + 1) / 2, 2)).otherwise(0.0)
    return first, last, total


def price(fin: Column, yearly: float, n: int) -> tuple[Column, Column]:
    """Fixed Price instalment and total interest."""
    jm, k, d = price_factors(yearly, n)
    p = fin * k / d
    ok = (fin > 0) & F.lit(jm > 0)
    return F.when(ok, F.bround(p, 2)).otherwise(0.0), F.when(ok, F.bround(p * n - fin, 2)).otherwise(0.0)


def _by_band(v: Column, values: dict[int, Column | float], default=0.0) -> Column:
    """Pick a per-band expression (band is decided by the first ceiling the value fits)."""
    expr = None
    for band, ceiling, *_ in dims.MCMV_BANDS:
        if band not in values:
            continue
        if band == 2:  # K3: bands 1 and 2 share the 264 000 ceiling, band 2 is never chosen
            continue
        val = values[band]
        val = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(v <= ceiling, val) if expr is None else expr.when(v <= ceiling, val)
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def mcmv_band(v: Column) -> Column:
    """E5: first band whose ceiling holds the value; 0 = not eligible."""
    return _by_band(v, {b[0]: float(b[0]) for b in dims.MCMV_BANDS}, 0.0).cast("int")


def finance(df: DataFrame, value: str = "valor", condo: str = "condominio", tax: str = "iptu",
            bi_compat: bool = False) -> DataFrame:
    """E1 + E5-E13 on every listing."""
    v = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    cond = F.coalesce(F.col(condo).cast("double"), F.lit(0.0))
    iptu = F.coalesce(F.col(tax).cast("double"), F.lit(0.0))
    pos = v > 0
    itbi = F.bround(v * dims.ITBI_RATE, 2)
    cart = F.bround(v * dims.REGISTRY_RATE, 2)
    cols: dict[str, Column] = {
        "itbi_estimado": itbi, "cartorio_estimado": cart,
        "custo_aquisicao_total": F.bround(v + itbi + cart, 2),
    }
    band = F.when(pos, mcmv_band(v)).otherwise(0)
    elig = band > 0

    # housing programme: per-band closed forms
    per = {b: {} for b, *_ in dims.MCMV_BANDS}
    for b, ceiling, sub_max, factor, aa, quota, n, has_sub in dims.MCMV_BANDS:
        sub = F.least(F.lit(sub_max * factor), v * 0.90) if has_sub else F.lit(0.0)
        fin = v * quota
        s1, su, stj = sac(fin, monthly_rate(aa), n)
        pp, ptj = price(fin, aa, n)
        per[b] = {
            "mcmv_subsidio": F.bround(sub, 2), "mcmv_entrada": F.bround(F.greatest(v - fin - sub, F.lit(0.0)), 2),
            "mcmv_financiado": F.bround(fin, 2), "mcmv_juros_aa": F.lit(round(aa * 100, 2)),
            "mcmv_sac_1a": s1, "mcmv_sac_ult": su, "mcmv_sac_juros_total": stj,
            "mcmv_price_parcela": pp, "mcmv_price_juros_total": ptj,
            "mcmv_renda_min_sac": F.bround(s1 / 0.30, 2), "mcmv_renda_min_price": F.bround(pp / 0.30, 2),
        }
    for k in per[1]:
        cols[k] = F.when(elig, _by_band(v, {b: per[b][k] for b in per})).otherwise(0.0)
    cols["mcmv_elegivel"] = elig.cast("int")
    cols["mcmv_faixa"] = band
    cols["mcmv_teto"] = F.when(elig, _by_band(v, {b[0]: b[1] for b in dims.MCMV_BANDS})).otherwise(0.0)

    # market financing (SFH up to its ceiling, SFI above)
    sfh = v <= dims.SFH[0]
    market = {}
    for name, (_, aa, quota, n) in (("SFH", dims.SFH), ("SFI", dims.SFI)):
        fin = v * quota
        s1, su, stj = sac(fin, monthly_rate(aa), n)
        pp, ptj = price(fin, aa, n)
        market[name] = {
            "merc_entrada": F.bround(v - fin, 2), "merc_financiado": F.bround(fin, 2),
            "merc_juros_aa": F.lit(round(aa * 100, 2)), "merc_sac_1a": s1, "merc_sac_ult": su,
            "merc_sac_juros_total": stj, "merc_price_parcela": pp, "merc_price_juros_total": ptj,
            "merc_renda_min_sac": F.bround(s1 / 0.30, 2), "merc_renda_min_price": F.bround(pp / 0.30, 2),
        }
    for k in market["SFH"]:
        cols[k] = F.when(pos, F.when(sfh, market["SFH"][k]).otherwise(market["SFI"][k])).otherwise(0.0)
    cols["merc_modalidade"] = F.when(~pos, "N/A").when(sfh, "SFH").otherwise("SFI")
    df = df.withColumns(cols)
    # Programme saving vs the market Price schedule
    df = df.withColumn("mcmv_economia", F.when(elig, F.bround(F.col("merc_price_juros_total")
                                                                 - F.col("mcmv_price_juros_total"), 2)).otherwise(0.0))
    df = df.withColumn("mcmv_faixa_label", F.element_at(
        F.create_map(*[x for k, lbl in dims.MCMV_LABELS.items() for x in (F.lit(k), F.lit(lbl))]), F.col("mcmv_faixa")))
    if bi_compat:  # K13: market band columns exist in the source but stay 0
        df = df.withColumns({c: F.lit(0.0) for c in ("merc_faixa", "merc_elegivel", "merc_teto",
                                                      "merc_subsidio", "merc_economia")})
    return cash_flow(df, v, cond, iptu)


def cash_flow(df: DataFrame, v: Column, cond: Column, iptu: Column) -> DataFrame:
    """E10 + E11 + E12 + E13."""
    fixed = cond + iptu / 12
    rent = v * dims.RENT_YIELD
    flow = rent - fixed
    yearly = flow * 12
    payback = F.when(yearly > 0, F.col("custo_aquisicao_total") / yearly).otherwise(999.0)
    df = df.withColumns({
        "custo_fixo_mensal": F.bround(fixed, 2), "aluguel_estimado": F.bround(rent, 2),
        "fluxo_caixa_mensal": F.bround(flow, 2),
        "yield_bruto_anual": F.when(v > 0, F.bround(rent * 12 / v * 100, 2)).otherwise(0.0),
        "anos_payback": F.bround(payback, 1),
        "payback_classificacao": (F.when(payback <= 15, "Excelente (<=15 anos)").when(payback <= 20, "Bom (15-20 anos)")
                                  .when(payback <= 30, "Regular (20-30 anos)").when(payback <= 50, "Longo (30-50 anos)")
                                  .when(payback > 50, "Inviavel (>50 anos)").otherwise("N/A")),
    })
    diff = F.coalesce(F.col("diferenca_percentual"), F.lit(0.0)) if "diferenca_percentual" in df.columns else F.lit(0.0)
    dist = (F.coalesce(F.col("dist_transporte_km"), F.lit(99.0)) if "dist_transporte_km" in df.columns
            else F.lit(99.0))
    score = (F.lit(5.0)
             + F.when(diff < -20, 2.0).when(diff < -10, 1.0).otherwise(0.0)
             - F.when(diff > 20, 2.0).when(diff > 10, 1.0).otherwise(0.0)
             + F.when(dist < 0.5, 1.5).when(dist < 1.0, 0.5).otherwise(0.0)
             + F.when(fixed < 500, 1.0).otherwise(0.0) - F.when(fixed > 2500, 1.0).otherwise(0.0)
             + F.when(payback < 15, 1.0).otherwise(0.0) - F.when(payback > 40, 1.0).otherwise(0.0)
             + F.when(F.col("mcmv_elegivel") == 1, 0.5).otherwise(0.0))
    df = df.withColumn("score_investimento", F.least(F.greatest(F.bround(score, 0), F.lit(0.0)), F.lit(10.0)).cast("int"))
    return df.withColumn("resumo_financeiro", finance_summary(flow, payback))


def _thousands(c: Column) -> Column:
    """``f'{x:,.0f}'`` (half-even on the value, comma grouping)."""
    return F.format_number(F.bround(c, 0), 0)


def finance_summary(flow: Column, payback: Column) -> Column:
    """``MCMV Faixa 1: SAC R$1,234 | Subsidio ~R$27,500 | Payback 25a``."""
    elig = F.col("mcmv_elegivel") == 1
    head = F.when(elig, F.concat(F.lit("MCMV "), F.col("mcmv_faixa_label"), F.lit(": SAC R$"), _thousands(F.col("mcmv_sac_1a"))))\
        .otherwise(F.concat(F.col("merc_modalidade"), F.lit(": SAC R$"), _thousands(F.col("merc_sac_1a"))))
    sub = F.when(elig & (F.col("mcmv_subsidio") > 0), F.concat(F.lit("Subsidio ~R$"), _thousands(F.col("mcmv_subsidio"))))
    eco = F.when(elig & (F.col("mcmv_economia") > 0), F.concat(F.lit("Economia R$"), _thousands(F.col("mcmv_economia"))))
    pay = F.when(flow > 0, F.concat(F.lit("Payback "), F.bround(payback, 0).cast("bigint").cast("string"), F.lit("a")))
    return F.concat_ws(" | ", head, sub, eco, pay)


# ----------------------------------------------------------------------------- first generation

def v1_finance(df: DataFrame, value: str = "valor", rate: float = 0.105, months: int = 420,
               entry: float = 0.20) -> DataFrame:
    """Single-scenario SAC: 20 % entry, 80 % financed, first instalment, minimum income."""
    v = F.coalesce(F.col(value), F.lit(0.0))
    fin = v * (1 - entry)
    s1, _, _ = sac(fin, monthly_rate(rate), months)
    return df.withColumns({"entrada_minima": F.bround(v * entry, 2), "valor_financiado": F.bround(fin, 2),
                           "primeira_parcela_estimada": s1, "renda_minima_familiar": F.bround(s1 / 0.30, 2)})


def v1_investment_score(df: DataFrame) -> DataFrame:
    """±2 at ±15 % price gap, +1 transit < 0.8 km, ±1 fixed cost < 1 000 / > 2 500."""
    diff = F.coalesce(F.col("diferenca_percentual"), F.lit(0.0))
    fixed = F.coalesce(F.col("custo_fixo_mensal"), F.lit(0.0))
    s = (F.lit(5.0) + F.when(diff < -15, 2.0).when(diff > 15, -2.0).otherwise(0.0)
         + F.when(F.col("dist_transporte_km") < 0.8, 1.0).otherwise(0.0)
         + F.when(fixed < 1000, 1.0).when(fixed > 2500, -1.0).otherwise(0.0))
    return df.withColumn("score_investimento_v1", F.least(F.greatest(s, F.lit(0.0)), F.lit(10.0)))


def two_rate(v: Column, ceiling: float = 350_000.0, low: float = 0.0785, high: float = 0.105) -> Column:
    """Declared parameter rule — yearly rate by value ceiling."""
    return F.when(v <= ceiling, F.lit(low)).otherwise(F.lit(high))
