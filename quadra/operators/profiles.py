"""Phase 12 — zone, price band, floor class, age, ad quality, audience profiles."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra import dims
from quadra.functions.text import strip_accents, title_case, trim_ws
from quadra.session import stored


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _zone_array() -> Column:
    """array<struct<prio,b,n,zona>> literal of the zone dimension (one parsed SQL literal)."""
    items = ", ".join(f"named_struct('prio', {p}, 'b', {_q(b)}, 'n', {_q(n)}, 'zona', {_q(z)})"
                      for b, n, z, p in dims.zone_rows())
    return F.expr(f"array({items})")


def _first_zone(arr: Column, pred) -> Column:
    hit = F.array_min(F.transform(F.filter(arr, pred), lambda z: F.struct(z["prio"].alias("p"), z["zona"].alias("z"))))
    return hit["z"]


def zone_of(bairro: Column, min_substring: int = 3) -> Column:
    """Exact name -> accent/case-free name -> substring either way -> ``Não classificado``.

    Zones are tried in order (Sul, Norte, Oeste, Centro), so a neighbourhood
    listed in two zones takes the first.  Long card junk is cut first.
    """
    b = title_case(trim_ws(F.coalesce(bairro.cast("string"), F.lit("nan"))))
    junk = (F.length(b) > 50) | b.contains("Para Comprar") | b.contains("Para Alugar")
    cut = F.regexp_extract(b, "[Ee][Mm](.+?)(?:,\\s*Rio|$)", 1)
    b = F.when(junk & (cut != ""), title_case(trim_ws(cut))).otherwise(b)
    norm = F.lower(strip_accents(b))
    arr = _zone_array()
    exact = _first_zone(arr, lambda z: z["b"] == b)
    fuzzy = _first_zone(arr, lambda z: z["n"] == norm)
    sub = F.when(F.length(norm) >= min_substring,
                 _first_zone(arr, lambda z: z["n"].contains(norm) | norm.contains(z["n"])))
    return F.coalesce(exact, fuzzy, sub, F.lit(dims.ZONE_UNKNOWN))


def with_zone(df: DataFrame, col: str = "bairro") -> DataFrame:
    """Zone computed once per distinct neighbourhood, joined back.

    The distinct set is tiny next to the listings (partial aggregation keeps
    the shuffle to one row per neighbourhood per task); it is stored, so that
    its size is known when the join is planned and no listing is shuffled.
    """
    names = df.select(F.col(col).alias("__zb")).distinct()
    zones = stored(names.withColumn("zona", zone_of(F.col("__zb"))), "zones")
    return df.join(zones, F.col(col).eqNullSafe(F.col("__zb")), "left").drop("__zb")


def price_band(v: str = "valor") -> Column:
    """R2."""
    x = F.coalesce(F.col(v), F.lit(0.0))
    return (F.when(x <= 300_000, "Até R$300k").when(x <= 500_000, "R$300k-500k").when(x <= 1_000_000, "R$500k-1M")
            .when(x <= 2_000_000, "R$1M-2M").otherwise("Acima R$2M"))


def floor_class(floor: str = "andar", kind: str = "tipo_imovel") -> Column:
    """R3."""
    a = F.coalesce(F.col(floor).cast("string").try_cast("double"), F.lit(0.0)).cast("int")
    t = F.lower(F.coalesce(F.col(kind).cast("string"), F.lit("nan")))
    return (F.when(t.contains("cobertura"), "Cobertura").when(a == 0, "Térreo / N.I.").when(a <= 3, "Baixo (1-3)")
            .when(a <= 8, "Médio (4-8)").otherwise("Alto (9+)"))


def age_class(status: str = "status_construcao", days: str = "dias_publicado") -> Column:
    """R4."""
    s = F.lower(F.coalesce(F.col(status).cast("string"), F.lit("nan")))
    d = F.coalesce(F.col(days).cast("double"), F.lit(0.0))
    return (F.when(s.contains("planta"), "Lançamento (Na Planta)").when(s.rlike("construção|construcao"), "Em Construção")
            .when(s.contains("pronto") & (d < 365), "Novo / Semi-novo").otherwise("Usado"))


def _txt(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("nan"))


def ad_quality(df: DataFrame) -> Column:
    """0-10 completeness score of the listing."""
    dl = F.length(_txt("descricao"))
    q = (F.when(dl > 500, 2).when(dl > 200, 1).otherwise(0)
         + F.when(F.length(_txt("imagem_url")) > 10, 1).otherwise(0)
         + F.when(F.coalesce(F.col("condominio"), F.lit(0.0)) > 0, 1).otherwise(0)
         + F.when(F.coalesce(F.col("iptu"), F.lit(0.0)) > 0, 1).otherwise(0)
         + F.when(_txt("origem_geo") != "Nao Encontrado", 2).otherwise(0)
         + F.when(~trim_ws(_txt("corretora")).isin("", "Nan", "nan"), 1).otherwise(0)
         + F.when(F.length(_txt("endereco_completo")) > 20, 1).otherwise(0)
         + F.when(F.coalesce(F.col("dias_publicado").cast("double"), F.lit(0.0)) > 0, 1).otherwise(0))
    return F.least(F.greatest(q, F.lit(0)), F.lit(10)).cast("int")


def _num(df: DataFrame, c: str, default: float = 0.0) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(default)


NORM_COLS = ["dist_saude_educ_km", "score_seguranca", "dist_lazer_km", "dist_mercado_km", "custo_fixo_mensal",
             "score_mobilidade", "score_lifestyle", "dist_transporte_km"]


#: Columns that the audience profiles read, and those whose values need two passes of the table.
INPUTS = ["valor", *NORM_COLS, "quartos", "tem_playground", "tem_piscina", "tem_churrasqueira", "tem_condominio_fechado", "tem_portaria_24h",
          "tem_elevador", "diferenca_percentual", "anos_payback", "vocacao_airbnb", "mcmv_elegivel", "mcmv_faixa", "mcmv_subsidio",
          "mcmv_renda_min_sac", "gatilho_urgencia"]
SCORES = [f"perfil_{p}{x}" for p in ("familia", "investidor", "primeiro_imovel") for x in ("", "_label")]


def minmax_stats(df: DataFrame, cols=NORM_COLS) -> Column:
    """W3 support: one scalar subquery row with min and max of every column (NULL→0)."""
    aggs = []
    for c in cols:
        x = _num(df, c)
        aggs += [F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max")]
    return df.select(F.struct(*aggs)).scalar()


def minmax(df: DataFrame, stats: Column, c: str, invert: bool = False) -> Column:
    """(x − min)/(max − min) over the whole table, optional 1 − x; constant column → 0."""
    x, lo, hi = _num(df, c), stats[f"{c}_min"], stats[f"{c}_max"]
    n = F.when(hi == lo, F.lit(0.0)).otherwise((x - lo) / (hi - lo))
    return F.when(hi == lo, F.lit(0.0)).otherwise(1 - n) if invert else n


def audience_profiles(df: DataFrame) -> DataFrame:
    """Family, investor and first-home scores 0-100 with labels."""
    df = df.withColumn("__mm", minmax_stats(df))
    st = F.col("__mm")
    b = lambda c: _num(df, c)
    rooms = _num(df, "quartos")
    fam = (F.when(rooms >= 3, 20).when(rooms >= 2, 15).otherwise(0) + F.when(rooms >= 4, 5).otherwise(0)
           + minmax(df, st, "dist_saude_educ_km", True) * 15 + b("tem_playground") * 10 + b("tem_piscina") * 5
           + b("tem_churrasqueira") * 5 + b("tem_condominio_fechado") * 10 + b("tem_portaria_24h") * 5
           + b("tem_elevador") * 5 + minmax(df, st, "score_seguranca") * 10
           + minmax(df, st, "dist_lazer_km", True) * 5 + minmax(df, st, "dist_mercado_km", True) * 5)
    diff = _num(df, "diferenca_percentual")
    pay = F.coalesce(F.col("anos_payback").cast("double"), F.lit(999.0)) if "anos_payback" in df.columns else F.lit(999.0)
    voc = F.coalesce(F.col("vocacao_airbnb"), F.lit("Baixa")) if "vocacao_airbnb" in df.columns else F.lit("Baixa")
    inv = (F.when(diff < -20, 20).when(diff < -10, 15).when(diff < 0, 8).otherwise(0)
           + F.when(pay < 15, 20).when(pay < 20, 15).when(pay < 30, 8).otherwise(0)
           + minmax(df, st, "custo_fixo_mensal", True) * 10 + minmax(df, st, "score_mobilidade") * 10
           + F.when(voc == "Altíssima", 15).when(voc == "Alta", 10).when(voc == "Média", 5).otherwise(0)
           + F.when(b("mcmv_elegivel") > 0, 5).otherwise(0) + minmax(df, st, "score_lifestyle") * 5
           + F.when(b("gatilho_urgencia") > 0, 5).otherwise(0))
    v = _num(df, "valor")
    renda = b("mcmv_renda_min_sac")
    first = (F.when(b("mcmv_elegivel") > 0, 25).otherwise(0)
             + F.when(b("mcmv_faixa") <= 2, 10).when(b("mcmv_faixa") == 3, 5).otherwise(0)  # K4: band 0 scores too
             + F.when(b("mcmv_subsidio") > 0, 10).otherwise(0)
             + F.when(v <= 264_000, 10).when(v <= 350_000, 5).otherwise(0)
             + minmax(df, st, "score_mobilidade") * 15 + minmax(df, st, "dist_transporte_km", True) * 10
             + b("tem_elevador") * 5 + b("tem_portaria_24h") * 5
             + F.when((renda > 0) & (renda < 4000), 10).when((renda >= 4000) & (renda < 8000), 5).otherwise(0))
    clip = lambda x: F.least(F.greatest(F.bround(x, 0), F.lit(0.0)), F.lit(100.0)).cast("int")
    df = df.withColumns({"perfil_familia": clip(fam), "perfil_investidor": clip(inv),
                         "perfil_primeiro_imovel": clip(first)}).drop("__mm")
    return df.withColumns({f"{c}_label": profile_label(c, lbl) for c, lbl in
                           [("perfil_familia", "Família"), ("perfil_investidor", "Investidor"),
                            ("perfil_primeiro_imovel", "Primeiro Imóvel")]})


def profile_label(c: str, label: str) -> Column:
    """R9."""
    s = F.col(c)
    return (F.when(s >= 70, f"Excelente p/ {label}").when(s >= 50, f"Bom p/ {label}")
            .when(s >= 30, f"Regular p/ {label}").otherwise(f"Fraco p/ {label}"))


def row_profiles(df: DataFrame) -> DataFrame:
    """The columns of phase 12 that need no pass of the whole table."""
    df = with_zone(df)
    return df.withColumns({"faixa_preco": price_band(), "andar_classificacao": floor_class(),
                           "idade_estimada": age_class(), "score_qualidade_anuncio": ad_quality(df)})


def profiles(df: DataFrame) -> DataFrame:
    """Whole phase 12."""
    return audience_profiles(row_profiles(df))
