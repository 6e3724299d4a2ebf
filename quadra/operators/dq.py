"""Phase 16 and the health check — BI shaping (B1-B4, N36), field rules (Q1-Q9), reports (Q10, Q11).

Every rule is one aggregate inside a single ``agg`` (the source makes ten
passes per field), then unpivoted with ``inline`` to one row per rule.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadra import dims
from quadra.functions.order import ranked
from quadra.functions.text import bool_to_int, to_double0
from quadra.session import stored

MONEY_COLS = ["condominio_R$", "iptu_R$", "valor_R$", "area_m2", "custo_fixo_mensal", "entrada_minima",
              "valor_financiado", "primeira_parcela_estimada", "renda_minima_familiar"]
BOOL_PREFIXES = ("tem_", "aceita_", "tag_", "flag_", "bool_", "alerta_", "gatilho_")
TEXT_NOT_BOOL = {"alerta_oferta_rua"}  # K2: text column under a boolean prefix
FUSIONS = [("final_tem_vista_mar", ["tem_vista_pro_mar", "tag_vista_mar"]),
           ("final_tem_varanda", ["tem_varanda", "tem_varanda_gourmet"]),
           ("final_tem_lazer", ["tem_piscina", "tem_churrasqueira", "tem_academia"])]
OK, WARN, FAIL = "✅", "⚠️", "❌"


def to_bi(df: DataFrame, unknown_geo_text: str = "Url encontrada sem coordenadas") -> DataFrame:
    """BI names (``valor_R$``…), money NULL→0, booleans→int, ISO date text, OR-fusions."""
    df = df.withColumnsRenamed({k: v for k, v in {"valor": "valor_R$", "condominio": "condominio_R$",
                                                   "iptu": "iptu_R$"}.items() if k in df.columns})
    out = {c: to_double0(c) for c in MONEY_COLS if c in df.columns}
    out.update({c: bool_to_int(c) for c in df.columns
                if c.startswith(BOOL_PREFIXES) and c not in TEXT_NOT_BOOL and c not in out})
    if "anuncio_criado" in df.columns:
        out["anuncio_criado"] = F.date_format(F.col("anuncio_criado").cast("date"), "yyyy-MM-dd")
    if "coordenadas" not in df.columns and "latitude" in df.columns:
        known = (F.col("latitude") != 0) & (F.col("longitude") != 0)
        out["coordenadas"] = F.when(known, F.concat_ws(",", F.col("latitude").cast("string"),
                                                      F.col("longitude").cast("string"))).otherwise(unknown_geo_text)
    df = df.withColumns(out)
    fused = {}
    for target, sources in FUSIONS:
        present = [c for c in sources if c in df.columns]
        if present:
            fused[target] = F.greatest(*[F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in present], F.lit(0))
    return df.withColumns(fused)


# ----------------------------------------------------------------------------- field rules

def _rule_metrics(df: DataFrame, field: str, kind: str) -> list[Column]:
    """[positive count, distinct>1 flag] aggregates of one rule."""
    if field not in df.columns:
        return [F.lit(0).cast("bigint"), F.lit(False)]
    c = F.col(f"`{field}`")
    text = F.coalesce(c.cast("string"), F.lit("nan"))
    num = F.coalesce(c.cast("string").try_cast("double"), F.lit(0.0))
    if kind in ("num", "bool", "var"):
        pos = F.count_if(num > 0)
    elif kind == "txt":
        t = F.trim(text)
        pos = F.count_if(~t.isin(*dims.INVALID_TEXT) & (F.length(t) > 0))
    elif kind == "lng":
        pos = F.count_if(F.length(text) > 50)
    elif kind == "geo":
        pos = F.count_if(text.contains(",") & ~text.contains("0.0,0.0") & ~text.contains("Url") & ~text.contains("Nao"))
    else:
        pos = F.lit(0).cast("bigint")
    varies = F.min(num) < F.max(num)   # more than one distinct value, without a distinct shuffle
    return [pos.cast("bigint"), varies]


def field_rules(df: DataFrame, rules=None) -> DataFrame:
    """Q1-Q7 + A10: one row per rule with coverage % and status."""
    rules = rules or dims.FIELD_RULES
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, (field, _, kind, _) in enumerate(rules):
        pos, varies = _rule_metrics(df, field, kind)
        aggs += [pos.alias(f"p{i}"), varies.alias(f"v{i}")]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(i).alias("ord"), F.lit(field).alias("campo"), F.lit(desc).alias("descricao"),
                        F.lit(kind).alias("tipo"), F.lit(mn).alias("min_pct"), F.lit(field in df.columns).alias("present"),
                        F.col(f"p{i}").alias("pos"), F.col(f"v{i}").alias("varies"))
               for i, (field, desc, kind, mn) in enumerate(rules)]
    long = wide.select("__n", F.inline(F.array(*structs)))
    n = F.col("__n")
    pct = F.when(n > 0, F.bround(F.col("pos") / n * 100, 1)).otherwise(0.0)
    status = (F.when(~F.col("present"), FAIL)
              .when(F.col("tipo") == "bool", F.when((F.col("pos") > 0) & (F.col("pos") < n), OK).otherwise(WARN))
              .when(F.col("tipo") == "var", F.when(F.col("varies"), OK).otherwise(FAIL))
              .when(F.col("pct") >= F.col("min_pct"), OK)
              .when(F.col("pct") >= F.col("min_pct") * 0.5, WARN)
              .otherwise(FAIL))
    long = long.withColumn("pct", F.when(F.col("present"), pct).otherwise(0.0))
    return long.withColumn("status", status).select("ord", "campo", "tipo", "min_pct", "pos", "pct", "status")


def verdict(rules: DataFrame) -> DataFrame:
    """Q9: one row — counts per status and the overall verdict."""
    ok = F.count_if(F.col("status") == OK)
    warn = F.count_if(F.col("status") == WARN)
    fail = F.count_if(F.col("status") == FAIL)
    total = F.count(F.lit(1))
    return rules.agg(ok.alias("ok"), warn.alias("avisos"), fail.alias("problemas"), total.alias("total")).withColumn(
        "veredito", F.when(F.col("problemas") > 0, F.format_string("❌ REPROVADO — %d/%d campos OK", "ok", "total"))
        .when(F.col("avisos") > 0, F.format_string("⚠️ APROVADO COM RESSALVAS — %d/%d campos OK", "ok", "total"))
        .otherwise(F.format_string("✅ APROVADO — %d/%d campos OK", "ok", "total")))


def constant_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """A8 + Q8: per numeric column min / max and whether it is constant (min = max or all NULL)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}")]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("coluna"), F.col(f"mn{i}").alias("minimo"), F.col(f"mx{i}").alias("maximo"))
               for i, c in enumerate(cols)]
    long = wide.select(F.inline(F.array(*structs)))
    return long.withColumn("constante", F.coalesce(F.col("minimo") == F.col("maximo"), F.lit(True)).cast("int"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Q10: counts per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, col: str, k: int = 3) -> DataFrame:
    """The ``k`` most common values with their rank (ties by value); a top-k report."""
    order = [F.desc("n"), F.col(col)]
    top = value_counts(df, col).orderBy(*order).limit(k)
    return top.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), col, "n")  # over k rows


def opportunity_level(delta: str = "delta_pct") -> Column:
    """Q11 level ladder."""
    d = F.col(delta)
    return F.when(d < -40, "🔥🔥🔥 EXCEPCIONAL").when(d < -25, "🔥🔥 FORTE").otherwise("🔥 MODERADA")


# FIXED VALUES: what to look at when a field fails, by a part of its name (first match), then by kind
ADVICE = [
    (("condominio", "iptu"), "verificar a taxa e o imposto na página de detalhes (valor em um parágrafo, com espaço não separável)"),
    (("coordenadas",), "verificar o mapa da página de detalhes (latitude e longitude separadas por %2C)"),
    (("publicacao", "dias_"), "verificar o texto de publicação, que pode estar oculto na página"),
]
ADVICE_CONSTANT = "campo calculado com valor fixo: verificar os campos de entrada (condomínio, IPTU, coordenadas)"


def recommendations(rules: DataFrame) -> DataFrame:
    """Q9: what to do about every failed rule, in the order of the rules; none if none failed."""
    field = F.col("campo")
    text = F.when(F.lit(False), "")
    for parts, advice in ADVICE:
        hit = F.lit(False)
        for p in parts:
            hit |= field.contains(p)
        text = text.when(hit, advice)
    text = text.when(F.col("tipo") == "var", ADVICE_CONSTANT).otherwise(
        F.concat(F.lit("cobertura "), F.col("pct").cast("string"), F.lit("% (mínimo esperado: "), F.col("min_pct").cast("string"), F.lit("%): verificar o seletor")))
    return rules.where(F.col("status") == FAIL).select("ord", "campo", text.alias("recomendacao"))


#: A payback of so many years or more means "never" and is not shown.
NO_PAYBACK = 900
#: What the report of opportunities reads.
REPORT_INPUTS = ["id_imovel", "bairro", "zona", "valor", "diferenca_percentual", "tipo_imovel", "area_m2", "quartos", "vagas", "condominio", "iptu",
                 "anos_payback", "score_conforto", "perfil_familia", "perfil_investidor", "perfil_primeiro_imovel"]


def opportunity_report(df: DataFrame, delta: str = "diferenca_percentual") -> DataFrame:
    """Q11: the report's line of every opportunity (below -15 %), ranked: level, costs only where there are any, payback only where it comes."""
    some = lambda c: F.when(F.col(c) > 0, F.bround(c, 0))
    lines = df.where(F.col(delta) < -15).select(
        "id_imovel", "bairro", "zona", "valor", F.col(delta).alias("delta_pct"), opportunity_level(delta).alias("nivel"), "tipo_imovel", "area_m2", "quartos", "vagas",
        some("condominio").alias("condominio"), some("iptu").alias("iptu"), F.when(F.col("anos_payback") < NO_PAYBACK, F.bround("anos_payback", 0)).alias("payback_anos"),
        "score_conforto", "perfil_familia", "perfil_investidor", "perfil_primeiro_imovel")
    # the sort reads its input twice, for the bounds of its ranges and for the rows
    return ranked(stored(lines, "report"), [F.col("delta_pct"), F.col("id_imovel")])
