"""Phases 7-11 — quintile segments, days on market, description tags, urgency, comfort.

Operators: W2 N1-N36.  One tag catalogue drives a single projection of flags
(plain alternatives by ``contains``, the others by ``rlike``); no Python per row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra import dims
from quadra.functions.order import column_quantiles
from quadra.functions.text import bool_to_int, found


def _lower_text(df: DataFrame, col: str = "descricao", title: str = "titulo") -> Column:
    text = F.lower(F.coalesce(F.col(col).cast("string"), F.lit("nan")))
    if title in df.columns:
        text = F.concat(text, F.lit(" "), F.lower(F.coalesce(F.col(title).cast("string"), F.lit("nan"))))
    return text


def extract_tags(df: DataFrame, catalogue=None, col: str = "descricao") -> DataFrame:
    """N1-N26 (or another catalogue): one 0/1 column per pattern."""
    text = _lower_text(df, col)
    return df.withColumns({name: found(text, p).cast("int") for name, p in (catalogue or dims.TAGS)})


def urgency(df: DataFrame, col: str = "descricao", phrases=None, min_days: int = 90) -> DataFrame:
    """N30 + N31: trigger phrase found; golden opportunity = trigger and > 90 days listed."""
    pattern = "|".join(phrases or dims.URGENCY_PHRASES)
    text = F.lower(F.coalesce(F.col(col).cast("string"), F.lit("")))
    days = F.coalesce(F.col("dias_no_mercado"), F.lit(0)) if "dias_no_mercado" in df.columns else F.lit(0)
    df = df.withColumn("gatilho_urgencia", found(text, pattern).cast("int"))
    return df.withColumn("alerta_oportunidade_ouro", ((F.col("gatilho_urgencia") == 1) & (days > min_days)).cast("int"))


def days_on_market(df: DataFrame, as_of: str, col: str = "anuncio_criado") -> DataFrame:
    """N32 + N33: ``as_of − announcement`` in days (unparsable → 0) and the temporal status."""
    d = F.col(col)
    d = d if dict(df.dtypes).get(col) == "date" else F.try_to_date(d.cast("string"))
    days = F.coalesce(F.datediff(F.to_date(F.lit(as_of)), d), F.lit(0))
    df = df.withColumn("dias_no_mercado", days)
    s = F.col("dias_no_mercado")
    status = (F.when(s <= 7, "Recém Chegado (Hype)").when(s <= 30, "Recente (1 Mês)")
              .when(s <= 90, "Normal (3 Meses)").when(s <= 180, "Encalhado (6 Meses)")
              .otherwise("Zombie (> 6 Meses - Barganha Extrema)"))
    return df.withColumn("status_temporal", status)


QUINTILES = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]


def quintile_edges(df: DataFrame, cols: list[str]) -> dict[str, Column]:
    """[0, .2, .4, .6, .8, 1] quantiles of each column of a stored table, as literals (nulls without values)."""
    found = column_quantiles(df, cols, QUINTILES)
    return {c: F.array(*[F.lit(x).cast("double") for x in (found[c][0] or [None] * len(QUINTILES))]) for c in cols}


def quintile_label(c: str, edges: Column, labels: list[str], fallback: str = "Padrão") -> Column:
    """Right-closed bins on linear quantile edges, lowest included; repeated edges → one label.

    (The source's ``qcut(duplicates='drop')`` with five labels fails on repeated
    edges and falls back to a constant; ``ntile`` would split ties differently.)
    """
    e = [F.get(edges, i) for i in range(6)]
    dup = (e[0] == e[1]) | (e[1] == e[2]) | (e[2] == e[3]) | (e[3] == e[4]) | (e[4] == e[5])
    x = F.col(c)
    lab = F.when(x <= e[1], labels[0])
    for i in range(1, 5):
        lab = lab.when(x <= e[i + 1], labels[i])
    return F.when(dup, F.lit(fallback)).otherwise(lab)


def segment_market(df: DataFrame, edges: dict[str, Column] | None = None) -> DataFrame:
    """W2; ``edges`` as :func:`quintile_edges` gives them (of a table with the same rows)."""
    edges = edges or quintile_edges(df, ["valor", "area_m2"])
    return df.withColumns({
        "segmento_mercado": quintile_label("valor", edges["valor"], dims.PRICE_SEGMENTS),
        "perfil_tamanho": quintile_label("area_m2", edges["area_m2"], dims.SIZE_SEGMENTS),
    })


def comfort_index(df: DataFrame) -> DataFrame:
    """Weighted amenities + tags + parking + transit/market bonus, capped at 100."""
    score = (F.coalesce(F.col("vagas").cast("double"), F.lit(0.0)) > 0).cast("int") * dims.COMFORT_PARKING_WEIGHT
    for col, w in dims.COMFORT_WEIGHTS:
        if col in df.columns:
            score = score + bool_to_int(col) * w
    if "dist_transporte_km" in df.columns:
        score = score + (F.coalesce(F.col("dist_transporte_km"), F.lit(99.0)) < 0.7).cast("int") * 10
    if "dist_mercado_km" in df.columns:
        score = score + (F.coalesce(F.col("dist_mercado_km"), F.lit(99.0)) < 0.4).cast("int") * 5
    return df.withColumn("score_conforto", F.least(score, F.lit(100)).cast("int"))


def comfort_class(c: str = "score_conforto") -> Column:
    """N35 (first generation)."""
    s = F.col(c)
    return (F.when(s >= 80, "💎 Super Conforto (Premium)").when(s >= 60, "🥇 Muito Confortável")
            .when(s >= 40, "🥈 Padrão / Bom").when(s >= 20, "🥉 Básico")
            .otherwise("⚠️ Simples / Precisa Melhorias"))


# FIXED VALUES: first-generation tag set.
V1_TAGS = [
    ("tag_lamina", r"\bl[aâ]mina\b"),
    ("tag_planta_circular", r"planta circular|circular"),
    ("tag_cobertura_linear", r"cobertura linear|linear"),
    ("tag_pe_direito_alto", r"p[eé] direito alto|pé-direito"),
    ("tag_janelao", r"janel[aã]o|janelas amplas"),
    ("tag_indevassavel", r"indevass[aá]vel|vista livre"),
    ("tag_vista_cristo", r"vista.*(?:cristo|redentor|corcovado)"),
    ("tag_vista_pao_acucar", r"vista.*(?:p[aã]o de a[cç][uú]car|enseada)"),
    ("tag_vista_mar", r"vista.*(?:mar|oceano|praia)"),
    ("tag_sol_passante", r"sol passante"),
    ("tag_sol_manha", r"sol (?:da|pela) manh[ãa]"),
    ("tag_reformado_arquiteto", r"reformado por arquiteto|projeto de ilumina[cç][aã]o|fino acabamento"),
    ("tag_estado_original", r"estado original|precisa de (?:obra|moderniza[cç][aã]o)|antigo"),
    ("tag_retrofit", r"retrofit|toda hidr[aá]ulica e el[eé]trica nova"),
    ("tag_centro_terreno", r"centro de terreno|afastado"),
    ("tag_exclusivo", r"um por andar|1 por andar|hall privativo|elevador privativo"),
    ("tag_silencioso", r"silencioso|silêncio|rua tranquila|arborizada"),
    ("tag_vazio", r"vazio|chaves|entrega imediata|desocupado"),
    ("tag_doc_ok", r"documenta[cç][aã]o (?:ok|cristalina|perfeita)|aceita financiamento"),
]

# FIXED VALUES: early dataset amenity words (N28), flag -> pattern.
LEGACY_WORDS = [
    ("suite", r"suite|suíte|suites|suítes"),
    ("acabamento", r"porcelanato|ceramica|cerâmica|cerâmico|cerâmicos|gesso|antiderrapante|planejado"),
    ("academia", r"academia|academias"),
    ("varanda", r"varanda|terraço|terraco|sacada|varandas|terraços|terracos|sacadas"),
    ("transporte", r"estação|estaçao|metro|onibus|ônibus"),
    ("salao", r"salao|salão"),
    ("planejado", r"planejado|planejados|planejada|planejadas"),
]

# FIXED VALUES: early property-type classifier (N29), first match wins, else 9.
LEGACY_TYPES = [
    (1, r"kitnet|kitnets|kit|kit net|kitinete|kitinetes|quitinete|kitão|germinada|geminada|conjugado"),
    (2, r"apartamento|apartamentos|apto|cobertura"),
    (3, r"casa de condominio|casa de condomínio|casa de condominios|casa de condomínios"),
    (4, r"studio|studios"),
    (5, r"vila|villa"),
    (6, r"casa|casas"),
    (7, r"loft|duplex|dupllex"),
    (8, r"loteamento|lote|terrenos|terreno|trrno|lote/terreno"),
]


def legacy_type_code(col: str = "descricao") -> Column:
    """N29."""
    text = F.lower(F.coalesce(F.col(col), F.lit("")))
    expr = None
    for code, p in LEGACY_TYPES:
        expr = F.when(text.rlike(p), code) if expr is None else expr.when(text.rlike(p), code)
    return expr.otherwise(9)


def legacy_words(df: DataFrame, col: str = "descricao") -> DataFrame:
    """One 0/1 column per early amenity word list."""
    text = F.lower(F.coalesce(F.col(col), F.lit("")))
    return df.withColumns({f"w_{name}": text.rlike(p).cast("int") for name, p in LEGACY_WORDS})
