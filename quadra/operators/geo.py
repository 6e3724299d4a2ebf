"""Phase 4 — distances to points of interest and the geo scores.

The POI set is a bounded dimension (checked against ``MAX_INLINE_POIS``) and
travels with the plan: every listing finds its nearest point per category in
batches of rows — a narrow projection, no shuffle, no join.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra import dims
from quadra.functions.geo import k_nearest, nearest_each, nearest_found
from quadra.functions.text import title_case, trim_ws


def category_points(categories=None, category: str = "") -> list[tuple[int, str, float, float]]:
    cats = dims.POIS if categories is None else categories
    return [(i, n, la, lo) for i, (n, la, lo) in enumerate(cats.get(category, []))]


def nearest_pois(df: DataFrame, categories=None, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """G2 + J8 + J10: ``dist_*_km`` / ``*_prox`` per category and the transport merge."""
    near = {f"__nn_{cat}": category_points(categories, cat) for cat, _, _ in dims.GEO_COLUMNS}
    near |= {"__nn_metro": category_points(categories, "transporte_hub"), "__nn_brt": category_points(categories, "brt_stations")}
    df = df.withColumn("__nn", nearest_each(F.col(lat), F.col(lon), near))
    df = df.withColumns({c: nearest_found(F.col(f"__nn.{c}"), points) for c, points in near.items()})
    out = {}
    for cat, dcol, ncol in dims.GEO_COLUMNS:
        out[dcol] = F.col(f"__nn_{cat}.dist")
        out[ncol] = F.col(f"__nn_{cat}.name")
    brt_closer = F.col("__nn_brt.dist") < F.col("__nn_metro.dist")
    out["dist_transporte_km"] = F.when(brt_closer, F.col("__nn_brt.dist")).otherwise(F.col("__nn_metro.dist"))
    out["transporte_prox"] = F.when(brt_closer, F.col("__nn_brt.name")).otherwise(F.col("__nn_metro.name"))
    return df.withColumns(out).drop("__nn", *near)


def mobility_score(d) -> F.Column:
    """G3."""
    d = F.col(d) if isinstance(d, str) else d
    raw = (F.when(d < 0.6, 10.0).when(d < 1.5, 8.0).when(d < 3.0, 6.0).when(d < 5.0, 4.0)
           .otherwise(F.greatest(F.lit(0.0), 10 - d * 1.5)))
    return F.bround(raw, 1)


def security_score(risk, police) -> F.Column:
    """G4."""
    r, p = F.col(risk), F.col(police)
    s = (F.lit(5.0) - F.when(r < 0.5, 4.0).when(r < 1.0, 2.0).when(r < 2.0, 0.5).otherwise(0.0)
         + F.when(p < 0.8, 2.5).when(p < 2.0, 1.0).otherwise(0.0))
    return F.least(F.greatest(F.bround(s, 1), F.lit(0.0)), F.lit(10.0))


WALKABLE = ["dist_transporte_km", "dist_mercado_km", "dist_feira_km", "dist_lazer_km", "dist_praia_km",
            "dist_shopping_km"]


def lifestyle_score(df: DataFrame) -> F.Column:
    """Walkable (< 1.5 km) services out of six, scaled to 0-10."""
    n = sum((F.col(c) < 1.5).cast("int") for c in WALKABLE if c in df.columns)
    return F.least(F.greatest(F.bround(n * 10 / 6, 1), F.lit(0.0)), F.lit(10.0))


def is_tourist(bairro: str = "bairro") -> F.Column:
    """Membership of the tourist-district set."""
    return title_case(trim_ws(F.coalesce(F.col(bairro), F.lit("nan")))).isin(*dims.TOURIST_DISTRICTS)


def airbnb_vocation(df: DataFrame) -> F.Column:
    """G6 (ordered ladder)."""
    tur = is_tourist()
    beach = F.col("dist_praia_km")
    sight = F.col("dist_turismo_km") if "dist_turismo_km" in df.columns else F.lit(99.0)
    return (F.when(tur & ((beach < 0.8) | (sight < 1.0)), "Altíssima")
            .when(tur & ((beach < 2.0) | (sight < 2.0)), "Alta")
            .when(~tur & (beach < 1.0), "Média")
            .otherwise("Baixa"))


def geo_scores(df: DataFrame) -> DataFrame:
    """G3-G6 over the distance columns."""
    return df.withColumns({
        "score_mobilidade": mobility_score("dist_transporte_km"),
        "score_seguranca": security_score("dist_risco_km", "dist_policia_km"),
        "score_lifestyle": lifestyle_score(df),
        "vocacao_airbnb": airbnb_vocation(df),
    })


def enrich_geo(df: DataFrame, categories=None) -> DataFrame:
    """Whole phase 4."""
    return geo_scores(nearest_pois(df, categories))


# ----------------------------------------------------------------------------- earlier variants

def _km1(c: str) -> F.Column:
    return F.format_string("%.1f", F.bround(F.col(c), 1))


def walkability_index(df: DataFrame) -> F.Column:
    """Count of walkable services -> Excelente / Média / Baixa."""
    n = sum((F.col(c) < 1.5).cast("int") for c in WALKABLE if c in df.columns)
    return F.when(n >= 4, "Excelente (Tudo a pé)").when(n >= 2, "Média").otherwise("Baixa")


def nearby_summary(df: DataFrame, lat: str = "latitude", lon: str = "longitude", categories=None) -> DataFrame:
    """J9 + G8: three nearest health/education points and the ``|``-joined summary text."""
    df = df.withColumn("top3_saude_educ", k_nearest(lat, lon, category_points(categories, "saude_educacao"), 3))
    health = F.array_join(F.transform("top3_saude_educ", lambda p: F.concat(
        p["name"], F.lit(" ("), F.format_string("%.1f", F.bround(p["dist"], 1)), F.lit("km)"))), ", ")
    bus = F.col("transporte_prox").contains("BRT") | F.col("transporte_prox").contains("Estação")
    parts = [
        F.concat(F.when(bus, "🚌").otherwise("🚇"), F.lit(" "), F.col("transporte_prox"), F.lit(" ("),
                 _km1("dist_transporte_km"), F.lit("km)")),
        F.concat(F.when(F.col("dist_mercado_km") < 2.0, "🛒").otherwise("⚠️🛒"), F.lit(" "), F.col("mercado_prox"),
                 F.lit(" ("), _km1("dist_mercado_km"), F.lit("km)")),
        F.when(F.col("dist_feira_km") < 1.5, F.concat(F.lit("🍎 "), F.col("feira_prox"), F.lit(" ("),
                                                       _km1("dist_feira_km"), F.lit("km)"))),
        F.concat(F.lit("🏖️ "), F.col("praia_prox"), F.lit(" ("), _km1("dist_praia_km"), F.lit("km)")),
        F.when(F.col("dist_shopping_km") < 4.0, F.concat(F.lit("🛍️ "), F.col("shopping_prox"), F.lit(" ("),
                                                          _km1("dist_shopping_km"), F.lit("km)"))),
        F.concat(F.lit("🏥/🎓 "), health),
    ]
    return df.withColumn("itens_proximos", F.concat_ws(" | ", *parts))


def map_link(lat: str = "latitude", lon: str = "longitude") -> F.Column:
    """G9."""
    return F.concat(F.lit("https://www.google.com/maps/search/?api=1&query="),
                    F.col(lat).cast("string"), F.lit(","), F.col(lon).cast("string"))


def v1_scores(df: DataFrame) -> DataFrame:
    """First-generation mobility / security / vocation rules."""
    d, risk, pol = F.col("dist_transporte_km"), F.col("dist_risco_km"), F.col("dist_policia_km")
    mob = F.when(d < 0.6, 10.0).when(d < 1.5, 8.0).otherwise(F.greatest(F.lit(0.0), 10 - d * 2))
    sec = (F.lit(5.0) - F.when(risk < 0.5, 4.0).when(risk < 1.0, 2.0).otherwise(0.0)
           + F.when(pol < 0.8, 2.5).when(pol < 2.0, 1.0).otherwise(0.0))
    sul = F.lit(False)
    for b in ["Copacabana", "Ipanema", "Leblon", "Botafogo", "Flamengo"]:   # fixed values
        sul = sul | F.coalesce(F.col("bairro"), F.lit("nan")).contains(b)
    voc = F.when(sul & ((F.col("dist_praia_km") < 0.8) | (d < 0.5)), "Altíssima").otherwise("Baixa")
    return df.withColumns({"score_mobilidade_v1": mob, "score_seguranca_v1": F.least(F.greatest(sec, F.lit(0.0)), F.lit(10.0)),
                           "walkability": walkability_index(df), "vocacao_airbnb_v1": voc,
                           "link_maps": map_link()})
