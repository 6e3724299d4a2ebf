"""Text -> typed columns for collected listing text (X1-X29), as Spark column jobs.

The source parses one element at a time while crawling; here each parser is
a column expression applied to a whole table of collected text.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra import dims
from quadra.functions.text import (WS, extract_decimal, extract_number, parse_pt_date, parse_relative_days,
                                   split_coordinates, title_case, trim_ws)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cost_line(c) -> tuple[Column, Column]:
    """``Cond. R$ 850 • IPTU R$ 1.200`` -> (condominium, tax); absent -> 0."""
    cond = F.regexp_extract(_c(c), f"(?i)Cond\\.{WS}*(R\\${WS}*[0-9.,]+)", 1)
    iptu = F.regexp_extract(_c(c), f"(?i)IPTU{WS}*(R\\${WS}*[0-9.,]+)", 1)
    return (F.when(cond != "", extract_decimal(cond)).otherwise(0.0),
            F.when(iptu != "", extract_decimal(iptu)).otherwise(0.0))


def rating(c) -> tuple[Column, Column]:
    """``4.5/5 (12 …`` -> (4.5, 12); no match -> (0.0, 0)."""
    pat = "([0-9]+(?:\\.[0-9]+)?)/[0-9]+\\s*\\(([0-9]+)"
    score = F.regexp_extract(_c(c), pat, 1)
    count = F.regexp_extract(_c(c), pat, 2)
    return (F.when(score != "", score.try_cast("double")).otherwise(0.0),
            F.when(count != "", count.try_cast("int")).otherwise(0))


def created_date(c, as_of: str) -> Column:
    """X12 + X3: first comma part without the prefix, parsed; missing text -> the collection date."""
    part = trim_ws(F.replace(F.split_part(_c(c), F.lit(","), F.lit(1)), F.lit("Anúncio criado em"), F.lit("")))
    return F.when(F.coalesce(_c(c), F.lit("")) != "", parse_pt_date(part)).otherwise(F.lit(as_of))


def card_location(c) -> tuple[Column, Column, Column]:
    """``<tipo> em <bairro>, <cidade>``; else (Indefinido, text, Rio de Janeiro)."""
    s = F.coalesce(_c(c), F.lit(""))
    has = s.contains(" em ")
    tipo = F.substring_index(s, " em ", 1)
    rest = F.regexp_extract(s, "^.*? em (.*)$", 1)
    bairro = F.trim(F.substring_index(rest, ",", 1))
    cidade = F.trim(F.when(rest.contains(","), F.regexp_extract(rest, "^[^,]*,(.*)$", 1)).otherwise(F.lit("")))
    return (F.when(has, tipo).otherwise("Indefinido"), F.when(has, bairro).otherwise(s),
            F.when(has, cidade).otherwise("Rio de Janeiro"))


def full_address(c) -> dict[str, Column]:
    """``Rua X, 116 - Bairro, Cidade - UF`` (right splits on `` - ``); no separator -> UF RJ."""
    s = F.coalesce(_c(c), F.lit(""))
    has = s.contains(" - ")
    uf = F.trim(F.regexp_extract(s, "^(.*) - (.*)$", 2))
    rest = F.regexp_extract(s, "^(.*) - (.*)$", 1)
    has2 = rest.contains(" - ")
    rua_raw = F.trim(F.regexp_extract(rest, "^(.*) - (.*)$", 1))
    bc = F.trim(F.regexp_extract(rest, "^(.*) - (.*)$", 2))
    has3 = bc.contains(", ")
    bairro = F.when(has3, F.trim(F.regexp_extract(bc, "^(.*), (.*)$", 1))).otherwise(bc)
    cidade = F.when(has3, F.trim(F.regexp_extract(bc, "^(.*), (.*)$", 2))).otherwise(F.lit("Rio de Janeiro"))
    rua = F.trim(F.split_part(rua_raw, F.lit(","), F.lit(1)))
    ok = has & has2
    return {"uf": F.when(has, uf).otherwise(F.lit("RJ")),
            "bairro_end": F.when(ok, bairro), "cidade_end": F.when(ok, cidade),
            "rua_end": F.when(ok & (F.length(rua) > 3), rua)}


def legacy_address(c) -> tuple[Column, Column]:
    """state = last ``-`` token, number = digits of the address."""
    s = F.coalesce(_c(c), F.lit(""))
    return F.trim(F.substring_index(s, "-", -1)), extract_number(s)


def map_url_coords(c) -> tuple[Column, Column]:
    """``[?&]q=lat,lon`` after decoding ``%2C``; no match -> 0.0 (unknown)."""
    s = F.replace(F.replace(F.coalesce(_c(c), F.lit("")), F.lit("%2C"), F.lit(",")), F.lit("%2c"), F.lit(","))
    pat = "[?&]q=(-?[0-9]{1,3}\\.[0-9]+),(-?[0-9]{1,3}\\.[0-9]+)"
    lat, lon = F.regexp_extract(s, pat, 1), F.regexp_extract(s, pat, 2)
    return (F.when(lat != "", lat.try_cast("double")).otherwise(0.0),
            F.when(lon != "", lon.try_cast("double")).otherwise(0.0))


def range_split(c, lo_default: int, hi_default: int) -> tuple[Column, Column]:
    """``'2-3'`` -> (2, 3); ``'3'`` -> (3, 3); empty -> defaults."""
    s = trim_ws(F.coalesce(_c(c), F.lit("")))
    parts = F.split(s, "-")
    lo = F.get(parts, 0).try_cast("int")
    hi = F.coalesce(F.get(parts, 1).try_cast("int"), lo)
    return F.coalesce(lo, F.lit(lo_default)), F.coalesce(hi, F.lit(hi_default))


_TYPES = list(dims.STREET_TYPES.items())


def _type_of(word: Column) -> Column:
    return F.element_at(F.create_map(*[x for k, v in _TYPES for x in (F.lit(k), F.lit(v))]), F.upper(word))


def normalise_street(c) -> Column:
    """City-register street text -> ``Tipo Nome``.

    Stages: keep the part before ``/`` (re-attaching a trailing type), drop
    ``ENTRE …``, then type-first / ``NOME, TIPO`` / ``NOME TIPO`` / plain title.
    """
    raw = F.trim(F.coalesce(_c(c), F.lit("")))
    after_comma = F.upper(F.trim(F.regexp_extract(raw, "^.*,(.*)$", 1)))
    tail_type = F.when(raw.contains(",") & _type_of(after_comma).isNotNull(), after_comma)
    first = F.trim(F.regexp_replace(F.trim(F.split_part(raw, F.lit("/"), F.lit(1))), ",+$", ""))
    first = F.trim(first)
    slashed = F.when(tail_type.isNotNull() & ~first.contains(","), F.concat(first, F.lit(", "), tail_type)).otherwise(first)
    s = F.when(raw.contains("/"), slashed).otherwise(raw)
    s = F.trim(F.regexp_replace(s, "(?i),?\\s*ENTRE\\s+.*$", ""))
    words = F.split(s, "\\s+")
    w0 = F.regexp_replace(F.upper(F.get(words, 0)), ",+$", "")
    rest_words = F.array_join(F.slice(words, 2, 1 << 20), " ")
    t0 = _type_of(w0)
    name_part = F.trim(F.regexp_extract(s, "^(.*),(.*)$", 1))
    type_part = F.upper(F.trim(F.regexp_extract(s, "^(.*),(.*)$", 2)))
    t1 = _type_of(type_part)
    last = F.upper(F.element_at(words, -1))
    t2 = _type_of(last)
    head = F.array_join(F.slice(words, 1, F.size(words) - 1), " ")
    return (F.when((F.length(s) > 0) & t0.isNotNull(), F.concat(t0, F.lit(" "), title_case(rest_words)))
            .when(s.contains(",") & t1.isNotNull(), F.concat(t1, F.lit(" "), title_case(name_part)))
            .when((F.size(words) >= 2) & t2.isNotNull(), F.concat(t2, F.lit(" "), title_case(head)))
            .otherwise(title_case(s)))


def parse_listing_text(df: DataFrame, as_of: str) -> DataFrame:
    """All text parsers over the collected text columns of a listing table."""
    cond, iptu = cost_line("custos_texto")
    nota, total = rating("rating_texto")
    tipo, bairro, cidade = card_location("loc_texto")
    lat, lon = map_url_coords("mapa_url")
    q_lo, q_hi = range_split("faixa_texto", 1, 1)
    uf9, num9 = legacy_address("endereco_completo")
    out = {"valor_txt": extract_decimal("preco_texto"), "digitos": extract_number("faixa_texto"),
           "cond_txt": cond, "iptu_txt": iptu, "nota_txt": nota, "avaliacoes_txt": total,
           "criado_txt": created_date("data_texto", as_of),
           "dias_pub_txt": parse_relative_days("publicacao_texto", "publicado"),
           "dias_atu_txt": parse_relative_days("publicacao_texto", "atualizado"),
           "tipo_card": tipo, "bairro_card": bairro, "cidade_card": cidade,
           "lat_url": lat, "lon_url": lon, "quartos_min": q_lo, "quartos_max": q_hi,
           "estado_g0": uf9, "numero_g0": num9, "logradouro_norm": normalise_street("endereco_prefeitura")}
    out.update(full_address("endereco_completo"))
    return df.withColumns(out)


# FIXED VALUES: what an early card holds where a field is missing
EARLY_DEFAULTS = {"valor": 0, "quartos": 1, "garagem": 0, "banheiro": 1, "area": 30, "iptu": 0, "condominio": 0}
EARLY_TEXTS = {"descricao": "Vazio", "novidade": "Nenhuma"}
NO_PLACE = "Não disponivel"


def comma_parts(c) -> tuple[Column, Column]:
    """The first two comma parts of an address, without blanks around; without two parts both are the placeholder."""
    parts = F.split(F.coalesce(_c(c), F.lit("")), ",")
    two = F.size(parts) >= 2
    return tuple(F.when(two, F.trim(F.get(parts, i))).otherwise(F.lit(NO_PLACE)) for i in (0, 1))


def early_card(df: DataFrame) -> DataFrame:
    """X26 + X27 + X29: a card of the early datasets (texts, null where missing) with numbers, place and defaults."""
    numbers = {c: extract_number(c, default) for c, default in EARLY_DEFAULTS.items()}
    described = trim_ws(F.regexp_replace(F.replace(F.col("descricao"), F.lit("-"), F.lit(" ")), "\\s+", " "))
    local, district = comma_parts("endereco")
    out = df.withColumns({**numbers, "descricao": F.coalesce(described, F.lit(EARLY_TEXTS["descricao"])), "novidade": F.coalesce("novidade", F.lit(EARLY_TEXTS["novidade"])),
                          "local": local, "bairro/cidade": district})
    return out.withColumnRenamed("area", "area(m2)").drop("endereco")
