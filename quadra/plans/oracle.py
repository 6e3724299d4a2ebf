"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark operators: plain ANSI SQL + DuckDB
functions over the same parquet tables.  Rounding goes through the shortest
decimal text of the double and DECIMAL so half-even ties match Spark's
``bround`` (DuckDB's own ``round_even`` on DOUBLE rounds the binary value).
"""
from __future__ import annotations

from quadra import dims
from quadra.sources import listing_view as lv

WS = r"[\s\x{00A0}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rnd(x: str, n: int) -> str:
    """Half-even on the shortest decimal form of the double, as Spark's ``bround`` does."""
    return f"CAST(round_even(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
            f"lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), '')")


def std(x: str) -> str:
    return title(trim(f"coalesce(CAST({x} AS VARCHAR), 'nan')"))


def in_list(x: str, values) -> str:
    return f"{x} IN ({', '.join(q(v) for v in values)})"


def accents(x: str) -> str:
    return (f"translate({x}, 'áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ', "
            f"'aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN')")


# ----------------------------------------------------------------------------- silver

def silver_ctes() -> str:
    """raw -> dedup -> typed -> sane -> trimmed -> silver (phase 2)."""
    order = lv.listing_order_sql()
    return f"""
raw AS ({lv.listing_view_sql()}),
ided AS (SELECT *, CASE WHEN regexp_extract(url, 'id-([0-9]+)', 1) <> '' THEN regexp_extract(url, 'id-([0-9]+)', 1)
                        ELSE url END AS id_imovel FROM raw),
dedup AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id_imovel ORDER BY {order}) AS rn FROM ided) WHERE rn = 1),
typed AS (SELECT * REPLACE (coalesce(valor, 0) AS valor, coalesce(area_m2, 0) AS area_m2,
                            coalesce(condominio, 0) AS condominio, coalesce(iptu, 0) AS iptu,
                            coalesce(quartos, 0) AS quartos, coalesce(vagas, 0) AS vagas,
                            coalesce(banheiros, 0) AS banheiros, coalesce(suites, 0) AS suites),
                 CAST(coalesce(vagas, 0) > 0 AS INTEGER) AS bool_vaga FROM dedup),
sane AS (SELECT *, {rnd('valor / area_m2', 2)} AS preco_m2 FROM typed WHERE valor > 10000 AND area_m2 >= 10),
bounds AS (SELECT quantile_cont(preco_m2, 0.01) AS q_lo, quantile_cont(preco_m2, 0.99) AS q_hi,
                  count(*) AS n FROM sane),
trimmed AS (SELECT sane.* FROM sane, bounds WHERE n <= 20 OR (preco_m2 > q_lo AND preco_m2 < q_hi)),
std1 AS (SELECT * REPLACE ({std('bairro')} AS bairro, {std('tipo')} AS tipo, {std('cidade')} AS cidade,
                           {std('descricao')} AS descricao, {std('rua')} AS rua, {std('corretora')} AS corretora)
         FROM trimmed),
std2 AS (SELECT * REPLACE ({title(trim("CASE WHEN regexp_extract(tipo, '^(.+?)\\s+Para\\b', 1) <> '' THEN regexp_extract(tipo, '^(.+?)\\s+Para\\b', 1) ELSE tipo END"))} AS tipo)
         FROM std1),
silver AS (SELECT * REPLACE (CASE WHEN {in_list(std('tipo_imovel'), ['', 'Nan', 'Não Informado', 'None'])}
                                  THEN tipo ELSE {std('tipo_imovel')} END AS tipo_imovel) FROM std2)"""


def reference_ctes() -> str:
    """Phase 3 on top of silver -> ``priced``."""
    bad = in_list("p.rua", dims.INVALID_STREETS)
    return f""",
p0 AS (SELECT *, CASE WHEN area_m2 > 0 THEN valor / area_m2 ELSE 0.0 END AS preco_m2_real FROM silver),
by_bairro AS (SELECT bairro, avg(preco_m2_real) AS media_bairro_m2 FROM p0 WHERE preco_m2_real > 100 GROUP BY bairro),
by_rua AS (SELECT bairro, rua, avg(preco_m2_real) AS media_rua_m2, count(*) AS qtd_amostras_rua
           FROM p0 WHERE preco_m2_real > 100 GROUP BY bairro, rua),
p1 AS (SELECT p.*, b.media_bairro_m2, r.media_rua_m2, r.qtd_amostras_rua,
              coalesce(NOT ({bad}) AND r.qtd_amostras_rua >= 3, false) AS _valid, {bad} AS _invalid
       FROM p0 p LEFT JOIN by_bairro b ON p.bairro = b.bairro
                 LEFT JOIN by_rua r ON p.bairro = r.bairro AND p.rua = r.rua),
p2 AS (SELECT *, {rnd('CASE WHEN _valid THEN media_rua_m2 ELSE media_bairro_m2 END', 2)} AS preco_m2_referencia,
              CASE WHEN _valid THEN 'Rua' WHEN _invalid THEN 'Bairro (Rua desconhecida)'
                   ELSE 'Bairro (Amostra insuficiente na rua)' END AS origem_referencia FROM p1),
priced AS (SELECT * EXCLUDE (_valid, _invalid),
                  {rnd('(preco_m2_real - preco_m2_referencia) / preco_m2_referencia * 100', 1)} AS diferenca_percentual
           FROM p2)"""


def with_silver(body: str, priced: bool = False) -> str:
    return "WITH " + silver_ctes() + (reference_ctes() if priced else "") + "\n" + body


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql


# ----------------------------------------------------------------------------- queries

register("dedup_first", f"""
WITH raw AS ({lv.listing_view_sql()}),
ided AS (SELECT *, CASE WHEN regexp_extract(url, 'id-([0-9]+)', 1) <> '' THEN regexp_extract(url, 'id-([0-9]+)', 1)
                        ELSE url END AS id_imovel FROM raw)
SELECT id_imovel, url, valor, area_m2, quartos, bairro, rua FROM (
  SELECT *, row_number() OVER (PARTITION BY id_imovel ORDER BY {lv.listing_order_sql()}) AS rn FROM ided) WHERE rn = 1
""")

register("sanity_trim", with_silver("""
SELECT id_imovel, valor, area_m2, preco_m2, bool_vaga, bairro, rua, tipo, tipo_imovel, corretora FROM silver
"""))

register("street_reference", with_silver(f"""
SELECT id_imovel, bairro, rua, {rnd('preco_m2_real', 4)} AS preco_m2_real,
       {rnd('media_bairro_m2', 2)} AS media_bairro_m2, {rnd('media_rua_m2', 2)} AS media_rua_m2,
       CAST(qtd_amostras_rua AS BIGINT) AS qtd_amostras_rua, preco_m2_referencia, origem_referencia,
       diferenca_percentual
FROM priced
""", priced=True))

register("supply_alert", with_silver(f"""
, per_street AS (SELECT bairro, rua, count(url) AS qtd_na_rua FROM silver GROUP BY bairro, rua),
per_bairro AS (SELECT bairro, avg(qtd_na_rua) AS media_ofertas_por_rua_no_bairro FROM per_street GROUP BY bairro)
SELECT s.id_imovel, s.bairro, s.rua, CAST(ps.qtd_na_rua AS BIGINT) AS qtd_na_rua,
       {rnd('pb.media_ofertas_por_rua_no_bairro', 4)} AS media_ofertas_por_rua_no_bairro,
       CASE WHEN coalesce(ps.qtd_na_rua, 0) < 3 THEN 'Normal'
            WHEN coalesce(ps.qtd_na_rua, 0) > coalesce(pb.media_ofertas_por_rua_no_bairro, 1) * 3
                 THEN 'ALERTA: Fuga Possível (Oferta Muito Alta)'
            WHEN coalesce(ps.qtd_na_rua, 0) > coalesce(pb.media_ofertas_por_rua_no_bairro, 1) * 1.5 THEN 'Oferta Elevada'
            ELSE 'Normal/Baixa' END AS alerta_oferta_rua
FROM silver s LEFT JOIN per_street ps ON s.bairro = ps.bairro AND s.rua = ps.rua
              LEFT JOIN per_bairro pb ON s.bairro = pb.bairro
""").replace("WITH \nraw", "WITH \nraw", 1))


# ----------------------------------------------------------------------------- enrichment chain

def D(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def poi_values() -> str:
    rows = [f"({q(c)}, {o}, {q(n)}, {D(la)}, {D(lo)})" for c, o, n, la, lo in dims.poi_rows()]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(category, ord, name, plat, plon)"


def hav(lat: str, lon: str, plat: str, plon: str) -> str:
    return (f"CAST(12742.0 AS DOUBLE) * asin(sqrt(pow(sin((radians({plat}) - radians({lat})) / 2), 2) + "
            f"cos(radians({lat})) * cos(radians({plat})) * pow(sin((radians({plon}) - radians({lon})) / 2), 2)))")


def geo_ctes(src: str) -> str:
    cats = [c for c, _, _ in dims.GEO_COLUMNS] + ["transporte_hub", "brt_stations"]
    cols = []
    for c in cats:
        if c in dims.POIS:
            cols.append(f"coalesce(max(CASE WHEN n.category = {q(c)} THEN n.d END), CASE WHEN s.latitude <> 0 AND s.longitude <> 0 THEN NULL ELSE 999.0 END) AS d_{c}")
            cols.append(f"coalesce(max(CASE WHEN n.category = {q(c)} THEN n.name END), 'N/A') AS n_{c}")
        else:
            cols.append(f"{D(99.9)} AS d_{c}")
            cols.append(f"'N/A' AS n_{c}")
    sel = []
    for c, dcol, ncol in dims.GEO_COLUMNS:
        sel += [f"d_{c} AS {dcol}", f"n_{c} AS {ncol}"]
    tur = in_list(std("bairro"), dims.TOURIST_DISTRICTS)
    return f""",
poi AS ({poi_values()}),
cand AS (SELECT s.id_imovel, p.category, p.ord, p.name,
                {hav('s.latitude', 's.longitude', 'p.plat', 'p.plon')} AS dist
         FROM {src} s, poi p WHERE s.latitude <> 0 AND s.longitude <> 0),
nn AS (SELECT id_imovel, category, name, {rnd('dist', 2)} AS d FROM (
         SELECT *, row_number() OVER (PARTITION BY id_imovel, category ORDER BY dist, ord) AS rk FROM cand) WHERE rk = 1),
nnw AS (SELECT s.id_imovel, {', '.join(cols)}
        FROM {src} s LEFT JOIN nn n ON s.id_imovel = n.id_imovel GROUP BY s.id_imovel, s.latitude, s.longitude),
g0 AS (SELECT s.*, {', '.join(sel)},
              CASE WHEN w.d_brt_stations < w.d_transporte_hub THEN w.d_brt_stations ELSE w.d_transporte_hub END AS dist_transporte_km,
              CASE WHEN w.d_brt_stations < w.d_transporte_hub THEN w.n_brt_stations ELSE w.n_transporte_hub END AS transporte_prox
       FROM {src} s JOIN nnw w ON s.id_imovel = w.id_imovel),
geo AS (SELECT *,
   {rnd('CASE WHEN dist_transporte_km < 0.6 THEN 10.0 WHEN dist_transporte_km < 1.5 THEN 8.0 WHEN dist_transporte_km < 3.0 THEN 6.0 WHEN dist_transporte_km < 5.0 THEN 4.0 ELSE greatest(0.0, 10 - dist_transporte_km * 1.5) END', 1)} AS score_mobilidade,
   least(greatest({rnd('5.0 - CASE WHEN dist_risco_km < 0.5 THEN 4.0 WHEN dist_risco_km < 1.0 THEN 2.0 WHEN dist_risco_km < 2.0 THEN 0.5 ELSE 0.0 END + CASE WHEN dist_policia_km < 0.8 THEN 2.5 WHEN dist_policia_km < 2.0 THEN 1.0 ELSE 0.0 END', 1)}, 0.0), 10.0) AS score_seguranca,
   least(greatest({rnd('(CAST(dist_transporte_km < 1.5 AS INTEGER) + CAST(dist_mercado_km < 1.5 AS INTEGER) + CAST(dist_feira_km < 1.5 AS INTEGER) + CAST(dist_lazer_km < 1.5 AS INTEGER) + CAST(dist_praia_km < 1.5 AS INTEGER) + CAST(dist_shopping_km < 1.5 AS INTEGER)) * 10 / 6', 1)}, 0.0), 10.0) AS score_lifestyle,
   CASE WHEN {tur} AND (dist_praia_km < 0.8 OR dist_turismo_km < 1.0) THEN 'Altíssima'
        WHEN {tur} AND (dist_praia_km < 2.0 OR dist_turismo_km < 2.0) THEN 'Alta'
        WHEN NOT ({tur}) AND dist_praia_km < 1.0 THEN 'Média' ELSE 'Baixa' END AS vocacao_airbnb
   FROM g0)"""


def _sac_sql(fin: str, jm: float, n: int):
    a = f"({fin}) / {n}"
    ok = f"({fin}) > 0"
    return (f"CASE WHEN {ok} THEN {rnd(f'{a} + ({fin}) * {D(jm)}', 2)} ELSE 0.0 END",
            f"CASE WHEN {ok} THEN {rnd(f'{a} + {a} * {D(jm)}', 2)} ELSE 0.0 END",
            f"CASE WHEN {ok} THEN {rnd(f'{D(jm)} * ({fin}) * {n + 1} / 2', 2)} ELSE 0.0 END")


def _price_sql(fin: str, aa: float, n: int):
    jm = (1 + aa) ** (1 / 12) - 1
    f = (1 + jm) ** n
    p = f"({fin}) * {D(jm * f)} / {D(f - 1)}"
    ok = f"({fin}) > 0"
    return (f"CASE WHEN {ok} THEN {rnd(p, 2)} ELSE 0.0 END",
            f"CASE WHEN {ok} THEN {rnd(f'{p} * {n} - ({fin})', 2)} ELSE 0.0 END")


def finance_ctes(src: str) -> str:
    v = "valor"
    band_case = []
    per = {}
    for b, ceiling, sub_max, factor, aa, quota, n, has_sub in dims.MCMV_BANDS:
        jm = (1 + aa) ** (1 / 12) - 1
        sub = f"least({D(sub_max * factor)}, {v} * {D(0.90)})" if has_sub else "0.0"
        fin = f"{v} * {D(quota)}"
        s1, su, stj = _sac_sql(fin, jm, n)
        pp, ptj = _price_sql(fin, aa, n)
        per[b] = {"mcmv_subsidio": rnd(sub, 2), "mcmv_entrada": rnd(f"greatest({v} - {fin} - {sub}, 0.0)", 2),
                  "mcmv_financiado": rnd(fin, 2), "mcmv_juros_aa": D(round(aa * 100, 2)),
                  "mcmv_sac_1a": s1, "mcmv_sac_ult": su, "mcmv_sac_juros_total": stj,
                  "mcmv_price_parcela": pp, "mcmv_price_juros_total": ptj,
                  "mcmv_renda_min_sac": rnd(f"({s1}) / {D(0.30)}", 2), "mcmv_renda_min_price": rnd(f"({pp}) / {D(0.30)}", 2),
                  "mcmv_teto": D(ceiling)}
    def by_band(k):
        return (f"CASE WHEN {v} <= 0 THEN 0.0 WHEN {v} <= 264000 THEN {per[1][k]} WHEN {v} <= 350000 THEN {per[3][k]} "
                f"WHEN {v} <= 500000 THEN {per[4][k]} ELSE 0.0 END")
    mcmv = ",\n  ".join(f"{by_band(k)} AS {k}" for k in per[1])
    market = {}
    for name, (_, aa, quota, n) in (("SFH", dims.SFH), ("SFI", dims.SFI)):
        jm = (1 + aa) ** (1 / 12) - 1
        fin = f"{v} * {D(quota)}"
        s1, su, stj = _sac_sql(fin, jm, n)
        pp, ptj = _price_sql(fin, aa, n)
        market[name] = {"merc_entrada": rnd(f"{v} - {fin}", 2), "merc_financiado": rnd(fin, 2),
                        "merc_juros_aa": D(round(aa * 100, 2)), "merc_sac_1a": s1, "merc_sac_ult": su,
                        "merc_sac_juros_total": stj, "merc_price_parcela": pp, "merc_price_juros_total": ptj,
                        "merc_renda_min_sac": rnd(f"({s1}) / {D(0.30)}", 2),
                        "merc_renda_min_price": rnd(f"({pp}) / {D(0.30)}", 2)}
    merc = ",\n  ".join(f"CASE WHEN {v} <= 0 THEN 0.0 WHEN {v} <= {D(dims.SFH[0])} THEN {market['SFH'][k]} "
                        f"ELSE {market['SFI'][k]} END AS {k}" for k in market["SFH"])
    band = (f"CASE WHEN {v} <= 0 THEN 0 WHEN {v} <= 264000 THEN 1 WHEN {v} <= 350000 THEN 3 "
            f"WHEN {v} <= 500000 THEN 4 ELSE 0 END")
    fixed = "(coalesce(condominio, 0) + coalesce(iptu, 0) / 12)"
    rent = f"({v} * {D(0.0045)})"
    flow = f"({rent} - {fixed})"
    payback = f"(CASE WHEN {flow} * 12 > 0 THEN custo_aquisicao_total / ({flow} * 12) ELSE 999.0 END)"
    diff = "coalesce(diferenca_percentual, 0.0)"
    dist = "coalesce(dist_transporte_km, 99.0)"
    score = (f"5.0 + CASE WHEN {diff} < -20 THEN 2.0 WHEN {diff} < -10 THEN 1.0 ELSE 0.0 END"
             f" - CASE WHEN {diff} > 20 THEN 2.0 WHEN {diff} > 10 THEN 1.0 ELSE 0.0 END"
             f" + CASE WHEN {dist} < 0.5 THEN 1.5 WHEN {dist} < 1.0 THEN 0.5 ELSE 0.0 END"
             f" + CASE WHEN {fixed} < 500 THEN 1.0 ELSE 0.0 END - CASE WHEN {fixed} > 2500 THEN 1.0 ELSE 0.0 END"
             f" + CASE WHEN {payback} < 15 THEN 1.0 ELSE 0.0 END - CASE WHEN {payback} > 40 THEN 1.0 ELSE 0.0 END"
             f" + CASE WHEN mcmv_elegivel = 1 THEN 0.5 ELSE 0.0 END")
    th = lambda x: f"format('{{:,.0f}}', {rnd(x, 0)})"
    labels = " ".join(f"WHEN {k} THEN {q(lbl)}" for k, lbl in dims.MCMV_LABELS.items())
    return f""",
f0 AS (SELECT *, {rnd(f'{v} * {D(0.03)}', 2)} AS itbi_estimado, {rnd(f'{v} * {D(0.015)}', 2)} AS cartorio_estimado,
              {rnd(f'{v} + {rnd(f"{v} * {D(0.03)}", 2)} + {rnd(f"{v} * {D(0.015)}", 2)}', 2)} AS custo_aquisicao_total,
  {mcmv},
  {merc},
  CAST({band} > 0 AS INTEGER) AS mcmv_elegivel, {band} AS mcmv_faixa,
  CASE WHEN {v} <= 0 THEN 'N/A' WHEN {v} <= {D(dims.SFH[0])} THEN 'SFH' ELSE 'SFI' END AS merc_modalidade
  FROM {src}),
f1 AS (SELECT *, CASE WHEN mcmv_elegivel = 1 THEN {rnd('merc_price_juros_total - mcmv_price_juros_total', 2)} ELSE 0.0 END AS mcmv_economia,
              CASE mcmv_faixa {labels} END AS mcmv_faixa_label,
              {rnd(fixed, 2)} AS custo_fixo_mensal, {rnd(rent, 2)} AS aluguel_estimado, {rnd(flow, 2)} AS fluxo_caixa_mensal,
              CASE WHEN {v} > 0 THEN {rnd(f'{rent} * 12 / {v} * 100', 2)} ELSE 0.0 END AS yield_bruto_anual,
              {rnd(payback, 1)} AS anos_payback,
              CASE WHEN {payback} <= 15 THEN 'Excelente (<=15 anos)' WHEN {payback} <= 20 THEN 'Bom (15-20 anos)'
                   WHEN {payback} <= 30 THEN 'Regular (20-30 anos)' WHEN {payback} <= 50 THEN 'Longo (30-50 anos)'
                   WHEN {payback} > 50 THEN 'Inviavel (>50 anos)' ELSE 'N/A' END AS payback_classificacao,
              CAST(least(greatest({rnd(score, 0)}, 0.0), 10.0) AS INTEGER) AS score_investimento,
              {flow} AS _flow, {payback} AS _payback
       FROM f0),
fin AS (SELECT * EXCLUDE (_flow, _payback), concat_ws(' | ',
           CASE WHEN mcmv_elegivel = 1 THEN 'MCMV ' || mcmv_faixa_label || ': SAC R$' || {th('mcmv_sac_1a')}
                ELSE merc_modalidade || ': SAC R$' || {th('merc_sac_1a')} END,
           CASE WHEN mcmv_elegivel = 1 AND mcmv_subsidio > 0 THEN 'Subsidio ~R$' || {th('mcmv_subsidio')} END,
           CASE WHEN mcmv_elegivel = 1 AND mcmv_economia > 0 THEN 'Economia R$' || {th('mcmv_economia')} END,
           CASE WHEN _flow > 0 THEN 'Payback ' || CAST(CAST({rnd('_payback', 0)} AS BIGINT) AS VARCHAR) || 'a' END
        ) AS resumo_financeiro FROM f1)"""


def tail_ctes(src: str) -> str:
    """supply -> segments -> days -> tags -> urgency -> comfort -> profiles, from ``src``."""
    tag_cols = ",\n  ".join(f"CAST(regexp_matches(lower(coalesce(descricao, 'nan')), {q(p)}) AS INTEGER) AS {n}"
                            for n, p in dims.TAGS)
    urg = "|".join(dims.URGENCY_PHRASES)
    comfort = " + ".join(f"coalesce({c}, 0) * {w}" for c, w in dims.COMFORT_WEIGHTS)
    seg = dims.PRICE_SEGMENTS
    size = dims.SIZE_SEGMENTS

    def qlab(c, e, labels):
        dup = " OR ".join(f"{e}[{i}] = {e}[{i + 1}]" for i in range(1, 6))
        whens = " ".join(f"WHEN {c} <= {e}[{i + 2}] THEN {q(labels[i])}" for i in range(5))
        return f"CASE WHEN {dup} THEN 'Padrão' ELSE CASE {whens} END END"
    zone_rows = ", ".join(f"({q(b)}, {q(n)}, {q(z)}, {p})" for b, n, z, p in dims.zone_rows())
    b = std("bairro")
    bj = (f"CASE WHEN (length({b}) > 50 OR contains({b}, 'Para Comprar') OR contains({b}, 'Para Alugar')) "
          f"AND regexp_extract({b}, '[Ee][Mm](.+?)(?:,\\s*Rio|$)', 1) <> '' "
          f"THEN {title(trim(f'regexp_extract({b}, ' + q('[Ee][Mm](.+?)(?:,\\s*Rio|$)') + ', 1)'))} ELSE {b} END")
    norm_cols = ["dist_saude_educ_km", "score_seguranca", "dist_lazer_km", "dist_mercado_km", "custo_fixo_mensal",
                 "score_mobilidade", "score_lifestyle", "dist_transporte_km"]
    mm = ", ".join(f"min(coalesce({c}, 0)) AS {c}_min, max(coalesce({c}, 0)) AS {c}_max" for c in norm_cols)

    def nrm(c, inv=False):
        x = f"(CASE WHEN m.{c}_max = m.{c}_min THEN 0.0 ELSE (coalesce(t.{c}, 0) - m.{c}_min) / (m.{c}_max - m.{c}_min) END)"
        return f"(CASE WHEN m.{c}_max = m.{c}_min THEN 0.0 ELSE 1 - {x} END)" if inv else x
    fam = (f"CASE WHEN quartos >= 3 THEN 20 WHEN quartos >= 2 THEN 15 ELSE 0 END + CASE WHEN quartos >= 4 THEN 5 ELSE 0 END"
           f" + {nrm('dist_saude_educ_km', True)} * 15 + tem_playground * 10 + tem_piscina * 5 + tem_churrasqueira * 5"
           f" + tem_condominio_fechado * 10 + tem_portaria_24h * 5 + tem_elevador * 5 + {nrm('score_seguranca')} * 10"
           f" + {nrm('dist_lazer_km', True)} * 5 + {nrm('dist_mercado_km', True)} * 5")
    diff = "coalesce(diferenca_percentual, 0)"
    pay = "coalesce(anos_payback, 999.0)"
    inv = (f"CASE WHEN {diff} < -20 THEN 20 WHEN {diff} < -10 THEN 15 WHEN {diff} < 0 THEN 8 ELSE 0 END"
           f" + CASE WHEN {pay} < 15 THEN 20 WHEN {pay} < 20 THEN 15 WHEN {pay} < 30 THEN 8 ELSE 0 END"
           f" + {nrm('custo_fixo_mensal', True)} * 10 + {nrm('score_mobilidade')} * 10"
           f" + CASE vocacao_airbnb WHEN 'Altíssima' THEN 15 WHEN 'Alta' THEN 10 WHEN 'Média' THEN 5 ELSE 0 END"
           f" + CASE WHEN mcmv_elegivel > 0 THEN 5 ELSE 0 END + {nrm('score_lifestyle')} * 5"
           f" + CASE WHEN gatilho_urgencia > 0 THEN 5 ELSE 0 END")
    first = (f"CASE WHEN mcmv_elegivel > 0 THEN 25 ELSE 0 END + CASE WHEN mcmv_faixa <= 2 THEN 10 WHEN mcmv_faixa = 3 THEN 5 ELSE 0 END"
             f" + CASE WHEN mcmv_subsidio > 0 THEN 10 ELSE 0 END + CASE WHEN valor <= 264000 THEN 10 WHEN valor <= 350000 THEN 5 ELSE 0 END"
             f" + {nrm('score_mobilidade')} * 15 + {nrm('dist_transporte_km', True)} * 10 + tem_elevador * 5 + tem_portaria_24h * 5"
             f" + CASE WHEN mcmv_renda_min_sac > 0 AND mcmv_renda_min_sac < 4000 THEN 10"
             f" WHEN mcmv_renda_min_sac >= 4000 AND mcmv_renda_min_sac < 8000 THEN 5 ELSE 0 END")
    clip = lambda x: f"CAST(least(greatest({rnd(x, 0)}, 0.0), 100.0) AS INTEGER)"

    def lbl(c, name):
        return (f"CASE WHEN {c} >= 70 THEN {q('Excelente p/ ' + name)} WHEN {c} >= 50 THEN {q('Bom p/ ' + name)} "
                f"WHEN {c} >= 30 THEN {q('Regular p/ ' + name)} ELSE {q('Fraco p/ ' + name)} END")
    txt = lambda c: f"coalesce(CAST({c} AS VARCHAR), 'nan')"
    adq = (f"CASE WHEN length({txt('descricao')}) > 500 THEN 2 WHEN length({txt('descricao')}) > 200 THEN 1 ELSE 0 END"
           f" + CASE WHEN length({txt('imagem_url')}) > 10 THEN 1 ELSE 0 END + CASE WHEN coalesce(condominio, 0) > 0 THEN 1 ELSE 0 END"
           f" + CASE WHEN coalesce(iptu, 0) > 0 THEN 1 ELSE 0 END + CASE WHEN {txt('origem_geo')} <> 'Nao Encontrado' THEN 2 ELSE 0 END"
           f" + CASE WHEN {trim(txt('corretora'))} NOT IN ('', 'Nan', 'nan') THEN 1 ELSE 0 END"
           f" + CASE WHEN length({txt('endereco_completo')}) > 20 THEN 1 ELSE 0 END"
           f" + CASE WHEN coalesce(dias_publicado, 0) > 0 THEN 1 ELSE 0 END")
    tl = "lower(coalesce(CAST(tipo_imovel AS VARCHAR), 'nan'))"
    st = "lower(coalesce(CAST(status_construcao AS VARCHAR), 'nan'))"
    return f""",
sp_street AS (SELECT bairro, rua, count(url) AS qtd_na_rua FROM {src} GROUP BY bairro, rua),
sp_bairro AS (SELECT bairro, avg(qtd_na_rua) AS media_ofertas_por_rua_no_bairro FROM sp_street GROUP BY bairro),
sup AS (SELECT s.*, ps.qtd_na_rua, pb.media_ofertas_por_rua_no_bairro,
          CASE WHEN coalesce(ps.qtd_na_rua, 0) < 3 THEN 'Normal'
               WHEN coalesce(ps.qtd_na_rua, 0) > coalesce(pb.media_ofertas_por_rua_no_bairro, 1) * 3 THEN 'ALERTA: Fuga Possível (Oferta Muito Alta)'
               WHEN coalesce(ps.qtd_na_rua, 0) > coalesce(pb.media_ofertas_por_rua_no_bairro, 1) * 1.5 THEN 'Oferta Elevada'
               ELSE 'Normal/Baixa' END AS alerta_oferta_rua
        FROM {src} s LEFT JOIN sp_street ps ON s.bairro = ps.bairro AND s.rua = ps.rua LEFT JOIN sp_bairro pb ON s.bairro = pb.bairro),
edges AS (SELECT quantile_cont(valor, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS ev, quantile_cont(area_m2, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS ea FROM sup),
seg AS (SELECT sup.*, {qlab('valor', 'edges.ev', seg)} AS segmento_mercado, {qlab('area_m2', 'edges.ea', size)} AS perfil_tamanho
        FROM sup, edges),
dom AS (SELECT *, coalesce(datediff('day', anuncio_criado, DATE '{lv.AS_OF}'), 0) AS dias_no_mercado FROM seg),
dom2 AS (SELECT *, CASE WHEN dias_no_mercado <= 7 THEN 'Recém Chegado (Hype)' WHEN dias_no_mercado <= 30 THEN 'Recente (1 Mês)'
                        WHEN dias_no_mercado <= 90 THEN 'Normal (3 Meses)' WHEN dias_no_mercado <= 180 THEN 'Encalhado (6 Meses)'
                        ELSE 'Zombie (> 6 Meses - Barganha Extrema)' END AS status_temporal FROM dom),
tags AS (SELECT *,
  {tag_cols} FROM dom2),
urg AS (SELECT *, CAST(regexp_matches(lower(coalesce(descricao, '')), {q(urg)}) AS INTEGER) AS gatilho_urgencia FROM tags),
urg2 AS (SELECT *, CAST(gatilho_urgencia = 1 AND coalesce(dias_no_mercado, 0) > 90 AS INTEGER) AS alerta_oportunidade_ouro FROM urg),
comf AS (SELECT *, CAST(least(CAST(coalesce(vagas, 0) > 0 AS INTEGER) * 15 + {comfort}
           + CAST(coalesce(dist_transporte_km, 99) < 0.7 AS INTEGER) * 10 + CAST(coalesce(dist_mercado_km, 99) < 0.4 AS INTEGER) * 5, 100) AS INTEGER) AS score_conforto FROM urg2),
zdim AS (SELECT * FROM (VALUES {zone_rows}) AS z(zb, zn, zona, prio)),
zb AS (SELECT DISTINCT bairro, {bj} AS b FROM comf),
zb2 AS (SELECT bairro, b, lower({accents('b')}) AS nb FROM zb),
zres AS (SELECT bairro, coalesce(
            (SELECT arg_min(zona, prio) FROM zdim WHERE zb = zb2.b),
            (SELECT arg_min(zona, prio) FROM zdim WHERE zn = zb2.nb),
            CASE WHEN length(nb) >= 3 THEN (SELECT arg_min(zona, prio) FROM zdim WHERE contains(zn, zb2.nb) OR contains(zb2.nb, zn)) END,
            {q(dims.ZONE_UNKNOWN)}) AS zona FROM zb2),
pz AS (SELECT c.*, z.zona,
          CASE WHEN coalesce(valor, 0) <= 300000 THEN 'Até R$300k' WHEN coalesce(valor, 0) <= 500000 THEN 'R$300k-500k'
               WHEN coalesce(valor, 0) <= 1000000 THEN 'R$500k-1M' WHEN coalesce(valor, 0) <= 2000000 THEN 'R$1M-2M' ELSE 'Acima R$2M' END AS faixa_preco,
          CASE WHEN contains({tl}, 'cobertura') THEN 'Cobertura' WHEN coalesce(andar, 0) = 0 THEN 'Térreo / N.I.'
               WHEN andar <= 3 THEN 'Baixo (1-3)' WHEN andar <= 8 THEN 'Médio (4-8)' ELSE 'Alto (9+)' END AS andar_classificacao,
          CASE WHEN contains({st}, 'planta') THEN 'Lançamento (Na Planta)' WHEN regexp_matches({st}, 'construção|construcao') THEN 'Em Construção'
               WHEN contains({st}, 'pronto') AND coalesce(dias_publicado, 0) < 365 THEN 'Novo / Semi-novo' ELSE 'Usado' END AS idade_estimada,
          CAST(least(greatest({adq}, 0), 10) AS INTEGER) AS score_qualidade_anuncio
       FROM comf c LEFT JOIN zres z ON c.bairro IS NOT DISTINCT FROM z.bairro),
mm AS (SELECT {mm} FROM pz),
pf AS (SELECT t.*, {clip(fam)} AS perfil_familia, {clip(inv)} AS perfil_investidor, {clip(first)} AS perfil_primeiro_imovel
       FROM pz t, mm m),
prof AS (SELECT *, {lbl('perfil_familia', 'Família')} AS perfil_familia_label, {lbl('perfil_investidor', 'Investidor')} AS perfil_investidor_label,
                {lbl('perfil_primeiro_imovel', 'Primeiro Imóvel')} AS perfil_primeiro_imovel_label FROM pf)"""


def with_gold(body: str) -> str:
    return "WITH " + silver_ctes() + reference_ctes() + geo_ctes("priced") + finance_ctes("geo") + tail_ctes("fin") + "\n" + body


def _gold_sql(*cols: str) -> str:
    return with_gold(f"SELECT id_imovel, {', '.join(cols)} FROM prof")


_GEO = [c for _, d, n in dims.GEO_COLUMNS for c in (d, n)] + ["dist_transporte_km", "transporte_prox"]
_MCMV = ["mcmv_faixa", "mcmv_elegivel", "mcmv_teto", "mcmv_subsidio", "mcmv_entrada", "mcmv_financiado",
         "mcmv_juros_aa", "mcmv_sac_1a", "mcmv_sac_ult", "mcmv_sac_juros_total", "mcmv_price_parcela",
         "mcmv_price_juros_total", "mcmv_renda_min_sac", "mcmv_renda_min_price", "mcmv_economia", "mcmv_faixa_label"]
_MERC = ["merc_entrada", "merc_financiado", "merc_juros_aa", "merc_sac_1a", "merc_sac_ult", "merc_sac_juros_total",
         "merc_price_parcela", "merc_price_juros_total", "merc_renda_min_sac", "merc_renda_min_price", "merc_modalidade"]
_CASH = ["itbi_estimado", "cartorio_estimado", "custo_aquisicao_total", "custo_fixo_mensal", "aluguel_estimado",
         "fluxo_caixa_mensal", "yield_bruto_anual", "anos_payback", "payback_classificacao"]
_PROFILE = ["perfil_familia", "perfil_investidor", "perfil_primeiro_imovel", "perfil_familia_label",
            "perfil_investidor_label", "perfil_primeiro_imovel_label"]

register("nearest_poi", _gold_sql(*_GEO))
register("geo_scores", _gold_sql("score_mobilidade", "score_seguranca", "score_lifestyle", "vocacao_airbnb"))
register("finance_scenarios", _gold_sql(*_MCMV, *_MERC))
register("cash_flow_payback", _gold_sql(*_CASH))
register("investment_score", _gold_sql("diferenca_percentual", "dist_transporte_km", "score_investimento"))
register("finance_summary", _gold_sql("resumo_financeiro"))
register("quintile_segments", _gold_sql("valor", "area_m2", "segmento_mercado", "perfil_tamanho"))
register("days_on_market", _gold_sql("anuncio_criado", "CAST(dias_no_mercado AS INTEGER) AS dias_no_mercado", "status_temporal"))
register("text_tags", _gold_sql(*[n for n, _ in dims.TAGS]))
register("urgency_gold", _gold_sql("gatilho_urgencia", "alerta_oportunidade_ouro"))
register("comfort_index", _gold_sql("score_conforto"))
register("zone_lookup", _gold_sql("bairro", "zona"))
register("bands_floor_age", _gold_sql("faixa_preco", "andar_classificacao", "idade_estimada"))
register("ad_quality", _gold_sql("score_qualidade_anuncio"))
register("audience_profiles", _gold_sql(*_PROFILE))


def deed_ctes() -> str:
    return f""",
draw AS ({lv.deed_view_sql()}),
deeds AS (SELECT {std('bairro')} AS bairro, coalesce(ano_transacao, 0) AS ano_transacao,
                 coalesce(media_valor_transacao, 0) AS media_valor_transacao, coalesce(media_area_terreno, 0) AS media_area_terreno,
                 CAST(coalesce(total_transacoes, 0) AS DOUBLE) AS total_transacoes FROM draw),
dv AS (SELECT *, media_valor_transacao / media_area_terreno AS pm2 FROM deeds
       WHERE media_valor_transacao > 10000 AND media_area_terreno > 0),
dmx AS (SELECT max(ano_transacao) AS m FROM dv),
dstats AS (SELECT bairro, {rnd('avg(CAST(media_valor_transacao AS DECIMAL(38,4)))', 2)} AS escritura_valor_medio,
                  {rnd('median(media_valor_transacao)', 2)} AS escritura_valor_mediano,
                  {rnd('coalesce(avg(CASE WHEN pm2 > 0 THEN pm2 END), 0.0)', 2)} AS escritura_preco_m2_medio,
                  count(total_transacoes) AS escritura_total_transacoes,
                  max(ano_transacao) AS escritura_ano_mais_recente, min(ano_transacao) AS escritura_ano_mais_antigo,
                  {rnd('(avg(CASE WHEN ano_transacao >= m - 3 THEN media_valor_transacao END) - avg(CASE WHEN ano_transacao < m - 3 THEN media_valor_transacao END)) / avg(CASE WHEN ano_transacao < m - 3 THEN media_valor_transacao END) * 100', 1)} AS escritura_valorizacao_pct
           FROM dv, dmx GROUP BY bairro)"""


_DEED = ["escritura_valor_medio", "escritura_valor_mediano", "escritura_preco_m2_medio", "escritura_total_transacoes",
         "escritura_ano_mais_recente", "escritura_ano_mais_antigo", "escritura_valorizacao_pct"]

register("deed_trend", "WITH " + deed_ctes()[2:] + f"\nSELECT bairro, {', '.join(_DEED)} FROM dstats")
register("deed_stats", with_silver(deed_ctes() + f"""
SELECT s.id_imovel, s.bairro, s.valor, {', '.join('d.' + c for c in _DEED)},
       CASE WHEN coalesce(d.escritura_valor_medio, 0) > 0
            THEN {rnd('(s.valor - d.escritura_valor_medio) / d.escritura_valor_medio * 100', 1)} ELSE 0.0 END AS delta_escritura_pct
FROM silver s LEFT JOIN dstats d ON s.bairro = d.bairro"""))


# ----------------------------------------------------------------------------- BI, data quality, statistics

def bi_ctes() -> str:
    return """,
bi AS (SELECT * EXCLUDE (valor, condominio, iptu, anuncio_criado),
              coalesce(valor, 0) AS "valor_R$", coalesce(condominio, 0) AS "condominio_R$", coalesce(iptu, 0) AS "iptu_R$",
              strftime(anuncio_criado, '%Y-%m-%d') AS anuncio_criado,
              CASE WHEN latitude <> 0 AND longitude <> 0 THEN CAST(latitude AS VARCHAR) || ',' || CAST(longitude AS VARCHAR)
                   ELSE 'Url encontrada sem coordenadas' END AS coordenadas,
              greatest(coalesce(tem_vista_pro_mar, 0), coalesce(tag_vista_mar, 0), 0) AS final_tem_vista_mar,
              greatest(coalesce(tem_varanda, 0), coalesce(tem_varanda_gourmet, 0), 0) AS final_tem_varanda,
              greatest(coalesce(tem_piscina, 0), coalesce(tem_churrasqueira, 0), coalesce(tem_academia, 0), 0) AS final_tem_lazer
       FROM prof)"""


def with_bi(body: str) -> str:
    return with_gold(bi_ctes() + "\n" + body)


def _qc(c: str) -> str:
    return '"' + c + '"'


def rules_cte() -> str:
    aggs = ["count(*) AS n"]
    rows = []
    for i, (field, _desc, kind, mn) in enumerate(dims.FIELD_RULES):
        c = _qc(field)
        num = f"coalesce(TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE), 0.0)"
        text = f"coalesce(CAST({c} AS VARCHAR), 'nan')"
        if kind in ("num", "bool", "var"):
            pos = f"count_if({num} > 0)"
        elif kind == "txt":
            pos = f"count_if(NOT ({in_list(f'trim({text})', dims.INVALID_TEXT)}) AND length(trim({text})) > 0)"
        elif kind == "lng":
            pos = f"count_if(length({text}) > 50)"
        else:
            pos = (f"count_if(contains({text}, ',') AND NOT contains({text}, '0.0,0.0') AND NOT contains({text}, 'Url') "
                   f"AND NOT contains({text}, 'Nao'))")
        aggs += [f"CAST({pos} AS BIGINT) AS p{i}", f"min({num}) < max({num}) AS v{i}"]
        rows.append(f"SELECT {i} AS ord, {q(field)} AS campo, {q(kind)} AS tipo, {mn} AS min_pct, p{i} AS pos, v{i} AS varies, n FROM ragg")
    return f""",
ragg AS (SELECT {', '.join(aggs)} FROM bi),
rlong AS ({' UNION ALL '.join(rows)}),
rpct AS (SELECT *, CASE WHEN n > 0 THEN {rnd('pos / n * 100', 1)} ELSE 0.0 END AS pct FROM rlong),
rules AS (SELECT ord, campo, tipo, min_pct, pos, pct,
            CASE WHEN tipo = 'bool' THEN CASE WHEN pos > 0 AND pos < n THEN '✅' ELSE '⚠️' END
                 WHEN tipo = 'var' THEN CASE WHEN varies THEN '✅' ELSE '❌' END
                 WHEN pct >= min_pct THEN '✅' WHEN pct >= min_pct * 0.5 THEN '⚠️' ELSE '❌' END AS status FROM rpct)"""


_BI_FLAGS = ["final_tem_vista_mar", "final_tem_varanda", "final_tem_lazer", "gatilho_urgencia",
             "alerta_oportunidade_ouro", "bool_vaga", "tag_vista_mar", "tem_piscina"]
_CONST = ["valor_R$", "area_m2", "condominio_R$", "iptu_R$", "preco_m2", "custo_fixo_mensal", "yield_bruto_anual",
          "score_conforto", "score_investimento", "anos_payback", "mcmv_faixa", "score_mobilidade",
          "score_seguranca", "score_lifestyle", "dias_no_mercado"]

register("bi_shape", with_bi(f'SELECT id_imovel, anuncio_criado, "valor_R$", coordenadas, {", ".join(_BI_FLAGS)} FROM bi'))
register("field_rules", with_bi(rules_cte() + "\nSELECT * FROM rules"))
register("health_verdict", with_bi(rules_cte() + """
SELECT count_if(status = '✅') AS ok, count_if(status = '⚠️') AS avisos, count_if(status = '❌') AS problemas,
       count(*) AS total,
       CASE WHEN count_if(status = '❌') > 0 THEN '❌ REPROVADO — ' || count_if(status = '✅') || '/' || count(*) || ' campos OK'
            WHEN count_if(status = '⚠️') > 0 THEN '⚠️ APROVADO COM RESSALVAS — ' || count_if(status = '✅') || '/' || count(*) || ' campos OK'
            ELSE '✅ APROVADO — ' || count_if(status = '✅') || '/' || count(*) || ' campos OK' END AS veredito
FROM rules"""))
register("constant_columns", with_bi(", cagg AS (SELECT " + ", ".join(
    f"min(CAST({_qc(c)} AS DOUBLE)) AS mn{i}, max(CAST({_qc(c)} AS DOUBLE)) AS mx{i}" for i, c in enumerate(_CONST))
    + " FROM bi)\n" + " UNION ALL ".join(
    f"SELECT {q(c)} AS coluna, mn{i} AS minimo, mx{i} AS maximo, CAST(coalesce(mn{i} = mx{i}, true) AS INTEGER) AS constante FROM cagg"
    for i, c in enumerate(_CONST))))
register("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
register("top_values", """SELECT CAST(row_number() OVER (ORDER BY n DESC, event_type) AS INTEGER) AS rank, event_type, n FROM (
  SELECT event_type, count(*) AS n FROM events GROUP BY event_type) ORDER BY rank LIMIT 3""")
register("distribution_report", with_gold("""
, dist AS (SELECT 'origem_geo' AS campo, coalesce(origem_geo, 'nan') AS valor FROM prof
           UNION ALL SELECT 'tipo_imovel', coalesce(tipo_imovel, 'nan') FROM prof
           UNION ALL SELECT 'status_construcao', coalesce(status_construcao, 'nan') FROM prof)
SELECT campo, valor, count(*) AS n FROM dist GROUP BY campo, valor"""))


def _means_sql(by: str) -> str:
    return (f"SELECT {q(by)} AS dimensao, CAST({by} AS VARCHAR) AS grupo, count(*) AS n, {rnd('avg(valor)', 2)} AS media, "
            f"{rnd('stddev_samp(valor)', 2)} AS desvio, {rnd('sum(valor) / sum(area_m2)', 4)} AS valor_m2 FROM silver GROUP BY {by}")


register("group_means", with_silver("\n" + " UNION ALL ".join(_means_sql(b) for b in ("quartos", "vagas", "bairro"))))

_SUMMARY = ["valor", "area_m2", "condominio", "iptu", "preco_m2"]
register("summary_quantiles", with_silver(", sagg AS (SELECT " + ", ".join(
    f"count({c}) AS n{i}, count_if({c} IS NULL) AS z{i}, avg({c}) AS a{i}, stddev_samp({c}) AS s{i}, min({c}) AS lo{i}, "
    f"max({c}) AS hi{i}, quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.5, 0.75, 0.9]) AS q{i}" for i, c in enumerate(_SUMMARY))
    + " FROM silver)\n" + " UNION ALL ".join(
    f"SELECT {q(c)} AS coluna, n{i} AS n, z{i} AS nulos, {rnd(f'a{i}', 4)} AS media, {rnd(f's{i}', 4)} AS desvio, "
    f"{rnd(f'lo{i}', 4)} AS minimo, {rnd(f'q{i}[1]', 4)} AS q25, {rnd(f'q{i}[2]', 4)} AS mediana, {rnd(f'q{i}[3]', 4)} AS q75, "
    f"{rnd(f'q{i}[4]', 4)} AS p90, {rnd(f'hi{i}', 4)} AS maximo, {rnd(f'q{i}[1] - 1.5 * (q{i}[3] - q{i}[1])', 4)} AS bigode_inf, "
    f"{rnd(f'q{i}[3] + 1.5 * (q{i}[3] - q{i}[1])', 4)} AS bigode_sup FROM sagg" for i, c in enumerate(_SUMMARY))))

_PAIRS = [("valor", "area_m2"), ("valor", "quartos"), ("preco_m2", "area_m2"), ("latitude", "longitude"), ("valor", "condominio")]
register("correlations", with_silver(", cagg AS (SELECT " + ", ".join(f"corr({a}, {b}) AS c{i}" for i, (a, b) in enumerate(_PAIRS))
    + " FROM silver)\n" + " UNION ALL ".join(
    f"SELECT {q(a)} AS x, {q(b)} AS y, {rnd(f'c{i}', 6)} AS r, {rnd(f'pow(c{i}, 2)', 6)} AS r2 FROM cagg"
    for i, (a, b) in enumerate(_PAIRS))))
register("target_histogram", with_silver("""
, hx AS (SELECT CAST(valor AS DOUBLE) AS x FROM silver WHERE valor IS NOT NULL),
hm AS (SELECT min(x) AS lo, max(x) AS hi FROM hx)
SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((x - lo) / (hi - lo) * 50) + 1, 50) END AS INTEGER) AS bin,
       count(*) AS n, min(x) AS x_min, max(x) AS x_max
FROM hx, hm GROUP BY 1"""))
_NORM = "sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), lambda a, b: a + b))"
register("cluster_profile", f"""
SELECT label AS cluster_id, count(*) AS n, {rnd('avg(CAST(embedding[1] AS DOUBLE))', 4)} AS media_x0,
       {rnd(f'avg({_NORM})', 4)} AS media_norma FROM embeddings GROUP BY label""")
register("top_anomalies", f"""
SELECT row_number() OVER (ORDER BY score DESC, vec_id) AS rank, vec_id, label, {rnd('score', 4)} AS score FROM (
  SELECT vec_id, label, {_NORM} AS score FROM embeddings ORDER BY score DESC, vec_id LIMIT 50)""")
register("opportunity_rank", with_gold("""
SELECT row_number() OVER (ORDER BY diferenca_percentual, id_imovel) AS rank, id_imovel, bairro, zona, valor,
       diferenca_percentual AS delta_pct,
       CASE WHEN diferenca_percentual < -40 THEN '🔥🔥🔥 EXCEPCIONAL' WHEN diferenca_percentual < -25 THEN '🔥🔥 FORTE'
            ELSE '🔥 MODERADA' END AS nivel
FROM prof WHERE diferenca_percentual < -15"""))
register("opportunities_by_type", with_gold("SELECT tipo_imovel, count(*) AS n FROM prof WHERE diferenca_percentual < -15 GROUP BY tipo_imovel"))
register("opportunities_by_zone", with_gold("SELECT zona, count(*) AS n FROM prof WHERE diferenca_percentual < -15 GROUP BY zona"))


# ----------------------------------------------------------------------------- text extraction

def _dec(x: str) -> str:
    """Brazilian money text -> double."""
    wp = f"regexp_extract({x}, 'R\\$[\\s\\x{{00A0}}]*([0-9.,]+)', 1)"
    pl = f"regexp_extract({x}, '([0-9]+(?:\\.[0-9]{{3}})*(?:,[0-9]{{1,2}})?)', 1)"
    conv = lambda s: f"TRY_CAST(replace(replace({s}, '.', ''), ',', '.') AS DOUBLE)"
    first = f"CASE WHEN {wp} <> '' THEN {conv(wp)} END"
    fb = f"CASE WHEN {pl} <> '' AND {conv(pl)} > 0 THEN {conv(pl)} END"
    return f"coalesce({first}, {fb}, 0.0)"


def _num(x: str) -> str:
    d = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return f"coalesce(CASE WHEN length({d}) > 0 THEN TRY_CAST({d} AS BIGINT) END, 0)"


def _ptdate(x: str) -> str:
    pat = "(?i)([0-9]{1,2})\\s+de\\s+([A-Za-zç]+)\\s+de\\s+([0-9]{4})"
    m = f"regexp_extract({x}, '{pat}', 2)"
    month = "CASE lower(" + m + ") " + " ".join(f"WHEN {q(n)} THEN {k}" for n, k in dims.MONTHS_PT) + " END"
    d = f"regexp_extract({x}, '{pat}', 1)"
    y = f"regexp_extract({x}, '{pat}', 3)"
    return (f"CASE WHEN {d} <> '' AND ({month}) IS NOT NULL THEN printf('%04d-%02d-%02d', CAST({y} AS INTEGER), "
            f"{month}, CAST({d} AS INTEGER)) ELSE {x} END")


def _reldays(x: str, kind: str) -> str:
    pat = (kind + "\\s+h[aá]\\s+([0-9]+)\\s+(dia|dias|semana|semanas|m[eê]s|meses|ano|anos|hora|horas|minuto|minutos)")
    low = f"lower({x})"
    n = f"regexp_extract({low}, '{pat}', 1)"
    u = f"regexp_extract({low}, '{pat}', 2)"
    mult = (f"CASE WHEN contains({u}, 'hora') OR contains({u}, 'minuto') THEN 0 WHEN contains({u}, 'dia') THEN 1 "
            f"WHEN contains({u}, 'semana') THEN 7 WHEN regexp_matches({u}, 'm[eê]s|meses') THEN 30 "
            f"WHEN contains({u}, 'ano') THEN 365 ELSE 0 END")
    return f"coalesce(CASE WHEN {n} <> '' THEN TRY_CAST({n} AS INTEGER) * {mult} END, 0)"


def _stype(w: str) -> str:
    return "CASE upper(" + w + ") " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in dims.STREET_TYPES.items()) + " END"


def _norm_street(x: str) -> str:
    raw = f"trim(coalesce({x}, ''))"
    after = f"upper(trim(regexp_extract({raw}, '^.*,(.*)$', 1)))"
    tail = f"CASE WHEN contains({raw}, ',') AND ({_stype(after)}) IS NOT NULL THEN {after} END"
    first = f"trim(regexp_replace(trim(split_part({raw}, '/', 1)), ',+$', ''))"
    slashed = f"CASE WHEN ({tail}) IS NOT NULL AND NOT contains({first}, ',') THEN {first} || ', ' || ({tail}) ELSE {first} END"
    s0 = f"CASE WHEN contains({raw}, '/') THEN {slashed} ELSE {raw} END"
    return s0


def text_ctes() -> str:
    tv = lv.text_view_sql()
    cond = "regexp_extract(custos_texto, '(?i)Cond\\.[\\s\\x{00A0}]*(R\\$[\\s\\x{00A0}]*[0-9.,]+)', 1)"
    iptu = "regexp_extract(custos_texto, '(?i)IPTU[\\s\\x{00A0}]*(R\\$[\\s\\x{00A0}]*[0-9.,]+)', 1)"
    rpat = "([0-9]+(?:\\.[0-9]+)?)/[0-9]+\\s*\\(([0-9]+)"
    part = trim("replace(split_part(data_texto, ',', 1), 'Anúncio criado em', '')")
    loc = "coalesce(loc_texto, '')"
    rest = f"regexp_extract({loc}, '^.*? em (.*)$', 1)"
    mu = "replace(replace(coalesce(mapa_url, ''), '%2C', ','), '%2c', ',')"
    mpat = "[?&]q=(-?[0-9]{1,3}\\.[0-9]+),(-?[0-9]{1,3}\\.[0-9]+)"
    fx = trim("coalesce(faixa_texto, '')")
    e = "coalesce(endereco_completo, '')"
    rest8 = f"regexp_extract({e}, '^(.*) - (.*)$', 1)"
    bc = f"trim(regexp_extract({rest8}, '^(.*) - (.*)$', 2))"
    rua8 = f"trim(split_part(trim(regexp_extract({rest8}, '^(.*) - (.*)$', 1)), ',', 1))"
    ok8 = f"(contains({e}, ' - ') AND contains({rest8}, ' - '))"
    return f"""
tv AS ({tv}),
t1 AS (SELECT *, {_norm_street('endereco_prefeitura')} AS _s0 FROM tv),
t2 AS (SELECT *, trim(regexp_replace(_s0, '(?i),?\\s*ENTRE\\s+.*$', '')) AS _s FROM t1),
t3 AS (SELECT *, regexp_split_to_array(_s, '\\s+') AS _w FROM t2),
parsed AS (SELECT url,
  {_dec('preco_texto')} AS valor_txt, {_num("faixa_texto")} AS digitos,
  CASE WHEN {cond} <> '' THEN {_dec(cond)} ELSE 0.0 END AS cond_txt,
  CASE WHEN {iptu} <> '' THEN {_dec(iptu)} ELSE 0.0 END AS iptu_txt,
  CASE WHEN regexp_extract(rating_texto, '{rpat}', 1) <> '' THEN TRY_CAST(regexp_extract(rating_texto, '{rpat}', 1) AS DOUBLE) ELSE 0.0 END AS nota_txt,
  CASE WHEN regexp_extract(rating_texto, '{rpat}', 2) <> '' THEN TRY_CAST(regexp_extract(rating_texto, '{rpat}', 2) AS INTEGER) ELSE 0 END AS avaliacoes_txt,
  CASE WHEN coalesce(data_texto, '') <> '' THEN {_ptdate(part)} ELSE '{lv.AS_OF}' END AS criado_txt,
  {_reldays('publicacao_texto', 'publicado')} AS dias_pub_txt, {_reldays('publicacao_texto', 'atualizado')} AS dias_atu_txt,
  CASE WHEN contains({loc}, ' em ') THEN split_part({loc}, ' em ', 1) ELSE 'Indefinido' END AS tipo_card,
  CASE WHEN contains({loc}, ' em ') THEN trim(split_part({rest}, ',', 1)) ELSE {loc} END AS bairro_card,
  CASE WHEN contains({loc}, ' em ') THEN trim(CASE WHEN contains({rest}, ',') THEN regexp_extract({rest}, '^[^,]*,(.*)$', 1) ELSE '' END)
       ELSE 'Rio de Janeiro' END AS cidade_card,
  CASE WHEN regexp_extract({mu}, '{mpat}', 1) <> '' THEN TRY_CAST(regexp_extract({mu}, '{mpat}', 1) AS DOUBLE) ELSE 0.0 END AS lat_url,
  CASE WHEN regexp_extract({mu}, '{mpat}', 2) <> '' THEN TRY_CAST(regexp_extract({mu}, '{mpat}', 2) AS DOUBLE) ELSE 0.0 END AS lon_url,
  coalesce(TRY_CAST(string_split({fx}, '-')[1] AS INTEGER), 1) AS quartos_min,
  coalesce(TRY_CAST(string_split({fx}, '-')[2] AS INTEGER), TRY_CAST(string_split({fx}, '-')[1] AS INTEGER), 1) AS quartos_max,
  trim(regexp_extract({e}, '([^-]*)$', 1)) AS estado_g0, {_num(e)} AS numero_g0,
  CASE WHEN length(_s) > 0 AND ({_stype("regexp_replace(upper(_w[1]), ',+$', '')")}) IS NOT NULL
         THEN ({_stype("regexp_replace(upper(_w[1]), ',+$', '')")}) || ' ' || {title("array_to_string(_w[2:], ' ')")}
       WHEN contains(_s, ',') AND ({_stype("trim(regexp_extract(_s, '^(.*),(.*)$', 2))")}) IS NOT NULL
         THEN ({_stype("trim(regexp_extract(_s, '^(.*),(.*)$', 2))")}) || ' ' || {title("trim(regexp_extract(_s, '^(.*),(.*)$', 1))")}
       WHEN len(_w) >= 2 AND ({_stype("_w[-1]")}) IS NOT NULL
         THEN ({_stype("_w[-1]")}) || ' ' || {title("array_to_string(_w[1:len(_w) - 1], ' ')")}
       ELSE {title('_s')} END AS logradouro_norm,
  CASE WHEN contains({e}, ' - ') THEN trim(regexp_extract({e}, '^(.*) - (.*)$', 2)) ELSE 'RJ' END AS uf,
  CASE WHEN {ok8} THEN CASE WHEN contains({bc}, ', ') THEN trim(regexp_extract({bc}, '^(.*), (.*)$', 1)) ELSE {bc} END END AS bairro_end,
  CASE WHEN {ok8} THEN CASE WHEN contains({bc}, ', ') THEN trim(regexp_extract({bc}, '^(.*), (.*)$', 2)) ELSE 'Rio de Janeiro' END END AS cidade_end,
  CASE WHEN {ok8} AND length({rua8}) > 3 THEN {rua8} END AS rua_end
FROM t3)"""


_TEXT_GROUPS = {
    "money_numbers": ["valor_txt", "digitos", "nota_txt", "avaliacoes_txt"],
    "dates_relative": ["criado_txt", "dias_pub_txt", "dias_atu_txt"],
    "address_parse": ["tipo_card", "bairro_card", "cidade_card", "uf", "bairro_end", "cidade_end", "rua_end",
                      "estado_g0", "numero_g0"],
    "address_normalise": ["logradouro_norm"],
    "coords_cost_rating": ["lat_url", "lon_url", "cond_txt", "iptu_txt"],
    "range_split": ["quartos_min", "quartos_max"],
}
for _k, _cols in _TEXT_GROUPS.items():
    register(_k, "WITH " + text_ctes() + f"\nSELECT url, {', '.join(_cols)} FROM parsed")


# ----------------------------------------------------------------------------- earlier generations, catalogues

def _km1(c: str) -> str:
    return f"printf('%.1f', {rnd(c, 1)})"


register("top3_poi", with_gold(f""",
h3 AS (SELECT id_imovel, name, {rnd('dist', 2)} AS d, row_number() OVER (PARTITION BY id_imovel ORDER BY dist, ord) AS rk
       FROM cand WHERE category = 'saude_educacao'),
h3a AS (SELECT id_imovel, string_agg(name, '; ' ORDER BY rk) AS top3,
               string_agg(name || ' (' || {_km1('d')} || 'km)', ', ' ORDER BY rk) AS health FROM h3 WHERE rk <= 3 GROUP BY id_imovel)
SELECT p.id_imovel, coalesce(h.top3, '') AS top3, concat_ws(' | ',
   CASE WHEN contains(transporte_prox, 'BRT') OR contains(transporte_prox, 'Estação') THEN '🚌' ELSE '🚇' END || ' ' || transporte_prox || ' (' || {_km1('dist_transporte_km')} || 'km)',
   CASE WHEN dist_mercado_km < 2.0 THEN '🛒' ELSE '⚠️🛒' END || ' ' || mercado_prox || ' (' || {_km1('dist_mercado_km')} || 'km)',
   CASE WHEN dist_feira_km < 1.5 THEN '🍎 ' || feira_prox || ' (' || {_km1('dist_feira_km')} || 'km)' END,
   '🏖️ ' || praia_prox || ' (' || {_km1('dist_praia_km')} || 'km)',
   CASE WHEN dist_shopping_km < 4.0 THEN '🛍️ ' || shopping_prox || ' (' || {_km1('dist_shopping_km')} || 'km)' END,
   '🏥/🎓 ' || coalesce(h.health, '')) AS itens_proximos
FROM prof p LEFT JOIN h3a h ON p.id_imovel = h.id_imovel"""))


def _legacy_sql() -> str:
    from quadra.operators import nlp as _n
    d = "dist_transporte_km"
    jm = (1 + 0.105) ** (1 / 12) - 1
    fin = "(coalesce(valor, 0) * 0.8)"
    s1 = f"CASE WHEN {fin} > 0 THEN {rnd(f'{fin} / 420 + {fin} * {D(jm)}', 2)} ELSE 0.0 END"
    walk = ("(CAST(dist_transporte_km < 1.5 AS INTEGER) + CAST(dist_mercado_km < 1.5 AS INTEGER) + CAST(dist_feira_km < 1.5 AS INTEGER)"
            " + CAST(dist_lazer_km < 1.5 AS INTEGER) + CAST(dist_praia_km < 1.5 AS INTEGER) + CAST(dist_shopping_km < 1.5 AS INTEGER))")
    sul = " OR ".join(f"contains(coalesce(bairro, 'nan'), {q(b)})" for b in ["Copacabana", "Ipanema", "Leblon", "Botafogo", "Flamengo"])
    diff = "coalesce(diferenca_percentual, 0.0)"
    fixed = "coalesce(custo_fixo_mensal, 0.0)"
    tags = ", ".join(f"CAST(regexp_matches(lower(coalesce(descricao, 'nan')), {q(p)}) AS INTEGER) AS {n}" for n, p in _n.V1_TAGS)
    return f"""
SELECT id_imovel,
  CAST(CASE WHEN {d} < 0.6 THEN 10.0 WHEN {d} < 1.5 THEN 8.0 ELSE greatest(0.0, 10 - {d} * 2) END AS DOUBLE) AS score_mobilidade_v1,
  CAST(least(greatest(5.0 - CASE WHEN dist_risco_km < 0.5 THEN 4.0 WHEN dist_risco_km < 1.0 THEN 2.0 ELSE 0.0 END
        + CASE WHEN dist_policia_km < 0.8 THEN 2.5 WHEN dist_policia_km < 2.0 THEN 1.0 ELSE 0.0 END, 0.0), 10.0) AS DOUBLE) AS score_seguranca_v1,
  CASE WHEN {walk} >= 4 THEN 'Excelente (Tudo a pé)' WHEN {walk} >= 2 THEN 'Média' ELSE 'Baixa' END AS walkability,
  CASE WHEN ({sul}) AND (dist_praia_km < 0.8 OR {d} < 0.5) THEN 'Altíssima' ELSE 'Baixa' END AS vocacao_airbnb_v1,
  'https://www.google.com/maps/search/?api=1&query=' || CAST(latitude AS VARCHAR) || ',' || CAST(longitude AS VARCHAR) AS link_maps,
  {rnd('coalesce(valor, 0) * 0.2', 2)} AS entrada_minima, {rnd(fin, 2)} AS valor_financiado,
  {s1} AS primeira_parcela_estimada, {rnd(f'({s1}) / 0.3', 2)} AS renda_minima_familiar,
  CAST(least(greatest(5.0 + CASE WHEN {diff} < -15 THEN 2.0 WHEN {diff} > 15 THEN -2.0 ELSE 0.0 END
        + CASE WHEN {d} < 0.8 THEN 1.0 ELSE 0.0 END + CASE WHEN {fixed} < 1000 THEN 1.0 WHEN {fixed} > 2500 THEN -1.0 ELSE 0.0 END,
        0.0), 10.0) AS DOUBLE) AS score_investimento_v1,
  CAST(CASE WHEN valor <= 350000 THEN 0.0785 ELSE 0.105 END AS DOUBLE) AS juros_param,
  {tags}
FROM prof"""


def _types_sql() -> str:
    from quadra.operators import nlp as _n
    low = "lower(coalesce(descricao, ''))"
    words = ", ".join(f"CAST(regexp_matches({low}, {q(p)}) AS INTEGER) AS w_{n}" for n, p in _n.LEGACY_WORDS)
    code = "CASE " + " ".join(f"WHEN regexp_matches({low}, {q(p)}) THEN {c}" for c, p in _n.LEGACY_TYPES) + " ELSE 9 END"
    cls = ("CASE WHEN score_conforto >= 80 THEN '💎 Super Conforto (Premium)' WHEN score_conforto >= 60 THEN '🥇 Muito Confortável' "
           "WHEN score_conforto >= 40 THEN '🥈 Padrão / Bom' WHEN score_conforto >= 20 THEN '🥉 Básico' "
           "ELSE '⚠️ Simples / Precisa Melhorias' END")
    return f"SELECT id_imovel, {words}, {code} AS tipo_codigo, {cls} AS classificacao_conforto FROM prof"


register("legacy_variants", with_gold(_legacy_sql()))
register("type_classifier", with_gold(_types_sql()))


# ----------------------------------------------------------------------------- streaming
register("stream_ingest", "SELECT event_id, user_id, event_type FROM events")
register("stream_dedup", "SELECT DISTINCT event_id, user_id, event_type FROM events")
register("stream_counters", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")


# ----------------------------------------------------------------------------- sources and sinks
register("cv_folds", with_silver(f"""
SELECT CAST(CAST('0x' || substr(md5(id_imovel), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold, count(*) AS n, {rnd('avg(valor)', 2)} AS valor_medio
FROM silver WHERE valor > 0 GROUP BY 1
"""))
register("union_part_rows", f"""SELECT url, valor, area_m2, quartos, vagas, banheiros, suites, andar, nullif(tipo_imovel, '') AS tipo_imovel, status_construcao,
       bairro, cidade, rua, numero, condominio, iptu, destaque, descricao, nota_media, total_avaliacoes, dias_publicado,
       dias_atualizado, latitude, longitude, origem_geo FROM ({lv.listing_view_sql()})""")
register("union_parts", f"SELECT DISTINCT url FROM ({lv.listing_view_sql()})")
register("csv_round_trip", with_silver('\nSELECT id_imovel, coalesce(valor, 0) AS valor, preco_m2, bairro FROM silver'))
_WSX = "[\\s\\x{00A0}]"
register("html_fields", "SELECT page_id, url, "
         + f"regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1), '{_WSX}+', ' ', 'g'), '^{_WSX}+|{_WSX}+$', '', 'g'), '^{_WSX}+|{_WSX}+$', '', 'g') AS titulo, "
         + f"regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '{_WSX}+', ' ', 'g'), '^{_WSX}+|{_WSX}+$', '', 'g'), '^{_WSX}+|{_WSX}+$', '', 'g') AS h1, "
         + "len(string_split(html, '<a ')) - 1 AS n_links, CAST(contains(html, 'class=\"ad\"') AS INTEGER) AS tem_anuncio, "
         + ", ".join(f"CAST(contains(html, {q(chr(39).join(['itemprop=', code, '']))}) AS INTEGER) AS {n}"
                     for n, code in dims.UNIT_AMENITIES + dims.CONDO_AMENITIES)
         + " FROM pages")


_SCREEN = ["area_m2", "quartos", "vagas", "banheiros", "condominio", "iptu", "latitude", "longitude",
           "dist_praia_km", "dist_transporte_km", "dist_mercado_km", "dist_shopping_km", "score_mobilidade"]
_SP = [(a, b) for i, a in enumerate(_SCREEN) for b in _SCREEN[i + 1:]]
register("feature_screen", with_gold(", sagg AS (SELECT " + ", ".join(f"corr({a}, {b}) AS c{i}" for i, (a, b) in enumerate(_SP))
    + " FROM prof)\n" + " UNION ALL ".join(
    f"SELECT {q(a)} AS x, {q(b)} AS y, {rnd(f'c{i}', 6)} AS r, CASE WHEN abs(c{i}) > 0.95 THEN {q(b)} END AS descartar FROM sagg"
    for i, (a, b) in enumerate(_SP))))


def _mi_sql() -> str:
    cols = _SCREEN + ["valor"]
    mm = ", ".join(f"min(CAST({c} AS DOUBLE)) AS lo_{c}, max(CAST({c} AS DOUBLE)) AS hi_{c}" for c in cols)

    def b(c):
        return (f"CAST(CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE least(floor((CAST({c} AS DOUBLE) - lo_{c}) / (hi_{c} - lo_{c}) * 10) + 1, 10) END AS INTEGER)")
    unions = " UNION ALL ".join(f"SELECT {q(c)} AS feature, {b(c)} AS bx, {b('valor')} AS byy FROM prof, mi_mm WHERE valor IS NOT NULL"
                                for c in _SCREEN)
    return f""", mi_mm AS (SELECT {mm} FROM prof),
mi_cells AS (SELECT feature, bx, byy, count(*) AS n FROM ({unions}) GROUP BY feature, bx, byy),
mi_n AS (SELECT feature, sum(n) AS big_n FROM mi_cells GROUP BY feature),
mi_px AS (SELECT feature, bx, sum(n) AS nx FROM mi_cells GROUP BY feature, bx),
mi_py AS (SELECT feature, byy, sum(n) AS ny FROM mi_cells GROUP BY feature, byy)
SELECT c.feature, {rnd('sum(CAST(c.n AS DOUBLE) / nn.big_n * ln(CAST(c.n AS DOUBLE) * nn.big_n / (CAST(px.nx AS DOUBLE) * py.ny)))', 6)} AS mi
FROM mi_cells c JOIN mi_n nn ON c.feature = nn.feature JOIN mi_px px ON c.feature = px.feature AND c.bx = px.bx
     JOIN mi_py py ON c.feature = py.feature AND c.byy = py.byy GROUP BY c.feature"""


register("binned_mi", with_gold(_mi_sql()))
