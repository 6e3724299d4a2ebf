"""Places, pages and the collection run on small hand-made input."""
import math
import random

import pytest
from pyspark.sql import functions as F

from quadra import dims
from quadra.operators import dq, geo_cells, html, places
from quadra.streaming import collect


def test_places_go_from_fine_to_coarse(spark):
    rows = [
        ("a", "https://m/x?q=-22.9%2C-43.2&z=1", "Rua A, 1 - Centro, Rio", "Rua A", "Centro"),
        ("b", "https://m/x?z=1", "rua  á, 1 - CENTRO, Rio", "x", ""),                    # the same address, otherwise written
        ("c", "", "Rua A, 99 - Centro, Rio", "Rua A", "Centro"),                        # the street is known
        ("d", None, None, "Rua Não Informada", "centro"),                               # only the neighbourhood
        ("e", "https://m/x?q=0.0,0.0", "", "Rua Z", "Nowhere"),
        ("f", None, None, None, None),
        ("d", None, None, "Rua Não Informada", "centro"),                               # a repeated row stays
    ]
    df = spark.createDataFrame(rows, "url string, mapa_url string, endereco_completo string, rua string, bairro string").withColumn("latitude", F.lit(9.0))
    table = places.gazetteer(places.with_link(df))
    assert {(r.nivel, r.chave): (r.lat, r.lon, r.amostras) for r in table.collect()} == {
        ("Endereco", "rua a, 1 - centro, rio"): (-22.9, -43.2, 1), ("Rua", "rua a|centro"): (-22.9, -43.2, 1), ("Bairro", "centro"): (-22.9, -43.2, 1)}
    got = places.resolve(df, table).collect()
    assert len(got) == len(rows)
    by = {r.url: r for r in got}
    assert {u: r.origem_geo for u, r in by.items()} == {"a": "Site", "b": "Gazetteer (Endereco)", "c": "Gazetteer (Rua)", "d": "Gazetteer (Bairro)", "e": "Nao Encontrado", "f": "Nao Encontrado"}
    assert by["d"].coordenadas == "-22.9,-43.2" and by["e"].coordenadas == places.NO_COORDINATES and by["e"].latitude == 0
    assert places.resolve(df.limit(0), table).count() == 0 and places.resolve(df, table.limit(0)).where("origem_geo = 'Nao Encontrado'").count() == 6


CARD = '<li data-cy="rp-property-cd"><a href="{url}">x</a><h2 data-cy="rp-cardProperty-location-txt">Casa em  Lapa, Rio</h2>{price}</li>'


@pytest.mark.parametrize(("price", "want"), [
    ('<div data-cy="rp-cardProperty-price-txt"><p>7</p><div><p class="a text-2-25">R$ 1.000</p></div></div>', 1000),
    ('<div data-cy="rp-cardProperty-price-txt"><span><p>R$ 2.000</p></span><p class="text-1-75">Cond. R$ 10</p></div>', 2000),
    ("<div data-cy='rp-cardProperty-price-txt'><div>R$</div> 3.000</div>", 3000),
    ('<p data-cy="rp-cardProperty-price-txt">R$&nbsp;4.000</p>', 4000),
    ('<div class="x-price-y"><br><p>ignored: no first child</p></div><div class="price"></div>', 0),
    ('<div class="x-price-y"><p>R$ 5.000</p></div>', 5000),
    ("", 0),
])
def test_card_price_fallbacks(spark, price, want):
    page = "<ul><!-- " + CARD.format(url="no", price="") + " -->" + CARD.format(url="/u1?a=1&amp;b=2", price=price) + CARD.format(url="", price=price) + "</ul>"
    got = html.cards(spark.createDataFrame([(1, page), (2, None), (3, "<p>none</p>")], "page_id int, html string")).collect()
    assert [(r.page_id, r.url, r["valor_R$"], r.bairro, r.cidade, r.tipo) for r in got] == [(1, "/u1?a=1&b=2", want, "Lapa", "Rio", "Casa")]


def test_nested_elements_end_where_their_depth_does(spark):
    page = '<div id="panel-unitAmenities"><div><div><li itemprop="POOL"></li></div></div><li itemprop="BALCONY">v</li></div><li itemprop="BATHTUB"></li>'
    condo = '<div id="panel-sectionAmenities"><li itemprop="POOL"></li></div>'
    rows = [(1, page + condo), (2, page + '<b id="sectionAmenities"></b>' + condo), (3, ""), (4, None)]
    got = {r.k: r for r in html.details(spark.createDataFrame(rows, "k int, html string"), "2001-12-31").collect()}
    flags = {k: {n for n, _ in dims.UNIT_AMENITIES + dims.CONDO_AMENITIES if r[n]} for k, r in got.items()}
    assert flags == {1: {"tem_varanda"}, 2: {"tem_varanda", "tem_piscina"}, 3: set(), 4: set()}
    assert got[3].tipo_imovel == "Não informado" and got[3].status_construcao == "Pronto" and got[3].anuncio_criado == "2001-12-31" and got[3].uf == "RJ"


@pytest.mark.parametrize(("markup", "want"), [
    ('<h3 data-testid="price-info-value">R$ 10</h3>', 10), ('<b data-testid="price-info-value">R$ 20</b>', 20), ('<div data-testid="price-info"><p>x</p><h3>R$ 30</h3></div>', 30),
    ('<h3 class="a price-b">R$ 40</h3>', 40), ('<span class="price">R$ 50</span>', 50), ('<h3 data-testid="price-info-value">Sob consulta</h3><span class="price">R$ 60</span>', 60), ("", 0)])
def test_detail_price_fallbacks(spark, markup, want):
    df = spark.createDataFrame([(0, markup), (99, markup)], "`valor_R$` bigint, html string")
    assert sorted(r["valor_R$"] for r in html.details(df, "2001-12-31").collect()) == sorted([want, 99])


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    rows = [("u1", "10", "5", "Site"), ("", "10", "5", "Site"), ("u2", "x" * 200, "5", "Site"), ("u3", "10", None, None)]
    batch = spark.createDataFrame(rows, "url string, `valor_R$` string, area_m2 string, origem_geo string")
    sink = collect.batch_sink(str(tmp_path), F.lit("2001-12-31 12:00:00").cast("timestamp"))
    for number in (0, 1, 0, 1, 1):
        sink(batch, number)
    got = spark.read.parquet(f"{tmp_path}/rows").collect()
    assert len(got) == 8 and sorted({r.origem_geo for r in got}) == sorted(["Site", "ERRO: url ausente", ("ERRO: valor inválido: " + "x" * 200)[:86], "ERRO: area inválido: "])
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 6
    assert [tuple(r) for r in collect.table(spark, str(tmp_path), "counters", "").select("recebidos", "processados", "erros", "lote").orderBy("lote").collect()] == [(4, 1, 3, 0), (4, 1, 3, 1)]
    assert collect.table(spark, str(tmp_path / "none"), "rows", "url string").count() == 0
    assert str(collect.last_refresh(spark.read.parquet(f"{tmp_path}/rows")).first()[0]) == "2001-12-31 12:00:00"


def test_run_counters(spark, tmp_path):
    rows = [("x/id-1", "10", "5", "Site", 1), ("x/id-1", "10", "5", "Site", 2), ("x/id-2", "?", "5", "Site", 3), ("", "1", "1", "Site", 4), (None, "1", "1", "Site", 5)]
    feed = spark.createDataFrame(rows, "url string, `valor_R$` string, area_m2 string, origem_geo string, src_order int")
    assert collect.run(feed, str(tmp_path / "o")) == {"vistos": 5, "sem_url": 2, "enfileirados": 2, "duplicados": 1, "processados": 1, "erros": 1}


def _km(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    return 2 * 6371.0 * math.asin(math.sqrt(math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2))


@pytest.mark.parametrize("seed", range(2))
def test_nearest_by_cells_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    spot = lambda: rng.choice(((rng.gauss(-22.9, 0.05), rng.gauss(-43.3, 0.1)), (rng.uniform(-89, 89), rng.choice((-179.99, 179.99, rng.uniform(-180, 180)))), (89.9, rng.uniform(-180, 180))))
    points = [(c, i, f"p{i}", *spot()) for c, n in (("a", 150), ("b", 2)) for i in range(n)]
    seats = [(i, *spot()) for i in range(80)] + [(100, None, 1.0)]
    df = spark.createDataFrame(seats + seats[:5], "id int, lat double, lon double")
    got = geo_cells.nearest(df, spark.createDataFrame(points, "category string, ord int, name string, lat double, lon double"), 3).collect()
    assert len(got) == 160
    for r in got:
        want = sorted((_km((r.lat, r.lon), p[3:]), p[1]) for p in points if p[0] == r.category)[:3]
        assert [p.dist for p in r.near] == pytest.approx([d for d, _ in want], abs=1e-6)
    assert geo_cells.nearest(df.limit(0), spark.createDataFrame(points, "category string, ord int, name string, lat double, lon double")).count() == 0


def test_recommendations(spark):
    rules = spark.createDataFrame([(0, "condominio_R$", "num", 50, 10.0, dq.FAIL), (1, "dias_publicado", "num", 50, 0.0, dq.FAIL), (2, "score", "var", 0, 0.0, dq.FAIL), (3, "area_m2", "num", 90, 12.5, dq.FAIL), (4, "rua", "txt", 9, 99.0, dq.OK)],
                                  "ord int, campo string, tipo string, min_pct int, pct double, status string")
    got = {r.campo: r.recomendacao for r in dq.recommendations(rules).collect()}
    assert set(got) == {"condominio_R$", "dias_publicado", "score", "area_m2"}
    assert got["score"] == dq.ADVICE_CONSTANT and got["area_m2"] == "cobertura 12.5% (mínimo esperado: 90%): verificar o seletor"
