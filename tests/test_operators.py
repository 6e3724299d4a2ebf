"""Operator invariants and rule boundaries on small literal tables."""
import math

from pyspark.sql import functions as F

from quadra import dims
from quadra.functions.geo import haversine, nearest
from quadra.operators import finance, nlp, profiles, quality


def test_dedup_keeps_first_and_unique(spark):
    rows = [("a", 3, "x3"), ("a", 1, "x1"), ("a", 1, "x1"), ("b", 2, "y2")] + [("a", 10 + i, "z") for i in range(50)]
    df = spark.createDataFrame(rows, "id_imovel string, src_order int, v string")
    out = {r["id_imovel"]: r["v"] for r in quality.dedup_first(df).collect()}
    assert out == {"a": "x1", "b": "y2"}
    assert quality.dedup_first(df).count() == 2


def test_dedup_order_holds_for_large_keys_and_ties(spark):
    from datetime import datetime

    from quadra.sources.listing_view import ORDER_COLS, order_key

    day, big = datetime(1996, 1, 2), 20_000_000_000
    rows = [("line", 1, big, 5, day, 9.0), ("line", 2, 1, 5, day, 1.0), ("part", 7, big, 1, day, 2.0), ("part", 7, big - 1, 1_000_000_000, day, 3.0),
            ("supplier", 1, 3, 1 << 21, day, 4.0), ("supplier", 1, 4, 1, day, 5.0), ("tie", 1, 2, 3, day, 7.0), ("tie", 1, 2, 3, day, 6.0)]
    rows = [(*r, 1.0, 0.0, 0.0, "N", "O") for r in rows]
    df = spark.createDataFrame(rows, "id_imovel string, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_shipdate timestamp, l_extendedprice double,"
                                     " l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    want = {}
    for r in sorted(df.collect(), key=lambda r: tuple(r[c] for c in ORDER_COLS)):
        want.setdefault(r.id_imovel, r.l_extendedprice)
    for parts in (1, 4):
        got = quality.dedup_first(df.repartition(parts).withColumn("src_order", order_key())).collect()
        assert sorted((r.id_imovel, r.l_extendedprice) for r in got) == sorted(want.items()) == [("line", 9.0), ("part", 3.0), ("supplier", 4.0), ("tie", 6.0)]


def test_trim_outliers_strict_and_guard(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "preco_m2 double")
    kept = quality.trim_outliers(df).agg(F.min("preco_m2"), F.max("preco_m2"), F.count("*")).first()
    assert kept[0] > 1.99 and kept[1] < 99.01 and kept[2] == 98
    small = spark.createDataFrame([(float(i),) for i in range(1, 21)], "preco_m2 double")
    assert quality.trim_outliers(small).count() == 20        # <= 20 rows: no trim


def test_haversine_symmetry_and_zero(spark):
    df = spark.createDataFrame([(-22.97, -43.18, -22.90, -43.20)], "a double, b double, c double, d double")
    r = df.select(haversine("a", "b", "c", "d").alias("x"), haversine("c", "d", "a", "b").alias("y"),
                  haversine("a", "b", "a", "b").alias("z")).first()
    assert math.isclose(r["x"], r["y"]) and r["z"] == 0.0 and 7 < r["x"] < 9


def test_nearest_unknown_and_empty(spark):
    df = spark.createDataFrame([(0.0, 0.0), (-22.9635, -43.1717)], "lat double, lon double")
    pts = [(i, n, la, lo) for i, (n, la, lo) in enumerate(dims.POIS["praias"])]
    got = [tuple(r["n"]) for r in df.select(nearest("lat", "lon", pts).alias("n")).collect()]
    assert got == [(999.0, "N/A"), (0.0, "Leme")]
    assert tuple(df.select(nearest("lat", "lon", []).alias("n")).first()["n"]) == (99.9, "N/A")


def test_mcmv_band_two_unreachable(spark):
    vals = [100_000.0, 264_000.0, 264_001.0, 350_000.0, 500_000.0, 500_001.0, 0.0]
    df = spark.createDataFrame([(v, 0.0, 0.0) for v in vals], "valor double, condominio double, iptu double")
    bands = [r["mcmv_faixa"] for r in finance.finance(df).orderBy("valor").collect()]
    assert 2 not in bands
    assert bands == [0, 1, 1, 3, 3, 4, 0]


def test_sac_total_interest_closed_form():
    fin, aa, n = 400_000.0, 0.1099, 420
    jm = finance.monthly_rate(aa)
    a = fin / n
    summed = sum((fin - a * k) * jm for k in range(n))
    assert math.isclose(summed, jm * fin * (n + 1) / 2, rel_tol=1e-9)   # SAC total interest, closed form
    _, k, d = finance.price_factors(aa, n)
    p = fin * k / d
    bal = fin
    for _ in range(n):
        bal = bal * (1 + jm) - p
    assert abs(bal) < 1e-3       # Price instalment amortises to zero


def test_quintile_labels_and_ties(spark):
    df = spark.createDataFrame([(float(v), float(v)) for v in range(1, 101)], "valor double, area_m2 double")
    seg = nlp.segment_market(df).groupBy("segmento_mercado").count().collect()
    assert sorted(r["count"] for r in seg) == [20, 20, 20, 20, 20]
    flat = spark.createDataFrame([(1.0, 1.0)] * 10, "valor double, area_m2 double")
    assert {r["segmento_mercado"] for r in nlp.segment_market(flat).collect()} == {"Padrão"}


def test_zone_lookup(spark):
    cases = {"Copacabana": "Zona Sul", "meier": "Zona Norte", "Praça Seca": "Zona Norte",
             "Recreio": "Zona Oeste", "Centro": "Centro", "Niterói": dims.ZONE_UNKNOWN, "": dims.ZONE_UNKNOWN}
    df = spark.createDataFrame([(k,) for k in cases], "bairro string")
    got = {r["bairro"]: r["zona"] for r in profiles.with_zone(df).collect()}
    assert got == cases


def test_comfort_cap_and_tags(spark):
    df = spark.createDataFrame([("Frente mar, vista livre. Sol da manhã.", 2)], "descricao string, vagas int")
    t = nlp.comfort_index(nlp.extract_tags(df)).first()
    assert t["tag_vista_mar"] == 1 and t["tag_indevassavel"] == 1 and t["tag_sol_manha"] == 1
    assert t["score_conforto"] == 15 + 8 + 5 + 5
