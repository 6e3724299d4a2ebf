"""Steps that every query over the listing view shares: same results as the plain form, without its cost a row."""
import math

from pyspark.sql import functions as F

from quadra import dims
from quadra.functions.geo import nearest
from quadra.functions.text import _needed, found, title_case
from quadra.operators import geo, nlp, price, profiles, quality
from quadra.sources.listing_view import first_listings, listing_view


def test_found_is_rlike(spark):
    texts = ["", "nan", "permuta", "aceita p", "Édifício lâmina", "lamina", "alamina", "pe direito alto", "pé.direito alto", "0km", "mobiliado", "mobiliada",
             "vista bem para o mar", "frente-mar", "motivo viagem", "a|b", "oportunidade de uma reforma", "pet place", "sem vis-à-vis", "1 por andar"]
    patterns = [p for _, p in dims.TAGS + nlp.V1_TAGS] + ["|".join(dims.URGENCY_PHRASES), r"a\|b|x", "[a-c]x|y", "a|", "(?:a|b)c|d"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for p in patterns:
        assert df.where(found(F.col("t"), p) != F.col("t").rlike(p)).count() == 0, p


def test_nearest_pois_like_nearest(spark):
    rows = [(-22.9, -43.2), (-22.97, -43.18), (0.0, -43.2), (-22.9, 0.0), (None, -43.2), (-22.9, None), (-23.01, -43.45), (60.0, 100.0), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "latitude double, longitude double")
    got = geo.nearest_pois(df)
    assert "transform(" not in got._jdf.queryExecution().optimizedPlan().toString()
    got = got.withColumns({f"_{c}": nearest("latitude", "longitude", geo.category_points(None, c)) for c, _, _ in dims.GEO_COLUMNS})
    same = lambda x, y: x == y or (math.isnan(x) and math.isnan(y))
    for r in got.collect():
        for c, d, n in dims.GEO_COLUMNS:
            assert same(r[d], r[f"_{c}"]["dist"]) and r[n] == r[f"_{c}"]["name"], (r, c)


def test_nearest_pois_ties_and_empty(spark):
    cats = {"praias": [("first", -22.9, -43.2), ("second", -22.9, -43.2)]}
    r = geo.nearest_pois(spark.createDataFrame([(-22.91, -43.21)], "latitude double, longitude double"), cats).first()
    assert r["praia_prox"] == "first" and (r["lazer_prox"], r["dist_lazer_km"]) == ("N/A", 99.9)


def test_first_listings(spark):
    sf = "/root/testdata/sf0.001"
    first, old = first_listings(spark, sf), quality.dedup_first(quality.with_canonical_id(listing_view(spark, sf)))
    assert [(f.name, f.dataType) for f in first.schema] == [(f.name, f.dataType) for f in old.schema]
    assert sorted(map(str, first.collect())) == sorted(map(str, old.collect()))


def test_submitted_session_keeps_wide_stages_compiled(spark):
    own, key = spark.newSession(), "spark.sql.codegen.hugeMethodLimit"
    own.conf.unset(key)
    listing_view(own, "/root/testdata/sf0.001")
    assert own.conf.get(key) == "8000"
    own.conf.set(key, "5000")
    listing_view(own, "/root/testdata/sf0.001")
    assert own.conf.get(key) == "5000"


def test_needed_text_is_in_every_match():
    assert _needed(r"vista.*(?:mar|praia)") == "vista" and _needed(r"\bl[aâ]mina\b") == "mina" and _needed("ab?c+de{0,2}fgh") == "fgh"
    for p in ("ab{2,}?cd*e", "x(?i)yz", r"\x41bcd", "zz(?=y)", "(ab|cd)", "a.b", "", r"\Qab", "[a[bc]]de"):
        assert _needed(p) is None, p


def test_regex_tags_look_for_their_text_first(spark):
    df = spark.createDataFrame([("vista para o mar",), (None,)], "t string")
    got = df.select(found(F.col("t"), "vista.*(?:mar|praia)").alias("x"))
    assert "Contains" in got._jdf.queryExecution().optimizedPlan().toString() and [r.x for r in got.collect()] == [True, None]


def test_title_case_of_merged_runs(spark):
    texts = ["", "a", " a  b", "sol,mar. e praia", "d'água (é)", "1a2b ⓐⅱ ⅱx", "ΑΣ, ΑΣ'ⓐ", "ß, ßa", "x\u0345y", "ÇA  VA, 12ⓐ", "a\nb-c", "ǆ ǆa"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    runs = F.transform(F.regexp_extract_all("t", F.lit("(\\p{L}+|[^\\p{L}]+)"), F.lit(1)), lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30))))
    for r in df.select("t", title_case("t").alias("got"), F.array_join(runs, "").alias("want")).collect():
        assert r.got == r.want, r


def test_struct_order_dedups_without_a_join(spark):
    rows = [("a", (2, None), "z"), ("a", (1, 5), "y"), ("a", (1, None), "x"), ("a", (1, None), "x"), (None, (1, 1), "n"), ("b", None, "o"), ("b", (9, 9), None), ("c", None, "p")]
    df = spark.createDataFrame(rows, "id_imovel string, src_order struct<i:int,j:int>, `v.w` string")
    got = quality.dedup_first(df)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.columns == ["id_imovel", "src_order", "v.w"]
    assert sorted(map(tuple, got.collect())) == [("a", (1, None), "x"), ("b", (9, 9), None)]


def test_group_tables_are_joined_without_a_shuffle_of_listings(spark):
    rows = [("Centro", "Rua 1", 500000.0, 50.0, "u1"), ("Centro", "Rua 1", 400000.0, 50.0, "u2"), (None, "Rua 2", 300000.0, 30.0, "u3"), ("Leblon", None, 900000.0, 60.0, None)]
    df = spark.createDataFrame(rows, "bairro string, rua string, valor double, area_m2 double, url string")
    for step in (price.reference_price, price.street_supply, profiles.with_zone):
        out = step(df)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan, step
        assert out.count() == 4


def test_silver_stores_short_texts_as_standardised(spark):
    sf = "/root/testdata/sf0.001"
    plan = quality.clean(first_listings(spark, sf)).select("bairro", "rua", "tipo", "tipo_imovel", "corretora")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
