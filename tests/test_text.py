"""Unit cases for the text column functions (boundaries, NBSP, accents, docstring examples)."""
from pyspark.sql import functions as F

from quadra.functions import text as tx
from quadra.operators import extract


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_title_case_matches_python_title(spark):
    for s in ["freguesia (ilha)", "BARRA DA TIJUCA", "são cristóvão", "2nd floor", "d'or x"]:
        assert one(spark, tx.title_case(F.col("s")), s) == s.title()


def test_strip_accents(spark):
    assert one(spark, tx.strip_accents(F.col("s")), "Méier Jacarepaguá Praça") == "Meier Jacarepagua Praca"


def test_extract_decimal_cases(spark):
    assert one(spark, tx.extract_decimal(F.col("s")), "R$ 1.200,50") == 1200.5
    assert one(spark, tx.extract_decimal(F.col("s")), "R$ 1.400/mês") == 1400.0   # NBSP
    assert one(spark, tx.extract_decimal(F.col("s")), "1.200,50") == 1200.5           # no prefix fallback
    assert one(spark, tx.extract_decimal(F.col("s")), "sob consulta") == 0.0


def test_extract_number_concatenates_digits(spark):
    assert one(spark, tx.extract_number(F.col("s")), "2-3") == 23
    assert one(spark, tx.extract_number(F.col("s")), "none") == 0


def test_parse_pt_date(spark):
    assert one(spark, tx.parse_pt_date(F.col("s")), "12 de março de 2025") == "2025-03-12"
    assert one(spark, tx.parse_pt_date(F.col("s")), "ontem") == "ontem"


def test_relative_days(spark):
    s = "Publicado há 3 dias, atualizado há 1 semana."
    assert one(spark, tx.parse_relative_days(F.col("s"), "publicado"), s) == 3
    assert one(spark, tx.parse_relative_days(F.col("s"), "atualizado"), s) == 7
    assert one(spark, tx.parse_relative_days(F.col("s"), "publicado"), "Publicado há 5 horas") == 0
    assert one(spark, tx.parse_relative_days(F.col("s"), "publicado"), "") == 0


def test_canonical_id(spark):
    assert one(spark, tx.canonical_id(F.col("s")), "https://x/venda-id-2612.html") == "2612"
    assert one(spark, tx.canonical_id(F.col("s")), "https://x/other") == "https://x/other"


def test_street_normaliser_examples(spark):
    cases = {
        "SETE DE ABRIL, RUA": "Rua Sete De Abril", "BOA VISTA, ETR": "Estrada Boa Vista",
        "MAR AZUL, AVN": "Avenida Mar Azul", "BANDEIRA, PCA": "Praça Bandeira",
        "RUA CEREJEIRA": "Rua Cerejeira", "LARGO DA FONTE": "Largo Da Fonte",
        "MANOEL TORRES / ANA PRADO, RUA": "Rua Manoel Torres",
        "ATLÂNTICO SUL AV, ENTRE ALM. DAS PALMAS": "Avenida Atlântico Sul",
        "TOMAS LIMA, RUA / DR. IVO SERRA": "Rua Tomas Lima",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "s string").select("s", extract.normalise_street("s").alias("r"))
    got = {r["s"]: r["r"] for r in rows.collect()}
    assert got == cases


def test_address_parse(spark):
    df = spark.createDataFrame([("Rua Sete de Abril, 21 - Vila Nova, Rio de Janeiro - RJ",)], "e string")
    r = df.select(*[c.alias(k) for k, c in extract.full_address("e").items()]).first()
    assert (r["uf"], r["bairro_end"], r["cidade_end"], r["rua_end"]) == ("RJ", "Vila Nova", "Rio de Janeiro",
                                                                         "Rua Sete de Abril")
