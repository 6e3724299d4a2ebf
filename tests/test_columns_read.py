"""Queries of the enriched table name what they read; numbers do not go through text; parts are compressed."""
from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadra.functions.geo import haversine, k_nearest
from quadra.operators import ml, selection
from quadra.plans import queries, reports
from quadra.sources import sinks

POINTS = [(0, "a", -22.9, -43.2), (1, "b", -22.95, -43.25), (2, "same as b", -22.95, -43.25), (3, "c", -22.8, -43.4)]


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", ["top3_poi", "legacy_variants", "type_classifier", "price_gbt", "pca", "opportunity_report"])
def test_only_the_columns_read_are_asked_for(spark, monkeypatch, name):
    def gold(spark, sf_dir, *args, columns=None, **more):
        raise Asked(columns)

    monkeypatch.setattr(queries, "gold", gold)
    with pytest.raises(Asked) as found:
        {**queries.QUERIES, **reports.QUERIES}[name](spark, "nowhere")
    assert found.value.args[0]


def test_k_nearest_equals_all_distances(spark):
    rows = [(i, -22.9 - i % 7 / 50, -43.2 - i % 11 / 40) for i in range(60)] + [(60, None, -43.0), (61, 0.0, -43.0), (62, -22.95, -43.25), (63, float("nan"), -43.0)]
    df = spark.createDataFrame(rows, "i int, lat double, lon double")
    got = {r.i: r for r in df.select("i", "lat", "lon", k_nearest("lat", "lon", POINTS, 3).alias("near"), *[haversine("lat", "lon", la, lo).alias(f"d{o}") for o, _, la, lo in POINTS]).collect()}
    for r in got.values():
        if r.lat is None or r.lat == 0:
            assert r.near == []
        elif not math.isnan(r.lat):
            best = sorted((r[f"d{o}"], o, n) for o, n, _, _ in POINTS)[:3]
            assert [p.name for p in r.near] == [n for _, _, n in best] and [p.dist for p in r.near] == pytest.approx([d for d, _, _ in best], abs=0.0051)
    assert [p.name for p in got[62].near] == ["b", "same as b", "a"] and [p.name for p in got[63].near] == ["a", "b", "same as b"]
    assert df.select(k_nearest("lat", "lon", [], 3).alias("n")).first().n == []
    plan = df.select(k_nearest("lat", "lon", POINTS, 3))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan


def test_rule_reads_numbers_as_they_are(spark):
    df = spark.createDataFrame([(1, 2.0, -0.0, float("nan"), "3"), (4, 2.0, 0.0, None, "x")], "i int, same double, zero double, none double, t string").withColumn("dia", F.lit("2001-01-01").cast("date"))
    got = {r.coluna: (r.preenchidos, r.numericos, r.minimo, r.maximo, r.constante, r.feature) for r in selection.column_rule(df).collect()}
    assert got == {"i": (2, 2, 1.0, 4.0, 0, 1), "same": (2, 2, 2.0, 2.0, 1, 0), "zero": (2, 2, 0.0, 0.0, 0, 0), "none": (1, 0, None, None, 1, 0), "t": (2, 1, 3.0, 3.0, 0, 0), "dia": (2, 0, None, None, 1, 0)}
    plan = selection.column_rule(df.select("i", "same"))._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" not in plan.lower() and "cast(i#" in plan


def test_components_equal_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)) + 1e6
    x[:, 2] = 2 * x[:, 0] + rng.normal(size=300) / 10
    x[:, 3] = 5
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double, d double").repartition(7)
    share, vectors = ml.principal_components(df, list("abcd"))
    want = np.linalg.eigvalsh(np.corrcoef(x[:, :3].T))[::-1]
    assert share == pytest.approx([*(want / want.sum()), 0.0], abs=1e-6) and abs(vectors[3, 0]) < 1e-9
    got = ml.first_loadings(df, list("abcd"), 2).collect()
    assert {r.feature for r in got} == {"a", "c"} and [r.posicao for r in got] == [1, 2]


def test_components_of_missing_values(spark):
    with pytest.raises(ValueError):
        ml.principal_components(spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double"), ["a", "b"])


def test_compressed_parts(spark, tmp_path):
    from quadra.sources import files
    df = spark.createDataFrame([(f"u{i}", str(i), "é" * 30) for i in range(500)], "url string, quartos string, descricao string")
    sinks.write_parts(df, str(tmp_path / "p"), compression=queries.PARTS_CODEC)
    assert all(f.suffix != ".csv" for f in (tmp_path / "p").glob("part-*")) and list((tmp_path / "p").glob("part-*"))
    got = files.read_listings(spark, str(tmp_path / "p")).select("url", "quartos", "descricao").collect()
    assert sorted((r.url, r.quartos, r.descricao) for r in got) == sorted((f"u{i}", i, "é" * 30) for i in range(500))
