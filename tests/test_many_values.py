"""Tree models on categories of more values than a tree learner has bins by default (32)."""
from __future__ import annotations

import pytest

from quadra.operators import ml, selection


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, i % 5, float(100_000 + (i % 45) * 1000 + i), float(i % 7), f"bairro {i % 45:02d}", "Sul", "Casa") for i in range(270)]
    return spark.createDataFrame(data, "id_imovel bigint, fold int, valor double, area_m2 double, bairro string, zona string, tipo_imovel string")


def test_price_by_boosted_trees(rows):
    out = ml.fair_price(rows, max_iter=2)
    assert out.count() == 270 and out.where("preco_estimado_ml is null").count() == 0


def test_forest_grid_and_log_price(rows):
    table, names = selection.prepared(rows, ["area_m2"])
    assert "bairro_encoded" in names
    assert selection.tune(table, names, "RandomForest", {"numTrees": [2], "maxDepth": [2]}).count() == 1
    assert selection.log_price(table, names, max_iter=2).count() == 270
    model = selection.fit_forest(table, names, trees=2)
    assert model.stages[-1].getOrDefault("maxBins") == 46  # 45 values and the place of unknown ones
    assert selection.scored(model, table, "p").count() == 270


def test_few_values_keep_the_default(spark):
    data = [(i, i % 5, float(i), f"b{i % 3}", "x", "y") for i in range(1, 41)]
    df = spark.createDataFrame(data, "id_imovel bigint, fold int, valor double, bairro string, zona string, tipo_imovel string")
    table, names = selection.prepared(df.withColumn("area_m2", df.valor), ["area_m2"])
    assert selection.fit_forest(table, names, trees=1).stages[-1].getOrDefault("maxBins") == 32
