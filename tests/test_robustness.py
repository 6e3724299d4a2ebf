"""Cases that once gave wrong rows: part files by name, odd numbers, ties, quantiles, ranks, late arrivals, model rules."""
import glob
import random

import pytest
from pyspark.sql import functions as F

from quadra.functions.order import exact_quantiles, ranked
from quadra.functions.text import bool_to_int, to_double0, to_int0
from quadra.operators import ml, quality
from quadra.session import get_spark, stored
from quadra.sources import files, sinks
from quadra.streaming import ingest


def test_parts_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("url;valor_R$;area_m2;bairro\nhttps://x/id-1;100000;50;Centro\nhttps://x/id-2;nan;60\n", "utf-8")
    (tmp_path / "b.csv").write_text("﻿area_m2;url;valor_R$\n77;https://x/id-3;99999\n10;https://x/id-4;1e400;extra\n30;https://x/id-5;10000000000\n", "utf-8")
    got = {r.url[-1]: r for r in files.read_listings(spark, str(tmp_path)).collect()}
    assert set(got) == {"1", "2", "3", "5"}
    assert (got["3"].valor, got["3"].area_m2) == (99999.0, 77.0)
    assert (got["2"].valor, got["2"].area_m2, got["2"].bairro) == (0.0, 60.0, None)
    assert files.read_listings(spark, str(tmp_path)).select("url").count() == 4
    assert [r.raw_line for r in files.read_rejects(spark, str(tmp_path)).collect()] == ["10;https://x/id-4;1e400;extra"]


def test_missing_deeds_are_empty_and_other_errors_are_not(spark, tmp_path):
    assert files.read_deeds(spark, str(tmp_path / "none.csv")).count() == 0


def test_numbers_never_fail(spark):
    df = spark.createDataFrame([(x,) for x in ("nan", "inf", "-Infinity", "1e400", "10000000000", "7.9", "", None, "True")], "x string")
    got = df.select(to_double0("x").alias("d"), to_int0("x").alias("i"), bool_to_int("x").alias("b")).collect()
    assert [r.d for r in got] == [0, 0, 0, 0, 1e10, 7.9, 0, 0, 0]
    assert [r.i for r in got] == [0, 0, 0, 0, 0, 7, 0, 0, 0]
    assert [r.b for r in got] == [0, 0, 0, 0, 0, 7, 0, 0, 1]


def test_a_price_that_is_no_number_is_dropped(spark):
    df = spark.createDataFrame([("a", "nan", 50.0), ("b", "20000", 50.0)], "url string, valor string, area_m2 double")
    assert [r.url for r in quality.sanity_filter(quality.coerce_numeric(df)).collect()] == ["b"]


def test_ties_keep_one_row(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 5, "w")], "id_imovel string, src_order bigint, v string")
    got = [(r.id_imovel, r.v) for r in quality.dedup_first(df).orderBy("id_imovel").collect()]
    assert len(got) == 2 and got[0][1] in "xy" and got[1] == ("b", "w")
    plan = quality.dedup_first(df)._jdf.queryExecution().executedPlan().toString()
    assert "min(src_order" in plan and plan.count("HashAggregate") >= 2


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_are_exact(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice((rng.gauss(0, 1) ** 7, 5.0, float("nan"), None)) for _ in range(9000)]
    df = stored(spark.createDataFrame([(v,) for v in values], "x double"), "values")
    want = df.where("not isnan(x)").agg(F.percentile("x", [0.01, 0.5, 0.99])).first()[0]
    got, n = exact_quantiles(df, "x", [0.01, 0.5, 0.99])
    assert got == pytest.approx(want) and n == sum(v is not None and v == v for v in values)
    assert exact_quantiles(df.limit(0), "x", [0.5]) == (None, 0)


def test_rank_of_all_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")).repartition(6)
    assert [(r.x, r.rank) for r in ranked(df, [F.col("x")]).orderBy("rank").collect()] == [(i, i + 1) for i in range(1000)]


def test_stream_dedup_is_the_same_for_any_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [(i % 40, f"2024-01-01 00:{i % 60:02d}:00") for i in range(120)]
    for k in range(6):
        spark.createDataFrame(rows[k::6], "event_id int, t string").select("event_id", F.to_timestamp("t").alias("ts")).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    for files_at_once in (1, None):
        out = str(tmp_path / f"out{files_at_once}")
        ingest.run_available(ingest.dedup(ingest.source(spark, folder, schema, max_files=files_at_once), ["event_id"], "ts"), "d", sink="parquet", path=out)
        assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == list(range(40))


def test_submitted_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert get_spark().conf.get("spark.sql.shuffle.partitions") == before


def test_elbow():
    assert ml.elbow([], 10) == 5
    assert ml.elbow([100.0, 60.0], 3) == 3
    assert ml.elbow([100.0, 60.0, 50.0, 45.0, 41.0], 6) == 3
    assert ml.elbow([100.0, 80.0, 61.0, 60.0, 59.1], 6) == 4


def test_labels_of_clusters_and_anomalies(spark):
    df = spark.createDataFrame([(0, 2_500_000.0, 200.0), (1, 900_000.0, 100.0), (2, 500_000.0, 80.0), (3, 300_000.0, 50.0), (4, 200_000.0, 151.0), (4, 200_000.0, 151.0)], "cluster_id int, valor double, area_m2 double")
    got = {r.cluster_id: r.cluster_label for r in ml.cluster_labels(df).collect()}
    assert got == {0: "Alto Padrão Grande (n=1)", 1: "Médio-Alto Médio (n=1)", 2: "Médio Compacto (n=1)", 3: "Popular Compacto (n=1)", 4: "Econômico Grande (n=2)"}
    df = spark.createDataFrame([(1, 60.0), (1, 160.0), (1, 100.0), (0, 1.0)], "anomalia int, valor double").withColumn("preco_estimado_ml", F.lit(100.0))
    assert [r[0] for r in df.select(ml.anomaly_type()).collect()] == ["Subprecificado (possível oportunidade)", "Superprecificado (possível erro)", "Atípico (revisar manualmente)", "Normal"]


def test_bi_file_has_a_mark_and_reads_back(spark):
    df = spark.createDataFrame([("a", 1.5)], "id string, x double")
    path = sinks.write_bi(df)
    assert any(open(f, "rb").read().startswith(b"\xef\xbb\xbfid;x") for f in glob.glob(path.removeprefix("file:") + "/*.csv"))
    assert [tuple(r) for r in files.read_bi(spark, path).collect()] == [("a", "1.5")]


def test_isolation_forest_finds_the_far_point(spark):
    rng = random.Random(3)
    rows = [(str(i), rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(600)] + [("far", 40.0, -40.0)]
    df = spark.createDataFrame(rows, "id_imovel string, x double, y double")
    got = ml.isolation_forest(df, ["x", "y"], trees=40, sample=64).collect()
    assert max(got, key=lambda r: r.anomaly_score).id_imovel == "far"
    assert 0.03 < sum(r.anomalia for r in got) / len(got) < 0.08
