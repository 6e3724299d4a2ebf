"""Queries over the listing view work out and store the columns they read; cheaper text and dedup steps give the same rows."""
import datetime
import os
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quadra.functions.geo import nearest_each
from quadra.functions.text import canonical_id, title_case, trim_ws
from quadra.operators import profiles, quality
from quadra.plans.pipeline import gold
from quadra.plans.queries import BI_FLAGS, PROFILE_OUT, bi, silver
from quadra.session import ensure_checkpoint_dir
from quadra.sources.listing_view import ORDER_COLS, first_bases, first_listings, listing_columns, listing_view

SF = "/root/testdata/sf0.001"


def _stored(spark, name):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {x for x in os.listdir(folder) if x.startswith(f"{name}-")} if os.path.isdir(folder) else set()


def test_title_case_and_trim_as_by_regex(spark):
    rng = random.Random(7)
    chars = "aZ bß ÿÇç×÷²ªºµ(1',.-/\t\n\x0b\r\f\xa0\x85\u2028 ǆΑΣİıéÀ_^`[{中ﬁⓐ"
    texts = ["", " ", "frente MAR, vista livre. ", "Sala/Conjunto", "m² área", *("".join(rng.choice(chars + "abcDE    ") for _ in range(rng.randint(1, 9))) for _ in range(3000))]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    runs = F.transform(F.regexp_extract_all("t", F.lit("(\\p{L}+|[^\\p{L}]+)"), F.lit(1)), lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30))))
    blanks = "[\\s\\x{00A0}]+"
    assert "initcap" in df.select(title_case("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "trim" in df.select(trim_ws("t"))._jdf.queryExecution().optimizedPlan().toString()
    got = df.select("t", title_case("t").alias("a"), F.array_join(runs, "").alias("b"), trim_ws("t").alias("c"), F.regexp_replace("t", f"^{blanks}|{blanks}$", "").alias("d"))
    for r in got.collect():
        assert (r.a, r.c) == (r.b, r.d), r


def test_canonical_id(spark):
    df = spark.createDataFrame([("x/id-12",), ("x/id--5",), ("",), (None,)], "u string")
    assert [r.i for r in df.select(canonical_id("u").alias("i")).collect()] == ["12", "x/id--5", "", "nan"]


def test_first_rows_keeps_a_null_key(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, None, "c"), (1, None, "b"), (None, 5, "d"), (None, 4, "e")], "k int, o int, x string")
    assert sorted(map(str, map(tuple, quality.first_rows(df, "k", ["o"], ["x"]).collect()))) == ["(1, None, 'b')", "(None, 4, 'e')"]


def test_first_listings_of_odd_keys(spark, tmp_path):
    day = datetime.datetime(2001, 1, 1)
    keys = [(1, 3), (1, 1), (1, 1), (None, 2), (None, 1), (-5, 1), (7, None), (7, 1)]
    pq.write_table(pa.table({"l_orderkey": pa.array([k for k, _ in keys], pa.int64()), "l_partkey": pa.array([9] * 8, pa.int64()), "l_suppkey": pa.array([1, 1, 1, 1, 2, 2, 1, 2], pa.int64()),
                             "l_linenumber": pa.array([n for _, n in keys], pa.int32()), "l_quantity": [5.0] * 8, "l_extendedprice": [9e4] * 8, "l_discount": [0.0] * 8, "l_tax": [0.0] * 8,
                             "l_returnflag": ["A"] * 8, "l_linestatus": ["F", "O"] * 4, "l_shipdate": [day] * 8}), tmp_path / "lineitem.parquet")
    pq.write_table(pa.table({"s_suppkey": pa.array([1, 2, 2], pa.int64()), "s_name": ["a", "c", "b"], "s_nationkey": pa.array([0, 0, 0], pa.int64())}), tmp_path / "supplier.parquet")
    pq.write_table(pa.table({"n_nationkey": pa.array([0], pa.int64()), "n_name": ["N"]}), tmp_path / "nation.parquet")
    first = first_listings(spark, str(tmp_path))
    old = quality.dedup_first(quality.with_canonical_id(listing_view(spark, str(tmp_path))))
    assert first.columns == old.columns and first.count() == 4
    assert sorted(map(str, first.collect())) == sorted(map(str, old.collect()))
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()


def test_silver_stores_the_columns_read(spark):
    cols = ["id_imovel", "valor", "tipo", "tipo_imovel", "descricao"]
    some, every = silver(spark, SF, *cols), silver(spark, SF)
    assert set(some.columns) == {*cols, "preco_m2"} < set(every.columns)
    assert sorted(map(str, some.select(*cols).collect())) == sorted(map(str, every.select(*cols).collect()))


def test_gold_columns_are_those_of_the_whole_table(spark):
    plain = ["id_imovel", "dias_no_mercado", "dist_praia_km", "score_conforto", "zona", "resumo_financeiro", "alerta_oferta_rua", "tag_reformado"]
    every = gold(spark, SF)
    plain = [c for c in plain if c in every.columns]
    assert len(plain) >= 6
    was = _stored(spark, "gold")
    some = gold(spark, SF, columns=plain)
    assert _stored(spark, "gold") == was   # read once: not stored
    assert sorted(map(str, some.collect())) == sorted(map(str, every.select(*plain).collect()))
    scored = gold(spark, SF, columns=["id_imovel", *PROFILE_OUT])
    assert sorted(map(str, scored.collect())) == sorted(map(str, every.select("id_imovel", *PROFILE_OUT).collect()))
    new, = _stored(spark, "gold") - was
    kept = spark.read.parquet(f"{ensure_checkpoint_dir(spark)}/{new}").columns
    assert set(kept) <= {"id_imovel", *PROFILE_OUT, *profiles.INPUTS} and set(profiles.INPUTS) <= set(kept)


def test_bi_table_is_worked_out_where_read(spark):
    was = _stored(spark, "gold")
    assert "ArrowEvalPython" not in bi(spark, SF).select("id_imovel", *BI_FLAGS)._jdf.queryExecution().optimizedPlan().toString()
    assert _stored(spark, "gold") == was


def test_gold_stores_base_columns_and_derives_the_rest(spark):
    was = _stored(spark, "silver")
    lazy = quality.clean_derived(first_bases(spark, SF), listing_columns)
    new, = _stored(spark, "silver") - was
    kept = spark.read.parquet(f"{ensure_checkpoint_dir(spark)}/{new}").columns
    assert set(kept) == {"l_orderkey", "s_name", "n_name", *ORDER_COLS, *[f"_{c}" for c in quality.SHARED_COLS]}
    every = quality.clean(first_listings(spark, SF))
    assert [(f.name, f.dataType) for f in lazy.schema] == [(f.name, f.dataType) for f in every.schema]
    assert sorted(map(str, lazy.collect())) == sorted(map(str, every.collect()))
    was = _stored(spark, "silver")
    gold(spark, SF, columns=["id_imovel", "dias_no_mercado"])
    new, = _stored(spark, "silver") - was
    assert "descricao" not in spark.read.parquet(f"{ensure_checkpoint_dir(spark)}/{new}").columns


def test_scans_of_the_listing_view_are_cut_by_cores(spark):
    own, key = spark.newSession(), "spark.sql.files.minPartitionNum"
    own.conf.unset(key)
    listing_view(own, SF)
    assert int(own.conf.get(key)) == 4 * spark.sparkContext.defaultParallelism
    own.conf.set(key, "3")
    listing_view(own, SF)
    assert own.conf.get(key) == "3"


def test_nearest_by_products_is_the_haversine_of_every_point(spark):
    points = [(0, "a", -22.9, -43.2), (1, "b", -22.9, -43.2 + 1e-9), (2, "c", -22.9 + 1e-10, -43.2), (3, "d", 10.0, 170.0), (4, "e", 10.0, -170.0), (5, "f", 89.9, 0.5)]
    rows = [(-22.9, -43.2), (-22.9, -43.2 + 5e-10), (-22.9 + 5e-11, -43.2), (10.0, 180.0), (10.0, -180.0), (90.0, 1.0), (400.0, 20.0), (1e9, 1e17), (1e300, 2.0),
            (float("inf"), 1.0), (1.0, float("nan")), (0.0, 1.0), (None, 1.0), (-89.0, 179.0)]
    rows += [(-22.9 + i / 997, -43.2 - i / 1013) for i in range(300)]
    df = spark.createDataFrame(rows, "latitude double, longitude double")
    got = df.withColumn("n", nearest_each(F.col("latitude"), F.col("longitude"), {"x": points}))
    for r in got.collect():
        if r.latitude is None or r.latitude == 0:
            assert r.n.x.a is None and r.n.x.i is None
            continue
        with np.errstate(invalid="ignore"):
            la, lo = np.radians(r.latitude), np.radians(r.longitude)
            p = np.radians([q[2:] for q in points])
            a = np.sin((p[:, 0] - la) / 2) ** 2 + np.cos(la) * np.cos(p[:, 0]) * np.sin((p[:, 1] - lo) / 2) ** 2
        assert r.n.x.i == a.argmin(), r
        assert (np.isnan(r.n.x.a) and np.isnan(a[a.argmin()])) or abs(r.n.x.a - a.min()) <= 1e-15 + 1e-12 * abs(a.min()), r
