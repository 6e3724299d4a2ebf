"""Phases 13-15 — features, fair-price model, clusters, anomalies, PCA (M1-M18) on ``pyspark.ml``.

Training runs as Spark ML jobs over the partitioned table; the trees of the
isolation forest (not in ``pyspark.ml``) grow in tasks, one group of sampled
rows each, and score every row in whole Arrow batches.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadra.functions.order import exact_quantiles
from quadra.session import stored

LEAKAGE = {"valor", "preco_m2", "preco_m2_real", "preco_m2_referencia", "diferenca_percentual", "custo_aquisicao_total",
           "itbi_estimado", "cartorio_estimado", "aluguel_estimado", "fluxo_caixa_mensal", "delta_escritura_pct"}
BASE_FEATURES = ["area_m2", "quartos", "vagas", "banheiros", "suites", "andar", "condominio", "iptu", "latitude",
                 "longitude", "dist_praia_km", "dist_transporte_km", "dist_mercado_km", "dist_shopping_km",
                 "score_mobilidade", "score_seguranca", "score_lifestyle", "score_conforto", "dias_no_mercado"]
CATEGORICAL = ["bairro", "zona", "tipo_imovel"]


def discover_features(df: DataFrame, candidates=BASE_FEATURES) -> list[str]:
    """M1: numeric candidates that vary (min < max) and are not target leakage; one aggregate pass."""
    cands = [c for c in candidates if c in df.columns and c not in LEAKAGE]
    row = df.agg(*[(F.min(c) < F.max(c)).alias(c) for c in cands]).first()
    return [c for c in cands if row[c]]


def feature_pipeline(features: list[str], categorical=CATEGORICAL, scale: bool = False) -> list:
    """M2 (+M3): alphabetical label codes for categoricals, assembled vector (optionally z-scored)."""
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetAsc", handleInvalid="keep")
              for c in categorical]
    stages.append(VectorAssembler(inputCols=features + [f"{c}_idx" for c in categorical], outputCol="raw_features",
                                  handleInvalid="keep"))
    stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
                  if scale else VectorAssembler(inputCols=["raw_features"], outputCol="features"))
    return stages


def most_values(df: DataFrame, column: str = "features") -> int:
    """The largest number of values of a categorical entry of an assembled vector, by its metadata; 0 without one."""
    entries = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
    return max((len(e["vals"]) if "vals" in e else e.get("num_vals", 0) for e in entries), default=0)


def fit_trees(stages: list, trees: Estimator, df: DataFrame) -> PipelineModel:
    """``Pipeline(stages + [trees]).fit(df)``, with as many bins as the largest category has values (the default at least).

    A tree learner refuses a categorical entry of more values than it has bins.
    """
    prepared = Pipeline(stages=stages).fit(df)
    x = prepared.transform(df)
    model = trees.copy({trees.maxBins: max(trees.getMaxBins(), most_values(x))}).fit(x)
    return PipelineModel([*prepared.stages, model])


def fair_price(df: DataFrame, target: str = "valor", model: str = "gbt", max_iter: int = 200, seed: int = 42) -> DataFrame:
    """M11 + M12: fit on rows with target > 0, predict every row; delta, delta % and the opportunity flag."""
    df = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in BASE_FEATURES if c in df.columns})
    df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in CATEGORICAL if c in df.columns})
    feats = discover_features(df)
    cats = [c for c in CATEGORICAL if c in df.columns]
    if model == "rf":
        reg = RandomForestRegressor(labelCol=target, featuresCol="features", numTrees=200, seed=seed)
    elif model == "linear":
        reg = LinearRegression(labelCol=target, featuresCol="features")
    else:
        reg = GBTRegressor(labelCol=target, featuresCol="features", maxIter=max_iter, maxDepth=4, stepSize=0.05,
                           minInstancesPerNode=3, subsamplingRate=0.8, seed=seed)
    stages = feature_pipeline(feats, cats, scale=(model == "linear"))
    train = df.filter(F.col(target) > 0)                       # F8
    fitted = Pipeline(stages=[*stages, reg]).fit(train) if model == "linear" else fit_trees(stages, reg, train)
    pred = fitted.transform(df).withColumnRenamed("prediction", "preco_estimado_ml")
    r2 = RegressionEvaluator(labelCol=target, predictionCol="preco_estimado_ml", metricName="r2").evaluate(
        pred.filter(F.col(target) > 0))
    delta = F.col(target) - F.col("preco_estimado_ml")
    pct = F.when(F.col("preco_estimado_ml") > 0, F.bround(delta / F.col("preco_estimado_ml") * 100, 1)).otherwise(0.0)
    return pred.withColumns({"preco_estimado_ml": F.bround("preco_estimado_ml", 2), "delta_preco_ml": F.bround(delta, 2),
                             "delta_preco_ml_pct": pct, "ml_r2_score": F.lit(round(r2, 4))}).withColumn(
        "oportunidade_ml", (F.col("delta_preco_ml_pct") < -15).cast("int")).drop("raw_features", "features",
                                                                                  *[f"{c}_idx" for c in cats])


def share(key: str, parts: int) -> F.Column:
    """A part 0 .. parts - 1 of a row by the MD5 of its key: the same on every run and at every size."""
    return (F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % parts).cast("int")


def regressors(n: int, target: str = "valor", seed: int = 42) -> dict:
    """M7: the compared models.  FIXED VALUES: their settings; a penalty per row, as the loss here is a mean.

    Neighbour regression is left out: it needs every row beside every other.
    """
    common = {"labelCol": target, "featuresCol": "features"}
    return {
        "GradientBoosting": GBTRegressor(**common, maxIter=200, maxDepth=4, stepSize=0.05, minInstancesPerNode=3, subsamplingRate=0.8, seed=seed),
        "RandomForest": RandomForestRegressor(**common, numTrees=200, maxDepth=6, minInstancesPerNode=3, seed=seed),
        "Ridge": LinearRegression(**common, regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False),
        "Lasso": LinearRegression(**common, regParam=1000.0, elasticNetParam=1.0, standardization=False, maxIter=5000),
    }


def cross_validate(df: DataFrame, features: list[str], target: str = "valor", key: str = "id_imovel", folds: int = 5,
                   models: tuple[str, ...] = ("GradientBoosting", "RandomForest", "Ridge", "Lasso")) -> DataFrame:
    """M7 + M12: mean and deviation of R² and mean MAE over held-out folds, a row per model.

    All fits are Spark jobs over the cached features; only a few numbers per fold reach the driver.
    """
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    rows = df.where(F.col(target) > 0).select(share(key, folds).alias("fold"), F.col(target).cast("double").alias(target), *cols)
    prepared = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)])
    rows = rows.persist()
    out = []
    n = rows.count()
    for name in models:
        r2, mae = [], []
        for fold in range(folds):
            train, test = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
            fitted = Pipeline(stages=[*prepared.getStages(), regressors(n, target)[name]]).fit(train)
            seen = fitted.transform(test).select(F.col(target).alias("y"), F.col("prediction").alias("p"))
            s = seen.agg(F.sum(F.pow(F.col("y") - F.col("p"), 2)).alias("sse"), (F.var_pop("y") * F.count("y")).alias("sst"), F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae")).first()
            if s["sst"]:
                r2.append(1 - s["sse"] / s["sst"])
                mae.append(s["mae"])
        out.append((name, len(r2), float(np.mean(r2)) if r2 else None, float(np.std(r2)) if r2 else None, float(np.mean(mae)) if mae else None))
    rows.unpersist()
    return df.sparkSession.createDataFrame(out, "modelo string, folds int, r2_media double, r2_desvio double, mae_media double")


def train_test_linear(df: DataFrame, features: list[str], target: str = "valor", key: str = "id_imovel", test_share: int = 30) -> DataFrame:
    """Plain linear regression on 70 % of the rows; R² on those and on the other 30 %."""
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    rows = df.select((share(key, 100) < test_share).alias("test"), F.col(target).cast("double").alias(target), *cols).persist()
    fitted = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), LinearRegression(labelCol=target, featuresCol="features")]).fit(rows.where(~F.col("test")))
    seen = fitted.transform(rows).groupBy("test").agg(F.count(F.lit(1)).alias("n"), (1 - F.sum(F.pow(F.col(target) - F.col("prediction"), 2)) / (F.var_pop(target) * F.count(F.lit(1)))).alias("r2"))
    return seen.select(F.when(F.col("test"), "teste").otherwise("treino").alias("amostra"), "n", "r2")


def elbow(costs: list[float], kmax: int) -> int:
    """The k after which the cost drops least, relative to the drop before: smallest ratio of successive drops.

    ``costs`` start at k = 2; without costs (a table of under 100 rows) k = 5.
    """
    drops = [a - b for a, b in zip(costs, costs[1:], strict=False)]
    ratios = [b / a if a > 0 else 1.0 for a, b in zip(drops, drops[1:], strict=False)]
    if ratios:
        return min(3 + ratios.index(min(ratios)), kmax)
    return min(3, kmax) if drops else 5


def kmeans_elbow(df: DataFrame, features: list[str], seed: int = 42) -> tuple[DataFrame, int, list[float]]:
    """K from 2 to min(10, n/20), at least 3; see :func:`elbow`."""
    n = df.count()
    kmax = max(3, min(10, n // 20))
    prep = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="keep"),
                            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)]).fit(df)
    x = prep.transform(df).cache()
    costs = [KMeans(k=k, seed=seed, featuresCol="features").fit(x).summary.trainingCost for k in range(2, kmax + 1)] if n >= 100 else []
    k = elbow(costs, kmax)
    out = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster_id").fit(x).transform(x)
    x.unpersist()
    return out.drop("raw", "features"), k, costs


def cluster_labels(df: DataFrame, value: str = "valor", area: str = "area_m2") -> DataFrame:
    """M14 + A19: price tier and size tier from the cluster means, plus ``(n=…)``."""
    means = df.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("v"), F.avg(area).alias("a"))
    # FIXED VALUES: price tiers and size tiers (strictly above)
    tier = (F.when(F.col("v") > 2_000_000, "Alto Padrão").when(F.col("v") > 800_000, "Médio-Alto")
            .when(F.col("v") > 400_000, "Médio").when(F.col("v") > 200_000, "Popular").otherwise("Econômico"))
    size = F.when(F.col("a") > 150, "Grande").when(F.col("a") > 80, "Médio").otherwise("Compacto")
    lab = means.select("cluster_id", F.format_string("%s %s (n=%d)", tier, size, F.col("n")).alias("cluster_label"))
    return df.join(F.broadcast(lab), "cluster_id", "left")   # at most 10 clusters


# ----------------------------------------------------------------------------- isolation forest

NODES = "tree int, node int, feature int, split double, depth double"  # a leaf has feature -1; children of i are 2i + 1 and 2i + 2


def _mean_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    return np.where(n > 1, 2.0 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2.0 * (n - 1) / np.maximum(n, 1), 0.0)


def _grow(features: list[str], limit: int, seed: int):
    """One random tree from the rows of a group."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        x = np.column_stack([table.column(c).to_numpy() for c in features])
        rng = np.random.default_rng([seed, tree])
        out, todo = [], [(0, 0, np.arange(len(x)))]
        while todo:
            node, depth, rows = todo.pop()
            lo, hi = x[rows].min(0), x[rows].max(0)
            usable = np.flatnonzero(hi > lo)
            if depth == limit or not len(usable):
                out.append((tree, node, -1, 0.0, depth + float(_mean_path(len(rows)))))
                continue
            f = int(rng.choice(usable))
            split = float(rng.uniform(lo[f], hi[f]))
            out.append((tree, node, f, split, 0.0))
            left = x[rows, f] <= split
            todo += [(2 * node + 1, depth + 1, rows[left]), (2 * node + 2, depth + 1, rows[~left])]
        names = ["tree", "node", "feature", "split", "depth"]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()), strict=True)})
    return run


def isolation_forest(df: DataFrame, features: list[str], trees: int = 200, sample: int = 256,
                     contamination: float = 0.05, seed: int = 42, key: str = "id_imovel") -> DataFrame:
    """Anomaly score 2^(-E[depth] / c(sample)); flagged from the (1 - contamination) quantile on.

    About ``trees * sample`` rows, chosen and dealt to the trees by hash, grow one tree per group, in
    tasks; the forest (``trees * 2 * sample`` nodes at most) is broadcast and scores whole batches.
    """
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    n = df.count()
    limit = max(1, int(np.ceil(np.log2(sample))))
    dealt = filled.select(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)).alias("h"), F.pmod(F.xxhash64(key, F.lit(seed + 1)), F.lit(trees)).cast("int").alias("tree"), *features)
    dealt = dealt.where(F.col("h") < F.lit(min(1 << 30, (trees * sample << 30) // max(n, 1)))).drop("h")
    nodes = dealt.groupBy("tree").applyInArrow(_grow(features, limit, seed), NODES).toArrow()
    tree, node = nodes.column("tree").to_numpy(), nodes.column("node").to_numpy()
    names, row = np.unique(tree, return_inverse=True)
    width = 2 ** (limit + 1)
    feature, split, depth = np.full((len(names), width), -1), np.zeros((len(names), width)), np.zeros((len(names), width))
    for grid, column in ((feature, "feature"), (split, "split"), (depth, "depth")):
        grid[row, node] = nodes.column(column).to_numpy()
    shared = df.sparkSession.sparkContext.broadcast((feature, split, depth))
    norm = max(float(_mean_path(min(sample, max(2, n // trees if n < trees * sample else sample)))), 1e-9)
    kept = filled.columns

    def score(batches):
        feature, split, depth = shared.value
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features]) if batch.num_rows else np.zeros((0, len(features)))
            total = np.zeros(len(x))
            for f, s, d in zip(feature, split, depth, strict=True):
                at = np.zeros(len(x), int)
                for _ in range(limit):
                    inner = f[at] >= 0
                    right = x[np.arange(len(x)), np.maximum(f[at], 0)] > s[at]
                    at = np.where(inner, 2 * at + 1 + right, at)
                total += d[at]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(2.0 ** (-total / max(len(feature), 1) / norm))], [*kept, "anomaly_score"])

    schema = T.StructType([*filled.schema.fields, T.StructField("anomaly_score", T.DoubleType())])
    scored = stored(filled.mapInArrow(score, schema), "anomaly")
    bound, _ = exact_quantiles(scored, "anomaly_score", [1 - contamination])
    return scored.withColumn("anomalia", (F.col("anomaly_score") >= F.lit(bound[0] if bound else 1.0)).cast("int"))


def anomaly_type(est: str = "preco_estimado_ml", value: str = "valor", flag: str = "anomalia") -> F.Column:
    """M16."""
    v, e = F.col(value), F.col(est)
    # FIXED VALUES: texts and factors
    return (F.when(F.col(flag) != 1, "Normal").when(v < 0.7 * e, "Subprecificado (possível oportunidade)")
            .when(v > 1.5 * e, "Superprecificado (possível erro)").otherwise("Atípico (revisar manualmente)"))


#: Partial sums meet in so many groups before the driver adds them up.
GROUPS = 32


def _moments(features: list[str]):
    """Count, means and centred cross products of a task's rows, as one row."""
    def run(batches):
        n, mean, cross = 0, np.zeros(len(features)), np.zeros((len(features), len(features)))
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features]).astype(float)
            if len(x):
                n, mean, cross = _added(n, mean, cross, len(x), x.mean(0), (x - x.mean(0)).T @ (x - x.mean(0)))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())), pa.array([cross.ravel().tolist()], pa.list_(pa.float64()))], ["n", "mean", "cross"])
    return run


def _added(n, mean, cross, m, other, also):
    """Moments of two sets of rows together."""
    away = other - mean
    return n + m, mean + away * (m / (n + m)), cross + also + np.outer(away, away) * (n * m / (n + m))


def _sum_moments(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    n, mean, cross = 0, 0.0, 0.0
    for row in table.select(["n", "mean", "cross"]).to_pylist():
        other = np.array(row["mean"])
        n, mean, cross = _added(n, mean if n else np.zeros(len(other)), cross, row["n"], other, np.array(row["cross"]).reshape(len(other), -1))
    return n, mean, cross


def principal_components(df: DataFrame, features: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(share of the variance, loadings as columns) of the components of the standardised features, largest first.

    One pass: count, means and cross products of the features are summed per task, then in ``GROUPS`` groups; the driver
    decomposes their correlations (features x features).  A feature without deviation is 0 throughout.
    """
    numbers = df.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(c) for c in features])
    kind = "n bigint, mean array<double>, cross array<double>"

    def merge(table: pa.Table) -> pa.Table:
        n, mean, cross = _sum_moments(table)
        return pa.table({"n": pa.array([n], pa.int64()), "mean": pa.array([mean.tolist()], pa.list_(pa.float64())), "cross": pa.array([cross.ravel().tolist()], pa.list_(pa.float64()))})

    parts = numbers.mapInArrow(_moments(features), kind).withColumn("g", F.spark_partition_id() % GROUPS)
    n, _, cross = _sum_moments(parts.groupBy("g").applyInArrow(merge, kind).toArrow())
    if not n or not np.isfinite(cross).all():
        raise ValueError("principal components need rows, and features without missing or infinite values")
    std = np.sqrt(np.diag(cross))
    scale = np.divide(1.0, std, out=np.zeros_like(std), where=~(std == 0))
    values, vectors = np.linalg.eigh(cross * np.outer(scale, scale))
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    return values / values.sum(), vectors


def pca_summary(df: DataFrame, features: list[str]) -> DataFrame:
    """M5: explained variance per component and the count needed for 80 / 90 / 95 %."""
    k = len(features)
    ev = [float(v) for v in principal_components(df, features)[0]]
    cum = np.cumsum(ev)
    rows = [(i + 1, ev[i], float(cum[i]), int(np.searchsorted(cum, 0.8) + 1), int(np.searchsorted(cum, 0.9) + 1),
             int(np.searchsorted(cum, 0.95) + 1)) for i in range(k)]
    return df.sparkSession.createDataFrame(pd.DataFrame(rows, columns=["componente", "variancia", "acumulada",
                                                                       "n_80", "n_90", "n_95"]))


def first_loadings(df: DataFrame, features: list[str], top: int = 10) -> DataFrame:
    """M5: the ``top`` features by absolute loading on the first principal component of the standardised features."""
    weights = principal_components(df, features)[1][:, 0]
    order = sorted(range(len(features)), key=lambda i: (-abs(weights[i]), features[i]))[:top]
    return df.sparkSession.createDataFrame([(r + 1, features[i], round(float(abs(weights[i])), 4)) for r, i in enumerate(order)], "posicao int, feature string, peso double")


def collinearity(df: DataFrame, features: list[str], threshold: float = 0.95) -> DataFrame:
    """M4: Pearson r of every feature pair in one pass; the later column of a |r| > threshold pair is dropped."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    out = wide.select(F.inline(F.array(*rows)))
    return out.withColumn("descartar", F.when(F.abs(F.col("r")) > threshold, F.col("y")))


def binned_mutual_information(df: DataFrame, features: list[str], target: str, bins: int = 10) -> DataFrame:
    """M6 (re-aimed): mutual information of equal-width bins, I = Σ p(x,y)·ln(p(x,y)/(p(x)p(y))).

    One pass explodes (feature, bin) pairs; the contingency table is at most
    features × bins² rows, so the marginals and the sum are tiny aggregates.
    """
    cols = features + [target]
    mm = df.select(F.struct(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
                              for c in cols])).scalar()
    d = df.withColumn("__mm", mm)

    def b(c):
        lo, hi, x = F.col(f"__mm.{c}.lo"), F.col(f"__mm.{c}.hi"), F.col(c).cast("double")
        return F.when(hi == lo, 1).otherwise(F.least(F.floor((x - lo) / (hi - lo) * bins) + 1, F.lit(bins))).cast("int")
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), b(c).alias("bx")) for c in features])
    cells = (d.filter(F.col(target).isNotNull()).select(F.inline(pairs), b(target).alias("by"))
             .groupBy("feature", "bx", "by").agg(F.count(F.lit(1)).alias("n")))
    n = cells.groupBy("feature").agg(F.sum("n").alias("total"))   # (names are case-insensitive: not "N")
    px = cells.groupBy("feature", "bx").agg(F.sum("n").alias("nx"))
    py = cells.groupBy("feature", "by").agg(F.sum("n").alias("ny"))
    t = cells.join(n, "feature").join(px, ["feature", "bx"]).join(py, ["feature", "by"])
    term = F.col("n") / F.col("total") * F.log(F.col("n") * F.col("total") / (F.col("nx") * F.col("ny")))
    return t.groupBy("feature").agg(F.sum(term).alias("mi"))
