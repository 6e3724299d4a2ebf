"""Quantiles of many columns and many groups against sorted lists."""
import random

import pytest

from quadra.functions import order
from quadra.functions.order import column_quantiles, grouped_quantiles
from quadra.session import stored


def linear(values, p):
    v = sorted(values)
    at = (len(v) - 1) * p
    a = int(at)
    return v[a] + (v[min(a + 1, len(v) - 1)] - v[a]) * (at - a)


def _values(rng, n):
    return [rng.choice((rng.gauss(0, 1) ** 7, 5.0, -1e300, 1e-300, float("nan"), None, float(rng.randint(0, 3)))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_columns_at_once(spark, monkeypatch, seed):
    monkeypatch.setattr(order, "FEW", 40)
    rng = random.Random(seed)
    a, b = _values(rng, 4000), [float(rng.randint(0, 10**9)) for _ in range(4000)]
    df = stored(spark.createDataFrame(list(zip(a, b, [None] * 4000, strict=True)), "a double, b double, c double"), "q")
    probs = [0.0, 0.01, 0.2, 0.5, 0.999, 1.0]
    got = column_quantiles(df, ["a", "b", "c"], probs)
    for name, values in (("a", a), ("b", b)):
        clean = [v for v in values if v is not None and v == v]
        assert got[name][1] == len(clean) and got[name][0] == pytest.approx([linear(clean, p) for p in probs])
    assert got["c"] == (None, 0)


@pytest.mark.parametrize(("bins", "few"), [(256, 1000), (4, 5)])
def test_groups(spark, monkeypatch, bins, few):
    monkeypatch.setattr(order, "GROUP_BINS", bins)
    monkeypatch.setattr(order, "GROUP_FEW", few)
    rng = random.Random(7)
    rows = [(rng.choice(("a", "a", "a", "b", "c", None)), rng.randint(0, 1), v) for v in _values(rng, 1500)] + [("only nulls", 0, None), ("one", 0, 3.5)]
    df = spark.createDataFrame(rows, "g string, h int, x double").repartition(4)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.h): r.quantis for r in grouped_quantiles(df, ["g", "h"], "x", probs).collect()}
    want = {}
    for g, h, x in rows:
        if x is not None and x == x:
            want.setdefault((g, h), []).append(x)
    assert set(got) == set(want)
    for key, values in want.items():
        assert got[key] == pytest.approx([linear(values, p) for p in probs])
    assert grouped_quantiles(df.limit(0), ["g"], "x", probs).count() == 0
