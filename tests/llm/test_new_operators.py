"""Importance resampling, HyperMinHash near-duplicates and embedding whitening against plain versions, and on odd input."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadra.llm import hyperminhash, importance, queries, whitening
from tests.llm import brute

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, lang string, score string, n int, key string, rank string, node string, weight int"


def _texts(seed=5):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(150)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    return rng, vocabulary, text


@pytest.fixture(scope="module")
def rows():
    rng, vocabulary, text = _texts()
    base = text(140)
    out = []
    for i in range(120):
        t = text(rng.randint(1, 80))
        if i % 2 == 0:  # edits of one text, from near to too far
            w = base.split()
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary) + "x"
            t = " ".join(w)
        out.append((i, t))
    chain = text(200).split()
    for i in range(12):  # each is near the one before, not the first
        chain = [*chain[6:], *text(6).split()]
        out.append((200 + i, " ".join(chain)))
    out += [(300, base), (301, base.upper()), (302, base.replace(" ", "\t\n")), (303, None), (304, ""), (305, " \n\t "), (306, "one"), (307, "ONE"), (308, "one two"), (309, "one\ntwo"),
            (310, "abc " * 4000), (311, text(30_000)), (312, "naïve café 日本語 \U0001f600 " * 40), (313, "日" * 5000), (314, "a-b_c`d{e~f@g[h 1:2/3"), (315, "x" * 3000 + " y"),
            (316, base), (316, base), (317, text(9)), (317, text(9)), (None, text(25)), (None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y", 3, "k", "r", "n", 5) for d, t in rows], SCHEMA).repartition(6)


# ---------------------------------------------------------------- 11


def _features(text):
    w = WORD.findall((text or "").translate(brute.LOWER))
    return w, Counter(zlib.crc32(f.encode()) % 10000 for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))])


def _resampled(rows, target, percent=25):
    raw, goal = Counter(), Counter()
    for _, t in rows:
        raw += _features(t)[1]
    for t in target:
        goal += _features(t)[1]
    s, t = sum(raw.values()), sum(goal.values())
    out = []
    for d, text in rows:
        w, f = _features(text)
        gain = sum(n * math.floor(1000 * math.log((goal[b] + 1) * (s + 10000) / ((raw[b] + 1) * (t + 10000)))) for b, n in f.items())
        n = sum(f.values())
        weight = gain // n if n else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)])
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1]))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r.append(i + 1)
    return sorted(([*r[:4], r[5] if len(r) > 5 else None] for r in out), key=str)


def test_resampling_matches_plain_version(spark, docs, rows, tmp_path):
    target = [rows[3][1], rows[5][1], None, "", "naïve one two"]
    goal = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id int, text string, score int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    goal.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = queries.op11_importance_resampling(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for c, t in got.dtypes} == {"bigint"}
    assert sorted((list(r) for r in got.collect()), key=str) == _resampled(rows, target)
    assert sorted(r.rank for r in got.where("rank is not null").collect()) == list(range(1, got.where("rank is not null").count() + 1))


def test_pieces_of_a_long_text_count_the_same(docs, rows, monkeypatch):
    want = importance.bucket_counts(docs)
    assert want.sum() == sum(_features(t)[1].total() for _, t in rows)
    for size in (7, 900):
        monkeypatch.setattr(importance, "CHUNK", size)
        assert (importance.bucket_counts(docs) == want).all()
    monkeypatch.setattr(importance, "LONG", 2)
    assert (importance.bucket_counts(docs) == want).all()


def test_crc_columns():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 40):
        m = rng.integers(0, 256, (n, 50)).astype(np.uint8)
        assert importance.crc_columns(m).tolist() == [zlib.crc32(m[:, i].tobytes()) for i in range(50)]


def test_resampling_favours_the_target(spark):
    rng = random.Random(2)
    one, two = [[f"{p}{i}" for i in range(60)] for p in "ab"]
    data = [(i, " ".join(rng.choice((one, two)[i % 4 == 0]) for _ in range(40))) for i in range(800)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    goal = spark.createDataFrame([(" ".join(rng.choice(two) for _ in range(400)),)], "text string")
    drawn = importance.resample(df, goal)
    kept = importance.sampled(df, drawn).collect()
    assert len(kept) == 200 and kept[0].asDict().keys() == {"doc_id", "text"}
    assert sum(r.doc_id % 4 == 0 for r in kept) > 100  # an even draw would take 50


def test_resampling_without_rows_or_target(spark, docs, rows):
    none = spark.createDataFrame([], SCHEMA)
    assert importance.resample(none, docs).count() == 0
    got = importance.resample(docs, none).select("key", "n_features", "weight", "score", "rank").collect()
    assert sorted((list(r) for r in got), key=str) == _resampled(rows, [])
    few = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert [r.rank for r in importance.resample(few, few).collect()] == [None]


# ---------------------------------------------------------------- 12


def _same(got, rows, k, percent):
    """Components as sets of rows, since two texts may share a key."""
    want = brute.components([(-1 if d is None else d, t) for d, t in rows], k, percent)
    want = [(d, n, c if n else d) for d, n, c in want]
    assert sorted((-1 if r.doc is None else r.doc, r.n_shingles, -1 if r.component is None else r.component) for r in got) == sorted(want)


@pytest.mark.parametrize(("k", "percent", "small", "few"), [(3, 85, 32, 8), (3, 85, 1, 2), (5, 80, 3, 4), (1, 60, 32, 8), (1, 70, 1, 3)])
def test_near_duplicates_match_all_pairs(docs, rows, monkeypatch, k, percent, small, few):
    monkeypatch.setattr(hyperminhash, "SMALL", small)
    monkeypatch.setattr(hyperminhash, "FEW", few)
    _same(hyperminhash.near_duplicates(docs, k=k, percent=percent).collect(), rows, k, percent)


def test_near_duplicate_query(spark, docs, rows, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_hyperminhash(spark, str(tmp_path)).collect()
    want = [(d, n, c if n else d) for d, n, c in brute.components([(-1 if d is None else d, t) for d, t in rows], 3, 85)]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id, r.kept) for r in got) == sorted((d, n, c, d == c) for d, n, c in want)
    kept = hyperminhash.deduplicated(docs, hyperminhash.near_duplicates(docs, k=3, percent=85))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {None if d == -1 else d for d, _, c in want if d == c}


def test_near_duplicates_without_words(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in hyperminhash.near_duplicates(df).collect()) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert hyperminhash.near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_corrected():
    rng = np.random.default_rng(4)
    one, two = (lambda n: np.zeros(n, np.int64)), 40
    for size, share in ((30, 0.5), (300, 0.85), (5000, 0.5), (5000, 0.0), (200_000, 0.0)):
        est, raw = [], []
        for _ in range(two if size < 10_000 else 8):
            common = int(2 * size * share / (1 + share))
            h = rng.integers(0, 2**64, 2 * size - common, dtype=np.uint64)
            x, y = (hyperminhash.registers(part, one(len(part)), 1) for part in (h[:size], h[size - common:]))
            e, same, used = hyperminhash.estimates(x, y, np.array([size]), np.array([size]))
            est.append(e[0])
            raw.append(same[0] / used[0])
        assert abs(np.mean(est) - share) < 0.05
        assert np.mean(est) <= np.mean(raw)
    # eight bits fewer of mantissa would agree by accident often; the correction is what the formula says
    assert hyperminhash._accidental(40) == pytest.approx(0.1699 / 2**hyperminhash.MANTISSA * 1.0, rel=0.3)


# ---------------------------------------------------------------- 13


def _vectors(seed=1, n=400, d=24):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) * np.linspace(0.3, 3, d) + rng.standard_normal(d)
    x[n // 2:n // 2 + n // 3] = x[0]  # a third are copies
    return x.astype(np.float32)


def _plain(x):
    """n, S, V, eigenpairs (falling) of the distinct whole-number vectors."""
    whole = np.floor(64 * x.astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(whole, axis=0)
    n, s = len(fit), fit.sum(0)
    y = (n * fit - s) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    return whole, n, s, v, e[::-1], u[:, ::-1]


def test_whitening_matches_eigh(spark, tmp_path):
    x = _vectors()
    odd = [(1000, None), (1001, []), (1002, [float("nan")] * 24), (1003, [None] + [1.0] * 23), (1004, [float("inf")] * 24), (1005, [1.0, 2.0]), (0, x[0].tolist())]
    df = spark.createDataFrame([*((i, v.tolist()) for i, v in enumerate(x)), *odd], "vec_id bigint, embedding array<float>").withColumns({"n": F.lit("z"), "x": F.lit(1), "key": F.lit("k"), "v": F.lit(2)})
    df.repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = queries.op13_embedding_whitening(spark, str(tmp_path))
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    got = out.collect()
    whole, n, s, v, e, u = _plain(x)
    assert len(got) == (len(x) + 1) * 16 and {r.n for r in got} == {n}
    z = np.zeros((len(x), 16))
    for r in got:
        z[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(whole[r.vec_id], s, strict=True))
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(v), rel=1e-9)
    want = (whole - s / n) @ (u[:, :16] / np.sqrt(e[:16]))
    assert np.allclose(z * np.sign((z * want).sum(0)), want, atol=1e-8)
    fit = np.unique(whole, axis=0, return_index=True)[1]
    cov = np.cov(z[fit].T, bias=True)
    assert abs(cov - np.eye(16)).max() < 1e-9 and {r.identity_error for r in got}.pop() < 1e-9
    assert len({r.identity_error for r in got}) == 1


@pytest.mark.parametrize("seed", range(3))
def test_inertia_counts(seed):
    rng = np.random.default_rng(seed)
    for _ in range(150):
        d = int(rng.integers(1, 25))
        a = rng.standard_normal((d, d))
        a = np.round(a + a.T) if rng.random() < 0.3 else a + a.T
        s = rng.normal()
        assert whitening.above(a, s) == (np.linalg.eigvalsh(a) > s).sum()


def test_feast_finds_every_pair(spark):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.standard_normal((60, 60)))
    for v in (np.eye(20), np.diag([5.0] * 12 + [3.0] * 10 + [0.0] * 4), np.array([[2.0]]), q @ np.diag(1.3 ** -np.arange(60.0)) @ q.T, np.diag([1e6] + [1.0] * 30)):
        v = (v + v.T) / 2
        e, u = whitening.feast(spark, v)
        want = np.linalg.eigvalsh(v)[::-1][:16]
        want = want[want > 1e-12 * want.max()]
        assert np.allclose(e, want, rtol=1e-12, atol=1e-14 * want.max())
        assert abs(u.T @ u - np.eye(len(e))).max() < 1e-13 and abs(v @ u - u * e).max() < 1e-12 * want.max()
    assert len(whitening.feast(spark, np.zeros((4, 4)))[0]) == 0


def test_whitening_of_few_or_flat_rows(spark):
    make = lambda data: spark.createDataFrame(data, "vec_id bigint, embedding array<float>")
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, None), (2, [])])).count() == 0
    assert whitening.whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector: no variance
    got = whitening.whiten(make([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0]), (4, [1.0])])).collect()
    assert sorted((r.key, r.component, r.n, int(r.deviation)) for r in got) == [(1, 1, 2, 4096), (2, 1, 2, 4096), (3, 1, 2, 4096)]
    assert sorted(abs(r.whitened) for r in got) == pytest.approx([1.0, 1.0, 1.0]) and {r.explained for r in got} == {1.0}


def test_deviation_beyond_long():
    m = whitening.Whitener(3_000_000_001, np.array([5, -7], np.int64), 0.0, np.zeros(0), np.zeros((2, 0)))
    x = np.array([[1 << 40, -3]])
    assert m.deviation(x) == [(3_000_000_001 * (1 << 40) - 5) ** 2 + (3_000_000_001 * -3 + 7) ** 2]
