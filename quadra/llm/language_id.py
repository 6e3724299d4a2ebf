"""Language ID by prediction by partial matching (PPM) over bytes.

Per language a variable-order context tree (orders 0 .. ``ORDER``) is counted on labelled texts and
then frozen.  A byte costs, in the longest known context, ``log2((T + U) / c)`` bits (T bytes seen
there, U different ones, this one c times); an unseen byte pays the escape ``log2((T + U) / U)`` and
is coded one order lower, below order 0 in 8 bits.  The language with the shortest code wins.

Size: the model is fitted on a bounded sample (``SAMPLE_ROWS`` rows of each label, taken by a hash of
the row key) and bounded to ``NODES`` context entries over all languages, so that it may be broadcast.
Scoring is one narrow pass over Arrow batches, whole texts, about a quarter of a MB at a time.

Defined results: null text, text without a letter, or no training rows at all: ``und``, score 0,
bits 0.  Ties in code length go to the smaller label by code point.  Input columns named like a
result column are replaced; all others pass through.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadra.llm.shared import runs, text_bytes

ORDER = 4
SAMPLE_ROWS = 1500
NODES = 400_000
CHUNK = 1 << 18
COUNTS = T.StructType([T.StructField("label", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])
RESULT = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())]


def _windows(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte the last ``length`` bytes up to it (fewer at a text's start) as length << 40 | bytes."""
    b = data[int(at[0]):int(at[-1])].astype(np.uint64)
    since = np.arange(len(b)) - np.repeat(at[:-1] - at[0], np.diff(at))
    have = np.minimum(since + 1, length)
    packed = b.copy()
    for j in range(1, length):
        shifted = np.zeros_like(b)
        shifted[j:] = b[:-j]
        packed |= np.where(since >= j, shifted, 0).astype(np.uint64) << np.uint64(8 * j)
    return packed | (have.astype(np.uint64) << np.uint64(40)), have


def _suffix(window: np.ndarray, length: int) -> np.ndarray:
    return (window & np.uint64((1 << (8 * length)) - 1)) | np.uint64(length << 40)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, gram, n) of grams of 1 .. ORDER + 1 bytes; partial counts per chunk."""
    for batch in batches:
        data, at = text_bytes(batch.column(1))
        labels = np.array(batch.column(0).to_pylist(), object)
        for label in sorted(set(labels)):
            rows = np.flatnonzero(labels == label)
            for lo, hi in runs(np.concatenate([[0], np.cumsum(np.diff(at)[rows])]), CHUNK):
                parts = [data[at[r]:at[r + 1]] for r in rows[lo:hi]]
                sub = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
                sub_at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                window, have = _windows(sub, sub_at, ORDER + 1)
                for k in range(1, ORDER + 2):
                    gram, n = np.unique(_suffix(window[have >= k], k), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([label] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))], ["label", "gram", "n"])


class Model:
    """Frozen context trees: per language sorted grams with code lengths, and contexts with escape costs."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.labels = sorted(counts)
        self.trees = []
        for label in self.labels:
            gram, n = counts[label]
            order = np.argsort(gram)
            gram, n = gram[order].astype(np.uint64), n[order].astype(np.float64)
            size = (gram >> np.uint64(40)).astype(np.int64) - 1
            context = ((gram & np.uint64((1 << 40) - 1)) >> np.uint64(8)) | (size.astype(np.uint64) << np.uint64(40))
            ctx, which = np.unique(context, return_inverse=True)
            total = np.bincount(which, n, len(ctx))
            kinds = np.bincount(which, minlength=len(ctx)).astype(np.float64)
            self.trees.append((gram, np.log2((total + kinds)[which] / n), ctx, np.log2((total + kinds) / kinds)))

    def costs(self, window: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each window, one column per language."""
        have = (window >> np.uint64(40)).astype(np.int64)
        out = np.empty((len(window), len(self.labels)), np.float32)
        for j, (gram, bits, ctx, escape) in enumerate(self.trees):
            cost = np.full(len(window), 8.0)
            for k in range(ORDER + 1):
                key = _suffix(window, k + 1)
                context = ((key & np.uint64((1 << 40) - 1)) >> np.uint64(8)) | np.uint64(k << 40)
                g = np.minimum(np.searchsorted(gram, key), len(gram) - 1)
                c = np.minimum(np.searchsorted(ctx, context), len(ctx) - 1)
                now = np.where(gram[g] == key, bits[g], np.where(ctx[c] == context, cost + escape[c], cost))
                cost = np.where(have > k, now, cost)
            out[:, j] = cost
        return out


class _Memo:
    """Code lengths of the windows met last, by a hash of the window: texts repeat their words."""

    def __init__(self, model: Model):
        self.model = model
        bits = 20
        while bits > 12 and (1 << bits) * len(model.labels) * 4 > 8 << 20:
            bits -= 1
        self.shift = np.uint64(64 - bits)
        self.key = np.zeros(1 << bits, np.uint64)
        self.value = np.zeros((1 << bits, len(model.labels)), np.float32)

    def costs(self, window: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            slot = (window * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
        out = self.value[slot]
        miss = np.flatnonzero(self.key[slot] != window)
        if len(miss):
            new, which = np.unique(window[miss], return_inverse=True)
            cost = self.model.costs(new)
            out[miss] = cost[which]
            with np.errstate(over="ignore"):
                to = (new * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
            self.key[to] = new
            won = self.key[to] == new  # of several windows for a slot one stays, with its own value
            self.value[to[won]] = cost[won]
        return out


def fit(labelled: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS, nodes: int = NODES) -> Model:
    """Trees from at most about ``sample_rows`` rows of each label.

    The sample keeps the rows whose 30-bit key hash lies below a per-label threshold, so it needs one
    count per label and no sort; the context entries of a label are cut at a count (all entries of
    that count or none), which keeps the tree closed under shorter contexts.
    """
    rows = labelled.select(F.col(label).cast("string").alias("label"), F.col(text).cast("string").alias("text"), F.pmod(F.xxhash64(F.col(key), F.lit(31)), F.lit(1 << 30)).alias("h")).where("label is not null and text is not null and text <> ''")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model({})
    below = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1 << 30, (sample_rows << 30) // n)))])
    sample = rows.where(F.col("h") < F.element_at(below, F.col("label"))).select("label", "text")
    grams = sample.mapInArrow(_count, COUNTS).groupBy("label", "gram").agg(F.sum("n").alias("n")).persist()
    try:
        left: dict[str, int] = {}
        for r in grams.groupBy("label", "n").agg(F.count("*").alias("m")).orderBy("label", F.desc("n")).collect():
            used, floor = left.get(r["label"], (0, 1))
            if used is not None:
                left[r["label"]] = (used + r["m"], r["n"]) if used + r["m"] <= nodes // len(sizes) else (None, floor)
        floors = F.create_map(*[x for k, (_, floor) in left.items() for x in (F.lit(k), F.lit(floor))])
        table = grams.where(F.col("n") >= F.element_at(floors, F.col("label"))).toArrow()
    finally:
        grams.unpersist()
    labels = np.array(table.column("label").to_pylist(), object)
    gram, n = table.column("gram").to_numpy(), table.column("n").to_numpy()
    return Model({k: (gram[labels == k], n[labels == k]) for k in sizes if (labels == k).any()})


def detect(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (probability of the label under equal priors) and ``bits_per_byte``."""
    new = {f.name for f in RESULT}
    kept = [c for c in df.columns if c not in new]
    schema = T.StructType([f for f in df.schema.fields if f.name in kept] + RESULT)
    shared = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("_text"), F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)).alias("_letter"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        memo = _Memo(m) if m.labels else None
        for batch in batches:
            data, at = text_bytes(batch.column(len(kept)))
            letter = batch.column(len(kept) + 1).to_numpy(zero_copy_only=False)
            label, prob, rate = ["und"] * len(letter), np.zeros(len(letter)), np.zeros(len(letter))
            for lo, hi in runs(at, CHUNK) if memo else ():
                total = np.zeros((hi - lo, len(m.labels)))
                for a in range(int(at[lo]), int(at[hi]), 2 * CHUNK):  # a very long text: piece by piece, with its contexts
                    b = min(int(at[hi]), a + 2 * CHUNK)
                    back = min(ORDER, a - int(at[lo]))
                    cut = np.clip(at[lo:hi + 1], a - back, b)
                    if back:
                        cut[0] = a - back
                    window, _ = _windows(data, cut, ORDER + 1)
                    cost = memo.costs(window[back:])
                    cut = np.clip(at[lo:hi + 1], a, b)
                    full = np.flatnonzero(np.diff(cut))
                    total[full] += np.add.reduceat(cost, (cut[:-1] - a)[full], axis=0, dtype=np.float64)
                best = total.argmin(1)
                for i in np.flatnonzero(letter[lo:hi]):
                    label[lo + i] = m.labels[best[i]]
                gap = np.exp2(-np.minimum(total - total.min(1, keepdims=True), 1000.0))
                prob[lo:hi] = np.where(letter[lo:hi], 1.0 / gap.sum(1), 0.0)
                rate[lo:hi] = np.where(letter[lo:hi], total.min(1) / np.maximum(np.diff(at[lo:hi + 1]), 1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(label, pa.string()), pa.array(prob), pa.array(rate)], [*kept, *(f.name for f in RESULT)])

    return source.mapInArrow(score, schema)
