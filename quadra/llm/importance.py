"""Target-distribution importance resampling with length-bucketed CRC matrices.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lowered (digits, letters, all that is not ASCII);
features are all runs of one and two consecutive words (two joined by one blank), repeats counted; a feature's
bucket is its bytes' CRC-32 modulo ``buckets``.

How buckets are found (:class:`Hasher`): the words of a stretch of texts are dictionary-encoded, so are the pairs of
their numbers; only distinct features are spelled out, grouped by equal length into a two-dimensional ``uint8`` array
each, whose CRCs advance together, column by column; the buckets are scattered back over the occurrences.

1. One narrow pass a table counts features by bucket (``buckets`` numbers a task, summed by Spark).
2. A bucket's gain is ``floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))``: S features, s of
   them in the bucket, in the documents, T and t in the target's texts.  The gains (``buckets`` numbers) are broadcast.
3. A second narrow pass takes each document's floored mean of gains (``weight``); ``score`` adds Gumbel noise from
   the SHA-256 of ``<seed>:<key>``, so that the highest scores are a sample without replacement in proportion to
   ``exp(weight / 1000)``.
4. The draw needs no sort of the table: counts by score value (whole numbers of a range that the logarithms bound,
   whatever the number of rows) name the cut, and ranks are taken within each score value.  Copies have the same
   weight but noise of their own, so they spread over score values.

Defined results: null and empty texts have no features, weight 0; a null key counts as the empty text in the noise;
rows with an equal score and key are ranked by their number of features and words, equal rows in any order (they do not
differ); an empty table gives no rows, an empty target has T = t = 0.  Other columns of the input are not touched and may
have any name.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadra.llm.shared import LOWER, runs, stored, text_bytes, words

BUCKETS = 10_000
#: About so many bytes of text are taken at once; longer texts go in pieces of whole words.
CHUNK = 1 << 20
#: Longer features than this have hardly a second one of their length: they go one by one.
LONG = 2048
_GAP = np.ones(256, bool)
_GAP[ord("0"):ord("9") + 1] = _GAP[ord("A"):ord("Z") + 1] = _GAP[ord("a"):ord("z") + 1] = False
_GAP[0x80:] = False


def _crc_table() -> np.ndarray:
    """CRC-32 of each byte, by the reflected polynomial 0xEDB88320."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


CRC = _crc_table()


def crc_columns(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every column of a (length, features) byte matrix: all features advance by one byte at a time."""
    c = np.full(matrix.shape[1], 0xFFFFFFFF, np.uint32)
    for row in matrix:
        c = CRC[(c ^ row) & np.uint32(0xFF)] ^ (c >> np.uint32(8))
    return ~c


def _by_length(length: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(length, the numbers of the features of that length), for all lengths."""
    order = np.argsort(length, kind="stable")
    first = np.flatnonzero(np.diff(length[order], prepend=-1))
    for a, b in zip(first, [*first[1:], len(order)], strict=True):
        yield int(length[order[a]]), order[a:b]


class Hasher:
    """Buckets of all features of a stretch of words."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets = np.uint32(buckets)

    def _crcs(self, length: np.ndarray, spell) -> np.ndarray:
        """CRC of features of these lengths; ``spell(numbers, i)`` gives byte i of some of them (all of one length)."""
        out = np.zeros(len(length), np.uint32)
        for n, of in _by_length(length):
            if n > LONG:
                for one in of:
                    out[one] = zlib.crc32(spell(np.full(n, one), np.arange(n)).tobytes())
                continue
            for some in np.array_split(of, len(of) * n // CHUNK + 1):
                matrix = np.empty((n, len(some)), np.uint8)
                for i in range(n):
                    matrix[i] = spell(some, i)
                out[some] = crc_columns(matrix)
        return out

    def __call__(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray, paired: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of every word, and of every pair of words i and i + 1 for i in ``paired``."""
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        length = stop - start
        at = np.concatenate([[0], np.cumsum(length)])
        flat = LOWER[data[np.repeat(start - at[:-1], length) + np.arange(at[-1])]]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat)]).dictionary_encode()
        word = coded.indices.to_numpy().astype(np.int64)
        known = coded.dictionary
        kat = np.frombuffer(known.buffers()[1], np.int64)[known.offset:known.offset + len(known) + 1]
        first, size = kat[:-1], np.diff(kat)
        # the blank that joins two words stands behind the last word
        letters = np.concatenate([np.frombuffer(known.buffers()[2], np.uint8)[:kat[-1]], np.full(1, 0x20, np.uint8)])
        one = self._crcs(size, lambda of, i: letters[first[of] + i])
        pairs = pc.dictionary_encode(pa.array(word[paired] * len(known) + word[paired + 1]))
        code = pairs.dictionary.to_numpy()
        a, b = code // len(known), code % len(known)
        ends = size[a]

        def spell(of, i):
            k = i - ends[of]
            return letters[np.where(k < 0, first[a[of]] + i, np.where(k == 0, len(letters) - 1, first[b[of]] + k - 1))]

        two = self._crcs(ends + 1 + size[b], spell)
        return (one % self.buckets).astype(np.int64)[word], (two % self.buckets).astype(np.int64)[pairs.indices.to_numpy()]


def _features(column: pa.Array, hasher: Hasher) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of whole texts, or pieces of one: (first row, rows, row of each word, its bucket, row of each pair, its bucket)."""
    data, at = text_bytes(column)
    for lo, hi in runs(at, CHUNK):
        start, stop, row = words(data, at[lo:hi + 1], _GAP)
        owner = np.repeat(np.arange(hi - lo), np.diff(row))
        cut = [0]  # a piece: words of about CHUNK bytes; the word behind it is there for the pair across the border
        while cut[-1] < len(start):
            cut.append(max(cut[-1] + 1, int(np.searchsorted(start, start[cut[-1]] + CHUNK))))
        for a, b in zip(cut, cut[1:], strict=False):
            b = min(b, len(start))
            over = min(b + 1, len(start))
            paired = np.flatnonzero(owner[a:over][1:] == owner[a:over][:-1])
            single, double = hasher(data, start[a:over], stop[a:over], paired)
            yield lo, hi - lo, owner[a:b], single[:b - a], owner[a:over][paired], double


def _text(df: DataFrame, text: str) -> Column:
    return F.col(f"`{text}`").cast("string")


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of the whole table by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hasher = np.zeros(buckets, np.int64), Hasher(buckets)
        for batch in batches:
            for _, _, _, single, _, double in _features(batch.column(0), hasher):
                total += np.bincount(single, minlength=buckets) + np.bincount(double, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["b", "n"])

    rows = df.select(_text(df, text).alias("t")).mapInArrow(count, "b int, n bigint").groupBy("b").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("b").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much more common a bucket is in the target, smoothed by one feature a bucket."""
    many = float(len(raw))
    ratio = (target + 1.0) * (float(raw.sum()) + many) / ((raw + 1.0) * (float(target.sum()) + many))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_features, weight): the floored mean gain of each row's features."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        hasher = Hasher(len(table))
        for batch in batches:
            n, pairs, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for lo, rows, one, single, two, double in _features(batch.column(1), hasher):
                part = slice(lo, lo + rows)
                n[part] += np.bincount(one, minlength=rows)
                pairs[part] += np.bincount(two, minlength=rows)
                np.add.at(total, lo + one, table[single])
                np.add.at(total, lo + two, table[double])
            features = n + pairs
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(features), pa.array(np.where(features > 0, total // np.maximum(features, 1), 0))], ["key", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), _text(docs, text).alias("t"))
    return rows.mapInArrow(mean, f"key {rows.schema['key'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint")


def noise(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw that depends on the key alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def draw(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` (key, score, n_words, n_features) with ``rank``: 1, 2, ... for the highest ``percent`` % of the eligible rows, else null.

    ``scored`` is a stored table.  Only (score value, count) pairs reach the driver.
    """
    counts = scored.where(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow()
    score, n = counts.column("score").to_numpy(), counts.column("n").to_numpy()
    order = np.argsort(-score)
    score, n = score[order], n[order]
    wanted = percent * int(n.sum()) // 100
    before = np.cumsum(n) - n
    taken = before < wanted
    none = F.lit(None).cast("bigint")
    if not taken.any():
        return scored.withColumn("rank", none)
    cut = int(score[taken].min())
    ahead = scored.sparkSession.createDataFrame(pa.table({"score": pa.array(score[taken], pa.int64()), "ahead": pa.array(before[taken], pa.int64())}))
    inside = Window.partitionBy("score").orderBy("key", "n_features", "n_words")
    chosen = eligible & (F.col("score") >= cut)
    place = F.col("ahead") + F.row_number().over(inside)
    top = scored.where(chosen).join(F.broadcast(ahead), "score").withColumn("rank", F.when(place <= wanted, place)).drop("ahead")
    return top.select(*scored.columns, "rank").unionByName(scored.where(~chosen).withColumn("rank", none))


def resample(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", target_text: str = "text", buckets: int = BUCKETS,
             percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """(key, n_words, n_features, weight, score, rank): a row per row of ``docs``; the rows with a rank are the sample.

    Of the rows with ``least_words`` words or more, ``percent`` % are drawn (rounded down).
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    scored = weigh(docs, gain, text, key).withColumn("score", F.col("weight") + noise(F.col("key"), seed))
    return draw(stored(scored, "scored"), F.col("n_words") >= least_words, percent)


def sampled(docs: DataFrame, drawn: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose key is drawn (unique keys; rows that share a key stay together)."""
    chosen = drawn.where("rank is not null").select(F.col("key").alias("_drawn_key")).distinct()
    return docs.join(chosen, F.col(f"`{key}`").eqNullSafe(F.col("_drawn_key")), "left_semi")
