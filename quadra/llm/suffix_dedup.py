"""Suffix-array dedup: bytes covered by a ``length``-byte string that also starts elsewhere.

Split into tasks by content.  Every ``length``-byte window has a key, the least hash of its ``GRAM``-byte
grams (a quarter of the window at most); equal windows have equal keys.  A *segment* is a run of windows of one key in a text (about one
per ``length`` / 2 bytes).  Equal texts are one class (a class of two or more is removed whole, if long
enough, and takes part once); equal segments are one content (a content in two places is repeated as
a whole).  What is left are keys with several different contents, or with one that may
repeat a window inside; only their bytes are shuffled.

Per task a suffix array by two-stage sorting: suffixes smaller than their successor are sorted
directly (eight bytes at a time, ties only, until a group is known to agree on ``length`` bytes); the
rest are induced by scanning the buckets of first bytes in ascending order.  Common prefixes of
neighbours then show which windows occur twice.

A key whose different contents exceed ``HOT_BYTES`` (the edges of a passage that very many texts share)
would not fit a task; its windows are counted by 128-bit hash instead, in a partial aggregate.

Defined results: null text is empty; repeated rows are copies of each other; texts shorter than
``length`` lose nothing; a document's matches are judged on the input, never across documents.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra.llm.shared import bitmap, in_bitmap, mix, powers, runs, span_hash, stored, text_bytes

LENGTH = 400
GRAM = 64
CHUNK = 1 << 19
TASK_BYTES = 1 << 20
HOT_BYTES = 1 << 21

# ---------------------------------------------------------------- suffix array


def _words8(x: np.ndarray) -> np.ndarray:
    """Eight symbols from each position as one number, first symbol highest (zeros after the end)."""
    padded = np.concatenate([x, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(x)].copy().view(">u8").ravel().astype(np.uint64)


def suffix_array(x: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the symbols ``x`` (uint8) in the order of their suffixes, exact to ``depth`` symbols."""
    n = len(x)
    if n < 2:
        return np.arange(n)
    # smaller than the successor: the next different symbol is larger (the end is smallest)
    change = np.flatnonzero(np.concatenate([x[1:] != x[:-1], [True]]))
    run_end = change[np.searchsorted(change, np.arange(n))]
    after = np.concatenate([x.astype(np.int16), [-1]])[run_end + 1]
    small = after > x
    # stage one: sort these directly
    word = np.concatenate([_words8(x), np.zeros(depth + 8, np.uint64)])
    alike = np.concatenate([window_hash(x, depth), np.zeros(1, np.uint64)])
    s = np.flatnonzero(small)
    s = s[np.argsort(word[s], kind="stable")]
    at, d = np.arange(len(s)), 8
    group = np.cumsum(np.concatenate([[0], (word[s][1:] != word[s][:-1]).astype(np.int64)])) if len(s) else at
    while len(at) and d < depth:
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        h = alike[np.minimum(s[at], n)]
        open_ = np.minimum.reduceat(h, starts) != np.maximum.reduceat(h, starts)  # else all agree on `depth` symbols
        keep = np.repeat(open_, np.diff(np.concatenate([starts, [len(at)]])))
        at, group = at[keep], group[keep]
        if not len(at):
            break
        key = word[s[at] + d]
        order = np.lexsort((key, group))
        s[at] = s[at[order]]
        key = key[order]
        group = np.cumsum(np.concatenate([[0], ((group[1:] != group[:-1]) | (key[1:] != key[:-1])).astype(np.int64)]))
        d += 8
    # stage two: induce the others, bucket by bucket
    first = np.searchsorted(x[s], np.arange(257)) if len(s) else np.zeros(257, np.int64)
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(positions: np.ndarray, here: int) -> np.ndarray:
        before = positions[positions > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return before
        symbol = x[before]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        cuts = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
        own = np.zeros(0, np.int64)
        for a, b in zip(cuts, [*cuts[1:], len(symbol)], strict=True):
            if symbol[a] == here:
                own = before[a:b]
            else:
                induced[symbol[a]].append(before[a:b])
        return own

    out: list[np.ndarray] = []
    # the last suffix has no successor: it is the first of its bucket
    induced[x[-1]].append(np.array([n - 1]))
    for c in range(256):
        todo = induced[c]
        while todo:
            part = todo.pop(0)
            out.append(part)
            own = induce(part, c)
            if len(own):
                todo.append(own)
        mine = s[first[c]:first[c + 1]]
        if len(mine):
            out.append(mine)
            induce(mine, c)
    return np.concatenate(out)


def window_hash(x: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """64-bit hash of the ``length`` bytes from each position (fewer at the end)."""
    start = np.arange(len(x))
    return span_hash(x, start, np.minimum(start + length, len(x)), lower=False, seed=seed)


def repeated(x: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Which of the positions ``start`` begin ``length`` symbols that begin at another of them too."""
    chosen = np.full(len(x), -1, np.int64)
    chosen[start] = np.arange(len(start))
    order = suffix_array(x, length)
    order = order[chosen[order] >= 0]
    common = np.ones(max(len(order) - 1, 0), bool)
    word = np.concatenate([_words8(x), np.zeros(length + 8, np.uint64)])
    at = np.arange(len(common))
    for d in range(0, length, 8):  # common prefix of neighbours, eight symbols at a time, while it lasts
        step = min(d, length - 8)
        same = word[order[at] + step] == word[order[at + 1] + step]
        common[at[~same]] = False
        at = at[same]
    out = np.zeros(len(start), bool)
    out[chosen[order[:-1][common]]] = True
    out[chosen[order[1:][common]]] = True
    return out


# ---------------------------------------------------------------- segments


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours (len(h) - width + 1 numbers)."""
    n = len(h) - width + 1
    pad = -len(h) % width
    full = np.concatenate([h, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, 1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def segments(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, lo, hi, key, own): runs of window starts lo .. hi (in ``data``) with one key, at most ``length`` starts each.

    ``own``: a window may occur twice inside the segment.  Then its key's first gram lies between the
    two starts, so a window other than the last starts with the key's gram.
    """
    base, end = int(at[0]), int(at[-1])
    none = np.zeros(0, np.int64)
    if end - base < length:
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    size = min(GRAM, length // 4)
    gram = np.arange(base, end - size + 1)
    h = span_hash(data, gram, gram + size, lower=False)
    key = _sliding_min(h, length - size + 1)
    p = np.arange(base, base + len(key))
    row = np.searchsorted(at, p, "right") - 1
    inside = p + length <= at[row + 1]
    new = np.ones(len(p), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    began = np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))
    new |= (np.arange(len(p)) - began) % length == 0
    lo = np.flatnonzero(new)
    hi = np.concatenate([lo[1:], [len(p)]]) - 1
    # windows that would cross the end of a text are the last of its positions
    last = np.where(inside[lo], np.minimum(hi, at[row[lo] + 1] - length - base), -1)
    ok = last >= lo
    lo, last = lo[ok], last[ok]
    begins = np.concatenate([[0], np.cumsum(h[:len(key)] == key)])
    return row[lo], p[lo], p[last], key[lo], begins[last] > begins[lo]


_SEGMENT = "key bigint, s1 bigint, s2 bigint, c1 bigint, c2 bigint, lo bigint, hi bigint, own boolean"


def _find(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(2))
            for lo, hi in runs(at, CHUNK):
                row, a, b, key, own = segments(data, at[lo:hi + 1], length)
                columns = [key.view(np.int64), *(span_hash(data, a, b + length, lower=False, seed=s).view(np.int64) for s in (0, 1))]
                yield pa.RecordBatch.from_arrays([
                    *(pa.array(c) for c in columns), batch.column(0)[lo:hi].take(pa.array(row)), batch.column(1)[lo:hi].take(pa.array(row)),
                    pa.array(a - at[lo + row]), pa.array(b - at[lo + row]), pa.array(own)], ["key", "s1", "s2", "c1", "c2", "lo", "hi", "own"])
    return run


def _cut(length: int):
    """Bytes of the wanted segments of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(2))
            out: tuple[list, ...] = ([], [], [], [], [])
            size = 0
            for i, wanted in enumerate(batch.column(3)):
                for w in wanted.as_py():
                    part = data[at[i] + w["lo"]:at[i] + w["hi"] + length].tobytes()
                    for column, v in zip(out, (w["key"], i, w["lo"], w["hi"], part), strict=True):
                        column.append(v)
                    size += len(part)
                if size > TASK_BYTES or i == batch.num_rows - 1:
                    rows = pa.array(out[1], pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.binary())], ["key", "c1", "c2", "lo", "hi", "part"])
                    out, size = ([], [], [], [], []), 0
    return run


def _intervals(c1: np.ndarray, c2: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of consecutive starts of one segment as [a, b) of covered bytes."""
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1] + 1) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])
    lo = np.flatnonzero(new)
    hi = np.concatenate([lo[1:], [len(start)]]) - 1 if len(lo) else lo
    return pa.RecordBatch.from_arrays([pa.array(c1[lo]), pa.array(c2[lo]), pa.array(start[lo]), pa.array(start[hi] + length)], ["c1", "c2", "a", "b"])


def _sorted(length: int):
    """Rows arrive by key; whole keys are gathered to about a task's bytes and sorted together."""
    def flush(rows: list[tuple]) -> pa.RecordBatch:
        parts = [np.frombuffer(r[5], np.uint8) for r in rows]
        at = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        x = np.zeros(at[-1], np.uint8)
        starts, owner = [], []
        for i, part in enumerate(parts):
            x[at[i]:at[i] + len(part)] = part + np.uint8(1)  # UTF-8 has no byte 255: 0 stands between segments
            n = rows[i][4] - rows[i][3] + 1
            starts.append(at[i] + np.arange(n))
            owner.append(np.full(n, i))
        start, own = np.concatenate(starts), np.concatenate(owner)
        hit = repeated(x, start, length)
        start, own = start[hit], own[hit]
        c1, c2, lo = (np.array([r[j] for r in rows], np.int64) for j in (1, 2, 3))
        return _intervals(c1[own], c2[own], lo[own] + start - at[own], length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, key = 0, None
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[0] != key and size > TASK_BYTES:
                    yield flush(rows)
                    rows, size = [], 0
                key = r[0]
                rows.append(r)
                size += len(r[5])
        if rows:
            yield flush(rows)
    return run


def _hashed(length: int):
    """Every window of a hot key by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, c1, c2, lo, hi, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = np.frombuffer(part, np.uint8)
                n = hi - lo + 1
                h = [window_hash(x, length, seed)[:n].view(np.int64) for seed in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(h[0]), pa.array(h[1]), pa.array(np.full(n, c1)), pa.array(np.full(n, c2)), pa.array(lo + np.arange(n))], ["h1", "h2", "c1", "c2", "p"])
    return run


def covered(rows: DataFrame, length: int, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """(c1, c2, a, b): byte ranges to remove, per class of equal texts; ``rows``: (doc, c1, c2, t, n_bytes)."""
    classes = rows.groupBy("c1", "c2").agg(F.count("*").alias("copies"), F.min("doc").alias("doc"), F.max("n_bytes").alias("n_bytes"))
    classes = stored(classes, "classes")
    whole = classes.where((F.col("copies") > 1) & (F.col("n_bytes") >= length)).select("c1", "c2", F.lit(0).cast("bigint").alias("a"), F.col("n_bytes").alias("b"))

    found = stored(rows.where(F.col("n_bytes") >= length).select("c1", "c2", "t").mapInArrow(_find(length), _SEGMENT), "segments")
    place = F.struct("c1", "c2", "lo", "hi")
    contents = found.groupBy("key", "s1", "s2").agg(F.min(place).alias("p"), F.max(place).alias("q"), F.max("own").alias("own"))
    contents = stored(contents.select("key", "s1", "s2", "p", (F.col("p") != F.col("q")).alias("twice"), "own"), "contents")
    full = found.join(contents.where("twice").select("key", "s1", "s2"), ["key", "s1", "s2"], "left_semi").select("c1", "c2", F.col("lo").alias("a"), (F.col("hi") + length).alias("b")).distinct()

    keys = contents.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("p.hi") - F.col("p.lo") + length).alias("bytes"), F.max("own").alias("own")).where("n > 1 or own").select("key", (F.col("bytes") > hot_bytes).alias("hot"))
    keys = stored(keys, "keys")
    wanted = contents.join(keys.select("key"), "key", "left_semi").select("p.c1", "p.c2", F.struct("key", "p.lo", "p.hi").alias("w"))
    wanted = wanted.groupBy("c1", "c2").agg(F.collect_list("w").alias("w")).join(classes.select("c1", "c2", "doc"), ["c1", "c2"])
    wanted = stored(wanted, "wanted")
    marks = bitmap(wanted, "c1")
    texts = rows.where(in_bitmap(marks, F.col("c1"))).select("c1", "c2", "doc", "t").withColumnRenamed("doc", "d")
    one = texts.join(wanted, ["c1", "c2"]).where(F.col("d").eqNullSafe(F.col("doc"))).select("c1", "c2", "t", "w")
    parts = one.mapInArrow(_cut(length), "key bigint, c1 bigint, c2 bigint, lo bigint, hi bigint, part binary")
    if keys.where("hot").take(1):
        parts = stored(parts.join(keys, "key"), "parts")
        cold, hot = parts.where("not hot").drop("hot"), parts.where("hot").drop("hot")
        window = stored(hot.mapInArrow(_hashed(length), "h1 bigint, h2 bigint, c1 bigint, c2 bigint, p bigint"), "windows")
        at = F.struct("c1", "c2", "p")
        twice = window.groupBy("h1", "h2").agg(F.min(at).alias("x"), F.max(at).alias("y")).where("x <> y").select("h1", "h2")
        extra = window.join(twice, ["h1", "h2"], "left_semi").select("c1", "c2", F.col("p").alias("a"), (F.col("p") + length).alias("b"))
    else:
        cold, extra = parts, None
    order = ["key", "c1", "c2", "lo"]
    ranges = cold.repartition("key").sortWithinPartitions(*order).mapInArrow(_sorted(length), "c1 bigint, c2 bigint, a bigint, b bigint")
    ranges = whole.unionByName(full).unionByName(ranges)
    return ranges.unionByName(extra) if extra is not None else ranges


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = text_bytes(batch.column(1))
        out: tuple[list, ...] = ([], [], [], [])
        for i, ranges in enumerate(batch.column(2)):
            text = data[at[i]:at[i + 1]].tobytes()
            kept, spans, removed, end, since = [], 0, 0, 0, 0
            for a, b in sorted((r["a"], r["b"]) for r in (ranges.as_py() or [])):
                if spans == 0 or a > end:
                    kept.append(text[end:a])
                    spans, since = spans + 1, a
                    removed -= a
                    removed += b
                    end = b
                elif b > end:
                    removed += b - end
                    end = b
            kept.append(text[end:])
            for column, v in zip(out, (len(text), removed, spans, hashlib.sha256(b"".join(kept)).hexdigest()), strict=True):
                column.append(v)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())], ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept_sha256): a row per row of ``docs``."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("doc"), body.alias("t"))
    rows = rows.select("doc", F.xxhash64("t").alias("c1"), F.xxhash64(F.lit(17), "t").alias("c2"), "t", F.octet_length("t").cast("bigint").alias("n_bytes"))
    ranges = stored(covered(rows, length).groupBy("c1", "c2").agg(F.collect_list(F.struct("a", "b")).alias("r")), "ranges")
    marks = bitmap(ranges, "c1")
    touched = in_bitmap(marks, F.col("c1"))
    changed = rows.where(touched).join(ranges, ["c1", "c2"], "left").select("doc", "t", "r").mapInArrow(
        _apply, rows.select("doc", "n_bytes", F.col("n_bytes").alias("n_removed"), F.col("n_bytes").alias("n_spans"), F.col("t").alias("kept_sha256")).schema)
    zero = F.lit(0).cast("bigint")
    same = rows.where(~touched).select("doc", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(F.col("t").cast("binary"), 256).alias("kept_sha256"))
    return same.unionByName(changed)
