"""Best-fit packing of tokenised documents into sequences by bin completion.

Documents become token ids and an end token; only those longer than a sequence are cut.  What the
packing decides depends on lengths alone, so it is decided on the histogram of lengths: at most
``LENGTH`` numbers, whatever the input.  The plan is a list of fillings with multiplicities:

* incumbent: best-fit decreasing on the histogram (all pieces of a length at once);
* bin completion: the largest remaining length is completed by a maximal filling, over all counts of
  each size within the limits of ``fillings``, least waste first;
  a branch is cut when its waste exceeds what a better solution could still waste;
* it ends when the volume bound is met, or after ``NODES`` nodes with the better solution so far.

Pieces are then numbered within their length (counts per hash bucket, one prefix sum, one window per
bucket, so a length that holds a third of all pieces is split) and look their place up in the plan.

Defined results: null text is empty, and an empty text is the end token alone; rows that are equal
are interchangeable; an empty table gives an empty result.  The tokenizer file's path is a parameter.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadra.llm.shared import offsets, stored

LENGTH = 2048
END_ID = 0
NODES = 400
BRANCHES = 3
EXTENSIONS = 60
CACHE = 500_000
TOKENIZER = "byte_bpe_50k.json"


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


# ---------------------------------------------------------------- token ids

#: Splits that byte-level BPE makes before merging (contractions, letters, digits, others, white space).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose Unicode classes every library agrees on, and no two blanks in a row: such a text may
#: be split before each blank first.  All others go to the tokenizer whole.
ODD = r"[^\t\n\r\x20-\x7e\u00a1-\u024f]|  "


class _Known(dict):
    """word -> ids, computed when first met; emptied when full."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        self[word] = ids = self.make(word)
        return ids


class Encoder:
    """Whole texts to little-endian unsigned 32-bit ids; remembers the ids of the words met."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # a text that holds an added token (``<|endoftext|>``) goes to the tokenizer whole, too
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split, self.odd = regex.compile(SPLIT).findall, re.compile("|".join([ODD, *added])).search
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
        others = [b for b in range(256) if b not in plain]
        self.table = {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(others)}}
        model = self.tokenizer.model
        self.words = _Known(lambda w: np.array([t.id for t in model.tokenize(w.encode().decode("latin-1").translate(self.table))], "<u4").tobytes(), CACHE)
        self.after_blank = _Known(lambda w: self.pieces(" " + w), CACHE)

    def pieces(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.odd(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.pieces(first) + b"".join(map(self.after_blank.__getitem__, rest))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per Python worker, so that what it remembers serves all its tasks."""
    return Encoder(path)


PIECES = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """(key, piece, start, length, ids_crc32): every document's ids and its end token, cut only if longer than ``length``."""
    schema = T.StructType([docs.schema[key], *PIECES])
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows, out = [], ([], [], [], [])
            for i, value in enumerate(batch.column(1)):
                ids = encode(value.as_py() or "") + end
                n = len(ids) // 4
                first = n if n <= length else (n - 1) % length + 1
                for piece, stop in enumerate(range(first, n + 1, length)):
                    start = 0 if piece == 0 else stop - length
                    rows.append(i)
                    for column, x in zip(out, (piece, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), pa.array(out[0], pa.int32()), *(pa.array(x, pa.int64()) for x in out[1:])], schema.names)

    return docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(cut, schema)


# ---------------------------------------------------------------- the plan on the histogram


def best_fit(sizes: Counter, room: int) -> list[tuple[int, tuple]]:
    """[(bins, ((size, count), ...))]: best-fit decreasing, equal pieces at once."""
    open_: dict[int, list[list]] = {}  # space left -> [bins, filling]
    done: list[tuple[int, tuple]] = []

    def put(bins: int, left: int, filling: tuple) -> None:
        if left:
            open_.setdefault(left, []).append([bins, filling])
        else:
            done.append((bins, filling))

    for size in sorted(sizes, reverse=True):
        n = sizes[size]
        for left in sorted(x for x in open_ if x >= size):
            each = left // size
            groups = open_.pop(left)
            while groups and n >= each:
                bins, filling = groups.pop()
                use = min(bins, n // each)
                if use < bins:
                    groups.append([bins - use, filling])
                put(use, left - each * size, (*filling, (size, each)))
                n -= use * each
            if groups and n:  # fewer than fill one bin
                bins, filling = groups.pop()
                if bins > 1:
                    groups.append([bins - 1, filling])
                put(1, left - n * size, (*filling, (size, n)))
                n = 0
            for bins, filling in groups:
                put(bins, left, filling)
            if not n:
                break
        each = room // size
        if n // each:
            put(n // each, room - each * size, ((size, each),))
        if n % each:
            put(1, room - n % each * size, ((size, n % each),))
    return done + [(bins, filling) for groups in open_.values() for bins, filling in groups]


def fillings(sizes: list[int], have: Counter, room: int, most: int) -> list[tuple]:
    """Undominated fillings of ``room``, least waste first, larger pieces first: (size, count) pairs of remaining sizes, descending.

    Every filling is maximal.  Of each size all counts are tried, from the greatest down to none, but for those
    after which all smaller pieces together leave room for one more.  Limits: ``most`` sizes at a place and
    ``EXTENSIONS`` in all, of which no branch gets more than half of what is left; one branch is always completed.
    """
    found: dict[tuple, int] = {}
    below = [0] * (len(sizes) + 1)  # volume of the sizes from a place on
    for i in range(len(sizes) - 1, -1, -1):
        below[i] = below[i + 1] + sizes[i] * have[sizes[i]]

    def largest(limit: int) -> int:
        lo, hi = 0, len(sizes)  # descending
        while lo < hi:
            mid = (lo + hi) // 2
            if sizes[mid] <= limit:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def extend(at: int, left: int, filling: tuple, budget: int) -> int:
        at = max(at, largest(left))
        tried = 0
        while at < len(sizes) and (not tried or budget > 0) and tried < most:
            size = sizes[at]
            n = min(have[size], left // size)
            for count in range(n, 0, -1):
                if count < n and (budget <= 0 or left - count * size - below[at + 1] >= size):
                    break
                share = (budget + 1) // 2
                budget += extend(at + 1, left - count * size, (*filling, (size, count)), share - 1) - share
                if filling == () and count == 1 and size == room:  # one piece that fits exactly dominates all others
                    return 0
            if n > 0:
                tried += 1
                if left - below[at + 1] >= size:
                    break
            at += 1
        if not tried:
            taken = dict(filling)
            if all(have[s] == taken.get(s, 0) for s in sizes[largest(left):]):
                found[filling] = left
        return budget

    extend(0, room, (), EXTENSIONS)
    return [f for f, _ in sorted(found.items(), key=lambda x: (x[1], [(-s, -n) for s, n in x[0]]))]


def complete(sizes: Counter, room: int, best: int, nodes: int = NODES, branches: int = BRANCHES) -> list[tuple[int, tuple]] | None:
    """A plan of fewer than ``best`` bins by bin completion, or None if the search finds none.

    The search is limited: ``branches`` fillings at a node, each repeated as often as the pieces allow, ``nodes``
    nodes that branch, and the limits of :func:`fillings`.  None does not prove that there is none.
    """
    total = sum(s * n for s, n in sizes.items())
    spent = 0

    def search(have: Counter, waste: int, bins: int) -> list | None:
        nonlocal spent
        plan: list[tuple[int, tuple]] = []
        while True:
            left = sorted((s for s, n in have.items() if n), reverse=True)
            if not left:
                return plan if bins < best else None
            spent += 1
            if waste > (best - 1) * room - total or spent > nodes * 50:
                return None
            top = left[0]
            options = fillings(left, have - Counter({top: 1}), room - top, branches)
            if len(options) > 1 and spent < nodes:
                for option in options[:branches]:
                    use, after = _apply(have, top, option)
                    rest = search(after, waste + use * (room - top - sum(s * n for s, n in option)), bins + use)
                    if rest is not None:
                        return [*plan, (use, _merge(top, option)), *rest]
                    if spent >= nodes:
                        break
                return None
            option = options[0] if options else ()
            use, have = _apply(have, top, option)
            plan.append((use, _merge(top, option)))
            waste, bins = waste + use * (room - top - sum(s * n for s, n in option)), bins + use

    return search(Counter(sizes), 0, 0)


def _merge(top: int, option: tuple) -> tuple:
    need = Counter({top: 1})
    for s, n in option:
        need[s] += n
    return tuple(sorted(need.items(), reverse=True))


def _apply(have: Counter, top: int, option: tuple) -> tuple[int, Counter]:
    """How often the filling can be repeated, and what is left then."""
    need = dict(_merge(top, option))
    use = min(have[s] // n for s, n in need.items())
    after = Counter(have)
    for s, n in need.items():
        after[s] -= use * n
    return use, after


def plan_bins(sizes: Counter, room: int) -> list[tuple[int, tuple]]:
    """The better of best-fit decreasing and bin completion; pieces as long as the room need no search."""
    rest = Counter({s: n for s, n in sizes.items() if s < room and n})
    plan = best_fit(rest, room)
    bins, bound = sum(b for b, _ in plan), -(-sum(s * n for s, n in rest.items()) // room)
    if bins > bound:
        plan = complete(rest, room, bins) or plan
    return ([(sizes[room], ((room, 1),))] if sizes.get(room) else []) + plan


def slots(plan: list[tuple[int, tuple]]) -> np.ndarray:
    """Rows (size, first rank, first sequence, offset, count per sequence), sorted by size and first rank."""
    used: Counter = Counter()
    out, sequence = [], 0
    for bins, filling in plan:
        offset = 0
        for size, n in filling:
            out.append((size, used[size], sequence, offset, n))
            used[size] += bins * n
            offset += size * n
        sequence += bins
    return np.array(sorted(out), np.int64).reshape(-1, 5)


# ---------------------------------------------------------------- Spark


def pack(docs: DataFrame, tokenizer: str | None = None, text: str = "text", key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset): every piece's place."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer or default_tokenizer(), text, key, length).withColumn("_b", F.xxhash64(key, "piece", "ids_crc32")), "pieces")
    total = cut.count()
    bucket: Column = F.pmod(F.col("_b"), F.lit(max(1, total // 100_000 + 1)))
    table = cut.withColumn("_b", bucket)
    counts = table.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    histogram = Counter({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()})
    where = spark.sparkContext.broadcast(slots(plan_bins(histogram, length)))
    before = offsets(counts, ["length"], "_b", "_n", "_before").select("length", "_b", "_before")
    rank = F.row_number().over(Window.partitionBy("length", "_b").orderBy(key, "piece", "ids_crc32")) - 1
    ranked = table.withColumn("_r", rank).join(before, ["length", "_b"]).select(key, "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_r")).cast("long").alias("_r"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = where.value
        starts = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            size, r = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            s = table[np.searchsorted(starts, size << 44 | r, "right") - 1] if len(r) else table[:0]
            nth = r - s[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(s[:, 2] + nth // s[:, 4]), pa.array(s[:, 3] + nth % s[:, 4] * size)], [*batch.schema.names[:5], "sequence_id", "offset"])

    schema = T.StructType([*[f for f in ranked.schema.fields if f.name != "_r"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)
