"""Near-duplicates by HyperMinHash: banded compressed registers, corrected estimates, exact confirmation.

A document's set: hashes (64 bits) of its distinct ``k``-word shingles (words: stretches without white space, A-Z
lowered; fewer than ``k`` words: the whole sequence as one).  Two sets link when ``100 * common >= percent * union``.

**Sketch.**  Shingles are dealt to ``BANDS * WIDTH`` buckets by hash.  A bucket's register keeps its least second hash
in compressed form: the count of leading zeros and ``MANTISSA`` bits behind the first one, 16 bits in all.  Equal
sets (128-bit identity) become one node.

**Banding.**  ``WIDTH`` neighbouring registers are a band; nodes with an equal band share a key.  Two linked sets share
a register with a probability of at least ``percent`` / 100, so at 80 % a band with 0.26, at 85 % with 0.38; all 48 bands are
missed with less than 6e-7 and 2e-10 for large sets on the very threshold.  Sets of up to about 200 shingles cannot be
missed as long as they fill more bands than they have differing shingles: each differing shingle spoils one band.

**Bound.**  Shingles that no other node with a shared key has cannot be common to a pair.  One count of shingles over
these nodes (a share of them, chosen by hash, for sets of more than ``COUNTED``) tells how many of a node's shingles are
its own; a node with too many of them links with nobody and goes.  Documents that share just a passage end here.

**Groups, not pairs.**  The node whose keys are the most common leads a key; every node is compared with the leads of
its keys, and what links is a component.  A group of thousands of near copies costs one comparison a member and key.
Only then nodes outside their lead's component (the minority) meet the rest of the key's nodes, in other components,
as far as sizes and the bound allow.  In keys of more than ``SMALL`` nodes the bound is closer: a pair either shares a
shingle that ``FEW`` nodes of such keys have at most, and is found by it, or what it shares are common shingles alone,
and a node with too few of those meets nobody.  A last bound sits in the join itself: two sets differ in at least as many
shingles as their parity bits (``PARITY`` of them) differ.

**Estimate.**  A pair's registers give ``(matches - expected accidental matches) / used`` (registers agree by accident
with a probability that the set sizes fix).  Pairs are dropped that lie eight deviations below the threshold, or that
differ in more registers than two linked sets of their sizes can have differing shingles.

**Confirmation** on the full sets of both texts; components follow by star contraction.

Defined results: null and empty texts have no shingles and link with nothing; rows with equal sets are one node,
however many they are; a component is named by its smallest key (nulls first; keys are whole
numbers).  Other columns are not touched.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra.llm.components import components
from quadra.llm.shared import MULT, distinct_by_row, if_small, mix, runs, shingles, stored, text_bytes

BANDS, WIDTH = 48, 6
REGISTERS = BANDS * WIDTH
MANTISSA = 10
PARITY = 512
EMPTY = np.uint16(0xFFFF)
CHUNK, CHUNK_ROWS = 1 << 20, 1 << 12
#: Sets of at most so many shingles are counted whole, larger ones by a sample of between half and all of this number.
COUNTED = 256
#: Keys of at most so many nodes compare their minority with all others at once; in larger ones shingles of at most FEW nodes are told apart.
SMALL, FEW = 32, 8
#: Up to so many nodes, a node table of 24 bytes a row is broadcast to the texts.
BROADCAST_NODES = 200_000
_SALTS = np.random.default_rng(1207).integers(1, 2**64 - 1, BANDS + 2, dtype=np.uint64)


# ---------------------------------------------------------------- sketches


def registers(h: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """(rows, REGISTERS) compressed registers of the hashes ``h`` of the rows ``owner``."""
    with np.errstate(over="ignore"):
        g = mix(h + _SALTS[0])
        bucket = ((g >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
        v = mix(g + _SALTS[1])
    least = np.full(rows * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, owner * REGISTERS + bucket.astype(np.int64), v)
    part, size = np.frexp((least >> np.uint64(11)).astype(np.float64))  # 53 bits: exact
    zeros = 53 - size
    mantissa = ((2 * part - 1) * (1 << MANTISSA)).astype(np.int64)
    code = np.where(least >> np.uint64(11) > 0, (zeros << MANTISSA) | mantissa, 53 << MANTISSA)
    used = least < np.iinfo(np.uint64).max
    return np.where(used, code, int(EMPTY)).astype(np.uint16).reshape(rows, REGISTERS)


def band_keys(sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit key of every band with a used register, and the band's row."""
    bands = sketch.reshape(-1, BANDS, WIDTH).astype(np.uint64)
    used = (bands != np.uint64(EMPTY)).any(2)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(_SALTS[2:], used.shape).copy()
        for j in range(WIDTH):
            key = mix(key * MULT + bands[:, :, j])
    row, _ = np.nonzero(used)
    return key[used], row


@cache
def _accidental(octave: int) -> float:
    """Probability that the registers of two sets of 2**(octave / 4) other shingles agree in a bucket."""
    edge = np.concatenate([2.0 ** -(z + 1) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA)) for z in range(53, -1, -1)] + [np.ones(1)])
    tail = np.exp(-edge * 2.0 ** (octave / 4) / REGISTERS)
    return float(((tail[:-1] - tail[1:]) ** 2).sum())


def estimates(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Jaccard similarity by the registers of rows x and y, corrected for accidental matches; matches; used registers."""
    used = (x != EMPTY) | (y != EMPTY)
    same = ((x == y) & used).sum(1)
    used = used.sum(1)
    octave = np.rint(2 * np.log2(np.maximum(nx, 1).astype(float) * np.maximum(ny, 1))).astype(int)
    chance = np.array([_accidental(int(o)) for o in octave]) if len(octave) else np.zeros(0)
    return (same - REGISTERS * chance) / np.maximum(used, 1), same, used


def _text(docs: DataFrame, text: str) -> Column:
    return F.col(f"`{text}`").cast("string")


def _row(docs: DataFrame, text: str, key: str) -> list[Column]:
    """Key, row hash and text: key and hash together name a row up to equal rows."""
    return [F.col(f"`{key}`").cast("bigint").alias("doc"), F.xxhash64(F.col(f"`{key}`"), _text(docs, text)).alias("rid"), _text(docs, text).alias("t")]


def signatures(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5) -> DataFrame:
    """(doc, rid, n, h0, h1, sketch, parity) of every row: set size, 128-bit identity of the set, registers, parity bits."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(2))
            for first, last in runs(at, CHUNK):
                for lo in range(first, last, CHUNK_ROWS):
                    hi = min(last, lo + CHUNK_ROWS)
                    h, row = distinct_by_row(*shingles(data, at[lo:hi + 1], k))
                    n = np.diff(row)
                    owner = np.repeat(np.arange(hi - lo), n)
                    full = np.flatnonzero(n)
                    ids = np.zeros((2, hi - lo), np.uint64)
                    if len(full):
                        with np.errstate(over="ignore"):
                            ids[0, full] = np.add.reduceat(mix(h ^ _SALTS[0]), row[:-1][full])
                            ids[1, full] = np.add.reduceat(mix(h ^ _SALTS[1]), row[:-1][full])
                    sketch = registers(h, owner, hi - lo)
                    bit = (mix(h ^ _SALTS[2]) % np.uint64(PARITY)).astype(np.int64)
                    odd = np.bincount(owner * PARITY + bit, minlength=(hi - lo) * PARITY).astype(np.uint8) & 1
                    parity = np.packbits(odd.reshape(hi - lo, PARITY), axis=1).view(np.int64)
                    width = REGISTERS * sketch.itemsize
                    held = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((np.arange(hi - lo + 1) * width).astype(np.int32)), pa.py_buffer(sketch.tobytes())])
                    yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(n.astype(np.int32)), pa.array(ids[0].view(np.int64)), pa.array(ids[1].view(np.int64)), held,
                                                      pa.ListArray.from_arrays(pa.array((np.arange(hi - lo + 1) * (PARITY // 64)).astype(np.int32)), pa.array(parity.ravel()))],
                                                     ["doc", "rid", "n", "h0", "h1", "sketch", "parity"])

    rows = docs.select(*_row(docs, text, key))
    return stored(rows.mapInArrow(sign, "doc bigint, rid bigint, n int, h0 bigint, h1 bigint, sketch binary, parity array<bigint>"), "sketches")


# ---------------------------------------------------------------- candidates


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(lo, CHUNK_ROWS)
            key, row = band_keys(_sketches(part.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part.column(0).take(pa.array(row))], ["key", "node"])


def _bands(heads: DataFrame) -> DataFrame:
    """(key, node): the bands that two nodes or more have."""
    keyed = heads.select("node", "sketch").mapInArrow(_keys, "key bigint, node bigint")
    common = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    return stored(keyed.join(common, "key"), "bands")


def _led(bands: DataFrame) -> DataFrame:
    """(key, node, c, lead): bands of c nodes (two or more), each with the node whose bands are the most common."""
    common = bands.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    met = stored(bands.join(common, "key"), "met")
    weight = met.groupBy("node").agg(F.sum(F.log2("c")).alias("w"))
    lead = met.join(weight, "node").groupBy("key").agg(F.max(F.struct("w", "node")).alias("m")).select("key", F.col("m.node").alias("lead"))
    return stored(met.join(lead, "key"), "keys")


def halvings(n: np.ndarray) -> np.ndarray:
    """How often the share of counted shingles is halved for sets of n: the least j with COUNTED * 2**j >= n."""
    return np.maximum(np.frexp(np.maximum(n - 1, 0).astype(float))[1] - (COUNTED.bit_length() - 1), 0).astype(np.uint64)


def _able(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, s): the nodes of ``texts`` (node, n, t) that may link with another one; at most s of a node's shingles are shared.

    A partner can be larger by ``100 / percent`` and so be sampled more thinly: a node spells out its own share but
    counts only what its largest partner spells out too.  Up to ``COUNTED`` shingles the count is exact; a sampled one drops
    a node only eight deviations beyond what a link allows.
    """
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(2))
            size = batch.column(1).to_numpy().astype(np.int64)
            for lo, hi in runs(at, CHUNK):
                h, row = distinct_by_row(*shingles(data, at[lo:hi + 1], k))
                owner = np.repeat(np.arange(hi - lo), np.diff(row))
                n = size[lo:hi][owner]
                top = mix(h ^ _SALTS[1]) >> np.uint64(1)  # 63 bits
                some = top >> (np.uint64(63) - halvings(n)) == 0
                counted = top >> (np.uint64(63) - halvings(n * 100 // percent + 1)) == 0
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi].take(pa.array(owner[some])), pa.array(h[some].view(np.int64)), pa.array(counted[some].astype(np.int8))], ["node", "tok", "counted"])

    tokens = texts.select("node", "n", "t").mapInArrow(spell, "node bigint, tok bigint, counted tinyint")
    alone = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node"), F.max("counted").alias("counted")).where("c = 1 and counted = 1")
    own = alone.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    rate = F.pow(F.lit(0.5), F.greatest(F.length(F.bin(F.expr(f"n * 100 div {percent}"))) - (COUNTED.bit_length() - 1), F.lit(0)))
    left = (100 - percent) / 100 * F.col("n") * rate
    out = texts.select("node", "n").join(own, "node", "left").na.fill(0, ["own"])
    s = F.when(rate == 1, F.col("n") - F.col("own")).when(F.col("own") <= left + 8 * F.sqrt(left), F.col("n")).otherwise(0)
    return stored(out.withColumn("s", s.cast("int")).where(f"100 * s >= {percent} * n").select("node", "s"), "able")


def _confirmed(pairs: DataFrame, heads: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets link."""
    side = lambda x: heads.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(f"100 * na >= {percent} * nb and 100 * nb >= {percent} * na").select("a", "b", "na", "nb", "sa", "sb")
    p = percent / 100

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(lo, CHUNK_ROWS)
                na, nb = (part.column(i).to_numpy().astype(np.int64) for i in (2, 3))
                est, same, used = estimates(_sketches(part.column(4)), _sketches(part.column(5)), na, nb)
                ok = (est >= p - 8 * np.sqrt(p * (1 - p) / np.maximum(used, 1))) & ((100 + percent) * (used - same) <= (100 - percent) * (na + nb))
                yield pa.RecordBatch.from_arrays([part.column(i).filter(pa.array(ok)) for i in (0, 1)], ["a", "b"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            da, at = text_bytes(batch.column(2))
            db, bt = text_bytes(batch.column(3))
            ok = np.zeros(batch.num_rows, bool)
            for lo, hi in runs(at + bt, CHUNK):
                x, xr = distinct_by_row(*shingles(da, at[lo:hi + 1], k))
                y, yr = distinct_by_row(*shingles(db, bt[lo:hi + 1], k))
                owner = np.concatenate([np.repeat(np.arange(hi - lo), np.diff(r)) for r in (xr, yr)])
                h, owner = distinct_pairs(np.concatenate([x, y]), owner)
                total = np.diff(xr) + np.diff(yr)
                union = np.bincount(owner, minlength=hi - lo)
                ok[lo:hi] = (100 * (total - union) >= percent * union) & (union > 0)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], ["a", "b"])

    likely = stored(both.mapInArrow(near, "a bigint, b bigint"), "likely")
    read = likely.join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a").join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b")
    return stored(read.select("a", "b", "ta", "tb").mapInArrow(check, "a bigint, b bigint"), "linked")


def distinct_pairs(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, h)."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[keep], owner[keep]


def _spelled(texts: DataFrame, k: int) -> DataFrame:
    """(tok, node): the distinct shingles of every node."""
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            for lo, hi in runs(at, CHUNK):
                h, row = distinct_by_row(*shingles(data, at[lo:hi + 1], k))
                of = batch.column(0)[lo:hi].take(pa.array(np.repeat(np.arange(hi - lo), np.diff(row))))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), of], ["tok", "node"])

    return texts.select("node", "t").mapInArrow(spell, "tok bigint, node bigint")


def _between(keys: DataFrame, root: DataFrame, heads: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): nodes of different components that share a key whose lead settled neither, as far as bounds allow a link."""
    named = keys.join(root, "node", "left").withColumn("comp", F.coalesce("root", "node")).select("key", "node", "lead", "c", "comp").join(heads.select("node", "n", "s", "parity"), "node")
    named = stored(named, "named")
    main = named.where("node = lead").select("key", F.col("comp").alias("main"))
    minority = stored(named.join(main, "key").where("comp <> main").drop("lead", "main"), "minority")
    rest = named.join(minority.select("key").distinct(), "key", "left_semi").join(main, "key").withColumn("inside", F.col("comp") == F.col("main"))
    rest = stored(rest.select("key", "node", "n", "s", "parity", "c", "comp", "inside"), "rest")
    large = f"c > {SMALL}"

    # shingles in the large keys: of one node alone, of few, of many
    tokens = stored(_spelled(texts.join(rest.where(large).select("node").distinct(), "node", "left_semi"), k), "shingles")
    count = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node"))
    own = count.where("c = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    wanted = minority.where(large).select("node", "n", "s", "comp").distinct()
    few = stored(tokens.join(wanted.select("node"), "node", "left_semi").join(count.where(f"c between 2 and {FEW}").select("tok"), "tok"), "few")
    many = wanted.join(own, "node", "left").join(few.groupBy("node").agg(F.count(F.lit(1)).alias("few")), "node", "left").na.fill(0, ["own", "few"])
    many = stored(many.select("node", "n", "s", "comp", (F.col("n") - F.col("own") - F.col("few")).cast("int").alias("m")), "many")
    fits = f"100 * x.n >= {percent} * y.n and 100 * y.n >= {percent} * x.n"
    pair = [F.col("x.node").alias("a"), F.col("y.node").alias("b")]

    # by a shingle of few nodes: all they share of those, and all common ones, bound the overlap
    others = tokens.join(few.select("tok").distinct(), "tok", "left_semi").join(rest.where(large).select("node", "n", "s", "comp").distinct(), "node")
    shared = few.join(many, "node").alias("x").join(others.alias("y"), (F.col("x.tok") == F.col("y.tok")) & F.expr(f"x.comp <> y.comp and {fits}"))
    by_few = shared.groupBy(*pair, F.col("x.m").alias("m"), (F.col("x.n") + F.col("y.n")).alias("both")).agg(F.count(F.lit(1)).alias("g")).where(f"{100 + percent} * (m + g) >= {percent} * both")

    # by a key: the others share common shingles alone
    asking = minority.where(~F.expr(large)).select("key", "node", "n", "s", "parity", "comp").unionByName(
        minority.where(large).drop("s").join(many.select("node", F.col("m").alias("s")), "node").where(f"100 * s >= {percent} * n").select("key", "node", "n", "s", "parity", "comp"))
    apart = " + ".join(f"bit_count(x.parity[{i}] ^ y.parity[{i}])" for i in range(PARITY // 64))
    able = F.expr(f"x.comp <> y.comp and (y.inside or x.node < y.node) and {fits} and {100 + percent} * least(x.s, y.s) >= {percent} * (x.n + y.n)"
                  f" and {100 + percent} * ({apart}) <= {100 - percent} * (x.n + y.n)")
    by_key = asking.alias("x").join(rest.alias("y"), (F.col("x.key") == F.col("y.key")) & able).select(*pair)
    return by_few.select("a", "b").unionByName(by_key).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, percent: int = 80) -> DataFrame:
    """(doc, n_shingles, component): a row per row of ``docs``; ``component`` is the smallest key reachable by links."""
    signed = signatures(docs, text, key, k)
    some = signed.where("n > 0")
    heads = some.groupBy("h0", "h1", "n").agg(F.min(F.struct("doc", "rid", "sketch", "parity")).alias("x"))
    heads = stored(heads.select("h0", "h1", "n", "x.*", F.monotonically_increasing_id().alias("node")), "heads")
    bands = _bands(heads)

    met = heads.join(bands.select("node").distinct(), "node", "left_semi").select("node", "n", F.col("doc").alias("_doc"), F.col("rid").alias("_rid"))
    rows = docs.select(*_row(docs, text, key))
    texts = stored(rows.join(if_small(met, BROADCAST_NODES), F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("rid") == F.col("_rid"))).select("node", "n", "t"), "texts")
    if texts.count() > met.count():  # rows that repeat with key and text: one of each is enough
        texts = stored(texts.dropDuplicates(["node"]), "texts")
    able = _able(texts, k, percent)
    alive = stored(heads.select("node", "n", "sketch", "parity").join(able, "node"), "alive")
    texts = texts.join(able.select("node"), "node", "left_semi")
    keys = _led(bands.join(able.select("node"), "node", "left_semi"))

    star = _confirmed(keys.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct(), alive, texts, k, percent)
    root = stored(components(star), "roots")
    link = _confirmed(_between(keys, root, alive, texts, k, percent), alive, texts, k, percent)
    # what the second links join are components of the first
    for end in ("a", "b"):
        link = link.join(root.select(F.col("node").alias(end), F.col("root").alias(f"_{end}")), end, "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
    top = stored(components(link), "tops").select(F.col("node").alias("root"), F.col("root").alias("top"))

    nodes = heads.select("h0", "h1", "n", "doc", "node").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = stored(nodes.join(top, "root", "left").withColumn("top", F.coalesce("top", "root")).drop("root"), "nodes")
    first = nodes.groupBy("top").agg(F.min(F.struct("doc")).alias("m")).select("top", F.col("m.doc").alias("component"))
    named = nodes.join(first, "top").select("h0", "h1", "n", "component")
    out = some.select("doc", "h0", "h1", "n").join(named, ["h0", "h1", "n"]).select("doc", "n", "component")
    return out.unionByName(signed.where("n = 0").select("doc", "n", F.col("doc").alias("component"))).select("doc", F.col("n").cast("bigint").alias("n_shingles"), "component")


def deduplicated(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose key names its own component."""
    kept = found.where(F.col("doc").eqNullSafe(F.col("component"))).select(F.col("doc").alias("_kept_key")).distinct()
    return docs.join(kept, F.col(f"`{key}`").cast("bigint").eqNullSafe(F.col("_kept_key")), "left_semi")
