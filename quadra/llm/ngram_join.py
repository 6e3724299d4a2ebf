"""N-gram Jaccard join with a token-group matrix: exact links, connected components.

A document's set: hashes (64 bits) of its distinct ``k``-word shingles (words: stretches without
white space, A-Z lowered; fewer than ``k`` words: the whole sequence as one).  Two sets link when
``100 * common >= percent * union``.

1. One narrow pass makes each document's signature: size, set hash, 128-bit parity sketch, the prefix
   of its set in order of rarity, four min-hashes.  Rarity is a count over *all* shingles in
   ``2**SKETCH_BITS`` buckets (a fixed size, broadcast).  Equal sets become one node.
2. Similar documents are partitioned into groups: nodes with an equal min-hash are compared, exactly,
   with the most typical one among them (its shingles are the most common), and what links is a group.
   A group of thousands of near copies becomes one here, with one comparison per member.
3. The matrix: per (shingle, group) the union of the members' prefixes, kept as the longest tail and
   the least and largest size.  Only shingles of two or more groups matter.  Two groups whose bound on
   the overlap allows a link meet; only those are opened, and members meet under length, positional
   and sketch filters.  Groups that are connected already meet nowhere.
4. Pairs that are left are verified on the texts; components follow by star contraction.

Filters 2 to 4 never lose a link: prefixes of linked sets share a shingle, and two sets differ in at
least as many shingles as their parity sketches differ in bits.

Defined results: null and empty texts have no shingles and link with nothing; rows with equal sets
are one node, however many they are; a component is named by its smallest doc_id.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra.llm.components import contracted
from quadra.llm.shared import bitmap, distinct_by_row, in_bitmap, mix, runs, shingles, stored, text_bytes

SKETCH_BITS = 16
CHUNK = 1 << 20
KEYS = 4
_SALTS = np.random.default_rng(77).integers(1, 2**64 - 1, KEYS, dtype=np.uint64)


def _text(docs: DataFrame, text: str) -> Column:
    return F.col(f"`{text}`").cast("string")


def _rarity(docs: DataFrame, text: str, k: int) -> np.ndarray:
    """Occurrences of all shingles by hash bucket."""
    size = 1 << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            data, at = text_bytes(batch.column(0))
            for lo, hi in runs(at, CHUNK):
                h, _ = shingles(data, at[lo:hi + 1], k)
                total += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["b", "n"])

    rows = docs.select(_text(docs, text).alias("t")).mapInArrow(count, "b int, n bigint").groupBy("b").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[rows.column("b").to_numpy()] = rows.column("n").to_numpy()
    return out


SIGNATURE = "rid bigint, doc bigint, n int, node bigint, s0 bigint, s1 bigint, typical double, mins array<bigint>, prefix array<bigint>"


def _ragged(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int64)))


def signatures(docs: DataFrame, text: str, key: str, k: int, percent: int) -> DataFrame:
    """One row per row of ``docs``: see ``SIGNATURE``."""
    counts = docs.sparkSession.sparkContext.broadcast(_rarity(docs, text, k))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = counts.value
        for batch in batches:
            data, at = text_bytes(batch.column(2))
            for lo, hi in runs(at, CHUNK):
                h, row = distinct_by_row(*shingles(data, at[lo:hi + 1], k))
                n = np.diff(row)
                owner = np.repeat(np.arange(hi - lo), n)
                full = np.flatnonzero(n)
                common = seen[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.lexsort((h, common, owner))
                keep = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
                pos = np.arange(len(h)) - row[owner]
                chosen = order[pos < keep[owner]]
                def per_row(ufunc, x, dtype):
                    out = np.zeros(hi - lo, dtype)
                    if len(full):
                        out[full] = ufunc.reduceat(x, row[:-1][full])
                    return out
                bit = np.uint64(1) << (h & np.uint64(63))
                half = (h & np.uint64(64)) == 0
                with np.errstate(over="ignore"):
                    node = mix(per_row(np.add, h, np.uint64) ^ mix(per_row(np.bitwise_xor, mix(h), np.uint64)) + n.astype(np.uint64))
                    mins = np.stack([per_row(np.minimum, mix(h ^ salt), np.uint64) ^ np.uint64(j) for j, salt in enumerate(_SALTS)], 1)
                typical = per_row(np.add, np.log2(common + 1.0), np.float64) / np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(n.astype(np.int32)), pa.array(node.view(np.int64)),
                    pa.array(per_row(np.bitwise_xor, np.where(half, bit, np.uint64(0)), np.uint64).view(np.int64)),
                    pa.array(per_row(np.bitwise_xor, np.where(half, np.uint64(0), bit), np.uint64).view(np.int64)),
                    pa.array(typical), _ragged(mins.reshape(-1), np.arange(hi - lo + 1) * KEYS), _ragged(h[chosen], np.concatenate([[0], np.cumsum(keep)])),
                ], ["rid", "doc", "n", "node", "s0", "s1", "typical", "mins", "prefix"])

    source = docs.select(F.xxhash64(F.col(f"`{key}`"), _text(docs, text)).alias("rid"), F.col(f"`{key}`").cast("bigint").alias("doc"), _text(docs, text).alias("t"))
    return stored(source.mapInArrow(sign, SIGNATURE), "signatures")


def _alike(a: str, b: str, percent: int) -> str:
    """Length and sketch filters between two nodes."""
    return (f"100 * {a}.n >= {percent} * {b}.n and 100 * {b}.n >= {percent} * {a}.n and "
            f"{100 + percent} * (bit_count({a}.s0 ^ {b}.s0) + bit_count({a}.s1 ^ {b}.s1)) <= {100 - percent} * ({a}.n + {b}.n)")


def _verified(pairs: DataFrame, heads: DataFrame, docs: DataFrame, text: str, key: str, k: int, percent: int) -> DataFrame:
    """The pairs (x, y: structs with node and rid) that link, as (a, b) nodes.

    First the prefixes bound the overlap: what two sets share is in both prefixes, or beyond the prefix
    that ends first.  Only pairs within that bound fetch their texts.
    """
    pairs = stored(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.rid").alias("ar"), F.col("y.rid").alias("br"), F.col("x.n").alias("an"), F.col("y.n").alias("bn")).distinct(), "pairs")
    known = heads.select("node", "prefix").where(in_bitmap(bitmap(pairs.select(F.explode(F.array("a", "b")).alias("h")), "h"), F.col("node")))
    beyond = F.greatest(F.col("an") - F.size("pa"), F.col("bn") - F.size("pb"))
    pairs = pairs.join(known.toDF("a", "pa"), "a").join(known.toDF("b", "pb"), "b").where((100 + percent) * (F.size(F.array_intersect("pa", "pb")) + beyond) >= percent * (F.col("an") + F.col("bn")))
    pairs = stored(pairs.select("a", "b", "ar", "br"), "bounded")
    marks = bitmap(pairs.select(F.explode(F.array("ar", "br")).alias("h")), "h")
    rid = F.xxhash64(F.col(f"`{key}`"), _text(docs, text))
    texts = docs.select(rid.alias("rid"), _text(docs, text).alias("t")).where(in_bitmap(marks, F.col("rid")))
    both = pairs.join(texts.toDF("ar", "ta"), "ar").join(texts.toDF("br", "tb"), "br").select("a", "b", "ta", "tb")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            da, at = text_bytes(batch.column(2))
            db, bt = text_bytes(batch.column(3))
            ok = np.zeros(batch.num_rows, bool)
            for lo, hi in runs(at + bt, CHUNK):
                x, xr = distinct_by_row(*shingles(da, at[lo:hi + 1], k))
                y, yr = distinct_by_row(*shingles(db, bt[lo:hi + 1], k))
                owner = np.concatenate([np.repeat(np.arange(hi - lo), np.diff(r)) for r in (xr, yr)])
                h = np.concatenate([x, y])
                order = np.lexsort((h, owner))
                same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
                common = np.bincount(owner[order][1:][same], minlength=hi - lo)
                union = np.diff(xr) + np.diff(yr) - common
                ok[lo:hi] = (100 * common >= percent * union) & (union > 0)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], ["a", "b"])

    return stored(both.mapInArrow(check, "a bigint, b bigint").distinct(), "linked")


def links(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signatures, stars, links): pairs of nodes that connect whatever is linked (not all links inside a group).

    Stars: a links to the centre b; links: all that the groups do not show.
    """
    signed = signatures(docs, text, key, k, percent)
    some = signed.where("n > 0")
    # one row per node; only nodes of two rows or more need to move for that
    copied = stored(some.groupBy("node").agg(F.min(F.struct("doc", "rid")).alias("h"), F.count("*").alias("c")).where("c > 1").drop("c"), "copied")
    marks = bitmap(copied, "node")
    twice = in_bitmap(marks, F.col("node"))
    chosen = some.where(twice).join(copied, "node", "left").where(F.col("h").isNull() | F.struct("doc", "rid").eqNullSafe(F.col("h"))).drop("h")
    heads = stored(some.where(~twice).unionByName(chosen.dropDuplicates(["node"])).drop("doc"), "heads")

    # groups: each node against the most typical one of its min-hash
    item = F.struct("typical", "node", "rid", "n", "s0", "s1")
    keyed = heads.select(F.explode("mins").alias("m"), item.alias("x"))
    lead = keyed.groupBy("m").agg(F.max("x").alias("y"), F.count("*").alias("c")).where("c > 1").drop("c")
    first = _verified(keyed.join(lead, "m").where(F.expr("x.node <> y.node and " + _alike("x", "y", percent))), heads, docs, text, key, k, percent)
    group = stored(first.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "groups")
    members = group.groupBy(F.col("root").alias("g")).agg((F.count("*") + 1).alias("members"))

    # the matrix: shingles of two groups or more, with the groups' bounds
    inside = in_bitmap(bitmap(group, "node"), F.col("node"))
    narrow = heads.drop("mins", "typical")
    named = narrow.where(~inside).withColumn("g", F.col("node")).unionByName(narrow.where(inside).join(group, "node", "left").withColumn("g", F.coalesce("root", "node")).drop("root"))
    cells = named.select("g", "n", F.posexplode("prefix").alias("pos", "tok")).select("tok", "g", (F.col("n") - F.col("pos")).alias("tail"), "n").repartition("tok")
    shared = cells.groupBy("tok").agg(F.min("g").alias("g0"), F.max("g").alias("g1")).where("g0 <> g1").select("tok")
    matrix = stored(cells.join(shared, "tok", "left_semi").groupBy("tok", "g").agg(F.max("tail").alias("tail"), F.min("n").alias("lo"), F.max("n").alias("hi")), "matrix")
    near = F.expr(
        f"a.g < b.g and 100 * a.hi >= {percent} * b.lo and 100 * b.hi >= {percent} * a.lo"
        f" and {100 + percent} * least(a.tail, b.tail) >= {percent} * (a.lo + b.lo)")
    met = matrix.alias("a").join(matrix.alias("b"), "tok").where(near).select(F.col("a.g").alias("ga"), F.col("b.g").alias("gb")).distinct()

    # open the groups that met: members of the smaller against those of the larger
    size = lambda g, m: members.select(F.col("g").alias(g), F.col("members").alias(m))
    met = met.join(size("ga", "ma"), "ga", "left").join(size("gb", "mb"), "gb", "left").na.fill(1, ["ma", "mb"])
    less = F.col("ma") <= F.col("mb")
    met = stored(met.select(F.when(less, F.col("ga")).otherwise(F.col("gb")).alias("gs"), F.when(less, F.col("gb")).otherwise(F.col("ga")).alias("gl")), "met")
    wanted = in_bitmap(bitmap(met.select(F.explode(F.array("gs", "gl")).alias("g")), "g"), F.col("g"))
    people = stored(named.where(wanted).select("g", F.struct("node", "rid", "n", "s0", "s1").alias("x")), "members")
    pairs = met.join(people.select(F.col("g").alias("gs"), "x"), "gs").join(people.select(F.col("g").alias("gl"), F.col("x").alias("y")), "gl").where(F.expr(_alike("x", "y", percent)))
    rest = _verified(pairs, heads, docs, text, key, k, percent)
    return signed, first, rest


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, percent: int = 80) -> DataFrame:
    """(rid, doc, n_shingles, component, first): a row per row of ``docs``; ``rid`` is the hash of key and text.

    ``first`` marks the rows that speak for their component: its smallest (doc, rid).
    """
    signed, star, link = links(docs, text, key, k, percent)
    root = stored(contracted(star, link), "roots")
    nodes = signed.where("n > 0").groupBy("node").agg(F.min(F.struct("doc", "rid")).alias("o")).join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = stored(nodes, "nodes")
    named = nodes.join(nodes.groupBy("root").agg(F.min("o").alias("head")), "root").select("node", "head")
    signed = signed.select("rid", "doc", "n", "node")
    out = signed.where("n > 0").join(named, "node").unionByName(signed.where("n = 0").withColumn("head", F.struct("doc", "rid")))
    return out.select("rid", "doc", F.col("n").cast("long").alias("n_shingles"), F.col("head.doc").alias("component"), F.struct("doc", "rid").eqNullSafe(F.col("head")).alias("first"))
