"""Helpers of the operators: shared-folder tables, distributed ranks, byte-level word hashing.

Shared tables: an intermediate result that several branches read is written once as Parquet below
the folder the cluster names in ``spark.checkpoint.dir`` (every executor sees it, and a lost
executor costs only its running tasks).  Where that setting is missing, only a ``local`` session
gets a folder of its own; elsewhere it is an error.
"""
from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column as ClassicColumn

# ---------------------------------------------------------------- shared tables


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of this application in the shared store."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="quadra-shared-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Drops the shuffle files of finished steps.

    Spark removes them once the driver's JVM has collected the plans that refer to them, which it does under heap pressure or
    every half hour; so the files of all steps so far would lie on the executors' disks together.
    """
    spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- distributed order


def range_bucket(df: DataFrame, key: str, buckets: int) -> Column:
    """Column: number of the value range of ``key`` (0 .. buckets-1; nulls in 0), monotone in ``key``.

    The bounds are approximate quantiles of the whole column (a bounded sketch, ``buckets`` numbers
    on the driver); a row's bucket depends on its key alone, so recomputed tasks agree.
    """
    if buckets <= 1:
        return F.lit(0)
    bounds = df.agg(F.percentile_approx(key, [i / buckets for i in range(1, buckets)], 100 * buckets)).first()[0]
    bounds = sorted(set(bounds or []))
    if not bounds:
        return F.lit(0)
    # two steps of about sqrt(bounds) comparisons: whole rows of bounds below, then those of one row
    wide = math.isqrt(len(bounds) - 1) + 1
    table = [bounds[i:i + wide] for i in range(0, len(bounds), wide)]
    below = lambda row: F.size(F.filter(row, lambda b: b <= F.col(key)))
    rows = below(F.array(*[F.lit(r[-1]) for r in table]))
    rest = F.get(F.array(*[F.array(*map(F.lit, r)) for r in table]), rows)
    return F.when(F.col(key).isNull(), 0).otherwise(rows * wide + F.when(rest.isNull(), 0).otherwise(below(rest))).cast("int")


def offsets(counts: DataFrame, group: list[str], bucket: str, n: str, out: str) -> DataFrame:
    """Rows of the buckets before each bucket, per group.  ``counts`` has one row per (group, bucket)."""
    w = Window.partitionBy(*[F.col(c) for c in group]).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0)))


# ---------------------------------------------------------------- bytes and words

#: [\x20\x09-\x0D] separates words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: One random 64-bit number per byte value, and an odd multiplier with its inverse modulo 2**64.
_RNG = np.random.default_rng(20240607)
BYTE64 = _RNG.integers(1, 2**64 - 1, 256, dtype=np.uint64)
MULT = np.uint64(int(_RNG.integers(1, 2**62)) * 4 + 3)
MULT_INV = np.uint64(pow(int(MULT), -1, 2**64))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**n at least (modulo 2**64), kept between calls and grown by doubling."""
    have = _POWERS.get(int(base), np.ones(1, np.uint64))
    with np.errstate(over="ignore"):
        while len(have) <= n:
            have = np.concatenate([have, have * (have[-1] * base)])
    _POWERS[int(base)] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser, element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and its n + 1 offsets; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def runs(at: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes (one row at least, whole rows always)."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def words(data: np.ndarray, at: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each row (n + 1 numbers).  ``gap``: which bytes separate."""
    base, end = int(at[0]), int(at[-1])
    letter = ~gap[data[base:end]]
    edge = np.zeros(end - base + 1, bool)
    edge[at[:-1] - base] = True
    first = letter.copy()
    first[1:] &= ~letter[:-1] | edge[1:-1]
    last = letter
    last[:-1] &= ~letter[1:] | edge[1:-1]
    start, stop = np.flatnonzero(first) + base, np.flatnonzero(last) + base + 1
    return start, stop, np.searchsorted(start, at)


def span_hash(data: np.ndarray, start: np.ndarray, stop: np.ndarray, lower: bool = True, seed: int = 0) -> np.ndarray:
    """64-bit hash of the bytes of each span (spans lie in one stretch of ``data``; A-Z lowered if ``lower``)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    base, end = int(start.min()), int(stop.max())
    part = data[base:end]
    with np.errstate(over="ignore"):
        sums = np.zeros(end - base + 1, np.uint64)
        table = mix(BYTE64 + np.uint64(seed)) if seed else BYTE64
        np.cumsum(table[LOWER[part] if lower else part] * powers(MULT, end - base)[:end - base], out=sums[1:])
        s, e = start - base, stop - base
        return mix((sums[e] - sums[s]) * powers(MULT_INV, end - base)[s] + (e - s).astype(np.uint64))


def shingles(data: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words (fewer words: the whole sequence as one), and each row's range."""
    start, stop, row = words(data, at)
    h = span_hash(data, start, stop)
    n = np.diff(row)
    many = np.where(n == 0, 0, np.maximum(n - k + 1, 1))
    out_at = np.concatenate([[0], np.cumsum(many)])
    owner = np.repeat(np.arange(len(n)), many)
    first = row[owner] + (np.arange(out_at[-1]) - out_at[owner])
    size = np.minimum(n[owner], k)
    with np.errstate(over="ignore"):
        acc = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        padded = np.concatenate([h, np.zeros(k, np.uint64)])
        for j in range(k):
            acc = mix(np.where(j < size, acc * MULT + padded[np.minimum(first + j, len(padded) - 1)], acc))
    return acc, out_at


def distinct_by_row(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, ascending, and the new ranges."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[keep], owner[keep]
    return values, np.searchsorted(owner, np.arange(len(at)))


# ---------------------------------------------------------------- native (SQL-only) helpers


def rarity_classes(hashes: DataFrame, column: str, top: int = 1 << 17, bits: int = 20) -> Column:
    """Table literal: per hash bucket (top ``bits`` bits) a byte, the class 0 .. 126 that grows with how common its words are.

    Counts every occurrence; the ``top`` most common hashes (a fixed number, whatever the input) set
    their bucket to ``4 * log2(count)``, all other buckets are 0, rare.  A word's class depends on its
    hash alone, so (class, hash) is one total order for all rows.
    """
    common = hashes.groupBy(F.col(column).alias("h")).agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "h").limit(top)
    rows = common.select(F.shiftrightunsigned("h", 64 - bits).cast("int").alias("b"), F.least(F.lit(126), F.round(4 * F.log2("n"))).cast("int").alias("c")).toArrow()
    table = np.zeros(1 << bits, np.uint8)
    np.maximum.at(table, rows.column("b").to_numpy(), rows.column("c").to_numpy().astype(np.uint8))
    return byte_table(hashes.sparkSession, table)


def byte_table(spark: SparkSession, table: np.ndarray) -> Column:
    """array<tinyint> literal of numbers 0 .. 127, a byte each, that plans do not spell out.

    An array literal parsed from text is an object per number, and its text stands in every description of a plan: in the
    driver's memory, and in the event log, where tables of a MB made most of the disk of a small run.
    """
    jvm = spark.sparkContext._jvm
    catalyst, types = jvm.org.apache.spark.sql.catalyst.expressions, jvm.org.apache.spark.sql.types.DataTypes
    values = catalyst.UnsafeArrayData.fromPrimitiveArray(table.astype(np.int8).tobytes())
    return ClassicColumn(jvm.org.apache.spark.sql.classic.ExpressionUtils.column(catalyst.Literal(values, types.createArrayType(types.ByteType, False))))


def by_rarity(classes: Column, h: Column, bits: int = 20) -> Column:
    """A hash as (class, top 56 bits of the hash): a number that sorts rare words first."""
    return F.call_function("shiftleft", F.get(classes, F.shiftrightunsigned(h, 64 - bits).cast("int")).cast("bigint"), F.lit(56)) + F.shiftrightunsigned(h, 8)


def bitmap(keys: DataFrame, column: str, bits: int = 20) -> Column:
    """Table literal of a bitmap with the top ``bits`` bits of each 64-bit ``column`` set, seven a byte."""
    h = F.shiftrightunsigned(F.col(column), 64 - bits)
    rows = keys.select(h.alias("h")).groupBy(F.expr("cast(h div 7 as int)").alias("w")).agg(F.bit_or(F.expr("shiftleft(1, cast(h % 7 as int))")).cast("int").alias("m")).toArrow()
    table = np.zeros((1 << bits) // 7 + 1, np.uint8)
    table[rows.column("w").to_numpy()] = rows.column("m").to_numpy()
    return byte_table(keys.sparkSession, table)


def in_bitmap(marks: Column, h: Column, bits: int = 20) -> Column:
    """True for every hash that was set, and for others that share its top bits."""
    top = F.shiftrightunsigned(h, 64 - bits)
    return F.call_function("shiftright", F.get(marks, F.call_function("div", top, F.lit(7)).cast("int")).cast("int"), (top % 7).cast("int")).bitwiseAND(F.lit(1)) != 0


#: A side of at most so many narrow rows may be broadcast; larger ones are left to the planner.
SMALL_ROWS = 50_000


def if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is (a shuffle join)."""
    return F.broadcast(df) if len(df.limit(rows + 1).select(F.lit(1)).take(rows + 1)) <= rows else df


def in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` sorted by range over all partitions and stored, with its range's number ``_pid`` and ``_pos`` in the whole order (from 0).

    Only one count per range is summed in one place; rows stay where the distributed sort put them.
    """
    table = stored(df.orderBy(*order).withColumn("_pid", F.spark_partition_id()), name)
    count = offsets(table.groupBy("_pid").agg(F.count("*").alias("_n")).withColumn("_g", F.lit(0)), ["_g"], "_pid", "_n", "_before").select("_pid", "_before")
    pos = F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1
    return table.withColumn("_in", pos).join(if_small(count), "_pid").withColumn("_pos", (F.col("_before") + F.col("_in")).cast("long")).drop("_in", "_before")


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    return F.coalesce(F.size(F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != "")), F.lit(0)).cast("long")
