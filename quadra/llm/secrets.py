"""Secret scan with multipart credential linking (native: no Python on the executors).

Strong spans stand alone: ``assign`` (a keyword, ``:`` or ``=``, a value of 8 or more characters),
``access`` (``AKIA...`` of 16 or more) and ``hex`` (32 or more lowercase hex digits).  Weak spans alone
prove nothing: ``weak_id`` (a named account or client), ``weak_key`` (a long mixed token without a
name) and ``endpoint`` (a URL or cloud host).  They are reported only where complementary parts
co-occur: an identifier near a secret, a secret near an identifier, an endpoint near both.  Near means
within ``REACH`` code points and in one scope; scopes are the stretches between blank lines.

The interval join is a window, not a pairing: the parts of a document are ordered by start, the scope
is the running number of breaks, and each part looks at the nearest part of each role on either side
in its scope.  So a document with thousands of parts costs their sort.  Positions come from the gaps
between matches (lengths of what ``split`` leaves, summed), in code points.  Texts never shuffle; what
moves is one narrow row per part.

Defined results: null text is empty; a document without spans has counts 0, the hash of the empty
text and an empty ``spans``; equal rows give equal results, one each.  Spans of one kind do not overlap.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REACH = 400
#: (kind, pattern, group whose length counts, its least length); the first three are the base kinds, in their order.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("weak_id", r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{3,}""", 0, 3),
    ("weak_key", r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{32,}={0,2}", 0, 32),
    ("endpoint", r"(?i:https?|jdbc:[a-z]+|postgres|mysql|redis|amqp|mongodb)://[^\x20\x09-\x0D\"'<>]+|[a-z0-9.-]+\.amazonaws\.com", 0, 8),
)
BREAK = r"\n[\x20\t]*\n"
BASE = 3
IDENTIFIERS, SECRETS = ("access", "weak_id"), ("assign", "hex", "weak_key")


def _parts(text: Column, number: int, pattern: str, group: int, least: int) -> Column:
    """Matches of a kind as (kind, i, gap, size, ok): what lies before each, its length, whether it counts."""
    p = F.lit(pattern)
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, p, F.lit(0))
    counted = hits if group == 0 else F.regexp_extract_all(text, p, F.lit(group))
    rows = F.arrays_zip(F.transform(hits, lambda x: F.length(x)).alias("size"), F.transform(counted, lambda x: F.length(x)).alias("counted"), F.transform(gaps, lambda x: F.length(x)).alias("gap"))
    found = F.transform(rows, lambda x, i: F.struct(F.lit(number).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["size"].alias("size"), (x["counted"] >= least).alias("ok")))
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,ok:boolean>>")
    return F.when(text.rlike(pattern), F.slice(found, 1, F.size(hits))).otherwise(none)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", reach: int = REACH) -> DataFrame:
    """(key, spans): per row the reported spans, an array of (start, kind number, end) in order."""
    rows = docs.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("_t")).withColumn("_row", F.monotonically_increasing_id())
    any_id = F.col("_t").rlike(KINDS[1][1]) | F.col("_t").rlike(KINDS[3][1])
    kinds = [_parts(F.col("_t"), n, *k[1:]) for n, k in enumerate(KINDS)]
    extra = [_parts(F.col("_t"), len(KINDS), BREAK, 0, 0), *kinds[4:]]
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,ok:boolean>>")
    # without an identifier nothing weak can be reported
    rows = rows.select("_row", key, F.explode_outer(F.concat(*kinds[:BASE], F.when(any_id, F.concat(kinds[3], *extra)).otherwise(none))).alias("p"))
    rows = rows.select("_row", key, "p.*")
    upto = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto)).withColumn("start", F.col("end") - F.col("size"))
    # what fails its least length loses its kind, not its row: a document of nothing else stays
    rows = rows.withColumn("kind", F.when(F.col("ok"), F.col("kind")))

    order = Window.partitionBy("_row").orderBy("start", "kind")
    rows = rows.withColumn("scope", F.sum((F.col("kind") == len(KINDS)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    scope = Window.partitionBy("_row", "scope").orderBy("start", "kind")
    number = {k[0]: n for n, k in enumerate(KINDS)}

    def near(role: tuple[str, ...]) -> Column:
        """Is a part of the role, other than this one, within reach in the scope?"""
        mine = F.col("kind").isin([number[r] for r in role])
        left = F.max(F.when(mine, F.col("end"))).over(scope.rowsBetween(Window.unboundedPreceding, -1))
        right = F.min(F.when(mine, F.col("start"))).over(scope.rowsBetween(1, Window.unboundedFollowing))
        return F.coalesce(F.col("start") - left <= reach, F.lit(False)) | F.coalesce(right - F.col("end") <= reach, F.lit(False))

    kind = F.col("kind")
    linked = (F.when(kind < BASE, True).when(kind == number["weak_id"], near(SECRETS)).when(kind == number["weak_key"], near(IDENTIFIERS))
              .when(kind == number["endpoint"], near(SECRETS) & near(IDENTIFIERS)).otherwise(False))
    rows = rows.withColumn("linked", linked)
    span = F.when(F.col("linked"), F.struct(F.col("start"), F.col("kind"), F.col("end")))
    return rows.groupBy("_row", key).agg(F.sort_array(F.collect_list(span)).alias("spans")).drop("_row")


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
