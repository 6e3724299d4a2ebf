"""Sinks: BI CSV with decimal comma (S8), listing parts (S9/S10), early datasets (S10), metrics JSON.

Output folders live under the cluster's shared ``spark.checkpoint.dir`` unless a path is given.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra.session import ensure_checkpoint_dir


def scratch(df: DataFrame, name: str) -> str:
    return f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/quadra-out/{name}-{uuid.uuid4().hex[:8]}"


def write_bi(df: DataFrame, path: str | None = None, sep: str = ";") -> str:
    """``;`` separated, decimal comma for doubles, UTF-8 with a byte-order mark before each file's header."""
    out = path or scratch(df, "bi")
    cols = [F.regexp_replace(F.col(f"`{c}`").cast("string"), "\\.", ",").alias(c) if t in ("double", "float")
            else F.col(f"`{c}`").cast("string").alias(c) for c, t in df.dtypes]
    cols[0] = cols[0].alias("\ufeff" + df.columns[0])
    df.select(*cols).write.mode("overwrite").option("header", True).option("sep", sep).csv(out)
    return out


def write_parts(df: DataFrame, path: str | None = None, sep: str = ";", compression: str = "none") -> str:
    """Listing rows appended as text CSV parts, one per task as the rows lie; ``compression``: a codec that Spark's CSV reader knows."""
    out = path or scratch(df, "parts")
    df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]) \
      .write.mode("append").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("header", True).option("sep", sep).option("compression", compression).csv(out)
    return out


def write_early(df: DataFrame, path: str | None = None, sep: str = ";") -> str:
    """An early dataset, its columns in their fixed order."""
    from quadra.sources.files import EARLY_SCHEMA
    out = path or scratch(df, "early")
    df.select(*[F.col(f"`{c}`") for c in EARLY_SCHEMA.names]).write.mode("overwrite").option("header", True).option("sep", sep).csv(out)
    return out


def write_metrics(df: DataFrame, path: str | None = None) -> str:
    """Report / metrics table as JSON lines."""
    out = path or scratch(df, "metrics")
    df.write.mode("overwrite").json(out)
    return out
