"""SparkSession helpers shared by tests, bench and the pipeline."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Set only where the session does not say otherwise; nothing here depends on the data or the cluster's size.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    # wide listing rows (~150 columns) must stay inside whole-stage codegen
    "spark.sql.codegen.maxFields": "1000",
    # the JVM never compiles methods of over 8,000 bytes: such stages run as separate operators, which it does compile
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

TASKS_A_CORE = 4


def get_spark(master: str | None = None, app: str = "quadra", **conf) -> SparkSession:
    """The submitted session, as it is (but see :func:`compiled`); with ``master`` a session of one's own (tests, bench) with ``conf``."""
    builder = SparkSession.builder.appName(app)
    settings = dict(conf)
    if master:
        builder = builder.master(master)
        settings = {**_DEFAULTS, "spark.ui.enabled": "false", "spark.driver.memory": os.environ.get("QUADRA_DRIVER_MEM", "16g"), **conf}
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if master:
        spark.sparkContext.setLogLevel("ERROR")
    return spark


def compiled(spark: SparkSession) -> None:
    """Wide stages of the listing view run as separate operators, which the JVM compiles, also in a submitted session that has no limit of its own.

    So many columns make a row dear for its bytes: a scan is cut into some tasks a core (never below the open cost of a file),
    where the session says nothing else, or one task more than there are cores takes as long as a second wave.
    """
    key, parts = "spark.sql.codegen.hugeMethodLimit", "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, _DEFAULTS[key])
    if spark.conf.get(parts, None) is None:
        spark.conf.set(parts, str(TASKS_A_CORE * spark.sparkContext.defaultParallelism))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a ``local`` session without one gets its own, a cluster an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="quadra-ckpt-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once as Parquet (to ``path``, else below the shared folder) and read back.

    The rows behind it are durable and columnar: what follows reads only its columns, with
    statistics and push-down, and a lost executor repeats only its own tasks.
    """
    spark = df.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
