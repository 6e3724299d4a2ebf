"""Collected rows into durable tables: error provenance (S9), run counters (A24), collection time (X28), last refresh.

The source's consumers append each row to a file and keep a failed one with the reason in ``origem_geo``.  Here a batch
of the stream is one folder, named by its number and written as a whole, so a batch that runs again after a failure
replaces itself: nothing is added twice.  Counters are observed while rows pass (``Observation``), or summed by batch.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quadra.functions.text import canonical_id
from quadra.operators import quality

# FIXED VALUES: the mark of a failed row and the length its reason is cut to
ERROR_MARK = "ERRO: "
ERROR_LENGTH = 80


def failure(url: str = "url", price: str = "valor_R$", area: str = "area_m2") -> Column:
    """Why a collected row cannot be processed (the first reason), or null."""
    def no_number(c: str, what: str) -> tuple[Column, Column]:
        text = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        return text.try_cast("double").isNull(), F.concat(F.lit(f"{what} inválido: "), text)

    bad_price, price_text = no_number(price, "valor")
    bad_area, area_text = no_number(area, "area")
    blank = F.trim(F.coalesce(F.col(f"`{url}`"), F.lit(""))) == ""
    return F.when(blank, "url ausente").when(bad_price, price_text).when(bad_area, area_text)


def with_provenance(df: DataFrame, reason: Column) -> DataFrame:
    """``erro``, and the reason in ``origem_geo`` where there is one; the row stays."""
    out = df.withColumn("erro", reason)
    return out.withColumn("origem_geo", F.when(F.col("erro").isNotNull(), F.concat(F.lit(ERROR_MARK), F.left("erro", F.lit(ERROR_LENGTH)))).otherwise(F.col("origem_geo")))


def batch_sink(path: str, collected_at: Column | None = None):
    """A ``foreachBatch`` function that keeps rows, rejects and counters of each batch below ``path``.

    ``rows/lote=<n>`` holds every row, failed ones marked; ``rejects/lote=<n>`` the failed ones; ``counters/lote=<n>`` one
    line.  Each is overwritten as a whole, and the last two are read from the first, so any replay ends in the same tables.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = with_provenance(batch, failure()).withColumn("timestamp_coleta", F.current_timestamp() if collected_at is None else collected_at)
        rows.write.mode("overwrite").parquet(f"{path}/rows/lote={number}")
        kept = spark.read.schema(rows.schema).parquet(f"{path}/rows/lote={number}")
        kept.where("erro is not null").write.mode("overwrite").parquet(f"{path}/rejects/lote={number}")
        line = kept.agg(F.count(F.lit(1)).alias("recebidos"), F.count_if(F.col("erro").isNull()).alias("processados"), F.count_if(F.col("erro").isNotNull()).alias("erros"))
        line.write.mode("overwrite").parquet(f"{path}/counters/lote={number}")
    return write


def collect(stream: DataFrame, path: str, checkpoint: str, collected_at: Column | None = None) -> None:
    """Drive a stream of collected rows into the tables below ``path``, as far as there is input now."""
    stream.writeStream.foreachBatch(batch_sink(path, collected_at)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """``rows``, ``rejects`` or ``counters`` of all batches; empty before the first one."""
    try:
        return spark.read.parquet(f"{path}/{name}")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], f"{schema}, lote int")


def run(feed: DataFrame, path: str) -> dict[str, int]:
    """One run over a feed of cards (with ``src_order``): the first row of each url is kept at ``path``; counts of the run.

    ``vistos``: rows that came; ``sem_url``: dropped for want of one; ``enfileirados``: first rows; ``duplicados``: the others;
    ``processados`` and ``erros``: first rows without and with a reason against them.  The counts are observed while the
    one job writes; no second pass.  A stage that is run again after a lost executor may count its rows again, so a
    run's counts describe it, and the tables are the record.
    """
    seen, done = Observation(), Observation()
    blank = F.trim(F.coalesce(F.col("url"), F.lit(""))) == ""
    rows = feed.observe(seen, F.count(F.lit(1)).alias("vistos"), F.count_if(blank).alias("sem_url")).where(~blank)
    first = quality.dedup_first(rows.withColumn("id_imovel", canonical_id("url")))
    marked = with_provenance(first, failure())
    marked = marked.observe(done, F.count(F.lit(1)).alias("enfileirados"), F.count_if(F.col("erro").isNull()).alias("processados"), F.count_if(F.col("erro").isNotNull()).alias("erros"))
    marked.write.mode("overwrite").parquet(path)
    out = {**seen.get, **done.get}
    return {**out, "duplicados": out["vistos"] - out["sem_url"] - out["enfileirados"]}


def last_refresh(rows: DataFrame) -> DataFrame:
    """When the newest row was collected."""
    return rows.agg(F.max("timestamp_coleta").alias("ultima_atualizacao"))
