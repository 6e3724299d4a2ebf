"""File sources: listing CSV parts, deed CSV, enriched BI CSV, legacy datasets, fair table.

Schemas are explicit (no inference); every raw field is read as text and typed
later with ``try_cast`` so one malformed value never fails the job (ANSI mode).
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadra import dims
from quadra.functions.text import std_text, strip_accents_py, to_double0, to_int0

# FIXED VALUES: declared listing fields of the collection CSV parts, in order.
LISTING_FIELDS = [
    "url", "valor_R$", "area_m2", "quartos", "vagas", "banheiros", "suites", "andar",
    "tipo_imovel", "status_construcao", "tipo_negocio",
    "bairro", "cidade", "rua", "numero", "endereco_completo",
    "condominio_R$", "iptu_R$",
    "destaque", "imagem_url", "descricao", "corretora",
    "nota_media", "total_avaliacoes", "anuncio_criado",
    "publicacao_texto", "dias_publicado", "dias_atualizado",
    "latitude", "longitude", "coordenadas", "origem_geo",
    *[n for n, _ in dims.UNIT_AMENITIES], *[n for n, _ in dims.CONDO_AMENITIES],
]
BRONZE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in LISTING_FIELDS])
RENAMES = {"valor_R$": "valor", "condominio_R$": "condominio", "iptu_R$": "iptu"}
DEED_SCHEMA = T.StructType([
    T.StructField("bairro", T.StringType()), T.StructField("ano_transacao", T.IntegerType()),
    T.StructField("media_valor_transacao", T.DoubleType()), T.StructField("media_valor_imovel", T.DoubleType()),
    T.StructField("media_area_terreno", T.DoubleType()), T.StructField("total_transacoes", T.DoubleType()),
])


def clean_header(name: str) -> str:
    """S3: trim and drop the UTF-8 BOM."""
    return name.replace("﻿", "").strip()


def part_headers(spark: SparkSession, paths, sep: str = ";") -> dict[tuple[str, ...], list[str]]:
    """Column names (cleaned) -> the files that have this header line, in order of path."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    first = lines.where("block = 0").withColumn("at", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    out: dict[tuple[str, ...], list[str]] = {}
    for r in first.orderBy("file").collect():  # one row per file
        out.setdefault(tuple(clean_header(c.strip('"')) for c in r["header"].split(sep)), []).append(r["file"])
    return out


def read_parts(spark: SparkSession, paths, sep: str = ";") -> DataFrame:
    """Rows of all parts by column *name* (text), with ``src_order`` and ``overlong``.

    Every header has a schema of its own, so parts may order or lack columns.  Short rows keep what
    they have; a row with more fields than its header is marked, not dropped.  What is read does
    not depend on the columns selected later.
    """
    union = None
    for names, files in part_headers(spark, paths, sep).items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, "_corrupt_record")])
        raw = (spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", "UTF-8").option("columnPruning", False)
               .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").csv(files))
        unquoted = F.regexp_replace("_corrupt_record", '"[^"]*"', "")
        # the reader refuses a query of the corrupt record alone: the first column takes part, always true
        fields = F.when(F.coalesce(F.octet_length(F.col(f"`{names[0]}`")), F.lit(0)) >= 0, F.size(F.split(unquoted, sep)))
        order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
        part = raw.select(*[F.col(f"`{c}`") if c in names else F.lit(None).cast("string").alias(c) for c in LISTING_FIELDS],
                          order.alias("src_order"), F.coalesce(fields > len(names), F.lit(False)).alias("overlong"), F.col("_corrupt_record").alias("raw_line"))
        union = part if union is None else union.unionByName(part)
    if union is None:
        order = "struct<file:string,block:bigint,pos:bigint>"
        union = spark.createDataFrame([], BRONZE_SCHEMA).withColumns({"src_order": F.lit(None).cast(order), "overlong": F.lit(False), "raw_line": F.lit(None).cast("string")})
    return union


def read_listings(spark: SparkSession, paths, sep: str = ";") -> DataFrame:
    """S1 + S2 + S3 + U1: typed union of CSV parts by name, with the order for dedup; over-long rows are rejected.

    ``src_order`` = (file path, split, position) gives the source's "first occurrence in
    sorted-file concatenation" order without a global sort.
    """
    return typed_listings(read_parts(spark, paths, sep).where(~F.col("overlong")).drop("overlong", "raw_line"))


def read_rejects(spark: SparkSession, paths, sep: str = ";") -> DataFrame:
    """The over-long rows, as (file, line)."""
    return read_parts(spark, paths, sep).where("overlong").select("src_order.file", "raw_line")


def typed_listings(df: DataFrame) -> DataFrame:
    """Bronze (text) -> silver types: numbers via try_cast (bad -> 0), booleans -> 0/1."""
    from quadra.functions.text import bool_to_int
    out = df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})
    nums = {c: to_double0(c) for c in ["valor", "area_m2", "condominio", "iptu", "nota_media", "latitude", "longitude"]
            if c in out.columns}
    ints = {c: to_int0(c) for c in ["quartos", "vagas", "banheiros", "suites", "andar",
                                                    "total_avaliacoes", "dias_publicado", "dias_atualizado"]
            if c in out.columns}
    flags = {n: bool_to_int(n) for n, _ in dims.UNIT_AMENITIES + dims.CONDO_AMENITIES if n in out.columns}
    extra = {}
    if "numero" in out.columns:
        extra["numero"] = to_int0("numero", "bigint")
    if "anuncio_criado" in out.columns:
        extra["anuncio_criado"] = F.try_to_date(F.col("anuncio_criado").cast("string"))
    return out.withColumns({**nums, **ints, **flags, **extra})


def _canonical_deed(col: str) -> str | None:
    c = strip_accents_py(col.strip().lower())
    if c == "bairro":
        return "bairro"
    if "valor_transa" in c or "media_valor_t" in c:
        return "media_valor_transacao"
    if "ano_transa" in c:
        return "ano_transacao"
    if "area_terreno" in c or "media_area" in c:
        return "media_area_terreno"
    if "valor_imovel" in c or "media_valor_i" in c:
        return "media_valor_imovel"
    if "total_transa" in c:
        return "total_transacoes"
    return None


def read_deeds(spark: SparkSession, path: str) -> DataFrame:
    """Deed CSV with fuzzy header names -> canonical columns; missing file / bairro -> empty."""
    try:
        raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DEED_SCHEMA)  # a missing file is an empty input, as in the source
    ren = {c: _canonical_deed(c) for c in raw.columns}
    if "bairro" not in ren.values():
        return spark.createDataFrame([], DEED_SCHEMA)
    df = raw.select(*[F.col(f"`{c}`").alias(n) for c, n in ren.items() if n])
    return normalise_deeds(df)


def normalise_deeds(df: DataFrame) -> DataFrame:
    """Title-case the neighbourhood, coerce numerics (bad -> 0)."""
    out = {"bairro": std_text("bairro")}
    for c in ["media_valor_transacao", "media_valor_imovel", "media_area_terreno", "ano_transacao", "total_transacoes"]:
        if c in df.columns:
            out[c] = to_double0(c) if c != "ano_transacao" else to_int0(c)
    return df.withColumns(out)


def read_bi(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Enriched CSV (decimal comma, BOM) back to numbers where the text parses."""
    raw = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(path)
    raw = raw.toDF(*[clean_header(c) for c in raw.columns])
    conv = {}
    for c in raw.columns:
        col = F.col(f"`{c}`")
        # only decimal-comma numbers change; ids and other text stay as written
        conv[c] = F.when(col.rlike("^-?[0-9]+,[0-9]+$"), F.regexp_replace(col, ",", ".")).otherwise(col)
    return raw.withColumns(conv)


# FIXED VALUES: columns of the early datasets, in order
EARLY_SCHEMA = T.StructType([T.StructField(c, T.StringType() if c in ("descricao", "local", "bairro/cidade", "novidade") else T.LongType()) for c in [
    "valor", "descricao", "local", "bairro/cidade", "quartos", "garagem", "banheiro", "area(m2)", "iptu", "condominio", "novidade"]])


def read_early(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """An early dataset (``;``) by its schema; names with ``(`` and ``/`` are kept and quoted with back-ticks."""
    return spark.read.schema(EARLY_SCHEMA).option("header", True).option("sep", sep).csv(path)


def read_fairs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Geocoded market fairs -> (POI rows ``name, lat, lon``, rejects without coordinates)."""
    raw = spark.read.option("header", True).csv(path)
    typed = raw.withColumns({"lat": F.col("lat").try_cast("double"), "lon": F.col("lon").try_cast("double")})
    key = F.format_string("Feira %s (%s/%s)", F.col("bairro"), F.col("dia"), F.col("endereco_normalizado"))
    ok = typed.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    bad = typed.filter(F.col("lat").isNull() | F.col("lon").isNull())
    return ok.select(key.alias("name"), "lat", "lon"), bad
