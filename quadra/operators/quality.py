"""Phase 2 — dedup, numeric coercion, sanity filter, outlier trim, text standardisation.

Operators: X19 W1 F1 F2 F3 F4 F5 D1 X22 X23 X24.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quadra.functions.order import exact_quantiles
from quadra.functions.text import canonical_id, clean_text, title_case, to_double0, trim_ws
from quadra.session import stored

NUMERIC_COLS = ["valor", "area_m2", "condominio", "iptu", "quartos", "vagas", "banheiros", "suites"]
TEXT_COLS = ["bairro", "tipo", "cidade", "descricao", "rua", "corretora"]
LONG_TEXT_COLS = ["descricao"]   # standardised where they are read, not in the stored table


def with_canonical_id(df: DataFrame, url_col: str = "url") -> DataFrame:
    """``id_imovel`` from the url."""
    return df.withColumn("id_imovel", canonical_id(url_col))


def dedup_first(df: DataFrame, key: str = "id_imovel", order_col: str = "src_order") -> DataFrame:
    """Keep the first row per ``key`` in ``order_col`` order; of rows that tie on both, one.

    A scalar order: 1. ``min(order)`` per key, combined map-side by hash, so a key holding a third of all rows is
    reduced inside every task; 2. left-semi join back on ``(key, first order)``: both are hash keys, so the rows of a
    hot key spread over all partitions; 3. ties on (key, order) are dropped where they already are, without another shuffle.

    An order of several columns (a struct) sorts inside the task anyway, so the row goes along behind its order: the first
    of each key in every task (a window group limit before the exchange), so one shuffle of at most a row per key and task, without a join.
    """
    if isinstance(df.schema[order_col].dataType, StructType):
        fields = df.schema[order_col].dataType.names
        known = df.where(F.col(key).isNotNull() & F.col(order_col).isNotNull())
        return first_rows(known, key, [F.col(order_col).getField(c) for c in fields], [c for c in df.columns if c not in (key, order_col)]).select(
            key, order_col, *[F.col(f"`{c}`") for c in df.columns if c not in (key, order_col)])
    firsts = df.groupBy(key).agg(F.min(order_col).alias(order_col))
    return df.join(firsts, [key, order_col], "left_semi").dropDuplicates([key, order_col])


def first_rows(df: DataFrame, key: str, order: list, rest: list[str] = ()) -> DataFrame:
    """The first row of every ``key`` (null is one) by ``order``, then by the columns of ``rest``."""
    by = Window.partitionBy(key).orderBy(*order, *[F.col(f"`{c}`") for c in rest])
    return df.withColumn("__n", F.row_number().over(by)).where("__n = 1").drop("__n")


def coerce_numeric(df: DataFrame, cols=NUMERIC_COLS) -> DataFrame:
    """text or numbers -> double, unparsable/NULL -> 0 (integer columns stay int)."""
    types = dict(df.dtypes)
    conv = {}
    for c in cols:
        if c not in types:
            continue
        if types[c] == "string":
            conv[c] = to_double0(c)
        else:   # already numeric: only NULL -> 0, no text round trip
            conv[c] = F.coalesce(F.col(c), F.lit(0).cast(types[c]))
    return df.withColumns(conv)


def parking_flag(df: DataFrame) -> DataFrame:
    """F2."""
    return df.withColumn("bool_vaga", (F.col("vagas") > 0).cast("int"))


def sanity_filter(df: DataFrame, min_price: float = 10_000, min_area: float = 10) -> DataFrame:
    """``valor > 10 000 AND area >= 10`` (pushed into the scan when the source allows)."""
    return df.filter((F.col("valor") > min_price) & (F.col("area_m2") >= min_area))


def price_per_m2(df: DataFrame) -> DataFrame:
    """``preco_m2`` = valor / area, 2 dp half-even."""
    return df.withColumn("preco_m2", F.bround(F.try_divide("valor", "area_m2"), 2))


def trim_outliers(df: DataFrame, col: str = "preco_m2", lo: float = 0.01, hi: float = 0.99,
                  min_rows: int = 20) -> DataFrame:
    """keep ``q_lo < col < q_hi`` (strict, exact linear quantiles) when the table has > ``min_rows`` rows.

    Call on a stored table: the bounds are found by counting in bins (bounded memory), and applied as
    literals, so that no branch of a later plan computes them again.
    """
    bounds, n = exact_quantiles(df, col, [lo, hi])
    if bounds is None or n <= min_rows:
        return df
    return df.filter((F.col(col) > F.lit(bounds[0])) & (F.col(col) < F.lit(bounds[1])))


def title_columns(df: DataFrame, cols) -> DataFrame:
    """X22 of the columns that are there: trim + title case, in two steps, so that no text is trimmed for each use of the result."""
    cols = [c for c in cols if c in df.columns]
    return df.withColumns({c: clean_text(c) for c in cols}).withColumns({c: title_case(c) for c in cols})


def standardise_text(df: DataFrame, cols=TEXT_COLS) -> DataFrame:
    """X22 (+X23, X24): trim + title-case text columns, clean ``tipo``, backfill ``tipo_imovel``."""
    df = title_columns(df, [*cols, "tipo_imovel"])
    if "tipo" in df.columns:
        df = df.withColumn("__head", F.regexp_extract("tipo", "^(.+?)\\s+Para\\b", 1))
        df = df.withColumn("tipo", trim_ws(F.when(F.col("__head") != "", F.col("__head")).otherwise(F.col("tipo")))).drop("__head")
        df = df.withColumn("tipo", title_case("tipo"))
    if "tipo_imovel" in df.columns:
        ti = F.col("tipo_imovel")
        empty = ti.isin("", "Nan", "Não Informado", "None")
        fill = F.col("tipo") if "tipo" in df.columns else ti
        df = df.withColumn("tipo_imovel", F.when(empty, fill).otherwise(ti))
    return df


def apply_quality_rules(df: DataFrame, path: str | None = None) -> DataFrame:
    """Whole phase 2 on raw typed listings carrying ``url`` and ``src_order``."""
    return clean(dedup_first(with_canonical_id(df)), path)


def _standard_rows(df: DataFrame) -> DataFrame:
    """The columns of phase 2 that need one row each, long texts left out."""
    return standardise_text(price_per_m2(parking_flag(coerce_numeric(df))), [c for c in TEXT_COLS if c not in LONG_TEXT_COLS])


def clean(df: DataFrame, path: str | None = None, columns=None) -> DataFrame:
    """Phase 2 after the dedup, on rows that carry ``id_imovel``.

    The deduplicated, sanity-filtered table is written once as Parquet (to ``path``, else to the
    shared folder): the quantile pass reads one of its columns, later plans only those they use.  Short
    texts are stored as standardised, so that the branches of a later plan (group keys above all) do not repeat it;
    long ones follow on the rows read.  ``columns``: those the caller reads, all by default; the others are not written.
    """
    df = sanity_filter(_standard_rows(df))
    if columns is not None:
        df = df.select(*dict.fromkeys([*columns, "preco_m2"]))
    df = stored(df, "silver", path)
    return title_columns(trim_outliers(df), LONG_TEXT_COLS)


#: Columns that several branches of an enrichment read (quantiles, outlier bounds, group keys and means).
SHARED_COLS = ["valor", "area_m2", "preco_m2", "bairro", "rua"]


def clean_derived(base: DataFrame, derive) -> DataFrame:
    """``clean(derive(base))`` for listings whose columns ``derive`` makes from a few base columns, row by row.

    The base columns and ``SHARED_COLS`` are stored; the other columns are derived on the rows read, so a caller of three
    columns does not pay for the text of sixty.  ``derive(rows, *keep)`` adds the columns of ``keep`` as they are.
    """
    shared = {c: F.col(f"_{c}") for c in SHARED_COLS}
    rows = sanity_filter(_standard_rows(derive(base, *base.columns))).select(*base.columns, *[F.col(c).alias(f"_{c}") for c in shared])
    rows = stored(rows, "silver")
    df = _standard_rows(derive(rows, *[f"_{c}" for c in shared])).withColumns(shared).drop(*[f"_{c}" for c in shared])
    return title_columns(trim_outliers(df), LONG_TEXT_COLS)


def is_empty_guard(df: DataFrame) -> bool:
    """the job-edge emptiness check (one tiny action)."""
    return df.isEmpty()
