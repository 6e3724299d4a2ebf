"""The composed listing job: phases 2-16 as ``DataFrame.transform`` steps over two stored tables.

Phase 2 ends in a Parquet table, and so do phases 3-12 before the audience profiles.  Table-wide scalars (quintile edges, min/max for the
profiles, latest deed year) are scalar subqueries; the only shuffles are the dedup aggregate
and the group statistics (all partially aggregated map-side).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadra.operators import finance, geo, nlp, price, profiles, quality
from quadra.session import stored
from quadra.sources.listing_view import AS_OF, first_bases, listing_columns


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a Parquet table in the cluster's shared folder.

    Keeps plans small (analysis of ~150 derived columns grows with the lineage); later steps
    read only the columns they use.
    """
    return stored(df, "gold")


def silver(raw: DataFrame, path: str | None = None) -> DataFrame:
    """Phase 2."""
    return quality.apply_quality_rules(raw, path)


def enrich(df: DataFrame, as_of: str = AS_OF, categories=None, checkpoint: bool = True, columns=None) -> DataFrame:
    """Phases 3-12 on a silver table.

    ``columns``: those the caller reads (all by default).  What the audience profiles read twice is then stored with these
    and the profiles' inputs only, and not stored at all for a caller who reads no profile.
    """
    edges = nlp.quintile_edges(df, ["valor", "area_m2"])
    mid = (df.transform(price.reference_price)
             .transform(lambda d: geo.enrich_geo(d, categories))
             .transform(finance.finance)
             .transform(price.street_supply)
             .transform(lambda d: nlp.segment_market(d, edges))
             .transform(lambda d: nlp.days_on_market(d, as_of))
             .transform(nlp.extract_tags)
             .transform(nlp.urgency)
             .transform(nlp.comfort_index)
             .transform(profiles.row_profiles))
    if checkpoint and columns is None:
        mid = cut(mid)
    elif checkpoint and set(columns) & set(profiles.SCORES):
        mid = cut(mid.select(*[c for c in mid.columns if c in {*columns, *profiles.INPUTS}]))
    out = mid.transform(profiles.audience_profiles)
    return out if columns is None else out.select(*columns)


def gold(spark: SparkSession, sf_dir: str, as_of: str = AS_OF, categories=None, checkpoint: bool = True, columns=None) -> DataFrame:
    return enrich(quality.clean_derived(first_bases(spark, sf_dir), listing_columns), as_of, categories, checkpoint, columns)
