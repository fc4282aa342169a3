"""Projections and filters of the interactive views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import zero_if_null
from ..schemas import DASHBOARD_COLUMNS

ALL = "All"


def has_coordinates() -> Column:
    return F.col("latitude").isNotNull() & F.col("longitude").isNotNull()


def year_between(lo: int, hi: int) -> Column:
    return F.col("iyear").between(lo, hi)


def filter_incidents(
    df: DataFrame,
    years: tuple[int, int],
    region: str | None = None,
    country: str | None = None,
    attack: str | None = None,
    group: str | None = None,
) -> DataFrame:
    """Rows with coordinates, in the year range, and equal to each option given (``All`` or None: no filter).

    Values enter as literals, so quotes in a name do no harm, and all predicates reach the parquet scan.
    """
    keep = has_coordinates() & year_between(*years)
    chosen = {"region_txt": region, "country_txt": country, "attacktype1_txt": attack, "gname": group}
    for col, value in chosen.items():
        if value is not None and value != ALL:
            keep = keep & (F.col(col) == F.lit(value))
    return df.where(keep)


def dashboard_columns(df: DataFrame) -> DataFrame:
    return df.select(*DASHBOARD_COLUMNS)


def locations(df: DataFrame) -> DataFrame:
    return df.select("latitude", "longitude")


def with_year_label(df: DataFrame) -> DataFrame:
    return df.withColumns({"iyear": F.col("iyear").cast("int"), "iyear_str": F.col("iyear").cast("int").cast("string")})


def fill_casualties(df: DataFrame) -> DataFrame:
    """``nkill_size`` is taken from the original ``nkill`` (1 if unknown) before that becomes 0."""
    return df.withColumns({
        "nkill_size": F.coalesce(F.col("nkill"), F.lit(1)),
        "nkill": zero_if_null(F.col("nkill")),
        "nwound": zero_if_null(F.col("nwound")),
    })


def year_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("iyear").alias("min_year"), F.max("iyear").alias("max_year"))


def filter_options(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    """``All`` first, then the distinct values of ``col``; a NULL value stays an option."""
    if where is not None:
        df = df.where(where)
    found = df.select(F.lit(1).alias("ordinal"), F.col(col).alias("option")).distinct()
    first = df.sparkSession.range(1).select(F.lit(0).alias("ordinal"), F.lit(ALL).alias("option"))
    return first.unionByName(found).orderBy("ordinal", F.col("option").asc_nulls_last())


def restrict_to(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is in a key list. Spark knows the size of a top-n list and broadcasts it; a long list
    is joined by shuffle."""
    return df.join(keys.select(col), col, "left_semi")
