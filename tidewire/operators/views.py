"""Counts, sums, cross-tabs and rankings. Every view is one partial + final aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import zero_if_null
from ..session import materialize


def sorted_view(df: DataFrame, col: str, desc: bool = False, tie: str | None = None) -> DataFrame:
    """Sort with NULLs last in both directions; ``tie`` makes the order total."""
    first = F.col(col).desc_nulls_last() if desc else F.col(col).asc_nulls_last()
    return df.orderBy(first, *([F.col(tie).asc_nulls_last()] if tie else []))


def _grouped(df: DataFrame, keys: list[Column | str], drop_null_keys: bool):
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    if drop_null_keys:
        for col in cols:
            df = df.where(col.isNotNull())
    return df.groupBy(*cols)


def count_by(df: DataFrame, key: str, drop_null_keys: bool = False, name: str = "count") -> DataFrame:
    return _grouped(df, [key], drop_null_keys).agg(F.count("*").alias(name))


def sum_by(df: DataFrame, key: str, value: str, drop_null_keys: bool = False, name: str | None = None) -> DataFrame:
    total = F.sum(zero_if_null(F.col(value))).alias(name or value)
    return _grouped(df, [key], drop_null_keys).agg(total)


def incidents_per_year(df: DataFrame) -> DataFrame:
    return sorted_view(count_by(df, "iyear"), "iyear")


def fatalities_per_year(df: DataFrame) -> DataFrame:
    return sorted_view(sum_by(df, "iyear", "nkill", name="fatalities"), "iyear")


def ranked_counts(df: DataFrame, key: str, name: str, drop_null_keys: bool = False) -> DataFrame:
    """All groups of ``key``, the largest first."""
    counts = count_by(df, key, drop_null_keys).withColumnRenamed(key, name)
    return sorted_view(counts, "count", desc=True, tie=name)


def exclude_value(col: str, value: str) -> Column:
    """Not the given value; NULL does not pass either."""
    return F.col(col) != value


def top_n(df: DataFrame, key: str, n: int, drop_null_keys: bool = False) -> DataFrame:
    """The ``n`` most frequent keys; ties go to the smaller key."""
    counts = count_by(df, key, drop_null_keys)
    return counts.orderBy(F.col("count").desc(), F.col(key).asc_nulls_last()).limit(n)


def top_n_by_sum(
    df: DataFrame, key: str, value: str, n: int, exclude: str | None = None, name: str = "total"
) -> DataFrame:
    if exclude is not None:
        df = df.where(exclude_value(key, exclude))
    sums = sum_by(df, key, value, name=name)
    return sums.orderBy(F.col(name).desc(), F.col(key).asc_nulls_last()).limit(n)


def cooccurrence(df: DataFrame, a: str, b: str, drop_null_keys: bool = False) -> DataFrame:
    return _grouped(df, [a, b], drop_null_keys).agg(F.count("*").alias("count"))


def crosstab(
    df: DataFrame, a: str, b: str, values: list[str] | None = None, drop_null_keys: bool = True,
    null_column: str = "(none)",
) -> DataFrame:
    """Matrix of counts, one row per ``a``, one column per value of ``b``, 0 where a pair is missing.

    With ``drop_null_keys=False`` NULL in ``a`` is a row of its own and NULL in ``b`` the column ``null_column``.

    With ``values`` the result is lazy. Without, the column names come from the data: the pair counts are written
    once and both the names and the matrix come from there, so the input is scanned once. Spark refuses more than
    ``spark.sql.pivotMaxValues`` columns; :func:`cooccurrence` has the same content in long form.
    """
    if drop_null_keys:
        df = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    counts = df.groupBy(a, b).agg(F.count("*").alias("count"))
    if not drop_null_keys:
        counts = counts.withColumn(b, F.coalesce(b, F.lit(null_column)))
    if values is None:
        counts = materialize(counts, "crosstab")
    matrix = counts.groupBy(a).pivot(b, values).agg(F.sum("count"))
    cells = [c for c in matrix.columns if c != a]
    return matrix.na.fill(0, cells) if cells else matrix


def order_rows_by(matrix: DataFrame, ranked: DataFrame, key: str, rank: str) -> DataFrame:
    """Rows of ``matrix`` in the order of a ranked list of keys."""
    return matrix.join(ranked.select(key, rank), key).orderBy(rank)


def trend(df: DataFrame, drop_null_keys: bool = False, attack: str = "attack") -> DataFrame:
    """Incidents and fatalities per year and attack type."""
    grouped = _grouped(df, [F.col("iyear"), F.col("attacktype1_txt").alias(attack)], drop_null_keys)
    totals = grouped.agg(F.count("*").alias("incidents"), F.sum(zero_if_null(F.col("nkill"))).alias("fatalities"))
    return totals.orderBy(F.col("iyear").asc_nulls_last(), F.col(attack).asc_nulls_last())


def with_bubble_size(df: DataFrame) -> DataFrame:
    return df.withColumn("bubble_size", F.col("fatalities") * F.lit(0.5))


def kpis(df: DataFrame) -> DataFrame:
    """One row of totals; zeros for an empty input."""
    return df.agg(
        F.count("*").alias("total_incidents"),
        zero_if_null(F.sum("nkill")).alias("total_fatalities"),
        zero_if_null(F.sum("nwound")).alias("total_injuries"),
    )


def latest(df: DataFrame, ts_col: str, n: int = 10, tie: str | None = None) -> DataFrame:
    return df.orderBy(
        F.col(ts_col).desc_nulls_last(), *([F.col(tie).asc_nulls_last()] if tie else [])
    ).limit(n)
