"""Cumulative animation frames: frame Y shows everything up to year Y."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def cumulative_frames(df: DataFrame, col: str = "iyear", label: str = "iyear_str") -> DataFrame:
    """Each row once per observed year at or after its own.

    The distinct observed years arrive as one array from a scalar subquery over this one column; each row then
    expands itself, so there is no join and no shuffle of the rows. The result has a row per row and later year, so
    show it for a selection, or store :func:`frame_spans`; :func:`cumulative_year_counts` is the aggregate.
    """
    years = (
        df.select(F.col(col).alias("y"))
        .where(F.col("y").isNotNull())
        .distinct()
        .agg(F.sort_array(F.collect_list("y")).alias("years"))
        .scalar()
    )
    frames = F.filter("_years", lambda year: year >= F.col(col))
    return (
        df.withColumn("_years", years)
        .withColumn("frame_year", F.explode(frames))
        .withColumn(label, F.col("frame_year").cast("string"))
        .drop("_years")
    )


def frame_spans(df: DataFrame, every: int = 1, col: str = "iyear") -> DataFrame:
    """Each row once, with the first and the last frame that show it: ``first_frame``, ``last_frame``.

    Frames stand at every ``every``-th year from the earliest on, the last one at or after the latest year. Rows without
    a year are in no frame. As large as the input, whatever the number of years; :func:`shown_in` picks a frame.
    """
    if every < 1:
        raise ValueError("every must be at least 1")
    bounds = df.agg(F.struct(F.min(col).alias("low"), F.max(col).alias("high"))).scalar()

    def frame(year):
        return (F.col("_bounds.low") + F.ceil((year - F.col("_bounds.low")) / every) * every).cast("int")

    spans = df.withColumn("_bounds", bounds).withColumn("first_frame", frame(F.col(col)))
    shown = F.when(F.col("first_frame").isNotNull(), frame(F.col("_bounds.high")))
    return spans.withColumn("last_frame", shown).drop("_bounds")


def shown_in(spans: DataFrame, frame: int) -> DataFrame:
    """The rows that a frame shows: a filter on the stored spans, which reaches their scan."""
    return spans.where(F.lit(frame).between(F.col("first_frame"), F.col("last_frame")))


def cumulative_year_counts(df: DataFrame, col: str = "iyear") -> DataFrame:
    """Per frame, the count of each single year up to it. Not a running sum.

    Counted per year first; frames are made from that result alone, one row per observed year.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("y")).agg(
        F.count("*").alias("n")
    )
    series = counts.agg(F.sort_array(F.collect_list(F.struct("y", "n"))).alias("series"))
    framed = series.select("series", F.explode("series.y").alias("frame"))
    shown = F.filter("series", lambda point: point["y"] <= F.col("frame"))
    points = framed.select("frame", F.inline(shown).alias("y", "n"))
    return points.select(
        F.col("y").alias(col),
        F.col("n").alias("count"),
        F.col("y").cast("string").alias("iyear_str"),
        F.col("frame").cast("string").alias("frame_year"),
    ).orderBy("frame", col)
