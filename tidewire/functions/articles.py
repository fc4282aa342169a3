"""Column helpers on article fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_missing(url: Column) -> Column:
    """NULL and the empty text both count as no url."""
    return url.isNull() | (url == "")


def dedupe_key(url: Column, title: Column, published_at: Column) -> Column:
    """The url, or title and time where there is none."""
    fallback = F.concat(
        F.coalesce(title, F.lit("None")), F.lit("|"), F.coalesce(published_at.cast("string"), F.lit("None"))
    )
    return F.when(url_missing(url), fallback).otherwise(url)
