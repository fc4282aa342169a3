"""First-writer-wins de-duplication of articles, as set operations.

The rule, for rows taken in arrival order: a row with a url is stored iff that url is not stored yet; a row without
one is stored iff no stored row, with or without a url, has the same non-null title and time.

Both kinds of key are taken as hashes of 256 bits, so keys of any length are narrow and equal only if the texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.articles import url_missing
from ..session import materialize


def _has_title_time() -> Column:
    return F.col("title").isNotNull() & F.col("published_at").isNotNull()


def url_key() -> Column:
    """NULL where there is no url."""
    return F.when(~url_missing(F.col("url")), F.unhex(F.sha2(F.concat(F.lit("u"), F.col("url")), 256)))


def title_time_key() -> Column:
    """NULL where title or time is NULL."""
    text = F.concat(F.lit("t"), F.col("published_at").cast("string"), F.lit(" "), F.col("title"))
    return F.when(_has_title_time(), F.unhex(F.sha2(text, 256)))


def article_keys(stored: DataFrame, keep: list[str] = ()) -> DataFrame:
    """(key): under which stored rows block later ones, one or two per row."""
    keys = F.array_compact(F.array(url_key(), title_time_key()))
    return stored.select(*keep, F.explode(keys).alias("key"))


def unseen_by_url(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Batch rows whose url is not stored."""
    # Distinct before the join: a key stored many times is cut down inside each map task, and the join uses the
    # partitioning of the distinct. A key that is hot in the batch is split by the adaptive skew join.
    return batch.join(stored.where(~url_missing(F.col("url"))).select("url").distinct(), "url", "left_anti")


def unseen_by_title_time(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Batch rows whose (title, published_at) is not stored. A NULL in either never matches, such rows stay."""
    keys = ["title", "published_at"]
    return batch.join(stored.where(_has_title_time()).select(*keys).distinct(), keys, "left_anti")


def new_articles(batch: DataFrame, stored_keys: DataFrame | None, order_cols: list[str]) -> DataFrame:
    """The rows of ``batch`` to store, given the keys of stored rows (:func:`article_keys`; None: nothing yet).

    ``order_cols`` give the arrival order and must make it total. The batch is read once; what is first of its key
    and not stored is written to the shared folder, as two branches need it.
    """
    keyed = batch.withColumns({"_url": url_key(), "_title_time": title_time_key()})
    return _unseen(keyed, stored_keys, order_cols).select(batch.columns)


def with_keys(batch: DataFrame) -> DataFrame:
    """Adds ``_url``, ``_title_time`` and a number of the row, which holds only in what is written of it."""
    return batch.withColumns({
        "_url": url_key(), "_title_time": title_time_key(), "_uid": F.monotonically_increasing_id()
    })


def new_rows(written: DataFrame, stored_keys: DataFrame | None, order_cols: list[str]) -> DataFrame:
    """(_uid): the rows that :func:`new_articles` would keep, of a written table that has what :func:`with_keys` adds.

    Only keys, numbers and the arrival are shuffled, sorted and written.
    """
    narrow = written.select("_uid", "_url", "_title_time", *order_cols)
    return materialize(_unseen(narrow, stored_keys, order_cols).select("_uid"), "new")


def _unseen(keyed: DataFrame, stored_keys: DataFrame | None, order_cols: list[str]) -> DataFrame:
    arrival = F.col(order_cols[0]) if len(order_cols) == 1 else F.struct(*order_cols)
    keyed = keyed.withColumns({"_key": F.coalesce("_url", "_title_time"), "_arrival": arrival})
    # Rows without a key never match anything. Each gets a group of its own, or all of them would meet in one task.
    alone = F.unhex(F.sha2(F.concat_ws(" ", F.lit("a"), *[F.col(c).cast("string") for c in order_cols]), 256))
    keyed = keyed.withColumn("_key", F.coalesce("_key", alone))
    # Spark cuts a `row_number() = 1` filter down inside each map task (WindowGroupLimit), so a hot key sends at
    # most one row per task through the shuffle.
    order = Window.partitionBy("_key").orderBy("_arrival")
    first = keyed.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")
    if stored_keys is not None:
        first = first.join(stored_keys.select(F.col("key").alias("_key")).distinct(), "_key", "left_anti")
    first = materialize(first, "first")

    # A url row stored earlier in this batch also blocks a later row without url.
    by_url = F.col("_url").isNotNull()
    blockers = first.where(by_url & F.col("_title_time").isNotNull()).groupBy("_title_time").agg(
        F.min("_arrival").alias("_first")
    )
    blocked = first.where(~by_url & F.col("_title_time").isNotNull()).select("_title_time", "_arrival").join(
        blockers, "_title_time"
    ).where(F.col("_first") < F.col("_arrival")).select(F.col("_title_time").alias("_key"))
    return first.join(blocked, "_key", "left_anti")


def dedupe_stream(df: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Bounded-state variant for endless streams: a key is remembered for ``delay`` of event time."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
