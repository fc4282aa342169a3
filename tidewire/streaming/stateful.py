"""Streams with keyed state and timers: de-duplication with bounded state, and flushing by size or silence.

State lives in the state store (RocksDB) by key, is versioned with the checkpoint, and is looked up for the keys of a batch
only. Each group of keys is a call into Python and each key a look into the store, so :func:`tidewire.streaming.ingest.ingest` is the faster way where a table of all
articles is wanted; these are for endless streams that must forget, and for consumers that must not wait.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.dedupe import title_time_key, url_key

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Fixed names of the columns that the processors share.
ARRIVAL = ["arrival_ts", "arrival_off", "arrival_part"]


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that processors with timers need, for queries that are started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _least(held: pd.DataFrame | None, some: pd.DataFrame, key: str) -> pd.DataFrame:
    """The first row of each key by arrival."""
    both = some if held is None else pd.concat([held, some])
    return both.sort_values("tw_arrival", kind="stable").drop_duplicates(key)


class FirstByUrl(StatefulProcessor):
    """Of the rows of a key, only the first ever; rows without a url all pass. A group holds many keys."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "key string", "seen boolean", self.ttl_ms or None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = None
        for batch in rows:
            keyed = batch["tw_url_key"].notna()
            if not keyed.all():
                yield batch[~keyed]
            if keyed.any():
                held = _least(held, batch[keyed], "tw_url_key")
        if held is None:
            return
        fresh = held[[not self.seen.containsKey((k,)) for k in held["tw_url_key"]]]
        for k in fresh["tw_url_key"]:
            self.seen.updateValue((k,), (True,))
        if len(fresh):
            yield fresh

    def close(self) -> None:
        pass


class FirstByTitleTime(StatefulProcessor):
    """Rows with a url pass and block later rows without one; of those, the first passes if nothing was there before.

    Rows without title or time all pass. A group holds many keys.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "key string", "seen boolean", self.ttl_ms or None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, blocked_from = None, {}
        for batch in rows:
            keyed, by_url = batch["tw_title_key"].notna(), batch["tw_has_url"].astype(bool)
            free = ~keyed | by_url
            if free.any():
                yield batch[free]
            urls = batch[keyed & by_url]
            for k, arrival in zip(urls["tw_title_key"], urls["tw_arrival"]):
                blocked_from[k] = min(arrival, blocked_from.get(k, arrival))
            if not free.all():
                held = _least(held, batch[~free], "tw_title_key")
        candidates = {} if held is None else dict(zip(held["tw_title_key"], held["tw_arrival"]))
        # The first row of a key always passes, so from now on something is stored under it.
        unknown = {k for k in candidates.keys() | blocked_from.keys() if not self.seen.containsKey((k,))}
        for k in unknown:
            self.seen.updateValue((k,), (True,))
        passing = [k in unknown and not (k in blocked_from and blocked_from[k] <= a) for k, a in candidates.items()]
        if any(passing):
            yield held[passing]

    def close(self) -> None:
        pass


def first_articles(
    articles: DataFrame, order_cols: list[str] = ARRIVAL, remember_ms: int = 0, carry: list[str] | None = None
) -> DataFrame:
    """The rows of a stream that are first of their key, by the rule of :mod:`tidewire.operators.dedupe`, for all rows.

    A key is forgotten ``remember_ms`` of processing time after it was stored (0: never; else
    use a trigger that goes on). Rows without url, title or time
    have no key and all pass. ``order_cols`` give the order inside a micro-batch. The columns of ``carry`` (all) are passed on.
    """
    columns, spark = carry or articles.columns, articles.sparkSession
    use_rocksdb(spark)
    # One text that sorts as the arrival columns do: whole numbers and times are padded, NULLs come first.
    parts = [
        F.coalesce(F.when(F.lit(kind in ("bigint", "int")), F.format_string("%020d", F.col(c).cast("long")))
                   .otherwise(F.col(c).cast("string")), F.lit(""))
        for c, kind in ((c, dict(articles.dtypes)[c]) for c in order_cols)
    ]
    arrival = F.concat_ws("\x01", *parts)
    # Names that begin with an underscore do not reach the processors.
    keyed = articles.withColumns({
        "tw_arrival": arrival, "tw_has_url": url_key().isNotNull(),
        "tw_url_key": F.hex(url_key()), "tw_title_key": F.hex(title_time_key()),
    })
    # A call into Python takes milliseconds, so it is made for each of 4,096 groups of keys, by their first 12 bits.
    group = lambda key: F.upper(F.substring(F.coalesce(key, F.sha2("tw_arrival", 256)), 1, 3))
    keyed = keyed.select(*columns, "tw_arrival", "tw_has_url", "tw_url_key", "tw_title_key").withColumns({
        "tw_url_group": group("tw_url_key"), "tw_title_group": group("tw_title_key")
    })
    # Forgetting goes by processing time, with which Spark goes on with batches for ever, so "availableNow" does not end.
    schema, mode = keyed.schema, "ProcessingTime" if remember_ms else "None"
    by_url = keyed.groupBy("tw_url_group").transformWithStateInPandas(
        FirstByUrl(remember_ms), schema, "Append", mode
    )
    by_both = by_url.groupBy("tw_title_group").transformWithStateInPandas(
        FirstByTitleTime(remember_ms), schema, "Append", mode
    )
    return by_both.select(columns)


class Flushes(StatefulProcessor):
    """Holds the rows of a group back until there are ``size``, or none has come for ``idle_ms``."""

    def __init__(self, size: int, idle_ms: int, columns: list[str], schema: str):
        self.size, self.idle_ms, self.columns, self.schema = size, idle_ms, columns, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)
        self.flushes = handle.getValueState("flushes", "n long")

    def _flushed(self, rows: list[tuple], reason: str) -> pd.DataFrame:
        number = self.flushes.get()[0] if self.flushes.exists() else 0
        self.flushes.update((number + 1,))
        out = pd.DataFrame(rows, columns=self.columns)
        return out.assign(flush=number, reason=reason)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.rows.get()] if self.rows.exists() else []
        for batch in rows:
            held += [tuple(r) for r in batch[self.columns].itertuples(index=False)]
            while len(held) >= self.size:
                yield self._flushed(held[: self.size], "size")
                held = held[self.size :]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held:
            self.rows.put(held)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        else:
            self.rows.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.rows.get()] if self.rows.exists() else []
        self.rows.clear()
        if held:
            yield self._flushed(held, "idle")

    def close(self) -> None:
        pass


def flush_groups(messages: DataFrame, group: str = "arrival_part", size: int = 50, idle_ms: int = 1_000) -> DataFrame:
    """Rows of a stream as they are flushed, with ``flush`` (0, 1, … in their group) and ``reason`` (size or idle).

    A group, such as a partition of a topic, is flushed when it has ``size`` rows, or when none has come for
    ``idle_ms``; less than ``size`` rows of a group are held in the state, so what is held is bounded by the groups.
    """
    use_rocksdb(messages.sparkSession)
    columns = messages.columns
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in messages.schema)
    processor = Flushes(size, idle_ms, columns, kept)
    return messages.groupBy(group).transformWithStateInPandas(
        processor, f"{kept}, flush long, reason string", "Append", "ProcessingTime"
    )
