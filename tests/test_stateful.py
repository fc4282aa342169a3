"""Streams with keyed state and timers."""

import random
import time

import pandas as pd
from conftest import rows
from test_streaming import Pipeline, message

from tidewire.operators import dedupe
from tidewire.session import scratch_path
from tidewire.sources import articles
from tidewire.streaming import ingest as stream
from tidewire.streaming import stateful

COLUMNS = ["title", "url", "published_at"]


def some_messages(count):
    rng = random.Random(6)
    return [
        message(
            rng.choice([None, "", f"u{rng.randrange(12)}"]), rng.choice([None, f"t{rng.randrange(6)}"]),
            rng.choice([None, f"2025-01-0{rng.randrange(1, 4)}T00:00:00Z"]),
        )
        for _ in range(count)
    ]


def batch_result(spark, pipe):
    decoded = articles.decode_articles(stream.from_topic(spark.read.parquet(pipe.landing)))
    good = articles.accepted(articles.extract_article(decoded, keep=stream.ORDER_COLS))
    return rows(dedupe.new_articles(good, None, stream.ORDER_COLS).select(COLUMNS))


def test_state_equals_batch_over_several_runs(spark):
    pipe, path, values = Pipeline(spark), scratch_path(spark, "first"), some_messages(150)
    for low in (0, 60, 90):
        pipe.land(*values[low : {0: 60, 60: 90, 90: 150}[low]])
        source = stream.read_article_stream(spark, "parquet", {"path": pipe.landing})
        stream.ingest_first(source, path, pipe.checkpoint, {"availableNow": True}).awaitTermination()
    assert rows(spark.read.parquet(path).select(COLUMNS)) == batch_result(spark, pipe)


class Seen:
    def __init__(self):
        self.keys = set()

    def containsKey(self, key):
        return key in self.keys

    def updateValue(self, key, value):
        self.keys.add(key)


def test_a_call_takes_many_keys():
    def passed(processor, *batches):
        return sorted(n for out in processor.handleInputRows(("0AB",), iter(batches), None) for n in out["n"])

    columns = ["n", "tw_arrival", "tw_has_url", "tw_url_key", "tw_title_key"]
    by_url, by_title = stateful.FirstByUrl(0), stateful.FirstByTitleTime(0)
    by_url.seen, by_title.seen = Seen(), Seen()
    one = pd.DataFrame([(0, "5", True, "A", "T"), (1, "2", True, "A", "T"), (2, "3", True, "B", None)], columns=columns)
    two = pd.DataFrame([(3, "1", True, "B", None), (4, "1", False, None, "T"), (5, "9", False, None, None)], columns=columns)
    assert passed(by_url, one, two) == [1, 3, 4, 5]
    assert passed(by_url, one, two) == [4, 5]
    late = pd.DataFrame([(6, "7", False, None, "T"), (7, "8", False, None, "U"), (8, "4", False, None, "U")], columns=columns)
    assert passed(by_title, one, late) == [0, 1, 2, 8]
    assert passed(by_title, two, late) == [3, 5]


def test_keys_are_forgotten(spark):
    pipe, path = Pipeline(spark), scratch_path(spark, "first")
    pipe.land(message("a"), message(None, "x"))
    source = stream.read_article_stream(spark, "parquet", {"path": pipe.landing})
    trigger = {"processingTime": "200 milliseconds"}
    running = stream.ingest_first(source, path, pipe.checkpoint, trigger, remember_ms=1)
    try:
        for n in (2, 4):
            end = time.time() + 60
            while time.time() < end and (not running.lastProgress or spark.read.schema("url string").parquet(path).count() < n):
                assert running.exception() is None
                time.sleep(0.5)
            if n == 2:
                pipe.land(message("a"), message(None, "x"))
    finally:
        running.stop()
    assert rows(spark.read.parquet(path).select("url")) == [(None,), (None,), ("a",), ("a",)]


def flushed(spark, count, size, idle_ms, expected, seconds=90):
    landing, path, checkpoint = (scratch_path(spark, name) for name in ("landing", "flushed", "checkpoint"))
    spark.range(count).selectExpr("id AS off", "'p' AS arrival_part").coalesce(1).write.parquet(landing)
    source = spark.readStream.schema("off long, arrival_part string").parquet(landing)
    running = (
        stateful.flush_groups(source, size=size, idle_ms=idle_ms).writeStream.option("checkpointLocation", checkpoint)
        .trigger(processingTime="200 milliseconds").format("parquet").start(path)
    )
    try:
        end, found = time.time() + seconds, []
        while time.time() < end and len(found) < expected:
            time.sleep(0.5)
            assert running.exception() is None
            if running.lastProgress and running.lastProgress["batchId"] > 0:
                found = [tuple(r) for r in spark.read.schema("flush long, reason string").parquet(path).groupBy("flush", "reason").count().collect()]
        return sorted(found)
    finally:
        running.stop()


def test_flush_by_size_at_once(spark):
    # The idle time is longer than the test: only the size can flush.
    assert flushed(spark, 50, 50, 3_600_000, 1) == [(0, "size", 50)]


def test_flush_after_silence(spark):
    assert flushed(spark, 57, 50, 1_000, 2) == [(0, "size", 50), (1, "idle", 7)]
