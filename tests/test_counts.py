import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewire.session import scratch_path
from tidewire.sources import commits, tables
from tidewire.streaming import counts
from tidewire.streaming import ingest as stream
from test_streaming import Pipeline, message

NAMES = ["arrived", "rejected", "stored", "duplicates"]


@pytest.fixture
def pipe(spark):
    return Pipeline(spark)


def test_counts_of_batches_add_up_to_the_table(spark, pipe):
    pipe.land(message("a"), message("b", "u"), message("a"), "no json", "")
    pipe.run()
    pipe.land(message("a"), message("c", "v", "bad time"))
    pipe.run()
    pipe.land(message("d", "w"), message(None, "x"), message(None, "x"))
    pipe.run()
    held = counts.read_counts(spark, pipe.path)
    assert rows(held.select("batch_id", *NAMES)) == [(0, 5, 2, 2, 1), (1, 2, 1, 0, 1), (2, 3, 0, 2, 1)]
    assert held.agg(F.sum("stored")).first()[0] == pipe.stored().count()
    assert held.agg(F.sum("rejected")).first()[0] == tables.read_rejected(spark, pipe.bad, pipe.path).count()


def test_counts_of_lost_and_replayed_batches(spark, pipe):
    pipe.land(message("a"), message("b", "u"))
    batch = stream.from_topic(spark.read.parquet(pipe.landing))
    tables.ensure_articles(spark, pipe.path)
    counts.ensure_counts(spark, pipe.path)
    assert counts.read_counts(spark, pipe.path).count() == 0
    stream.stage_batch(batch, 0, pipe.path, None, "run", commits.read_state(spark, pipe.path))
    assert counts.read_counts(spark, pipe.path).count() == 0
    for _ in range(2):
        stream.append_new_articles(batch, 0, pipe.path, run="run")
    assert rows(counts.read_counts(spark, pipe.path).select(*NAMES)) == [(2, 0, 2, 0)]


def test_a_listener_hears_each_batch(spark, pipe):
    pipe.land(message("a"), message("a"), "no json")
    pipe.land(message("b", "u"), message("a"))
    path, checkpoint = scratch_path(spark, "first"), scratch_path(spark, "checkpoint")
    source = stream.read_article_stream(spark, "parquet", {"path": pipe.landing, "maxFilesPerTrigger": "1"})
    heard, other = counts.BatchCounts("articles"), counts.BatchCounts("others")
    for listener in (heard, other):
        spark.streams.addListener(listener)
    stream.ingest_first(source, path, checkpoint, {"availableNow": True}, name="articles").awaitTermination()
    heard.wait()
    for listener in (heard, other):
        spark.streams.removeListener(listener)
    table = heard.table(spark)
    assert sorted(r.arrived for r in table.collect()) == [2, 3] and other.table(spark).count() == 0
    total = table.agg(*[F.sum(name) for name in NAMES]).first()
    assert tuple(total) == (5, 1, 2, 2) and spark.read.parquet(path).count() == 2
    with pytest.raises(TimeoutError):
        other.wait(0.01)
