import datetime as dt
import json
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewire.operators import dedupe
from tidewire.plans import bindings
from tidewire.schemas import MESSAGE
from tidewire.session import scratch_path
from tidewire.sources import articles, commits, tables
from tidewire.streaming import ingest as stream


def message(url, title="t", published="2025-01-01T00:00:00Z", **more):
    return json.dumps({"url": url, "title": title, "publishedAt": published, **more})


def land(spark, path, values, start):
    stamped = [
        (None, v.encode(), 0, start + i, dt.datetime(2025, 1, 1) + dt.timedelta(seconds=start + i))
        for i, v in enumerate(values)
    ]
    spark.createDataFrame(stamped, MESSAGE).coalesce(1).write.mode("append").parquet(path)


class Pipeline:
    def __init__(self, spark):
        self.spark = spark
        self.landing, self.path, self.bad, self.checkpoint = (
            scratch_path(spark, name) for name in ("landing", "stored", "bad", "checkpoint")
        )
        self.offset = 0

    def land(self, *values):
        land(self.spark, self.landing, values, self.offset)
        self.offset += len(values)

    def run(self, **options):
        source = stream.read_article_stream(self.spark, "parquet", {"path": self.landing, **options})
        stream.ingest(source, self.path, self.checkpoint, self.bad, {"availableNow": True}).awaitTermination()

    def stored(self):
        return tables.read_articles(self.spark, self.path)


@pytest.fixture
def pipe(spark):
    return Pipeline(spark)


def test_a_batch_shuffles_keys_and_writes_its_messages_once(spark, monkeypatch):
    written = {}
    for module in (dedupe, stream):
        real = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label, real=real: written.update({label: df.columns}) or real(df, label))
    path = scratch_path(spark, "articles")
    tables.ensure_articles(spark, path)
    landed = [(None, message(u, t).encode(), 0, i, None) for i, (u, t) in enumerate([("a", "x"), ("a", "y"), (None, "x"), (None, "z")])]
    stream.append_new_articles(stream.from_topic(spark.createDataFrame(landed, MESSAGE)), 0, path)
    assert rows(tables.read_articles(spark, path).select("url", "title")) == [(None, "z"), ("a", "x")]
    assert not {"title", "description", "content"} & set(written["extracted"])
    assert not {"title", "raw_json", "content"} & set(written["first"])


def test_ensure_articles_idempotent(spark):
    path = scratch_path(spark, "articles")
    tables.ensure_articles(spark, path)
    tables.ensure_articles(spark, path)
    assert tables.read_articles(spark, path).count() == 0


def test_restart_no_loss(pipe):
    pipe.land(message("a"), message("a"), message("b"), "{broken")
    pipe.run()
    pipe.land(message("b"), message("c"), message(None, published="notadate"))
    pipe.run()
    pipe.run()
    assert rows(pipe.stored().select("url", "batch_id")) == [("a", 0), ("b", 0), ("c", 1)]
    bad = pipe.spark.read.parquet(pipe.bad)
    assert rows(bad.select("reject_reason")) == [("bad timestamp",), ("invalid json",)]


def test_small_batches_give_the_same_table(pipe):
    for part in (("a", "b"), ("b", "c"), ("a", "d")):
        pipe.land(*[message(url) for url in part])
    pipe.run(maxFilesPerTrigger="1")
    assert [r.url for r in pipe.stored().orderBy("url").collect()] == ["a", "b", "c", "d"]
    assert pipe.stored().select("batch_id").distinct().count() == 3


def test_stream_goes_on_after_compaction(pipe):
    for part in (("a", "b"), ("b", "c"), ("d",)):
        pipe.land(*[message(url) for url in part])
        pipe.run()
    before = rows(pipe.stored().drop("batch_id", "run"))
    new_path = scratch_path(pipe.spark, "compact")
    tables.compact_articles(pipe.spark, pipe.path, new_path)
    pipe.path = new_path
    assert rows(pipe.stored().drop("batch_id", "run")) == before
    assert rows(pipe.stored().select("batch_id").distinct()) == [(-1,), (2,)]
    assert pipe.stored().select("run").distinct().count() == 2
    pipe.land(message("a"), message("e"))
    pipe.run()
    assert rows(pipe.stored().select("url", "batch_id").where("batch_id > 2")) == [("e", 3)]
    empty = scratch_path(pipe.spark, "empty")
    tables.ensure_articles(pipe.spark, empty)
    tables.compact_articles(pipe.spark, empty, f"{empty}-compact")
    assert tables.read_articles(pipe.spark, f"{empty}-compact").count() == 0


def test_replay_idempotent(spark):
    path = scratch_path(spark, "stored")
    tables.ensure_articles(spark, path)

    def batch(*values):
        return spark.createDataFrame(
            [(v, dt.datetime(2025, 1, 1), "0", i) for i, v in enumerate(values)],
            "value string, arrival_ts timestamp, arrival_part string, arrival_off long",
        )

    def stored():
        return rows(tables.read_articles(spark, path).select("batch_id", "url", "title"))

    first = batch(message("a"), message(None, "x"), message(None, "x"))
    second = batch(message("a"), message("b"), message(None, "x"), message(None, "y"))
    stream.append_new_articles(first, 0, path)
    stream.append_new_articles(second, 1, path)
    expected = [(0, None, "x"), (0, "a", "t"), (1, None, "y"), (1, "b", "t")]
    assert stored() == expected
    stream.append_new_articles(second, 1, path)
    assert stored() == expected


def test_new_checkpoint_keeps_what_is_stored(pipe):
    pipe.land(*[message(f"u{i}", title=f"t{i}") for i in range(10)])
    pipe.run()
    pipe.checkpoint = scratch_path(pipe.spark, "another")
    pipe.land(message("u3"), message("new"), message(None, "t4"), message(None, "other"))
    pipe.run()
    urls = [r.url for r in pipe.stored().collect()]
    assert sorted(filter(None, urls)) == sorted([f"u{i}" for i in range(10)] + ["new"])
    assert urls.count(None) == 1
    # The first checkpoint goes on where it was.
    pipe.checkpoint = scratch_path(pipe.spark, "third")
    pipe.run()
    assert pipe.stored().count() == 12


def test_a_small_batch_reads_few_buckets(spark, monkeypatch):
    path = scratch_path(spark, "stored")
    tables.ensure_articles(spark, path)
    monkeypatch.setattr(commits, "KEYS_PER_BUCKET", 10)
    many = spark.range(500).selectExpr(
        "to_json(struct(concat('u', id) AS url)) AS value", "cast(null AS timestamp) AS arrival_ts",
        "'0' AS arrival_part", "id AS arrival_off",
    )
    stream.append_new_articles(many, 0, path)
    state = commits.read_state(spark, path)
    keys = commits.read_keys(spark, path).withColumn("prefix", commits.prefix(F.col("key")))
    assert keys.select("key").distinct().count() == 500
    assert len(commits.key_files(spark, path, state.runs)) > 60
    some = keys.limit(3).collect()
    pruned = commits.read_keys(spark, path, state, [r.prefix for r in some])
    assert {r.key for r in some} <= {r.key for r in pruned.collect()} and pruned.count() < 60


def test_first_line_of_a_text_file_wins(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [message(f"u{i % 20}", title="first" if i < 20 else "second") for i in range(40)]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines) + "\n")
    source = stream.read_article_stream(spark, "text", {"path": str(tmp_path / "in")})
    path, checkpoint = scratch_path(spark, "stored"), scratch_path(spark, "checkpoint")
    stream.ingest(source, path, checkpoint, trigger={"availableNow": True}).awaitTermination()
    assert rows(tables.read_articles(spark, path).select("title")) == [("first",)] * 20


def test_a_text_file_is_split_and_keeps_the_order_of_its_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [message(f"u{i % 200}", title=f"{i:05d}") for i in range(2_000)]
    (tmp_path / "in" / "a.json").write_text("\r\n".join(["", *lines]) + "\n")
    settings = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        source = stream.read_article_stream(spark, "text", {"path": str(tmp_path / "in")})
        seen = []

        def keep(batch, _):
            parts = batch.select(F.spark_partition_id().alias("p"), "arrival_off", F.get_json_object("value", "$.title"))
            seen.extend(parts.collect())

        checkpoint = str(tmp_path / "seen")
        source.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        path, checkpoint = scratch_path(spark, "stored"), scratch_path(spark, "checkpoint")
        stream.ingest(source, path, checkpoint, trigger={"availableNow": True}).awaitTermination()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len({r[0] for r in seen}) > 5
    assert [r[2] for r in sorted(seen, key=lambda r: r[1])] == [f"{i:05d}" for i in range(2_000)]
    assert rows(tables.read_articles(spark, path).select("title")) == [(f"{i:05d}",) for i in range(200)]


def test_offsets_order_a_partition_not_times(spark):
    path = scratch_path(spark, "stored")
    tables.ensure_articles(spark, path)
    landed = [(None, message("a", title="early").encode(), 0, 1, dt.datetime(2025, 1, 2)),
              (None, message("a", title="late").encode(), 0, 2, dt.datetime(2025, 1, 1))]
    stream.append_new_articles(stream.from_topic(spark.createDataFrame(landed, MESSAGE)), 0, path)
    assert rows(tables.read_articles(spark, path).select("title")) == [("early",)]


def test_stream_equals_batch(spark, sf, pipe):
    bindings.landed_messages(spark, sf, broken=True).write.parquet(pipe.landing)
    pipe.run()
    decoded = articles.decode_articles(bindings.messages(spark, sf, broken=True))
    good = articles.accepted(articles.extract_article(decoded, keep=["off"]))
    batch = dedupe.new_articles(good, None, ["off"])
    columns = ["title", "url", "published_at", "source_name", "content"]
    assert rows(pipe.stored().select(columns)) == rows(batch.select(columns))


def test_text_lines_source(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([message("a"), message("b"), message("a")]) + "\n")
    source = stream.read_article_stream(spark, "text", {"path": str(tmp_path / "in")})
    path, checkpoint = scratch_path(spark, "stored"), scratch_path(spark, "checkpoint")
    stream.ingest(source, path, checkpoint, trigger={"availableNow": True}).awaitTermination()
    assert rows(tables.read_articles(spark, path).select("url")) == [("a",), ("b",)]


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        stream.read_article_stream(spark, "carrier pigeon", {"path": "x"})


def test_topic_is_read_from_its_start():
    """No connector here: only the options are checked."""
    spark = MagicMock()
    stream.read_article_stream(spark, "kafka", {"subscribe": "news", "maxOffsetsPerTrigger": "50"})
    reader = spark.readStream.format
    reader.assert_called_once_with("kafka")
    reader.return_value.options.assert_called_once_with(
        startingOffsets="earliest", subscribe="news", maxOffsetsPerTrigger="50"
    )


def test_watermark_dedupe(spark, pipe):
    pipe.land(message("a", published="2025-01-01T00:00:00Z"), message("a", published="2025-01-01T00:10:00Z"),
              message("b", published="2025-01-01T00:20:00Z"))
    source = stream.read_article_stream(spark, "parquet", {"path": pipe.landing})
    out = articles.extract_article(articles.decode_articles(source)).withColumn(
        "event_time", F.col("published_at").cast("timestamp")
    )
    path = scratch_path(spark, "unique")
    run = (
        dedupe.dedupe_stream(out, ["url"], "event_time", "1 hour")
        .writeStream.option("checkpointLocation", pipe.checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(path)
    )
    run.awaitTermination()
    assert rows(spark.read.parquet(path).select("url")) == [("a",), ("b",)]


def test_crash_between_rows_and_commit(spark, pipe, monkeypatch):
    """The rows are written, the record is not; another checkpoint then reads the source from its start."""
    pipe.land(*[message(f"u{i}", title=f"t{i}") for i in range(10)], "{broken")

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "write_state", crash)
        with pytest.raises(Exception, match="lost"):
            pipe.run()
    assert pipe.stored().count() == 0 and spark.read.parquet(f"{pipe.path}/run=*/batch_id=0").count() == 10
    lost, pipe.checkpoint = pipe.checkpoint, scratch_path(spark, "another")
    pipe.run()
    assert sorted(r.url for r in pipe.stored().collect()) == sorted(f"u{i}" for i in range(10))
    assert spark.read.parquet(pipe.bad).count() >= 1
    assert tables.read_rejected(spark, pipe.bad, pipe.path).count() == 1
    # The first checkpoint goes on with the batch that failed, and finds everything stored.
    pipe.checkpoint = lost
    pipe.land(message("later"))
    pipe.run()
    pipe.run()
    assert pipe.stored().count() == 11


def test_crash_before_the_batch_is_whole(spark, pipe):
    pipe.land(message("a"))
    pipe.run()
    state = commits.read_state(spark, pipe.path)
    run = next(r for r in state.committed if r != "none")
    stray = pipe.stored().select(tables.ARTICLES.names)
    stray.write.parquet(tables.batch_path(pipe.path, run, 1))
    left = commits.write_key_run(spark.createDataFrame([(b"0" * 32,)], "key binary"), pipe.path, 0, 1)
    assert pipe.stored().count() == 1 and commits.read_keys(spark, pipe.path).count() == 2
    commits.recover(spark, pipe.path)
    assert left.name not in commits._Folder(spark, f"{pipe.path}-keys").names()
    assert spark.read.parquet(pipe.path).count() == 1
