"""Article stream: topic or landed files -> decode -> de-duplicate -> append, with a quarantine.

Every micro-batch overwrites its own ``run=<id>/batch_id=<n>`` folder. The run is the id that Spark keeps in the
checkpoint: batch numbers that start again under a new checkpoint belong to another run, and overwrite nothing. Rows, keys
and rejects of a batch count from one commit (:mod:`tidewire.sources.commits`): after a crash, under whatever checkpoint,
nothing is lost and nothing stored twice.

A batch reads only those parts of the key index that its own keys are in, and opens files in numbers that grow as the
logarithm of the batches before it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import dedupe_stream, new_rows, with_keys
from ..schemas import MESSAGE
from ..session import materialize, scratch_scope
from ..sources.articles import accepted, decode_articles, extract_article, quarantine, stored_columns
from ..sources.commits import State, commit_batch, prefix, read_keys, read_state, recover
from ..sources.splits import block_lines
from ..sources.tables import batch_path, ensure_articles, write_batch
from .counts import IN, OUT, counts_path, ensure_counts, in_counts, write_counts
from .stateful import first_articles

# Arrival order: total, and that of offsets inside a partition of a topic, or of lines inside a file.
ORDER_COLS = ["arrival_ts", "arrival_off", "arrival_part"]


def _with_arrival(df: DataFrame, ts: Column, part: Column, off: Column) -> DataFrame:
    return df.select(
        "value", ts.alias("arrival_ts"), part.cast("string").alias("arrival_part"), off.alias("arrival_off")
    )


def from_topic(df: DataFrame) -> DataFrame:
    # Times may be set by producers and run against the offsets, so they do not count.
    return _with_arrival(df, F.lit(None).cast("timestamp"), F.col("partition"), F.col("offset"))


def read_article_stream(spark: SparkSession, source: str, options: dict[str, str]) -> DataFrame:
    """``kafka``: a topic from its start; ``parquet``: messages landed with topic columns; ``text``: JSON lines.

    Lines are in order of their place in the file, however many tasks read it; files in order of their time.
    """
    options = dict(options)
    if source == "kafka":
        reader = spark.readStream.format("kafka").options(**{"startingOffsets": "earliest", **options})
        return from_topic(reader.load())
    path = options.pop("path")
    if source == "parquet":
        return from_topic(spark.readStream.schema(MESSAGE).options(**options).parquet(path))
    if source == "text":
        # Whatever else the caller sets: lines end with LF, and a file is read by as many tasks as it has blocks.
        files = spark.readStream.options(**{**options, "lineSep": "\n", "wholetext": "false"}).text(path)
        lines = block_lines(files.select("value", "_metadata")).withColumn("value", F.regexp_replace("value", "\r$", ""))
        return _with_arrival(lines.where("value != ''"), F.col("time"), F.col("file"), F.col("offset"))
    raise ValueError(f"unknown source {source!r}")


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def stage_batch(
    batch: DataFrame, batch_id: int, path: str, quarantine_path: str | None, run: str, state: State
) -> tuple[DataFrame, int]:
    """Write the unseen articles of a micro-batch and what cannot be decoded. Neither counts before the commit."""
    spark = batch.sparkSession
    came = Observation()
    read = extract_article(decode_articles(batch), keep=ORDER_COLS).observe(came, *in_counts())
    # Of the fields, which the message holds, only the keys are written and shuffled; new rows are read from it again.
    narrow = with_keys(read).select(*ORDER_COLS, "raw_json", "reject_reason", "_url", "_title_time", "_uid")
    extracted = materialize(narrow, "extracted")
    if quarantine_path:
        bad = quarantine(extracted, keep=ORDER_COLS)
        bad.write.mode("overwrite").parquet(batch_path(quarantine_path, run, batch_id))
    good = accepted(extracted)
    key = F.coalesce("_url", "_title_time")
    # At most 65,536 numbers: the first 16 bits of the keys.
    prefixes = [r[0] for r in good.select(prefix(key)).where(key.isNotNull()).distinct().collect()]
    chosen = new_rows(good, read_keys(spark, path, state, prefixes), ORDER_COLS)
    fresh = extract_article(decode_articles(good.join(chosen, "_uid", "left_semi"), "raw_json"))
    keys, rows = write_batch(spark, stored_columns(fresh), path, run, batch_id)
    write_counts(spark, batch_path(counts_path(path), run, batch_id), **came.get, stored=rows)
    return keys, 2 * rows


def append_new_articles(
    batch: DataFrame, batch_id: int, path: str, quarantine_path: str | None = None, run: str = "direct"
) -> None:
    """Store the unseen articles of one micro-batch and set the undecodable messages aside.

    Rows, keys and rejects count from one commit, which is written last. A batch that is replayed after its commit is
    left as it is; one that was interrupted before is written anew.
    """
    spark = batch.sparkSession
    state = read_state(spark, path)
    if state.committed.get(run, -2) >= batch_id:
        return
    with scratch_scope(spark):
        keys, count = stage_batch(batch, batch_id, path, quarantine_path, run, state)
        commit_batch(spark, path, state, run, batch_id, keys, count)


def ingest(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    quarantine_path: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream. The checkpoint holds the read position, so a restart loses and repeats nothing.

    Under another checkpoint the table goes on: what is stored stays, and is not stored again. Batch size is set on
    the reader (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``), the idle flush here (default: every second).
    """
    spark = messages.sparkSession
    ensure_articles(spark, path)
    ensure_counts(spark, path)
    recover(spark, path)

    def store(batch: DataFrame, batch_id: int) -> None:
        append_new_articles(batch, batch_id, path, quarantine_path, run_of(spark, checkpoint))

    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).foreachBatch(store).start()


def ingest_first(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    remember_ms: int = 0,
    name: str | None = None,
) -> StreamingQuery:
    """Ingest with keyed state and no look at what is stored: a key counts as seen for ``remember_ms`` (0: for ever).

    All accepted articles take part, those without url or time by the same rule as in :func:`ingest`. The sink is a plain
    Parquet stream, exactly once by its own log; another checkpoint starts with empty state, so it needs another path.
    A :class:`~tidewire.streaming.counts.BatchCounts` of the same ``name`` hears what became of each batch.
    """
    came = extract_article(decode_articles(messages), keep=ORDER_COLS).observe(IN, *in_counts())
    # The message holds the fields, so it goes through the state alone and is read again behind it.
    unique = first_articles(accepted(came), ORDER_COLS, remember_ms, carry=["raw_json"])
    first = stored_columns(extract_article(decode_articles(unique, "raw_json")))
    first = first.observe(OUT, F.count(F.lit(1)).alias("stored"))
    writer = first.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).format("parquet").start(path)


def ingest_recent(
    messages: DataFrame, path: str, checkpoint: str, delay: str, trigger: dict | None = None
) -> StreamingQuery:
    """Ingest with bounded state and no look at what is stored: a url counts as seen for ``delay`` of event time.

    Articles without url or time are left out; :func:`ingest_first` keeps them. The sink is a plain Parquet stream, exactly once by its own log.
    """
    rows = accepted(extract_article(decode_articles(messages)))
    timed = rows.withColumn("event_time", F.col("published_at").cast("timestamp"))
    timed = timed.where("coalesce(url, '') != '' AND event_time IS NOT NULL")
    unique = dedupe_stream(timed, ["url"], "event_time", delay).drop("event_time")
    writer = unique.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).format("parquet").start(path)
