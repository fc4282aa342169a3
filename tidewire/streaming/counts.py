"""What became of the messages of each micro-batch: arrived, rejected, stored, duplicates.

:func:`tidewire.streaming.ingest.ingest` keeps the counts beside its table, under the same commit as the batch. A stream
that stores by itself (``ingest_first``) reports them to a listener while it runs.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from ..sources.tables import batch_path, read_batches

COUNTS = "arrived long, rejected long, stored long, duplicates long"
#: Names under which a stream observes what comes in and what goes out.
IN, OUT = "tidewire_in", "tidewire_out"


def in_counts() -> list[Column]:
    """Aggregates over extracted articles."""
    return [F.count(F.lit(1)).alias("arrived"), F.count("reject_reason").alias("rejected")]


def counts_path(path: str) -> str:
    return f"{path.rstrip('/')}-counts"


def write_counts(spark: SparkSession, folder: str, arrived: int, rejected: int, stored: int) -> None:
    """One row for a batch in a folder of its own; what is neither rejected nor stored was there before."""
    values = {"arrived": arrived, "rejected": rejected, "stored": stored, "duplicates": arrived - rejected - stored}
    row = spark.range(1).select(*[F.lit(value).cast("long").alias(name) for name, value in values.items()])
    row.coalesce(1).write.mode("overwrite").parquet(folder)


def ensure_counts(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], COUNTS).write.mode("ignore").parquet(batch_path(counts_path(path), "none", -1))


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """A row per committed batch of the article table at ``path``, with ``run`` and ``batch_id``.

    The sum of ``stored`` is the number of its rows. Counts are no part of a compacted copy.
    """
    return read_batches(spark, counts_path(path), StructType.fromDDL(COUNTS), path)


class BatchCounts(StreamingQueryListener):
    """Gathers the counts of the micro-batches of one query, given by its checkpoint's id.

    Add it to ``spark.streams`` before the query starts. Events come later than the rows: call :meth:`wait` when the
    query has ended. A batch that is run again after a crash replaces its first report.
    """

    def __init__(self, name: str):
        self.name, self.batches = name, {}
        self._ended, self._id = threading.Event(), None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._id = event.id

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics
        if progress.name == self.name and IN in seen:
            came = seen[IN]
            self.batches[progress.batchId] = (came.arrived, came.rejected, seen[OUT].stored)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self._id:
            self._ended.set()

    def wait(self, seconds: float = 60) -> None:
        if not self._ended.wait(seconds):
            raise TimeoutError(f"{self.name}: no report of its end")

    def table(self, spark: SparkSession) -> DataFrame:
        """(batch_id, arrived, rejected, stored, duplicates), a row per micro-batch with messages."""
        rows = [(n, *c, c[0] - c[1] - c[2]) for n, c in sorted(self.batches.items()) if c[0] or c[2]]
        return spark.createDataFrame(rows, f"batch_id long, {COUNTS}")
