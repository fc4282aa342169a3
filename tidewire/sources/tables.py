"""Stored tables: plain Parquet datasets."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import article_keys
from ..schemas import ARTICLES
from .commits import State, commit_batch, is_committed, read_keys, read_state, write_state

log = logging.getLogger(__name__)
#: Of stored tables: texts take about half of what the usual codec leaves.
CODEC = "zstd"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _replace(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Overwrite a table and return its row count, observed during the write (no second scan)."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        # Rebalance gathers each partition value into well-sized files and splits a large one over many tasks.
        observed.hint("rebalance", partition_by).write.mode("overwrite").option("compression", CODEC).partitionBy(
            partition_by
        ).parquet(path)
    else:
        observed.write.mode("overwrite").option("compression", CODEC).parquet(path)
    rows = seen.get["rows"]
    log.info("%s: %d rows written", path, rows)
    return rows


def write_raw(df: DataFrame, path: str) -> int:
    return _replace(df, path)


def write_clean(df: DataFrame, path: str, partition_by_year: bool = False) -> int:
    """``partition_by_year`` lets year ranges skip whole folders."""
    return _replace(df, path, "iyear" if partition_by_year else None)


def load_report(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Row counts after load and after clean, for tables written without the count at hand."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(stage).alias("stage"), "rows")
              for stage, df in (("raw", raw), ("clean", clean))]
    return counts[0].unionByName(counts[1])


def batch_path(path: str, run: str, batch_id: int) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


def ensure_articles(spark: SparkSession, path: str) -> None:
    """Create the empty article table unless there is one. Batches live in ``run=<id>/batch_id=<n>`` folders."""
    spark.createDataFrame([], ARTICLES).write.mode("ignore").parquet(batch_path(path, "none", -1))
    if not read_state(spark, path).version:
        write_state(spark, path, State(committed={"none": -1}))


def _batches(fields: list[T.StructField]) -> T.StructType:
    return T.StructType([*fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])


def read_batches(spark: SparkSession, folder: str, schema: T.StructType, path: str) -> DataFrame:
    """Rows of the batches below ``folder`` that are committed in the table at ``path``."""
    rows = spark.read.schema(_batches(schema.fields)).parquet(folder)
    return rows.where(is_committed(read_state(spark, path), F.col("run"), F.col("batch_id")))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """The articles of committed batches, with ``run`` and ``batch_id``."""
    return read_batches(spark, path, ARTICLES, path)


def read_rejected(spark: SparkSession, quarantine_path: str, path: str) -> DataFrame:
    """What the committed batches of the table at ``path`` set aside."""
    return read_batches(spark, quarantine_path, spark.read.parquet(quarantine_path).drop("run", "batch_id").schema, path)


def write_batch(spark: SparkSession, rows: DataFrame, path: str, run: str, batch_id: int) -> tuple[DataFrame, int]:
    """Write a batch, which does not count yet. Returns the keys of its rows, two each at most, and the number of rows."""
    seen = Observation()
    own = batch_path(path, run, batch_id)
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", CODEC).parquet(own)
    return article_keys(spark.read.schema(ARTICLES).parquet(own)), seen.get["rows"]


def compact_articles(spark: SparkSession, path: str, new_path: str) -> None:
    """Copy an article table into few large files, for use when it has gathered many small batches.

    Run it while no stream writes, then go on with the same checkpoints and ``new_path``. The newest batch of each run
    keeps its own folder; all runs and batches are written by one job.
    """
    state = read_state(spark, path)
    stored = read_articles(spark, path)
    last = F.create_map(*[F.lit(v) for pair in state.committed.items() for v in pair])
    newest = (F.col("run") != "none") & (F.element_at(last, F.col("run")) == F.col("batch_id"))
    moved = stored.withColumns({
        "run": F.when(newest, F.col("run")).otherwise("compact"), "batch_id": F.when(newest, F.col("batch_id")).otherwise(-1)
    })
    ensure_articles(spark, new_path)
    whole = moved.hint("rebalance", "run", "batch_id").write.mode("append").option("compression", CODEC)
    whole.partitionBy("run", "batch_id").parquet(new_path)
    new = read_state(spark, new_path)
    keys = read_keys(spark, path, state)
    commit_batch(
        spark, new_path, State(new.version, {**state.committed, "compact": -1}), "none", -1, keys, sum(r.keys for r in state.runs)
    )


def export_results(results: dict[str, DataFrame], path: str) -> dict[str, str]:
    """One Parquet dataset per view. A view that fails does not stop the others; returns name -> 'ok' or the error."""
    outcome = {}
    for name, df in results.items():
        try:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            outcome[name] = "ok"
        except Exception as error:
            log.warning("view %s failed: %s", name, type(error).__name__)
            outcome[name] = f"{type(error).__name__}: {error}"
    return outcome
