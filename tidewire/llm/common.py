"""What the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that Python functions get: texts are long, so a batch must not hold too many.
BATCH_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, most_bytes: int | None = None) -> None:
    """Lower the session's Arrow batch size to :data:`BATCH_ROWS` rows; a smaller one is left as it is.

    With ``most_bytes``, a batch ends with so many bytes too (a longer row is one batch), on the JVM's side as well.
    """
    if most_bytes:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most_bytes))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has such a column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hashed_below(name: str, share: float) -> Column:
    """Whether a 64-bit hash lies in the least ``share`` of all hashes; always for 1 and more."""
    return F.col(name) < int(share * 2.0**64 - 2.0**63) if share < 1 else F.lit(True)


def utf8(text: str = "text") -> Column:
    """The UTF-8 bytes of a string column, NULL as no bytes."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def row_uid(stored: DataFrame) -> Column:
    """A number for each row of a stored table, the same in every job of the session that reads it.

    The number goes by input partition. Spark cuts files by the cores at hand, which change when executors come and
    go, so the number of cores that counts is fixed when this is first called, unless it is set.
    """
    spark, key = stored.sparkSession, "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    return F.monotonically_increasing_id()


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(uid, doc_id, raw): the rows of a stored table with :func:`row_uid` and the text's bytes."""
    return docs.select(
        row_uid(docs).alias("uid"), docs[doc_id].cast("long").alias("doc_id"), utf8(text).alias("raw")
    )
