"""Exactly n rows out of many, repeatable and without a big sort.

A plain top-k keeps up to n rows of *every* partition and merges them in one task. With n in the ten thousands, many
partitions and wide rows, that merge is the bottleneck. Here only hashes are ranked, and only those at the cut:

1. keys and hashes are written once;
2. a histogram of 65,536 hash prefixes tells in which the n-th smallest hash lies, and one of the next 65,536 below it;
3. the few hashes that share both prefixes are ranked, which gives the cut;
4. every row decides by its own hash whether it is in.

The rows themselves are neither sorted nor moved, and the result is the same as that of the plain top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

_PREFIX = 4  # hex digits, 16**4 histogram bins


def _cut_bin(hashed: DataFrame, start: int, n: int) -> tuple[str, int] | None:
    """The prefix from digit ``start`` in which the n-th smallest digest lies, and how many are wanted of it."""
    bins = hashed.groupBy(F.substring("digest", start, _PREFIX).alias("bin")).agg(F.count("*").alias("rows"))
    # At most 16**4 bins.
    upto = F.sum("rows").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    before = bins.withColumn("before", upto - F.col("rows")).where(F.col("before") < n)
    last = before.agg(F.max(F.struct("bin", "before"))).first()[0]
    return (last["bin"], n - last["before"]) if last else None


def random_sample(df: DataFrame, key: str, n: int = 20_000, seed: int = 42) -> DataFrame:
    """Uniform sample of exactly ``n`` rows (all, if there are fewer). ``key`` must be unique."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    near = materialize(df.select(digest.alias("digest"), F.col(key).alias("key")), "digests")
    for start in (1, 1 + _PREFIX):
        found = _cut_bin(near, start, n)
        if found is None:
            return df.limit(0)
        last_bin, n = found
        near = near.where(F.substring("digest", start, _PREFIX) == last_bin)
    cut = near.orderBy("digest", "key").limit(n).agg(F.max(F.struct("digest", "key"))).scalar()
    return df.where(F.struct(digest.alias("digest"), F.col(key).alias("key")) <= cut)


def first_n(df: DataFrame, n: int, key: str) -> DataFrame:
    """Any ``n`` rows, the same ones each time. ``key`` must be unique."""
    return random_sample(df, key, n, seed=0)


def texts(df: DataFrame, col: str, key: str, limit: int | None = None) -> DataFrame:
    """Rows with a non-null text; all of them unless a limit is asked for."""
    found = df.where(F.col(col).isNotNull()).select(key, col)
    return found if limit is None else first_n(found, limit, key)


def materialize_sample(df: DataFrame, key: str, n: int = 20_000, seed: int = 42, path: str | None = None) -> DataFrame:
    """Store a sample for interactive use and return the stored table."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "sample")
    random_sample(df, key, n, seed).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
