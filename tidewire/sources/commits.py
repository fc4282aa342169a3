"""Commits of a table that grows by micro-batches, and the index of its keys.

Parquet has no transaction across files, so a batch counts from the moment a small record names it, which is written last.
Records are numbered files beside the table; the newest that can be read is the state: up to which batch each run has
been committed, and which key files are live. Readers of rows and of keys go by it, so nobody sees half a batch, and
what a crash left behind is overwritten or removed. A table has one writer at a time; of two, one fails to commit.

Keys of stored rows lie in *key runs*. A committed batch adds a run at level 0; ``FANOUT`` runs of a level are merged
into one of the next, so the number of live runs grows as the logarithm of the batches. A run is cut into buckets by the
first bits of the key (a hash), about ``KEYS_PER_BUCKET`` keys each, and a lookup opens the buckets its own keys are in.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path

#: Runs of a level that are merged, and keys of a bucket on average.
FANOUT, KEYS_PER_BUCKET = 8, 200_000
#: Records that are kept for readers that have just looked at an older one.
RECORDS_KEPT = 16
KEY_SCHEMA = "key binary"


@dataclass(frozen=True)
class KeyRun:
    name: str
    level: int
    buckets: int
    keys: int


@dataclass(frozen=True)
class State:
    """``committed``: the last batch of each run; batches of a run are numbered in order, so all before it count too."""

    version: int = 0
    committed: dict[str, int] = field(default_factory=dict)
    runs: tuple[KeyRun, ...] = ()


class _Folder:
    """A folder of the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._of = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._of(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        where = self._of(self.path)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def create(self, name: str, text: str) -> None:
        """A new file; fails if there is one of that name."""
        stream = self.fs.create(self._of(f"{self.path}/{name}"), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self._of(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _records(spark: SparkSession, path: str) -> _Folder:
    return _Folder(spark, f"{path.rstrip('/')}-commits")


def _keys_path(path: str, name: str = "") -> str:
    return f"{path.rstrip('/')}-keys/{name}".rstrip("/")


def _numbers(folder: _Folder) -> list[int]:
    return sorted(int(n.split(".")[0]) for n in folder.names() if n.endswith(".json") and not n.startswith("."))


def read_state(spark: SparkSession, path: str) -> State:
    """The newest record that is whole; one that a crash cut off does not count."""
    folder = _records(spark, path)
    for version in reversed(_numbers(folder)):
        try:
            held = json.loads(folder.read(f"{version:012d}.json"))
        except (ValueError, Py4JJavaError):
            continue
        return State(held["version"], held["committed"], tuple(KeyRun(**run) for run in held["runs"]))
    return State()


def write_state(spark: SparkSession, path: str, state: State) -> State:
    """The state under the next free number. Raises if another writer has taken it."""
    folder = _records(spark, path)
    numbers = _numbers(folder)
    following = replace(state, version=max([state.version, *numbers]) + 1)
    if any(n > state.version and _whole(folder, n) for n in numbers):
        raise RuntimeError(f"{path}: another writer has committed since version {state.version}")
    text = {
        "version": following.version, "committed": following.committed, "runs": [vars(run) for run in following.runs]
    }
    folder.create(f"{following.version:012d}.json", json.dumps(text))
    for old in numbers[:-RECORDS_KEPT]:
        delete_path(spark, f"{folder.path}/{old:012d}.json")
    return following


def _whole(folder: _Folder, number: int) -> bool:
    try:
        return bool(json.loads(folder.read(f"{number:012d}.json")))
    except (ValueError, Py4JJavaError):
        return False


def is_committed(state: State, run: Column, batch_id: Column) -> Column:
    """Whether rows of the partition columns ``run`` and ``batch_id`` count; it prunes folders."""
    if not state.committed:
        return F.lit(False)
    last = F.create_map(*[F.lit(v) for pair in state.committed.items() for v in pair])
    return F.coalesce(batch_id <= F.element_at(last, run), F.lit(False))


def prefix(key: Column) -> Column:
    """The first 16 bits of a key as a number."""
    return F.conv(F.hex(F.substring(key, 1, 2)), 16, 10).cast("int")


def _bucket(number: Column, buckets: int) -> Column:
    return F.shiftright(number.cast("long") * buckets, 16).cast("int")


def write_key_run(keys: DataFrame, path: str, level: int, count: int) -> KeyRun:
    """A sorted run of the (key) rows, of which there are at most ``count``. It counts once a state names it."""
    buckets = max(1, min(1 << 16, -(-count // KEYS_PER_BUCKET)))
    run = KeyRun(uuid.uuid4().hex, level, buckets, count)
    if buckets == 1:
        keys.coalesce(1).sortWithinPartitions("key").write.parquet(f"{_keys_path(path, run.name)}/bucket=0")
    else:
        cut = keys.withColumn("bucket", _bucket(prefix(F.col("key")), buckets)).repartition(buckets, "bucket")
        cut.sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(_keys_path(path, run.name))
    return run


def key_files(spark: SparkSession, path: str, runs: tuple[KeyRun, ...], prefixes: list[int] | None = None) -> list[str]:
    """The folders of buckets that may hold keys of those prefixes (None: of any)."""
    found = []
    for run in runs:
        folder = _Folder(spark, _keys_path(path, run.name))
        there = {int(n.split("=")[1]) for n in folder.names() if n.startswith("bucket=")}
        wanted = there if prefixes is None else there & {p * run.buckets >> 16 for p in prefixes}
        found += [f"{folder.path}/bucket={b}" for b in sorted(wanted)]
    return found


def read_keys(spark: SparkSession, path: str, state: State | None = None, prefixes: list[int] | None = None) -> DataFrame:
    """(key) of committed rows; with ``prefixes`` only from the buckets these can be in."""
    state = state or read_state(spark, path)
    files = key_files(spark, path, state.runs, prefixes)
    return spark.read.schema(KEY_SCHEMA).parquet(*files) if files else spark.createDataFrame([], KEY_SCHEMA)


def merged(spark: SparkSession, path: str, state: State) -> tuple[State, list[KeyRun]]:
    """``state`` after merging each level that is full, the lowest first, and the runs that went into others.

    Those stay until the state is committed, as the one before names them.
    """
    runs, gone, level = list(state.runs), [], 0
    while any(run.level >= level for run in runs):
        own = tuple(run for run in runs if run.level == level)
        if len(own) >= FANOUT:
            keys = read_keys(spark, path, replace(state, runs=own))
            whole = write_key_run(keys, path, level + 1, sum(run.keys for run in own))
            runs = [run for run in runs if run not in own] + [whole]
            gone += own
        level += 1
    return replace(state, runs=tuple(runs)), gone


def commit_batch(
    spark: SparkSession, path: str, state: State, run: str, batch_id: int, keys: DataFrame, count: int
) -> State:
    """Make a batch count whose rows are written: adds its keys, merges full levels, writes the record last."""
    if count:
        state = replace(state, runs=(*state.runs, write_key_run(keys, path, 0, count)))
    new, gone = merged(spark, path, replace(state, committed={**state.committed, run: batch_id}))
    following = write_state(spark, path, new)
    for old in gone:
        delete_path(spark, _keys_path(path, old.name))
    return following


def recover(spark: SparkSession, path: str) -> State:
    """Remove what batches without a commit left behind: folders of rows, and key runs that no state names."""
    state = read_state(spark, path)
    live = {run.name for run in state.runs}
    for name in _Folder(spark, _keys_path(path)).names():
        if name not in live:
            delete_path(spark, _keys_path(path, name))
    for run in (n for n in _Folder(spark, path).names() if n.startswith("run=")):
        last = state.committed.get(run.split("=", 1)[1], -2)
        for batch in (n for n in _Folder(spark, f"{path}/{run}").names() if n.startswith("batch_id=")):
            if int(batch.split("=")[1]) > last:
                delete_path(spark, f"{path}/{run}/{batch}")
    return state
