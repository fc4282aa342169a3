"""Commits and the key index by themselves."""

import hashlib

import pytest

from tidewire.session import scratch_path
from tidewire.sources import commits


def keys_of(spark, names):
    return spark.createDataFrame([(hashlib.sha256(n.encode()).digest(),) for n in names], commits.KEY_SCHEMA)


def test_two_hundred_batches_open_few_files(spark):
    path, state, opened = scratch_path(spark, "table"), commits.State(), []
    for batch in range(200):
        state = commits.commit_batch(spark, path, state, "run", batch, keys_of(spark, [f"a{batch}", f"b{batch}"]), 2)
        opened.append(len(commits.key_files(spark, path, state.runs)))
    # Seven runs a level at most, and as many levels as 200 has digits to the base of eight.
    assert max(opened) <= 3 * (commits.FANOUT - 1) and opened[-1] == len(state.runs) == 3 + 1 + 0
    assert commits.read_keys(spark, path).distinct().count() == 400
    assert commits.read_state(spark, path) == state and state.committed == {"run": 199}
    # Merged runs and old records are gone.
    assert len(commits._Folder(spark, f"{path}-keys").names()) == 4
    assert len(commits._records(spark, path).names()) <= 2 * (commits.RECORDS_KEPT + 1)


def test_a_record_that_was_cut_off_does_not_count(spark):
    path = scratch_path(spark, "table")
    state = commits.commit_batch(spark, path, commits.State(), "run", 0, keys_of(spark, ["a"]), 1)
    commits._records(spark, path).create(f"{state.version + 1:012d}.json", '{"version": 2, "comm')
    assert commits.read_state(spark, path) == state
    later = commits.commit_batch(spark, path, state, "run", 1, keys_of(spark, ["b"]), 1)
    assert later.version == state.version + 2 and commits.read_state(spark, path) == later


def test_two_writers(spark):
    path = scratch_path(spark, "table")
    state = commits.commit_batch(spark, path, commits.State(), "run", 0, keys_of(spark, ["a"]), 1)
    commits.commit_batch(spark, path, state, "other", 0, keys_of(spark, ["b"]), 1)
    with pytest.raises(RuntimeError, match="another writer"):
        commits.commit_batch(spark, path, state, "run", 1, keys_of(spark, ["c"]), 1)
    assert commits.read_keys(spark, path).count() == 2


def test_buckets_follow_the_size_of_a_run(spark, monkeypatch):
    monkeypatch.setattr(commits, "KEYS_PER_BUCKET", 5)
    path = scratch_path(spark, "table")
    run = commits.write_key_run(keys_of(spark, [f"k{i}" for i in range(100)]), path, 0, 100)
    assert run.buckets == 20
    state = commits.State(runs=(run,))
    for key, number in commits.read_keys(spark, path, state).select("key", commits.prefix(commits.F.col("key"))).limit(5).collect():
        files = commits.key_files(spark, path, state.runs, [number])
        assert len(files) == 1 and spark.read.parquet(files[0]).where(commits.F.col("key") == commits.F.lit(key)).count() == 1
    assert commits.key_files(spark, path, state.runs, []) == []


def test_an_empty_table(spark):
    path = scratch_path(spark, "table")
    assert commits.read_state(spark, path) == commits.State() == commits.recover(spark, path)
    assert commits.read_keys(spark, path).count() == 0
    state = commits.commit_batch(spark, path, commits.State(), "run", 0, keys_of(spark, []), 0)
    assert state.runs == () and state.committed == {"run": 0}
