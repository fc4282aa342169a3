"""Packing: first-fit decreasing into token sequences, with a tournament tree, in randomised groups."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from struct import Struct
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches
from .wordpieces import WordPieces

#: Pieces that a group has on average. First-fit decreasing is close to optimal from some hundreds on.
GROUP_PIECES = 5_000
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, lot long"


class Recent(dict):
    """A dict that asks ``make`` for what it lacks. When full, it becomes the older generation, whose keys come back when
    they are asked for again: what is frequent stays, what is not goes with the next generation."""

    def __init__(self, make, most: int = 300_000, longest: int = 48):
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def _of_worker(name: str, make):
    """What ``make`` gives, made once in each Python worker and kept for its later tasks.

    This module goes to the workers by value, anew for each task, so its own variables do not last.
    """
    store = sys.modules.setdefault("tidewire_worker", ModuleType("tidewire_worker")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


class Encoder:
    """Ids of white-space units and what they are made of, as bytes. For one Python worker."""

    def __init__(self, path: str):
        self.words = words = WordPieces(path)
        formats = [Struct(f"<{n}I") for n in range(64)]

        def packed(piece: str) -> bytes:
            ids = words.ids(piece)
            return formats[len(ids)].pack(*ids) if len(ids) < 64 else Struct(f"<{len(ids)}I").pack(*ids)

        # Most units that are looked up here are one pre-token.
        def of_unit(unit: str) -> bytes:
            pieces = words.pretokens(unit)
            return self.pieces[pieces[0]] if len(pieces) == 1 else b"".join([self.pieces[p] for p in pieces])

        self.pieces, self.units = Recent(packed), Recent(of_unit)

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.units.__getitem__, self.words.units(text)))


def _mix(number: int) -> int:
    """A 62-bit hash of a number."""
    number = (number + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    number = ((number ^ number >> 30) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    number = ((number ^ number >> 27) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return (number ^ number >> 31) >> 2


def token_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = 4096,
    end_id: int = 2,
    with_ids: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each document's ids and ``end_id``, cut from its start into pieces of ``capacity`` and a rest.

    NULL and empty texts have ``end_id`` only. ``lot`` is a random number per piece, the same whenever a task runs
    again on the same input partition. ``with_ids`` adds the ids themselves.
    """
    bounded_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _of_worker(f"encoder {path}", lambda: Encoder(path))
        end = np.array([end_id], "<u4").tobytes()
        lot = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.ids(value or "") + end
                for at in range(0, len(ids), 4 * capacity):
                    piece = ids[at : at + 4 * capacity]
                    lot += 1
                    row = (key, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, _mix(lot))
                    out.append(row + ((np.frombuffer(piece, "<i4"),) if with_ids else ()))
            columns = list(zip(*out)) or [()] * (6 + with_ids)
            arrays = [pa.array(c, pa.int64()) for c in columns[:6]]
            arrays += [pa.array(columns[6], pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])

    schema = PIECE + ", ids array<int>" * with_ids
    return docs.select(docs[doc_id].cast("long"), docs[text].cast("string")).mapInArrow(work, schema)


class Bins:
    """Open bins as a tournament tree: each node holds the most room below it, bins stand in order of opening."""

    def __init__(self, capacity: int, most: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        # Bins that are not open yet have all their room: the first that fits may be a new one.
        self.room = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> tuple[int, int]:
        """(bin, offset in it) of the first bin with enough room, which is then less."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        offset = room[node]
        room[node] -= size
        found = node - self.leaves
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return found, offset


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece, which must be given longest first."""
    bins = Bins(capacity, len(lengths))
    return [(found, capacity - room) for found, room in map(bins.first_fit, lengths)]


def pack(pieces: DataFrame, capacity: int = 4096, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity`` and ``lot``) plus ``sequence_id`` and ``offset``.

    Pieces are dealt at random into groups of about ``group_pieces``, so that no source or document is together in
    one; each group is packed for itself. Pieces of a sequence lie gapless from 0 and sequences are not shared
    between groups. All other columns are passed on, ``lot`` is dropped. ``pieces`` should be a stored table, which
    is counted first.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    names = [c for c in pieces.columns if c != "lot"]
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "lot"]

    def work(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("lot", "ascending")])
        placed = first_fit_decreasing(rows.column("length").to_pylist(), capacity)
        group = rows.column("_group")[0].as_py()
        columns = [*(rows.column(c) for c in names), pa.array([group << 32 | b for b, _ in placed], pa.int64())]
        return pa.table([*columns, pa.array([o for _, o in placed], pa.int64())], [*names, "sequence_id", "offset"])

    dealt = pieces.withColumn("_group", F.pmod(F.col("lot"), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(work, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """One row per piece of every document: where it starts, how long it is, and its place in a sequence."""
    pieces = materialize(token_pieces(docs, path, capacity, end_id), "pieces")
    return pack(pieces, capacity)
