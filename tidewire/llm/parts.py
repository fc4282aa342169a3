"""Hashes, their packed form, and blocks of rows, for operators that count hashes of a corpus in parts of the hash space."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import zstandard

#: Bits of a hash that are sent. Equal hashes of different things only cost work, or a document count that is 1 too high.
HASH_BITS = 48
#: A block ends with so many bytes of text or rows; a longer text is one block. Row ordinals have 16 bits.
BLOCK_BYTES, BLOCK_ROWS = 6_000_000, 60_000


def give_back() -> None:
    """Return free memory to the system. A worker lives on after a task, and would keep what its largest block took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``work`` on a group, after which free memory is returned."""

    @wraps(work)
    def then_give_back(rows: pa.Table) -> pa.Table:
        try:
            return work(rows)
        finally:
            give_back()

    return then_give_back


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(sorted_keys: np.ndarray) -> bytes:
    """Increasing 64-bit numbers as compressed byte planes of their differences."""
    steps = np.diff(sorted_keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.cumsum(planes.reshape(8, -1).T.copy().view("<u8").ravel(), dtype=np.uint64)


def cut_parts(keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(part, first, end) of the sorted keys (hash, then 16 bits) in each part of the hash space that has some."""
    part = ((keys >> np.uint64(16)).astype(np.float64) * (parts / 2.0**HASH_BITS)).astype(np.int64)
    cuts = np.searchsorted(part, np.arange(parts + 1)).tolist()
    for number, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
        if low < high:
            yield number, low, high


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[dict[str, list]]:
    """Rows of the batches in blocks of ``most`` bytes, as lists by column. ``column`` holds the bytes."""
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        cells = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        held = held or {name: [] for name in cells}
        for row, raw in enumerate(cells[column]):
            if held[column] and (size + len(raw) > most or len(held[column]) >= BLOCK_ROWS):
                yield held
                held, size = {name: [] for name in cells}, 0
                give_back()
            for name, values in cells.items():
                held[name].append(values[row])
            size += len(raw)
    if held and held[column]:
        yield held
        held = {}
        give_back()


def pack_ids(ids: list[int | None]) -> bytes:
    """Numbers of which some are None: a flag for each, then 8 bytes each."""
    return np.array([i is not None for i in ids], np.uint8).tobytes() + np.array([i or 0 for i in ids], "<i8").tobytes()


def unpack_ids(packed: bytes) -> pa.Array:
    count = len(packed) // 9
    return pa.array(np.frombuffer(packed[count:], "<i8"), mask=np.frombuffer(packed[:count], np.uint8) == 0)
