"""Token counts: the pieces of each distinct pre-token are counted once, joined to frequencies and summed.

Documents are taken in blocks. A block gives one row per distinct pre-token, with the documents that hold it and how
often, so a pre-token that is in every document is a row per block, not per document. These rows meet by pre-token,
sorted, where each is counted once; what comes back to a block is summed before it is sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .wordpieces import WordPieces

#: A block ends with so many characters or documents, whichever comes first; a longer document is one block.
BLOCK_CHARS, BLOCK_DOCS = 16_000_000, 60_000
#: Postings that are summed before they are sent back to their blocks.
SUM_ROWS = 4_000_000
SENT = "block long, pretoken string, ordinals binary, times binary, ids binary, n_bytes binary"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Slices of ``data``, one from each start to the next."""
    ends = np.append(starts, len(data)) * data.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    )


class Numbers(dict):
    """Numbers keys in the order in which they come."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class Block:
    """Documents whose pre-tokens go out together."""

    def __init__(self, words: WordPieces, number: int):
        self.words, self.number = words, number
        self.units, self.docs, self.ids, self.sizes, self.chars = Numbers(), [], [], [], 0

    def add(self, doc_id: int | None, text: str) -> None:
        self.docs.append(np.fromiter(map(self.units.__getitem__, self.words.units(text)), np.int64))
        self.ids.append(doc_id)
        self.sizes.append(len(text.encode()))
        self.chars += len(text)

    def rows(self) -> Iterator[pa.RecordBatch]:
        names = [column.split()[0] for column in SENT.split(", ")]
        known = np.array([i is not None for i in self.ids], np.uint8)
        header = known.tobytes() + np.array([i or 0 for i in self.ids], "<i8").tobytes()
        sizes = np.array(self.sizes, "<i8").tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([self.number]), pa.array([None], pa.string()), *(pa.array([x], pa.binary()) for x in (None, None, header, sizes))],
            names,
        )
        pretokens = Numbers()
        split = [[pretokens[p] for p in self.words.pretokens(unit)] for unit in self.units]
        many = np.array([len(s) for s in split], np.int64)
        first = np.cumsum(many) - many
        flat = np.array([p for s in split for p in s], np.int64)
        units = np.concatenate(self.docs)
        owner = np.repeat(np.arange(len(self.docs)), [len(d) for d in self.docs])
        reps = many[units]
        at = np.repeat(first[units] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
        keys, times = np.unique(flat[at] << 16 | np.repeat(owner, reps), return_counts=True)
        # A count over 255 takes several entries.
        entries = -(-times // 255)
        ends = np.cumsum(entries) - 1
        keys = np.repeat(keys, entries)
        packed = np.full(len(keys), 255, np.uint8)
        packed[ends] = times - 255 * (entries - 1)
        starts = np.flatnonzero(np.r_[True, np.diff(keys >> 16) != 0]) if len(keys) else np.array([], np.int64)
        text, ordinals = list(pretokens), (keys & 0xFFFF).astype("<u2")
        for low in range(0, len(starts), 20_000):
            some = starts[low : low + 20_000]
            end = starts[low + 20_000] if low + 20_000 < len(starts) else len(keys)
            nulls = pa.nulls(len(some), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), self.number)),
                    pa.array([text[p] for p in (keys[some] >> 16).tolist()], pa.string()),
                    _binary(ordinals[some[0] : end], some - some[0]),
                    _binary(packed[some[0] : end], some - some[0]),
                    nulls,
                    nulls,
                ],
                names,
            )


def frequencies(docs: DataFrame, path: str, doc_id: str, text: str) -> DataFrame:
    """A header row for each block with its documents, then a row per pre-token with its postings."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, made = WordPieces(path), 0
        number = TaskContext.get().partitionId() << 32
        block = Block(words, number)
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                value = value or ""
                if block.ids and (block.chars + len(value) > BLOCK_CHARS or len(block.ids) >= BLOCK_DOCS):
                    yield from block.rows()
                    made += 1
                    block = Block(words, number + made)
                block.add(key, value)
        if block.ids:
            yield from block.rows()

    bounded_batches(docs.sparkSession)
    return docs.select(docs[doc_id].cast("long"), docs[text].cast("string")).mapInArrow(work, SENT)


def _summed(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    blocks, ordinals, pieces = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((ordinals, blocks))
    blocks, ordinals, pieces = blocks[order], ordinals[order], pieces[order]
    first = np.flatnonzero(np.r_[True, (np.diff(blocks) != 0) | (np.diff(ordinals) != 0)])
    blocks, ordinals, pieces = blocks[first], ordinals[first].astype("<u2"), np.add.reduceat(pieces, first)
    starts = np.flatnonzero(np.r_[True, np.diff(blocks) != 0])
    nulls = pa.nulls(len(starts), pa.binary())
    columns = [pa.array(blocks[starts]), _binary(ordinals, starts), _binary(pieces.astype("<i8"), starts), nulls, nulls]
    yield pa.RecordBatch.from_arrays(columns, ["block", "ordinals", "pieces", "ids", "n_bytes"])


def token_counts(
    docs: DataFrame, path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, as the library of the ``tokenizers`` file counts.

    NULL and empty texts have no tokens; ``doc_id`` is passed on, NULL as well; repeated rows are counted each.
    Blocks are numbered by input partition, so ``docs`` should read a stored table, whose partitions come out the
    same when a lost task is run again.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last, pieces, held, size = WordPieces(path), None, 0, [], 0
        for batch in batches:
            header = batch.filter(batch.column("pretoken").is_null())
            if len(header):
                nulls = pa.nulls(len(header), pa.binary())
                columns = [header.column("block"), nulls, nulls, header.column("ids"), header.column("n_bytes")]
                yield pa.RecordBatch.from_arrays(columns, ["block", "ordinals", "pieces", "ids", "n_bytes"])
            batch = batch.filter(batch.column("pretoken").is_valid())
            counts = []
            for pretoken in batch.column("pretoken").to_pylist():
                if pretoken != last:  # sorted: each is counted once
                    last, pieces = pretoken, words.count(pretoken)
                counts.append(pieces)
            times = batch.column("times").to_pylist()
            lengths = [len(t) for t in times]
            ordinals = np.frombuffer(b"".join(batch.column("ordinals").to_pylist()), "<u2")
            weight = np.repeat(np.array(counts, np.int64), lengths) * np.frombuffer(b"".join(times), np.uint8)
            held.append((np.repeat(np.array(batch.column("block")), lengths), ordinals, weight))
            size += len(ordinals)
            if size >= SUM_ROWS:
                yield from _summed(held)
                held, size = [], 0
        if size:
            yield from _summed(held)

    def per_document(rows: pa.Table) -> pa.Table:
        header = next(r for r in zip(rows.column("ids").to_pylist(), rows.column("n_bytes").to_pylist()) if r[1] is not None)
        sizes = np.frombuffer(header[1], "<i8")
        known, ids = np.frombuffer(header[0][: len(sizes)], np.uint8), np.frombuffer(header[0][len(sizes) :], "<i8")
        total = np.zeros(len(sizes), np.int64)
        for ordinals, pieces in zip(rows.column("ordinals").to_pylist(), rows.column("pieces").to_pylist()):
            if ordinals:
                total[np.frombuffer(ordinals, "<u2")] += np.frombuffer(pieces, "<i8")
        columns = [pa.array(ids, mask=known == 0), pa.array(sizes), pa.array(total), pa.array(total > limit)]
        return pa.table(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    sent = frequencies(docs, path, doc_id, text)
    # Header rows have no pre-token; they are spread by their block.
    met = sent.repartition(F.coalesce("pretoken", F.col("block").cast("string"))).sortWithinPartitions("pretoken")
    partial = met.mapInArrow(count, "block long, ordinals binary, pieces binary, ids binary, n_bytes binary")
    return partial.groupBy("block").applyInArrow(per_document, SCHEMA)
