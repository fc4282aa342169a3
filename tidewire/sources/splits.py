"""Lines and records of text files that are read by many tasks.

Spark cuts a file into blocks of bytes and reads each by itself. Two things are then unknown inside a block: how many
lines stand before it, and whether it begins within a quoted field.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

RECORD = "file string, block long, row long, kind int, raw binary"
#: Parts of a record: all of it; its beginning; a block in the midst of it; its end.
WHOLE, OPENS, WITHIN, CLOSES = range(4)
QUOTE = b'"'


def block_lines(batch_or_stream: DataFrame) -> DataFrame:
    """(file, time, offset, value) of a text scan. Offsets grow with the place of a line in its file.

    The offset is the first byte of the block plus the number of lines of the block before. A block has no more lines
    than bytes, so offsets of later blocks are larger, and no file has to be read by one task.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count = None, 0
        for batch in batches:
            offsets = []
            for place in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                now, count = place, count + 1 if place == now else 0
                offsets.append(place[1] + count)
            columns = [batch.column(0), batch.column(1), pa.array(offsets, pa.int64()), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, ["file", "time", "offset", "value"])

    scan = batch_or_stream.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_block_start").alias("offset"),
        "value",
    )
    return scan.mapInArrow(work, "file string, time timestamp, offset long, value string")


def _records_of(open_: bool, lines: pa.Array) -> tuple[list[tuple[int, int]], bool]:
    """Spans of lines that form a record, and whether the last one goes on. ``open_``: so does the one before."""
    quotes = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False)
    after = (np.cumsum(quotes) + open_) % 2 == 1
    ends = (np.flatnonzero(~after) + 1).tolist()
    spans = list(zip([0, *ends], ends))
    return spans, bool(after[-1])


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the lines of blocks that come one after the other, in order, with ``open`` for the block's start.

    Holds a batch and the record it ends in.
    """
    names = [c.split()[0] for c in RECORD.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    now: tuple[str, int] | None = None
    held: list[bytes] = []
    inside = began_before = False
    row = 0

    def flush() -> list[tuple]:
        if not inside:
            return []
        return [(*now, row, WITHIN if began_before else OPENS, b"\n".join(held))]

    for batch in batches:
        files, blocks, opens, lines = (batch.column(i) for i in range(4))
        places = list(zip(files.to_pylist(), blocks.to_pylist()))
        cuts = [0, *(i for i in range(1, len(places)) if places[i] != places[i - 1]), len(places)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            if low == high:
                continue
            out = []
            if places[low] != now:
                out += flush()
                now, held, row = places[low], [], 0
                inside = began_before = opens[low].as_py()
            some = lines.slice(low, high - low)
            spans, ends_open = _records_of(inside, some)
            values = some.to_pylist()
            for a, b in spans:
                raw = b"\n".join(held + values[a:b]) if held or b - a > 1 else values[a]
                out.append((*now, row, CLOSES if began_before else WHOLE, raw))
                held, began_before, row = [], False, row + 1
            held = held + values[spans[-1][1] if spans else 0 :]
            inside = ends_open
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
    last = flush()
    if last:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*last), types)], names)


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, raw): the records of CSV files, whose quoted fields may hold line breaks; ``first`` of its file.

    Files are read twice, in blocks. First each block counts its quotes; their running sum over a file's blocks is odd
    where a block begins within a field. Then blocks are cut into records; the few that go over the end of a block are
    put together. Quotes must stand around or, doubled, in quoted fields only; records end with LF or CRLF. A file
    that ends in a quoted field is an error, as are blocks that Spark cuts otherwise the second time.
    """
    scan = spark.read.option("lineSep", "\n").text(path)
    lines = scan.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("raw"),
        F.col("value"),
    )
    quotes = F.sum(F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes")
    counted = lines.groupBy("file", "block").agg(quotes)
    before = Window.partitionBy("file").orderBy("block")
    running = counted.select("file", "block", (F.sum("quotes").over(before) % 2 == 1).alias("ends"))
    blocks = materialize(
        running.select("file", "block", "ends", F.coalesce(F.lag("ends").over(before), F.lit(False)).alias("open")),
        "blocks",
    )
    unclosed = blocks.groupBy("file").agg(F.max_by("ends", "block").alias("ends")).where("ends").limit(1).collect()
    if unclosed:
        raise ValueError(f"{unclosed[0].file} ends in a quoted field")
    known = F.coalesce(F.col("open"), F.raise_error(F.lit("files were cut otherwise the second time; read again")))
    numbered = lines.select("file", "block", "raw", F.monotonically_increasing_id().alias("row"))
    # A join by shuffle would change the order of the lines; one by broadcast, which Spark takes if blocks are few, not.
    placed = numbered.join(blocks.drop("ends"), ["file", "block"], "left").sortWithinPartitions("file", "block", "row")
    parts = materialize(
        placed.select("file", "block", known.alias("open"), "raw").mapInArrow(_join_lines, RECORD), "records"
    )
    # At most two a block. A record's parts follow one another in the order of blocks.
    pieces = parts.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "row")
    grouped = pieces.withColumn("record", F.sum((F.col("kind") == OPENS).cast("long")).over(order))
    part = F.struct("block", "row", F.hex("raw").alias("raw"))
    joined = grouped.groupBy("file", "record").agg(F.sort_array(F.collect_list(part)).alias("parts")).select(
        "file",
        ((F.col("parts")[0]["block"] == 0) & (F.col("parts")[0]["row"] == 0)).alias("first"),
        F.unhex(F.array_join("parts.raw", "0A")).alias("raw"),
    )
    first = (F.col("block") == 0) & (F.col("row") == 0)
    whole = parts.where(F.col("kind") == WHOLE).select("file", first.alias("first"), "raw")
    return whole.unionByName(joined)
