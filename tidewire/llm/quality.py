"""Quality rules: counts of words, symbols and repetition, and bands of zstandard ratios."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope
from .common import bounded_batches, utf8

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_bytes long, ratio double, n_chunks long, n_bad_chunks long"
)
# Fixed values of the contract.
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Allowed ratios of plain to compressed bytes, ends included.

    ``whole``: (length below which it holds, least, most) for whole documents, the last one for all others. Short
    texts compress worse, since the frame and the literals weigh more, and repetition has less room to show.
    ``chunk``: least and most for each full chunk of ``chunk_bytes``; the rest after the last one is a chunk as well,
    with the band that ``whole`` has for its length. A document fails when more than ``bad_percent`` of its bytes lie
    in chunks outside their band.

    Documents of sf0.1 that pass the base rules have ratios of 1.34 to 1.84 below 512 bytes, 1.43 to 2.15 below 1,024,
    1.69 to 2.61 below 4,096, 2.09 to 2.76 below 16,384, 2.33 to 2.90 beyond, and 2.05 to 2.62 in 4,096 bytes; base64
    noise has 1.31 there. The bands leave room for text that is denser or more regular than this; where labels tell
    which texts are good, :func:`fit_bands` narrows them.
    """

    level: int = 3
    whole: tuple[tuple[float, float, float], ...] = (
        (256, 0.5, 3.0),
        (512, 1.15, 2.6),
        (1024, 1.3, 2.8),
        (4096, 1.45, 3.2),
        (16384, 1.6, 3.5),
        (65536, 1.7, 4.0),
        (float("inf"), 1.7, 5.0),
    )
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (1.6, 3.5)
    bad_percent: int = 20


@dataclass(frozen=True)
class Fit:
    """How bands are learned from documents that are labelled good.

    Documents are put into classes of length by powers of two. A class with ``enough`` of them gets the band from the
    quantile ``tail`` to the quantile 1 - ``tail`` of their ratios, widened by ``margin`` of itself on both sides; others
    keep what they had. All documents that are labelled good are learned from, unless ``most_labels`` is given: then those
    with the smallest hashes of their ids.
    """

    most_labels: int | None = None
    enough: int = 20
    tail: float = 0.005
    margin: float = 0.05


@dataclass
class Meter:
    """Measures one text after the other; holds the compressor."""

    bands: Bands = field(default_factory=Bands)

    def __post_init__(self) -> None:
        self.compress = zstandard.ZstdCompressor(level=self.bands.level).compress

    def ratio(self, raw: bytes) -> float:
        return len(raw) / len(self.compress(raw)) if raw else 0.0

    def band(self, n_bytes: int) -> tuple[float, float]:
        """Least and most for a text of that length."""
        return next((low, high) for below, low, high in self.bands.whole if n_bytes < below)

    def bad_chunks(self, raw: bytes) -> tuple[int, int, int]:
        """(chunks, those outside their band, the bytes in these)."""
        size, bad, bad_bytes = self.bands.chunk_bytes, 0, 0
        starts = range(0, len(raw), size)
        for start in starts:
            piece = raw[start : start + size]
            least, most = self.bands.chunk if len(piece) == size else self.band(len(piece))
            if not least <= self.ratio(piece) <= most:
                bad, bad_bytes = bad + 1, bad_bytes + len(piece)
        return len(starts), bad, bad_bytes

    def in_bands(self, n_bytes: int, ratio: float, bad_bytes: int) -> bool:
        least, most = self.band(n_bytes)
        return least <= ratio <= most and 100 * bad_bytes <= self.bands.bad_percent * n_bytes

    def row(self, raw: bytes) -> tuple:
        words = raw.split()  # bytes split at the six ASCII blanks only
        n_words = len(words)
        repeated = repeated_words(words)
        failed = base_failed(n_words, repeated)
        ratio, (chunks, bad, bad_bytes) = self.ratio(raw), self.bad_chunks(raw)
        return (
            n_words,
            len(raw.decode("utf-8", "replace")) - sum(raw.count(bytes([c])) for c in BLANKS),
            sum(raw.count(bytes([c])) for c in SYMBOLS),
            duplicate_lines(raw),
            repeated,
            failed,
            not failed and self.in_bands(len(raw), ratio, bad_bytes),
            len(raw),
            ratio,
            chunks,
            bad,
        )


def base_failed(n_words: int, repeated: int) -> bool:
    return n_words < 50 or 100 * repeated > 50 * n_words


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, end = 0, 0
    for start, window in enumerate(windows):
        if times[window] > 1:
            covered += start + 3 - max(start, end)
            end = start + 3
    return covered


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands: Bands | None = None) -> DataFrame:
    """One row per document with its counts, its ratios and the verdict ``kept``.

    A document is kept if it passes the base rules (50 words, at most half of them repeated) and its ratios lie in
    the bands. NULL and empty texts have no words and fail the base rules; ``doc_id`` is passed on, NULL as well;
    repeated rows are judged one by one. Needs no shuffle.
    """
    bounded_batches(docs.sparkSession)
    bands = bands or Bands()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(bands)
        for batch in batches:
            rows = [meter.row(raw) for raw in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) or [()] * 11
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64(), pa.float64()] + [pa.int64()] * 2
            arrays = [batch.column(0).cast(pa.int64()), *map(pa.array, columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(docs[doc_id].cast("long"), utf8(text)).mapInArrow(measure, SCHEMA)


def fit_bands(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    bands: Bands | None = None,
    fit: Fit | None = None,
) -> Bands:
    """``bands`` with those for whole documents narrowed to what documents with ``quality`` 1 show.

    Documents that fail the base rules teach nothing. NULL ids and labels, labels without a document and an empty table
    of labels are no harm: classes that are not learned keep their bands. A repeated label counts once, a repeated document
    as often as it is there. The quantiles are exact, so neither order nor partitions matter. What reaches the driver is a
    row per class of length and range of ratios.
    """
    bands, fit = bands or Bands(), fit or Fit()
    good = labels.where(labels[quality] == 1).select(labels[doc_id].cast("long").alias("id")).dropna().distinct()
    if fit.most_labels is not None:
        good = good.orderBy(F.xxhash64("id"), "id").limit(fit.most_labels)
    # All documents are measured where they lie, so that three numbers each meet the labels and no text is shuffled.
    taught = _ratios(docs, doc_id, text, bands).join(good, "id", "left_semi")
    whole = []
    for power, least, most in _tails(taught, fit):
        low, high = 1 << power, 1 << power + 1
        whole += _cut(bands.whole, whole[-1][0] if whole else 0, low)
        whole.append((high, least * (1 - fit.margin), most * (1 + fit.margin)))
    whole += _cut(bands.whole, whole[-1][0] if whole else 0, float("inf"))
    return replace(bands, whole=tuple(whole))


def _ratios(docs: DataFrame, doc_id: str, text: str, bands: Bands) -> DataFrame:
    """(id, n_bytes, ratio) of the documents that pass the base rules."""
    bounded_batches(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(bands)
        for batch in batches:
            passed, found = [], []
            for raw in batch.column(1).to_pylist():
                words = raw.split()
                passed.append(not base_failed(len(words), repeated_words(words)))
                if passed[-1]:
                    found.append((len(raw), meter.ratio(raw)))
            sizes, ratios = zip(*found) if found else ((), ())
            ids = batch.column(0).filter(pa.array(passed, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(ratios, pa.float64())], ["id", "n_bytes", "ratio"]
            )

    rows = docs.select(docs[doc_id].cast("long").alias("id"), utf8(text).alias("raw")).where("id IS NOT NULL")
    return rows.mapInArrow(measure, "id long, n_bytes long, ratio double")


def _tails(taught: DataFrame, fit: Fit) -> list[tuple[int, float, float]]:
    """(power of two, least, most) by class of length with ``enough`` rows: the quantiles of their ratios.

    Equal ratios of a class are counted first. Then ranges of ratios are laid out over the tasks; the sums of the ranges
    say in which of them a quantile lies and how far in, and only these are counted up.
    """
    spark, power = taught.sparkSession, F.floor(F.log2("n_bytes")).cast("int").alias("power")
    counts = taught.groupBy(power, "ratio").agg(F.count("*").alias("n"))
    with scratch_scope(spark):
        laid = counts.repartitionByRange("power", "ratio").withColumn("lot", F.spark_partition_id())
        lots = materialize(laid, "ratio-counts")
        of: dict[int, list] = {}
        for r in lots.groupBy("power", "lot").agg(F.sum("n").alias("n"), F.min("ratio").alias("least")).collect():
            of.setdefault(r.power, []).append((r.least, r.lot, r.n))
        wanted = []
        for power, ranges in of.items():
            total = sum(n for _, _, n in ranges)
            for end, share in enumerate((fit.tail, 1 - fit.tail) if total >= fit.enough else ()):
                rank = max(1, math.ceil(share * total))
                for _, lot, n in sorted(ranges):
                    if rank <= n:
                        wanted.append((power, lot, end, rank))
                        break
                    rank -= n
        if not wanted:
            return []
        wanted = spark.createDataFrame(wanted, "power int, lot int, end int, rank long")
        up_to = F.sum("n").over(Window.partitionBy("power", "lot", "end").orderBy("ratio"))
        found = lots.join(F.broadcast(wanted), ["power", "lot"]).withColumn("up_to", up_to)
        tails = found.where("up_to - n < rank AND rank <= up_to").orderBy("power", "end").collect()
    return [(least.power, least.ratio, most.ratio) for least, most in zip(tails[::2], tails[1::2])]


def _cut(whole: tuple[tuple[float, float, float], ...], low: float, high: float) -> list[tuple[float, float, float]]:
    """The bands for lengths from ``low`` to below ``high``."""
    starts = [0, *(below for below, _, _ in whole)]
    return [
        (min(below, high), least, most)
        for start, (below, least, most) in zip(starts, whole)
        if below > low and start < high and low < high
    ]


def keep_good(docs: DataFrame, bands: Bands | None = None, text: str = "text") -> DataFrame:
    """The documents that pass :func:`judge`, all their columns as they were, without a shuffle.

    NULL and empty texts go, as they have no words; repeated rows stay or go one by one; no documents give none.
    """
    bounded_batches(docs.sparkSession)
    bands = bands or Bands()
    at = docs.columns.index(text)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(bands)
        for batch in batches:
            kept = [meter.row((text or "").encode())[6] for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(sift, docs.schema)
