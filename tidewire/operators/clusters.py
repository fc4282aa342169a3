"""Topic clusters of texts: k-means by cosine over TF-IDF vectors.

Weights, centres and sums are whole numbers, whose sum is the same in any order, so the clusters do not depend on how the
rows are spread over tasks. Rows are never shuffled in the rounds: a task gives each of its rows the nearest centre and
hands on one sum per cluster and word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.once import once
from ..session import materialize
from .text import token_counts

#: A vector or centre of length 1 has this length as whole numbers.
SCALE = 1 << 20
#: Centres go to every task, so clusters times words is bounded: 8 bytes each.
MOST_CELLS = 2_000_000
#: Seeds are chosen among so many different vectors per cluster.
TRIED_PER_SEED = 20
#: Words whose products with the centres are held at a time.
AT_ONCE = 100_000


def weighted_terms(
    df: DataFrame, row: str, col: str, stop: list[str], vocabulary: int = 20_000
) -> tuple[DataFrame, DataFrame]:
    """((row, term, weight), (term, token)): TF-IDF weights over the words that the most rows hold.

    weight = tf * (ln((1 + rows) / (1 + rows with the word)) + 1), by which a row's weights are scaled to length
    :data:`SCALE` and rounded. Ties for a place in the vocabulary go to the smaller word. Rows of one id are one text;
    NULL ids, NULL texts and texts without such words give nothing.
    """
    # Dealt out by row, a text's words are counted where it lies; texts are smaller than their words one by one.
    texts = df.select(F.col(row).alias("row"), F.col(col).alias("text")).dropna().repartition("row")
    counts = materialize(token_counts(texts, "text", stop, ["row"]).withColumnRenamed("count", "tf"), "term-counts")
    rows = counts.agg(F.count_distinct("row").cast("double").alias("rows")).scalar()
    most = counts.groupBy("token").agg(F.count("*").alias("held")).orderBy(F.desc("held"), "token").limit(vocabulary)
    idf = F.ln((F.col("rows") + 1) / (F.col("held") + 1)) + 1
    # One task numbers the vocabulary, which is bounded.
    number = F.row_number().over(Window.orderBy(F.desc("held"), "token")) - 1
    terms = materialize(most.withColumn("rows", rows).select(number.alias("term"), "token", idf.alias("idf")), "terms")
    weighted = counts.join(terms, "token").select("row", "term", (F.col("tf") * F.col("idf")).alias("w"))
    # Summed in order of the terms, so that the length is the same to the last bit.
    held = weighted.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("held"))
    # Beside an explode, Spark would work out the length anew for each word of the row.
    length = once(F.sqrt(F.aggregate("held", F.lit(0e0), lambda total, x: total + x.w * x.w)))
    cells = held.select("row", "held", length.alias("length")).select("row", "length", F.explode("held").alias("x")).select(
        "row", "x.term", F.rint(F.col("x.w") / F.col("length") * F.lit(float(SCALE))).cast("long").alias("weight")
    )
    return cells, terms.select("term", "token")


def _vectors(cells: DataFrame) -> DataFrame:
    held = cells.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("held"))
    return held.select("row", F.col("held.term").alias("terms"), F.col("held.weight").alias("weights"))


def choose_seeds(vectors: DataFrame, k: int, terms: int) -> np.ndarray:
    """At most ``k`` different vectors as rows of a matrix, chosen among those with the smallest hashes.

    Each next seed is the one that brings the sample nearest to its seeds; ties go to the smaller hash.
    """
    hashed = vectors.select(F.xxhash64("terms", "weights").alias("hash"), "terms", "weights").distinct()
    sample = hashed.orderBy("hash", "terms", "weights").limit(TRIED_PER_SEED * k).collect()
    dense = np.zeros((len(sample), terms), np.int64)
    for i, r in enumerate(sample):
        dense[i, r.terms] = r.weights
    alike = dense @ dense.T // SCALE
    chosen: list[int] = []
    best = np.zeros(len(sample), np.int64)
    while len(chosen) < min(k, len(sample)):
        gain = np.maximum(alike, best).sum(axis=1)
        gain[chosen] = -1
        chosen.append(int(np.argmax(gain)))
        best = np.maximum(best, alike[chosen[-1]])
    return dense[chosen]


def nearest_centres(batch: pa.RecordBatch, by_term: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(slice of rows, their nearest centre or -1, product with it) in slices of about :data:`AT_ONCE` words.

    Ties go to the smaller number; a row that shares no word with any centre has none.
    """
    lists = batch.column("terms")
    ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    terms, weights = (batch.column(c).flatten().to_numpy() for c in ("terms", "weights"))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + AT_ONCE, "right")) - 1)
        some = slice(ends[low], ends[high])
        products = by_term[terms[some]] * weights[some, None]
        sums = np.add.reduceat(products, ends[low:high] - ends[low], axis=0)
        best = sums.argmax(axis=1)
        value = sums[np.arange(high - low), best]
        yield slice(low, high), np.where(value > 0, best, -1), value
        low = high


def _round(vectors: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, int]:
    """(sums of the vectors of each cluster, how near all rows are to their centres)."""
    by_term = np.ascontiguousarray(centres.T)
    k, terms = centres.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, near = np.zeros((k, terms), np.int64), 0
        for batch in batches:
            ends = np.diff(batch.column("terms").offsets.to_numpy())
            held, weights = (batch.column(c).flatten().to_numpy() for c in ("terms", "weights"))
            labels = [np.zeros(0, np.int64)]
            for _, best, value in nearest_centres(batch, by_term):
                labels.append(best)
                near += int((value // SCALE).sum())
            of_word = np.repeat(np.concatenate(labels), ends)
            known = of_word >= 0
            np.add.at(total, (of_word[known], held[known]), weights[known])
        cluster, term = np.nonzero(total)
        columns = [np.append(cluster, -1), np.append(term, -1), np.append(total[cluster, term], near)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "term", "total"])

    parts = vectors.select("terms", "weights").mapInArrow(work, "cluster long, term long, total long")
    # At most clusters times words, and one row more.
    found = parts.groupBy("cluster", "term").agg(F.sum("total").alias("total")).toArrow()
    cluster, term, value = (found.column(c).to_numpy() for c in ("cluster", "term", "total"))
    sums, of_words = np.zeros((k, terms), np.int64), cluster >= 0
    sums[cluster[of_words], term[of_words]] = value[of_words]
    return sums, int(value[~of_words].sum())


def _centres(sums: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Sums scaled to :data:`SCALE`; a cluster without rows keeps the centre it had."""
    length = np.sqrt((sums.astype(float) ** 2).sum(axis=1, keepdims=True))
    scaled = np.rint(sums / np.where(length > 0, length, 1) * SCALE).astype(np.int64)
    return np.where(length > 0, scaled, before)


def topic_clusters(
    df: DataFrame,
    row: str,
    col: str,
    stop: list[str],
    k: int = 8,
    vocabulary: int = 20_000,
    rounds: int = 50,
    tolerance: float = 1e-4,
    top_terms: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """((row, cluster, similarity), (cluster, place, token, weight)): each text's cluster, and the clusters' first words.

    Ends when the centres stay, when the sum of all similarities grows by less than ``tolerance`` of itself, or after
    ``rounds``. Similarity is the cosine with the centre. Rows of one id are one text; a text without known words, or
    without one that any centre has, belongs to no cluster (NULL). Equal texts share a cluster; fewer different texts than
    ``k`` give fewer clusters. ``k`` times ``vocabulary`` may be at most :data:`MOST_CELLS`.
    """
    if k < 1 or vocabulary < 1 or k * vocabulary > MOST_CELLS:
        raise ValueError(f"k and vocabulary must be positive, their product at most {MOST_CELLS}")
    spark = df.sparkSession
    cells, terms = weighted_terms(df, row, col, stop, vocabulary)
    vectors = materialize(_vectors(cells), "vectors")
    centres = choose_seeds(vectors, k, terms.count())
    before = 0
    for _ in range(rounds if len(centres) else 0):
        sums, near = _round(vectors, centres)
        following = _centres(sums, centres)
        if near <= before * (1 + tolerance) or (following == centres).all():
            break
        centres, before = following, near
    by_term = np.ascontiguousarray(centres.T)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, best, value in nearest_centres(batch, by_term):
                part = batch.slice(some.start, some.stop - some.start)
                cluster = pa.array(best, pa.int32(), mask=best < 0)
                similarity = pa.array(value / SCALE / SCALE, pa.float64(), mask=best < 0)
                yield pa.RecordBatch.from_arrays([part.column("row"), cluster, similarity], ["row", "cluster", "similarity"])

    kind = vectors.schema["row"].dataType.simpleString()
    placed = vectors.mapInArrow(work, f"row {kind}, cluster int, similarity double")
    everyone = df.select(F.col(row).alias("row")).dropna().distinct()
    first = [
        (cluster, place, int(term), float(centre[term]) / SCALE)
        for cluster, centre in enumerate(centres)
        for place, term in enumerate(np.argsort(-centre, kind="stable")[:top_terms], 1)
        if centre[term] > 0
    ]
    named = spark.createDataFrame(first, "cluster int, place int, term int, weight double").join(terms, "term")
    return everyone.join(placed, "row", "left"), named.select("cluster", "place", "token", "weight")
