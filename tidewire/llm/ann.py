"""Nearest neighbours by a permutation index: inverted files of pivots, footrule distance, exact rerank."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches, hashed_below

#: The index is fitted on at most this many vectors, the pivots, out of a sample of four times as many; every vector
#: is indexed. Pivots with a larger cosine than this to another are taken only if there are no others.
PIVOTS, APART = 512, 0.9
#: The sample is taken from so many times its rows, by their hash.
SAMPLE_ROOM = 4
#: A vector is posted under its nearest pivots, in this share of all pivots.
POSTED = 0.25
#: The share of a block's vectors that is reranked for a query unless it is given, and the least number.
RERANKED, RERANKED_LEAST = 0.06, 128
#: Vectors of an index block, and queries that meet a block at a time.
BLOCK_ROWS, QUERY_ROWS = 8_192, 512
#: Bytes of an Arrow batch; a larger row, as of a block and a group of queries, is one batch.
ARROW_BYTES = 8_000_000


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(uid, vec_id, vector) of the rows that take part.

    Out are NULL ids, NULL and zero vectors, and those with a NULL or non-finite component. ``uid`` tells repeated rows
    apart.
    """
    rows = vectors.select(
        vectors[vec_id].cast("long").alias("vec_id"),
        vectors[embedding].cast("array<double>").alias("vector"),
        F.monotonically_increasing_id().alias("uid"),
    )
    limit = F.lit(float("inf"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def choose_pivots(rows: DataFrame, pivots: int) -> np.ndarray:
    """So many different vectors of length 1, apart from one another as far as possible.

    They are chosen in order of a hash, from a bounded sample that is always the same. Many near copies of one vector
    would else give many pivots that say the same.
    """
    different = list(dict.fromkeys(tuple(vector) for vector in _least_hashed(rows, 4 * pivots)))
    if not different:
        return np.zeros((0, 0))
    units = _unit(np.array(different, np.float64))
    chosen: list[int] = []
    for i in range(len(units)):
        if len(chosen) < pivots and not (units[chosen] @ units[i] > APART).any():
            chosen.append(i)
    rest = [i for i in range(len(units)) if i not in set(chosen)]
    return units[(chosen + rest)[:pivots]]


def _least_hashed(rows: DataFrame, most: int) -> list[list[float]]:
    """The different vectors among the ``most`` rows of the least hashes, in order of the hash.

    Sorting all rows would send so many from each task. The hashes are spread evenly, so those below a bound are asked
    for, some times ``most`` rows in all; the bound is raised where few different vectors fill the table.
    """
    hashed = rows.select("vector", F.xxhash64("vector").alias("hash"))
    share = SAMPLE_ROOM * most / max(1, rows.count())
    while True:
        low = hashed.where(hashed_below("hash", share)).groupBy("hash", "vector").agg(F.count("*").alias("n"))
        few = low.orderBy("hash").limit(most).collect()
        before = np.cumsum([0, *(r.n for r in few)])
        if share >= 1 or before[-1] >= most:
            return [r.vector for r, n in zip(few, before) if n < most]
        share *= SAMPLE_ROOM


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that the squares of very large or small components are no trouble.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, posted: int) -> np.ndarray:
    """The ``posted`` nearest pivots of each vector, nearest first, ties to the smaller number."""
    return np.argsort(-(_unit(vectors) @ pivots.T), axis=1, kind="stable")[:, :posted].astype(np.int32)


def inverted_files(order: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each pivot's posting list, rows, places): row r holds the pivot at that place of its permutation."""
    rows, posted = order.shape
    flat = order.T.ravel()  # by place, so that each list is in order of place
    by_pivot = np.argsort(flat, kind="stable")
    starts = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))
    return starts, (by_pivot % rows).astype(np.int32), (by_pivot // rows).astype(np.int32)


class Block:
    """An index block as it is stored, with its inverted files."""

    def __init__(self, payload: dict, dims: int, pivots: int, posted: int, reranked: float):
        self.uid, self.vec_id = (np.frombuffer(payload[k], "<i8") for k in ("uids", "ids"))
        self.vectors = np.frombuffer(payload["vectors"], "<f8").reshape(-1, dims)
        self.order = np.frombuffer(payload["orders"], "<i4").reshape(-1, posted)
        self.posted = posted
        self.pivots, self.reranked = pivots, reranked
        self.files = None

    def search(self, query: np.ndarray, order: np.ndarray, uid: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, cosines) of the nearest ``keep`` but the row ``uid`` itself."""
        if self.files is None:
            self.files = inverted_files(self.order, self.pivots)
        starts, rows, places = self.files
        # The footrule distance of two prefixes, taking absent pivots as at the end, is a constant less twice the
        # sum of (posted - the later place) over the pivots they share.
        shared = np.zeros(len(self.uid), np.int32)
        for place, pivot in enumerate(order.tolist()):
            some = slice(starts[pivot], starts[pivot + 1])
            shared[rows[some]] += self.posted - np.maximum(places[some], place)
        shared[self.uid == uid] = -1
        most = min(len(shared), max(RERANKED_LEAST, math.ceil(self.reranked * len(shared))))
        if most < len(shared):
            least = np.partition(shared, len(shared) - most)[len(shared) - most]
            sure = np.flatnonzero(shared > least)
            tied = np.flatnonzero(shared == least)[: most - len(sure)]  # in order of vec_id
            found = np.concatenate([sure, tied])
        else:
            found = np.arange(len(shared))
        found = found[self.uid[found] != uid]
        scores = cosines(query, self.vectors[found])
        best = np.lexsort((self.vec_id[found], -scores))[:keep]
        return found[best], scores[best]


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return (vectors * query).sum(axis=1) / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


def build_index(rows: DataFrame, pivots: np.ndarray, posted: int, per_block: int) -> DataFrame:
    """One row per block of vectors: ids, vectors and permutations, packed, in order of ``vec_id``."""
    blocks = -(-rows.count() // per_block) or 1

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending"), ("uid", "ascending")])
        vectors = _matrix(table.column("vector"))
        columns = {
            "block": [table.column("_block")[0].as_py()],
            "uids": [np.array(table.column("uid"), "<i8").tobytes()],
            "ids": [np.array(table.column("vec_id"), "<i8").tobytes()],
            "vectors": [vectors.astype("<f8").tobytes()],
            "orders": [nearest_pivots(vectors, pivots, posted).astype("<i4").tobytes()],
        }
        return pa.table(columns)

    dealt = rows.withColumn("_block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    schema = "block long, uids binary, ids binary, vectors binary, orders binary"
    return dealt.groupBy("_block").applyInArrow(work, schema)


def nearest(
    vectors: DataFrame,
    every: int = 50,
    keep: int = 5,
    pivots: int = PIVOTS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    reranked: float = RERANKED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id ``every`` divides, its ``keep`` nearest other rows.

    Score is the cosine of the original vectors in double precision, ties go to the smaller id. Rows that
    :func:`usable` leaves out are neither queries nor found; a repeated row is a neighbour of its copy. Vectors of
    different lengths have no cosine: each length has an index of its own. Queries meet index blocks in groups of
    :data:`QUERY_ROWS`; of each block the share ``reranked`` that is nearest by footrule distance is compared exactly,
    so 1.0 is the exact search.
    """
    if not 0 < reranked <= 1:
        raise ValueError("reranked must lie above 0 and not above 1")
    rows = materialize(usable(vectors, vec_id, embedding), "vectors")
    sizes = sorted(r.n for r in rows.select(F.size("vector").alias("n")).distinct().collect())
    parts = [_nearest_of_length(rows.where(F.size("vector") == n), every, keep, pivots, reranked) for n in sizes or [0]]
    return reduce(DataFrame.unionByName, parts)


def _nearest_of_length(rows: DataFrame, every: int, keep: int, pivots: int, reranked: float) -> DataFrame:
    chosen = choose_pivots(rows, pivots)
    count, dims = chosen.shape
    posted = math.ceil(POSTED * count)
    index = materialize(build_index(rows, chosen, posted, BLOCK_ROWS), "index")
    queries = materialize(build_index(rows.where(F.col("vec_id") % every == 0), chosen, posted, QUERY_ROWS), "queries")
    asked = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("uids", "ids", "vectors", "orders")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                cells = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                if cells["block"] != number:
                    number, block = cells["block"], Block(cells, dims, count, posted, reranked)
                asked_by = {k: cells[f"q_{k}"] for k in ("uids", "ids", "vectors", "orders")}
                group = Block(asked_by, dims, count, posted, reranked)
                out = []
                for i, uid in enumerate(group.uid.tolist()):
                    found, scores = block.search(group.vectors[i], group.order[i], uid, keep)
                    ids = block.vec_id[found].tolist()
                    out += [(uid, int(group.vec_id[i]), v, s) for v, s in zip(ids, scores.tolist())]
                columns = list(zip(*out)) or [()] * 4
                types = [pa.int64()] * 3 + [pa.float64()]
                names = ["uid", "query_id", "vec_id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    # Each group of queries meets every block: whole groups and blocks are rows, not their pairs. Tasks read both from
    # where they are stored, so no copies are shuffled; the block is the outer loop and changes rarely.
    bounded_batches(rows.sparkSession, ARROW_BYTES)
    met = index.hint("shuffle_replicate_nl").crossJoin(asked)
    found = met.mapInArrow(work, "uid long, query_id long, vec_id long, score double")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return ranked.select("query_id", "rank", "vec_id", "score")
