"""Toxicity: a factorization machine over hashed terms.

The score of a text is the logistic function of

    b + sum of w_i + sum over pairs i < j of <v_i, v_j>

over its distinct terms i, so that two terms may say together what neither says alone. Terms are words and their beginnings
of some letters, hashed.

1. Of the labelled rows, at most so many of either class are taken, by a hash of their document's number, and meet the
   documents; only their term numbers go on. This sample is bounded and fits one task, which trains on it.
2. The model has a bounded number of terms. It goes to all tasks, which score whole texts as they read them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .bpe import Cache
from .common import bounded_batches

WORD = re.compile(r"[^\W\d_]+")
MODEL = "terms binary, weights binary, factors binary, bias double"


@dataclass(frozen=True)
class Machine:
    """What is fitted and on how much of it.

    ``positives``, ``negatives``, ``train_terms``: bounds of the sample (rows of either class, terms of all rows).
    ``starts``: lengths of word beginnings that are terms, of longer words. ``rare``: terms of fewer rows are left out.
    ``factors`` numbers make a term's vector. ``l1`` keeps the weights of terms that say nothing at zero, ``l2`` pulls
    vectors back.
    """

    bits: int = 20
    starts: tuple[int, ...] = (3, 4)
    positives: int = 10_000
    negatives: int = 20_000
    train_terms: int = 30_000_000
    rare: int = 5
    factors: int = 6
    epochs: int = 10
    batch: int = 64
    rate: float = 1.0
    vector_rate: float = 0.02
    l1: float = 16.0
    l2: float = 0.002
    seed: int = 7


class Terms:
    """Distinct hashed terms of whole texts. For one Python worker."""

    def __init__(self, machine: Machine):
        mask, starts = (1 << machine.bits) - 1, machine.starts

        def numbers(word: str) -> tuple[int, ...]:
            parts = [word, *(f"{word[:n]}-" for n in starts if len(word) > n)]
            return tuple(xxhash.xxh3_64_intdigest(p) & mask for p in parts)

        self.known = Cache(numbers)

    def __call__(self, text: str | None) -> np.ndarray:
        words = set(WORD.findall((text or "").lower()))
        found = {number for word in words for number in self.known[word]}
        return np.sort(np.fromiter(found, np.int64, len(found)))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows from each start to the next; empty stretches give 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


class Trainer:
    """Logistic loss; weights by follow-the-regularized-leader with L1, vectors by adaptive steps."""

    def __init__(self, machine: Machine, count: int):
        self.m = machine
        rng = np.random.default_rng(machine.seed)
        self.z, self.n, self.w = np.zeros(count), np.zeros(count), np.zeros(count)
        self.v = rng.normal(0, 0.01, (count, machine.factors))
        self.g2 = np.ones((count, 1))
        self.b, self.b2 = 0.0, 1.0

    def active(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The terms that have a weight, and where each row's begin. Only these have a vector that counts."""
        own = self.w[flat] != 0
        return flat[own], np.r_[0, np.cumsum(own)][starts]

    def raw(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score before the logistic function, sum of vectors) of each row of active terms."""
        own = self.v[flat]
        sums = _sums(own, starts)
        pairs = 0.5 * ((sums**2).sum(axis=1) - _sums((own**2).sum(axis=1), starts))
        return self.b + _sums(self.w[flat], starts) + pairs, sums

    def step(self, flat: np.ndarray, starts: np.ndarray, wanted: np.ndarray) -> None:
        m = self.m
        own, own_starts = self.active(flat, starts)
        score, sums = self.raw(own, own_starts)
        error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - wanted
        # Gradients by term, of the weights of all terms and of the vectors of active ones.
        row = np.repeat(np.arange(len(wanted)), np.diff(starts))
        g = np.bincount(flat, weights=error[row], minlength=len(self.w))
        terms = np.flatnonzero(g)
        row = np.repeat(np.arange(len(wanted)), np.diff(own_starts))
        order = np.argsort(own, kind="stable")
        live, first = np.unique(own[order], return_index=True)
        gv = _sums(error[row[order], None] * sums[row[order]], np.r_[first, len(own)]) if len(own) else np.zeros((0, m.factors))
        gv += (m.l2 - g[live])[:, None] * self.v[live]
        self.g2[live] += (gv**2).mean(axis=1, keepdims=True)
        self.v[live] -= m.vector_rate * gv / np.sqrt(self.g2[live])
        g = g[terms]
        n = self.n[terms] + g * g
        self.z[terms] += g - (np.sqrt(n) - np.sqrt(self.n[terms])) / m.rate * self.w[terms]
        self.n[terms] = n
        z = self.z[terms]
        self.w[terms] = np.where(np.abs(z) <= m.l1, 0.0, (np.sign(z) * m.l1 - z) / ((1 + np.sqrt(n)) / m.rate))
        gb = float(error.sum())
        self.b2 += gb * gb
        self.b -= m.rate * gb / np.sqrt(self.b2)


def train(rows: list[tuple[np.ndarray, int]], machine: Machine) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(terms, weights, vectors, bias) from (terms, label) rows; the same for the same rows in the same order."""
    labels = np.array([y for _, y in rows], np.float64)
    every, times = np.unique(np.concatenate([t for t, _ in rows] or [np.array([], np.int64)]), return_counts=True)
    every = every[times >= machine.rare]
    held = [np.searchsorted(every, t[np.isin(t, every, assume_unique=True)]) for t, _ in rows]
    trainer = Trainer(machine, len(every))
    share = (labels.sum() + 1) / (len(labels) + 2)
    trainer.b = float(np.log(share / (1 - share)))
    rng = np.random.default_rng(machine.seed)
    for _ in range(machine.epochs if 0 < labels.sum() < len(labels) else 0):
        turn = rng.permutation(len(held))
        for low in range(0, len(turn), machine.batch):
            some = turn[low : low + machine.batch]
            starts = np.cumsum([0, *(len(held[i]) for i in some)])
            trainer.step(np.concatenate([held[i] for i in some]), starts, labels[some])
    return every, trainer.w, trainer.v, trainer.b


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned: crc32 of the number's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _examples(labels: DataFrame, machine: Machine, doc_id: str, label: str) -> tuple[DataFrame, float]:
    """(key, order, label) of the sample, and by how much the log-odds of its labels exceed those of all."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id))
    # Of a document that is labelled twice the higher label counts.
    known = known.groupBy(F.col(doc_id).cast("long").alias("key")).agg(F.max(F.col(label).cast("int")).alias("label"))
    known = materialize(known.withColumn("order", F.xxhash64("key")), "labels")
    bounds = {1: machine.positives, 0: machine.negatives}
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    some = [known.where(F.col("label") == y).orderBy("order", "key").limit(most) for y, most in bounds.items()]
    share = {y: min(counts.get(y, 0), most) / counts[y] if counts.get(y) else 1.0 for y, most in bounds.items()}
    return some[0].unionByName(some[1]), float(np.log(share[1] / share[0]))


def fit(
    docs: DataFrame, labels: DataFrame, machine: Machine = Machine(), doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic",
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(terms, weights, vectors, bias) learned from a bounded sample of the labelled rows that are not held out.

    Rows with equal terms count once. Without rows of both classes there is a bias only.
    """
    sample, excess = _examples(labels, machine, doc_id, label)
    # Its rows are bounded by two parameters of the machine, some bytes each.
    small = F.broadcast(sample.withColumnRenamed("key", "_key"))
    met = docs.select(F.col(doc_id).cast("long").alias("_doc"), F.col(text).cast("string").alias("text")).join(
        small, F.col("_doc") == F.col("_key")
    )

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(machine)
        for batch in batches:
            found = [terms(value).astype("<i4").tobytes() for value in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), batch.column("label"), pa.array(found, pa.binary())], ["order", "label", "terms"]
            )

    bounded_batches(docs.sparkSession)
    coded = met.select("order", "label", "text").mapInArrow(numbers, "order long, label int, terms binary")
    # A document may stand in the table many times.
    once = coded.groupBy("terms").agg(F.min("order").alias("order"), F.max("label").alias("label"))
    bounded = once.orderBy("order", "terms").limit(machine.positives + machine.negatives)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, room = [], machine.train_terms
        for batch in batches:
            for y, held in zip(batch.column("label").to_pylist(), batch.column("terms").to_pylist()):
                room -= len(held) // 4
                if room >= 0:
                    rows.append((np.frombuffer(held, "<i4").astype(np.int64), y))
        terms, weights, vectors, bias = train(rows, machine)
        taken = weights != 0
        cells = (terms[taken].astype("<i8"), weights[taken].astype("<f8"), vectors[taken].astype("<f8"))
        columns = [pa.array([c.tobytes()], pa.binary()) for c in cells] + [pa.array([bias])]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in MODEL.split(", ")])

    # The sample comes sorted in one partition, whose size the machine bounds, so the model does not go by partitions.
    model = materialize(bounded.select("label", "terms").coalesce(1).mapInArrow(learn, MODEL), "model").first()
    if model is None:
        # No labelled document at all.
        return np.array([], np.int64), np.array([]), np.zeros((0, machine.factors)), 0.0
    terms, weights, vectors = (np.frombuffer(model[c], t) for c, t in (("terms", "<i8"), ("weights", "<f8"), ("factors", "<f8")))
    return terms, weights, vectors.reshape(len(terms), machine.factors), model["bias"] - excess


def toxicity(
    docs: DataFrame, labels: DataFrame, machine: Machine = Machine(), least: float = 0.7, doc_id: str = "doc_id",
    text: str = "text", label: str = "toxic",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, by its text alone.

    NULL, empty and other texts without letters get the score of no terms. Rows with equal texts have equal scores; a
    NULL ``doc_id`` is passed on, has no label and is not held out. Labels that are NULL or of no document are not
    learned. An empty table gives no rows, an empty table of labels gives 0.5 to all. Other columns are not looked at.
    """
    terms, weights, vectors, bias = fit(docs, labels, machine, doc_id, text, label)
    norms = (vectors**2).sum(axis=1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Terms(machine)
        place = np.full(1 << machine.bits, -1, np.int32)
        place[terms] = np.arange(len(terms))
        for batch in batches:
            scores = []
            for value in batch.column("text").to_pylist():
                own = place[find(value)]
                own = own[own >= 0]
                pairs = 0.5 * ((vectors[own].sum(axis=0) ** 2).sum() - norms[own].sum())
                raw = bias + weights[own].sum() + pairs
                scores.append(float(1 / (1 + np.exp(-np.clip(raw, -500, 500)))))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score"])

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).cast("string").alias("text")
    )
    scored = rows.mapInArrow(work, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= least).cast("int"))
