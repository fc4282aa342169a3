"""The factorization machine: held-out accuracy, pairs of terms, edges."""

import random
import zlib

import numpy as np
import pytest

from tidewire.llm import toxicity
from tidewire.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, score double, terms string"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def tables(spark, texts, labels):
    docs = spark.createDataFrame([(i, t, "x", 0.0, "y") for i, t in enumerate(texts)], SCHEMA)
    return docs, spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")


def test_pairs_say_what_neither_says_alone(spark):
    # An insult is toxic only beside a group; alone, either stands in clean texts, and longer ones hold both kinds of filler.
    rng = random.Random(1)
    texts, labels = [], []
    for _ in range(1_500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [rng.choice(["plain", "other", "stone", "river", "table"]) for _ in range(8)]
        texts.append(" ".join(words + ["vermin"] * insult + ["strangers"] * group))
        labels.append(int(insult and group))
    docs, known = tables(spark, texts, labels)
    # Equal sets of terms are learned once, so there are few rows: more rounds.
    machine = toxicity.Machine(l1=1.0, epochs=30, batch=16)
    found = {r.doc_id: r for r in toxicity.toxicity(docs, known, machine).collect()}
    unseen = [i for i in range(1_500) if held(i)]
    assert all(found[i].predicted == labels[i] for i in unseen)
    _, _, vectors, _ = toxicity.fit(docs, known, machine)
    assert np.abs(vectors).max() > 0.05


def test_scores_come_from_the_formula():
    machine = toxicity.Machine()
    rng = np.random.default_rng(0)
    trainer = toxicity.Trainer(machine, 9)
    trainer.w, trainer.v, trainer.b = rng.normal(size=9), rng.normal(size=(9, 6)), 0.5
    rows = [[0, 3, 7], [], [1], [2, 4, 5, 8]]
    flat, starts = np.array([i for r in rows for i in r]), np.cumsum([0, *map(len, rows)])
    plain = [0.5 + sum(trainer.w[i] for i in r) + sum(trainer.v[i] @ trainer.v[j] for i in r for j in r if i < j) for r in rows]
    assert np.allclose(trainer.raw(flat, starts)[0], plain)


def test_gradient_of_vectors():
    # A step against the gradient lowers the loss.
    machine = toxicity.Machine(l1=0.0)
    trainer = toxicity.Trainer(machine, 4)
    trainer.w[:] = 0.1
    flat, starts, wanted = np.array([0, 1, 1, 2, 0, 3]), np.array([0, 2, 4, 6]), np.array([1.0, 0.0, 0.0])

    def loss():
        p = 1 / (1 + np.exp(-trainer.raw(*trainer.active(flat, starts))[0]))
        return -(wanted * np.log(p) + (1 - wanted) * np.log(1 - p)).sum()

    before = loss()
    for _ in range(50):
        trainer.step(flat, starts, wanted)
    assert loss() < 0.5 * before


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["nice", "words", "here", f"t{i}"]) for _ in range(5)) + rng.choice([" bad", ""]) for i in range(300)]
    labels = [int("bad" in t) for t in texts]
    docs, known = tables(spark, texts, labels)
    _, other = tables(spark, texts, [1 - y if held(i) else y for i, y in enumerate(labels)])
    first = {r.doc_id: r.score for r in toxicity.toxicity(docs, known).collect()}
    second = {r.doc_id: r.score for r in toxicity.toxicity(docs.repartition(3), other.repartition(4)).collect()}
    assert first == second


def test_edges(spark):
    long = "word " * 60_000 + "vile"
    texts = [None, "", " \n ", "123 ...", long, "vile", "vile", "漢字 vile"] + ["vile thing", "nice thing"] * 100
    docs, known = tables(spark, texts, [0] * 8 + [1, 0] * 100)
    docs = docs.unionByName(spark.createDataFrame([(None, "vile", None, None, None), (3, "again", None, None, None)], SCHEMA))
    known = known.unionByName(spark.createDataFrame([(None, 1), (1, None), (10**9, 1), (9, 1)], "doc_id long, toxic int"))
    found = toxicity.toxicity(docs, known).collect()
    assert len(found) == len(texts) + 2 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    by = {r.doc_id: r for r in found if r.doc_id not in (3, None)}
    assert by[0].score == by[1].score == by[2].score and by[5].score == by[6].score
    assert all(r.held_out == held(r.doc_id) for r in by.values())
    assert [r.held_out for r in found if r.doc_id is None] == [False]


@pytest.mark.parametrize("labels", [[], [(0, 0), (2, 0), (3, 0)], [(0, 1)]])
def test_labels_of_one_class(spark, labels):
    docs = spark.createDataFrame([(i, f"text {i}", "", 0.0, "") for i in range(5)], SCHEMA)
    found = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len({r.score for r in found}) == 1
    if not labels:
        assert found[0].score == 0.5
    assert toxicity.toxicity(docs.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int")).collect() == []


def test_bounds_of_the_sample(spark):
    docs, known = tables(spark, [f"common w{i}" for i in range(400)], [int(i % 4 == 0) for i in range(400)])
    machine = toxicity.Machine(positives=20, negatives=30)
    sample, excess = toxicity._examples(known, machine, "doc_id", "toxic")
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert counts == {1: 20, 0: 30}
    of = {y: sum(not held(i) for i in range(400) if (i % 4 == 0) == bool(y)) for y in (0, 1)}
    assert excess == pytest.approx(np.log((20 / of[1]) / (30 / of[0])))


def test_held_out_accuracy(spark, sf):
    path = sf.replace("sf0.001", "sf0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    found = [r for r in QUERIES["op12_toxicity"](spark, path).collect() if r.held_out and r.doc_id in labels]
    hits = [r.predicted for r in found if labels[r.doc_id] == 1]
    false = [r.predicted for r in found if labels[r.doc_id] == 0]
    # 305 toxic texts to learn from, with four vocabularies of insults.
    assert len(hits) > 100 and sum(hits) / len(hits) > 0.75 and sum(false) / len(false) < 0.005
