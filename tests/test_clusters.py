import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidewire.operators import clusters
from tidewire.operators.text import title_tokens
from tidewire.plans import bindings
from tidewire.plans.queries import NEWS_STOP, QUERIES


def plain_vectors(tokens, scale, vocabulary=20_000):
    """({row: {token: weight}}, {token: number}) of (row, token) pairs."""
    held = {}
    for row, token in tokens:
        held.setdefault(row, Counter())[token] += 1
    known = Counter(token for words in held.values() for token in words)
    rank = {token: i for i, token in enumerate(sorted(known, key=lambda t: (-known[t], t))[:vocabulary])}
    out = {}
    for row, words in held.items():
        words = {t: n for t, n in words.items() if t in rank}
        if not words:
            continue
        w = {t: words[t] * (math.log((len(held) + 1) / (known[t] + 1)) + 1) for t in sorted(words, key=rank.get)}
        total = 0.0
        for x in w.values():
            total += x * x
        out[row] = {t: round(x / math.sqrt(total) * scale) for t, x in w.items()}
    return out, rank


def dot(a, b):
    return sum(x * b.get(t, 0) for t, x in a.items())


def plain_rounds(vectors, centres, scale, rounds=50, tolerance=1e-4):
    """{row: (cluster, product)} by dictionaries, from given first centres."""
    before = 0
    place = lambda v: max(((dot(v, c), -i) for i, c in enumerate(centres)))
    for _ in range(rounds):
        placed = {row: place(v) for row, v in vectors.items()}
        near = sum(value // scale for value, _ in placed.values())
        sums = [Counter() for _ in centres]
        for row, (value, i) in placed.items():
            if value > 0:
                sums[-i].update(vectors[row])
        lengths = [math.sqrt(math.fsum(float(x) ** 2 for x in s.values())) for s in sums]
        following = [
            {t: n for t, x in s.items() if (n := round(x / length * scale))} if length else old
            for s, length, old in zip(sums, lengths, centres)
        ]
        if near <= before * (1 + tolerance) or following == centres:
            break
        centres, before = following, near
    return {row: (-i, value) if value > 0 else (None, None) for row, v in vectors.items() for value, i in [place(v)]}


def test_clusters_as_by_plain_rounds(spark, sf):
    titles = bindings.articles_in(spark, sf)
    tokens = [(r.off, r.token) for r in title_tokens(titles, "title", NEWS_STOP, ["off"]).collect()]
    vectors, rank = plain_vectors(tokens, clusters.SCALE)
    cells, terms = clusters.weighted_terms(titles, "off", "title", NEWS_STOP)
    names = {r.term: r.token for r in terms.collect()}
    assert names == {i: t for t, i in rank.items()}
    found = {}
    for r in cells.collect():
        found.setdefault(r.row, {})[names[r.term]] = r.weight
    assert found == vectors
    seeds = clusters.choose_seeds(clusters._vectors(cells), 8, len(names))
    first = [{names[i]: int(x) for i, x in enumerate(seed) if x} for seed in seeds]
    assert len(first) == 8 and all(seed in vectors.values() for seed in first)
    expected = plain_rounds(vectors, first, clusters.SCALE)
    got = {r.off: r for r in QUERIES["title_clusters"](spark, sf).collect()}
    assert set(got) == {r.off for r in titles.select("off").collect()}
    assert {row: got[row].cluster for row in vectors} == {row: cluster for row, (cluster, _) in expected.items()}
    for row, (cluster, value) in expected.items():
        assert cluster is None or got[row].similarity == value / clusters.SCALE**2
    assert all(got[row].cluster is None for row in set(got) - set(vectors))


def test_lengths_are_worked_out_once_a_row(spark):
    df = spark.createDataFrame([(1, "river boat fish")], "id long, words string")
    cells, _ = clusters.weighted_terms(df, "id", "words", [])
    found = [line for line in plan(cells).split("== Initial Plan ==")[-1].splitlines() if "aggregate(" in line]
    assert found and all("Generate" in line for line in found)


def test_planted_topics_under_any_partitioning(spark):
    rng = random.Random(3)
    topics = [["river", "boat", "fish", "water", "bridge"], ["court", "judge", "trial", "lawyer", "verdict"],
              ["goal", "match", "team", "coach", "league"]]
    texts = [(i, " ".join(rng.choices(topics[i % 3], k=8)) + f" {rng.choice(['monday', 'friday'])}") for i in range(240)]
    texts += [(900, None), (901, ""), (902, "of 12 a"), (None, "river boat"), (3, "river")]
    df = spark.createDataFrame(texts, "id long, words string").withColumn("cluster", F.lit(1))
    runs = []
    for parts in (1, 7):
        placed, first = clusters.topic_clusters(df.repartition(parts), "id", "words", ["of"], k=3)
        runs.append((rows(placed), rows(first)))
    assert runs[0] == runs[1]
    of = {r[0]: r[1] for r in runs[0][0]}
    assert sorted(of) == [*range(240), 900, 901, 902] and of[900] is of[901] is of[902] is None
    assert len({of[i] for i in range(3)}) == 3 and all(of[i] == of[i % 3] for i in range(240))
    named = {c: {t for cluster, place, t, _ in runs[0][1] if cluster == c and place <= 5} for c in range(3)}
    assert [named[of[i]] for i in range(3)] == [set(t) for t in topics]


def test_few_equal_and_no_texts(spark):
    df = spark.createDataFrame([(i, "same words here") for i in range(5)], "id long, words string")
    placed, first = clusters.topic_clusters(df, "id", "words", [], k=4)
    assert {r.cluster for r in placed.collect()} == {0} and first.count() == 3
    assert all(abs(r.similarity - 1) < 1e-5 for r in placed.collect())
    placed, first = clusters.topic_clusters(df.limit(0), "id", "words", [])
    assert (placed.count(), first.count()) == (0, 0)
    # Texts of rare words only: the vocabulary leaves them without a vector.
    df = spark.createDataFrame([(1, "apple apple"), (2, "apple pear"), (3, "zebra")], "id long, words string")
    assert {r.row: r.cluster for r in clusters.topic_clusters(df, "id", "words", [], k=1, vocabulary=1)[0].collect()} == {1: 0, 2: 0, 3: None}
    with pytest.raises(ValueError):
        clusters.topic_clusters(df, "id", "words", [], k=1000, vocabulary=1_000_000)


def test_many_words_are_placed_in_slices(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"word{'abcdefgh'[i % 8]} text{'xyz'[i % 3]}") for i in range(100)], "id long, words string")
    whole = rows(clusters.topic_clusters(df, "id", "words", [], k=3)[0])
    monkeypatch.setattr(clusters, "AT_ONCE", 3)
    assert rows(clusters.topic_clusters(df, "id", "words", [], k=3)[0]) == whole
