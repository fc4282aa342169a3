import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidewire.functions.words import BASE_STOPWORDS, NEWS_STOPWORDS, stopwords
from tidewire.operators import text


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, body string")


def frequencies(spark, *texts, stop=(), **options):
    top = text.word_frequencies(docs(spark, *texts), "body", list(stop), **options)
    return {r.term: r["count"] for r in top.collect()}


def test_stopword_union():
    union = stopwords(BASE_STOPWORDS, NEWS_STOPWORDS)
    assert len(union) == len(set(union)) and {"the", "mrs"} <= set(union)


def test_title_tokens(spark):
    df = docs(spark, "It's a Bomb-Threat, 'news' 9/11 été x1", None, "")
    tokens = text.title_tokens(df, "body", stopwords(extra=NEWS_STOPWORDS), ["i"])
    assert rows(tokens) == [(0, "bomb"), (0, "threat"), (0, "été")]
    counts = text.token_counts(df, "body", stopwords(extra=NEWS_STOPWORDS))
    assert rows(counts) == [("bomb", 1), ("threat", 1), ("été", 1)]


def test_token_counts_equal_counted_tokens(spark, sf):
    from tidewire.plans import bindings

    df = bindings.articles_in(spark, sf)
    stop = stopwords(extra=NEWS_STOPWORDS)
    one_by_one = text.title_tokens(df, "title", stop, []).groupBy("token").agg(F.count("*"))
    assert rows(text.token_counts(df, "title", stop)) == rows(one_by_one)


def test_plural_and_case_folding(spark):
    assert frequencies(spark, "Attack attacks ATTACK glass") in (
        {"ATTACK": 3, "glass": 1}, {"Attack": 3, "glass": 1}, {"attack": 3, "glass": 1}
    )
    assert frequencies(spark, "cats cats Cats") == {"cats": 3}
    assert frequencies(spark, "cats cats cat") == {"cat": 3}
    assert frequencies(spark, "boss boss bos") == {"boss": 2, "bos": 1}


def test_words_numbers_and_possessives(spark):
    assert frequencies(spark, "Bob's 1999 3rd 12's a it's we'll 2000's x", stop=["it"]) == {
        "Bob": 1, "3rd": 1, "we'll": 1, "a": 1, "x": 1
    }
    assert frequencies(spark, "x 7 7a", min_word_length=1) == {"x": 1, "7a": 1}
    assert frequencies(spark, "x ab abc", min_word_length=3) == {"abc": 1}
    assert frequencies(spark, "plan B plan B x x x x") == {"plan": 2, "B": 2, "x": 4}


def test_weights(spark):
    top = text.word_frequencies(docs(spark, "aa aa aa aa bb bb cc"), "body", [], max_words=2)
    assert rows(top) == [("aa", 4, 1.0), ("bb", 2, 0.5)]


def test_no_texts_no_words(spark):
    for both in (False, True):
        assert frequencies(spark, None, "", with_collocations=both) == {}


def model(texts, stop, threshold):
    """Word and pair counts in plain Python, pairs inside a text only."""

    def fold(words):
        forms = {}
        for word, n in Counter(words).items():
            forms.setdefault(word.lower(), Counter())[word] += n
        for low in sorted(forms):
            if low.endswith("s") and not low.endswith("ss") and low[:-1] in forms:
                for word, n in forms.pop(low).items():
                    forms[low[:-1]][word[:-1]] += n
        return {low: (min(c, key=lambda w: (-c[w], w)), sum(c.values())) for low, c in forms.items()}

    def find(folded, low):
        return folded[low] if low in folded else folded[low[:-1]]

    unigrams, bigrams = [], []
    for body in texts:
        words = [w[:-2] if w.lower().endswith("'s") else w for w in re.findall(r"\w[\w']+", body)]
        words = [w for w in words if not w.isdigit()]
        unigrams += [w for w in words if w.lower() not in stop]
        bigrams += [f"{a} {b}" for a, b in zip(words, words[1:]) if a.lower() not in stop and b.lower() not in stop]
    total, ones, twos = len(unigrams), fold(unigrams), fold(bigrams)
    left = Counter({term: n for term, n in ones.values()})

    def part(k, n, x):
        return k * math.log(max(x, 1e-10)) + (n - k) * math.log(max(1 - x, 1e-10))

    strong = {}
    for term, n in twos.values():
        (w1, c1), (w2, c2) = (find(ones, w.lower()) for w in term.split())
        if total <= c1 or total <= c2:
            continue
        p, p1, p2 = c2 / total, n / c1, (c2 - n) / (total - c1)
        score = -2 * (part(n, c1, p) + part(c2 - n, total - c1, p) - part(n, c1, p1) - part(c2 - n, total - c1, p2))
        if score > threshold:
            strong[term] = n
            left[w1] -= n
            left[w2] -= n
    return {t: n for t, n in left.items() if n > 0} | strong, strong


@pytest.mark.parametrize("threshold", [2, 30])
def test_collocations_equal_a_plain_model(spark, threshold):
    rng = random.Random(3)
    vocabulary = ["bomb", "Bomb", "bombs", "car", "cars", "CAR", "the", "of", "mass", "attack", "Attacks", "12", "Bob's"]
    weights = [5, 2, 3, 4, 2, 1, 6, 5, 2, 4, 2, 2, 1]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 60))) for _ in range(40)]
    texts += ["New York police said"] * 12
    stop = {"the", "of"}
    expected, strong = model(texts, stop, threshold)
    assert strong
    df = docs(spark, *texts)
    found = text.collocations(df, "body", list(stop), threshold)
    assert {r.bigram: r.c12 for r in found.collect()} == strong
    terms = text.word_frequencies(df, "body", list(stop), 10_000, True, threshold)
    assert {r.term: r["count"] for r in terms.collect()} == expected


def test_pairs_stay_inside_a_text(spark):
    pairs = text.adjacent_pairs(docs(spark, "red car", "car red"), "body", [])
    assert rows(pairs) == [("car", None, 1), ("car", "red", 1), ("red", None, 1), ("red", "car", 1)]


def test_pairs_are_dealt_out_by_stem_alone(spark):
    """A pair is one spelling already, so it is not counted by spelling again, and its stem does not travel with it."""
    found = plan(text.collocations(docs(spark, "red car", "car red"), "body", [])).split("== Initial Plan ==")[-1]
    assert "hashpartitioning(word#" not in found and "hashpartitioning(stem#" not in found


def test_keyword_matrix_order(spark):
    df = spark.createDataFrame(
        [("S1", "bomb bomb bomb car"), ("S2", "car car car car bomb"), ("S2", None), (None, "car"), ("S3", "zebra")],
        "source_name string, title string",
    )
    matrix = text.keyword_source_matrix(df, [], n_sources=2, n_keywords=2)
    assert matrix.columns == ["token", "S1", "S2", "kw_rank"]
    assert [tuple(r) for r in matrix.collect()] == [("car", 1, 4, 1), ("bomb", 3, 1, 2)]
