from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewire.operators import frames, patterns
from tidewire.plans import bindings
from tidewire.plans.queries import NEWS_STOP
from tidewire.operators.text import title_tokens


def plain_sets(baskets, share):
    """All frequent sets, grown one item at a time over all rows."""
    least = share * len(baskets) - 1e-9
    found = {}
    level = [frozenset([x]) for x in set().union(*baskets)]
    while level:
        kept = {s: n for s in set(level) if (n := sum(s <= b for b in baskets)) >= least}
        found |= kept
        level = [a | b for a, b in combinations(kept, 2) if len(a | b) == len(a) + 1]
    return sorted((tuple(sorted(s)), n) for s, n in found.items())


def found_sets(df):
    return sorted((tuple(r.words), r.n) for r in df.collect() if r.size == len(r.words))


def test_word_sets_of_titles_as_by_brute_force(spark, sf):
    titles = bindings.articles_in(spark, sf)
    baskets = {}
    for off, token in title_tokens(titles, "title", NEWS_STOP, ["off"]).collect():
        baskets.setdefault(off, set()).add(token)
    found = found_sets(patterns.frequent_word_sets(titles, "off", "title", NEWS_STOP, 0.1))
    assert found == plain_sets(list(baskets.values()), 0.1)
    assert max(len(words) for words, _ in found) > 3


def test_sets_with_nulls_ties_repeats_and_any_partitioning(spark):
    baskets = [{"a", "b", "c"}, {"a", "b", "c"}, {"a", "b"}, {"c"}, {"d"}]
    cells = [(i, x) for i, b in enumerate(baskets) for x in [*b, *b]] + [(9, None), (None, "a")]
    df = spark.createDataFrame(cells, "r int, x string")
    for parts in (1, 7):
        assert found_sets(patterns.frequent_sets(df.repartition(parts), "r", "x", 0.4)) == plain_sets(baskets, 0.4)
    assert found_sets(patterns.frequent_sets(df, "r", "x", 0.2)) == plain_sets(baskets, 0.2)
    assert rows(patterns.frequent_sets(df, "r", "x", 0.4, max_size=1).select("size")) == [(1,)] * 3
    assert patterns.frequent_sets(df.limit(0), "r", "x", 0.4).count() == 0
    with pytest.raises(ValueError):
        patterns.frequent_sets(df, "r", "x", 0)


def test_words_that_one_corpus_lacks(spark):
    counts = lambda **n: spark.createDataFrame(list(n.items()), "token string, count long")
    found = {r.token: r for r in patterns.compare_counts(counts(old=50, both=50), counts(new=50, both=50)).collect()}
    assert (found["old"].n_second, found["new"].n_first) == (0, 0)
    assert found["old"].z > 2 and found["new"].z < -2 and abs(found["both"].z) < 1e-9
    assert found["old"].log_odds == pytest.approx(-found["new"].log_odds)
    alone = patterns.compare_counts(counts(x=3), counts(x=1).limit(0)).collect()
    assert [(r.token, r.share_first, r.share_second, r.log_odds) for r in alone] == [("x", 1.0, None, 0.0)]


def test_frame_spans_show_what_cumulative_frames_do(spark, sf):
    df = bindings.clean(spark, sf).withColumn("iyear", F.when(F.col("eventid") % 9 != 0, F.col("iyear")))
    spans = frames.frame_spans(df)
    assert spans.count() == df.count()
    shown = frames.cumulative_frames(df).groupBy("frame_year").count().collect()
    assert {r.frame_year: r["count"] for r in shown} == {
        r.frame_year: frames.shown_in(spans, r.frame_year).count() for r in shown
    }
    assert spans.where("iyear IS NULL AND (first_frame IS NOT NULL OR last_frame IS NOT NULL)").count() == 0
