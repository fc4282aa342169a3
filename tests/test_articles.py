import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidewire.functions.articles import dedupe_key
from tidewire.operators import dedupe
from tidewire.sources import articles

DAY = dt.datetime(2025, 1, 1)
BATCH = "off int, title string, url string, published_at timestamp_ntz"


def batch(spark, *records):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(records)], BATCH)


def sequential(records, stored=()):
    """The rule applied row by row."""
    table, kept = list(stored), []
    for off, title, url, time in records:
        if url:
            new = all(s[1] != url for s in table)
        else:
            new = title is None or time is None or all((s[0], s[2]) != (title, time) for s in table)
        if new:
            table.append((title, url, time))
            kept.append(off)
    return kept


def test_dedupe_asymmetry(spark):
    records = [
        ("A", "u1", DAY), ("A", "u1", DAY), ("A", None, DAY), ("B", None, DAY), ("B", "u2", DAY), ("B", "", DAY),
        (None, None, DAY), (None, None, DAY), ("C", None, None), ("C", None, None),
    ]
    kept = dedupe.new_articles(batch(spark, *records), None, ["off"])
    assert sorted(r.off for r in kept.collect()) == [0, 3, 4, 6, 7, 8, 9]


def test_dedupe_against_stored(spark):
    stored = batch(spark, ("A", "u1", DAY), ("B", None, DAY))
    fresh = batch(spark, ("X", "u1", DAY), ("B", None, DAY), ("A", None, DAY), ("B", "u9", DAY), ("D", None, DAY))
    kept = dedupe.new_articles(fresh, dedupe.article_keys(stored), ["off"])
    assert sorted(r.off for r in kept.collect()) == [3, 4]


def test_dedupe_equals_the_sequential_rule(spark):
    """Many random batches at once: every case gets its own url and title space."""
    rng = random.Random(7)
    records, stored, expected, off = [], [], [], 0
    for case in range(120):
        def article():
            url = rng.choice([None, "", f"{case}-u1", f"{case}-u2", f"{case}-u3"])
            return rng.choice([None, f"{case}-A", f"{case}-B"]), url, rng.choice([None, DAY, DAY + dt.timedelta(1)])

        prior = [article() for _ in range(rng.randrange(4))]
        ours = []
        for _ in range(12):
            ours.append((off, *article()))
            off += 1
        expected += sequential(ours, prior)
        records += ours
        stored += prior
    rng.shuffle(records)
    have = spark.createDataFrame([(0, *s) for s in stored], BATCH)
    df = spark.createDataFrame(records, BATCH).repartition(5)
    kept = dedupe.new_articles(df, dedupe.article_keys(have), ["off"])
    assert sorted(r.off for r in kept.collect()) == sorted(expected)


def test_dedupe_with_a_composite_order(spark):
    df = batch(spark, ("A", "u", DAY), ("A", "u", DAY), ("A", None, DAY)).withColumn("part", F.lit("0"))
    kept = dedupe.new_articles(df, None, ["off", "part"])
    assert [r.off for r in kept.collect()] == [0]


def test_hot_keys_shrink_before_the_shuffle(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(dedupe, "materialize", lambda df, label: plans.append(plan(df)) or df)
    dedupe.new_articles(batch(spark, ("A", "u", DAY)), None, ["off"])
    assert plans[0].count("WindowGroupLimit") >= 2


def test_dedupe_key(spark):
    df = batch(spark, ("A", "u", DAY), ("A", "", None), (None, None, DAY))
    key = dedupe_key(F.col("url"), F.col("title"), F.col("published_at"))
    assert [r[0] for r in df.orderBy("off").select(key).collect()] == ["u", "A|None", "None|2025-01-01 00:00:00"]


def extract(spark, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value binary")
    return articles.extract_article(articles.decode_articles(df), keep=["i"])


def test_decode_and_quarantine(spark):
    good = {
        "title": "t", "url": "u", "publishedAt": "2025-12-01T15:32:56+02:00", "source": {"id": 1, "name": "S"},
        "author": None, "description": "été", "content": "c", "more": [1],
    }
    messages = [
        json.dumps(good).encode(),
        b"{not json",
        json.dumps({"title": "t", "source": "plain"}).encode(),
        json.dumps({"title": "t", "publishedAt": "notadate"}).encode(),
        b"{}",
        b"[1, 2]",
        b'{"title": "\xff\xfe"}',
        json.dumps({"title": "t", "source": {"id": 1}}).encode(),
    ]
    out = extract(spark, *messages)
    kept = {r.i: r for r in articles.accepted(out).collect()}
    assert sorted(kept) == [0, 2, 4, 7]
    first = kept[0]
    assert (first.title, first.url, first.source_name, first.author, first.description) == ("t", "u", "S", None, "été")
    assert first.published_at == dt.datetime(2025, 12, 1, 15, 32, 56)
    assert json.loads(first.raw_json) == good
    assert kept[2].source_name is None and kept[7].source_name is None
    assert [kept[4][name] for name in ("title", "url", "published_at", "source_name")] == [None] * 4
    rejected = rows(articles.quarantine(out, keep=["i"]).select("i", "reject_reason"))
    assert rejected == [(1, "invalid json"), (3, "bad timestamp"), (5, "invalid json"), (6, "invalid json")]


@pytest.mark.parametrize(
    "text",
    ['{"title": "a"} xyz', '{"title": "a"}, {"title": "b"}', "{'title': 'a'}", '{"title": "a"', '"title"', "null", "",
     '{"title": "line\nbreak"}', '{title: "a"}', '{"title": "a"}] garbage', '{"title": "a"}],[{"b": 1}',
     '{"title": "a"}, null] {}', '{"title": "a"},{"_end_of_text":"1"}] {}', "[{}]", "{}{}"],
)
def test_only_one_whole_object_decodes(spark, text):
    assert [r.reject_reason for r in extract(spark, text.encode()).collect()] == ["invalid json"]


def test_blanks_around_an_object_are_fine(spark):
    out = extract(spark, b'\n{"title": "a"}', b'\t{"title": "b"}\r\n', b' \t\r\n{"title": "c"} ')
    assert rows(articles.accepted(out).select("i", "title")) == [(0, "a"), (1, "b"), (2, "c")]


def test_odd_but_valid_messages_decode(spark):
    out = extract(spark, b' {"title": 5, "source": null} ', b'{"title": {"a": 1}, "url": true}')
    assert rows(articles.accepted(out).select("i", "title", "url")) == [(0, "5", None), (1, '{"a":1}', "true")]


def test_response_pages(spark):
    pages = [
        {"status": "ok", "articles": [{"title": "a", "source": {"name": "S"}}, {"title": "b"}]},
        {"status": "ok", "articles": []},
        {"status": "ok"},
        {"status": "error", "message": "bad key"},
    ]
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(pages)], "i int, value string")
    exploded = articles.explode_response_pages(df, keep=["i"])
    out = articles.extract_article(articles.decode_articles(exploded), keep=["i"])
    assert rows(out.select("i", "title", "source_name")) == [(0, "a", "S"), (0, "b", None)]
    assert rows(articles.rejected_pages(df, keep=["i"]).select("i", "status", "message")) == [(3, "error", "bad key")]


def test_messages_keep_nulls_and_key_only_text(spark):
    df = spark.createDataFrame([("u", None, 3), (None, "t", 4)], "url string, title string, size int")
    sent = rows(articles.article_messages(df))
    assert [(k, json.loads(v)) for k, v in sent] == [
        (None, {"url": None, "title": "t", "size": 4}), ("u", {"url": "u", "title": None, "size": 3}),
    ]
    for key_field in ("size", "nothing", None):
        assert [r.key for r in articles.article_messages(df, key_field).collect()] == [None, None]


def test_parse_happens_once(spark):
    df = spark.createDataFrame([(b"{}",)], "value binary")
    out = articles.accepted(articles.extract_article(articles.decode_articles(df)))
    assert plan(out).count("from_json") == 1


def test_nothing_in_nothing_out(spark):
    empty = batch(spark, ("A", "u", DAY)).where("false")
    some = batch(spark, ("A", "u", DAY))
    assert dedupe.new_articles(empty, None, ["off"]).count() == 0
    assert dedupe.new_articles(empty, dedupe.article_keys(some), ["off"]).count() == 0
    assert dedupe.new_articles(some, dedupe.article_keys(empty), ["off"]).count() == 1
    out = articles.extract_article(articles.decode_articles(spark.createDataFrame([], "value binary")))
    assert articles.accepted(out).count() == 0 and articles.quarantine(out).count() == 0


def test_publishing_goes_to_the_topic_sink(spark):
    """The connector is not installed here, so the job stops at that source."""
    df = spark.createDataFrame([("u", "t")], "url string, title string")
    with pytest.raises(Exception, match="(?i)kafka"):
        articles.publish_articles(df, "news", {"kafka.bootstrap.servers": "nowhere:9092"})
