import math

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidewire.operators import filters, frames, sampling, views
from tidewire.plans import bindings

INCIDENT = """eventid long, iyear int, country_txt string, region_txt string, city string, latitude double,
longitude double, attacktype1_txt string, targtype1_txt string, gname string, nkill int, nwound int, summary string"""


def incidents(spark, *records):
    defaults = dict(
        eventid=1, iyear=2000, country_txt="C", region_txt="R", city="x", latitude=1.0, longitude=2.0,
        attacktype1_txt="A", targtype1_txt="T", gname="G", nkill=1, nwound=1, summary=None,
    )
    return spark.createDataFrame([tuple({**defaults, **r}.values()) for r in records], INCIDENT)


def test_null_groups_kept_or_dropped(spark):
    df = incidents(spark, {"region_txt": None}, {"region_txt": None}, {"region_txt": "N"})
    assert rows(views.ranked_counts(df, "region_txt", "region")) == [(None, 2), ("N", 1)]
    assert rows(views.ranked_counts(df, "region_txt", "region", drop_null_keys=True)) == [("N", 1)]
    df = incidents(spark, {"attacktype1_txt": None, "nkill": 4}, {})
    assert rows(views.trend(df)) == [(2000, None, 1, 4), (2000, "A", 1, 1)]
    assert rows(views.trend(df, drop_null_keys=True)) == [(2000, "A", 1, 1)]


def test_top_n_breaks_ties_by_key(spark):
    df = incidents(spark, *[{"country_txt": c} for c in "bbaacd"])
    assert [tuple(r) for r in views.top_n(df, "country_txt", 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_deadliest_groups_skip_unknown_and_null(spark):
    df = incidents(
        spark, {"gname": "Unknown", "nkill": 99}, {"gname": None, "nkill": 50}, {"gname": "G", "nkill": None},
        {"gname": "H", "nkill": 2},
    )
    top = views.top_n_by_sum(df, "gname", "nkill", 15, exclude="Unknown", name="kills")
    assert [tuple(r) for r in top.collect()] == [("H", 2), ("G", 0)]


def test_sorted_view_puts_nulls_last(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "v int")
    assert [r.v for r in views.sorted_view(df, "v").collect()] == [1, 2, None]
    assert [r.v for r in views.sorted_view(df, "v", desc=True).collect()] == [2, 1, None]


def test_crosstab_with_null_keys(spark):
    df = incidents(spark, {"attacktype1_txt": None}, {"targtype1_txt": None}, {})
    matrix = views.crosstab(df, "attacktype1_txt", "targtype1_txt", drop_null_keys=False)
    assert rows(matrix.select("attacktype1_txt", "(none)", "T")) == [(None, 0, 1), ("A", 1, 1)]


def test_crosstab_fills_zero(spark):
    df = incidents(
        spark, {"targtype1_txt": "x"}, {"targtype1_txt": "x"}, {"attacktype1_txt": "B", "targtype1_txt": "y"},
        {"targtype1_txt": None},
    )
    for values in (None, ["x", "y"]):
        matrix = views.crosstab(df, "attacktype1_txt", "targtype1_txt", values)
        assert matrix.columns == ["attacktype1_txt", "x", "y"]
        assert rows(matrix) == [("A", 2, 0), ("B", 0, 1)]


def test_casualty_fill_order(spark):
    df = filters.fill_casualties(incidents(spark, {"nkill": None, "nwound": None}, {"nkill": 3, "nwound": 4}))
    assert rows(df.select("nkill", "nwound", "nkill_size")) == [(0, 0, 1), (3, 4, 3)]


def test_quote_in_a_filter_value(spark):
    df = incidents(spark, {"gname": "O'Neil"}, {"gname": "ONeil"}, {"gname": None})
    assert filters.filter_incidents(df, (1990, 2010), group="O'Neil").count() == 1
    assert filters.filter_incidents(df, (1990, 2010), region="All", group="All").count() == 3
    assert filters.filter_incidents(df, (2001, 2010)).count() == 0


def test_options_start_with_all(spark):
    df = incidents(spark, {"gname": "b"}, {"gname": "a"}, {"gname": None}, {"gname": "a"})
    assert [r.option for r in filters.filter_options(df, "gname").collect()] == ["All", "a", "b", None]
    cascade = filters.filter_options(df, "gname", F.col("gname") == "b")
    assert [r.option for r in cascade.collect()] == ["All", "b"]


def test_kpis_of_nothing_are_zero(spark):
    df = incidents(spark, {}).where("false")
    assert rows(views.kpis(df)) == [(0, 0, 0)]


def test_frames(spark):
    df = incidents(spark, {"iyear": 2000}, {"iyear": 2000}, {"iyear": 2002}, {"iyear": None})
    shown = frames.cumulative_frames(df.select("iyear"))
    assert rows(shown) == [(2000, 2000, "2000")] * 2 + [(2000, 2002, "2002")] * 2 + [(2002, 2002, "2002")]
    counts = frames.cumulative_year_counts(df).select("frame_year", "iyear", "count")
    assert rows(counts) == [("2000", 2000, 2), ("2002", 2000, 2), ("2002", 2002, 1)]
    assert "Join" not in plan(shown) and "CartesianProduct" not in plan(shown)


def test_frames_take_any_integer(spark):
    df = incidents(spark, {"iyear": 123456}, {"iyear": -5}, {"iyear": 0})
    assert rows(frames.cumulative_frames(df.select("iyear")).select("frame_year", "iyear")) == [
        (-5, -5), (0, -5), (0, 0), (123456, -5), (123456, 0), (123456, 123456)
    ]


@pytest.mark.parametrize("n", [0, 1, 7, 300, 999, 1000, 5000])
def test_sample_is_exactly_the_plain_top_k(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "key")
    digest = F.md5(F.concat(F.col("key").cast("string"), F.lit("|42")))
    expected = rows(df.orderBy(digest, "key").limit(n))
    assert rows(sampling.random_sample(df, "key", n)) == expected
    assert len(expected) == min(n, 1000)


def test_sample_depends_on_seed_not_on_partitions(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    first = rows(sampling.random_sample(df, "key", 50, seed=1))
    assert rows(sampling.random_sample(df.repartition(13), "key", 50, seed=1)) == first
    assert rows(sampling.random_sample(df, "key", 50, seed=2)) != first


def test_sample_is_uniform(spark):
    df = spark.range(20_000).withColumnRenamed("id", "key")
    picked = [r[0] for r in sampling.random_sample(df, "key", 2000).collect()]
    halves = sum(key < 10_000 for key in picked)
    assert abs(halves - 1000) < 4 * math.sqrt(500)


def test_stored_sample(spark, sf):
    clean = bindings.clean(spark, sf)
    sample = sampling.materialize_sample(clean, "eventid", 100)
    assert sample.count() == 100 and sample.schema == clean.schema


def test_texts(spark):
    df = incidents(spark, {"eventid": 1, "summary": "a"}, {"eventid": 2}, {"eventid": 3, "summary": "b"})
    assert rows(sampling.texts(df, "summary", "eventid")) == [(1, "a"), (3, "b")]
    assert sampling.texts(df, "summary", "eventid", limit=1).count() == 1


def test_latest_puts_unknown_times_last(spark):
    df = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2025-01-02'), (2, NULL), (3, timestamp_ntz'2025-01-03') t(k, ts)")
    assert [r.k for r in views.latest(df, "ts", 3, tie="k").collect()] == [3, 1, 2]


def test_plans(spark, sf):
    from tidewire.plans.queries import QUERIES

    for name in ("top_countries", "deadliest_groups", "latest_articles", "top_sources", "top_keywords"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf)), name
    for name in ("keyword_source_long", "keyword_source_matrix"):
        text = plan(QUERIES[name](spark, sf))
        assert "SortMergeJoin" not in text, name
    for name, query in QUERIES.items():
        if name.startswith(("stream", "quarantined_stream", "job", "sink")):
            continue
        text = plan(query(spark, sf))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        if name != "kde_density_exact":  # sums its points in numpy
            assert "Python" not in text and "InPandas" not in text, name


EMPTY_VIEWS = {
    "per_year": views.incidents_per_year,
    "fatalities": views.fatalities_per_year,
    "attacks": lambda df: views.ranked_counts(df, "attacktype1_txt", "attack"),
    "countries": lambda df: views.top_n(df, "country_txt", 15),
    "groups": lambda df: views.top_n_by_sum(df, "gname", "nkill", 15, exclude="Unknown"),
    "matrix": lambda df: views.crosstab(df, "attacktype1_txt", "targtype1_txt"),
    "trend": lambda df: views.with_bubble_size(views.trend(df)),
    "frames": frames.cumulative_frames,
    "frame_counts": frames.cumulative_year_counts,
    "sample": lambda df: sampling.random_sample(df, "eventid", 10),
}


@pytest.mark.parametrize("name", sorted(EMPTY_VIEWS))
def test_views_of_nothing_are_empty(spark, name):
    assert EMPTY_VIEWS[name](incidents(spark, {}).where("false")).count() == 0


def test_views_of_nulls(spark):
    nothing = {name: None for name in incidents(spark, {}).columns} | {"eventid": 1}
    df = incidents(spark, nothing)
    assert rows(views.incidents_per_year(df)) == [(None, 1)]
    assert rows(views.fatalities_per_year(df)) == [(None, 0)]
    assert rows(views.kpis(df)) == [(1, 0, 0)]
    assert views.crosstab(df, "attacktype1_txt", "targtype1_txt").count() == 0
    assert frames.cumulative_frames(df).count() == 0
