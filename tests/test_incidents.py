import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from tidewire.plans import bindings
from tidewire.schemas import CLEAN, RAW_COLUMNS
from tidewire.session import scratch_path
from tidewire.sources import incidents, tables

WIDE = ["extra_a", *RAW_COLUMNS, "extra_b"]


def record(**values):
    base = dict.fromkeys(RAW_COLUMNS)
    base.update(eventid="1", iyear="2000", imonth="1", iday="2", latitude="1.5", longitude="2.5")
    base.update(values)
    return tuple(base[name] for name in RAW_COLUMNS)


def raw(spark, *records):
    return spark.createDataFrame(list(records), ", ".join(f"{name} string" for name in RAW_COLUMNS))


def csv_line(summary, city="x", cut=0, extra=()):
    values = dict.fromkeys(WIDE, "1")
    values.update(city=city, summary=summary)
    fields = [values[name] for name in WIDE]
    return ",".join([*(fields[:-cut] if cut else fields), *extra])


def test_malformed_csv_rows_are_skipped(spark, tmp_path):
    lines = [
        ",".join(WIDE),
        csv_line("good"),
        csv_line('""', city="empty quoted"),
        csv_line("", city="empty"),
        csv_line("short", cut=3),
        csv_line("long", extra=("7", "8")),
        csv_line('"say ""no"" twice"'),
        csv_line('"two\nlines"'),
    ]
    (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
    df = incidents.read_incident_csv(spark, str(tmp_path / "in.csv"))
    assert df.columns == RAW_COLUMNS
    assert {t for _, t in df.dtypes} == {"string"}
    kept = [r.summary for r in df.collect()]
    assert sorted(kept, key=str) == sorted(["good", None, None, 'say "no" twice', "two\nlines"], key=str)
    assert df.select("city").count() == 5


def test_rows_in_another_encoding_are_skipped(spark, tmp_path):
    lines = [",".join(WIDE), csv_line("São"), csv_line("plain"), csv_line("cafe"), csv_line("kept \ufffd sign")]
    raw_bytes = "\n".join(lines).encode().replace(b"cafe", b"caf\xe9")
    (tmp_path / "in.csv").write_bytes(raw_bytes)
    df = incidents.read_incident_csv(spark, str(tmp_path / "in.csv"))
    assert sorted(r.summary for r in df.collect()) == ["São", "kept \ufffd sign", "plain"]
    assert df.select("city").count() == 3
    latin = incidents.read_incident_csv(spark, str(tmp_path / "in.csv"), multi_line=False, encoding="ISO-8859-1")
    assert "café" in [r.summary for r in latin.collect()]


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    for name, header in (("a", RAW_COLUMNS), ("b", RAW_COLUMNS[::-1])):
        (tmp_path / f"{name}.csv").write_text(",".join(header) + "\n" + ",".join(header) + "\n")
    with pytest.raises(Exception):
        incidents.read_incident_csv(spark, str(tmp_path)).collect()


def test_clean_types_and_filter(spark):
    df = raw(spark, record(nkill="3.0", nwound="2.5"), record(nkill="bad", latitude=None))
    clean = incidents.clean_incidents(df)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in CLEAN.fields]
    (only,) = clean.collect()
    assert (only.eventid, only.nkill, only.nwound, only.latitude) == (1, 3, 3, 1.5)


def test_bad_cast_modes(spark):
    df = raw(spark, record(nkill="many"), record(nkill="4"))
    with pytest.raises(Exception):
        incidents.clean_incidents(df).collect()
    assert sorted(r.nkill or 0 for r in incidents.clean_incidents(df, "null").collect()) == [0, 4]
    assert [r.nkill for r in incidents.clean_incidents(df, "quarantine").collect()] == [4]
    assert [r.nkill for r in incidents.quarantined_incidents(df).collect()] == ["many"]
    with pytest.raises(ValueError):
        incidents.clean_incidents(df, "ignore")


def test_write_raw_overwrite(spark, sf):
    path = scratch_path(spark, "raw")
    df = bindings.incidents_raw(spark, sf)
    assert tables.write_raw(df, path) == 1500
    assert tables.write_raw(df.where("eventid < 100"), path) == 100
    assert tables.read_table(spark, path).count() == 100


def test_write_clean_overwrite(spark, sf):
    path = scratch_path(spark, "clean")
    df = bindings.clean(spark, sf)
    assert tables.write_clean(df, path, partition_by_year=True) == 1470
    back = tables.read_table(spark, path)
    assert back.count() == 1470
    years = back.where(F.col("iyear").between(1997, 1998))
    assert "PartitionFilters: [isnotnull(iyear" in plan(years)
    assert rows(years.select("eventid")) == rows(df.where("iyear in (1997, 1998)").select("eventid"))
    assert tables.write_clean(df.limit(0), path) == 0


def test_filters_reach_the_scan(spark, sf):
    from tidewire.operators import filters

    path = scratch_path(spark, "clean")
    tables.write_clean(bindings.clean(spark, sf), path)
    shown = filters.filter_incidents(tables.read_table(spark, path), (1996, 1998), region="ASIA", group="O'Neil")
    text = plan(shown.select("city"))
    for pushed in ("EqualTo(region_txt,ASIA)", "EqualTo(gname,O'Neil)", "GreaterThanOrEqual(iyear,1996)",
                   "IsNotNull(latitude)"):
        assert pushed in text
    assert "attacktype1_txt" not in text


def small_blocks(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture
def cut_files(spark):
    yield lambda size: small_blocks(spark, size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [700, 2_000, 100_000])
def test_quoted_line_breaks_in_a_file_read_by_many_tasks(spark, tmp_path, cut_files, size, ending):
    made = random.Random(size)
    bits = ['""', ending, ending * 2, ",", "word", " ", "é", '"",""', "x" * 300]
    lines = [",".join(WIDE)]
    for i in range(400):
        quoted = '"' + "".join(made.choice(bits) for _ in range(made.randrange(30))) + '"'
        lines.append(csv_line(made.choice([quoted, quoted, "", "plain"]), city=f"c{i}", cut=3 if i % 50 == 7 else 0))
    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.csv").write_bytes((ending.join(lines) + ending).encode())
    whole = rows(incidents.read_incident_csv(spark, str(tmp_path / "in")))
    cut_files(size)
    split = incidents.read_incident_csv(spark, str(tmp_path / "in"), split=True)
    assert rows(split) == whole and len(whole) == 2 * 392
    if size < 100_000:
        tasks = spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions()
        assert tasks > 8


def test_split_csv_with_a_field_larger_than_blocks_no_rows_or_an_open_quote(spark, tmp_path, cut_files):
    cut_files(500)
    long = '"' + "line\n" * 1_000 + '"'
    text = "\n".join([",".join(WIDE), csv_line("a"), csv_line(long), csv_line('"b\nc"')])
    (tmp_path / "long.csv").write_text(text)
    found = incidents.read_incident_csv(spark, str(tmp_path / "long.csv"), split=True)
    assert sorted(r.summary for r in found.collect()) == ["a", "b\nc", "line\n" * 1_000]
    (tmp_path / "none.csv").write_text(",".join(WIDE) + "\n")
    assert incidents.read_incident_csv(spark, str(tmp_path / "none.csv"), split=True).count() == 0
    (tmp_path / "open.csv").write_text(text + '\n"')
    with pytest.raises(ValueError, match="ends in a quoted field"):
        incidents.read_incident_csv(spark, str(tmp_path / "open.csv"), split=True)
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text(text)
    (tmp_path / "two" / "b.csv").write_text(text.replace("city", "town"))
    with pytest.raises(Exception, match="another header"):
        incidents.read_incident_csv(spark, str(tmp_path / "two"), split=True).collect()
