"""Every operator bound to the test tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.articles import dedupe_key, url_missing
from ..functions.casts import ntz_to_iso
from ..functions.words import BASE_STOPWORDS, NEWS_STOPWORDS, stopwords
from ..operators import clusters, dedupe, filters, frames, geo, patterns, sampling, text, views
from ..session import materialize, scratch_path
from ..sources import articles as art
from ..sources import incidents as inc
from ..sources import tables
from ..sources.commits import read_state
from ..streaming.counts import BatchCounts, read_counts
from ..streaming.ingest import from_topic, ingest, ingest_first, ingest_recent, read_article_stream, stage_batch
from . import bindings as b
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STOP = stopwords()
NEWS_STOP = stopwords(BASE_STOPWORDS, NEWS_STOPWORDS)
FILTERS = {"years": (1996, 1999), "region": "ASIA", "attack": "2-HIGH"}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Sources, sinks, cleaning


@query
def csv_roundtrip_load(spark, sf):
    path = scratch_path(spark, "incidents-csv")
    b.incidents_raw(spark, sf).write.options(header=True, quote='"', escape='"').csv(path)
    return inc.read_incident_csv(spark, path)


@query
def csv_split_load(spark, sf):
    """Fields with line breaks and quotes in them, from files that many tasks may read."""
    path = scratch_path(spark, "broken-lines-csv")
    raw = b.incidents_raw(spark, sf).withColumn("city", F.concat("city", F.lit('\n"city"\n\n'), "eventid"))
    raw.write.options(header=True, quote='"', escape='"').csv(path)
    return inc.read_incident_csv(spark, path, split=True)


@query
def clean_incidents(spark, sf):
    return inc.clean_incidents(b.incidents_raw(spark, sf))


@query
def load_clean_report(spark, sf):
    raw = b.incidents_raw(spark, sf, summary=False)
    return tables.load_report(raw, inc.clean_incidents(raw))


FIELDS = ["title", "url", "published_at", "source_name", "author", "description", "content"]


def _article_fields(df: DataFrame) -> DataFrame:
    return df.select("off", *FIELDS)


def _stored(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """All stored columns, the message as it came among them."""
    return df.select(*keep, *FIELDS, "raw_json")


@query
def articles_scan(spark, sf):
    extracted = art.extract_article(art.decode_articles(b.messages(spark, sf)), keep=["off"])
    return _stored(materialize(art.accepted(extracted), "articles"), ["off"])


@query
def articles_count(spark, sf):
    return b.articles_in(spark, sf).agg(F.count("*").alias("articles"))


@query
def decode_articles(spark, sf):
    decoded = art.decode_articles(b.messages(spark, sf, broken=True))
    fields = ["title", "url", "publishedAt", "author", "description", "content"]
    return decoded.select("off", "decoded", *[F.col(f"doc.{name}").alias(name) for name in fields])


@query
def extract_article_fields(spark, sf):
    decoded = art.decode_articles(b.landed_messages(spark, sf, broken=True))
    extracted = art.extract_article(decoded.withColumnRenamed("offset", "off"), keep=["off"])
    return _stored(art.accepted(extracted), ["off"])


@query
def quarantine_bad_articles(spark, sf):
    extracted = art.extract_article(art.decode_articles(b.messages(spark, sf, broken=True)), keep=["off"])
    return art.quarantine(extracted, keep=["off"]).select("off", "reject_reason")


@query
def response_pages_explode(spark, sf):
    pages = art.explode_response_pages(b.response_pages(spark, sf), keep=["page"])
    return art.accepted(art.extract_article(art.decode_articles(pages), keep=["page"])).select(
        "page", "title", "url", "published_at", "source_name"
    )


@query
def response_pages_rejected(spark, sf):
    return art.rejected_pages(b.response_pages(spark, sf), keep=["page"]).select("page", "status", "message")


@query
def article_messages(spark, sf):
    shaped = art.as_api_articles(b.articles_in(spark, sf), keep=["off"])
    sent = art.article_messages(shaped, keep=["off"])
    return sent.select(
        "off",
        "key",
        F.get_json_object("value", "$.title").alias("title"),
        F.get_json_object("value", "$.publishedAt").alias("published_text"),
        F.get_json_object("value", "$.source.name").alias("source_name"),
        F.contains("value", F.lit('"author":null')).alias("null_author_kept"),
    )


@query
def article_dedupe_key(spark, sf):
    published = ntz_to_iso(F.col("published_at"))
    return b.articles_in(spark, sf).select(
        "off", dedupe_key(F.col("url"), F.col("title"), published).alias("dedupe_key")
    )


# De-duplication and streaming


def _stored_first_half(spark, sf):
    old, fresh = b.first_half(b.articles_in(spark, sf))
    return materialize(dedupe.article_keys(dedupe.new_articles(old, None, ["off"])), "keys"), fresh


@query
def anti_join_url(spark, sf):
    old, fresh = b.first_half(b.articles_in(spark, sf))
    return _article_fields(dedupe.unseen_by_url(fresh.where(~url_missing(F.col("url"))), old))


@query
def anti_join_title_time(spark, sf):
    old, fresh = b.first_half(b.articles_in(spark, sf))
    return _article_fields(dedupe.unseen_by_title_time(fresh.where(url_missing(F.col("url"))), old))


@query
def dedupe_articles(spark, sf):
    return _article_fields(dedupe.new_articles(b.articles_in(spark, sf), None, ["off"]))


@query
def dedupe_articles_incremental(spark, sf):
    keys, fresh = _stored_first_half(spark, sf)
    return _article_fields(dedupe.new_articles(fresh, keys, ["off"]))


def _two_waves(spark, sf, again: Callable[[str, str], str]) -> str:
    """Ingest two landings; ``again`` gives the second one's checkpoint from a fresh path and the first's."""
    landing, path, checkpoint, fresh = (scratch_path(spark, part) for part in ("landing", "stored", "first", "fresh"))
    sent = b.landed_messages(spark, sf, broken=True)
    middle = sent.agg(F.floor((F.max("offset") + 1) / 2)).scalar()
    for wave in (F.col("offset") < middle, F.col("offset") >= middle):
        sent.where(wave).write.mode("append").parquet(landing)
        stream = read_article_stream(spark, "parquet", {"path": landing})
        ingest(stream, path, checkpoint, f"{path}-rejected", trigger={"availableNow": True}).awaitTermination()
        checkpoint = again(fresh, checkpoint)
    return path


@query
def stream_ingest_articles(spark, sf):
    """Two landings, the stream restarted in between from its checkpoint; both give one stored table."""
    return _stored(tables.read_articles(spark, _two_waves(spark, sf, lambda fresh, used: used)))


@query
def stream_ingest_new_checkpoint(spark, sf):
    """The same with a new checkpoint for the second landing, which then reads both: the stored rows stay."""
    return _stored(tables.read_articles(spark, _two_waves(spark, sf, lambda fresh, used: fresh)))


@query
def stream_ingest_after_crash(spark, sf):
    """A batch is written but its commit is lost; another checkpoint then reads the topic from its start."""
    landing, path, checkpoint = (scratch_path(spark, name) for name in ("landing", "stored", "checkpoint"))
    b.landed_messages(spark, sf, broken=True).write.parquet(landing)
    tables.ensure_articles(spark, path)
    first = from_topic(spark.read.parquet(landing).where("offset % 3 != 0"))
    stage_batch(first, 0, path, None, "lost", read_state(spark, path))
    stream = read_article_stream(spark, "parquet", {"path": landing})
    ingest(stream, path, checkpoint, trigger={"availableNow": True}).awaitTermination()
    return _stored(tables.read_articles(spark, path))


@query
def stream_ingest_small_batches(spark, sf):
    """One file per micro-batch: the keys of earlier batches come from their buckets."""
    landing, path, checkpoint = (scratch_path(spark, part) for part in ("landing", "stored", "checkpoint"))
    sent = b.landed_messages(spark, sf, broken=True).sort("offset")
    sent.repartitionByRange(4, "offset").sortWithinPartitions("offset").write.parquet(landing)
    stream = read_article_stream(spark, "parquet", {"path": landing, "maxFilesPerTrigger": "1"})
    ingest(stream, path, checkpoint, trigger={"availableNow": True}).awaitTermination()
    stored = tables.read_articles(spark, path)
    # Which file comes first is up to the file times, so only what does not depend on it is compared.
    return stored.where("url != ''").groupBy("url").agg(F.count("*").alias("copies"))


@query
def stream_compacted_articles(spark, sf):
    """The stored table after compaction."""
    path = _two_waves(spark, sf, lambda fresh, used: used)
    tables.compact_articles(spark, path, f"{path}-compact")
    return _stored(tables.read_articles(spark, f"{path}-compact"))


@query
def stream_recent_articles(spark, sf):
    """De-duplication with bounded state; the delay is longer than all event times."""
    landing, path, checkpoint = (scratch_path(spark, part) for part in ("landing", "recent", "checkpoint"))
    b.landed_messages(spark, sf, broken=True).write.parquet(landing)
    stream = read_article_stream(spark, "parquet", {"path": landing})
    ingest_recent(stream, path, checkpoint, "3650 days", {"availableNow": True}).awaitTermination()
    return spark.read.parquet(path).select("url")


@query
def stream_first_articles(spark, sf):
    """De-duplicated by keyed state, rows without url or time too; nothing is forgotten while the query runs."""
    landing, path, checkpoint = (scratch_path(spark, name) for name in ("landing", "first", "checkpoint"))
    b.landed_messages(spark, sf, broken=True).write.parquet(landing)
    stream = read_article_stream(spark, "parquet", {"path": landing})
    ingest_first(stream, path, checkpoint, {"availableNow": True}).awaitTermination()
    return _stored(spark.read.parquet(path))


@query
def stream_batch_counts(spark, sf):
    """What became of the messages of each of two micro-batches, as it is kept beside the table."""
    counts = read_counts(spark, _two_waves(spark, sf, lambda fresh, used: used))
    return counts.select("batch_id", "arrived", "rejected", "stored", "duplicates")


@query
def stream_reported_counts(spark, sf):
    """The same of a stream with keyed state, as a listener hears it, over all micro-batches."""
    landing, path, checkpoint = (scratch_path(spark, name) for name in ("landing", "first", "checkpoint"))
    b.landed_messages(spark, sf, broken=True).write.parquet(landing)
    stream = read_article_stream(spark, "parquet", {"path": landing})
    heard = BatchCounts(path)
    spark.streams.addListener(heard)
    try:
        ingest_first(stream, path, checkpoint, {"availableNow": True}, name=path).awaitTermination()
        heard.wait()
    finally:
        spark.streams.removeListener(heard)
    names = ["arrived", "rejected", "stored", "duplicates"]
    return heard.table(spark).agg(*[F.sum(name).alias(name) for name in names])


@query
def quarantined_stream_messages(spark, sf):
    """What the stream set aside, over both waves."""
    rejected = spark.read.parquet(_two_waves(spark, sf, lambda fresh, used: used) + "-rejected")
    return rejected.select(F.col("arrival_off").alias("off"), "reject_reason")


# Sinks: written and read back


@query
def sink_raw_and_clean(spark, sf):
    """Both tables replaced twice, the clean one in folders by year; the counts were observed while writing."""
    path = scratch_path(spark, "tables")
    raw = materialize(b.incidents_raw(spark, sf), "raw")
    for _ in range(2):
        raw_rows = tables.write_raw(raw, f"{path}/raw")
        loaded = inc.clean_incidents(tables.read_table(spark, f"{path}/raw"))
        clean_rows = tables.write_clean(loaded, f"{path}/clean", partition_by_year=True)
    stored = tables.read_table(spark, f"{path}/clean")
    return stored.groupBy("iyear").agg(
        F.count("*").alias("rows"), F.sum("eventid").alias("ids"), F.sum(F.length("summary")).alias("summary_chars")
    ).withColumns({"raw_rows": F.lit(raw_rows).cast("long"), "clean_rows": F.lit(clean_rows).cast("long")})


@query
def sink_exported_views(spark, sf):
    """A view that fails does not stop the others."""
    path = scratch_path(spark, "views")
    clean = b.clean(spark, sf)
    broken = clean.select(F.raise_error(F.lit("broken")).alias("x"))
    outcome = tables.export_results(
        {"broken": broken, "regions": views.ranked_counts(clean, "region_txt", "region")}, path
    )
    regions = spark.read.parquet(f"{path}/regions")
    return regions.withColumn("failed", F.lit(",".join(n for n, said in outcome.items() if said != "ok")))


# Filters and projections


@query
def filtered_incidents(spark, sf):
    return filters.dashboard_columns(filters.filter_incidents(b.clean(spark, sf, summary=True), **FILTERS))


@query
def filtered_incidents_quote(spark, sf):
    return filters.dashboard_columns(
        filters.filter_incidents(b.clean(spark, sf, summary=True), (1995, 2001), region="All", group="O'Neil")
    )


@query
def null_filled_incidents(spark, sf):
    filled = filters.fill_casualties(filters.with_year_label(b.clean(spark, sf)))
    return filled.select("eventid", "iyear", "iyear_str", "nkill_size", "nkill", "nwound")


@query
def locations_limit(spark, sf):
    return filters.locations(sampling.first_n(b.clean(spark, sf), 1_000, "eventid"))


@query
def nonnull_texts_limit(spark, sf):
    return sampling.texts(b.clean(spark, sf, summary=True), "summary", "eventid", limit=150)


@query
def year_bounds(spark, sf):
    return filters.year_bounds(b.clean(spark, sf))


@query
def filter_options_region(spark, sf):
    return filters.filter_options(b.clean(spark, sf), "region_txt")


@query
def filter_options_country_in_region(spark, sf):
    return filters.filter_options(b.clean(spark, sf), "country_txt", F.col("region_txt") == "ASIA")


@query
def filter_options_attack(spark, sf):
    return filters.filter_options(b.clean(spark, sf), "attacktype1_txt")


@query
def filter_options_group(spark, sf):
    return filters.filter_options(b.clean(spark, sf), "gname")


# Aggregations


@query
def incidents_per_year(spark, sf):
    return views.incidents_per_year(b.clean(spark, sf))


@query
def fatalities_per_year(spark, sf):
    return views.fatalities_per_year(b.clean(spark, sf))


@query
def attack_type_counts(spark, sf):
    return views.ranked_counts(b.clean(spark, sf), "attacktype1_txt", "attack")


@query
def attack_type_counts_nonnull(spark, sf):
    return views.ranked_counts(b.clean(spark, sf), "attacktype1_txt", "attack", drop_null_keys=True)


@query
def region_counts(spark, sf):
    return views.ranked_counts(b.clean(spark, sf), "region_txt", "region")


@query
def region_counts_nonnull(spark, sf):
    return views.ranked_counts(b.clean(spark, sf), "region_txt", "region", drop_null_keys=True)


@query
def country_counts(spark, sf):
    return views.ranked_counts(b.clean(spark, sf), "country_txt", "country", drop_null_keys=True)


@query
def attack_target_counts(spark, sf):
    counts = views.cooccurrence(b.clean(spark, sf), "attacktype1_txt", "targtype1_txt")
    return counts.withColumnsRenamed({"attacktype1_txt": "attack", "targtype1_txt": "target"})


@query
def attack_target_matrix(spark, sf):
    return views.crosstab(b.clean(spark, sf), "attacktype1_txt", "targtype1_txt")


@query
def attack_target_matrix_all(spark, sf):
    """With the NULL row and the column ``(none)`` for incidents without a target type."""
    return views.crosstab(b.clean(spark, sf), "attacktype1_txt", "targtype1_txt", drop_null_keys=False)


@query
def attack_year_trend(spark, sf):
    return views.with_bubble_size(views.trend(b.clean(spark, sf)))


@query
def attack_year_trend_nonnull(spark, sf):
    return views.trend(b.clean(spark, sf), drop_null_keys=True)


@query
def kpi_totals(spark, sf):
    return views.kpis(filters.filter_incidents(b.clean(spark, sf), **FILTERS))


@query
def kpi_totals_empty(spark, sf):
    return views.kpis(filters.filter_incidents(b.clean(spark, sf), (1995, 2001), group="no such group"))


@query
def top_countries(spark, sf):
    return views.top_n(b.clean(spark, sf), "country_txt", 15).withColumnRenamed("country_txt", "country")


@query
def deadliest_groups(spark, sf):
    top = views.top_n_by_sum(b.clean(spark, sf), "gname", "nkill", 15, exclude="Unknown", name="kills")
    return top.withColumnRenamed("gname", "group_name")


@query
def sample_subset(spark, sf):
    return sampling.materialize_sample(b.clean(spark, sf, summary=True), "eventid", 1_000)


@query
def latest_articles(spark, sf):
    return views.latest(b.articles_in(spark, sf), "published_at", 10, tie="off").select("title", "published_at")


@query
def top_sources(spark, sf):
    return views.top_n(b.articles_in(spark, sf), "source_name", 20, drop_null_keys=True)


# Frames


@query
def cumulative_frames(spark, sf):
    shown = filters.fill_casualties(b.clean(spark, sf, summary=True))
    return frames.cumulative_frames(shown).drop("frame_year")


@query
def frame_spans(spark, sf):
    return frames.frame_spans(b.clean(spark, sf, summary=True), every=2)


@query
def cumulative_year_counts(spark, sf):
    return frames.cumulative_year_counts(b.clean(spark, sf))


# Text


@query
def title_tokens(spark, sf):
    return text.title_tokens(b.articles_in(spark, sf), "title", NEWS_STOP, ["off", "source_name"])


@query
def top_keywords(spark, sf):
    return text.top_tokens(b.articles_in(spark, sf), "title", NEWS_STOP, 15)


@query
def keyword_source_long(spark, sf):
    return text.keyword_source_long(b.articles_in(spark, sf), NEWS_STOP, n_sources=5)


@query
def keyword_source_matrix(spark, sf):
    return text.keyword_source_matrix(b.articles_in(spark, sf), NEWS_STOP)


@query
def title_word_freq(spark, sf):
    return _rounded(text.word_frequencies(b.articles_in(spark, sf), "title", NEWS_STOP))


@query
def title_word_sets(spark, sf):
    sets = patterns.frequent_word_sets(b.articles_in(spark, sf), "off", "title", NEWS_STOP, 0.1, max_size=3)
    return sets.withColumn("words", F.array_join("words", " "))


@query
def title_tfidf(spark, sf):
    """The vectors that titles are clustered by."""
    cells, terms = clusters.weighted_terms(b.articles_in(spark, sf), "off", "title", NEWS_STOP)
    return cells.join(terms, "term").select(F.col("row").alias("off"), "token", "weight")


@query
def title_clusters(spark, sf):
    """The cluster of every title."""
    found, _ = clusters.topic_clusters(b.articles_in(spark, sf), "off", "title", NEWS_STOP)
    return found.select(F.col("row").alias("off"), "cluster", "similarity")


@query
def title_cluster_terms(spark, sf):
    """The first words of the clusters of titles."""
    return clusters.topic_clusters(b.articles_in(spark, sf), "off", "title", NEWS_STOP)[1]


@query
def keyword_shift(spark, sf):
    """Words of the incidents' summaries against those of the article titles."""
    past = text.token_counts(b.clean(spark, sf, summary=True), "summary", NEWS_STOP)
    now = text.token_counts(b.articles_in(spark, sf), "title", NEWS_STOP)
    compared = patterns.compare_counts(past, now)
    doubles = [name for name, kind in compared.dtypes if kind == "double"]
    return compared.withColumns({name: F.round(name, 9) for name in doubles})


def _rounded(top: DataFrame) -> DataFrame:
    return top.withColumn("weight", F.round("weight", 9))


@query
def summary_word_freq(spark, sf):
    return _rounded(
        text.word_frequencies(b.clean(spark, sf, summary=True), "summary", STOP, with_collocations=True)
    )


@query
def summary_collocations(spark, sf):
    found = text.collocations(b.clean(spark, sf, summary=True), "summary", STOP)
    return found.withColumn("score", F.round("score", 6))


# Density


@query
def geo_bins(spark, sf):
    binned = geo.bin_points(b.clean(spark, sf), "longitude", "latitude")
    return binned.withColumns({"mean_x": F.round("mean_x", 8), "mean_y": F.round("mean_y", 8)})


def _grid_rounded(grid: DataFrame) -> DataFrame:
    return grid.withColumns({"x": F.round("x", 6), "y": F.round("y", 6), "density": F.round("density", 12)})


@query
def kde_density(spark, sf):
    return _grid_rounded(geo.kde_grid(b.clean(spark, sf), "longitude", "latitude"))


@query
def kde_density_exact(spark, sf):
    """Every point for itself. The points are two components of the vectors."""
    points = b.table(spark, sf, "embeddings").select(
        F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y")
    )
    grid = geo.kde_grid(points, "x", "y", bins=None)
    return grid.withColumns({"x": F.round("x", 9), "y": F.round("y", 9), "density": F.round("density", 8)})


@query
def kde_levels(spark, sf):
    levels = geo.density_levels(geo.kde_grid(b.clean(spark, sf), "longitude", "latitude"))
    return levels.withColumns({"share": F.round("share", 6), "density": F.round("density", 11)})


# Jobs


def _long(view: str, df: DataFrame, keys: list[str], value: str) -> DataFrame:
    key = F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("-")) for k in keys])
    return df.select(F.lit(view).alias("view"), key.alias("key"), F.col(f"`{value}`").cast("long").alias("value"))


def _matrix_long(view: str, df: DataFrame, row: str) -> DataFrame:
    return _long(view, df.unpivot([row], [c for c in df.columns if c != row], "col", "n"), [row, "col"], "n")


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def job_incidents(spark, sf):
    """The batch job from CSV to views, as one long table of (view, key, value)."""
    path = scratch_path(spark, "job")
    b.incidents_raw(spark, sf).write.options(header=True, quote='"', escape='"').csv(f"{path}/csv")
    done = jobs.run_incident_job(spark, f"{path}/csv", f"{path}/out")
    view = lambda name: spark.read.parquet(f"{path}/out/views/{name}")
    counted = spark.range(1).select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("key"), F.lit(done[n]).alias("value")) for n in ("raw_rows", "clean_rows")]))
    )
    return _all([
        _long("job", counted, ["key"], "value"),
        _long("incidents_per_year", view("incidents_per_year"), ["iyear"], "count"),
        _long("fatalities_per_year", view("fatalities_per_year"), ["iyear"], "fatalities"),
        _long("attack_types", view("attack_types"), ["attack"], "count"),
        _long("regions", view("regions"), ["region"], "count"),
        _long("top_countries", view("top_countries"), ["country_txt"], "count"),
        _long("deadliest_groups", view("deadliest_groups"), ["gname"], "kills"),
        _long("attack_targets", view("attack_targets"), ["attacktype1_txt", "targtype1_txt"], "count"),
        _long("attack_trend", view("attack_trend"), ["iyear", "attack"], "incidents"),
        _matrix_long("attack_target_matrix", view("attack_target_matrix"), "attacktype1_txt"),
        _long("summary_words", view("summary_words"), ["term"], "count"),
    ])


@query
def job_news(spark, sf):
    """The news job over stored articles, as (view, key, value)."""
    path = scratch_path(spark, "news")
    jobs.run_news_job(spark, b.articles_in(spark, sf), path)
    view = lambda name: spark.read.parquet(f"{path}/{name}")
    return _all([
        _long("title_words", view("title_words"), ["term"], "count"),
        _long("top_sources", view("top_sources"), ["source_name"], "count"),
        _matrix_long("keyword_source_matrix", view("keyword_source_matrix").drop("kw_rank"), "token"),
    ])


@query
def job_explore(spark, sf):
    """The interactive views of a selection on a sample, as (view, key, value)."""
    found = jobs.explore(b.clean(spark, sf, summary=True), (1995, 1997), region="ASIA", sample_n=200)
    kpis = found["kpis"].select(F.lit("n").alias("key"), "total_incidents")
    return _all([
        _long("kpis", kpis, ["key"], "total_incidents"),
        _long("year_frames", found["year_frames"], ["frame_year", "iyear"], "count"),
        _long("map_frames", found["map_frames"].groupBy("frame_year").count(), ["frame_year"], "count"),
        _long("attack_types", found["attack_types"], ["attack"], "count"),
        _long("regions", found["regions"], ["region"], "count"),
        _long("countries", found["countries"], ["country"], "count"),
        _long("attack_trend", found["attack_trend"], ["iyear", "attack"], "incidents"),
        _long("attack_targets", found["attack_targets"], ["attacktype1_txt", "targtype1_txt"], "count"),
        _matrix_long("attack_target_matrix", found["attack_target_matrix"], "attacktype1_txt"),
        _long("summary_words", found["summary_words"], ["term"], "count"),
    ])
