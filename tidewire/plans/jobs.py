"""Composite jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.words import BASE_STOPWORDS, NEWS_STOPWORDS, stopwords
from ..operators import filters, frames, geo, sampling, text, views
from ..session import materialize, scratch_scope
from ..sources.incidents import clean_incidents, read_incident_csv
from ..sources.tables import export_results, read_table, write_clean, write_raw


def incident_views(clean: DataFrame) -> dict[str, DataFrame]:
    """The batch views over the clean table; each scans only the columns it needs."""
    density = materialize(geo.kde_grid(clean, "longitude", "latitude"), "density")
    return {
        "incidents_per_year": views.incidents_per_year(clean),
        "fatalities_per_year": views.fatalities_per_year(clean),
        "attack_types": views.ranked_counts(clean, "attacktype1_txt", "attack"),
        "regions": views.ranked_counts(clean, "region_txt", "region"),
        "top_countries": views.top_n(clean, "country_txt", 15),
        "deadliest_groups": views.top_n_by_sum(clean, "gname", "nkill", 15, exclude="Unknown", name="kills"),
        "attack_targets": views.cooccurrence(clean, "attacktype1_txt", "targtype1_txt"),
        "location_density": density,
        "density_levels": geo.density_levels(density),
        "attack_trend": views.with_bubble_size(views.trend(clean)),
        "summary_words": text.word_frequencies(clean, "summary", stopwords(), with_collocations=True),
    }


def run_incident_job(spark: SparkSession, csv: str, out: str, on_error: str = "fail") -> dict:
    """Load, clean, and write every view. The clean table is written once and feeds all views."""
    raw_rows = write_raw(read_incident_csv(spark, csv), f"{out}/incidents_raw")
    clean_rows = write_clean(
        clean_incidents(read_table(spark, f"{out}/incidents_raw"), on_error), f"{out}/incidents_clean"
    )
    clean = read_table(spark, f"{out}/incidents_clean")
    with scratch_scope(spark):
        matrix = views.crosstab(clean, "attacktype1_txt", "targtype1_txt", drop_null_keys=False)
        outcome = export_results(incident_views(clean) | {"attack_target_matrix": matrix}, f"{out}/views")
    failed = {name: error for name, error in outcome.items() if error != "ok"}
    if failed:
        raise RuntimeError(f"views failed: {failed}")
    return {"raw_rows": raw_rows, "clean_rows": clean_rows, "views": outcome}


def run_news_job(spark: SparkSession, articles: DataFrame, out: str) -> dict[str, str]:
    """Title words, sources and the keyword matrix. One failing analysis does not stop the others."""
    stop = stopwords(BASE_STOPWORDS, NEWS_STOPWORDS)
    analyses = {
        "title_words": lambda: text.word_frequencies(articles, "title", stop),
        "top_sources": lambda: views.top_n(articles, "source_name", 20, drop_null_keys=True),
        "keyword_source_matrix": lambda: text.keyword_source_matrix(articles, stop),
    }
    outcome = {}
    for name, build in analyses.items():
        try:
            with scratch_scope(spark):
                outcome |= export_results({name: build()}, out)
        except Exception as error:
            outcome[name] = f"{type(error).__name__}: {error}"
    return outcome


def explore(
    clean: DataFrame,
    years: tuple[int, int],
    region: str | None = None,
    country: str | None = None,
    attack: str | None = None,
    group: str | None = None,
    sample_n: int | None = None,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """The interactive views over the filtered rows, all empty for an empty selection.

    Totals cover every filtered row; with ``sample_n`` all views work on one stored random sample instead. The word
    pairs of the summaries and the counts of the matrix are written once, when this is called; all else is lazy.
    """
    rows = filters.filter_incidents(clean, years, region, country, attack, group)
    if sample_n is not None:
        rows = materialize(sampling.random_sample(rows, "eventid", sample_n, seed), "explore")
    shown = filters.fill_casualties(filters.with_year_label(filters.dashboard_columns(rows)))
    return {
        "kpis": views.kpis(shown),
        "map_frames": frames.cumulative_frames(shown),
        "year_frames": frames.cumulative_year_counts(shown),
        "attack_types": views.ranked_counts(shown, "attacktype1_txt", "attack", drop_null_keys=True),
        "regions": views.ranked_counts(shown, "region_txt", "region", drop_null_keys=True),
        "countries": views.ranked_counts(shown, "country_txt", "country", drop_null_keys=True),
        "attack_trend": views.trend(shown, drop_null_keys=True),
        "attack_targets": views.cooccurrence(shown, "attacktype1_txt", "targtype1_txt", drop_null_keys=True),
        "attack_target_matrix": views.crosstab(shown, "attacktype1_txt", "targtype1_txt"),
        "summary_words": text.word_frequencies(shown, "summary", stopwords(), with_collocations=True),
    }
