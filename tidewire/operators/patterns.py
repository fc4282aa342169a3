"""Recurring word sets of texts, and words that set two corpora apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .text import title_tokens


def frequent_sets(items: DataFrame, row: str, item: str, min_share: float, max_size: int | None = None) -> DataFrame:
    """(words, size, n): the sets of items that at least ``min_share`` of the rows hold together, and how many do.

    Prefix projection: each row carries, for every frequent set in it, only those of its later items that are frequent
    with that set. The rarest items come first, so that few rows go far. Items below the share never leave the first
    count; of the others a row's number times the share is bounded by its length, so the vocabulary does not grow with the
    rows. A NULL item counts nowhere; rows without items are not counted among all rows, repeated items once.
    """
    if not 0 < min_share <= 1:
        raise ValueError("min_share must lie above 0 and not above 1")
    pairs = materialize(items.select(F.col(row).alias("row"), F.col(item).alias("item")).dropna().distinct(), "items")
    rows = pairs.select("row").distinct().count()
    least = min_share * rows - 1e-9
    counts = pairs.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    ranked = materialize(counts.withColumn("rank", F.row_number().over(Window.orderBy("n", "item"))), "ranked")
    held = pairs.join(ranked, "item").groupBy("row").agg(F.sort_array(F.collect_set("rank")).alias("rest"))
    projected = held.select(F.array().cast("array<int>").alias("prefix"), "rest")
    found = [ranked.select(F.array("rank").alias("set"), "n")]
    while max_size is None or len(found) < max_size:
        step = F.posexplode("rest").alias("at", "next")
        longer = projected.select("prefix", "rest", step).select(
            F.concat("prefix", F.array("next")).alias("prefix"),
            F.slice("rest", F.col("at") + 2, F.greatest(F.size("rest") - F.col("at") - 1, F.lit(0))).alias("rest"),
        )
        # A column that is only tested for its size would be made again for each use.
        grown = materialize(longer.where(F.size("rest") > 0), "projected")
        extended = grown.select("prefix", F.explode("rest").alias("next")).groupBy("prefix", "next").agg(
            F.count("*").alias("n")
        )
        frequent = materialize(extended.where(F.col("n") >= least), "frequent")
        if frequent.isEmpty():
            break
        found.append(frequent.select(F.concat("prefix", F.array("next")).alias("set"), "n"))
        allowed = frequent.groupBy("prefix").agg(F.collect_set("next").alias("allowed"))
        projected = grown.join(allowed, "prefix").select("prefix", F.array_intersect("rest", "allowed").alias("rest"))
    sets = found[0]
    for more in found[1:]:
        sets = sets.unionByName(more)
    numbered = sets.withColumn("id", F.to_json("set"))
    words = numbered.select("id", "n", F.explode("set").alias("rank")).join(ranked.select("rank", "item"), "rank")
    named = words.groupBy("id", "n").agg(F.sort_array(F.collect_list("item")).alias("words"))
    return named.select("words", F.size("words").alias("size"), "n")


def frequent_word_sets(
    df: DataFrame, row: str, col: str, stop: list[str], min_share: float, max_size: int | None = None
) -> DataFrame:
    """:func:`frequent_sets` of a text column's tokens."""
    return frequent_sets(title_tokens(df, col, stop, [row]), row, "token", min_share, max_size)


def compare_counts(first: DataFrame, second: DataFrame, prior: float = 1000.0) -> DataFrame:
    """Words of two corpora, each given as (token, count), by how much their shares differ.

    (token, n_first, n_second, share_first, share_second, log_odds, variance, z): the log of the ratio of the odds, with
    ``prior`` words spread as in both corpora together added to each, so that rare words and words of one side only have
    a finite value; its variance; and the value over its deviation. Corpora without words have NULL shares.
    """
    if prior <= 0:
        raise ValueError("prior must be positive")
    both = first.select("token", F.col("count").alias("n_first")).join(
        second.select("token", F.col("count").alias("n_second")), "token", "full_outer"
    )
    counts = materialize(both.na.fill(0, ["n_first", "n_second"]), "compared")
    all_first, all_second = (counts.agg(F.sum(c).cast("double")).scalar() for c in ("n_first", "n_second"))
    known = counts.withColumns({"all_first": all_first, "all_second": all_second})
    expected = F.lit(float(prior)) * (F.col("n_first") + F.col("n_second")) / (F.col("all_first") + F.col("all_second"))
    known = known.withColumn("expected", expected)

    def odds(side: str):
        has = F.col(f"n_{side}") + F.col("expected")
        return has / (F.col(f"all_{side}") + F.lit(float(prior)) - has)

    # Where there is one word only, its odds have no finite value.
    log_odds = F.when(F.col("expected") < F.lit(float(prior)), F.ln(odds("first") / odds("second"))).otherwise(F.lit(0e0))
    variance = 1 / (F.col("n_first") + F.col("expected")) + 1 / (F.col("n_second") + F.col("expected"))
    return known.select(
        "token",
        "n_first",
        "n_second",
        (F.col("n_first") / F.nullif("all_first", F.lit(0e0))).alias("share_first"),
        (F.col("n_second") / F.nullif("all_second", F.lit(0e0))).alias("share_second"),
        log_odds.alias("log_odds"),
        variance.alias("variance"),
    ).withColumn("z", F.col("log_odds") / F.sqrt("variance"))
