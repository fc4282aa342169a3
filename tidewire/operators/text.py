"""Token, word and bigram statistics. Texts are never joined: tokens are exploded per row and counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import words as W
from ..functions.once import once
from ..session import materialize
from .filters import restrict_to
from .views import top_n


def title_tokens(df: DataFrame, col: str, stop: list[str], keep: list[str]) -> DataFrame:
    """One row per token, with the columns in ``keep``. NULL texts give none."""
    raw = df.select(*keep, F.explode(W.tokenize(F.col(col))).alias("_raw"))
    return raw.select(*keep, W.strip_quotes(F.col("_raw")).alias("token")).where(
        W.is_title_token(F.col("token"), stop)
    )


def token_counts(df: DataFrame, col: str, stop: list[str], by: list[str] = ()) -> DataFrame:
    """(by..., token, count). Counts raw tokens first, so that each distinct one is cleaned and tested once.

    A filter on a grouping key would move below the grouping and run on every token; ``once`` keeps it above.
    """
    raw = df.select(*by, F.explode(W.tokenize(F.col(col))).alias("_raw"))
    counts = raw.groupBy(*by, "_raw").agg(F.count("*").alias("n"))
    tokens = counts.select(*by, once(W.strip_quotes(F.col("_raw"))).alias("token"), "n")
    return tokens.where(W.is_title_token(F.col("token"), stop)).groupBy(*by, "token").agg(F.sum("n").alias("count"))


def top_tokens(df: DataFrame, col: str, stop: list[str], n: int = 15) -> DataFrame:
    return token_counts(df, col, stop).orderBy(F.col("count").desc(), "token").limit(n)


def source_tokens(df: DataFrame, stop: list[str], n_sources: int = 20) -> DataFrame:
    """Counts of (token, source) for the titles from the most frequent sources; all later steps start here."""
    sources = top_n(df, "source_name", n_sources, drop_null_keys=True)
    return token_counts(restrict_to(df, sources, "source_name"), "title", stop, ["source_name"])


def ranked_tokens(pair_counts: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` most frequent tokens with their rank (ties: smaller token first)."""
    top = (
        pair_counts.groupBy("token")
        .agg(F.sum("count").alias("total"))
        .orderBy(F.col("total").desc(), "token")
        .limit(n)
    )
    rank = F.row_number().over(Window.orderBy(F.col("total").desc(), "token"))
    return top.withColumn("kw_rank", rank)


def keyword_source_long(
    df: DataFrame, stop: list[str], n_sources: int = 20, n_keywords: int = 15, pairs: DataFrame | None = None
) -> DataFrame:
    pairs = pairs if pairs is not None else materialize(source_tokens(df, stop, n_sources), "pairs")
    return restrict_to(pairs, ranked_tokens(pairs, n_keywords), "token")


def keyword_source_matrix(
    df: DataFrame, stop: list[str], n_sources: int = 20, n_keywords: int = 15, values: list[str] | None = None
) -> DataFrame:
    """Keywords by sources, 0 where a pair is missing, rows by keyword frequency.

    The counts per token and source are gathered per token, at most ``n_sources`` entries each; the top tokens then
    carry their whole row of the matrix with them.
    """
    entry = F.struct("source_name", "count")
    gathered = source_tokens(df, stop, n_sources).groupBy("token").agg(
        F.sum("count").alias("total"), F.collect_list(entry).alias("entries")
    )
    top = materialize(gathered.orderBy(F.col("total").desc(), "token").limit(n_keywords), "keywords")
    ranked = top.withColumn("kw_rank", F.row_number().over(Window.orderBy(F.col("total").desc(), "token")))
    long = ranked.select("token", "kw_rank", F.inline("entries").alias("source_name", "count"))
    matrix = long.groupBy("token", "kw_rank").pivot("source_name", values).agg(F.sum("count"))
    cells = [c for c in matrix.columns if c not in ("token", "kw_rank")]
    return (matrix.na.fill(0, cells) if cells else matrix).select("token", *cells, "kw_rank").orderBy("kw_rank")


def fold_forms(counts: DataFrame) -> DataFrame:
    """(word, n) to (stem, term, n): adds up letter case and, where the singular occurs, simple plurals.

    ``term`` is the most frequent spelling (ties: the smallest). Works on the vocabulary, not on the tokens: one row
    per spelling, then one group per word that holds its spellings.
    """
    return _folded(counts.groupBy("word").agg(F.sum("n").alias("n")))


def _folded(spellings: DataFrame) -> DataFrame:
    """:func:`fold_forms` of counts with one row per spelling."""
    lower = F.lower("word")
    # Dealt out by stem, a word travels once and not beside its stem.
    forms = spellings.repartition(W.stem(lower)).select(
        W.stem(lower).alias("stem"), F.struct("word", "n", W.is_plural(lower).alias("plural")).alias("form")
    )
    words = forms.groupBy("stem").agg(F.collect_list("form").alias("forms"), F.min("form.plural").alias("only_plural"))
    cut = lambda f: F.when(
        f["plural"] & ~F.col("only_plural"), F.substring(f["word"], F.lit(1), F.length(f["word"]) - 1)
    ).otherwise(f["word"])
    spelled = F.transform("forms", lambda f: F.struct(cut(f).alias("form"), f["n"].alias("n")))
    # A spelling may come from the singular and from a plural that was cut.
    total = lambda form: F.aggregate(
        F.filter("spelled", lambda s: s["form"] == form), F.lit(0).cast("long"), lambda sum_, s: sum_ + s["n"]
    )
    ranked = F.transform("spelled", lambda s: F.struct((-total(s["form"])).alias("rank"), s["form"].alias("form")))
    every = F.aggregate("spelled", F.lit(0).cast("long"), lambda sum_, s: sum_ + s["n"])
    return words.select("stem", spelled.alias("spelled")).select(
        "stem", F.array_min(ranked)["form"].alias("term"), every.alias("n")
    )


def word_counts(df: DataFrame, col: str, stop: list[str], min_word_length: int = 0) -> DataFrame:
    """(word, n) of all words that are neither stop words nor numbers, as spelled; a word may come in two rows."""
    raw = df.select(F.explode(W.raw_words(F.col(col), min_word_length)).alias("raw"))
    counts = raw.groupBy("raw").agg(F.count("*").alias("n"))
    words = counts.select(once(W.cut_possessive(F.col("raw"))).alias("word"), "n")
    return words.where(~F.lower("word").isin(stop))


def adjacent_pairs(df: DataFrame, col: str, stop: list[str], min_word_length: int = 0) -> DataFrame:
    """(w1, w2, n): every non-stop word with its successor, NULL if that is a stop word or the text ends.

    Pairs of raw words are formed inside a row, so there is no shuffle by document. They are tested and cleaned once
    they are rows, in compiled code; functions on array elements would be interpreted. The sum over w2 gives the word
    counts, so one pass over the texts serves both.
    """
    texts = df.where(F.col(col).isNotNull()).select(once(W.raw_words(F.col(col), min_word_length)).alias("t"))
    following = F.slice("t", F.lit(2), F.greatest(F.size("t") - 1, F.lit(0)))
    raw = texts.select(F.inline(F.arrays_zip(F.col("t").alias("r1"), following.alias("r2"))).alias("r1", "r2"))
    pairs = raw.where(~W.is_stop(F.col("r1"), stop)).select(
        W.cut_possessive(F.col("r1")).alias("w1"),
        F.when(~W.is_stop(F.col("r2"), stop), W.cut_possessive(F.col("r2"))).alias("w2"),
    )
    return pairs.groupBy("w1", "w2").agg(F.count("*").alias("n"))


def _log_likelihood(k: Column, n: Column, x: Column) -> Column:
    floor = F.lit(1e-10)
    return k * F.ln(F.greatest(x, floor)) + (n - k) * F.ln(F.greatest(F.lit(1e0) - x, floor))


def association(c12: Column, c1: Column, c2: Column, total: Column) -> Column:
    """Log-likelihood ratio of a word pair; 0 where a single word makes up the whole text."""
    c12, c1, c2, total = (c.cast("double") for c in (c12, c1, c2, total))
    rest = F.nullif(total - c1, F.lit(0e0))
    p, p1, p2 = c2 / total, c12 / c1, (c2 - c12) / rest
    score = (
        _log_likelihood(c12, c1, p)
        + _log_likelihood(c2 - c12, rest, p)
        - _log_likelihood(c12, c1, p1)
        - _log_likelihood(c2 - c12, rest, p2)
    )
    return F.when((total <= c1) | (total <= c2), F.lit(0e0)).otherwise(F.lit(-2e0) * score)


def _unigrams(pairs: DataFrame) -> DataFrame:
    return fold_forms(pairs.groupBy(F.col("w1").alias("word")).agg(F.sum("n").alias("n")))


def _collocations(pairs: DataFrame, unigrams: DataFrame, threshold: float) -> DataFrame:
    # The pairs are counted and words hold no blank, so there is one row per spelling.
    joined = F.concat_ws(" ", "w1", "w2")
    bigrams = _folded(pairs.where(F.col("w2").isNotNull()).select(joined.alias("word"), "n"))
    bigrams = bigrams.select(F.col("term").alias("bigram"), F.col("n").alias("c12"))
    # The key of a join is worked out where the join needs it, and does not travel beside the pair.
    part = lambda at: W.stem(F.lower(F.split_part("bigram", F.lit(" "), F.lit(at))))
    # Both sides are already counted, so one word meets at most one row per distinct neighbour; the sort-merge join
    # splits larger groups (adaptive skew join), and Spark broadcasts the vocabulary only if it is small.
    first = unigrams.select(F.col("stem").alias("s1"), F.col("term").alias("word1"), F.col("n").alias("c1"))
    second = unigrams.select(F.col("stem").alias("s2"), F.col("term").alias("word2"), F.col("n").alias("c2"))
    total = pairs.agg(F.sum("n")).scalar()
    scored = bigrams.join(first, part(1) == F.col("s1")).drop("s1").join(second, part(2) == F.col("s2")).drop("s2")
    scored = scored.withColumn("total", total)
    score = association(F.col("c12"), F.col("c1"), F.col("c2"), F.col("total"))
    return scored.select("bigram", "word1", "word2", "c12", "c1", "c2", once(score).alias("score")).where(
        F.col("score") > threshold
    )


def collocations(
    df: DataFrame, col: str, stop: list[str], threshold: float = 30, min_word_length: int = 0
) -> DataFrame:
    """Word pairs that occur together far more often than by chance, with their score.

    Counts that several branches need are written once.
    """
    pairs = materialize(adjacent_pairs(df, col, stop, min_word_length), "pairs")
    unigrams = materialize(_unigrams(pairs), "unigrams")
    return _collocations(pairs, unigrams, threshold)


def _with_collocations(pairs: DataFrame, threshold: float) -> DataFrame:
    """A strong pair becomes a term of its own, its count leaves both words, and what is used up vanishes."""
    unigrams = materialize(_unigrams(pairs), "unigrams")
    strong = materialize(_collocations(pairs, unigrams, threshold), "collocations")
    used = (
        strong.select(F.explode(F.array("word1", "word2")).alias("term"), "c12")
        .groupBy("term")
        .agg(F.sum("c12").alias("used"))
    )
    left = unigrams.join(used, "term", "left").select(
        "term", (F.col("n") - F.coalesce(F.col("used"), F.lit(0))).alias("n")
    )
    return left.where(F.col("n") > 0).unionByName(strong.select(F.col("bigram").alias("term"), F.col("c12").alias("n")))


def word_weights(top: DataFrame) -> DataFrame:
    """Count relative to the largest; ``top`` is a top-n result, so the window sees only those rows."""
    return top.withColumn("weight", F.col("count") / F.max("count").over(Window.partitionBy(F.lit(1))))


def word_frequencies(
    df: DataFrame,
    col: str,
    stop: list[str],
    max_words: int = 200,
    with_collocations: bool = False,
    threshold: float = 30,
    min_word_length: int = 0,
) -> DataFrame:
    """The most frequent terms of a text column: (term, count, weight)."""
    if with_collocations:
        pairs = materialize(adjacent_pairs(df, col, stop, min_word_length), "pairs")
        terms = _with_collocations(pairs, threshold)
    else:
        terms = fold_forms(word_counts(df, col, stop, min_word_length)).select("term", "n")
    top = terms.orderBy(F.col("n").desc(), "term").limit(max_words)
    return word_weights(top.withColumnRenamed("n", "count"))
