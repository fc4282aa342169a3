"""Tokenizers and stop words."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The usual English stop words of word clouds.
BASE_STOPWORDS = """
a about above after again against all also am an and any are aren't as at
be because been before being below between both but by
can can't cannot com could couldn't
did didn't do does doesn't doing don't down during
each else ever
few for from further
get
had hadn't has hasn't have haven't having he he'd he'll he's hence her here here's hers herself him himself his
how how's however http
i i'd i'll i'm i've if in into is isn't it it's its itself
just
k
let's like
me more most mustn't my myself
no nor not
of off on once only or other otherwise ought our ours ourselves out over own
r
same shall shan't she she'd she'll she's should shouldn't since so some such
than that that's the their theirs them themselves then there there's therefore these they they'd they'll they're
they've this those through to too
under until up
very
was wasn't we we'd we'll we're we've were weren't what what's when when's where where's which while who who's
whom why why's with won't would wouldn't www
you you'd you'll you're you've your yours yourself yourselves
""".split()

# Words added for news titles.
NEWS_STOPWORDS = ["news", "said", "say", "new", "one", "just", "will", "us", "mr", "mrs", "ms", "also"]

# Java's \w is ASCII only; these classes follow Unicode.
_BETWEEN = r"[^\p{L}\p{N}_']+"
_LETTERS = r"^\p{L}+$"


def stopwords(base: Iterable[str] = BASE_STOPWORDS, extra: Iterable[str] = ()) -> list[str]:
    """Union of two word lists, lower case."""
    return sorted({word.lower() for word in [*base, *extra]})


def tokenize(text: Column) -> Column:
    """Array of the candidate title tokens: what lies between runs of anything but word characters and apostrophes.
    Filter them with :func:`is_title_token` after the explode."""
    return F.split(F.lower(text), _BETWEEN)


def strip_quotes(token: Column) -> Column:
    return F.btrim(token, F.lit("'"))


def is_title_token(token: Column, stop: list[str]) -> Column:
    return (F.length(token) > 2) & token.rlike(_LETTERS) & ~token.isin(stop)


def raw_words(text: Column, min_word_length: int = 0) -> Column:
    """All words of a text in order, without numbers; a possessive ``'s`` is still on.

    A word starts with a letter, digit or underscore and may hold apostrophes; shorter ones than ``min_word_length``
    are left out. The first branch of the pattern swallows numbers, which leaves an empty group.
    """
    start, rest = r"[\p{L}\p{N}_]", r"[\p{L}\p{N}_']"
    number = rf"\p{{Nd}}+(?:'[sS])?(?!{rest})"
    word = rf"{start}{rest}{{{max(0, min_word_length - 1)},}}"
    return F.array_remove(F.regexp_extract_all(text, F.lit(f"{number}|({word})"), F.lit(1)), "")


def cut_possessive(word: Column) -> Column:
    return F.when(F.lower(word).endswith("'s"), F.substring(word, F.lit(1), F.length(word) - 2)).otherwise(word)


def is_stop(raw: Column, stop: list[str]) -> Column:
    """Whether a raw word is a stop word once its possessive is cut."""
    plain = [word for word in stop if not word.endswith("'s")]
    return F.lower(raw).isin([*plain, *(word + "'s" for word in stop)])


def stem(lower: Column) -> Column:
    """A simple plural and its singular share a stem: one ``s`` is cut, ``ss`` is left alone."""
    return F.when(is_plural(lower), F.substring(lower, F.lit(1), F.length(lower) - 1)).otherwise(lower)


def is_plural(lower: Column) -> Column:
    return lower.endswith("s") & ~lower.endswith("ss")
