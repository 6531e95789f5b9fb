"""Tokens and stop words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A token is a run of letters, digits and underscores of any script.
TOKEN = r"[\p{L}\p{N}_]+"

# The common English stop-word list used by full-text search.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom this "
    "that these those am is are was were be been being have has had having do does did doing a an "
    "the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now"
).split()


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def tokens_of(df: DataFrame, text: str) -> Column:
    """Tokens of a row: its column ``tokens``, where texts were cut into tokens before, else those of its text."""
    return F.coalesce("tokens", F.array().cast("array<string>")) if "tokens" in df.columns else tokens(F.col(text))


def terms(text: Column, drop_stop_words: bool = True) -> Column:
    """Distinct lower-case tokens, stop words removed."""
    found = F.array_distinct(tokens(text))
    if not drop_stop_words:
        return found
    return F.array_except(found, F.array(*[F.lit(w) for w in STOP_WORDS]))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct tokens of two token arrays."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return both / F.nullif(F.size(F.array_union(a, b)).cast("double"), F.lit(0.0))
