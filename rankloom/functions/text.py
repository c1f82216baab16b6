"""Text to terms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Words of at least two letters, digits or underscores in any script.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# The English stop words of Spark's own StopWordsRemover, without those the
# token pattern can never produce (single letters and words with an apostrophe).
STOP_WORDS = (
    "me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did doing "
    "an the and but if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some "
    "such no nor not only own same so than too very can will just don should now cannot could "
    "ought would"
).split()


def item_text(title: Column, genres: Column) -> Column:
    return F.trim(F.concat_ws(" ", title, F.replace(genres, F.lit("|"), F.lit(" "))))


def tokens(text: Column, stop_words: list[str] | None = None) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN_PATTERN})"), F.lit(1))
    stop = STOP_WORDS if stop_words is None else stop_words
    return F.filter(words, lambda w: ~w.isin(*stop)) if stop else words


def terms(words: Column) -> Column:
    """The words, then every pair of neighbours."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.concat(
        words,
        F.zip_with(F.slice(words, 1, pairs), F.slice(words, 2, pairs), lambda a, b: F.concat(a, F.lit(" "), b)),
    )
