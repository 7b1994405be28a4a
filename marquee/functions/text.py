"""Text features (S-6 ... S-9): combined item text, tokens, stop words, n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Token rule of the reference's vectoriser: lower-cased runs of two or more
# word characters.  Written with Unicode classes because ``\w`` is ASCII-only
# in Java regular expressions.
TOKEN_PATTERN = r"([\p{L}\p{N}_]{2,})"
TOKEN_PATTERN_SQL = r"[\p{L}\p{N}_]{2,}"

# Spark's default English stop-word list
# (pyspark.ml.feature.StopWordsRemover.loadDefaultStopWords("english")),
# kept here verbatim so the SQL oracle can inline the same list.
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's",
    "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't",
    "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't",
    "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could",
    "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
]

FEATURE_COLUMNS = ("genres_str", "keywords_str", "director", "cast_str", "overview")


def combined_text(df: DataFrame) -> Column:
    """S-6: genres, keywords, director, cast and overview joined by one blank.

    Columns missing from ``df`` are skipped (driver-side schema check), nulls
    are skipped by ``concat_ws`` and ``''`` is kept, as in the reference.
    The overview is always whole.
    """
    parts = []
    for name in FEATURE_COLUMNS:
        if name not in df.columns:
            continue
        parts.append(F.col(name).cast("string"))
    if not parts:
        return F.lit("")
    return F.concat_ws(" ", *parts)


def tokens(c) -> Column:
    """S-7: lower-case word tokens of two or more characters."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN_PATTERN), 1)


def drop_stop_words(c, stop_words: list[str] | None = None) -> Column:
    """S-8: remove stop words, keeping order and repeats.

    The list is a literal array; membership is tested with ``array_contains``,
    which Catalyst evaluates in generated code.
    """
    c = F.col(c) if isinstance(c, str) else c
    sw = F.array(*[F.lit(w) for w in (stop_words if stop_words is not None else ENGLISH_STOP_WORDS)])
    return F.filter(c, lambda t: ~F.array_contains(sw, t))


def with_bigrams(c) -> Column:
    """S-9: unigrams followed by adjacent pairs joined by a blank.

    ``c`` must be a column reference (an already materialised array): it is
    read several times, and an unmaterialised expression would be re-evaluated
    for each read.
    """
    c = F.col(c) if isinstance(c, str) else c
    n = F.size(c)
    bigrams = F.when(
        n >= 2,
        F.zip_with(F.slice(c, 1, n - 1), F.slice(c, 2, n - 1),
                   lambda a, b: F.concat(a, F.lit(" "), b)),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(c, bigrams)


def unigrams(c, stop_words: list[str] | None = None, remove_stop: bool = True) -> Column:
    """Tokens with stop words removed (a single-pass expression)."""
    t = tokens(c)
    return drop_stop_words(t, stop_words) if remove_stop else t


def with_terms(df: DataFrame, text, out_col: str = "terms", ngram_max: int = 1,
               stop_words: list[str] | None = None, remove_stop: bool = True) -> DataFrame:
    """Token pipeline used by every vectoriser: tokens → stop words → n-grams.

    The unigram array is materialised as its own column before the bigrams
    are formed from it, so the regular expression runs once per text.
    """
    out = df.withColumn(out_col, tokens(text))
    if remove_stop:
        from pyspark.ml.feature import StopWordsRemover
        # Hash-set lookup in the JVM; exact match (tokens are already lower-case).
        rm = StopWordsRemover(inputCol=out_col, outputCol=out_col + "__kept", caseSensitive=True,
                              stopWords=list(stop_words if stop_words is not None else ENGLISH_STOP_WORDS))
        out = rm.transform(out).drop(out_col).withColumnRenamed(out_col + "__kept", out_col)
    if ngram_max >= 2:
        out = out.withColumn(out_col, with_bigrams(out_col))
    return out
