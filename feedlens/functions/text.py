"""Column expressions over free text (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace as Python's str.split() sees it: Java's (?U)\s plus the
# information separators \x1c-\x1f that Python also treats as whitespace.
WS_CLASS = r"(?U)[\s\x1c-\x1f]"
WS_RUN = WS_CLASS + "+"
# Word-ish token: two or more letters, digits or underscores (same class in DuckDB/RE2).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# The exploration lexicon (duplicates in the original literals
# collapse because the words are used as a set).
POSITIVE_WORDS = (
    "love", "great", "excellent", "good", "happy", "amazing", "brilliant",
    "fantastic", "perfect", "best", "wonderful", "awesome", "easy", "smooth",
    "simple", "quick", "fast", "reliable", "stable", "satisfied", "pleased",
    "impressed", "delighted", "works", "enjoy",
)
NEGATIVE_WORDS = (
    "hate", "bad", "terrible", "awful", "horrible", "worst", "poor", "problem",
    "issue", "broken", "fail", "error", "crash", "slow", "confusing", "difficult",
    "annoying", "frustrating", "useless", "waste", "don't", "doesn't", "can't",
    "cannot", "impossible", "rubbish", "trash", "pathetic", "disaster",
)
# The English stop words of Spark ML's StopWordsRemover, in its order.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they",
    "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those",
    "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at",
    "by", "for", "with", "about", "against", "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't",
    "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't",
    "can't", "couldn't", "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's",
    "when's", "where's", "who's", "why's", "would",
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def char_length(col) -> Column:
    """Length in code points (same as Python ``len``)."""
    return F.length(_c(col))


def word_count(col) -> Column:
    """Number of whitespace-separated words, Unicode-aware like ``str.split()``."""
    c = _c(col)
    parts = F.split(c, WS_RUN)
    return F.when(c.isNotNull(), F.size(F.filter(parts, lambda x: x != F.lit(""))))


def strip_ws(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(col), r"^" + WS_RUN + r"|" + WS_RUN + r"$", "")


def dedup_key(col) -> Column:
    """Key used for duplicate detection: lower-cased and stripped."""
    return F.lower(strip_ws(col))


def normalize_name(col, word_boundary: bool = False) -> Column:
    """Strip, lower-case and drop every ``'the '``.

    Default keeps the reference behaviour (the substring is removed inside words,
    too); ``word_boundary=True`` removes only the whole word.
    """
    base = F.lower(strip_ws(col))
    if word_boundary:
        return F.regexp_replace(base, r"\bthe ", "")
    return F.replace(base, F.lit("the "), F.lit(""))


def contains_count(lower_text: Column, words: Iterable[str]) -> Column:
    """How many distinct words occur as substrings of ``lower_text`` (already lower-cased)."""
    arr = F.array(*[F.lit(w) for w in dict.fromkeys(words)])
    return F.aggregate(arr, F.lit(0), lambda acc, w: acc + F.when(F.instr(lower_text, w) > 0, 1).otherwise(0))


def lexicon_counts(df, col: str, positive: Iterable[str] = POSITIVE_WORDS,
                   negative: Iterable[str] = NEGATIVE_WORDS, pos_out: str = "pos_hits", neg_out: str = "neg_hits"):
    """Add positive/negative lexicon hit counts; the text is lower-cased once in its own projection."""
    lt = df.withColumn("_lt", F.lower(_c(col)))
    return (lt.withColumn(pos_out, contains_count(F.col("_lt"), positive))
            .withColumn(neg_out, contains_count(F.col("_lt"), negative)).drop("_lt"))


def polarity(pos, neg) -> Column:
    """Larger side wins; a tie is neutral."""
    p, n = _c(pos), _c(neg)
    return F.when(p > n, "positive").when(n > p, "negative").otherwise("neutral")


def lexicon_polarity(col, positive: Iterable[str] = POSITIVE_WORDS,
                     negative: Iterable[str] = NEGATIVE_WORDS) -> Column:
    """'positive' / 'negative' / 'neutral' by counting lexicon words contained in the text (single column)."""
    lt = F.lower(_c(col))
    return polarity(contains_count(lt, positive), contains_count(lt, negative))


def tokens(col, pattern: str = TOKEN_PATTERN) -> Column:
    """Lower-cased word tokens of two or more word characters."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(pattern), 0)


def prefix(col, n: int) -> Column:
    """First ``n`` characters (error messages and previews)."""
    return F.substring(_c(col), 1, n)
