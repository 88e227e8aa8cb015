"""Column expressions for product-name standardisation and text handling.

Every function takes and returns ``pyspark.sql.Column`` and is built from
Spark SQL built-ins only, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the matched behaviour for equal results.
# Colour words removed from names and compared between matched products:
COLOR_NAMES = ["red", "green", "blue", "yellow", "orange", "purple", "pink",
               "brown", "black", "white", "gray", "silver"]
# Measure units (number, optional fraction, optional space, unit):
MEASURE_RE = r"(?iU)\b\d+(\.\d+)?\s*(mL|mm)\b"
MEASURE_UNIT_RE = r"(?iU)\s*(mL|mm)$"
# Right-side name written for a left row without an accepted match:
NO_MATCH_NAME = "No good match found (Low match score)"
# Agreement labels of an accepted match (colours, then measures):
AGREE_BOTH = "Colors and mL/mm Match"
AGREE_COLORS_ONLY = "Colors Match, mL/mm Mismatch"
AGREE_NONE = "Colors Mismatch"
# Encoder input limit in sub-word tokens, two of them special:
ENCODER_MAX_TOKENS = 128
# English stop words (the common NLTK list, 179 words):
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "you're", "you've", "you'll", "you'd", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "she's", "her",
    "hers", "herself", "it", "it's", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "that'll", "these", "those", "am", "is", "are", "was", "were",
    "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there",
    "when", "where", "why", "how", "all", "any", "both", "each", "few",
    "more", "most", "other", "some", "such", "no", "nor", "not", "only",
    "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "don't", "should", "should've", "now", "d", "ll", "m",
    "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn",
    "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn",
    "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won",
    "won't", "wouldn", "wouldn't",
]
# ---------------------------------------------------------------------------

# Java regex forms.  (?U) makes \b, \d and \w Unicode-aware like Python's
# str patterns; (?i) ignores case.
COLOR_RE = r"(?iU)\b(?:" + "|".join(COLOR_NAMES) + r")\b"
COLOR_GROUP_RE = r"(?iU)\b(" + "|".join(COLOR_NAMES) + r")\b"
NUM_RE = r"(?U)\b\d+\b"
# Split on runs of characters that are neither letters, digits nor '_':
# equals Python's re.split(r'\W+') on str, and runs the same in DuckDB.
WORD_SPLIT = r"[^\p{L}\p{N}_]+"
# Word-level tokeniser after the Treebank rules: quotes become `` and '',
# contractions split off ("n't", "'s"), an ellipsis, a number with inner
# points or commas and a hyphenated word are one token each, other
# punctuation marks are tokens of their own.
TOKEN_RE = (r"``|''|\.\.\.|n't|'\p{L}+|\p{N}+(?:[.,]\p{N}+)+"
            r"|[\p{L}\p{N}_]+(?:-[\p{L}\p{N}_]+)*|[^\s\p{L}\p{N}_]")
EDGE_SPACE_RE = r"^\s+|\s+$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_to_empty(x) -> Column:
    """X11: a missing text is the empty string."""
    return F.coalesce(_c(x), F.lit(""))


def remove_colors(x) -> Column:
    """Delete whole-word colour names, any case."""
    return F.regexp_replace(_c(x), COLOR_RE, "")


def remove_measures(x) -> Column:
    """Delete ``number[.fraction][space]mL|mm``, any case."""
    return F.regexp_replace(_c(x), MEASURE_RE, "")


def remove_numbers(x) -> Column:
    """Delete whole-word integers."""
    return F.regexp_replace(_c(x), NUM_RE, "")


def strip_text(x) -> Column:
    """Strip surrounding whitespace (any Unicode-agnostic \\s)."""
    return F.regexp_replace(_c(x), EDGE_SPACE_RE, "")


def clean_name(x) -> Column:
    """X1..X4 in their fixed order: colours, then measures, then numbers."""
    return strip_text(remove_numbers(remove_measures(remove_colors(null_to_empty(x)))))


def word_set(x) -> Column:
    """X5 + F6 + A4: distinct non-empty words, case kept, as an array."""
    return F.array_distinct(F.filter(F.split(_c(x), WORD_SPLIT), lambda w: w != ""))


def name_words(x, fold_case: bool = False) -> Column:
    """Word set of a product name after cleaning."""
    c = clean_name(x)
    if fold_case:
        c = F.lower(c)
    return word_set(c)


def set_key(words) -> Column:
    """Canonical text of a word set: sorted words joined by a space.

    Words never contain a space, so equal keys mean equal sets.
    """
    return F.array_join(F.array_sort(_c(words)), " ")


def color_set(x) -> Column:
    """Colour names present in the (uncleaned) name, lower-cased, sorted."""
    found = F.regexp_extract_all(null_to_empty(x), F.lit(COLOR_GROUP_RE), 1)
    return F.array_sort(F.array_distinct(F.transform(found, lambda c: F.lower(c))))


def measure_set(x, mode: str = "as_written") -> Column:
    """Measures of a name as a sorted set of ``fraction|unit`` strings.

    ``as_written`` keeps only the fraction and the unit's case, like the
    matched behaviour (so 250 mL equals 500 mL).  ``value`` compares the
    whole number and a lower-cased unit.
    """
    s = null_to_empty(x)
    if mode == "as_written":
        first = F.regexp_extract_all(s, F.lit(MEASURE_RE), 1)
    elif mode == "value":
        first = F.transform(F.regexp_extract_all(s, F.lit(MEASURE_RE), 0),
                            lambda m: F.regexp_replace(m, MEASURE_UNIT_RE, ""))
    else:
        raise ValueError(f"unknown measure mode: {mode}")
    unit = F.regexp_extract_all(s, F.lit(MEASURE_RE), 2)
    if mode == "value":
        unit = F.transform(unit, lambda u: F.lower(u))
    pairs = F.zip_with(first, unit, lambda a, b: F.concat(a, F.lit("|"), b))
    return F.array_sort(F.array_distinct(pairs))


def agreement(colors_l, colors_r, measures_l, measures_r) -> Column:
    """P5: three-way agreement label of an accepted match."""
    ceq = _c(colors_l) == _c(colors_r)
    meq = _c(measures_l) == _c(measures_r)
    return (F.when(ceq & meq, F.lit(AGREE_BOTH))
            .when(ceq, F.lit(AGREE_COLORS_ONLY))
            .otherwise(F.lit(AGREE_NONE)))


def tokenize(x) -> Column:
    """Lower-case, split quotes, contractions and punctuation into tokens."""
    return split_tokens(F.lower(null_to_empty(x)), TOKEN_RE)


def split_tokens(s: Column, token_re: str) -> Column:
    """Tokens of a lower-cased text by a pattern, quotes and contractions split before."""
    s = F.regexp_replace(s, "n't", " n't")
    s = F.regexp_replace(s, r"(?U)\bcannot\b", "can not")
    s = F.regexp_replace(s, r'(^|[\s(\[{<])"', "$1 `` ")
    s = F.replace(s, F.lit('"'), F.lit(" '' "))
    return F.regexp_extract_all(s, F.lit(token_re), 0)


def remove_stop_words(tokens, stop_words=None) -> Column:
    """drop stop words, keeping order and duplicates."""
    stop = ENGLISH_STOP_WORDS if stop_words is None else list(stop_words)
    if not stop:
        return _c(tokens)
    # a long IN list is planned as a hash-set lookup (InSet), not a scan
    return F.filter(_c(tokens), lambda t: ~t.isin(*stop))


def stop_filtered_text(x, stop_words=None) -> Column:
    """X9 + F7 + X10: the sentence handed to an encoder."""
    return F.array_join(remove_stop_words(tokenize(x), stop_words), " ")


def truncate_tokens(tokens, limit: int = ENCODER_MAX_TOKENS - 2) -> Column:
    """Keep the first ``limit`` tokens (room left for two specials)."""
    return F.slice(_c(tokens), 1, limit)


def text_after(x, delimiter: str) -> Column:
    """Text after the first delimiter, or the whole text if absent."""
    return F.element_at(F.split(_c(x), _quote(delimiter), 2), -1)


def strip_parens(x) -> Column:
    """Remove every '(' and ')'."""
    return F.translate(_c(x), "()", "")


def parse_score_text(x) -> Column:
    """First ``digits.digits`` run of a printed score, as a double."""
    return F.regexp_extract(_c(x), r"\d*\.\d*", 0).cast("double")


def threshold_label(k, scale: int = 100) -> Column:
    """Two-decimal threshold label of grid value ``k``/``scale``."""
    return F.format_string("%.2f", _c(k).cast("double") / F.lit(float(scale)))


def _quote(s: str) -> str:
    import re
    return re.escape(s)
