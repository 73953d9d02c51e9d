"""Column-expression builders for text (B1 tokeniser, B16 length profile, B17 rationale checks).

Everything here returns a ``Column`` evaluated JVM-side inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference tokeniser's behaviour:
#   1. split lower->upper camel case:            ([a-z])([A-Z])       -> "$1 $2"
#   2. split an abbreviation before a Word:      ([A-Z]+)([A-Z][a-z]) -> "$1 $2"
#   3. underscores / hyphens are separators:     [_\-]+               -> " "
#   4. words are runs of Unicode letters / digits / underscore, lower-cased.
CAMEL = r"([a-z])([A-Z])"
ABBR = r"([A-Z]+)([A-Z][a-z])"
SEPARATORS = r"[_\-]+"
WORD = r"[\p{L}\p{N}_]+"


def tokenize(col: Column | str) -> Column:
    """B1: identifier / phrase -> ``ARRAY<STRING>`` of lower-case tokens (order and repeats kept)."""
    s = F.col(col) if isinstance(col, str) else col
    s = F.regexp_replace(s, CAMEL, "$1 $2")
    s = F.regexp_replace(s, ABBR, "$1 $2")
    s = F.regexp_replace(s, SEPARATORS, " ")
    return F.regexp_extract_all(F.lower(s), F.lit(WORD), 0)


def tokenize_sql(expr: str) -> str:
    """DuckDB twin of :func:`tokenize` (used by the oracles)."""
    s = f"regexp_replace({expr}, '{CAMEL}', '\\1 \\2', 'g')"
    s = f"regexp_replace({s}, '{ABBR}', '\\1 \\2', 'g')"
    s = f"regexp_replace({s}, '{SEPARATORS}', ' ', 'g')"
    return f"regexp_extract_all(lower({s}), '{WORD}')"


def word_count(col: Column | str) -> Column:
    """Whitespace word count of the trimmed text (0 for empty / NULL)."""
    s = F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"^\s+|\s+$", "")
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(s, r"\s+")))


# Stop-words ignored by the keyword column expansion (as in the reference).
STOPWORDS = (
    # English filler
    "the", "a", "an", "of", "and", "or", "in", "on", "at", "to", "for",
    "is", "are", "was", "were", "be", "been", "being", "has", "have", "had",
    "do", "does", "did", "with", "from", "by", "into", "onto", "as",
    "me", "us", "you", "i", "we", "they", "it", "them", "their", "our",
    # Query-y words
    "show", "list", "find", "get", "give", "tell", "display", "return",
    "what", "when", "where", "who", "which", "why", "how", "whose",
    "many", "much", "some", "any", "no", "not", "all", "each", "every",
    "count", "sum", "avg", "min", "max", "group", "order", "sort",
    "that", "this", "these", "those", "there", "than", "then", "over",
    "most", "least", "top", "bottom", "first", "last", "next", "previous",
    "one", "two", "three", "between", "including", "only", "also",
)
MIN_TOKEN_LEN = 3


def meaningful_tokens(col: Column | str) -> Column:
    """Distinct tokens of length >= 3 that are not stop-words."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.array_distinct(F.filter(tokenize(col), lambda t: (F.length(t) >= MIN_TOKEN_LEN)
                                     & ~F.array_contains(stop, t)))


def stopwords_sql() -> str:
    return "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"
