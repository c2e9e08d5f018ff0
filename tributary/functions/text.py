"""String functions as column expressions. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strings that stand for null, by what reads them. Fixed values.
NULL_TOKENS = ("", "nan", "none", "null", "<na>", "n/a")
ID_NULL_TOKENS = ("", "nan", "none", "null")
#: Strings that a reader of tab- or comma-separated files takes for null. Fixed values.
READER_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: ASCII punctuation for text statistics.
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""


def is_null_text(column: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Null, or one of the tokens whatever its case and outer spaces."""
    return F.coalesce(F.lower(F.trim(column)).isin(*tokens), F.lit(True))


def null_to(column: Column, tokens: tuple[str, ...] = NULL_TOKENS, default: str | None = None) -> Column:
    return F.when(is_null_text(column, tokens), F.lit(default)).otherwise(F.trim(column))


def tokens(column: Column) -> Column:
    """Parts between white space, none of them empty."""
    return F.filter(F.split(F.coalesce(column, F.lit("")), r"\s+"), lambda w: w != "")


def char_ngrams(column: Column, n: int = 3, whole_if_short: bool = False) -> Column:
    """All substrings of n characters in order; a shorter text has none, or itself alone."""
    text = F.coalesce(column, F.lit(""))
    size = F.length(text)
    short = F.when((size > 0) & F.lit(whole_if_short), F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.when(size >= n, F.transform(F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1))), lambda k: F.substring(text, k, F.lit(n)))).otherwise(short)


def strip_punctuation(column: Column) -> Column:
    """Everything but word characters and white space becomes a space."""
    return F.regexp_replace(column, r"[^\w\s]", " ")


def soundex(column: Column) -> Column:
    """First letter and three digits; any uncoded letter, H and W among them, ends a run of equal digits."""
    letters = F.regexp_replace(F.upper(F.coalesce(column, F.lit(""))), "[^A-Z]", "")
    digits = F.translate(letters, "BFPVCGJKQSXZDTLMNRAEIOUYHW", "11112222222233455600000000")
    rest = F.regexp_replace(F.substring(F.regexp_replace(digits, r"(\d)\1+", "$1"), 2, 1 << 20), "0", "")
    return F.when(letters == "", F.lit("")).otherwise(F.concat(F.substring(letters, 1, 1), F.substring(F.rpad(rest, 3, "0"), 1, 3)))


def jaccard(a: Column, b: Column) -> Column:
    """Of the sets of two arrays; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.when(a == b, F.lit(1.0)).otherwise(both / F.size(F.array_union(a, b)))).otherwise(F.lit(0.0))


def dice(a: Column, b: Column) -> Column:
    sizes = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.when(a == b, F.lit(1.0)).otherwise(F.lit(2.0) * F.size(F.array_intersect(a, b)) / sizes)).otherwise(F.lit(0.0))


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), F.when(a == b, F.lit(1.0)).otherwise(F.lit(1.0) - F.levenshtein(a, b) / longest)).otherwise(F.lit(0.0))


def ternary_match(a: Column, b: Column) -> Column:
    """1 for equal numerals, -1 for different ones, 0 if either is missing. 15.0 is 15."""

    def plain(x: Column) -> Column:
        return F.regexp_replace(F.lower(F.trim(x.cast("string"))), r"^(\d+)\.0$", "$1")

    missing = is_null_text(a.cast("string")) | is_null_text(b.cast("string"))
    return F.when(missing, F.lit(0.0)).when(plain(a) == plain(b), F.lit(1.0)).otherwise(F.lit(-1.0))


def safe_float(column: Column, default: float = 0.0) -> Column:
    """The number a value holds; the default for null, NaN and what is no number."""
    return F.coalesce(F.nanvl(column.cast("string").try_cast("double"), F.lit(default)), F.lit(default))


def join_list(column: Column, separator: str = ",") -> Column:
    return F.concat_ws(separator, column)


def split_list(column: Column, separator: str = ",") -> Column:
    """Trimmed distinct parts in their order, without empty ones."""
    parts = F.transform(F.split(F.coalesce(column, F.lit("")), f"\\Q{separator}\\E"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


#: Entities decoded without leaving the JVM; the kernel module decodes the full table.
BASIC_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescape_basic(column: Column) -> Column:
    for name, char in BASIC_ENTITIES:
        column = F.replace(column, F.lit(name), F.lit(char))
    return column


def clean_text(column: Column, lower: bool = True, strip_html: bool = True, clean_whitespace: bool = True, unescape=unescape_basic) -> Column:
    """Entities first, then tags, case and white space; null is empty."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    if strip_html:
        text = F.regexp_replace(unescape(text), "<[^>]+>", " ")
    if lower:
        text = F.lower(text)
    if clean_whitespace:
        text = F.trim(F.regexp_replace(text, r"[\s ]+", " "))
    return text


def text_statistics(column: Column, prefix: str = "txt") -> list[Column]:
    """Length, words, mean word length, shares of upper case and digits, and punctuation marks."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    size, words = F.length(text), F.size(tokens(text))
    return [
        size.cast("bigint").alias(f"{prefix}_char_len"),
        words.cast("bigint").alias(f"{prefix}_word_cnt"),
        (size / (words + F.lit(1e-5))).alias(f"{prefix}_mean_word_len"),
        (F.regexp_count(text, F.lit(r"\p{Lu}")) / (size + F.lit(1e-5))).alias(f"{prefix}_upper_ratio"),
        (F.regexp_count(text, F.lit(r"\p{Nd}")) / (size + F.lit(1e-5))).alias(f"{prefix}_digit_ratio"),
        F.regexp_count(text, F.lit(PUNCTUATION)).cast("bigint").alias(f"{prefix}_punc_cnt"),
    ]


def pair_text(name: Column, address: Column, country: Column) -> Column:
    """One record as text for a pair scorer."""
    parts = [F.concat(F.lit(f"{label}: "), null_to(c, ("", "none", "nan", "null", "<na>"), "")) for label, c in (("name", name), ("addr", address), ("country", country))]
    return F.concat_ws(" | ", *parts)


def concat_text(*columns: Column, separator: str = " | ") -> Column:
    return F.concat_ws(separator, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
