"""Names and addresses in a canonical form.

Both operators are projections: they keep every row and column and add a struct column. Null, and the strings that stand
for null, give empty texts and lists and no numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import kernels, text

#: Words that are no part of a company's name. Fixed values.
LEGAL_SUFFIXES = ("inc", "incorporated", "llc", "corp", "corporation", "ltd", "limited", "pvt", "private", "co", "company", "llp", "sa", "sarl", "sas", "eurl", "gmbh", "plc", "enterprises", "services", "anonyme", "limitee")

#: Legal forms and their short form, replaced in this order. Fixed values.
LEGAL_FORMS = (
    ("(pvt|private) (ltd|limited)", "pvt ltd"),
    ("limited liability company", "llc"),
    ("limited liability partnership", "llp"),
    ("public limited company", "plc"),
    ("societe a responsabilite limitee", "sarl"),
    ("societe par actions simplifiee", "sas"),
    ("societe anonyme", "sa"),
    ("societe civile immobiliere", "sci"),
    ("entreprise unipersonnelle a responsabilite limitee", "eurl"),
    ("incorporated", "inc"),
    ("corporation", "corp"),
    ("limited", "ltd"),
    ("private", "pvt"),
    ("company", "co"),
)

#: Mail routes without a street. The keyword must be a word of its own, or be followed by its number.
_ROUTE = r"\b(cedex|b\.?p\.?|c\.?s\.?)"
_STREET = r"\b(\d+[a-z]?)\b"


def folded(column: Column) -> Column:
    return kernels.ascii_fold(F.when(~text.is_null_text(column), F.trim(column)))


def name_columns(fold: Column, raw: Column) -> dict[str, Column]:
    """Parts of a normalised name, given the folded text."""
    words = text.tokens(text.strip_punctuation(fold))
    canonical = F.array_join(words, " ")
    for long, short in LEGAL_FORMS:
        canonical = F.regexp_replace(canonical, rf"\b{long}\b", short)
    kept = F.filter(words, lambda w: ~w.isin(*LEGAL_SUFFIXES))
    return {
        "raw": F.when(text.is_null_text(raw), F.lit("")).otherwise(F.trim(raw)),
        "canonical_name": canonical,
        "tokens": F.when(F.size(kept) > 0, kept).otherwise(words),
    }


def normalize_names(df: DataFrame, column: str = "business_name", out: str = "name", phonetic: bool = True) -> DataFrame:
    """Adds the struct raw, clean_name, canonical_name, tokens, char_3grams, metaphone_primary, metaphone_secondary.

    Each text is folded once. Phonetic codes take the first token.
    """
    kept = df.columns
    rows = df.withColumn("_fold", folded(F.col(column)))
    rows = rows.withColumns({f"_{k}": c for k, c in name_columns(F.col("_fold"), F.col(column)).items()})
    rows = rows.withColumns({"_clean": F.array_join("_tokens", " "), "_grams": text.char_ngrams(F.array_join("_tokens", ""), 3, whole_if_short=True)})
    codes = [F.lit(None).cast("string"), F.lit(None).cast("string")]
    if phonetic:
        rows = rows.withColumn("_codes", kernels.metaphone(F.coalesce(F.get("_tokens", F.lit(0)), F.lit(""))))
        codes = [F.col("_codes.primary"), F.col("_codes.secondary")]
    parts = [F.col("_raw").alias("raw"), F.col("_clean").alias("clean_name"), F.col("_canonical_name").alias("canonical_name"), F.col("_tokens").alias("tokens"), F.col("_grams").alias("char_3grams"), codes[0].alias("metaphone_primary"), codes[1].alias("metaphone_secondary")]
    return rows.select(*kept, F.struct(*parts).alias(out))


def normalize_addresses(df: DataFrame, column: str = "business_address", out: str = "address") -> DataFrame:
    """Adds the struct raw, clean_address, street_number, postal_code, tokens, cedex_flag.

    The postal code is the last number of five or six digits. The street number is the first other number, one after a
    letter and a dash only if there is no plain one. Mail routes are cut out before numbers are looked for.
    """
    kept = df.columns
    rows = df.withColumn("_fold", folded(F.col(column)))
    rows = rows.withColumn("_plain", F.regexp_replace("_fold", _ROUTE + r"(?![a-z_])\s*(?:\d{1,4}\b)?", " "))
    postal = F.regexp_extract("_plain", r"(?s)^.*\b(\d{5,6})\b", 1)
    rows = rows.withColumns({"_postal": F.nullif(postal, F.lit("")), "_others": F.regexp_replace("_plain", r"(?s)^(.*)\b\d{5,6}\b", "$1 ")})
    plain, after_dash = F.regexp_extract("_others", "(?<![a-z]-)" + _STREET, 1), F.regexp_extract("_others", _STREET, 1)
    words = text.tokens(text.strip_punctuation(F.col("_plain")))
    rows = rows.withColumns({"_street": F.coalesce(F.nullif(plain, F.lit("")), F.nullif(after_dash, F.lit(""))), "_words": words})
    parts = [
        F.when(text.is_null_text(F.col(column)), F.lit("")).otherwise(F.trim(column)).alias("raw"),
        F.array_join("_words", " ").alias("clean_address"),
        F.col("_street").alias("street_number"),
        F.col("_postal").alias("postal_code"),
        F.col("_words").alias("tokens"),
        F.col("_fold").rlike(_ROUTE + r"(?!\w)").alias("cedex_flag"),
    ]
    return rows.select(*kept, F.struct(*parts).alias(out))


def _known(df: DataFrame) -> DataFrame:
    return df.where(~text.is_null_text(F.col("entity_id"), text.ID_NULL_TOKENS)).withColumns({"entity_id": F.trim("entity_id"), "country": F.upper(text.null_to(F.col("country"), text.ID_NULL_TOKENS, ""))})


def normalized(df: DataFrame, phonetic: bool = True) -> DataFrame:
    """Records with trimmed ids, upper-case countries and the structs name and address; rows without an entity_id are left out.

    Blocking and the pair features both start from it, so a record is normalised once.
    """
    return normalize_addresses(normalize_names(_known(df), phonetic=phonetic))


def blocking_view(rows: DataFrame) -> DataFrame:
    """What blocking needs of normalised records: entity_id, country, name, address, tokens, char_3grams, metaphone, street, postal."""
    return rows.select("entity_id", "country", F.col("name.clean_name").alias("name"), F.col("address.clean_address").alias("address"), F.col("name.tokens").alias("tokens"), F.col("name.char_3grams").alias("char_3grams"), F.col("name.metaphone_primary").alias("metaphone"), F.col("address.street_number").alias("street"), F.col("address.postal_code").alias("postal"))


def prepare(df: DataFrame, profile: str = "canonical", phonetic: bool = True) -> DataFrame:
    """Records ready for blocking, see blocking_view(). Without phonetic codes metaphone is null.

    `lite` lower-cases and trims only and takes numbers as they stand; `canonical` normalises. Both sides of a linkage
    must be prepared with the same profile.
    """
    if profile == "lite":
        known = _known(df)
        known = known.withColumns({"_n": F.lower(text.null_to(F.col("business_name"), default="")), "_a": F.lower(text.null_to(F.col("business_address"), default=""))})
        words = text.tokens(F.col("_n"))
        known = known.withColumn("_code", kernels.metaphone(F.coalesce(F.get(words, F.lit(0)), F.lit(""))))
        return known.select("entity_id", "country", F.col("_n").alias("name"), F.col("_a").alias("address"), words.alias("tokens"), text.char_ngrams(F.array_join(words, ""), 3, True).alias("char_3grams"), F.col("_code.primary").alias("metaphone"), F.nullif(F.regexp_extract("_a", r"\b(\d+)\b", 1), F.lit("")).alias("street"), F.nullif(F.regexp_extract("_a", r"\b(\d{5,6})\b", 1), F.lit("")).alias("postal"))
    if profile != "canonical":
        raise ValueError(f"unknown profile {profile!r}; canonical or lite")
    return blocking_view(normalized(df, phonetic))
