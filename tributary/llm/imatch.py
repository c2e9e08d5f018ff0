"""I-Match document fingerprints with randomised lexicons, in DataFrame functions only.

A text's terms are its distinct lower-cased runs of letters and digits, each known by its 64-bit hash. The lexicon keeps
the terms whose document frequency lies within a band of shares of all documents, which is a band of inverse document
frequencies; frequencies of all terms are counted over all documents. As every term of the lexicon is in a share of
BAND[0] of the documents at least, it has at most (mean number of distinct terms of a document) / BAND[0] terms however
large the corpus is, so it reaches the executors as one value: a hash table of about as many buckets as terms. Each of the
randomised subsets of the lexicon takes a term by bits of its second hash; a fingerprint is, for each subset, a hash of the
sorted distinct terms of the text that are in it, or 0 if there are none. Subsets are of several sizes, so that long texts
and short ones both have subsets with few terms; the first part is that of the whole lexicon. A text without a term of the
lexicon is known by all its terms.

The likeness of two fingerprints is the largest share of equal parts that a size of subsets has: large subsets tell near
copies, small ones texts that have a part in common. Equal fingerprints, those of two texts without terms among them, have
likeness 1.

Null and empty texts have no terms. Equal texts have equal fingerprints. Rows with equal doc_id are ordered by the hash of
their text, then by text; a null doc_id comes last. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Shares of all documents between which a term's document frequency lies.
BAND = (1e-3, 0.1)
#: Subsets by hash bits that a term must match: a subset of k bits takes 1 in 2^k terms of the lexicon.
SUBSETS = (2, 3, 4, 5, 6, 7, 8, 9, 10)
#: Independent series of subsets.
SERIES = 12
#: Documents of a bucket of neighbours, on average; cuts of the ids, cuts between two of those, and parts of the null ids. So
#: there are at most 256 * 1025 + 65,536 buckets, and tables of one row a bucket are small enough to broadcast.
BUCKET_ROWS, QUANTILES, FINE, NULL_PARTS = 200, 256, 1024, 65_536
#: Accuracy of quantiles: their ranks are off by at most a share of 1 / ACCURACY.
ACCURACY = 10_000


def terms(text: Column) -> Column:
    """Sorted hashes of the distinct terms of a text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.sort_array(F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))))


def _slot(term: Column, table: Column) -> Column:
    """The bucket of a term in a table whose size is a power of two."""
    return term.bitwiseAND((F.size(table) - 1).cast("bigint")).cast("int")


def lexicon_terms(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """(term, df): hashes of the terms whose document frequency is within the band, and in two documents at least."""
    found = docs.select(F.explode(terms(F.col(text_col).cast("string"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    # An empty text holds no term, so documents are counted apart.
    size = docs.agg(F.count("*").alias("n"))
    least, most = (size.select(F.greatest(F.lit(2.0), F.col("n") * share)).scalar() for share in band)
    return found.where((F.col("df") >= least) & (F.col("df") <= most))


def lexicon(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """One row with `words`: the lexicon as an array of buckets of terms, one for each value of a term's lowest bits."""
    kept = common.stored(lexicon_terms(docs, text_col, band).select("term"), "lexicon")
    size = 1 << max(0, kept.count() - 1).bit_length()
    held = kept.groupBy(F.col("term").bitwiseAND(F.lit(size - 1).cast("bigint")).alias("k")).agg(F.sort_array(F.collect_list("term")).alias("held"))
    whole = docs.sparkSession.range(0, size, 1, 1).select(F.col("id").alias("k")).join(held, "k", "left")
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", F.coalesce("held", F.array().cast("array<bigint>")).alias("held")))), lambda x: x["held"]).alias("words"))


def _member(number: int, bits: int):
    return lambda t: F.xxhash64(t, F.lit(number)).bitwiseAND(F.lit((1 << bits) - 1)) == 0


def _hash(found: str) -> Column:
    return F.when(F.size(found) > 0, F.xxhash64(found).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).otherwise(F.lit(0))


def add_fingerprint(rows: DataFrame, text_col: str, words: DataFrame, name: str, subsets: tuple[int, ...] = SUBSETS, series: int = SERIES) -> DataFrame:
    """The rows with the column `name`: an int, or 0, for the whole lexicon and each subset. words is what lexicon() gives.

    The subsets of a series are nested, each taken from the one before. They are columns of their own until they are
    hashed: as one expression, the shared parts would be evaluated once for each subset.
    """

    def known(t: Column) -> Column:
        return F.array_contains(F.get(F.col("_words"), _slot(t, F.col("_words"))), t)

    kept = rows.columns
    rows = rows.withColumn("_words", words.scalar()).withColumn("_all", terms(F.col(text_col))).withColumn("_terms", F.filter("_all", known))
    rows = rows.withColumn("_terms", F.when(F.size("_terms") > 0, F.col("_terms")).otherwise(F.col("_all"))).drop("_words", "_all")
    rows = rows.withColumn("_hash", _hash("_terms"))
    before = ["_terms"] * series
    for level, bits in enumerate(sorted(subsets)):
        now = [f"_subset_{level}_{number}" for number in range(series)]
        rows = rows.withColumns({n: F.filter(F.col(b), _member(number, bits)) for number, (n, b) in enumerate(zip(now, before))})
        hashed = {f"_hash_{level}_{number}": _hash(n) for number, n in enumerate(now)}
        rows = rows.withColumns(hashed).drop(*set(before))
        before = now
    parts = [F.col(f"_hash_{level}_{number}") for level in range(len(subsets)) for number in range(series)]
    return rows.select(*kept, F.array("_hash", *parts).alias(name))


def likeness(a: Column, b: Column, series: int = SERIES, sizes: int = len(SUBSETS)) -> Column:
    """The largest share of equal parts that a size of subsets has; 1 for equal fingerprints.

    Shares are of the parts that are not 0 in both, or of half the series where there are fewer, so that a single subset
    that happens to hold one common term does not count as a full match.
    """
    shares = []
    for size in range(sizes):
        pairs = F.zip_with(F.slice(a, 2 + size * series, series), F.slice(b, 2 + size * series, series), lambda x, y: F.when((x == 0) & (y == 0), F.lit(0)).when(x == y, F.lit(1001)).otherwise(F.lit(1)))
        # Thousands count equal parts, ones count all.
        total = F.aggregate(pairs, F.lit(0), lambda s, x: s + x)
        shares.append(F.floor(total / 1000) / F.greatest(total % 1000, F.lit((series + 1) // 2)))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(*shares))


def as_text(found: Column) -> Column:
    """Eight hexadecimal digits for each part."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def _at_most(cuts: Column, value: Column) -> Column:
    """How many of the cuts after the first are at most the value."""
    return F.greatest(F.size(F.filter(cuts, lambda x: x <= value)) - 1, F.lit(0)).cast("bigint")


def add_bucket(docs: DataFrame, id_col: str, hash_col: str, name: str) -> tuple[DataFrame, int]:
    """(the rows with their bucket, how many numbers a coarse bucket takes): about BUCKET_ROWS neighbouring ids each, in order of the ids; null ids lie below, by hash.

    Ids are cut at quantiles, and between two of those at the quantiles of the ids there, so uneven ids make even buckets.
    """
    steps = lambda n: F.array(*[F.lit(k / n) for k in range(n + 1)])
    found = docs.agg(F.count("*").alias("n"), F.count(id_col).alias("named"), F.percentile_approx(id_col, steps(QUANTILES), ACCURACY).alias("q")).first()
    n_fine = min(FINE, max(1, -(-found["named"] // (QUANTILES * BUCKET_ROWS))))
    rows = docs.withColumn("_coarse", _at_most(F.array(*[F.lit(x).cast("bigint") for x in sorted(set(found["q"] or [0]))]), F.col(id_col)))
    bucket = F.col("_coarse") * (n_fine + 1)
    if n_fine > 1:
        fine = rows.where(F.col(id_col).isNotNull()).groupBy(F.col("_coarse").alias("k")).agg(F.array_distinct(F.percentile_approx(id_col, steps(n_fine), ACCURACY)).alias("cuts"))
        fine = common.stored(fine.agg(F.map_from_entries(F.collect_list(F.struct("k", "cuts"))).alias("cuts")), "cuts")
        rows = rows.withColumn("_cuts", F.element_at(fine.scalar(), F.col("_coarse")))
        bucket += _at_most(F.col("_cuts"), F.col(id_col))
    n_null = min(NULL_PARTS, max(1, -(-(found["n"] - found["named"]) // BUCKET_ROWS)))
    bucket = F.when(F.col(id_col).isNull(), -1 - F.pmod(F.col(hash_col), F.lit(n_null))).otherwise(bucket).cast("bigint")
    return rows.select(*docs.columns, bucket.alias(name)), n_fine + 1


def with_next(docs: DataFrame, carried: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row with next_<column> of the next row in descending id_col, for text_col and the carried columns.

    Rows are cut into buckets of neighbouring ids, and the first row of the bucket below is copied to each bucket's end
    (to the lowest bucket's end that of the highest), so rows are shuffled once and no task sees more than its buckets.
    Rows that share an id, null apart, are in one bucket.
    """
    docs = docs.select(id_col, text_col, *carried, F.xxhash64(text_col).alias("_hash_of"))
    docs, wide = add_bucket(docs, id_col, "_hash_of", "_bucket")
    # The order of rows; turned bits are the reverse order without an overflow.
    key = F.struct(F.bitwise_not(F.col(id_col)).alias("turned"), F.col("_hash_of").alias("hash"))
    heads = docs.groupBy(F.col("_bucket").alias("own")).agg(F.min(key).alias("head"))
    heads = common.stored(heads.select("own", F.floor(F.col("own") / wide).alias("coarse"), F.bitwise_not("head.turned").alias("head_id"), F.col("head.hash").alias("head_hash")), "heads")
    # A row for each coarse bucket.
    order = Window.orderBy("coarse")
    lowest = heads.groupBy("coarse").agg(F.min("own").alias("lowest"))
    lowest = lowest.select("coarse", F.coalesce(F.lead("lowest").over(order), F.first("lowest").over(order)).alias("beyond"))
    above = F.coalesce(F.lead("own").over(Window.partitionBy("coarse").orderBy("own")), "beyond")
    heads = common.stored(heads.join(lowest, "coarse").select("head_id", "head_hash", above.alias("target")), "targets")
    copied = F.when(F.col("target").isNotNull(), F.struct(F.col("target").alias("bucket"), F.lit(1).alias("copy")))
    placed = docs.join(F.broadcast(heads), F.col(id_col).eqNullSafe(F.col("head_id")) & (F.col("_hash_of") == F.col("head_hash")), "left")
    placed = placed.select(id_col, text_col, *carried, "_hash_of", F.explode(F.array_compact(F.array(F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("copy")), copied))).alias("place"))
    by = Window.partitionBy("place.bucket").orderBy("place.copy", F.col(id_col).desc_nulls_last(), "_hash_of", text_col)
    ahead = [F.lead(c).over(by).alias(f"next_{c}") for c in (text_col, *carried)]
    return placed.select(id_col, text_col, *carried, "place", *ahead).where("place.copy = 0").drop("place")


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as many first code points of the following text, or all it has."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def op2_imatch(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    words = common.stored(lexicon(docs), "lexicon")
    both = with_next(add_fingerprint(docs, "text", words, "fingerprint"), ["fingerprint"])
    both = both.withColumn("edited", edited(F.col("text"), F.coalesce("next_text", F.lit(""))))
    both = both.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "fingerprint", "next_fingerprint", "edited")
    both = add_fingerprint(both, "edited", words, "edited_fingerprint")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fingerprint")).alias("fingerprint"),
        as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("next_fingerprint", "fingerprint")).alias("near_next"),
    )
