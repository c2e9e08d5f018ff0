"""The 32 similarity features of a candidate pair.

pair_features() joins the candidates to both sides' normalised records and projects. Sides that normalize.normalized() has
made are not normalised again.
Only the Jaro-Winkler and LCS kernels leave the JVM; every Indel ratio is an LCS length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import kernels, text
from tributary.operators import mining
from tributary.operators.normalize import normalize_addresses, normalize_names

#: Column order of the feature matrix. Fixed values.
FEATURES = [
    "name_exact_match", "name_clean_exact_match", "name_jaro_winkler", "name_levenshtein_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_char_3gram_jaccard", "name_length_diff",
    "name_length_ratio", "name_first_token_match", "name_soundex_match", "name_soundex_jaccard", "name_common_tokens_count", "addr_exact_match", "addr_token_jaccard", "addr_token_sort_ratio",
    "addr_token_set_ratio", "addr_street_num_status", "addr_postal_code_status", "addr_locality_jaccard", "addr_numeric_overlap", "addr_is_empty", "name_in_address_cross", "is_source2",
    "is_source3", "blocking_rank", "blocking_score", "name_lcs_ratio", "addr_lcs_ratio", "name_char_3gram_dice", "dense_cosine_similarity", "dense_norm_difference",
]
#: Features that need a kernel outside the JVM.
KERNEL_FEATURES = ("name_jaro_winkler", "name_token_sort_ratio", "name_token_set_ratio", "addr_token_sort_ratio", "addr_token_set_ratio", "name_lcs_ratio", "addr_lcs_ratio")


def _flag(test: Column) -> Column:
    return F.when(test, F.lit(1.0)).otherwise(F.lit(0.0))


def _sorted_text(tokens: Column) -> Column:
    return F.array_join(F.sort_array(tokens), " ")


def token_set_parts(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """Sorted text of the shared tokens, of a's other tokens and of b's."""
    a, b = F.array_distinct(a), F.array_distinct(b)
    return _sorted_text(F.array_intersect(a, b)), _sorted_text(F.array_except(a, b)), _sorted_text(F.array_except(b, a))


def token_set_ratio(shared: Column, only_a: Column, only_b: Column, lcs: Column) -> Column:
    """From the parts and the LCS of both rests: the best ratio of the shared text to either side and of both sides."""
    size, a, b = F.length(shared), F.length(only_a), F.length(only_b)
    gap = F.when(size > 0, F.lit(1)).otherwise(F.lit(0))
    total = 2 * (size + gap) + a + b
    both = F.when(total > 0, F.lit(1.0) - (a + b - 2 * lcs) / total).otherwise(F.lit(0.0))
    side = lambda x: F.lit(1.0) - (gap + x) / (size + size + gap + x)
    return F.when((size > 0) & ((a == 0) | (b == 0)), F.lit(1.0)).when(size > 0, F.greatest(both, side(a), side(b))).otherwise(both)


def _side(df: DataFrame, side: str) -> DataFrame:
    """Normalised columns of one side, prefixed; records that are normalised already are taken as they are."""
    rows = df if {"name", "address"} <= set(df.columns) else normalize_addresses(normalize_names(df, phonetic=False))
    words, place = F.col("name.tokens"), F.col("address.tokens")
    columns = {
        "raw": F.lower("name.raw"), "name": F.col("name.clean_name"), "tokens": words, "grams": F.array_distinct("name.char_3grams"),
        "sounds": F.array_distinct(F.transform(words, text.soundex)), "first_sound": text.soundex(F.get(words, F.lit(0))),
        "raw_addr": F.lower("address.raw"), "addr": F.col("address.clean_address"), "words": place,
        "street": F.col("address.street_number"), "postal": F.col("address.postal_code"),
        "places": F.array_distinct(F.filter(place, lambda t: ~t.rlike(r"^\d+$") & (F.length(t) >= 3))), "numbers": F.array_distinct(F.filter(place, lambda t: t.rlike(r"\d"))),
    }
    return rows.select(F.trim("entity_id").alias(f"{side}_id"), *[c.alias(f"{side}_{k}") for k, c in columns.items()])


def pair_features(candidates: DataFrame, s1: DataFrame, targets: DataFrame, kernel_features: bool = True) -> DataFrame:
    """s1, cand and the features as doubles, for candidates with s1, cand, rank and score.

    Optional columns cosine and norm_difference of the candidates are passed through. A candidate without a record is
    compared as an empty one. Without kernel_features the seven that need a kernel are left out.
    """
    passed = {c: text.safe_float(F.col(c)) if c in candidates.columns else F.lit(0.0) for c in ("cosine", "norm_difference")}
    pairs = candidates.select("s1", "cand", F.col("rank").cast("double").alias("rank"), F.col("score").cast("double").alias("score"), *[c.alias(k) for k, c in passed.items()])
    # By the size of their file Spark would broadcast records that take far more room in memory.
    p = pairs.join(_side(s1, "a").hint("merge"), F.col("s1") == F.col("a_id"), "left").join(_side(targets, "b").hint("merge"), F.col("cand") == F.col("b_id"), "left")
    return _compared(p, kernel_features)


def class_pair_features(s1: DataFrame, targets: DataFrame, classes: mining.Classes, candidates: DataFrame, block: int = 32) -> DataFrame:
    """s1, cand and all features of the true pairs that are no candidates, with score 0 and the rank after the s1's last.

    Records meet by their class and not by a list of pairs, so each is dealt out once for every `block` records of its
    class on the other side, and no task has more of a large class than that.
    """
    spark = candidates.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    labelled = classes.label(candidates.select("s1", "cand", "rank"))
    seen = labelled.groupBy("s1").agg(F.max("rank").alias("_last"), F.collect_list(F.when(F.col("label") == 1, F.col("cand"))).alias("_seen"))
    sizes = classes.own.groupBy("class_id").agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    own = classes.own.hint("merge").join(sizes, "class_id").withColumn("_block", F.pmod(F.xxhash64("s1"), F.col("_blocks")).cast("int"))
    others = classes.others.hint("merge").join(sizes, "class_id").select("cand", "class_id", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
    own = own.select("s1", "class_id", "_block").join(seen.hint("merge"), "s1", "left").join(_side(s1, "a").hint("merge"), F.col("s1") == F.col("a_id"))
    others = others.hint("merge").join(_side(targets, "b"), F.col("cand") == F.col("b_id"))
    # A given number of partitions stays as it is: small records make many pairs.
    met = own.repartition(parts, "class_id", "_block").hint("merge").join(others.repartition(parts, "class_id", "_block"), ["class_id", "_block"])
    missed = met.where(~F.coalesce(F.array_contains("_seen", F.col("cand")), F.lit(False)))
    last = (F.coalesce("_last", F.lit(0)) + 1).cast("double")
    return _compared(missed.withColumns({"rank": last, "score": F.lit(0.0), "cosine": F.lit(0.0), "norm_difference": F.lit(0.0)}).drop("class_id", "_block", "_seen", "_last"), True)


def _compared(p: DataFrame, kernel_features: bool) -> DataFrame:
    """s1, cand and the features of pairs with s1, cand, rank, score, cosine, norm_difference and both sides' columns."""
    empty_list = F.array().cast("array<string>")
    p = p.withColumns({f"{s}_{c}": F.coalesce(f"{s}_{c}", F.lit("")) for s in "ab" for c in ("raw", "name", "first_sound", "raw_addr", "addr")} | {f"{s}_{c}": F.coalesce(f"{s}_{c}", empty_list) for s in "ab" for c in ("tokens", "grams", "sounds", "words", "places", "numbers")})
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    size_a, size_b = F.length("a_name"), F.length("b_name")
    whole_word = lambda name, *places: F.array_contains(F.transform(F.array(*places), lambda x: F.rlike(x, F.concat(F.lit(r"\b"), name, F.lit(r"\b")))), True)
    source = F.upper(F.trim("cand"))
    values = {
        "name_exact_match": _flag((a("raw") == b("raw")) & (a("raw") != "")),
        "name_clean_exact_match": _flag((a("name") == b("name")) & (a("name") != "")),
        "name_levenshtein_ratio": text.levenshtein_ratio(a("name"), b("name")),
        "name_char_3gram_jaccard": text.jaccard(a("grams"), b("grams")),
        "name_length_diff": F.abs(size_a - size_b).cast("double"),
        "name_length_ratio": F.when(F.greatest(size_a, size_b) > 0, F.least(size_a, size_b) / F.greatest(size_a, size_b)).otherwise(F.lit(0.0)),
        "name_first_token_match": _flag(F.coalesce(F.get("a_tokens", F.lit(0)) == F.get("b_tokens", F.lit(0)), F.lit(False))),
        "name_soundex_match": _flag((a("first_sound") == b("first_sound")) & (a("first_sound") != "")),
        "name_soundex_jaccard": text.jaccard(a("sounds"), b("sounds")),
        "name_common_tokens_count": F.size(F.array_intersect("a_tokens", "b_tokens")).cast("double"),
        "addr_exact_match": _flag(((a("addr") == b("addr")) & (a("addr") != "")) | ((a("raw_addr") == b("raw_addr")) & (a("raw_addr") != ""))),
        "addr_token_jaccard": text.jaccard(F.array_distinct("a_words"), F.array_distinct("b_words")),
        "addr_street_num_status": text.ternary_match(a("street"), b("street")),
        "addr_postal_code_status": text.ternary_match(a("postal"), b("postal")),
        "addr_locality_jaccard": text.jaccard(a("places"), b("places")),
        "addr_numeric_overlap": text.jaccard(a("numbers"), b("numbers")),
        "addr_is_empty": _flag((a("addr") == "") | (b("addr") == "")),
        "name_in_address_cross": _flag(((size_a >= 3) & whole_word(a("name"), b("raw_addr"), b("addr"))) | ((size_b >= 3) & whole_word(b("name"), a("raw_addr"), a("addr")))),
        "is_source2": _flag(source.startswith("S2")),
        "is_source3": _flag(source.startswith("S3")),
        "blocking_rank": F.col("rank"),
        "blocking_score": F.col("score"),
        "name_char_3gram_dice": text.dice(a("grams"), b("grams")),
        "dense_cosine_similarity": F.col("cosine"),
        "dense_norm_difference": F.col("norm_difference"),
    }
    if kernel_features:
        rests = {}
        for field, tokens in (("name", "tokens"), ("addr", "words")):
            rests |= dict(zip((f"_{field}_shared", f"_{field}_only_a", f"_{field}_only_b"), token_set_parts(a(tokens), b(tokens))))
            rests |= {f"_{field}_{s}": _sorted_text(F.col(f"{s}_{tokens}")) for s in "ab"}
        p = p.withColumns(rests)
        # Sorted tokens have the length of the text, as it has single spaces only.
        for field in ("name", "addr"):
            rest = [F.col(f"_{field}_{c}") for c in ("shared", "only_a", "only_b")]
            some = (a(field) != "") & (b(field) != "")
            values[f"{field}_lcs_ratio"] = kernels.lcs_ratio(a(field), b(field))
            values[f"{field}_token_sort_ratio"] = kernels.lcs_ratio(F.col(f"_{field}_a"), F.col(f"_{field}_b"))
            values[f"{field}_token_set_ratio"] = F.when(some, token_set_ratio(*rest, kernels.lcs_size(rest[1], rest[2]))).otherwise(F.lit(0.0))
        values["name_jaro_winkler"] = kernels.jaro_winkler_similarity(a("name"), b("name"))
    return p.select("s1", "cand", *[values[f].alias(f) for f in FEATURES if f in values])
