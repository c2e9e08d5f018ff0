"""Candidate retrieval: equi-joins on bucket keys, weighted token overlap, dense neighbours, and their fusion.

Every retriever takes prepared records (operators.normalize.prepare) of both sides and gives s1, cand, score and rank
(from 1) in a long relation. country is part of every key, so one job serves all countries. Frequent keys are cut by their
posting length before the join, which also bounds the rows that one key can make: at most `ceiling` per record.

Keys and terms of records are joined with a merge hint: repeated texts take little room in a file, and by the file's size
Spark would broadcast them, though they are many rows that the driver has to hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import text

BUCKET_CEILING, POSTING_CEILING, LEGACY_CEILING = 250, 1000, 500
TIER_TOP, MAX_CANDIDATES, RRF_K = 20, 35, 60
TIER_WEIGHTS = {1: 1.5, 2: 1.0, 3: 1.0}
#: Weights of an exact name and of any other bucket; of a shared word and a shared trigram; of an address anchor.
NAME_WEIGHT, KEY_WEIGHT, TOKEN_WEIGHT, GRAM_WEIGHT, ANCHOR_WEIGHT = 3.0, 1.0, 2.0, 0.5, 5.0


def top_per(pairs: DataFrame, k: int | None, by: tuple[str, ...] = ("s1",), score: str = "score") -> DataFrame:
    """The k best rows of each group with their rank; scores are compared to nine places, ties go by cand."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), "cand")
    ranked = pairs.withColumn(score, F.round(score, 9)).withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def bucket_keys() -> Column:
    """Keys of a prepared record, each tagged with its kind: name, name start and street, sound and postal, postal and street."""
    has = {c: F.col(c).isNotNull() & (F.col(c) != "") for c in ("name", "street", "postal", "metaphone")}
    key = lambda kind, *parts: F.concat_ws("\x1f", F.lit(kind), "country", *parts)
    kinds = [
        F.when(has["name"], key("name", F.col("name"))),
        F.when(has["name"] & has["street"], key("start", F.substring("name", 1, 4), F.col("street"))),
        F.when(has["metaphone"] & has["postal"], key("sound", F.col("metaphone"), F.col("postal"))),
        F.when(has["postal"] & has["street"], key("place", F.col("postal"), F.col("street"))),
    ]
    return F.array_compact(F.array(*kinds))


def buckets(records: DataFrame, ceiling: int = BUCKET_CEILING) -> DataFrame:
    """(key, cand) of all keys that at most `ceiling` different records have."""
    postings = records.select(F.explode(bucket_keys()).alias("key"), F.col("entity_id").alias("cand")).distinct()
    return postings.hint("merge").join(postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") <= ceiling).select("key"), "key")


def tier1(s1: DataFrame, targets: DataFrame, k: int = MAX_CANDIDATES, ceiling: int = BUCKET_CEILING) -> DataFrame:
    """Records that share a bucket key; an exact name counts three times."""
    keys = s1.select(F.col("entity_id").alias("s1"), F.explode(bucket_keys()).alias("key"))
    weight = F.when(F.col("key").startswith("name\x1f"), F.lit(NAME_WEIGHT)).otherwise(F.lit(KEY_WEIGHT))
    return top_per(keys.hint("merge").join(buckets(targets, ceiling), "key").groupBy("s1", "cand").agg(F.sum(weight).alias("score")), k)


def _terms(records: DataFrame, grams: Column, words: Column, id_name: str) -> DataFrame:
    """(id, country, kind, term): distinct words of three characters or more, and distinct trigrams."""
    tagged = lambda kind, terms: F.transform(F.array_distinct(terms), lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term")))
    both = F.concat(tagged("word", F.filter(words, lambda w: F.length(w) >= 3)), tagged("gram", grams))
    return records.select(F.col("entity_id").alias(id_name), "country", F.explode(both).alias("x")).select(id_name, "country", "x.kind", "x.term")


def _weights(targets: DataFrame, postings: DataFrame, ceiling: int) -> DataFrame:
    """(country, kind, term, weight) of the terms that at most `ceiling` records of their country hold."""
    sizes = targets.groupBy("country").agg(F.count("*").alias("n_records"))
    frequencies = postings.groupBy("country", "kind", "term").agg(F.count("*").alias("df")).where(F.col("df") <= ceiling)
    idf = F.log((F.col("n_records") + 1) / (F.col("df") + 1)) + 1
    weight = F.when(F.col("kind") == "word", F.lit(TOKEN_WEIGHT)).otherwise(F.lit(GRAM_WEIGHT)) * idf
    return frequencies.join(sizes, "country").select("country", "kind", "term", weight.alias("weight"))


def _overlap(s1: DataFrame, targets: DataFrame, ceiling: int, words: Column, grams: Column, weights: DataFrame | None = None) -> DataFrame:
    """Summed weights of shared terms; a term's weight falls with the number of records of its country that hold it.

    Given weights are those of a reference: terms that it does not weigh, as they are too frequent or unknown there, do
    not count.
    """
    postings = _terms(targets, grams, words, "cand")
    weights = _weights(targets, postings, ceiling) if weights is None else weights
    asked = _terms(s1, grams, words, "s1").hint("merge").join(weights, ["country", "kind", "term"])
    return asked.join(postings.hint("merge"), ["country", "kind", "term"]).groupBy("s1", "cand").agg(F.sum("weight").alias("score"))


def _tier2_terms() -> tuple[Column, Column]:
    return text.tokens(F.concat_ws(" ", "name", "address")), text.char_ngrams(F.col("name"))


def term_weights(targets: DataFrame, max_postings: int = POSTING_CEILING) -> DataFrame:
    """The weights of tier 2's terms by their frequencies in prepared targets."""
    words, grams = _tier2_terms()
    return _weights(targets, _terms(targets, grams, words, "cand"), max_postings)


def tier2(s1: DataFrame, targets: DataFrame, k: int = TIER_TOP, max_postings: int = POSTING_CEILING, weights: DataFrame | None = None) -> DataFrame:
    """IDF-weighted overlap of words of name and address and of the name's trigrams, spaces included."""
    words, grams = _tier2_terms()
    return top_per(_overlap(s1, targets, max_postings, words, grams, weights), k)


def legacy(s1: DataFrame, targets: DataFrame, k: int = 25, max_postings: int = LEGACY_CEILING) -> DataFrame:
    """Words and trigrams of the name without its spaces, and a bonus for the same postal code and street number."""
    overlap = _overlap(s1, targets, max_postings, F.col("tokens"), F.col("char_3grams"))
    place = lambda df, id_name: df.where("postal IS NOT NULL AND street IS NOT NULL").select("country", "postal", "street", F.col("entity_id").alias(id_name)).distinct()
    held = place(targets, "cand")
    rare = held.groupBy("country", "postal", "street").agg(F.count("*").alias("n")).where(F.col("n") <= max_postings).drop("n")
    anchors = place(s1, "s1").join(rare, ["country", "postal", "street"]).join(held, ["country", "postal", "street"]).select("s1", "cand", F.lit(ANCHOR_WEIGHT).alias("score"))
    return top_per(overlap.unionByName(anchors).groupBy("s1", "cand").agg(F.sum("score").alias("score")), k)


def dense(s1: DataFrame, targets: DataFrame, k: int = TIER_TOP, id_col: str = "entity_id", vector_col: str = "embedding", block_rows: int = 4096, max_block_bytes: int = 32 << 20) -> DataFrame:
    """Exact cosine neighbours: s1, cand, score, rank.

    The s1 side is the stated query set: it goes through the targets in blocks of at most block_rows queries, fewer where
    the vectors are long, so that a block's matrix that is sent to the executors has at most max_block_bytes. A task keeps the k best of each query among its
    own targets, so what is shuffled is k rows a query and task. Zero vectors have cosine 0; null vectors are left out.
    """
    import numpy as np
    import pandas as pd

    def unit(rows: list) -> np.ndarray:
        matrix = np.array(rows, np.float64)
        size = np.linalg.norm(matrix, axis=1, keepdims=True)
        return matrix / np.where(size > 0, size, 1)

    def search(ids: list, matrix: np.ndarray):
        def step(batches):
            best_ids, best = [np.array([], object)] * len(ids), [np.array([])] * len(ids)
            for batch in batches:
                scores = matrix @ unit(list(batch["v"])).T
                names = batch["cand"].to_numpy(object)
                for q in range(len(ids)):
                    all_ids, all_scores = np.concatenate([best_ids[q], names]), np.concatenate([best[q], scores[q]])
                    keep = np.lexsort((all_ids, -np.round(all_scores, 9)))[:k]
                    best_ids[q], best[q] = all_ids[keep], all_scores[keep]
            yield pd.DataFrame({"s1": np.repeat(np.array(ids, object), [len(b) for b in best]), "cand": np.concatenate(best_ids), "score": np.concatenate(best)})

        return step

    held = targets.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("string").alias("cand"), F.col(vector_col).alias("v"))
    out, block = None, []

    def flush(rows: list) -> DataFrame:
        matrix = unit([r["v"] for r in rows])
        return held.mapInPandas(search([r["s1"] for r in rows], matrix), "s1 string, cand string, score double")

    for row in s1.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("string").alias("s1"), F.col(vector_col).alias("v")).toLocalIterator():
        block.append(row)
        if len(block) >= max(1, min(block_rows, max_block_bytes // (8 * max(len(row["v"]), 1)))):
            out = flush(block) if out is None else out.unionByName(flush(block))
            block = []
    if block:
        out = flush(block) if out is None else out.unionByName(flush(block))
    if out is None:
        return s1.sparkSession.createDataFrame([], "s1 string, cand string, score double, rank int")
    return top_per(out, k)


def fuse(tiers: dict[int, DataFrame], k: int | None = None, rrf_k: int = RRF_K, weights: dict[int, float] | None = None) -> DataFrame:
    """Reciprocal rank fusion: each tier adds weight / (rrf_k + best rank of the candidate)."""
    weights = TIER_WEIGHTS if weights is None else weights
    rows = None
    for tier, found in tiers.items():
        share = found.groupBy("s1", "cand").agg(F.min("rank").alias("rank")).select("s1", "cand", (F.lit(float(weights.get(tier, 1.0))) / (F.lit(rrf_k) + F.col("rank"))).alias("score"))
        rows = share if rows is None else rows.unionByName(share)
    return top_per(rows.groupBy("s1", "cand").agg(F.sum("score").alias("score")), k)


def generate(s1: DataFrame, targets: DataFrame, k: int = MAX_CANDIDATES, ceiling: int = BUCKET_CEILING, max_postings: int = POSTING_CEILING, vectors: tuple[DataFrame, DataFrame] | None = None, weights: DataFrame | None = None) -> DataFrame:
    """Fused candidates of all tiers; the third takes part if both sides' vectors are given."""
    tiers = {1: tier1(s1, targets, k, ceiling), 2: tier2(s1, targets, TIER_TOP, max_postings, weights)}
    if vectors:
        tiers[3] = dense(*vectors)
    return fuse(tiers, k)


def candidate_lists(candidates: DataFrame, universe: DataFrame) -> DataFrame:
    """Every s1 of the universe (column s1) with its candidates in rank order, joined by commas."""
    lists = candidates.groupBy("s1").agg(F.array_sort(F.collect_list(F.struct("rank", "cand"))).alias("x"))
    joined = universe.select("s1").distinct().join(lists, "s1", "left")
    return joined.select(F.col("s1").alias("source1_entity_id"), F.coalesce(F.array_join(F.transform("x", lambda r: r["cand"]), ","), F.lit("")).alias("candidate_entity_ids"))
