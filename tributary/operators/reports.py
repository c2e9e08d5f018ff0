"""Profiles of candidates, matches and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import text


def partition_summary(lists: DataFrame, universe: DataFrame) -> DataFrame:
    """country, total, matched, singletons, match_ratio (per cent) of match lists; universe has s1 and country."""
    joined = universe.select(F.col("s1").alias("source1_entity_id"), "country").join(lists, "source1_entity_id", "left")
    some = F.coalesce(F.col("matched_entity_ids"), F.lit("")) != ""
    counts = joined.groupBy("country").agg(F.count("*").alias("total"), F.count_if(some).alias("matched"))
    return counts.select("country", "total", "matched", (F.col("total") - F.col("matched")).alias("singletons"), (F.col("matched") * 100.0 / F.col("total")).alias("match_ratio"))


def match_counts(lists: DataFrame) -> DataFrame:
    """(n_matches, records): how many records have how many matches."""
    n = F.size(text.split_list(F.col("matched_entity_ids"))).cast("bigint")
    return lists.groupBy(n.alias("n_matches")).agg(F.count("*").alias("records"))


def match_profile(lists: DataFrame) -> DataFrame:
    """One row: records, matches, mean_matches, singleton_share."""
    n = F.size(text.split_list(F.col("matched_entity_ids")))
    return lists.agg(F.count("*").alias("records"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("matches"), F.coalesce(F.avg(n), F.lit(0.0)).alias("mean_matches"), F.coalesce(F.avg((n == 0).cast("double")), F.lit(0.0)).alias("singleton_share"))


def candidate_percentiles(lists: DataFrame) -> DataFrame:
    """Ids per record of candidate lists: records, mean, least, p25, p50, p75, p90, p95, p99, most."""
    n = F.size(text.split_list(F.col("candidate_entity_ids")))
    exact = [F.expr(f"percentile(n, {q / 100})").alias(f"p{q}") for q in (25, 50, 75, 90, 95, 99)]
    return lists.select(n.alias("n")).agg(F.count("*").alias("records"), F.avg("n").alias("mean"), F.min("n").cast("bigint").alias("least"), *exact, F.max("n").cast("bigint").alias("most"))


def target_collisions(lists: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """One row: claimed ids, ids that several records claim, and the share of them."""
    claims = lists.select("source1_entity_id", F.explode(text.split_list(F.col(column))).alias("cand")).groupBy("cand").agg(F.count_distinct("source1_entity_id").alias("k"))
    return claims.agg(F.count("*").alias("claimed"), F.count_if(F.col("k") > 1).alias("shared"), F.coalesce(F.avg((F.col("k") > 1).cast("double")), F.lit(0.0)).alias("shared_share"))


def blocker_recall(candidates: DataFrame, truth_pairs: DataFrame) -> DataFrame:
    """One row: true pairs, those among the raw candidates, and recall."""
    held = candidates.select("s1", "cand", F.lit(1).alias("hit")).distinct()
    joined = truth_pairs.select("s1", "cand").distinct().join(held, ["s1", "cand"], "left")
    return joined.agg(F.count("*").alias("true_pairs"), F.count("hit").alias("found"), F.coalesce(F.count("hit") / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("recall"))


def leaderboard(runs: DataFrame, metric: str = "macro_f05") -> DataFrame:
    """run_id, run_name, value of the metric and rank, best first; runs without it come last."""
    from pyspark.sql import Window

    value = F.col("metrics")[metric]
    order = Window.partitionBy(F.lit(1)).orderBy(value.desc_nulls_last(), "run_id")
    return runs.select("run_id", "run_name", value.alias(metric), F.row_number().over(order).alias("rank"))
