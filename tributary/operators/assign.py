"""Assignment of candidates to records of the first source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import text
from tributary.sources import storage

TAU_SINGLETON, TAU_SECONDARY, MAX_MATCHES = 0.74, 0.60, 15
#: Column names that stand for each role, whatever their case.
ALIASES = {
    "s1": ("s1", "source1_id", "s1_id", "source1_entity_id"),
    "cand": ("cand", "candidate_id", "cand_id", "candidate_entity_id"),
    "p": ("p", "p_final", "prob", "probability", "score"),
    "country": ("country",),
}
MATCHES = "s1 string, cand string, p double, rank int"
#: Primary and secondary thresholds of the competitive assignment. Fixed values.
COMPETITIVE = {"France": (0.52, 0.58), "India": (0.46, 0.52), "US": (0.55, 0.60)}


def scored_pairs(df: DataFrame) -> DataFrame:
    """s1, cand, p, country from any of the known column names; scores that are no numbers are 0, no country is ''."""
    have = {c.lower(): c for c in df.columns}
    found = {role: next((have[n] for n in names if n in have), None) for role, names in ALIASES.items()}
    absent = [r for r in ("s1", "cand", "p") if not found[r]]
    if absent:
        raise KeyError(f"no column for {', '.join(absent)} among {df.columns}")
    country = F.coalesce(F.trim(F.col(f"`{found['country']}`").cast("string")), F.lit("")) if found["country"] else F.lit("")
    return df.select(F.trim(F.col(f"`{found['s1']}`").cast("string")).alias("s1"), F.trim(F.col(f"`{found['cand']}`").cast("string")).alias("cand"), text.safe_float(F.col(f"`{found['p']}`")).alias("p"), country.alias("country"))


def is_candidate(cand: Column, enforce_prefix: bool = True) -> Column:
    """A candidate's id: no null token, no id of the first source, and with enforce_prefix one of the second or third."""
    known = ~text.is_null_text(cand, text.ID_NULL_TOKENS) & ~cand.startswith("S1-")
    return known & cand.rlike("^S[23]-") if enforce_prefix else known


def assign(pairs: DataFrame, universe: DataFrame | None = None, tau_singleton: Column | float = TAU_SINGLETON, tau_secondary: Column | float = TAU_SECONDARY, max_matches: int | None = MAX_MATCHES, enforce_prefix: bool = True, also: tuple[str, ...] = ()) -> DataFrame:
    """(s1, cand, p, rank) of the pairs that stay; `also` names columns that keep whole assignments apart.

    In each country a candidate belongs to the record with its highest score (ties: the smaller id). A record then keeps
    its candidates if the best reaches tau_singleton, at most max_matches of them. Scores under tau_secondary never count.
    """
    rows = pairs if also else scored_pairs(pairs)
    rows = rows.where((F.col("p") >= tau_secondary) & ~text.is_null_text(F.col("s1"), text.ID_NULL_TOKENS) & is_candidate(F.col("cand"), enforce_prefix))
    if universe is not None:
        rows = rows.join(universe.select(F.trim("s1").alias("s1")).distinct(), "s1", "left_semi")
    claim = Window.partitionBy(*also, "country", "cand").orderBy(F.desc("p"), "s1")
    won = rows.withColumn("claim", F.row_number().over(claim)).where("claim = 1").drop("claim")
    own = Window.partitionBy(*also, "s1")
    ranked = won.withColumns({"best": F.max("p").over(own), "rank": F.row_number().over(own.orderBy(F.desc("p"), "cand"))})
    kept = ranked.where(F.col("best") >= tau_singleton).select(*also, "s1", "cand", "p", "rank")
    return kept if max_matches is None else kept.where(F.col("rank") <= max_matches)


def match_lists(matches: DataFrame, universe: DataFrame) -> DataFrame:
    """Every s1 of the universe with its matches in rank order, joined by commas."""
    lists = matches.groupBy("s1").agg(F.array_sort(F.collect_list(F.struct("rank", "cand"))).alias("x"))
    return universe.select("s1").distinct().join(lists.hint("merge"), "s1", "left").select(F.col("s1").alias("source1_entity_id"), F.coalesce(F.array_join(F.array_distinct(F.transform("x", lambda r: r["cand"])), ","), F.lit("")).alias("matched_entity_ids"))


def competitive(pairs: DataFrame, thresholds: DataFrame | dict[str, tuple[float, float]] | None = None, max_matches: int = MAX_MATCHES) -> DataFrame:
    """(s1, cand, p, rank): pairs by falling score, each candidate once, at most max_matches a record, further matches of a
    record only from the secondary threshold on.

    Equal to the sequential pass in the order (-p, s1, cand). Each round accepts the pairs that are first both for their
    record and for their candidate; what they rule out goes, and the rest decides again, until nothing is left. A round is
    written once, the one before it is removed, and matches are added to one table, so neither plans nor disk grow with
    the rounds.
    """
    spark = pairs.sparkSession
    limits = COMPETITIVE if thresholds is None else thresholds
    if isinstance(limits, dict):
        limits = spark.createDataFrame([(c, float(a), float(b)) for c, (a, b) in limits.items()] or [], "country string, primary double, secondary double")
    live = scored_pairs(pairs).where(is_candidate(F.col("cand"), False)).dropDuplicates(["s1", "cand"]).join(limits, "country").where("p >= primary").select("s1", "cand", "p", "secondary", F.lit(0).alias("held"))
    matches, before = storage.scratch(spark, "matches"), None
    order = (F.desc("p"), "s1", "cand")
    while True:
        first = F.row_number().over(Window.partitionBy("s1").orderBy(*order)) + F.row_number().over(Window.partitionBy("cand").orderBy(*order)) == 2
        path = storage.scratch(spark, "round")
        live.withColumn("won", first).write.parquet(path)
        marked = spark.read.parquet(path)
        won = marked.where("won").select("s1", "cand", "p", (F.col("held") + 1).cast("int").alias("rank"))
        won.write.mode("append").parquet(matches)
        if before:
            storage.remove(spark, before)
        before = path
        if marked.isEmpty():
            storage.remove(spark, path)
            return spark.read.schema(MATCHES).parquet(matches)
        left = marked.where("NOT won").drop("won").join(won.select("cand"), "cand", "left_anti").join(won.select("s1", "rank"), "s1", "left").withColumn("held", F.coalesce("rank", "held")).drop("rank")
        live = left.where((F.col("held") < max_matches) & ((F.col("held") == 0) | (F.col("p") >= F.col("secondary"))))
