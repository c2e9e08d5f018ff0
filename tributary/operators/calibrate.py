"""Macro F0.5 and the search for thresholds, all thresholds in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators import mining
from tributary.operators.assign import MAX_MATCHES, assign, scored_pairs

GRID_STEPS, GRID_LOW, GRID_HIGH, PLATEAU, SECONDARY_SHARE = 25, 0.30, 0.90, 1e-5, 0.85


def f_half(shared: Column, predicted: Column, true: Column) -> Column:
    """F0.5 of one record: 1 if nothing is true and nothing predicted, 0 if only one of both is empty or nothing is shared."""
    precision, recall = shared / predicted, shared / true
    return F.when((true == 0) & (predicted == 0), F.lit(1.0)).when((true == 0) | (predicted == 0) | (shared == 0), F.lit(0.0)).otherwise(1.25 * precision * recall / (0.25 * precision + recall))


def record_scores(truth: DataFrame, predicted: DataFrame, also: tuple[str, ...] = (), points: Column | None = None) -> DataFrame:
    """F0.5 of each s1 of truth (s1, cands array) against predicted (s1, cand); points lists the structs of `also`."""
    lists = predicted.groupBy(*also, "s1").agg(F.collect_set("cand").alias("found"))
    base = truth if points is None else truth.select("*", F.explode(points).alias("_point")).select(*truth.columns, "_point.*")
    joined = base.join(lists, [*also, "s1"], "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return joined.select(*also, "s1", f_half(F.size(F.array_intersect(found, "cands")), F.size(found), F.size(F.array_distinct("cands"))).alias("f05"))


def class_scores(truth: mining.Classes, predicted: DataFrame, also: tuple[str, ...], points: Column) -> DataFrame:
    """record_scores() of truth by class: what is true is counted, never listed."""
    found = truth.label(predicted.select(*also, "s1", "cand").distinct()).groupBy(*also, "s1").agg(F.count("*").alias("n"), F.sum("label").alias("shared"))
    base = truth.counts().select("*", F.explode(points).alias("_point")).select("s1", "n_true", "_point.*")
    return base.join(found.hint("merge"), [*also, "s1"], "left").select(*also, "s1", f_half(F.coalesce("shared", F.lit(0)), F.coalesce("n", F.lit(0)), F.col("n_true")).alias("f05"))


def macro_f05(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row, macro_f05: the mean over all records of truth; 0 without any."""
    return record_scores(truth, predicted).agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"))


def grid(steps: int = GRID_STEPS, low: float = GRID_LOW, high: float = GRID_HIGH) -> Column:
    """Evenly spaced thresholds as an array of structs step, tau."""
    tau = lambda k: F.round(F.lit(low) + k * F.lit((high - low) / max(steps - 1, 1)), 10)
    return F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda k: F.struct(k.alias("step"), tau(k).alias("tau")))


def curve(pairs: DataFrame, truth: DataFrame | mining.Classes, steps: int = GRID_STEPS, low: float = GRID_LOW, high: float = GRID_HIGH, max_matches: int | None = MAX_MATCHES, by_country: DataFrame | None = None, disambiguate: bool = True) -> DataFrame:
    """Macro F0.5 at each threshold: [country,] step, tau, f05.

    A pair is repeated for each threshold that it reaches, and the assignment runs once with the threshold as a further
    key. by_country (s1, country) makes a curve for each country.
    """
    taus = grid(steps, low, high)
    share = SECONDARY_SHARE if disambiguate else 1.0
    scored = scored_pairs(pairs).where(F.col("p") >= share * low - 1e-9)
    rows = scored.select("*", F.explode(F.filter(taus, lambda t: F.col("p") >= t["tau"] * share)).alias("point")).select("s1", "cand", "p", "country", "point.*")
    if by_country is not None:
        # The rows of all thresholds are many times those of the stored file that Spark would judge them by.
        rows = rows.drop("country").hint("merge").join(by_country.select("s1", "country"), "s1")
        known = by_country.select("s1", "country")
        truth = mining.Classes(truth.own.join(known.hint("merge"), "s1", "left_semi"), truth.others) if isinstance(truth, mining.Classes) else truth.hint("merge").join(known, "s1")
    if disambiguate:
        kept = assign(rows, None, F.col("tau"), F.col("tau") * SECONDARY_SHARE, max_matches, False, also=("step", "tau"))
    else:
        kept = rows.select("step", "tau", "s1", "cand").distinct()
    by = class_scores if isinstance(truth, mining.Classes) else record_scores
    scores = by(truth if isinstance(truth, mining.Classes) else truth.select("s1", "cands"), kept, ("step", "tau"), taus)
    keys = ["step", "tau"]
    if by_country is not None:
        keys, scores = ["country", *keys], scores.hint("merge").join(by_country.select("s1", "country"), "s1")
    return scores.groupBy(*keys).agg(F.avg("f05").alias("f05"))


def best_threshold(points: DataFrame, plateau: float = PLATEAU) -> DataFrame:
    """[country,] tau, f05: the median of the thresholds whose score is within the plateau below the best."""
    by = ["country"] if "country" in points.columns else []
    best = points.withColumn("best", F.max("f05").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))))
    return best.where(F.col("best") - F.col("f05") <= plateau).groupBy(*by).agg(F.expr("percentile(tau, 0.5)").alias("tau"), F.max("f05").alias("f05"))


def effective_thresholds(countries: DataFrame, calibrated: DataFrame | None = None, tau: float | None = None, tau_singleton: float | None = None, default: float = 0.74) -> DataFrame:
    """(country, tau_singleton, tau_secondary): a country's own calibration, else tau, else tau_singleton, else the default."""
    general = tau if tau is not None else tau_singleton if tau_singleton is not None else default
    own = F.lit(None).cast("double")
    rows = countries.select("country").distinct()
    if calibrated is not None:
        rows, own = rows.join(calibrated.select("country", F.col("tau").alias("own")), "country", "left"), F.col("own")
    return rows.select("country", F.coalesce(own, F.lit(float(general))).alias("tau_singleton")).withColumn("tau_secondary", F.col("tau_singleton") * SECONDARY_SHARE)
