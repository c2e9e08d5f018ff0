"""Encoders, row statistics, imputation, rank averages and metrics for tabular learning, in SQL functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import text
from tributary.sources import storage

SMOOTHING, FOLDS = 10.0, 5


# --- encoders --------------------------------------------------------------------------------------------------------


def category_means(df: DataFrame, column: str, target: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(target).alias("n"), F.avg(target).alias("mean"))


def target_encode(df: DataFrame, column: str, target: str, fold: str = "fold", smoothing: float = SMOOTHING, out: str | None = None) -> DataFrame:
    """Adds the mean of the target over the other folds' rows of the same category, drawn towards the overall mean.

    Rows are aggregated by category and fold before anything is shuffled; sums of the other folds are the category's less
    the own fold's, so there is no loop over folds. A category that the other folds lack gets the overall mean.
    """
    mean = df.agg(F.avg(target).alias("m")).select("m").scalar()
    parts = df.groupBy(F.col(column).alias("_key"), F.col(fold).alias("_fold")).agg(F.count(target).alias("_n"), F.coalesce(F.sum(target), F.lit(0.0)).alias("_s"))
    whole = Window.partitionBy("_key")
    n, total = F.sum("_n").over(whole) - F.col("_n"), F.sum("_s").over(whole) - F.col("_s")
    coded = parts.withColumns({"_n": n, "_s": total}).where("_n > 0 AND _key IS NOT NULL").select("_key", "_fold", ((F.col("_s") + smoothing * mean) / (F.col("_n") + smoothing)).alias("_value"))
    joined = df.join(coded, (F.col(column) == F.col("_key")) & (F.col(fold) == F.col("_fold")), "left")
    return joined.withColumn(out or f"{column}_te", F.coalesce("_value", mean)).drop("_key", "_fold", "_value")


def fit_target_means(df: DataFrame, column: str, target: str, smoothing: float = SMOOTHING) -> DataFrame:
    """(column, encoded) for rows that were not in the training set; encoded of the null row is the mean over all rows."""
    mean = df.agg(F.avg(target).alias("m")).select("m").scalar()
    coded = category_means(df.where(F.col(column).isNotNull()), column, target).select(column, ((F.col("n") * F.col("mean") + smoothing * mean) / (F.col("n") + smoothing)).alias("encoded"))
    return coded.unionByName(df.agg(F.avg(target).alias("encoded")).select(F.lit(None).cast(dict(df.dtypes)[column]).alias(column), "encoded"))


def apply_target_means(df: DataFrame, means: DataFrame, column: str, out: str | None = None) -> DataFrame:
    default = means.where(F.col(column).isNull()).select("encoded").scalar()
    known = means.where(F.col(column).isNotNull()).withColumnRenamed(column, "_key")
    return df.join(known, F.col(column) == F.col("_key"), "left").withColumn(out or f"{column}_te", F.coalesce("encoded", default)).drop("_key", "encoded")


def frequency_encode(df: DataFrame, column: str, train: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """Adds each value's share of the non-null training values; unseen values and null get 0."""
    base = (df if train is None else train).where(F.col(column).isNotNull())
    total = base.agg(F.count("*").alias("n")).select("n").scalar()
    shares = base.groupBy(F.col(column).alias("_key")).agg((F.count("*") / total).alias("_share"))
    return df.join(shares, F.col(column) == F.col("_key"), "left").withColumn(out or f"{column}_freq", F.coalesce("_share", F.lit(0.0))).drop("_key", "_share")


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): codes from 0 in the order of the values; null is `__MISSING__`."""
    values = df.select(F.coalesce(F.col(column).cast("string"), F.lit("__MISSING__")).alias("value")).distinct()
    return positions(values, None, "value", "code").withColumn("code", F.col("code").cast("int"))


def label_encode(df: DataFrame, codes: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Adds the code; -1 for values without one."""
    rows = df.withColumn("_value", F.coalesce(F.col(column).cast("string"), F.lit("__MISSING__"))).join(codes.select(F.col("value").alias("_key"), F.col("code").alias("_code")), F.col("_value") == F.col("_key"), "left")
    return rows.withColumn(out or f"{column}_code", F.coalesce("_code", F.lit(-1))).drop("_value", "_key", "_code")


# --- row statistics and preprocessing --------------------------------------------------------------------------------


def row_statistics(*columns: Column) -> dict[str, Column]:
    """Sum, mean, sample deviation and adjusted skewness over a row's values that are not null; 0 where undefined.

    Plain arithmetic over the columns, so that it is compiled and common parts are computed once.
    """
    values = [F.nanvl(c.cast("double"), F.lit(None)) for c in columns]

    def over(parts: list[Column]) -> Column:
        out = F.lit(0.0)
        for part in parts:
            out = out + F.coalesce(part, F.lit(0.0))
        return out

    n = over([v.isNotNull().cast("double") for v in values])
    total = over(values)
    mean = total / F.nullif(n, F.lit(0.0))
    m2, m3 = (over([F.pow(v - mean, F.lit(k)) for v in values]) for k in (2.0, 3.0))
    variance = F.nullif(m2 / F.nullif(n, F.lit(0.0)), F.lit(0.0))
    skew = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)) * (m3 / F.nullif(n, F.lit(0.0))) / F.pow(variance, F.lit(1.5))
    return {
        "row_sum": total,
        "row_mean": F.coalesce(mean, F.lit(0.0)),
        "row_std": F.when(n > 1, F.sqrt(m2 / F.nullif(n - 1, F.lit(0.0)))).otherwise(F.lit(0.0)),
        "row_skew": F.when((n > 2) & (variance > 1e-30), skew).otherwise(F.lit(0.0)),
    }


class Preprocessor:
    """Median imputation, optional scaling with the population deviation, label codes and text cleaning.

    fit() keeps the statistics as frames of one row, or one row a category, that can be written and read again.
    """

    def __init__(self, numerical: list[str] = (), categorical: list[str] = (), texts: list[str] = (), scale: bool = False) -> None:
        self.numerical, self.categorical, self.texts, self.scale = list(numerical), list(categorical), list(texts), scale
        self.statistics: DataFrame | None = None
        self.codes: dict[str, DataFrame] = {}

    def fit(self, df: DataFrame) -> Preprocessor:
        if self.numerical:
            medians = df.agg(*[F.median(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in self.numerical])
            filled = df.select(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), medians.select(c).scalar()).alias(c) for c in self.numerical])
            parts = [x for c in self.numerical for x in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))]
            moments = filled.agg(*parts)
            self.statistics = moments.select("*", *[medians.select(c).scalar().alias(f"{c}_median") for c in self.numerical])
        self.codes = {c: label_codes(df, c) for c in self.categorical}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """The fitted columns replaced in place; columns that a frame lacks are skipped."""
        for c in (c for c in self.numerical if c in df.columns):
            value = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), self.statistics.select(f"{c}_median").scalar())
            if self.scale:
                deviation = self.statistics.select(F.when(F.col(f"{c}_std") > 0, F.col(f"{c}_std")).otherwise(F.lit(1.0))).scalar()
                value = (value - self.statistics.select(f"{c}_mean").scalar()) / deviation
            df = df.withColumn(c, value)
        for c in (c for c in self.categorical if c in df.columns):
            columns = df.columns
            df = label_encode(df, self.codes[c], c, "_coded").drop(c).withColumnRenamed("_coded", c).select(*columns)
        return df.withColumns({c: text.clean_text(F.col(c)) for c in self.texts if c in df.columns})

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def running_sums(df: DataFrame, order: str, sums: list[str], buckets: int = 256) -> DataFrame:
    """The rows with `before_<column>`: the sum of a column over all rows whose (numeric) order is smaller. Orders are distinct.

    Rows are dealt into buckets by approximate quantiles; a window runs inside each bucket, and the sums of the buckets
    before it, a table of at most `buckets` + 1 rows, are added. No task sees more than its buckets.
    """
    cuts = sorted(set(df.agg(F.percentile_approx(F.col(order).cast("double"), [k / buckets for k in range(1, buckets)], 10_000)).first()[0] or []))
    bucket = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < F.col(order).cast("double"))) if cuts else F.lit(0)
    rows = df.withColumn("_bucket", F.coalesce(bucket, F.lit(0)))
    totals = rows.groupBy(F.col("_bucket").alias("_of")).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    earlier = Window.partitionBy(F.lit(0)).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_of", *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums])
    inside = Window.partitionBy("_bucket").orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(F.broadcast(offsets), F.col("_bucket") == F.col("_of"))
    return joined.select(*df.columns, *[(F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"before_{c}") for c in sums])


def positions(df: DataFrame, by: str | None, order: str, out: str = "position") -> DataFrame:
    """The rows with their position from 0 in their group (of all rows without `by`), in the order of distinct values.

    Rows are cut into ranges of the order and written with the number of their range; the sizes of the ranges before are
    added to the position within a range, so no task orders a whole group.
    """
    group = F.col(by) if by else F.lit(0)
    ranged = storage.written(df.withColumn("_g", F.struct(group.alias("v"))).repartitionByRange("_g", order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_g", "_part").agg(F.count("*").alias("_k"))
    earlier = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_g", "_part", F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_g", "_part").orderBy(order)) - 1
    return ranged.join(before, ["_g", "_part"]).select(*df.columns, (F.col("_before") + nth).alias(out))


# --- ranks and metrics -----------------------------------------------------------------------------------------------


def percentile_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds <column>_rank in [0, 1], ties sharing their mean rank; 0 in a frame of one row.

    Ranks come from counts of distinct values and running_sums(), so no task orders all rows.
    """
    n = df.agg(F.count("*").alias("n")).select("n").scalar()
    for c in columns:
        counts = df.groupBy(F.col(c).alias("_v")).agg(F.count("*").alias("_k"))
        ranks = running_sums(counts, "_v", ["_k"]).select("_v", ((F.col("before__k") + (F.col("_k") - 1) / 2) / F.greatest(n - 1, F.lit(1))).alias(f"{c}_rank"))
        df = df.join(ranks, F.col(c).eqNullSafe(F.col("_v")), "left").drop("_v")
    return df


def rank_average(df: DataFrame, columns: list[str], weights: list[float] | None = None, out: str = "rank_average") -> DataFrame:
    """Adds the weighted mean of the percentile ranks; weights are normalised to 1."""
    weights = [1.0] * len(columns) if weights is None else list(weights)
    if len(weights) != len(columns):
        raise ValueError(f"{len(weights)} weights for {len(columns)} columns")
    total = F.lit(0.0)
    for c, w in zip(columns, weights):
        total = total + F.col(f"{c}_rank") * F.lit(w / sum(weights))
    ranked = percentile_ranks(df, columns)
    return ranked.withColumn(out, total).drop(*[f"{c}_rank" for c in columns])


def _f1_values(df: DataFrame, y: str, p: str, averages: list[str]) -> DataFrame:
    """One row with a column for each average of the classes' F1."""
    sides = df.select(F.explode(F.array_distinct(F.array(F.col(y), F.col(p)))).alias("c"), (F.col(y) == F.col(p)).alias("hit"), F.col(y).alias("y"), F.col(p).alias("p"))
    counts = sides.groupBy("c").agg(F.count_if(F.col("hit")).alias("tp"), F.count_if(F.col("y") == F.col("c")).alias("n"), F.count_if(F.col("p") == F.col("c")).alias("m"))
    f1 = F.when(F.col("n") + F.col("m") > 0, 2.0 * F.col("tp") / (F.col("n") + F.col("m"))).otherwise(F.lit(0.0))
    known = {"f1_macro": F.avg(f1), "f1_weighted": F.sum(f1 * F.col("n")) / F.sum("n"), "f1_micro": 2.0 * F.sum("tp") / (F.sum("n") + F.sum("m"))}
    return counts.agg(*[known[a].alias(a) for a in averages])


def _log_loss(y: Column, p: Column) -> Column:
    clipped = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    return -F.avg(y * F.log(clipped) + (1 - y) * F.log(1 - clipped))


def _auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """By the rank sum over distinct scores; null with one class only."""
    counts = df.groupBy(F.col(p).alias("v")).agg(F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("pos"), F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).alias("neg"))
    return running_sums(counts, "v", ["neg"]).withColumn("won", F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)).agg((F.sum("won") / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("value"))


#: Metrics that are one aggregate over the rows.
ROW_METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "rmse": lambda y, p: F.sqrt(F.avg((y - p) * (y - p))),
    "mse": lambda y, p: F.avg((y - p) * (y - p)),
    "mae": lambda y, p: F.avg(F.abs(y - p)),
    "mape": lambda y, p: F.coalesce(F.avg(F.when(y != 0, F.abs((y - p) / y))) * 100, F.lit(0.0)),
    "smape": lambda y, p: F.coalesce(F.avg(F.when(F.abs(y) + F.abs(p) != 0, 2.0 * F.abs(y - p) / (F.abs(y) + F.abs(p)))) * 100, F.lit(0.0)),
    "accuracy": lambda y, p: F.avg((y == p).cast("double")),
    "log_loss": _log_loss,
}
F1_METRICS = ("f1_macro", "f1_micro", "f1_weighted")
METRICS = (*ROW_METRICS, "roc_auc", *F1_METRICS)


def compute_metrics(df: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """(metric, value) of metrics, each over its columns (truth, prediction): all that are plain aggregates in one pass, F1
    averages over the same columns in one more, AUC in its own."""
    unknown = sorted(set(wanted) - set(METRICS))
    if unknown:
        raise KeyError(f"unknown metric {', '.join(unknown)}; known: {', '.join(sorted(METRICS))}")
    frames = []
    plain = {m: columns for m, columns in wanted.items() if m in ROW_METRICS}
    if plain:
        frames.append(df.agg(*[ROW_METRICS[m](F.col(y).cast("double"), F.col(p).cast("double")).alias(m) for m, (y, p) in plain.items()]))
    by: dict[tuple[str, str], list[str]] = {}
    for m, columns in wanted.items():
        if m in F1_METRICS:
            by.setdefault(columns, []).append(m)
    frames += [_f1_values(df, y, p, averages) for (y, p), averages in by.items()]
    frames += [_auc(df, *wanted["roc_auc"]).withColumnRenamed("value", "roc_auc")] if "roc_auc" in wanted else []
    out = None
    for frame in frames:
        rows = frame.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in frame.columns])).alias("x")).select("x.*")
        out = rows if out is None else out.unionByName(rows)
    return df.sparkSession.createDataFrame([], "metric string, value double") if out is None else out


def get_metric(name: str) -> Callable[[DataFrame, str, str], DataFrame]:
    """A function of (frame, truth, prediction) that gives a row with `value`."""
    key = "_".join(name.strip().lower().split())
    if key not in METRICS:
        raise KeyError(f"unknown metric {name!r}; known: {', '.join(sorted(METRICS))}")
    return lambda df, y, p: compute_metrics(df, {key: (y, p)}).select("value")


def compute_metric(name: str, df: DataFrame, y: str = "y", p: str = "p") -> float | None:
    return get_metric(name)(df, y, p).first()["value"]
