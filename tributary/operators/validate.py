"""Rules over result files. Each rule gives a row: rule, n (violations) and the smallest example."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import text


def _rule(name: str, bad: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("string")
    return bad.agg(F.lit(name).alias("rule"), F.count("*").alias("n"), F.coalesce(F.min(value), F.lit("")).alias("example"))


def id_lists(rows: DataFrame, universe: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rules of a list file (columns s1 and ids, a comma list) against all s1 (column s1) and, if given, all ids (column id)."""
    parts = rows.select(F.col("s1"), F.explode(F.split(F.coalesce("ids", F.lit("")), ",")).alias("id")).select("s1", F.trim("id").alias("id")).where("id <> ''")
    repeated = rows.groupBy("s1").agg(F.count("*").alias("k")).where("k > 1")
    twice = parts.groupBy("s1", "id").agg(F.count("*").alias("k")).where("k > 1").withColumn("pair", F.concat_ws(":", "s1", "id"))
    out = [
        _rule("duplicate_s1", repeated, "s1"),
        _rule("duplicate_id_in_list", twice, "pair"),
        _rule("self_match", parts.where(F.col("id").startswith("S1-")), "id"),
        _rule("wrong_prefix", parts.where(~F.col("id").rlike("^S[123]-")), "id"),
        _rule("missing_s1", universe.select("s1").distinct().join(rows, "s1", "left_anti"), "s1"),
        _rule("extra_s1", rows.select("s1").distinct().join(universe, "s1", "left_anti"), "s1"),
    ]
    if known is not None:
        out.append(_rule("unknown_id", parts.select("id").distinct().join(known, "id", "left_anti"), "id"))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def id_list_file(spark: SparkSession, path: str, header: tuple[str, str], universe: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rules of a tab-separated list file, its header and row format among them. A missing or empty file is one violation."""
    try:
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
        first = lines.first()
    except Exception as error:  # noqa: BLE001 - Spark has one class for all analysis errors
        if "PATH_NOT_FOUND" not in str(error):
            raise
        first = None
    if first is None:
        return spark.createDataFrame([("missing_or_empty_file", 1, path)], "rule string, n long, example string")
    wanted = "\t".join(header)
    # The first line of each file of the folder is its header; it alone is left out of the body, by its place.
    tops = lines.where("block = 0").groupBy("file").agg(F.min(F.struct("at", "value")).alias("top")).select("top.*")
    body = lines.join(tops.select("at"), "at", "left_anti").where("trim(value) <> ''")
    head = tops.where(F.col("value") != wanted)
    rows = body.where(F.col("value").contains("\t")).select(F.trim(F.split("value", "\t")[0]).alias("s1"), F.get(F.split("value", "\t"), F.lit(1)).alias("ids"))
    rules = _rule("header", head, "value").unionByName(_rule("comma_separated", head.where(F.col("value") == ",".join(header)), "value"))
    rules = rules.unionByName(_rule("row_without_tab", body.where(~F.col("value").contains("\t")), "value"))
    return rules.unionByName(id_lists(rows, universe, known))


def matches_within_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """A warning: matched ids (s1, ids) that are not among the candidates (s1, ids)."""
    joined = matches.join(candidates.select("s1", F.col("ids").alias("offered")), "s1", "left")
    outside = F.size(F.array_except(text.split_list(F.col("ids")), text.split_list(F.col("offered")))) > 0
    return _rule("match_not_a_candidate", joined.where(outside), "s1")


def prediction_file(df: DataFrame, id_col: str = "id", prediction_col: str = "prediction", sample: DataFrame | None = None, expected_rows: int | None = None, order_col: str | None = None) -> DataFrame:
    """Rules of a prediction table; with a sample its ids, and with order_col in both its order, must be the same."""
    spark = df.sparkSession
    absent = [c for c in (id_col, prediction_col) if c not in df.columns]
    if absent:
        return spark.createDataFrame([("missing_column", len(absent), absent[0])], "rule string, n long, example string")
    value = F.col(prediction_col)
    number = value.cast("string").try_cast("double")
    out = _rule("null_prediction", df.where(value.isNull() | F.coalesce(F.isnan(number), F.lit(False))), id_col)
    out = out.unionByName(_rule("infinite_prediction", df.where(F.abs(number) == float("inf")), id_col))
    out = out.unionByName(_rule("duplicate_id", df.groupBy(id_col).agg(F.count("*").alias("k")).where("k > 1"), id_col))
    if expected_rows is not None or sample is not None:
        want = F.lit(expected_rows) if expected_rows is not None else sample.agg(F.count("*").alias("n")).select("n").scalar()
        out = out.unionByName(df.agg(F.count("*").alias("k")).select(F.lit("row_count").alias("rule"), F.abs(F.col("k") - want).alias("n"), F.when(F.col("k") != want, F.col("k").cast("string")).otherwise(F.lit("")).alias("example")))
    if sample is not None:
        out = out.unionByName(_rule("missing_id", sample.select(id_col).distinct().join(df, id_col, "left_anti"), id_col))
        if order_col:
            moved = sample.select(F.col(order_col), F.col(id_col).alias("_want")).join(df.select(order_col, id_col), order_col).where(F.col("_want") != F.col(id_col))
            out = out.unionByName(_rule("id_order", moved, id_col))
    return out


def passes(rules: DataFrame) -> bool:
    return rules.where("n > 0").isEmpty()


def gate(rules: DataFrame, warnings: tuple[str, ...] = ("match_not_a_candidate",)) -> None:
    """Raise ValueError with all violated rules, if there are any besides warnings."""
    bad = [r for r in rules.where("n > 0").orderBy("rule").collect() if r["rule"] not in warnings]
    if bad:
        raise ValueError("; ".join(f"{r['rule']}: {r['n']} (such as {r['example']})" for r in bad))
