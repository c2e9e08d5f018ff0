"""Registered queries that write files and read them back, check files against rules, and choose records; and their SQL."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions import text
from tributary.operators import assign, mining, validate
from tributary.plans import linkage
from tributary.sources import files, storage


def _table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _records(spark, sf_dir) -> DataFrame:
    return linkage.records_of_pages(spark, sf_dir)


def _truth(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Records of the first source, and pairs of them with targets of the same name."""
    rows = _records(spark, sf_dir).select("entity_id", "business_name", "country")
    s1 = rows.where(F.col("entity_id").startswith("S1-")).withColumnRenamed("entity_id", "s1")
    targets = rows.where(~F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("cand"), "business_name")
    return s1, s1.join(targets, "business_name").select("s1", "cand").distinct()


def _lists(spark, sf_dir) -> DataFrame:
    s1, pairs = _truth(spark, sf_dir)
    ranked = pairs.select("s1", "cand", F.row_number().over(mining.Window.partitionBy("s1").orderBy("cand")).alias("rank"))
    return assign.match_lists(ranked, s1)


def record_file(spark, sf_dir):
    """Records with nulls, as a tab-separated file."""
    path = storage.scratch(spark, "records")
    named = F.when(F.regexp_extract("entity_id", "([0-9]+)$", 1).cast("bigint") % 7 != 0, F.col("business_name"))
    files.write_tsv(_records(spark, sf_dir).withColumn("business_name", named), path)
    return files.read_records(spark, path).unionByName(files.read_records(spark, f"{path}-missing", optional=True))


def id_file(spark, sf_dir):
    """The ids of a file's first column: trimmed, distinct, none empty."""
    path = storage.scratch(spark, "ids")
    ids = _table(spark, sf_dir, "orders").select(F.when(F.col("o_custkey") % 5 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" S1-"), "o_custkey")).alias("id"), "o_orderstatus")
    files.write_tsv(ids, path)
    return files.read_ids(spark, path)


def truth_file(spark, sf_dir):
    path = storage.scratch(spark, "truth")
    files.write_matches(_lists(spark, sf_dir), path)
    return files.read_truth(spark, path).select("s1", F.size("cands").cast("bigint").alias("n"), F.array_join("cands", ",").alias("cands"))


def scored_file(spark, sf_dir):
    """Scored pairs as Parquet by country; one country's folder and two columns are read."""
    path = storage.scratch(spark, "scored")
    rows = _table(spark, sf_dir, "orders").select(F.concat(F.lit("S1-"), "o_custkey").alias("s1"), F.concat(F.lit("S2-"), "o_orderkey").alias("cand"), (F.col("o_totalprice") / 1e6).alias("p"), F.col("o_orderstatus").alias("country"))
    files.write_scored(rows, path)
    return files.read_scored(spark, path, "F").select("cand", F.round("p", 6).alias("p"))


def prediction_table(spark, sf_dir):
    path = files.write_predictions(_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") / 4).alias("prediction")), storage.scratch(spark, "predictions"))
    return files.read_table(spark, path, ("id", "prediction")).select(F.col("id").cast("bigint").alias("id"), "prediction")


def csv_table(spark, sf_dir):
    """A CSV with a header, types inferred."""
    path = storage.scratch(spark, "nation") + ".csv"
    _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").write.options(header=True).csv(path)
    found = files.read_table(spark, path, ("c_custkey",))
    return found.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_acctbal", "c_mktsegment")


def competition_tables(spark, sf_dir):
    """Train and test tables of a configuration, one CSV and one Parquet."""
    base = storage.scratch(spark, "competition")
    rows = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_retailprice").alias("price"))
    rows.where("key % 4 <> 0").write.options(header=True).csv(f"{base}/train.csv")
    rows.where("key % 4 = 0").select("key").write.parquet(f"{base}/test.parquet")
    config = files.Config.of({"paths": {"train": f"{base}/train.csv", "test": f"{base}/test.parquet"}, "columns": {"id": "key", "target": "price"}, "unknown": 1})
    train, test = files.load_competition(spark, config)
    kinds = train.select(F.lit("train").alias("part"), F.col("key").cast("bigint").alias("key"), "price")
    return kinds.unionByName(test.select(F.lit("test").alias("part"), "key", F.lit(None).cast("double").alias("price")))


def cached_features(spark, sf_dir):
    """A feature table that is built at the first call and read at the second."""
    path = storage.scratch(spark, "features")
    build = lambda: _table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    files.cached(spark, path, build)

    def never() -> DataFrame:
        raise AssertionError("built twice")

    return files.cached(spark, path, never)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        for content in batch.column(0):
            rows = []
            with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                for info in archive.infolist():
                    with archive.open(info) as member:
                        rows.append((info.filename, info.file_size, hashlib.file_digest(member, "md5").hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["name", "size", "md5"])


def package_file(spark, sf_dir):
    """A package of two list files: members, sizes and digests of the zip as it lies in the store."""
    base = storage.scratch(spark, "package")
    lists = _lists(spark, sf_dir)
    files.write_tsv(lists, f"{base}/matches", order_by="source1_entity_id", single_file=True)
    files.write_tsv(lists.select("source1_entity_id"), f"{base}/ids", header=False, order_by="source1_entity_id", single_file=True)
    files.zip_files(spark, {"output/matching_results.tsv": f"{base}/matches", "output/ids.tsv": f"{base}/ids"}, f"{base}/package.zip")
    return spark.read.format("binaryFile").load(f"{base}/package.zip").select("content").mapInArrow(_members, "name string, size bigint, md5 string")


def run_ledger(spark, sf_dir):
    """A run a region, each saved twice: the second replaces the first."""
    ledger = files.Ledger(storage.scratch(spark, "ledger") + ".json", spark)
    for row in _table(spark, sf_dir, "region").orderBy("r_regionkey").collect():
        for share in (0.5, row["r_regionkey"] / 10):
            run = files.Run(ledger, row["r_name"], {"k": 25}, run_id=f"run-{row['r_regionkey']}")
            run.log_metrics(macro_f05=share)
            run.end()
    return ledger.frame(spark).select("run_id", "run_name", F.round(F.col("metrics")["macro_f05"], 6).alias("macro_f05"), F.col("params")["k"].alias("k"), "status")


def list_file_rules(spark, sf_dir):
    """A list file of several parts with a wrong row, repeated rows, foreign ids and missing records, held against all rules."""
    path = storage.scratch(spark, "list")
    orders = _table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0")
    ids = F.concat_ws(",", F.concat(F.lit("S2-"), F.col("o_orderkey") % 40), F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("S1-"), F.col("o_orderkey") % 7)), F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("S2-"), F.col("o_orderkey") % 40)), F.when(F.col("o_orderkey") % 13 == 0, F.lit("X9")))
    files.write_tsv(orders.select(F.concat(F.lit("S1-"), "o_custkey").alias("source1_entity_id"), ids.alias("candidate_entity_ids")).repartition(3), path)
    bare = orders.where("o_orderkey % 100 = 0").select(F.concat(F.lit("S1-"), "o_custkey").alias("value"))
    spark.createDataFrame([("source1_entity_id\tcandidate_entity_ids",)], "value string").coalesce(1).unionByName(bare).coalesce(1).write.mode("append").text(path)
    everyone = _table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("S1-"), "c_custkey").alias("s1"))
    known = spark.range(0, 30).select(F.concat(F.lit("S2-"), "id").alias("id"))
    return validate.id_list_file(spark, path, ("source1_entity_id", "candidate_entity_ids"), everyone, known).select("rule", "n")


def pair_rules(spark, sf_dir):
    """Matches that are no candidates."""
    rows = _table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("s1")).agg(F.sort_array(F.collect_set(F.col("o_orderkey").cast("string"))).alias("x"))
    matches, candidates = rows.select("s1", F.array_join("x", ",").alias("ids")), rows.select("s1", F.array_join(F.filter("x", lambda v: v.cast("bigint") % 9 != 0), ", ").alias("ids"))
    return validate.matches_within_candidates(matches, candidates)


def prediction_rules(spark, sf_dir):
    """Predictions with nulls, infinities, repeated and missing ids, against a sample."""
    part = _table(spark, sf_dir, "part")
    value = F.when(F.col("p_partkey") % 17 == 0, F.lit(None)).when(F.col("p_partkey") % 23 == 0, F.lit(float("inf"))).when(F.col("p_partkey") % 29 == 0, F.lit(float("nan"))).otherwise(F.col("p_retailprice"))
    rows = part.where("p_partkey % 5 <> 1").select(F.when(F.col("p_partkey") % 31 == 0, F.lit(0)).otherwise(F.col("p_partkey")).alias("id"), value.alias("prediction"))
    return validate.prediction_file(rows, sample=part.select(F.col("p_partkey").alias("id"))).select("rule", "n")


def chosen_records(spark, sf_dir):
    """Records of two countries, by their place in the order of ids."""
    s1, _ = _truth(spark, sf_dir)
    options = linkage.Options(countries=("en", "fr"), first_record=3, last_record=40)
    return linkage.chosen(s1.withColumnRenamed("s1", "entity_id"), options).select("entity_id", "country")


def kept_first(spark, sf_dir):
    """A union in which the first frame that has a key wins."""
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    frames = [orders.where("o_orderkey % 3 = 2"), orders.where("o_orderkey % 3 = 1"), orders]
    return mining.keep_first(frames, ["o_custkey"]).select("o_custkey", "o_orderkey")


def united_targets(spark, sf_dir):
    rows = _records(spark, sf_dir)
    return linkage.targets_of(rows.where("entity_id like 'S2-%'"), rows.where("entity_id like 'S3-%'")).select("entity_id", text.null_to(F.col("country"), default="").alias("country"))


def group_split(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), (F.col("o_totalprice") > 250_000).cast("int").alias("label"))
    return mining.group_split(rows, "o_custkey").select("o_orderkey", "is_validation")


QUERIES = {f.__name__: f for f in (record_file, id_file, truth_file, scored_file, prediction_table, csv_table, competition_tables, cached_features, package_file, run_ledger, list_file_rules, pair_rules, prediction_rules, chosen_records, kept_first, united_targets, group_split)}


def sql(prepared: str, t1: str, scored: str, truth: str, entities: str) -> dict[str, str]:
    lists = f"{entities}, {truth}, lists AS (SELECT entity_id AS s1, coalesce(string_agg(cand, ',' ORDER BY cand), '') AS ids, count(cand) AS n FROM ent LEFT JOIN pairs_true ON entity_id = s1 WHERE entity_id LIKE 'S1-%' GROUP BY 1)"
    return {
        "record_file": f"WITH {entities} SELECT entity_id, CASE WHEN CAST(regexp_extract(entity_id, '([0-9]+)$', 1) AS BIGINT) % 7 <> 0 THEN business_name ELSE '' END AS business_name, business_address, country FROM ent",
        "id_file": "SELECT DISTINCT 'S1-' || CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE o_custkey % 5 <> 0",
        "truth_file": f"WITH {lists} SELECT s1, n, ids AS cands FROM lists",
        "scored_file": "SELECT 'S2-' || CAST(o_orderkey AS VARCHAR) AS cand, round(o_totalprice / 1e6, 6) AS p FROM orders WHERE o_orderstatus = 'F'",
        "prediction_table": "SELECT p_partkey AS id, p_size / 4.0::DOUBLE AS prediction FROM part",
        "csv_table": "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
        "competition_tables": "SELECT CASE WHEN p_partkey % 4 <> 0 THEN 'train' ELSE 'test' END AS part, p_partkey AS key, CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS price FROM part",
        "cached_features": "SELECT l_suppkey, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY l_suppkey",
        "package_file": f"""WITH {lists}, m AS (SELECT 'source1_entity_id' || chr(9) || 'matched_entity_ids' || chr(10) || string_agg(s1 || chr(9) || ids || chr(10), '' ORDER BY s1) AS body FROM lists), i AS (SELECT string_agg(s1 || chr(10), '' ORDER BY s1) AS body FROM lists)
          SELECT 'output/matching_results.tsv' AS name, strlen(body) AS size, md5(body) AS md5 FROM m UNION ALL SELECT 'output/ids.tsv', strlen(body), md5(body) FROM i""",
        "run_ledger": "SELECT 'run-' || CAST(r_regionkey AS VARCHAR) AS run_id, r_name AS run_name, round(r_regionkey / 10, 6) AS macro_f05, '25' AS k, 'finished' AS status FROM region",
        "list_file_rules": """WITH o AS (SELECT * FROM orders WHERE o_orderkey % 3 = 0), l AS (SELECT o_orderkey, 'S1-' || CAST(o_custkey AS VARCHAR) AS s1, list_filter(['S2-' || CAST(o_orderkey % 40 AS VARCHAR), CASE WHEN o_orderkey % 5 = 0 THEN 'S1-' || CAST(o_orderkey % 7 AS VARCHAR) END, CASE WHEN o_orderkey % 11 = 0 THEN 'S2-' || CAST(o_orderkey % 40 AS VARCHAR) END, CASE WHEN o_orderkey % 13 = 0 THEN 'X9' END], lambda x: x IS NOT NULL) AS ids FROM o
          ), p AS (SELECT s1, unnest(ids) AS id FROM l), d AS (SELECT s1, id FROM p GROUP BY ALL HAVING count(*) > 1), u AS (SELECT 'S1-' || CAST(c_custkey AS VARCHAR) AS s1 FROM customer WHERE c_custkey % 2 = 0)
          SELECT 'header' AS rule, 0::BIGINT AS n UNION ALL SELECT 'comma_separated', 0 UNION ALL SELECT 'row_without_tab', count(*) FROM o WHERE o_orderkey % 100 = 0
          UNION ALL SELECT 'duplicate_s1', count(*) FROM (SELECT s1 FROM l GROUP BY s1 HAVING count(*) > 1) UNION ALL SELECT 'duplicate_id_in_list', count(*) FROM d UNION ALL SELECT 'self_match', count(*) FROM p WHERE id LIKE 'S1-%' UNION ALL SELECT 'wrong_prefix', count(*) FROM p WHERE NOT regexp_matches(id, '^S[123]-')
          UNION ALL SELECT 'missing_s1', count(*) FROM u WHERE s1 NOT IN (SELECT s1 FROM l) UNION ALL SELECT 'extra_s1', count(DISTINCT s1) FROM l WHERE s1 NOT IN (SELECT s1 FROM u) UNION ALL SELECT 'unknown_id', count(DISTINCT id) FROM p WHERE id NOT IN (SELECT 'S2-' || CAST(x AS VARCHAR) FROM range(30) r(x))""",
        "pair_rules": "SELECT 'match_not_a_candidate' AS rule, count(*) AS n, coalesce(min(s1), '') AS example FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS s1 FROM orders WHERE o_orderkey % 9 = 0)",
        "prediction_rules": """WITH r AS (SELECT CASE WHEN p_partkey % 31 = 0 THEN 0 ELSE p_partkey END AS id, CASE WHEN p_partkey % 17 = 0 THEN 'null' WHEN p_partkey % 23 = 0 THEN 'infinite' WHEN p_partkey % 29 = 0 THEN 'null' ELSE 'good' END AS kind FROM part WHERE p_partkey % 5 <> 1)
          SELECT 'null_prediction' AS rule, count(*) AS n FROM r WHERE kind = 'null' UNION ALL SELECT 'infinite_prediction', count(*) FROM r WHERE kind = 'infinite' UNION ALL SELECT 'duplicate_id', count(*) FROM (SELECT id FROM r GROUP BY id HAVING count(*) > 1)
          UNION ALL SELECT 'row_count', (SELECT count(*) FROM part) - (SELECT count(*) FROM r) UNION ALL SELECT 'missing_id', count(*) FROM part WHERE p_partkey NOT IN (SELECT id FROM r)""",
        "chosen_records": f"WITH {entities} SELECT entity_id, country FROM ent WHERE entity_id LIKE 'S1-%' AND country IN ('en', 'fr') QUALIFY row_number() OVER (PARTITION BY country ORDER BY entity_id) BETWEEN 4 AND 40",
        "kept_first": "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderkey % 3 WHEN 2 THEN 0 WHEN 1 THEN 1 ELSE 2 END, o_orderkey) = 1",
        "united_targets": f"WITH {entities} SELECT entity_id, country FROM ent WHERE entity_id NOT LIKE 'S1-%'",
        "group_split": "SELECT o_orderkey, CAST('0x' || substr(md5('42:' || CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0 AS is_validation FROM orders",
    }
