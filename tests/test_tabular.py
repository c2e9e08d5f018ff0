import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tributary.operators import models, reports, tabular, validate


@pytest.fixture(scope="module")
def frame():
    r = np.random.default_rng(0)
    n = 200
    return pd.DataFrame({"id": range(n), "cat": r.choice(["a", "b", "c", None], n), "y": r.random(n), "fold": r.integers(0, 4, n), "x": np.where(r.random(n) < 0.1, np.nan, r.random(n)), "z": r.integers(0, 5, n)})


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "id long, cat string, y double, fold int, x double, z int")


def test_target_encoding_is_out_of_fold(df, frame):
    got = {r["id"]: r["cat_te"] for r in tabular.target_encode(df, "cat", "y").collect()}
    mean = frame["y"].mean()
    for _, row in frame.iterrows():
        rest = frame[(frame["fold"] != row["fold"]) & (frame["cat"] == row["cat"])]["y"]
        want = (rest.sum() + 10 * mean) / (len(rest) + 10) if row["cat"] is not None and len(rest) else mean
        assert abs(got[row["id"]] - want) < 1e-9


def test_target_means_of_new_rows(spark, df, frame):
    means = tabular.fit_target_means(df, "cat", "y")
    new = spark.createDataFrame([("a",), ("new",), (None,)], "cat string")
    got = {r["cat"]: r["cat_te"] for r in tabular.apply_target_means(new, means, "cat").collect()}
    mean, a = frame["y"].mean(), frame[frame["cat"] == "a"]["y"]
    assert abs(got["new"] - mean) < 1e-9 and abs(got[None] - mean) < 1e-9
    assert abs(got["a"] - (a.sum() + 10 * mean) / (len(a) + 10)) < 1e-9


def test_frequency_and_label_codes(spark, df, frame):
    shares = frame["cat"].value_counts(normalize=True)
    for r in tabular.frequency_encode(df, "cat").select("cat", "cat_freq").distinct().collect():
        assert abs(r["cat_freq"] - shares.get(r["cat"], 0.0)) < 1e-9
    codes = tabular.label_codes(df, "cat")
    new = spark.createDataFrame([("a",), ("c",), ("new",), (None,)], "cat string")
    assert {r["cat"]: r["cat_code"] for r in tabular.label_encode(new, codes, "cat").collect()} == {None: 0, "a": 1, "c": 3, "new": -1}


def test_row_statistics_are_those_of_pandas(spark):
    rows = [(1.0, 2.0, 4.0, 9.0), (None, 1.0, 1.0, 5.0), (None, None, 2.0, 3.0), (None, None, None, 7.0), (None,) * 4, (3.0, 3.0, 3.0, 3.0), (float("nan"), 1.0, 2.0, 9.0)]
    names = list("abcd")
    got = spark.createDataFrame(rows, "a double, b double, c double, d double").select(*[c.alias(k) for k, c in tabular.row_statistics(*map(F.col, names)).items()]).collect()
    want = pd.DataFrame(rows, columns=names)
    for r, w in zip(got, zip(want.sum(axis=1), want.mean(axis=1).fillna(0), want.std(axis=1).fillna(0), want.skew(axis=1).fillna(0))):
        assert np.allclose(list(r), w)


def test_preprocessor(spark, df, frame):
    p = tabular.Preprocessor(["x", "absent"][:1], ["cat"], ["cat2"], scale=True)
    got = p.fit_transform(df).orderBy("id").toPandas()
    filled = frame["x"].fillna(frame["x"].median())
    assert np.allclose(got["x"], (filled - filled.mean()) / filled.std(ddof=0))
    assert got.columns.tolist() == df.columns and set(got["cat"]) == {0, 1, 2, 3}
    other = p.transform(spark.createDataFrame([(1, "zzz", None)], "id int, cat string, x double")).first()
    assert other["cat"] == -1 and abs(other["x"] - (frame["x"].median() - filled.mean()) / filled.std(ddof=0)) < 1e-9


def test_rank_average_shares_ties(spark):
    df = spark.createDataFrame([(1, 10.0, 1.0), (2, 10.0, 2.0), (3, 30.0, 3.0)], "id int, a double, b double")
    got = {r["id"]: r["rank_average"] for r in tabular.rank_average(df, ["a", "b"]).collect()}
    assert got == {1: 0.125, 2: 0.375, 3: 1.0}
    assert tabular.rank_average(df.limit(1), ["a"]).first()["rank_average"] == 0
    with pytest.raises(ValueError):
        tabular.rank_average(df, ["a", "b"], [1])


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.2), (1.0, 0.2), (0.0, 0.1)], "y double, p double")
    assert tabular.compute_metric("ROC AUC", df) == (1 + 1 + 0.5 + 1) / 4
    assert abs(tabular.compute_metric("log_loss", df) + (math.log(0.9) + math.log(0.8) + math.log(0.2) + math.log(0.9)) / 4) < 1e-9
    zeros = spark.createDataFrame([(0.0, 0.0)], "y double, p double")
    assert tabular.compute_metric("smape", zeros) == tabular.compute_metric("mape", zeros) == 0
    labels = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "y string, p string")
    assert abs(tabular.compute_metric("f1_macro", labels) - (0.5 + 2 / 3 + 0) / 3) < 1e-9
    assert tabular.compute_metric("f1_micro", labels) == 0.5
    with pytest.raises(KeyError, match="rmse"):
        tabular.get_metric("nope")


def test_models_folds_and_blending(spark):
    r = np.random.default_rng(1)
    x = r.random((240, 2))
    rows = [(k, float(a), float(b), int(a > 0.5)) for k, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, label int")
    cv = models.CrossValidation(lambda: models.TreeModel(["a", "b"], "forest", numTrees=5, maxDepth=3), "roc_auc", 3)
    oof = cv.fit(df, "label", "id", stratify="label")
    assert oof.count() == 240 and cv.score > 0.95 and len(cv.fold_scores) == 3
    assert cv.predict(df.drop("label")).count() == 240
    assert next(iter(cv.models[0].importances())) == "a"
    both = oof.withColumn("bad", F.lit(0.5) + F.col("b") / 10).withColumn("y", F.col("label"))
    blender = models.Blender("log_loss").fit(both, ["oof", "bad"])
    assert abs(sum(blender.weights.values()) - 1) < 1e-9 and blender.weights["oof"] > 0.5
    assert models.stack(both, ["oof", "bad"], "label").score(both).count() == 240


def test_model_is_saved(spark, tmp_path):
    df = spark.createDataFrame([(float(k), float(k % 2)) for k in range(40)], "a double, label double")
    model = models.TreeModel(["a"], "linear").fit(df)
    model.save(str(tmp_path / "m"))
    again = models.TreeModel(["a"], "linear").load(str(tmp_path / "m"))
    assert again.score(df).collect() == model.score(df).collect()
    with pytest.raises(KeyError):
        models.TreeModel(["a"], "none")


def test_admission(spark):
    p = [0.05, 0.12, 0.85, 0.11, 0.40, 0.95, 0.20, 0.15, 0.60, 0.30]
    df = spark.createDataFrame([("S1-1", f"C{k + 1}", v, k) for k, v in enumerate(p)], "s1 string, cand string, p_gbdt double, rank int")
    assert [r["cand"] for r in models.admit(df, 0.12, 5).orderBy(F.desc("p_gbdt")).collect()] == ["C6", "C3", "C9", "C5", "C10"]
    assert models.admit(df.drop("p_gbdt")).collect() == []


def test_text_components(spark):
    df = spark.createDataFrame([(k, "red apple pie" if k % 2 else "blue sky above") for k in range(20)], "id int, t string")
    got = models.TextFeatures(50, 2).fit(df, "t").transform(df, "t").collect()
    first = {tuple(round(abs(r[f"tfidf_svd_{k}"]), 4) for k in range(2)) for r in got}
    assert len(first) == 2


def test_validation(spark, tmp_path):
    universe = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "s1 string")
    rows = spark.createDataFrame([("S1-1", "S2-1,S2-1,S1-9"), ("S1-2", "X-1"), ("S1-2", ""), ("S1-8", None)], "s1 string, ids string")
    known = spark.createDataFrame([("S2-1",)], "id string")
    got = {r["rule"]: r["n"] for r in validate.id_lists(rows, universe, known).collect()}
    assert got == {"duplicate_s1": 1, "duplicate_id_in_list": 1, "self_match": 1, "wrong_prefix": 1, "missing_s1": 1, "extra_s1": 1, "unknown_id": 2}
    (tmp_path / "f.tsv").write_text("source1_entity_id,ids\nS1-1\tS2-1\nS1-2\n")
    got = {r["rule"]: r["n"] for r in validate.id_list_file(spark, str(tmp_path / "f.tsv"), ("source1_entity_id", "ids"), universe).collect()}
    assert got["header"] == got["comma_separated"] == got["row_without_tab"] == 1 and got["missing_s1"] == 2
    assert validate.id_list_file(spark, str(tmp_path / "none.tsv"), ("a", "b"), universe).first()["rule"] == "missing_or_empty_file"
    outside = validate.matches_within_candidates(spark.createDataFrame([("S1-1", "S2-1,S2-2")], "s1 string, ids string"), spark.createDataFrame([("S1-1", "S2-1")], "s1 string, ids string"))
    assert outside.first()["n"] == 1 and not validate.passes(outside)


def test_prediction_rules(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None), (2, float("inf")), (4, 1.0)], "id int, prediction double")
    sample = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 0.0)], "id int, prediction double")
    got = {r["rule"]: r["n"] for r in validate.prediction_file(df, sample=sample).collect()}
    assert got == {"null_prediction": 1, "infinite_prediction": 1, "duplicate_id": 1, "row_count": 1, "missing_id": 1}
    assert validate.prediction_file(df.drop("prediction")).first()["rule"] == "missing_column"


def test_reports(spark):
    lists = spark.createDataFrame([("S1-1", "a,b"), ("S1-2", ""), ("S1-3", "b")], "source1_entity_id string, matched_entity_ids string")
    universe = spark.createDataFrame([("S1-1", "US"), ("S1-2", "US"), ("S1-3", "FR"), ("S1-4", "FR")], "s1 string, country string")
    got = {r["country"]: (r["total"], r["matched"], r["singletons"], r["match_ratio"]) for r in reports.partition_summary(lists, universe).collect()}
    assert got == {"US": (2, 1, 1, 50.0), "FR": (2, 1, 1, 50.0)}
    assert tuple(reports.match_profile(lists).first()) == (3, 3, 1.0, 1 / 3)
    assert tuple(reports.target_collisions(lists).first()) == (2, 1, 0.5)


def test_ensemble_is_saved_with_its_thresholds(spark, tmp_path):
    df = spark.createDataFrame([(float(k), float(k % 3), int(k % 3 > 1)) for k in range(60)], "a double, b double, label int")
    model = models.Ensemble(["a", "b"], ("forest", "linear"), {"forest": 3, "linear": 1}, options={"forest": {"numTrees": 3}}).fit(df)
    limits = spark.createDataFrame([("US", 0.6)], "country string, tau double")
    model.save(str(tmp_path / "e"), limits)
    again, kept = models.Ensemble.load(str(tmp_path / "e"), ["a", "b"])
    assert again.score(df).collect() == model.score(df).collect() and kept.collect() == limits.collect()
    assert model.weights == {"forest": 0.75, "linear": 0.25}


def test_learned_pair_scorer(spark, tmp_path):
    rows = [(f"acme tools {k}", f"acme tool {k}", 1) for k in range(20)] + [(f"acme tools {k}", f"zebra shop {k + 7}", 0) for k in range(20)] + [(None, "", 0)]
    df = spark.createDataFrame(rows, "text_a string, text_b string, label int")
    scorer = models.LearnedPairScorer().fit(df)
    got = scorer.score(df)
    assert got.columns == [*df.columns, "p_ce"]
    assert all((r["p_ce"] > 0.5) == bool(r["label"]) for r in got.collect())
    scorer.save(str(tmp_path / "s"))
    assert models.LearnedPairScorer().load(str(tmp_path / "s")).score(df).collect() == got.collect()


def test_weighted_pairs_are_repeated_pairs(spark, tmp_path):
    rows = [("acme tools", "acme tools", 1, 900), ("beta shop", "beta shops", 1, 3), ("acme tools", "acme shop", 0, 40), ("gamma", "acme tools", 0, 7), ("gamma", "gamma ray", 0, 1)]
    df = spark.createDataFrame(rows, "text_a string, text_b string, label int, n bigint")
    weighted = models.LearnedPairScorer().fit(df, weight="n")
    repeated = models.LearnedPairScorer().fit(df.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))))
    p, q = ({r["text_a"] + r["text_b"]: r["p_ce"] for r in m.score(df).collect()} for m in (weighted, repeated))
    assert all(abs(p[k] - q[k]) < 1e-4 for k in p)
    weighted.save(str(tmp_path / "s"))
    assert models.LearnedPairScorer().load(str(tmp_path / "s")).score(df).collect() == weighted.score(df).collect()


def test_true_pairs_are_scored_by_class(spark, tmp_path):
    """Equal names make true pairs by the square of their number; rows of the result grow with the records."""
    from tributary.plans import queries

    page = lambda k, title: (k, f"http://h{k}.org/{k}", f'<html lang="en"><title>{title}</title>{"x" * (7 * k)}</html>')
    rows = [page(k, "same title here") for k in range(90)] + [page(90 + k, f"title number {k % 7} {'abc' * (k % 5)}") for k in range(60)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = queries.learned_pair_scorer(spark, str(tmp_path)).collect()
    expanded = {(r["s1"], r["cand"]): r["p_ce"] for r in found if r["class_id"] is None}
    own, others = [r for r in found if r["cand"] is None], [r for r in found if r["s1"] is None]
    assert len(own) + len(others) <= len(rows)
    linked = [(a, b) for a in own for b in others if a["class_id"] == b["class_id"]]
    assert all(sum(x["s1"] == a["s1"] for x, _ in linked) == a["n_links"] for a in own) and all(sum(x["cand"] == b["cand"] for _, x in linked) == b["n_links"] for b in others)
    expanded |= {(a["s1"], b["cand"]): a["p_ce"] for a, b in linked}
    pairs = queries.training_pairs(spark, str(tmp_path))
    s1, targets = queries.sides(queries.records(spark, str(tmp_path)))
    pairs = pairs.join(s1.select(F.col("entity_id").alias("s1"), F.col("business_name").alias("text_a")), "s1").join(targets.select(F.col("entity_id").alias("cand"), F.col("business_name").alias("text_b")), "cand")
    want = {(r["s1"], r["cand"]): r["p_ce"] for r in models.LearnedPairScorer().fit(pairs).score(pairs).collect()}
    assert expanded.keys() == want.keys() and len(want) > len(rows) * 5
    assert all(abs(expanded[k] - want[k]) < 1e-3 for k in want)


def test_gate_and_cached_frames(spark, tmp_path):
    from tributary.sources import files

    rules = spark.createDataFrame([("header", 0, ""), ("match_not_a_candidate", 3, "x")], "rule string, n long, example string")
    validate.gate(rules)
    with pytest.raises(ValueError, match="extra_s1: 2"):
        validate.gate(rules.union(spark.createDataFrame([("extra_s1", 2, "S1-9")], rules.schema)))
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    for _ in range(2):
        assert files.cached(spark, str(tmp_path / "c"), build).count() == 3
    assert len(built) == 1


def test_running_sums_over_buckets(spark):
    rows = [(None, 2)] + [(float(k * k), k % 5) for k in range(-1, 300) if k]
    df = spark.createDataFrame(rows, "v double, n long").dropDuplicates(["v"]).repartition(4)
    values = df.toPandas()
    for buckets in (1, 7, 256):
        for r in tabular.running_sums(df, "v", ["n"], buckets).collect():
            smaller = 0 if r["v"] is None else values[values["v"].isna() | (values["v"] < r["v"])]["n"].sum()
            assert r["before_n"] == smaller
