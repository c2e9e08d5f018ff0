import json
import os
import zipfile

import pytest

from tributary.sources import files
from tributary.streaming import arrivals


def lines(path):
    return [x for part in sorted(path.glob("part-*")) for x in part.read_text().splitlines()]


def test_records_and_reader_nulls(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-1\tNA\t\tUS\nS2-2\tnull shop\tN/A\tFrance\n")
    rows = files.read_records(spark, str(tmp_path / "r.tsv")).collect()
    assert [tuple(r) for r in rows] == [("S2-1", "", "", "US"), ("S2-2", "null shop", "", "France")]
    assert files.read_records(spark, str(tmp_path / "none.tsv"), optional=True).collect() == []
    assert {r["id"] for r in files.read_ids(spark, str(tmp_path / "r.tsv")).collect()} == {"S2-1", "S2-2"}


def test_truth(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2,\nS1-2\t\nS1-3\tNone\n")
    truth = files.read_truth(spark, str(tmp_path / "t.tsv"))
    assert {r["s1"]: r["cands"] for r in truth.collect()} == {"S1-1": ["S2-1", "S3-2"], "S1-2": [], "S1-3": []}
    assert files.truth_pairs(truth).count() == 2


def test_written_lists_have_no_quotes(spark, tmp_path):
    df = spark.createDataFrame([("S1-2", ""), ("S1-1", "S2-9,S2-1")], "source1_entity_id string, candidate_entity_ids string").coalesce(1)
    files.write_candidates(df, str(tmp_path / "c"))
    assert [x for x in lines(tmp_path / "c") if not x.startswith("source1")] == ["S1-1\tS2-9,S2-1", "S1-2\t"]
    files.write_matches(df.withColumnRenamed("candidate_entity_ids", "matched_entity_ids"), str(tmp_path / "m"))
    files.write_matches(df.withColumnRenamed("candidate_entity_ids", "matched_entity_ids"), str(tmp_path / "m"), append=True, header=False)
    assert len([x for x in lines(tmp_path / "m") if x.startswith("S1-1\t")]) == 2
    files.zip_files(spark, {"matching_results.tsv": str(tmp_path / "m"), "candidate_pairs.tsv": str(tmp_path / "c")}, str(tmp_path / "out.zip"))
    assert sorted(zipfile.ZipFile(tmp_path / "out.zip").namelist()) == ["candidate_pairs.tsv", "matching_results.tsv"]
    with pytest.raises(FileNotFoundError):
        files.zip_files(spark, {"x": str(tmp_path / "absent")}, str(tmp_path / "y.zip"))


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5)], "id int, target double")
    df.write.parquet(str(tmp_path / "a.parquet"))
    df.write.options(header=True).csv(str(tmp_path / "a.csv"))
    train, test = files.load_competition(spark, str(tmp_path / "a.parquet"), str(tmp_path / "a.csv"), "id", "target")
    assert train.collect() == test.collect()
    with pytest.raises(ValueError):
        files.read_table(spark, str(tmp_path / "a.csv"), ("absent",))
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, str(tmp_path / "none.csv"))
    assert files.write_predictions(df.selectExpr("id", "target AS prediction"), str(tmp_path), "m").startswith(str(tmp_path))


def test_scored_pairs_by_country(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", "S2-1", 0.5, "US"), ("S1-2", "S2-2", 0.6, "FR")], "source1_id string, candidate_id string, prob double, country string")
    files.write_scored(df, str(tmp_path / "s"))
    assert [r["source1_id"] for r in files.read_scored(spark, str(tmp_path / "s"), "FR").collect()] == ["S1-2"]


def test_package(spark, tmp_path):
    (tmp_path / "code" / "__pycache__").mkdir(parents=True)
    (tmp_path / "code" / "a.py").write_text("1")
    (tmp_path / "code" / ".hidden").write_text("1")
    (tmp_path / "code" / "__pycache__" / "a.pyc").write_text("1")
    assert files.package_code(str(tmp_path / "code"), str(tmp_path / "o.zip"), prefixes=("code/", "src/")) == ["code/a.py", "src/a.py"]
    assert files.package_code(str(tmp_path / "code"), f"file://{tmp_path}/store/o.zip", spark=spark) == ["code/a.py"]
    assert zipfile.ZipFile(tmp_path / "store" / "o.zip").namelist() == ["code/a.py"]
    with pytest.raises(FileNotFoundError):
        files.package_code(str(tmp_path / "none"), str(tmp_path / "o.zip"))


def test_ledger(spark, tmp_path):
    from tributary.operators import reports

    ledger = files.Ledger(str(tmp_path / "runs.json"))
    assert ledger.runs() == [] and ledger.frame(spark).count() == 0
    for name, score in (("a", 0.2), ("b", 0.9), ("a", 0.4)):
        run = files.Run(ledger, name, {"k": 25}, run_id=name)
        run.log_metrics(macro_f05=score, absent=None)
        run.log_curve([0.1], [score])
        run.log_importances({"f": 1.0})
        run.log_summary({"US": {"total": 3.0}})
        run.end()
    assert len(ledger.runs()) == 2 and ledger.get("a")["metrics"] == {"macro_f05": 0.4} and ledger.get("x") is None
    board = reports.leaderboard(ledger.frame(spark)).orderBy("rank").collect()
    assert [(r["run_id"], r["macro_f05"]) for r in board] == [("b", 0.9), ("a", 0.4)]
    (tmp_path / "runs.json").write_text("{broken")
    assert ledger.runs() == []


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"columns": {"target": "t", "odd": 1}, "training": {"n_splits": 3}}))
    config = files.Config.read(str(tmp_path / "c.json"))
    assert (config.columns.target, config.columns.id, config.training.n_splits, config.paths.output) == ("t", "id", 3, "output")


def test_learning_a_table(spark):
    from tributary.plans import linkage

    rows = [(k, float(k % 7), "ab"[k % 2], int(k % 7 > 3)) for k in range(140)]
    train = spark.createDataFrame(rows, "id int, x double, c string, target int")
    config = files.Config.of({"columns": {"numerical": ["x"], "categorical": ["c"]}, "training": {"n_splits": 2, "metric": "roc_auc", "model": "forest", "options": {"numTrees": 5}}})
    cv, predictions = linkage.learn_table(train, train.drop("target"), config)
    assert cv.score > 0.9 and predictions.count() == 140


def test_arrivals_give_the_batch_result(spark, tmp_path):
    from tributary.plans import linkage

    s1 = spark.createDataFrame([("S1-1", "Acme Tools", "1 Main St 10001", "US")], files.RECORD)
    (tmp_path / "in").mkdir()
    header = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    (tmp_path / "in" / "a.tsv").write_text(header + "S2-1\tAcme Tools Inc\t1 Main St 10001\tUS\nS2-2\tOther\tx\tUS\n")
    query = arrivals.link_arrivals(arrivals.stream_records(spark, str(tmp_path / "in")), s1, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).select("s1", "cand", "p").collect()
    batch = linkage.link(s1, files.read_records(spark, str(tmp_path / "in" / "a.tsv"))).scored.select("s1", "cand", "p").collect()
    assert sorted(got) == sorted(batch) and {r["cand"] for r in got} == {"S2-1"}


def test_only_the_first_line_of_a_file_is_its_header(spark, tmp_path):
    from tributary.operators import validate

    folder = tmp_path / "lists"
    folder.mkdir()
    (folder / "part-0.tsv").write_text("a\tb\nS1-1\tS2-1\na\tb\n")
    (folder / "part-1.tsv").write_text("S1-2\tS2-1\nS1-2\tS2-1\nS1-2\tS2-1\n")
    everyone = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1 string")
    rules = {r["rule"]: r["n"] for r in validate.id_list_file(spark, str(folder), ("a", "b"), everyone).collect()}
    # The second header row is a row like any other; the file without a header keeps all rows but its first.
    assert (rules["header"], rules["duplicate_s1"], rules["extra_s1"], rules["missing_s1"], rules["wrong_prefix"]) == (1, 1, 1, 0, 1)


def test_outer_spaces_and_quotes_are_kept(spark, tmp_path):
    rows = [(" S2-1 ", 'a "quoted" name ', " 1 road", "US"), ("S2-2", "it's", "", "")]
    files.write_tsv(spark.createDataFrame(rows, files.RECORD), str(tmp_path / "r"))
    assert sorted(tuple(r) for r in files.read_records(spark, str(tmp_path / "r")).collect()) == sorted(rows)


def test_a_ledger_in_the_store(spark, tmp_path):
    ledger = files.Ledger(f"file://{tmp_path}/deep/runs.json", spark)
    assert ledger.runs() == []
    for name in ("a", "b", "a"):
        files.Run(ledger, name, run_id=name).end()
    assert [r["run_id"] for r in ledger.runs()] == ["b", "a"] and ledger.frame(spark).count() == 2


def test_a_large_package_streams(spark, tmp_path):
    import os

    (tmp_path / "in").mkdir()
    parts = [os.urandom(700_000) for _ in range(3)]
    for k, part in enumerate(parts):
        (tmp_path / "in" / f"part-{k}").write_bytes(part)
    files.zip_files(spark, {"data.bin": str(tmp_path / "in")}, str(tmp_path / "p.zip"))
    with zipfile.ZipFile(tmp_path / "p.zip") as found:
        assert found.testzip() is None and found.read("data.bin") == b"".join(parts)


def test_package_in_pieces(spark, tmp_path, monkeypatch):
    """A part file of several megabytes reaches the zip a megabyte at a time."""
    data, sizes, member_write = os.urandom(3_500_000), [], zipfile._ZipWriteFile.write
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-0").write_bytes(data)
    (tmp_path / "in" / "part-1").write_bytes(b"")
    monkeypatch.setattr(zipfile._ZipWriteFile, "write", lambda self, piece: sizes.append(len(piece)) or member_write(self, piece))
    files.zip_files(spark, {"data.bin": str(tmp_path / "in")}, str(tmp_path / "p.zip"))
    assert zipfile.ZipFile(tmp_path / "p.zip").read("data.bin") == data
    assert max(sizes) <= 1 << 20
