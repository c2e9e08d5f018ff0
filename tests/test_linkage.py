import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import assign, blocking, calibrate, features, mining, normalize
from tributary.plans import linkage

RECORD = "entity_id string, business_name string, business_address string, country string"


def records(spark, rows):
    return spark.createDataFrame([(*r, *("US",) * (4 - len(r))) for r in rows] or [], RECORD)


# --- normalisation ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name, clean, grams",
    [("Léarning Center SARL", "learning center", None), ("LLC", "llc", ["llc"]), ("Inc", "inc", ["inc"]), ("SARL", "sarl", ["sar", "arl"]), ("---", "", []), ("Tata Motors Private Limited", "tata motors", None), ("nan", "", []), (None, "", []), ("<NA>", "", []), ("A B", "a b", ["ab"])],
)
def test_names(spark, name, clean, grams):
    row = normalize.normalize_names(records(spark, [("S1-1", name, "")])).first()["name"]
    assert row["clean_name"] == clean and (grams is None or row["char_3grams"] == grams)


def test_canonical_name(spark):
    rows = normalize.normalize_names(records(spark, [("S1-1", "Tata Motors Private Limited", ""), ("S1-2", "Beta Corporation, Incorporated Company", ""), ("S1-3", "Société Anonyme Gamma", "")])).collect()
    assert [r["name"]["canonical_name"] for r in rows] == ["tata motors pvt ltd", "beta corp inc co", "sa gamma"]


@pytest.mark.parametrize(
    "address, street, postal, flag",
    [
        ("105 ELM ST, MORGANTON, NC 28655", "105", "28655", False), ("75001 Paris, 10 Rue de la Paix", "10", "75001", False), ("High Point, NC 27262", None, "27262", False),
        ("G-3/571, Gulmohar Colony, Bhopal, 462039", "571", "462039", False), ("1 Apple Park Way", "1", None, False), ("Block A", None, None, False), ("G-3 Colony", "3", None, False),
        ("15 RUE DE RIVOLI PARIS CEDEX 09 BP 1024", "15", None, True), ("RUE DE RIVOLI B.P. 1024 PARIS 75001", None, "75001", True), ("10 RUE DE LA PAIX CEDEX 75001", "10", "75001", True), (None, None, None, False), ("nan", None, None, False),
        ("12b High Street 12345 67890", "12b", "67890", False),
    ],
)
def test_addresses(spark, address, street, postal, flag):
    row = normalize.normalize_addresses(records(spark, [("S1-1", "", address)])).first()["address"]
    assert (row["street_number"], row["postal_code"], row["cedex_flag"]) == (street, postal, flag)


def test_route_keywords_are_whole_words(spark):
    row = normalize.normalize_addresses(records(spark, [("S1-1", "", "csir road 12"), ("S1-2", "", "12 bpcl colony"), ("S1-3", "", "rue x cedex 09")])).collect()
    assert [r["address"]["clean_address"] for r in row] == ["csir road 12", "12 bpcl colony", "rue x"]


# --- blocking --------------------------------------------------------------------------------------------------------


def prep(spark, rows, **kw):
    return normalize.prepare(records(spark, rows), **kw)


def test_bucket_keys(spark):
    rec = spark.createDataFrame([("S1-1", "US", "walmart store", "100", "12345", "ALMR")], "entity_id string, country string, name string, street string, postal string, metaphone string")
    keys = rec.select(blocking.bucket_keys().alias("k")).first()["k"]
    assert [k.split("\x1f") for k in keys] == [["name", "US", "walmart store"], ["start", "US", "walm", "100"], ["sound", "US", "ALMR", "12345"], ["place", "US", "12345", "100"]]


def test_bucket_ceiling(spark):
    many = [(f"S2-{k}", "Societe Generique", f"{k} rue") for k in range(10)] + [("S2-U", "Unique Name", "")]
    s1 = prep(spark, [("S1-1", "Societe Generique", ""), ("S1-2", "Unique Name", "")])
    assert [(r["s1"], r["cand"]) for r in blocking.tier1(s1, prep(spark, many), ceiling=5).collect()] == [("S1-2", "S2-U")]
    assert blocking.tier1(s1, prep(spark, many), k=3).where("s1 = 'S1-1'").count() == 3


def test_exact_name_beats_place(spark):
    s1 = prep(spark, [("S1-1", "Apex Auto", "450 Industrial 78745")])
    targets = prep(spark, [("S2-PLACE", "Other Shop", "450 Industrial 78745"), ("S2-NAME", "Apex Auto", "1 Elsewhere")])
    rows = blocking.tier1(s1, targets).orderBy("rank").collect()
    assert [(r["cand"], r["score"]) for r in rows] == [("S2-NAME", 3.0), ("S2-PLACE", 1.0)]


def test_tier2_is_weighted_overlap(spark):
    import math

    s1 = prep(spark, [("S1-1", "abcd", "elm")])
    targets = prep(spark, [("S2-1", "abcd", "oak"), ("S2-2", "xyz", "elm"), ("S2-3", "xyz", "oak")])
    got = {r["cand"]: r["score"] for r in blocking.tier2(s1, targets).collect()}
    idf = lambda df: math.log(4 / (df + 1)) + 1
    assert got == {"S2-1": round(2 * idf(1) + 2 * 0.5 * idf(1), 9), "S2-2": round(2 * idf(1), 9)}
    assert blocking.tier2(s1, targets, max_postings=0).collect() == []


def test_legacy_posting_cut_and_anchor(spark):
    same = [(f"S2-{k}", "fashion boutique", "9 street 10001") for k in range(10)]
    s1 = prep(spark, [("S1-1", "fashion boutique", "9 street 10001")])
    assert blocking.legacy(s1, prep(spark, same), max_postings=5).collect() == []
    assert blocking.legacy(s1, prep(spark, same), k=3).count() == 3
    two = prep(spark, [("S2-A", "zzz", "9 street 10001"), ("S2-B", "fashion x", "")])
    assert [r["cand"] for r in blocking.legacy(s1, two).orderBy("rank").collect()] == ["S2-B", "S2-A"]


def test_fusion(spark):
    rank = lambda rows: spark.createDataFrame([("S1-1", c, s, r) for c, s, r in rows], "s1 string, cand string, score double, rank int")
    tiers = {1: rank([("C1", 1.0, 1), ("C2", 1.0, 2)]), 2: rank([("C2", 34.5, 1), ("C3", 12.1, 2)]), 3: rank([("C3", 0.92, 1), ("C1", 0.81, 2)])}
    got = {r["cand"]: r["score"] for r in blocking.fuse(tiers).collect()}
    assert got == {"C1": round(1.5 / 61 + 1 / 62, 9), "C2": round(1.5 / 62 + 1 / 61, 9), "C3": round(1 / 62 + 1 / 61, 9)}


def test_dense(spark):
    schema = "entity_id string, embedding array<float>"
    s1 = spark.createDataFrame([("S1-1", [1.0, 0.0, 0.0]), ("S1-2", [0.0, 1.0, 0.0]), ("S1-3", None)], schema)
    t = spark.createDataFrame([("T-1", [0.9, 0.1, 0.0]), ("T-2", [0.1, 0.9, 0.0]), ("T-3", [0.0, 0.0, 1.0]), ("T-4", None)], schema).repartition(3)
    for limits in ({"block_rows": 1}, {}, {"max_block_bytes": 1}):
        rows = blocking.dense(s1, t, 2, **limits).where("rank = 1").collect()
        assert {r["s1"]: r["cand"] for r in rows} == {"S1-1": "T-1", "S1-2": "T-2"}
    assert blocking.dense(s1.limit(0), t).collect() == []


def test_empty_sides_and_ids(spark):
    none = prep(spark, [])
    some = prep(spark, [("  S1-10  ", "Acme", ""), (None, "Acme", ""), ("nan", "Acme", "")])
    assert [r["entity_id"] for r in some.collect()] == ["S1-10"]
    assert blocking.generate(some, none).collect() == [] == blocking.generate(none, some).collect()


# --- features --------------------------------------------------------------------------------------------------------


def feature_row(spark, a, b, cand="S2-1"):
    pairs = spark.createDataFrame([("S1-1", cand, 2, 0.5)], "s1 string, cand string, rank int, score double")
    return features.pair_features(pairs, records(spark, [("S1-1", *a)]), records(spark, [(cand, *b)])).first().asDict()


def test_matching_pair(spark):
    f = feature_row(spark, ("Acme Widgets", "123 Main St, NY 10001"), ("Acme Widgets LLC", "123 Main St, NY 10001"))
    assert list(f)[2:] == features.FEATURES and len(features.FEATURES) == 32
    ones = ["name_clean_exact_match", "name_jaro_winkler", "name_levenshtein_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_char_3gram_jaccard", "name_char_3gram_dice", "name_lcs_ratio", "addr_exact_match", "addr_token_jaccard", "addr_token_sort_ratio", "addr_token_set_ratio", "addr_street_num_status", "addr_postal_code_status", "addr_lcs_ratio", "is_source2", "name_first_token_match", "name_soundex_match"]
    assert {k: f[k] for k in ones} == dict.fromkeys(ones, 1.0)
    assert f["name_exact_match"] == 0 and f["name_common_tokens_count"] == 2 and f["name_in_address_cross"] == 0 and f["blocking_rank"] == 2


def test_feature_values(spark):
    f = feature_row(spark, ("Alpha Beta", "100 Elm Street"), ("Alpha Gamma", "100 Oak Street"), "S3-9")
    assert abs(f["name_char_3gram_jaccard"] - 0.25) < 1e-9 and abs(f["name_char_3gram_dice"] - 0.4) < 1e-9
    assert f["addr_token_jaccard"] == 0.5 and f["is_source3"] == 1
    f = feature_row(spark, ("Target", "105 Elm St, 28655"), ("Target Supercenter", "502 Oak St, 28655"))
    assert f["name_length_diff"] == 12 and abs(f["name_length_ratio"] - 1 / 3) < 1e-9 and f["name_lcs_ratio"] == 0.5
    assert (f["addr_street_num_status"], f["addr_postal_code_status"]) == (-1, 1) and f["name_token_set_ratio"] == 1
    f = feature_row(spark, ("AAAA", ""), ("ZZZZ", "5 x ZZZZ"))
    assert f["name_lcs_ratio"] == f["name_char_3gram_dice"] == 0 and f["addr_is_empty"] == 1 and f["addr_street_num_status"] == 0


@pytest.mark.parametrize("name, cross", [("Starbucks", 1), ("St", 0), ("In", 0), ("Go", 0)])
def test_name_in_address(spark, name, cross):
    assert feature_row(spark, (name, "1 Pike St"), ("Other", f"inside {name} store"))["name_in_address_cross"] == cross


def test_missing_record_is_empty(spark):
    pairs = spark.createDataFrame([("S1-1", "S2-X", 1, 1.0)], "s1 string, cand string, rank int, score double")
    f = features.pair_features(pairs, records(spark, [("S1-1", "A", "B")]), records(spark, [])).first()
    assert f["name_levenshtein_ratio"] == 0 and f["addr_is_empty"] == 1


# --- assignment ------------------------------------------------------------------------------------------------------


def pairs_of(spark, rows):
    return spark.createDataFrame([(a, b, None if p is None else float(p), c) for a, b, p, c in rows], "source1_id string, candidate_id string, p_final double, country string")


def matched(df):
    out = {}
    for r in df.orderBy("s1", "rank").collect():
        out.setdefault(r["s1"], []).append(r["cand"])
    return out


def test_one_owner_guard_and_ties(spark):
    us = lambda *rows: pairs_of(spark, [(*r, "US") for r in rows])
    assert matched(assign.assign(us(("S1-A", "S2-1", 0.92), ("S1-B", "S2-1", 0.75)))) == {"S1-A": ["S2-1"]}
    assert matched(assign.assign(us(("S1-B", "S2-1", 0.95), ("S1-A", "S2-1", 0.76), ("S1-A", "S2-2", 0.62)))) == {"S1-B": ["S2-1"]}
    assert matched(assign.assign(us(("S1-A", "S2-1", 0.88), ("S1-A", "S2-2", 0.68), ("S1-A", "S3-3", 0.62), ("S1-A", "S3-4", 0.55)))) == {"S1-A": ["S2-1", "S2-2", "S3-3"]}
    assert matched(assign.assign(us(("S1-B", "S2-1", 0.8), ("S1-A", "S2-1", 0.8)))) == {"S1-A": ["S2-1"]}
    assert matched(assign.assign(us(("S1-A", "S2-1", 0.74), ("S1-A", "S2-2", 0.60), ("S1-B", "S2-3", 0.7399), ("S1-A", "S2-4", 0.5999)))) == {"S1-A": ["S2-1", "S2-2"]}
    bad = us(("S1-A", None, 0.9), ("S1-A", "nan", 0.9), ("S1-A", "None", 0.9), ("S1-A", "S1-02", 0.9), ("S1-A", "INVALID-99", 0.9), ("S1-A", "S2-VALID", 0.9), ("S1-A", "S2-N", None))
    assert matched(assign.assign(bad)) == {"S1-A": ["S2-VALID"]}


def test_countries_universe_and_cap(spark):
    rows = pairs_of(spark, [("S1-A", "S2-1", 0.9, "US"), ("S1-B", "S2-1", 0.8, "India")])
    assert matched(assign.assign(rows)) == {"S1-A": ["S2-1"], "S1-B": ["S2-1"]}
    some = spark.createDataFrame([("S1-B",), ("S1-C",)], "s1 string")
    kept = assign.assign(rows, some)
    assert matched(kept) == {"S1-B": ["S2-1"]}
    assert {r[0]: r[1] for r in assign.match_lists(kept, some).collect()} == {"S1-B": "S2-1", "S1-C": ""}
    many = pairs_of(spark, [("S1-A", f"S2-{k}", 0.9 - k / 100, "US") for k in range(10)])
    assert [len(matched(assign.assign(many, max_matches=m)).get("S1-A", [])) for m in (15, 6, 4, None)] == [10, 6, 4, 10]
    with pytest.raises(KeyError):
        assign.assign(rows.drop("p_final"))


def random_pairs(r, n=60):
    return [(f"S1-{r.randint(0, 8)}", f"S2-{r.randint(0, 12)}", r.choice([0.4, 0.5, 0.55, 0.6, 0.7, 0.8, 0.9]), r.choice(["US", "FR"])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_assignment_is_the_sequential_one(spark, seed):
    rows = random_pairs(random.Random(seed))
    owner, best = {}, {}
    for s1, cand, p, c in sorted(rows, key=lambda x: (-x[2], x[0], x[1])):
        if p >= 0.5 and (c, cand) not in owner:
            owner[c, cand] = (s1, p)
    for (_, cand), (s1, p) in owner.items():
        best.setdefault(s1, []).append((-p, cand))
    want = {s: [c for _, c in sorted(x)][:4] for s, x in best.items() if min(x)[0] <= -0.7}
    assert matched(assign.assign(pairs_of(spark, rows), None, 0.7, 0.5, 4)) == want


@pytest.mark.parametrize("seed", range(3))
def test_competitive_is_the_sequential_one(spark, seed):
    rows = list({(a, b): (a, b, p, c) for a, b, p, c in random_pairs(random.Random(10 + seed), 40)}.values())
    limits, held, taken, want = {"US": (0.5, 0.6), "FR": (0.4, 0.7)}, {}, set(), {}
    for s1, cand, p, c in sorted(rows, key=lambda x: (-x[2], x[0], x[1])):
        if p < limits[c][0] or cand in taken or held.get(s1, 0) >= 3 or (held.get(s1, 0) and p < limits[c][1]):
            continue
        taken.add(cand)
        held[s1] = held.get(s1, 0) + 1
        want.setdefault(s1, []).append(cand)
    assert matched(assign.competitive(pairs_of(spark, rows), limits, 3)) == want


# --- calibration and mining ------------------------------------------------------------------------------------------


def truth_of(spark, rows):
    return spark.createDataFrame(rows, "s1 string, cands array<string>")


def test_macro_f05(spark):
    truth = truth_of(spark, [("a", ["x"]), ("b", []), ("c", ["y"]), ("d", []), ("e", ["q"])])
    got = spark.createDataFrame([("a", "x"), ("c", "y"), ("c", "z"), ("d", "w")], "s1 string, cand string")
    assert abs(calibrate.macro_f05(truth, got).first()[0] - (1 + 1 + 1.25 * 0.5 / (0.125 + 1) + 0 + 0) / 5) < 1e-9
    assert calibrate.macro_f05(truth.limit(0), got).first()[0] == 0


def test_curve_is_one_assignment_per_threshold(spark):
    rows = random_pairs(random.Random(5))
    pairs = pairs_of(spark, rows)
    truth = truth_of(spark, [(f"S1-{k}", [f"S2-{k}", f"S2-{k + 1}"]) for k in range(9)])
    points = {r["step"]: (r["tau"], r["f05"]) for r in calibrate.curve(pairs, truth).collect()}
    assert len(points) == 25
    for step in (0, 10, 24):
        tau, f05 = points[step]
        again = assign.assign(pairs, None, tau, tau * 0.85, 15, False)
        assert abs(calibrate.macro_f05(truth, again).first()[0] - f05) < 1e-9


def test_plateau_takes_the_median(spark):
    rows = [(k, 0.5 + k * 0.45 / 24, 1.0 if k <= 24 else 0.0) for k in range(25)]
    assert abs(calibrate.best_threshold(spark.createDataFrame(rows, "step int, tau double, f05 double")).first()["tau"] - 0.725) < 1e-9


def test_mining(spark):
    cands = spark.createDataFrame([(s, c, 1.0, r) for s, c, r in [("S1-1", "a", 1), ("S1-1", "b", 2), ("S1-1", "c", 3), ("S1-1", "d", 4), ("S1-2", "x", 1)]], "s1 string, cand string, score double, rank int")
    truth = spark.createDataFrame([("S1-1", "b"), ("S1-1", "z"), ("S1-3", "q")], "s1 string, cand string")
    got = {tuple(r) for r in mining.hard_negatives(cands, truth, 2).collect()}
    assert got == {("S1-1", "b", 1), ("S1-1", "z", 1), ("S1-1", "a", 0), ("S1-1", "c", 0), ("S1-2", "x", 0), ("S1-3", "q", 1)}
    assert mining.hard_negatives(cands, truth, 0).where("label = 0").count() == 0
    assert mining.hard_negatives(cands, truth, 2, sample_size=0).collect() == []
    missed = {tuple(r) for r in mining.missed_truth(cands, truth).select("s1", "cand", "rank").collect()}
    assert missed == {("S1-1", "z", 5), ("S1-3", "q", 1)}
    assert mining.training_pairs(cands, truth).where("label = 1").count() == 3


def test_samples_and_folds(spark):
    df = spark.createDataFrame([(f"S1-{k}", "US" if k < 70 else "FR" if k < 95 else "IN") for k in range(100)], "entity_id string, country string")
    some = mining.stratified_sample(df, 20)
    assert {r[0]: r[1] for r in some.groupBy("country").count().collect()} == {"US": 14, "FR": 5, "IN": 1}
    assert some.collect() == mining.stratified_sample(df, 20).collect()
    spread = mining.folds(df, 5, stratify="country").groupBy("country", "fold").count().collect()
    assert {r["count"] for r in spread if r["country"] == "US"} == {14}
    assert mining.folds(df, 3, group="country").groupBy("country").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    down = mining.downsample_targets(df, spark.createDataFrame([("s", "S1-99"), ("s", "S1-5")], "s1 string, cand string"), 10)
    assert down.count() == 10 and {"S1-99", "S1-5"} <= {r[0] for r in down.collect()}


# --- whole runs ------------------------------------------------------------------------------------------------------

TRAIN_S1 = [("S1-01", "Acme Tools Corp", "123 Main St, New York, NY 10001"), ("S1-02", "Acme Hardware Store", "123 Main Street, NY 10001"), ("S1-03", "Beta Logistics Inc", "456 Market St, SF, CA 94105"), ("S1-04", "Gamma Services", "789 Broadway, NY 10003"), ("S1-05", "Delta Cafe", "101 5th Ave, NY 10003"), ("S1-06", "Epsilon Books", "202 Elm St, Austin, TX 78701")]
TRAIN_T = [("S2-01", "Acme Tools", "123 Main St 10001"), ("S2-03", "Beta Logistics", "456 Market St 94105"), ("S2-05", "Delta Coffee Cafe", "101 5th Ave"), ("S3-01", "Acme Tools Corporation", "123 Main Street 10001"), ("S3-04", "Gamma Services LLC", "789 Broadway")]
TRUTH = [("S1-01", ["S2-01", "S3-01"]), ("S1-02", []), ("S1-03", ["S2-03"]), ("S1-04", ["S3-04"]), ("S1-05", ["S2-05"]), ("S1-06", [])]


def test_train_and_link(spark):
    from tributary.operators import models

    model = models.Ensemble(features.FEATURES, options={"gbt": {"maxIter": 5}, "forest": {"numTrees": 10}})
    model, by_country, overall = linkage.train(records(spark, TRAIN_S1), records(spark, TRAIN_T), truth_of(spark, TRUTH), model=model)
    assert by_country.first()["f05"] > 0.8 and overall.count() == 1
    assert abs(sum(model.importances().values()) - 1) < 1e-6
    test_s1 = [("S1-T1", "Acme Tools", "123 Main St 10001"), ("S1-T2", "Beta Logistics", "456 Market St 94105"), ("S1-T3", "Boulangerie Parisienne", "10 Rue de la Paix, 75002 Paris", "France")]
    targets = [("S2-T1", "Acme Tools Inc", "123 Main St 10001"), ("S2-T3", "Boulangerie Parisienne SARL", "10 Rue de la Paix 75002 Paris", "France"), ("S3-T2", "Beta Logistics Co", "456 Market St")]
    for options in (linkage.Options(calibrated=by_country, tau_singleton=0.3), linkage.Options(tau=0.3, scorer=models.PairScorer())):
        out = linkage.link(records(spark, test_s1), records(spark, targets), options, model)
        lists = {r[0]: set(r[1].split(",")) for r in out.match_lists.collect()}
        offered = {r[0]: set(r[1].split(",")) for r in out.candidate_lists.collect()}
        assert set(lists) == {"S1-T1", "S1-T2", "S1-T3"} and all(v <= offered[k] | {""} for k, v in lists.items())
        assert lists["S1-T1"] == {"S2-T1"}
        assert {r["country"]: r["total"] for r in out.summary.collect()} == {"US": 2, "FRANCE": 1}


def test_choosing_records(spark):
    df = records(spark, TRAIN_S1)
    assert [r[0] for r in linkage.chosen(df, linkage.Options(first_record=1, last_record=3)).orderBy("entity_id").collect()] == ["S1-02", "S1-03"]
    assert linkage.chosen(df, linkage.Options(countries=("FR",))).count() == 0


def test_hash_ranks_are_the_sorted_ones(spark):
    rows = [(f"e{k % 400}", None if k % 3 == 0 else f"g{k % 2}", k) for k in range(500)]
    df = spark.createDataFrame(rows, "entity_id string, g string, k int").repartition(5)
    for by in ("g", None):
        got = mining.with_hash_rank(df, F.col("entity_id"), by).collect()
        groups = {}
        for r in got:
            groups.setdefault(r["g"] if by else 0, []).append((r["_rank"], hashlib.md5(f"42:{r['entity_id']}".encode()).hexdigest()))
        for found in groups.values():
            assert [n for n, _ in sorted(found)] == list(range(1, len(found) + 1))
            assert [h for _, h in sorted(found)] == sorted(h for _, h in found)
    some = mining.with_hash_rank(df, F.col("entity_id"), "g", most=F.lit(7)).collect()
    assert len(some) == 21 and max(r["_rank"] for r in some) == 7


def test_positions_are_the_sorted_ones(spark):
    from tributary.operators import tabular

    rows = [(f"id{k * 37 % 501:03d}", None if k % 4 == 0 else "ab"[k % 2]) for k in range(501)]
    got = tabular.positions(spark.createDataFrame(rows, "i string, g string").repartition(4), "g", "i", "n").collect()
    for g in (None, "a", "b"):
        own = sorted(i for i, x in rows if x == g)
        assert {r["i"]: r["n"] for r in got if r["g"] == g} == {i: k for k, i in enumerate(own)}


def test_keep_first(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, x int")
    got = mining.keep_first([frame(("a", 5), ("a", 3)), frame(("a", 1), ("b", 2), (None, 9)), frame(("b", 0), (None, 1), ("c", 4))], ["k"]).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([("a", 3), ("b", 2), (None, 9), ("c", 4)], key=str)


def test_long_chains_end(spark):
    """Each round of the competitive assignment settles one pair of a chain; the chain has no bound."""
    n = 12
    rows = [(f"S1-{k:02d}", f"S2-{c:02d}", 0.9 - 0.01 * (k + c), "X") for k in range(n) for c in (k, k + 1)]
    limits = {"X": (0.1, 0.1)}
    got = assign.competitive(spark.createDataFrame(rows, "s1 string, cand string, p double, country string"), limits, 1).collect()
    taken, held, want = set(), set(), set()
    for s1, cand, p, _ in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        if s1 not in held and cand not in taken:
            held.add(s1)
            taken.add(cand)
            want.add((s1, cand))
    assert {(r["s1"], r["cand"]) for r in got} == want and len(want) == n


def test_weights_of_a_reference(spark):
    """With a reference, a pair's score does not depend on the other targets of its batch."""
    s1 = prep(spark, [("S1-1", "alpha beta", "elm")])
    targets = [("S2-1", "alpha gamma", "oak"), ("S2-2", "beta delta", "elm"), ("S2-3", "alpha beta", "ash")]
    whole = prep(spark, targets)
    weights = blocking.term_weights(whole)
    all_at_once = {r["cand"]: r["score"] for r in blocking.tier2(s1, whole).collect()}
    apart = {r["cand"]: r["score"] for t in targets for r in blocking.tier2(s1, prep(spark, [t]), weights=weights).collect()}
    assert apart == all_at_once


def test_stored_records_are_not_broadcast(spark, tmp_path):
    """Repeated texts take little room in a file and much in memory: records, keys and terms are dealt out, not sent through the driver."""
    raw = spark.createDataFrame([(f"S{k % 3 + 1}-{k}", f"name {k % 5}", f"{k} road 12345", "US") for k in range(60)], "entity_id string, business_name string, business_address string, country string")
    normalize.normalized(raw).write.parquet(str(tmp_path / "n"))
    rows = spark.read.parquet(str(tmp_path / "n"))
    own, others = rows.where("entity_id LIKE 'S1-%'"), rows.where("entity_id NOT LIKE 'S1-%'")
    candidates = spark.createDataFrame([("S1-0", "S2-1", 1, 1.0)], "s1 string, cand string, rank int, score double")
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan(features.pair_features(candidates, own, others))
    sides = normalize.blocking_view(own), normalize.blocking_view(others)
    assert plan(blocking.tier1(*sides)).count("SortMergeJoin") >= 1
    assert plan(blocking.tier2(*sides)).count("SortMergeJoin") >= 2


def test_bucket_keys_are_not_broadcast(spark, tmp_path):
    """Every key that is not too frequent stays; the driver does not hold them."""
    raw = spark.createDataFrame([(f"S2-{k}", f"name {k}", f"{k} road 12345", "US") for k in range(60)], "entity_id string, business_name string, business_address string, country string")
    normalize.normalized(raw).write.parquet(str(tmp_path / "n"))
    held = blocking.buckets(normalize.blocking_view(spark.read.parquet(str(tmp_path / "n"))), 59)
    assert "Broadcast" not in held._jdf.queryExecution().sparkPlan().toString()
    assert held.where("key LIKE 'name%'").count() == 60
    assert held.where("key LIKE 'sound%'").count() == 0


def test_truth_by_class_is_truth_by_lists(spark):
    """The same training rows and the same curves as from listed pairs, which grow with the square of a class."""
    own = [(f"S1-{k:02}", f"name {k % 3} tools", f"{k} main street {10000 + k % 4}", "US" if k % 5 else "FR") for k in range(40)]
    held = [(f"S{2 + k % 2}-{k:02}", f"name {k % 4} tools", f"{k} main road {10000 + k % 4}", "US" if k % 7 else "FR") for k in range(70)]
    s1, targets = (spark.createDataFrame(x, "entity_id string, business_name string, business_address string, country string") for x in (own, held))
    classes = mining.Classes(s1.selectExpr("entity_id AS s1", "business_name AS class_id"), targets.selectExpr("entity_id AS cand", "business_name AS class_id"))
    lists = spark.createDataFrame([(a[0], [b[0] for b in held if b[1] == a[1]]) for a in own], "s1 string, cands array<string>")
    made = linkage.ready(s1, targets, linkage.Options())
    pairs = lists.select("s1", F.explode("cands").alias("cand"))
    mined = mining.hard_negatives(made.candidates, pairs, 4)
    ranked = mining.training_pairs(made.candidates, pairs, targets).select("s1", "cand", "rank", F.when(F.col("is_blocker"), F.lit(1.0) / F.col("rank")).otherwise(F.lit(0.0)).alias("score"))
    want = features.pair_features(ranked, made.own, made.others).join(mined, ["s1", "cand"]).select("s1", "label", *features.FEATURES)
    rows = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())
    got = rows(linkage._mined(made, classes, 4))
    assert got == rows(want) and sum(r[1] for r in got) == pairs.count()
    assert {r[0] for r in rows(linkage._mined(made, classes, 4, 7))} == {r[0] for r in rows(mining.hard_negatives(made.candidates, pairs, 4, 7))}
    scored = made.candidates.select("s1", "cand", F.round(1 / F.col("rank"), 2).alias("p")).join(s1.selectExpr("entity_id AS s1", "country"), "s1")
    everyone = s1.selectExpr("entity_id AS s1", "country")
    for by in (None, everyone):
        assert rows(calibrate.curve(scored, classes, by_country=by)) == rows(calibrate.curve(scored, lists, by_country=by))


def test_calibration_sends_no_pairs_through_the_driver(spark, tmp_path):
    """Stored scores are a small file; repeated for each threshold they are not."""
    for name, columns, row in (("scored", "s1 string, cand string, p double", lambda k: (f"S1-{k}", f"S2-{k}", 0.9)), ("everyone", "s1 string, country string", lambda k: (f"S1-{k}", f"US {hashlib.md5(str(k).encode()).hexdigest()}"))):
        spark.createDataFrame([row(k) for k in range(300)], columns).write.parquet(str(tmp_path / name))
    scored, everyone = spark.read.parquet(str(tmp_path / "scored")), spark.read.parquet(str(tmp_path / "everyone"))
    side = lambda i: everyone.select(F.col("s1").alias(i), F.lit("x").alias("class_id"))
    lists = everyone.select("s1", F.array("s1").alias("cands"))
    for truth in (mining.Classes(side("s1"), side("cand")), lists):
        plan = calibrate.curve(scored, truth, by_country=everyone)._jdf.queryExecution().sparkPlan().toString()
        assert not [x for x in plan.split("\n") if "BroadcastHashJoin" in x and "class_id" not in x]


@pytest.mark.parametrize("by_class", [True, False])
def test_training_takes_all_records_at_any_size(spark, monkeypatch, by_class):
    """No number of records makes train() mine only some of them."""
    n = 500_003
    none = normalize.normalized(records(spark, []))
    candidates = spark.range(n).select(F.concat(F.lit("S1-"), "id").alias("s1"), F.lit("S2-0").alias("cand"), F.lit(1).alias("rank"), F.lit(1.0).alias("score"))
    made = linkage.Ready(none, none, candidates, candidates.select("s1", "cand", *[F.lit(0.0).alias(f) for f in features.FEATURES]))
    lists = spark.createDataFrame([("S1-7", ["S2-0"])], "s1 string, cands array<string>")
    classes = mining.Classes(lists.selectExpr("s1", "'x' AS class_id"), spark.createDataFrame([("S2-0", "x")], "cand string, class_id string"))
    mined = []

    def kept(df, *_):
        mined.append(df)
        raise InterruptedError

    monkeypatch.setattr(linkage.storage, "written", kept)
    with pytest.raises(InterruptedError):
        linkage.train(none, none, classes if by_class else lists, made=made)
    assert mined[0].agg(F.count("*"), F.countDistinct("s1")).first() == (n, n)
