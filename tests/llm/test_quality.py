import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import quality

from .conftest import words


def test_rules_are_found_and_compiled(spark):
    r = np.random.default_rng(0)
    x = r.random((3000, 4))
    y = ((x[:, 1] > 0.5) & (x[:, 3] <= 0.3)).astype(float)
    model = quality.RuleModel.fit(x, y, ["a", "b", "c", "d"])
    assert 0 < len(model.rules) < len(quality.grow_rules(x, y))
    p = model.predict(x)
    assert ((p > 0.5) == y).mean() > 0.98
    df = spark.createDataFrame([tuple(map(float, v)) for v in x[:200]], "a double, b double, c double, d double")
    assert np.allclose([v[0] for v in df.select(model.score_column()).collect()], p[:200])
    nested = df.select(F.struct("a", "b", "c", "d").alias("s")).select(model.score_column("s"))
    assert np.allclose([v[0] for v in nested.collect()], p[:200])


def test_lasso_drops_noise():
    r = np.random.default_rng(1)
    z = (r.random((2000, 30)) > 0.5).astype(float)
    y = (z[:, 0] > 0).astype(float)
    w, _ = quality.fit_lasso(z, y, 0.02)
    assert w[0] > 1 and np.count_nonzero(w) < 6


@pytest.fixture(scope="module")
def corpus(spark):
    docs, labels = [], []
    for k in range(300):
        good = k % 5 > 0
        text = words(k, 60) + "." if good else " ".join(w.upper() + "!!" for w in words(k, 60).split())
        docs.append((k, text))
        labels.append((k, int(good), 0))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    rows = {r["doc_id"]: r for r in quality.score_quality(docs, labels).collect()}
    assert len(rows) == 300
    for k, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.7) == int(k % 5 > 0)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {k for k in range(300) if k % 5}


def test_held_out_labels_are_not_learned(corpus):
    docs, labels = corpus
    flipped = labels.withColumn("quality", F.when(quality.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    a = sorted(map(tuple, quality.score_quality(docs, labels).collect()))
    assert a == sorted(map(tuple, quality.score_quality(docs, flipped).collect()))


def test_edge_cases(nasty, clashing, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.score_quality(nasty, none).collect()} == {0.5}
    labels = spark.createDataFrame([(3, 1, 0), (13, 0, 0), (13, 0, 0), (None, 1, 0), (33, None, 1), (83, 1, 0)], "doc_id long, quality int, toxic int")
    for df in (nasty, clashing):
        rows = quality.score_quality(df, labels).collect()
        assert len(rows) == nasty.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score_quality(empty, labels).collect() == []
    assert quality.keep_good(empty, labels).collect() == []


def test_shared_ids_and_names(corpus):
    """Rows that share a labelled doc_id count once; the user's columns stay as they are."""
    docs, labels = corpus
    many = docs.unionByName(docs.where("doc_id = 7")).unionByName(docs.where("doc_id = 7"))
    a = {(r["doc_id"], r["score"]) for r in quality.score_quality(docs, labels).collect()}
    assert {(r["doc_id"], r["score"]) for r in quality.score_quality(many, labels).collect()} == a
    named = docs.select("*", F.lit(1).alias("statistics"), F.lit(2).alias("_statistics"), F.lit(3).alias("a.b"))
    kept = quality.keep_good(named, labels)
    assert kept.columns == named.columns and {tuple(r[2:]) for r in kept.collect()} == {(1, 2, 3)}


def test_sample_is_a_share(corpus):
    docs, labels = corpus
    n = quality.labelled(labels, sample=100).count()
    assert 60 < n < 140
    assert quality.keep_good(docs, labels, sample=100).count() == 240


def plain_statistics(text):
    """Each statistic from its description, a character or word at a time."""
    text = text or ""
    raw, words, lines = list(text.encode()), text.split(), [x for x in text.split("\n") if x.strip()]
    if not raw:
        return dict.fromkeys(quality.STATISTICS, 0.0)
    n, pairs = len(words), list(zip(words, words[1:]))
    share = lambda test: sum(1 for b in raw if test(b)) / len(raw)
    letter = lambda b: b >= 128 or chr(b).isalpha()
    per_word = lambda found: found / n if n else found / 1
    return {
        "n_words": n, "mean_word": per_word(sum(len(w) for w in words)), "long_words": per_word(sum(len(w) > 20 for w in words)),
        "upper_words": per_word(sum(w.isupper() for w in words)), "title_words": per_word(sum(w.istitle() for w in words)), "distinct_words": per_word(len(set(words))),
        "top_word": per_word(max((words.count(w) for w in set(words)), default=0)), "bigram_repeats": 1 - len(set(pairs)) / len(pairs) if pairs else 0.0,
        "letters": share(letter), "digits": share(lambda b: 48 <= b <= 57), "spaces": share(lambda b: chr(b) in " \t\n\x0b\x0c\r"), "plain_marks": share(lambda b: b < 128 and chr(b) in ".,;:'\"()-"),
        "bars": share(lambda b: b == ord("|")), "other_symbols": share(lambda b: 32 <= b < 128 and not letter(b) and chr(b) not in "0123456789 .,;:'\"()-|!"),
        "exclamations": share(lambda b: b == ord("!")), "n_lines": len(lines), "repeated_lines": 1 - len(set(lines)) / len(lines) if lines else 0.0,
        "words_per_line": n / max(len(lines), 1), "sentence_ends": per_word(sum(text.count(c) for c in ".!?")),
    }


def test_the_query_by_brute_force(spark):
    """Whole documents of the test data: statistics by hand, the rules of the fitted model one by one."""
    import math

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit_on(quality.text_statistics(docs), quality.labelled(labels))
    assert model.rules and all(w for w in model.weights)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = quality.op5_quality(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(texts)
    for r in found:
        values = plain_statistics(texts[r["doc_id"]])
        x = [values[name] for name in quality.STATISTICS]
        margin = model.intercept + sum(w for rule, w in zip(model.rules, model.weights) if all((x[k] > cut) == above for k, cut, above in rule.parts))
        assert abs(r["score"] - 1 / (1 + math.exp(-margin))) < 1e-9
        assert r["predicted"] == int(r["score"] >= 0.7)
