import pytest
from pyspark.sql import functions as F

from tributary.functions import kernels, scores, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, value, build):
    return values(spark, [(value,)], "x string", build(F.col("x")))[0][0]


def test_tokens_and_ngrams(spark):
    assert one(spark, "  a  bc\td ", text.tokens) == ["a", "bc", "d"]
    assert one(spark, None, text.tokens) == []
    assert one(spark, "abcd", text.char_ngrams) == ["abc", "bcd"]
    assert one(spark, "ab", text.char_ngrams) == []
    assert one(spark, "ab", lambda c: text.char_ngrams(c, 3, True)) == ["ab"]
    assert one(spark, "", lambda c: text.char_ngrams(c, 3, True)) == []


@pytest.mark.parametrize("word, code", [("Chaudhary", "C360"), ("Choudhary", "C360"), ("Ashcraft", "A226"), ("123", ""), ("", ""), (None, ""), ("o'Brien", "O165"), ("a", "A000")])
def test_soundex(spark, word, code):
    assert one(spark, word, text.soundex) == code


def test_metaphone_codes():
    assert kernels.double_metaphone("Fedex") == ("FTKS", "FTKS")
    assert kernels.double_metaphone("Good") == ("KT", "KT")
    assert set(kernels.double_metaphone("Lakshmi")) & set(kernels.double_metaphone("Laxmi"))
    assert set(kernels.double_metaphone("Choudhary")) & set(kernels.double_metaphone("Chowdhury"))
    assert kernels.double_metaphone("") == kernels.double_metaphone("12") == ("", "")
    assert kernels.double_metaphone("Renault") == ("RNL", "RNLT")


def test_lcs_and_jaro_winkler(spark):
    rows = [("abc", "ac"), ("AAAA", "ZZZZ"), ("", "a"), ("martha", "marhta"), ("same", "same"), (None, "x")]
    found = values(spark, rows, "a string, b string", F.round(kernels.lcs_ratio(F.col("a"), F.col("b")), 6), F.round(kernels.jaro_winkler_similarity(F.col("a"), F.col("b")), 4))
    assert [x for x, _ in found] == [0.8, 0.0, 0.0, 0.833333, 1.0, 0.0]
    assert [y for _, y in found] == [0.6111, 0.0, 0.0, 0.9611, 1.0, 0.0]


def test_sets(spark):
    rows = [(["abc", "bcd"], ["abc", "xyz"]), ([], ["a"]), (["a", "a"], ["a"])]
    found = values(spark, rows, "a array<string>, b array<string>", text.dice(F.col("a"), F.col("b")), F.round(text.jaccard(F.col("a"), F.col("b")), 6))
    assert found == [(0.5, 0.333333), (0.0, 0.0), (1.0, 1.0)]


def test_ternary(spark):
    rows = [("15.0", "15"), ("15", "15.0"), ("15.0", "20.0"), (None, "1"), ("", "1"), ("nan", "1"), ("N/A", "n/a"), (" 12a ", "12A")]
    assert [x for (x,) in values(spark, rows, "a string, b string", text.ternary_match(F.col("a"), F.col("b")))] == [1, 1, -1, 0, 0, 0, 0, 1]


def test_floats_and_lists(spark):
    rows = [("1.5",), ("x",), (None,), ("NaN",), ("",)]
    assert [x for (x,) in values(spark, rows, "a string", text.safe_float(F.col("a"), -1.0))] == [1.5, -1, -1, -1, -1]
    assert one(spark, " a, b,,a , 11", text.split_list) == ["a", "b", "11"]
    assert one(spark, None, text.split_list) == []


def test_clean_text(spark):
    clean = lambda c: text.clean_text(c, unescape=kernels.html_unescape)
    assert one(spark, "\n<h1 class='t'>Salt &amp; Pepper</h1><br/>Two&nbsp;mills,\t ONE <i>price</i>.", clean) == "salt & pepper two mills, one price ."
    assert one(spark, "&lt;b&gt;x", text.clean_text) == "x"
    assert one(spark, "&eacute;t&eacute;", clean) == "été"
    assert one(spark, None, text.clean_text) == ""


def test_text_statistics(spark):
    row = spark.createDataFrame([("Ab 1, c!",), (None,)], "x string").select(*text.text_statistics(F.col("x"))).collect()
    assert tuple(row[0])[:2] == (8, 3) and row[0]["txt_punc_cnt"] == 2
    assert abs(row[0]["txt_upper_ratio"] - 1 / 8) < 1e-4 and abs(row[0]["txt_digit_ratio"] - 1 / 8) < 1e-4
    assert tuple(row[1]) == (0, 0, 0.0, 0.0, 0.0, 0)


def test_pair_text(spark):
    rows = [(" Quill & Ink ", "7 Mill Lane", "FR"), ("nan", None, "<na>")]
    found = values(spark, rows, "n string, a string, c string", text.pair_text(F.col("n"), F.col("a"), F.col("c")))
    assert found == [("name: Quill & Ink | addr: 7 Mill Lane | country: FR",), ("name:  | addr:  | country: ",)]


def test_blend(spark):
    rows = [(0.8, 0.6, 0.4), (None, 0.6, 0.4), (float("nan"), 0.8, 0.4), (5.0, 5.0, 5.0), (-1.0, -1.0, -1.0)]
    cols = [F.col(c) for c in "abc"]
    assert [round(x, 6) for (x,) in values(spark, rows, "a double, b double, c double", scores.blend(*cols))] == [0.65, 0.5, 0.6, 1.0, 0.0]
    assert [round(x, 6) for (x,) in values(spark, rows[:1], "a double, b double, c double", scores.blend(*cols, weights=(2, 1, 1)))] == [0.65]
    assert [round(x, 6) for (x,) in values(spark, rows[:1], "a double, b double, c double", scores.blend(*cols, weights=(0, 0, 0)))] == [0.6]


def test_focal_loss(spark):
    import math

    found = values(spark, [(2.0, 1.0), (2.0, 0.0)], "x double, y double", scores.focal_loss(F.col("x"), F.col("y")))
    p = 1 / (1 + math.exp(-2))
    assert abs(found[0][0] - 0.25 * (1 - p) ** 2 * -math.log(p)) < 1e-9
    assert abs(found[1][0] - 0.75 * p**2 * -math.log(1 - p)) < 1e-9


def test_ascii_fold_is_fold_text(spark):
    """Texts of ASCII stay in the JVM, others go through the kernel: both are fold_text()."""
    rows = [("Plain ASCII, 12!",), ("Crème Brûlée",), ("ﬁne № ½",), ("",), (None,), ("tab\tand\nline",), ("日本 Ltd",), ("İstanbul",), ("K",)]
    found = values(spark, rows, "a string", kernels.ascii_fold(F.col("a")))
    assert [x for (x,) in found] == [kernels.fold_text(x) for (x,) in rows]
