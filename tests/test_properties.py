import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions import kernels, text

SHORT = st.text(alphabet="abc dé", max_size=12)


@given(SHORT, SHORT)
@settings(max_examples=300, deadline=None)
def test_lcs_is_the_table(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert kernels.lcs_length(a, b) == table[-1][-1]


@given(SHORT, SHORT)
@settings(max_examples=300, deadline=None)
def test_jaro_winkler_is_symmetric_and_bounded(a, b):
    assert 0 <= kernels.jaro_winkler(a, b) <= 1
    assert abs(kernels.jaro_winkler(a, b) - kernels.jaro_winkler(b, a)) < 1e-9
    assert kernels.jaro_winkler(a, a) == (1.0 if a else 0.0)


@given(st.text(max_size=20))
@settings(max_examples=300, deadline=None)
def test_folded_text_is_lower_ascii(value):
    folded = kernels.fold_text(value)
    assert folded.isascii() and folded == folded.lower() == kernels.fold_text(folded)


@given(st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ", max_size=14))
@settings(max_examples=500, deadline=None)
def test_phonetic_codes_are_short(word):
    first, second = kernels.double_metaphone(word)
    assert len(first) <= 4 and len(second) <= 4 and set(first + second) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0")


def coded(word):
    """Soundex letter by letter."""
    digit = {c: d for d, letters in enumerate(("", "BFPV", "CGJKQSXZ", "DT", "L", "MN", "R")) for c in letters}
    letters = [c for c in word.upper() if "A" <= c <= "Z"]
    if not letters:
        return ""
    out, last = letters[0], digit.get(letters[0], 0)
    for c in letters[1:]:
        d = digit.get(c, 0)
        if d and d != last:
            out += str(d)
        last = d
    return (out + "000")[:4]


def test_soundex_of_random_words(spark):
    r = random.Random(3)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyzBWH '7", k=r.randint(0, 9))) for _ in range(3000)]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", text.soundex(F.col("w")).alias("c")).collect()
    assert all(row["c"] == coded(row["w"]) for row in got)


def test_lists_survive_the_codec(spark):
    r = random.Random(4)
    rows = [(["S2-%d" % r.randint(0, 99) for _ in range(r.randint(0, 6))],) for _ in range(300)]
    got = spark.createDataFrame(rows, "x array<string>").select("x", text.split_list(text.join_list(F.col("x"))).alias("y")).collect()
    assert all(row["y"] == list(dict.fromkeys(row["x"])) for row in got)


def test_lcs_side_by_side():
    draw = random.Random(3)
    texts = ["", "a", "\0b", "é", "x" * 64, "x" * 65] + ["".join(draw.choices("abc 1", k=draw.choice((3, 20, 63, 64, 65, 90)))) for _ in range(300)]
    a, b = [draw.choice(texts) for _ in range(3000)], [draw.choice(texts) for _ in range(3000)]
    assert kernels.lcs_lengths(a, b, 500).tolist() == [kernels.lcs_length(x, y) for x, y in zip(a, b)]
    assert kernels.lcs_lengths([], []).tolist() == []
