import random

from pyspark.sql import functions as F

from tributary.llm import line_dedup


def expected(rows, min_docs=2):
    space = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(space))
    held = {}
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(d)
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if d is None or len(held.get(key(x), ())) < min_docs or d == min(held[key(x)])]
        out.append((d, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=str)


def test_brute_force(nasty, nasty_rows, clashing, empty):
    assert found(line_dedup.dedup_lines(nasty)) == expected(nasty_rows)
    assert found(line_dedup.dedup_lines(clashing)) == expected(nasty_rows)
    assert found(line_dedup.dedup_lines(empty)) == []


def test_random_lines(spark):
    r = random.Random(2)
    pool = ["  Some Shared Line\t", "some shared line", "ÉTAT de la ligne", "éTAT de la ligne", "short", "123456789", "1234567890", "", "another line here"]
    rows = [(k, "\n".join(r.choices(pool, k=r.randint(0, 6)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(line_dedup.dedup_lines(df)) == expected(rows)
    assert found(line_dedup.dedup_lines(df, min_docs=20)) == expected(rows, 20)


def test_other_columns_stay(nasty):
    assert line_dedup.dedup_lines(nasty).columns == ["doc_id", "lang", "source", "n_chars", "kept_text", "n_lines", "n_dropped"]


def test_any_column_names(nasty, nasty_rows):
    """Names of result columns are replaced, names that the operator uses itself stay."""
    names = ("kept_text", "n_lines", "n_dropped", "_drops", "_text", "_doc", "row", "places", "_row", "hash", "doc", "a.b")
    df = nasty.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    got = line_dedup.dedup_lines(df)
    assert found(got) == expected(nasty_rows)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", *names[3:], *names[:3]]
    other = line_dedup.dedup_lines(df, out=("x", "y", "z"))
    assert other.columns == [*[c for c in df.columns if c != "text"], "x", "y", "z"]
    assert {tuple(r) for r in other.select(*[f"`{c}`" for c in names]).collect()} == {tuple(range(len(names)))}


def test_rows_of_one_document_are_cleaned_apart(spark):
    """A document's own repetitions stay, in each of its rows; positions tell equal lines apart."""
    rows = [(1, "shared line here\nown line of one\nshared line here"), (1, "own line of one"), (2, "x\nshared line here\ny\n SHARED line here\nx"), (2, "y"), (2, None), (None, "shared line here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(line_dedup.dedup_lines(df)) == expected(rows)
    assert ("x\ny\nx", 5, 2) in {r[1:] for r in found(line_dedup.dedup_lines(df))}
