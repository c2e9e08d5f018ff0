"""The stages against brute force, each on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tributary.llm import common

from .conftest import words
from .test_decontamination import expected as contaminated
from .test_line_dedup import expected as cleaned
from .test_simhash import expected as classes


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    item = words(900, 25)
    rows = []
    for k in range(120):
        text = words(k % 40 if k > 80 else k, 70) + ".\nline " + words(k // 3, 12) + "\n" + words(500 + k % 7, 15) + "."
        if k % 9 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if k % 10 == 4:
            text += "\n" + item[20:90]
        rows.append((k, text, "en", "s", len(text)))
    rows += [(500, None, None, None, None), (501, "", "en", "s", 0), (None, words(3, 30), "en", None, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(k, int(k % 9 > 0), 0) for k in range(0, 120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, "too short"), (3, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages(spark, tables):
    folder, rows = tables
    docs = common.table(spark, folder, "documents")
    columns = docs.columns

    kept = common.stored(cp.keep_quality(spark, docs, folder), "t")
    assert kept.columns == columns
    ids = {r[0] for r in collected(kept)}
    assert {k for k in range(120) if k % 9} <= ids and not {k for k in range(0, 120, 9)} & ids

    before = collected(kept)
    lines = common.stored(cp.drop_lines(spark, kept, folder), "t")
    want = {d: t for d, t, *_ in cleaned(before)}
    assert lines.columns == columns
    assert sorted(((r[0], r[1], r[4]) for r in collected(lines)), key=str) == sorted(((d, t, len(t)) for d, t in want.items()), key=str)

    before = collected(lines)
    single = common.stored(cp.drop_near_duplicates(spark, lines, folder), "t")
    assert single.columns == columns
    first = {c for d, _, c in classes(before) if d is not None}
    assert collected(single) == sorted((r for r in before if r[0] is None or r[0] in first), key=str)

    before = collected(single)
    clean = common.stored(cp.drop_contaminated(spark, single, folder), "t")
    items = [(1, words(900, 25)), (2, "too short")]
    hit = {d for d, _, h, _ in contaminated(before, items) if h}
    assert hit and clean.columns == columns
    assert collected(clean) == sorted((r for r in before if r[0] not in hit), key=str)

    packed = cp.pack_documents(spark, clean, folder)
    assert {r["doc_id"] for r in packed.collect()} == {r[0] for r in collected(clean)}
    whole = cp.run(spark, folder)
    assert whole.columns == packed.columns
    assert sorted(r[:5] for r in whole.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").na.fill(-1, "doc_id").collect()) == sorted(r[:5] for r in packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").na.fill(-1, "doc_id").collect())


def test_empty_tables(spark, tables, tmp_path, empty):
    folder, _ = tables
    for name in ("labels", "benchmark"):
        common.table(spark, folder, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_clashing_columns(spark, tables, clashing):
    folder, _ = tables
    extra = clashing.columns[5:]
    values = {tuple(r) for r in clashing.select(*[f"`{c}`" for c in extra]).collect()}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, clashing, folder)
        assert out.columns == clashing.columns, name
        assert {tuple(r) for r in out.select(*[f"`{c}`" for c in extra]).collect()} == values, name
    assert clashing.select(F.count("*")).first()[0] > 0


def test_decisions_are_of_rows(spark, tables):
    """Null and shared doc_ids: copies go, another text stays, and only the row that is hit goes."""
    folder, _ = tables
    item = words(900, 25)
    a, b, c, d = (words(k, 40) for k in range(700, 704))
    rows = [(None, a), (5, a), (5, b), (None, c), (None, c + " tail"), (7, d), (7, a + " tail"), (None, item), (9, item + " more"), (9, words(704, 40))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    single = common.stored(cp.drop_near_duplicates(spark, docs, folder), "t")
    found = sorted(((r["doc_id"], r["text"]) for r in single.collect()), key=str)
    pairs = [x for x in found if x[1] in (c, c + " tail")]
    assert len(pairs) == 1
    assert [x for x in found if x not in pairs] == sorted([(5, a), (5, b), (7, d), (9, item + " more"), (9, words(704, 40))], key=str)
    clean = cp.drop_contaminated(spark, docs, folder)
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted((x for x in rows if item not in x[1]), key=str)
