import random
import re

import pytest

from tributary.llm import decontamination as dc


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(docs, items, window=10):
    out = []
    for d, t, *_ in docs:
        w, hit, found = plain_words(t), set(), set()
        for item, text in items:
            v = plain_words(text)
            for at in range(max(1, len(v) - window + 1) if v else 0):
                part = v[at : at + window]
                for k in range(len(w) - len(part) + 1):
                    if w[k : k + len(part)] == part:
                        hit.update(range(k, k + len(part)))
                        found.add(str(item))
        out.append((d, len(w), sorted(hit), sorted(found)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["id"], r["n_words"], list(r["hits"]), list(r["items"])) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(4)
    vocabulary = ["the", "of", "a", "b7", "Cé", "word", "x"]
    docs = [(k, " ".join(r.choices(vocabulary, k=r.randint(0, 40)))) for k in range(80)]
    items = [(k, ",".join(r.choices(vocabulary, k=r.choice([1, 3, 10, 12])))) for k in range(12)]
    items += [(90, None), (91, ""), (92, "!?"), (None, "the of")]
    docs += [(200, "-- " + items[3][1].upper() + " end"), (201, items[3][1]), (201, items[3][1]), (None, items[5][1]), (202, None)]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")


def test_brute_force(corpus):
    docs, items, d, b = corpus
    want = expected(docs, [i for i in items if i[0] is not None])
    assert found(dc.decontaminate(d, b)) == want
    assert found(dc.decontaminate(d, b, shard_bytes=200)) == want
    assert found(dc.decontaminate(d, b, window=3)) == expected(docs, [i for i in items if i[0] is not None], 3)


@pytest.mark.parametrize("block_bytes", [40, 1])
def test_blocks_are_united_over_one_index(corpus, monkeypatch, block_bytes):
    """Many blocks, one pass over the corpus."""
    docs, items, d, b = corpus
    built, searched = [], []
    build, search = dc.build_index, dc.search
    monkeypatch.setattr(dc, "build_index", lambda *a, **k: built.append(1) or build(*a, **k))
    monkeypatch.setattr(dc, "search", lambda *a, **k: searched.append(1) or search(*a, **k))
    assert found(dc.decontaminate(d, b, block_bytes=block_bytes, shard_bytes=300)) == expected(docs, [i for i in items if i[0] is not None])
    assert len(built) == 1 and len(searched) > 3


def test_bitmap_holds_every_test_word(spark):
    """A small bitmap posts more words, and the result is the same."""
    r = random.Random(8)
    docs = [(k, " ".join(f"w{r.randint(0, 300)}" for _ in range(30))) for k in range(40)]
    items = [(k, " ".join(docs[3 * k][1].split()[5:17])) for k in range(10)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for bits in (6, 8, 24):
        bitmap = dc.vocabulary(b, slot_bits=bits)
        assert len(bitmap) == 1 << bits >> 6
        index = dc.build_index(d, bitmap)
        assert found(dc.search(index, dc.Queries([(str(i), t.encode()) for i, t in items]))) == expected(docs, items)


def test_edge_cases(nasty, clashing, empty, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert len(found(dc.decontaminate(nasty, none))) == nasty.count()
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    rows = found(dc.decontaminate(clashing, items))
    assert len(rows) == nasty.count() and sum(bool(r[2]) for r in rows) == 2
    assert found(dc.decontaminate(empty, items)) == []


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha " + "x " * 30 + "beta gamma"), (4, "alpha beta gamma"), (5, "beta gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    rows = {r["id"]: r for r in dc.decontaminate(docs, items, window=3, slop=5).collect()}
    assert {k: list(r["near_items"]) for k, r in rows.items()} == {1: ["7"], 2: ["7"], 3: [], 4: ["7"], 5: []}
    assert {k for k, r in rows.items() if r["items"]} == {4}


def test_null_items_are_hit(spark):
    """Windows of a null item hit words and name no item."""
    docs = spark.createDataFrame([(1, "x a b c y"), (2, "x y")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b c"), (7, "b c")], "item_id long, text string")
    for size in (1 << 20, 1):
        found = {r["id"]: (list(r["hits"]), list(r["items"])) for r in dc.decontaminate(docs, items, block_bytes=size).collect()}
        assert found == {1: ([1, 2, 3], ["7"]), 2: ([], [])}
