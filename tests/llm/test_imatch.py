import collections
import functools
import hashlib
import struct

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from tributary.llm import imatch

from .conftest import words


def run(df, tmp_path, monkeypatch):
    monkeypatch.setattr(imatch.common, "table", lambda *_: df)
    return imatch.op2_imatch(df.sparkSession, "").collect()


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)), r[1] or ""))


@pytest.mark.parametrize("quantiles, bucket_rows", [(256, 1000), (2, 3)])
def test_edits_and_neighbours(nasty, nasty_rows, tmp_path, monkeypatch, quantiles, bucket_rows):
    monkeypatch.setattr(imatch, "QUANTILES", quantiles)
    monkeypatch.setattr(imatch, "BUCKET_ROWS", bucket_rows)
    rows = order(nasty_rows)
    want = []
    for k, (d, t, *_) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        want.append((d, len(t), hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest()))
    found = run(nasty, tmp_path, monkeypatch)
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=str) == sorted(want, key=str)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    text = {d: t for d, t, *_ in nasty_rows}
    by = {}
    for r in found:
        assert by.setdefault(text[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"]


def test_clashing_columns_and_empty_table(clashing, empty, tmp_path, monkeypatch):
    assert len(run(clashing, tmp_path, monkeypatch)) == clashing.count()
    assert run(empty, tmp_path, monkeypatch) == []


def term_hash(word):
    return signed(xxhash.xxh64_intdigest(word.encode(), 42))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_terms(text):
    return sorted({term_hash(w) for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w})


def plain_fingerprint(terms, lexicon):
    """The parts, with Spark's hash: XXH64 with seed 42, each further value seeded with the hash so far."""
    folded = lambda values: functools.reduce(lambda h, v: xxhash.xxh64_intdigest(v, h), values, 42)
    own = [t for t in terms if t in lexicon] or terms
    part = lambda found: folded([struct.pack("<q", t) for t in found]) & 0x7FFFFFFF if found else 0
    out, held = [part(own)], [own] * imatch.SERIES
    for bits in imatch.SUBSETS:
        for k in range(imatch.SERIES):
            held[k] = [t for t in held[k] if folded([struct.pack("<q", t), struct.pack("<i", k)]) & ((1 << bits) - 1) == 0]
            out.append(part(held[k]))
    return out


def plain_likeness(a, b):
    best = 0.0
    for size in range(len(imatch.SUBSETS)):
        at = 1 + size * imatch.SERIES
        pairs = [(x, y) for x, y in zip(a[at : at + imatch.SERIES], b[at : at + imatch.SERIES]) if x or y]
        best = max(best, sum(x == y for x, y in pairs) / max(len(pairs), (imatch.SERIES + 1) // 2))
    return 1.0 if a == b else best


def test_lexicon_is_a_band(spark):
    docs = [(k, f"everywhere w{k % 4} only{k}") for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    table = imatch.lexicon(df, band=(0.1, 0.5)).first()["words"]
    assert {t for bucket in table for t in bucket} == {term_hash(w) for w in ("w0", "w1", "w2", "w3")}
    assert all(t & (len(table) - 1) == k for k, bucket in enumerate(table) for t in bucket)


def test_fingerprints_and_likeness_by_brute_force(spark, monkeypatch):
    """Whole documents of the test data: lexicon, parts of both texts, likeness of both pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = order((r["doc_id"], r["text"]) for r in docs.collect())
    df = collections.Counter(t for _, text in rows for t in plain_terms(text))
    lexicon = {t for t, n in df.items() if max(2, len(rows) * imatch.BAND[0]) <= n <= max(2, len(rows) * imatch.BAND[1])}
    prints = [plain_fingerprint(plain_terms(t), lexicon) for _, t in rows]
    want = {}
    for k, (d, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = plain_fingerprint(plain_terms(text[: len(text) - half] + following[:half]), lexicon)
        shown = lambda parts: "".join(f"{x:08x}" for x in parts)
        want[d] = (shown(prints[k]), shown(edited), round(plain_likeness(prints[k], edited), 9), round(plain_likeness(prints[k], prints[(k + 1) % len(rows)]), 9))
    found = {r["doc_id"]: (r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in run(docs, None, monkeypatch)}
    assert found == want


@pytest.mark.parametrize("quantiles, bucket_rows, fine", [(256, 200, 1024), (4, 5, 8), (3, 2, 2)])
def test_uneven_and_null_ids_make_even_buckets(spark, monkeypatch, quantiles, bucket_rows, fine):
    for name, value in (("QUANTILES", quantiles), ("BUCKET_ROWS", bucket_rows), ("FINE", fine)):
        monkeypatch.setattr(imatch, name, value)
    ids = [k for k in range(100)] + [10**6 + 2**k for k in range(20, 60)] + [-(2**63), 2**63 - 1, -5] + [None] * 60 + [7] * 3
    rows = [(d, f"text {k % 97}") for k, d in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    key = lambda r: (r[0] is None, -(r[0] or 0), signed(xxhash.xxh64_intdigest(r[1].encode(), 42)), r[1])
    by = sorted((r for r in rows if r[0] is not None), key=key)
    parts = -(-60 // bucket_rows)
    nulls = sorted((r for r in rows if r[0] is None), key=lambda r: (key(r)[2] % parts, *key(r)))
    want = by + nulls
    found = imatch.with_next(df, []).collect()
    assert sorted(((r["doc_id"], r["text"], r["next_text"]) for r in found), key=str) == sorted(((d, t, want[(k + 1) % len(want)][1]) for k, (d, t) in enumerate(want)), key=str)


def test_parts_are_hashes_of_the_subsets(spark):
    docs = [(k, " ".join(words(j, 30) for j in (k % 5, 50 + k % 3))) for k in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lexicon = imatch.common.stored(imatch.lexicon(df, band=(0.01, 0.9)), "lexicon")
    rows = {r["doc_id"]: r["f"] for r in imatch.add_fingerprint(df, "text", lexicon, "f").collect()}
    likeness = {r["a"]: r["x"] for r in spark.createDataFrame([(k, rows[0], rows[k]) for k in rows], "a long, p array<int>, q array<int>").select("a", imatch.likeness(F.col("p"), F.col("q")).alias("x")).collect()}
    assert likeness[0] == likeness[15] == 1.0
    assert min(likeness[5], likeness[10]) > max(likeness[1], likeness[2])
