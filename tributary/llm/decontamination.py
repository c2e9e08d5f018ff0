"""Benchmark decontamination over a distributed positional inverted index.

build_index() reads the corpus once and stores, shard by shard, the postings (document and word position) of every corpus
word that may occur in the test set. A shard is a run of documents, so that one very frequent word or passage is spread
over all shards. Words are known by their 64-bit hashes; whether the test set holds a word is looked up in a bitmap of
2^SLOT_BITS slots, whose size does not depend on the test set (a word that shares a slot is posted and never asked for).
search() takes the test windows of each item, starts from the term with the shortest posting list in the shard and
intersects the other lists after shifting them by their offsets (exact phrases), or looks for every term within `slop`
words of the rarest one (proximity). A test set larger than BLOCK_BYTES of text is searched in blocks over the same stored
index; each block's hits are written before the next block is read, so neither the driver nor a task holds more than one.

Words are runs of characters that are neither ASCII punctuation, space nor control, after A-Z are lower-cased. Null and
empty texts have no words, get a row with zeros and match nothing. Repeated rows are separate documents, whatever their
doc_id. Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 10
#: Documents of one shard hold about this many bytes of text.
SHARD_BYTES = 8 << 20
#: Test text of one block.
BLOCK_BYTES = 1 << 20
#: Slots of the bitmap of test words, in bits: 2 MB are sent to the executors.
SLOT_BITS = 24

#: Everything below 0x80 that is no letter or digit separates words.
_WORDS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).translate(common.ASCII_LOWER)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def word_hash(word: bytes) -> int:
    raw = xxhash.xxh64_intdigest(word)
    return raw - (1 << 64) if raw >> 63 else raw


class Queries:
    """Windows of test items: each is a row of term numbers, with the items that hold it."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW) -> None:
        self.window = window
        terms: dict[bytes, int] = {}
        held: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            found = [terms.setdefault(w, len(terms)) for w in words(text)]
            for at in range(max(1, len(found) - window + 1) if found else 0):
                held[tuple(found[at : at + window])].add(item)
        self.hashes = np.fromiter(map(word_hash, terms), np.int64, len(terms))
        self.windows = [np.array(w, dtype=np.int64) for w in held]
        self.items = [sorted(i for i in x if i is not None) for x in held.values()]
        # Shorter windows repeat their first term, which leaves the rarest one as it is.
        self.matrix = np.array([np.resize(w, window) for w in self.windows], dtype=np.int64).reshape(-1, window)


def vocabulary(benchmark: DataFrame, text_col: str = "text", slot_bits: int = SLOT_BITS) -> np.ndarray:
    """The bitmap of the slots of all words of the test set, as 64-bit numbers."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches):
            own = {word_hash(w) & (1 << slot_bits) - 1 for text in common.utf8(batch.column(0)) for w in words(text)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(own), pa.int64())], ["slot"])

    slots = benchmark.select(F.col(text_col).cast("string").alias("text")).mapInArrow(step, "slot bigint")
    bits = slots.groupBy(F.shiftright("slot", 6).alias("k")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toPandas()
    bitmap = np.zeros(1 << slot_bits >> 6, np.int64)
    bitmap[bits["k"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.int64)
    return bitmap


class _Terms(dict):
    """Numbers of a shard's words, from 0 in the order they come; -1 for those whose slot is not set."""

    def __init__(self, bitmap: np.ndarray) -> None:
        super().__init__()
        self.bitmap, self.mask, self.hashes = bitmap, (len(bitmap) << 6) - 1, []

    def __missing__(self, word: bytes) -> int:
        key = word_hash(word)
        slot = key & self.mask
        number = -1
        if int(self.bitmap[slot >> 6]) >> (slot & 63) & 1:
            number = len(self.hashes)
            self.hashes.append(key)
        self[word] = number
        return number


def _index_batches(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray, gap: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 33
    terms = _Terms(bitmap)
    ids: list = []
    counts: list[int] = []
    lists: list[np.ndarray] = []
    size = 0

    def shard() -> pa.RecordBatch:
        # A document's words follow those of the one before after a gap that no window can bridge.
        starts = np.zeros(len(counts), dtype=np.int64)
        np.cumsum(np.array(counts[:-1], dtype=np.int64) + gap, out=starts[1:])
        flat = np.concatenate(lists)
        at = np.arange(len(flat), dtype=np.int64) + np.repeat(np.arange(len(counts), dtype=np.int64) * gap, counts)
        posted = flat >= 0
        flat, at = flat[posted], at[posted]
        hashes = np.array(terms.hashes, np.int64)
        by = np.argsort(hashes, kind="stable")
        place = np.empty(len(by), np.int32)
        place[by] = np.arange(len(by), dtype=np.int32)
        flat = place[flat]
        order = np.argsort(flat, kind="stable")
        flat, at = flat[order], at[order]
        first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, np.int64)
        columns = [
            pa.array([row], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([counts], pa.list_(pa.int64())),
            pa.array([starts], pa.list_(pa.int64())),
            pa.array([hashes[by][flat[first]]], pa.list_(pa.int64())),
            pa.array([first], pa.list_(pa.int64())),
            pa.array([at.astype("<i8").tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["row", "ids", "counts", "starts", "terms", "firsts", "postings"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = words((text.as_py() or "").encode())
            ids.append(doc)
            counts.append(len(found))
            lists.append(np.fromiter(map(terms.__getitem__, found), np.int32, len(found)))
            size += sum(map(len, found)) + 64
            if size >= shard_bytes:
                yield shard()
                row += len(ids)
                ids, counts, lists, size = [], [], [], 0
                terms = _Terms(bitmap)
    if ids:
        yield shard()


#: row is the number of a shard's first document; the others follow.
INDEX = "row bigint, ids array<bigint>, counts array<bigint>, starts array<bigint>, terms array<bigint>, firsts array<bigint>, postings binary"


def build_index(docs: DataFrame, bitmap: np.ndarray, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, gap: int = WINDOW) -> DataFrame:
    """A row per shard: its documents, their word counts, and the posting list of each test term, stored in the shared folder.

    No phrase or proximity match may be longer than gap words.
    """
    frame = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return common.stored(frame.mapInArrow(lambda batches: _index_batches(batches, bitmap, gap, shard_bytes), INDEX), "postings")


def _within(lists: list[np.ndarray], rare: np.ndarray, slop: int) -> np.ndarray:
    """Positions of the rarest term that have every other term at most slop words away."""
    for other in lists:
        if not len(rare):
            break
        at = np.searchsorted(other, rare - slop)
        rare = rare[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= rare + slop)]
    return rare


def _search_batches(batches: Iterator[pa.RecordBatch], queries: Queries, slop: int | None, all_rows: bool) -> Iterator[pa.RecordBatch]:
    n_terms = len(queries.hashes)
    for batch in batches:
        for row in batch.to_pylist():
            counts, starts = np.array(row["counts"], np.int64), np.array(row["starts"], np.int64)
            at = np.frombuffer(row["postings"], "<i8")
            first = np.zeros(n_terms, np.int64)
            length = np.zeros(n_terms, np.int64)
            terms, firsts = np.array(row["terms"], np.int64), np.array(row["firsts"], np.int64)
            if len(terms) and n_terms:
                place = np.minimum(np.searchsorted(terms, queries.hashes), len(terms) - 1)
                held = terms[place] == queries.hashes
                first[held] = firsts[place[held]]
                length[held] = np.diff(np.r_[firsts, len(at)])[place[held]]
            hit = np.zeros(int(starts[-1] + counts[-1]) if len(counts) else 0, bool)
            matched: dict[int, set[str]] = defaultdict(set)
            near: dict[int, set[str]] = defaultdict(set)
            alive = np.flatnonzero(length[queries.matrix].min(axis=1) > 0) if len(queries.matrix) else []
            for k in alive:
                window = queries.windows[k]
                order = np.argsort(length[window], kind="stable")
                postings = [at[first[t] : first[t] + length[t]] for t in window]
                found = postings[order[0]] - order[0]
                for j in order[1:]:
                    if not len(found):
                        break
                    place = np.searchsorted(postings[j], found + j)
                    found = found[postings[j][np.minimum(place, len(postings[j]) - 1)] == found + j]
                if len(found):
                    for j in range(len(window)):
                        hit[found + j] = True
                    for doc in np.unique(np.searchsorted(starts, found, side="right") - 1):
                        matched[doc].update(queries.items[k])
                if slop is not None:
                    for doc in np.unique(np.searchsorted(starts, _within([postings[j] for j in order[1:]], postings[order[0]], slop), side="right") - 1):
                        near[doc].update(queries.items[k])
            hits = np.split(places := np.flatnonzero(hit), np.searchsorted(places, starts[1:]))
            shown = range(len(counts)) if all_rows else [k for k in range(len(counts)) if len(hits[k]) or k in near]
            columns = [
                pa.array([row["row"] + k for k in shown], pa.int64()),
                pa.array([row["ids"][k] for k in shown], pa.int64()),
                pa.array([int(counts[k]) for k in shown], pa.int64()),
                pa.array([hits[k] - int(starts[k]) for k in shown], pa.list_(pa.int64())),
                pa.array([sorted(matched.get(k, ())) for k in shown], pa.list_(pa.string())),
                pa.array([sorted(near.get(k, ())) for k in shown], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "n_words", "hits", "items", "near_items"])


FOUND = "row bigint, id bigint, n_words bigint, hits array<bigint>, items array<string>, near_items array<string>"


def search(index: DataFrame, queries: Queries, slop: int | None = None, all_rows: bool = True) -> DataFrame:
    """A row per document, or per one that is hit: its number and id, its words, the positions of those inside exact matches, the items matched exactly, and those within slop."""
    return index.mapInArrow(lambda batches: _search_batches(batches, queries, slop, all_rows), FOUND)


def blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The test items in blocks of bounded size; a larger item makes a block of its own. Null texts hold no window; of a null item they hit words but name no item."""
    block: list[tuple[str, bytes]] = []
    size = 0
    frame = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    for row in frame.where("text is not null").toLocalIterator():
        text = row["text"].encode()
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["item"], text))
        size += len(text)
    yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int | None = None, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: row (its number), id, n_words, hits (positions of hit words), items, near_items (all terms of a window within slop words).

    The corpus is read once. The blocks of a larger test set are searched over the stored index, and the hits of a row are united.
    """
    index = build_index(docs, vocabulary(benchmark), id_col, text_col, shard_bytes, max(window, slop or 0))
    left = blocks(benchmark, block_bytes=block_bytes)
    items, more = next(left), next(left, None)
    if more is None:
        return search(index, Queries(items, window), slop)
    path = common.scratch(docs.sparkSession, "hits")
    while items is not None:
        search(index, Queries(items, window), slop, all_rows=False).write.mode("append").parquet(path)
        items, more = more, next(left, None) if more is not None else None
    united = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("hits", "items", "near_items")]
    merged = docs.sparkSession.read.schema(FOUND).parquet(path).groupBy("row").agg(*united)
    rows = index.select("row", F.posexplode(F.arrays_zip("ids", "counts")).alias("k", "x")).select((F.col("row") + F.col("k")).alias("row"), F.col("x.ids").alias("id"), F.col("x.counts").alias("n_words"))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    return rows.join(merged, "row", "left").select("row", "id", "n_words", F.coalesce("hits", none("bigint")).alias("hits"), *[F.coalesce(c, none("string")).alias(c) for c in ("items", "near_items")])


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), q AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM q
), g AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), m AS (SELECT doc_id, i, q.n, item_id FROM g JOIN q ON g.n = q.n AND g.g = q.g
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
