"""SimHash near-duplicates by pivot distance tables.

A fingerprint has a bit for each position that is set in over half the hashes of a text's word shingles. Pairs within
max_bits of each other are found among distinct fingerprints:

1. Buckets by block banding: with b blocks of the 64 bits and up to k differing bits, at least b - k blocks are equal, so
   every pair meets in the bucket of a choice of b - k blocks and their contents. b grows with the number of fingerprints
   so that a bucket's key has at least log2 of it bits.
2. In a bucket, the pivot distance table: the Hamming distances of each fingerprint to PIVOTS reference fingerprints. By
   the triangle inequality two fingerprints within k bits differ by at most k in each coordinate; pairs with a larger
   maximum difference are discarded and the survivors are verified by their own distance.
3. Each task gives back a spanning forest of the pairs it verified, never the pairs. Components of the forests' union are
   the components of all pairs.

The pivot table is what decides within a bucket; it can't stand alone, as distances to a pivot all lie near 32 and a table
over all fingerprints would have to look at all pairs. How many pairs it discards is given by filter_counts(). A bucket of
more than HOT_BUCKET fingerprints is dealt out as pairs of its parts, so that no task holds more than two parts; all pairs
of parts are compared. Exact copies are one fingerprint before any of this.

Null and empty texts, and those of white space, have fingerprint zero and are linked like any other. Repeated rows give
repeated rows of the result. A row with a null doc_id gets the component of its fingerprint, whose number is the smallest
non-null doc_id (null if there is none). Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, graph

SHINGLE, MAX_BITS, SEED = 4, 4, 42
PIVOTS, HOT_BUCKET = 32, 8192
#: Shingles whose bits are counted at a time, and verified pairs after which a task sums up its forest.
_STEP, _PAIRS = 1 << 16, 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The signed 64-bit SimHash of a UTF-8 text."""
    words = text.translate(common.ASCII_LOWER).split()
    if not words:
        return 0
    joined, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: max(1, len(words) - shingle + 1)], ends[min(shingle, len(words)) - 1 :]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _STEP):
        hashes = [digest(joined[s:e], seed) for s, e in zip(starts[at : at + _STEP].tolist(), ends[at : at + _STEP].tolist())]
        counts += np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) per row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches):
            found = [fingerprint(x, shingle, seed) for x in common.utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    return common.map_batches(docs, [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")], step, "doc_id bigint, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(n: int, max_bits: int = MAX_BITS) -> list[int]:
    """Masks of every choice of blocks - max_bits blocks, for the least number of blocks with keys of log2(n) bits."""
    for blocks in range(max_bits + 1, 33):
        cuts = [64 * k // blocks for k in range(blocks + 1)]
        parts = [(1 << b) - (1 << a) for a, b in itertools.pairwise(cuts)]
        kept = blocks - max_bits
        if kept * (64 // blocks) >= math.log2(max(n, 2)) or blocks == 32:
            break
    return [_signed(sum(chosen)) for chosen in itertools.combinations(parts, kept)]


def pivots(n: int = PIVOTS) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % k) for k in range(n)], np.uint64)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the pairs but the least of its component, and that least one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _close_pairs(fps: np.ndarray, last: np.ndarray, table: np.ndarray, max_bits: int, counts: dict[str, int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs of fingerprints in the same run; last is the index of the run's last row. counts adds up pairs by what became of them."""
    unsigned, at, lag = fps.view(np.uint64), np.arange(len(fps)), 1
    counts = {} if counts is None else counts
    while len(at := at[at + lag <= last[at]]):
        left = at
        counts["compared"] = counts.get("compared", 0) + len(at)
        for some in (slice(0, 4), slice(4, None)):
            left = left[np.abs(table[left, some] - table[left + lag, some]).max(axis=1, initial=0) <= max_bits]
        counts["verified"] = counts.get("verified", 0) + len(left)
        left = left[np.bitwise_count(unsigned[left] ^ unsigned[left + lag]) <= max_bits]
        counts["close"] = counts.get("close", 0) + len(left)
        if len(left):
            yield fps[left], fps[left + lag]
        lag += 1


def _link_batches(batches: Iterator[pa.RecordBatch], refs: np.ndarray, max_bits: int, counts: dict[str, int] | None = None) -> Iterator[pa.RecordBatch]:
    """Rows (set, key, part, fp) sorted by the first three."""
    held: list[np.ndarray] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []
    n_found = 0

    def runs(rows: list[np.ndarray]) -> None:
        nonlocal n_found
        fps = rows[3]
        table = np.bitwise_count(fps.view(np.uint64)[:, None] ^ refs[None, :]).astype(np.int8)
        ends = np.flatnonzero(np.r_[np.any([r[1:] != r[:-1] for r in rows[:3]], axis=0), True])
        last = np.repeat(ends, np.diff(np.r_[-1, ends]))
        for pair in _close_pairs(fps, last, table, max_bits, counts):
            found.append(pair)
            n_found += len(pair[0])
            if n_found > _PAIRS:
                merged = _forest(*(np.concatenate(x) for x in zip(*found)))
                found[:] = [merged]
                n_found = len(merged[0])

    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held:
            rows = [np.concatenate([h, r]) for h, r in zip(held, rows)]
        # The last run may go on in the next batch.
        starts = np.flatnonzero(np.r_[True, np.any([r[1:] != r[:-1] for r in rows[:3]], axis=0)]) if len(rows[0]) else [0]
        cut = int(starts[-1])
        if cut:
            runs([r[:cut] for r in rows])
        held = [r[cut:] for r in rows]
    if held and len(held[0]):
        runs(held)
    if found:
        nodes, roots = _forest(*(np.concatenate(x) for x in zip(*found)))
        for at in range(0, len(nodes), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[at : at + 100_000], pa.int64()), pa.array(roots[at : at + 100_000], pa.int64())], ["u", "v"])


def _tally_batches(batches: Iterator[pa.RecordBatch], refs: np.ndarray, max_bits: int) -> Iterator[pa.RecordBatch]:
    counts = dict.fromkeys(("compared", "verified", "close"), 0)
    for _ in _link_batches(batches, refs, max_bits, counts):
        pass
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()) for n in counts.values()], list(counts))


def _bucketed(distinct: DataFrame, n: int, max_bits: int, hot_bucket: int) -> DataFrame:
    """(set, key, part, fp) of every bucket, dealt out and sorted by the first three."""
    masks = block_masks(n, max_bits)
    keys = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("set", "key"))
    part: Column = F.lit(0)
    if n > hot_bucket:
        hot = keys.groupBy("set", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot_bucket).withColumn("parts", F.ceil(F.col("n") / hot_bucket).cast("int"))
        own = F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts")).cast("int")
        # Part numbers of pairs of parts; 0 where the bucket is not hot.
        pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.least(own, other) * F.col("parts") + F.greatest(own, other))
        keys = keys.join(hot.select("set", "key", "parts"), ["set", "key"], "left").withColumn("part", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(pairs)))
        part = F.col("part")
    return keys.select("set", "key", part.cast("int").alias("part"), "fp").repartition("set", "key", "part").sortWithinPartitions("set", "key", "part")


def links(distinct: DataFrame, n: int, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Spanning forests (u, v) of the pairs of distinct fingerprints (column fp, n rows) within max_bits."""
    refs = pivots(n_pivots)
    return _bucketed(distinct, n, max_bits, hot_bucket).mapInArrow(lambda batches: _link_batches(batches, refs, max_bits), "u bigint, v bigint")


def filter_counts(distinct: DataFrame, n: int, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """One row: pairs that meet in buckets (compared), those that the pivot table leaves (verified), and those within max_bits (close)."""
    refs = pivots(n_pivots)
    tallies = _bucketed(distinct, n, max_bits, hot_bucket).mapInArrow(lambda batches: _tally_batches(batches, refs, max_bits), "compared bigint, verified bigint, close bigint")
    return tallies.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("compared", "verified", "close")])


def candidate_pairs(marked: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Pairs (u, v), u < v, of the rows (doc_id, fp): a row with the least row of its fingerprint, and the least rows of linked fingerprints.

    Their components are those of all pairs within max_bits; a group of copies costs a pair a row.
    """
    distinct = common.stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    linked = links(distinct, distinct.count(), max_bits, n_pivots, hot_bucket).distinct()
    side = lambda x: distinct.select(F.col("fp").alias(x), F.col("first").alias(f"first_{x}"))
    apart = linked.join(side("u"), "u").join(side("v"), "v").select(F.least("first_u", "first_v").alias("u"), F.greatest("first_u", "first_v").alias("v"))
    same = marked.join(distinct, "fp").where("doc_id <> first").select(F.col("first").alias("u"), F.col("doc_id").alias("v"))
    found = common.stored(apart.unionByName(same), "simhash-pairs")
    common.discard(distinct)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED, n_pivots: int = PIVOTS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Per row: doc_id, fp, component_id (the smallest doc_id that links reach)."""
    marked = common.stored(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    distinct = common.stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    linked = graph.components(links(distinct, distinct.count(), max_bits, n_pivots, hot_bucket))
    named = linked.join(distinct, linked["node"] == distinct["fp"]).select("fp", "root", "first")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    moved = named.join(least, "root").select("fp", "least")
    # Stored, so that both sides of the last join are dealt out for it alone and Spark can split copies of one text.
    classes = common.stored(distinct.join(moved, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "classes")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
