"""Near-duplicates by SimHash and pivot distance tables, held to the exact Jaccard similarity of word shingles.

Words are split as in simhash; a text of fewer words than a shingle is one shingle, and texts without words are copies of
each other. Two texts are linked if 5-word shingles in both are at least 0.8 of those in either.

Texts with the same set of shingles are one set, known by its least row. The method of simhash comes first: fingerprints of
the sets' shingles, buckets, pivot tables and verified distances give pairs within its bits, and those that are 0.8 alike
are linked. Pairs of 0.8 that lie further apart than these bits are searched for among the components that result, so that
every pair is found:

1. Sets that SimHash has linked are in one component from the start and are not compared again.
2. Shingles have one order for all sets. A set of n posts the first n - ceil(0.8 n) + 1 of them; the first n - ceil(8 n / 9)
   + 1 of those are marked. Of two sets of 0.8 or more, a marked post of the smaller one is a post of the larger one, so a
   bucket's pairs are a marked set and a larger one. The order is rarest first, by counts of a sample: any order is exact,
   this one keeps phrases that many texts share out of the posts.
3. Every set has a bitmap of BITS parities of its shingles' hashes. Bits in which two bitmaps differ are shingles that only
   one of both has, so a pair with too many of them is dropped before its shingles are compared; no pair is lost. Pairs
   that are left are held to wider bitmaps, of 4 to 8 cells a shingle, before the shingles themselves are shuffled.
4. The smallest marked set of each bucket is compared with the larger sets there that are in another component, and components are formed. Then, in
   buckets that hold several components, all pairs across components are: a large group of near copies costs a row a
   member, unless its members are not alike. Large buckets are dealt out as pairs of their parts, none is collected.

SimHash alone cannot stand in for 2: by its collision probability (estimated, not measured) fingerprints of texts at 0.8 differ
by about 10 bits of 64, often more, and blocks that find 13 or more bits need tens of thousands of choices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, graph, simhash

SHINGLE, SIMILARITY, SEED = 5, 0.8, 42
#: Texts that the order of shingles is taken from, the count from which a shingle is told apart, and the most of those.
SAMPLE, OFTEN, MOST = 10_000, 3, 1_000_000
#: Members of a bucket's part, bits of a bitmap, and rows of a bucket that are compared with the rest at a time.
_PART, BITS, _ROWS = 4096, 1024, 256


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's word shingles, in order."""
    words = text.translate(common.ASCII_LOWER).split()
    if not words:
        return np.zeros(0, np.int64)
    joined, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: max(1, len(words) - shingle + 1)], ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist())], np.uint64).view(np.int64))


def n_posts(n: int, similarity: float) -> int:
    return n - int(np.ceil(similarity * n - 1e-9)) + 1 if n else 0


def n_marked(n: int, similarity: float) -> int:
    return n - int(np.ceil(2 * similarity / (1 + similarity) * n - 1e-9)) + 1 if n else 0


def bitmap(own: np.ndarray) -> np.ndarray:
    """Parities of the shingles in each of BITS cells, as 64-bit numbers."""
    odd = np.bincount((own.view(np.uint64) >> np.uint64(20)).astype(np.int64) & (BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_bitmap(own: np.ndarray) -> bytes:
    """The same parities in a number of cells that grows with the set: the least power of two of 4 cells a shingle, BITS at least."""
    cells = max(BITS, 1 << int(4 * len(own) - 1).bit_length()) if len(own) else BITS
    odd = np.bincount((own.view(np.uint64) >> np.uint64(20)).astype(np.int64) & (cells - 1), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_be_alike(n_a: int, a: bytes, n_b: int, b: bytes, similarity: float) -> bool:
    """False only for sets that are less alike, by their wide bitmaps: the wider one is folded to the other's width."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    if len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    total = n_a + n_b
    return (total - int(np.bitwise_count(x ^ y).sum())) / 2 >= similarity / (1 + similarity) * total - 1e-6


def _set_batches(batches: Iterator[pa.RecordBatch], shingle: int, similarity: float, often: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in common.sliced(batches):
        digests, sizes, posts, bits = [], [], [], []
        for text in common.utf8(batch.column(1)):
            own = shingles(text, shingle)
            digests.append(xxhash.xxh3_128_digest(own.tobytes()))
            sizes.append(len(own))
            bits.append(bitmap(own))
            if len(often) and len(own):
                at = np.minimum(np.searchsorted(often, own), len(often) - 1)
                own = own[np.argsort(np.where(often[at] == own, counts[at], 0), kind="stable")]
            posts.append(own[: n_posts(len(own), similarity)])
        marked = [n_marked(n, similarity) for n in sizes]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(posts, pa.list_(pa.int64())), pa.array(marked, pa.int64()), pa.array(bits, pa.list_(pa.int64()))], ["row", "digest", "n", "posts", "marked", "bits"])


def _shingle_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """The shingles of all rows that at least OFTEN of them hold, the MOST frequent ones, with their counts."""
    found = [np.zeros(0, np.int64)]
    for batch in common.sliced(batches):
        found += [shingles(x, shingle) for x in common.utf8(batch.column(1))]
    own, n = np.unique(np.concatenate(found), return_counts=True)
    own, n = own[n >= OFTEN], n[n >= OFTEN]
    first = np.argsort(-n, kind="stable")[:MOST]
    yield pa.RecordBatch.from_arrays([pa.array(own[first]), pa.array(n[first], pa.int64())], ["hash", "n"])


def _pack_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in common.sliced(batches):
        own = [shingles(x, shingle) for x in common.utf8(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in own], pa.binary()), pa.array([wide_bitmap(x) for x in own], pa.binary())], ["row", "held", "wide"])


def _near_batches(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in common.sliced(batches):
        sides = [c.to_pylist() for c in batch.columns[2:]]
        yield batch.select([0, 1]).filter(pa.array([may_be_alike(*x, similarity) for x in zip(*sides)], pa.bool_()))


def _alike_batches(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in common.sliced(batches):
        keep = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            a, b = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(both >= similarity * (len(a) + len(b) - both) - 1e-9)
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _run_pairs(n: np.ndarray, row: np.ndarray, label: np.ndarray, marked: np.ndarray, own: np.ndarray, bits: np.ndarray, alone: bool, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a marked member and a later one (members by size, then row) of another component that may be alike; of two parts, pairs across them."""
    firsts = np.flatnonzero(marked)
    ends = np.searchsorted(n, n[firsts] / similarity + 1e-6, side="right")
    for at in range(0, len(firsts), _ROWS):
        some, end = firsts[at : at + _ROWS], ends[at : at + _ROWS]
        low, high = int(some[0]) + 1, int(end.max())
        if low >= high:
            continue
        later = np.arange(low, high)
        fits = (later > some[:, None]) & (later < end[:, None]) & (label[later] != label[some][:, None])
        if not alone:
            fits &= own[later] != own[some][:, None]
        i, j = np.nonzero(fits)
        i, j = some[i], later[j]
        for k in range(0, len(i), 1 << 16):
            a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1)
            total = n[a] + n[b]
            keep = (total - apart) / 2 >= similarity / (1 + similarity) * total - 1e-6
            yield row[a[keep]], row[b[keep]]


def _pair_batches(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows (post, part, parts, own, n, row, label, marked, bits) in order of the first two, n and row; part is a pair of parts' number."""
    held: list[np.ndarray] = []

    def runs(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        post, part, parts, own, n, row, label, marked, bits = rows
        starts = np.flatnonzero(np.r_[True, (post[1:] != post[:-1]) | (part[1:] != part[:-1])])
        u, v, size = [], [], 0
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(post)]):
            if b - a < 2:
                continue
            alone = part[a] // parts[a] == part[a] % parts[a]
            for x, y in _run_pairs(n[a:b], row[a:b], label[a:b], marked[a:b], own[a:b], bits[a:b], alone, similarity):
                u.append(np.minimum(x, y))
                v.append(np.maximum(x, y))
                size += len(x)
            if size > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (u, v)], ["u", "v"])
                u, v, size = [], [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (u, v)], ["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]
        # Unsigned, as bits of a negative number would be counted in its absolute value.
        rows.append(batch.columns[-1].flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(batch.num_rows, -1))
        if held:
            rows = [np.concatenate([h, r]) for h, r in zip(held, rows)]
        # The last run may go on in the next batch.
        cut = int(np.flatnonzero(np.r_[True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])])[-1])
        if cut:
            yield from runs([r[:cut] for r in rows])
        held = [r[cut:] for r in rows]
    if held:
        yield from runs(held)


def _alike(pairs: DataFrame, sets: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Of the pairs (u, v) of rows those that are alike: bitmaps first, then bitmaps as wide as the sets need, then shingles.

    Only texts of pairs that the first leaves are read again. A set's shingles go into the shuffle once a pair, so only
    those of pairs that the second leaves do: the first say little of sets of many more shingles than BITS.
    """
    side = lambda x: sets.select(F.col("row").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.distinct().join(side("u"), "u").join(side("v"), "v")
    apart = F.aggregate(F.zip_with("bits_u", "bits_v", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    total = F.col("n_u") + F.col("n_v")
    pairs = common.stored(both.where((total - apart) / 2 >= total * F.lit(similarity / (1 + similarity)) - 1e-6).select("u", "v"), "pairs")
    rows = pairs.select(F.col("u").alias("row")).unionByName(pairs.select(F.col("v").alias("row"))).distinct()
    # Of all texts only those that a bitmap lets through are shuffled.
    texts = texts.where(common.may_hold(common.hashed_bits(rows), F.col("row")))
    held = texts.join(rows, "row", "left_semi").select("row", "text").mapInArrow(lambda batches: _pack_batches(batches, shingle), "row bigint, held binary, wide binary")
    held = common.stored(held, "shingles")
    u, v = (held.join(sets.select("row", "n"), "row").select(F.col("row").alias(x), F.col("n").alias(f"n_{x}"), F.col("wide").alias(f"wide_{x}")) for x in "uv")
    near = pairs.join(u, "u").join(v, "v").select("u", "v", "n_u", "wide_u", "n_v", "wide_v")
    near = common.stored(near.mapInArrow(lambda batches: _near_batches(batches, similarity), "u bigint, v bigint"), "near")
    u, v = (held.select(F.col("row").alias(x), F.col("held").alias(f"held_{x}")) for x in "uv")
    both = near.join(u, "u").join(v, "v").select("u", "v", "held_u", "held_v")
    found = common.stored(both.mapInArrow(lambda batches: _alike_batches(batches, similarity), "u bigint, v bigint"), "alike")
    for frame in (held, pairs, near):
        common.discard(frame)
    return found


def near_duplicates(texts: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, sample: int = SAMPLE) -> DataFrame:
    """(row, group) of rows with texts (row, text): row must be stored and unique, group is the least row that links reach."""
    texts = texts.select(F.col("row").cast("bigint").alias("row"), F.col("text").cast("string").alias("text"))
    share = min(1.0, sample / max(texts.count(), 1))
    some = texts.where(common.sampled(share, "row", F.lit("order")))
    known = some.repartition(1).mapInArrow(lambda batches: _shingle_batches(batches, shingle), "hash bigint, n bigint").toPandas().sort_values("hash")
    often, times = known["hash"].to_numpy(np.int64), known["n"].to_numpy(np.int64)

    sets = texts.mapInArrow(lambda batches: _set_batches(batches, shingle, similarity, often, times), "row bigint, digest binary, n bigint, posts array<bigint>, marked bigint, bits array<bigint>")
    sets = common.stored(sets, "sets")
    classes = common.stored(sets.groupBy("digest").agg(F.min("row").alias("first")), "classes")
    # Only rows that may be copies of others are held against the classes.
    copies = sets.select("row", "digest").join(classes, "digest").where("row <> first").select("row")
    copied = common.may_hold(common.hashed_bits(copies), F.col("row"))
    firsts = lambda rows: rows.where(~copied).unionByName(rows.where(copied).join(classes.select(F.col("first").alias("row")), "row", "left_semi"))

    marked = common.stored(simhash.fingerprints(firsts(texts), "row", "text", shingle), "fingerprints")
    near = _alike(simhash.candidate_pairs(marked), sets, texts, shingle, similarity)
    common.discard(marked)
    close = common.stored(graph.components(near), "labels")

    only = firsts(sets.select("row", "n", "marked", "posts"))
    posts = only.select("row", "n", "marked", F.posexplode("posts").alias("k", "post")).select("post", "row", "n", (F.col("k") < F.col("marked")).alias("marked"))
    buckets = posts.groupBy("post").agg(F.count("*").alias("members"), F.min(F.when(F.col("marked"), F.struct("n", "row"))).alias("c"))
    buckets = common.stored(buckets.where("members > 1 AND c IS NOT NULL").select("post", "members", F.col("c.n").alias("c_n"), F.col("c.row").alias("c_row")), "buckets")
    # Most posts are in one set alone: a bitmap of the others' keeps them out of the join's shuffle.
    posted = common.stored(posts.where(common.may_hold(common.hashed_bits(buckets.select("post")), F.col("post"))).join(buckets, "post"), "posted")

    stars = posted.where("row <> c_row AND n >= c_n").where(F.col("c_n") >= F.col("n") * F.lit(similarity) - 1e-6).select("row", "c_row").distinct()
    named = lambda node: close.select(F.col("node").alias(node), F.col("root").alias(f"{node}_root"))
    stars = stars.join(named("row"), "row", "left").join(named("c_row"), "c_row", "left").where("coalesce(row_root, row) <> coalesce(c_row_root, c_row)")
    linked = _alike(stars.select(F.least("row", "c_row").alias("u"), F.greatest("row", "c_row").alias("v")), sets, texts, shingle, similarity).unionByName(near)
    labels = common.stored(graph.components(linked), "labels")

    members = posted.select("post", "members", "row", "n", "marked").join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("root", "row")).drop("root")
    members = common.stored(members, "members")
    common.discard(posted)
    apart = members.groupBy("post").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("post")
    rows = members.join(apart, "post").join(sets.select("row", "bits"), "row")
    rows = rows.withColumn("parts", F.ceil(F.col("members") / _PART).cast("bigint")).withColumn("own", F.pmod(F.xxhash64("row", F.lit("part")), F.col("parts")))
    pairs_of = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1), lambda other: F.least(F.col("own"), other) * F.col("parts") + F.greatest(F.col("own"), other))
    rows = rows.select("post", F.explode(pairs_of).alias("part"), "parts", "own", "n", "row", "label", F.col("marked"), "bits")
    rows = rows.repartition("post", "part").sortWithinPartitions("post", "part", "n", "row")
    pairs = rows.mapInArrow(lambda batches: _pair_batches(batches, similarity), "u bigint, v bigint")
    linked = linked.unionByName(_alike(pairs, sets, texts, shingle, similarity))
    common.discard(members)
    common.discard(buckets)

    roots = common.stored(graph.components(linked).withColumnRenamed("node", "first"), "roots")
    found = classes.join(roots, "first", "left").select("digest", F.coalesce("root", "first").alias("group"))
    groups = common.stored(sets.select("row", "digest").join(found, "digest").select("row", "group"), "groups")
    for frame in (sets, classes, close, labels, roots):
        common.discard(frame)
    return groups
