import itertools
import random

import numpy as np
import xxhash

from tributary.llm import graph, simhash


def plain(text):
    words = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def classes(nodes, near):
    label = {x: x for x in nodes}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if near(a, b):
            a, b = top(a), top(b)
            label[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}


def expected(rows):
    fps = [(d, plain(t)) for d, t, *_ in rows]
    of = classes(sorted({f for _, f in fps}), lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 4)
    least = {}
    for d, f in fps:
        if d is not None:
            least[of[f]] = min(d, least.get(of[f], d))
    return sorted(((d, f, least.get(of[f])) for d, f in fps), key=str)


def test_fingerprints_and_classes_are_brute_force(nasty, nasty_rows):
    found = simhash.near_duplicates(nasty).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected(nasty_rows)


def test_clashing_columns_and_empty_table(clashing, nasty_rows, empty):
    assert sorted((tuple(r) for r in simhash.near_duplicates(clashing).collect()), key=str) == expected(nasty_rows)
    assert simhash.near_duplicates(empty).collect() == []


def test_links_of_a_dense_group_in_hot_buckets(spark):
    r = random.Random(5)
    centre = r.getrandbits(64)
    fps = {centre}
    for _ in range(600):
        x = centre
        for b in r.sample(range(64), r.randint(0, 9)):
            x ^= 1 << b
        fps.add(x)
    fps |= {r.getrandbits(64) for _ in range(300)}
    signed = sorted(int(np.uint64(x).view(np.int64)) for x in fps)
    distinct = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = classes(signed, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 4)
    for hot in (50, 8192):
        edges = simhash.links(distinct, len(signed), hot_bucket=hot)
        roots = {r["node"]: r["root"] for r in graph.components(edges).collect()}
        assert {x: roots.get(x, x) for x in signed} == want


def test_every_pair_meets_in_a_bucket():
    r = random.Random(3)
    for n in (10, 10**6, 10**11):
        masks = simhash.block_masks(n)
        for _ in range(300):
            a = r.getrandbits(64)
            b = a
            for k in r.sample(range(64), 4):
                b ^= 1 << k
            assert any(a & (m & (1 << 64) - 1) == b & (m & (1 << 64) - 1) for m in masks)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (3, 2)]
    found = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_the_pivot_table_discards_pairs(spark):
    """More pivots leave fewer pairs to verify, and always all that are close."""
    r = random.Random(11)
    near = [r.getrandbits(64) for _ in range(40)]
    near += [x ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for x in near]
    # Alike in most blocks and far apart in the rest.
    wide = [(x & ~0xFFFFFF) | r.getrandbits(24) for x in near for _ in range(3)]
    signed = sorted({int(np.uint64(x).view(np.int64)) for x in near + wide})
    distinct = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = {n: simhash.filter_counts(distinct, len(signed), n_pivots=n).first() for n in (1, 8, 32)}
    assert len({(c["compared"], c["close"]) for c in found.values()}) == 1 and found[1]["close"] > 0
    assert found[1]["compared"] >= found[1]["verified"] > found[8]["verified"] > found[32]["verified"] >= found[32]["close"]
