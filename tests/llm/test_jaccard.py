import itertools
import random

import numpy as np
import pytest

import corpus_pipeline as cp
from tributary.llm import common, jaccard

from .conftest import DOCS, words


def grams(text):
    w = (text or "").encode().translate(common.ASCII_LOWER).split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def groups(texts, similarity=0.8):
    """Brute force: the least index that links of every pair reach."""
    sets, root = [grams(t) for t in texts], list(range(len(texts)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] == sets[b] or both >= similarity * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return [top(k) for k in range(len(texts))]


@pytest.fixture(scope="module")
def texts():
    """Copies at similarities around 0.8, a shared phrase in many texts, short and empty ones."""
    r, phrase, out = random.Random(8), words(77, 30), [None, "", " \n", "one", "ONE", "one two three", words(90, 5)]
    for k in range(60):
        base = words(k, r.randint(30, 90)).split()
        out.append(" ".join(base) + (" " + phrase if k % 2 else ""))
        for _ in range(3):
            w = out[-1].split() if r.random() < 0.3 else list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = "other"
            out.append(" ".join(w) + " tail" * r.randint(0, 3))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("sample", [20_000, 0])
def test_groups_are_brute_force(spark, texts, sample):
    df = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    found = dict(jaccard.near_duplicates(df, sample=sample).collect())
    want = groups(texts)
    assert [found[k] for k in range(len(texts))] == want
    assert 60 < len(set(want)) < len(texts) - 60


def test_stage_takes_jaccard(spark, texts):
    """Most of these pairs are further apart than four bits of their fingerprints."""
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    kept = cp.drop_near_duplicates(spark, spark.createDataFrame(rows, DOCS), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(groups(texts)))


@pytest.mark.parametrize("part", [3, 4096])
def test_many_that_share_most_but_not_enough(spark, monkeypatch, part):
    """A passage that is most of many texts, in buckets that are dealt out in parts; sizes tie."""
    monkeypatch.setattr(jaccard, "_PART", part)
    r, passage = random.Random(5), words(300, 60)
    out = [f"{passage} {words(1000 + k, r.choice([2, 8, 8, 14]))}" for k in range(70)]
    out += [" ".join(x for j, x in enumerate(out[k].split()) if j != 30) for k in range(0, 70, 9)]
    found = dict(jaccard.near_duplicates(spark.createDataFrame(list(enumerate(out)), "row long, text string").repartition(3), sample=0).collect())
    assert [found[k] for k in range(len(out))] == groups(out)


def test_bitmaps_and_posts_lose_no_pair():
    """For random pairs around 0.8: a marked post of the smaller set is a post of the larger one, and the bitmaps let it pass."""
    r = random.Random(4)
    seen = 0
    for _ in range(4000):
        n = r.randint(1, 300)
        both = set(r.sample(range(10**6), n))
        a = both | set(r.sample(range(10**6, 2 * 10**6), r.randint(0, n // 4)))
        b = both | set(r.sample(range(2 * 10**6, 3 * 10**6), r.randint(0, n // 4)))
        if len(a & b) < 0.8 * len(a | b):
            continue
        seen += 1
        a, b = sorted((a, b), key=len)
        order = lambda x: (x * 7919 % 10007, x)
        a, b = sorted(a, key=order), sorted(b, key=order)
        assert set(a[: jaccard.n_marked(len(a), 0.8)]) & set(b[: jaccard.n_posts(len(b), 0.8)])
        x, y = (jaccard.bitmap(np.array([hash(("s", v)) for v in s], np.int64)) for s in (a, b))
        total = len(a) + len(b)
        assert (total - int(np.bitwise_count((x ^ y).view(np.uint64)).sum())) / 2 >= len(set(a) & set(b)) >= 0.8 / 1.8 * total - 1e-6
    assert seen > 1000


def test_simhash_links_come_first(spark, texts, monkeypatch):
    """The groups start from pairs of simhash's pivot tables; those that are not alike are not linked."""
    given = []
    candidate_pairs = jaccard.simhash.candidate_pairs

    def seen(marked):
        found = candidate_pairs(marked)
        given.extend(tuple(r) for r in found.collect())
        return found

    monkeypatch.setattr(jaccard.simhash, "candidate_pairs", seen)
    df = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    found = dict(jaccard.near_duplicates(df).collect())
    want = groups(texts)
    assert [found[k] for k in range(len(texts))] == want
    assert given and all(u < v for u, v in given) and any(want[u] == want[v] for u, v in given)


def test_shuffle_files_go_with_the_job(spark):
    """What a stored frame has shuffled does not stay on disk, and the session's setting is as before."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, tracker = spark.conf.get(key), spark._jsc.sc().env().mapOutputTracker()
    held = spark.range(0, 1000, 1, 3).groupBy("id").count()
    n = tracker.shuffleStatuses().size()
    back = common.stored(held.repartition(2, "count"), "t")
    assert back.count() == 1000 and spark.conf.get(key) == before
    assert tracker.shuffleStatuses().size() <= n + 1  # the count's own


def test_wide_bitmaps_lose_no_pair():
    """Bitmaps by size: pairs of 0.8 pass, also where both have different widths; most long pairs of 0.5 are dropped."""
    r, passed, far = np.random.default_rng(3), 0, 0
    for n in (1, 2, 5, 60, 500, 1000, 2040, 4090, 9000):
        for _ in range(12):
            both, more, other = np.split(r.integers(-(2**62), 2**62, 3 * n), 3)
            for share in (0, 0.1, 0.24, 0.5):
                k = int(share * n)
                a, b = np.unique(both), np.unique(np.concatenate([both, more[:k]]))
                c = np.unique(np.concatenate([both, other[:k]]))
                for x, y in ((a, b), (b, a), (b, c)):
                    shared = len(np.intersect1d(x, y))
                    fits = jaccard.may_be_alike(len(x), jaccard.wide_bitmap(x), len(y), jaccard.wide_bitmap(y), 0.8)
                    if shared >= 0.8 * (len(x) + len(y) - shared):
                        passed += 1
                        assert fits
                    elif n > 400 and share == 0.5:
                        far += 1
                        assert not fits
    assert passed > 300 and far > 100


def test_long_texts_that_share_a_part(spark, monkeypatch):
    """Texts of many more shingles than BITS: pairs that are not alike are dropped before their shingles are shuffled."""
    counts, stored = {"pairs": 0, "near": 0}, common.stored

    def seen(df, what):
        back = stored(df, what)
        if what in counts:
            counts[what] += back.count()
        return back

    monkeypatch.setattr(common, "stored", seen)
    passage = words(500, 2500)
    out = [f"{passage} {words(600 + k, 1500)}" for k in range(12)]
    out += [out[0] + " tail", out[5] + " end of it"]
    found = dict(jaccard.near_duplicates(spark.createDataFrame(list(enumerate(out)), "row long, text string").repartition(3), sample=0).collect())
    assert [found[k] for k in range(len(out))] == groups(out)
    assert counts["pairs"] > 40 and counts["near"] <= 8
