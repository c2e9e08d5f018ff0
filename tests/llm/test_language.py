import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from tributary.llm import common, language

SYLLABLES = {"en": ["th", "er", "on", "an", "ing", "ou"], "fr": ["eau", "é", "oi", "que", "les", "è"], "de": ["sch", "ung", "ü", "ein", "keit", "ß"]}


def text(lang, seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 3))) for _ in range(n))


def plain_positions(model, raw):
    """Language probabilities of each byte of a window, one step after the other."""
    w, size = model.weights, model.weights["uf"].shape[1]
    scores = np.zeros((len(raw), len(model.languages))) + w["c"]
    for way in "fb":
        h = np.zeros(size)
        for t in range(len(raw)) if way == "f" else reversed(range(len(raw))):
            x, u = w[f"x{way}"][:, raw[t]].astype(float), w[f"u{way}"].astype(float)
            z, r = (np.clip(0.2 * (x[k] + h @ u[k]) + 0.5, 0, 1) for k in (0, 1))
            new = np.tanh(x[2] + r * (h @ u[2]))
            h = z * h + (1 - z) * new
            scores[t] += h @ w[f"o{way}"]
    p = np.exp(scores)
    return p / p.sum(axis=1, keepdims=True)


def test_gradients_are_numerical():
    model = language.BiGRU.new(["a", "b", "c"], hidden=4)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    r = np.random.default_rng(0)
    ids, labels, weight = r.integers(0, 256, (6, 5)), r.integers(0, 3, 5), r.random(5)

    def loss():
        p = [np.log(plain_positions(model, ids[:, k])[:, labels[k]]).mean() for k in range(5)]
        return -(np.array(p) * weight).sum() / weight.sum()

    slopes = model.gradients(ids, labels, weight)
    for name, w in model.weights.items():
        places = [tuple(x) for x in np.argwhere(np.abs(slopes[name]) > 1e-3)[:8]]
        assert places
        for at in places:
            old = w[at]
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-5 - slopes[name][at]) < 1e-6


def test_windows_cover_texts_between_characters():
    texts = [text(lang, k, 50) for k, lang in enumerate(SYLLABLES)] + ["", "日本語" * 100, "a", "é" * 128, "\U0001f600" * 64]
    raw = [t.encode() for t in texts]
    flat, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw])
    for width in (5, 16, 128):
        starts, lengths = language.windows(flat, ends, width)
        parts = [bytes(flat[a : a + n]).decode() for a, n in zip(starts, lengths)]
        assert "".join(parts) == "".join(texts)
        assert max(lengths) <= width + 3 and not set(ends) & {int(a + k) for a, n in zip(starts, lengths) for k in range(1, n)}


def test_batched_positions_are_the_plain_ones():
    """Windows of all lengths at once, whole texts pooled over all their bytes, long ones in parts."""
    model = language.BiGRU.new(["a", "b", "c"])
    texts = [text(lang, 7 * k, n) for k, (lang, n) in enumerate([("en", 3), ("fr", 200), ("de", 40), ("en", 1)])] + ["日本語 テキスト"]
    want = []
    for t in texts:
        raw = np.frombuffer(t.lower().encode(), np.uint8)
        starts, lengths = language.windows(raw, np.array([len(raw)]), 32)
        want.append(np.concatenate([plain_positions(model, raw[a : a + n]) for a, n in zip(starts, lengths)]).mean(axis=0))
    for together in (32, 64, 1 << 18):
        names, scores = language.Predictor(model, 32, together)(texts)
        assert names == [model.languages[int(np.argmax(w))] for w in want]
        assert np.allclose(scores, [w.max() for w in want], atol=1e-5)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(k, text(lang, k, 30), lang) for k in range(240) for lang in [list(SYLLABLES)[k % 3]]]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(corpus):
    rows, df = corpus
    model = language.fit(df, steps=200)
    found = {r["doc_id"]: r for r in language.identify(df, model).collect()}
    held = [k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    assert held and np.mean([found[k]["lang_pred"] == rows[k][2] for k in held]) > 0.97
    assert all(0 < r["score"] <= 1 for r in found.values())


def test_a_rare_language_is_learned(spark):
    """A sample far smaller than the table takes rows of every language, and the rare one is told apart."""
    rows = [(k, text("en" if k % 50 else "de", k, 12), "en" if k % 50 else "de") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, sample=100, steps=200)
    assert model.languages == ["de", "en"]
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(df, model).collect()}
    held = [k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    for lang in ("de", "en"):
        own = [k for k in held if rows[k][2] == lang]
        assert own and np.mean([found[k] == lang for k in own]) > 0.95


def test_shares_below_one_in_a_million(spark):
    """The sample follows the share, however small it is."""
    ids = spark.range(0, 200_000, numPartitions=4)
    assert 100 < ids.where(common.sampled(1e-3, "id")).count() < 320
    assert ids.where(common.sampled(1.0, "id")).count() == 200_000
    least = ids.select(F.min(F.xxhash64("id").bitwiseAND(F.lit((1 << 63) - 1))).alias("h")).first()["h"] / 2**63
    assert 0 < least < 5e-5
    assert ids.where(common.sampled(least * 1.000001, "id")).count() == 1
    some = spark.range(0, 40_000_000, numPartitions=8).where(common.sampled(5e-7, "id")).count()
    assert 5 <= some <= 40


def test_edge_cases(nasty, clashing, empty, spark):
    rows = [(1, None, "en"), (2, "word", None), (3, "", "fr"), (None, "word", "de")]
    none = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.identify(none, language.fit(none)).collect()} == {"und"}
    for df in (nasty, clashing):
        model = language.fit(df, steps=5)
        found = language.identify(df, model).collect()
        assert len(found) == df.count()
    und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert und == {33, 43, 53, 153, 163}
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") for r in found)
    assert language.identify(empty, model).collect() == []
    assert language.fit(empty).languages == []
