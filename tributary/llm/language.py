"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a lower-cased text in both directions, across words, and labels every position with
language probabilities; a document's probabilities are the mean over all its positions. Texts are read in windows of
WINDOW bytes, cut between characters, so that many windows take a step together; the state starts anew at a window, and
every byte of every whole text lies in one window. The network is written in numpy and trained by backpropagation through
time.

It learns from a bounded sample: at most about `sample` labelled documents that are not held out, shared out evenly among
the languages (so a rare one keeps all its documents, LEAST_ROWS at least), picked by the hash of their doc_ids. Of each it takes up to PIECES pieces of
PIECE bytes, spread evenly over the whole text. Prediction covers all rows and whole texts.

Null texts and texts without a letter get `und` and score 0. With no labelled text every text gets `und`; with one
language every text with a letter gets it. Rows with a null lang or doc_id are predicted, not learned from. Repeated
rows are repeated in the result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .quality import is_held_out

#: Documents to learn from, those of a language at least, and pieces of each with their bytes.
SAMPLE, LEAST_ROWS, PIECES, PIECE = 3000, 50, 8, 48
HIDDEN, STEPS, BATCH, RATE, SEED = 8, 240, 192, 0.02, 7
#: Bytes of a window, and bytes of text that are read together.
WINDOW, TOGETHER = 128, 1 << 18
_LETTER = regex.compile(r"\p{L}")


def windows(raw: np.ndarray, ends: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the windows of texts whose UTF-8 bytes follow each other in raw up to their ends."""
    begins = np.r_[0, ends[:-1]].astype(np.int64)
    n = -(-(ends - begins) // width)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    starts = np.repeat(begins, n) + width * within
    for _ in range(3):  # a character has at most three bytes after its first
        starts -= (within > 0) & (raw[starts] & 0xC0 == 0x80)
    lengths = np.diff(np.r_[starts, len(raw)])
    return starts[lengths > 0], lengths[lengths > 0]


def _gate(x: np.ndarray) -> np.ndarray:
    """The straight sigmoid: 0 up to -2.5, 1 from 2.5 on."""
    return np.clip(0.2 * x + 0.5, 0, 1)


@dataclass
class BiGRU:
    """Weights of both directions (update gate, reset gate, new state) and of the labels; ids are bytes."""

    languages: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> BiGRU:
        rng = np.random.default_rng(seed)
        w = {}
        for way in "fb":
            w[f"x{way}"] = rng.normal(0, 0.3, (3, 256, hidden))
            w[f"u{way}"] = rng.normal(0, 1 / np.sqrt(hidden), (3, hidden, hidden))
            w[f"o{way}"] = rng.normal(0, 1 / np.sqrt(2 * hidden), (hidden, len(languages)))
        w["c"] = np.zeros(len(languages))
        return cls(languages, {k: v.astype(np.float32) for k, v in w.items()})

    def positions(self, ids: np.ndarray, running: list[int]) -> np.ndarray:
        """Language probabilities (step, language, window) of windows ids (step, window) in order of falling length.

        running counts the windows that reach each step: the first ones. Steps beyond a window's end get 0.
        """
        scores = np.zeros((len(ids), len(self.languages), ids.shape[1]), np.float32)
        for way in "fb":
            x, u, out = self.weights[f"x{way}"].copy(), self.weights[f"u{way}"].copy(), self.weights[f"o{way}"].T.copy()
            # The gates' straight part is folded into their weights.
            x[:2] = 0.2 * x[:2] + 0.5
            u[:2] *= 0.2
            size = u.shape[1]
            h = np.zeros((running[0] if way == "f" and running else 0, size), np.float32)
            for t in range(len(ids)) if way == "f" else range(len(ids) - 1, -1, -1):
                n = running[t]
                h = h[:n] if len(h) >= n else np.concatenate([h, np.zeros((n - len(h), size), np.float32)])
                at = ids[t, :n]
                gates = []
                for k in (0, 1):
                    gate = h @ u[k]
                    gate += x[k].take(at, axis=0)
                    np.maximum(gate, 0, out=gate)
                    np.minimum(gate, 1, out=gate)
                    gates.append(gate)
                new = h @ u[2]
                new *= gates[1]
                new += x[2].take(at, axis=0)
                np.tanh(new, out=new)
                h = h - new
                h *= gates[0]
                h += new
                scores[t, :, :n] += out @ h.T
        scores += self.weights["c"][:, None]
        np.exp(np.clip(scores, -40, 40, out=scores), out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        for t, n in enumerate(running):
            scores[t, :, n:] = 0
        return scores

    def gradients(self, ids: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the weighted mean cross entropy over all positions of ids (step, window), by backpropagation through time."""
        steps, n = ids.shape
        tapes: dict[str, list] = {}
        scores = np.zeros((steps, n, len(self.languages)), self.weights["c"].dtype)
        for way in "fb":
            x, u = self.weights[f"x{way}"], self.weights[f"u{way}"]
            h, tape = np.zeros((n, u.shape[1]), u.dtype), []
            for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
                z, r = (_gate(x[k][ids[t]] + h @ u[k]) for k in (0, 1))
                gated = h @ u[2]
                new = np.tanh(x[2][ids[t]] + r * gated)
                after = new + z * (h - new)
                tape.append((t, h, z, r, gated, new, after))
                h = after
                scores[t] += h @ self.weights[f"o{way}"]
            tapes[way] = tape
        scores += self.weights["c"]
        p = np.exp(scores - scores.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(n), labels] -= 1
        p *= (weight / weight.sum() / steps)[None, :, None]
        slopes = {"c": p.sum(axis=(0, 1))}
        # The bytes in order, each with its run: slopes of a byte's weights are summed over its places.
        order = np.argsort(ids.ravel(), kind="stable")
        places = ids.ravel()[order]
        runs = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        for way in "fb":
            u, out, tape = self.weights[f"u{way}"], self.weights[f"o{way}"], tapes[way]
            size = u.shape[1]
            down = np.zeros((steps, n, 3 * size), p.dtype)
            befores, afters, carry = np.zeros((steps, n, size), p.dtype), np.zeros((steps, n, size), p.dtype), 0
            above = p @ out.T
            for t, h, z, r, gated, new, after in reversed(tape):
                dh = above[t] + carry
                dn = dh * (1 - z) * (1 - new * new)
                dz = dh * (h - new) * 0.2 * ((z > 0) & (z < 1))
                dr = dn * gated * 0.2 * ((r > 0) & (r < 1))
                carry = dh * z + dz @ u[0].T + dr @ u[1].T + (dn * r) @ u[2].T
                down[t, :, :size], down[t, :, size : 2 * size], down[t, :, 2 * size :] = dz, dr, dn
                befores[t], afters[t] = h, after
            flat = down.reshape(-1, 3 * size)
            dx = np.zeros((256, 3 * size), p.dtype)
            dx[places[runs]] = np.add.reduceat(flat[order], runs, axis=0)
            resets = np.stack([r for t, _, _, r, *_ in sorted(tape, key=lambda x: x[0])])
            gated_down = np.concatenate([down[:, :, : 2 * size], down[:, :, 2 * size :] * resets], axis=2).reshape(-1, 3 * size)
            du = befores.reshape(-1, size).T @ gated_down
            slopes[f"x{way}"] = dx.reshape(256, 3, size).transpose(1, 0, 2)
            slopes[f"u{way}"] = du.reshape(size, 3, size).transpose(1, 0, 2)
            slopes[f"o{way}"] = afters.reshape(-1, size).T @ p.reshape(-1, p.shape[2])
        return slopes

    def fit(self, examples: list[tuple[bytes, int]], steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> BiGRU:
        """examples: piece and language number. Adam over batches of pieces of one length, languages alike in number."""
        rng = np.random.default_rng(seed)
        by: dict[int, list] = {}
        for piece, language in examples:
            by.setdefault(len(piece), []).append((piece, language))
        groups = [(np.frombuffer(b"".join(p for p, _ in g), np.uint8).reshape(len(g), -1), np.array([k for _, k in g])) for _, g in sorted(by.items())]
        total = np.bincount([k for _, k in examples], minlength=len(self.languages))
        share = np.array([g[0].size for g in groups], float)
        share /= share.sum()
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            ids, labels = groups[rng.choice(len(groups), p=share)]
            some = rng.integers(0, len(ids), min(batch, 4 * len(ids)))
            for k, slope in self.gradients(ids[some].T, labels[some], (1 / total[labels[some]]).astype(np.float32)).items():
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                pace = rate * min(1, 2 * (1 - step / (steps + 1)))
                self.weights[k] = (self.weights[k] - pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


class Predictor:
    """Pools the position probabilities of whole texts."""

    def __init__(self, model: BiGRU, width: int = WINDOW, together: int = TOGETHER) -> None:
        self.model, self.width, self.together = model, width, together

    def _sums(self, raw: list[bytes]) -> np.ndarray:
        """The mean probabilities of each text; windows are read together up to a number of bytes."""
        sums = np.zeros((len(raw), len(self.model.languages)))
        flat, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw])
        starts, lengths = windows(flat, ends, self.width)
        order = np.argsort(-lengths, kind="stable")
        per = max(1, self.together // self.width)
        for k in range(0, len(order), per):
            some = order[k : k + per]
            at, long = starts[some], lengths[some]
            steps = np.arange(long[0])
            ids = flat[np.minimum(at + steps[:, None], len(flat) - 1)]
            found = self.model.positions(ids, np.searchsorted(-long, -steps, side="left").tolist())
            np.add.at(sums, np.searchsorted(ends, at, side="right"), found.sum(axis=0, dtype=float).T)
        return sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-300)

    def __call__(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        known = [k for k, x in enumerate(texts) if _LETTER.search(x)] if self.model.languages else []
        if known:
            found = self._sums([texts[k].lower().encode() for k in known])
            best = found.argmax(axis=1)
            for k, b, row in zip(known, best.tolist(), found):
                names[k], scores[k] = self.model.languages[b], float(min(1.0, row[b]))
        return names, scores


def pieces(text: str, most: int = PIECES, size: int = PIECE) -> list[bytes]:
    """Up to so many pieces of so many bytes of a lower-cased text, spread evenly over it; a shorter text is one piece."""
    raw = text.lower().encode()
    if len(raw) <= size:
        return [raw] if raw else []
    n = min(most, len(raw) // size)
    return [raw[at : at + size] for at in np.linspace(0, len(raw) - size, n).astype(int).tolist()]


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.sliced(batches):
        found = [(p, lang) for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for p in pieces(text or "")]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.binary()), pa.array([x for _, x in found], pa.string())], ["piece", "lang"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, steps: int = STEPS) -> BiGRU:
    """The network of the labelled documents that are not held out."""
    known = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    langs = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not langs:
        return BiGRU.new([])
    own = max(LEAST_ROWS, sample // len(langs))
    shares = F.create_map(*[F.lit(x) for lang, n in sorted(langs.items()) for x in (lang, own / n)])
    some = known.where(common.sampled(F.element_at(shares, F.col("lang")), "doc_id", F.lit("language")))
    rows = some.select("text", "lang").mapInArrow(_piece_batches, "piece binary, lang string").toPandas().sort_values(["lang", "piece"])
    languages = sorted(set(rows["lang"]))
    model = BiGRU.new(languages)
    if len(languages) > 1:
        number = {x: k for k, x in enumerate(languages)}
        model.fit([(bytes(p), number[x]) for p, x in zip(rows["piece"], rows["lang"])], steps)
    return model


def identify(docs: DataFrame, model: BiGRU, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Predictor(model)
        for part in common.sliced(batches, 500):
            names, scores = predict([x or "" for x in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return common.map_batches(docs, [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")], step, "doc_id bigint, lang_pred string, score double")


def op6_language(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
