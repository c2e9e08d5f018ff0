"""Quality classifier: a sparse rule ensemble that becomes Spark column expressions.

1. text_statistics() turns each whole text into numbers (STATISTICS).
2. On at most `sample` labelled rows, shallow boosted trees are grown; each path from a root to a node is a rule, a
   conjunction of comparisons of statistics.
3. Logistic regression with a lasso penalty over the rules keeps few of them.
4. RuleModel.score_column() compiles the rules that are left into one column expression, which scores all rows.

The labelled sample is a hash-ordered share of all labelled rows: where there are more than `sample`, a row is taken with
probability sample / rows, by its doc_id's hash. Everything else covers all rows.

Null and empty texts have statistics of 0 and a score like any other. Rows with a null or unlabelled doc_id are scored
and never learned from; of rows that share a labelled doc_id one is learned from. With no labels, or with labels of one class only, the score is the share of label 1 (0.5 with
none). Repeated rows are repeated in the result. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

STATISTICS = [
    "n_words", "mean_word", "long_words", "upper_words", "title_words", "distinct_words", "top_word", "bigram_repeats",
    "letters", "digits", "spaces", "plain_marks", "bars", "other_symbols", "exclamations", "n_lines", "repeated_lines",
    "words_per_line", "sentence_ends",
]
SAMPLE, THRESHOLD = 20_000, 0.7
#: A sample of up to so many rows, of a number and a label each, is broadcast.
BROADCAST_ROWS = 100_000
TREES, DEPTH, BINS, RATE, PENALTY = 24, 3, 32, 0.3, 2e-3

_LETTERS = bytes(c for c in range(256) if c >= 0x80 or chr(c).isalpha())
_DIGITS, _SPACES, _PLAIN = b"0123456789", b" \t\n\x0b\x0c\r", b".,;:'\"()-"
_OTHER = bytes(c for c in range(0x80) if c not in _LETTERS + _DIGITS + _SPACES + _PLAIN + b"|!" and c >= 0x20)


def statistics(text: str) -> list[float]:
    raw, words = text.encode(), text.split()
    n, size = len(words), len(raw)
    if not size:
        return [0.0] * len(STATISTICS)
    lines = [x for x in text.split("\n") if x.strip()]
    share = lambda kinds: (size - len(raw.translate(None, kinds))) / size
    counts = Counter(words)
    per_word = 1 / max(n, 1)
    return [
        float(n),
        sum(map(len, words)) * per_word,
        sum(len(w) > 20 for w in words) * per_word,
        sum(map(str.isupper, words)) * per_word,
        sum(map(str.istitle, words)) * per_word,
        len(counts) * per_word,
        max(counts.values(), default=0) * per_word,
        1 - len(set(zip(words, words[1:]))) / max(n - 1, 1) if n > 1 else 0.0,
        share(_LETTERS),
        share(_DIGITS),
        share(_SPACES),
        share(_PLAIN),
        raw.count(b"|") / size,
        share(_OTHER),
        raw.count(b"!") / size,
        float(len(lines)),
        1 - len(set(lines)) / max(len(lines), 1) if lines else 0.0,
        n / max(len(lines), 1),
        sum(raw.count(x) for x in (b".", b"!", b"?")) * per_word,
    ]


def _statistic_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.sliced(batches):
        rows = np.array([statistics(x.as_py() or "") for x in batch.column(1)], float).reshape(-1, len(STATISTICS))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in rows.T)], ["doc_id", *STATISTICS])


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and a double for each of STATISTICS, per row."""
    columns = [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    return docs.select(*columns).mapInArrow(_statistic_batches, "doc_id bigint, " + ", ".join(f"{s} double" for s in STATISTICS))


def _statistic_frame(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([statistics(x or "") for x in text], columns=STATISTICS)


def is_held_out(doc_id: Column) -> Column:
    """Rows whose crc32(doc_id as text) mod 4 is 2; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Rule:
    """Statistic, threshold and whether it lies above, for each comparison."""

    parts: tuple[tuple[int, float, bool], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        found = np.ones(len(x), bool)
        for k, cut, above in self.parts:
            found &= (x[:, k] > cut) == above
        return found

    def column(self, names: list[str], of: str | None = None) -> Column:
        """The rule over columns, or over the fields of the struct `of`."""
        found = None
        for k, cut, above in self.parts:
            value = F.col(of)[names[k]] if of else F.col(names[k])
            test = value > F.lit(cut) if above else value <= F.lit(cut)
            found = test if found is None else found & test
        return found


def _grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, rows: np.ndarray, parts: tuple, depth: int, rules: set, margin: np.ndarray) -> None:
    """One node: split it where the gain is largest, note both rules, or add its value to the margin of its rows."""
    g, h = slope[rows], curve[rows]
    value = -g.sum() / (h.sum() + 1)
    best = (1e-3, None, None)
    if depth:
        for k in range(x.shape[1]):
            if not len(cuts[k]):
                continue
            at = bins[rows, k]
            gl = np.cumsum(np.bincount(at, g, len(cuts[k]) + 1))[:-1]
            hl = np.cumsum(np.bincount(at, h, len(cuts[k]) + 1))[:-1]
            nl = np.cumsum(np.bincount(at, minlength=len(cuts[k]) + 1))[:-1]
            gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1)
            gain[(nl < 5) | (len(rows) - nl < 5)] = 0
            j = int(np.argmax(gain))
            if gain[j] > best[0]:
                best = (gain[j], k, j)
    if best[1] is None:
        margin[rows] += RATE * value
        return
    _, k, j = best
    for above in (False, True):
        path = (*parts, (k, float(cuts[k][j]), above))
        rules.add(Rule(path))
        _grow(x, bins, cuts, slope, curve, rows[(bins[rows, k] > j) == above], path, depth - 1, rules, margin)


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Rule]:
    """Rules of the paths of boosted trees under logistic loss."""
    cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    cuts = [c[c < col.max()] if len(col) else c[:0] for c, col in zip(cuts, x.T)]
    bins = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    margin, rules = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), set()
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        _grow(x, bins, cuts, p - y, p * (1 - p), np.arange(len(y)), (), depth, rules, margin)
    return sorted(rules, key=lambda r: (len(r.parts), r.parts))


def fit_lasso(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of logistic regression with an L1 penalty, by accelerated proximal gradient steps."""
    n, k = z.shape
    design = np.c_[z, np.ones(n)]
    vector = np.ones(k + 1)
    for _ in range(20):
        vector = design.T @ (design @ vector)
        vector /= np.linalg.norm(vector)
    rate = 4 * n / np.linalg.norm(design @ vector) ** 2
    w = np.zeros(k + 1)
    w[-1] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        slope = design.T @ (1 / (1 + np.exp(-np.clip(design @ ahead, -30, 30))) - y) / n
        new = ahead - rate * slope
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / grown * (new - w), new, grown
    return w[:-1], float(w[-1])


@dataclass(frozen=True)
class RuleModel:
    names: list[str]
    rules: list[Rule]
    weights: list[float]
    intercept: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, names: list[str], trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> RuleModel:
        if not len(y) or y.min() == y.max():
            mean = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
            return cls(names, [], [], float(np.log(mean / (1 - mean))))
        rules = grow_rules(x, y, trees, depth)
        z = np.stack([r.holds(x) for r in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
        weights, intercept = fit_lasso(z, y, penalty)
        kept = np.flatnonzero(weights)
        return cls(names, [rules[k] for k in kept], [float(weights[k]) for k in kept], intercept)

    def score_column(self, of: str | None = None) -> Column:
        margin = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            margin = margin + F.when(rule.column(self.names, of), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-margin))

    def predict(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            margin += weight * rule.holds(x)
        return 1 / (1 + np.exp(-margin))


def labelled(labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, label) of the labelled rows that are not held out, or of a hash-ordered share of about `sample` of them."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("double").alias("label")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    return known.where(common.sampled(sample / max(known.count(), 1), "doc_id", F.lit("sample")))


def _hinted(known: DataFrame, sample: int) -> DataFrame:
    return F.broadcast(known) if sample <= BROADCAST_ROWS else known


def fit_on(stats: DataFrame, known: DataFrame) -> RuleModel:
    """The model of the rows of stats (doc_id and STATISTICS) that have a label; one row, the least, for each doc_id and label."""
    rows = stats.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(*STATISTICS)).alias("s"))
    rows = rows.select("doc_id", "s.*", "label").toPandas().sort_values(["doc_id", "label"])
    return RuleModel.fit(rows[STATISTICS].to_numpy(float), rows["label"].to_numpy(float), STATISTICS)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    stats = common.stored(text_statistics(docs, id_col, text_col), "statistics")
    model = fit_on(stats, _hinted(labelled(labels, label_col, sample), sample))
    scored = stats.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), model.score_column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows, with their own columns, whose score reaches the threshold. Rows to learn from are picked before they are measured."""
    known = labelled(labels, label_col, sample)
    ids = _hinted(known.select("doc_id").distinct(), sample)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = fit_on(text_statistics(rows.join(ids, "doc_id", "left_semi")), _hinted(known, sample))
    measure = F.pandas_udf(_statistic_frame, T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS]))
    (name,) = common.fresh(docs, "statistics")
    found = docs.withColumn(name, measure(F.col(text_col).cast("string")))
    return found.where(model.score_column(name) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
