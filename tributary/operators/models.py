"""Learners over feature columns, all of pyspark.ml, and the cascade that decides which pairs meet the expensive scorer."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions import text
from tributary.operators import mining, tabular
from tributary.sources import storage

CUTOFF, MAX_KEEP = 0.12, 8

LEARNERS: dict[str, Callable[..., object]] = {
    "gbt": lambda classify, seed, **o: (GBTClassifier if classify else GBTRegressor)(seed=seed, **({"maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "maxIter": 100} | o)),
    "forest": lambda classify, seed, **o: (RandomForestClassifier if classify else RandomForestRegressor)(seed=seed, **({"maxDepth": 8, "numTrees": 60} | o)),
    "linear": lambda classify, seed, **o: LogisticRegression(**({"regParam": 1e-4} | o)) if classify else LinearRegression(**({"elasticNetParam": 0.0, "regParam": 1.0} | o)),
}


class TreeModel:
    """One learner over named columns: fit, score, importances, save and load. Scores are probabilities or values."""

    def __init__(self, features: list[str], kind: str = "gbt", classify: bool = True, seed: int = 42, **options) -> None:
        if kind not in LEARNERS:
            raise KeyError(f"unknown learner {kind!r}; known: {', '.join(sorted(LEARNERS))}")
        self.features, self.kind, self.classify, self.seed, self.options = list(features), kind, classify, seed, options
        self.model: PipelineModel | None = None

    def fit(self, df: DataFrame, label: str = "label", validation: str | None = None, weight: str | None = None) -> TreeModel:
        """validation names a boolean column whose rows stop the boosting early; other learners leave those rows out.

        weight names a column with the number of equal rows that a row stands for.
        """
        learner = LEARNERS[self.kind](self.classify, self.seed, **self.options).setFeaturesCol("_features").setLabelCol("_label")
        rows = df.withColumn("_label", F.col(label).cast("double"))
        if validation and self.kind == "gbt":
            learner = learner.setValidationIndicatorCol(validation)
        elif validation:
            rows = rows.where(~F.col(validation))
        stages = [VectorAssembler(inputCols=self.features, outputCol="_features", handleInvalid="keep")]
        if weight:
            rows = rows.withColumn("_weight", F.col(weight).cast("double"))
            learner = learner.setWeightCol("_weight")
            if self.kind == "linear":
                stages.append(ElementwiseProduct(scalingVec=self._scales(rows), inputCol="_features", outputCol="_scaled"))
                learner = learner.setFeaturesCol("_scaled").setStandardization(False)
        self.model = Pipeline(stages=[*stages, learner]).fit(rows)
        return self

    def _scales(self, rows: DataFrame) -> list[float]:
        """One over each feature's deviation among the rows that stand for others, 0 for a constant: the learner's own
        deviations take weights for reliabilities, so that its penalty would not be that of the repeated rows."""
        n = rows.agg(F.sum("_weight")).first()[0] or 0.0
        means = rows.agg(*[F.sum(F.col(c) * F.col("_weight")) for c in self.features]).first()
        squares = rows.agg(*[F.sum((F.col(c) - (m or 0.0) / max(n, 1.0)) ** 2 * F.col("_weight")) for c, m in zip(self.features, means)]).first()
        deviations = [math.sqrt((x or 0.0) / max(n - 1, 1.0)) for x in squares]
        return [1 / d if d > 1e-9 else 0.0 for d in deviations]

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        """The rows with a score."""
        scored = self.model.transform(df)
        value = F.get(vector_to_array("probability"), F.lit(1)) if self.classify else F.col("prediction")
        return scored.select(*df.columns, value.alias(out))

    def importances(self) -> dict[str, float]:
        last = self.model.stages[-1]
        values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
        return dict(sorted(zip(self.features, map(float, values)), key=lambda x: (-x[1], x[0])))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    def load(self, path: str) -> TreeModel:
        self.model = PipelineModel.load(path)
        return self


class Ensemble:
    """Several learners whose scores are averaged by normalised weights."""

    def __init__(self, features: list[str], kinds: tuple[str, ...] = ("gbt", "forest"), weights: dict[str, float] | None = None, seed: int = 42, options: dict[str, dict] | None = None) -> None:
        self.members = {k: TreeModel(features, k, seed=seed, **(options or {}).get(k, {})) for k in kinds}
        weights = {k: float((weights or {}).get(k, 1.0)) for k in kinds}
        total = sum(weights.values())
        self.weights = {k: w / total if total > 0 else 1 / len(kinds) for k, w in weights.items()}

    def fit(self, df: DataFrame, label: str = "label", group: str | None = None, n_splits: int = 5, seed: int = 42) -> Ensemble:
        """With a group column, one fold of whole groups is kept for early stopping."""
        rows, validation = df, None
        if group:
            rows, validation = mining.group_split(df, group, label, n_splits, seed), "is_validation"
        for member in self.members.values():
            member.fit(rows, label, validation)
        return self

    def components(self, df: DataFrame) -> DataFrame:
        for kind, member in self.members.items():
            df = member.score(df, f"p_{kind}")
        return df

    def score(self, df: DataFrame, out: str = "p") -> DataFrame:
        total = F.lit(0.0)
        for kind, weight in self.weights.items():
            total = total + F.col(f"p_{kind}") * F.lit(weight)
        return self.components(df).withColumn(out, total)

    def save(self, path: str, thresholds: DataFrame | None = None) -> None:
        """A folder for each member, the weights, and the thresholds by country."""
        spark = SparkSession.active()
        for kind, member in self.members.items():
            member.save(f"{path}/{kind}")
        spark.createDataFrame(list(self.weights.items()), "kind string, weight double").coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
        if thresholds is not None:
            thresholds.write.mode("overwrite").parquet(f"{path}/thresholds")

    @classmethod
    def load(cls, path: str, features: list[str]) -> tuple[Ensemble, DataFrame | None]:
        """(ensemble, thresholds or None) as they were saved."""
        from tributary.sources.files import exists

        spark = SparkSession.active()
        weights = {r["kind"]: r["weight"] for r in spark.read.parquet(f"{path}/weights").collect()}
        found = cls(features, tuple(sorted(weights)), weights)
        for kind, member in found.members.items():
            member.load(f"{path}/{kind}")
        return found, spark.read.parquet(f"{path}/thresholds") if exists(spark, f"{path}/thresholds") else None

    def importances(self) -> dict[str, float]:
        mixed: dict[str, float] = {}
        for kind, member in self.members.items():
            own = member.importances()
            total = sum(own.values()) or 1.0
            for name, value in own.items():
                mixed[name] = mixed.get(name, 0.0) + self.weights[kind] * value / total
        return dict(sorted(mixed.items(), key=lambda x: (-x[1], x[0])))


class CrossValidation:
    """A model for each fold, scores of each row by the model that did not see it, and the models' mean on other rows."""

    def __init__(self, factory: Callable[[], TreeModel], metric: str = "roc_auc", n_splits: int = 5, seed: int = 42) -> None:
        self.factory, self.metric, self.n_splits, self.seed = factory, metric, n_splits, seed
        self.models: list[TreeModel] = []
        self.fold_scores: list[float] = []
        self.score = 0.0

    def fit(self, df: DataFrame, label: str, key: str, group: str | None = None, stratify: str | None = None) -> DataFrame:
        """The rows with fold and oof."""
        rows = mining.folds(df, self.n_splits, key, group, stratify, self.seed)
        out = None
        for k in range(self.n_splits):
            model = self.factory().fit(rows.where(F.col("fold") != k), label)
            part = model.score(rows.where(F.col("fold") == k), "oof")
            self.models.append(model)
            self.fold_scores.append(tabular.compute_metric(self.metric, part, label, "oof"))
            out = part if out is None else out.unionByName(part)
        self.score = tabular.compute_metric(self.metric, out, label, "oof")
        return out

    def predict(self, df: DataFrame, out: str = "p") -> DataFrame:
        total = F.lit(0.0)
        for k, model in enumerate(self.models):
            df, total = model.score(df, f"_p{k}"), total + F.col(f"_p{k}")
        return df.withColumn(out, total / len(self.models)).drop(*[f"_p{k}" for k in range(len(self.models))])


class Blender:
    """Weights on the simplex for several score columns, by pairwise shifts of weight that improve a metric.

    Each step measures all shifts in one pass over the rows for metrics that are means over rows; ranks take a pass each.
    """

    def __init__(self, metric: str = "rmse", maximize: bool = False) -> None:
        self.metric, self.maximize = tabular.get_metric(metric), maximize
        self.weights: dict[str, float] = {}

    def fit(self, df: DataFrame, columns: list[str], label: str = "y", step: float = 0.25, least: float = 0.01) -> Blender:
        sign = -1 if self.maximize else 1
        rows = df.select(F.col(label).alias("y"), *columns).cache()

        def loss(w: tuple[float, ...]) -> float:
            total = F.lit(0.0)
            for c, x in zip(columns, w):
                total = total + F.col(c) * F.lit(x)
            return sign * (self.metric(rows.withColumn("_p", total), "y", "_p").first()["value"] or 0.0)

        best = tuple([1 / len(columns)] * len(columns))
        value = loss(best)
        while step >= least:
            moves = []
            for i in range(len(columns)):
                for j in range(len(columns)):
                    if i != j and best[i] > 0:
                        moved = list(best)
                        part = min(step, best[i])
                        moved[i], moved[j] = moved[i] - part, moved[j] + part
                        moves.append((loss(tuple(moved)), tuple(moved)))
            new = min(moves, default=(value, best))
            if new[0] < value - 1e-12:
                value, best = new
            else:
                step /= 2
        rows.unpersist()
        self.weights = dict(zip(columns, best))
        return self

    def predict(self, df: DataFrame, out: str = "p") -> DataFrame:
        total = F.lit(0.0)
        for c, w in self.weights.items():
            total = total + F.col(c) * F.lit(w)
        return df.withColumn(out, total)


def stack(df: DataFrame, columns: list[str], label: str, classify: bool = True) -> TreeModel:
    """A logistic or ridge model over out-of-fold scores."""
    return TreeModel(columns, "linear", classify).fit(df, label)


# --- text features ---------------------------------------------------------------------------------------------------


class TextFeatures:
    """TF-IDF over words and word pairs with 1 + ln tf, ln((1 + n) / (1 + df)) + 1 and unit length, then a truncated SVD."""

    #: Terms up to which the product of the matrix with itself is made; more go through ARPACK's passes.
    GRAM = 500

    def __init__(self, max_features: int = 5000, components: int = 50, svd_features: int = 20_000) -> None:
        if max_features > svd_features:
            raise ValueError(f"the SVD's matrix is held by the driver; at most {svd_features} features")
        self.max_features, self.components = max_features, components
        self.vocabulary: Transformer | None = None
        self.idf: list[float] = []
        self.axes: list[list[float]] = []

    def _grams(self, df: DataFrame, column: str) -> DataFrame:
        from tributary.functions.kernels import ascii_fold

        words = F.filter(F.split(ascii_fold(F.coalesce(F.col(column), F.lit(""))), r"\W+"), lambda w: F.length(w) >= 2)
        pairs = NGram(n=2, inputCol="_words", outputCol="_pairs").transform(df.withColumn("_words", words))
        return pairs.withColumn("_grams", F.concat("_words", "_pairs")).drop("_words", "_pairs")

    def _weights(self, df: DataFrame) -> Column:
        counts = vector_to_array("_counts")
        idf = F.array(*[F.lit(x) for x in self.idf]) if len(self.idf) <= 50 else F.lit(self.idf)
        raw = F.zip_with(counts, idf, lambda c, w: F.when(c > 0, (F.log(c) + 1) * w).otherwise(F.lit(0.0)))
        size = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda s, x: s + x * x))
        return F.when(size > 0, F.transform(raw, lambda x: x / size)).otherwise(raw)

    def fit(self, df: DataFrame, column: str) -> TextFeatures:
        from pyspark.ml.functions import array_to_vector
        from pyspark.ml.stat import Summarizer
        from pyspark.mllib.linalg.distributed import RowMatrix
        from pyspark.mllib.util import MLUtils

        grams = self._grams(df.select(column), column).select("_grams")
        # The most frequent terms, ties by the term; counted by a plain aggregation, as most pairs of words are rare.
        terms = grams.select(F.explode("_grams").alias("term")).groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(self.max_features)
        self.vocabulary = CountVectorizerModel.from_vocabulary([r["term"] for r in terms.collect()], "_grams", "_counts")
        # Texts are split twice in all: for the terms and for the stored counts.
        counted = storage.written(self.vocabulary.transform(grams).select("_counts"), "counts")
        found = counted.select(Summarizer.metrics("count", "numNonZeros").summary(F.col("_counts")).alias("s")).select("s.count", "s.numNonZeros").first()
        n, frequency = found["count"], found["numNonZeros"].toArray()
        self.idf = [math.log((1 + n) / (1 + x)) + 1 for x in frequency]
        # Vectors are converted inside the JVM; no row passes through Python.
        rows = MLUtils.convertVectorColumnsFromML(counted.select(array_to_vector(self._weights(counted)).alias("v")), "v").persist(StorageLevel.MEMORY_AND_DISK)
        k = min(self.components, max(1, len(self.idf) - 1))
        if len(self.idf) <= self.GRAM:
            # A small product of the matrix with itself takes one pass, its axes are found on the driver.
            values, vectors = np.linalg.eigh(RowMatrix(rows).computeGramianMatrix().toArray())
            sizes = np.sqrt(np.maximum(values[::-1][:k], 0))
            self.axes = vectors[:, ::-1][:, :k].T[sizes > 1e-9 * sizes[0]].tolist()
        else:
            self.axes = RowMatrix(rows).computeSVD(k, computeU=False).V.toArray().T.tolist()
        rows.unpersist()
        return self

    def transform(self, df: DataFrame, column: str, prefix: str = "tfidf_svd") -> DataFrame:
        counted = self.vocabulary.transform(self._grams(df, column)).withColumn("_w", self._weights(df))
        parts = [F.aggregate(F.zip_with("_w", F.lit(axis), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x).alias(f"{prefix}_{k}") for k, axis in enumerate(self.axes)]
        return counted.select(*df.columns, *parts)


# --- the cascade -----------------------------------------------------------------------------------------------------


def admit(pairs: DataFrame, cutoff: float = CUTOFF, max_keep: int = MAX_KEEP, score: str = "p_gbdt", by: str = "s1") -> DataFrame:
    """The pairs that the expensive scorer sees: of each record the max_keep best that reach the cutoff.

    Ties go by blocking rank, then candidate. Scores that are no numbers count as 0; a frame without the column is empty.
    """
    if score not in pairs.columns:
        return pairs.limit(0)
    rows = pairs.withColumn("_p", text.safe_float(F.col(score))).where(F.col("_p") >= cutoff)
    ties = [c for c in ("rank", "blocking_rank", "cand", "candidate_id") if c in pairs.columns]
    nth = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("_p"), *ties))
    return rows.withColumn("_nth", nth).where(F.col("_nth") <= max_keep).drop("_p", "_nth")


class PairScorer:
    """A pluggable scorer of pairs of texts, run in Arrow batches. The default is a deterministic stand-in: the share of
    common word bigrams' and words' characters, which needs no model."""

    def __init__(self, function: Callable[[list[str], list[str]], list[float]] | None = None, batch: int = 512) -> None:
        self.function, self.batch = function or self.overlap, batch

    @staticmethod
    def overlap(a: list[str], b: list[str]) -> list[float]:
        out = []
        for x, y in zip(a, b):
            p, q = set(x.lower().split()), set(y.lower().split())
            out.append(len(p & q) / len(p | q) if p | q else 0.0)
        return out

    def score(self, pairs: DataFrame, a: str = "text_a", b: str = "text_b", out: str = "p_ce") -> DataFrame:
        function, size = self.function, self.batch

        def step(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for x, y in batches:
                x, y = x.fillna("").tolist(), y.fillna("").tolist()
                yield pd.Series([float(v) for k in range(0, len(x), size) for v in function(x[k : k + size], y[k : k + size])], dtype="float64")

        step.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
        return pairs.withColumn(out, F.pandas_udf(step, "double")(F.col(a), F.col(b)))


class LearnedPairScorer:
    """A scorer of pairs of texts that is fitted: a logistic model over likenesses of the texts, all inside the JVM."""

    FEATURES = ["word_jaccard", "gram_dice", "levenshtein", "length_ratio"]

    def __init__(self) -> None:
        self.model = TreeModel(self.FEATURES, "linear", regParam=1e-3)

    def _likenesses(self, pairs: DataFrame, a: str, b: str) -> DataFrame:
        left, right = (F.lower(F.coalesce(c, F.lit(""))) for c in (a, b))
        sizes = F.length(left), F.length(right)
        return pairs.withColumns(
            {
                "word_jaccard": text.jaccard(F.array_distinct(text.tokens(left)), F.array_distinct(text.tokens(right))),
                "gram_dice": text.dice(text.char_ngrams(left), text.char_ngrams(right)),
                "levenshtein": text.levenshtein_ratio(left, right),
                "length_ratio": F.coalesce(F.least(*sizes) / F.nullif(F.greatest(*sizes), F.lit(0)), F.lit(0.0)),
            }
        )

    def fit(self, pairs: DataFrame, label: str = "label", a: str = "text_a", b: str = "text_b", weight: str | None = None) -> LearnedPairScorer:
        """weight names a column with the number of pairs of equal texts that a row stands for.

        The likenesses are written once, as each of the learner's passes reads them.
        """
        rows = self._likenesses(pairs, a, b).select(*self.FEATURES, label, *([weight] if weight else []))
        self.model.fit(storage.written(rows, "likenesses"), label, weight=weight)
        return self

    def score(self, pairs: DataFrame, a: str = "text_a", b: str = "text_b", out: str = "p_ce") -> DataFrame:
        return self.model.score(self._likenesses(pairs, a, b), out).drop(*self.FEATURES)

    def save(self, path: str) -> None:
        self.model.save(path)

    def load(self, path: str) -> LearnedPairScorer:
        self.model.load(path)
        return self
