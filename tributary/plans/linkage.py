"""Whole runs: linkage with a model or a fixed score, training with calibration, reassignment, and tabular learning."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions import scores, text
from tributary.operators import assign, blocking, calibrate, features, mining, models, normalize, reports, tabular
from tributary.sources import files, storage

#: Weights of the fixed score, a stand-in for a model: they add up to 1.
FIXED_SCORE = {"name_clean_exact_match": 0.30, "name_levenshtein_ratio": 0.25, "name_char_3gram_jaccard": 0.20, "addr_token_jaccard": 0.25}


@dataclass
class Options:
    k: int = 25
    ceiling: int = blocking.BUCKET_CEILING
    max_postings: int = blocking.POSTING_CEILING
    tau: float | None = None
    tau_singleton: float = assign.TAU_SINGLETON
    max_matches: int | None = assign.MAX_MATCHES
    countries: tuple[str, ...] = ()
    first_record: int | None = None
    last_record: int | None = None
    blend: tuple[float, float, float] = (0.5, 0.25, 0.25)
    scorer: models.PairScorer | None = None
    profile: str = "canonical"
    #: Without phonetic codes the bucket of sounds is left out.
    phonetic: bool = True
    #: Applied to normalised records and candidates, which several joins read: they are computed once. None leaves them as plans.
    cut: Callable[[DataFrame], DataFrame] | None = storage.written
    #: Weights of tier 2's terms by a reference (blocking.term_weights), where the linked targets are a part of it.
    weights: DataFrame | None = field(default=None, repr=False)
    calibrated: DataFrame | None = field(default=None, repr=False)


@dataclass
class Linked:
    candidates: DataFrame
    scored: DataFrame
    matches: DataFrame
    candidate_lists: DataFrame
    match_lists: DataFrame
    summary: DataFrame


@dataclass
class Ready:
    """What training and linking of the same records share, each computed once: normalised records, candidates, features."""

    own: DataFrame
    others: DataFrame
    candidates: DataFrame
    featured: DataFrame


def chosen(s1: DataFrame, options: Options) -> DataFrame:
    """Records of the chosen countries and, by the order of their ids in each country, of the chosen positions."""
    rows = s1.where(F.col("country").isin(*options.countries)) if options.countries else s1
    if options.first_record is None and options.last_record is None:
        return rows
    low, high = options.first_record or 0, options.last_record
    ranked = tabular.positions(rows, "country", "entity_id", "_nth").where(F.col("_nth") >= low)
    return (ranked if high is None else ranked.where(F.col("_nth") < high)).drop("_nth")


def targets_of(s2: DataFrame, s3: DataFrame) -> DataFrame:
    return s2.unionByName(s3)


def _cut(df: DataFrame, options: Options) -> DataFrame:
    return options.cut(df) if options.cut else df


def normalized(df: DataFrame, options: Options) -> DataFrame:
    """Normalised records for block() and featurize(), or with another profile the raw ones; normalised ones stay as they are."""
    if {"name", "address"} <= set(df.columns):
        return df
    return _cut(normalize.normalized(df, options.phonetic), options) if options.profile == "canonical" else df


def _ready(df: DataFrame, options: Options) -> DataFrame:
    if options.profile == "canonical" and {"name", "address"} <= set(df.columns):
        return normalize.blocking_view(df)
    return _cut(normalize.prepare(df, options.profile, options.phonetic), options)


def block(s1: DataFrame, targets: DataFrame, options: Options) -> DataFrame:
    """Fused candidates of raw records, or of records that normalized() has made."""
    return _cut(blocking.generate(_ready(s1, options), _ready(targets, options), options.k, options.ceiling, options.max_postings, weights=options.weights), options)


def term_weights(reference: DataFrame, options: Options) -> DataFrame:
    """Options.weights of a reference's records, computed once."""
    return _cut(blocking.term_weights(_ready(normalized(reference, options), options), options.max_postings), options)


def featurize(candidates: DataFrame, s1: DataFrame, targets: DataFrame, kernel_features: bool = True) -> DataFrame:
    """Features of the candidates; their blocking score is the inverse of their rank."""
    ranked = candidates.select("s1", "cand", "rank", (F.lit(1.0) / F.col("rank")).alias("score"))
    return features.pair_features(ranked, s1, targets, kernel_features)


def ready(s1: DataFrame, targets: DataFrame, options: Options) -> Ready:
    own, others = normalized(s1, options), normalized(targets, options)
    candidates = block(own, others, options)
    return Ready(own, others, candidates, _cut(featurize(candidates, own, others), options))


def fixed_score(rows: DataFrame, weights: dict[str, float] = FIXED_SCORE, out: str = "p") -> DataFrame:
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.col(name) * F.lit(weight)
    return rows.withColumn(out, F.round(total, 9))


def cascade(featured: DataFrame, s1: DataFrame, targets: DataFrame, model: models.Ensemble, scorer: models.PairScorer, options: Options, low: float) -> DataFrame:
    """Pairs over `low` with p: the ensemble's score, blended with the pair scorer's for those that are admitted."""
    members = list(model.members)[:2]
    scored = model.score(featured, "p_gbdt").where(F.col("p_gbdt") >= low)
    admitted = models.admit(scored.withColumn("rank", F.col("blocking_rank")).select("s1", "cand", "rank", "p_gbdt"))
    side = lambda df, i, t: df.select(F.trim("entity_id").alias(i), text.pair_text(F.col("business_name"), F.col("business_address"), F.col("country")).alias(t))
    texts = admitted.select("s1", "cand").join(side(s1, "s1", "text_a").hint("merge"), "s1").join(side(targets, "cand", "text_b").hint("merge"), "cand", "left")
    expensive = scorer.score(texts).select("s1", "cand", "p_ce")
    first, second = F.col(f"p_{members[0]}"), F.col(f"p_{members[-1]}")
    return scored.join(expensive.hint("merge"), ["s1", "cand"], "left").withColumn("p", scores.blend(F.col("p_ce"), first, second, options.blend))


def link(s1: DataFrame, targets: DataFrame, options: Options | None = None, model: models.Ensemble | None = None, made: Ready | None = None) -> Linked:
    """Candidates, scores and matches of all countries in one plan. `made` is ready() of the same records and options; a
    choice of records does not apply to it."""
    options = options or Options()
    s1 = s1 if made else chosen(s1, options)
    own, others = (made.own, made.others) if made else (normalized(s1, options), normalized(targets, options))
    universe = s1.select(F.trim("entity_id").alias("s1"), F.upper(text.null_to(F.col("country"), text.ID_NULL_TOKENS, "")).alias("country"))
    candidates = made.candidates if made else block(own, others, options)
    limits = calibrate.effective_thresholds(universe, options.calibrated, options.tau, options.tau_singleton)
    featured = made.featured if made else featurize(candidates, own, others, model is not None)
    if model is None:
        scored = fixed_score(featured)
    elif options.scorer is None:
        scored = model.score(featured)
    else:
        scored = cascade(featured, s1, targets, model, options.scorer, options, models.CUTOFF)
    scored = scored.select("s1", "cand", "p").join(universe.hint("merge"), "s1")
    # The thresholds of a record's country travel with its pairs.
    timed = scored.join(F.broadcast(limits), "country")
    matches = assign.assign(timed.select("s1", "cand", "p", "country", "tau_singleton", "tau_secondary"), None, F.col("tau_singleton"), F.col("tau_secondary"), options.max_matches, also=("tau_singleton", "tau_secondary")).select("s1", "cand", "p", "rank")
    lists = assign.match_lists(matches, universe)
    return Linked(candidates, scored, matches, blocking.candidate_lists(candidates, universe), lists, reports.partition_summary(lists, universe))


def _mined(made: Ready, truth: mining.Classes, max_negatives: int, sample_size: int | None = None) -> DataFrame:
    """s1, label and the features of mining.hard_negatives() under truth by class; of all s1 unless a size is asked for."""
    labelled = truth.label(made.candidates.select("s1", "cand", "rank"))
    nth = F.row_number().over(Window.partitionBy("s1", "label").orderBy("rank", "cand"))
    kept = labelled.withColumn("_nth", nth).where((F.col("label") == 1) | (F.col("_nth") <= max(0, max_negatives))).select("s1", "cand", "label")
    found = made.featured.hint("merge").join(kept, ["s1", "cand"])
    missed = features.class_pair_features(made.own, made.others, truth, made.candidates).withColumn("label", F.lit(1))
    if sample_size is not None:
        members = made.candidates.select("s1").union(truth.counts().where("n_true > 0").select("s1")).distinct()
        some = mining.some_members(members, sample_size)
        found, missed = (df.join(some, "s1", "left_semi") for df in (found, missed))
    columns = ["s1", "label", *features.FEATURES]
    return found.select(*columns).unionByName(missed.select(*columns))


def train(s1: DataFrame, targets: DataFrame, truth: DataFrame | mining.Classes, options: Options | None = None, model: models.Ensemble | None = None, max_negatives: int = 10, made: Ready | None = None) -> tuple[models.Ensemble, DataFrame, DataFrame]:
    """(model, thresholds by country, threshold over all): mined pairs of all s1 train it, raw candidates calibrate it.

    Truth by class serves where many records are the same: its pairs meet by class, and only their feature rows are written.
    `made` is ready() of the same records and options.
    """
    options = options or Options()
    made = made or ready(s1, targets, options)
    if isinstance(truth, mining.Classes):
        rows = storage.written(_mined(made, truth, max_negatives), "mined")
    else:
        pairs = files.truth_pairs(truth)
        mined = mining.hard_negatives(made.candidates, pairs, max_negatives, sample_size=None)
        ranked = mining.training_pairs(made.candidates, pairs, targets).select("s1", "cand", "rank", F.when(F.col("is_blocker"), F.lit(1.0) / F.col("rank")).otherwise(F.lit(0.0)).alias("score"))
        rows = storage.written(features.pair_features(ranked.join(mined.select("s1", "cand"), ["s1", "cand"], "left_semi"), made.own, made.others).join(mined, ["s1", "cand"]), "mined")
    model = (model or models.Ensemble(features.FEATURES)).fit(rows, "label", "s1")
    universe = s1.select(F.trim("entity_id").alias("s1"), F.upper(text.null_to(F.col("country"), text.ID_NULL_TOKENS, "")).alias("country"))
    # Both searches read the scores.
    scored = storage.written(model.score(made.featured).select("s1", "cand", "p").join(universe.hint("merge"), "s1"))
    by_country = calibrate.best_threshold(calibrate.curve(scored, truth, by_country=universe))
    return model, by_country, calibrate.best_threshold(calibrate.curve(scored, truth))


def reassign(scored: DataFrame, universe: DataFrame, thresholds: dict[str, tuple[float, float]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(match lists, profile) of the competitive assignment."""
    lists = assign.match_lists(assign.competitive(scored, thresholds), universe)
    return lists, reports.match_profile(lists)


def learn_table(train_rows: DataFrame, test_rows: DataFrame, config: files.Config) -> tuple[models.CrossValidation, DataFrame]:
    """(fitted folds, test ids with predictions). The preprocessing is fitted on the training rows alone."""
    c, t = config.columns, config.training
    prepared = tabular.Preprocessor(c.numerical, c.categorical, c.text, scale=False).fit(train_rows)
    inputs = [*c.numerical, *c.categorical]
    classify = dict(train_rows.dtypes)[c.target] not in ("double", "float")
    cv = models.CrossValidation(lambda: models.TreeModel(inputs, t.model, classify, t.seed, **t.options), t.metric, t.n_splits, t.seed)
    cv.fit(prepared.transform(train_rows), c.target, c.id, c.group, c.target if classify and t.stratified and not c.group else None)
    return cv, cv.predict(prepared.transform(test_rows), "prediction").select(c.id, "prediction")


def records_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources of records made of the pages table: title, address and language of each page. Equal titles across
    sources are true matches. The numbers of the address come from the page's length, as pages have no street."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    size = F.length(F.coalesce("html", F.lit("")))
    street, postal = (size % 997 + 1).cast("string"), (F.lit(10000) + size * 37 % 90000).cast("string")
    return pages.select(
        F.concat(F.lit("S"), (F.col("page_id") % 3 + 1).cast("string"), F.lit("-"), F.col("page_id").cast("string")).alias("entity_id"),
        F.regexp_extract(F.coalesce("html", F.lit("")), "<title>([^<]*)</title>", 1).alias("business_name"),
        F.concat_ws(" ", street, F.regexp_replace(F.coalesce("url", F.lit("")), "^https?://", ""), postal).alias("business_address"),
        F.regexp_extract(F.coalesce("html", F.lit("")), '<html lang="([^"]*)"', 1).alias("country"),
    )
