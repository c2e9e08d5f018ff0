"""Corpus pipeline: five stages, each one operator over all that the stage before has kept.

Quality classifier, line dedup, near-dedup by SimHash and pivot tables with an exact check and an exact search for what
lies beyond their bits, benchmark decontamination, packing. Each stage
takes (spark, docs, sf_dir) and gives a frame that is written to the shared folder and read again as the next stage's
docs. All but the last give the columns of documents, and extra columns as they are, whatever their names. Near-dedup and decontamination decide on rows, not on doc_ids: rows
with a null doc_id or with one that others share are dropped or kept by their own text. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import common, decontamination, jaccard, line_dedup, packing, quality

def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document holds; n_chars follows the text."""
    common.bound_batches(spark)
    text, *counts = common.fresh(docs, "kept_text", "n_lines", "n_dropped")
    kept = line_dedup.dedup_lines(docs, out=(text, *counts))
    changed = {"text": F.col(text), "n_chars": F.length(text).cast("bigint")}
    return kept.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a stored number of their own, by which a stage's decisions are joined back, and its name."""
    (row,) = common.fresh(docs, "row")
    return common.stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row of each group of Jaccard similarity 0.8 or more over five-word shingles: the smallest doc_id, nulls last.

    Groups start from op1's method, see tributary/llm/jaccard.py.
    """
    common.bound_batches(spark)
    rows, row = _numbered(docs)
    groups = jaccard.near_duplicates(rows.select(F.col(row).alias("row"), "text"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    named = rows.select(F.col(row).alias("row"), "doc_id").join(groups, "row")
    first = named.groupBy("group").agg(F.min(order)["row"].alias("first"))
    dropped = common.stored(groups.join(first, "group").where("row <> first").select(F.col("row").alias(row)), "dropped")
    return common.without(rows, dropped, row).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window."""
    rows, row = _numbered(docs)
    found = decontamination.decontaminate(rows, common.table(spark, sf_dir, "benchmark"), id_col=row)
    hit = common.stored(found.where(F.size("hits") > 0).select(F.col("id").alias(row)), "hit")
    return common.without(rows, hit, row).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    common.bound_batches(spark)
    return packing.digests(packing.pack(docs, "word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: Near-duplicates, the trained classifier and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
