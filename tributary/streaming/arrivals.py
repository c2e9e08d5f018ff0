"""Records of the second and third source as a stream: each micro-batch is linked against the first source.

The first source's normalised records are static: they are written once, when the query starts. Shared words are weighed by
their frequencies among the targets of a static reference, if one is given, so that a pair's score does not depend on how
arrivals are cut into batches; without a reference each batch weighs them by its own targets, as a batch run over its rows
would. Ceilings and the k best candidates of a record are always those of its batch. Batches are written with their
number, and a batch that is run again replaces its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tributary.plans import linkage
from tributary.sources import files


def stream_records(spark, folder: str, max_files: int = 100) -> DataFrame:
    """A stream of record files that arrive in a folder."""
    return spark.readStream.schema(files.RECORD).options(sep="\t", header=True, maxFilesPerTrigger=max_files).csv(folder)


def link_arrivals(stream: DataFrame, s1: DataFrame, out: str, checkpoint: str, options: linkage.Options | None = None, on_batch: Callable[[DataFrame, int], None] | None = None, reference: DataFrame | None = None) -> StreamingQuery:
    """Scored pairs of each batch under out/batch=<number>; a writer of one's own can be given instead."""
    options = options or linkage.Options()
    s1 = linkage.normalized(linkage.chosen(s1, options), options)
    options = replace(options, countries=(), first_record=None, last_record=None, weights=options.weights if reference is None else linkage.term_weights(reference, options))

    def write(batch: DataFrame, number: int) -> None:
        scored = linkage.link(s1, batch, options).scored
        if on_batch:
            on_batch(scored, number)
        else:
            scored.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
