"""Line dedup over all documents.

Rows are numbered and stored. Their lines are exploded with a 128-bit hash of their key (both ends stripped of ASCII white
space, A-Z lower-cased) and their positions; the smallest and largest doc_id of each hash tell whether at least two
documents hold it; rows of documents other than the smallest then lose the lines at those positions, and the others are
joined again in order of their positions. A hash occurs once per row before the shuffle and is aggregated on the map side,
so a line that a third of all documents share is one row a task; Spark splits its join.

With min_docs above 2 distinct documents are counted. Keys shorter than min_chars code points stay. Null and empty texts
are one empty line. Rows with the same doc_id count as one document, and each is cleaned for itself. Rows with a null
doc_id count as no document: their lines stay and make no other line go. Extra columns stay, whatever their names; one
that has the name of a result column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

MIN_CHARS, MIN_DOCS = 10, 2
_SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).translate(common.ASCII_LOWER)


def _hash(key: bytes, min_chars: int) -> bytes | None:
    """16 bytes, or None for a key that is too short."""
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _line_batches(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Rows (row, doc_id, text); a row per distinct line key, with its hash and the positions of its lines."""
    for batch in common.sliced(batches):
        rows, docs, hashes, places = [], [], [], []
        for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), common.utf8(batch.column(2))):
            own: dict[bytes, list[int]] = {}
            for at, line in enumerate(text.split(b"\n")):
                if h := _hash(line_key(line), min_chars):
                    own.setdefault(h, []).append(at)
            rows += [row] * len(own)
            docs += [doc] * len(own)
            hashes += own.keys()
            places += own.values()
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(docs, pa.int64()), pa.array(hashes, pa.binary()), pa.array(places, pa.list_(pa.int32()))], ["row", "doc_id", "hash", "places"])


def dropped_lines(rows: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(row, places) of the lines that each of the stored rows (row, doc_id, text) has to give up, if any."""
    lines = rows.where("doc_id is not null").mapInArrow(lambda batches: _line_batches(batches, min_chars), "row bigint, doc_id bigint, hash binary, places array<int>")
    if min_docs <= 2:
        held = lines.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    else:
        held = lines.select("doc_id", "hash").distinct().groupBy("hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where(F.col("n") >= min_docs)
    # Stored, both sides of the join are dealt out for it alone, and Spark can split a hot line's share of the lines.
    held = common.stored(held.select("hash", "first"), "repeated")
    return lines.join(held, "hash").where("doc_id > first").groupBy("row").agg(F.flatten(F.collect_list("places")).alias("places"))


def _keep_batches(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of other columns, text and places; the text becomes the kept text, the places the two counts."""
    for batch in common.sliced(batches):
        *others, texts, dropped = batch.columns
        kept, n_lines, n_dropped = [], [], []
        for text, places in zip(common.utf8(texts), dropped):
            if places.is_valid:
                gone, lines = set(places.as_py()), text.split(b"\n")
                kept.append(b"\n".join([line for at, line in enumerate(lines) if at not in gone]))
                n_lines.append(len(lines))
                n_dropped.append(len(gone))
            else:
                kept.append(text)
                n_lines.append(text.count(b"\n") + 1)
                n_dropped.append(0)
        yield pa.RecordBatch.from_arrays([*others, pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, out: tuple[str, str, str] = ("kept_text", "n_lines", "n_dropped")) -> DataFrame:
    """The rows with all their columns but text_col, then the three of out: the kept text, lines, dropped lines."""
    row, text, places = common.fresh(docs, "row", "text", "places")
    others = [c for c in docs.columns if c.lower() not in {text_col.lower(), *(x.lower() for x in out)}]
    own = [F.col(f"`{c}`") for c in others]
    numbered = docs.select(*own, F.col(text_col).cast("string").alias(text), F.col(id_col).cast("bigint").alias(places), F.monotonically_increasing_id().alias(row))
    rows = common.stored(numbered, "rows")
    drops = dropped_lines(rows.select(F.col(row).alias("row"), F.col(places).alias("doc_id"), F.col(text).alias("text")), min_chars, min_docs)
    joined = rows.drop(places).join(drops.select(F.col("row").alias(row), F.col("places").alias(places)), row, "left")
    # Plain names, as mapInArrow takes no column whose name has a dot.
    joined = joined.select(*[c.alias(f"c{k}") for k, c in enumerate([*own, F.col(text), F.col(places)])])
    schema = T.StructType([*(docs.schema[c] for c in others), *(T.StructField(n, t) for n, t in zip(out, (T.StringType(), T.LongType(), T.LongType())))])
    return joined.mapInArrow(lambda batches: _keep_batches(batches, schema.names), schema)


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    kept = dedup_lines(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = """
WITH lines AS (
  SELECT doc_id, i, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)
), held AS (
  SELECT k, min(doc_id) AS first FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT lines.doc_id, i, l, coalesce(lines.doc_id <> first, FALSE) AS gone FROM lines LEFT JOIN held USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
