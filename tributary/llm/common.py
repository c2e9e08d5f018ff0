"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER, LOWER)


#: Rows of an Arrow batch. Texts are long, so Spark's own default would hold tens of megabytes a task on either side.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to BATCH_ROWS, unless they have been set to fewer than Spark's default."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) >= 10_000:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only a local session may leave it unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """The frame written once to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, what)
    # What the job shuffled goes as soon as it ends; Spark itself waits for the driver to collect its garbage.
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


def discard(df: DataFrame) -> None:
    """Remove what stored() wrote for this frame."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def sampled(share: float | Column, *keys: str | Column) -> Column:
    """Whether the hash of the keys lies in the first share of all 63-bit numbers; any share above 1e-18 takes rows."""
    hashed = F.xxhash64(*keys).bitwiseAND(F.lit((1 << 63) - 1)) / F.lit(float(1 << 63))
    return hashed < share if isinstance(share, Column) else (F.lit(True) if share >= 1 else hashed < F.lit(float(share)))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def hashed_bits(keys: DataFrame, bits: int = 24) -> Column:
    """A bitmap of 2^bits slots, 2 MB however many keys there are, of the hashes of a frame's one column: for may_hold()."""
    slots = keys.select(F.xxhash64(keys.columns[0]).bitwiseAND(F.lit((1 << bits) - 1)).alias("slot"))
    longs = slots.groupBy(F.shiftright("slot", 6).alias("k")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS INT)))").alias("bits"))
    whole = keys.sparkSession.range(0, 1 << bits >> 6, 1, 1).select(F.col("id").alias("k")).join(longs, "k", "left")
    packed = whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))), lambda x: x["bits"]).alias("words"))
    return stored(packed, "bitmap").scalar()


def may_hold(bitmap: Column, key: Column, bits: int = 24) -> Column:
    """False only for keys that were not in the bitmap's frame: rows are sorted out before a shuffle, and a join decides on the rest."""
    slot = F.xxhash64(key).bitwiseAND(F.lit((1 << bits) - 1))
    return F.getbit(F.get(bitmap, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1


def without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in the stored frame `dropped` (one column of that name). Only rows that its bitmap holds are shuffled."""
    flagged = may_hold(hashed_bits(dropped), F.col(key))
    return rows.where(~flagged).unionByName(rows.where(flagged).join(dropped, key, "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns]))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that Python holds few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, columns: list[str | Column], step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow over just these columns."""
    return df.select(*columns).mapInArrow(step, schema)


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z, other letters as they are."""
    return F.translate(column, UPPER.decode(), LOWER.decode())


def utf8(values: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [x or b"" for x in values.cast(pa.binary()).to_pylist()]
