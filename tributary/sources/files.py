"""Readers and writers of records, truth, candidates, matches, scores, predictions, models' thresholds and the run ledger."""

from __future__ import annotations

import io
import json
import os
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import text

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _without_nulls(df: DataFrame) -> DataFrame:
    """Strings that readers take for null become empty, as do nulls."""
    return df.select(*[F.when(F.col(c).isin(*text.READER_NULLS), F.lit("")).otherwise(F.coalesce(c, F.lit(""))).alias(c) for c in df.columns])


def read_records(spark: SparkSession, path: str, optional: bool = False) -> DataFrame:
    """A tab-separated record file, all strings, no nulls. An optional file that is missing is empty."""
    if optional and not exists(spark, path):
        return spark.createDataFrame([], RECORD)
    header = spark.read.options(sep="\t", header=True, quote='"').csv(path)
    return _without_nulls(header.select(*[F.col(c) if c in header.columns else F.lit("").alias(c) for c in RECORD.names]))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of a tab-separated file's first column."""
    df = spark.read.options(sep="\t", header=True).csv(path)
    first = df.columns[0]
    return df.select(F.trim(first).alias("id")).where("id <> ''").distinct()


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(s1, cands): an array of trimmed ids for every s1, empty for records without a match."""
    df = spark.read.options(sep="\t", header=True).csv(path)
    s1, ids = df.columns[:2]
    listed = F.when(text.is_null_text(F.col(ids), text.ID_NULL_TOKENS), F.lit("")).otherwise(F.col(ids))
    return df.select(F.trim(s1).alias("s1"), text.split_list(listed).alias("cands")).where("s1 <> ''")


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth.select("s1", F.explode("cands").alias("cand"))


def read_table(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """Parquet by its suffix, else CSV with inferred types."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    df = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.options(header=True, inferSchema=True).csv(path)
    absent = [c for c in required if c and c not in df.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}; it has {', '.join(df.columns)}")
    return df


def load_competition(spark: SparkSession, train: str | Config, test: str = "", id_col: str | None = None, target_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) of two paths, or of a Config with its paths and columns; the columns that are named must be there."""
    if isinstance(train, Config):
        return load_competition(spark, train.paths.train, train.paths.test, train.columns.id, train.columns.target)
    return read_table(spark, train, (id_col, target_col)), read_table(spark, test, (id_col,))


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The Parquet at the path; built and written first if it is not there. A feature matrix is computed once this way."""
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# --- sinks -----------------------------------------------------------------------------------------------------------


def write_tsv(df: DataFrame, path: str, append: bool = False, header: bool = True, order_by: str | None = None, single_file: bool = False) -> None:
    """Tab-separated without quotes; empty strings stay empty and outer spaces stay. order_by sorts all rows, single_file makes one part."""
    rows = df.orderBy(order_by) if order_by else df
    rows = rows.coalesce(1) if single_file else rows
    rows.write.mode("append" if append else "overwrite").options(sep="\t", header=header, quote="", emptyValue="", nullValue="", escapeQuotes=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_candidates(lists: DataFrame, path: str, append: bool = False, header: bool = True) -> None:
    write_tsv(lists.select("source1_entity_id", "candidate_entity_ids"), path, append, header, "source1_entity_id")


def write_matches(lists: DataFrame, path: str, append: bool = False, header: bool = True) -> None:
    ids = F.array_join(text.split_list(F.col("matched_entity_ids")), ",")
    write_tsv(lists.select("source1_entity_id", ids.alias("matched_entity_ids")), path, append, header)


def write_scored(pairs: DataFrame, path: str) -> None:
    """Scored pairs as snappy Parquet, a folder for each country."""
    pairs.write.mode("overwrite").partitionBy("country").parquet(path)


def read_scored(spark: SparkSession, path: str, country: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if country is None else df.where(F.col("country") == country)


def write_predictions(df: DataFrame, folder: str, name: str = "model", id_col: str = "id", prediction_col: str = "prediction") -> str:
    """A CSV folder with a time stamp in its name; its path is returned."""
    path = f"{folder.rstrip('/')}/{name}_{time.strftime('%Y%m%d_%H%M%S')}.csv"
    df.select(id_col, prediction_col).write.options(header=True).csv(path)
    return path


class _Sink(io.RawIOBase):
    """A file of the store as a stream to write to."""

    def __init__(self, spark: SparkSession, target: str) -> None:
        place = spark._jvm.org.apache.hadoop.fs.Path(target)
        self.stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(bytearray(data))
        return len(data)

    def close(self) -> None:
        if not self.closed:
            super().close()
            self.stream.close()


def _chunks(spark: SparkSession, path: str, size: int = 1 << 20) -> Iterator[bytes]:
    """A file's bytes, so many at a time, by the store's own reader."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        while data := bytes(stream.readNBytes(size)):
            yield data
    finally:
        stream.close()


def zip_files(spark: SparkSession, members: dict[str, str], target: str) -> None:
    """A zip of files by their name in it; folders of parts become one member each. All must exist and are read from Spark's store.

    Bytes go to the store as they come: the driver holds a megabyte of a part file and a buffer at a time.
    """
    absent = [p for p in members.values() if not exists(spark, p)]
    if absent:
        raise FileNotFoundError(", ".join(absent))
    with io.BufferedWriter(_Sink(spark, target), 1 << 20) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as out:
        for name, path in sorted(members.items()):
            files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path).select("path").orderBy("path")
            with out.open(name, "w", force_zip64=True) as member:
                for part in [r["path"] for r in files.collect()]:
                    for data in _chunks(spark, part):
                        member.write(data)


def package_code(folder: str, target: str, extra: dict[str, str] | None = None, prefixes: tuple[str, ...] = ("code/",), spark: SparkSession | None = None) -> list[str]:
    """A zip of the driver's code folder under each prefix, without hidden, cached and build files; names are returned.

    With a session the zip goes to the store that Spark reaches, byte by byte, else to the local disk.
    """
    if not os.path.isdir(folder):
        raise FileNotFoundError(folder)
    names = []
    with io.BufferedWriter(_Sink(spark, target), 1 << 20) if spark else open(target, "wb") as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as out:
        for top, dirs, found in os.walk(folder):
            dirs[:] = sorted(d for d in dirs if not d.startswith(".") and d != "__pycache__" and not d.endswith(".egg-info"))
            for name in sorted(f for f in found if not f.startswith(".") and not f.endswith(".pyc")):
                path = os.path.join(top, name)
                for prefix in prefixes:
                    names.append(prefix + os.path.relpath(path, folder).replace(os.sep, "/"))
                    out.write(path, names[-1])
        for name, path in sorted((extra or {}).items()):
            if os.path.exists(path):
                names.append(name)
                out.write(path, name)
    return names


# --- configuration and ledger ----------------------------------------------------------------------------------------


@dataclass
class Paths:
    train: str = ""
    test: str = ""
    output: str = "output"


@dataclass
class Columns:
    id: str = "id"
    target: str = "target"
    numerical: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    group: str | None = None


@dataclass
class Training:
    n_splits: int = 5
    seed: int = 42
    stratified: bool = True
    metric: str = "rmse"
    model: str = "gbt"
    options: dict[str, Any] = field(default_factory=dict)


@dataclass
class Config:
    paths: Paths = field(default_factory=Paths)
    columns: Columns = field(default_factory=Columns)
    training: Training = field(default_factory=Training)

    @classmethod
    def of(cls, values: dict) -> Config:
        """Unknown keys are ignored, absent ones keep their default."""

        def build(kind, given):
            given = given or {}
            return kind(**{f.name: build(f.default_factory, given[f.name]) if is_dataclass(f.default_factory) else given[f.name] for f in fields(kind) if f.name in given})

        return build(cls, values)

    @classmethod
    def read(cls, path: str) -> Config:
        """A JSON file, or a YAML file where PyYAML is installed."""
        with open(path) as file:
            if path.endswith(".json"):
                return cls.of(json.load(file))
            import yaml

            return cls.of(yaml.safe_load(file) or {})


RUN = T.StructType.fromJson(
    {
        "type": "struct",
        "fields": [
            *[{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in (("run_id", "string"), ("run_name", "string"), ("timestamp", "string"), ("status", "string"), ("duration_seconds", "double"))],
            *[{"name": n, "type": {"type": "map", "keyType": "string", "valueType": v, "valueContainsNull": True}, "nullable": True, "metadata": {}} for n, v in (("params", "string"), ("metrics", "double"), ("feature_importances", "double"), ("threshold_curve", {"type": "array", "elementType": "double", "containsNull": True}), ("partition_summary", {"type": "map", "keyType": "string", "valueType": "double", "valueContainsNull": True}))],
        ],
    }
)


class Ledger:
    """Runs in one JSON file. A run with a known run_id replaces it; a missing, empty or broken file is an empty ledger.

    With a session the path is one of a store that Spark reaches, else one of the local disk. The file is small: it is
    read and written whole, and put in its place by renaming.
    """

    def __init__(self, path: str, spark: SparkSession | None = None) -> None:
        self.path, self.spark = path, spark

    def _content(self) -> bytes | None:
        if self.spark:
            return bytes(self.spark.read.format("binaryFile").load(self.path).select("content").first()[0]) if exists(self.spark, self.path) else None
        if not os.path.exists(self.path):
            return None
        with open(self.path, "rb") as file:
            return file.read()

    def runs(self) -> list[dict]:
        try:
            found = json.loads(self._content() or b"")
        except (OSError, ValueError):
            return []
        return found if isinstance(found, list) else []

    def save(self, run: dict) -> None:
        rest = [r for r in self.runs() if r.get("run_id") != run["run_id"]]
        if self.spark:
            part = f"{self.path}.new"
            with _Sink(self.spark, part) as sink:
                sink.write(json.dumps([*rest, run], indent=1).encode())
            place, old = (self.spark._jvm.org.apache.hadoop.fs.Path(p) for p in (part, self.path))
            store = old.getFileSystem(self.spark._jsc.hadoopConfiguration())
            store.delete(old, False)
            store.rename(place, old)
            return
        folder = os.path.dirname(os.path.abspath(self.path))
        os.makedirs(folder, exist_ok=True)
        with tempfile.NamedTemporaryFile("w", dir=folder, delete=False) as file:
            json.dump([*rest, run], file, indent=1)
        os.replace(file.name, self.path)

    def get(self, run_id: str) -> dict | None:
        return next((r for r in self.runs() if r.get("run_id") == run_id), None)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The runs as a frame of RUN; the ledger is one small file."""
        if not self.runs():
            return spark.createDataFrame([], RUN)
        return spark.read.schema(RUN).json(self.path, multiLine=True)


class Run:
    """One run while it goes on: parameters, metrics, importances, curve and summary, saved at its end."""

    def __init__(self, ledger: Ledger, name: str, params: dict | None = None, run_id: str | None = None) -> None:
        self.ledger, self.began = ledger, time.time()
        stamp = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(self.began))
        self.values: dict[str, Any] = {"run_id": run_id or f"{name}-{int(self.began * 1000)}", "run_name": name, "timestamp": stamp, "params": {k: str(v) for k, v in (params or {}).items()}, "metrics": {}, "feature_importances": {}, "threshold_curve": {}, "partition_summary": {}}

    def log_metrics(self, **metrics: float) -> None:
        self.values["metrics"] |= {k: float(v) for k, v in metrics.items() if v is not None}

    def log_importances(self, importances: dict[str, float]) -> None:
        self.values["feature_importances"] = dict(importances)

    def log_curve(self, thresholds: list[float], scores: list[float]) -> None:
        self.values["threshold_curve"] = {"thresholds": list(thresholds), "scores": list(scores)}

    def log_summary(self, summary: dict[str, dict[str, float]]) -> None:
        self.values["partition_summary"] = summary

    def end(self, status: str = "finished") -> dict:
        self.values |= {"status": status, "duration_seconds": time.time() - self.began}
        self.ledger.save(self.values)
        return self.values
