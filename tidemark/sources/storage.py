"""Reading and writing tables, splits, predictions, models and reports."""

from __future__ import annotations

import json
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path, PurePosixPath

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: With it Spark removes the shuffle files of a query when the query ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stands for NULL inside the CSV reader. No text is equal to it, so that only empty fields without quotes are NULL.
NO_VALUE = "\ufffe\ufffeNULL"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or, where that is not set, one in the warehouse."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work").rstrip("/")


def lasting_dir(spark: SparkSession, name: str) -> str:
    """A folder below the shared root that stays when the application ends, for what a later one may take up."""
    return f"{shared_root(spark)}/tidemark-{name}"


def shared_dir(spark: SparkSession) -> str:
    """The name of a fresh folder that every executor can reach; it is removed when the application ends."""
    path = f"{shared_root(spark)}/{uuid.uuid4().hex}"
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)  # only what exists can be marked
    fs.deleteOnExit(hadoop_path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """The same rows, read back from a table in the shared folder: computed once, cheap to reuse."""
    path = shared_dir(df.sparkSession)
    write_parquet(df, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(*frames: DataFrame) -> None:
    """Removes the tables behind frames that ``stored`` gave, when their last reader is done."""
    for df in frames:
        path = df.__dict__.pop("_stored_at", None)
        if path is not None:
            remove(df.sparkSession, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files: a query that has been written is read from its table, so nobody asks for them again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Puts what ``write`` writes to a folder in the place of ``path``.

    The new folder is complete before the old one goes, so a write that fails leaves the old rows, and the table may be
    computed from its own old rows. The switch is two renames; if the second fails, the first is taken back.
    """
    fs, target = _file_system(spark, path)
    make = spark._jvm.org.apache.hadoop.fs.Path
    new, old = (make(f"{path.rstrip('/')}.{word}-{uuid.uuid4().hex}") for word in ("new", "old"))
    try:
        with shuffles_removed(spark):
            write(new.toString())
        had = fs.exists(target)
        if had and not fs.rename(target, old):
            raise OSError(f"cannot move {path} away")
        if not fs.rename(new, target):
            if had:
                fs.rename(old, target)
            raise OSError(f"cannot put the new table at {path}")
        if had:
            fs.delete(old, True)
    finally:
        if fs.exists(new):
            fs.delete(new, True)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    """Replace the table at ``path``."""
    return replace(df.sparkSession, path, lambda new: df.write.parquet(new))


def write_csv(df: DataFrame, path: str) -> str:
    """Replace the CSV table (header, quotes doubled, full timestamps) at ``path``."""
    writer = df.write.option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer = writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    return replace(df.sparkSession, path, lambda new: writer.csv(new))


def _by_time(df: DataFrame):
    # rebalancing joins small times in one task and splits large ones
    return df.hint("rebalance", "metric_time").sortWithinPartitions("metric_time", "metric_name_id").write.partitionBy("metric_time")


def write_metric_table(df: DataFrame, path: str) -> str:
    """Replace the metric table at ``path``, one folder for each metric time: a snapshot reads one of them."""
    return replace(df.sparkSession, path, lambda new: _by_time(df).parquet(new))


def rewrite_metric_times(df: DataFrame, path: str) -> str:
    """Replace, in the metric table at ``path``, the metric times that occur in ``df``; all others stay as they are."""
    _by_time(df).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system."""
    fs, hadoop_path = _file_system(spark, path)
    return hadoop_path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def _holds_parquet(spark: SparkSession, path: str) -> bool:
    if PurePosixPath(path).suffix.lower() == ".parquet":
        return True
    fs, hadoop_path = _file_system(spark, path)
    if not fs.getFileStatus(hadoop_path).isDirectory():
        return False
    return not any(f.getPath().getName().endswith((".csv", ".csv.gz")) for f in fs.listStatus(hadoop_path))


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A dataset by its path: folders and ``.parquet`` files are Parquet, folders of CSV parts and other files CSV.

    Without a schema the CSV columns are text; the feature step turns them into numbers.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"dataset not found: {path}")
    if _holds_parquet(spark, path):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True).option("escape", '"').option("nullValue", NO_VALUE)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_bytes(spark: SparkSession, content: bytes, path: str) -> str:
    """A file, written beside its place and moved there when it is complete."""
    fs, hadoop_path = _file_system(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    fs.delete(hadoop_path, False)
    fs.rename(new, hadoop_path)
    return path


def read_bytes(spark: SparkSession, path: str) -> bytes:
    (content,) = spark.read.format("binaryFile").load(path).select("content").first()
    return bytes(content)


def write_json(spark: SparkSession, content: Mapping | list, path: str) -> str:
    """A small report or feature list as one JSON document."""
    return write_bytes(spark, json.dumps(content, indent=2).encode(), path)


def read_json(spark: SparkSession, path: str):
    if not exists(spark, path):
        raise FileNotFoundError(f"file not found: {path}")
    (text,) = spark.read.text(path, wholetext=True).first()
    return json.loads(text)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="tidemark-ship-")  # the driver's own; Spark serves the file from there
        context.addPyFile(shutil.make_archive(f"{folder}/tidemark", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
