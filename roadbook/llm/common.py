"""What the operators share: reading tables, shipping this package, short-lived tables."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from roadbook.session import shared_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did.

    On a cluster the package is installed on, or sent to, the executors
    (``--py-files``); the extra path entry then does no harm.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with its columns renamed ``c0, c1, …``, and the new name of each: a caller's names clash with none."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def workers(spark: SparkSession) -> int:
    """Shuffle partitions as the session sets them: how finely heavy Python work is dealt."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark keeps it; nothing where the session has ended."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def free_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark deletes a query's shuffle files when the query ends, not when its frames are forgotten."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Scratch:
    """Tables in the folder that ``spark.checkpoint.dir`` names, one folder for each run.

    ``keep`` cuts a lineage by writing it; the files outlive lost executors.
    ``drop`` deletes a table that nothing reads any more; what is left goes when
    the session's program ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        atexit.register(self._delete, self.folder)

    def keep(self, df: DataFrame, compression: str | None = None) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path, compression=compression)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored._scratch_path = path
        return stored

    def drop(self, *tables: DataFrame) -> None:
        for stored in tables:
            self._delete(stored._scratch_path)

    def _delete(self, path: str) -> None:
        delete(self.spark, path)
