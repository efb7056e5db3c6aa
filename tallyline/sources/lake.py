"""Written tables: partition probes, idempotent month writes, scratch tables that cut lineage."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyline.session import shared_root


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return bool(fs.exists(hadoop_path))


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a Spark write into ``path`` has committed."""
    return path_exists(spark, f"{path}/_SUCCESS")


def fingerprint(spark: SparkSession, path: str) -> str:
    """Length and modification time of a file or of all files under a folder."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return "absent"
    status = fs.getFileStatus(hadoop_path)
    if status.isFile():
        return f"{status.getLen()}-{status.getModificationTime()}"
    summary = fs.getContentSummary(hadoop_path)
    return f"{summary.getLength()}-{summary.getFileCount()}-{status.getModificationTime()}"


def list_months(spark: SparkSession, path: str) -> list[str]:
    """Existing ``year_month=`` partitions, newest first. Reads folder names only."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return sorted((n.split("=", 1)[1] for n in names if n.startswith("year_month=")), reverse=True)


def month_times(spark: SparkSession, path: str) -> dict[str, int]:
    """When each ``year_month=`` partition was last replaced, in milliseconds. Reads folder entries only."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return {}
    entries = [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(hadoop_path)]
    return {name.split("=", 1)[1]: time for name, time in entries if name.startswith("year_month=")}


PACKED = {"compression": "zstd"}  # written tables take some two thirds of the default's bytes


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside have their shuffle files deleted as soon as each is done; a written table is never made from them again.

    Otherwise they lie on local disks until the driver happens to collect garbage. The session's own setting comes back afterwards.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, own)


def write_months(df: DataFrame, path: str, laid_out: bool = False) -> None:
    """Write by month, replacing exactly the months present in ``df``.

    The rebalance hint lets AQE split a month that is far larger than the others and pack small ones together. Rows that are
    ``laid_out`` by month already are written where they are.
    """
    rows = df if laid_out else df.hint("rebalance", "year_month")
    with shuffles_dropped(df.sparkSession):
        rows.write.mode("overwrite").options(**PACKED, partitionOverwriteMode="dynamic").partitionBy("year_month").parquet(path)


class Scratch:
    """Unique written tables under the shared folder, used where a plan needs rows to stay where they are.

    A written table survives the loss of executors and, unlike a cached one, is never computed a second time.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_root(spark)}/tallyline-scratch/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex}"
        with shuffles_dropped(self.spark):
            df.write.options(**PACKED).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete this scratch folder, once nothing lazy reads from it any more."""
        fs, hadoop_path = _filesystem(self.spark, self.root)
        fs.delete(hadoop_path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        self.clear()


class Lake:
    """Named tables, each built once from its declared builder and read back from its files afterwards.

    With ``rebuild`` tables that are complete on disk are written again when they are first asked for.
    """

    def __init__(self, spark: SparkSession, root: str, rebuild: bool = False):
        self.spark = spark
        self.rebuild = rebuild
        self.root = root.rstrip("/")
        self.scratch = Scratch(spark, f"{self.root}/_scratch")
        self._builders: dict[str, tuple[Callable[[Lake], DataFrame], bool, bool]] = {}
        self._open: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def declare(self, name: str, builder: Callable[[Lake], DataFrame], by_month: bool = False, laid_out: bool = False) -> None:
        self._builders[name] = (builder, by_month, laid_out)

    def attach(self, name: str, df: DataFrame) -> None:
        """Use a table that is written elsewhere."""
        self._open[name] = df

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._open:
                path = self.path(name)
                if self.rebuild or not is_complete(self.spark, path):
                    self._build(name, path)
                self._open[name] = self.spark.read.parquet(path)
            return self._open[name]

    def _build(self, name: str, path: str) -> None:
        builder, by_month, laid_out = self._builders[name]
        df = builder(self)
        if by_month:
            write_months(df, path, laid_out)
        else:
            with shuffles_dropped(self.spark):
                df.write.mode("overwrite").options(**PACKED).parquet(path)
