"""Sinks: appends, materialised tables and views, versioned replacement."""

from __future__ import annotations

import contextlib
import datetime as _dt
import re
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.sources.batches import enforce_required

VERSION_COL = "_version"


def append_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, schema: T.StructType | None = None) -> None:
    """Append rows to a Parquet table (the committer makes each append atomic).
    With ``schema`` a null in one of its REQUIRED columns fails the append."""
    w = (df if schema is None else enforce_required(df, schema)).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def materialize_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table and return a reader over it.

    The write also cuts the lineage: downstream plans start from the files.
    ``path`` must not be an input of ``df``.
    """
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def sort_columns(order: str) -> list[Column]:
    """Sort columns of a text like ``'season, points desc'``: ascending ones
    put NULL first, descending ones last."""
    parts = [re.fullmatch(r"(\w+)(?: (asc|desc))?", p.strip()) for p in order.split(",")]
    return [F.desc(m[1]) if m[2] == "desc" else F.asc(m[1]) for m in parts]


def write_sorted(df: DataFrame, path: str, order: str) -> None:
    """Write ``df`` as Parquet files that hold the rows in ``order``: the files
    are consecutive ranges, in the order of their part numbers, each sorted."""
    df.orderBy(*sort_columns(order)).write.mode("overwrite").parquet(path)


def read_positions(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """Rows of a table written by ``write_sorted`` with their place in it, 1 for
    the first: the rows of the files before, one number per file, plus the row's
    index in its own file.  No row moves and nothing is sorted again."""
    rows = spark.read.parquet(path)
    file, row = F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row")
    counts = rows.select(file).groupBy("__file").agg(F.count(F.lit(1)).alias("__own"))
    part = F.regexp_extract("__file", r"^part-(\d+)", 1).cast("int")
    ahead = Window.orderBy(part, "__file").rowsBetween(Window.unboundedPreceding, -1)      # over one row per file
    before = counts.select("__file", F.coalesce(F.sum("__own").over(ahead), F.lit(0)).alias("__before"))
    placed = rows.select("*", file, row).join(F.broadcast(before), "__file")
    return placed.select(*rows.columns, (F.col("__before") + F.col("__row") + 1).alias(position))


def replace_partitions(df: DataFrame, path: str, by: str, fmt: str = "parquet", **options: str) -> None:
    """Replace the partitions of ``by`` that ``df`` has rows of, and no other
    (dynamic partition overwrite).  ``df`` may read the table: rows are staged
    first and moved at the end; its other inputs should be pinned."""
    (df.write.format(fmt).options(**options).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).save(path))


def has_partitions(spark: SparkSession, path: str, by: str) -> bool:
    """Whether ``path`` is a folder partitioned by ``by`` first."""
    return any(n.startswith(f"{by}=") for n in _Folder(spark, path).names())


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temporary view (lazy, recomputed per query)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def checkpoint_reliably(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder (``spark.checkpoint.dir``) with
    its lineage cut.  The rows are cached while the checkpoint is written, so
    the plan runs once rather than once for the action and once for the write."""
    from pyspark import StorageLevel

    from matchlake.session import shared_dir

    shared_dir(df.sparkSession)            # make sure a checkpoint folder is set
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def new_version() -> str:
    """Sortable version label from the UTC clock (no listing needed)."""
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")


def write_version(df: DataFrame, base: str, fmt: str = "parquet", version: str | None = None,
                  **options: str) -> str:
    """Replace-in-full without overwriting: write a new ``_version=<v>`` folder.

    Readers take the newest committed version, so a job may read the
    previous version while writing the next one, and a failed write leaves
    the previous version in place (its folder never gets committed).
    """
    v = version or new_version()
    df.write.format(fmt).options(**options).mode("errorifexists").save(f"{base}/{VERSION_COL}={v}")
    return v


LEASES, DOOMED = "_leases", "_doomed"


class _Folder:
    """Names and markers of a versioned folder, through the file system Spark uses."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.base = spark.sparkContext._jvm, base
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, name: str = "") -> list[str]:
        p = self._path(name)
        return [f.getPath().getName() for f in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def modified(self, name: str) -> float:
        return self.fs.getFileStatus(self._path(name)).getModificationTime() / 1000

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def mark(self, name: str) -> None:
        self.fs.create(self._path(name), True).close()

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def committed(self) -> list[str]:
        """Versions whose writer has left ``_SUCCESS``, oldest first."""
        return sorted(n.removeprefix(f"{VERSION_COL}=") for n in self.names()
                      if n.startswith(f"{VERSION_COL}=") and self.exists(f"{n}/_SUCCESS"))


def read_latest(spark: SparkSession, base: str, fmt: str = "parquet", schema=None,
                **options: str) -> DataFrame:
    """Rows of the newest committed version under ``base`` (see
    ``write_version``), also when that version is empty.  A version counts once
    its writer has left ``_SUCCESS``; only that one folder is read.  Without a
    committed version the result is empty (``schema``) or an error.  The rows
    may be collected by ``collect_versions``; ``open_latest`` holds on to them."""
    done = _Folder(spark, base).committed()
    return _version(spark, base, done[-1] if done else None, fmt, schema, options)


def _version(spark: SparkSession, base: str, version: str | None, fmt: str, schema, options) -> DataFrame:
    if version is None:
        if schema is None:
            raise FileNotFoundError(f"no committed version under {base}")
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{base}/{VERSION_COL}={version}")


@contextlib.contextmanager
def open_latest(spark: SparkSession, base: str, fmt: str = "parquet", schema=None, lease_seconds: float = 86_400,
                **options: str) -> Iterator[DataFrame]:
    """``read_latest`` under a lease: until the block ends (or the lease's time
    is over, for readers that died) the version is not collected.

    The lease is left before the version is looked at again; a collector marks
    a version before it looks for leases.  So one of the two always sees the
    other, and the reader goes on to the version that is newest then.
    """
    folder = _Folder(spark, base)
    while True:
        done = folder.committed()
        version = done[-1] if done else None
        lease = f"{LEASES}/{version}~{int(time.time() + lease_seconds)}~{uuid.uuid4().hex[:12]}"
        if version is None:
            yield _version(spark, base, None, fmt, schema, options)
            return
        folder.mark(lease)
        if not folder.exists(f"{DOOMED}/{version}") and folder.exists(f"{VERSION_COL}={version}/_SUCCESS"):
            break
        folder.delete(lease)
    try:
        yield _version(spark, base, version, fmt, schema, options)
    finally:
        folder.delete(lease)


def collect_versions(spark: SparkSession, base: str, keep: int = 2, grace_seconds: float = 86_400) -> list[str]:
    """Delete committed versions but the newest ``keep`` that no lease holds,
    and folders without ``_SUCCESS`` older than ``grace_seconds`` (writers that
    died); returns what was deleted.  Expired leases go, too."""
    if keep < 1:
        raise ValueError("the newest version always stays")
    folder, now, gone = _Folder(spark, base), time.time(), []
    done = folder.committed()

    def held(version: str) -> bool:
        return any(n.split("~")[0] == version and float(n.split("~")[1]) > now for n in folder.names(LEASES))
    for lease in folder.names(LEASES):
        if float(lease.split("~")[1]) <= now:
            folder.delete(f"{LEASES}/{lease}")
    for version in done[:-keep]:
        folder.mark(f"{DOOMED}/{version}")
        if not held(version):
            folder.delete(f"{VERSION_COL}={version}")
            gone.append(version)
        folder.delete(f"{DOOMED}/{version}")
    for name in folder.names():
        if name.startswith(f"{VERSION_COL}=") and name.removeprefix(f"{VERSION_COL}=") not in done \
                and now - folder.modified(name) > grace_seconds and not folder.exists(f"{name}/_SUCCESS"):
            folder.delete(name)
            gone.append(name.removeprefix(f"{VERSION_COL}="))
    return gone
