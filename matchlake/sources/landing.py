"""Landing folders of many small files, listed, opened and written by tasks.

Paths stay a distributed table from the listing to the read: no file name
passes the driver.  A folder tree is listed level by level, each task listing
its share of a level's folders, so the rounds are the depth of the tree.  Files
are opened by path with ``pyarrow.fs`` inside tasks that each take about
``spark.sql.files.maxPartitionBytes`` of them, or are many small ones.
"""

from __future__ import annotations

import fnmatch
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.sources.files import JSON_NAME_GLOB, qualify

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Files read or written between two Arrow batches: by count and by bytes.
BATCH_FILES, BATCH_BYTES = 256, 8 << 20
#: Tasks a core that small files are dealt out to, at most.
WAVES = 4


def _file_system(uri: str):
    """(file system, path in it) of a fully qualified URI; the path is taken as
    it stands, so ``%`` and ``+`` in names mean themselves."""
    from pyarrow import fs

    m = re.match(r"^([a-zA-Z][a-zA-Z0-9+.-]*):(?://([^/]*))?(/.*)?$", uri)
    if not m:
        raise ValueError(f"not a qualified path: {uri}")
    scheme, authority, path = m[1], m[2] or "", m[3] or "/"
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, base.rstrip("/") + path


def listable(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` is an existing folder of a kind that ``list_files`` opens."""
    scheme = qualify(spark, root).split(":", 1)[0]
    if scheme not in ("file", "hdfs", "s3", "gs", "abfs", "abfss"):
        return False
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).isDirectory(path)


def _hidden(name: str) -> bool:
    """Names Spark's readers leave out, too."""
    return name.startswith(".") or name.startswith("_") and "=" not in name


_LISTED = "file_name string, path string, length long, modified timestamp, is_dir boolean"


def _list(glob: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for prefix, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, path = _file_system(uri)
                infos = system.get_file_info(fs.FileSelector(path, recursive=False))
                for k in range(0, len(infos), 10_000):
                    kept = [(i, i.type == fs.FileType.Directory) for i in infos[k: k + 10_000] if not _hidden(i.base_name)]
                    kept = [(i, d) for i, d in kept if d or (i.size and fnmatch.fnmatchcase(i.base_name, glob))]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([prefix + i.base_name for i, _ in kept], pa.string()),
                        pa.array([f"{uri.rstrip('/')}/{i.base_name}" for i, _ in kept], pa.string()),
                        pa.array([i.size or 0 for i, _ in kept], pa.int64()),
                        pa.array([i.mtime for i, _ in kept], pa.timestamp("us", tz="UTC")),
                        pa.array([d for _, d in kept], pa.bool_())], ["file_name", "path", "length", "modified", "is_dir"])
    return run


def list_files(spark: SparkSession, root: str, name_glob: str = JSON_NAME_GLOB) -> DataFrame:
    """``(file_name, path, length, modified)`` of every file under ``root``
    whose own name matches ``name_glob`` (``* ? [..]``), names relative to
    ``root`` as they stand in the file system.

    Each level of folders is listed by tasks and written to the shared folder,
    so a lost executor does not list again.  Zero-byte files and names Spark
    hides are left out.  ``root`` must be of a kind that Arrow opens (file,
    hdfs, s3, gs, abfs).
    """
    from matchlake.session import scratch_dir

    dirs = spark.createDataFrame([("", qualify(spark, root))], "file_name string, path string")
    levels: list[DataFrame] = []
    while not dirs.isEmpty():
        at = scratch_dir(spark, "listing")
        dirs.select("file_name", "path").mapInArrow(_list(name_glob), _LISTED).write.parquet(at)
        level = spark.read.schema(_LISTED).parquet(at)
        levels.append(level.where("not is_dir").drop("is_dir"))
        # folders of the next level, spread over the cores whatever their parents' tasks were
        dirs = level.where("is_dir").select(F.concat("file_name", F.lit("/")).alias("file_name"), "path") \
                    .repartition(spark.sparkContext.defaultParallelism)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def _open(keep: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        systems: dict[str, tuple] = {}
        for batch in batches:
            start, texts, size = 0, [], 0
            for k, uri in enumerate(batch.column(1).to_pylist()):
                where = re.match(r"^[^:]+:(?://[^/]*)?", uri)[0]
                if where not in systems:
                    system, path = _file_system(uri)
                    systems[where] = system, path[: len(path) - len(uri[len(where):])]
                system, base = systems[where]
                with system.open_input_stream((base + uri[len(where):]) if base else "/" + uri[len(where):].lstrip("/")) as f:
                    texts.append(f.read().decode("utf-8", "replace"))
                size += len(texts[-1])
                if len(texts) == BATCH_FILES or size >= BATCH_BYTES or k + 1 == batch.num_rows:
                    part = batch.slice(start, len(texts))
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.string())], names)
                    start, texts, size = k + 1, [], 0
    return run


def open_files(files: DataFrame) -> DataFrame:
    """``(file_name, .., content)``: the whole contents of listed files
    (``file_name``, ``path``, ``length`` and any columns to keep), and of no
    other; malformed UTF-8 is replaced, as Spark's text reader does.

    The files are dealt out by path to as many tasks as their bytes fill
    (``maxPartitionBytes``); each file counts ``openCostInBytes`` more until
    there are ``WAVES`` tasks a core, so that small files in any number make no
    more tasks, and no more parts of a table written from them, than that.  A
    file that is gone by now is an error.
    """
    spark = files.sparkSession
    most = _bytes(spark, "spark.sql.files.maxPartitionBytes")
    cost = _bytes(spark, "spark.sql.files.openCostInBytes")
    held, count = files.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    cores = spark.sparkContext.defaultParallelism
    opened = max(-(-(held + count * cost) // most), min(cores, count))
    tasks = max(-(-held // most), min(opened, WAVES * cores), 1)
    extra = [c for c in files.columns if c not in ("file_name", "path", "length", "modified")]
    given = files.select("file_name", "path", *extra).repartition(int(tasks), "path")
    kept = [0, *range(2, 2 + len(extra))]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in given.select("file_name", *extra).schema), "content string"])
    return given.mapInArrow(_open(kept, ["file_name", *extra, "content"]), schema)


def _bytes(spark: SparkSession, key: str) -> int:
    """A size setting in bytes ('128MB', '4m', '1048576b')."""
    n, unit = re.match(r"^\s*(\d+)\s*([kmgt]?)b?\s*$", spark.conf.get(key).lower()).groups()
    return int(n) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _write(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(root)
        made: set[str] = set()
        for batch in batches:
            sizes = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = f"{base.rstrip('/')}/{name}"
                folder = path.rsplit("/", 1)[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                raw = (content or "").encode()
                with system.open_output_stream(path) as f:
                    f.write(raw)
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["file_name", "length"])
    return run


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Every row of ``(file_name, content)`` as a file under ``root``; returns
    ``(file_name, length)`` of what was written.  A task that runs again writes
    the same files again, so the names must not repeat."""
    from matchlake.session import scratch_dir

    spark, at = files.sparkSession, scratch_dir(files.sparkSession, "written")
    files.select("file_name", "content").mapInArrow(_write(qualify(spark, root)), "file_name string, length long").write.parquet(at)
    return spark.read.parquet(at)
