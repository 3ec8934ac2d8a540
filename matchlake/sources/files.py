"""File scans: whole JSON files as rows, with names relative to the root."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Case-insensitive ".json" suffix, as a Hadoop glob (applied to file names).
JSON_NAME_GLOB = "*.[jJ][sS][oO][nN]"


def qualify(spark: SparkSession, root: str) -> str:
    """``root`` as the fully qualified URI Spark reports (scheme added, a
    relative path resolved against the JVM's working folder)."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(root)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return fs.makeQualified(p).toString()
    except Exception:  # noqa: BLE001 - no JVM access; keep the path as given
        return root


def _root_uri_pattern(root: str) -> str:
    """Regex matching the URI prefix Spark reports for files under ``root``."""
    root = root.rstrip("/")
    if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", root):          # gs://b/p, file:/x
        scheme, rest = root.split(":", 1)
        return "^" + re.escape(scheme) + ":/*" + re.escape(rest.lstrip("/")) + "/"
    local = os.path.abspath(root)            # Spark reports absolute URIs
    return "^[a-zA-Z][a-zA-Z0-9+.-]*:/*" + re.escape(local.lstrip("/")) + "/"


def relative_name(path: Column, root: str, spark: SparkSession | None = None) -> Column:
    """File name relative to ``root``, URL-decoded (Spark reports paths as
    URIs, so a space arrives as ``%20``; a literal ``+`` stays ``+``)."""
    if spark is not None:
        root = qualify(spark, root)
    decoded = F.url_decode(F.regexp_replace(path, r"\+", "%2B"))
    return F.regexp_replace(decoded, _root_uri_pattern(root), "")


def scan_json_files(spark: SparkSession, root: str, name_glob: str = JSON_NAME_GLOB,
                    recursive: bool = True) -> DataFrame:
    """One row ``(file_name, content)`` per file under ``root`` whose name
    matches ``name_glob``; a pretty-printed file stays one row.

    A folder that Arrow opens is listed by tasks and its files are opened by
    path (``landing``), so neither their number nor their names pass the driver
    and small files do not mean millions of tasks.  Anything else (a glob, one
    file, a store that only Spark reads, ``recursive=False``) goes to Spark's text
    reader, where ``wholetext`` must be a keyword of ``text()``: set as an option
    it is overridden.  Zero-byte files are skipped either way.
    """
    from matchlake.sources.landing import list_files, listable, open_files

    if recursive and listable(spark, root):
        return open_files(list_files(spark, root, name_glob))
    raw = spark.read.text(root, wholetext=True, pathGlobFilter=name_glob,
                          recursiveFileLookup=recursive)
    return raw.select(relative_name(F.col("_metadata.file_path"), root, spark).alias("file_name"),
                      F.col("value").alias("content"))
