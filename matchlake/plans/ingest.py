"""Incremental raw ingest (batch): land new JSON files, quarantine invalid ones.

A file's name is its identity: a name already in the target is skipped, even
when its content changed.  Valid documents are appended to the raw table,
invalid ones to a quarantine table with the same columns.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake import schemas
from matchlake.functions import is_valid_json
from matchlake.operators import anti_new, broadcast_if_small
from matchlake.sources import commit_batch, ensure_table, finish_batches, list_files, loaded_keys, open_files
from matchlake.sources.batches import ROUTE
from matchlake.sources.files import JSON_NAME_GLOB

RAW_COLUMNS = [f.name for f in schemas.RAW_DOCUMENTS.fields]


def new_documents(candidates: DataFrame, loaded: DataFrame, key: str = "file_name") -> DataFrame:
    """Candidates ``(file_name, content)`` whose name is not loaded yet, stamped
    with one load timestamp per batch and flagged ``is_valid``."""
    return (anti_new(candidates, loaded, key)
            .withColumn("file_upload_timestamp", F.current_timestamp())
            .withColumn("is_valid", is_valid_json("content")))


def split_valid(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) rows in the raw-table layout."""
    return (flagged.where(F.col("is_valid")).select(*RAW_COLUMNS),
            flagged.where(~F.col("is_valid")).select(*RAW_COLUMNS))


@dataclass
class IngestReport:
    loaded: int
    quarantined: int


TABLES = {"loaded": schemas.RAW_DOCUMENTS, "quarantined": schemas.QUARANTINE_DOCUMENTS}


def mark_known_bad(candidates: DataFrame, quarantine: str) -> DataFrame:
    """``candidates`` with ``known_bad``: the name is in quarantine already."""
    bad = loaded_keys(candidates.sparkSession, quarantine).withColumn("known_bad", F.lit(True))
    return candidates.join(broadcast_if_small(bad), "file_name", "left")


def write_batch(flagged: DataFrame, target: str, quarantine: str, batch: str | None = None) -> IngestReport:
    """Append a flagged batch (``is_valid``, ``known_bad``) to target and quarantine.

    Both appends are one batch: every document is written once, to staging, and
    one manifest publishes it to both tables or to neither.  A batch name that is
    committed already is not written again.  Invalid files stay candidates on
    later runs (a fixed file then loads), but a name already in quarantine is
    not quarantined twice.  A null name fails the batch; a null content is invalid.
    """
    route = F.when(F.col("is_valid"), "loaded").when(F.col("known_bad").isNull(), "quarantined")
    rows = flagged.withColumn(ROUTE, route).where(F.col(ROUTE).isNotNull()).select(*RAW_COLUMNS, ROUTE)
    counts = commit_batch(rows, batch or uuid.uuid4().hex, {"loaded": target, "quarantined": quarantine}, TABLES)
    return IngestReport(**counts)


def ensure_tables(spark: SparkSession, target: str, quarantine: str) -> None:
    """Both tables exist and hold all that earlier runs have committed."""
    ensure_table(spark, target, schemas.RAW_DOCUMENTS)
    ensure_table(spark, quarantine, schemas.QUARANTINE_DOCUMENTS)
    finish_batches(spark, target)


def ingest_files(spark: SparkSession, source_root: str, target: str, quarantine: str,
                 name_glob: str = JSON_NAME_GLOB) -> IngestReport:
    """Land every new ``*.json`` file under ``source_root`` (recursively).

    Names come first, as a distributed table: the contents of files that are
    loaded already are not read, and no path passes the driver.  One run at a
    time may write to ``target``.
    """
    ensure_tables(spark, target, quarantine)
    names = anti_new(list_files(spark, source_root, name_glob), loaded_keys(spark, target), "file_name")
    files = open_files(mark_known_bad(names, quarantine))
    flagged = files.withColumn("file_upload_timestamp", F.current_timestamp()).withColumn("is_valid", is_valid_json("content"))
    return write_batch(flagged, target, quarantine)
