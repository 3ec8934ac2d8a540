"""Exactly-once appends: staged files, published by an atomic batch manifest.

A batch is written once, to a hidden staging folder, split by the table each
row goes to.  The manifest that lists its files is then created by one rename:
that rename is the commit.  Publishing moves the staged files into the tables
under names fixed by the batch, so it can be broken off anywhere and finished by
the next run; a batch without a manifest never happened.  Readers need nothing
special: staging and ledger are hidden folders of the first table.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAGING, LEDGER = "_staging", "_batches"
ROUTE = "__to"


class _Files:
    """The few file-system calls a manifest needs, through Hadoop's own client."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder))) if self.exists(folder) else []

    def read(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, p: str, text: str) -> None:
        out = self.fs.create(self.path(p), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def move(self, a: str, b: str) -> bool:
        return self.fs.rename(self.path(a), self.path(b))

    def make(self, p: str) -> None:
        self.fs.mkdirs(self.path(p))

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)


def required(schema: T.StructType) -> list[str]:
    """The REQUIRED columns of a table: those its schema does not let be null."""
    return [f.name for f in schema.fields if not f.nullable]


def missing_required(schema: T.StructType) -> Column:
    """The names of a row's REQUIRED columns that are null, as an array (empty: complete)."""
    names = [F.when(F.col(c).isNull(), F.lit(c)) for c in required(schema)]
    return F.filter(F.array(*names), lambda c: c.isNotNull()) if names else F.array().cast("array<string>")


def enforce_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` whose evaluation fails on a null in a REQUIRED column: the check
    is part of the plan that writes, so no such row can reach a table."""
    def checked(c: str) -> Column:
        return F.coalesce(F.col(c), F.raise_error(F.lit(f"REQUIRED column {c} is null")).cast(df.schema[c].dataType)).alias(c)
    must = set(required(schema))
    return df.select(*[checked(c) if c in must else F.col(c) for c in df.columns])


def finish_batches(spark: SparkSession, ledger_table: str) -> list[str]:
    """Publishes what earlier runs have committed and not finished, and drops
    what they have staged and not committed; returns the batches finished."""
    files, ledger = _Files(spark, ledger_table), f"{ledger_table}/{LEDGER}"
    pending = [n for n in files.names(ledger) if n.endswith(".json")]
    for name in pending:
        _publish(files, ledger_table, json.loads(files.read(f"{ledger}/{name}")))
    for batch in files.names(f"{ledger_table}/{STAGING}"):
        files.delete(f"{ledger_table}/{STAGING}/{batch}")
    return [n.removesuffix(".json") for n in pending]


def _publish(files: _Files, ledger_table: str, manifest: dict) -> None:
    for staged, final in manifest["moves"]:
        if files.exists(staged):
            files.make(final.rsplit("/", 1)[0])
            if not files.move(staged, final) and files.exists(staged):
                raise OSError(f"cannot move {staged} to {final}")
        elif not files.exists(final):
            raise FileNotFoundError(f"batch {manifest['batch']}: neither {staged} nor {final}")
    ledger, batch = f"{ledger_table}/{LEDGER}", manifest["batch"]
    files.move(f"{ledger}/{batch}.json", f"{ledger}/{batch}.done")
    files.delete(f"{ledger_table}/{STAGING}/{batch}")


def committed(spark: SparkSession, ledger_table: str, batch: str) -> dict | None:
    """The manifest of a batch that is committed, published or not."""
    files = _Files(spark, ledger_table)
    for end in ("json", "done"):
        if files.exists(p := f"{ledger_table}/{LEDGER}/{batch}.{end}"):
            return json.loads(files.read(p))
    return None


def commit_batch(rows: DataFrame, batch: str, tables: Mapping[str, str], schemas: Mapping[str, T.StructType] | None = None) -> dict[str, int]:
    """Appends ``rows`` to several tables at once, each row to ``tables[row.__to]``.

    All or nothing, and once: a batch that is committed already is published if
    need be and not written again.  The first table keeps the ledger; all must
    be on one file system.  ``schemas``: REQUIRED columns, whose nulls the write
    counts; with any, the error names every such column, whichever task came
    first, and nothing is committed.  Returns the rows of each table, counted by
    the write.
    """
    spark, home = rows.sparkSession, next(iter(tables.values()))
    files = _Files(spark, home)
    known = committed(spark, home, batch)
    if known is None:
        staging = f"{home}/{STAGING}/{batch}"
        broken = {f"REQUIRED column {c} of {name} is null": (F.col(ROUTE) == name) & F.col(c).isNull()
                  for name, schema in (schemas or {}).items() for c in required(schema)}
        seen = Observation()
        counted = rows.observe(seen, *[F.count_if(F.col(ROUTE) == name).alias(name) for name in tables],
                               *[F.count_if(x).alias(told) for told, x in broken.items()])
        counted.write.mode("overwrite").partitionBy(ROUTE).parquet(staging)
        if wrong := [f"{told} in {seen.get[told]} rows" for told in broken if seen.get[told]]:
            files.delete(staging)
            raise ValueError(f"batch {batch}: {'; '.join(wrong)}")
        moves = []
        for name, table in tables.items():
            own = f"{staging}/{ROUTE}={name}"
            staged = [n for n in files.names(own) if not n.startswith(("_", "."))]
            moves += [(f"{own}/{n}", f"{table}/part-{k:05d}-{batch}.parquet") for k, n in enumerate(staged)]
        known = {"batch": batch, "moves": moves, "counts": {name: seen.get[name] for name in tables}}
        files.make(f"{home}/{LEDGER}")
        files.write(f"{home}/{LEDGER}/.{batch}.tmp", json.dumps(known))
        if not files.move(f"{home}/{LEDGER}/.{batch}.tmp", f"{home}/{LEDGER}/{batch}.json"):
            raise OSError(f"cannot commit batch {batch}")
    elif files.exists(f"{home}/{LEDGER}/{batch}.done"):
        return {name: 0 for name in tables}
    _publish(files, home, known)
    return known["counts"]


def batch_counts(spark: SparkSession, ledger_table: str) -> DataFrame:
    """``(batch, table, rows)``: what each committed batch has appended, as its manifest says."""
    path = f"{ledger_table}/{LEDGER}"
    schema = "batch string, counts map<string,bigint>"
    if not _Files(spark, ledger_table).exists(path):
        return spark.createDataFrame([], "batch string, table string, rows long")
    told = spark.read.schema(schema).option("pathGlobFilter", "*.{done,json}").json(path)
    return told.select("batch", F.explode("counts").alias("table", "rows"))
