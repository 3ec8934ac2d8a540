"""Table sources: registry of named inputs, seeds, CSV edges, loaded keys."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from matchlake import schemas

SEED_DIR = os.path.join(os.path.dirname(__file__), "seeds")
SEEDS: dict[str, T.StructType] = {
    "default_powerplay": schemas.DEFAULT_POWERPLAY,
    "playoffs_code": schemas.PLAYOFFS_CODE,
}


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when its scan yields at most
    half as many partitions (a file with a single row group is one task).

    The partition count comes from the physical plan (no job runs).  A large
    input already has more splits than cores and is returned unchanged, so on
    a cluster this adds no shuffle.  Filters and column pruning still reach
    the scan below the repartition.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    try:
        have = df._jdf.queryExecution().executedPlan().execute().getNumPartitions()
    except Exception:  # noqa: BLE001 - no JVM access (e.g. a remote session)
        return df
    # Only a clearly under-split scan (at most half the cores busy) is worth a shuffle.
    return df.repartition(want) if have * 2 <= want else df


def read_seed(spark: SparkSession, name: str) -> DataFrame:
    """A seed CSV shipped with the package (a handful of fixed rows)."""
    path = os.path.join(SEED_DIR, f"{name}.csv")
    return spark.read.schema(SEEDS[name]).option("header", True).option("mode", "FAILFAST").csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the file system Spark itself uses."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             missing: str = "error") -> DataFrame:
    """CSV with a header and a declared schema.

    ``missing='empty'`` turns an absent path into an empty frame of that
    schema (a previous result that does not exist yet); ``'error'`` raises
    ``FileNotFoundError`` (a required input).
    """
    if not path_exists(spark, path):
        if missing == "empty":
            return spark.createDataFrame([], schema)
        raise FileNotFoundError(path)
    return spark.read.schema(schema).option("header", True).csv(path)


def read_table_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                        fmt: str = "parquet") -> DataFrame:
    """Existing table at ``path``, or an empty frame with ``schema``."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(path)


def loaded_keys(spark: SparkSession, target: str, key: str = "file_name",
                schema: T.StructType = schemas.RAW_DOCUMENTS) -> DataFrame:
    """Distinct keys already in the target table; only the key column is read."""
    return read_table_or_empty(spark, target, schema).select(key).distinct()


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Create an empty table with ``schema`` at ``path`` if none exists; return it."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class Source:
    path: str
    schema: T.StructType | None = None
    fmt: str = "parquet"
    options: Mapping[str, str] | None = None


class SourceRegistry:
    """Named inputs (the ``source(...)`` of a model) resolved to readers."""

    def __init__(self, spark: SparkSession, sources: Mapping[str, Source]):
        self.spark = spark
        self.sources = dict(sources)

    def read(self, name: str) -> DataFrame:
        s = self.sources[name]
        reader = self.spark.read.format(s.fmt).options(**(s.options or {}))
        if s.schema is not None:
            reader = reader.schema(s.schema)
        return reader.load(s.path)

    def names(self) -> list[str]:
        return sorted(self.sources)
