"""Written tables that cut lineage: Parquet in the folder every executor shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import scratch_dir

#: Written tables up to this many bytes on disk may be broadcast instead of shuffling texts.
SMALL = 8 << 20


#: Drops the shuffle files of a query once it has ended.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written once under ``spark.checkpoint.dir`` and read back.

    The files survive a lost executor, so later steps never recompute what
    stands before; unlike a checkpoint the copy can be pruned by column.  The
    shuffle files behind it are dropped when it is written.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing unevaluated reads any more."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_of(col: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
