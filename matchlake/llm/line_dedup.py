"""Line dedup by overlapping three-line windows.

Every three consecutive lines of a document are hashed; a window that occurs
more than once in the corpus keeps its first occurrence (smallest document,
then smallest position) and all later ones are removed by merging the lines
they cover.  All of it is DataFrame work: a hot window is combined on the map
side into one row per task, and the join that finds the later occurrences is
left to AQE, which splits a hot window's side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.spans import row_texts
from matchlake.llm.store import stored

WINDOW = 3


def _windows(rows: DataFrame, width: int) -> DataFrame:
    """One row per window: row key, index of its first line, two 64-bit hashes.
    The lines and the lines after them are zipped, so a text is split once and
    each line is looked at ``width`` times, however many there are."""
    n = F.size("lines") - width + 1
    zipped = F.arrays_zip(*[F.slice("lines", F.lit(k + 1), F.greatest(n, F.lit(0))) for k in range(width)])
    each = rows.select("doc", F.posexplode(F.when(n > 0, zipped)).alias("pos", "w"))
    # the whole window as one text: a line feed stands in no line
    said = F.concat_ws("\n", *[F.col("w").getItem(str(k)) for k in range(width)])
    return each.select("doc", "pos", F.xxhash64(said).alias("a"), F.xxhash64(F.lit("second"), said).alias("b"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, text (what is kept).

    Lines are what stands between line feeds, empty ones included, compared as
    they are.  A null or empty text is one empty line.  Documents of fewer
    than ``width`` lines have no window and stay whole.  Each row is a document
    of its own: null identifiers rank after every other one, and rows that
    share an identifier by their texts, as ``spans.row_keys`` says.  Other
    columns are not read; an empty table gives an empty result.
    """
    rows = row_texts(docs, id_col, text_col).select("doc", "doc_id", F.split("text", "\n", -1).alias("lines"))
    windows = _windows(rows, width)
    first = (windows.groupBy("a", "b")
                    .agg(F.min(F.struct("doc", "pos")).alias("first"), F.max(F.struct("doc", "pos")).alias("last"))
                    .where("first != last"))
    later = (windows.join(first, ["a", "b"])
                    .where(F.struct("doc", "pos") != F.col("first"))
                    .groupBy("doc").agg(F.collect_set("pos").alias("cut")))
    later = stored(later, "line-dedup")
    # the starts in order: what is kept stands between one window's end and the next one's start
    starts = F.array_sort("cut")
    ends = F.concat(F.array(F.lit(0)), F.transform(starts, lambda p: p + width))
    begins = F.concat(starts, F.array(F.size("lines")))
    pieces = F.zip_with(ends, begins, lambda e, b: F.when(b > e, F.slice("lines", e + 1, b - e)).otherwise(F.array().cast("array<string>")))
    out = rows.join(later, "doc", "left").withColumn("kept", F.when(F.col("cut").isNull(), F.col("lines")).otherwise(F.flatten(pieces)))
    return out.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                      (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
                      F.array_join("kept", "\n").alias("text"))
