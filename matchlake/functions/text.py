"""String, numeric and conditional helpers with the warehouse's semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlake import constants as C


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_first(col: Column | str, delimiter: str) -> Column:
    """``SPLIT(s, d)[OFFSET(0)]`` with a literal delimiter (``split`` would take
    a regex, where ``.`` matches everything); no delimiter gives the whole text."""
    return F.split_part(_c(col), F.lit(delimiter), F.lit(1))


def regexp_group(col: Column | str, pattern: str, group: int = 1) -> Column:
    """Capture group, NULL when the pattern does not match (Spark returns '')."""
    c = _c(col)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def ceil_double(col: Column | str) -> Column:
    """CEIL of text or number as DOUBLE (Spark's ceil returns an integral type)."""
    return F.ceil(_c(col).cast("double")).cast("double")


def margin_label(wickets: Column | str, runs: Column | str) -> Column:
    """'<n> wickets', else '<n> runs', else 'no result' (ties included)."""
    w, r = _c(wickets), _c(runs)
    return (F.when(w.isNotNull(), F.concat(w, F.lit(C.WICKETS_SUFFIX)))
            .when(r.isNotNull(), F.concat(r, F.lit(C.RUNS_SUFFIX)))
            .otherwise(F.lit(C.NO_RESULT)))


def flag_from_predicate(predicate: Column) -> Column:
    """``CASE WHEN p THEN true ELSE false END``: NULL reads as false."""
    return F.coalesce(predicate, F.lit(False))
