"""Row counts reported alongside a job, collected by the job's own action."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter; read ``obs.get[name]`` after the next action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs
