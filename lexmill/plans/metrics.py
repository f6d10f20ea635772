"""What went in and out of an extraction, counted while it runs.

`observed` puts counters into a table's own job (observed metrics), so they cost no scan of their own; `Counts` names the steps of a run and gives one
row per step and cause once the run's rows have been written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Counts:
    def __init__(self):
        self.steps: list[tuple[str, Observation]] = []

    def observed(self, step: str, df: DataFrame, causes: dict[str, Column]) -> DataFrame:
        """`df`, whose rows are counted as `rows` and those that each cause holds for by its name, when it is next run."""
        seen = Observation(f"{step}-{len(self.steps)}")
        self.steps.append((step, seen))
        counters = [F.count_if(c).alias(name) for name, c in causes.items()]
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counters)

    def rows(self, spark: SparkSession) -> DataFrame:
        """(step, cause, n). Only after an action over the observed tables; a few rows per step reach the driver."""
        found = [(step, cause, n) for step, seen in self.steps for cause, n in seen.get.items()]
        return spark.createDataFrame(found, "step string, cause string, n long")


def absent(*columns: str) -> dict[str, Column]:
    """Causes `no_<column>`: fields an extraction did not find."""
    return {f"no_{c}": F.col(c).isNull() for c in columns}


def observed(counts: Counts | None, step: str, df: DataFrame, causes: dict[str, Column] | None = None) -> DataFrame:
    return df if counts is None else counts.observed(step, df, causes or {})
