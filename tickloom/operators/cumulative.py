"""State over many runs: counters that merge, kept as a table with a part for each run.

A run adds its own rows under its name; written again under the same name they
replace themselves, so a run that failed half way is repeated without counting
twice. The state is what all runs merge to: counts and sums add up, extremes
are extremes. Metrics observed while a frame is written (``measured``) come
along without a second pass.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: How the columns of two runs merge.
MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


class State:
    """Counters by ``key``; ``merges`` names each counter's rule (sum, min or max)."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], merges: Mapping[str, str]):
        unknown = set(merges.values()) - MERGES.keys()
        if unknown:
            raise ValueError(f"unknown merges: {sorted(unknown)}")
        self.spark, self.path, self.key, self.merges = spark, path.rstrip("/"), list(key), dict(merges)

    def merged(self, rows: DataFrame) -> DataFrame:
        """One row for each key."""
        return rows.groupBy(*self.key).agg(*(MERGES[how](name).alias(name) for name, how in self.merges.items()))

    def add(self, run: str, rows: DataFrame) -> None:
        """A run's counters, in place of those it wrote before."""
        self.merged(rows).write.mode("overwrite").parquet(f"{self.path}/run={run}")

    def runs(self) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/run=*")

    def total(self) -> DataFrame:
        """The state after all runs."""
        return self.merged(self.runs())

    def compact(self, run: str, runs: Sequence[str]) -> None:
        """Write several runs' counters as one run's, for states of very many runs. The old parts must go before the next ``total``."""
        self.merged(self.runs().where(F.col("run").cast("string").isin(*runs))).write.mode("overwrite").parquet(f"{self.path}/run={run}")


def measured(frame: DataFrame, metrics: Mapping[str, Column], write) -> dict:
    """``write(frame)``, and the metrics of the rows that went through it: one pass."""
    seen = Observation()
    write(frame.observe(seen, *(c.alias(n) for n, c in metrics.items())))
    return dict(seen.get)


def counters(spark: SparkSession, run: str, metrics: Mapping[str, object]) -> DataFrame:
    """Measured metrics as rows (run, metric, value as JSON text)."""
    return spark.createDataFrame([(run, name, json.dumps(value, default=str)) for name, value in sorted(metrics.items())], "run string, metric string, value string")
