"""Run totals counted by the passes that write.

``watch`` attaches aggregates to a frame just below its write. They ride on the
write's own tasks (``DataFrame.observe``) and cost no other pass. Put them after
the last shuffle: a task of the writing stage counts once however often it is
tried, while a stage before a shuffle may run again when an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession


class RunTotals:
    def __init__(self):
        self.watched: list[Observation] = []

    def watch(self, df: DataFrame, **aggregates: Column) -> DataFrame:
        seen = Observation()
        self.watched.append(seen)
        return df.observe(seen, *[a.alias(name) for name, a in aggregates.items()])

    def values(self) -> dict[str, int]:
        """All totals; waits for writes that are still running."""
        return {k: v for seen in self.watched for k, v in seen.get.items()}

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.values().items()), "metric string, n long")
