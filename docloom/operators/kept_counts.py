"""Counts of groups that follow a changing table by what its commits changed, without counting the rest again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.delta_table import DeltaTable


class KeptCounts:
    """How many rows of a table each group has, and of how many things: for each group and thing a row with its number of rows.

    A group that has lost its last row goes. The counts name the version of the table that
    they are of, in the same commit: refresh() after a crash goes on from there, and twice
    is once. test: an SQL condition of the rows that count.
    """

    def __init__(self, source: DeltaTable, path: str, group: Sequence[str], things: Sequence[str] = (), test: str = "true", buckets: int = 16) -> None:
        self.source, self.group, self.things, self.test = source, list(group), list(things), test
        self.table = DeltaTable(source.spark, path)
        if not self.table.exists():
            version = source.versions()[-1]
            counted = self._counted(source.read(version))
            DeltaTable.create(counted, path, self.group + self.things, buckets=buckets)
            self.table.change(counted.limit(0), lambda old: old, ("version", version))

    def _counted(self, rows: DataFrame) -> DataFrame:
        keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in self.group + self.things]
        return rows.filter(self.test).groupBy(*keys).agg(F.count("*").alias("n"))

    def refresh(self) -> int:
        """Bring the counts to the table's current version; the number of counts that changed."""
        since, until = self.table.tag("version"), self.source.versions()[-1]
        if since == until:
            return 0
        before, after = (self._counted(x) for x in self.source.changes(since, until))
        moved = after.unionByName(before.withColumn("n", -F.col("n"))).groupBy(*self.group, *self.things).agg(F.sum("n").alias("n")).filter("n <> 0")
        keys = self.group + self.things

        def added(old: DataFrame) -> DataFrame:
            return old.unionByName(moved).groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0")

        return self.table.change(moved, added, ("version", until))

    def read(self) -> DataFrame:
        """group, n rows and n_things of the version that was refreshed last."""
        return self.table.read().groupBy(*self.group).agg(F.sum("n").alias("n"), F.count("*").alias("n_things"))
