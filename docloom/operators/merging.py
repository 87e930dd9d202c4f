"""Changing tables that are immutable files: joins of the old snapshot with new rows.

MERGE and UPDATE don't exist for Parquet tables; each function gives the new snapshot as a
DataFrame, and SnapshotTable writes it beside the old one before it becomes current.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _sides(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    a = old.select(*keys, F.struct(*old.columns).alias("old"))
    b = new.select(*keys, F.struct(*new.columns).alias("new"))
    return a.join(b, list(keys), "full_outer")


def latest(new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the last by order, as if rows were written one after another.

    The row with the greatest order columns wins; a maximum of structs combines copies
    before the shuffle, so that a key with many rows is one row a task. Columns that can't
    be compared (maps) may not be part of the table.
    """
    rest = [c for c in new.columns if c not in keys and c not in order]
    best = new.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__best"))
    return best.select(*(F.col(c) if c in keys else F.col(f"__best.{c}") for c in new.columns))


def unique(new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """new, or an error in place of the rows of a key that it has more than once."""
    rest = [c for c in new.columns if c not in keys]
    if not rest:
        return new.distinct()
    one = new.groupBy(*keys).agg(F.count("*").alias("__n"), F.any_value(F.struct(*rest)).alias("__row"))
    checked = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("a key of new rows is repeated: "), F.to_json(F.struct(*keys))))).otherwise(F.col("__row"))
    return one.select(*keys, checked.alias("__row")).select(*(F.col(c) if c in keys else F.col(f"__row.{c}") for c in new.columns))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], combine: dict[str, Callable[[Column, Column], Column]] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """Rows of both; a key on both sides takes the new values, or combine[column](old, new).

    Keys must be unique in new, a repeated one is an error when the rows are made; unless
    order is given: then the last row of each key by these columns of new counts (see
    latest). order may name columns that old lacks.
    """
    combine = combine or {}
    new = latest(new, keys, order).select(*old.columns) if order else unique(new, keys)

    def value(c: str) -> Column:
        both = combine[c](F.col(f"old.{c}"), F.col(f"new.{c}")) if c in combine else F.col(f"new.{c}")
        return F.when(F.col("old").isNull(), F.col(f"new.{c}")).when(F.col("new").isNull(), F.col(f"old.{c}")).otherwise(both).alias(c)

    return _sides(old, new, keys).select(*(F.col(c) if c in keys else value(c) for c in old.columns))


def accumulate(old: Column, new: Column) -> Column:
    return F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0))


def keep_if_null(old: Column, new: Column) -> Column:
    return F.coalesce(new, old)


def guarded_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], guarded: Callable[[str], Column]) -> DataFrame:
    """upsert(), but a guarded old row gives way to a guarded new row only. guarded takes 'old' or 'new'."""
    take_new = ~F.coalesce(guarded("old"), F.lit(False)) | F.coalesce(guarded("new"), F.lit(False))

    def value(c: str) -> Column:
        return F.when(F.col("old").isNull(), F.col(f"new.{c}")).when(F.col("new").isNull(), F.col(f"old.{c}")).when(take_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)

    return _sides(old, new, keys).select(*(F.col(c) if c in keys else value(c) for c in old.columns))


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old, and the new rows whose key it lacks."""
    return old.unionByName(new.select(*old.columns).join(old.select(*keys), list(keys), "left_anti"))


def scoped_delete(old: DataFrame, scope: DataFrame, keys: Sequence[str]) -> DataFrame:
    return old.join(scope.select(*keys).distinct(), list(keys), "left_anti")


def join_update(old: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old with the columns of values where a key matches; columns that old lacks are added."""
    fresh = [c for c in values.columns if c not in keys]
    v = values.select(*keys, F.lit(True).alias("__hit"), *(F.col(c).alias(f"__{c}") for c in fresh))
    joined = old.join(v, list(keys), "left")
    own = [F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c) for c in old.columns]
    return joined.select(*own, *(F.col(f"__{c}").alias(c) for c in fresh if c not in old.columns))


def scd2_merge(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str, run_ts: Column, scope: Column | None = None) -> DataFrame:
    """History with is_current, first_seen_at, last_seen_at and retired_at.

    A key in new is current and keeps its first_seen_at, whether it was retired or not; a
    current key in scope that new lacks is retired at run_ts; all else stays. change_type
    tells what happened: new, same, changed, retired or kept.
    """
    s = _sides(old, new.select(*keys, value), keys)
    in_scope = (scope if scope is not None else F.lit(True)) & F.col("old.is_current")
    came, gone = F.col("new").isNotNull(), F.col("new").isNull() & F.coalesce(in_scope, F.lit(False))
    return s.select(
        *keys,
        F.when(came, F.col(f"new.{value}")).otherwise(F.col(f"old.{value}")).alias(value),
        F.when(came, True).when(gone, False).otherwise(F.col("old.is_current")).alias("is_current"),
        F.coalesce("old.first_seen_at", run_ts).alias("first_seen_at"),
        F.when(came, run_ts).otherwise(F.col("old.last_seen_at")).alias("last_seen_at"),
        F.when(came, F.lit(None)).when(gone, run_ts).otherwise(F.col("old.retired_at")).alias("retired_at"),
        F.when(F.col("old").isNull(), "new").when(came & F.col(f"old.{value}").eqNullSafe(F.col(f"new.{value}")), "same").when(came, "changed").when(gone, "retired").otherwise("kept").alias("change_type"),
    )


def run_key(*parts: Column) -> Column:
    """A run's id from what it is a run of: the same on every attempt, so that facts can point to a row not yet written."""
    return F.sha2(F.concat_ws("\n", *parts), 256)


def upsert_runs(old: DataFrame, new: DataFrame, facts: DataFrame, keys: Sequence[str] = ("analysis_hash", "model")) -> tuple[DataFrame, DataFrame]:
    """Runs merged by keys with their run_id, and facts (which have the keys) with the run_id of their run.

    Facts of a run that new replaces are to be deleted by the same ids (scoped_delete).
    """
    named = new.withColumn("run_id", run_key(*(F.col(k) for k in keys)))
    return upsert(old, named.select(*old.columns), keys), facts.join(named.select(*keys, "run_id"), list(keys))


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """ADD COLUMN IF NOT EXISTS."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


class SnapshotTable:
    """Versions of a table as folders; a one-row pointer names the current one.

    A writer makes a whole new folder and then a pointer of a higher number: readers see
    the old or the new snapshot, and a failed write leaves the old one.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def exists(self) -> bool:
        files, path = self._fs(f"{self.path}/pointers")
        return bool(files.exists(path))

    def _current(self):
        return self.spark.read.parquet(f"{self.path}/pointers/*").orderBy(F.desc("number")).first()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self._current().folder}")

    def write(self, df: DataFrame) -> None:
        number = self._current().number + 1 if self.exists() else 1
        folder = f"v-{number:08d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.path}/{folder}")
        self.spark.createDataFrame([(number, folder)], "number long, folder string").coalesce(1).write.parquet(f"{self.path}/pointers/{number:08d}")

    def truncate(self) -> None:
        self.write(self.read().limit(0))

    def drop(self) -> None:
        files, path = self._fs(self.path)
        files.delete(path, True)


def dump(tables: dict[str, SnapshotTable], target: str, stamp: str) -> list[str]:
    """Copy the current snapshot of each table that exists to target/name_stamp, compressed; the folders written."""
    out = []
    for name, table in tables.items():
        if table.exists():
            table.read().write.option("compression", "zstd").parquet(f"{target.rstrip('/')}/{name}_{stamp}")
            out.append(f"{name}_{stamp}")
    return out


def reset(tables: dict[str, SnapshotTable], published: Sequence[str] = (), *, include_published: bool = False, execute: bool = False) -> list[tuple[str, int]]:
    """Names and row counts of the tables that are (or, without execute, would be) emptied; missing ones are skipped."""
    chosen = [n for n in tables if (include_published or n not in published) and tables[n].exists()]
    out = [(n, tables[n].read().count()) for n in chosen]
    if execute:
        for n in chosen:
            tables[n].truncate()
    return out
