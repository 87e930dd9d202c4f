"""Tables written to the folder that the cluster shares, to cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession

_OWN: dict[str, str] = {}


#: Spark then deletes a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where that is unset, a temporary folder in local mode and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        base = _OWN.setdefault(app, "") or tempfile.mkdtemp(prefix="docloom-shared-")
        _OWN[app] = base
    return base.rstrip("/")


_LOCK = threading.Lock()
#: Of each session, how many writes are under way and what the setting was before the first of them.
_WRITES: dict[int, tuple[int, str | None]] = {}


@contextmanager
def shuffles_end_with_query(spark: SparkSession) -> Iterator[None]:
    """The setting is the session's: of writes in several threads, the last to end puts it back."""
    own = id(spark)
    with _LOCK:
        n, before = _WRITES.get(own, (0, None))
        if not n:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _WRITES[own] = n + 1, before
    try:
        yield
    finally:
        with _LOCK:
            n, before = _WRITES.pop(own)
            if n > 1:
                _WRITES[own] = n - 1, before
            else:
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


#: The innermost list that gathers workspaces; each thread has its own.
_SCOPE: ContextVar[list[Workspace] | None] = ContextVar("docloom-scope", default=None)


@contextmanager
def gathered() -> Iterator[list[Workspace]]:
    """The workspaces that are opened within, but for those of an inner scratch()."""
    own: list[Workspace] = []
    token = _SCOPE.set(own)
    try:
        yield own
    finally:
        _SCOPE.reset(token)


@contextmanager
def scratch() -> Iterator[None]:
    """Folders of operators called within are deleted at its end: their results must have been written by then."""
    with gathered() as own:
        try:
            yield
        finally:
            for ws in own:
                ws.drop()


class Workspace:
    """One operator call's own folder of intermediate tables."""

    def __init__(self, spark: SparkSession, name: str, root: str | None = None) -> None:
        self.spark = spark
        self.named: dict[str, list[str]] = {}
        self.root = root or f"{shared_folder(spark)}/docloom-{name}-{uuid.uuid4().hex}"
        if root is None:
            atexit.register(self._remove)
            if (scope := _SCOPE.get()) is not None:
                scope.append(self)

    def tables(self, folder: str) -> list[str]:
        """Names in a folder of the workspace, sorted; none if there is no such folder."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(folder))
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(x.getPath().getName() for x in files.listStatus(path)) if files.exists(path) else []

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Write and read again: later stages restart from the files, not from the lineage, and shuffles behind them go."""
        schema = df.schema
        with shuffles_end_with_query(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(table))
        return self.spark.read.schema(schema).parquet(self.path(table))

    def half(self, table: str, chosen: bool) -> str:
        return f"{table}/half={str(chosen).lower()}"

    def write_halves(self, df: DataFrame, test: Column, table: str) -> tuple[DataFrame, DataFrame]:
        """write() in one pass, rows for which test holds and the others apart, so that either half can be dropped."""
        with shuffles_end_with_query(self.spark):
            df.withColumn("half", test).write.mode("overwrite").partitionBy("half").option("compression", "zstd").parquet(self.path(table))
        return tuple(self.spark.read.schema(df.schema).parquet(self.path(self.half(table, x))) if self.tables(self.half(table, x)) else self.spark.createDataFrame([], df.schema) for x in (True, False))

    def write_bucketed(self, df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
        """write() for rows that were dealt by repartition(buckets, key): tables of as many buckets are joined without moving either.

        The table stands in the session's catalog under a name of its own until drop().
        """
        name = f"docloom_{uuid.uuid4().hex}"
        with shuffles_end_with_query(self.spark):
            df.write.bucketBy(buckets, key).sortBy(key).option("path", self.path(table)).saveAsTable(name)
        if not self.named:
            atexit.register(self._forget)
        self.named.setdefault(table, []).append(name)
        return self.spark.table(name)

    def _forget(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                for name in (n for names in self.named.values() for n in names):
                    self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # noqa: BLE001  the session may have ended before the interpreter does
            pass

    def drop(self, table: str = "") -> None:
        """Delete a table that nothing reads any more, or the whole folder."""
        for t in [table] if table else list(self.named):
            for name in self.named.pop(t, []):
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(table) if table else self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def move(self, source: str, target: str) -> None:
        """Rename a finished table: it appears whole or not at all."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = lambda x: jvm.org.apache.hadoop.fs.Path(self.path(x))
        files = path(target).getFileSystem(conf)
        files.mkdirs(path(target).getParent())
        if not files.rename(path(source), path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def _remove(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                self.drop()
        except Exception:  # noqa: BLE001  the session may have ended before the interpreter does
            pass
