"""Tables that a run changes in proportion to its changes: base and delta files by bucket of key.

A commit writes the rows that a change made new or different, and marks of those that it removed, into delta files of
their buckets; the log's next entry names the files of every bucket. A reader takes one entry: buckets without deltas
are read as they are, in the others the last row of a key counts. Buckets with many deltas are compacted, and only
they. Files that no kept entry names are removed by vacuum().

Rows of one scope (documents, say) share a bucket: `bucket_by` are the columns of the key that scopes are given by, so
that a change of some scopes reads their buckets alone.

One writer at a time holds a lock, a file that ends after LEASE_SECONDS if its owner is gone. The log decides in any
case: an entry's file is made if it isn't there, else the commit fails and nothing has changed.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from docloom.operators.merging import latest, upsert

LEASE_SECONDS, MOST_DELTAS = 3600, 4
_VERSION, _GONE, _BUCKET = "__version", "__gone", "__bucket"


class ConflictError(RuntimeError):
    """Another writer holds the lock, or has committed since this one read."""


class DeltaTable:
    """A table of unique keys below path. buckets: fixed when the table is made."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: Sequence[str], bucket_by: Sequence[str] | None = None, buckets: int = 64) -> DeltaTable:
        """A new table of rows, whose keys must be unique and mustn't be null."""
        table = cls(rows.sparkSession, path)
        if table.exists():
            raise ConflictError(f"{path} is a table already")
        bucket_by = list(bucket_by or keys)
        if not set(bucket_by) <= set(keys):
            raise ValueError("bucket_by must be columns of the key")
        state = {"number": 1, "keys": list(keys), "bucket_by": bucket_by, "buckets": buckets, "schema": rows.schema.json(), "files": {}, "delta": None, "tags": {}}
        folder = table._write(rows.withColumn(_GONE, F.lit(False)), state)
        table._publish(state | {"files": {str(b): [folder] for b in table._written(folder)}})
        return table

    # --- log ----------------------------------------------------------------------------------------------------------

    def _at(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(x.getPath().getName() for x in self._files.listStatus(at)) if self._files.exists(at) else []

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("log") if n.endswith(".json") and not n.startswith(".")]

    def exists(self) -> bool:
        return bool(self.versions())

    def _state(self, version: int | None = None) -> dict:
        stream = self._files.open(self._at(f"log/{version or self.versions()[-1]:010d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _make(self, name: str, body: str) -> None:
        """A file that isn't there yet."""
        try:
            stream = self._files.create(self._at(name), False)
        except Exception as e:
            raise ConflictError(f"{name} is there already") from e
        stream.write(bytearray(body.encode()))
        stream.close()

    def _publish(self, state: dict) -> None:
        self._make(f"log/{state['number']:010d}.json", json.dumps(state))

    @contextmanager
    def lock(self, lease: float = LEASE_SECONDS) -> Iterator[None]:
        """One writer at a time; a lock older than its lease is taken over."""
        if "lock" in self._names("."):
            age = time.time() - self._files.getFileStatus(self._at("lock")).getModificationTime() / 1000
            if age <= lease:
                raise ConflictError(f"another writer has held the lock for {age:.0f} s")
            self._files.delete(self._at("lock"), False)
        self._make("lock", uuid.uuid4().hex)
        try:
            yield
        finally:
            self._files.delete(self._at("lock"), False)

    # --- files --------------------------------------------------------------------------------------------------------

    @staticmethod
    def _bucket(state: dict) -> Column:
        return F.pmod(F.xxhash64(*(F.col(c) for c in state["bucket_by"])), F.lit(state["buckets"])).cast("int")

    def _write(self, rows: DataFrame, state: dict) -> str:
        folder = f"files/{state['number']:010d}-{uuid.uuid4().hex[:8]}"
        out = rows.withColumns({_VERSION: F.lit(state["number"]).cast("bigint"), _BUCKET: self._bucket(state)})
        out.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).option("compression", "zstd").parquet(f"{self.path}/{folder}")
        return folder

    def _written(self, folder: str) -> list[int]:
        return [int(n.split("=")[1]) for n in self._names(folder) if n.startswith(f"{_BUCKET}=")]

    def _load(self, state: dict, folders: Sequence[tuple[str, int]]) -> DataFrame:
        schema = StructType.fromJson(json.loads(state["schema"])).add(_GONE, BooleanType()).add(_VERSION, LongType())
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{folder}/{_BUCKET}={b}" for folder, b in folders))

    def _rows(self, state: dict, only: Sequence[int] | None = None) -> DataFrame:
        keys = state["keys"]
        columns = StructType.fromJson(json.loads(state["schema"])).names
        own = {int(b): folders for b, folders in state["files"].items() if only is None or int(b) in set(only)}
        out = [self._load(state, [(f[0], b) for b, f in own.items() if len(f) == 1]).filter(~F.col(_GONE)).select(*columns)]
        changed = {b: f for b, f in own.items() if len(f) > 1}
        if changed:
            deltas = self._load(state, [(x, b) for b, f in changed.items() for x in f[1:]])
            last = deltas.groupBy(*keys).agg(F.max_by(F.struct(*deltas.columns), _VERSION).alias("r")).select("r.*")
            base = self._load(state, [(f[0], b) for b, f in changed.items()])
            out += [base.filter(~F.col(_GONE)).join(last.select(*keys), keys, "left_anti").select(*columns), last.filter(~F.col(_GONE)).select(*columns)]
        return reduce(DataFrame.unionByName, out)

    def read(self, version: int | None = None) -> DataFrame:
        """The current rows, or those of an earlier version that vacuum() has left."""
        return self._rows(self._state(version))

    # --- changes ------------------------------------------------------------------------------------------------------

    def tag(self, name: str) -> int | None:
        """The number that the last commit tagged with a name had; none without one."""
        return self._state()["tags"].get(name)

    def change(self, scope: DataFrame, f: Callable[[DataFrame], DataFrame], tag: tuple[str, int] | None = None) -> int:
        """Replace the rows of a scope by f(those rows); the number of rows written, marks of removal included.

        scope has the columns of bucket_by. f gets every row whose values of these are in
        scope, and gives the rows that shall stand there; what it leaves as it was isn't
        written. f may give rows of such scopes only. tag: a name and a number that is
        recorded with the commit; a change whose number isn't above the name's last is one
        that was made before, and does nothing.
        """
        with self.lock():
            state = self._state()
            if tag and state["tags"].get(tag[0], -1) >= tag[1]:
                return 0
            keys, by = state["keys"], state["bucket_by"]
            scope = scope.select(*by).distinct()
            touched = [r[0] for r in scope.select(self._bucket(state)).distinct().collect()]
            old = self._rows(state, touched).join(scope, by, "left_semi")
            columns = old.columns
            new = f(old).select(*columns)
            sides = old.select(*keys, F.struct(*columns).alias("o")).join(new.select(*keys, F.struct(*columns).alias("n")), keys, "full_outer")
            gone = F.col("n").isNull()
            differ = sides.filter(gone | ~F.col("o").eqNullSafe(F.col("n")))
            delta = differ.select(*(F.col(c) if c in keys else F.when(gone, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in columns), gone.alias(_GONE))
            after = state | {"number": state["number"] + 1, "tags": state["tags"] | (dict([tag]) if tag else {})}
            folder = self._write(delta, after)
            written = self._written(folder)
            if not written:
                self._files.delete(self._at(folder), True)
                if tag:
                    self._publish(after | {"delta": None})
                return 0
            if not set(written) <= set(touched):
                self._files.delete(self._at(folder), True)
                raise ValueError("the change gave rows outside its scope")
            n = self._load(after, [(folder, b) for b in written]).count()
            files = dict(state["files"])
            for b in written:
                files[str(b)] = [*files.get(str(b), []), folder]
            self._publish(after | {"files": files, "delta": folder})
            full = [int(b) for b, own in files.items() if len(own) > MOST_DELTAS + 1]
            if full:
                self._compact(full)
            return n

    def upsert(self, new: DataFrame, combine: dict | None = None, order: Sequence[str] | None = None, tag: tuple[str, int] | None = None) -> int:
        """merging.upsert() with the rows of new's keys."""
        keys = self._state()["keys"]
        touched = new.select(*keys).distinct()
        return self.change(new, lambda old: self._beside(old, touched, keys, lambda own: upsert(own, new, keys, combine, order)), tag)

    def upsert_last(self, new: DataFrame, order: Sequence[str], tag: tuple[str, int] | None = None) -> int:
        """Of the old row and the new ones of a key, the last by order stays (see merging.latest()), in whatever order they come."""
        keys = self._state()["keys"]
        touched = new.select(*keys).distinct()
        return self.change(new, lambda old: self._beside(old, touched, keys, lambda own: latest(own.unionByName(new.select(*own.columns)), keys, order)), tag)

    def delete(self, scope: DataFrame) -> int:
        """Remove the rows with these keys."""
        keys = self._state()["keys"]
        return self.change(scope, lambda old: old.join(scope.select(*keys).distinct(), keys, "left_anti"))

    @staticmethod
    def _beside(old: DataFrame, touched: DataFrame, keys: Sequence[str], f: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """f of the rows with touched keys, and the others as they are."""
        changed = f(old.join(touched, list(keys), "left_semi"))
        return old.join(touched, list(keys), "left_anti").unionByName(changed.select(*old.columns))

    def changes(self, since: int, until: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(rows as they were, rows as they are) of the keys that commits after a version wrote, up to another.

        Reads the deltas of these commits, and of the two versions the buckets they touched.
        """
        end = self._state(until)
        start = self._state(since)
        deltas = [(s["delta"], b) for v in range(since + 1, end["number"] + 1) if (s := self._state(v))["delta"] for b in self._written(s["delta"])]
        keys = self._load(end, deltas).select(*end["keys"]).distinct()
        touched = sorted({b for _, b in deltas})
        return tuple(self._rows(s, touched).join(keys, end["keys"], "left_semi") for s in (start, end))

    # --- upkeep -------------------------------------------------------------------------------------------------------

    def _compact(self, buckets: Sequence[int]) -> None:
        state = self._state()
        after = state | {"number": state["number"] + 1}
        folder = self._write(self._rows(state, buckets).withColumn(_GONE, F.lit(False)), after)
        written = set(self._written(folder))
        files = {b: own for b, own in state["files"].items() if int(b) not in set(buckets)}
        self._publish(after | {"files": files | {str(b): [folder] for b in written}, "delta": None})

    def compact(self, most_deltas: int = 0) -> int:
        """Make one file set of each bucket with more deltas than most_deltas; the number of such buckets."""
        with self.lock():
            full = [int(b) for b, own in self._state()["files"].items() if len(own) > most_deltas + 1]
            if full:
                self._compact(full)
            return len(full)

    def vacuum(self, keep: int = 2) -> int:
        """Remove log entries but the last keep, and the files that none of these names; the number of folders removed.

        Readers of removed versions fail: keep as many as the longest query needs.
        """
        if keep < 1:
            raise ValueError("at least one version must be kept")
        with self.lock():
            versions = self.versions()
            used = {f for v in versions[-keep:] for own in self._state(v)["files"].values() for f in own}
            for v in versions[:-keep]:
                self._files.delete(self._at(f"log/{v:010d}.json"), False)
            unused = [n for n in self._names("files") if f"files/{n}" not in used]
            for n in unused:
                self._files.delete(self._at(f"files/{n}"), True)
            return len(unused)
