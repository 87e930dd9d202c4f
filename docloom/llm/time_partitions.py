"""Time partitions that follow the rows: sparse years share a file, busy months, days and hours are split; external merge.

A layout comes from counts of rows by hour. Years between the first and the last moment are siblings; one of more than
leaf_rows rows is split into all its months, these into days, these into hours. In time order, siblings that fit are put
together while their sum fits. A leaf is a run of siblings with rows, an hour that doesn't fit, or all null moments.

Rows are brought into place by an external merge. A map task sorts its input by moment and order columns, which is by
leaf as leaves are spans of time, and spills it as one Parquet run whose row groups end with their leaves, with the
counts of each. Where a leaf has more than FAN slices, tasks merge groups of them into longer runs first. Then each file
has a task: it seeks the split points of its part (merge path: a binary search over all slices, which reads single row
groups), and merges just its part's slices by a heap of their blocks, holding one row group of each.

Writing a folder again moves only what has changed: a leaf whose rows, by count and by 60-bit sums of their hashes, are
those of a leaf of the same name before keeps its files, and so does a part whose rows recur. A task writes files of
names of its own, and a file counts when the table of files names it: lost executors leave stray files, which go at the
end with the files replaced. Readers have to wait for that end. Workers open the folder through Arrow's file systems
(local or mounted paths, hdfs, s3, gs).

Defined cases: null moments are leaf `null`, null order columns come first, rows that are equal in moment and order
columns follow by their hash, repeated rows are rows; years before 0 or beyond 9999 are written as they are. An empty
table leaves an empty folder and no rows. Order columns are whole numbers, dates or timestamps. All columns are kept,
whatever their names (but for the `_docloom_` ones), also null, empty or long ones; of a column of maps no hash is
possible, which is Spark's error.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom._ship import ensure_importable
from docloom.llm.memory import trim
from docloom.llm.workspace import Workspace
from docloom.sources.archives import opened

#: Most slices that one task merges; rows and bytes of a row group of a run, and of a file; input rows of a task that writes several files.
FAN, GROUP_ROWS, GROUP_BYTES, FILE_GROUP_ROWS, FILE_GROUP_BYTES, TASK_ROWS = 64, 4096, 1 << 20, 1 << 16, 32 << 20, 200_000
MOMENT, HASH, NEW = "_docloom_moment", "_docloom_hash", "_docloom_new"
#: Pieces of a row's hash whose sums tell whether a leaf's or a part's rows recur.
PIECES = ("sum_a", "sum_b", "sum_c")
SLICES = "leaf int, run string, first_group int, n_groups int, n bigint"
FILES = "leaf string, part bigint, n_rows bigint, n_new bigint, columns string, ids_sha256 string, path string, sum_a bigint, sum_b bigint, sum_c bigint"


@dataclass(frozen=True)
class Leaf:
    """members: numbers yyyy, yyyymm, yyyymmdd or yyyymmddhh of the siblings that have rows; none for null moments."""

    name: str
    start: int
    n: int
    sums: tuple[int, ...]
    level: int = 0
    members: tuple[int, ...] = ()


@dataclass(frozen=True)
class Written:
    """What a folder holds. files: a row for each file, as FILES says, with rewritten."""

    folder: str
    leaf_rows: int
    leaves: tuple[Leaf, ...]
    files: DataFrame


# --- layout -----------------------------------------------------------------------------------------------------------


def _numbers(moment: Column) -> list[Column]:
    year = F.year(moment).cast("bigint")
    month = year * 100 + F.month(moment)
    day = month * 100 + F.dayofmonth(moment)
    return [year, month, day, day * 100 + F.hour(moment)]


def _days(month: int) -> int:
    m = np.datetime64((month // 100 - 1970) * 12 + month % 100 - 1, "M")
    return int(((m + 1).astype("datetime64[D]") - m.astype("datetime64[D]")).astype(int))


def _start(number: int, level: int) -> int:
    """Microseconds since 1970 of a year, month, day or hour."""
    parts = []
    for _ in range(level - 1):
        parts.append(number % 100)
        number //= 100
    month, day, hour = (*reversed(parts), *(1, 1, 0)[len(parts) :])
    days = np.datetime64((number - 1970) * 12 + month - 1, "M").astype("datetime64[D]").astype(int) + day - 1
    return (int(days) * 24 + hour) * 3_600_000_000


def _name(number: int, level: int, first: int, last: int) -> str:
    """number: the parent's; first and last: the members' own."""
    above = []
    for _ in range(max(0, level - 2)):
        above.append(f"{number % 100:02d}")
        number //= 100
    if level > 1:
        above.append(f"{number:04d}")
    return "/".join([*reversed(above), f"{first:0{4 if level == 1 else 2}d}-{last:0{4 if level == 1 else 2}d}"])


def plan(hours: DataFrame, leaf_rows: int) -> list[Leaf]:
    """The leaves of counts by hour (k1 to k4, n, sums), in time order, null moments first.

    The driver gets the years, and the children of nodes of more than leaf_rows rows, of which a level has fewer than
    all rows by leaf_rows.
    """
    sums = [F.sum(c).alias(c) for c in ("n", *PIECES)]
    leaves = []
    none = hours.filter(F.col("k1").isNull()).agg(*sums).first()
    if none.n:
        leaves.append(Leaf("null", -(1 << 63), none.n, tuple(none[c] for c in PIECES)))
    known, big = hours.filter(F.col("k1").isNotNull()), None
    for level in (1, 2, 3, 4):
        chosen = known if big is None else known.filter(F.col(f"k{level - 1}").isin(big))
        found = {r[0]: (r.n, tuple(r[c] for c in PIECES)) for r in chosen.groupBy(f"k{level}").agg(*sums).collect()}
        if not found:
            break
        if level == 1:
            siblings = {0: range(min(found), max(found) + 1)}
        else:
            siblings = {p: range(p * 100 + (level < 4), p * 100 + (12 + 1, _days(p) + 1 if level == 3 else 0, 24)[level - 2]) for p in sorted(big)}
        big = []
        for parent, members in siblings.items():
            run: list[int] = []
            total = 0

            def close(run: list[int], parent: int = parent, level: int = level) -> None:
                with_rows = [m for m in run if m in found]
                if with_rows:
                    own = (lambda m: m) if level == 1 else (lambda m: m % 100)
                    leaves.append(Leaf(_name(parent, level, own(run[0]), own(run[-1])), _start(run[0], level), sum(found[m][0] for m in with_rows), tuple(map(sum, zip(*(found[m][1] for m in with_rows), strict=True))), level, tuple(with_rows)))

            for m in members:
                n = found[m][0] if m in found else 0
                if n > leaf_rows or not run or total + n > leaf_rows:
                    close(run)
                    run, total = [], 0
                if n > leaf_rows and level < 4:
                    big.append(m)
                else:
                    run.append(m)
                    total += n
            close(run)
        if not big:
            break
    return sorted(leaves, key=lambda x: x.start)


def _in_leaves(moment: Column, leaves: list[Leaf]) -> Column:
    test = moment.isNull() if any(not x.level for x in leaves) else F.lit(False)
    for level, number in enumerate(_numbers(moment), 1):
        members = [m for x in leaves if x.level == level for m in x.members]
        if members:
            test = test | F.coalesce(number.isin(members), F.lit(False))
    return test


# --- runs -------------------------------------------------------------------------------------------------------------


def _keys(rows: pa.RecordBatch | pa.Table, order: Sequence[str]) -> np.ndarray:
    """Of each row, bytes that compare as moment, order columns and hash do; nulls first."""
    parts = []
    for name in (MOMENT, *order, HASH):
        col = rows.column(name)
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        col = col.cast(pa.int32()) if pa.types.is_date32(col.type) else col
        values = pc.fill_null(col.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
        parts += [col.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)[:, None], (values.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)]
    joined = np.ascontiguousarray(np.concatenate(parts, axis=1))
    return joined.view(f"S{joined.shape[1]}").ravel()


class _Writer:
    """One Parquet file; a row group ends where its caller says, or at rows or bytes."""

    def __init__(self, uri: str, schema: pa.Schema, rows: int, size: int) -> None:
        files, path = opened(uri)
        self.writer = pq.ParquetWriter(path, schema, filesystem=files, compression="zstd")
        self.limits, self.schema = (rows, size), schema
        self.held: list[pa.Table] = []
        self.rows = self.size = self.groups = 0

    def add(self, rows: pa.Table) -> None:
        step = max(1, min(self.limits[0], self.limits[1] * max(1, len(rows)) // max(1, rows.nbytes)))
        for at in range(0, len(rows), step):
            piece = rows.slice(at, step)
            if self.held and (self.rows + len(piece) > self.limits[0] or self.size + piece.nbytes > self.limits[1]):
                self.end_group()
            self.held.append(piece)
            self.rows, self.size = self.rows + len(piece), self.size + piece.nbytes

    def end_group(self) -> None:
        if self.held:
            self.writer.write_table(pa.concat_tables(self.held), row_group_size=self.rows)
            self.groups += 1
        self.held, self.rows, self.size = [], 0, 0

    def close(self) -> None:
        self.end_group()
        self.writer.close()


def _slice_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = {"leaf": pa.int32(), "run": pa.string(), "first_group": pa.int32(), "n_groups": pa.int32(), "n": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types.values(), strict=True)], list(types))


def _spill(batches: Iterator[pa.RecordBatch], folder: str, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's sorted rows as one run; the slice of each leaf. starts: of all leaves."""
    uri, writer, out = f"{folder}/{uuid.uuid4().hex}.parquet", None, []
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch])
        writer = writer or _Writer(uri, rows.schema, GROUP_ROWS, GROUP_BYTES)
        moments = pc.fill_null(batch.column(MOMENT).cast(pa.int64()), -(1 << 63)).to_numpy(zero_copy_only=False)
        leaves = np.searchsorted(starts, moments, side="right") - 1
        cuts = [0, *(np.flatnonzero(np.diff(leaves)) + 1).tolist(), len(leaves)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            leaf = int(leaves[a])
            if not out or out[-1][0] != leaf:
                writer.end_group()
                if out:
                    out[-1][3] = writer.groups - out[-1][2]
                out.append([leaf, uri, writer.groups, 0, 0])
            writer.add(rows.slice(a, b - a))
            out[-1][4] += b - a
    if writer:
        writer.close()
        out[-1][3] = writer.groups - out[-1][2]
        yield _slice_rows(out)
    trim()


class Slice:
    """A leaf's sorted rows in one run."""

    def __init__(self, file: pq.ParquetFile, first_group: int, n_groups: int, order: Sequence[str]) -> None:
        self.file, self.first, self.order = file, first_group, order
        self.ends = np.cumsum([file.metadata.row_group(g).num_rows for g in range(first_group, first_group + n_groups)])
        self.known: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return int(self.ends[-1])

    def group_keys(self, g: int) -> np.ndarray:
        if g not in self.known:
            while len(self.known) >= 4:
                self.known.pop(next(iter(self.known)))
            self.known[g] = _keys(self.file.read_row_group(self.first + g, columns=[MOMENT, *self.order, HASH]), self.order)
        return self.known[g]

    def key(self, i: int) -> bytes:
        g = int(np.searchsorted(self.ends, i, side="right"))
        return self.group_keys(g)[i - (self.ends[g - 1] if g else 0)]

    def before(self, key: bytes, side: str) -> int:
        """The number of rows before key, rows equal to it included if side is right."""
        low, high = 0, len(self.ends)
        while low < high:
            g = (low + high) // 2
            last = self.group_keys(g)[-1]
            if last < key or side == "right" and last == key:
                low = g + 1
            else:
                high = g
        if low == len(self.ends):
            return len(self)
        keys = self.group_keys(low)
        return int(self.ends[low - 1] if low else 0) + int(np.searchsorted(keys, np.array([key], dtype=keys.dtype), side=side)[0])

    def blocks(self, low: int, high: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
        """Rows low to high, one row group at a time, with their keys."""
        for g, end in enumerate(self.ends.tolist()):
            begin = end - self.file.metadata.row_group(self.first + g).num_rows
            if max(low, begin) < min(high, end):
                rows = self.file.read_row_group(self.first + g).slice(max(0, low - begin), min(high, end) - max(low, begin))
                yield rows, _keys(rows, self.order)


def split_points(slices: Sequence[Slice], rank: int) -> list[int]:
    """How many rows of each slice are among the first rank rows of all; of equal rows, those of earlier slices come first."""
    low, high = [0] * len(slices), [len(s) for s in slices]
    while sum(low) < rank < sum(high):
        j = max(range(len(slices)), key=lambda i: high[i] - low[i])
        middle = (low[j] + high[j]) // 2
        pivot = slices[j].key(middle)
        at = [middle if i == j else s.before(pivot, "right" if i < j else "left") for i, s in enumerate(slices)]
        if sum(at) < rank:
            low = [max(a, b) for a, b in zip(low, at, strict=True)]
            low[j] = max(low[j], middle + 1)
        else:
            high = [min(a, b) for a, b in zip(high, at, strict=True)]
    return low if sum(low) == rank else high


def merged(slices: Sequence[Slice], low: Sequence[int], high: Sequence[int]) -> Iterator[pa.Table]:
    """The slices' rows between low and high, in order.

    The heap holds the last key of each slice's block: of the least of them, all rows up to it are in memory.
    """
    sources = [s.blocks(a, b) for s, a, b in zip(slices, low, high, strict=True)]
    held: dict[int, tuple[pa.Table, np.ndarray]] = {}
    heap: list[tuple[bytes, int]] = []

    def load(i: int) -> None:
        block = next(sources[i], None)
        if block is None:
            held.pop(i, None)
        else:
            held[i] = block
            heapq.heappush(heap, (block[1][-1], i))

    for i in range(len(sources)):
        load(i)
    while heap:
        last, i = heapq.heappop(heap)
        ready, keys = [], []
        for j, (rows, own) in list(held.items()):
            cut = int(np.searchsorted(own, np.array([last], dtype=own.dtype), side="right")[0])
            if cut:
                ready.append(rows.slice(0, cut))
                keys.append(own[:cut])
                held[j] = rows.slice(cut), own[cut:]
        if len(ready) == 1:
            yield ready[0]
        elif ready:
            yield pa.concat_tables(ready).take(pa.array(np.argsort(np.concatenate(keys), kind="stable")))
        load(i)


def _opened(slices: list[dict], order: Sequence[str]) -> list[Slice]:
    files: dict[str, pq.ParquetFile] = {}
    for s in slices:
        if s["run"] not in files:
            system, path = opened(s["run"])
            files[s["run"]] = pq.ParquetFile(path, filesystem=system)
    return [Slice(files[s["run"]], s["first_group"], s["n_groups"], order) for s in slices]


def _longer_runs(batches: Iterator[pa.RecordBatch], folder: str, order: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            slices, uri = _opened(row["slices"], order), f"{folder}/{uuid.uuid4().hex}.parquet"
            writer = _Writer(uri, slices[0].file.schema_arrow, GROUP_ROWS, GROUP_BYTES)
            for rows in merged(slices, [0] * len(slices), [len(s) for s in slices]):
                writer.add(rows)
            writer.close()
            yield _slice_rows([(row["leaf"], uri, 0, writer.groups, sum(map(len, slices)))])
    trim()


def _write_files(batches: Iterator[pa.RecordBatch], folder: str, order: Sequence[str], id_col: str, leaf_rows: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            slices, uri = _opened(row["slices"], order), f"{folder}/{uuid.uuid4().hex}.parquet"
            schema = slices[0].file.schema_arrow
            own = [f.name for f in schema if f.name not in (MOMENT, HASH, NEW)]
            writer = _Writer(uri, pa.schema([schema.field(c) for c in own]), FILE_GROUP_ROWS, FILE_GROUP_BYTES)
            digest, n, new, sums = hashlib.sha256(), 0, 0, [0, 0, 0]
            total = sum(map(len, slices))
            low, high = (split_points(slices, min(total, p * leaf_rows)) for p in (row["part"] - 1, row["part"]))
            for rows in merged(slices, low, high):
                ids = rows.column(id_col).to_pylist()
                digest.update(("," * bool(n) + ",".join("" if i is None else str(i) for i in ids)).encode())
                n += len(ids)
                new += pc.sum(rows.column(NEW)).as_py() or 0
                hashes = rows.column(HASH).to_numpy()
                sums = [s + int(((hashes >> (20 * k)) & 0xFFFFF).sum()) for k, s in enumerate(sums)]
                writer.add(rows.select(own))
            writer.close()
            values = [names[row["leaf"]], row["part"], n, int(new), ",".join(own), digest.hexdigest(), uri, *sums]
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, types, strict=True)], [c.split()[0] for c in FILES.split(", ")])
    trim()


# --- the operator -----------------------------------------------------------------------------------------------------


def write_partitions(rows: DataFrame, folder: str, *, moment: Column, order: Sequence[str], id_col: str, leaf_rows: int, new: Column | None = None, before: Written | None = None, fan: int = FAN) -> Written:
    """Write rows to a folder in leaves of about leaf_rows rows, each as parts of leaf_rows rows: one Parquet file a part.

    A folder that holds `before` already gets all rows anew, but only files whose rows don't recur are written. new: which
    rows n_new counts; none by default at first, and none but new ones later.
    """
    spark = rows.sparkSession
    ensure_importable(spark)
    ws, listed = Workspace(spark, "time-runs"), Workspace(spark, "time-files")
    own = rows.columns
    nulls = F.concat(*(F.col(f"`{c}`").isNull().cast("int").cast("string") for c in own))
    keyed = rows.select(*(F.col(f"`{c}`") for c in own), moment.cast("timestamp_ntz").alias(MOMENT), F.xxhash64(*(F.col(f"`{c}`") for c in own), nulls).alias(HASH), F.coalesce(new, F.lit(False)).cast("int").alias(NEW) if new is not None else F.lit(0).alias(NEW))
    pieces = [F.sum(F.shiftright(HASH, 20 * k).bitwiseAND(0xFFFFF)).alias(c) for k, c in enumerate(PIECES)]
    hours = keyed.groupBy(*(n.alias(f"k{i}") for i, n in enumerate(_numbers(F.col(MOMENT)), 1))).agg(F.count("*").alias("n"), *pieces)
    leaves = plan(ws.write(hours, "hours"), leaf_rows)
    known = {(x.name, x.n, x.sums) for x in before.leaves} if before and before.leaf_rows == leaf_rows else set()
    stay = [x.name for x in leaves if (x.name, x.n, x.sums) in known]
    moved = [x for x in leaves if (x.name, x.n, x.sums) not in known]
    files = spark.createDataFrame([], FILES)
    if moved:
        starts, names = np.array([x.start for x in leaves], dtype=np.int64), [x.name for x in leaves]
        chosen = keyed.filter(_in_leaves(F.col(MOMENT), moved)) if stay else keyed
        runs = ws.path("runs")
        _folder(spark, runs)
        _folder(spark, folder)
        slices = ws.write(chosen.sortWithinPartitions(MOMENT, *(F.col(f"`{c}`") for c in order), HASH).mapInArrow(lambda b: _spill(b, runs, starts), SLICES), "slices-0")
        as_slice, level = F.struct("run", "first_group", "n_groups"), 0
        while (most := slices.groupBy("leaf").count().agg(F.max("count").alias("n")).first().n or 0) > fan:
            groups = -(-2 * most // fan)
            dealt = slices.withColumn("g", F.pmod(F.xxhash64("run"), F.lit(groups))).groupBy("leaf", "g").agg(F.collect_list(as_slice).alias("slices"))
            level += 1
            slices = ws.write(dealt.repartition(min(groups * len(moved), 20_000), "leaf", "g").mapInArrow(lambda b: _longer_runs(b, runs, order), SLICES), f"slices-{level}")
        n_files, n_rows = sum(-(-x.n // leaf_rows) for x in moved), sum(x.n for x in moved)
        parts = F.explode(F.sequence(F.lit(1), F.ceil(F.col("n") / leaf_rows).cast("int"))).alias("part")
        todo = slices.groupBy("leaf").agg(F.sum("n").alias("n"), F.collect_list(as_slice).alias("slices")).select("leaf", parts, "slices")
        tasks = min(n_files, max(4 * spark.sparkContext.defaultParallelism, n_rows // TASK_ROWS))
        files = listed.write(todo.repartition(max(1, tasks), "leaf", "part").mapInArrow(lambda b: _write_files(b, folder, order, id_col, leaf_rows, names), FILES), "written")
    else:
        _folder(spark, folder)
    files = files.withColumn("rewritten", F.lit(True))
    if before:
        old = before.files.drop("rewritten", "n_new")
        recur = old.select("leaf", "part", F.col("n_rows").alias("o_rows"), *(F.col(c).alias(f"o_{c}") for c in PIECES), F.col("path").alias("o_path"), F.col("ids_sha256").alias("o_ids"))
        same = (F.col("n_rows") == F.col("o_rows")) & (F.col("ids_sha256") == F.col("o_ids"))
        for c in PIECES:
            same = same & (F.col(c) == F.col(f"o_{c}"))
        same = F.coalesce(same, F.lit(False))
        judged = files.join(recur, ["leaf", "part"], "left").withColumns({"path": F.when(same, F.col("o_path")).otherwise(F.col("path")), "rewritten": ~same}).select(*files.columns)
        kept = old.filter(F.col("leaf").isin(stay)).withColumns({"n_new": F.lit(0).cast("bigint"), "rewritten": F.lit(False)}).select(*files.columns)
        files = judged.unionByName(kept)
    files = listed.write(files.coalesce(8), "files")
    _remove_others(spark, folder, {r.path for r in files.select("path").collect()})
    ws.drop()
    return Written(folder, leaf_rows, tuple(leaves), files)


def _hadoop(spark, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _folder(spark, uri: str) -> None:
    files, path = _hadoop(spark, uri)
    files.mkdirs(path)


def _remove_others(spark, folder: str, keep: set[str]) -> None:
    names = {p.rsplit("/", 1)[-1] for p in keep}
    files, path = _hadoop(spark, folder)
    for status in files.listStatus(path):
        if status.getPath().getName() not in names:
            files.delete(status.getPath(), True)
