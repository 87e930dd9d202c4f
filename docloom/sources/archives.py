"""ZIP archives by entry: the directory gives a byte range for each member, and tasks inflate ranges side by side.

An archive is never read as a whole where workers can open its store (Arrow's file systems: local or mounted paths,
hdfs, s3, gs). One task reads its directory and makes a row a member; members are dealt out by the place of their bytes,
about RANGE_BYTES of an archive a group, so that one archive spreads over all cores. A member that is damaged,
encrypted, packed by an unknown method or larger than MOST_BYTES is a row with an error, as an archive without a
readable directory is; the others are read. Archives within archives are opened up to DEPTH deep, path!inner!member.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom._ship import ensure_importable

RANGE_BYTES, MOST_BYTES, DEPTH, ROWS = 8 << 20, 1 << 30, 3, 1000
#: Directories that a task reads where there are many archives: the driver keeps figures of each task.
TASK_ARCHIVES = 50
MEMBER_SCHEMA = "archive string, name string, start bigint, packed bigint, size bigint, method int, crc bigint, encrypted boolean, error string"
FILE_SCHEMA = "path string, content binary, error string"
_LOCAL = struct.Struct("<4s5H3I2H")
#: What a damaged archive or member raises in its readers.
_BROKEN = (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError, ValueError, EOFError, zlib.error, struct.error)


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path within."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def by_ranges(uri: str) -> bool:
    """Whether Arrow opens the store of a path, so that workers can read ranges of its files."""
    try:
        opened(uri)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def _rows(columns: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], columns)


_MEMBER_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.string()]
_FILE_TYPES = [pa.string(), pa.binary(), pa.string()]


def _is_archive(name: str) -> bool:
    return name.lower().endswith(".zip")


class _File:
    """An Arrow file that refuses a place before its start as zipfile expects, by OSError."""

    def __init__(self, f: pa.NativeFile) -> None:
        self.f, self.read, self.tell = f, f.read, f.tell

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        place = offset + (0, self.f.tell(), self.f.size())[whence]
        if place < 0:
            raise OSError("a place before the start")
        return self.f.seek(place)


def _directory(suffix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [c.split()[0] for c in MEMBER_SCHEMA.split(", ")]
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                out: list[tuple] = []
                try:
                    files, path = opened(archive)
                    with files.open_input_file(path) as f, zipfile.ZipFile(_File(f)) as z:
                        for m in z.infolist():
                            if not m.is_dir() and (m.filename.lower().endswith(suffix) or _is_archive(m.filename)):
                                out.append((archive, m.filename, m.header_offset, m.compress_size, m.file_size, m.compress_type, m.CRC, bool(m.flag_bits & 1), None))
                            if len(out) >= ROWS:
                                yield _rows(columns, _MEMBER_TYPES, out)
                                out = []
                except _BROKEN as e:
                    out.append((archive, None, None, 0, None, None, None, None, f"{type(e).__name__}: {e}"))
                if out:
                    yield _rows(columns, _MEMBER_TYPES, out)

    return run


def unpacked(packed: bytes, method: int, size: int, crc: int) -> bytes:
    """A member's bytes; stored and deflated ones only, as a size and a sum that must agree say."""
    if method == zipfile.ZIP_DEFLATED:
        reader = zlib.decompressobj(-15)
        data = reader.decompress(packed, size + 1)
        if not reader.eof:
            raise zipfile.BadZipFile("the packed data don't end where the directory says")
    elif method == zipfile.ZIP_STORED:
        data = packed
    else:
        raise NotImplementedError(f"packing method {method}")
    if len(data) != size or zlib.crc32(data) != crc:
        raise zipfile.BadZipFile("size or checksum differs from the directory's")
    return data


def _range(f, start: int, packed: int) -> bytes:
    """The packed bytes of a member, whose local header stands at start."""
    f.seek(start)
    head = f.read(_LOCAL.size)
    if len(head) < _LOCAL.size or not head.startswith(b"PK\x03\x04"):
        raise zipfile.BadZipFile("no local header where the directory says")
    name, extra = _LOCAL.unpack(head)[-2:]
    f.seek(start + _LOCAL.size + name + extra)
    body = f.read(packed)
    if len(body) < packed:
        raise zipfile.BadZipFile("the archive ends within the member")
    return body


def _inner(path: str, content: bytes, suffix: str, depth: int) -> Iterator[tuple[str, bytes | None, str | None]]:
    """Members of an archive held in memory, each with its own error."""
    try:
        z = zipfile.ZipFile(io.BytesIO(content))
    except _BROKEN as e:
        yield path, None, f"{type(e).__name__}: {e}"
        return
    with z:
        for m in z.infolist():
            own = f"{path}!{m.filename}"
            if m.is_dir() or not (m.filename.lower().endswith(suffix) or _is_archive(m.filename)):
                continue
            try:
                if m.file_size > MOST_BYTES:
                    raise ValueError(f"{m.file_size} bytes, at most {MOST_BYTES}")
                data = z.read(m)
            except _BROKEN as e:
                yield own, None, f"{type(e).__name__}: {e}"
                continue
            yield from _told(own, data, m.filename, suffix, depth)


def _told(path: str, data: bytes, name: str, suffix: str, depth: int) -> Iterator[tuple[str, bytes | None, str | None]]:
    if not _is_archive(name):
        yield path, data, None
    elif depth >= DEPTH:
        yield path, None, f"archives more than {DEPTH} deep"
    else:
        yield from _inner(path, data, suffix, depth + 1)


def _members(suffix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, f = None, None
        for batch in batches:
            for m in batch.to_pylist():
                path = m["archive"] if m["name"] is None else f"{m['archive']}!{m['name']}"
                try:
                    if m["error"] is not None:
                        found = [(path, None, m["error"])]
                    elif m["encrypted"]:
                        found = [(path, None, "encrypted")]
                    elif m["size"] > MOST_BYTES or m["packed"] > MOST_BYTES:
                        found = [(path, None, f"{m['size']} bytes, at most {MOST_BYTES}")]
                    else:
                        if m["archive"] != at:
                            files, name = opened(m["archive"])
                            f, at = files.open_input_file(name), m["archive"]
                        data = unpacked(_range(f, m["start"], m["packed"]), m["method"], m["size"], m["crc"])
                        found = _told(path, data, m["name"], suffix, 1)
                    for row in found:
                        yield _rows(["path", "content", "error"], _FILE_TYPES, [row])
                except _BROKEN as e:
                    yield _rows(["path", "content", "error"], _FILE_TYPES, [(path, None, f"{type(e).__name__}: {e}")])

    return run


def _whole(suffix: str):
    """For stores that only Spark opens: archives as Spark reads them, whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                for row in _inner(path.as_py(), content.as_py(), suffix, 1):
                    yield _rows(["path", "content", "error"], _FILE_TYPES, [row])

    return run


def archive_members(spark: SparkSession, path: str, suffix: str = ".xml") -> DataFrame:
    """A row for each member with that suffix and each inner archive of the ZIP files below path: where its bytes are."""
    ensure_importable(spark)
    found = _archives(spark, path).select("path")
    n = found.count()
    tasks = max(1, min(n, max(4 * spark.sparkContext.defaultParallelism, -(-n // TASK_ARCHIVES))))
    return found.repartition(tasks, "path").mapInArrow(_directory(suffix), MEMBER_SCHEMA)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[zZ][iI][pP]").load(path)


def read_archives(spark: SparkSession, path: str, suffix: str = ".xml", ranges: bool | None = None) -> DataFrame:
    """(path, content, error) of the members of all ZIP files below path; nothing is unpacked to disk.

    ranges: read members by their byte ranges; by default wherever Arrow opens the store.
    """
    ensure_importable(spark)
    if not (by_ranges(path) if ranges is None else ranges):
        return _archives(spark, path).select("path", "content").mapInArrow(_whole(suffix), FILE_SCHEMA)
    sizes = _archives(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first().n
    tasks = max(spark.sparkContext.defaultParallelism, -(-sizes // RANGE_BYTES))
    members = archive_members(spark, path, suffix).withColumn("__range", F.coalesce(F.floor(F.col("start") / RANGE_BYTES), F.lit(0)))
    dealt = members.repartition(int(min(tasks, 100_000)), "archive", "__range").sortWithinPartitions("archive", "start").drop("__range")
    return dealt.mapInArrow(_members(suffix), FILE_SCHEMA)
