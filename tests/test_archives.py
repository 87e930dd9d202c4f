"""Archives by entry against a plain unpack; what is damaged is told by entry."""

import io
import random
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from docloom.sources import archives


def plain(folder):
    out = {}
    for p in sorted(folder.rglob("*")):
        if p.suffix.lower() == ".zip":
            with zipfile.ZipFile(p) as z:
                for n in z.namelist():
                    if n.lower().endswith(".xml"):
                        out[f"file:{p}!{n}"] = z.read(n)
    return out


def make(path, n, seed):
    r = random.Random(seed)
    with zipfile.ZipFile(path, "w") as z:
        for i in range(n):
            body = "".join(r.choice("<a>bé\n PK\x03\x04") for _ in range(r.randint(0, 3000))).encode()
            z.writestr(zipfile.ZipInfo(f"d/é{i}.{r.choice(['xml', 'XML', 'txt'])}"), body, compress_type=r.choice([zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED]))


@pytest.mark.parametrize("ranges", [True, False])
def test_equals_a_plain_unpack(spark, tmp_path, ranges):
    (tmp_path / "x").mkdir()
    make(tmp_path / "x" / "one.zip", 300, 1)
    make(tmp_path / "two.ZIP", 20, 2)
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    rows = archives.read_archives(spark, str(tmp_path), ranges=ranges).collect()
    assert [r.error for r in rows if r.error] == []
    got = {r.path: (bytes(r.content), r.error) for r in rows}
    assert {k: v[0] for k, v in got.items()} == plain(tmp_path) and not any(v[1] for v in got.values())


def test_one_archive_spreads_over_tasks(spark, tmp_path, monkeypatch):
    make(tmp_path / "one.zip", 400, 3)
    monkeypatch.setattr(archives, "RANGE_BYTES", 20_000)
    rows = archives.read_archives(spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
    tasks = [r["n"] for r in rows.groupBy("task").agg(F.count("*").alias("n")).collect()]
    assert len(tasks) >= 8 and max(tasks) < 0.5 * sum(tasks)


def test_damaged_members_are_told(spark, tmp_path):
    path = tmp_path / "bad.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name in ("good.xml", "sum.xml", "head.xml", "last.xml"):
            z.writestr(name, name.encode() * 200)
        z.writestr(zipfile.ZipInfo("lzma.xml"), b"x" * 100, compress_type=zipfile.ZIP_LZMA)
    with zipfile.ZipFile(path) as z:
        at = {m.filename: m.header_offset for m in z.infolist()}
    raw = bytearray(path.read_bytes())
    raw[at["sum.xml"] + 30 + len("sum.xml") + 5] ^= 0xFF
    raw[at["head.xml"]] = 0
    directory = raw.rindex(b"PK\x01\x02", 0, raw.rindex(b"last.xml"))
    struct.pack_into("<H", raw, directory + 8, struct.unpack_from("<H", raw, directory + 8)[0] | 1)
    path.write_bytes(raw)
    (tmp_path / "cut.zip").write_bytes(bytes(raw[: len(raw) // 2]))
    got = {r.path.rsplit("/", 1)[-1]: (r.content, r.error) for r in archives.read_archives(spark, str(tmp_path)).collect()}
    assert bytes(got["bad.zip!good.xml"][0]) == b"good.xml" * 200 and got["bad.zip!good.xml"][1] is None
    for name in ("bad.zip!sum.xml", "bad.zip!head.xml", "bad.zip!last.xml", "bad.zip!lzma.xml", "cut.zip"):
        assert got[name][0] is None and got[name][1], name
    assert got["bad.zip!last.xml"][1] == "encrypted" and len(got) == 6


def test_archives_within_archives(spark, tmp_path):
    def wrap(name, body):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(name, body)
            z.writestr("also.xml", b"<a/>")
        return out.getvalue()

    deep = wrap("d.xml", b"<d/>")
    for level in ("c.zip", "b.zip"):
        deep = wrap(level, deep)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("b.zip", deep)
        z.writestr("broken.zip", b"none")
    for ranges in (True, False):
        got = {r.path.rsplit("/", 1)[-1]: (r.content and bytes(r.content), r.error) for r in archives.read_archives(spark, str(tmp_path), ranges=ranges).collect()}
        assert got["a.zip!b.zip!also.xml"] == (b"<a/>", None) and got["a.zip!b.zip!b.zip!also.xml"] == (b"<a/>", None)
        assert got["a.zip!b.zip!b.zip!c.zip"][1].startswith("archives more than") and got["a.zip!broken.zip"][1] and len(got) == 4


def test_a_member_that_is_too_large_is_told(spark, tmp_path, monkeypatch):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("large.xml", b"x" * 5000)
        z.writestr("small.xml", b"x")
    whole = (tmp_path / "a.zip").read_bytes()
    with pytest.raises(zipfile.BadZipFile):
        archives.unpacked(whole[:10], zipfile.ZIP_STORED, 11, 0)
    monkeypatch.setattr(archives, "MOST_BYTES", 1000)
    rows = list(archives._inner("a", whole, ".xml", 1))
    assert [(p, e is None) for p, _, e in rows] == [("a!large.xml", False), ("a!small.xml", True)]


def test_documents_through_archives(spark, tmp_path, monkeypatch):
    from docloom.plans import queries

    r = random.Random(6)
    rows = [(i, r.choice([None, "", "one line\n\ntwo  lines <&>\nshort", "x" * 4000 + "\nabc\n" + "é" * 9]), f"src{i % 3}") for i in range(60)]
    spark.createDataFrame([*rows, rows[7]], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "_ARCHIVE_ROWS", 7)
    got = sorted((x.doc_id, x.source, x.n_notes, x.chars) for x in queries.QUERIES["archived_documents"](spark, str(tmp_path)).collect())
    items = lambda t: [s for s in (" ".join(line.split()) for line in (t or "").split("\n")) if len(s) >= 4]
    assert got == sorted((i, s, len(items(t)), sum(map(len, items(t)))) for i, t, s in rows)


def test_files_of_archives_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Few archives hold many files: their list says nothing about the sizes of what is read from them."""
    from docloom.plans import queries
    from docloom.sources import files

    plan = lambda df: df.collect() and df._jdf.queryExecution().executedPlan().toString()
    make(tmp_path / "one.zip", 300, 7)
    make(tmp_path / "two.zip", 300, 7)
    first, other = files.split_duplicates(archives.read_archives(spark, str(tmp_path)))
    assert "SortMergeJoin" in plan(first) and "Broadcast" not in plan(first) and "Broadcast" not in plan(other)
    contents = list(plain(tmp_path).values())
    assert first.count() == len(set(contents)) and other.count() == len(contents) - len(set(contents))
    rows = [(i, "line one\nline two", "s") for i in range(50)] + [(None, "no id", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "_ARCHIVE_ROWS", 7)
    zipped = queries._zipped
    monkeypatch.setattr(queries, "_zipped", lambda folder: lambda frames: zipped(folder)(f for frame in frames for f in (frame, frame)))  # as tasks that were run again
    got = queries.QUERIES["archived_documents"](spark, str(tmp_path))
    assert "SortMergeJoin" in plan(got) and "Broadcast" not in plan(got)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(i, "s", len(t.split("\n")), len(t.replace("\n", ""))) for i, t, _ in rows], key=str)


def test_many_archives_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(120):
        with zipfile.ZipFile(tmp_path / f"{i}.zip", "w") as z:
            z.writestr("a.xml", str(i))
    members = archives.archive_members(spark, str(tmp_path))
    assert members.count() == 120 and members.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
