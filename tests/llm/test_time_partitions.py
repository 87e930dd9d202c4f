"""Time partitions against a plain layout and sort of all rows."""

import calendar
import datetime as dt
import hashlib
import os
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docloom.llm import queries, time_partitions as T

CUT = dt.datetime(2024, 5, 1)


def moment(row):
    if row["ts"] is None:
        return None
    k = zlib.crc32(str(row["click_id"]).encode()) % 128 if row["click_id"] is not None else None
    if k is not None and k < 16:
        return row["ts"] - dt.timedelta(days=(k + 6) ** 3)
    if k is not None and k > 111:
        day = row["ts"].date() - dt.timedelta(days=row["ts"].weekday())
        return dt.datetime(day.year, day.month, day.day)
    return row["ts"]


def layout(rows, limit):
    """{(leaf, part): rows in order} by the rule, from all rows at once."""
    leaves = {}

    def split(level, prefix, siblings, of, held):
        run, total = [], 0
        own = lambda m: f"{m:04d}" if level == 0 else f"{m:02d}"

        def end():
            got = [r for m in run for r in of.get(m, [])]
            if got:
                leaves["/".join([*prefix, f"{own(run[0])}-{own(run[-1])}"])] = got

        for m in siblings:
            n = len(of.get(m, []))
            if n > limit and level < 3:
                end()
                run, total = [], 0
                sub = {}
                for r in of[m]:
                    t = r["moment"]
                    sub.setdefault((t.month, t.day, t.hour)[level], []).append(r)
                year, month = (m, None) if level == 0 else (held[0], m if level == 1 else held[1])
                split(level + 1, [*prefix, own(m)], (range(1, 13), range(1, 1 + calendar.monthrange(year, month)[1]) if month else (), range(24))[level], sub, (year, month))
            else:
                if run and total + n <= limit:
                    run.append(m)
                    total += n
                else:
                    end()
                    run, total = [m], n
        end()

    years = {}
    for r in rows:
        if r["moment"] is not None:
            years.setdefault(r["moment"].year, []).append(r)
    if years:
        split(0, [], range(min(years), max(years) + 1), years, None)
    if none := [r for r in rows if r["moment"] is None]:
        leaves["null"] = none
    low = dt.datetime.min
    first = lambda x: (x is not None, x if x is not None else low)
    out = {}
    for name, own in leaves.items():
        own = sorted(own, key=lambda r: (first(r["moment"]), first(r["arrived_at"]), r["click_id"] is not None, r["click_id"] or 0))
        for p in range(0, len(own), limit):
            out[name, p // limit + 1] = own[p : p + limit]
    return out


def expected(rows):
    limit = 1 + len(rows) // 500
    rows = [r | {"moment": moment(r)} for r in rows]
    early = lambda r: r["arrived_at"] is not None and r["arrived_at"] < CUT
    before, after = layout([r for r in rows if early(r)], limit), layout(rows, limit)
    full = lambda part: sorted(repr(r) for r in part)
    ids = lambda part: hashlib.sha256(",".join("" if r["click_id"] is None else str(r["click_id"]) for r in part).encode()).hexdigest()
    return {k: (len(v), sum(not early(r) for r in v), ids(v), not (k in before and full(before[k]) == full(v))) for k, v in after.items()}


def clicks(n, seed=3, hot=False):
    r = random.Random(seed)
    out = []
    for i in range(n):
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=r.random() * 150 * 86400) if not hot or i % 3 else dt.datetime(2024, 2, 7, 10, 5)
        ts = None if r.random() < 0.02 else ts
        arrived = None if r.random() < 0.01 else (ts or dt.datetime(2024, 4, 1)) + dt.timedelta(seconds=r.choice([1, 1, 1, 9 * 86400]))
        out.append({"click_id": i, "ts": ts, "arrived_at": arrived, "client_id": r.choice([None, 1, 2]), "kind": r.choice([None, "view", ""]), "value": r.random(), "props": r.choice([None, "", "{}", "x" * 3000])})
    out += [dict(r.choice(out)) for _ in range(n // 20)]
    r.shuffle(out)
    return out


def save(rows, folder):
    us = pa.timestamp("us")
    schema = pa.schema([("click_id", pa.int64()), ("ts", us), ("arrived_at", us), ("client_id", pa.int64()), ("kind", pa.string()), ("value", pa.float64()), ("props", pa.string())])
    os.makedirs(folder / "clicks.parquet")
    for i in range(4):
        pq.write_table(pa.Table.from_pylist(rows[i::4], schema=schema), folder / "clicks.parquet" / f"{i}.parquet")


def run(spark, folder):
    return [r.asDict() for r in queries.op11_time_partitions(spark, str(folder)).collect()]


@pytest.mark.parametrize("hot", [False, True])
def test_equals_a_plain_layout(spark, tmp_path, hot):
    rows = clicks(2500, hot=hot)
    save(rows, tmp_path)
    got, want = run(spark, tmp_path), expected(rows)
    assert {(r["leaf"], r["part"]): (r["n_rows"], r["n_new"], r["ids_sha256"], r["rewritten"]) for r in got} == want
    assert any(r["rewritten"] for r in got) and not all(r["rewritten"] for r in got)
    folder = Path(got[0]["path"]).parent
    assert {str(p) for p in folder.iterdir() if not p.name.endswith(".crc")} == {r["path"] for r in got}
    for r in got:
        table = pq.read_table(r["path"])
        assert ",".join(table.column_names) == r["columns"] == "click_id,ts,arrived_at,client_id,kind,value,props"
        assert hashlib.sha256(",".join(map(str, table["click_id"].to_pylist())).encode()).hexdigest() == r["ids_sha256"]
    found = [x for r in got for x in pq.read_table(r["path"]).to_pylist()]
    assert sorted(map(repr, found)) == sorted(map(repr, rows))


def test_many_runs_are_merged_in_levels(spark, tmp_path):
    rows = clicks(3000, hot=True)
    save(rows, tmp_path)
    table = spark.read.parquet(f"{tmp_path}/clicks.parquet")
    how = {"moment": F.col("ts"), "order": ["arrived_at", "click_id"], "id_col": "click_id", "leaf_rows": 150}
    one = T.write_partitions(table, f"{tmp_path}/one", **how).files
    many = T.write_partitions(table.repartition(40), f"{tmp_path}/many", **how, fan=3).files
    cols = ["leaf", "part", "n_rows", "ids_sha256", "sum_a", "sum_b", "sum_c"]
    assert sorted(map(tuple, one.select(cols).collect())) == sorted(map(tuple, many.select(cols).collect()))


def test_rows_that_go_are_noticed(spark, tmp_path):
    rows = clicks(1000)
    save(rows, tmp_path)
    table = spark.read.parquet(f"{tmp_path}/clicks.parquet")
    how = {"moment": F.col("ts"), "order": ["arrived_at", "click_id"], "id_col": "click_id", "leaf_rows": 60}
    before = T.write_partitions(table, f"{tmp_path}/out", **how)
    same = T.write_partitions(table, f"{tmp_path}/out", **how, before=before)
    assert not any(r.rewritten for r in same.files.collect())
    fewer = table.filter("click_id is null or click_id != 17")
    after = T.write_partitions(fewer, f"{tmp_path}/out", **how, before=same)
    assert 1 <= sum(r.rewritten for r in after.files.collect()) <= 3
    assert spark.read.parquet(f"{tmp_path}/out").count() == fewer.count()


def test_empty_null_and_clashing(spark, tmp_path):
    save([], tmp_path / "a")
    assert run(spark, tmp_path / "a") == []
    rows = [{"click_id": None, "ts": None, "arrived_at": None, "client_id": None, "kind": None, "value": None, "props": None}] * 3
    save(rows, tmp_path / "b")
    got = run(spark, tmp_path / "b")
    assert [(r["leaf"], r["part"], r["n_rows"], r["n_new"], r["rewritten"]) for r in sorted(got, key=lambda r: r["part"])] == [("null", p, 1, 1, True) for p in (1, 2, 3)]
    odd = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "y", 2, "z")], "id long, leaf timestamp_ntz, part string, run int, `k 1` string")
    files = T.write_partitions(odd, f"{tmp_path}/c", moment=F.col("leaf"), order=["run"], id_col="id", leaf_rows=5).files.collect()
    assert [(r.leaf, r.columns) for r in files] == [("2024-2024", "id,leaf,part,run,k 1")]


def test_split_points_and_merge_hold_any_ties(tmp_path):
    r = random.Random(1)
    for case in range(20):
        slices, all_keys = [], []
        for i in range(r.randint(1, 6)):
            n = r.randint(1, 400)
            keys = sorted((r.randint(0, 5 if case % 2 else 10**6), r.randint(0, 3), 7) for _ in range(n))
            all_keys += keys
            table = pa.table({T.MOMENT: pa.array([k[0] for k in keys], pa.timestamp("us")), "a": pa.array([k[1] for k in keys], pa.int64()), T.HASH: pa.array([k[2] for k in keys], pa.int64())})
            pq.write_table(table, tmp_path / f"{case}-{i}.parquet", row_group_size=16)
            file = pq.ParquetFile(tmp_path / f"{case}-{i}.parquet")
            slices.append(T.Slice(file, 0, file.num_row_groups, ["a"]))
        all_keys.sort()
        cuts = sorted(r.randint(0, len(all_keys)) for _ in range(5))
        points = [T.split_points(slices, c) for c in [0, *cuts, len(all_keys)]]
        assert [sum(p) for p in points] == [0, *cuts, len(all_keys)]
        got = [list(zip(t[T.MOMENT].cast(pa.int64()).to_pylist(), t["a"].to_pylist(), strict=True)) for a, b in zip(points, points[1:], strict=False) for t in T.merged(slices, a, b)]
        assert [x for part in got for x in part] == [k[:2] for k in all_keys]


def test_starts_of_all_levels():
    for y, m, d, h in ((2024, 2, 29, 23), (1969, 12, 31, 0), (1, 1, 1, 5), (12000, 3, 1, 2)):
        numbers = [y, y * 100 + m, (y * 100 + m) * 100 + d, ((y * 100 + m) * 100 + d) * 100 + h]
        for level, number in enumerate(numbers, 1):
            want = np.datetime64(y - 1970, "Y").astype("datetime64[M]") + (m - 1) * (level > 1)
            want = want.astype("datetime64[D]") + (d - 1) * (level > 2)
            want = want.astype("datetime64[h]") + h * (level > 3)
            assert T._start(number, level) == want.astype("datetime64[us]").astype(int)
