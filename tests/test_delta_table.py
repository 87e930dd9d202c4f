"""Delta tables: equal to whole snapshots after any changes, written in proportion, one writer, compaction and vacuum."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.operators import merging
from docloom.operators.delta_table import ConflictError, DeltaTable
from docloom.plans import incremental

COLS = "doc string, uid int, text string, is_current boolean, first_seen_at string, last_seen_at string, retired_at string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def n_files(path):
    return sum(1 for p in (path / "files").rglob("*.parquet"))


def test_history_by_delta_equals_whole_history(spark, tmp_path):
    r = random.Random(2)
    start = [(f"d{d}", u, f"t{u}", True, "0", "0", None) for d in range(30) for u in range(r.randint(0, 5))]
    whole = spark.createDataFrame(start, COLS)
    table = DeltaTable.create(whole, f"{tmp_path}/t", ["doc", "uid"], ["doc"], buckets=4)
    for run in range(1, 4):
        docs = r.sample(range(40), 4)
        new = spark.createDataFrame([(f"d{d}", u, f"t{u if r.random() < 0.8 else run}") for d in docs for u in range(r.randint(0, 6))], "doc string, uid int, text string")
        scope = spark.createDataFrame([(f"d{d}",) for d in docs], "doc string")
        step = lambda old: incremental.replace_blocks(old, new, scope, "doc", ["doc", "uid"], "text", F.lit(str(run))).drop("change_type")  # noqa: B023, E731
        table.change(scope, step)
        step(whole).write.parquet(f"{tmp_path}/whole{run}")
        whole = spark.read.parquet(f"{tmp_path}/whole{run}").select(*[c.split()[0] for c in COLS.split(", ")])
        assert rows_of(table.read()) == rows_of(whole)
    before = rows_of(table.read())
    assert table.compact() > 0 and rows_of(table.read()) == before and table.compact() == 0
    assert table.vacuum(1) > 0 and rows_of(table.read()) == before and len(table.versions()) == 1


def test_upserts_and_deletes_equal_snapshots(spark, tmp_path):
    r = random.Random(3)
    whole = {k: (k, "a", 1) for k in range(200)}
    table = DeltaTable.create(spark.createDataFrame(list(whole.values()), "k int, v string, n int"), f"{tmp_path}/t", ["k"], buckets=2)
    for run in range(3):
        new = [(k, r.choice([None, f"v{run}"]), r.choice([None, run])) for k in r.sample(range(230), 6)]
        table.upsert(spark.createDataFrame(new, "k int, v string, n int"), {"n": merging.accumulate, "v": merging.keep_if_null})
        for k, v, n in new:
            _, ov, on = whole.get(k, (k, None, None))
            whole[k] = (k, v if v is not None or k not in whole else ov, (on or 0) + (n or 0) if k in whole else n)
        gone = r.sample(range(230), 3)
        table.delete(spark.createDataFrame([(k,) for k in gone], "k int"))
        for k in gone:
            whole.pop(k, None)
        assert rows_of(table.read()) == sorted(whole.values(), key=repr)
    assert max(len(f) for f in table._state()["files"].values()) <= 5


def test_a_run_writes_in_proportion_and_nothing_if_nothing_changes(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table = DeltaTable.create(rows, f"{tmp_path}/t", ["k"], buckets=4)
    size = lambda v: sum(p.stat().st_size for d in (tmp_path / "t/files").glob(f"{v:010d}-*") for p in d.rglob("*.parquet"))
    few = rows.filter("k % 100 = 7").withColumn("v", F.concat("v", F.lit("!")))
    assert table.upsert(few) == 200 and table.upsert(few) == 0 and table.versions() == [1, 2]
    assert size(2) < 0.04 * size(1)
    one = few.filter("k = 7")
    read = table._rows(table._state(), [0])
    assert 4000 < read.count() < 6000
    assert table.upsert(one.withColumn("v", F.lit("x"))) == 1 and len(table._written(table._state()["files"][next(b for b, f in table._state()["files"].items() if len(f) == 3)][-1])) == 1


def test_old_versions_stay_readable_until_vacuum(spark, tmp_path):
    table = DeltaTable.create(spark.createDataFrame([(1, "a")], "k int, v string"), f"{tmp_path}/t", ["k"], buckets=2)
    table.upsert(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"))
    assert rows_of(table.read(1)) == [(1, "a")] and rows_of(table.read()) == [(1, "b"), (2, "c")]
    with pytest.raises(ConflictError):
        DeltaTable.create(spark.createDataFrame([(1, "a")], "k int, v string"), f"{tmp_path}/t", ["k"])


def test_one_writer_at_a_time(spark, tmp_path):
    table = DeltaTable.create(spark.createDataFrame([(1, "a")], "k int, v string"), f"{tmp_path}/t", ["k"], buckets=2)
    other = DeltaTable(spark, f"{tmp_path}/t")
    new = spark.createDataFrame([(1, "b")], "k int, v string")
    with table.lock():
        with pytest.raises(ConflictError):
            other.upsert(new)
        with other.lock(lease=-1):
            pass
    assert rows_of(table.read()) == [(1, "a")]
    state = table._state()
    with pytest.raises(ConflictError):
        table._publish(state)
    with pytest.raises(ZeroDivisionError):
        table.change(new, lambda old: 1 / 0)
    assert other.upsert(new) == 1 and rows_of(table.read()) == [(1, "b")]


def test_rows_outside_the_scope_are_refused(spark, tmp_path):
    table = DeltaTable.create(spark.createDataFrame([(k, "a") for k in range(50)], "k int, v string"), f"{tmp_path}/t", ["k"], buckets=16)
    scope = spark.createDataFrame([(1,)], "k int")
    other = spark.createDataFrame([(k, "z") for k in range(60, 90)], "k int, v string")
    with pytest.raises(ValueError):
        table.change(scope, lambda old: old.unionByName(other))
    assert table.read().count() == 50
    empty = DeltaTable.create(spark.createDataFrame([], "k int, v string"), f"{tmp_path}/e", ["k"], buckets=4)
    assert empty.read().count() == 0 and empty.upsert(other) == 30 and empty.read().count() == 30


def test_query_on_a_small_table(spark, tmp_path):
    from docloom.plans import queries

    orders = [(k, k % 23, float(k)) for k in range(200)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.uid: (r.doc, r.value, r.is_current, r.first_seen_at, r.last_seen_at, r.retired_at) for r in queries.QUERIES["delta_history"](spark, str(tmp_path)).collect()}

    def want(k, c, p):
        if c % 10 != 3:
            return c, p, True, "1", "1", None
        return (c, p, True, "1", "3", None) if k % 2 == 0 else (c, p + 1, False, "1", "2", "3")

    assert got == {k: want(k, c, p) for k, c, p in orders}
