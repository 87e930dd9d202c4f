"""Streams into tables: a batch handed over again changes nothing, contents come once; counts that follow a table."""

import datetime as dt
import random

from pyspark.sql import functions as F

from docloom.operators.delta_table import DeltaTable
from docloom.operators.kept_counts import KeptCounts
from docloom.streaming import ingest


def test_documents_once_and_batches_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    table = DeltaTable.create(spark.createDataFrame([], ingest.DOCUMENTS), f"{tmp_path}/t", ["path"], buckets=2)
    run = lambda: ingest.documents_into_table(spark, str(source), table, "docs", f"{tmp_path}/c").awaitTermination()
    found = lambda: {r.path.rsplit("/", 1)[-1]: (r.text, r.error, r.batch) for r in table.read().collect()}
    (source / "a.xml").write_text("<a/>")
    run()
    assert found() == {"a.xml": ("<a/>", None, 0)} and table.tag("docs") == 0
    (source / "copy.xml").write_text("<a/>")
    (source / "b.xml").write_text("<b/>")
    (source / "bad.xml").write_bytes(b"\xff")
    run()
    want = {"a.xml": ("<a/>", None, 0), "b.xml": ("<b/>", None, 1), "bad.xml": (None, "not UTF-8", 1)}
    assert found() == want and table.tag("docs") == 1
    last = max((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (tmp_path / "c" / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    versions = table.versions()
    run()
    assert found() == want and table.versions() == versions


def test_a_batch_without_changes_is_recorded(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    table = DeltaTable.create(rows, f"{tmp_path}/t", ["k"], buckets=2)
    assert table.upsert(rows, tag=("s", 0)) == 0 and table.tag("s") == 0 and table.tag("other") is None
    assert table.upsert(spark.createDataFrame([(1, "b")], "k int, v string"), tag=("s", 0)) == 0
    assert table.read().first().v == "a"


def test_counts_follow_the_table(spark, tmp_path):
    r = random.Random(9)
    row = lambda k: (k, r.choice(["x", "y", None]), f"p{r.randint(0, 4)}", r.random() < 0.8)
    schema = "k int, kind string, package string, is_current boolean"
    table = DeltaTable.create(spark.createDataFrame([row(k) for k in range(60)], schema), f"{tmp_path}/t", ["k"], buckets=2)
    counts = KeptCounts(table, f"{tmp_path}/c", ["kind"], ["package"], "is_current", buckets=1)

    def check():
        want = table.read().filter("is_current").groupBy(F.coalesce("kind", F.lit("")).alias("kind")).agg(F.count("*").alias("n"), F.countDistinct("package").alias("n_things"))
        assert sorted(map(tuple, counts.read().collect())) == sorted(map(tuple, want.collect()))

    check()
    for run in range(2):
        table.upsert(spark.createDataFrame([row(k) for k in r.sample(range(90), 9)], schema))
        table.delete(spark.createDataFrame([(k,) for k in r.sample(range(90), 4)], "k int"))
        if run % 2:
            assert counts.refresh() > 0 and counts.refresh() == 0
            check()
    again = KeptCounts(table, f"{tmp_path}/c", ["kind"], ["package"], "is_current")
    assert again.refresh() == 0
    table.compact()
    again.refresh()
    check()
    table.delete(table.read().filter("kind = 'x'").select("k"))
    again.refresh()
    check()
    assert "x" not in {x.kind for x in again.read().collect()}


def test_queries_on_small_tables(spark, tmp_path):
    from docloom.plans import queries

    r = random.Random(12)
    when = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    sales = [(r.choice([None, *range(20)]), r.randint(0, 3), r.choice("ab"), r.random(), when(r.randint(0, 9)), when(100 + i), 1) for i in range(80)]
    df = spark.createDataFrame(sales, "sale_id long, client_id long, status string, total double, sold_at timestamp, arrived_at timestamp, priority int")
    df.repartition(6).write.parquet(f"{tmp_path}/sales.parquet")
    want = {}
    for row in sales:
        if row[0] is not None:
            want[row[0]] = row
    assert {x.sale_id: tuple(x) for x in queries.QUERIES["streamed_sales"](spark, str(tmp_path)).collect()} == want
    clients = [(i % 50, when(i), r.randint(0, 3), r.choice(["x", "y", None]), r.choice([None, 5.0, -5.0])) for i in range(70)]
    spark.createDataFrame(clients, "client_id long, updated_at timestamp, nation_id int, segment string, balance double").write.parquet(f"{tmp_path}/clients.parquet")
    last = {c[0]: c for c in clients}
    groups = {}
    for i, _, nation, segment, balance in last.values():
        balance = -balance if i % 10 == 3 and balance is not None else balance
        if i % 10 != 4 and (balance is None or balance >= 0):
            groups.setdefault(str(nation), []).append(segment or "")
    got = {x.nation_id: (x.n, x.n_things) for x in queries.QUERIES["kept_client_counts"](spark, str(tmp_path)).collect()}
    assert got == {k: (len(v), len(set(v))) for k, v in groups.items()}
