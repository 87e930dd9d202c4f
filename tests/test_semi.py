"""JSON as VARIANT, facts stored as such, and the validator of the chapter on pharmacokinetics."""

import json

from pyspark.sql import functions as F

from docloom.functions import semi, text
from docloom.plans import incremental, publishing, validation


def test_nested_json_and_what_is_none(spark):
    rows = [(1, '{"a": 1}'), (2, json.dumps('{"a": 2}')), (3, "{"), (4, None), (5, '"plain"'), (6, "[1]"), (7, json.dumps(json.dumps(json.dumps({"a": 7})))), (8, "7")]
    v = spark.createDataFrame(rows, "i int, j string").select("i", semi.nested(F.col("j")).alias("v"))
    got = {r.i: (r.a, r.r and r.r.a) for r in v.select("i", semi.field(F.col("v"), "$.a", "int").alias("a"), semi.record(F.col("v"), "a int, `b c` string").alias("r")).collect()}
    assert got == {1: (1, 1), 2: (2, 2), 3: (None, None), 4: (None, None), 5: (None, None), 6: (None, None), 7: (None, None), 8: (None, None)}
    lists = v.select("i", F.size(semi.entries(F.col("v"))).alias("n")).collect()
    assert {r.i: r.n for r in lists if r.n is not None and r.n >= 0} == {6: 1}


def test_facts_as_text_and_as_variant(spark, tmp_path):
    facts = [("a", json.dumps([{"x": "1", "y": 2}, {"x": "z"}])), ("b", json.dumps(json.dumps([{"x": "in"}]))), ("c", "{"), ("d", json.dumps({"x": "no list"})), ("e", None), ("f", "[]"), ("g", '[{"x": "q", "y": "not a number"}, 5]')]
    runs = spark.createDataFrame([(h, "m", "success", f) for h, f in facts], "analysis_hash string, model string, status string, facts string")
    blocks = spark.createDataFrame([(h + n, h) for h, _ in facts for n in "12"], "block string, analysis_hash string")
    stored = runs.withColumn("facts", semi.nested(F.col("facts")))
    stored.write.parquet(f"{tmp_path}/runs")
    want = sorted([(h + n, i, x, y) for n in "12" for h, i, x, y in [("a", 0, "1", 2), ("a", 1, "z", None), ("b", 0, "in", None), ("g", 0, "q", None), ("g", 1, None, None)]], key=repr)
    for source in (runs, spark.read.parquet(f"{tmp_path}/runs")):
        got = incremental.rebuilt_facts(blocks, source, "struct<x:string,y:int>")
        assert sorted(((r.block, r.fact_no, r.x, r.y) for r in got.collect()), key=repr) == want
        cases = runs.select("analysis_hash", "model")
        shown = publishing.proposed_facts(cases, source, "struct<x:string,y:int>").collect()
        assert sorted((r.analysis_hash, r.fact_no, r.x) for r in shown if r.x) == [("a", 1, "1"), ("a", 2, "z"), ("b", 1, "in"), ("g", 1, "q")] and len(shown) == 9
    plan = incremental.rebuilt_facts(blocks, spark.read.parquet(f"{tmp_path}/runs"), "struct<x:string,y:int>")._jdf.queryExecution().toString()
    assert "parse_json" not in plan and "from_json" not in plan


FACT = {"feature_type": "enzyme", "relation_type": "metabolized_by", "target_name": "CYP 3A4", "evidence_text": "主にCYP3A4で　\n 代謝", "strength": "primary", "confidence": "1.5", "qualifiers": "x"}
BLOCK = "本剤は主にCYP3A4で　\r\n代謝される。 UGT1A1も弱く関与"


def test_chapter_facts():
    facts, errors = validation.chapter_facts({"facts": [FACT]}, BLOCK)
    assert errors == [] and facts == [
        {"feature_type": "ENZYME", "relation_type": "METABOLIZED_BY", "strength": "PRIMARY", "polarity": "UNCERTAIN", "evidence_level": "UNKNOWN", "assertion_type": "EXPLICIT", "target_name": "CYP 3A4", "target_code": "CYP3A4", "evidence_text": "主にCYP3A4で\n代謝", "qualifiers": {"raw_qualifiers": "x"}, "confidence": 1.0}
    ]
    for change in ({"relation_type": "EXCRETED_IN"}, {"relation_type": "?"}, {"feature_type": "?"}, {"target_name": " "}, {"target_name": "unknown"}, {"evidence_text": "none"}, {"evidence_text": ""}, {"strength": "weak"}, {"strength": "?"}, {"confidence": "much"}, {"confidence": None}, {"polarity": "?"}, {"evidence_level": "?"}, {"assertion_type": "?"}):
        facts, errors = validation.chapter_facts({"facts": [FACT | change]}, BLOCK)
        assert facts == [] and len(errors) == 1, change
    other = {"feature_type": "EXCRETION", "relation_type": "EXCRETED_IN", "target_name": "QT", "evidence_text": "代謝される。"}
    assert validation.chapter_facts({"facts": [other, "no"]}, BLOCK) == ([{"feature_type": "EXCRETION", "relation_type": "EXCRETED_IN", "strength": "UNKNOWN", "polarity": "UNCERTAIN", "evidence_level": "UNKNOWN", "assertion_type": "EXPLICIT", "target_name": "QT", "target_code": None, "evidence_text": "代謝される。", "qualifiers": {"raw_qualifiers": None}, "confidence": 0.0}], ["1: not an object"])
    assert validation.chapter_facts({"facts": {}}, BLOCK) == ([], ["facts must be a list"])
    assert text.tight_text(None) == "" and text.tight_text("a 　\tb \r\n\n c") == "a b\nc"


def test_rebuilt_facts_are_never_broadcast(spark, tmp_path):
    runs = spark.createDataFrame([("a", "m", "success", '[{"x": 1}, {"x": 2}]')], "analysis_hash string, model string, status string, facts string")
    blocks = spark.createDataFrame([("b", "a")], "block string, analysis_hash string")
    for name, rows in (("runs", runs), ("blocks", blocks)):
        rows.write.parquet(f"{tmp_path}/{name}")
    got = incremental.rebuilt_facts(spark.read.parquet(f"{tmp_path}/blocks"), spark.read.parquet(f"{tmp_path}/runs"), "x int")
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString() and sorted(r.x for r in got.collect()) == [1, 2]
