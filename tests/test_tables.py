from pyspark.sql import functions as F

from docloom.operators import merging, ranking
from docloom.plans import model_calls, publishing, statements, validation
from docloom.sources import xml_tree

XML = """<r xmlns="u"><ApprovalEtc><DetailBrandName><BrandCode><YJCode>1</YJCode></BrandCode></DetailBrandName></ApprovalEtc>
<Use><Header>H</Header><OrderedList><Item><Detail>first item。</Detail></Item><Item><Detail>second item。</Detail></Item></OrderedList></Use></r>"""


def test_snapshot_and_scd2(spark, tmp_path):
    table = merging.SnapshotTable(spark, str(tmp_path / "t"))
    cols = "k int, v string, is_current boolean, first_seen_at string, last_seen_at string, retired_at string"
    table.write(spark.createDataFrame([(1, "a", True, "1", "1", None), (2, "b", True, "1", "1", None)], cols))
    new = spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string")
    for _ in range(2):
        table.write(merging.scd2_merge(table.read(), new, ["k"], "v", F.lit("2")).drop("change_type"))
    rows = {r.k: (r.is_current, r.first_seen_at, r.retired_at) for r in table.read().collect()}
    assert rows == {1: (True, "1", None), 2: (False, "1", "2"), 3: (True, "2", None)}
    assert merging.reset({"t": table}) == [("t", 3)]
    merging.reset({"t": table}, execute=True)
    assert table.read().count() == 0


def test_preferred_run_without_facts_publishes_none(spark):
    cases = spark.createDataFrame([("h",)], "analysis_hash string")
    runs = spark.createDataFrame([("h", "good", "success", 1), ("h", "weak", "success", 2)], "analysis_hash string, model string, status string, run_id int")
    facts = spark.createDataFrame([(2, "f")], "run_id int, fact string")
    assert publishing.published_facts(cases, runs, facts, ["good", "weak"]).count() == 0
    assert publishing.published_facts(cases, runs, facts, ["weak", "good"]).count() == 1


def test_priority_ties_and_absent(spark):
    groups = spark.createDataFrame([(1,), (2,)], "k int")
    items = spark.createDataFrame([(1, "B"), (1, "A"), (1, None)], "k int, code string")
    rows = {r.k: (r.best_code, r.n_items) for r in ranking.argmax_by_priority(groups, items, "k", "code", {"A": 9, "B": 9}, F.lit("NONE")).collect()}
    assert rows == {1: ("A", 2), 2: ("NONE", 0)}


def test_answers():
    assert model_calls.parse_answer('x {"facts": [1,],} y') == {"facts": [1]}
    assert model_calls.parse_answer('{"a": "a,]"}') == {"a": "a,]"}
    client = model_calls.ReplayClient({"p": ["no", '{"facts": []}']})
    assert model_calls.ask(client, "p", lambda a: (a["facts"], []))["attempts"] == 2


def test_validators():
    fact = {"relation_type": "R", "subject_type": "DRUG", "polarity": "POSITIVE", "certainty": "EXPLICIT", "note_text": "8%", "evidence_text": "a 8%"}
    definition = {"allowed_relations": ["R"], "reject_duplicated_aggregate_percent": True}
    facts, errors = validation.notes({"facts": [fact, fact | {"note_text": "8% too"}]}, definition, "a 8%")
    assert len(facts) == 2 and len(errors) == 1
    assert validation.statement({"classification_code": "AVOID", "assessment_text": "x", "evidence_text": "Take it"}, "Take it.", {"AVOID": "avoid"})[0][0]["classification_code"] == "UNCLASSIFIABLE"


def test_summaries_read_the_statements_once(spark, tmp_path):
    rows = [("1", "PREGNANCY", "s2", "AVOID"), ("1", "PREGNANCY", "s1", "AVOID"), ("1", "PREGNANCY", "s0", "ACCEPTABLE"), ("1", "PREGNANCY", "s3", "UNCLASSIFIABLE"), ("1", "LACTATION", "s4", None), ("1", "LACTATION", "s5", "odd")]
    spark.createDataFrame(rows, "package_insert_no string, population_type string, statement_id string, classification_code string").write.parquet(f"{tmp_path}/statements")
    states = [("1", "PREGNANCY", True), ("1", "LACTATION", True), ("2", "LACTATION", False)]
    spark.createDataFrame(states, "package_insert_no string, population_type string, has_section boolean").write.parquet(f"{tmp_path}/states")
    got = statements.summaries(spark.read.parquet(f"{tmp_path}/states"), spark.read.parquet(f"{tmp_path}/statements"))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    assert sorted((r.package_insert_no, r.population_type, r.assessment_code, r.reason_statement_id, r.has_unclassified, r.statement_count) for r in got.collect()) == [
        ("1", "LACTATION", "NO_EXPLICIT_RECOMMENDATION", None, False, 2), ("1", "PREGNANCY", "AVOID", "s1", True, 4), ("2", "LACTATION", "SECTION_ABSENT", None, False, 0)
    ]
