"""The document pipeline's parts on small hand-made cases, and one run from XML to published notes and back."""

import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from docloom.functions import progress, text
from docloom.operators import filters, merging
from docloom.functions.targets import TARGETS
from docloom.plans import incremental, model_calls, prompts, publishing, statements, validation
from docloom.sources import archives, files, one_pass, sections, xml_tree
from docloom.streaming.ingest import ingest

XML = """<r xmlns="u"><PackageInsertNo>1</PackageInsertNo><Warnings><Header>警告</Header><OrderedList><Item><Detail>一つ目の警告。</Detail></Item><Item><Detail>二</Detail></Item></OrderedList></Warnings>
<UseInSpecificPopulations><UseInPregnant id="p1"><Header>妊婦</Header><Detail><Lang xml:lang="en">do not use</Lang><Lang xml:lang="ja">投与しないこと。</Lang></Detail></UseInPregnant></UseInSpecificPopulations>
<Pharmacokinetics><Metabolism><Detail>主にCYP3A4で代謝される。50%が尿中に排泄。</Detail><TblBlock>1 2 3 4</TblBlock></Metabolism><Unknown><Detail>未知の項目。</Detail></Unknown></Pharmacokinetics></r>"""


def rows_of(xml, collector):
    return one_pass.collected(xml, [collector])[0]


def test_chapter_chunks():
    rows = rows_of(XML, one_pass.Chunks(12, 2))
    assert [(r["section_code"], r["known"], r["section_order"]) for r in rows if r["chunk_no"] == 1] == [("16.4", True, 1), ("16.?", False, 2)]
    assert all(r["section_xml"] is None or r["chunk_no"] == 1 for r in rows) and len(rows) > 2
    assert rows_of("<r/>", one_pass.Chunks()) == []


def test_population_blocks():
    rows = rows_of(XML, one_pass.Populations())
    assert [(r["population_type"], r["section_code"], r["block_order"], r["heading_path"]) for r in rows] == [("PREGNANCY", "9.5", 1, "妊婦")]
    nested = "<r><Pregnant>a<Pregnant>b</Pregnant><PregnantWomen/></Pregnant></r>"
    assert [r["block_text"] for r in rows_of(nested, one_pass.Populations())] == ["ab", "b"]


def test_note_blocks():
    rows = rows_of(XML, one_pass.Notes())
    assert [(r["block_order"], r["section_code"], r["block_text"]) for r in rows] == [(1, "1", "一つ目の警告。"), (2, "9", "妊婦do not use投与しないこと。"), (3, "16.4", "主にCYP3A4で代謝される。50%が尿中に排泄。"), (4, "16", "未知の項目。")]
    assert rows[2]["heading_path"] == "Pharmacokinetics > Metabolism" and rows[0]["block_type"] == "Item"
    parts = rows_of(XML, one_pass.Notes(10, frozenset({"Pharmacokinetics"})))
    assert parts[0]["heading_path"].endswith("> part 1") and parts[1]["block_xml"] is None


def test_legacy_texts():
    row = rows_of(XML, one_pass.Legacy())[0]
    assert row == {"pregnancy_text": "投与しないこと。\n\ndo not use", "pregnancy_id": "p1", "lactation_text": None, "lactation_id": None}
    assert set(rows_of("<r/>", one_pass.Legacy())[0].values()) == {None}


def test_units_and_interactions():
    inner = xml_tree.parse("<s><a><OrderedList><Item>x</Item></OrderedList></a><b>y</b><c/><UnorderedList>z</UnorderedList></s>")
    assert [xml_tree.local(n.tag) for n in xml_tree.units(inner, sections.LISTS, sections.LEAVES)] == ["Item", "b", "UnorderedList"]
    drug = "<r><P><Drug><DrugName><Detail><Lang xml:lang='ja'>類</Lang></Detail><SimpleList><Item>甲</Item><Item>乙</Item><Item>甲</Item></SimpleList></DrugName></Drug><Drug><DrugName><Detail>乙類</Detail></DrugName></Drug><Drug/></P></r>"
    assert [(r["partner_group"], r["partner_name"], r["category"]) for r in rows_of(drug, one_pass.Interactions({"P": "precaution"}))] == [("類", "甲", "precaution"), ("類", "乙", "precaution"), ("乙類", None, "precaution")]
    assert xml_tree.as_json(xml_tree.parse("<a k='1'> t <b/>tail</a>")) == {"tag": "a", "attr": {"k": "1"}, "text": "t", "children": [{"tag": "b", "attr": {}, "text": None, "children": []}, {"tag": "__tail__", "text": "tail"}]}


def test_statement_rules(spark):
    cases = [
        ("PREGNANCY", "妊婦には禁忌である。", "CONTRAINDICATED", "DRUG", False),
        ("PREGNANCY", "投与しないことが望ましい。", "PREFER_AVOID", "DRUG", False),
        ("PREGNANCY", "投与しないこと。", "AVOID", "DRUG", False),
        ("PREGNANCY", "本剤の投与は慎重に行う。", "UNCLASSIFIABLE", None, True),
        ("PREGNANCY", "HMG-CoA還元酵素阻害剤は禁忌であり本剤との併用投与は行わない。", None, None, False),
        ("LACTATION", "授乳の継続又は中止を検討すること。", "CONSIDER_CONTINUE_OR_STOP", "BREASTFEEDING", False),
        ("LACTATION", "授乳を避けること。", "AVOID", "BREASTFEEDING", False),
        ("LACTATION", "乳汁中に移行する。", None, None, False),
    ]
    df = spark.createDataFrame([(i, p, s) for i, (p, s, *_) in enumerate(cases)], "i int, p string, s string")
    rows = df.withColumn("c", statements.classified(F.col("p"), F.col("s"))).orderBy("i").select("c.*").collect()
    assert [(r.classification_code, r.recommendation_target, r.requires_llm) for r in rows] == [c[2:] for c in cases]
    assert rows[-1].expression_type == "MILK_TRANSFER" and rows[4].expression_type == "OTHER_INFORMATION"


def test_candidates_tell_occurrences_apart(spark):
    blocks = spark.createDataFrame([(1, "a", "PREGNANCY", "甲。乙。甲。"), (2, "b", "PREGNANCY", "甲。")], "block_id int, package_insert_no string, population_type string, block_text string")
    rows = {(r.block_id, r.statement_order): r.statement_hash for r in statements.candidates(blocks).collect()}
    assert len(rows) == 4 and rows[1, 1] != rows[1, 3] and rows[1, 1] == rows[2, 1]


def test_last_row_of_a_key_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 1)], "k int, v string, n int")
    assert sorted(merging.upsert(old, new, ["k"], order=["n"]).collect()) == [(1, "y"), (2, "b"), (3, "z")]


def test_runs_and_dump(spark, tmp_path):
    old = spark.createDataFrame([], "analysis_hash string, model string, status string, run_id string")
    new = spark.createDataFrame([("h", "m", "success")], "analysis_hash string, model string, status string")
    facts = spark.createDataFrame([("h", "m", "f"), ("x", "m", "g")], "analysis_hash string, model string, fact string")
    runs, named = merging.upsert_runs(old, new, facts)
    assert [r.run_id for r in runs.collect()] == [r.run_id for r in named.collect()]
    table = merging.SnapshotTable(spark, str(tmp_path / "runs"))
    table.write(runs)
    assert merging.dump({"runs": table, "none": merging.SnapshotTable(spark, str(tmp_path / "none"))}, str(tmp_path / "out"), "20240101") == ["runs_20240101"]
    assert spark.read.parquet(str(tmp_path / "out" / "runs_20240101")).count() == 1


def test_filters(spark):
    df = spark.createDataFrame([(1, "a", ""), (2, None, None), (3, "", "b")], "k int, x string, y string")
    assert [r.k for r in filters.any_text(df, ["x", "y"]).collect()] == [1, 3]
    assert [r.k for r in filters.members(df, ["k", "x"], [(1, "a"), (2, None), (3, "a")]).collect()] == [1, 2]
    assert filters.members(df, ["k"], []).count() == 0 and filters.where_given(df, {"k": [1, 2], "x": None}).count() == 2


def test_files(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a": 1, "b": 2}', encoding="utf-8-sig")
    assert files.load_config(str(tmp_path / "c.json"), b=3, a=None) == {"a": 1, "b": 3}
    df = spark.createDataFrame([("x\ny", '"q"')], "a string, b string")
    files.write_review_pair(df, df, str(tmp_path / "pair"))
    back = files.read_csv_strings(spark, str(tmp_path / "pair" / "facts"))
    assert back.columns == ["a", "b"] and back.collect() == df.collect()
    with pytest.raises(Exception, match="(?i)exist"):
        files.write_review_pair(df, df, str(tmp_path / "pair"))
    copies = spark.createDataFrame([("b", bytearray(b"x")), ("a", bytearray(b"x")), ("c", bytearray(b"y")), ("d", None)], "path string, content binary")
    first, other = files.split_duplicates(copies)
    assert sorted(r.path for r in first.collect()) == ["a", "c", "d"] and [(r.kept, r.skipped) for r in other.collect()] == [("a", "b")]


DEFINITION = {"note_type": "METABOLISM", "definition_version": "1", "allowed_relations": ["METABOLIZED_BY", "QT"], "target_evidence_relations": ["METABOLIZED_BY"], "relation_targets": {"QT": {"target_code": "QT", "target_name": "QT間隔"}}, "required_evidence_term_groups": [["代謝"]], "max_note_percentages": 1, "reject_duplicated_aggregate_percent": True, "max_facts_per_evidence": 3}
FACT = {"relation_type": "metabolized_by", "subject_type": "drug", "target_code": None, "target_name": "CYP 3A4", "polarity": "positive", "certainty": "explicit", "note_text": "CYP3A4で代謝", "details": {}, "evidence_text": "CYP3A4で代謝"}
BLOCK = "主にCYP3A4で代謝される。50%が尿中に排泄。"


def test_note_validator():
    facts, errors = validation.notes({"facts": [FACT, FACT]}, DEFINITION, BLOCK)
    assert errors == [] and len(facts) == 1
    assert (facts[0]["relation_type"], facts[0]["target_code"], facts[0]["evidence_text"]) == ("METABOLIZED_BY", "CYP3A4", "主にCYP3A4で代謝される。")
    assert validation.notes({"facts": [FACT | {"relation_type": "QT"}]}, DEFINITION, BLOCK)[0][0]["target_code"] == "QT"
    for change in ({"target_name": "UGT1A1"}, {"evidence_text": "CYP2D6"}, {"note_text": " "}, {"details": []}, {"note_text": "5% 6％"}, {"polarity": "?"}):
        assert validation.notes({"facts": [FACT | change]}, DEFINITION, BLOCK)[0] == []
    shared = [FACT | {"evidence_text": BLOCK, "note_text": f"{x} 50％"} for x in "ab"]
    facts, errors = validation.notes({"facts": shared}, DEFINITION | {"required_evidence_term_groups": []}, BLOCK)
    assert len(facts) == 2 and len(errors) == 1
    assert TARGETS.find("P糖蛋白") == "P-gp" and TARGETS.supported("Ｐ－糖蛋白の基質", "P-gp", "")


def test_statement_validator():
    codes = statements.SUPPORT
    good = {"classification_code": "stop_breastfeeding", "recommendation_target": "null", "evidence_text": "授乳を中止する", "assessment_text": "x"}
    assert validation.statement(good, "授乳を中止する。", codes)[0][0]["classification_code"] == "STOP_BREASTFEEDING"
    assert validation.statement(good, "授乳を中止する。", codes, "PREGNANCY", statements.LACTATION_ONLY)[0][0]["classification_code"] == "UNCLASSIFIABLE"


def test_prompts(spark):
    row = spark.createDataFrame([("PREGNANCY", "文。", "16.4")], "p string, s string, c string")
    note, one = row.select(prompts.note_prompt(DEFINITION, F.lit(None).cast("string"), F.col("c"), F.lit("Metabolism"), F.lit("a > b"), F.col("s")).alias("n"), prompts.statement_prompt(F.col("p"), F.col("s")).alias("s")).first()
    assert "METABOLIZED_BY|QT" in note and note.endswith("[Text]\n文。") and "[Instructions]" not in note
    assert "pregnant" in one and "UNCLASSIFIABLE" in one and one.endswith("文。")


def test_revalidation(spark):
    runs = [("h", "m", "success", '{"facts": [1, 2]}', "[1, 2]", [], 1), ("e", "m", "success", "nothing", "[1]", [], 1), ("o", "m", "review", None, None, ["x"], 1)]
    runs = spark.createDataFrame(runs, model_calls.RUN_SCHEMA)
    contexts = spark.createDataFrame([("h", '{"most": 1}'), ("e", '{"most": 1}')], "analysis_hash string, context string")
    judge = lambda a, c: ([x for x in a["facts"] if x <= c["most"]], [f"{x} is too much" for x in a["facts"] if x > c["most"]])
    got = {r.analysis_hash: (r.status, r.facts, r.changed) for r in model_calls.revalidated(runs, contexts, judge).collect()}
    assert got == {"h": ("review", "[1]", True), "e": ("error", "[]", True), "o": ("review", None, False)}
    kept = {r.analysis_hash: r.status for r in model_calls.revalidated(runs, contexts, judge, leave_unreadable=True).collect()}
    assert kept["e"] == "success"


def test_review_import(spark):
    decisions = spark.createDataFrame([("a", "approve", "R", "", "1", "m"), ("b", "EXCLUDE", "R", "", "2", "m"), ("c", "", "", "", "3", "m"), ("d", "APPROVE", " ", "", "4", "m"), ("e", "APPROVE", "R", "", "9", "m")], "analysis_hash string, decision string, reviewer string, comment string, run_id string, source_model string")
    facts = spark.createDataFrame([("a", "TRUE", json.dumps(FACT)), ("a", "", json.dumps(FACT | {"note_text": ""})), ("d", "false", "{}"), ("e", "1", "{}")], "analysis_hash string, include string, fact string")
    current = spark.createDataFrame([(h, json.dumps({"block": BLOCK})) for h in "abde"], "analysis_hash string, context string")
    runs = spark.createDataFrame([(h, str(i + 1), "m") for i, h in enumerate("abcde")], "analysis_hash string, run_id string, model string")
    judge = lambda found, context: validation.notes({"facts": found}, DEFINITION, context["block"])
    errors, out = publishing.review_import(decisions, facts, current, runs, judge)
    assert sorted(map(tuple, errors.collect())) == [("b", "EXCLUDE without a comment"), ("d", "APPROVE without a fact"), ("d", "no reviewer"), ("e", "the source run isn't stored")]
    good = [r for r in out.collect() if r.analysis_hash == "a"][0]
    assert (good.model, good.status, good.attempts, len(json.loads(good.facts))) == ("human-review", "success", 0, 1)


def test_from_xml_to_notes_and_again(spark, tmp_path):
    """Blocks, candidates, answers from a replay, publication; a second run parses nothing, a changed document only itself."""
    version, state = "v1", spark.createDataFrame([], "doc string, " + incremental.STATE)
    history = None

    def ingest(docs: dict[str, str], state, history, ts):
        df = spark.createDataFrame(list(docs.items()), "doc string, xml string").withColumn("raw_hash", F.sha2("xml", 256))
        work, rest = incremental.to_parse(df, state, "doc", version)
        kinds, bad = one_pass.document_rows(work, "doc", "xml", {"notes": one_pass.Notes}, f"{tmp_path}/{ts}-parsed")
        good = kinds["notes"]
        good = good.withColumn("block_uid", F.sha2(F.concat_ws("|", "doc", "block_order", "block_text"), 256))
        ok = work.join(bad.select("doc"), "doc", "left_anti")
        found = incremental.manifests(ok, good, ["doc"])
        if history is None:
            empty = good.limit(0).select("doc", "block_uid", "block_text").withColumns({"is_current": F.lit(True), "first_seen_at": F.lit(""), "last_seen_at": F.lit(""), "retired_at": F.lit(None).cast("string")})
            history = empty
        scope = incremental.changed(found, state, ["doc"], version)
        new = incremental.replace_blocks(history, good.select("doc", "block_uid", "block_text"), scope, "doc", ["doc", "block_uid"], "block_text", F.lit(ts)).drop("change_type")
        after = incremental.next_state(state, "doc", version, F.lit(ts), parsed=found, skipped=rest, failed=bad.join(work.select("doc", "raw_hash"), "doc"))
        path = f"{tmp_path}/{ts}"
        new.write.parquet(f"{path}/blocks")
        after.write.parquet(f"{path}/state")
        return work.count(), spark.read.parquet(f"{path}/state"), spark.read.parquet(f"{path}/blocks")

    docs = {"one": XML, "two": XML.replace("二", "二つ目の警告。"), "bad": "<r"}
    n, state, history = ingest(docs, state, history, "1")
    assert n == 3 and history.filter("is_current").count() == 9 and {r.doc: r.status for r in state.collect()} == {"one": "success", "two": "success", "bad": "error"}
    n, state, history = ingest(docs, state, history, "2")
    assert n == 1 and history.filter("is_current").count() == 9 and {r.doc: r.last_seen_at for r in state.collect()}["one"] == "2"
    n, state, history = ingest(docs | {"two": XML}, state, history, "3")
    assert n == 2 and history.filter("is_current").count() == 8 and history.filter("doc = 'two' and not is_current").count() == 5 - 4 + 3

    blocks = history.filter("is_current and block_text like '%代謝%'").withColumn("analysis_hash", F.sha2("block_text", 256))
    cases = blocks.select("analysis_hash", F.col("block_text").alias("prompt"), F.to_json(F.struct("block_text")).alias("context"))
    answers = {"代謝": ["no", json.dumps({"facts": [FACT, FACT | {"note_text": ""}]}), json.dumps({"facts": [FACT]})]}
    todo = model_calls.pending(cases, spark.createDataFrame([], model_calls.RUN_SCHEMA), "m")
    judge = lambda a, c: validation.notes(a, DEFINITION, c["block_text"])
    model_calls.run_cases(todo, lambda: model_calls.ReplayClient(answers), "m", judge, partitions=1).write.parquet(f"{tmp_path}/runs")
    runs = spark.read.parquet(f"{tmp_path}/runs")
    assert [(r.status, r.attempts, len(json.loads(r.facts))) for r in runs.collect()] == [("success", 3, 1)]
    assert model_calls.pending(cases, runs, "m").count() == 0
    notes = incremental.rebuilt_facts(blocks.select("doc", "block_uid", "analysis_hash"), runs, "struct<relation_type:string,target_code:string,note_text:string,evidence_text:string>")
    assert sorted((r.doc, r.target_code) for r in notes.collect()) == [("one", "CYP3A4"), ("two", "CYP3A4")]


def test_review_status_keeps_valid_facts():
    out = model_calls.ask(model_calls.ReplayClient({"p": ['{"facts": [1, "x"]}']}), "p", lambda a: ([1], ["x is wrong"]), retries=1)
    assert (out["status"], out["facts"], out["attempts"]) == ("review", [1], 2)


def test_sentence_of_a_span():
    assert text.enclosing_sentence("甲。乙は\n丙。丁", "丙。") == "丙。" and text.enclosing_sentence("甲乙。丙", "甲") == "甲乙。"


def test_progress():
    assert [progress.eta(n, 100, 50) for n in (0, 1, 50, 100)] == ["?", "1h22m30s", "50s", "0s"]
    assert progress.run_time().endswith("+00:00")


def test_wrong_definitions():
    good = {"note_type": "a", "definition_version": "1", "allowed_relations": []}
    assert list(files.load_definitions([good])) == ["a"]
    for change in ({"note_type": ""}, {"definition_version": 1}, {"allowed_relations": None}, {"required_evidence_term_groups": ["x"]}, {"relation_targets": {"R": "QT"}}, {"max_note_percentages": "1"}):
        with pytest.raises(ValueError):
            files.load_definitions([good | change])
    with pytest.raises(ValueError):
        files.load_definitions([good, good])


def test_archives_and_bytes(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    with zipfile.ZipFile(tmp_path / "deep" / "er" / "one.Zip", "w") as z:
        z.writestr("b.xml", "\ufeff<b/>".encode())
        z.writestr("a.XML", b"<a>\xff</a>")
        z.writestr("note.txt", b"no")
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    rows = {r.path.rsplit("/", 1)[-1]: (r.text, r.error) for r in files.decoded(archives.read_archives(spark, str(tmp_path))).collect()}
    assert rows["one.Zip!b.xml"] == ("<b/>", None) and rows["one.Zip!a.XML"] == (None, "not UTF-8")
    assert rows["bad.zip"][0] is None and rows["bad.zip"][1] and len(rows) == 3


def test_files_that_keep_arriving(spark, tmp_path):
    source, seen = tmp_path / "in", []
    source.mkdir()
    (source / "a.xml").write_text("<a/>")
    handle = lambda batch, number: seen.extend(r.path.rsplit("/", 1)[-1] for r in files.decoded(batch).filter("error is null").collect())
    run = lambda: ingest(spark, str(source), str(tmp_path / "checkpoint"), handle).awaitTermination()
    run()
    (source / "b.xml").write_text("<b/>")
    run()
    run()
    assert seen == ["a.xml", "b.xml"]


def test_http_client():
    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            body = json.dumps({"response": " ", "message": {"content": f"{asked['model']} got {asked['prompt']}"}}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        assert model_calls.HttpClient(f"http://127.0.0.1:{server.server_port}/", "m", 5)("p") == "m got p"
    finally:
        server.shutdown()
