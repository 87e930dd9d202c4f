"""One parse for all kinds of rows: equal to kinds taken one by one, tree of one section, failed documents as a whole."""

import json
import random
import re
from collections import Counter
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from docloom.sources import one_pass as P
from docloom.sources.xml_tree import as_json

KINDS = {"brands": P.Brands, "interactions": lambda: P.Interactions({"ContraIndicatedCombinations": "併用禁忌", "PrecautionsForCombinations": "併用注意"}), "chunks": lambda: P.Chunks(40, 5), "populations": P.Populations, "notes": lambda: P.Notes(30), "legacy": P.Legacy}
BRANDED = """<?xml version="1.0" encoding="UTF-8"?><PackIns xmlns="u"><PackageInsertNo>12</PackageInsertNo><CompanyIdentifier> co </CompanyIdentifier><DateOfPreparationOrRevision><PreparationOrRevision><YearMonth>2024-05</YearMonth></PreparationOrRevision></DateOfPreparationOrRevision>
<GenericName><Detail><Lang xml:lang="en">x</Lang><Lang xml:lang="ja">一般</Lang></Detail></GenericName><TherapeuticClassification>plain</TherapeuticClassification>
<ApprovalEtc><DetailBrandName><BrandCode><YJCode>Y1</YJCode></BrandCode><ApprovalBrandName><Lang xml:lang="ja">甲<Sub>2</Sub></Lang></ApprovalBrandName><TrademarkInEnglish><TrademarkName>A</TrademarkName></TrademarkInEnglish></DetailBrandName><DetailBrandName><ApprovalAndLicenseNo><ApprovalNo>7</ApprovalNo></ApprovalAndLicenseNo><StartingDateOfMarketing>2001</StartingDateOfMarketing></DetailBrandName></ApprovalEtc>
<IndicationsOrEfficacy a="1">t<b/>tail</IndicationsOrEfficacy></PackIns>"""

COMBINED = """<r><Interactions><PrecautionsForCombinations><Drug><DrugName><Detail>類</Detail><SimpleList><Item>甲</Item><Item>乙</Item></SimpleList></DrugName><MechanismAndRiskFactors><Detail><Lang xml:lang="ja">機序</Lang></Detail></MechanismAndRiskFactors></Drug></PrecautionsForCombinations>
<ContraIndicatedCombinations><Drug><DrugName><Detail>乙類</Detail></DrugName><ClinSymptomsAndMeasures><Lang xml:lang="ja">症状</Lang></ClinSymptomsAndMeasures></Drug><Drug/></ContraIndicatedCombinations></Interactions></r>"""


def random_xml(r, depth=0):
    names = ["Pharmacokinetics", "BloodLevel", "UseInPregnant", "Nursing", "Warnings", "SimpleList", "Item", "Detail", "TblBlock", "Header", "Lang", "Interactions", "ContraIndicatedCombinations", "PrecautionsForCombinations", "Drug", "DrugName", "ClinSymptomsAndMeasures", "AdverseEvents", "ApprovalEtc", "DetailBrandName", "BrandCode", "YJCode"]
    name = r.choice(names)
    lang = r.choice(['', ' xml:lang="ja"', ' xml:lang="en"', ' id="i"'])
    inner = "".join(r.choice([f"文{r.randint(0, 99)}。", " ", "text; more ", random_xml(r, depth + 1) if depth < 6 else "x"]) for _ in range(r.randint(0, 5)))
    return f"<{name}{lang}>{inner}</{name}>"


def whole(text, make):
    """A kind by itself, all sections of a parsed tree."""
    c = make()
    for node in ElementTree.fromstring(text):
        c.section(node)
    return list(c.rows())


def test_all_kinds_at_once_equal_kinds_one_by_one(spark, tmp_path, monkeypatch):
    r = random.Random(11)
    docs = [(i, "<r>" + "".join(random_xml(r) for _ in range(r.randint(0, 12))) + "</r>") for i in range(150)] + [(900, BRANDED), (901, COMBINED)]
    bad = [(1000, "<r><Warnings>警告です。"), (1001, None), (1002, ""), (1003, "no"), (1004, "<r><Warnings><Detail>長い警告です。</Detail></Warnings>&nope;</r>")]
    monkeypatch.setattr(P, "FEED_CHARS", 37)
    rows, failed = P.document_rows(spark.createDataFrame(docs + bad, "doc long, xml string"), "doc", "xml", KINDS, f"{tmp_path}/out")
    total = 0
    for name, make in KINDS.items():
        got = sorted(json.dumps(x.asDict(), sort_keys=True, ensure_ascii=False) for x in rows[name].collect())
        assert got == sorted(json.dumps({"doc": i} | row, sort_keys=True, ensure_ascii=False) for i, t in docs for row in whole(t, make)), name
        total += len(got)
    assert total > 500 and sorted((x.doc, bool(x.error)) for x in failed.collect()) == [(i, True) for i, _ in bad]
    assert {p.name for p in (tmp_path / "out").iterdir() if "=" in p.name} == {f"kind={k}" for k in (*KINDS, "error")}


def test_raw_row_of_each_brand():
    rows = P.collected(BRANDED, [P.Brands()])[0]
    assert [(x["yj_code"], x["brand_name_ja"], x["trademark_en"], x["approval_no"], x["start_marketing"]) for x in rows] == [("Y1", "甲2", "A", None, None), ("", None, None, "7", "2001")]
    for x in rows:
        assert (x["package_insert_no"], x["company_identifier"], x["prepared_ym"], x["generic_name_ja"], x["therapeutic_class_ja"]) == ("12", "co", "2024-05", "一般", "plain")
        assert json.loads(x["indications_json"]) == {"tag": "{u}IndicationsOrEfficacy", "attr": {"a": "1"}, "text": "t", "children": [{"tag": "{u}b"}, {"tag": "__tail__", "text": "tail"}]} and x["property_json"] is None
    none = P.collected("<r><PackageInsertNo/></r>", [P.Brands()])[0]
    assert len(none) == 1 and none[0]["yj_code"] == "" and none[0]["package_insert_no"] == ""
    assert as_json(ElementTree.fromstring("<a/>"), sparse=True) == {"tag": "a"}


def test_tree_holds_one_section():
    sizes = []

    class Count(P.Collector):
        schema = "n int"

        def section(self, node):
            sizes.append(sum(1 for _ in node.iter()))

        def rows(self):
            return []

    text = "<r>" + "<s><a/><b/></s>" * 5000 + "</r>"
    P.collected(text, [Count()])
    assert sizes == [3] * 5000


def test_each_document_is_parsed_once(spark, tmp_path):
    """What reads a kind's rows reads that kind's files only."""
    docs = spark.createDataFrame([(1, BRANDED)], "doc long, xml string")
    rows, _ = P.document_rows(docs, "doc", "xml", KINDS, f"{tmp_path}/out")
    plan = rows["notes"].select(F.count("*"))._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "PartitionFilters: [isnotnull(kind" in plan
def test_one_kind_passes_through_with_the_fields_asked_for(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, COMBINED), (2, BRANDED), (3, "no")], "doc long, xml string")
    monkeypatch.setattr(P, "CHARS", 2)
    own = {"interactions": KINDS["interactions"]}
    rows, failed = P.document_rows(docs, "doc", "xml", own, None, {"interactions": ("position", "partner_name")})
    assert rows["interactions"].columns == ["doc", "position", "partner_name"] and [x.doc for x in failed.collect()] == [3]
    whole_rows = P.document_rows(docs, "doc", "xml", own, f"{tmp_path}/out")[0]["interactions"]
    assert sorted(map(tuple, rows["interactions"].collect())) == sorted(map(tuple, whole_rows.select("doc", "position", "partner_name").collect())) != []


def test_partners_are_lines_as_they_are(spark, tmp_path):
    """As the SQL says: lines without spaces at their ends, whatever they hold; none without lines; rows of one id are one document."""
    from docloom.plans import queries

    texts = [None, "", " \n\n ", "one\n\none \n two", "a  b\nc\td", "\tx\t", "\xa0y　", "ＡＢ ﬁ", "a\rb\r\nc", "\x00\x0bz\x1c", "￿", "%41\n %20\n%\x02", "<a>&amp;", "﻿y\x85"]
    sources = ["s", None, "", " s\t", "s\x01", "%73", "ﬁ", "<s>"]
    rows = [(i, t, "src1") for i, t in enumerate(texts)] + [(100 + i, t, s) for i, s in enumerate([*sources, *sources]) for t in ["l\n\nm" if i < len(sources) else None]]

    def of(rows):
        least: dict = {}
        for i, text, source in rows:
            for n, line in enumerate(re.split("\n+", text) if text is not None else []):
                if s := line.strip(" \n"):
                    least[i, source, s] = min(n, least.get((i, source, s), n))
        out: dict = {}
        for (i, source, s), _ in sorted(least.items(), key=lambda x: x[1]):
            out.setdefault(i, []).append((source, s))
        return Counter((i, p, "with care", *x) for i, own in out.items() for p, x in enumerate(own))

    for name, own in (("each", [*rows, (None, "n\nm", "src2")]), ("again", [*rows, rows[3], rows[4], (9, "\n\n\nlast", "src1")])):
        spark.createDataFrame(own, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = queries.QUERIES["interaction_partners"](spark, f"{tmp_path}/{name}")
        assert got.columns == ["doc_id", "position", "category", "partner_group", "partner_name"] and Counter(map(tuple, got.collect())) == of(own), name


def test_a_task_short_of_memory_fails_and_loses_no_document(spark):
    class Short(P.Collector):
        schema = "n int"

        def section(self, node):
            raise MemoryError

    rows, _ = P.document_rows(spark.createDataFrame([(1, BRANDED)], "doc long, xml string"), "doc", "xml", {"short": Short}, None)
    with pytest.raises(Exception, match="MemoryError"):
        rows["short"].collect()
