"""Each document parsed once, whatever kinds of rows are taken from it, holding one of its sections at a time.

A pull parser gives each child of the root as soon as it ends; collectors take their rows from it, and it goes. Rows of
all kinds leave the task as one tagged union, are written once, partitioned by kind, and read back kind by kind: another
kind neither parses again nor reads the others' files. A document that can't be read to its end counts as failed as a
whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from docloom._ship import ensure_importable
from docloom.functions.text import chunks, loose_text
from docloom.sources import sections as S
from docloom.sources.xml_tree import LANG, as_json, best_text, direct_text, heading, local, subtree_text, units

#: A task hands on so many rows at once, or fewer of so many characters together.
FEED_CHARS, ROWS, CHARS = 1 << 16, 1000, 4 << 20


class Collector:
    """Rows of one kind. section() gets each child of the root in order; rows() is asked for when the document has ended."""

    schema: str

    def section(self, node: ElementTree.Element) -> None:
        raise NotImplementedError

    def rows(self) -> Iterable[dict]:
        raise NotImplementedError


def collected(text: str, collectors: list[Collector]) -> list[list[dict]]:
    """The rows of each collector. The tree never holds more than the section that is being read."""
    parser = ElementTree.XMLPullParser(("start", "end"))
    depth, root = 0, None

    def drain() -> None:
        nonlocal depth, root
        for event, node in parser.read_events():
            if event == "start":
                depth += 1
                root = node if root is None else root
            else:
                depth -= 1
                if depth == 1:
                    for c in collectors:
                        c.section(node)
                    root.remove(node)

    for at in range(0, len(text), FEED_CHARS):
        parser.feed(text[at : at + FEED_CHARS])
        drain()
    parser.close()
    drain()
    return [list(c.rows()) for c in collectors]


class Brands(Collector):
    """One raw row for each brand of the approval section, or one with an empty code; what is the document's stands in each.

    Fields by path below a section (or below a brand), in the names of the raw table; whole sections as JSON.
    """

    # Names of columns, elements and categories.
    DOCUMENT = {
        "package_insert_no": ("PackageInsertNo", "", "direct"), "company_identifier": ("CompanyIdentifier", "", "direct"),
        "prepared_ym": ("DateOfPreparationOrRevision", "PreparationOrRevision/YearMonth", "direct"),
        "generic_name_ja": ("GenericName", "Detail", "best"), "therapeutic_class_ja": ("TherapeuticClassification", "Detail", "best"),
    }
    BRAND = {
        "yj_code": ("BrandCode/YJCode", "direct"), "brand_name_ja": ("ApprovalBrandName", "best"), "brand_name_hiragana": ("BrandNameInHiragana/NameInHiragana", "direct"),
        "trademark_en": ("TrademarkInEnglish/TrademarkName", "direct"), "standard_name_ja": ("StandardName/StandardNameCategory/StandardNameDetail", "best"),
        "approval_no": ("ApprovalAndLicenseNo/ApprovalNo", "direct"), "start_marketing": ("StartingDateOfMarketing", "direct"),
    }
    JSON = {
        "approval_etc_json": "ApprovalEtc", "indications_json": "IndicationsOrEfficacy", "info_dose_admin_json": "InfoDoseAdmin", "interactions_json": "Interactions",
        "adverse_reactions_json": "AdverseReactions", "composition_json": "Composition", "property_json": "Properties",
    }
    # End of fixed values.
    schema = "package_insert_no string, company_identifier string, prepared_ym string, generic_name_ja string, therapeutic_class_ja string, yj_code string, brand_name_ja string, brand_name_hiragana string, trademark_en string, standard_name_ja string, approval_no string, start_marketing string, approval_etc_json string, indications_json string, info_dose_admin_json string, interactions_json string, adverse_reactions_json string, composition_json string, property_json string"

    def __init__(self) -> None:
        self.seen: set[str] = set()
        self.own: dict[str, str | None] = {}
        self.brands: list[dict] = []

    @staticmethod
    def _text(node: ElementTree.Element, path: str, how: str) -> str | None:
        target = node
        for name in path.split("/") if path else []:
            target = next((c for c in target if local(c.tag) == name), None) if target is not None else None
        found = best_text(target) if how == "best" and target is not None else direct_text(target, "") if target is not None else None
        return found or (direct_text(node, "") if how == "best" and path == "Detail" else None)

    def section(self, node: ElementTree.Element) -> None:
        name = local(node.tag)
        first = name not in self.seen
        self.seen.add(name)
        if first:
            self.own |= {f: self._text(node, path, how) for f, (section, path, how) in self.DOCUMENT.items() if section == name}
            self.own |= {f: json.dumps(as_json(node, sparse=True), ensure_ascii=False) for f, section in self.JSON.items() if section == name}
        if name == "ApprovalEtc":
            self.brands += [{f: self._text(b, path, how) for f, (path, how) in self.BRAND.items()} for b in node if local(b.tag) == "DetailBrandName"]

    def rows(self) -> Iterator[dict]:
        own = {f: self.own.get(f) for f in (*self.DOCUMENT, *self.JSON)}
        own["package_insert_no"] = own["package_insert_no"] or ""
        for brand in self.brands or [dict.fromkeys(self.BRAND)]:
            yield own | brand | {"yj_code": brand["yj_code"] or ""}


def item_text(node: ElementTree.Element) -> str | None:
    return best_text(node) or subtree_text(node)


class Interactions(Collector):
    """Partners of each Drug under the sections of categories, in the order of categories: its items, else its class label, else nothing.

    item, label: how the texts of an Item and of a class label are read. place: which of
    the label's items it is, with empty and repeated ones counted.
    """

    schema = "position int, place int, category string, partner_group string, partner_name string, symptoms string, mechanism string"

    def __init__(self, categories: dict[str, str], item: Callable[[ElementTree.Element], str | None] = item_text, label: Callable[[ElementTree.Element | None], str | None] = best_text) -> None:
        self.categories, self.item, self.label = categories, item, label
        self.found: dict[str, list[dict]] = {s: [] for s in categories}

    def section(self, node: ElementTree.Element) -> None:
        for part in node.iter():
            if local(part.tag) in self.found:
                for drug in part.iter():
                    if local(drug.tag) == "Drug":
                        self.found[local(part.tag)] += self._partners(drug, self.categories[local(part.tag)])

    def _partners(self, drug: ElementTree.Element, category: str) -> Iterator[dict]:
        child = lambda node, name: next((c for c in node if local(c.tag) == name), None) if node is not None else None
        name = child(drug, "DrugName")
        group = self.label(child(name, "Detail"))
        items: dict[str | None, int | None] = {}
        for place, node in enumerate((n for n in (name.iter() if name is not None else ()) if local(n.tag) == "Item"), 1):
            if body := self.item(node):
                items.setdefault(body, place)
        for partner, place in (items or ({None: None} if group else {})).items():
            yield {"place": place, "category": category, "partner_group": group, "partner_name": partner, "symptoms": best_text(child(drug, "ClinSymptomsAndMeasures")), "mechanism": best_text(child(drug, "MechanismAndRiskFactors"))}

    def rows(self) -> Iterator[dict]:
        for i, row in enumerate(r for rows in self.found.values() for r in rows):
            yield {"position": i, **row}


class Chunks(Collector):
    """Overlapping chunks of each part of a chapter, of which the document's first counts. An unknown part gets the code 16.? and known = false; its XML goes with chunk 1."""

    schema = S.CHUNK_SCHEMA

    def __init__(self, size: int = 4000, overlap: int = 200, chapter: str = "Pharmacokinetics") -> None:
        self.size, self.overlap, self.chapter, self.found = size, overlap, chapter, None

    def section(self, node: ElementTree.Element) -> None:
        chapter = next((n for n in node.iter() if local(n.tag) == self.chapter), None) if self.found is None else None
        if chapter is not None:
            self.found = list(self._chunks(chapter))

    def _chunks(self, chapter: ElementTree.Element) -> Iterator[dict]:
        for order, part in enumerate(chapter, 1):
            name, body = local(part.tag), subtree_text(part)
            for number, (start, end, piece) in enumerate(chunks(body, self.size, self.overlap), 1):
                yield {
                    "section_code": S.CHAPTER_16.get(name, "16.?"), "section_type": name, "section_order": order, "chunk_no": number, "char_start": start, "char_end": end,
                    "block_text": piece, "section_text": body, "section_xml": S.as_xml(part) if number == 1 else None, "known": name in S.CHAPTER_16,
                }

    def rows(self) -> Iterable[dict]:
        return self.found or []


class Populations(Collector):
    """Sections on each population wherever they stand, nested ones too; empty ones don't count in the order."""

    schema = S.POPULATION_SCHEMA

    def __init__(self) -> None:
        self.found: dict[str, list[dict]] = {p: [] for p in S.POPULATION_TAGS}

    def section(self, node: ElementTree.Element) -> None:
        for part in node.iter():
            for population, (code, tags) in S.POPULATION_TAGS.items():
                if local(part.tag) in tags and (body := subtree_text(part)):
                    own = self.found[population]
                    own.append({"population_type": population, "block_order": len(own) + 1, "section_type": local(part.tag), "section_code": code, "heading_path": heading(part, S.TITLES), "block_text": body, "block_xml": S.as_xml(part)})

    def rows(self) -> Iterator[dict]:
        for own in self.found.values():
            yield from own


class Notes(Collector):
    """Semantic blocks of the chapters asked for, in document order, with heading paths; long ones in parts.

    The chapter on pharmacokinetics is taken by subsection (code 16 if unknown) and
    without tables. Units of less than four characters go; the XML goes with part 1.
    """

    schema = S.NOTE_SCHEMA

    def __init__(self, size: int = 3000, chapters: frozenset[str] = S.NOTE_CHAPTERS) -> None:
        self.size, self.chapters, self.found = size, chapters, []

    def section(self, node: ElementTree.Element) -> None:
        top = local(node.tag)
        if top in S.NOT_CHAPTERS or top not in self.chapters:
            return
        split = top == "Pharmacokinetics" and len(node) > 0
        for part, name, code in [(s, local(s.tag), S.CHAPTER_16.get(local(s.tag), "16")) for s in node] if split else [(node, top, S.CHAPTERS.get(top))]:
            for unit in units(part, S.LISTS, S.LEAVES):
                hidden = S.TABLES if top == "Pharmacokinetics" else frozenset()
                body = "" if local(unit.tag) in hidden else subtree_text(unit, hidden)
                if len(body) < 4:
                    continue
                path = " > ".join(x for x in (top, name if name != top else None, heading(unit, S.CAPTIONS)) if x)
                pieces = [body] if len(body) <= self.size else [p for _, _, p in chunks(body, self.size, 0, "。\n；; ")]
                for number, piece in enumerate(pieces, 1):
                    self.found.append(
                        {
                            "top_section_type": top, "section_type": name, "section_code": code, "heading_path": path + (f" > part {number}" if len(body) > self.size else ""),
                            "block_type": local(unit.tag), "block_order": len(self.found) + 1, "block_text": piece, "block_xml": S.as_xml(unit) if number == 1 else None,
                        }
                    )

    def rows(self) -> Iterable[dict]:
        return self.found


class Legacy(Collector):
    """One row of both populations' texts and ids: language texts, Japanese first, each once; else the whole text of the first section."""

    schema = S.LEGACY_SCHEMA

    def __init__(self) -> None:
        self.hits = {p: 0 for p in S.POPULATION_TAGS}
        self.ids: dict[str, str | None] = dict.fromkeys(S.POPULATION_TAGS)
        self.whole: dict[str, str] = {}
        self.groups: dict[str, dict[bool, dict[str, None]]] = {p: {True: {}, False: {}} for p in S.POPULATION_TAGS}

    def section(self, node: ElementTree.Element) -> None:
        for part in node.iter():
            for population, (_, tags) in S.POPULATION_TAGS.items():
                if local(part.tag) not in tags:
                    continue
                if not self.hits[population]:
                    self.ids[population], self.whole[population] = part.get("id"), loose_text("".join(part.itertext()))
                self.hits[population] += 1
                for lang in part.iter():
                    if local(lang.tag) == "Lang" and (body := loose_text("".join(lang.itertext()))):
                        self.groups[population][(lang.get(LANG) or lang.get("lang") or "").lower().startswith("ja")][body] = None

    def rows(self) -> Iterator[dict]:
        text = lambda p: "\n\n".join([*self.groups[p][True], *self.groups[p][False]]) or self.whole[p] if self.hits[p] else None
        yield {f"{p.lower()}_{f}": v for p in S.POPULATION_TAGS for f, v in (("text", text(p)), ("id", self.ids[p]))}


def document_rows(df: DataFrame, id_col: str, text_col: str, kinds: dict[str, Callable[[], Collector]], folder: str | None, fields: dict[str, Sequence[str]] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The rows of each kind, with the document's id first, and (id, error) of documents that failed.

    All are written to folder by this call. Without a folder nothing is written, and each
    frame that is used parses for itself: for a single kind whose failures aren't asked
    for. fields: the columns of a kind that are wanted, where not all are; the others don't
    leave the task. A null text is an empty one, which isn't XML.
    """
    spark = df.sparkSession
    ensure_importable(spark)
    id_type = df.schema[id_col].dataType
    schemas = {name: StructType.fromDDL(make().schema) for name, make in kinds.items()}
    for name, own in (fields or {}).items():
        schemas[name] = StructType([schemas[name][f] for f in own])
    if {"error", "kind", "id"} & set(kinds):
        raise ValueError("a kind can't be called error, kind or id")
    types = {"id": to_arrow_type(id_type), "kind": pa.string(), "error": pa.string()} | {name: to_arrow_type(s) for name, s in schemas.items()}

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], type=t) for c, t in types.items()], list(types))

    names = {name: schema.names for name, schema in schemas.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        held = 0
        for b in batches:
            for i, text in zip(b.column(0), b.column(1), strict=True):
                own = {"id": i.as_py()}
                try:
                    found = collected(text.as_py() or "", [make() for make in kinds.values()])
                    new = [own | {"kind": name, name: row} for name, rows in zip(kinds, found, strict=True) for row in rows]
                except MemoryError:  # the task is short of memory and fails; the document isn't bad
                    raise
                except Exception as e:  # noqa: BLE001  a bad document is quarantined, not the job
                    new = [own | {"kind": "error", "error": f"{type(e).__name__}: {e}"[:2000]}]
                for row in new:
                    out.append(row)
                    held += sum(len(v) for f in names.get(row["kind"], ()) if isinstance(v := row[row["kind"]].get(f), str))
                    if len(out) >= ROWS or held >= CHARS:
                        yield batch(out)
                        out, held = [], 0
        if out:
            yield batch(out)

    ddl = f"id {id_type.simpleString()}, kind string, error string, " + ", ".join(f"`{n}` {s.simpleString()}" for n, s in schemas.items())
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, ddl)
    table = rows
    if folder is not None:
        rows.write.partitionBy("kind").option("compression", "zstd").parquet(folder)
        table = spark.read.schema(f"{ddl.replace('kind string, ', '')}, kind string").parquet(folder)
    good = {n: table.filter(F.col("kind") == n).select(F.col("id").alias(id_col), F.col(f"`{n}`.*")) for n in kinds}
    return good, table.filter(F.col("kind") == "error").select(F.col("id").alias(id_col), "error")
