"""The format of package inserts: names of chapters and sections, and what rows are made of them (see one_pass.py)."""

from __future__ import annotations

from xml.etree import ElementTree

# Element names and chapter numbers of the document format.
CHAPTERS = {
    "Warnings": "1", "ContraIndications": "2", "CompositionAndProperty": "3", "IndicationsOrEfficacy": "4", "EfficacyRelatedPrecautions": "5", "InfoDoseAdmin": "6",
    "InfoPrecautionsDosage": "7", "ImportantPrecautions": "8", "UseInSpecificPopulations": "9", "Interactions": "10", "AdverseEvents": "11", "InfluenceOnLaboratoryValues": "12",
    "OverDosage": "13", "PrecautionsForApplication": "14", "OtherPrecautions": "15", "Pharmacokinetics": "16", "ResultsOfClinicalTrials": "17", "EfficacyPharmacology": "18",
    "PhyschemOfActIngredients": "19", "PrecautionsForHandling": "20", "ConditionsOfApproval": "21", "Package": "22", "MainLiterature": "23",
}
CHAPTER_16 = {
    "BloodLevel": "16.1", "Absorption": "16.2", "Distribution": "16.3", "Metabolism": "16.4", "Excretion": "16.5",
    "SpecificPopulation": "16.6", "DrugAndDrugInteractions": "16.7", "PharmacokineticsEtc": "16.8",
}
NOT_CHAPTERS = frozenset("PackageInsertNo CompanyIdentifier DateOfPreparationOrRevision Version JapaneseStandardCommodityClassificationNo TherapeuticClassification ApprovalEtc GenericName".split())
NOTE_CHAPTERS = frozenset(
    "Warnings ContraIndications ImportantPrecautions UseInSpecificPopulations AdverseEvents InfluenceOnLaboratoryValues OverDosage OtherPrecautions Pharmacokinetics ResultsOfClinicalTrials EfficacyPharmacology".split()
)
POPULATION_TAGS = {
    "PREGNANCY": ("9.5", frozenset({"UseInPregnant", "UseInPregnantWomen", "Pregnant", "PregnantWomen"})),
    "LACTATION": ("9.6", frozenset({"UseInNursing", "UseInNursingMothers", "Nursing", "BreastFeeding", "LactatingWomen"})),
}
LISTS = frozenset({"OrderedList", "UnorderedList", "SimpleList"})
LEAVES = frozenset({"Detail", "TblBlock", "Graphic", "Item"})
TABLES = frozenset({"TblBlock", "Graphic"})
CAPTIONS = frozenset({"Header", "TblCaption", "GraphicCaption"})
TITLES = frozenset({"Header", "Title"})
# End of fixed values.

CHUNK_SCHEMA = "section_code string, section_type string, section_order int, chunk_no int, char_start int, char_end int, block_text string, section_text string, section_xml string, known boolean"
POPULATION_SCHEMA = "population_type string, block_order int, section_type string, section_code string, heading_path string, block_text string, block_xml string"
NOTE_SCHEMA = "top_section_type string, section_type string, section_code string, heading_path string, block_type string, block_order int, block_text string, block_xml string"
LEGACY_SCHEMA = "pregnancy_text string, pregnancy_id string, lactation_text string, lactation_id string"


def as_xml(node) -> str:
    return ElementTree.tostring(node, encoding="unicode")
