"""Prompts as columns: what to extract, the allowed values, where the text stands, the answer's form, the text."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.plans.statements import CLASSES

#: Forms of answers: the field names are what the validators read.
NOTE_ANSWER = {"facts": [{"relation_type": "one of the relations", "subject_type": "DRUG", "target_code": None, "target_name": "", "polarity": "POSITIVE|NEGATIVE", "certainty": "EXPLICIT", "note_text": "short note", "details": {}, "evidence_text": "literal quotation"}]}
STATEMENT_ANSWER = {"classification_code": "one of the codes", "recommendation_target": None, "assessment_text": "short summary", "evidence_text": "the whole sentence"}
CHAPTER_ANSWER = {
    "facts": [
        {"feature_type": "", "target_name": "", "target_code": None, "relation_type": "", "strength": "", "polarity": "", "evidence_level": "", "assertion_type": "", "evidence_text": "literal quotation", "qualifiers": {}, "confidence": 0.0}
    ]
}
RULES = (
    "Use the text below only; add nothing from general knowledge.",
    "Quote evidence_text as one unbroken, unchanged part of the text.",
    "State one claim in each fact. A figure that several parts share is one fact, unless the text gives it to each.",
    "If the subject is not the product itself or is not clear, give no fact.",
)


def _prompt(parts: Sequence[tuple[str, Column | str | None]]) -> Column:
    """Titled parts one below the other; parts without text are left out."""
    columns = [F.lit(x) if isinstance(x, str) or x is None else x for _, x in parts]
    return F.concat_ws("\n\n", *(F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"[{title}]\n"), c)) for (title, _), c in zip(parts, columns)))


def _answer(form: Mapping[str, Any]) -> str:
    return "Give JSON of this form and nothing else:\n" + json.dumps(form, ensure_ascii=False, indent=1)


def note_prompt(definition: Mapping[str, Any], name: Column, section_code: Column, section_type: Column, heading_path: Column, text: Column) -> Column:
    """The prompt of one block for a note definition."""
    place = F.concat_ws("\n", F.concat(F.lit("section_code: "), section_code), F.concat(F.lit("section_type: "), section_type), F.concat(F.lit("heading_path: "), heading_path))
    return _prompt(
        [
            ("Task", "Extract facts that the text states outright.\n" + "\n".join(RULES)),
            ("Product", F.coalesce(name, F.lit("unknown"))),
            ("Theme", f"{definition['note_type']}: {definition.get('description', '')}"),
            ("Instructions", definition.get("instructions", "")),
            ("Relations", "|".join(definition["allowed_relations"])),
            ("Place", place),
            ("Answer", _answer(NOTE_ANSWER)),
            ("Text", text),
        ]
    )


def chapter_prompt(instructions: str, section_code: Column, section_type: Column, text: Column) -> Column:
    """The prompt of one chunk under fixed instructions."""
    return _prompt([("Task", instructions + "\n" + "\n".join(RULES)), ("Section", F.concat_ws(" ", section_code, section_type)), ("Answer", _answer(CHAPTER_ANSWER)), ("Text", text)])


def statement_prompt(population: Column, text: Column) -> Column:
    """The prompt of one statement that the rules leave open."""
    who = F.when(population == "PREGNANCY", "pregnant women").otherwise("breastfeeding women")
    return _prompt(
        [
            ("Task", "Classify the sentence. Use UNCLASSIFIABLE unless one code fits for certain.\n" + RULES[0]),
            ("Population", who),
            ("Codes", "|".join(CLASSES)),
            ("Targets", "DRUG, BREASTFEEDING or JSON null"),
            ("Answer", _answer(STATEMENT_ANSWER)),
            ("Sentence", text),
        ]
    )
