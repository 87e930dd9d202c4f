"""What applications read: published notes, statements and summaries in display order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.filters import where_given

#: Display order of notes and colours; others come last.
NOTE_ORDER = ("QT_EFFECT", "ORGAN_IMPAIRMENT", "METABOLISM_TRANSPORT", "EXCRETION_ELIMINATION")
COLOURS = ("RED", "YELLOW", "BLUE")
POPULATIONS = ("PREGNANCY", "LACTATION")


def place(column: str, order: Sequence[str]) -> Column:
    """1 for the first of the order and so on; what isn't in it, or null, comes after all."""
    at = F.array_position(F.array(*(F.lit(x) for x in order)), F.col(column))
    return F.when(at > 0, at).otherwise(len(order) + 1)


def notes_of(notes: DataFrame, insert: str) -> DataFrame:
    """All current notes of one insert, by kind, relation, target (none last) and id."""
    own = where_given(notes.filter("is_current"), {"package_insert_no": insert})
    return own.orderBy(place("note_type", NOTE_ORDER), "relation_type", F.col("target_code").asc_nulls_last(), "note_id")


def notes_of_list(notes: DataFrame, inserts: Sequence[str]) -> DataFrame:
    own = where_given(notes.filter("is_current"), {"package_insert_no": list(inserts)})
    return own.orderBy("package_insert_no", "note_type", "relation_type", F.col("target_code").asc_nulls_last())


def notes_by_target(notes: DataFrame, note_type: str, targets: Sequence[str]) -> DataFrame:
    own = where_given(notes.filter("is_current"), {"note_type": note_type, "target_code": list(targets)})
    return own.orderBy("generic_name", "relation_type")


def relation_flags(notes: DataFrame, note_type: str, relations: dict[str, str], inserts: Sequence[str] | None = None) -> DataFrame:
    """For each insert whether it has a current note of each relation; relations: output column -> relation."""
    own = where_given(notes.filter("is_current"), {"note_type": note_type, "package_insert_no": None if inserts is None else list(inserts)})
    return own.groupBy("package_insert_no", "generic_name").agg(*(F.bool_or(F.col("relation_type") == r).alias(c) for c, r in relations.items()))


def notes_as_json(notes: DataFrame, fields: dict[str, str], order: Sequence[str] = ("note_type", "relation_type", "note_id"), inserts: Sequence[str] | None = None) -> DataFrame:
    """(package_insert_no, notes): one JSON array of objects for each insert, in order; fields: JSON name -> column. Nulls stay."""
    own = where_given(notes.filter("is_current"), {"package_insert_no": None if inserts is None else list(inserts)})
    item = F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(order)), F.struct(*(F.col(c).alias(n) for n, c in fields.items())).alias("note"))
    listed = own.groupBy("package_insert_no").agg(F.array_sort(F.collect_list(item)).alias("all"))
    return listed.select("package_insert_no", F.to_json(F.transform("all", lambda x: x["note"]), {"ignoreNullFields": "false"}).alias("notes"))


def note_counts(notes: DataFrame, keys: Sequence[str] = ("note_type",)) -> DataFrame:
    """Current facts and inserts by any keys: the kind, or the kind, model and review status."""
    return notes.filter("is_current").groupBy(*keys).agg(F.count("*").alias("facts"), F.countDistinct("package_insert_no").alias("packages"))


def invalid_rows(notes: DataFrame, statuses: Sequence[str] = ("AUTO_VALIDATED", "HUMAN_REVIEWED")) -> DataFrame:
    """How many current rows lack a text or evidence, or have another status; 0 is right."""
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c)) == "")
    return notes.filter(F.col("is_current") & (blank("note_text") | blank("evidence_text") | ~F.col("review_status").isin(*statuses))).agg(F.count("*").alias("invalid_rows"))


def summaries_of(summaries: DataFrame, insert: str) -> DataFrame:
    return where_given(summaries, {"package_insert_no": insert}).orderBy(place("population_type", POPULATIONS))


def summary_reasons(summaries: DataFrame, statements: DataFrame, insert: str | None = None) -> DataFrame:
    """Summaries with the current statement that is their reason; retired reasons leave nulls."""
    reason = statements.filter("is_current").select(F.col("statement_id").alias("reason_statement_id"), F.col("evidence_text").alias("reason_evidence_text"))
    return where_given(summaries, {"package_insert_no": insert}).join(reason, "reason_statement_id", "left").orderBy("population_type")


def statements_of(statements: DataFrame, insert: str, population: str) -> DataFrame:
    """All current statements of one insert and population, by colour (none last), block and id."""
    own = where_given(statements.filter("is_current"), {"package_insert_no": insert, "population_type": population})
    return own.orderBy(place("display_level", COLOURS), "source_block_id", "statement_id")


def summaries_of_list(summaries: DataFrame, inserts: Sequence[str]) -> DataFrame:
    return where_given(summaries, {"package_insert_no": list(inserts)}).orderBy(place("display_level", COLOURS), "package_insert_no", "population_type")


def unclassified(statements: DataFrame, inserts: Sequence[str]) -> DataFrame:
    own = where_given(statements.filter("is_current"), {"classification_code": "UNCLASSIFIABLE", "package_insert_no": list(inserts)})
    return own.orderBy("package_insert_no", "population_type", "statement_id")


def summary_counts(summaries: DataFrame) -> DataFrame:
    keys = ["population_type", "assessment_code", "display_level", "needs_review"]
    return summaries.groupBy(*keys).agg(F.count("*").alias("summaries")).orderBy("population_type", "display_level", "assessment_code")
