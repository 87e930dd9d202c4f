"""Ordered rule tables as columns: the first rule that matches decides."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.patterns import linear
from docloom.functions.terms import present_terms


@dataclass(frozen=True)
class Rule:
    """pattern: a Java regular expression; values: what the rule says, by output field."""

    pattern: str
    values: dict[str, object]


def classify(text: Column, rules: Sequence[Rule], default: dict[str, object], exclude: str | None = None) -> Column:
    """A struct of the fields of the first rule that text matches. Excluded and blank texts get the default.

    Patterns with gaps are tried in one pass over the text (see patterns.linear()).
    """
    out = None
    fields = list(default)
    as_struct = lambda v: F.struct(*(F.lit(v.get(f, default[f])).alias(f) for f in fields))
    if exclude:
        out = F.when(text.rlike(linear(exclude)), as_struct(default))
    for rule in rules:
        hit = text.rlike(linear(rule.pattern))
        out = F.when(hit, as_struct(rule.values)) if out is None else out.when(hit, as_struct(rule.values))
    return as_struct(default) if out is None else out.otherwise(as_struct(default))


def flags(text: Column, patterns: dict[str, str]) -> Column:
    """A map of which patterns match; empty for a blank text."""
    known = F.create_map(*(x for name, p in patterns.items() for x in (F.lit(name), text.rlike(linear(p)))))
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<boolean>"))).otherwise(known)


def label(code: Column, names: dict, default: str) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[code], F.lit(default))


def _matched(has: Callable[[Sequence[str]], Column], terms: Sequence[str], required: Sequence[Sequence[str]]) -> Column:
    """The terms present, or null unless one is and every required group has one. has: distinct ones of some words, sorted."""
    matched = has(terms)
    ok = F.size(matched) > 0
    for group in required:
        ok = ok & (F.size(has(group)) > 0)
    return F.when(ok, matched)


def keyword_candidates(text: Column, terms: Sequence[str], required: Sequence[Sequence[str]] = ()) -> Column:
    """Sorted distinct terms in the lower-cased text, or null unless one is and every required group has one."""
    low = F.lower(text)
    has = lambda words: F.array_sort(F.array_distinct(F.filter(F.array(*(F.lit(w.lower()) for w in words)), lambda w: F.contains(low, w))))
    return _matched(has, terms, required)


def _candidate(definition: dict, terms: Column, top_section: Column, section: Column, block_type: Column) -> Column:
    among = lambda c, key: c.isin(*definition[key]) if definition.get(key) else F.lit(True)
    excluded = section.isin(*definition["excluded_sections"]) if definition.get("excluded_sections") else F.lit(False)
    ok = among(top_section, "allowed_top_sections") & among(section, "allowed_sections") & among(block_type, "allowed_block_types") & ~F.coalesce(excluded, F.lit(False)) & terms.isNotNull()
    preferred = section.isin(*definition["preferred_sections"]) if definition.get("preferred_sections") else F.lit(False)
    reasons = F.when(F.coalesce(preferred, F.lit(False)), F.array(F.lit("keyword"), F.lit("preferred_section"))).otherwise(F.array(F.lit("keyword")))
    return F.when(ok, F.struct(terms.alias("terms"), reasons.alias("reasons")))


def definition_candidates(definition: dict, text: Column, top_section: Column, section: Column, block_type: Column) -> Column:
    """A struct (terms, reasons) if a block is a candidate for a note definition, else null.

    Lists of sections and block types that are empty or missing allow all. text is
    expected in normal form.
    """
    terms = keyword_candidates(text, definition.get("candidate_terms", []), definition.get("candidate_required_term_groups", []))
    return _candidate(definition, terms, top_section, section, block_type)


def candidates_of_all(blocks: DataFrame, definitions: Sequence[dict], text: Column, top_section: Column, section: Column, block_type: Column) -> DataFrame:
    """definition_candidates() for many definitions: a row for each block and definition it is a candidate for.

    blocks' columns, then note_type, terms and reasons. An automaton over the terms of all
    definitions searches each text once, whatever their number.
    """
    groups = lambda d: [d.get("candidate_terms", []), *d.get("candidate_required_term_groups", [])]
    words = sorted({w.lower() for d in definitions for g in groups(d) for w in g} - {""})
    number = {w: i for i, w in enumerate(words)}
    found, all_words = F.col("__present"), F.array(*(F.lit(w) for w in words)).cast("array<string>")

    def has(some: Sequence[str]) -> Column:
        own = F.array(*(F.lit(n) for n in sorted({number[w.lower()] for w in some if w}))).cast("array<int>")
        present = F.transform(F.array_intersect(found, own), lambda i: F.get(all_words, i))
        return F.array_sort(F.concat(present, F.array(F.lit("")))) if "" in some else F.array_sort(present)

    told = []
    for d in definitions:
        one = _candidate(d, _matched(has, *(groups(d)[:1]), groups(d)[1:]), top_section, section, block_type)
        told.append(F.when(one.isNotNull(), F.struct(F.lit(d["note_type"]).alias("note_type"), one["terms"].alias("terms"), one["reasons"].alias("reasons"))))
    searched = blocks.withColumn("__present", present_terms(blocks.sparkSession, F.lower(text), words))
    return searched.select(*(F.col(f"`{c}`") for c in blocks.columns), F.explode(F.array_compact(F.array(*told))).alias("__c")).select(*(F.col(f"`{c}`") for c in blocks.columns), "__c.*")
