"""Statements on two populations (pregnancy, lactation): rule tables, support checks, publication, summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.functions.hashing import stable_hash
from docloom.functions.rules import Rule, classify
from docloom.functions.text import normalise_nfkc, sentences
from docloom.operators.ranking import distinct_on, preference_rank, priority_rank

# Codes, texts, priorities and patterns, which published tables depend on.
CLASSES = {
    "CONTRAINDICATED": ("RED", "投与禁忌", 100),
    "AVOID": ("RED", "投与又は授乳を避ける", 90),
    "STOP_BREASTFEEDING": ("RED", "授乳を中止する", 90),
    "PREFER_AVOID": ("YELLOW", "投与しないことが望ましい", 70),
    "BENEFIT_RISK": ("YELLOW", "有益性が危険性を上回る場合のみ", 60),
    "CONSIDER_CONTINUE_OR_STOP": ("YELLOW", "授乳の継続又は中止を検討", 50),
    "UNCLASSIFIABLE": ("YELLOW", "判定不能・要確認", 40),
    "ACCEPTABLE": ("BLUE", "明示的に使用可能", 20),
}
PREGNANCY = [
    ("CONTRAINDICATED", "DRUG", "禁忌|投与してはならない|使用してはならない"),
    ("PREFER_AVOID", "DRUG", "(?:投与|使用)(?:を)?しないことが望ましい|(?:投与|使用)を避けることが望ましい"),
    ("AVOID", "DRUG", "(?:投与|使用)(?:を)?しないこと(?!が望ましい)|(?:投与|使用)せず|(?:投与|使用)を避けること(?!が望ましい)|原則として?(?:投与|使用)(?:を)?しない"),
    ("BENEFIT_RISK", "DRUG", "(?:有益性|ベネフィット|利益).*(?:危険性|リスク).*(?:上回|上まわ|上廻)"),
    ("ACCEPTABLE", "DRUG", "投与して差し支えない|使用して差し支えない|投与可能である|使用可能である"),
]
LACTATION = [
    ("CONTRAINDICATED", "DRUG", "授乳婦.{0,30}(?:禁忌|投与してはならない|使用してはならない)"),
    ("CONSIDER_CONTINUE_OR_STOP", "BREASTFEEDING", "授乳.{0,30}(?:継続|続行).{0,30}(?:中止|中断).{0,20}(?:検討|考慮)|(?:有益性|ベネフィット).{0,50}授乳.{0,30}(?:継続|中止)"),
    ("STOP_BREASTFEEDING", "BREASTFEEDING", "授乳.{0,20}(?:中止|中断)|断乳|母乳栄養.{0,20}(?:中止|中断)"),
    ("PREFER_AVOID", "DRUG", "(?:授乳婦|授乳中の(?:患者|女性|婦人)).{0,30}(?:(?:投与|使用)(?:を)?しないこと|(?:投与|使用)を避けること)が望ましい"),
    ("PREFER_AVOID", "BREASTFEEDING", "(?:授乳(?:を)?しない|母乳を与えない)ことが望ましい|授乳を避け(?:させ)?ることが望ましい"),
    ("AVOID", "DRUG", "(?:授乳婦|授乳中の(?:患者|女性|婦人)).{0,30}(?:投与|使用)(?:を)?しないこと(?!が望ましい)"),
    ("AVOID", "BREASTFEEDING", "授乳.{0,20}(?:避け|しないこと)|授乳をさせない|母乳を与えないこと"),
    ("BENEFIT_RISK", "DRUG", "(?:有益性|ベネフィット|利益).*(?:危険性|リスク).*(?:上回|上まわ|上廻)"),
    ("ACCEPTABLE", "BREASTFEEDING", "授乳を継続できる|授乳して差し支えない|母乳栄養を継続できる"),
]
CUE = "禁忌|投与|使用|避け|望ましい|有益性|ベネフィット|危険性|リスク|授乳.{0,30}(?:中止|中断|継続|検討|考慮|させない)|断乳"
EXPRESSIONS = [
    ("MILK_TRANSFER", "乳汁|母乳"),
    ("INFANT_EFFECT", "乳児|新生児|出生児"),
    ("ANIMAL_FINDING", "動物|ラット|マウス|ウサギ|サル|胎仔|胎児毒性|催奇形"),
    ("PLACENTAL_TRANSFER", "胎盤.{0,20}(?:通過|移行)"),
    ("HUMAN_FINDING", "妊婦|妊娠女性|ヒト"),
]
EXCLUDED = "HMG-CoA還元酵素阻害剤.{0,100}禁忌.{0,100}本剤との併用投与"
SUPPORT = {
    "CONTRAINDICATED": "禁忌|禁止|してはならない",
    "AVOID": "避け|回避|控え|しないこと|せず",
    "STOP_BREASTFEEDING": "授乳.{0,30}(?:中止|中断)|断乳|母乳.{0,30}(?:中止|中断)",
    "PREFER_AVOID": "望ましい|極力|可能な限り",
    "BENEFIT_RISK": "有益性|ベネフィット|利益|必要性",
    "CONSIDER_CONTINUE_OR_STOP": "授乳.{0,40}(?:継続|中止|中断).{0,30}(?:検討|考慮)|(?:継続|中止).{0,30}(?:検討|考慮)",
    "ACCEPTABLE": "差し支えない|可能|継続できる|影響しない",
}
LACTATION_ONLY = ("STOP_BREASTFEEDING", "CONSIDER_CONTINUE_OR_STOP")
NOT_STATED = {"SECTION_ABSENT": ("GRAY", "関連記載なし"), "NO_EXPLICIT_RECOMMENDATION": ("GRAY", "明確な推奨記載なし")}
# End of fixed values.

@dataclass(frozen=True)
class RuleSet:
    """What tells a statement's code. ordered: (code, target, pattern) by population; others are patterns of Java without case."""

    ordered: dict[str, Sequence[tuple[str, str, str]]]
    cue: str
    expressions: Sequence[tuple[str, str]]
    excluded: str
    support: dict[str, str]
    lactation_only: tuple[str, ...] = LACTATION_ONLY


#: The rules of the published tables; other collections bring their own.
PUBLISHED_RULES = RuleSet({"PREGNANCY": PREGNANCY, "LACTATION": LACTATION}, CUE, EXPRESSIONS, EXCLUDED, SUPPORT)

_FIELDS = {"expression_type": "OTHER_INFORMATION", "classification_code": None, "recommendation_target": None, "requires_llm": False}


def _any_case(pattern: str) -> str:
    return f"(?isu){pattern}"


def _table(rules: RuleSet, population: str) -> list[Rule]:
    told = [Rule(_any_case(p), {"expression_type": "RECOMMENDATION", "classification_code": code, "recommendation_target": target}) for code, target, p in rules.ordered[population]]
    unclear = Rule(_any_case(rules.cue), {"expression_type": "RECOMMENDATION", "classification_code": "UNCLASSIFIABLE", "requires_llm": True})
    return [*told, unclear, *(Rule(_any_case(p), {"expression_type": kind}) for kind, p in rules.expressions)]


def classified(population: Column, text: Column, rules: RuleSet = PUBLISHED_RULES) -> Column:
    """A struct of expression_type, classification_code, recommendation_target and requires_llm of one statement.

    The first match decides: what is excluded, the population's rules, a cue without a rule
    (for the model), kinds of findings. Texts are expected in normal form (NFKC). Any
    population but PREGNANCY has the rules of LACTATION.
    """
    by = {name: classify(text, _table(rules, name), _FIELDS, exclude=_any_case(rules.excluded)) for name in ("PREGNANCY", "LACTATION")}
    return F.when(population == "PREGNANCY", by["PREGNANCY"]).otherwise(by["LACTATION"])


def is_supported(population: Column, code: Column, evidence: Column, rules: RuleSet = PUBLISHED_RULES) -> Column:
    """Whether the evidence has words for the code; two codes are for lactation only, and UNCLASSIFIABLE needs none."""
    out = code == "UNCLASSIFIABLE"
    for name, pattern in rules.support.items():
        own = (code == name) & evidence.rlike(_any_case(pattern))
        out = out | (own & (population == "LACTATION") if name in rules.lactation_only else own)
    return F.coalesce(out, F.lit(False))


def class_field(code: Column, field: int) -> Column:
    """Display level (0), text (1) or priority (2) of a code, also of the two that say nothing was stated; null for others."""
    known = CLASSES if field == 2 else CLASSES | NOT_STATED
    return F.create_map(*(F.lit(x) for k, v in known.items() for x in (k, v[field])))[code]


def candidates(blocks: DataFrame, version: str = "rules-2", rules: RuleSet = PUBLISHED_RULES, marks: str = "。") -> DataFrame:
    """Statements of current blocks (block_id, package_insert_no, population_type, block_text) with what the rules say.

    statement_hash tells equal statements of a block apart by their occurrence, so that
    the same statement elsewhere has the same hash and one model call serves all. marks
    end statements, as newlines do.
    """
    rows = blocks.select("block_id", "package_insert_no", "population_type", F.posexplode(sentences(normalise_nfkc("block_text"), marks)).alias("i", "evidence_text"))
    nth = F.row_number().over(Window.partitionBy("block_id", "population_type", "evidence_text").orderBy("i"))
    rows = rows.withColumn("statement_hash", stable_hash(population_type=F.col("population_type"), evidence_text=F.col("evidence_text"), occurrence=nth)).withColumn("c", classified(F.col("population_type"), F.col("evidence_text"), rules))
    told = ("expression_type", F.col("c.classification_code").alias("rule_classification"), "c.recommendation_target", "c.requires_llm")
    return rows.select("block_id", "package_insert_no", "population_type", (F.col("i") + 1).alias("statement_order"), "statement_hash", "evidence_text", "c.expression_type", *told[1:], F.lit(version).alias("definition_version"))


def model_facts(runs: DataFrame, facts: DataFrame, models: Sequence[str]) -> DataFrame:
    """The fact of the most preferred model with a success, for each statement and population."""
    found = runs.filter((F.col("status") == "success") & F.col("model").isin(*models)).join(facts, "run_id")
    best = distinct_on(found, ["statement_hash", "population_type"], [preference_rank("model", models), "run_id"])
    return best.select("statement_hash", "population_type", F.col("model").alias("model_name"), F.col("classification_code").alias("llm_code"), F.col("recommendation_target").alias("llm_target"), F.col("assessment_text").alias("llm_text"))


def first_candidate(runs: DataFrame, found: DataFrame) -> DataFrame:
    """Each run with the first current candidate of its statement and population that needs a model; runs without one go."""
    needed = found.filter(F.col("is_current") & F.col("requires_llm"))
    first = distinct_on(needed, ["statement_hash", "population_type"], ["candidate_id"])
    return runs.join(first.select("statement_hash", "population_type", "candidate_id", "block_id", "evidence_text"), ["statement_hash", "population_type"])


def current_candidates(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """Current candidates with their current block's columns; what either side has retired goes."""
    own = [c for c in blocks.columns if c not in found.columns or c == "block_id"]
    return found.filter("is_current").join(blocks.filter("is_current").select(*own), "block_id")


def published(found: DataFrame, llm: DataFrame) -> DataFrame:
    """Candidates with the code, target, display level and text to publish, how they came about, and whether to look at them.

    Only candidates that need a model are joined with its facts. found is read for these
    and for the others: give a stored table where its rules are costly.
    """
    asked = F.coalesce(F.col("requires_llm"), F.lit(False))
    keys = ["statement_hash", "population_type"]
    told = llm.schema
    others = found.filter(~asked).select(*keys, *(c for c in found.columns if c not in keys), *(F.lit(None).cast(told[c].dataType).alias(c) for c in llm.columns if c not in keys))
    joined = found.filter(asked).join(llm, keys, "left").unionByName(others)
    used = F.col("requires_llm") & F.col("llm_code").isNotNull()
    code = F.when(used, F.col("llm_code")).otherwise(F.col("rule_classification"))
    method = F.when(used, "LLM").when(code.isNull(), "SOURCE").when(code == "UNCLASSIFIABLE", "UNCLASSIFIED").otherwise("RULE")
    text = F.when(class_field(code, 0).isNotNull(), F.when(used, F.col("llm_text")).otherwise(class_field(code, 1)))
    return joined.withColumns(
        {
            "classification_code": code,
            "target": F.when(used, F.col("llm_target")).otherwise(F.col("recommendation_target")),
            "display_level": class_field(code, 0),
            "assessment_text": text,
            "extraction_method": method,
            "review_status": F.when(code.eqNullSafe("UNCLASSIFIABLE"), "NEEDS_REVIEW").otherwise("AUTO_VALIDATED"),
            "model_name": F.when(used, F.col("model_name")),
        }
    ).drop("llm_code", "llm_target", "llm_text", "recommendation_target").withColumnRenamed("target", "recommendation_target")


def summaries(states: DataFrame, statements: DataFrame) -> DataFrame:
    """One row for each state (package_insert_no, population_type, has_section): its worst code and why.

    The code of highest priority wins; without one the section is absent or says nothing.
    reason_statement_id is the smallest id of a statement with the winning code. The
    statements are read once.
    """
    keys = ["package_insert_no", "population_type"]
    rank = priority_rank({c: v[2] for c, v in CLASSES.items()})[F.col("classification_code")]
    by_code = statements.groupBy(*keys, "classification_code").agg(F.count("*").alias("n"), F.min("statement_id").alias("reason_statement_id"))
    best = F.max(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), F.col("classification_code").alias("best_code"), "reason_statement_id")))
    told = by_code.groupBy(*keys).agg(F.sum("n").alias("statement_count"), F.bool_or(F.col("classification_code").eqNullSafe("UNCLASSIFIABLE")).alias("has_unclassified"), best.alias("b"))
    absent = F.when(F.col("has_section"), "NO_EXPLICIT_RECOMMENDATION").otherwise("SECTION_ABSENT")
    out = states.join(told, keys, "left").select(*(F.col(c) for c in states.columns), "statement_count", "has_unclassified", "b.reason_statement_id", F.coalesce("b.best_code", absent).alias("best_code"))
    return out.select(
        *(c for c in states.columns),
        F.col("best_code").alias("assessment_code"),
        class_field(F.col("best_code"), 0).alias("display_level"),
        class_field(F.col("best_code"), 1).alias("assessment_text"),
        "reason_statement_id",
        F.coalesce("has_unclassified", F.lit(False)).alias("has_unclassified"),
        F.coalesce("statement_count", F.lit(0)).alias("statement_count"),
    )
