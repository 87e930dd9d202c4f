"""Rewritten patterns find a match in the same texts as the patterns themselves, in time in proportion to the text."""

import random
import re
import time

from pyspark.sql import functions as F

from docloom.functions import patterns, rules
from docloom.plans import legacy_scores, statements

TABLES = [f"(?isu){p}" for own in (statements.PREGNANCY, statements.LACTATION) for *_, p in own]
TABLES += [f"(?isu){p}" for p in (statements.CUE, statements.EXCLUDED, *(p for _, p in statements.EXPRESSIONS), *statements.SUPPORT.values())]
TABLES += [f"(?s){p}" for own in (legacy_scores.PREGNANCY_SCORES, legacy_scores.LACTATION_SCORES) for _, p, _ in own]
TABLES += [f"(?ms){p}" for own in (legacy_scores.PREGNANCY_FLAGS, legacy_scores.LACTATION_FLAGS) for p in own.values()]
MADE = ["(?s)(ab|b|abc).*(cd|d).*[ef]x?", "(?s)a(b)?c.*(d|e.*(f|g.*h))|xy", "(?is)(A|bA).*B", r"(?s)a\..*b[^c]d", "(?s)(a|).*b", "(?s)(?:a.*b|c)d", "a.*b", "(?s)a+.*b", "(?s)a.*?b", "(?s)[a-c].*d", "(?s)x.*(?!a)b"]


def test_strings_of_a_pattern():
    assert patterns.strings("a(b|c)?[de]") == ["abd", "abe", "acd", "ace", "ad", "ae"]
    assert patterns.strings(r"a\.(?:b|)") == ["a.", "a.b"]
    assert [patterns.strings(p) for p in ("a*", "[a-z]", r"\d", "(?!a)", "a{2}", ".", "a+", "a??")] == [None] * 8


def test_same_texts_match(spark):
    r = random.Random(7)
    checked = 0
    for table in (TABLES, MADE):
        bits = sorted({b for p in table for b in re.findall(r"[^\W\d_]+", p.split(")", 1)[-1])} | set("abcdefghxy")) + ["\n", "。", " ", "."]
        texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 9))) for _ in range(1500)]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4)
        rows = df.select("i", F.array(*(F.col("t").rlike(p) for p in table)).alias("a"), F.array(*(F.col("t").rlike(patterns.linear(p)) for p in table)).alias("b")).collect()
        for row in rows:
            assert row.a == row.b, (texts[row.i], [p for p, x, y in zip(table, row.a, row.b, strict=True) if x != y])
        checked += sum(sum(row.a) for row in rows)
    changed = [p for p in TABLES if patterns.linear(p) != p]
    assert checked > 2000 and len(changed) >= 12
    assert all(".*" not in p or patterns.linear(p) != p for p in TABLES)


def test_long_statements_take_their_length(spark):
    """Megabytes of openings without an end, for which the patterns themselves would take hours."""
    text = "有益性を考慮し授乳の継続、新生児、ヒト、原則" * 60_000
    df = spark.createDataFrame([(text,)], "t string")
    start = time.time()
    found = statements.classified(F.lit("PREGNANCY"), F.col("t"))
    scores = legacy_scores.scored(F.col("t"), legacy_scores.PREGNANCY_SCORES), legacy_scores.evidence_flags(F.col("t"), legacy_scores.PREGNANCY_FLAGS)
    row = df.select(found.alias("c"), scores[0].alias("s"), scores[1].alias("f")).first()
    assert row.c.classification_code == "UNCLASSIFIABLE" and row.s.score == 0 and not any(row.f.values())
    assert time.time() - start < 60


def test_first_rule_still_decides(spark):
    table = [rules.Rule("(?s)a.*b", {"v": 1}), rules.Rule("(?s)b.*a", {"v": 2})]
    df = spark.createDataFrame([("ab",), ("ba",), ("x",), ("bab",), (None,)], "t string")
    assert [r.v for r in df.select(rules.classify(F.col("t"), table, {"v": 0}).alias("c")).select("c.v").collect()] == [1, 2, 0, 1, 0]


def test_the_scored_line_is_made_once(spark):
    plan = spark.range(1).select(legacy_scores.scored(F.col("id").cast("string"), legacy_scores.PREGNANCY_SCORES).alias("s"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("上まわる") == 1
