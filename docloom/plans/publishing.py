"""From runs and facts to published tables: coverage gates, choice of models, ranking, review."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom._ship import ensure_importable
from docloom.functions import semi
from docloom.operators.ranking import chosen_then_join, preference_rank, quality_dedup


def coverage(cases: DataFrame, runs: DataFrame, keys: Sequence[str], models: Sequence[str]) -> DataFrame:
    """Cases, those with a success of any listed model, and missing ones, for each group."""
    done = runs.filter((F.col("status") == "success") & F.col("model").isin(*models)).select("analysis_hash").distinct().withColumn("__ok", F.lit(True))
    return cases.join(done, "analysis_hash", "left").groupBy(*keys).agg(F.count("*").alias("n_cases"), F.count_if("__ok").alias("n_done"), F.count_if(F.col("__ok").isNull()).alias("n_missing"))


def gate(covered: DataFrame, *, dry_run: bool = False, publish_partial: bool = False) -> list[str]:
    """Raise unless every group is complete; the incomplete ones otherwise."""
    open_groups = [str(tuple(r)) for r in covered.filter("n_done < n_cases").collect()]
    if open_groups and not (dry_run or publish_partial):
        raise RuntimeError(f"incomplete: {open_groups[:20]}")
    return open_groups


def published_facts(cases: DataFrame, runs: DataFrame, facts: DataFrame, models: Sequence[str]) -> DataFrame:
    """Facts of each case's preferred successful run. A preferred run without facts publishes none."""
    best = runs.filter("status = 'success'")
    return cases.join(chosen_then_join(best, facts, ["analysis_hash"], "model", models, ["run_id"], "run_id").drop("run_id"), "analysis_hash")


def ranked_notes(facts: DataFrame, keys: Sequence[str], models: Sequence[str], sections: Sequence[str], markers: Sequence[str]) -> DataFrame:
    """One fact of each key: by model, section, marker count and evidence length, then by hash and block."""
    score = lambda rank, n: F.lit(n) - F.coalesce(rank, F.lit(n))
    marks = sum((F.contains("evidence_text", F.lit(m)).cast("int") for m in markers), F.lit(0))
    scored = facts.withColumns({"__m": score(preference_rank("model", models), len(models) + 1), "__s": score(preference_rank("section", sections), len(sections) + 1), "__k": marks, "__l": F.length("evidence_text")})
    return quality_dedup(scored, keys, ["__m", "__s", "__k", "__l"], ["fact_hash", "block_id"]).drop("__m", "__s", "__k", "__l")


def review_cases(runs: DataFrame, models: Sequence[str], human: str = "human-review") -> DataFrame:
    """The run to show a reviewer for each case without any success: the first model with review, else with error."""
    done = runs.filter((F.col("status") == "success") & F.col("model").isin(human, *models)).select("analysis_hash").distinct()
    open_runs = runs.filter(F.col("model").isin(*models) & F.col("status").isin("review", "error")).join(done, "analysis_hash", "left_anti")
    w = Window.partitionBy("analysis_hash").orderBy(F.when(F.col("status") == "review", 0).otherwise(1), preference_rank("model", models))
    return open_runs.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n").withColumn("decision", F.lit("PENDING"))


def proposed_facts(cases: DataFrame, runs: DataFrame, schema: str) -> DataFrame:
    """The facts of the run shown for each review case, numbered, not included yet; one blank row for a case without any."""
    facts = runs.select("analysis_hash", "model", F.transform(semi.entries(semi.as_variant(runs, "facts")), lambda v: semi.record(v, schema)).alias("__f"))
    rows = cases.select("analysis_hash", "model").join(facts, ["analysis_hash", "model"], "left").select("analysis_hash", F.posexplode_outer("__f").alias("__i", "__fact"))
    return rows.select("analysis_hash", (F.coalesce("__i", F.lit(0)) + 1).alias("fact_no"), "__fact.*", F.lit("FALSE").alias("include"))


def review_import(decisions: DataFrame, facts: DataFrame, current: DataFrame, runs: DataFrame, validate: Callable[[list[dict], dict], tuple[list[dict], list[str]]], human: str = "human-review") -> tuple[DataFrame, DataFrame]:
    """(errors, runs to write) of reviewed cases.

    decisions: analysis_hash, decision, reviewer, comment, run_id, source_model. facts:
    analysis_hash, include and fact (JSON). current: the case as it stands now:
    analysis_hash and context (JSON, what validate needs). runs: analysis_hash, run_id and
    model of stored runs. Undecided cases are left out. Runs are those of the model human,
    with status success, 0 attempts (an upsert sets the stored count back to it), the
    included and valid facts as JSON, reviewer, comment and decision; they may be written
    only if there is no error at all.
    """
    ensure_importable(decisions.sparkSession)
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    decided = decisions.withColumn("decision", F.upper(text("decision"))).filter("decision not in ('', 'PENDING')")
    chosen = facts.filter(F.upper(text("include")).isin("TRUE", "1", "YES", "Y")).groupBy("analysis_hash").agg(F.collect_list("fact").alias("chosen"))
    source = runs.select("analysis_hash", "run_id", F.col("model").alias("source_model"), F.lit(True).alias("__source"))
    now = current.select("analysis_hash", "context").dropDuplicates(["analysis_hash"])
    cases = decided.join(chosen, "analysis_hash", "left").join(now, "analysis_hash", "left").join(source, ["analysis_hash", "run_id", "source_model"], "left")
    tests = {
        "unknown decision": ~F.col("decision").isin("APPROVE", "EXCLUDE"),
        "no reviewer": text("reviewer") == "",
        "EXCLUDE without a comment": (F.col("decision") == "EXCLUDE") & (text("comment") == ""),
        "APPROVE without a fact": (F.col("decision") == "APPROVE") & F.col("chosen").isNull(),
        "the case is no longer current": F.col("context").isNull(),
        "the source run isn't stored": F.col("__source").isNull(),
    }
    cases = cases.withColumn("errors", F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests.items()))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                errors, valid = list(row["errors"]), []
                if not errors and row["decision"] == "APPROVE":
                    try:
                        valid, errors = validate([json.loads(x) for x in row["chosen"]], json.loads(row["context"]))
                    except ValueError as e:
                        errors = [f"a fact isn't JSON: {e}"]
                out.append((row["analysis_hash"], human, "success", 0, json.dumps(valid, ensure_ascii=False), row["decision"], row["reviewer"], row["comment"], errors))
            yield pd.DataFrame(out, columns=["analysis_hash", "model", "status", "attempts", "facts", "decision", "reviewer", "comment", "errors"])

    judged = cases.select("analysis_hash", "decision", "reviewer", "comment", "chosen", "context", "errors").mapInPandas(run, "analysis_hash string, model string, status string, attempts int, facts string, decision string, reviewer string, comment string, errors array<string>")
    return judged.select("analysis_hash", F.explode("errors").alias("error")), judged.drop("errors")


def three_way(runs: DataFrame, candidates: DataFrame, blocks: DataFrame, keys: Sequence[str] = ("content_hash", "note_type", "definition_version")) -> DataFrame:
    """Runs with every candidate of the same content and definition and the block it stands in."""
    return runs.join(candidates, list(keys)).join(blocks, "block_id")
