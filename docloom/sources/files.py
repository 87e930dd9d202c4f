"""Document files, deduplicated by content, decoded without loss; settings, definitions and CSV files."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """(path, content) of all files below path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content")


def decoded(files: DataFrame) -> DataFrame:
    """text: UTF-8 content without a byte order mark, otherwise unchanged; null, and an error, where a byte isn't UTF-8."""
    raw = F.col("content").cast("string")
    bad = F.when(~F.is_valid_utf8(raw), F.lit("not UTF-8"))
    error = F.coalesce(F.col("error"), bad) if "error" in files.columns else bad
    return files.withColumn("text", F.when(F.is_valid_utf8(raw), F.regexp_replace(raw, "^\ufeff", ""))).withColumn("error", error)


def split_duplicates(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files of distinct content (the first path stays), and (sha256, kept, skipped) of the others.

    Hashes and paths are grouped, not contents; a content with many copies is one row a
    task. Files without content all stay. The files are read twice: for the hashes, and
    for those that stay. Joined by sorting, never broadcast: there are as many hashes as
    files, of which Spark may expect few where a list of archives is what it knows.
    """
    hashed = files.withColumn("sha256", F.sha2("content", 256))
    paths = hashed.select("sha256", "path")
    least = paths.groupBy("sha256", F.when(F.col("sha256").isNull(), F.col("path")).alias("__own")).agg(F.min("path").alias("kept"), F.count("*").alias("n"))
    kept = least.select("kept", F.col("sha256").alias("__sha"))
    first = hashed.join(kept.hint("merge"), F.col("path").eqNullSafe(F.col("kept")) & F.col("sha256").eqNullSafe(F.col("__sha")), "left_semi")
    copies = least.filter("n > 1 and sha256 is not null").select("sha256", "kept")
    return first, paths.join(copies.hint("merge"), "sha256").filter("path <> kept").select("sha256", "kept", F.col("path").alias("skipped"))


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all columns text, quoted newlines allowed, a byte order mark dropped."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    return df.toDF(*(c.lstrip("﻿") for c in df.columns))


def write_csv_quoted(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """CSV with all values quoted, a file a task, each with the header, which read_csv_strings() takes together; refuses to replace what is there unless told to."""
    df.write.mode("overwrite" if overwrite else "errorifexists").csv(path, header=True, quoteAll=True, escape='"')


def load_config(path: str, **overrides: Any) -> dict[str, Any]:
    """Settings of a JSON file, an object; overrides that aren't None replace them."""
    with open(path, encoding="utf-8-sig") as f:
        found = json.load(f)
    if not isinstance(found, dict):
        raise ValueError("settings must be an object")
    return found | {k: v for k, v in overrides.items() if v is not None}


def write_review_pair(cases: DataFrame, facts: DataFrame, folder: str, overwrite: bool = False) -> None:
    """cases and facts as two CSV files with all values quoted, under one folder."""
    write_csv_quoted(with_mark(cases), f"{folder.rstrip('/')}/cases", overwrite)
    write_csv_quoted(with_mark(facts), f"{folder.rstrip('/')}/facts", overwrite)


def with_mark(df: DataFrame) -> DataFrame:
    """The first column's name after a byte order mark, which spreadsheets take as the sign of UTF-8; read_csv_strings drops it."""
    return df.toDF(f"\ufeff{df.columns[0]}", *df.columns[1:])


def load_definitions(source: str | list[dict[str, Any]]) -> dict[str, dict[str, Any]]:
    """Note definitions by type; a wrong one is an error."""
    items = source
    if isinstance(source, str):
        with open(source, encoding="utf-8") as f:
            items = json.load(f)
    if isinstance(items, dict):
        items = items.get("definitions")
    if not isinstance(items, list) or not items:
        raise ValueError("definitions must be a list that isn't empty")
    out: dict[str, dict[str, Any]] = {}
    for d in items:
        name = d.get("note_type")
        if not isinstance(name, str) or not name or name in out:
            raise ValueError(f"note_type must be unique text: {name!r}")
        if not isinstance(d.get("definition_version"), str) or not isinstance(d.get("allowed_relations"), list):
            raise ValueError(f"{name}: definition_version must be text and allowed_relations a list")
        for key in ("candidate_required_term_groups", "required_evidence_term_groups"):
            if not all(isinstance(g, list) and g for g in d.get(key, [])):
                raise ValueError(f"{name}: {key} must be lists of terms")
        if not all(isinstance(t, dict) and "target_code" in t for t in d.get("relation_targets", {}).values()):
            raise ValueError(f"{name}: relation_targets must be objects with a target_code")
        for key in ("max_facts_per_evidence", "max_note_percentages"):
            if not isinstance(d.get(key, 0), int):
                raise ValueError(f"{name}: {key} must be a number")
        out[name] = d
    return out
