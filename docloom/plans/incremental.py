"""Which documents to parse again, which blocks to replace, and the state kept of each document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import semi
from docloom.functions.hashing import manifest
from docloom.operators.merging import scd2_merge, upsert

STATE = "raw_hash string, manifest string, n_blocks bigint, version string, status string, error string, first_seen_at string, last_seen_at string, last_parsed_at string"


def to_parse(docs: DataFrame, state: DataFrame, key: str, version: str, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents to parse, documents to skip): a document of the same raw hash and extractor version was parsed before.

    docs has raw_hash. A document whose last parse failed has the version null and is tried again.
    """
    known = state.select(key, F.col("raw_hash").alias("__raw"), F.col("version").alias("__version"))
    joined = docs.join(known, key, "left")
    same = F.lit(not force) & F.col("__raw").eqNullSafe(F.col("raw_hash")) & F.col("__version").eqNullSafe(F.lit(version))
    return joined.filter(~same).drop("__raw", "__version"), joined.filter(same).drop("__raw", "__version")


def manifests(docs: DataFrame, blocks: DataFrame, keys: Sequence[str], uid: str = "block_uid", order: str | None = None) -> DataFrame:
    """docs (keys and more) with the manifest of their blocks and n_blocks; has_section is false for those without blocks."""
    joined = blocks.withColumn("__key", F.to_json(F.struct(*keys)))
    found = manifest(joined, "__key", uid, order)
    out = docs.withColumn("__key", F.to_json(F.struct(*keys))).join(found, "__key", "left").drop("__key")
    return out.withColumns({"manifest": F.coalesce("manifest", F.sha2(F.lit(""), 256)), "n_blocks": F.coalesce("n_blocks", F.lit(0)), "has_section": F.col("n_blocks").isNotNull()})


def changed(found: DataFrame, state: DataFrame, keys: Sequence[str], version: str | None = None, force: bool = False) -> DataFrame:
    """Rows of found whose manifest (and version, where one is given) is not the state's: their blocks are to be replaced."""
    known = state.select(*keys, F.col("manifest").alias("__manifest"), F.col("version").alias("__version"))
    same: Column = F.lit(not force) & F.col("__manifest").eqNullSafe(F.col("manifest"))
    if version is not None:
        same = same & F.col("__version").eqNullSafe(F.lit(version))
    return found.join(known, list(keys), "left").filter(~same).drop("__manifest", "__version")


def replace_blocks(old: DataFrame, new: DataFrame, scope: DataFrame, doc: str, keys: Sequence[str], value: str, run_ts: Column) -> DataFrame:
    """The block history after a run: within the documents of scope, blocks that new lacks are retired."""
    touched = scope.select(doc).distinct().withColumn("__touched", F.lit(True))
    old = old.join(touched, doc, "left")
    merged = scd2_merge(old.filter("__touched").drop("__touched"), new.join(touched.select(doc), doc, "left_semi"), keys, value, run_ts)
    kept = old.filter("__touched is null").drop("__touched").withColumn("change_type", F.lit("kept"))
    return kept.select(*merged.columns).unionByName(merged)


def next_state(state: DataFrame, key: str, version: str, run_ts: Column, *, parsed: DataFrame, skipped: DataFrame, failed: DataFrame) -> DataFrame:
    """The state after a run.

    parsed (key, raw_hash, manifest, n_blocks): success. skipped (key): only last_seen_at
    moves. failed (key, raw_hash, error): status error, the message cut at 2,000
    characters; the hashes and version of the last good parse stay, as its blocks do, and
    a document that never had one has no version. Both are parsed again.
    """
    text = lambda x: F.lit(x).cast("string")
    good = parsed.select(key, "raw_hash", "manifest", F.col("n_blocks").cast("bigint").alias("n_blocks"), text(version).alias("version"), text("success").alias("status"), text(None).alias("error"), run_ts.alias("first_seen_at"), run_ts.alias("last_seen_at"), run_ts.alias("last_parsed_at"))
    bad = failed.select(key, "raw_hash", F.sha2(F.lit(""), 256).alias("manifest"), F.lit(0).cast("bigint").alias("n_blocks"), text(None).alias("version"), text("error").alias("status"), F.substring("error", 1, 2000).alias("error"), run_ts.alias("first_seen_at"), run_ts.alias("last_seen_at"), run_ts.alias("last_parsed_at"))
    seen = skipped.select(key, F.lit(True).alias("__seen"))
    moved = state.join(seen, key, "left").withColumn("last_seen_at", F.when(F.col("__seen"), run_ts).otherwise(F.col("last_seen_at"))).select(*state.columns)
    first = lambda old, new: F.coalesce(old, new)
    out = upsert(moved, good.select(*state.columns), [key], {"first_seen_at": first})
    stays = {c: lambda old, new: old for c in ("raw_hash", "manifest", "n_blocks", "version")}
    return upsert(out, bad.select(*state.columns), [key], {"first_seen_at": first, **stays})


def rebuilt_facts(blocks: DataFrame, runs: DataFrame, schema: str, model: str | None = None) -> DataFrame:
    """Facts of stored answers for every block that shares their hash, without any call: one row a block and fact.

    runs has analysis_hash, model, status and facts (a JSON array, as VARIANT or as text);
    only successes count, and facts that aren't an array are none. How many facts the
    arrays hold isn't known to a plan, so that it would broadcast them at any size: the
    join is asked to sort both sides.
    """
    good = runs.filter("status = 'success'")
    good = good if model is None else good.filter(F.col("model") == model)
    items = good.select("analysis_hash", "model", F.posexplode(semi.entries(semi.as_variant(good, "facts"))).alias("fact_no", "__v"))
    facts = items.select("analysis_hash", "model", "fact_no", semi.record(F.col("__v"), schema).alias("fact"))
    return blocks.join(facts.hint("merge"), "analysis_hash").select(*blocks.columns, "model", "fact_no", "fact.*")
