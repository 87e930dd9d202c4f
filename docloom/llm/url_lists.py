"""URL filters whose list entries come and go: validity intervals and an as-of join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; null if the URL has none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def intervals(entries: DataFrame) -> DataFrame:
    """(list_name, pattern, valid_from, valid_to) from dated entries (list_name, pattern, action, entry_date).

    An 'add' holds from its date until the next entry of the same list and pattern; a
    'remove' only ends what came before. On one date the removal counts last. Rows with a
    null in any of the four columns say nothing and are left out; repeated rows count once.
    valid_to is null for what still holds.
    """
    clean = entries.select("list_name", F.lower("pattern").alias("pattern"), "action", F.col("entry_date").cast("date").alias("entry_date")).dropna()
    daily = clean.groupBy("list_name", "pattern", "entry_date").agg(F.max(F.when(F.col("action") == "remove", 1).otherwise(0)).alias("ends"))
    later = F.lead("entry_date").over(Window.partitionBy("list_name", "pattern").orderBy("entry_date"))
    return daily.withColumn("valid_to", later).filter("ends = 0").select("list_name", "pattern", F.col("entry_date").alias("valid_from"), "valid_to")


def filter_captures(captures: DataFrame, entries: DataFrame, *, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetch_date", allow_lists: tuple[str, ...] = ("allow",)) -> DataFrame:
    """Whether each capture was blocked by the entries in force when it was fetched.

    A pattern is a host; it covers itself and its subdomains. The most specific pattern in
    force decides; where a block list and one of allow_lists name the same pattern, allow
    wins.
    Columns: the id, host, fetch date, n_active (entries in force that cover the host),
    pattern and list_name that decided (null if none), blocked.

    The distinct (host, date) pairs are joined, not the captures: a host with a third of
    all captures costs its dates only, and the way back is an equi-join that Spark can
    split. A pair is asked for under those of its suffixes only that have as many labels as
    some pattern (at most 127 numbers come to the driver), so that hosts don't meet at a
    top-level domain that no list has. A null or unparsable URL, or a null date, matches
    nothing and isn't blocked. Null ids and repeated rows stay; empty captures give no
    rows, empty entries block nothing. Other columns are not read, whatever their names.
    """
    seen = captures.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), F.col(time_col).cast("date").alias(time_col))
    asked = seen.select("host", F.col(time_col).alias("day")).dropna().distinct()
    labels = F.split("host", r"\.")
    valid = intervals(entries)
    depths = [r.n for r in valid.select(F.size(F.split("pattern", r"\.")).alias("n")).distinct().filter("n < 128").collect()]
    wanted = F.filter(F.array(*(F.lit(d) for d in sorted(depths))).cast("array<int>"), lambda n: n <= F.size(labels))
    suffixes = F.transform(wanted, lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    keys = asked.select("host", "day", F.explode(suffixes).alias("pattern"))
    met = keys.join(valid, "pattern").filter((F.col("day") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
    best = met.groupBy("host", "day").agg(F.count("*").alias("n_active"), F.max(F.struct(F.length("pattern").alias("l"), F.when(F.col("list_name").isin(*allow_lists), 1).otherwise(0).alias("a"), "list_name", "pattern")).alias("b"))
    told = best.select("host", F.col("day").alias(time_col), "n_active", "b.pattern", "b.list_name", (F.col("b.a") == 0).alias("blocked"))
    return seen.join(told, ["host", time_col], "left").select(id_col, "host", time_col, F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"), "pattern", "list_name", F.coalesce("blocked", F.lit(False)).alias("blocked"))
