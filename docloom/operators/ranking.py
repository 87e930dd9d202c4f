"""First row of each group, by order, by preference list, by quality or by priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row for each key: the first in a total order. Spark plans a group limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def preference_rank(column: str, preferred: Sequence[str]) -> Column:
    """1 for the first of the list, and so on; null for what isn't on it."""
    at = F.array_position(F.array(*(F.lit(x) for x in preferred)), F.col(column))
    return F.when(at > 0, at)


def prefer_by(df: DataFrame, keys: Sequence[str], column: str, preferred: Sequence[str], tie: Sequence[Column | str]) -> DataFrame:
    """The most preferred row of each key; rows whose value isn't on the list don't count."""
    listed = df.filter(F.col(column).isin(*preferred))
    return distinct_on(listed, keys, [preference_rank(column, preferred), *tie])


def chosen_then_join(parents: DataFrame, children: DataFrame, keys: Sequence[str], column: str, preferred: Sequence[str], tie: Sequence[Column | str], on: str) -> DataFrame:
    """Children of the preferred parent only: a preferred parent without children gives no row for its key."""
    return prefer_by(parents, keys, column, preferred, tie).join(children, on)


def quality_dedup(df: DataFrame, keys: Sequence[str], ranks: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The row of each key with the highest rank tuple; ties go to the first by tie."""
    return distinct_on(df, keys, [*(F.col(r).desc_nulls_last() for r in ranks), *(F.col(t).asc_nulls_last() for t in tie)])


def priority_rank(priorities: dict[str, int]) -> Column:
    """A map of codes to ranks, the best the greatest; of equal priorities the smallest code is the best."""
    rank = sorted(sorted(priorities, reverse=True), key=priorities.__getitem__)
    return F.create_map(*(F.lit(x) for i, c in enumerate(rank) for x in (c, i)))


def argmax_by_priority(groups: DataFrame, items: DataFrame, key: str, code: str, priorities: dict[str, int], absent: Column) -> DataFrame:
    """The code of highest priority for each row of groups; absent for groups without a known code. Equal priorities: the smallest code."""
    rank = {c: i for i, c in enumerate(sorted(sorted(priorities, reverse=True), key=priorities.__getitem__))}  # the best code has the greatest rank
    names = F.array(*(F.lit(c) for c in rank))
    table = F.create_map(*(F.lit(x) for kv in rank.items() for x in kv))
    won = items.select(key, table[F.col(code)].alias("__r")).filter("__r is not null").groupBy(key).agg(F.max("__r").alias("__r"), F.count("*").alias("n_items"))
    won = won.select(key, F.get(names, F.col("__r")).alias("best_code"), "n_items")
    return groups.join(won, key, "left").withColumn("best_code", F.coalesce("best_code", absent)).withColumn("n_items", F.coalesce("n_items", F.lit(0)))
