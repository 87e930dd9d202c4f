"""Content identity: stable hashes, block ids with occurrence numbers, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def stable_hash(**fields: Column) -> Column:
    """SHA-256 of compact JSON with keys in order and nulls kept."""
    return F.sha2(F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"}), 256)


def with_occurrence(df: DataFrame, doc: str, content: str, order: str) -> DataFrame:
    """occurrence (from 1) of equal contents within a document, and block_uid made of both."""
    n = F.row_number().over(Window.partitionBy(doc, content).orderBy(order))
    return df.withColumn("occurrence", n).withColumn("block_uid", F.sha2(F.concat_ws(":", content, n.cast("string")), 256))


def manifest(df: DataFrame, doc: str, uid: str, order: str | None = None) -> DataFrame:
    """One hash a document of its ids: sorted, or in the given order."""
    if order is None:
        ids = F.array_sort(F.collect_list(uid))
    else:
        ids = F.transform(F.array_sort(F.collect_list(F.struct(order, uid))), lambda x: x[uid])
    return df.groupBy(doc).agg(F.sha2(F.array_join(ids, "\n"), 256).alias("manifest"), F.count("*").alias("n_blocks"))
