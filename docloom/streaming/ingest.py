"""Files and rows that keep arriving: micro-batches that change a table once each."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.delta_table import DeltaTable
from docloom.sources.files import decoded

DOCUMENTS = "path string, sha256 string, text string, error string, batch bigint"


def arriving(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """A stream of (path, content) of the files below path, new ones as they come."""
    return spark.readStream.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).schema("path string, modificationTime timestamp, length long, content binary").load(path).select("path", "content")


def started(rows: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], object], once: bool = True) -> StreamingQuery:
    """handle(batch, number) for each micro-batch; a restart goes on after the last finished batch, which it may hand over again.

    The batch is computed once and kept while handle reads it, however often: a stream's
    state moves once a batch, also where handle reads nothing.
    """

    def run(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            held.count()
            handle(held, number)
        finally:
            held.unpersist()

    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def ingest(spark: SparkSession, path: str, checkpoint: str, handle: Callable[[DataFrame, int], None], pattern: str = "*.xml", once: bool = True) -> StreamingQuery:
    """Run handle(batch, number) on new files of path."""
    return started(arriving(spark, path, pattern), checkpoint, handle, once)


def into_table(rows: DataFrame, table: DeltaTable, name: str, checkpoint: str, order: Sequence[str] | None = None, once: bool = True) -> StreamingQuery:
    """Upsert a stream into a table. A batch's number is part of its commit: handed over again, it changes nothing.

    order: columns by which the last row of a key counts, of the table's and the batches';
    without them a batch's row replaces the table's, and a repeated key in a batch is an
    error. The name belongs to the stream and its checkpoint.
    """

    def handle(batch: DataFrame, number: int) -> int:
        return table.upsert_last(batch, order, (name, number)) if order else table.upsert(batch, tag=(name, number))

    return started(rows, checkpoint, handle, once)


def documents_into_table(spark: SparkSession, path: str, table: DeltaTable, name: str, checkpoint: str, pattern: str = "*.xml", once: bool = True) -> StreamingQuery:
    """Decoded documents of arriving files, as DOCUMENTS with the key path; contents that came before under any path are left out.

    Hashes of contents seen are keyed state of the stream. A file that isn't UTF-8 is a row with an error.
    """
    hashed = arriving(spark, path, pattern).withColumn("sha256", F.sha2("content", 256)).dropDuplicates(["sha256"])

    def handle(batch: DataFrame, number: int) -> int:
        rows = decoded(batch).select("path", "sha256", "text", "error", F.lit(number).cast("bigint").alias("batch"))
        return table.upsert(rows, order=["batch", "sha256"], tag=(name, number))

    return started(hashed, checkpoint, handle, once)
