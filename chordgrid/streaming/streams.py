"""Incremental processing with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chordgrid.operators.dataset import SCHEMA
from chordgrid.sources.charts import file_texts, numbered


def shard_stream(spark: SparkSession, path: str, schema: T.StructType = SCHEMA, files_per_batch: int = 4) -> DataFrame:
    """Shards as a stream: a few files a batch bound what is in flight; broken files are passed over."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("ignoreCorruptFiles", "true").parquet(path)


def text_stream(spark: SparkSession, path: str, files_per_batch: int = 1000, song: str | None = None) -> DataFrame:
    """path, text of whole text files as they come, a bounded number of files a batch. ``song``: see
    :func:`chordgrid.sources.charts.file_texts`."""
    return file_texts(spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).text(path, wholetext=True), song)


def line_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """path, line_no, line of whole text files as they come, a bounded number of files a batch."""
    return numbered(text_stream(spark, path, files_per_batch))


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand all data that is there, batch by batch, to ``write``; a later call goes on where this one ended."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def await_all(queries: list[StreamingQuery]) -> None:
    """Waits for queries that run side by side; where one fails, the others are stopped."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def shuffled_batches(stream: DataFrame, key: list[str], out: str, checkpoint: str, seed: int = 0, buffer_rows: int = 0) -> StreamingQuery:
    """Rows in an order that seed and batch decide, shuffled over windows of files.

    With ``buffer_rows`` about so many rows stay behind at each batch, chosen by a hash among those that were held and
    those that came, so a row leaves in its own batch or any later one. What is held is a table beside the
    output, one for each batch: a batch that runs again reads its predecessor's and writes its own anew, so
    no row is lost or doubled by a restart. :func:`drained` lets the last rows out.
    """
    spark = stream.sparkSession
    turn = lambda batch, *more: F.xxhash64(F.lit(seed), F.lit(batch), *map(F.lit, more), *key)

    def write(rows: DataFrame, batch: int) -> None:
        if buffer_rows:
            if batch:
                rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{out}_held/batch={batch - 1}"))
            total = rows.count()
            cut = round(min(1.0, buffer_rows / max(total, 1)) * (1 << 32))
            stays = F.pmod(turn(batch, "stays"), F.lit(1 << 32)) < cut
            rows.where(stays).write.mode("overwrite").parquet(f"{out}_held/batch={batch}")
            rows = rows.where(~stays)
        rows.orderBy(turn(batch), *key).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return run_available(stream, write, checkpoint)


def drained(spark: SparkSession, out: str, key: list[str], seed: int = 0) -> DataFrame:
    """The rows that a shuffle still holds after its last batch, shuffled."""
    held = spark.read.parquet(f"{out}_held")
    last = held.agg(F.max("batch")).first()[0]
    return held.where(F.col("batch") == F.lit(last)).drop("batch").orderBy(F.xxhash64(F.lit(seed), F.lit("last"), *key), *key)


def status_counts(stream: DataFrame) -> DataFrame:
    """Running songs, rows and notes by status, for output mode update or complete."""
    return stream.groupBy("status").agg(F.count("*").alias("songs"), F.sum("num_rows").alias("rows"), F.sum("num_notes").alias("notes"))


def validation_rows(rows: DataFrame, key: list[str], n: int) -> DataFrame:
    """The first n rows by key, for validation; an empty input is an error."""
    held = rows.orderBy(*key).limit(n)
    if held.isEmpty():
        raise ValueError("no rows to validate on")
    return held


def training_rows(rows: DataFrame, held: DataFrame, key: list[str]) -> DataFrame:
    """All rows but those held for validation."""
    return rows.join(held.select(*key), key, "left_anti")


def encode_stream(lines: DataFrame, encode: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Encode the songs of each batch of files, as lines or whole texts; a song is one file, so batches share no
    state. A batch that is run again replaces its own output."""

    def write(rows: DataFrame, batch: int) -> None:
        encode(rows).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return run_available(lines, write, checkpoint)
