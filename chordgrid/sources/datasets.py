"""Opening shards and datasets, with a report of what could not be read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.operators.dataset import SCHEMA
from chordgrid.operators.quality import footer_schemas
from chordgrid.sources.folders import few_listing_tasks


def read_shards(spark: SparkSession, path: str, split: str | None = None, schema: T.StructType = SCHEMA) -> DataFrame:
    """The rows of a folder's Parquet shards, of one split or all; unreadable shards are passed over."""
    glob = f"{split}-*.parquet" if split else "*.parquet"
    return spark.read.schema(schema).option("pathGlobFilter", glob).option("ignoreCorruptFiles", "true").parquet(path)


def read_named_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a dataset's shards with ``shard_name``, what their folder's name says. Partitions are not discovered, as
    that takes Spark time by the square of their number; names are plain, as numbered shards have them."""
    with few_listing_tasks(spark):
        rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    folder = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)
    return rows.withColumn("shard_name", F.substring_index(folder, "shard_name=", -1))


def unreadable_shards(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """path of the shards whose footer cannot be read; a shard without rows is fine."""
    return footer_schemas(spark, path, f"{split}-*.parquet" if split else "*.parquet").where("type = 'unreadable'").select(F.col("file").alias("path"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def open_dataset(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A dataset by the shape of its path: .jsonl, .json (one document), or Parquet."""
    if path.endswith(".jsonl"):
        reader = spark.read
        return (reader.schema(schema) if schema else reader).json(path)
    if path.endswith(".json"):
        reader = spark.read.option("multiLine", True)
        return (reader.schema(schema) if schema else reader).json(path)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def shard_manifest(rows: DataFrame) -> DataFrame:
    """file, row_index of each row: where it stands in its shard."""
    return rows.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row_index"))


def with_file_day(rows: DataFrame, name: str = "day") -> DataFrame:
    """rows of files with the day on which their file was written, as for a split of shards by date."""
    return rows.withColumn(name, F.to_date(F.col("_metadata.file_modification_time")))


def shard_dates(rows: DataFrame) -> DataFrame:
    """date, files: the days on which shards were written."""
    day = F.to_date(F.col("_metadata.file_modification_time"))
    return rows.select(day.alias("date"), F.col("_metadata.file_path").alias("f")).distinct().groupBy("date").agg(F.count("*").alias("files")).orderBy("date")


def audio_files(files: DataFrame, extensions: tuple[str, ...] = ("ogg", "mp3", "wav", "opus", "flac")) -> DataFrame:
    """dir, path of files (path) with an audio extension, sorted."""
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return files.where(ext.isin(*extensions)).select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), "path").distinct().orderBy("path")
