"""Rewriting shards to one schema, file for file."""

from __future__ import annotations

from collections import defaultdict

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.operators.dataset import SCHEMA, conform
from chordgrid.operators.quality import footer_schemas, footer_stats, schema_diff
from chordgrid.sources.folders import Folder

#: Shards of one run are rewritten in groups of about so many, each put in place before the next.
GROUP = 64
STAGE = "_repair"


def arrow_types(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """column, type of a schema, in the words of Parquet footers."""
    rows = [(f.name, str(f.type)) for f in spark.createDataFrame([], schema).toArrow().schema]
    return spark.createDataFrame(rows, "column string, type string")


def repair_plan(spark: SparkSession, path: str, split: str | None = None, schema: T.StructType = SCHEMA) -> DataFrame:
    """What a repair would change, column by column: file, column, action (add / drop / cast), found and wanted type.

    Only footers are read. Names of list items do not count as a difference; an unreadable shard has the action
    ``unreadable`` and no column.
    """
    found = footer_schemas(spark, path, f"{split}-*.parquet" if split else "*.parquet")
    broken = found.where("type = 'unreadable'").select("file", F.lit(None).cast("string").alias("column"), F.lit("unreadable").alias("action"), F.lit(None).cast("string").alias("found"), F.lit(None).cast("string").alias("wanted"))
    diff = schema_diff(found.where("type <> 'unreadable'"), arrow_types(spark, schema))
    action = F.when(F.col("issue") == "MISSING", "add").when(F.col("issue") == "EXTRA", "drop").otherwise("cast")
    plan = diff.select("file", "column", action.alias("action"), "found", "wanted").union(broken)
    return plan.withColumn("file", F.regexp_extract("file", "([^/]*)$", 1))


def repair_shards(spark: SparkSession, path: str, split: str | None = None, schema: T.StructType = SCHEMA, compression: str = "zstd", failed: str = "cell", group: int = GROUP) -> DataFrame:
    """Rewrites the shards of a folder whose schema is another one, and reports file, status and columns changed.

    A shard keeps its name, its rows and their order, and gets the schema's columns as :func:`conform` makes
    them (``failed``: as there, for each shard by itself). Shards of one schema are read together, in groups; a
    group is written below ``_repair``, its rows are counted against the old files' footers, and each file then
    takes the old one's place in one move. A run that was cut off leaves old or new shards, no half ones; the
    next run clears its stage, finds the new ones in order, and goes on with the rest. Unreadable shards stay as
    they are, and so do those whose rewrite fails: ``status`` is ok, repaired, unreadable or failed.
    """
    folder = Folder(spark, path)
    folder.delete(STAGE)
    names = f"{split}-*.parquet" if split else "*.parquet"
    plan = repair_plan(spark, path, split, schema)
    changes = {r["file"]: r for r in plan.groupBy("file").agg(F.array_sort(F.collect_list("column")).alias("columns"), F.bool_or(F.col("action") == "unreadable").alias("unreadable")).collect()}
    stats = footer_stats(spark, path, names).groupBy("file").agg(F.max("rows").alias("rows"), F.md5(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "column", "type"))), ",")).alias("kind"))
    # one small row for each shard, as the file listing has it
    shards = {r["file"].rpartition("/")[2]: r for r in stats.collect()}
    report, kinds = {}, defaultdict(list)
    for name in sorted(set(shards) | set(changes)):
        if name not in changes:
            report[name] = ("ok", [])
        elif changes[name]["unreadable"]:
            report[name] = ("unreadable", [])
        else:
            kinds[shards[name]["kind"]].append(name)
    for same in kinds.values():
        for k in range(0, len(same), group):
            _rewrite(folder, spark, same[k : k + group], shards, schema, compression, failed, changes, report)
    folder.delete(STAGE)
    return spark.createDataFrame([(name, status, columns) for name, (status, columns) in sorted(report.items())], "file string, status string, columns array<string>")


def _rewrite(folder: Folder, spark: SparkSession, names: list[str], shards: dict, schema: T.StructType, compression: str, failed: str, changes: dict, report: dict) -> None:
    try:
        rows = spark.read.parquet(*[f"{folder.path}/{name}" for name in names])
        file, at = "_shard_file", "_shard_row"
        rows = rows.select("*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(at))
        keep = T.StructType([*schema, T.StructField(file, T.StringType()), T.StructField(at, T.LongType())])
        fixed = conform(rows, keep, failed, by=file)
        folder.delete(STAGE)
        stage = f"{folder.path}/{STAGE}"
        # all rows of a shard meet in one task, in their order, and make one file
        fixed.repartition(len(names), file).sortWithinPartitions(file, at).drop(at).write.partitionBy(file).option("compression", compression).parquet(stage)
        written = footer_stats(spark, stage, "part-*.parquet").groupBy("file").agg(F.max("rows").alias("rows")).collect()
        staged = {r["file"].rpartition("/")[0].rpartition("=")[2]: r for r in written}
    except (PySparkException, Py4JJavaError):
        if len(names) > 1:  # one of them is to blame
            for name in names:
                _rewrite(folder, spark, [name], shards, schema, compression, failed, changes, report)
            return
        report[names[0]] = ("failed", [])
        return
    for name in names:
        new = staged.get(name)
        if new is None and shards[name]["rows"] == 0:  # no rows, so no file was written: nothing to keep but the schema
            conform(spark.read.parquet(f"{folder.path}/{name}"), schema).limit(0).coalesce(1).write.option("compression", compression).parquet(f"{folder.path}/{STAGE}/none={name}")
            part = next(x for x in folder.names(f"{STAGE}/none={name}") if x.startswith("part-"))
            folder.replace(f"{STAGE}/none={name}/{part}", name)
        elif new is None or new["rows"] != shards[name]["rows"]:
            report[name] = ("failed", [])
            continue
        else:
            folder.replace(f"{STAGE}/{file}={name}/{new['file'].rpartition('/')[2]}", name)
        report[name] = ("repaired", list(changes[name]["columns"]))
