"""What the operators share: the shared working folder and tables written in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all word rules, as a Java and a Python pattern class.
SPACE = r"\x20\x09-\x0D"


def work_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Where the session sets none, a temporary folder serves on one machine; on a cluster that is an
    error, as each executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


#: Rows of two numbers for one file.
FILE_ROWS = 1_000_000


def files_for(rows: int) -> int:
    """How many files and tasks a narrow table of so many rows is worth."""
    return max(8, -(-rows // FILE_ROWS))


def written(df: DataFrame, folder: str, name: str, files: int | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the lineage, survives lost
    executors, and gives later joins true sizes. ``files``: at most so many, for tables known to be small."""
    path = f"{folder}/{name}"
    (df.coalesce(files) if files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table of the shared folder that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (compared without case)."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out


def normal_space(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def words_of(text: Column) -> Column:
    """Words of the pattern [^\\x20\\x09-\\x0D]+ as an array; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Key tables up to this many rows, list items included, may be broadcast (some tens of MB at most).
BROADCAST_ROWS = 1_000_000


def sized_hint(keys: DataFrame, lists: str | None = None) -> str:
    """The join hint for a small side that has been written out: its rows, and the items of its list
    column, are counted; above the bound both sides are shuffled and sorted, which spills and is split."""
    size = F.sum(F.size(lists) + 1) if lists else F.count("*")
    return "broadcast" if (keys.agg(size).first()[0] or 0) <= BROADCAST_ROWS else "merge"
