"""Folders and files of any Hadoop file system: a shared scratch folder, listings, and whole-file moves.

These touch names only, never contents, and run on the driver, as Spark's own commits do.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share; without that setting a
    temporary one on a local master, and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def kept(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written once in a shared folder and read back, for several readers."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


class Folder:
    """One folder and what is below it, by names relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.jvm = path.rstrip("/"), spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def qualified(self) -> str:
        """The folder's path as the file system lists what is below it."""
        return self.fs.makeQualified(self._path("")).toString()

    def names(self, below: str = "") -> list[str]:
        """Names of the files and folders directly below; none if there is no such folder."""
        if not self.fs.exists(self._path(below)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(below)))

    def bytes(self, name: str = "") -> int:
        """The length of a file, or of all files below a folder."""
        return self.fs.getContentSummary(self._path(name)).getLength()

    def exists(self) -> bool:
        return self.fs.exists(self._path(""))

    def make(self, name: str) -> None:
        """A folder of that name, and those above it, where there is none."""
        self.fs.mkdirs(self._path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def set_time(self, name: str, ms: int) -> None:
        """Sets when a file was last modified, in milliseconds since 1970."""
        self.fs.setTimes(self._path(name), ms, -1)

    def replace(self, source: str, target: str) -> None:
        """Moves a file to a name that another file may have; where the file system can, in one step."""
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        flags = self.gateway.new_array(options, 1)
        flags[0] = options.OVERWRITE
        source_path, target_path = (self.fs.makeQualified(self._path(x)) for x in (source, target))
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(source_path, target_path, flags)


def file_system(path: str) -> tuple[FileSystem, str]:
    """pyarrow's file system of a Hadoop path, and the path on it."""
    if path.startswith("file:"):
        return LocalFileSystem(), re.sub("^file:/*", "/", path)
    return FileSystem.from_uri(quote(path, safe=":/@?&=+,~"))


def opens(path: str) -> bool:
    """Can pyarrow open the file system of a path?"""
    try:
        file_system(path)
    except (OSError, pa.ArrowException):
        return False
    return True


def names_below(path: str, leaf: re.Pattern) -> Iterator[str]:
    """Names of the files and folders below a folder that the pattern finds, none if there is no such folder; hidden ones
    are left out, and what is below a found one is not listed."""
    system, base = file_system(path)
    left = [base]
    while left:
        for info in system.get_file_info(FileSelector(left.pop(), allow_not_found=True)):
            if info.base_name.startswith(("_", ".")):
                continue
            if leaf.search(info.base_name):
                yield info.base_name
            elif info.type == FileType.Directory:
                left.append(info.path)


#: What Spark escapes in the names of folders that hold values, and the name of an empty one.
_ODD, _NO_VALUE = re.compile("[\x01-\x1F\"#%'*/:=?\\\\\x7F{\\[\\]^]"), "__HIVE_DEFAULT_PARTITION__"


def folder_of(by: list[str], values: list[str]) -> str:
    """The folder of values of some columns, one level for each, named as Spark names and reads them."""
    safe = lambda x: _ODD.sub(lambda m: f"%{ord(m[0]):02X}", x)
    return "/".join(f"{safe(c)}={safe(v) or _NO_VALUE}" for c, v in zip(by, values))


def write_folders(rows: DataFrame, root: str, by: list[str], compression: str = "zstd") -> None:
    """Adds rows as Parquet files to the folders of their values of ``by``, one file for each folder that a task meets.

    For very many small folders: tasks write files below a hidden folder, and when all are there, tasks move them to
    their folders; so a run that fails while it writes leaves nothing, and the driver touches no file. Only files that
    a task has reported are moved, so an attempt that was given up adds nothing.
    """
    spark, run = rows.sparkSession, uuid.uuid4().hex
    folder = Folder(spark, root)
    target = folder.qualified()
    kept_columns = [c for c in rows.columns if c not in by]
    values = F.concat_ws("\0", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by])
    placed = rows.select(*kept_columns, values.alias("_values")).sortWithinPartitions("_values")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(target)
        context = TaskContext.get()
        own = f"_staged-{run}/{context.taskAttemptId()}"
        system.create_dir(f"{base}/{own}", recursive=True)
        found: list[tuple[str, str]] = []
        writer, here = None, None
        try:
            for batch in batches:
                data = batch.select(kept_columns)
                runs = pc.run_end_encode(batch.column("_values"))
                start = 0
                for values, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                    if values != here:
                        if writer:
                            writer.close()
                        here, writer = values, pq.ParquetWriter(f"{base}/{own}/{len(found)}.parquet", data.schema, filesystem=system, compression=compression)
                        found.append((f"{own}/{len(found)}.parquet", f"{folder_of(by, values.split(chr(0)))}/part-{context.partitionId():05d}-{run}.parquet"))
                    writer.write_batch(data.slice(start, end - start))
                    start = end
        finally:
            if writer:
                writer.close()
        yield pa.record_batch([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())], ["source", "target"])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(target)
        for batch in batches:
            for source, name in zip(batch.column("source").to_pylist(), batch.column("target").to_pylist()):
                system.create_dir(f"{base}/{name}".rpartition("/")[0], recursive=True)
                try:
                    system.move(f"{base}/{source}", f"{base}/{name}")
                except FileNotFoundError:  # an earlier attempt may have moved it
                    if system.get_file_info(f"{base}/{name}").type == FileType.NotFound:
                        raise
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], ["files"])

    try:
        files = kept(placed.mapInArrow(write, "source string, target string"), scratch_folder(spark), "files")
        files.repartition(shuffle_width(spark), "source").mapInArrow(move, "files long").write.format("noop").mode("overwrite").save()
    finally:
        folder.delete(f"_staged-{run}")


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Lists of very many paths that are made inside are the work of a few tasks for each core, not of a task for each path,
    up to 10,000 of them, which take longer to start than to list."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, few = spark.conf.get(key, None), 4 * spark.sparkContext.defaultParallelism
    if before is None or int(before) > few:
        spark.conf.set(key, str(few))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_files(files: DataFrame, root: str, parts: int | None = None) -> None:
    """Each row (name, value) as a text file of that name, folders included, below a folder. Tasks write them under
    their final names, so the driver touches no file; a task that runs again writes the same files anew.

    On a file system that pyarrow cannot open Spark writes a folder for each name, and the driver moves the files.
    """
    spark = files.sparkSession
    folder = Folder(spark, root)
    target = folder.qualified()
    # by number: rows are few bytes, files are many
    rows = files.select("name", "value").repartition(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), "name")
    try:
        file_system(target)
    except (OSError, pa.ArrowException):
        rows.write.partitionBy("name").text(f"{target}/tmp")
        for row in files.select("name").toLocalIterator():
            own = f"tmp/name={spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(row['name'])}"
            folder.fs.mkdirs(folder._path(row["name"]).getParent())
            folder.replace(f"{own}/{next(n for n in folder.names(own) if n.startswith('part-'))}", row["name"])
        folder.delete("tmp")
        return

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(target)
        done = 0
        for batch in batches:
            for name, value in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist()):
                system.create_dir(f"{base}/{name}".rpartition("/")[0], recursive=True)
                with system.open_output_stream(f"{base}/{name}") as out:
                    out.write((value or "").encode() + b"\n")
                done += 1
        yield pa.record_batch([pa.array([done], pa.int64())], ["files"])

    rows.mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()
