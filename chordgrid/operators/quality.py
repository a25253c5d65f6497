"""Schema and shape reports over shards."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.sources.folders import Folder


def schema_rows(df: DataFrame, file: str = "table") -> DataFrame:
    """file, column, type of a DataFrame's own schema."""
    return df.sparkSession.createDataFrame([(file, f.name, f.dataType.simpleString()) for f in df.schema.fields], "file string, column string, type string")


def open_seekable(name: str) -> pa.NativeFile:
    """A file by its Hadoop path, for reads with seeks, by pyarrow's file systems."""
    if name.startswith("file:"):
        return pa.OSFile(re.sub("^file:/*", "/", name))
    system, path = FileSystem.from_uri(quote(name, safe=":/@?&=+,~"))
    return system.open_input_file(path)


class HadoopFile(io.RawIOBase):
    """A file that only the JVM's file systems open, for reads with seeks on the driver."""

    def __init__(self, spark: SparkSession, name: str, length: int):
        self.jvm, self.length, self.at = spark.sparkContext._jvm, length, 0
        path = self.jvm.org.apache.hadoop.fs.Path(name)
        self.stream = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(path)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.length)[whence]
        return self.at

    def read(self, n: int = -1) -> bytes:
        left = max(0, self.length - self.at)
        n = left if n is None or n < 0 else min(n, left)
        self.stream.seek(self.at)
        self.at += n
        return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(self.stream, n)) if n else b""

    def close(self) -> None:
        if not self.closed:
            self.stream.close()
        super().close()


#: What a footer says of a column: its type, and of all row groups together rows, nulls, least and greatest value
#: (as text; null where the file does not say, and for nested columns) and bytes. An unreadable file has the type
#: ``unreadable``; rows of a file without columns have no column.
FOOTER = "file string, column string, type string, rows long, nulls long, low string, high string, bytes long"


def footer_rows(name: str, file: pa.NativeFile) -> list[tuple]:
    """FOOTER rows of an open Parquet file: only its footer is read."""
    with file:
        try:
            meta = pq.ParquetFile(file).metadata
            schema = meta.schema.to_arrow_schema()
        except (pa.ArrowInvalid, OSError):
            return [(name, None, "unreadable", *[None] * 5)]
    found = {f.name: [0, 0, None, None, True, True] for f in schema}
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for k in range(group.num_columns if group.num_rows else 0):
            chunk = group.column(k)
            column = chunk.path_in_schema.split(".")[0] if chunk.path_in_schema not in found else chunk.path_in_schema
            one = found[column]
            one[0] += chunk.total_compressed_size
            stats = chunk.statistics if chunk.path_in_schema == column else None
            one[4] &= stats is not None and stats.has_null_count
            one[5] &= stats is not None and (stats.has_min_max or stats.null_count == group.num_rows)
            if one[4]:
                one[1] += stats.null_count
            if one[5] and stats.has_min_max:
                one[2] = stats.min if one[2] is None else min(one[2], stats.min)
                one[3] = stats.max if one[3] is None else max(one[3], stats.max)
    text = lambda x: x.hex() if isinstance(x, bytes) else None if x is None else str(x)
    rows = [(name, f.name, str(f.type), meta.num_rows, *(lambda size, nulls, low, high, counted, bounded: (nulls if counted else None, text(low) if bounded else None, text(high) if bounded else None, size))(*found[f.name])) for f in schema]
    return rows or [(name, None, None, meta.num_rows, *[None] * 4)]


#: Files up to this size of a file system that only the JVM opens are read whole by tasks; larger ones have
#: their footers read by the driver.
WHOLE_BYTES = 1 << 29


def footer_stats(spark: SparkSession, path: str, names: str = "*.parquet") -> DataFrame:
    """FOOTER rows of a folder's Parquet files, by their own footers; no page of data is read.

    Tasks open the files and read the footers alone, whatever the files' size. On a file system that
    pyarrow cannot open, tasks get whole files from Spark's own reader.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", "true").load(path)
    schemes = files.select(F.substring_index("path", ":", 1).alias("scheme"), "path").groupBy("scheme").agg(F.min("path").alias("path")).collect()
    foreign = []
    for r in schemes:
        try:
            open_seekable(r["path"]).close()
        except (OSError, pa.ArrowException):
            foreign.append(r["scheme"])

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string()] * 3 + [pa.int64()] * 2 + [pa.string()] * 2 + [pa.int64()]
        return pa.record_batch([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], [x.split(" ")[0] for x in FOOTER.split(", ")])

    def by_name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield rows_of([x for name in batch.column("path").to_pylist() for x in footer_rows(name, open_seekable(name))])

    def by_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield rows_of(footer_rows(batch.column("path")[k].as_py(), pa.BufferReader(batch.column("content")[k].as_buffer())))

    apart = F.substring_index("path", ":", 1).isin(foreign)
    out = files.where(~apart).select("path").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").mapInArrow(by_name, FOOTER)
    if foreign:
        out = out.unionByName(files.where(apart & (F.col("length") <= WHOLE_BYTES)).select("path", "content").mapInArrow(by_content, FOOTER))
        large = files.where(apart & (F.col("length") > WHOLE_BYTES)).select("path", "length").toLocalIterator()
        rows = [x for r in large for x in footer_rows(r["path"], pa.PythonFile(HadoopFile(spark, r["path"], r["length"]), "r"))]
        if rows:
            out = out.unionByName(spark.createDataFrame(rows, FOOTER))
    return out


def footer_schemas(spark: SparkSession, path: str, names: str = "*.parquet") -> DataFrame:
    """file, column, type as each Parquet file's own footer has them; of an unreadable one, the type says so."""
    return footer_stats(spark, path, names).where("type is not null").select("file", "column", "type")


def footer_census(stats: DataFrame) -> DataFrame:
    """column, files, rows, nulls, ratio, low, high, bytes of a set of shards, from FOOTER rows alone.

    ``nulls`` is null where a file that has the column does not count them; a file that lacks it counts all its
    rows as nulls. Bounds are least and greatest by text for text, by number for numbers.
    """
    good = stats.where("column is not null")
    total = stats.groupBy("file").agg(F.max("rows").alias("n")).agg(F.sum("n").alias("all_rows"))
    number = F.col("type").rlike("^(u?int|float|double|decimal)")
    key = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.when(number, F.col(c).try_cast("double")).alias("x"), F.col(c).alias("t")))
    rows = good.groupBy("column").agg(F.countDistinct("file").alias("files"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.count_if(F.col("nulls").isNull()).alias("unknown"), F.min(key("low")).alias("low"), F.max(key("high")).alias("high"), F.sum("bytes").alias("bytes"))
    nulls = F.when(F.col("unknown") == 0, F.col("nulls") + F.col("all_rows") - F.col("rows"))
    both = rows.join(F.broadcast(total))  # one row
    return both.select("column", "files", "rows", nulls.alias("nulls"), F.try_divide(nulls, F.col("all_rows")).alias("ratio"), F.col("low.t").alias("low"), F.col("high.t").alias("high"), "bytes")


def dataset_schemas(spark: SparkSession, path: str) -> DataFrame:
    """file, column, type of the datasets directly below a folder, by their names: files, and folders whose part files
    count as one. What all parts say alike is said once; a column that they give two types has two rows."""
    root = Folder(spark, path).qualified()
    name = F.substring_index(F.substring("file", len(root) + 2, 1 << 30), "/", 1)
    return footer_schemas(spark, path).select(name.alias("file"), "column", "type").distinct()


def schema_diff(found: DataFrame, wanted: DataFrame | T.StructType) -> DataFrame:
    """file, column, issue (MISSING / EXTRA / TYPE), found and wanted type; names of list items do not count.

    ``wanted`` is one schema, small as schemas are: (column, type) rows of it, or a StructType. Each file's
    columns meet it in the file's own row, as a list, so files are not crossed with columns. A column that a file
    has with two types is compared with each.
    """
    if isinstance(wanted, DataFrame):
        pairs = [(r["column"], r["type"]) for r in wanted.select("column", "type").collect()]
    else:
        pairs = [(f.name, f.dataType.simpleString()) for f in wanted.fields]
    plain = lambda c: F.regexp_replace(c, "element", "item")
    want = F.map_from_entries(F.array(*[F.struct(F.lit(c), F.lit(t.replace("element", "item"))) for c, t in dict(pairs).items()]))
    files = found.groupBy("file").agg(F.collect_set(F.when(F.col("column").isNotNull(), F.struct("column", plain(F.col("type")).alias("type")))).alias("m"))
    row = lambda column, kind: F.struct(column.alias("column"), kind.cast("string").alias("found"), F.try_element_at("w", column).alias("wanted"))
    missing = F.array_except(F.map_keys("w"), F.transform("m", lambda x: x["column"]))
    every = F.concat(F.transform("m", lambda x: row(x["column"], x["type"])), F.transform(missing, lambda c: row(c, F.lit(None))))
    rows = files.withColumn("w", want).select("file", F.explode(every).alias("r")).select("file", "r.*")
    issue = F.when(F.col("found").isNull(), "MISSING").when(F.col("wanted").isNull(), "EXTRA").when(F.col("found") != F.col("wanted"), "TYPE")
    return rows.select("file", "column", issue.alias("issue"), "found", "wanted").where("issue is not null")


def shard_report(spark: SparkSession, path: str, wanted: DataFrame | T.StructType) -> DataFrame:
    """file, issue, columns: how many columns of each dataset below the folder are missing, extra or of another type."""
    diff = schema_diff(dataset_schemas(spark, path), wanted)
    return diff.groupBy("file", "issue").agg(F.countDistinct("column").alias("columns"))


def schema_census(found: DataFrame) -> DataFrame:
    """fingerprint, files: how many files have each schema, most first."""
    one = found.groupBy("file").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "column", "type"))), ",").alias("fingerprint"))
    return one.groupBy("fingerprint").agg(F.count("*").alias("files")).orderBy(F.desc("files"), "fingerprint")


def null_census(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, nulls, ratio of the columns, in one pass."""
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = counts.select("n", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])).alias("r"))
    return rows.select("r.column", "r.nulls", F.try_divide(F.col("r.nulls"), F.col("n")).alias("ratio"))


def shape_issues(df: DataFrame, keys: list[str], column: str, width: int) -> DataFrame:
    """keys.., beat, issue of nested arrays: rows that are null, of another width, or with null items."""
    rows = df.select(*keys, F.posexplode_outer(column).alias("beat", "row"))
    issue = F.when(F.col("row").isNull(), "null row").when(F.size("row") != width, F.concat(F.lit("width "), F.size("row"))).when(F.exists("row", lambda x: x.isNull()), "null item")
    return rows.withColumn("issue", issue).where("issue is not null").drop("row")


def first_issues(issues: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The first n issues of each group, for a report."""
    return issues.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rn") <= n)
