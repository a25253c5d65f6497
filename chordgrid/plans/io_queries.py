"""Sources, sinks and streams: files are written from the driver tables in the shared folder and read again."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.operators import batching as B, dataset as D, drift
from chordgrid.operators.chart_codec import LineEncoder
from chordgrid.plans.catalog import query
from chordgrid.plans.chart_queries import texts_of
from chordgrid.plans.views import Views, sql_hash
from chordgrid.sources import charts as C, datasets as DS
from chordgrid.sources.folders import Folder, few_listing_tasks, kept, scratch_folder, shuffle_width, write_files
from chordgrid.streaming import streams as ST

_ORDER = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"
_KEYS = ["o_orderkey", "o_custkey", "o_orderstatus"]


def orders(v: Views) -> DataFrame:
    return v.table("orders").select(*_KEYS)


def named_file(df: DataFrame, root: str, name: str, kind: str = "parquet") -> None:
    """One file of that name below a folder."""
    df.coalesce(1).write.format(kind).save(f"{root}/tmp")
    folder = Folder(df.sparkSession, root)
    folder.replace(f"tmp/{next(n for n in folder.names('tmp') if n.startswith('part-'))}", name)
    folder.delete("tmp")


def shards(v: Views, n: int = 6, broken: bool = False) -> str:
    """A folder of n shards of ``orders``, dealt by key: the last one is test, one may be broken."""
    root = scratch_folder(v.spark)
    for i in range(n):
        named_file(orders(v).where(F.col("o_orderkey") % n == i).sortWithinPartitions(*_KEYS), root, f"{'train' if i < n - 1 else 'test'}-{i:05d}.parquet")
    if broken:
        named_file(v.spark.createDataFrame([("no Parquet",)], "value string"), root, "train-00099.parquet", "text")
    return root


def name_of(path: str):
    """What follows a path's last slash; no pattern, which would begin anew at each letter of every row's path."""
    return F.substring_index(path, "/", -1)


@query("s1_song_folders", "SELECT 'song=' || s_suppkey AS dir, s_suppkey % 3 <> 0 AS has_chart, s_suppkey % 3 = 0 AS has_midi FROM supplier")
def _(v):
    root = scratch_folder(v.spark)
    k = F.col("s_suppkey")
    name = F.concat(F.lit("song="), k, F.lit("/notes."), F.when(k % 3 == 0, "mid").otherwise("chart"))
    write_files(v.table("supplier").select(name.alias("name"), F.concat(F.lit("x "), "s_name").alias("value")), root)
    return C.song_folders(v.spark, root).withColumn("dir", name_of("dir"))


@query("s2_numbered_lines", "SELECT CAST(s_suppkey AS VARCHAR) AS song, CAST(unnest(range(4)) AS INT) AS line_no, unnest([s_name, '', chr(9) || 'key = ' || s_nationkey, 'last']) AS line FROM supplier")
def _(v):
    """Whole text files as numbered lines; ends of lines, carriage returns included, are trimmed."""
    root = scratch_folder(v.spark)
    text = F.concat("s_name", F.lit(" \r\n\r\n\tkey = "), "s_nationkey", F.lit("\t\nlast"))
    k = F.col("s_suppkey")  # a thousand files a folder: one list of names each, however many songs
    write_files(v.table("supplier").select(F.concat(F.floor(k / 1000), F.lit("/song="), k, F.lit(".txt")).alias("name"), F.concat(text, F.lit("\n")).alias("value")), root)
    lines = C.read_lines(v.spark, root).withColumn("song", F.regexp_extract("path", r"song=([^/]*)\.txt$", 1))
    return lines.where("line_no < 4").select("song", "line_no", "line")


@query("s9_shards_of_a_split", "SELECT o_orderkey, o_custkey, o_orderstatus, 'read' AS what FROM orders WHERE o_orderkey % 6 <> 5 UNION ALL SELECT NULL, NULL, 'train-00099.parquet', 'unreadable' FROM (SELECT count(*) AS n FROM orders) WHERE n > 0")
def _(v):
    """The train shards' rows, and the one that cannot be read."""
    root, schema = shards(v, broken=True), T.StructType.fromDDL(_ORDER)
    rows = DS.read_shards(v.spark, root, "train", schema).withColumn("what", F.lit("read"))
    bad = DS.unreadable_shards(v.spark, root, "train").select(name_of("path").alias("o_orderstatus"), F.lit("unreadable").alias("what"))
    return rows.unionByName(bad, allowMissingColumns=True)


@query("s10_json_lines", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(v):
    root = scratch_folder(v.spark)
    v.table("customer").select("c_custkey", "c_name", "c_mktsegment").write.json(root)
    return DS.read_jsonl(v.spark, root, T.StructType.fromDDL("c_custkey bigint, c_name string, c_mktsegment string"))


@query("s11_opened_datasets", "SELECT shape, s_suppkey, s_name FROM supplier, (SELECT unnest(['parquet', 'jsonl', 'json']) AS shape)")
def _(v):
    """One table in three shapes, each opened by the shape of its path."""
    root, rows = scratch_folder(v.spark), v.table("supplier").select("s_suppkey", "s_name")
    rows.write.parquet(f"{root}/a")
    named_file(rows, root, "a.jsonl", "json")
    named_file(rows.agg(F.to_json(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("value")), root, "a.json", "text")  # one document, as the shape has it
    out = [DS.open_dataset(v.spark, f"{root}/{name}").select(F.lit(shape).alias("shape"), F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name") for shape, name in (("parquet", "a"), ("jsonl", "a.jsonl"), ("json", "a.json"))]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("s12_projected_scan", "SELECT label, count(*) AS vectors, round(sum(embedding[1]), 4) AS first_sum FROM embeddings GROUP BY label")
def _(v):
    """Vectors of one column, none of the others."""
    root = scratch_folder(v.spark)
    named_file(v.table("embeddings").withColumn("other", F.lit("x")), root, "train-00000.parquet")
    schema = v.table("embeddings").select("label", "embedding").schema
    rows = DS.read_shards(v.spark, root, "train", schema)
    return rows.groupBy("label").agg(F.count("*").alias("vectors"), F.round(F.sum(F.col("embedding")[0].cast("double")), 4).alias("first_sum"))


@query("s13_audio_files", "SELECT DISTINCT '/music/' || p_brand AS dir, '/music/' || p_brand || '/' || p_partkey || '.' || CASE p_partkey % 4 WHEN 0 THEN 'ogg' WHEN 1 THEN 'MP3' ELSE 'Flac' END AS path FROM part WHERE p_partkey % 4 <> 3")
def _(v):
    ending = F.element_at(F.array(*map(F.lit, ("ogg", "MP3", "Flac", "txt"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    files = v.table("part").select(F.concat(F.lit("/music/"), "p_brand", F.lit("/"), "p_partkey", F.lit("."), ending).alias("path"))
    return DS.audio_files(files.union(files))


@query("s14_manifest", "SELECT (CASE WHEN o_orderkey % 6 < 5 THEN 'train-0000' ELSE 'test-0000' END) || o_orderkey % 6 || '.parquet' AS file, row_number() OVER (PARTITION BY o_orderkey % 6 ORDER BY o_orderkey, o_custkey, o_orderstatus) - 1 AS row_index FROM orders")
def _(v):
    """Where every row stands in its shard."""
    return DS.shard_manifest(v.spark.read.parquet(shards(v)))


@query("k1_wide_rows", "SELECT CAST(c_custkey AS VARCHAR) AS song_id, c_name AS song_name, c_custkey % 7 || ',' || c_custkey % 11 AS tokens, CAST(c_custkey % 50 AS INT) AS year, CAST(NULL AS VARCHAR) AS artist, 30 AS columns FROM customer")
def _(v):
    """Rows of the whole schema written with a codec and read back."""
    root, k = scratch_folder(v.spark), F.col("c_custkey")
    rows = v.table("customer").select(k.alias("song_id"), F.col("c_name").alias("song_name"), F.array(k % 7, k % 11).alias("tokens"), (k % 50).cast("string").alias("year"))
    D.write_shards(D.conform(rows), f"{root}/x", compression="gzip", partition=None)
    back = v.spark.read.parquet(f"{root}/x")
    return back.select("song_id", "song_name", F.array_join(F.col("tokens").cast("array<string>"), ",").alias("tokens"), "year", "artist", F.lit(len(back.columns)).alias("columns"))


@query("k3_appended_shards", "SELECT shard_name, count(*) AS rows FROM (SELECT 'train-' || lpad(CAST(turn * (n + 49) // 50 + (row_number() OVER (PARTITION BY turn ORDER BY o_orderkey, o_custkey) - 1) // 50 AS VARCHAR), 5, '0') || '.parquet' AS shard_name FROM orders, (SELECT count(*) AS n FROM orders), (SELECT unnest([0, 1]) AS turn)) GROUP BY ALL")
def _(v):
    """Twice the same rows: the second time shards are numbered on from the first."""
    root = scratch_folder(v.spark)
    rows = orders(v).withColumns({"bytes": F.lit(100).cast("long"), "split": F.lit("train"), "at": F.struct("o_orderkey", "o_custkey")})
    for _ in range(2):
        D.append_shards(rows.select("o_orderkey", "o_custkey", "bytes", "split"), f"{root}/x", "bytes", 5000, "split", ["o_orderkey", "o_custkey"], partition=None)
    schema = T.StructType.fromDDL("o_orderkey bigint, o_custkey bigint, bytes bigint, split string, shard int")
    return DS.read_named_shards(v.spark, f"{root}/x", schema).groupBy("shard_name").agg(F.count("*").alias("rows"))


@query("k4_write_modes", "SELECT c_custkey, c_name, 'refused' AS again FROM customer WHERE c_custkey % 2 = 0")
def _(v):
    """A second write is refused; one that overwrites holds."""
    root, rows = scratch_folder(v.spark), v.table("customer").select("c_custkey", "c_name")
    D.write_shards(rows, f"{root}/x", partition=None)
    try:
        D.write_shards(rows, f"{root}/x", partition=None)
        again = "written"
    except AnalysisException:
        again = "refused"
    D.write_shards(rows.where("c_custkey % 2 = 0"), f"{root}/x", mode="overwrite", partition=None)
    return v.spark.read.parquet(f"{root}/x").withColumn("again", F.lit(again))


@query("k5_manifest", "SELECT o_orderstatus AS split, count(*) AS rows, (SELECT count(*) FROM orders) AS all_rows, (SELECT string_agg(DISTINCT 'i' || o_custkey % 3, ',' ORDER BY 'i' || o_custkey % 3) FROM orders) AS instruments, 'zstd' AS codec FROM orders GROUP BY 1")
def _(v):
    root = scratch_folder(v.spark)
    rows = v.table("orders").select(F.col("o_orderstatus").alias("split"), F.concat(F.lit("i"), F.col("o_custkey") % 3).alias("instrument"))
    D.write_manifest(rows, f"{root}/m", codec="zstd")
    one = v.spark.read.schema("rows bigint, splits map<string, bigint>, instruments array<string>, codec string").json(f"{root}/m")
    return one.select(F.explode("splits").alias("split", "rows"), F.col("rows").alias("all_rows"), F.array_join("instruments", ",").alias("instruments"), "codec")


def dated_shards(v: Views, table: str, key: str, n: int) -> str:
    """A folder of n shards of a table, dealt by key; shard i was written i days after the first of 2024, at noon."""
    root = scratch_folder(v.spark)
    for i in range(n):
        named_file(v.table(table).where(F.col(key) % n == i), root, f"train-{i:05d}.parquet")
        Folder(v.spark, root).set_time(f"train-{i:05d}.parquet", (1_704_110_400 + 86_400 * i) * 1000)
    return root


@query("a21_shard_dates", "SELECT CAST(DATE '2024-01-01' + CAST(p_partkey % 5 AS INT) AS DATE) AS date, count(DISTINCT p_partkey % 5) AS files FROM part GROUP BY 1")
def _(v):
    """The days on which shards were written, by their files' own times."""
    return DS.shard_dates(v.spark.read.parquet(dated_shards(v, "part", "p_partkey", 5)))


@query("l7_split_by_file_date", f"WITH r AS (SELECT vec_id, label, CASE WHEN vec_id % 5 < 2 THEN 'old' ELSE 'new' END AS side FROM embeddings) SELECT side, vec_id, label FROM r QUALIFY row_number() OVER (PARTITION BY side ORDER BY {sql_hash(4, 'vec_id')}, vec_id) <= 60")
def _(v):
    """Up to 60 vectors of the shards written before a day, and of those written from it on."""
    rows = DS.with_file_day(v.spark.read.parquet(dated_shards(v, "embeddings", "vec_id", 5)))
    sided = rows.select("vec_id", "label", F.when(F.col("day") < F.lit("2024-01-03").cast("date"), "old").otherwise("new").alias("side"))
    return drift.sample_by_group(sided, "side", "vec_id", 60, seed=4).select("side", "vec_id", "label")


# -- streams

def streamed(v: Views, root: str, **options) -> str:
    """The rows of a shard stream, written batch by batch with the number of files in each."""
    out = scratch_folder(v.spark)
    stream = ST.shard_stream(v.spark, root, T.StructType.fromDDL(_ORDER), **options).withColumn("file", name_of("_metadata.file_path"))
    ST.run_available(stream, lambda rows, batch: rows.write.mode("overwrite").parquet(f"{out}/x/batch={batch}"), f"{out}/check").awaitTermination()
    return f"{out}/x"


@query("r1_row_stream", "SELECT o_orderkey, o_custkey, o_orderstatus, (CASE WHEN o_orderkey % 6 < 5 THEN 'train-0000' ELSE 'test-0000' END) || o_orderkey % 6 || '.parquet' AS file FROM orders")
def _(v):
    return v.spark.read.parquet(streamed(v, shards(v))).drop("batch")


@query("r2_windows_of_shards", "SELECT count(*) AS rows, 3 AS batches, 2 AS most_files FROM orders")
def _(v):
    """Six shards, two a batch."""
    per = v.spark.read.parquet(streamed(v, shards(v), files_per_batch=2)).groupBy("batch").agg(F.countDistinct("file").alias("files"), F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("rows"), F.count("*").cast("int").alias("batches"), F.max("files").cast("int").alias("most_files"))


@query("r3_shuffle_buffer", "SELECT o_orderkey, o_custkey, o_orderstatus, true AS mixed FROM orders")
def _(v):
    """All rows, each once; batches hold rows of other batches' files."""
    root, out = shards(v), scratch_folder(v.spark)
    stream = ST.shard_stream(v.spark, root, T.StructType.fromDDL(_ORDER), files_per_batch=1).withColumn("file", name_of("_metadata.file_path"))
    ST.shuffled_batches(stream, ["o_orderkey", "o_custkey"], f"{out}/x", f"{out}/check", seed=5, buffer_rows=200).awaitTermination()
    gone = v.spark.read.parquet(f"{out}/x")
    files = gone.groupBy("batch").agg(F.countDistinct("file").alias("n")).agg(F.max("n").alias("most"))
    rows = gone.drop("batch").unionByName(ST.drained(v.spark, f"{out}/x", ["o_orderkey", "o_custkey"], seed=5)).drop("file")
    return rows.join(F.broadcast(files.select((F.col("most") > 1).alias("mixed"))))  # one row


@query("r4_validation_rows", "SELECT o_orderkey, o_custkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey, o_custkey) <= 40 THEN 'validation' ELSE 'train' END AS part FROM orders")
def _(v):
    rows, key = v.table("orders").select("o_orderkey", "o_custkey"), ["o_orderkey", "o_custkey"]
    held = ST.validation_rows(rows, key, 40)
    return held.withColumn("part", F.lit("validation")).unionByName(ST.training_rows(rows, held, key).withColumn("part", F.lit("train")))


@query("r5_resumed_run", "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 6 < 3 THEN 1 ELSE 2 END AS run FROM orders")
def _(v):
    """Shards that came after the first run are all that the second one reads."""
    root, out = scratch_folder(v.spark), scratch_folder(v.spark)
    for turn in (1, 2):
        for i in range(3 * turn - 3, 3 * turn):
            named_file(orders(v).where(F.col("o_orderkey") % 6 == i), f"{root}/s", f"train-{i:05d}.parquet")
        stream = ST.shard_stream(v.spark, f"{root}/s", T.StructType.fromDDL(_ORDER))
        ST.run_available(stream, lambda rows, batch, turn=turn: rows.write.mode("overwrite").parquet(f"{out}/x/run={turn}/batch={batch}"), f"{out}/check").awaitTermination()
    return v.spark.read.parquet(f"{out}/x").select(*_KEYS, "run")


@query("r6_running_counts", "SELECT o_orderstatus AS status, count(*) AS songs, sum(o_custkey) AS rows, sum(o_orderkey % 10) AS notes FROM orders GROUP BY 1")
def _(v):
    root, out = shards(v), scratch_folder(v.spark)
    stream = ST.shard_stream(v.spark, root, T.StructType.fromDDL(_ORDER), files_per_batch=2).select(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("num_rows"), (F.col("o_orderkey") % 10).alias("num_notes"))

    def write(counts: DataFrame, batch: int) -> None:
        counts.write.mode("overwrite").parquet(f"{out}/x/batch={batch}")

    ST.status_counts(stream).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{out}/check").trigger(availableNow=True).start().awaitTermination()
    counts = v.spark.read.parquet(f"{out}/x")
    return counts.groupBy("status").agg(*[F.max_by(c, "batch").alias(c) for c in ("songs", "rows", "notes")])


@query("r7_broken_files_in_a_stream", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(v):
    return v.spark.read.parquet(streamed(v, shards(v, broken=True), files_per_batch=3)).select(*_KEYS)


#: Streams that encode side by side, as a batch of files is planned and logged for longer than it keeps all cores busy.
_STREAMS = 4


@query("r8_streaming_encode", "SELECT DISTINCT CAST(song_id AS VARCHAR) AS song_id, instrument, true AS same FROM notes JOIN supplier ON s_suppkey = song_id WHERE song_id IN (SELECT song_id FROM tempo)", "notes", "tempo")
def _(v):
    """Charts encoded as their files come are as charts encoded together."""
    root, out = scratch_folder(v.spark), scratch_folder(v.spark)
    own = F.pmod(F.crc32("path"), F.lit(_STREAMS))  # a song's stream
    write_files(texts_of(v).select(F.concat(own, F.lit("/song="), "path", F.lit(".chart")).alias("name"), F.col("text").alias("value")), f"{root}/s")

    # a song's lines stay in one task; a batch is a bounded number of files, so its tasks are as many as the cluster runs
    encode, song, few = LineEncoder(), r"song=([^/]*)\.chart$", min(shuffle_width(v.spark), v.spark.sparkContext.defaultParallelism)
    with few_listing_tasks(v.spark):
        streams = []
        for i in range(_STREAMS):
            Folder(v.spark, root).make(f"s/{i}")
            texts = ST.text_stream(v.spark, f"{root}/s/{i}", song=song)
            streams.append(ST.encode_stream(texts, lambda rows: encode(C.numbered(rows, few)), f"{out}/x/stream={i}", f"{out}/check/{i}"))
        ST.await_all(streams)
    streamed_ = v.spark.read.parquet(f"{out}/x").select("song_id", "instrument", F.col("tokens").alias("a"))
    whole = encode(C.read_lines(v.spark, f"{root}/s", song, v.parts)).select("song_id", "instrument", F.col("tokens").alias("b"))
    return streamed_.join(whole.hint("merge"), ["song_id", "instrument"], "full").select("song_id", "instrument", F.col("a").eqNullSafe(F.col("b")).alias("same"))


# -- order of an epoch

_PERMUTED = """list_reduce(list_prepend(CAST({x} AS BIGINT), list_transform(range(1, 41), lambda r: CAST(r AS BIGINT))), lambda x, r: CASE WHEN ({mixed} // 65536) % 2 = 1 THEN {partner} ELSE x END)"""


def permuted_sql(x: str, n: str, start: str) -> str:
    """:func:`chordgrid.operators.batching.permuted` in SQL; ``start``: the seeds' number."""
    k = f"((({start} + r * 7919) * 48271 + 11) % {B._PRIME} * 48271 + 11) % {B._PRIME}"
    partner = f"((({k}) - x) % {n} + {n}) % {n}"
    high = f"greatest(x, {partner})"
    inner = f"((({high}) + ({k})) * 48271 + 11) % {B._PRIME}"
    mixed = f"(((({inner}) * 69621 + {high}) % {B._PRIME}) * 48271 + 11) % {B._PRIME}"
    return _PERMUTED.format(x=x, mixed=f"({mixed})", partner=partner)


def start_sql(*seeds: str) -> str:
    out = "CAST(0 AS BIGINT)"
    for s in seeds:
        out = f"(({out}) * 1000003 + ({s}) % {B._PRIME} + 12345) % {B._PRIME}"
    return out


_TURN = str(11 * 1_000_003 + 2)

@query("l3_epoch_places", f"""WITH m AS (SELECT o_orderkey, o_custkey, o_orderkey % 7 AS file, row_number() OVER (PARTITION BY o_orderkey % 7 ORDER BY o_orderkey, o_custkey) - 1 AS row_index FROM orders),
s AS (SELECT file, n, row_number() OVER (ORDER BY file) - 1 AS no, count(*) OVER () AS shards, CAST(sum(n) OVER () AS BIGINT) AS total FROM (SELECT file, count(*) AS n FROM m GROUP BY file)),
t AS (SELECT *, {permuted_sql('no', 'shards', start_sql(_TURN))} AS turn FROM s),
p AS (SELECT *, CAST(coalesce(sum(n) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM t),
q AS (SELECT o_orderkey, o_custkey, before + {permuted_sql('row_index', 'n', start_sql(_TURN, 'no + 1'))} AS place, total FROM m JOIN p USING (file))
SELECT o_orderkey, o_custkey, place, CASE WHEN place < total % 4 * (total // 4 + 1) THEN place // (total // 4 + 1) ELSE total % 4 + (place - total % 4 * (total // 4 + 1)) // (total // 4) END AS worker FROM q""")
def _(v):
    """Where each row stands in the third epoch, and which of four workers reads it."""
    files = v.table("orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 7).alias("file"))
    ranked = B.ranked(files, ["file"], ["o_orderkey", "o_custkey"]).select("o_orderkey", "o_custkey", "file", (F.col("rank") - 1).alias("row_index"))
    manifest = kept(ranked, scratch_folder(v.spark), "manifest")  # read twice; for sizes alone all rows would be ranked in few tasks
    return B.epoch_places(manifest, seed=11, epoch=2, workers=4).select("o_orderkey", "o_custkey", "place", "worker")


@query("l3_shuffled_order", f"SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY {sql_hash(7 * 1_000_003, 'o_custkey')}, o_custkey, {sql_hash(7 * 1_000_003, 'o_orderkey')}, o_orderkey) AS place FROM orders")
def _(v):
    """The rows of a seeded shuffle with their places."""
    root = scratch_folder(v.spark)
    B.shuffled(v.table("orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], seed=7, shard="o_custkey").write.parquet(f"{root}/x")
    rows = v.spark.read.parquet(f"{root}/x").select("o_orderkey", "o_custkey", F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).alias("part"), F.col("_metadata.row_index").alias("at"))
    return B.ranked(rows, [], ["part", "at"]).select("o_orderkey", "o_custkey", F.col("rank").cast("long").alias("place"))
