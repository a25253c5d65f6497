"""Building, conforming and sharding wide dataset rows."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.operators import codec, notes as N, tempo as TP
from chordgrid.operators.batching import RANGES, cut_points, value_range
from chordgrid.sources.folders import Folder, kept, names_below, opens, scratch_folder, shuffle_width, write_folders

_A = T.ArrayType
#: Columns and types of the wide row, one for each song and instrument.
SCHEMA = T.StructType([
    *(T.StructField(c, T.StringType()) for c in ("song_id", "instrument", "source_format")),
    T.StructField("tokens", _A(T.IntegerType())), T.StructField("num_tokens", T.IntegerType()), T.StructField("num_beats", T.IntegerType()),
    T.StructField("mert_embeddings", _A(_A(T.FloatType()))), T.StructField("logmel_frames", _A(_A(_A(T.FloatType())))),
    *(T.StructField(c, _A(T.FloatType())) for c in ("beat_times_s", "beat_durations_s", "bpm_at_beat")),
    *(T.StructField(c, _A(T.IntegerType())) for c in ("time_sig_num_at_beat", "time_sig_den_at_beat")),
    *(T.StructField(c, T.StringType()) for c in ("song_name", "artist", "genre", "charter")),
    *(T.StructField(c, T.IntegerType()) for c in ("year", "song_length_ms", "difficulty", "resolution")),
    *(T.StructField(c, T.BooleanType()) for c in ("has_star_power", "has_solo", "has_dedicated_stem")),
    T.StructField("num_notes", T.IntegerType()),
    *(T.StructField(c, T.FloatType()) for c in ("notes_per_beat_mean", "chord_ratio", "sustain_mean_ticks", "bpm_mean", "bpm_std")),
])


def _lost(before: Column, after: Column, kind: T.DataType) -> Column:
    """Did a cast make something null that was there? Items of lists count."""
    lost = before.isNotNull() & after.isNull()
    if isinstance(kind, T.ArrayType):
        lost = lost | F.coalesce(F.exists(F.zip_with(before, after, lambda x, y: _lost(x, y, kind.elementType)), lambda x: x), F.lit(False))
    return lost


def conform(df: DataFrame, schema: T.StructType = SCHEMA, failed: str = "cell", by: str | None = None) -> DataFrame:
    """The schema's columns in its order; missing ones are null.

    ``failed``: of values that do not fit, ``cell`` makes each of them null; ``column`` makes a column with one of
    them null as a whole, in all rows or in each group of ``by`` (a file, say).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields if f.name in have and have[f.name] != f.dataType}
    if failed == "column" and casts:
        lost = df.groupBy(*([F.col(by).alias("_by")] if by else [])).agg(F.struct(*[F.coalesce(F.bool_or(_lost(F.col(c), x, schema[c].dataType)), F.lit(False)).alias(c) for c, x in casts.items()]).alias("_lost"))
        df = df.join(lost.hint("merge"), F.col(by).eqNullSafe(F.col("_by"))) if by else df.join(F.broadcast(lost))  # one row
        casts = {c: F.when(~F.col("_lost")[c], x) for c, x in casts.items()}
    return df.select(*[casts[f.name].alias(f.name) if f.name in casts else F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def beat_arrays(grid: DataFrame) -> DataFrame:
    """song_id, num_beats and the grid's columns as arrays in beat order."""
    names = {"time_s": "beat_times_s", "duration_s": "beat_durations_s", "bpm": "bpm_at_beat", "ts_num": "time_sig_num_at_beat", "ts_den": "time_sig_den_at_beat"}
    rows = grid.groupBy("song_id").agg(F.array_sort(F.collect_list(F.struct("beat", *names))).alias("b"))

    def one(column: str):
        kind = "int" if column.startswith("ts_") else "float"
        return F.transform("b", lambda x: x[column].cast(kind)).alias(names[column])

    return rows.select("song_id", F.size("b").alias("num_beats"), *map(one, names))


def build_rows(sequences: DataFrame, stats: DataFrame, grid: DataFrame, specials: DataFrame, meta: DataFrame, source_format: str = "chart", resolution: int = 192) -> DataFrame:
    """Wide rows of the given tracks: sequences and statistics meet on (song, instrument), beats and
    metadata on the song. ``meta`` may hold the songs' own resolution."""
    flags = specials.groupBy("song_id", "instrument").agg(F.bool_or(F.col("kind") == "star_power").alias("has_star_power"), F.bool_or(F.col("kind") == "solo").alias("has_solo"))
    rows = sequences.join(stats.drop("num_beats").hint("merge"), ["song_id", "instrument"]).join(flags.hint("merge"), ["song_id", "instrument"], "left").join(beat_arrays(grid).hint("merge"), "song_id", "left").join(meta.hint("merge"), "song_id", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("has_star_power", "has_solo")})
    rows = rows.withColumns({"source_format": F.lit(source_format), "resolution": F.coalesce("resolution", F.lit(resolution)) if "resolution" in meta.columns else F.lit(resolution), "num_beats": F.coalesce("num_beats", F.lit(0))})
    return conform(rows)


def build_dataset(raw: DataFrame, specials: DataFrame, tempo: DataFrame, timesig: DataFrame, meta: DataFrame, source_format: str = "chart", resolution: int = 192, parts: int | None = None) -> DataFrame:
    """Wide rows from raw notes, markers, tempo, signatures and metadata.

    Chords and the beat grid are written once, and sequences, statistics, ends and arrays read them: raw
    notes are scanned and shuffled one time.
    """
    folder = scratch_folder(raw.sparkSession)
    notes = kept(N.chords(raw), folder, "notes")
    grid = kept(TP.beat_grid(tempo, timesig, N.song_ends(notes), resolution), folder, "grid")
    sequences = codec.encode(notes, specials, tempo, resolution, parts)
    return build_rows(sequences, N.track_stats(notes, grid), grid, specials, meta, source_format, resolution)


def prefer_formats(songs: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """One row a song: its format of the lowest rank."""
    rank = F.lit(len(ranks))
    for name, r in ranks.items():
        rank = F.when(F.col("format") == name, r).otherwise(rank)
    order = Window.partitionBy("song_id").orderBy(rank, "path")
    return songs.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def preferred_files(wanted: DataFrame, files: DataFrame, preference: DataFrame, parts: int | None = None) -> DataFrame:
    """wanted (song_id, instrument) with the path of the best file by (base_rank, ext_rank), null if none.

    ``preference`` is a short list of names. Joined by shuffle, all files would meet in as many tasks as there are
    names; it is broadcast, and files meet their song in ``parts`` tasks, or as many as the session's shuffles have.
    """
    by = ["song_id", "instrument"]
    n = parts or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = files.join(F.broadcast(preference), ["base", "ext"]).repartition(n, *by)
    best = hits.groupBy(*by).agg(F.min_by("path", F.struct("base_rank", "ext_rank", "path")).alias("path"))
    return wanted.repartition(n, *by).join(best.hint("merge"), by, "left")


def with_stems(songs: DataFrame, files: DataFrame, base: str) -> DataFrame:
    """songs with has_stem: is there a file of that base name?"""
    stems = files.where(F.col("base") == base).select("song_id").distinct().withColumn("has_stem", F.lit(True))
    return songs.join(stems.hint("merge"), "song_id", "left").withColumn("has_stem", F.coalesce("has_stem", F.lit(False)))


#: A block of the running sum is so many shards long.
BLOCK_SHARDS = 64


def with_shards(rows: DataFrame, size: str, limit: int, by: str, order: str | list[str], prefix: str = "train", part: Column | None = None, first: int = 0) -> DataFrame:
    """rows with ``shard``: within ``by``, rows go into a shard in their order until its bytes reach the limit, the next
    row begins a new one with an empty count. Numbers go on from ``first``; ``order`` is a full order of rows.

    Each cut depends on the one before, so blocks of the running sum first work out, for every row that may begin
    a shard at their start, where the chain of cuts leaves them; a walk over the blocks then joins these,
    and blocks list their cuts. A task holds the sizes of one block, never a split. ``part``, where given, grows
    with ``order`` (as a day grows with a time) and deals rows out for the running sum; without it cuts of
    the order do.
    """
    order = [order] if isinstance(order, str) else order
    own = rows.withColumn("_part", value_range(F.struct(*order), cut_points(rows, order, RANGES)) if part is None else part)
    upto = lambda *c: Window.partitionBy(*c).rowsBetween(Window.unboundedPreceding, -1)
    parts = own.groupBy(F.col(by).alias("_by"), F.col("_part").alias("_p")).agg(F.sum(size).alias("_s"))
    parts = parts.select("_by", "_p", F.coalesce(F.sum("_s").over(upto("_by").orderBy("_p")), F.lit(0)).alias("_start"))
    both = own.join(parts.hint("merge"), F.col(by).eqNullSafe(F.col("_by")) & F.col("_part").eqNullSafe(F.col("_p")))
    before = (F.col("_start") + F.coalesce(F.sum(size).over(upto(by, "_part").orderBy(*order)), F.lit(0))).cast("long")
    folder = scratch_folder(rows.sparkSession)
    both.select(*rows.columns, before.alias("_before")).write.parquet(f"{folder}/placed")
    placed = rows.sparkSession.read.parquet(f"{folder}/placed")
    cuts = shard_cuts(placed.select(F.col(by).alias("by"), F.col("_before").alias("before"), (F.col("_before") + F.coalesce(F.col(size), F.lit(0))).alias("after")), limit, folder)
    cuts = cuts.withColumnsRenamed({"by": "_by", "block": "_block"})
    block = F.floor(F.col("_before") / (limit * BLOCK_SHARDS))
    own = placed.withColumn("_b", block).join(cuts.hint("merge"), F.col(by).eqNullSafe(F.col("_by")) & (F.col("_b") == F.col("_block")), "left")
    shard = F.coalesce(F.col("earlier"), F.lit(0)) + F.coalesce(F.size(F.filter("cuts", lambda c: c <= F.col("_before"))), F.lit(0)) + first
    return own.select(*rows.columns, shard.cast("int").alias("shard")).withColumn("shard_name", F.format_string(prefix + "-%05d.parquet", "shard"))


def block_exits(before: np.ndarray, after: np.ndarray, block: int, limit: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's rows and those that its last shard may reach, sorted by their ends: (entry, exit) for every cut that
    may be the block's first."""
    end = (block + 1) * wide
    n = int(np.searchsorted(after, end, "left"))
    # walk back: a place whose next cut lies beyond the block leaves it there
    following = np.searchsorted(after, after[:n] + limit, "left").tolist()
    exits, last = [-1] * n, len(after)
    for i in range(n - 1, -1, -1):
        j = following[i]
        exits[i] = (int(after[j]) if j < last else -1) if j >= n else exits[j]
    first = before[:n] < end - wide + limit
    entry, leave = after[:n][first], np.array(exits, np.int64)[first]
    keep = np.append(entry[1:] != entry[:-1], True) if len(entry) else np.zeros(0, bool)  # the last of equal ends
    return entry[keep], leave[keep]


def block_cuts(after: np.ndarray, block: int, entry: int, limit: int, wide: int) -> list[int]:
    """Of a block's sorted ends, with the block's first cut in ``entry``: all its cuts."""
    end, cut, cuts = (block + 1) * wide, entry, []
    while cut < end:
        cuts.append(cut)
        j = np.searchsorted(after, cut + limit, "left")
        if j == len(after):
            break
        cut = int(after[j])
    return cuts


#: Rows of blocks that one call of a task's function gets, about.
PACK_ROWS = 250_000


def packed(rows: DataFrame, count: int) -> DataFrame:
    """Rows with ``pack``: some blocks, each whole, that one call works on, so small blocks cost no call each."""
    return rows.withColumn("pack", F.pmod(F.xxhash64("by", "block"), F.lit(max(1, -(-count // PACK_ROWS)))))


def each_block(rows: pd.DataFrame) -> tuple[np.ndarray, list[tuple]]:
    """The order of rows of many blocks by split, block and ends, and (by, block, first, end) of each block in it; null
    splits are one."""
    split = pd.factorize(rows["by"], use_na_sentinel=False)[0]
    order = np.lexsort((rows["before"].to_numpy() if "before" in rows else rows["after"].to_numpy(), rows["after"].to_numpy(), rows["block"].to_numpy(), split))
    split, block = split[order], rows["block"].to_numpy()[order]
    at = np.flatnonzero(np.append(True, (split[1:] != split[:-1]) | (block[1:] != block[:-1])))
    by = rows["by"].iloc[order[at]].tolist()
    return order, list(zip(by, block[at].tolist(), at.tolist(), np.append(at[1:], len(order)).tolist()))


def pack_exits(rows: pd.DataFrame, limit: int, wide: int) -> pd.DataFrame:
    """by, block, entry, exit of the rows of many blocks."""
    order, blocks = each_block(rows)
    before, after = rows["before"].to_numpy()[order], rows["after"].to_numpy()[order]
    found = [(by, block, *block_exits(before[a:b], after[a:b], int(block), limit, wide)) for by, block, a, b in blocks]
    n = [len(f[2]) for f in found]
    every = lambda k: np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64)
    by = pd.Series([f[0] for f in found], dtype=rows["by"].dtype).repeat(n).reset_index(drop=True)
    return pd.DataFrame({"by": by, "block": np.repeat([f[1] for f in found], n), "entry": every(2), "exit": every(3)})


def pack_cuts(rows: pd.DataFrame, limit: int, wide: int) -> pd.DataFrame:
    """by, block, cuts of the rows of many blocks, each with its first cut in ``entry``."""
    order, blocks = each_block(rows)
    after, entry = rows["after"].to_numpy()[order], rows["entry"].to_numpy()[order]
    cuts = [block_cuts(after[a:b], int(block), int(entry[a]), limit, wide) for _, block, a, b in blocks]
    return pd.DataFrame({"by": pd.Series([x[0] for x in blocks], dtype=rows["by"].dtype), "block": [x[1] for x in blocks], "cuts": cuts})


def walk_blocks(rows: pd.DataFrame, wide: int) -> pd.DataFrame:
    """Of (by, block, entry, exit, start) of some splits, each whole: (by, block, entry) of the chains that begin at
    their first cuts."""
    split = pd.factorize(rows["by"], use_na_sentinel=False)[0].tolist()
    at = {(s, b, e): x for s, b, e, x in zip(split, rows["block"].tolist(), rows["entry"].tolist(), rows["exit"].tolist())}
    first = np.flatnonzero(~pd.Series(split).duplicated().to_numpy()).tolist()
    out, names, starts = [], rows["by"].tolist(), rows["start"].tolist()
    for i in first:
        cut = int(starts[i])
        while cut >= 0:
            out.append((names[i], cut // wide, cut))
            cut = at.get((split[i], cut // wide, cut), -1)
    return pd.DataFrame({"by": pd.Series([x[0] for x in out], dtype=rows["by"].dtype), "block": [x[1] for x in out], "entry": [x[2] for x in out]})


def shard_cuts(places: DataFrame, limit: int, folder: str) -> DataFrame:
    """by, block, cuts, earlier of (by, before, after): the places where shards end, block by block of the running sum,
    and how many lie in earlier blocks. One task walks over a split's blocks; it gets the rows within one
    ``limit`` of each block's start."""
    spark, wide = places.sparkSession, limit * BLOCK_SHARDS
    kind = places.schema["by"].dataType.simpleString()
    block = F.floor(F.col("after") / wide)
    # a row is also in sight of the block before, where a shard that begins there may end with it
    back = F.greatest(F.lit(0), F.floor((F.col("before") - limit) / wide))
    seen = places.withColumn("block", F.explode(F.sequence(F.least(back, block), block)))
    seen.write.parquet(f"{folder}/seen")
    seen = spark.read.parquet(f"{folder}/seen")
    rows = seen.count()
    exits = packed(seen, rows).groupBy("pack").applyInPandas(lambda pack: pack_exits(pack, limit, wide), f"by {kind}, block long, entry long, exit long")
    exits.write.parquet(f"{folder}/exits")
    exits = spark.read.parquet(f"{folder}/exits")
    # the first cut: where the first shard's bytes reach the limit
    start = places.where(F.col("after") >= limit).groupBy("by").agg(F.min("after").alias("start"))
    start = start.withColumnRenamed("by", "_by")
    walk = start.join(exits.hint("merge"), F.col("_by").eqNullSafe(F.col("by")), "left").select(F.col("_by").alias("by"), "block", "entry", "exit", "start")
    splits = F.pmod(F.xxhash64("by"), F.lit(max(1, -(-exits.count() // PACK_ROWS))))
    entries = walk.fillna(-1, ["block", "entry", "exit"]).groupBy(splits.alias("pack")).applyInPandas(lambda pack: walk_blocks(pack, wide), f"by {kind}, block long, entry long")
    entries.write.parquet(f"{folder}/entries")
    entries = spark.read.parquet(f"{folder}/entries").withColumnsRenamed({"by": "_by", "block": "_block"})
    of = seen.join(entries.hint("merge"), F.col("by").eqNullSafe(F.col("_by")) & (F.col("block") == F.col("_block"))).select("by", "block", "after", "entry")
    cuts = packed(of, rows).groupBy("pack").applyInPandas(lambda pack: pack_cuts(pack, limit, wide), f"by {kind}, block long, cuts array<long>")
    cuts.write.parquet(f"{folder}/cuts")
    cuts = spark.read.parquet(f"{folder}/cuts")
    # blocks without a cut still need the number of cuts before them
    blocks = places.select("by", F.floor(F.col("before") / wide).alias("block")).distinct()
    named = cuts.withColumnsRenamed({"by": "_by", "block": "_block"})
    every = blocks.union(cuts.select("by", "block")).distinct().join(named.hint("merge"), F.col("by").eqNullSafe(F.col("_by")) & (F.col("block") == F.col("_block")), "left").select("by", "block", "cuts")
    earlier = F.sum(F.coalesce(F.size("cuts"), F.lit(0))).over(Window.partitionBy("by").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))  # blocks, not rows
    return every.withColumn("earlier", F.coalesce(earlier, F.lit(0)))


def size_label(n: Column) -> Column:
    """A dataset's size class by its rows."""
    steps = [(1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M")]
    out = F.lit("1M<n<10M")
    for most, label in reversed(steps):
        out = F.when(n < most, label).otherwise(out)
    return out


def status_of(rows: DataFrame) -> DataFrame:
    """rows with status ok / failed / skipped and the bucket of their error: its text before the colon."""
    bad = F.col("error").isNotNull()
    status = F.when(bad, "failed").when(F.col("num_rows") == 0, "skipped").otherwise("ok")
    return rows.withColumn("status", status).withColumn("bucket", F.when(bad, F.trim(F.substring_index("error", ":", 1))))


def pending(paths: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Paths that no finished run has logged."""
    return paths.join(done.select(key).distinct().hint("merge"), key, "left_anti")


#: Codecs by the names that Spark and pyarrow share.
_CODECS = {"none", "uncompressed", "snappy", "gzip", "zstd"}


def write_shards(rows: DataFrame, path: str, compression: str = "zstd", mode: str = "errorifexists", partition: str | None = "split") -> None:
    """Wide rows as Parquet; rows of one shard meet in one task where they are numbered, and a shard that has a
    name is a folder of that name.

    Named shards may be very many and small. Their tasks are a number of their own, as by their bytes all would be one
    task, and :func:`write_folders` writes them: Spark's writer takes some 20 ms for each folder, and its driver
    then moves them one after the other. It is left where pyarrow does not know the file system or the codec.
    """
    folders = [c for c in (partition, "shard_name") if c and c in rows.columns]
    out = rows
    if "shard" in rows.columns:
        out = rows.repartition(shuffle_width(rows.sparkSession), "shard")
    if "shard_name" in folders and compression.lower() in _CODECS and opens(Folder(rows.sparkSession, path).qualified()):
        there = Folder(rows.sparkSession, path).exists()
        if mode == "ignore" and there:
            return
        if mode != "append" or not there:  # no rows: the mode's own rules, and what is overwritten
            rows.limit(0).write.mode(mode).option("compression", compression).partitionBy(*folders).parquet(path)
        write_folders(out, path, folders, {"uncompressed": "none"}.get(compression.lower(), compression.lower()))
        return
    writer = out.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*folders) if folders else writer).parquet(path)


def next_shard(spark: SparkSession, path: str, prefix: str = "train") -> int:
    """The number after the highest shard number of a dataset's files and folders; 0 where there is none."""
    root = Folder(spark, path).qualified()
    if opens(root):  # names only: a list of all files would be a task for each folder
        shard = re.compile(rf"(?:^|=){prefix}-(\d+)\.parquet")
        return max((n for n in (int(shard.search(name)[1]) for name in names_below(root, shard)) if n < 1 << 31), default=-1) + 1
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    except AnalysisException:  # nothing has been written yet
        return 0
    number = F.regexp_extract("path", rf"(?:^|[/=]){prefix}-(\d+)\.parquet", 1)
    last = files.agg(F.max(number.try_cast("int"))).first()[0]
    return 0 if last is None else last + 1


def append_shards(rows: DataFrame, path: str, size: str, limit: int, by: str, order: str | list[str], prefix: str = "train", part: Column | None = None, **options) -> None:
    """Adds rows to a dataset as new shards, numbered on from those that are there."""
    first = next_shard(rows.sparkSession, path, prefix)
    write_shards(with_shards(rows, size, limit, by, order, prefix, part, first), path, mode="append", **options)


def write_manifest(rows: DataFrame, path: str, **options: str) -> None:
    """One JSON row: rows, in all and by split, instruments, and the run's options."""
    split = "split" if "split" in rows.columns else F.lit("all").alias("split")
    by = rows.groupBy(split).agg(F.count("*").alias("n"), F.collect_set("instrument").alias("i"))
    splits = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("split", F.lit("none")), "n")))).alias("splits")
    one = by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), splits, F.array_sort(F.array_distinct(F.flatten(F.collect_list("i")))).alias("instruments"))
    for name, value in options.items():
        one = one.withColumn(name, F.lit(value))
    one.coalesce(1).write.mode("overwrite").json(path)
