"""Row rules of dataset building: what is kept, why a song is skipped, and where its metadata come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def required_instruments(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """Rows of the wanted instruments."""
    return rows.where(F.col("instrument").isin(*wanted))


def skip_reasons(songs: DataFrame, ends: DataFrame, tempo: DataFrame, least_ticks: int = 1) -> DataFrame:
    """songs (song_id) with status: ok, or the first reason to skip it."""
    rows = songs.join(ends.hint("merge"), "song_id", "left").join(tempo.select("song_id", F.lit(True).alias("_t")).distinct().hint("merge"), "song_id", "left")
    why = F.when(F.col("end_tick").isNull(), "no notes").when(F.col("_t").isNull(), "no tempo").when(F.col("end_tick") < least_ticks, "too short").otherwise("ok")
    return rows.withColumn("status", why).drop("_t", "end_tick")


def with_features(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows none of whose arrays is null or empty."""
    for c in columns:
        rows = rows.where(F.size(c) > 0)
    return rows


def null_items(rows: DataFrame, column: str) -> DataFrame:
    """One row: bad (rows whose array has a null), n."""
    return rows.agg(F.count_if(F.exists(column, lambda x: x.isNull())).alias("bad"), F.count("*").alias("n"))


def metadata_value(has_ini: Column, ini: Column, chart: Column, default: str = "") -> Column:
    """A song's value: the ini file's where there is one, even an empty one; else the chart's; else the default."""
    return F.when(has_ini, F.coalesce(ini, F.lit(""))).otherwise(F.coalesce(chart, F.lit(default)))


def instrument_difficulty(instrument: Column, meta: Column, default: int = -1) -> Column:
    """The difficulty of an instrument in the metadata, a struct or table of diff_<instrument> columns."""
    out = F.lit(default)
    for name in ("guitar", "bass", "drums", "keys", "rhythm"):
        out = F.when(F.substring_index(instrument, "_", 1) == name, meta[f"diff_{name}"]).otherwise(out)
    return F.coalesce(out, F.lit(default))
