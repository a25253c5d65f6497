"""The driver tables projected into the domain: notes, tempo, markers and frames, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chordgrid.sources.folders import Folder


#: Bytes of line items, as stored, whose tracks are one task's work: some 200,000 notes, and half a million tokens.
PART_BYTES = 4 << 20


class Views:
    """The domain tables of one scale factor; each is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def parts(self) -> int:
        """Tasks for the songs' tracks: as many as the session's shuffles have, more where line items are large."""
        size = Folder(self.spark, self.dir).bytes("lineitem.parquet")
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))

    @property
    def raw(self) -> DataFrame:
        """Notes from line items."""
        instrument = F.when(F.col("l_returnflag") == "A", "guitar").when(F.col("l_returnflag") == "N", "bass").otherwise("drums")
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("song_id"), instrument.alias("instrument"), ((F.col("l_partkey") % 300) * 24).cast("int").alias("tick"),
            (F.floor("l_quantity").cast("int") % 8).alias("pitch"), (F.floor("l_extendedprice").cast("int") % 3000).alias("sustain"))

    def _events(self, kind: str) -> DataFrame:
        tick = F.floor((F.unix_timestamp("ts") - 1704067200) / 360).cast("int")
        return self.table("events").where(F.col("event_type") == kind).select("event_id", F.col("user_id").alias("song_id"), tick.alias("tick"), F.floor("value").cast("int").alias("v"))

    def _one_a_tick(self, rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("song_id", "tick").orderBy("event_id")
        return rows.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")

    @property
    def tempo(self) -> DataFrame:
        return self._one_a_tick(self._events("view")).select("song_id", "tick", (60 + F.col("v") % 140).cast("double").alias("bpm"))

    @property
    def timesig(self) -> DataFrame:
        return self._one_a_tick(self._events("signup")).select("song_id", "tick", (2 + F.col("event_id") % 6).cast("int").alias("num"), F.lit(4).alias("den"))

    @property
    def specials(self) -> DataFrame:
        instrument = F.element_at(F.array(F.lit("guitar"), F.lit("bass"), F.lit("drums")), (F.col("event_id") % 3 + 1).cast("int"))
        stars = self._events("purchase").select("song_id", instrument.alias("instrument"), "tick", F.lit("star_power").alias("kind"), F.col("v").alias("length"), F.col("event_id").alias("ord"))
        solos = self._events("error").select("song_id", instrument.alias("instrument"), "tick", F.when(F.col("event_id") % 2 == 0, "solo").otherwise("soloend").alias("kind"), F.lit(0).alias("length"), F.col("event_id").alias("ord"))
        return stars.unionByName(solos)

    @property
    def frames(self) -> DataFrame:
        order = Window.partitionBy("label").orderBy("vec_id")
        return self.table("embeddings").select(F.col("label").alias("song_id"), (F.row_number().over(order) - 1).cast("int").alias("frame"), F.col("embedding").alias("vec"))

    @property
    def preds(self) -> DataFrame:
        label = (F.col("l_partkey") % 187).cast("int")
        pred = F.when(F.col("l_linenumber") % 3 == 0, label).otherwise(((label + F.col("l_suppkey")) % 187).cast("int"))
        order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("seq_id"), (F.row_number().over(order) - 1).cast("int").alias("pos"), pred.alias("pred"), label.alias("label"), F.log(0.05 + F.col("l_discount")).alias("logp"),
            F.col("l_returnflag").alias("instrument"), (F.col("l_orderkey") % 4).cast("int").alias("difficulty"))


#: The same projections as DuckDB common table expressions, and tables derived from them.
CTE = {
    "raw": "SELECT l_suppkey AS song_id, CASE l_returnflag WHEN 'A' THEN 'guitar' WHEN 'N' THEN 'bass' ELSE 'drums' END AS instrument, CAST((l_partkey % 300) * 24 AS INT) AS tick, CAST(floor(l_quantity) AS INT) % 8 AS pitch, CAST(floor(l_extendedprice) AS INT) % 3000 AS sustain FROM lineitem",
    "ev": "SELECT event_id, user_id AS song_id, event_type, CAST(floor((epoch(ts) - 1704067200) / 360) AS INT) AS tick, CAST(floor(value) AS INT) AS v FROM events",
    "tempo": "SELECT song_id, tick, CAST(60 + v % 140 AS DOUBLE) AS bpm FROM ev WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY song_id, tick ORDER BY event_id) = 1",
    "timesig": "SELECT song_id, tick, CAST(2 + event_id % 6 AS INT) AS num, 4 AS den FROM ev WHERE event_type = 'signup' QUALIFY row_number() OVER (PARTITION BY song_id, tick ORDER BY event_id) = 1",
    "specials": "SELECT song_id, CASE event_id % 3 WHEN 0 THEN 'guitar' WHEN 1 THEN 'bass' ELSE 'drums' END AS instrument, tick, CASE WHEN event_type = 'purchase' THEN 'star_power' WHEN event_id % 2 = 0 THEN 'solo' ELSE 'soloend' END AS kind, CASE WHEN event_type = 'purchase' THEN v ELSE 0 END AS length, event_id AS ord FROM ev WHERE event_type IN ('purchase', 'error')",
    "frames": "SELECT label AS song_id, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INT) AS frame, embedding AS vec FROM embeddings",
    "preds": "SELECT l_orderkey AS seq_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INT) AS pos, CAST(CASE WHEN l_linenumber % 3 = 0 THEN l_partkey % 187 ELSE (l_partkey % 187 + l_suppkey) % 187 END AS INT) AS pred, CAST(l_partkey % 187 AS INT) AS label, ln(0.05 + l_discount) AS logp, l_returnflag AS instrument, CAST(l_orderkey % 4 AS INT) AS difficulty FROM lineitem",
    "notes": "SELECT song_id, instrument, tick, CAST(bit_or(CASE WHEN pitch <= 4 THEN 1 << pitch ELSE 0 END) AS INT) AS lane_mask, max(CASE WHEN pitch <= 4 THEN sustain END) AS sustain, bool_or(pitch = 5) AS is_hopo, bool_or(pitch = 7) AS is_tap, bool_or(pitch = 6) AS is_force_strum FROM raw GROUP BY ALL HAVING bit_or(CASE WHEN pitch <= 4 THEN 1 << pitch ELSE 0 END) > 0",
    "ends": "SELECT song_id, max(e) AS end_tick FROM (SELECT song_id, instrument, max_by(tick + sustain, tick) AS e FROM notes GROUP BY ALL) GROUP BY song_id",
    "seg": "SELECT song_id, tick AS start_tick, bpm, coalesce(sum(d) OVER (PARTITION BY song_id ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS start_s FROM (SELECT *, (lead(tick) OVER (PARTITION BY song_id ORDER BY tick) - tick) / 192.0 * (60.0 / bpm) AS d FROM tempo)",
    "first_seg": "SELECT song_id, min(start_tick) AS f_tick, min_by(start_s, start_tick) AS f_s, min_by(bpm, start_tick) AS f_bpm FROM seg GROUP BY song_id",
    "bt": "SELECT song_id, CAST(unnest(range(0, (end_tick - s) // 192 + 1)) AS INT) AS beat, s, CAST(s + 192 * unnest(range(0, (end_tick - s) // 192 + 1)) AS INT) AS tick FROM (SELECT e.song_id, end_tick, CAST(ceil(f_tick / 192) * 192 AS INT) AS s FROM ends e JOIN first_seg USING (song_id)) WHERE s <= end_tick",
    "grid": "SELECT song_id, beat, tick, time_s, coalesce(lead(time_s) OVER (PARTITION BY song_id ORDER BY beat) - time_s, 60.0 / bpm) AS duration_s, bpm, ts_num, ts_den FROM (SELECT b.song_id, b.beat, b.tick, coalesce(s.start_s, f_s) + (b.tick - coalesce(s.start_tick, f_tick)) / 192.0 * (60.0 / coalesce(s.bpm, f_bpm)) AS time_s, coalesce(s.bpm, f_bpm) AS bpm, coalesce(t.num, 4) AS ts_num, coalesce(t.den, 4) AS ts_den FROM bt b ASOF LEFT JOIN seg s ON b.song_id = s.song_id AND b.tick >= s.start_tick ASOF LEFT JOIN timesig t ON b.song_id = t.song_id AND b.tick >= t.tick JOIN first_seg f ON f.song_id = b.song_id)",
    "steps": "SELECT i, CASE WHEN i < 48 THEN i ELSE [54, 60, 66, 72, 78, 84, 90, 96, 110, 120, 144, 165][i - 47] END AS s FROM (SELECT CAST(unnest(range(60)) AS INT) AS i)",
    "sus": "SELECT q, min_by(i, abs(s - q) * 100 + i) AS idx FROM (SELECT DISTINCT CAST(round_even(sustain / 16.0, 0) AS INT) AS q FROM notes), steps GROUP BY q",
    "tl": "SELECT n.song_id, n.instrument, n.tick, 3 AS pr, 0 AS o1, 0 AS o2, 0 AS o3, CASE WHEN n.instrument = 'drums' THEN [91 + lane_mask] ELSE list_concat(list_concat(list_concat([56 + lane_mask, 123 + idx], CASE WHEN is_hopo THEN [88] ELSE [] END), CASE WHEN is_tap THEN [89] ELSE [] END), CASE WHEN is_force_strum THEN [91] ELSE [] END) END AS toks FROM notes n JOIN sus ON q = CAST(round_even(sustain / 16.0, 0) AS INT) UNION ALL SELECT song_id, instrument, tick, 0, 0, 0, 0, [4] FROM (SELECT DISTINCT song_id, instrument FROM notes) JOIN bt USING (song_id) UNION ALL SELECT song_id, instrument, CAST(s.tick + CASE WHEN side = 1 THEN length ELSE 0 END AS INT), CASE WHEN kind = 'star_power' THEN 1 ELSE 2 END, s.tick, ord, side, [CASE kind WHEN 'star_power' THEN 183 + side WHEN 'solo' THEN 185 ELSE 186 END] FROM (SELECT DISTINCT song_id, instrument FROM notes) JOIN specials s USING (song_id, instrument), (SELECT unnest([0, 1]) AS side) WHERE side = 0 OR kind = 'star_power'",
    "tl2": "SELECT *, tick - lag(tick, 1, 0) OVER (PARTITION BY song_id, instrument ORDER BY tick, pr, o1, o2, o3) AS gap, row_number() OVER (PARTITION BY song_id, instrument ORDER BY tick, pr, o1, o2, o3) AS n FROM tl",
    "tl3": "SELECT song_id, instrument, n, CASE WHEN gap > 0 THEN list_concat(list_concat(list_transform(range(st // 48), lambda x: 56), CASE WHEN st % 48 > 0 THEN [8 + st % 48] ELSE [] END), toks) ELSE toks END AS toks FROM (SELECT *, greatest(1, CAST(round_even(gap / 16.0, 0) AS INT)) AS st FROM tl2)",
    "seqs": "SELECT song_id, instrument, list_concat(list_concat([1, CASE instrument WHEN 'bass' THEN 7 WHEN 'drums' THEN 8 ELSE 6 END], flatten(list(toks ORDER BY n))), [2]) AS tokens FROM tl3 GROUP BY song_id, instrument",
    "tok": "SELECT song_id, instrument, CAST(generate_subscripts(tokens, 1) - 1 AS INT) AS pos, CAST(unnest(tokens) AS INT) AS tok FROM seqs",
}

def sql_hash(seed: int, *key: str) -> str:
    """A row's number by a hash, as :func:`chordgrid.operators.batching.hashed` has it, in SQL."""
    return f"CAST('0x' || substr(md5(concat_ws('|', {seed}, {', '.join(key)})), 1, 15) AS BIGINT)"


_NEEDS = {
    "tempo": ["ev"], "timesig": ["ev"], "specials": ["ev"], "notes": ["raw"], "ends": ["notes"], "seg": ["tempo"], "first_seg": ["seg"], "bt": ["ends", "first_seg"],
    "grid": ["bt", "seg", "timesig", "first_seg"], "sus": ["notes", "steps"], "tl": ["notes", "sus", "bt", "specials"], "tl2": ["tl"], "tl3": ["tl2"], "seqs": ["tl3"], "tok": ["seqs"],
}


def with_ctes(sql: str, *names: str) -> str:
    """``sql`` behind the named common table expressions and all that they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in ordered:
            ordered.append(name)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in ordered) + ("\n" + sql if sql.lstrip().upper().startswith("SELECT") else ",\n" + sql)
