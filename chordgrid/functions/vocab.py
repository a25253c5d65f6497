"""The token vocabulary as a table of 187 rows, built from its rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chordgrid.functions import scalars as S


def vocabulary(spark: SparkSession) -> DataFrame:
    """tok, name, category, wait_steps, sus_steps, lane_mask."""
    tok = F.col("tok")
    rows = spark.range(S.VOCAB_SIZE).select(F.col("id").cast("int").alias("tok")).withColumn("category", S.token_class(tok))
    kind = F.col("category")
    rows = rows.select(
        "tok", "category",
        F.when(kind == "wait", tok - (S.WAIT_FIRST - 1)).alias("wait_steps"),
        F.when(kind == "sustain", F.element_at(S.sustain_steps(), F.greatest(tok - S.SUS_FIRST + 1, F.lit(1)))).alias("sus_steps"),
        F.when(kind == "note", tok - (S.GUITAR_FIRST - 1)).when(kind == "drum", tok - (S.DRUM_FIRST - 1)).alias("lane_mask"))
    letters = lambda names: F.concat(*[F.when(F.getbit("lane_mask", F.lit(i)) == 1, c).otherwise("") for i, c in enumerate(names)])
    # fixed values: names of single tokens and letters of the lanes
    fixed = {0: "PAD", 1: "BOS", 2: "EOS", 3: "UNK", 4: "BEAT", 5: "MEASURE", 6: "INSTR:guitar", 7: "INSTR:bass", 8: "INSTR:drums", 88: "MOD:HOPO", 89: "MOD:TAP", 90: "MOD:OPEN", 91: "MOD:STRUM", 183: "SP_ON", 184: "SP_OFF", 185: "SOLO_ON", 186: "SOLO_OFF"}
    name = F.when(F.col("wait_steps").isNotNull(), F.concat(F.lit("WAIT_"), "wait_steps", F.lit("("), F.col("wait_steps") * S.GRID, F.lit("t)")))
    name = name.when(F.col("sus_steps").isNotNull(), F.concat(F.lit("SUS_"), "sus_steps", F.lit("("), F.col("sus_steps") * S.GRID, F.lit("t)")))
    name = name.when(F.col("category") == "note", F.concat(F.lit("NOTE:"), letters("GRYBO"))).when(F.col("category") == "drum", F.concat(F.lit("DRUM:"), letters("KSHTC")))
    for i, text in fixed.items():
        name = name.when(tok == i, text)
    return rows.withColumn("name", name)


def named(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Tokens with their vocabulary columns (the vocabulary has 187 rows); unknown ids are kept, unnamed."""
    out = tokens.join(F.broadcast(vocab), "tok", "left")
    return out.withColumn("name", F.coalesce("name", F.concat(F.lit("UNKNOWN("), "tok", F.lit(")")))).withColumn("category", F.coalesce("category", F.lit("unknown")))
