"""Predicted sequences against references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chordgrid.functions import scalars as S
from chordgrid.operators.tempo import at_ticks


def note_f1(pred: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """by.., tp, n_pred, n_target, precision, recall, f1 over distinct notes (by.., tick, lane_mask)."""
    key = [*by, "tick", "lane_mask"]
    rows = pred.select(*key, F.lit(1).alias("p"), F.lit(0).alias("t")).unionByName(target.select(*key, F.lit(0).alias("p"), F.lit(1).alias("t")))
    notes = rows.groupBy(*key).agg(F.max("p").alias("p"), F.max("t").alias("t"))
    sums = notes.groupBy(*by).agg(F.sum(F.col("p") * F.col("t")).alias("tp"), F.sum("p").alias("n_pred"), F.sum("t").alias("n_target"))
    return with_f1(sums)


def with_f1(sums: DataFrame) -> DataFrame:
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    out = sums.withColumn("precision", ratio(F.col("tp"), F.col("n_pred"))).withColumn("recall", ratio(F.col("tp"), F.col("n_target")))
    return out.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def shifted(preds: DataFrame, shift: int = 1, pad: int = S.PAD) -> DataFrame:
    """Predictions beside the label ``shift`` places on; padding and the tail are left out."""
    label = F.lead("label", shift).over(Window.partitionBy("seq_id").orderBy("pos")) if shift else F.col("label")
    return preds.withColumn("label", label).where(F.col("label").isNotNull() & (F.col("label") != pad))


def token_metrics(rows: DataFrame, groups: list[Column] | list[str]) -> DataFrame:
    """groups.., n, accuracy, perplexity."""
    return rows.groupBy(*groups).agg(F.count("*").alias("n"), F.coalesce(F.avg((F.col("pred") == F.col("label")).cast("int")), F.lit(0.0)).alias("accuracy"), F.exp(F.avg(-F.col("logp"))).alias("perplexity"))


def breakdown(rows: DataFrame) -> DataFrame:
    """Metrics in all, by instrument and by difficulty, in one pass."""
    level = rows.withColumn("level", S.difficulty_label(F.col("difficulty")))
    out = level.groupingSets([[], ["instrument"], ["level"]], "instrument", "level").agg(
        F.grouping_id().alias("g"), F.count("*").alias("n"), F.avg((F.col("pred") == F.col("label")).cast("int")).alias("accuracy"), F.exp(F.avg(-F.col("logp"))).alias("perplexity"))
    return out.select(F.when(F.col("g") == 3, "total").when(F.col("g") == 1, "instrument").otherwise("difficulty").alias("kind"), F.coalesce("instrument", "level", F.lit("all")).alias("name"), "n", "accuracy", "perplexity")


def beat_accuracy(pred: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """key.., spans, equal, accuracy: spans between beats whose sets of note tokens agree, over the larger
    number of spans. Tokens are (key.., pos, tok); a beat token that leads a sequence opens its first span."""
    def spans(tokens: DataFrame, name: str) -> DataFrame:
        order = Window.partitionBy(*key).orderBy("pos")
        tok = F.col("tok")
        # spans are numbered from 0 on both sides, whether a beat token or another one comes first
        span = F.sum((tok == S.BEAT).cast("int")).over(order) - F.first((tok == S.BEAT).cast("int")).over(order)
        rows = tokens.withColumn("span", span)
        note = tok.between(S.GUITAR_FIRST, S.GUITAR_LAST) | tok.between(S.DRUM_FIRST, S.DRUM_LAST)
        return rows.groupBy(*key, "span").agg(F.array_sort(F.collect_set(F.when(note, tok))).alias(name))

    both = spans(pred, "a").join(spans(target, "b").hint("merge"), [*key, "span"], "full")
    sums = both.groupBy(*key).agg(F.greatest(F.count("a"), F.count("b")).alias("spans"), F.count_if(F.col("a") == F.col("b")).alias("equal"))
    return sums.withColumn("accuracy", F.col("equal") / F.col("spans"))


def first_difference(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """key.., n_a, n_b, common, first_diff of two long sequences (key.., pos, tok), which have one token at a place.

    The sides are united and meet by place, so sides that lie by key are not shuffled again.
    """
    side = lambda rows, name: rows.select(*key, "pos", *[(F.col("tok") if c == name else F.lit(None).cast(rows.schema["tok"].dataType)).alias(c) for c in ("a", "b")])
    both = side(a, "a").unionByName(side(b, "b")).groupBy(*key, "pos").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return both.groupBy(*key).agg(F.count("a").alias("n_a"), F.count("b").alias("n_b"), F.count_if(F.col("a") == F.col("b")).alias("common"), F.min(F.when(~F.col("a").eqNullSafe(F.col("b")), F.col("pos"))).alias("first_diff"))


def compare_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, n_a, n_b and a total row (null key): how often each value occurs on both sides."""
    both = a.groupBy(key).agg(F.count("*").alias("n_a")).join(b.groupBy(key).agg(F.count("*").alias("n_b")).hint("merge"), key, "full").na.fill(0, ["n_a", "n_b"])
    return both.rollup(key).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))


def span_overlap(pred: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """key.., overlap, total_a, total_b, iou of (key.., start, stop) spans that do not overlap among themselves."""
    return _swept(_ends(pred, key, a=("start", "stop")).unionByName(_ends(target, key, b=("start", "stop"))), key)


def paired_overlap(rows: DataFrame, key: list[str], parts: int | None = None) -> DataFrame:
    """:func:`span_overlap` of rows with a span of each side (key.., start_a, stop_a, start_b, stop_b), read once.
    With ``parts`` rows go to that many tasks by key, and become ends there."""
    if parts:
        rows = rows.repartition(parts, *key)
    return _swept(_ends(rows, key, a=("start_a", "stop_a"), b=("start_b", "stop_b")), key)


def _ends(rows: DataFrame, key: list[str], **spans: tuple[str, str]) -> DataFrame:
    """key.., at, a, b: both ends of a row's spans, with what they add to the number of open ones."""
    end = lambda at, name, d: F.struct(F.col(at).alias("at"), *[F.lit(d if k == name else 0).alias(k) for k in ("a", "b")])
    every = [end(at, name, d) for name, span in spans.items() for at, d in zip(span, (1, -1))]
    return rows.select(*key, F.explode(F.array(*every)).alias("e")).select(*key, "e.*")


def _swept(ends: DataFrame, key: list[str]) -> DataFrame:
    """Ends of both sides are swept in order: where both are open, the stretch counts. No pair is joined. Of ends at one
    place all but the last have no stretch behind them, so they are not grouped before."""
    order = Window.partitionBy(*key).orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = ends.select(*key, F.sum("a").over(upto).alias("a"), F.sum("b").over(upto).alias("b"), (F.lead("at").over(order) - F.col("at")).alias("w"))
    span = lambda c: F.coalesce(F.sum(F.when(c, F.col("w"))), F.lit(0))
    a, b = F.col("a") > 0, F.col("b") > 0
    out = swept.groupBy(*key).agg(span(a & b).alias("overlap"), span(a).alias("total_a"), span(b).alias("total_b"), span(a | b).alias("_u"))
    return out.withColumn("iou", F.when(F.col("_u") > 0, F.col("overlap") / F.col("_u")).otherwise(0.0)).drop("_u")


def score(pred: DataFrame, target: DataFrame, by: list[str], groups: list[str]) -> DataFrame:
    """groups.., tp, n_pred, n_target, precision, recall, f1: note sets counted by ``by``, summed up by groups."""
    sums = note_f1(pred, target, by).groupBy(*groups).agg(*[F.sum(c).cast("long").alias(c) for c in ("tp", "n_pred", "n_target")])
    return with_f1(sums)


def sustain_error(pred: DataFrame, target: DataFrame, tempo: DataFrame, resolution: int = S.RESOLUTION) -> DataFrame:
    """song_id, instrument, error_ms: how far the sustains of notes at one tick are apart, on the mean."""
    key = ["song_id", "instrument", "tick"]
    both = target.select(*key, "sustain").join(pred.select(*key, F.col("sustain").alias("other")).hint("merge"), key)
    seconds = F.abs(F.col("sustain") - F.col("other")) / resolution * (60.0 / F.col("bpm"))
    return at_ticks(both, tempo, resolution).groupBy("song_id", "instrument").agg(F.avg(seconds * 1000).alias("error_ms"))


def weighted_f1(f1: DataFrame, grid: DataFrame, groups: list[str]) -> DataFrame:
    """groups.., f1: the songs' f1 weighted by 1 / (1 + deviation of the tempo)."""
    weight = grid.groupBy("song_id").agg((1 / (1 + F.stddev_pop(F.col("bpm").cast("float")))).alias("w"))
    return f1.join(weight.hint("merge"), "song_id").groupBy(*groups).agg((F.sum(F.col("w") * F.col("f1")) / F.sum("w")).alias("f1"))


def metrics_report(rows: DataFrame, group: str = "instrument") -> DataFrame:
    """One row: ``total`` and ``by_<group>``, each with loss, token_accuracy, perplexity and n of scored tokens
    (pred, label, logp)."""
    sums = rows.rollup(group).agg(F.count("*").alias("n"), F.avg(-F.col("logp")).alias("loss"), F.avg((F.col("pred") == F.col("label")).cast("int")).alias("token_accuracy"), F.grouping_id().alias("g"))
    one = sums.select(group, "g", F.struct("loss", "token_accuracy", F.exp("loss").alias("perplexity"), "n").alias("m"))
    named = F.collect_list(F.when((F.col("g") == 0) & F.col(group).isNotNull(), F.struct(group, "m")))
    return one.agg(F.max(F.when(F.col("g") == 1, F.col("m"))).alias("total"), F.map_from_entries(F.array_sort(named)).alias(f"by_{group}"))


def write_metrics(rows: DataFrame, path: str, group: str = "instrument") -> None:
    """The report as one JSON document in a folder of its own; an earlier one is replaced."""
    metrics_report(rows, group).coalesce(1).write.mode("overwrite").json(path)
