"""Quality rules with cross-document line frequency, in DataFrame functions only.

One pass over the texts gives each document's base counts and its lines as (hash, words) pairs. Lines
are then counted by host over distinct documents; lines above the limit, a share of the host's
documents, are taken out of every document of the host but the one with the smallest id, and a
document that loses most of its words is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chordgrid.llm.shared import SPACE, fresh, work_folder, written

WINDOW = 8
#: A line may stand in so large a share (in percent) of a host's documents, and in so many of any host.
MAX_SHARE_PERCENT, MAX_DOCS = 10, 10
#: A document is depleted when less than this share (in percent) of its words is left.
MIN_LEFT_PERCENT = 30
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_TRIM = " \t\n\x0b\f\r"


def split_words(text: Column) -> Column:
    """Words of a text that is not null."""
    trimmed = F.btrim(text, F.lit(_TRIM))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def repeat_words(words: Column, n: int = WINDOW) -> Column:
    """Words in windows of n words that the array holds twice or more."""
    hashes = F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n)))).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        """From window hashes: sort them, find those with an equal neighbour, add up what they cover."""
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        twins = lambda s: F.filter(
            F.transform(s, lambda e, j: F.when((F.get(s, j - 1)["x"] == e["x"]) | (F.get(s, j + 1)["x"] == e["x"]), e["i"])), lambda i: i.isNotNull())
        places = F.array_sort(F.element_at(F.transform(F.array(ordered), twins), 1))
        start = F.struct(F.lit(0).cast("long").alias("c"), F.lit(-n).alias("p"))
        step = lambda acc, p: F.struct((acc["c"] + F.least(F.lit(n), p - acc["p"])).cast("long").alias("c"), p.alias("p"))
        return F.aggregate(places, start, step)["c"]

    each = F.transform(F.array(hashes), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    return F.element_at(each, 1)


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per row of docs: id, th (hash of the text), base counts, hh (hash of the host) and lines
    array<struct<h, g, w>>: 128 bits that stand for host and line, and the line's words."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(host_col).cast("string"), F.lit("\0")).alias("host"))
    split = texts.select("id", "text", F.xxhash64("text").alias("th"), F.xxhash64("host").alias("hh"), split_words(F.col("text")).alias("words"), F.split("text", "\n").alias("lines"))
    full = F.filter("lines", lambda x: x.rlike(f"[^{SPACE}]"))
    counted = split.withColumn("lines", full)
    return counted.select(
        "id", "th",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        "hh",
        F.transform("lines", lambda x: F.struct(
            F.xxhash64("hh", F.lower(F.btrim(x, F.lit(_TRIM)))).alias("h"), F.xxhash64(F.lit(1), F.lower(F.btrim(x, F.lit(_TRIM)))).alias("g"), F.regexp_count(x, F.lit(f"[^{SPACE}]+")).alias("w"))).alias("lines"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_share_percent: int = MAX_SHARE_PERCENT,
                  max_docs: int = MAX_DOCS, min_left_percent: int = MIN_LEFT_PERCENT, copies_once: bool = False, folder: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_left (words after frequent lines are gone), kept; and th, a hash of the text.

    A line is frequent in a host when more than ``max_docs`` of its documents and more than
    ``max_share_percent`` of them hold it; ``copies_once``: documents of equal text count as one.

    A null or empty text has no words and fails the base rules; texts of any length are read whole.
    Documents without a host form one host. Rows that repeat an id are documents of their own, unless
    their texts are equal too; the line of a tie stays with the smallest id (a null id counts as largest).
    Other columns are not read. An empty table gives an empty result.
    """
    folder = folder or work_folder(docs.sparkSession)
    base = written(measured(docs, id_col, text_col, host_col), folder, "measured")
    document = [] if copies_once else ["id"]
    lines = base.select("id", "th", "hh", F.explode("lines").alias("line")).select("id", "th", "hh", "line.h", "line.g", "line.w")
    # distinct (line, document) pairs first, then partial counts: a line of a third of all documents meets no single task
    pairs = lines.groupBy("hh", "h", "g", *document, "th").agg(F.min("id").alias("first"))
    often = pairs.groupBy("hh", "h", "g").agg(F.count("*").alias("n"), F.min("first").alias("keeper")).where(F.col("n") > max_docs)
    often = written(often, folder, "often")
    hosts = base.groupBy("hh", *document, "th").agg(F.lit(1).alias("one")).groupBy("hh").agg(F.count("*").alias("docs"))
    hosts = written(hosts, folder, "hosts")
    frequent = often.join(hosts.hint("merge"), "hh").where(100 * F.col("n") > max_share_percent * F.col("docs"))
    frequent = written(frequent.select("h", "g", "keeper"), folder, "frequent")
    hits = lines.join(frequent.hint("merge"), ["h", "g"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
    lost = hits.groupBy("id", "th").agg(F.sum("w").alias("lost"))
    copies = base.groupBy("id", "th").agg(F.count("*").alias("copies"))  # rows that repeat id and text were all summed
    lost = lost.join(copies.hint("merge"), ["id", "th"]).select(F.col("id").alias("lost_id"), F.col("th").alias("lost_th"), (F.col("lost") / F.col("copies")).cast("long").alias("lost"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    both = base.drop("lines", "hh").join(lost.hint("merge"), F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("th") == F.col("lost_th")), "left")
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    return both.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), left.alias("n_left"), (~failed & (100 * left >= min_left_percent * F.col("n_words"))).alias("kept"), "th")


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of docs that the rules keep, unchanged: rows that repeat id and text stay or go together, all
    columns keep their names and values, and an empty table stays empty."""
    key, th, own = fresh(docs, "_rule_id", "_rule_th", "_own_th")
    kept = quality_rules(docs, id_col, text_col, host_col).where("kept").select(F.col("doc_id").alias(key), F.col("th").alias(th))
    rows = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return rows.join(kept.hint("merge"), rows[id_col].eqNullSafe(kept[key]) & (rows[own] == kept[th]), "left_semi").select(*docs.columns)
