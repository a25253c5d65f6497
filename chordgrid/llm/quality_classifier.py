"""Quality classifier: hierarchical empirical Bayes over document, path and host evidence.

A logistic regression on text measures and on hashed words and word pairs gives each document's evidence.
Hosts and their paths are then estimated by grouped aggregation: a document's vote is its label where it
has one, else its evidence; a host's rate of good documents is shrunk toward the global rate, a path's
toward its host's, with prior weights that the spread between groups decides against the spread within
them (method of moments), so sparse sites fall back on what is known above them. The score of a document
combines its own evidence with the rate of its path, which leaves its own vote out.

The model is fitted on a bounded sample of labelled rows: the weights of the words on one half of it, the
regression, which has their mean as one of its measures, on the other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chordgrid.llm.quality_rules import split_words
from chordgrid.llm.shared import SPACE, ascii_lower, work_folder, written

#: The regression is fitted on at most so many labelled rows, the first by a hash of the id.
MAX_TRAIN = 20_000
#: Rounds of Newton's method, and its ridge.
ROUNDS, RIDGE = 25, 1e-2
#: A document is kept at this score; the classifier drops what is very likely bad, not what is in doubt.
MIN_SCORE = 0.25
PRIOR = (2.0, 500.0)
#: Words and word pairs are hashed to so many weights.
BUCKETS = 4096


def measures(text: Column) -> dict[str, Column]:
    """Text measures, each between 0 and about 1; 0 for an empty text."""
    words = split_words(text)
    n, chars = F.greatest(F.size(words), F.lit(1)), F.greatest(F.length(text), F.lit(1))
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / chars
    return {
        "symbols": share(r"[#*$%&|<>]+") * 10,
        "shouts": share(r"[!?]{2,}") * 10,
        "capitals": share(r"[A-Z]"),
        "digits": share(r"[0-9]") * 4,
        "stops": share(r"[.,;:]") * 10,
        "bars": share(r" \| ") * 10,
        "word_chars": F.least(chars / n / 20, F.lit(1.0)),
        "repeats": F.when(F.size(words) > 0, 1 - F.size(F.array_distinct(words)) / n).otherwise(0.0),
        "length": F.log1p(F.size(words)) / 10,
        "breaks": share(r"\n") * 20,
        "twins": F.regexp_count(text, F.lit(rf"\b(\w+)[{SPACE}]+\1\b")) / n,
    }


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once a row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def word_buckets(text: Column) -> Column:
    """The hash buckets of a text's words and pairs of neighbouring words."""
    bucket = lambda *c: F.pmod(F.xxhash64(*c), F.lit(BUCKETS))
    return _once(split_words(ascii_lower(text)), lambda words: F.flatten(F.transform(words, lambda w, i: F.array(bucket(w), bucket(F.get(words, i + 1), w)))))


def bucket_weights(rows: DataFrame) -> list[float]:
    """For each bucket how much likelier good documents hold it than bad ones (log odds, smoothed), from rows
    (text, target)."""
    one = rows.select("target", F.explode(F.array_distinct(word_buckets(F.col("text")))).alias("bucket"))
    totals = rows.agg(F.sum("target").alias("good"), F.sum(1 - F.col("target")).alias("bad")).first()
    good, bad = totals["good"] or 0.0, totals["bad"] or 0.0
    out = [0.0] * BUCKETS
    for r in one.groupBy("bucket").agg(F.sum("target").alias("good"), F.sum(1 - F.col("target")).alias("bad")).collect():
        out[r["bucket"]] = round(float(np.log((r["good"] + 1) / (good + 2)) - np.log((r["bad"] + 1) / (bad + 2))), 6)
    return out


def word_evidence(text: Column, weights: list[float]) -> Column:
    """The mean weight of a text's words and word pairs; 0 without a word."""
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")  # folded to a constant
    total = lambda buckets: F.aggregate(buckets, F.lit(0.0), lambda a, b: a + F.get(table, b.cast("int")))
    return _once(word_buckets(text), lambda buckets: F.when(F.size(buckets) > 0, total(buckets) / F.size(buckets)).otherwise(0.0))


@dataclass
class Regression:
    names: list[str]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, rows: np.ndarray, target: np.ndarray, names: list[str]) -> "Regression":
        """Newton's method with a ridge, on standardised measures and their squares."""
        if not len(rows):
            return cls(names, np.zeros(2 * len(names)), np.ones(2 * len(names)), np.zeros(2 * len(names) + 1))
        x = np.hstack([rows, rows**2])
        mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
        x = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
        w = np.zeros(x.shape[1])
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * len(x) * np.eye(len(w)) / 100
            step = np.linalg.solve(hessian, x.T @ (target - p) - RIDGE * len(x) * w / 100)
            w += step
            if np.abs(step).max() < 1e-9:
                break
        return cls(names, mean, scale, w)

    def logit(self) -> Column:
        """The fitted log odds over columns ``names``."""
        out, k = F.lit(float(self.weights[0])), len(self.names)
        for i, name in enumerate(self.names):
            v = F.col(name)
            for j, x in ((i, v), (i + k, v * v)):
                out = out + (x - float(self.mean[j])) * float(self.weights[1 + j] / self.scale[j])
        return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), out))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def prior_weight(groups: DataFrame, rate: str) -> float:
    """How many documents the rate above a group is worth, from groups of (n, s, q, rate above), s and q being
    the sums of votes and of their squares: the variance within groups over that between them. It is large
    if the groups' means spread no more than votes of that variance make them."""
    mean = F.col("s") / F.col("n")
    within = F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean) * F.col("n") / (F.col("n") - 1)
    r = groups.where("n > 1").agg(
        F.sum(F.col("n") * F.pow(mean - F.col(rate), 2)).alias("spread"), F.sum(within).alias("chance"), F.sum(F.col("n") * within).alias("within"), F.sum("n").alias("n")).first()
    if not r["n"]:
        return PRIOR[1]
    between = max((r["spread"] - r["chance"]) / r["n"], 1e-9)
    return float(np.clip(r["within"] / r["n"] / between, *PRIOR))


def _key(*columns: str) -> Column:
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])


def fitted(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str, max_train: int, folder: str) -> tuple[Regression, list[float]]:
    """The regression and the words' weights, from at most ``max_train`` ids of ``marks`` (l_id, target): the
    first by a hash."""
    ids = docs.select(F.col(id_col).alias("id")).distinct()
    marked = ids.join(marks.hint("merge"), F.col("id") == F.col("l_id")).select("id", "target", F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("h"))
    marked = written(marked, folder, "marked")
    # a cut on the hash first: then no task sends the driver more than its share of the sample
    cut = int((1 << 40) * min(1.0, 1.2 * max_train / max(marked.count(), 1)))
    sample = written(marked.where(F.col("h") < cut).orderBy("h", "id").limit(max_train).withColumnRenamed("id", "s_id"), folder, "sample")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the sample has at most max_train rows; of an id that repeats, the text with the least hash counts
    rows = rows.join(F.broadcast(sample), F.col("id") == F.col("s_id")).groupBy("id", "h", "target").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows = written(rows.select("h", "target", "text"), folder, "train")
    weights = bucket_weights(rows.where("h % 2 = 0"))
    own = measures(F.col("text")) | {"words": word_evidence(F.col("text"), weights)}
    names = list(own)
    train = rows.where("h % 2 = 1").select("h", "target", *[c.cast("double").alias(n) for n, c in own.items()]).orderBy("h", *names).toPandas()
    return Regression.fit(train[names].to_numpy(float), train["target"].to_numpy(float), names), weights


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_cols: tuple[str, ...] = ("lang",),
                   label_col: str = "quality", max_train: int = MAX_TRAIN, min_score: float = MIN_SCORE, folder: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, evidence (the classifier's probability), host_rate, path_rate,
    score, kept.

    ``labels`` has id_col and label_col (1 good, 0 bad; null is ignored, and of an id with both the mean
    counts). Null texts are empty; texts of any length are measured whole; null hosts and paths are groups
    of their own. Rows that repeat an id are documents of their own. Without labels every evidence is a
    half. Other columns are not read. An empty table gives an empty result.
    """
    folder = folder or work_folder(docs.sparkSession)
    marks = written(labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l_id")).agg(F.avg(label_col).alias("target")), folder, "labels")
    model, weights = fitted(docs, marks, id_col, text_col, max_train, folder)

    own = measures(F.col("text")) | {"words": word_evidence(F.col("text"), weights)}
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), _key(host_col).alias("host"), _key(host_col, *path_cols).alias("path"))
    measured = base.select("id", "host", "path", *[c.cast("double").alias(n) for n, c in own.items()])
    scored = written(measured.select("id", "host", "path", F.round(sigmoid(model.logit()), 9).alias("e")), folder, "evidence")
    scored = scored.join(marks.hint("merge"), F.col("id") == F.col("l_id"), "left").select("id", "host", "path", "e", F.coalesce("target", "e").alias("vote"))
    return posteriors(written(scored, folder, "votes"), min_score, folder)


def posteriors(scored: DataFrame, min_score: float, folder: str) -> DataFrame:
    """The scores of rows (id, host, path, e, vote)."""
    sums = lambda *v: [F.sum(x).alias(x) for x in v]
    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("vote").alias("s"), F.sum(F.col("vote") * F.col("vote")).alias("q")), folder, "paths")
    total = paths.agg(*sums("n", "s")).first()
    rate = float(np.clip(total["s"] / total["n"], 1e-6, 1 - 1e-6)) if total["n"] else 0.5
    hosts = written(paths.groupBy("host").agg(*sums("n", "s", "q")).withColumn("above", F.lit(rate)), folder, "hosts")
    k_host = prior_weight(hosts, "above")
    hosts = written(hosts.select("host", F.col("n").alias("hn"), F.col("s").alias("hs"), ((F.col("s") + k_host * rate) / (F.col("n") + k_host)).alias("host_rate")), folder, "host_rates")
    sites = written(paths.join(hosts.hint("merge"), "host"), folder, "sites")
    k_path = prior_weight(sites.withColumnRenamed("host_rate", "above"), "above")

    # each document meets its site's sums less its own vote
    both = scored.join(sites.drop("host").hint("merge"), "path")
    host = (F.col("hs") - F.col("vote") + k_host * rate) / (F.col("hn") - 1 + k_host)
    both = both.withColumn("host_rate", host)
    path_rate = (F.col("s") - F.col("vote") + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path)
    both = both.withColumn("path_rate", F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), path_rate)))
    evidence = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("e")))
    score = F.round(sigmoid(logit(evidence) + logit(F.col("path_rate")) - float(np.log(rate / (1 - rate)))), 6)
    return both.select(
        F.col("id").alias("doc_id"), F.col("e").alias("evidence"), F.round("host_rate", 6).alias("host_rate"), F.round("path_rate", 6).alias("path_rate"),
        score.alias("score"), (score >= min_score).alias("kept"))
