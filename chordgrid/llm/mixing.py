"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame
functions only.

Sources get word targets by weight, none above a multiple of its size. Each source's documents fall
into blocks by a hash; its target is a quota of block draws: whole passes over all blocks, then a
prefix of a permutation of the blocks, then some documents of one more block. A binary tree splits the
quotas among output shards: each node hands its left child half of its draws, with a composition
drawn from the multivariate hypergeometric law. Every shard then takes the next draws of each
source's permuted blocks, so shards are disjoint, and shuffles its documents locally. How much of a source
is taken follows from its quota; which shard a document goes to, and with what company, from the tree.

Blocks have about 512 documents at every size, so their number follows the source. A node of the tree is
one row with a number for each source: sources may be tens of thousands, not as many as documents.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chordgrid.llm.quality_rules import split_words
from chordgrid.llm.shared import fresh, work_folder, written

MAX_TIMES = 3
DOCS_PER_BLOCK = 512
#: An output shard has about so many blocks; the tree has as many levels as that takes.
BLOCKS_PER_SHARD = 16
#: After so many levels the tree's nodes are written, so plans stay small.
LEVELS_AT_ONCE = 3
#: Up to so many sources (a few MB) the source table is broadcast; beyond, joins shuffle.
BROADCAST_SOURCES = 1 << 15


def targets(sources: DataFrame, max_times: int = MAX_TIMES) -> DataFrame:
    """(source, size, ..) with weights 1, 2, 3 repeating by code point and their word targets.

    target = least(max_times * size, level * weight) with the one level at which the targets add up to
    all sizes; it is the largest of the levels that each prefix of the sources, by size over weight,
    would leave to the others if that prefix stopped at its limit.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sources.withColumn("sno", number).withColumn("weight", (F.col("sno") - 1) % 3 + 1)
    ranked = ranked.withColumn("limit", (max_times * F.col("size")).cast("double"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "sno").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("size").over(every) - F.coalesce(F.sum("limit").over(order), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(order), F.lit(0)))
    levelled = ranked.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return levelled.withColumn("target", F.least("limit", F.col("level") * F.col("weight"))).drop("limit", "level")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that its arguments decide."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _log_factorial(x: str) -> str:
    """ln x! by Stirling's series, exact to 1e-13; small values are shifted up first."""
    y = f"(cast({x} as double) + 8D)"
    shift = " + ".join(f"ln(cast({x} as double) + {i}D)" for i in range(1, 9))
    return f"(({y} + 0.5D) * ln({y}) - {y} + 0.9189385332046728D + 1D / (12D * {y}) - 1D / (360D * {y} * {y} * {y}) + 1D / (1260D * {y} * {y} * {y} * {y} * {y}) - ({shift}))"


def hypergeometric(total: str, good: str, draws: str, u: str) -> str:
    """SQL: how many of ``draws`` draws without replacement out of ``total`` are among ``good``, by
    inversion at u. Values over 14 standard deviations off the mean are left out (chance below 1e-40)."""
    mean = f"({draws} * ({good} / greatest({total}, 1)))"
    wide = f"(14 * sqrt({mean} * (1 - {good} / greatest({total}, 1))) + 14)"
    low = f"cast(greatest(0, {draws} - ({total} - {good}), floor({mean} - {wide})) as bigint)"
    high = f"cast(least({good}, {draws}, ceil({mean} + {wide})) as bigint)"
    weight = lambda k: "(-" + " - ".join(_log_factorial(x) for x in (k, f"(v.g - {k})", f"(v.d - {k})", f"(v.t - v.g - v.d + {k})")) + ")"
    bound = f"named_struct('t', {total}, 'g', {good}, 'd', {draws}, 'u', {u}, 'lo', {low}, 'hi', {high})"
    logs = f"element_at(transform(array({bound}), v -> named_struct('lo', v.lo, 'u', v.u, 'w', transform(sequence(v.lo, v.hi), k -> {weight('k')}))), 1)"
    chance = f"element_at(transform(array({logs}), x -> named_struct('lo', x.lo, 'u', x.u, 'p', element_at(transform(array(array_max(x.w)), m -> transform(x.w, y -> exp(y - m))), 1))), 1)"
    return f"""element_at(transform(array({chance}), y -> y.lo + element_at(transform(array(y.u * aggregate(y.p, 0D, (a, b) -> a + b)), goal ->
        aggregate(y.p, named_struct('c', 0D, 'n', 0L), (a, b) -> named_struct('c', a.c + b, 'n', a.n + if(a.c + b < goal, 1L, 0L))).n), 1)), 1)"""


def shard_quotas(quotas: DataFrame, levels: int, seed: int = 0, folder: str | None = None) -> DataFrame:
    """(shard, sno, quota) of (sno, quota): exact block quotas of 2**levels shards.

    One row holds a node of the tree with its quota of every source. Each level splits all nodes; a
    source's share of the left child is hypergeometric given those of the sources before it.
    """
    nodes = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct("sno", F.col("quota").cast("long").alias("quota")))).alias("q")).where(F.size("q") > 0)
    nodes = nodes.select(F.lit(0).cast("long").alias("node"), F.transform("q", lambda x: x["quota"]).alias("q"), F.transform("q", lambda x: x["sno"]).alias("snos"))
    for level in range(levels):
        draw = hypergeometric("acc.t", "q[i]", "acc.d", f"((pmod(xxhash64({seed}, {level}, node, i), 4503599627370496L) + 0.5D) / 4503599627370496D)")
        step = f"element_at(transform(array({draw}), x -> named_struct('t', acc.t - q[i], 'd', acc.d - least(greatest(x, 0), q[i]), 'left', concat(acc.left, array(x)))), 1)"
        total = "aggregate(q, 0L, (a, b) -> a + b)"
        # the half that gets the odd draw is as random as the rest
        half = f"(({total} + pmod(xxhash64({seed}, {level}, node), 2L)) div 2)"
        left = f"aggregate(sequence(0, size(q) - 1), named_struct('t', {total}, 'd', {half}, 'left', cast(array() as array<bigint>)), (acc, i) -> {step}).left"
        split = nodes.withColumn("left", F.expr(left))
        right = F.zip_with("q", "left", lambda a, b: a - b)
        nodes = split.select("snos", F.explode(F.array(F.struct((2 * F.col("node")).alias("node"), F.col("left").alias("q")), F.struct((2 * F.col("node") + 1).alias("node"), right.alias("q")))).alias("n")).select("n.node", "n.q", "snos")
        if folder and (level + 1) % LEVELS_AT_ONCE == 0 and level + 1 < levels:
            nodes = written(nodes, folder, f"nodes{level + 1}")
    each = nodes.select(F.col("node").alias("shard"), F.explode(F.arrays_zip("snos", "q")).alias("s"))
    return each.select("shard", F.col("s.snos").alias("sno"), F.col("s.q").alias("quota"))


class Mix:
    """The plan of one mix.

    ``items``: one row per distinct (id, source, size) with its number of rows ``m``, its source's size
    and target, and its block. ``drawn``: (id, sno, size, shard, pass) for each time that a document is
    taken, with an ``order`` that shuffles a shard's documents.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_times: int = MAX_TIMES, levels: int | None = None, seed: int = 0, folder: str | None = None):
        spark = docs.sparkSession
        folder = folder or work_folder(spark)
        sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.size(split_words(F.coalesce(F.col(text_col), F.lit("")))).cast("long").alias("size"))
        sized = written(sized.groupBy("id", "source", "size").agg(F.count("*").alias("m")), folder, "sized")
        sources = written(sized.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("size"), F.sum("m").alias("docs")), folder, "source_sizes")
        plan = targets(sources, max_times).withColumn("blocks", F.ceil(F.col("docs") / DOCS_PER_BLOCK))
        passes = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
        plan = plan.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("size"))
        plan = written(plan.withColumnRenamed("size", "source_size").withColumnRenamed("source", "of"), folder, "plan")
        hint = "broadcast" if plan.count() <= BROADCAST_SOURCES else "merge"
        items = sized.join(plan.hint(hint), sized["source"].eqNullSafe(plan["of"])).withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "id"), F.col("blocks")))
        self.items = written(items.select("id", "source", "size", "m", "sno", "source_size", "target", "passes", "rest", "block"), folder, "items")

        blocks = self.items.groupBy("sno", "block").agg(F.sum(F.col("size") * F.col("m")).alias("words"), F.first("passes").alias("passes"), F.first("rest").alias("rest"))
        order = Window.partitionBy("sno").orderBy(F.xxhash64(F.lit(seed), "sno", "block"), "block")
        blocks = blocks.withColumn("rank", F.row_number().over(order) - 1).withColumn("upto", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        blocks = blocks.withColumn("count", F.count("*").over(Window.partitionBy("sno")))
        goes = F.when(F.col("upto") <= F.col("rest"), 2).when(F.col("upto") - F.col("words") < F.col("rest"), 1).otherwise(0)
        blocks = written(blocks.withColumn("extra", goes), folder, "blocks")

        quotas = blocks.groupBy("sno").agg((F.first("passes") * F.first("count") + F.count_if(F.col("extra") > 0)).alias("quota"))
        quotas = written(quotas, folder, "quotas")
        if levels is None:
            levels = max(0, ceil(log2(max(1, (quotas.agg(F.sum("quota")).first()[0] or 0) / BLOCKS_PER_SHARD))))
        self.shards = 1 << levels
        leaves = shard_quotas(quotas, levels, seed, folder)
        after = Window.partitionBy("sno").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
        leaves = leaves.withColumn("stop", F.sum("quota").over(after)).where("quota > 0")
        draws = leaves.select("sno", "shard", F.explode(F.sequence(F.col("stop") - F.col("quota"), F.col("stop") - 1)).alias("draw"))
        counts = blocks.groupBy("sno").agg(F.first("count").alias("count"))
        draws = draws.join(counts.hint("merge"), "sno").select("sno", "shard", F.floor(F.col("draw") / F.col("count")).alias("pass"), (F.col("draw") % F.col("count")).alias("rank"))
        draws = draws.join(blocks.hint("merge"), ["sno", "rank"]).select("sno", "block", "shard", "pass", ((F.col("pass") == F.col("passes")) & (F.col("extra") == 1)).alias("partial"))
        draws = written(draws, folder, "draws")

        # of a partial block, documents in permuted order as long as they fit into what its source still lacks
        last = blocks.where("extra = 1").select("sno", "block", (F.col("rest") - F.col("upto") + F.col("words")).alias("lack"))
        inner = self.items.select("id", "source", "size", "m", "sno", "block").join(last.hint("merge"), ["sno", "block"])
        lists = inner.groupBy("sno", "block").agg(F.first("lack").alias("lack"), F.array_sort(F.collect_list(F.struct(F.xxhash64(F.lit(seed), F.lit("in"), "id").alias("o"), "id", (F.col("size") * F.col("m")).alias("w"), "size"))).alias("l"))
        start = F.struct(F.col("lack").alias("lack"), F.slice("l", 1, 0).alias("got"))
        fit = lambda a, x: F.when(x["w"] <= a["lack"], F.struct((a["lack"] - x["w"]).alias("lack"), F.concat(a["got"], F.array(x)).alias("got"))).otherwise(a)
        got = lists.select("sno", "block", F.explode(F.aggregate("l", start, fit)["got"]).alias("g")).select("sno", "block", F.col("g.id").alias("got_id"), F.col("g.size").alias("got_size"))
        got = written(got, folder, "last_documents")
        mine = self.items.select("id", "source", "size", "m", "sno", "block").join(draws.hint("merge"), ["sno", "block"])
        mine = mine.join(got.withColumn("fits", F.lit(True)).hint("merge"), mine["id"].eqNullSafe(got["got_id"]) & (mine["sno"] == got["sno"]) & (mine["block"] == got["block"]) & (mine["size"] == got["got_size"]), "left")
        mine = mine.where((F.col("size") > 0) & (~F.col("partial") | F.col("fits")))
        self.drawn = mine.select("id", "source", "size", "m", "shard", "pass", F.xxhash64(F.lit(seed), "shard", "pass", "id").alias("order"))
        self.draws = draws


def mix_words(docs: DataFrame, **options) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target (of its source), taken, and shards, the numbers of the
    output shards that it goes to, one for each time it is taken (ascending, comma-joined).

    Null texts have size 0 and are never taken; a text of any length is one document, taken whole or not;
    a null source is a source of its own, last in order. Rows that repeat id, source and size are taken
    together. Other columns are not read. An empty table gives an empty result.
    """
    mix = Mix(docs, **options)
    # a document is taken a few times at most
    taken = mix.drawn.groupBy("id", "source", "size").agg(F.count("*").alias("times"), F.array_sort(F.collect_list("shard")).alias("shards"))
    taken = taken.select(F.col("id").alias("t_id"), F.col("source").alias("t_source"), F.col("size").alias("t_size"), "times", F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards"))
    same = mix.items["id"].eqNullSafe(taken["t_id"]) & mix.items["source"].eqNullSafe(taken["t_source"]) & (mix.items["size"] == taken["t_size"])
    rows = mix.items.join(taken.hint("merge"), same, "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"), F.coalesce("shards", F.lit("")).alias("shards"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shard_col: str | None = None, **options) -> DataFrame:
    """The rows of docs as often as the mix takes them, laid out by output shard: a shard's rows are in one partition,
    one after the other in shuffled order. All columns keep their names and values, and ``shard_col``, where
    given, adds the shard's number.

    Null texts and texts without words have size 0 and are never taken; a null id or source is a value like
    others; rows that repeat id, source and size are taken together; texts of any length are taken whole or
    not; an empty table stays empty.
    """
    a, b, c, d, e, f = fresh(docs, "_mix_id", "_mix_source", "_mix_size", "_own_size", "_draws", "_draw")
    drawn = Mix(docs, id_col, text_col, source_col, **options).drawn
    times = drawn.groupBy("id", "source", "size").agg(F.array_sort(F.collect_list(F.struct("shard", "order"))).alias(e))
    times = times.select(F.col("id").alias(a), F.col("source").alias(b), F.col("size").alias(c), e)
    rows = docs.withColumn(d, F.size(split_words(F.coalesce(F.col(text_col), F.lit("")))).cast("long"))
    same = rows[id_col].eqNullSafe(times[a]) & rows[source_col].cast("string").eqNullSafe(times[b]) & (rows[d] == times[c])
    out = rows.join(times.hint("merge"), same).withColumn(f, F.explode(e))
    laid = out.repartition(F.col(f"{f}.shard")).sortWithinPartitions(f"{f}.shard", f"{f}.order")
    return laid.select(*[F.col(x) for x in docs.columns], *([F.col(f"{f}.shard").alias(shard_col)] if shard_col else []))
