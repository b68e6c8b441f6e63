"""Mixing sources to target weights by Pareto order sampling.

Each source has a target number of words. A document's expected copies are in
proportion to a measure that grows with the root of its size, min(most copies,
rate * measure), with the rate of its source chosen so that the expected words
meet the target. The whole part is a certain number of copies, the fraction an
inclusion probability p of the document's own. Pareto sampling ranks the
documents of a source by Q = [u / (1 - u)] / [p / (1 - p)], with a random u that
the document and the seed alone decide, and takes them in that order as far as
they fit into the words still wanted. What the first document that doesn't fit
leaves open is filled in further passes down the same ranking, over documents
that still fit, and at last by the one document that comes nearest to what is
open, if it brings the source nearer to its target. A pass is kept as ranges of
size and Q, so the plan is one short row per source and applying it moves no
text.

Only built-in functions are used. No task sorts a source: Q falls into cells,
the words per (source, cell) are summed map-side, and only the cell of each
source in which the open words run out is ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm.common import BROADCAST_ROWS, free_name, release, spread_join, stored, text_of

#: Words: runs of anything but [\x20\x09-\x0D].
WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the hash that make the uniform number (52 bits, exact in a double).
DIGITS = 13
#: Passes down the ranking; each later one fills what the one before left open.
PASSES = 4
PLAN_COLUMNS = ("source_size", "target", "rate", "cuts")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def uniform(id_col: str, text: Column, seed: int) -> Column:
    """u in (0, 1) from the md5 of seed, id and the md5 of the text."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                      F.md5(text.cast("binary")))
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** DIGITS)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_copies: int) -> DataFrame:
    """source, source_size -> with its target: share of all words by weight, capped at max_copies x size.

    Weights go round the sources in code point order, null last. A source that
    reaches its cap gives its excess to the others by weight until none is
    above: with sources in order of cap / weight, one is capped if the words
    left per unit of weight left are at least that ratio. The windows run over
    one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    before, on = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    index = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    table = (sizes.withColumn("place", F.row_number().over(order))
             .withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (index + 1).cast("int")))
             .withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
             .withColumn("ratio", F.col("cap") / F.col("weight"))
             .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
             .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                         / F.sum("weight").over(on)))
    final = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "place", "level"))).over(everything)
    return (table.withColumn("final", final["level"])
            .select("source", "source_size",
                    F.when(F.col("final").isNull(), F.col("cap"))
                    .otherwise(F.least("cap", F.col("final") * F.col("weight"))).alias("target")))


CUTS = "array<struct<least:double,open:double,q0:double,q:double>>"


def _taken(size: Column, q: Column, cuts: Column) -> Column:
    return F.exists(cuts, lambda c: (size >= c["least"]) & (size <= c["open"]) & (q >= c["q0"]) & (q <= c["q"]))


def measure(size: Column) -> Column:
    """What inclusion is in proportion to: floor(1000 * root of the size), a whole number, so that sums are exact."""
    return F.floor(F.sqrt(F.greatest(size, F.lit(1)).cast("double")) * 1000).cast("long")


def expected(size: Column, rate: Column, max_copies: int) -> Column:
    """Expected copies of a document; every copy where its source is wanted whole (null rate)."""
    most = F.lit(float(max_copies))
    return F.coalesce(F.least(most, rate * measure(size)), most)


def _chance(copies: Column) -> Column:
    return copies - F.floor(copies)


def source_rates(by_size: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """source, rate: the expected words, sum of min(max_copies, rate * measure) * size, are the target.

    ``by_size``: source, size, n. From the largest measure down, the documents
    capped so far take max_copies each and the rest share what is left; the
    first size that stays below the cap at that level ends the caps. The windows
    run over one row per source and size.
    """
    order = Window.partitionBy("source").orderBy(F.col("x").desc())
    whole = F.col("n") * F.col("size")
    table = (by_size.filter("size > 0").withColumn("x", measure(F.col("size"))).groupBy("source", "x")
             .agg(F.sum(whole).alias("words"))
             .withColumn("before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("rest", F.sum(F.col("words").cast("decimal(38,0)") * F.col("x")).over(
                 order.rowsBetween(Window.currentRow, Window.unboundedFollowing)).cast("double")))
    wanted = targets.select(F.col("source").alias("target_source"), "target")
    level = (F.col("target") - F.lit(float(max_copies)) * F.col("before")) / F.col("rest")
    return (table.join(wanted, F.col("source").eqNullSafe(F.col("target_source"))).withColumn("level", level)
            .filter(F.col("level") * F.col("x") < max_copies).groupBy("source")
            .agg(F.max_by("level", "x").alias("rate")))


def _rank(u: Column, p: Column) -> Column:
    """Pareto rank: odds of u over odds of p; null where nothing is left to sample."""
    return F.when(p > 0, (u * (1 - p)) / ((1 - u) * p))


def mix_plan(docs: DataFrame, weights: Sequence[float], share: float = 1.5, max_copies: int = 2, seed: int = 17,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", passes: int = PASSES,
             rows_per_cell: int = 20_000) -> DataFrame:
    """One row per source: source, source_size, target, rate, cuts (ranges of size and Q that are taken)."""
    rows = stored(docs.select(F.col(source_col).alias("source"), n_words(text_of(text_col)).alias("size"),
                              uniform(id_col, text_of(text_col), seed).alias("u")))
    by_size = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    counted = stored(by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n")))
    n_sources, n_rows = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    cells = max(64, -(-n_rows // rows_per_cell))
    targets = stored(source_targets(counted.select("source", "source_size"), weights, share, max_copies))
    rates = source_rates(by_size, targets, max_copies).withColumnRenamed("source", "rate_source")
    plan = stored(targets.join(rates, F.col("source").eqNullSafe(F.col("rate_source")), "left").drop("rate_source"))
    certain = (spread_join(by_size, plan.select("source", "rate"), "source", "size", n_sources)
               .groupBy(F.col("source").alias("sure_source"))
               .agg(F.sum(F.floor(expected(F.col("size"), F.col("rate"), max_copies)) * F.col("n") * F.col("size")).alias("sure")))
    plan = stored(plan.join(certain, F.col("source").eqNullSafe(F.col("sure_source")), "left")
                  .withColumn("open", F.col("target") - F.coalesce("sure", F.lit(0)))
                  .withColumn("cuts", F.array().cast(CUTS)).drop("sure", "sure_source"))
    for _ in range(passes):
        wanted = stored(_left(rows, plan, n_sources, max_copies, cells).filter(F.col("size") <= F.col("open")))
        plan = stored(_next_pass(wanted, plan))
        release(wanted)
    plan = stored(_nearest(rows, plan, n_sources, max_copies, cells))
    return plan.select("source", *PLAN_COLUMNS)


def _left(rows: DataFrame, plan: DataFrame, n_sources: int, max_copies: int, cells: int) -> DataFrame:
    """The documents that can be sampled and have not been taken: source, cell, size, q, open.

    The cell follows Q / (1 + Q), in which the ranks around the cut (Q near 1) are spread evenly.
    """
    q = _rank(F.col("u"), _chance(expected(F.col("size"), F.col("rate"), max_copies)))
    return (spread_join(rows, plan.select("source", "rate", "open", "cuts"), "source", "u", n_sources)
            .withColumn("q", q).filter(F.col("q").isNotNull() & ~_taken(F.col("size"), F.col("q"), F.col("cuts")))
            .select("source", F.floor(F.col("q") / (1 + F.col("q")) * cells).cast("int").alias("cell"), "size", "q", "open"))


def _more_cuts(plan: DataFrame, cuts: DataFrame) -> DataFrame:
    """The plan with another cut per source of ``cuts`` (source, cut, words)."""
    cuts = cuts.withColumnRenamed("source", "cut_source")
    return (plan.join(cuts, plan["source"].eqNullSafe(cuts["cut_source"]), "left")
            .withColumn("cuts", F.concat("cuts", F.when(F.col("cut").isNotNull(), F.array("cut")).otherwise(F.array().cast(CUTS))))
            .withColumn("open", F.col("open") - F.coalesce("words", F.lit(0))).drop("cut", "words", "cut_source"))


def _cut(least: Column, most: Column, q0: Column, q: Column) -> Column:
    names = ("least", "open", "q0", "q")
    return F.struct(*(c.cast("double").alias(n) for n, c in zip(names, (least, most, q0, q), strict=True))).alias("cut")


def _nearest(rows: DataFrame, plan: DataFrame, n_sources: int, max_copies: int, cells: int) -> DataFrame:
    gap = F.abs(F.col("size") - F.col("open"))
    best = (_left(rows, plan, n_sources, max_copies, cells).filter((F.col("size") > 0) & (gap < F.col("open"))).groupBy("source")
            .agg(F.min(F.struct(gap.alias("gap"), "q", "size")).alias("best")).select("source", "best.*"))
    size, q = F.col("size"), F.col("q")
    return _more_cuts(plan, best.select("source", _cut(size, size, q, q), F.col("size").alias("words")))


def _next_pass(wanted: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with another cut down the ranking of ``wanted``, the documents left that still fit."""
    running = Window.partitionBy("source").orderBy("cell")
    summed = (wanted.groupBy("source", "cell").agg(F.sum("size").alias("words"), F.max("q").alias("last"),
                                                  F.first("open").alias("open"))
             .withColumn("before", F.sum("words").over(running) - F.col("words")))
    # Whole cells that fit, and in each source the one cell in which the open words run out.
    fits = F.col("before") + F.col("words") <= F.col("open")
    whole = (summed.filter(fits).groupBy("source")
             .agg(F.max("last").alias("q"), F.sum("words").alias("words")))
    edge = (summed.filter(~fits & (F.col("before") <= F.col("open")))
            .groupBy("source").agg(F.min_by(F.struct("cell", "before"), "cell").alias("edge"))
            .select(F.col("source").alias("edge_source"), F.col("edge.cell").alias("edge_cell"), "edge.before"))
    inside = Window.partitionBy("source").orderBy("q").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    within = wanted.join(edge, F.col("source").eqNullSafe(F.col("edge_source")) & (F.col("cell") == F.col("edge_cell")))
    part = (within.withColumn("sum", F.col("before") + F.sum("size").over(inside))
            .filter(F.col("sum") <= F.col("open")).groupBy("source")
            .agg(F.max("q").alias("q"), F.sum("size").alias("words")))
    cut = whole.unionByName(part).groupBy("source").agg(F.max("q").alias("q"), F.sum("words").alias("words"))
    cut = cut.join(plan.select(F.col("source").alias("plan_source"), "open"), F.col("source").eqNullSafe(F.col("plan_source")))
    none = F.lit(0.0)
    return _more_cuts(plan, cut.select("source", _cut(none, F.col("open"), none, F.col("q")), "words"))


def apply_mix(docs: DataFrame, plan: DataFrame, max_copies: int = 2, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (columns of these names are replaced).

    Every row stays; ``copies`` (0 to the cap) says how often the mix takes it
    and ``taken`` is copies x size.
    """
    key, u = free_name(docs, "_mix_source"), free_name(docs, "_mix_u")
    size = n_words(text_of(text_col))
    new = ("size", "source_size", "target", "copies", "taken")
    wide = docs.select(*(c for c in docs.columns if c not in new), F.col(source_col).alias(key), size.alias("size"),
                       uniform(id_col, text_of(text_col), seed).alias(u))
    own = {c: free_name(wide, f"_plan_{c}") for c in PLAN_COLUMNS}
    plan = plan.withColumnRenamed("source", key).withColumnsRenamed(own)
    n_sources = plan.limit(BROADCAST_ROWS + 1).count()
    both = spread_join(wide, plan, key, u, n_sources)
    copies = expected(F.col("size"), F.col(own["rate"]), max_copies)
    extra = F.coalesce(_taken(F.col("size"), _rank(F.col(u), _chance(copies)), F.col(own["cuts"])), F.lit(False))
    return (both.withColumn("source_size", F.col(own["source_size"])).withColumn("target", F.col(own["target"]))
            .withColumn("copies", F.floor(copies).cast("long") + extra.cast("long"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .drop(key, u, *own.values()))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_copies: int = 2,
                seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                **options) -> DataFrame:
    """Mix all documents: targets, the sampling plan, and the copies taken of every row.

    Sources weigh ``weights`` in turn (code point order, null last) and share
    ``share`` of all words; no source is taken more than ``max_copies`` times.
    A null source is a source; a null or empty text has size 0 and takes no
    words. Within a source longer documents are likelier (see the module). Rows repeated under one id and text share one draw and are taken or
    left together. The draw depends on the row and the seed alone, so reruns
    agree. An empty table gives an empty table.
    """
    names = {"id_col": id_col, "text_col": text_col, "source_col": source_col}
    plan = mix_plan(docs, weights, share, max_copies, seed, **names, **options)
    return apply_mix(docs, plan, max_copies, seed, **names)
