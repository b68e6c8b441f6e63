"""Exact ranks and linear-interpolation quantiles without a single-task buffer.

Spark's exact ``percentile`` aggregate keeps a value->count map that is merged
in ONE task for a global aggregate, so its memory grows with the number of
distinct values. Two operators spread the work out instead:

``selected_ranks`` finds a few order statistics (quantiles) by radix selection
over the ordered 64-bit images of the values: at most four counting passes,
whatever the distribution. What is shuffled is counts per task and digit.

``value_ranks`` ranks every distinct value (rank correlation, tree bins):

1. Bucket boundaries per column from quantile sketches that are merged in two
   levels, so no task receives the sketches of all others. Boundaries need
   little accuracy: they only balance the buckets.
2. ``groupBy(var, bucket, value)`` collapses duplicates map-side (a hot value
   becomes one row per map task, then one row).
3. Bucket totals (at most columns x B rows, broadcast) give each bucket's
   offset; a window partitioned by (var, bucket) and ordered by value gives the
   running count inside the bucket. ``cum_lo`` = rows strictly below the value,
   ``cum_hi`` = ``cum_lo + cnt``.

Quantile positions (``(N-1)*p``, the numpy / DuckDB ``quantile_cont`` rule) are
found with a per-row filter of a literal position array; only the matching
rows (at most 2 per probability and column) reach the driver, which
interpolates. NaN counts as missing, like null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _default_buckets(df: DataFrame) -> int:
    """4 buckets per shuffle partition, between 64 and 10,000.

    10,000 buckets leave ~10^7 distinct values per window partition at 10^11
    distinct values; ``buckets`` of ``value_ranks`` overrides it."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return int(min(10_000, max(64, 4 * parts)))


@dataclass
class Ranked:
    """Distinct values with cumulative positions, plus per-column totals.

    ``df`` columns: ``var, value, cnt, cum_lo, cum_hi`` and, for each summed
    column ``k``: ``k`` (sum at the value) and ``cum_k`` (running sum up to and
    including the value). ``n[var]`` is the non-null count of each column and
    ``totals[k][var]`` the total of summed column ``k``.
    """
    df: DataFrame
    n: dict[str, int]
    totals: dict[str, dict[str, float]] = field(default_factory=dict)
    extras: dict[str, object] = field(default_factory=dict)
    #: The rows of ``df`` where the driver holds them anyway.
    rows: list[dict] | None = None


def value_ranks(df: DataFrame, cols: list[str], buckets: int | None = None,
                round_digits: int | None = None, sums: dict[str, Column] | None = None,
                extras: dict[str, Column] | None = None) -> Ranked:
    """Distinct (var, value) rows with counts and cumulative positions (nulls ignored).

    ``extras`` are further aggregate expressions over ``df`` evaluated in the
    same first pass (e.g. min/max of the raw column); results land in
    ``Ranked.extras``.
    """
    extras = extras or {}
    buckets = buckets or _default_buckets(df)
    sums = sums or {}
    wide, vcols = _with_values(df, cols, sums, round_digits)
    head, n, totals = _totals(wide, cols, vcols, sums, extras)
    bounds = _bounds(wide, vcols, buckets, [i for i, c in enumerate(cols) if n[c]])
    splits = []
    for i in range(len(cols)):
        b = sorted({x for x in bounds.get(i, []) if x is not None and math.isfinite(x)})
        # Bucketizer needs at least one inner split (all-null or empty columns have none).
        splits.append([-math.inf] + (b or [0.0]) + [math.inf])
    bcols = [f"__b{i}" for i in range(len(cols))]
    bucketed = Bucketizer(splitsArray=splits, inputCols=vcols, outputCols=bcols,
                          handleInvalid="keep").transform(wide)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("var"), F.col(v).alias("value"), F.col(b).cast("int").alias("bucket"))
        for c, v, b in zip(cols, vcols, bcols)
    ])).alias("s")
    scols = [f"__s_{k}" for k in sums]
    # Both filters explicit: the bucket join would otherwise add one on one side only,
    # and the two uses of ``counts`` could no longer share one shuffle.
    long = (bucketed.select(stack, *scols).select("s.*", *scols)
            .where(F.col("value").isNotNull() & F.col("bucket").isNotNull()))
    counts = long.groupBy("var", "bucket", "value").agg(
        F.count(F.lit(1)).alias("cnt"), *[F.sum(f"__s_{k}").alias(k) for k in sums])
    per_bucket = counts.groupBy("var", "bucket").agg(
        F.sum("cnt").alias("bucket_cnt"), *[F.sum(k).alias(f"__bs_{k}") for k in sums])
    run = Window.partitionBy("var").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    offsets = per_bucket.select(
        "var", "bucket",
        (F.sum("bucket_cnt").over(run) - F.col("bucket_cnt")).alias("offset"),
        *[(F.sum(f"__bs_{k}").over(run) - F.col(f"__bs_{k}")).alias(f"__off_{k}") for k in sums],
    )
    # offsets has at most len(cols) * buckets rows: a proven bound, safe to broadcast.
    w = Window.partitionBy("var", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(F.broadcast(offsets), ["var", "bucket"])
    ranked = ranked.withColumn("cum_hi", F.col("offset") + F.sum("cnt").over(w))
    for k in sums:
        ranked = ranked.withColumn(f"cum_{k}", F.col(f"__off_{k}") + F.sum(k).over(w))
    ranked = ranked.withColumn("cum_lo", F.col("cum_hi") - F.col("cnt"))
    keep = ["var", "value", "cnt", "cum_lo", "cum_hi"]
    for k in sums:
        keep += [k, f"cum_{k}"]
    return Ranked(ranked.select(*keep), n, totals, {k: head[f"x_{k}"] for k in extras})


def _bounds(wide: DataFrame, vcols: list[str], buckets: int, some: list[int]) -> dict[int, list[float]]:
    """Bucket boundaries of the columns ``some`` (with values), repeated where a value fills several buckets.

    Two levels: sketches of the same residue meet first, then at most SKETCH_GROUPS of them.
    """
    if not some:
        return {}
    size = min(65_535, max(200, 4 * buckets))
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    near = (wide.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("__g"))
            .agg(*[F.kll_sketch_agg_double(vcols[i], F.lit(size)).alias(f"q{i}") for i in some]))
    merged = near.agg(F.count(F.lit(1)).alias("parts"), *[F.kll_merge_agg_double(f"q{i}", F.lit(size)).alias(f"q{i}") for i in some])
    row = merged.where("parts > 0").select(*[F.kll_sketch_get_quantile_double(f"q{i}", probs).alias(f"q{i}") for i in some]).first()
    return {i: list(row[f"q{i}"]) if row else [] for i in some}


def attach_ranks(df: DataFrame, ranks: dict[str, str], weight: str | None = None, buckets: int | None = None) -> DataFrame:
    """``df`` with the average-tie ranks of columns, ``ranks``: column -> name of its rank; rows lacking a value are left out.

    A row counts ``weight`` times. For each column the rows move once, to the
    bucket of their value, and are numbered there from the buckets' counts;
    nothing is joined on a value. A value that fills several buckets is dealt
    over them by a hash of the whole row: its rank follows from the counts
    alone. The tables of buckets (at most ``buckets`` rows) are broadcast.
    ``df`` is read for the bounds, the counts and the ranks: hand in a stored table.
    """
    cols = list(ranks)
    buckets = buckets or _default_buckets(df)
    w = F.col(f"`{weight}`") if weight else F.lit(1)
    wide, vcols = _with_values(df, cols, {}, None)
    for v in vcols:
        wide = wide.where(F.col(v).isNotNull())
    found = _bounds(wide, vcols, buckets, list(range(len(cols))))
    bounds = [sorted(b for b in found[i] or [] if b is not None and math.isfinite(b)) for i in range(len(cols))]
    placed = Bucketizer(splitsArray=[[-math.inf, *(sorted(set(b)) or [0.0]), math.inf] for b in bounds], inputCols=vcols,
                        outputCols=[f"__g{i}" for i in range(len(cols))], handleInvalid="keep").transform(wide)
    salt = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    for i, own_bounds in enumerate(bounds):
        distinct = sorted(set(own_bounds)) or [math.nan]
        copies = [1, *(max(1, own_bounds.count(b)) for b in distinct)]
        # Group g holds the values from bound g - 1 on; a repeated bound itself has that many buckets, the last shared with the group.
        at = F.col(f"__g{i}").cast("int") + 1
        last, many, edge = (F.element_at(F.array(*[F.lit(v) for v in values]), at)
                            for values in ((np.cumsum(copies) - 1).tolist(), copies, [math.nan, *distinct]))
        placed = placed.withColumn(f"__h{i}", F.when((many > 1) & (F.col(vcols[i]) == edge), at)).withColumn(
            f"__b{i}", F.when(F.col(f"__h{i}").isNotNull(), last - F.pmod(salt, many).cast("int")).otherwise(last).cast("int"))
    ranked = placed
    for i, (v, out) in enumerate(zip(vcols, ranks.values(), strict=True)):
        hot, bucket = F.col(f"__h{i}"), f"__b{i}"
        counts = placed.groupBy(bucket).agg(F.sum(w).alias("all"), F.coalesce(F.sum(F.when(hot.isNotNull(), w)), F.lit(0)).alias("hot"),
                                            F.max(hot).alias("g"))
        ahead = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
        table = counts.withColumn("__offset", F.coalesce(F.sum("all").over(ahead), F.lit(0)))
        same = Window.partitionBy("g")
        table = table.select(bucket, "__offset", F.min("__offset").over(same).alias("__hot_below"), F.sum("hot").over(same).alias("__hot_ties"))
        inside = Window.partitionBy(bucket).orderBy(v)
        ties = F.sum(w).over(inside.rangeBetween(Window.currentRow, Window.currentRow))
        upto = F.sum(w).over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        joined = ranked.withColumn("__ties", ties).withColumn("__upto", upto).join(F.broadcast(table), bucket)
        below = F.when(hot.isNotNull(), F.col("__hot_below")).otherwise(F.col("__offset") + F.col("__upto") - F.col("__ties"))
        equal = F.when(hot.isNotNull(), F.col("__hot_ties")).otherwise(F.col("__ties"))
        ranked = joined.withColumn(out, below + (equal + 1) / 2.0).drop("__ties", "__upto", "__offset", "__hot_below", "__hot_ties")
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], *ranks.values())


def _with_values(df: DataFrame, cols: list[str], sums: dict[str, Column], round_digits: int | None = None):
    """``df`` with the columns as doubles (NaN to null) ``__v<i>`` and the summed columns ``__s_<k>``."""
    def value(c):
        x = F.col(f"`{c}`").cast("double")
        x = F.when(~F.isnan(x), x)
        return x if round_digits is None else F.round(x, round_digits)
    vcols = [f"__v{i}" for i in range(len(cols))]
    wide = df.select("*", *[value(c).alias(v) for c, v in zip(cols, vcols)],
                     *[col.cast("double").alias(f"__s_{k}") for k, col in sums.items()])
    return wide, vcols


def _totals(wide: DataFrame, cols, vcols, sums, extras):
    """One aggregation: non-null counts, totals of the summed columns, extra expressions."""
    aggs = [F.count(v).alias(f"n{i}") for i, v in enumerate(vcols)]
    aggs += [F.sum(F.when(F.col(v).isNotNull(), F.col(f"__s_{k}"))).alias(f"t{i}_{k}")
             for i, v in enumerate(vcols) for k in sums]
    head = wide.agg(*aggs, *[e.alias(f"x_{k}") for k, e in extras.items()]).first()
    n = {c: int(head[f"n{i}"]) for i, c in enumerate(cols)}
    return head, n, {k: {c: float(head[f"t{i}_{k}"] or 0.0) for i, c in enumerate(cols)} for k in sums}


#: Sketches that meet in the last merge.
SKETCH_GROUPS = 64
#: Bits of a value's image that one counting pass looks at; rows up to which a cell is counted value by value.
DIGIT_BITS, RANKED_ROWS = 16, 200_000
#: (cell, digit) entries that a task gathers before it hands them on.
HELD_ENTRIES = 1 << 17


def ordered_image(x: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles (-0.0 as 0.0)."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def image_value(image: int) -> float:
    bits = np.array([image], np.int64)
    return float(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits).view(np.float64)[0])


def unsigned_image(image: np.ndarray) -> np.ndarray:
    return image.view(np.uint64) ^ np.uint64(1 << 63)


@dataclass
class _Cell:
    """Values of one column whose images begin alike: rows and sums before them, wanted positions among them."""
    column: int
    prefix: int
    before: int
    rows: int
    sums_before: list[float]
    wanted: list[int]


def merged_entries(parts: list[tuple]) -> tuple:
    """(cell, part, rows, low, high, *sums) with one entry per (cell, part)."""
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
    order = np.lexsort((columns[1], columns[0]))
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return tuple(columns)
    folds = [np.add, np.minimum, np.maximum, *[np.add] * (len(columns) - 5)]
    return (columns[0][first], columns[1][first], *(f.reduceat(c, first) for f, c in zip(folds, columns[2:], strict=True)))


def _counting(n_columns: int, n_sums: int, cells: list[_Cell] | None, shift: int, depth: int):
    """Task side of a pass: rows and sums by (cell, part); a part is the next digit, with ``shift`` -1 the whole value.

    ``depth``: bits of the images behind the cells' prefixes.
    """
    by_column: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for c in range(n_columns):
        own = sorted((x.prefix, i) for i, x in enumerate(cells or []) if x.column == c)
        by_column[c] = np.array([p for p, _ in own], np.uint64), np.array([i for _, i in own], np.int64)
    names = ["cell", "part", "rows", "low", "high", *(f"s{k}" for k in range(n_sums))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            sums = [pc.fill_null(batch.column(n_columns + k), 0.0).to_numpy(zero_copy_only=False) for k in range(n_sums)]
            for c in range(n_columns):
                x = pc.fill_null(batch.column(c), math.nan).to_numpy(zero_copy_only=False)
                at = np.flatnonzero(~np.isnan(x))
                image = ordered_image(x[at])
                if cells is None:
                    cell = np.full(len(at), c, np.int64)
                else:
                    prefixes, numbers = by_column[c]
                    if not len(prefixes):
                        continue
                    own = unsigned_image(image) >> np.uint64(depth)
                    place = np.minimum(np.searchsorted(prefixes, own), len(prefixes) - 1)
                    hit = prefixes[place] == own
                    at, image, cell = at[hit], image[hit], numbers[place[hit]]
                if shift >= 0:
                    part = ((unsigned_image(image) >> np.uint64(shift)) & np.uint64((1 << DIGIT_BITS) - 1)).astype(np.int64)
                else:
                    part = image
                held.append(merged_entries([(cell, part, np.ones(len(at), np.int64), image, image, *(w[at] for w in sums))]))
                size += len(held[-1][0])
            if size > HELD_ENTRIES:
                held = [merged_entries(held)]
                size = len(held[0][0])
                if size > HELD_ENTRIES // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in held[0]], names)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in merged_entries(held)], names)
    return run


def selected_ranks(df: DataFrame, cols: list[str], probs: list[float], sums: dict[str, Column] | None = None,
                   extras: dict[str, Column] | None = None, ranked_rows: int = RANKED_ROWS) -> Ranked:
    """Like ``value_ranks``, but the table holds only the values at the positions of ``probs``.

    Radix selection over the ordered 64-bit image of the doubles: a pass counts
    rows and sums by the next 16 bits of the images that share their first bits
    with a wanted position. Running counts and the choice of the digits hit are
    made in Spark, so the driver receives no more rows than there are wanted
    positions. Four passes read all 64 bits, whatever the distribution; once
    the cells that are left have at most ``ranked_rows`` rows, one pass counts
    them value by value instead.
    """
    sums, extras = sums or {}, extras or {}
    wide, vcols = _with_values(df, cols, sums)
    scols = [f"__s_{k}" for k in sums]
    head = wide.agg(*[e.alias(f"x_{k}") for k, e in extras.items()]).first() if extras else {}
    source = wide.select(*vcols, *scols)
    schema = "cell long, part long, rows long, low long, high long" + "".join(f", s{k} double" for k in range(len(scols)))
    n, totals = dict.fromkeys(cols, 0), {k: dict.fromkeys(cols, 0.0) for k in sums}
    found, cells, shift = [], None, 64
    while cols and (cells is None or cells):
        by_value = cells is not None and all(c.rows <= ranked_rows for c in cells)
        last, shift = shift, -1 if by_value else shift - DIGIT_BITS
        counts = (source.mapInArrow(_counting(len(vcols), len(scols), cells, shift, last), schema).groupBy("cell", "part")
                  .agg(*[F.sum(c).alias(c) for c in ("rows", *(f"s{k}" for k in range(len(scols))))],
                       F.min("low").alias("low"), F.max("high").alias("high")))
        hit = _hit(counts, cells, probs, len(scols)).collect()
        left = []
        for r in hit:
            column = r["cell"] if cells is None else cells[r["cell"]].column
            start = 0 if cells is None else cells[r["cell"]].before
            sums_start = [0.0] * len(scols) if cells is None else cells[r["cell"]].sums_before
            if cells is None:
                n[cols[column]] = r["all_rows"]
                for k, name in enumerate(sums):
                    totals[name][cols[column]] = float(r[f"all{k}"] or 0.0)
            before = start + r["before"]
            sums_before = [a + (r[f"b{k}"] or 0.0) for k, a in enumerate(sums_start)]
            if r["low"] == r["high"]:
                own = [x for k in range(len(scols)) for x in (float(r[f"s{k}"] or 0.0), sums_before[k] + float(r[f"s{k}"] or 0.0))]
                found.append((cols[column], image_value(r["low"]), r["rows"], before, before + r["rows"], *own))
            else:
                prefix = int(unsigned_image(np.array([r["low"]], np.int64))[0]) >> shift
                left.append(_Cell(column, prefix, before, r["rows"], sums_before, [start + q for q in r["wanted"]]))
        cells = left
    names = "var string, value double, cnt long, cum_lo long, cum_hi long" + "".join(f", `{k}` double, `cum_{k}` double" for k in sums)
    table = df.sparkSession.createDataFrame(found, names)
    keep = ["var", "value", "cnt", "cum_lo", "cum_hi", *[x for k in sums for x in (k, f"cum_{k}")]]
    rows = [dict(zip(table.columns, r, strict=True)) for r in found]
    return Ranked(table.select(*keep), n, totals, {k: head[f"x_{k}"] for k in extras}, rows)


def _hit(counts: DataFrame, cells: list[_Cell] | None, probs: list[float], n_sums: int) -> DataFrame:
    """Of the counted parts, those that hold a wanted position: rows before them in their cell, and these positions."""
    # A cell has 2^16 parts at most, or ranked_rows.
    ahead = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("cell")
    sums = [c for k in range(n_sums) for c in (F.sum(f"s{k}").over(ahead).alias(f"b{k}"), F.sum(f"s{k}").over(whole).alias(f"all{k}"))]
    running = counts.select("*", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("before"),
                            F.sum("rows").over(whole).alias("all_rows"), *sums)
    if cells is None:
        places = []
        for p in probs:
            low = F.floor((F.col("all_rows") - 1).cast("double") * F.lit(float(p))).cast("long")
            places += [low, F.least(low + 1, F.col("all_rows") - 1)]
        wanted = F.array(*places) if places else F.array().cast("array<long>")
    else:
        wanted = F.element_at(F.array(*[F.array(*[F.lit(q - c.before).cast("long") for q in c.wanted]) for c in cells]),
                              (F.col("cell") + 1).cast("int"))
    inside = F.array_distinct(F.filter(wanted, lambda q: (q >= F.col("before")) & (q < F.col("before") + F.col("rows"))))
    return running.withColumn("wanted", inside).where(F.size("wanted") > 0)


def _positions(n: int, probs: list[float]):
    plan = []
    for i, p in enumerate(probs):
        h = (n - 1) * float(p)
        lo = int(math.floor(h))
        hi = min(lo + 1, n - 1)
        plan.append((i, float(p), lo, hi, h - lo))
    return plan


def order_statistics(r: Ranked, positions: dict[str, list[int]]) -> dict[tuple[str, int], dict]:
    """Rows of the ranked table at 0-based sorted positions: (var, pos) -> row dict
    (value, cnt, cum_lo, cum_hi and the cumulative sums). One job; at most
    ``len(positions[var])`` rows per column reach the driver."""
    pos = {v: sorted(set(p)) for v, p in positions.items() if p}
    if not pos:
        return {}
    if r.rows is not None:
        return {(row["var"], q): row for row in r.rows for q in pos.get(row["var"], []) if row["cum_lo"] <= q < row["cum_hi"]}
    pos_map = F.create_map(*[x for var, ps in pos.items() for x in (
        F.lit(var), F.array(*[F.lit(p).cast("long") for p in ps]))])
    hits = (r.df.select("*", F.explode(F.filter(
        pos_map[F.col("var")], lambda p: (p >= F.col("cum_lo")) & (p < F.col("cum_hi")))).alias("__pos"))
        .collect())
    return {(h["var"], h["__pos"]): h.asDict() for h in hits}


def quantiles_from_ranks(r: Ranked, probs: list[float], round_digits: int | None = None) -> DataFrame:
    """Quantiles of every column of ``r``: (var, prob_index, prob, value).

    ``round_digits`` gives the quantiles of ``round(x, digits)`` without
    rounding every row: rounding is monotone, so the order statistics of the
    rounded column are the rounded order statistics; only the looked-up
    values are rounded before interpolation."""
    spark = r.df.sparkSession
    rows = [(var, i, p, v) for var, i, p, v, _ in interpolate(r, probs, round_digits)]
    return spark.createDataFrame(rows, "var string, prob_index int, prob double, value double")


def interpolate(r: Ranked, probs: list[float], round_digits: int | None = None):
    """[(var, prob_index, prob, value, (row_lo, row_hi))] - quantiles plus the
    order-statistic rows they were interpolated from."""
    plans = {var: _positions(n, probs) for var, n in r.n.items() if n > 0}
    stats = order_statistics(r, {var: [q[2] for q in plan] + [q[3] for q in plan] for var, plan in plans.items()})

    def val(row):
        return round(row["value"], round_digits) if round_digits is not None else row["value"]
    out = []
    for var, plan in plans.items():
        for i, p, lo, hi, frac in plan:
            a, b = stats[(var, lo)], stats[(var, hi)]
            v_lo, v_hi = val(a), val(b)
            out.append((var, i, p, v_lo + (v_hi - v_lo) * frac, (a, b)))
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    round_digits: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles (numpy default, DuckDB ``quantile_cont``).

    Returns a small local DataFrame
    ``var string, prob_index int, prob double, value double``.
    """
    return quantiles_from_ranks(selected_ranks(df, cols, probs), probs, round_digits=round_digits)


def average_ranks(r: Ranked) -> DataFrame:
    """Average-tie rank (scipy ``rankdata`` 'average'): rows below + (ties + 1) / 2."""
    return r.df.withColumn("avg_rank", F.col("cum_lo") + (F.col("cnt") + 1) / 2.0)
