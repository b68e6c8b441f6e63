"""Near-duplicate documents: banded MinHash with odd sketches, confirmed on full shingle sets.

1. Features (numpy in Arrow batches): the set of word shingles as 64-bit
   hashes, its digest, ``bands x rows`` MinHash samples, the band keys, and the
   odd sketch: sample i flips the bit that (i, value) hashes to, so two
   sketches differ by XOR in the samples in which the documents differ. With k
   samples, n bits and x bits set in the XOR, the similarity is about
   1 + n / (4 k) ln(1 - 2 x / n).
2. Rows with the same digest share a node, so copies are never paired.
3. Nodes that share a band key are candidates. No bucket is expanded into its
   pairs: in a star round every node is compared with one centre. A bucket's
   centre is the node that shares most buckets with others (in a family of
   copies, the one that the others were made from); a node's centre is the one
   of most of its buckets. Confirmed links make components. Then only pairs of
   one bucket whose nodes are still in different components are left, and of
   these all are compared: every node outside the bucket's largest component
   against the rest. In small buckets the pairs are joined; those of large
   buckets are compared inside tasks, in cells of bounded size, which give back
   at most one link of a node to each component. Cells are cut per bucket (a pair
   meets in the first bucket it shares) or, where that copies less, from all
   buckets of a component; only nodes that share a bucket are compared. While the
   number of pairs is large, further star rounds come first.
4. The odd sketches of a pair decide whether it is confirmed at all: the bound
   lies so far below the threshold that a true link fails with a probability
   below 1e-8. Confirmation intersects the full sets.

Banding itself (50 bands of 6) misses a pair at similarity 0.8 with a
probability of 3e-7, one at 0.9 with less than 1e-16.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwise.llm.common import chained, mix64, release, stored, text_of, text_slices
from bandwise.llm.components import components

BANDS, ROWS, SKETCH_BITS = 50, 6, 1024
#: A candidate pair is confirmed unless its sketches estimate a similarity this far below the threshold.
MARGIN = 0.15
#: Further star rounds come first while more pairs than this per bucket entry are left to compare.
STAR_ROUNDS, PAIRS_PER_ENTRY = 4, 64
#: Buckets up to this size are joined with themselves; of larger ones, cells of so many nodes meet in a task.
SMALL_BUCKET, CELL_NODES, CELL_OTHERS = 16, 256, 1024
#: Values hashed at once: as many fit into a core's cache.
BLOCK = 1 << 15


def shingle_sets(texts: Iterable[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text; an empty array without words."""
    words = [(t or "").encode("utf-8").lower().split() for t in texts]
    flat = [w for doc in words for w in doc]
    if not flat:
        return [np.empty(0, np.uint64)] * len(words)
    hashed = pd.util.hash_array(np.array(flat, dtype=object), categorize=False)
    sets, at = [], 0
    for doc in words:
        h = hashed[at:at + len(doc)]
        at += len(doc)
        n = min(width, len(doc))
        value = np.full(max(0, len(doc) - n + 1) if n else 0, np.uint64(n), np.uint64)
        for i in range(n):
            value = chained(value, h[i:i + len(value)])
        sets.append(np.unique(value))
    return sets


def digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def minhash(sets: list[np.ndarray], samples: int) -> np.ndarray:
    """(samples, len(sets)) smallest values under ``samples`` random multipliers; sets are not empty."""
    factors = np.random.default_rng(20).integers(0, 2 ** 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((samples, len(sets)), np.uint64)
    start = 0
    while start < len(sets):
        stop, n = start, 0
        while stop < len(sets) and (n == 0 or n + len(sets[stop]) <= BLOCK):
            n += len(sets[stop])
            stop += 1
        values = np.concatenate(sets[start:stop])
        first = np.concatenate(([0], np.cumsum([len(s) for s in sets[start:stop]])[:-1]))
        for i, a in enumerate(factors):
            out[i, start:stop] = np.minimum.reduceat(values * a, first)
        start = stop
    return out


def band_keys(samples: np.ndarray, bands: int) -> np.ndarray:
    """(sets, bands) 64-bit keys; the band's number is part of its key."""
    rows = samples.reshape(bands, -1, samples.shape[1])
    key = np.repeat(mix64(np.arange(1, bands + 1, dtype=np.uint64))[:, None], samples.shape[1], axis=1)
    for r in range(rows.shape[1]):
        key = chained(key, rows[:, r])
    return key.T


def odd_sketch(samples: np.ndarray, bits: int) -> np.ndarray:
    """(sets, bits / 64) parity bitmaps of the samples."""
    k, n = samples.shape
    salt = mix64(np.arange(1, k + 1, dtype=np.uint64))[:, None]
    bit = (mix64(samples ^ salt) % np.uint64(bits)).astype(np.int64)
    flips = np.bincount((bit + np.arange(n) * bits).ravel(), minlength=n * bits) & 1
    return np.packbits(flips.astype(np.uint8).reshape(n, bits), axis=1).view(np.uint64)


def max_differing_bits(similarity: float, samples: int, bits: int) -> int:
    """Bits set in the XOR of two odd sketches at an estimated similarity."""
    return math.ceil(bits / 2 * (1 - math.exp(-4 * samples * (1 - similarity) / bits)))


def _long_lists(values: np.ndarray) -> pa.Array:
    width = values.shape[1]
    offsets = np.arange(0, values.size + 1, width, dtype=np.int32) if width else np.zeros(len(values) + 1, np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).view(np.int64).ravel()))


def _features(width: int, bands: int, rows: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            sets = shingle_sets(part.column("text").to_pylist(), width)
            full = np.array([len(s) > 0 for s in sets], bool)
            keys = np.zeros((len(sets), bands), np.uint64)
            sketches = np.zeros((len(sets), bits // 64), np.uint64)
            if full.any():
                samples = minhash([s for s in sets if len(s)], bands * rows)
                keys[full], sketches[full] = band_keys(samples, bands), odd_sketch(samples, bits)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row_key"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([digest(s) for s in sets], pa.binary()), _long_lists(keys), _long_lists(sketches)],
                ["doc_id", "row_key", "n_shingles", "digest", "bands", "sketch"])
    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            sets = shingle_sets(part.column("text").to_pylist(), width)
            same = [digest(s) == d for s, d in zip(sets, part.column("digest").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("nid").filter(pa.array(same)),
                 pa.array([s.view(np.int64) for s, ok in zip(sets, same, strict=True) if ok], pa.list_(pa.int64()))],
                ["nid", "shingles"])
    return run


def _differing(a: str, b: str, words: int) -> Column:
    total = F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0]))
    for i in range(1, words):
        total = total + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return total


class _Links:
    """Candidate pairs of nodes -> links, by sketch and then by the full sets."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, percent: int, width: int, samples: int, bits: int):
        self.docs, self.nodes, self.percent, self.width = docs, nodes, percent, width
        self.words = bits // 64
        self.most = max_differing_bits(percent / 100 - MARGIN, samples, bits)

    def side(self, name: str) -> DataFrame:
        return self.nodes.select(F.col("nid").alias(name), F.col("sketch").alias(f"sketch_{name}"),
                                 F.col("n_shingles").alias(f"n_{name}"))

    def likely(self) -> Column:
        """Sizes allow the threshold, and the odd sketches don't rule it out."""
        sizes = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        return sizes & (_differing("sketch_a", "sketch_b", self.words) <= self.most)

    def full_sets(self, used: DataFrame) -> DataFrame:
        """nid, shingles of the nodes ``used`` (nid)."""
        wanted = self.nodes.select("nid", "digest", "row_key").join(used, "nid", "left_semi")
        sets = (self.docs.join(wanted, "row_key").select("nid", "digest", "text")
                .mapInArrow(_full_sets(self.width), "nid long, shingles array<long>"))
        return stored(sets.dropDuplicates(["nid"]))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Of the likely pairs (a, b), those that reach the threshold on their full sets."""
        sets = self.full_sets(pairs.select(F.col("a").alias("nid")).union(pairs.select(F.col("b").alias("nid"))).distinct())
        left, right = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
        both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("set_a", "set_b")))
        union = F.size("set_a") + F.size("set_b") - F.col("common")
        out = stored(both.filter(100 * F.col("common") >= self.percent * union).select("a", "b"))
        release(sets, pairs)
        return out


def link_cell(nodes: pd.DataFrame, others: pd.DataFrame, percent: int, most: int,
              key: int | None = None) -> list[tuple[int, int]]:
    """Links of each of ``nodes`` to ``others`` of other components, at most one to each component.

    Only nodes that share a bucket are compared; with ``key``, only in the
    first bucket they share. Columns: nid, root, bands, sketch, shingles (the
    last three 64-bit arrays; shingles sorted as unsigned numbers).
    """
    sketches = np.stack(others["sketch"].to_numpy()).view(np.uint64)
    bands = np.stack(others["bands"].to_numpy())
    sizes = others["shingles"].map(len).to_numpy()
    roots, ids = others["root"].to_numpy(), others["nid"].to_numpy()
    sets = [np.asarray(s).view(np.uint64) for s in others["shingles"]]
    out = []
    for nid, root, mine, sketch, own in nodes[["nid", "root", "bands", "sketch", "shingles"]].itertuples(index=False):
        own, mine = np.asarray(own).view(np.uint64), np.asarray(mine)
        differing = np.bitwise_count(sketches ^ np.asarray(sketch).view(np.uint64)).sum(axis=1)
        least, largest = np.minimum(sizes, len(own)), np.maximum(sizes, len(own))
        likely = np.flatnonzero((roots != root) & (100 * least >= percent * largest) & (differing <= most))
        shared = bands[likely] == mine
        meet = shared.any(axis=1)
        if key is not None:
            meet &= mine[shared.argmax(axis=1)] == key
        likely = likely[meet]
        if not len(likely):
            continue
        values = np.concatenate([sets[i] for i in likely])
        at = np.minimum(np.searchsorted(own, values), len(own) - 1)
        first = np.cumsum([0, *(len(sets[i]) for i in likely)])[:-1]
        common = np.add.reduceat((own[at] == values).astype(np.int64), first)
        linked = likely[100 * common >= percent * (len(own) + sizes[likely] - common)]
        out += [(nid, int(ids[i])) for i in linked[np.unique(roots[linked], return_index=True)[1]]]
    return out


def _cells(percent: int, most: int):
    def run(cell: tuple, nodes: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        _, by_bucket, key, _, _ = cell
        links = (link_cell(nodes, others, percent, most, int(key) if by_bucket else None)
                 if len(nodes) and len(others) else [])
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")
    return run


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """128 bits of a row's id and text (null: empty)."""
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_of(text_col))
    return F.unhex(F.md5(key.cast("binary")))


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text",
                    bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS,
                    star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept, row_key, component.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    sets of ``width``-word shingles (A-Z lower-cased, split at ASCII white
    space). ``component_id`` is the smallest id reachable by links. A text with
    fewer words is one shingle; one without words, null or empty, has none and
    is linked with nothing: its component is its own id. ``kept`` is true where
    the row's id is its component's id (both null counts as equal: ids are null
    throughout). Rows repeated under one id are separate rows with the same
    answer if their texts are alike. ``component`` is a number of the component
    (null without words). An empty table gives an empty table. Texts are looked
    up by ``row_key``, so repeated or null ids make no hot key; rows without
    words take no part in the last join, and the many rows of one text are its
    probing side, which Spark splits. Of the tables written on the way only the
    result's stays.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"),
                       text_of(text_col).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    feats = stored(docs.mapInArrow(
        _features(width, bands, rows, bits),
        f"doc_id {id_type}, row_key binary, n_shingles long, digest binary, bands array<long>, sketch array<long>"))
    nodes = stored(
        feats.filter("digest is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("first_doc"), F.any_value(F.struct("row_key", "n_shingles", "bands", "sketch")).alias("f"))
        .select(F.monotonically_increasing_id().alias("nid"), "digest", "first_doc", "f.*"))
    links = _Links(docs, nodes, percent, width, bands * rows, bits)
    roots = _link_components(nodes, links, star_rounds)

    comp = nodes.join(roots.withColumnRenamed("node", "nid"), "nid", "left").select(
        "digest", "first_doc", F.coalesce("root", "nid").alias("root"))
    least = stored(comp.groupBy("root").agg(F.min("first_doc").alias("component_id")))
    by_digest = stored(comp.select("digest", "root").join(least, "root"))
    release(nodes, roots, least)
    rows_of = feats.select("doc_id", "row_key", "n_shingles", "digest")
    none = rows_of.filter("digest is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "row_key", F.lit(None).cast("long").alias("component"))
    some = rows_of.filter("digest is not null").join(by_digest, "digest").select(
        "doc_id", "n_shingles", "component_id", "row_key", F.col("root").alias("component"))
    out = stored(some.union(none))
    release(feats, by_digest)
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "row_key", "component")


def drop_near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id",
                         text_col: str = "text", **options) -> DataFrame:
    """All columns of the rows of ``docs`` that stay: one document of each component, the one with the smallest id.

    Documents without words all stay. Rows equal in id and text count as one
    document, of which one row stays: the one whose other columns have the
    smallest hash, the same in every run. The texts move once.
    """
    verdicts = near_duplicates(docs, percent, width, id_col, text_col, **options).filter("kept")
    chosen = (verdicts.filter("component is not null").groupBy("component").agg(F.min("row_key").alias("key")).select("key")
              .union(verdicts.filter("component is null").select("row_key")).distinct())
    key = row_key(id_col, text_col).alias("key")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    order = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    once = (docs.select(key, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), order.alias("order"))
            .groupBy("key").agg(F.min_by("row", "order").alias("row")))
    return once.join(chosen, "key", "left_semi").select("row.*")


def _link_components(nodes: DataFrame, links: _Links, star_rounds: int) -> DataFrame:
    """(node, root) of every node that has a link."""
    entries = nodes.select("nid", F.explode("bands").alias("key"))
    shared = stored(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    popular = F.sum("n").over(Window.partitionBy("nid"))
    members = stored(entries.join(shared, "key").select("key", "nid", popular.alias("popular")))

    def star(centred: DataFrame) -> DataFrame:
        """Links of each node to the centre (nid, center) it shares most buckets with."""
        nearest = (centred.filter("nid <> center").groupBy("nid", "center").agg(F.count(F.lit(1)).alias("n"))
                   .groupBy(F.col("nid").alias("a"))
                   .agg(F.max(F.struct("n", "center"))["center"].alias("b")))
        likely = nearest.join(links.side("a"), "a").join(links.side("b"), "b").filter(links.likely())
        return links.confirmed(stored(likely.select("a", "b")))

    centers = members.groupBy("key").agg(F.max(F.struct("popular", "nid"))["nid"].alias("center"))
    found = star(members.join(centers, "key"))
    roots = components(found)
    for step in range(1, star_rounds + 1):
        labelled = (members.join(roots.withColumnRenamed("node", "nid"), "nid", "left")
                    .select("key", "nid", F.coalesce("root", "nid").alias("root")))
        parts = labelled.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.max(
            F.struct(F.xxhash64("nid", F.lit(step)), "nid"))["nid"].alias("center"))
        mixed = (parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"),
                                          F.max(F.struct("n", "root", "center")).alias("main"))
                 .filter("parts > 1").select("key", "n", F.col("main.n").alias("main_n"), F.col("main.root").alias("main"),
                                             F.col("main.center").alias("center")))
        mixed = stored(mixed)
        n, pairs = mixed.agg(F.coalesce(F.sum("n"), F.lit(0)),
                             F.coalesce(F.sum(F.col("n") * (F.col("n") - F.col("main_n"))), F.lit(0))).first()
        if not n:
            release(shared, members, mixed)
            return roots
        open_ = stored(labelled.join(mixed.select("key", "main", "center", "n"), "key"))
        if pairs <= PAIRS_PER_ENTRY * n or step == star_rounds:
            break
        wider = stored(found.union(star(open_.filter("root <> main"))))
        release(found, roots, mixed, open_)
        found = wider
        roots = components(found)

    # All pairs of a bucket across components: each node outside the largest against the others.
    small = open_.filter(F.col("n") <= SMALL_BUCKET)
    b = small.select("key", F.col("nid").alias("b"), F.col("root").alias("root_b")).join(links.side("b"), "b")
    a = (small.filter("root <> main").select("key", F.col("nid").alias("a"), F.col("root").alias("root_a"), "main")
         .join(links.side("a"), "a"))
    across = (F.col("root_a") != F.col("root_b")) & ((F.col("root_b") == F.col("main")) | (F.col("a") < F.col("b")))
    more = links.confirmed(stored(a.join(b, "key").filter(across & links.likely()).select("a", "b").distinct()))
    large = open_.filter(F.col("n") > SMALL_BUCKET)
    if not large.isEmpty():
        more = stored(more.union(_links_in_cells(large, nodes, links)))
    release(shared, members, mixed, open_)
    if more.isEmpty():
        return roots
    release(roots)
    return components(found.union(more))


def _links_in_cells(open_: DataFrame, nodes: DataFrame, links: _Links) -> DataFrame:
    """Links across components of nodes that share a bucket (``open_``: key, nid, root, main of the bucket).

    In each bucket the nodes outside its largest component, ``main``, meet all
    its nodes. Either every bucket of a ``main`` has cells of its own, or all its
    buckets have common ones: whichever ships fewer copies of sets.
    """
    cells = [F.ceil(F.col("n") / CELL_NODES).alias("rows"), F.ceil(F.col("m") / CELL_OTHERS).alias("columns")]

    def sized(*by: str) -> DataFrame:
        """Per group: rows and columns of cells, and the copies of sets they ship."""
        return (open_.select("main", *by, "nid", "root").distinct().groupBy("main", *by)
                .agg(F.count_if(F.col("root") != F.col("main")).alias("n"), F.count(F.lit(1)).alias("m"))
                .select("main", *by, *cells, (F.col("n") * cells[1] + F.col("m") * cells[0]).alias("copies")))

    buckets = stored(sized("key"))
    whole = sized().join(buckets.groupBy("main").agg(F.sum("copies").alias("apart")), "main").select(
        "main", (F.col("apart") < F.col("copies")).alias("by_bucket"), F.struct("rows", "columns").alias("whole"))
    own = F.struct("rows", "columns")
    dealt_in = (buckets.join(whole, "main").withColumn("cut", F.when(F.col("by_bucket"), own).otherwise(F.col("whole")))
                .select("key", "main", "by_bucket", F.when(F.col("by_bucket"), F.col("key")).otherwise(F.lit(0)).alias("bucket"),
                        "cut.rows", "cut.columns"))
    # By bucket, not by component: a component may hold most nodes.
    members = stored(open_.select("key", "nid", "root").join(dealt_in, "key").drop("key").distinct())
    group = ["main", "by_bucket", "bucket"]
    sets = links.full_sets(members.select("nid").distinct())
    carried = sets.join(nodes.select("nid", "bands", "sketch"), "nid")
    full = stored(members.join(carried, "nid"))

    def dealt(df: DataFrame, own: str, n: str, other: str, m: str) -> DataFrame:
        return df.select(*group, "nid", "root", "bands", "sketch", "shingles", F.pmod(F.xxhash64("nid"), F.col(n)).alias(own),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col(m) - 1)).alias(other)).groupBy(*group, "row", "column")

    left = dealt(full.filter("root <> main"), "row", "rows", "column", "columns")
    right = dealt(full, "column", "columns", "row", "rows")
    out = stored(left.cogroup(right).applyInPandas(_cells(links.percent, links.most), "a long, b long"))
    release(buckets, members, sets, full)
    return out
