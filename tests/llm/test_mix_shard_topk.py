"""Sharding, mixing and exact search against plain versions, and their odd inputs."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from bandwise.llm import mixing, topk
from bandwise.llm.common import spread_join
from bandwise.llm.mixing import mix_sources
from bandwise.llm.queries import op10_pareto_mix
from bandwise.llm.sharding import shard_documents
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS, doc, odd_rows


def test_shards(spark, odd):
    rows = shard_documents(odd, [1.0] * 8, rows_per_cell=1).collect()
    assert len(rows) == len(odd_rows())
    by_shard, key = defaultdict(list), {}
    for r in rows:
        by_shard[r.shard].append(r.slot)
        assert key.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.grown_shard in (r.shard, 8) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    want = sorted((repr(d[0]), len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in odd_rows())
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in rows) == want


def test_shards_follow_weights(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    got = {r.shard: r["count"] for r in shard_documents(docs, [1.0, 2.0, 1.0]).groupBy("shard").count().collect()}
    assert abs(got[1] / 20_000 - 0.5) < 0.02 and abs(got[0] / 20_000 - 0.25) < 0.02
    moved = shard_documents(docs, [1.0] * 8).filter("shard <> grown_shard").count()
    assert abs(moved / 20_000 - 1 / 9) < 0.01
    with pytest.raises(ValueError):
        shard_documents(docs, [1.0, 0.0])


def test_shards_of_nothing(nothing):
    assert shard_documents(nothing, [1.0] * 8).count() == 0


def plain_targets(sizes, weights, share, most):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= most * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        out |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return out


@pytest.mark.parametrize("cells", [2, 20_000])
def test_mix(spark, cells):
    rows = [doc(i, "w " * (i % 37 + (900 if i % 211 == 0 else 1)), source=None if i % 5 == 4 else "abcd"[i % 4]) for i in range(3000)]
    rows += [doc(9000 + i, "one word of few", source="small") for i in range(4)] + [doc(9100, None, source="empty")]
    df = spark.createDataFrame(rows, DOCS)
    got = mix_sources(df, rows_per_cell=cells).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        size = len((r.text or "").split())
        assert r.size == size and r.taken == r.copies * size <= 2 * size
        sizes[r.source] += size
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = plain_targets(sizes, (3, 1, 2), 1.5, 2)
    for s, t in target.items():
        assert math.isclose(t, want[s], rel_tol=1e-9, abs_tol=1e-6)
        assert abs(taken[s] - t) <= max(5, 0.01 * t), (s, taken[s], t)
    again = mix_sources(df.repartition(7), rows_per_cell=77).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)


def test_inclusion_follows_the_documents_own_odds(spark):
    """Over seeds each document is taken as often as its expected copies say, and these differ within a source."""
    rows = [doc(i, "w " * (3 + i % 5 * 40), source="a" if i % 3 else "b") for i in range(600)]
    df = spark.createDataFrame(rows, DOCS).cache()
    plan = mixing.mix_plan(df, (1.0, 1.0), 1.2, 2)
    rate = {r["source"]: r["rate"] for r in plan.collect()}
    seeds, taken = 30, defaultdict(int)
    for seed in range(seeds):
        for r in mix_sources(df, (1.0, 1.0), 1.2, 2, seed=seed, passes=1).collect():
            taken[r.source, r.size] += r.copies
    n = defaultdict(int)
    for r in rows:
        n[r[3], len(r[1].split())] += seeds
    want = {(s, size): min(2.0, rate[s] * math.floor(math.sqrt(size) * 1000)) for s, size in n}
    assert len({round(w, 6) for (s, _), w in want.items() if s == "a"}) == 5
    assert sum(want[k] * k[1] * n[k] for k in n) / seeds == pytest.approx(sum(r["target"] for r in plan.collect()))
    for k, w in want.items():
        p = w - math.floor(w)
        assert abs(taken[k] / n[k] - w) < 0.02 + 4 * math.sqrt(p * (1 - p) / n[k]), (k, taken[k] / n[k], w)


def test_mix_keeps_columns_of_any_name(spark):
    names = ["_small_key", "_plan_p", "_plan_rate", "_plan_cuts", "_mix_u", "_mix_source", "cell", "q", "_row_salt"]
    df = spark.createDataFrame([(i, "a b " * i, "s", *["mine"] * len(names)) for i in range(20)],
                               "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    got = mix_sources(df)
    assert set(df.columns) <= set(got.columns) and got.filter(" AND ".join(f"{n} = 'mine'" for n in names)).count() == 20
    small = spark.createDataFrame([("s", 1)], "source string, w int")
    for n in (1, 10 ** 9):
        assert spread_join(df, small, "source", "doc_id", n, salts=3).columns == [*df.columns, "w"]


def test_mix_of_odd_rows(odd, nothing):
    got = mix_sources(odd)
    assert set(odd.columns) <= set(got.columns) and got.count() == len(odd_rows())
    assert len({r.copies for r in got.filter("doc_id = 14 and text like 'rep%'").collect()}) == 1
    assert mix_sources(nothing).count() == 0


def test_mix_hits_the_targets_of_the_documents(spark):
    by = defaultdict(lambda: [0, 0.0])
    for r in op10_pareto_mix(spark, SF_SMALL.replace("0.001", "0.01")).collect():
        by[r.source_size, r.target][0] += r.taken
    assert all(abs(t - target) <= 0.02 * target for (_, target), (t, _) in by.items())


def test_spread_join_is_the_same_with_salts(spark):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(["a", "a", None, "b", "zz"] * 5)], "k string, v int")
    small = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, w int")
    a = spread_join(rows, small, "k", "v", 3).collect()
    b = spread_join(rows, small, "k", "v", 10 ** 9, salts=4).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b)) and len(a) == 25


def brute_top(rows, k, every):
    out = []
    fine = {(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    for q, v in fine:
        if q % every == 0:
            hits = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in fine if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits[:k])]
    return sorted(out)


def top(df, **options):
    return sorted(map(tuple, topk.top_inner_products(df, **options).collect()))


def test_top_k(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1 + i % 7, 6)]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(12)]  # ties
    rows += [rows[50], (2000, None), (2050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2100, [float("nan")] * 6), (None, [1.0] * 6),
             (2150, [float("inf")] * 6), (2200, [0.0] * 6), (2250, [1.0, 2.0]), (2251, [3.0, 2.0]), (2300, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for block in (16, 1024):
        assert top(df, block=block, cell_blocks=3) == brute_top(rows, 5, 50)


def test_short_blocks_are_not_sent(spark, monkeypatch):
    """A few long vectors answer all queries: the blocks of short ones stay where they are."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 100 if i < 32 else 0.5, 6)]) for i in range(640)]
    dealt, kept = [], []
    needed = topk.needed_blocks
    monkeypatch.setattr(topk, "needed_blocks", lambda pairs, needs: dealt.append(pairs.count()) or kept.append(needed(pairs, needs).count()) or needed(pairs, needs))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert top(df, block=16, cell_blocks=3, cell_queries=1) == brute_top(rows, 5, 50)
    assert kept[0] < 0.7 * dealt[0]
    assert topk.least_length(np.array([2.0, 0.0]), np.array([10.0, -np.inf])) == -np.inf
    assert topk.least_length(np.array([2.0]), np.array([10.0])) == pytest.approx(5.0) and topk.least_length(np.array([0.0]), np.array([1.0])) == np.inf


def test_top_k_beyond_exact_doubles(spark):
    rows = [(i, [float(3 ** i) * 1e4, -1e9, 7.0 + i]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert top(df, query_every=4) == brute_top(rows, 5, 4)


def test_top_k_of_nothing(spark):
    assert top(spark.createDataFrame([], "vec_id long, embedding array<float>")) == []
    assert top(spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")) == []


def test_bounds_prune(spark):
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 60, (2000, 16)) * np.geomspace(1, 0.05, 16) * rng.uniform(0.1, 1, (2000, 1)))
    x = x[np.argsort(-(x * x).sum(axis=1))]
    rotation = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    best, q = topk.Best(5, np.arange(20)), x[:20]
    n = sum(topk.search_block(best, q, np.arange(at, at + 250), x[at:at + 250], rotation, 4) for at in range(0, 2000, 250))
    assert n < 0.5 * 20 * 2000
    exact = (q @ x.T).astype(int)
    np.fill_diagonal(exact, -10 ** 9)
    assert [list(s) for s, _ in best.found] == [sorted(r, reverse=True)[:5] for r in exact]
