"""Hard negatives against brute force in Python integers, and against their SQL."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives as hn


def brute(rows, anchor=lambda i: i % 100 == 0, positives=5, negatives=5):
    best = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = tuple(math.floor(256 * float(x)) for x in v)
        best[i] = min(best.get(i, (lab, w)), (lab, w))
    out = []
    for a, (lab, v) in best.items():
        if not anchor(a):
            continue
        score = {j: sum(x * y for x, y in zip(v, w)) for j, (_, w) in best.items() if j != a}
        first = sorted(score, key=lambda j: (-score[j], j))
        for p in [j for j in first if best[j][0] == lab][:positives]:
            inside = [j for j in first if best[j][0] != lab and 80 * score[p] <= 100 * score[j] <= 100 * score[p]]
            out += [(a, p, r, j, score[p], score[j]) for r, j in enumerate(inside[:negatives], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], "vec_id long, embedding array<float>, label int, ids string")


def clustered(n, dim=6, seed=3, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    x = (centres[rng.integers(0, 5, n)] + 0.2 * rng.normal(size=(n, dim))).astype(np.float32)
    return [(i, [float(t) for t in v], int(rng.integers(0, labels))) for i, v in enumerate(x)]


@pytest.mark.parametrize("block, pivots", [(2048, 64), (16, 5)])
def test_equals_brute_force(spark, monkeypatch, block, pivots):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "PIVOTS", pivots)
    monkeypatch.setattr(hn, "CHUNK", 3)
    monkeypatch.setattr(hn, "SPREAD", 2)
    rows = clustered(300)
    hot = rows[10][1]
    rows += [(1000 + 10 * k, hot, k % 2) for k in range(40)]                   # one vector again and again: ties
    rows += [(2000, None, 1), (2100, [1.0] * 6, None), (2200, [1.0, None] * 3, 1), (2300, [float("nan")] * 6, 1),
             (2400, [float("inf")] * 6, 2), (None, hot, 1), (2500, [0.0] * 6, 1), (2600, [-x for x in hot], 1),
             (100, rows[5][1], 0), (100, rows[6][1], 0), (2700, [1.0, 2.0], 1), (2800, [], 1)]
    got = hn.mine(frame(spark, rows), lambda i: F.pmod(i, F.lit(20)) == 0, F.col("label"))
    kept = [r for r in rows if r[1] is None or len(r[1]) == 6]
    assert sorted(map(tuple, got.collect())) == brute(kept, lambda i: i % 20 == 0)


def test_scores_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in (rng.normal(size=4) * 1e5 + 4e5).astype(np.float32)], i % 3) for i in range(60)]
    got = hn.mine(frame(spark, rows), lambda i: F.pmod(i, F.lit(10)) == 0, F.col("label"))
    want = brute(rows, lambda i: i % 10 == 0)
    assert max(w[5] for w in want) > 2 ** 53
    assert sorted(map(tuple, got.collect())) == want


def test_no_rows(spark):
    for rows in ([], [(0, None, 1)], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 2)]):
        assert hn.mine(frame(spark, rows), lambda i: F.lit(True), F.col("label")).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_tree_covers_and_searches_exactly(monkeypatch, seed):
    monkeypatch.setattr(hn, "LEAF", 2)
    rng = np.random.default_rng(seed)
    x = rng.integers(-6, 7, (150, 3)).astype(np.int64)
    x[40:60] = x[0]
    norm = float(hn.lengths(x).max())
    tree = hn.Tree.grow(x, norm)
    assert sorted(tree.row[tree.new == 1]) == list(range(150))                  # every row is met once

    def below(node):
        for e in range(tree.start[node], tree.start[node + 1]):
            yield from [tree.row[e]] * int(tree.new[e]) + (list(below(tree.node[e])) if tree.node[e] >= 0 else [])
    for e in np.flatnonzero(tree.node >= 0):
        inside = np.array(list(below(tree.node[e])))
        assert np.sqrt(((x[inside] - x[tree.row[e]]) ** 2).sum(1)).max() <= tree.reach[e]
    ids = rng.permutation(150)
    for q in x[:20]:
        counts = rng.random(150) < 0.6
        s = x @ q
        windows = [(-10, 20), (5, 5), (0, 10 ** 9)]
        got = tree.search(x, ids, counts, q, float(np.linalg.norm(q)), [a for a, _ in windows], [b for _, b in windows], 4,
                          x[tree.row[:tree.start[1]]] @ q)
        for (a, b), (score, row) in zip(windows, got):
            want = sorted((-s[r], ids[r]) for r in range(150) if counts[r] and a <= s[r] <= b)[:4]
            assert sorted(zip((-score).tolist(), ids[row].tolist())) == want


def test_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{d}/embeddings.parquet')")
    rel = con.sql(hn.SQL["op13_hard_negatives"])
    got = hn.op13_hard_negatives(spark, d)
    assert got.columns == rel.columns
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())
