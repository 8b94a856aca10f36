"""The n-gram join against all pairs compared in Python."""

import random
import re

import numpy as np
import pytest

from strata.llm import ngram_join as nj
from strata.llm.minhash import with_components


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    """Per row (doc_id, n, component_id)."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids and sets[i] else d))
    return sorted(out, key=str)


def joined(spark, rows, extra=True):
    schema = "doc_id long, text string" + (", n int, node string, a int" if extra else "")
    docs = spark.createDataFrame([(d, t, 1, "x", 2) if extra else (d, t) for d, t in rows], schema).repartition(5)
    done, labels = nj.links_of(docs)
    got = with_components(done, labels).select("doc_id", "n", "component_id").collect()
    return sorted(map(tuple, got), key=str)


def corpus(seed, n=120):
    """Near copies of several degrees, chains of them, shared passages, short texts, odd white space."""
    r = random.Random(seed)
    word = lambda: "w%d" % r.randrange(4000)
    common = [" ".join(word() for _ in range(30)) for _ in range(4)]
    rows, i = [(0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "ONE\ttwo"), (5, "a b c d e"), (6, "a b c d e"), (None, "a b c d  e")], 10
    while len(rows) < n:
        base = [word() for _ in range(r.choice([6, 12, 40, 90]))]
        if r.random() < 0.5:
            base = common[r.randrange(4)].split() * r.choice([1, 1, 2]) + base[:r.choice([3, 10, 40])]
        for _ in range(r.choice([1, 1, 2, 6, 14])):
            if r.random() < 0.6:                # copies of copies: chains
                base = [word() if r.random() < r.choice([0.005, 0.02, 0.04]) else w for w in base]
            rows.append((i, r.choice([" ", "\n", "  "]).join(base) if r.random() < 0.9 else " ".join(base).upper()))
            i += 1
    rows += [(None, rows[20][1]), (21, rows[22][1]), (21, rows[22][1]), (999, "long " + " ".join("u%d" % k for k in range(30000)))]
    return rows


@pytest.mark.parametrize("seed, small, group", [(1, 8, 32), (2, 2, 2), (3, 1, 1)])
def test_equals_all_pairs(spark, monkeypatch, seed, small, group):
    monkeypatch.setattr(nj, "SMALL", small)
    monkeypatch.setattr(nj, "GROUP", group)
    monkeypatch.setattr(nj, "CHUNK", 4 * group)
    monkeypatch.setattr(nj, "SPREAD", 1 if small < 8 else 4096)
    rows = corpus(seed)
    assert joined(spark, rows) == brute(rows)


def test_no_rows(spark):
    assert joined(spark, []) == []
    assert joined(spark, [(1, None), (None, ""), (2, " ")], False) == [(1, 0, 1), (2, 0, 2), (None, 0, None)]


def test_shingles_of_a_batch_equal_those_of_each_text():
    texts = [b"", b"a", b"A b  c d", b"a b c d e f g", b"  ", b"x y z\nu v w " * 20]
    whole = list(nj.batch_shingles(texts))
    for t, s in zip(texts, whole):
        assert len(s) == len(shingle_set(t.decode()))
        assert np.array_equal(s, next(nj.batch_shingles([t])))
    assert np.array_equal(whole[2], next(nj.batch_shingles([b"a\tB c D"])))


def test_packed_postings_round_trip():
    rng = np.random.default_rng(1)
    t, g = rng.integers(0, 2 ** 63, 100, dtype=np.uint64), rng.integers(0, 2 ** 48, 100, dtype=np.uint64)
    for a, b in zip((t, g), nj.unpacked(nj.packed(t, g))):
        assert np.array_equal(a, b)


def test_query_columns(spark):
    got = nj.op12_ngram_join(spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got.collect()), key=str) == brute([tuple(d) for d in docs])
