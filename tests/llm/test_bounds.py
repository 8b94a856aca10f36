"""Bounds on the memory of single steps, and paths that only large inputs take."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F


def peak_mb(f):
    tracemalloc.start()
    out = f()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out, peak


def test_a_bucket_of_shared_tokens_stays_small():
    from strata.llm import line_dedup as d
    p = np.zeros(16_000, d.POSTING)
    p["token"] = np.repeat(np.arange(1, 17, dtype=np.uint64), 1000)
    p["cid"] = p["doc"] = np.tile(np.arange(1000), 16)
    p["size"], p["pos"] = 60, np.repeat(np.arange(16), 1000)
    spread = np.ones(1 << d.CELL_BITS, np.uint64)
    (later, earlier, lead, crowd), peak = peak_mb(lambda: d.paired(p, spread, d.SMALL))
    assert peak < 200 and len(crowd) == 16_000 and not len(later)
    p["token"] = np.arange(16_000) // 16        # a thousand tokens of as many classes as are paired at once
    (later, earlier, lead, crowd), peak = peak_mb(lambda: d.paired(p, spread, d.SMALL))
    assert peak < 200 and not len(crowd) and len(later) == len(earlier) == len(lead)
    pairs = {tuple(sorted(x)) for x in zip(later['cid'].tolist(), earlier['cid'].tolist())}
    want = {tuple(sorted(((16 * t + i) % 1000, (16 * t + j) % 1000))) for t in range(1000) for i in range(16) for j in range(i)}
    assert pairs == want and len(later) == len(want) and lead.any() and not lead.all()


@pytest.mark.parametrize("small", [2, 3, 16, 1024])
def test_line_dedup_of_chains_and_crowds(spark, monkeypatch, small):
    from strata.llm import line_dedup as d
    monkeypatch.setattr(d, "SMALL", small)
    monkeypatch.setattr(d, "CHUNK", 4)
    r = random.Random(11)
    word = lambda: "w%d" % r.randrange(3000)
    lines = []
    for _ in range(14):
        base = [word() for _ in range(r.choice([5, 9, 24, 40]))]
        for _ in range(r.choice([1, 3, 8, 30])):
            base = [word() if r.random() < 0.03 else w for w in base] if r.random() < 0.7 else base
            lines.append(" ".join(base))
    r.shuffle(lines)
    rows, at = [], 0
    while at < len(lines):
        n = r.choice([1, 2, 5])
        rows.append((len(rows), "\n".join(lines[at:at + n]), "other"))
        at += n
    seen, want = [], set()
    for i, t, _ in rows:
        for k, x in enumerate(t.split("\n")):
            w = x.split()
            s = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))}
            if any(100 * len(s & o) >= 75 * len(s | o) for o in seen):
                want.add((i, k))
            seen.append(s)
    out, text, removed = d.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, line string").repartition(6))
    got = out.select("doc_id", "text", "line", F.col(text).alias("left"), F.col(removed).alias("gone")).collect()
    assert len(got) == len(rows) and {(g[0], k) for g in got for k in g["gone"] or []} == want
    assert all(g["left"] == "\n".join(x for k, x in enumerate(g[1].split("\n")) if (g[0], k) not in want) for g in got)


def test_fit_of_the_centroids_stays_small():
    from strata.llm import ann
    x = np.random.default_rng(3).normal(size=(ann.MAX_SAMPLE, 64))
    x /= np.sqrt((x ** 2).sum(1))[:, None]
    index, peak = peak_mb(lambda: ann.Index(x, 10 * len(x), 1.0, 20))
    assert peak < 300
    assert index.graph.links.shape[1] <= ann.DEGREE + 1


def test_words_hashed_in_windows(monkeypatch):
    from strata.llm import line_dedup as d
    r = np.random.default_rng(2)
    data = np.frombuffer(b" ".join(bytes(r.integers(97, 123, int(n), dtype=np.uint8)) for n in r.integers(0, 30, 400)), np.uint8)
    whole = d.word_hashes(data)
    for w in (7, 64, 1000):
        monkeypatch.setattr(d, "WINDOW", w)
        for a, b in zip(whole, d.word_hashes(data)):
            assert np.array_equal(a, b)


def test_new_words_are_encoded_together_and_exactly():
    import pyarrow as pa
    from strata.llm import packing as p
    words = p.WordIds(p.word_bpe())
    plain, sent = words.tokenizer, []

    class Counting:
        def encode_batch(self, texts, **kw):
            sent.extend(texts)
            return plain.encode_batch(texts, **kw)

        encode_batch_fast = encode_batch

    words.tokenizer = Counting()
    r = random.Random(5)
    common = ["w%d" % i for i in range(1500)] + ["".join(r.choice("abcdefgé") for _ in range(9)) + r.choice(["", "."]) for _ in range(1500)]
    flat, ends = words.encode(pa.array([" ".join(common), None]))
    assert len(sent) <= 5 + len(common) // p.JOINED and flat.tolist() == plain.encode(" ".join(common), add_special_tokens=False).ids and ends[0] == ends[1]
    odd = ["", "́x", "a\x01b", "\x01", "\x01\x01", "<|endoftext|>", "x<|endoftext|>y", "ΟΔΟΣ", "it's", "'s", "…", "\xa0", "日本語", "\x00", "​", "|", "İ", "İİ.", "ǅa,", "ẖ", "H\u0331", "ŉ", "Ω", "ﬁ!", ".", "a..", "½", "\u0130?", "H\u0331", "\u0130.", "<|ENDOFTEXT|>", "it's.", "A.", "\u212a.", "ÉTÉ,", "\x0bB.\x0b"]
    texts = [" ".join(r.choice(odd + common[:50] + common[-50:]) for _ in range(r.randrange(200))) for _ in range(100)]
    flat, ends = words.encode(pa.array(texts))
    for x, a, b in zip(texts, [0, *ends], ends):
        assert flat[a:b].tolist() == plain.encode(x, add_special_tokens=False).ids
    for x in odd:               # and each alone, where no other word keeps its case
        assert words.encode(pa.array([x + " Abc. DEF"]))[0].tolist() == plain.encode(x + " Abc. DEF", add_special_tokens=False).ids


def test_few_texts_are_shuffled_for_sets(spark):
    from strata.llm import minhash as m
    docs = spark.range(3000).select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(5, None), (None, None)], "doc_id long, text string"))
    keyed = docs.select("doc_id", m.text_key().alias("tk"))
    ids = keyed.where("doc_id % 100 = 3 or (doc_id is null and tk is not null)").select(F.col("doc_id").alias("i"), F.col("tk").alias("k"))
    met = keyed.where(m.among(ids, "i", "k")("doc_id", "tk"))
    assert ids.exceptAll(met).isEmpty() and ids.count() <= met.count() <= ids.count() + 5
    none = ids.limit(0)
    assert keyed.where(m.among(none, "i", "k")("doc_id", "tk")).isEmpty()
    # the joins get the thinned rows only
    nodes = spark.createDataFrame([(bytes([1]),)], "node binary")
    classes = keyed.where("doc_id = 3").select(F.lit(bytes([1])).alias("node"), F.col("doc_id").alias("first"), "tk")
    plan = m.sets_of(nodes, docs, classes)
    assert plan.count() == 1 and "held" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_lines_that_share_a_shingle_by_chance_are_not_compared_on_full_sets(spark, monkeypatch):
    from strata.llm import line_dedup as d
    r, sent = random.Random(3), []
    plain = d.verified

    def counting(pairs, sets):
        sent.extend(map(tuple, pairs.select("later", "earlier").collect()))
        return plain(pairs, sets)

    monkeypatch.setattr(d, "verified", counting)
    part = [" ".join(f"w{r.randrange(10 ** 9)}" for _ in range(100)) for _ in range(40)]
    rows = [(i, part[i] + " " + part[(i + 1) % 40]) for i in range(40)]      # half of each line is in the next one
    rows += [(50, rows[0][1] + " more"), (51, rows[3][1])]
    out, _, removed = d.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {x.doc_id for x in out.where(F.size(removed) > 0).collect()} == {50, 51}
    cid = lambda row: int(np.uint64(d.class_id(row[1].encode())).view(np.int64))
    assert sent == [(cid(rows[40]), cid(rows[0]))]


def test_signs_never_rule_out_a_match():
    from strata.llm import line_dedup as d
    r = np.random.default_rng(5)
    for _ in range(200):
        a = np.unique(r.integers(0, 2 ** 64, int(r.integers(1, 400)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.9], r.integers(0, 2 ** 64, int(r.integers(0, 40)), dtype=np.uint64)]))
        if len(b):
            bits = sum(int(np.bitwise_count((x ^ y).view(np.uint64))[0]) for x, y in zip(d.signs_of(a, np.array([0])), d.signs_of(b, np.array([0]))))
            assert bits <= len(np.setxor1d(a, b))


def test_a_task_gives_memory_back_at_its_end(monkeypatch):
    from strata.llm import common
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    got = common.lean(lambda batches: (2 * b for b in batches))(iter([1, 2]))
    assert next(got) == 2 and not calls and list(got) == [4] and len(calls) == 1


def test_components_take_few_rounds(spark, monkeypatch):
    """The driver pays for each round: a long path is shortened in the tasks first, and a round is materialised once."""
    from strata.llm import components as c
    done = []
    monkeypatch.setattr(c, "cut", lambda df: done.append(df) or df.localCheckpoint())
    names = [b"%03d" % i for i in range(400)]
    r = random.Random(5)
    links = list(zip(names, names[1:])) + [(b"x", b"y"), (b"y", b"x"), (b"z", b"z")]
    r.shuffle(links)
    first = [(n, 1000 - i) for i, n in enumerate(names)] + [(b"x", None), (b"y", 7), (b"z", 8), (b"w", 9)]
    nodes = spark.createDataFrame(first, "node binary, first long")
    edges = spark.createDataFrame(links, "a binary, b binary")
    got = {bytes(x["node"]): (x["first"], bytes(x["root"]), x["root_first"]) for x in c.components(nodes, edges.repartition(1)).collect()
           if bytes(x["node"]) not in (b"z", b"w")}
    assert len(got) == 402
    assert all(got[n] == (1000 - i, names[-1], 601) for i, n in enumerate(names))
    assert got[b"x"] == (None, b"y", 7) and got[b"y"] == (7, b"y", 7)
    assert len(done) <= 5, len(done)
    some = [links[i] for i in range(0, len(links), 2)]
    apart = c.components(nodes, spark.createDataFrame(some, "a binary, b binary"))
    root = {bytes(x["node"]): bytes(x["root"]) for x in apart.collect()}
    rest = [(root.get(a, a), root.get(b, b)) for a, b in links if root.get(a, a) != root.get(b, b)]
    whole = {bytes(x["node"]): (bytes(x["root"]), x["root_first"]) for x in c.joined_up(apart, nodes, spark.createDataFrame(rest, "a binary, b binary")).collect()}
    assert {n: whole[n] for n in got} == {n: v[1:] for n, v in got.items()} and len(whole) == len(got)
    monkeypatch.setattr(c, "HELD", 3)           # tasks that hold few links at once
    again = {bytes(x["node"]): bytes(x["root"]) for x in c.components(nodes, edges.repartition(3)).collect()}
    assert {n: again[n] for n in got} == {n: v[1] for n, v in got.items()}


def test_words_and_shingles_by_their_bytes():
    from strata.llm import line_dedup as d
    r = random.Random(8)
    words = sorted({bytes(r.choices(b"ab\x00\xc3", k=r.choice([1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 72, 73, 200]))) for _ in range(3000)})
    own, start = d.word_hashes(np.frombuffer(b"\t".join(words), np.uint8))
    assert len(own) == len(set(own.tolist())) == len(words)
    lines = [b" ".join(words[i % 40] for i in range(at, at + n)) + b" \r" * (at % 2) for at in range(40) for n in (1, 2, 4, 5, 6, 30)]
    h, line = d.tokens_of(lines)
    token = {}
    for i, x in enumerate(lines):
        w = x.split()
        want = [tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))]
        have = h[line == i].tolist()
        assert len(have) == len(want)
        for a, b in zip(want, have):
            assert token.setdefault(a, b) == b
    assert len(set(token.values())) == len(token)


def test_postings_without_a_partner_are_not_unpacked():
    from strata.llm import line_dedup as d
    r = np.random.default_rng(4)
    p = np.zeros(3000, d.POSTING)
    p["token"] = np.concatenate([np.arange(2000) + 10, r.integers(5000, 5300, 1000)])
    for k in ("cid", "doc"):
        p[k] = r.integers(0, 900, 3000)
    p["line"], p["size"], p["pos"], p["sign"] = r.integers(0, 9, 3000), 60, r.integers(0, 16, 3000), r.integers(0, 2 ** 32, 3000)
    spread = np.ones(1 << d.CELL_BITS, np.uint64)
    blobs = [d.packed(p[i::3]) for i in range(3)]
    few = d.met(blobs, spread)
    assert len(few) <= 1000 and few["token"].min() >= 5000
    pairs = lambda x: {tuple(t) for t in zip(*(v["cid"].tolist() for v in d.paired(x, spread, d.SMALL)[:2]))}
    assert pairs(few) == pairs(p)
    crowded = spread.copy()
    crowded[d.cell_of(p["token"][:1]).astype(np.int64)] = 2         # dealt over several buckets: its partners may be elsewhere
    assert len(d.met(blobs, crowded)) > len(few)
