"""Fill-in-middle against its SQL and against a plain rearrangement in Python."""

import hashlib

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import fill_in_middle as fim

TEXTS = ["", None, "a", "ab", "plain words here", "größe ∑ 𝔘nicode 👩‍👩‍👧 tail", "has <P> inside", "ends <", "x" * 300, "<S", "M> <M", "\x00\n\t",
         "many words " * 400]


def expected(doc_id, text):
    t = text or ""
    n = len(t)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted(v % (n + 1) for v in h[:2])
    p, m, s = t[:a], t[a:b], t[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_output_form_and_restored_text(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], i) for i in range(400)] + [(None, "no id", 1), (7, "again", 2), (7, "again", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    done, c = fim.fill_in_middle(docs)
    assert done.columns[:3] == ["doc_id", "text", "n"]
    got = done.select("doc_id", "text", *(F.col(c[k]).alias(f"_{k}") for k in ("n", "form", "prefix_chars", "middle_chars", "output")),
                      fim.restored(F.col(c["output"]), F.col(c["form"])).alias("back")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[2:7] == expected(r[0], r[1])
        assert r["back"] == (r[1] or "")
    assert {r["_form"] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("limit", [1, 7, 64, 1 << 20])
def test_long_texts_in_pieces(limit):
    texts = pa.array(["äb𝔘c" * 30, "x", "wörter " * 11, "zz"])
    low, high = pa.array([5, 0, 20, 1], pa.int64()), pa.array([90, 1, 20, 2], pa.int64())
    out = fim.rearranged(texts, pa.array(["psm", "spm", "psm", "spm"]), low, high, fim.SENTINELS, limit).to_pylist()
    for t, f, a, b, o in zip(texts.to_pylist(), ["psm", "spm", "psm", "spm"], low.to_pylist(), high.to_pylist(), out):
        p, m, s = t[:a], t[a:b], t[b:]
        assert o == (f"<P>{p}<S>{s}<M>{m}" if f == "psm" else f"<S>{s}<P>{p}<M>{m}")


def test_sliced_arrays_keep_their_units():
    whole = pa.array(["skip", "äö", None, "abc"]).fill_null("")
    assert fim.split_units(whole.slice(1)).to_pylist() == [["ä", "ö"], [], ["a", "b", "c"]]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.fill_in_middle(docs)[0].collect() == []


def test_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.001"
    got = fim.op11_fill_in_middle(spark, d)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet')")
    rel = con.sql(fim.SQL["op11_fill_in_middle"])
    assert got.columns == rel.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, rel.fetchall()), key=key)
