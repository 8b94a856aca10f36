"""The registered queries themselves: names and types of their columns, and what must hold for every row."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
COLUMNS = {
    "op1_ann": "query_id bigint, rank int, vec_id bigint, score double",
    "op2_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op4_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op5_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op7_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
                         "base_failed boolean, kept boolean",
    "op9_html_extraction": "page_id bigint, url string, text string, n_chars bigint",
    "op11_fill_in_middle": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
    "op12_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op13_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
}


@pytest.fixture(scope="module")
def queries():
    from __spark_entry__ import queries
    return queries()


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, queries, name):
    got = dict(queries[name](spark, SF).dtypes)
    want = dict(c.split() for c in COLUMNS[name].split(", "))
    assert {k: got.get(k) for k in want} == want


def test_repeat_removal_counts_runs(spark, queries):
    """n_spans, n_removed and the digest against a plain search for strings of 200 bytes."""
    import hashlib
    docs = {r[0]: (r[1] or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    seen, marked = {}, {d: bytearray(len(b)) for d, b in docs.items()}
    for d, b in docs.items():
        for i in range(len(b) - 199):
            seen.setdefault(hash(b[i:i + 200]), []).append((d, i))
    for places in seen.values():
        for d, i in places if len(places) > 1 else ():
            marked[d][i:i + 200] = b"\x01" * 200
    for r in queries["op2_suffix_dedup"](spark, SF).collect():
        m = marked[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(m), sum(m), len([x for x in bytes(m).split(b"\x00") if x]))
        assert r["kept_sha256"] == hashlib.sha256(bytes(x for x, gone in zip(docs[r["doc_id"]], m) if not gone)).hexdigest()


def test_quality_counts(spark, queries):
    """n_symbols and n_dup_lines, of whole texts."""
    docs = {r[0]: r[1] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries["op7_quality_rules"](spark, SF).collect():
        lines = [x for x in docs[r["doc_id"]].split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in docs[r["doc_id"]])
        assert r["n_dup_lines"] == len(lines) - len(set(lines))


def test_language_query_holds_out_by_id(spark, queries):
    out = queries["op5_language_id"](spark, SF)
    assert out.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)).isEmpty()
    assert out.where((F.col("score") < 0) | (F.col("score") > 1) | F.col("lang_pred").isNull()).isEmpty()


def test_workers_find_the_package_from_another_folder(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from strata.session import build_session
from __spark_entry__ import queries
spark = build_session("local[2]", shuffle_partitions=2)
print("rows", len(queries()["op9_html_extraction"](spark, {SF!r}).collect()))
spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows " in out.stdout, out.stderr[-2000:]
