"""End-to-end: source tables -> Bronze -> Silver -> Gold -> reports."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.errors import CheckFailed
from strata.plans import diagnostics, legacy, medallion, reports
from strata.plans.schemas import RAW_COLUMNS
from strata.sources.layout import Layout, read_manifest
from tests.fixtures import SECURITY_ROWS, raw_rows, raw_tables


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    src = Layout(root=root + "/src")
    for t, df in raw_tables(spark).items():
        src.write(df, "raw", t)
    layout = Layout(root=root + "/lake")
    rep = medallion.run_pipeline(spark, layout, SECURITY_ROWS, source=src)
    return layout, rep, medallion.read_gold(spark, layout)


def _duck():
    con = duckdb.connect()
    for t, rows in raw_rows().items():
        con.register(t, pd.DataFrame(rows, columns=RAW_COLUMNS[t], dtype=object))
    return con


def test_report_numbers(built):
    _, rep, gold = built
    rows = raw_rows()
    assert all(r["match"] for r in rep["bronze"])
    assert rep["silver"]["click_rows_in"] == len(rows["studentVle"])
    assert rep["silver"]["studentAssessment"] + rep["silver"]["studentAssessment_quarantine"] \
        == len(rows["studentAssessment"])
    assert rep["gold"]["fact_assessment"] == rep["silver"]["studentAssessment"]
    assert rep["gold"]["fact_vle"] == rep["silver"]["studentVle"]


def test_silver_edge_rows(spark, built):
    layout, _, _ = built
    info = layout.read(spark, "silver", "studentInfo")
    bands = {r.imd_band for r in info.select("imd_band").distinct().collect()}
    assert "10-20" not in bands and {"Unknown", "10-20%"} <= bands
    reg = layout.read(spark, "silver", "studentRegistration")
    assert dict(reg.filter(F.col("id_student").isin("10000", "10001", "10002", "10003", "10004"))
                .groupBy("id_student").agg(F.max("is_withdrawn")).collect()) \
        == {"10000": False, "10001": False, "10002": True, "10003": True, "10004": True}
    # 'abc' unregistration: flagged withdrawn, date unreadable -> NULL
    r4 = reg.filter(F.col("id_student") == "10004").collect()[0]
    assert r4["is_withdrawn"] and r4["date_unregistration"] is None
    q = layout.read(spark, "silver", "studentAssessment_quarantine")
    assert sorted(r.score for r in q.collect()) == [-1, 101]
    ok = layout.read(spark, "silver", "studentAssessment")
    scores = [r.score for r in ok.collect()]
    assert 7 in scores and None in scores          # '7.5' truncated, '' / 'abc' ungraded
    clicks = layout.read(spark, "silver", "studentVle")
    assert "_ingested_at" not in clicks.columns
    assert clicks.agg(F.max("event_count")).collect()[0][0] >= 3


def test_gold_keys_dense_and_unique(built):
    _, _, gold = built
    ds = gold["dim_student"]
    n = ds.count()
    assert sorted(r.student_sk for r in ds.collect()) == list(range(n))
    assert n == ds.select("id_student").distinct().count()
    s0 = ds.filter(F.col("id_student") == "10000").collect()[0]
    assert s0["region"] == "Scotland"      # earliest presentation (2013J) wins
    assert gold["dim_module"].count() == 5


def test_dirty_sources_fail_checks(spark, tmp_path):
    src = Layout(root=str(tmp_path / "src"))
    for t, df in raw_tables(spark, dirty=True).items():
        src.write(df, "raw", t)
    with pytest.raises(CheckFailed):
        medallion.run_pipeline(spark, Layout(root=str(tmp_path / "lake")), SECURITY_ROWS,
                               source=src)


def test_pipeline_is_idempotent(spark, built, tmp_path):
    layout, _, gold = built
    layout2 = Layout(root=str(tmp_path / "again"))
    for t in RAW_COLUMNS:
        layout2.write(layout.read(spark, "bronze", t), "bronze", t)
    medallion.run_pipeline(spark, layout2, SECURITY_ROWS)
    again = medallion.read_gold(spark, layout2)
    for t in ("dim_student", "dim_module", "dim_assessment", "fact_assessment", "fact_vle",
              "fact_registration"):
        assert gold[t].exceptAll(again[t]).count() == 0
        assert again[t].exceptAll(gold[t]).count() == 0


def test_withdrawal_rate_by_region_matches_plain_sql(built):
    _, _, gold = built
    star = reports.student_star(gold, digits=None, secure=False)
    got = {r.region: r.withdrawal_rate for r in reports.report(star.unsecured(), "withdrawal_rate_by_region")
           .collect()}
    want = dict(_duck().sql("""
        WITH first AS (SELECT id_student, region FROM (SELECT *, row_number() OVER (
          PARTITION BY id_student ORDER BY code_presentation, code_module, gender, region,
          highest_education, imd_band, age_band, disability) rn FROM studentInfo) WHERE rn = 1)
        SELECT f.region, CAST(NULLIF(COUNT(*) FILTER (WHERE r.date_unregistration IS NOT NULL
          AND r.date_unregistration <> ''), 0) AS DOUBLE) / COUNT(*)
        FROM studentRegistration r LEFT JOIN first f ON r.id_student = f.id_student
        GROUP BY f.region""").fetchall())
    assert got.keys() == want.keys()
    for k in got:
        assert abs(got[k] - want[k]) < 1e-12


def test_literal_report_quirks(built):
    _, _, gold = built
    star = reports.student_star(gold, secure=False)
    total = gold["fact_registration"].count()
    v5 = reports.report(star.unsecured(), "registrations_by_assessment_module").collect()
    assert {r.total_registrations for r in v5} == {total}
    assert {r.code_module for r in v5} == {r.code_module for r in
                                          gold["dim_assessment"].select("code_module").collect()}
    students = gold["dim_student"].count()
    per = {r.code_module: r.avg_clicks_per_student for r in
           reports.report(star.unsecured(), "avg_clicks_per_student_by_module").collect()}
    clicks = {r.code_module: r.c for r in gold["fact_vle"].join(gold["dim_module"], "module_sk")
              .groupBy("code_module").agg(F.sum("total_clicks").alias("c")).collect()}
    assert per == {k: v / students for k, v in clicks.items()}
    dist = reports.report(star.unsecured(), "score_sum_by_score").collect()
    assert all(r.score_sum == r.score * c for r in dist for c in [
        gold["fact_assessment"].filter(F.col("score") == r.score).count()])


def test_kpis_and_rls(built):
    _, _, gold = built
    star = reports.student_star(gold)
    kpi = reports.report(star.unsecured(), "kpi_total_students").collect()[0]["total_students"]
    assert kpi == gold["dim_student"].count()
    north = reports.report(star, "students_by_region", principal="NORTH.admin@example.edu")
    regions = {r.region for r in north.collect()}
    assert regions <= {"Scotland", "North Region"} and regions
    assert reports.report(star, "kpi_total_registrations",
                          principal="nobody@example.edu").collect()[0][0] == 0
    secured_total = reports.report(star, "kpi_total_students",
                                   principal="north.admin@example.edu").collect()[0][0]
    assert 0 < secured_total < kpi


def test_all_reports_run(built):
    _, _, gold = built
    star = reports.student_star(gold)
    for key in reports.REPORTS:
        df = reports.report(star, key, principal="exec.admin@example.edu")
        assert df.columns[-1] in reports.REPORTS[key][0]
        df.collect()


def test_engagement_analysis(built):
    _, _, gold = built
    out = reports.engagement_analysis(gold)
    eo = out["outcome"]
    assert eo.count() == gold["fact_registration"].count()   # no fan-out
    r = out["correlation"].collect()[0]
    assert r["n"] == eo.count() and (r["r"] is None or -1 <= r["r"] <= 1)
    assert out["box"].count() == 2 and out["median_clicks"].count() == 2


def test_legacy_summary_and_diagnostics(spark, built):
    layout, _, _ = built
    raw = {t: layout.read(spark, "bronze", t) for t in RAW_COLUMNS}
    ls = legacy.legacy_summary(raw["studentInfo"], raw["studentRegistration"],
                               raw["studentAssessment"], raw["studentVle"])
    assert ls.count() == raw["studentInfo"].count()
    row = ls.filter(F.col("id_student") == "10002").collect()[0]
    assert row["is_withdrawn"] == 1 and row["imd_band"] == "10-20"
    d = diagnostics.diagnostics(raw)
    counts = {r.table_name: r.row_count for r in d["table_counts"].collect()}
    assert counts["studentVle"] == len(raw_rows()["studentVle"])
    orphan = d["registration_orphans"].collect()[0]
    assert tuple(orphan) == (0, 0)
    prof = {r.imd_band: r.imd_count for r in d["imd_band_profile"].collect()}
    assert prof[None] >= 1 and prof[""] >= 1
    st = {r.registration_status: r.status_count for r in d["registration_status"].collect()}
    assert sum(st.values()) == raw["studentRegistration"].count()


_SCORE = "TRY_CAST(trunc(TRY_CAST(score AS DECIMAL(38,6))) AS INTEGER)"


def test_assessment_measures_match_plain_sql(built):
    _, _, gold = built
    star = reports.student_star(gold, digits=None, secure=False)
    con = _duck()
    base = f"""WITH sa AS (SELECT id_assessment, {_SCORE} AS score FROM studentAssessment),
        valid AS (SELECT * FROM sa WHERE score IS NULL OR (score >= 0 AND score <= 100)),
        a AS (SELECT id_assessment, code_module, TRY_CAST(weight AS DOUBLE) AS weight
              FROM assessments)"""
    want_ws = con.sql(base + """ SELECT SUM(v.score * a.weight) / SUM(a.weight)
        FROM valid v LEFT JOIN a ON v.id_assessment = a.id_assessment""").fetchall()[0][0]
    got_ws = star.query(["weighted_score"]).collect()[0][0]
    assert abs(got_ws - want_ws) < 1e-12
    want_pr = dict(con.sql(base + """ SELECT a.code_module,
        CAST(COUNT(*) FILTER (WHERE v.score >= 40) AS DOUBLE) / COUNT(*)
        FROM valid v LEFT JOIN a ON v.id_assessment = a.id_assessment GROUP BY 1""").fetchall())
    got_pr = {r.code_module: r.pass_rate for r in
              reports.report(star.unsecured(), "pass_rate_by_module").collect()}
    assert got_pr.keys() == want_pr.keys()
    assert all(abs(got_pr[k] - want_pr[k]) < 1e-12 for k in got_pr)


def test_clicks_per_registration_drill_across(built):
    _, _, gold = built
    star = reports.student_star(gold, digits=None, secure=False)
    con = _duck()
    want = dict(con.sql("""
        WITH c AS (SELECT code_module, SUM(TRY_CAST(trunc(TRY_CAST(sum_click AS DECIMAL(38,6)))
                   AS INTEGER)) AS clicks FROM studentVle GROUP BY 1),
             r AS (SELECT code_module, COUNT(*) AS regs FROM studentRegistration GROUP BY 1)
        SELECT r.code_module, CAST(c.clicks AS DOUBLE) / r.regs FROM r JOIN c
          ON r.code_module = c.code_module""").fetchall())
    got = {r.code_module: r.avg_clicks_per_registration for r in
           reports.report(star.unsecured(), "avg_clicks_per_registration_by_module").collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_partitioned_click_layout(spark, tmp_path):
    src = Layout(root=str(tmp_path / "src"))
    for t, df in raw_tables(spark, seed=7, n_students=20).items():
        src.write(df, "raw", t)
    lake = Layout(root=str(tmp_path / "lake"))
    rep = medallion.run_pipeline(spark, lake, SECURITY_ROWS, source=src,
                                 partition_clicks_by=("code_presentation",))
    clicks = lake.read(spark, "silver", "studentVle")
    assert clicks.count() == rep["silver"]["studentVle"]
    folder = read_manifest(spark, lake)[1]["silver.studentVle"]
    assert any(p.name.startswith("code_presentation=") for p in (tmp_path / "lake" / folder).iterdir())
    plan = clicks.filter("code_presentation = '2014J'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(code_presentation" in plan


def test_implicit_sums_of_dates(built):
    _, _, gold = built
    star = reports.student_star(gold, secure=False).unsecured()
    for fact, column in (("fact_assessment", "date_submitted"), ("fact_registration", "date_registration"),
                         ("fact_registration", "date_unregistration")):
        want = [r[0] for r in gold[fact].select(column).collect() if r[0] is not None]
        assert want and [r[0] for r in star.query([f"{column}_sum"], []).collect()] == [sum(want)]
