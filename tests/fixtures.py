"""Seeded student-analytics source tables (all strings) with edge rows.

``raw_tables(spark, seed, dirty=False)`` returns the seven source tables;
``dirty=True`` adds keys that exist on one side only and facts that point
at unknown students / modules, which the Gold checks must reject.
"""

from __future__ import annotations

import random

from strata.plans.schemas import RAW_COLUMNS
from strata.sources.ingest import all_string_schema

REGIONS = ["Scotland", "Wales", "London Region", "North Region", "Ireland"]
EDUCATION = ["A Level or Equivalent", "HE Qualification", "Lower Than A Level"]
AGES = ["0-35", "35-55", "55<="]
MODULES = [("AAA", "2013J"), ("AAA", "2014J"), ("BBB", "2013B"), ("BBB", "2014B"),
           ("CCC", "2014J")]
# Fixed edge values of FIXTURES.md.
IMD_EDGE = [None, "", "10-20", "10-20%", "20-30%"]
UNREG_EDGE = [None, "", "12", "-5", "abc"]
SCORE_EDGE = [None, "", "0", "39", "40", "100", "101", "-1", "abc", "7.5"]
BANKED_EDGE = ["0", "1", "2", ""]


def raw_rows(seed: int = 42, n_students: int = 60, dirty: bool = False) -> dict[str, list]:
    rnd = random.Random(seed)
    courses = [(m, p, str(rnd.randint(230, 270))) for m, p in MODULES]
    # One module (CCC 2014J) gets no clicks at all.
    assessments, aid = [], 1000
    for m, p in MODULES:
        for k in range(3):
            aid += 1
            w = ["7.5", "0", ""][k] if (m, p) == MODULES[0] else str(rnd.choice([10, 20, 30]))
            date = "" if (aid == 1002) else str(rnd.randint(10, 200))
            assessments.append((m, p, str(aid), rnd.choice(["TMA", "CMA", "Exam"]), date, w))
    info, reg = [], []
    for s in range(n_students):
        sid = str(10000 + s)
        regs = [MODULES[rnd.randrange(4)]]
        if s == 0:   # two presentations, different region
            regs = [("AAA", "2013J"), ("AAA", "2014J")]
        if s == 1:   # two modules of the same presentation
            regs = [("AAA", "2014J"), ("CCC", "2014J")]
        for i, (m, p) in enumerate(regs):
            imd = IMD_EDGE[s % 5] if s < 10 else rnd.choice(["0-10%", "10-20", "30-40%", None])
            region = REGIONS[(s + i) % len(REGIONS)] if s == 0 else REGIONS[s % len(REGIONS)]
            info.append((m, p, sid, rnd.choice("MF"), region, rnd.choice(EDUCATION), imd,
                         rnd.choice(AGES), str(rnd.randint(0, 3)), str(rnd.choice([30, 60, 120])),
                         rnd.choice("NY"), rnd.choice(["Pass", "Fail", "Withdrawn"])))
            unreg = UNREG_EDGE[s % 5] if s < 10 else rnd.choice([None, None, "", str(rnd.randint(-20, 200))])
            reg.append((m, p, sid, str(rnd.randint(-100, 0)), unreg))
    scores, clicks = [], []
    by_module = {}
    for a in assessments:
        by_module.setdefault((a[0], a[1]), []).append(a[2])
    edge_i = 0
    for m, p, sid, *_ in info:
        for a in by_module[(m, p)]:
            if edge_i < len(SCORE_EDGE):
                sc = SCORE_EDGE[edge_i]
            else:
                sc = str(rnd.randint(0, 100))
            banked = BANKED_EDGE[edge_i % 4]
            edge_i += 1
            scores.append((a, sid, str(rnd.randint(0, 250)), banked, sc))
        if (m, p) == ("CCC", "2014J") or sid == "10005":
            continue  # a module and a student without clicks
        for _ in range(rnd.randint(1, 6)):
            site = str(rnd.randint(500, 503))
            day = str(rnd.randint(-5, 30))
            clk = str(rnd.randint(1, 9))
            clicks.append((m, p, sid, site, day, clk))
    # Repeated click rows and missing click counts.
    clicks.append(clicks[0])
    clicks.append(clicks[0])
    clicks.append(clicks[1][:5] + (None,))
    clicks.append(clicks[2][:5] + ("",))
    vle = [(str(500 + i), m, p, rnd.choice(["resource", "quiz", "forumng"]), str(i), str(i + 1))
           for i in range(4) for m, p in MODULES[:1]]
    if dirty:
        info.append(("BBB", "2013B", "99999", "M", "Wales", EDUCATION[0], "0-10%", AGES[0],
                     "0", "60", "N", "Pass"))
        reg.append(("AAA", "2013J", "88888", "-10", None))
        clicks.append(("ZZZ", "2013J", "10002", "500", "3", "4"))  # unknown module
        clicks.append(("AAA", "2099J", "10002", "500", "3", "4"))  # partial key match
        scores.append(("1001", "77777", "10", "0", "50"))           # unknown student
    return {"courses": courses, "assessments": assessments, "studentInfo": info,
            "studentRegistration": reg, "studentAssessment": scores, "studentVle": clicks,
            "vle": vle}


def raw_tables(spark, seed: int = 42, n_students: int = 60, dirty: bool = False):
    rows = raw_rows(seed, n_students, dirty)
    return {t: spark.createDataFrame(rows[t], all_string_schema(RAW_COLUMNS[t]))
            for t in RAW_COLUMNS}


SECURITY_ROWS = [
    ("scotland.admin@example.edu", "Scotland"),
    ("north.admin@example.edu", "Scotland"),
    ("north.admin@example.edu", "North Region"),
    ("North.Admin@example.edu", "North Region"),     # duplicate, other case
    ("exec.admin@example.edu", "Wales"),
    ("exec.admin@example.edu", "Atlantis"),          # region without students
]
