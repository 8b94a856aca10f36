from pyspark.sql import functions as F

from strata.functions import (canonicalise, cast_columns, cast_loss, impute_blank, measures as M,
                              presence_flag, presence_int, presence_label, to_flag, to_int)


def col_values(df, c):
    return [r[c] for r in df.collect()]


def test_truncating_int_cast(spark):
    vals = ["7.5", "-3", "", " 12 ", "99999999999", "abc", "-0.9", None, "0"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = col_values(df.select(to_int("x").alias("i")), "i")
    assert got == [7, -3, None, 12, None, None, 0, None, 0]


def test_two_step_flag(spark):
    df = spark.createDataFrame([(v,) for v in ["0", "1", "2", "", None, "x"]], "x string")
    assert col_values(df.select(to_flag("x").alias("b")), "b") == [False, True, True, None,
                                                                   None, None]


def test_cast_columns_and_loss(spark):
    df = spark.createDataFrame([("1", "7.5", "2020-01-01 00:00:00"), ("x", "", "bad")],
                               "a string, w string, t string")
    typed = cast_columns(df, {"a": "int", "w": "double", "t": "timestamp"})
    assert [f.dataType.simpleString() for f in typed.schema] == ["int", "double", "timestamp"]
    loss = cast_loss(df, {"a": "int", "w": "double", "t": "timestamp"}).collect()[0]
    assert (loss["rows"], loss["a_lost"], loss["w_lost"], loss["t_lost"]) == (2, 1, 0, 1)


def test_impute_and_canonicalise(spark):
    df = spark.createDataFrame([(v,) for v in [None, "", "10-20", "10-20%", "20-30%"]],
                               "imd string")
    out = df.select(canonicalise(impute_blank("imd"), {"10-20": "10-20%"}).alias("imd"))
    assert col_values(out, "imd") == ["Unknown", "Unknown", "10-20%", "10-20%", "20-30%"]


def test_presence_flags_on_raw_text(spark):
    df = spark.createDataFrame([(v,) for v in [None, "", "12", "-5", "abc"]], "u string")
    out = df.select(presence_flag("u").alias("b"), presence_int("u").alias("i"),
                    presence_label("u").alias("s")).collect()
    assert [r["b"] for r in out] == [False, False, True, True, True]
    assert [r["i"] for r in out] == [0, 0, 1, 1, 1]
    assert [r["s"] for r in out] == ["registered", "registered", "unregistered",
                                     "unregistered", "unregistered"]


def test_measure_semantics(spark):
    df = spark.createDataFrame([(None, 10.0, True), (39, 20.0, False), (40, 30.0, True),
                                (100, 40.0, False)], "score int, weight double, w boolean")
    r = df.agg(M.pass_rate("score", 40, None).alias("p"),
               M.weighted_score("score", "weight", None).alias("ws"),
               M.average("score").alias("avg"), M.row_count().alias("n"),
               M.flag_count("w").alias("wc"), M.flag_rate("w", 2).alias("wr")).collect()[0]
    assert r["p"] == 2 / 4                       # ungraded row stays in the denominator
    assert r["ws"] == (39 * 20 + 40 * 30 + 100 * 40) / 100.0   # NULL score keeps its weight
    assert r["avg"] == (39 + 40 + 100) / 3
    assert (r["n"], r["wc"], r["wr"]) == (4, 2, 0.5)


def test_divide_by_zero_is_null_and_blank_count(spark):
    df = spark.createDataFrame([(False,)], "w boolean").filter(F.lit(False))
    r = df.agg(M.flag_rate("w").alias("r"), M.flag_count("w", True).alias("c")).collect()[0]
    assert r["r"] is None and r["c"] is None
    one = spark.createDataFrame([(False,)], "w boolean")
    assert one.agg(M.flag_count("w", True).alias("c")).collect()[0]["c"] is None
    assert one.agg(M.flag_count("w").alias("c")).collect()[0]["c"] == 0


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 8)], "a int, b int")
    assert df.select(M.ratio(F.col("a"), F.col("b"), 2).alias("r")).collect()[0]["r"] == 0.13
