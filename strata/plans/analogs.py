"""Operator checks on the driver's tables: each operator of the library run
over an analogous table, with an equivalent SQL text for an independent
engine.

Mapping: customer ~ student, orders ~ registration (status 'F' ~
withdrawn), lineitem ~ assessment / click rows, part ~ assessment
definition, events ~ raw click stream.  The source tables carry no NULLs
or raw strings, so where NULL/blank handling is the point a column is
rewritten deterministically from a key (e.g. every 13th event type
blanked, the key of an account in debit negated); such rewrites never remove
rows.

Computed columns are aliased identically on both sides.  Money-like
doubles are summed as ``decimal(18,2)`` (exact, order-independent) and
ratios are left unrounded, so both engines produce identical doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import to_double, to_flag, to_int, to_timestamp
from strata.functions.clean import (canonicalise, impute_blank, presence_flag,
                                    presence_int, presence_label)
from strata.operators.dedup import keep_first
from strata.operators.joins import lookup_key, preaggregate_join
from strata.operators.keys import build_dimension
from strata.operators.quality import (anti_counts, count_tables, duplicate_keys,
                                      orphan_report, profile, reconcile, score_in_range,
                                      split_by_rule, split_report, uniqueness)
from strata.operators.rollup import conservation_report, rollup_events
from strata.operators.sequence import neighbour
from strata.operators.skew import salted_lookup, salted_rollup
from strata.operators.stats import (box_stats, median_by, point_biserial,
                                    point_biserial_test, segment_rates, summary)
from strata.session import scratch_path
from strata.sources.ingest import copy_tables
from strata.sources.layout import Layout, write_many

TPCH = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
EVENT_ORIGIN = "2024-01-01"     # day offsets of events count from here
ORDER_ORIGIN = "1995-01-01"     # day offsets of orders / lines count from here
MONEY = "decimal(18,2)"
# Brand spellings canonicalised to two digits (rule: 1..9).
BRAND_CANONICAL = {f"Brand#{i}": f"Brand#{i:02d}" for i in range(1, 10)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_day() -> F.Column:
    return F.datediff(F.to_date("ts"), F.lit(EVENT_ORIGIN))


# -- sources ------------------------------------------------------------------

def q_table_counts(spark, d):
    return count_tables({t: table(spark, d, t) for t in TPCH})


def q_bronze_reconcile(spark, d):
    """Three tables copied with the audit column, source rows against written rows."""
    parent, _, folder = d.rstrip("/").rpartition("/")
    names = ["customer", "orders", "lineitem"]
    report = copy_tables(spark, Layout(root=parent), Layout(root=scratch_path(spark, "bronze_copy")),
                         [f"{t}.parquet" for t in names], folder, "bronze")
    return report.select(F.regexp_replace("table_name", r"\.parquet$", "").alias("table_name"), "source_rows", "target_rows", "match")


def q_quarantine_roundtrip(spark, d):
    """Both sides of the split written and read back: rows and range of the scores."""
    valid, invalid = split_by_rule(_scored_customers(spark, d), score_in_range("score", 0, 9000))
    lake = Layout(root=scratch_path(spark, "quarantine"))
    write_many(lake, [(valid, "silver", "scores"), (invalid, "silver", "scores_quarantine")])
    frames = [lake.read(spark, "silver", t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n"), F.count("score").alias("scored"),
                                                F.min("score").alias("least"), F.max("score").alias("most"))
              for t in ("scores", "scores_quarantine")]
    return frames[0].unionByName(frames[1])


# -- casts, cleaning, flags ---------------------------------------------------

def q_cast_int_truncating(spark, d):
    li = table(spark, d, "lineitem")
    raw = (F.when(F.col("l_linenumber") == 3, F.lit(""))
           .when(F.col("l_linenumber") == 5, F.lit("n/a"))
           .otherwise(F.col("l_extendedprice").cast("string")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", to_int(raw).alias("price_int"))


def q_cast_double(spark, d):
    li = table(spark, d, "lineitem")
    raw = F.when(F.col("l_linenumber") == 2, F.lit("")).otherwise(
        F.col("l_discount").cast("string"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", to_double(raw).alias("discount"))


def q_cast_timestamp(spark, d):
    o = table(spark, d, "orders")
    raw = F.when(F.col("o_orderkey") % 10 == 0, F.lit("not a date")).otherwise(
        F.col("o_orderdate").cast("string"))
    return o.select("o_orderkey", to_timestamp(raw).alias("order_ts"))


def q_cast_flag_two_step(spark, d):
    e = table(spark, d, "events")
    raw = F.when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(
        (F.col("event_id") % 3).cast("string"))
    return e.select("event_id", to_flag(raw).alias("flag"))


def q_impute_unknown(spark, d):
    e = table(spark, d, "events")
    raw = (F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("string"))
           .when(F.col("event_id") % 13 == 1, F.lit(""))
           .otherwise(F.col("event_type")))
    return e.select("event_id", impute_blank(raw).alias("event_type"))


def q_canonical_values(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", canonicalise("p_brand", BRAND_CANONICAL).alias("p_brand"))


def _raw_unregistration() -> F.Column:
    # Present (a date text) for closed orders, '' or NULL otherwise.
    return (F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("date").cast("string"))
            .when(F.col("o_orderkey") % 2 == 0, F.lit("")))


def q_flag_bool(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", presence_flag(_raw_unregistration()).alias("is_withdrawn"))


def q_flag_int(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", presence_int(_raw_unregistration()).alias("is_withdrawn"))


def q_flag_label(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", presence_label(_raw_unregistration()).alias("registration_status"))


# -- quarantine ---------------------------------------------------------------

def _scored_customers(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.when(F.col("c_custkey") % 10 == 0, F.lit(None))
                    .otherwise(F.col("c_acctbal")).alias("score"))


def q_quarantine_valid(spark, d):
    return split_by_rule(_scored_customers(spark, d), score_in_range("score", 0, 9000))[0]


def q_quarantine_invalid(spark, d):
    return split_by_rule(_scored_customers(spark, d), score_in_range("score", 0, 9000))[1]


def q_quarantine_reconcile(spark, d):
    return split_report(_scored_customers(spark, d), score_in_range("score", 0, 9000))


# -- roll-up ------------------------------------------------------------------

def _rolled_events(spark, d):
    e = table(spark, d, "events").withColumn("day", event_day())
    return e, rollup_events(e, ["user_id", "event_type", "day"], "value", "total_value",
                            "event_count", MONEY)


def q_click_rollup(spark, d):
    _, r = _rolled_events(spark, d)
    return r.withColumn("total_value", F.col("total_value").cast("double"))


def q_click_rollup_reconcile(spark, d):
    e, r = _rolled_events(spark, d)
    rep = conservation_report(e, r, "value", "total_value", "event_count", MONEY)
    return rep.withColumns({"source_total": F.col("source_total").cast("double"),
                            "rolled_total": F.col("rolled_total").cast("double")})


# -- dedup, keys, joins -------------------------------------------------------

def q_dedup_first(spark, d):
    return keep_first(table(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


def _brand_type_dim(spark, d):
    return build_dimension(table(spark, d, "part"), ["p_brand", "p_type"], [], "sk")


def q_dim_distinct_key(spark, d):
    return _brand_type_dim(spark, d)


def q_dim_unique_check(spark, d):
    return uniqueness(_brand_type_dim(spark, d), ["p_brand", "p_type"])


def _debit_elsewhere(spark, d):
    """Customers whose key is negated where the account is in debit: no row is left out, some keys miss on both sides."""
    return table(spark, d, "customer").withColumn(
        "c_custkey", F.when(F.col("c_acctbal") < 0, -F.col("c_custkey")).otherwise(F.col("c_custkey")))


def _customer_dim(spark, d, debit_elsewhere=False):
    c = _debit_elsewhere(spark, d) if debit_elsewhere else table(spark, d, "customer")
    return build_dimension(c.select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"], [],
                           "customer_sk")


def q_fact_single_key_join(spark, d):
    f = lookup_key(table(spark, d, "orders"), _customer_dim(spark, d), "o_custkey", "customer_sk")
    return f.select("o_orderkey", "customer_sk", "o_totalprice")


def _part_supplier_dim(spark, d):
    return build_dimension(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], [], "ps_sk")


def q_fact_composite_join(spark, d):
    f = lookup_key(table(spark, d, "lineitem"), _part_supplier_dim(spark, d),
                   ["l_partkey", "l_suppkey"], "ps_sk")
    return f.select("l_orderkey", "l_linenumber", "ps_sk", "l_quantity")


def q_three_key_join(spark, d):
    e, r = _rolled_events(spark, d)
    j = salted_lookup(e, r, ["user_id", "event_type", "day"])
    return j.select("event_id", F.col("total_value").cast("double").alias("total_value"),
                    "event_count")


def _crowded_lines(spark, d):
    """Lines of which every third has the supplier 1: a hot key."""
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("l_suppkey"))
    return table(spark, d, "lineitem").withColumn("supp", hot)


def q_salted_rollup(spark, d):
    r = salted_rollup(_crowded_lines(spark, d), ["supp"], {
        "lines": ("count", "l_orderkey"), "first_line": ("min", "l_linenumber"), "last_part": ("max", "l_partkey"),
        "parts": ("distinct", "l_partkey"), "days": ("distinct", "l_shipdate"), "qty": ("sum", "l_quantity")})
    return r


def q_salted_lookup(spark, d):
    """Each line with its supplier's balance and number of lines: two lookups on a hot key."""
    li = _crowded_lines(spark, d)
    per = (li.groupBy("supp").agg(F.count(F.lit(1)).alias("lines"))
           .join(table(spark, d, "supplier").select(F.col("s_suppkey").alias("supp"), "s_acctbal"), "supp", "left"))
    return salted_lookup(li.select("l_orderkey", "l_linenumber", "l_partkey", "supp"), per, ["supp"])


def q_orphan_keys(spark, d):
    o = table(spark, d, "orders")
    f = lookup_key(o, _customer_dim(spark, d, debit_elsewhere=True), "o_custkey", "customer_sk")
    return orphan_report(f, ["customer_sk"], expected_rows=o)


def q_fanout_check(spark, d):
    li = table(spark, d, "lineitem")
    dim = _part_supplier_dim(spark, d)
    good = lookup_key(li, dim, ["l_partkey", "l_suppkey"], "ps_sk")
    # Joining on part only (a partial composite key) fans out.
    # Its size follows from counts per key; the join itself is quadratic.
    keys = dim.filter(F.col("l_partkey").isNotNull()).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("matches"))
    bad = (li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("rows")).join(keys, "l_partkey", "left")
           .agg(F.sum(F.col("rows") * F.coalesce("matches", F.lit(1))).alias("n")))
    src = li.agg(F.count(F.lit(1)).alias("source_rows"))
    return src.select("source_rows",
                      good.agg(F.count(F.lit(1))).scalar().alias("composite_rows"),
                      F.coalesce(bad.scalar(), F.lit(0)).alias("partial_key_rows")) \
        .withColumns({"composite_ok": F.col("composite_rows") == F.col("source_rows"),
                      "partial_key_ok": F.col("partial_key_rows") == F.col("source_rows")})


def q_anti_both_ways(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"))
    c = _debit_elsewhere(spark, d).select(F.col("c_custkey").alias("custkey"))
    return anti_counts(o, c, ["custkey"], "orders", "customer")


def q_preagg_left_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                            F.col("l_linestatus").alias("o_orderstatus"),
                                            "l_quantity")
    return preaggregate_join(o, li, ["o_orderkey", "o_orderstatus"], "l_quantity",
                             "total_qty", 0, "double")


# -- profiles and counts ------------------------------------------------------

def q_category_profile(spark, d):
    return profile(table(spark, d, "orders"), "o_orderpriority", "o_orderpriority", "n", "pct") \
        .orderBy(F.desc("n"), "o_orderpriority")


def q_case_profile(spark, d):
    grp = F.when(F.col("o_orderstatus") == "F", F.lit("closed")).otherwise(F.lit("open"))
    return profile(table(spark, d, "orders"), grp, "status_group", "n", "pct") \
        .orderBy(F.desc("n"), "status_group")


def q_distinct_count(spark, d):
    e = table(spark, d, "events").withColumn("day", event_day())
    return e.agg(F.count_distinct("user_id").alias("users"),
                 F.count_distinct("event_type").alias("event_types"),
                 F.count_distinct("user_id", "event_type", "day").alias("user_type_days"))


def q_duplicate_keys(spark, d):
    return duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "n")


def q_group_flag_count(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy((F.col("o_orderstatus") == "F").alias("is_closed")) \
        .agg(F.count(F.lit(1)).alias("n"))


# -- statistics ---------------------------------------------------------------

def q_summary_stats(spark, d):
    return summary(table(spark, d, "orders"), "o_totalprice", MONEY, std_digits=4)


def q_median_by_group(spark, d):
    return median_by(table(spark, d, "orders"), "o_totalprice", ["o_orderstatus"],
                     "median_price")


def q_box_stats(spark, d):
    return box_stats(table(spark, d, "orders"), "o_totalprice", ["o_orderstatus"])


def _null_group(spark, d):
    """Orders whose group is NULL where the status is P."""
    return table(spark, d, "orders").withColumn(
        "grp", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))


def q_median_null_group(spark, d):
    return median_by(_null_group(spark, d), "o_totalprice", ["grp"], "median_price")


def q_box_null_group(spark, d):
    return box_stats(_null_group(spark, d), "o_totalprice", ["grp"])


def q_lead_null_group(spark, d):
    return neighbour(_null_group(spark, d).select("grp", "o_orderkey", "o_totalprice"),
                     ["o_totalprice", "o_orderkey"], ["grp"], ["o_orderkey"], 1, "next_")


def q_cast_int_long_fraction(spark, d):
    text = F.concat(F.col("l_linenumber").cast("string"), F.lit(".9999999"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", to_int(text).alias("above"), to_int(F.concat(F.lit("-"), text)).alias("below"))


def q_point_biserial(spark, d):
    o = table(spark, d, "orders")
    return point_biserial(o, F.col("o_orderstatus") == "F", "o_totalprice", digits=6)


def q_point_biserial_pvalue(spark, d):
    o = table(spark, d, "orders")
    return point_biserial_test(o, F.col("o_orderstatus") == "F", "o_totalprice")


def q_segment_rates(spark, d):
    c = table(spark, d, "customer").join(
        table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"),
        "c_nationkey", "left")
    return segment_rates(c, "n_name", F.col("c_acctbal") < 0, rate="negative_rate", n="n")


QUERIES = {
    "table_counts": q_table_counts,
    "bronze_reconcile": q_bronze_reconcile,
    "cast_int_truncating": q_cast_int_truncating,
    "cast_double": q_cast_double,
    "cast_timestamp": q_cast_timestamp,
    "cast_flag_two_step": q_cast_flag_two_step,
    "impute_unknown": q_impute_unknown,
    "canonical_values": q_canonical_values,
    "flag_bool": q_flag_bool,
    "flag_int": q_flag_int,
    "flag_label": q_flag_label,
    "quarantine_valid": q_quarantine_valid,
    "quarantine_invalid": q_quarantine_invalid,
    "quarantine_reconcile": q_quarantine_reconcile,
    "quarantine_roundtrip": q_quarantine_roundtrip,
    "click_rollup": q_click_rollup,
    "click_rollup_reconcile": q_click_rollup_reconcile,
    "dedup_first": q_dedup_first,
    "dim_distinct_key": q_dim_distinct_key,
    "dim_unique_check": q_dim_unique_check,
    "fact_single_key_join": q_fact_single_key_join,
    "fact_composite_join": q_fact_composite_join,
    "three_key_join": q_three_key_join,
    "salted_rollup": q_salted_rollup,
    "salted_lookup": q_salted_lookup,
    "orphan_keys": q_orphan_keys,
    "fanout_check": q_fanout_check,
    "anti_both_ways": q_anti_both_ways,
    "preagg_left_join": q_preagg_left_join,
    "category_profile": q_category_profile,
    "case_profile": q_case_profile,
    "distinct_count": q_distinct_count,
    "duplicate_keys": q_duplicate_keys,
    "group_flag_count": q_group_flag_count,
    "summary_stats": q_summary_stats,
    "median_by_group": q_median_by_group,
    "median_null_group": q_median_null_group,
    "box_null_group": q_box_null_group,
    "lead_null_group": q_lead_null_group,
    "cast_int_long_fraction": q_cast_int_long_fraction,
    "box_stats": q_box_stats,
    "point_biserial": q_point_biserial,
    "point_biserial_pvalue": q_point_biserial_pvalue,
    "segment_rates": q_segment_rates,
}
