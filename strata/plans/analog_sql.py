"""Equivalent SQL (DuckDB dialect) for the operator analogs."""

from __future__ import annotations

_MONEY_SUM = "CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"
_EVENT_DAY = "CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER)"
_BRANDS = " ".join(f"WHEN 'Brand#{i}' THEN 'Brand#{i:02d}'" for i in range(1, 10))
_SCORED = ("(SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END "
           "AS score FROM customer)")
_ROLLED = f"""(SELECT user_id, event_type, {_EVENT_DAY} AS day,
        {_MONEY_SUM.format(c='value')} AS total_value, COUNT(*) AS event_count
        FROM events GROUP BY ALL)"""
_PS_DIM = """(SELECT l_partkey, l_suppkey, row_number() OVER (ORDER BY l_partkey, l_suppkey) - 1
        AS ps_sk FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))"""
_UNREG = ("CASE WHEN o_orderstatus = 'F' THEN TRUE ELSE FALSE END")
_Q = "quantile_cont(o_totalprice, {q})"

SQL = {
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
        for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]),
    "bronze_reconcile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS source_rows, COUNT(*) AS target_rows, "
        f"TRUE AS match FROM {t}" for t in ["customer", "orders", "lineitem"]),
    "cast_int_truncating": """SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_linenumber IN (3, 5) THEN NULL
             ELSE CAST(trunc(l_extendedprice) AS INTEGER) END AS price_int FROM lineitem""",
    "cast_double": """SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount END AS discount FROM lineitem""",
    "cast_timestamp": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END AS order_ts FROM orders""",
    "cast_flag_two_step": """SELECT event_id,
        CASE WHEN event_id % 11 = 0 THEN NULL ELSE (event_id % 3) <> 0 END AS flag FROM events""",
    "impute_unknown": """SELECT event_id,
        CASE WHEN event_id % 13 IN (0, 1) THEN 'Unknown' ELSE event_type END AS event_type
        FROM events""",
    "canonical_values": f"SELECT p_partkey, CASE p_brand {_BRANDS} ELSE p_brand END AS p_brand "
                        "FROM part",
    "flag_bool": f"SELECT o_orderkey, {_UNREG} AS is_withdrawn FROM orders",
    "flag_int": "SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END "
                "AS INTEGER) AS is_withdrawn FROM orders",
    "flag_label": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'unregistered' "
                  "ELSE 'registered' END AS registration_status FROM orders",
    "quarantine_valid": f"SELECT * FROM {_SCORED} WHERE score IS NULL OR "
                        "(score >= 0 AND score <= 9000)",
    "quarantine_invalid": f"SELECT * FROM {_SCORED} WHERE score < 0 OR score > 9000",
    "quarantine_reconcile": f"""SELECT
        COUNT(*) FILTER (WHERE score IS NULL OR (score >= 0 AND score <= 9000)) AS valid_rows,
        COUNT(*) FILTER (WHERE score < 0 OR score > 9000) AS invalid_rows,
        COUNT(*) AS source_rows, TRUE AS complete FROM {_SCORED}""",
    "click_rollup": f"SELECT * FROM {_ROLLED}",
    "click_rollup_reconcile": f"""SELECT COUNT(*) AS source_rows,
        {_MONEY_SUM.format(c='value')} AS source_total, COUNT(*) AS rolled_events,
        {_MONEY_SUM.format(c='value')} AS rolled_total,
        (SELECT COUNT(*) FROM {_ROLLED}) AS rolled_rows, TRUE AS conserved FROM events""",
    "dedup_first": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "dim_distinct_key": """SELECT row_number() OVER (ORDER BY p_brand, p_type) - 1 AS sk,
        p_brand, p_type FROM (SELECT DISTINCT p_brand, p_type FROM part)""",
    "dim_unique_check": """SELECT COUNT(*) AS rows, COUNT(*) AS distinct_keys, TRUE AS unique
        FROM (SELECT DISTINCT p_brand, p_type FROM part)""",
    "fact_single_key_join": """SELECT o.o_orderkey, d.customer_sk, o.o_totalprice FROM orders o
        LEFT JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS customer_sk
        FROM customer) d ON o.o_custkey = d.c_custkey""",
    "fact_composite_join": f"""SELECT l.l_orderkey, l.l_linenumber, d.ps_sk, l.l_quantity
        FROM lineitem l LEFT JOIN {_PS_DIM} d
        ON l.l_partkey = d.l_partkey AND l.l_suppkey = d.l_suppkey""",
    "three_key_join": f"""SELECT e.event_id, r.total_value, r.event_count FROM
        (SELECT event_id, user_id, event_type, {_EVENT_DAY} AS day FROM events) e
        LEFT JOIN {_ROLLED} r ON e.user_id = r.user_id AND e.event_type = r.event_type
        AND e.day = r.day""",
    "orphan_keys": """SELECT COUNT(*) AS rows,
        COUNT(*) FILTER (WHERE c.c_custkey IS NULL) AS null_customer_sk,
        (SELECT COUNT(*) FROM orders) AS source_rows,
        (COUNT(*) FILTER (WHERE c.c_custkey IS NULL) = 0
         AND COUNT(*) = (SELECT COUNT(*) FROM orders)) AS ok
        FROM orders o LEFT JOIN (SELECT CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END AS c_custkey FROM customer) c
        ON o.o_custkey = c.c_custkey""",
    "quarantine_roundtrip": """WITH s AS (SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS score FROM customer)
        SELECT 'scores' AS table_name, COUNT(*) AS n, COUNT(score) AS scored, MIN(score) AS least, MAX(score) AS most
          FROM s WHERE score IS NULL OR score BETWEEN 0 AND 9000
        UNION ALL SELECT 'scores_quarantine', COUNT(*), COUNT(score), MIN(score), MAX(score) FROM s WHERE score < 0 OR score > 9000""",
    "salted_rollup": """SELECT supp, COUNT(l_orderkey) AS lines, MIN(l_linenumber) AS first_line, MAX(l_partkey) AS last_part,
        COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_shipdate) AS days, SUM(l_quantity) AS qty
        FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS supp FROM lineitem) GROUP BY supp""",
    "salted_lookup": """WITH l AS (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS supp FROM lineitem)
        SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.supp, p.lines, s.s_acctbal FROM l
        LEFT JOIN (SELECT supp, COUNT(*) AS lines FROM l GROUP BY supp) p ON l.supp = p.supp
        LEFT JOIN supplier s ON l.supp = s.s_suppkey""",
    "fanout_check": f"""WITH d AS {_PS_DIM},
        s AS (SELECT COUNT(*) AS n FROM lineitem),
        g AS (SELECT COUNT(*) AS n FROM lineitem l LEFT JOIN d
              ON l.l_partkey = d.l_partkey AND l.l_suppkey = d.l_suppkey),
        b AS (SELECT COUNT(*) AS n FROM lineitem l LEFT JOIN d ON l.l_partkey = d.l_partkey)
        SELECT s.n AS source_rows, g.n AS composite_rows, b.n AS partial_key_rows,
        g.n = s.n AS composite_ok, b.n = s.n AS partial_key_ok FROM s, g, b""",
    "anti_both_ways": """WITH c AS (SELECT CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END AS k FROM customer)
        SELECT
        (SELECT COUNT(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.k = o.o_custkey)) AS in_orders_not_in_customer,
        (SELECT COUNT(*) FROM c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.k)) AS in_customer_not_in_orders""",
    "preagg_left_join": """WITH q AS (SELECT l_orderkey, l_linestatus, SUM(l_quantity) AS total_qty
        FROM lineitem GROUP BY l_orderkey, l_linestatus)
        SELECT o.o_orderkey, o.o_orderstatus, o.o_custkey,
        COALESCE(q.total_qty, 0.0) AS total_qty FROM orders o LEFT JOIN q
        ON o.o_orderkey = q.l_orderkey AND o.o_orderstatus = q.l_linestatus""",
    "category_profile": """SELECT o_orderpriority, COUNT(*) AS n,
        CAST(COUNT(*) AS DOUBLE) * 100.0::DOUBLE / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS pct
        FROM orders GROUP BY o_orderpriority ORDER BY n DESC, o_orderpriority""",
    "case_profile": """SELECT CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END
        AS status_group, COUNT(*) AS n,
        CAST(COUNT(*) AS DOUBLE) * 100.0::DOUBLE / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS pct
        FROM orders GROUP BY 1 ORDER BY n DESC, status_group""",
    "distinct_count": f"""SELECT COUNT(DISTINCT user_id) AS users,
        COUNT(DISTINCT event_type) AS event_types,
        (SELECT COUNT(*) FROM (SELECT DISTINCT user_id, event_type, {_EVENT_DAY} FROM events))
        AS user_type_days FROM events""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "group_flag_count": """SELECT o_orderstatus = 'F' AS is_closed, COUNT(*) AS n FROM orders
        GROUP BY 1""",
    "summary_stats": f"""SELECT COUNT(o_totalprice) AS count,
        {_MONEY_SUM.format(c='o_totalprice')} / COUNT(o_totalprice) AS mean,
        round(stddev_samp(o_totalprice), 4) AS std, MIN(o_totalprice) AS min,
        {_Q.format(q=0.25)} AS p25, {_Q.format(q=0.5)} AS p50, {_Q.format(q=0.75)} AS p75,
        MAX(o_totalprice) AS max FROM orders""",
    "median_null_group": """SELECT grp, quantile_cont(o_totalprice, 0.5) AS median_price
        FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS grp FROM orders)
        GROUP BY grp""",
    "box_null_group": """WITH o AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS grp FROM orders),
        q AS (SELECT grp, COUNT(*) AS n, quantile_cont(o_totalprice, 0.25) AS q1,
          quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.75) AS q3 FROM o GROUP BY grp),
        f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM q)
        SELECT f.grp, f.n, f.q1, f.median, f.q3,
          MIN(CASE WHEN o.o_totalprice BETWEEN f.lo AND f.hi THEN o.o_totalprice END) AS lower_whisker,
          MAX(CASE WHEN o.o_totalprice BETWEEN f.lo AND f.hi THEN o.o_totalprice END) AS upper_whisker,
          COUNT(*) FILTER (WHERE NOT (o.o_totalprice BETWEEN f.lo AND f.hi)) AS outliers
        FROM o JOIN f ON o.grp IS NOT DISTINCT FROM f.grp
        GROUP BY f.grp, f.n, f.q1, f.median, f.q3""",
    "lead_null_group": """SELECT grp, o_orderkey, o_totalprice, LEAD(o_orderkey) OVER (
          PARTITION BY grp ORDER BY o_totalprice, o_orderkey) AS next_o_orderkey
        FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS grp FROM orders)""",
    "cast_int_long_fraction": """SELECT l_orderkey, l_linenumber, l_linenumber AS above, -l_linenumber AS below
        FROM lineitem""",
    "median_by_group": """SELECT o_orderstatus, quantile_cont(o_totalprice, 0.5) AS median_price
        FROM orders GROUP BY o_orderstatus""",
    "box_stats": f"""WITH q AS (SELECT o_orderstatus, COUNT(*) AS n, {_Q.format(q=0.25)} AS q1,
          {_Q.format(q=0.5)} AS median, {_Q.format(q=0.75)} AS q3 FROM orders
          GROUP BY o_orderstatus),
        f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi
          FROM q)
        SELECT f.o_orderstatus, f.n, f.q1, f.median, f.q3,
          MIN(CASE WHEN o.o_totalprice BETWEEN f.lo AND f.hi THEN o.o_totalprice END)
            AS lower_whisker,
          MAX(CASE WHEN o.o_totalprice BETWEEN f.lo AND f.hi THEN o.o_totalprice END)
            AS upper_whisker,
          COUNT(*) FILTER (WHERE NOT (o.o_totalprice BETWEEN f.lo AND f.hi)) AS outliers
        FROM orders o JOIN f ON o.o_orderstatus = f.o_orderstatus
        GROUP BY f.o_orderstatus, f.n, f.q1, f.median, f.q3""",
    "point_biserial": """SELECT round(corr(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END,
        o_totalprice), 6) AS r, COUNT(*) AS n FROM orders""",
    "segment_rates": """SELECT n.n_name,
        CAST(COUNT(*) FILTER (WHERE c.c_acctbal < 0) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)
          AS negative_rate, COUNT(*) AS n
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""",
}
