"""DataFrame -> DataFrame operators.

Skew: aggregates here are algebraic (sum/count/min/max/min-of-struct) and
get map-side partial aggregation, exact distinct counts shuffle on
(key, value) first, joins rely on AQE skew-join splitting, and ordered
numbering (``sequence``) range-partitions a group across tasks.  No
operator gathers a whole group into one task or the driver.
"""
