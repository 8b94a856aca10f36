"""Dimension building: distinct attribute sets with dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from strata.operators.sequence import dense_key


def build_dimension(df: DataFrame, natural_key: Sequence[str], attributes: Sequence[str] = (),
                    sk: str = "sk", partitions: int | None = None) -> DataFrame:
    """Distinct (natural key, attributes) rows keyed 0..n-1, key first.

    The key is dense and follows the order of all selected columns, so it
    is reproducible run to run.  Uniqueness of the natural key is checked
    separately (``quality.uniqueness``).
    """
    cols = list(natural_key) + [a for a in attributes if a not in natural_key]
    base = df.select(*cols)
    return dense_key(base.distinct(), cols, sk, partitions)
