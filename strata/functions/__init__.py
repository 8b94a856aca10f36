"""Column builders (JVM-side expressions only, no Python UDFs)."""

from strata.functions.casts import (to_int, to_double, to_timestamp, to_flag,
                                    cast_columns, cast_loss)
from strata.functions.clean import (is_blank, impute_blank, canonicalise,
                                    presence_flag, presence_int, presence_label,
                                    null_default)
from strata.functions import measures

__all__ = ["to_int", "to_double", "to_timestamp", "to_flag", "cast_columns",
           "cast_loss", "is_blank", "impute_blank", "canonicalise",
           "presence_flag", "presence_int", "presence_label", "null_default",
           "measures"]
