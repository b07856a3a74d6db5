"""Column-level functions (pure ``Column -> Column`` expressions, JVM-side)."""

from riskloom.functions.nulls import (  # noqa: F401
    bool_to_int,
    clamp_positive,
    ieee_ratio,
    inf_to_null,
    nan_to_null,
    not_equal_keep_null,
    sentinel_to_null,
)
from riskloom.functions.names import clean_names, rename_columns  # noqa: F401
