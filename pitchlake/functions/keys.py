"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marker that stands for NULL in the warehouse's key macro. Keys only equal the
# ones in existing tables when this text is the same.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the columns as text, joined by ``-``."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARKER))
        for c in cols
    ]
    return F.md5(F.concat_ws("-", *parts))
