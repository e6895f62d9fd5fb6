"""User-defined functions (L1, L2).

The built-in ``F.length`` is the fast path; these exist to show the Python
extension surface. The row-at-a-time form is null-safe here (the
reference's version raised on null input).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def _length_or_none(s):
    return None if s is None else len(s)


# Row-at-a-time Python UDF: one Python call per row (slow path).
text_length_rowwise = F.udf(_length_or_none, IntegerType())


@F.pandas_udf(IntegerType())
def text_length_batched(s: pd.Series) -> pd.Series:
    """Arrow-batched string length; null in, null out."""
    return s.str.len().astype("Int32")
