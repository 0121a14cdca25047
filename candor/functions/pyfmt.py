"""Exact float-to-text formatting.

Spark's ``format_string``/``bround`` round the *shortest decimal* form of a double
(1/160 -> "0.00625" -> half-up "0.0063" or half-even "0.0062"), while the serving format
is C/Python ``'%.4f'`` of the *exact binary* value. The two differ on such ties, so this
one formatting step runs as an Arrow-batched pandas UDF (vectorised over a batch, never
row-at-a-time serde). Everything around it stays in built-in expressions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _fixed4(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if v is None or v != v else "%.4f" % v)


@F.pandas_udf(T.StringType())
def _short4(x: pd.Series) -> pd.Series:
    # str(float('%.4f' % v)): the rounded value in shortest form ("0.5", "1.0", "0.0123").
    return x.map(lambda v: None if v is None or v != v else str(float("%.4f" % v)))



def fixed4(c: Column) -> Column:
    """'%.4f' of the exact double."""
    return _fixed4(c)


def short4(c: Column) -> Column:
    """Shortest text of the double rounded to 4 decimals (as Python's str(float('%.4f' % x)))."""
    return _short4(c)
