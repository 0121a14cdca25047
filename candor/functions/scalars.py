"""Column-level helpers. All are built-in Spark expressions (whole-stage codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip01(c: Column | str) -> Column:
    """CASE WHEN x>1 THEN 1 WHEN x<0 THEN 0 ELSE x END (null stays null)."""
    x = col_(c)
    return F.when(x > 1, F.lit(1.0)).when(x < 0, F.lit(0.0)).otherwise(x)


def capped(c: Column | str, cap: float) -> Column:
    """if(x > cap, cap, x)."""
    x = col_(c)
    return F.when(x > cap, F.lit(cap)).otherwise(x)


def flag(cond: Column) -> Column:
    """if(cond, 1, 0) as bigint (null -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def play_rate_denominator(vdur: Column | str) -> Column:
    """0<vdur<10 -> 10; vdur=0 -> 900; null -> 900; otherwise vdur."""
    v = col_(vdur)
    return (
        F.when((v < 10) & (v > 0), F.lit(10))
        .when(v == 0, F.lit(900))
        .otherwise(F.coalesce(v, F.lit(900)))
    )



def ymd_days_before(as_of: int, days: int) -> str:
    """'yyyyMMdd' of ``as_of - days`` (UTC), computed once on the driver as a literal."""
    import datetime as dt

    return (dt.datetime.fromtimestamp(as_of, dt.timezone.utc) - dt.timedelta(days=days)).strftime("%Y%m%d")



def round_half_away(c: Column | str, digits: int) -> Column:
    """C-library rounding of the binary double: round(x * 10^d) / 10^d, halves away from zero.

    Spark's ``round`` rounds the shortest decimal text of the double instead, so the two
    differ on values such as 2.7421625 (binary slightly below the tie). This form gives the
    bit-identical double other SQL engines produce. Huge or non-finite values pass through.
    """
    x = col_(c).cast("double")
    m = float(10 ** digits)
    y = x * m
    r = F.when(y >= 0, F.floor(y + 0.5)).otherwise(-F.floor(-y + 0.5)) / m
    return F.when(F.isnan(x) | (F.abs(y) >= 1e15), x).otherwise(r)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for value comparison against another engine)."""
    cols = [
        round_half_away(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)
