"""Property-based checks of the primitives the scale design leans on."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from candor.functions.scalars import round_half_away
from candor.operators.skew import skew_safe_row_number

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(-5, 5)), min_size=1, max_size=300),
       st.integers(1, 6))
def test_skew_safe_row_number_equals_window(spark, rows, parts):
    df = spark.createDataFrame([(g, i, v) for i, (g, v) in enumerate(rows)], "g string, id long, v long")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = skew_safe_row_number(df, ["g"], order, name="rn", num_partitions=parts)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert sorted(tuple(r) for r in got.select("id", "rn").collect()) == sorted(tuple(r) for r in want.select("id", "rn").collect())


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.integers(-10**7, 10**7).map(lambda x: x / 8.0), st.floats(-1e6, 1e6, allow_nan=False),
                          st.integers(0, 10**6).map(lambda x: x / 160.0)), min_size=1, max_size=50),
       st.sampled_from([2, 4, 6]))
def test_rounding_is_bit_identical_to_duckdb(spark, xs, digits):
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(round_half_away("x", digits)).collect()]
    want = [r[0] for r in duckdb.execute(f"SELECT round(x, {digits}) FROM unnest(?::DOUBLE[]) t(x)", [xs]).fetchall()]
    assert got == want
