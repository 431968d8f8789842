"""Rounding on binary values, and means that come out the same however rows lie."""

from __future__ import annotations

import math
import struct
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_to
from tidemark.operators.aggregates import mean_by
from tidemark.operators.rows import round_floats

doubles = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False), st.floats(-1e6, 1e6).map(lambda x: round(x, 3)),
    st.integers(-(10**7), 10**7).map(lambda i: i / 8), st.sampled_from([2.675, 1.005, -0.5, 0.5, 2.5, 4503599627370497.0, 1e22, 5e-324]),
)
SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SLOW
@given(st.lists(doubles, min_size=200, max_size=400))
def test_binary_rounding_is_pythons(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    for decimals in (0, 1, 2, 7):
        rows = df.select("i", round_to(F.col("v"), decimals, "half_even_binary").alias("r")).collect()
        for r in rows:
            assert r.r == float(round(values[r.i], decimals)), (values[r.i], decimals)


def test_binary_rounding_of_what_is_no_number(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (-float("inf"),), (-0.001,)], "v double")
    rows = [r[0] for r in round_floats(df, 2, "half_even_binary").collect()]
    assert rows[0] is None and math.isnan(rows[1]) and rows[2:] == [math.inf, -math.inf, 0.0]
    with pytest.raises(ValueError):
        round_to(F.lit(1.0), 2, "half_odd")


def test_means_are_the_nearest_double_whatever_the_partitions(spark):
    import random

    rng = random.Random(4)
    groups = {
        "tiny and huge": [rng.uniform(-1, 1) * 2.0 ** rng.randint(-900, 900) for _ in range(300)], "cancelling": [1e300, 1.0, -1e300, 3.0],
        "tenths": [0.1] * 10, "subnormal": [5e-324, 5e-324], "bits": [struct.unpack("d", struct.pack("Q", rng.getrandbits(62)))[0] for _ in range(200)],
        "negative": [-0.1, -0.2, 0.05], "zero": [0.0, -0.0], "large": [1.7e308, 1.7e308], "none": [None, None], "some": [None, 2.0, 3.0],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    found = []
    for parts in (1, 7, 200):
        found.append({r.k: r.m for r in _means(df.repartition(parts))})
    assert found[0] == found[1] == found[2]
    for k, vs in groups.items():
        held = [Fraction(v) for v in vs if v is not None]
        assert found[0][k] == (float(sum(held) / len(held)) if held else None)


def _means(df):
    from tidemark.functions.exact import mean_of_doubles

    return mean_of_doubles(df, ["k"], "v", "m").collect()


def test_means_of_infinities_and_of_nothing(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([("a", inf), ("a", 1.0), ("b", inf), ("b", -inf), ("c", nan), ("c", 1.0)], "k string, v double")
    rows = {r.k: r.m for r in _means(df)}
    assert rows["a"] == inf and math.isnan(rows["b"]) and math.isnan(rows["c"])
    assert mean_by(df.limit(0), None, "v", "m", empty=0.0).collect()[0][0] == 0.0
    assert mean_by(df.limit(0), "k", "v", "m").count() == 0
    whole = spark.createDataFrame([(1, 10), (1, 11), (1, None)], "k int, v int")
    assert mean_by(whole, "k", "v", "m").collect()[0]["m"] == 10.5
