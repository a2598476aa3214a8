"""Property tests: Spark expressions against plain-Python models and the DuckDB emulation the
oracle relies on, over random strings (one Spark job per generated batch)."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridemart.functions import expr as X
from ridemart.plans.oracle import initcap as duck_initcap
from ridemart.plans.oracle import weather_group as duck_weather_group

WORDS = ["snow", "ICE", "heavy rain", "Moderate Rain", "light rain", "drizzle", "patchy rain",
         "shower", "fog", "Mist", "overcast", "cloudy", "sunny", "freezing", "b/e13", "nat",
         "48", "4-not", "x", "", " "]
texts = st.lists(st.lists(st.sampled_from(WORDS), min_size=0, max_size=4).map(" ".join),
                 min_size=1, max_size=60)


def py_weather_group(desc):
    d = str(desc).lower()
    for group, words in X.WEATHER_GROUP_RULES:
        if any(w in d for w in words):
            return group
    return X.WEATHER_DEFAULT_GROUP


def py_initcap(s):
    return " ".join(w[:1].upper() + w[1:] for w in s.lower().split(" "))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=texts)
def test_initcap_spark_python_and_duckdb_agree(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(F.initcap("s")).collect()]
    assert got == [py_initcap(v) for v in values]
    con = duckdb.connect()
    duck = [con.execute(f"SELECT {duck_initcap('?')}".replace("?", "$1"), [v]).fetchone()[0]
            for v in values]
    assert duck == got


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=texts)
def test_weather_group_spark_python_and_duckdb_agree(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "d string")
    got = [r[0] for r in df.select(X.weather_group("d")).collect()]
    assert got == [py_weather_group(v) for v in values]
    con = duckdb.connect()
    duck = [con.execute(f"SELECT {duck_weather_group('$1')}", [v]).fetchone()[0] for v in values]
    assert duck == got
