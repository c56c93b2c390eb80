from pyspark.sql import functions as F

from batchlens.functions.tsql import int_avg_minutes, int_div, quote_name, tsql_concat, tsql_plus


def test_concat_null_as_empty_and_plus_propagates(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    r = df.select(tsql_concat(F.col("x"), "-", F.col("y")).alias("c"), tsql_plus(F.col("x"), F.col("y")).alias("p")).first()
    assert r.c == "a-" and r.p is None


def test_integer_average_minutes_truncates(spark):
    # avg(61, 200) = 130 (integer), /60 = 2; a float average would give 2.175
    df = spark.createDataFrame([(261, 2), (None, 0), (-7, 2)], "s bigint, c bigint")
    got = [r.m for r in df.select(int_avg_minutes(F.col("s"), F.col("c")).alias("m")).collect()]
    assert got == [2, None, 0]
    assert df.select(int_div(F.lit(-7), 2).alias("q")).first().q == -3


def test_quote_name(spark):
    df = spark.createDataFrame([("a]b",), (None,)], "x string")
    assert [r.q for r in df.select(quote_name(F.col("x")).alias("q")).collect()] == ["[a]]b]", None]
