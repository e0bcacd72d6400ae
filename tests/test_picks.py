import datetime as dt

from pyspark.sql import functions as F

from cohortkit.functions.text import safe_number
from cohortkit.operators.picks import first_by, first_value_many, max_at_first, max_at_first_many

T0 = dt.datetime(2020, 1, 1, 8)
T1 = dt.datetime(2020, 1, 1, 9)


def test_max_at_first_ties_and_nulls(spark):
    # first_tie: two values at the earliest time, one NULL
    df = spark.createDataFrame([
        (1, T0, 5.0), (1, T0, 7.0), (1, T0, None), (1, T1, 99.0),
        (2, T0, None), (2, T1, 3.0),            # only NULL at the earliest time -> NULL
        (3, None, 50.0), (3, T1, 4.0),          # NULL time comes last
    ], "id int, t timestamp_ntz, v double")
    got = {r.id: r.v for r in max_at_first(df, "id", "t", "v").collect()}
    assert got == {1: 7.0, 2: None, 3: 4.0}


def test_first_by_takes_earlier_row_on_tie(spark):
    df = spark.createDataFrame([
        (1, T0, 2, 5.0), (1, T0, 1, None), (1, T1, 0, 9.0),
        (2, None, 0, 1.0), (2, T1, 5, 2.0),
    ], "id int, t timestamp_ntz, seq int, v double")
    got = {r.id: r.v for r in first_by(df, "id", ["t", "seq"]).collect()}
    assert got == {1: None, 2: 2.0}         # first row may carry a NULL value


def test_text_numbers(spark):
    df = spark.createDataFrame([(1, T0, "9"), (1, T0, "10"), (1, T0, "x"), (1, T0, " 12 ")],
                               "id int, t timestamp_ntz, v string")
    assert max_at_first(df, "id", "t", "v").first().v == "x"          # text maximum
    digits = df.filter(F.col("v").isin("9", "10"))
    assert max_at_first(digits, "id", "t", "v").first().v == "9"      # "9" > "10" as text
    num = df.withColumn("v", safe_number("v"))
    assert max_at_first(num, "id", "t", "v").first().v == 12.0        # bad text -> NULL


def test_many_equals_single(spark):
    rows = [(i % 7, dt.datetime(2020, 1, 1) + dt.timedelta(hours=(i * 13) % 5), float(i % 11), "ab"[i % 2])
            for i in range(200)]
    df = spark.createDataFrame(rows, "id int, t timestamp_ntz, v double, kind string")
    many = max_at_first_many(df, "id", "t", {"a": ("v", F.col("kind") == "a"), "b": ("v", F.col("kind") == "b")})
    one_a = {r.id: r.v for r in max_at_first(df.filter("kind = 'a'"), "id", "t", "v").collect()}
    assert {r.id: r.a for r in many.collect()} == one_a
    firsts = first_value_many(df.withColumn("seq", F.monotonically_increasing_id()), "id", ["t", "v"],
                              {"a": ("v", F.col("kind") == "a")})
    brute = {}
    for i, t, v, k in sorted(rows, key=lambda r: (r[1], r[2])):
        if k == "a":
            brute.setdefault(i, v)
    assert {r.id: r.a for r in firsts.collect()} == brute
