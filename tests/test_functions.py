import datetime as dt

from pyspark.sql import functions as F

from tidegate.functions import (as_amount, average_half_up, customer_segment, direction, exact, normalise_name,
                                parse_date, parse_timestamp, title_case)


def values(spark, texts, expression):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_dates_in_three_notations(spark):
    day = dt.date(2026, 8, 31)
    texts = ["2026-08-31", "2026/08/31", "31/08/2026", "2026-08-31 10:11:12", "bad", None, "2026-02-30", "31-08-2026"]
    assert values(spark, texts, parse_date("t")) == [day, day, day, None, None, None, None, None]


def test_dispatch_by_notation_equals_trying_all_formats(spark):
    texts = ["2026-08-31", "2026/08/31", "31/08/2026", "1/08/2026", "2026-8-31", "2026-08/31", "20260831", "",
             "  2026-08-31", "+12026-08-31", "2026/08-31", "12-31-2026", "31/08/26", "0000-01-01", "99/99/9999"]
    tried = F.coalesce(*[F.try_to_date("t", f) for f in ("yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy")])
    assert values(spark, texts, parse_date("t").cast("string")) == values(spark, texts, tried.cast("string"))
    formats = ["yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy"]
    tried = F.coalesce(*[F.try_to_timestamp(F.col("t"), F.lit(f + " HH:mm:ss")) for f in formats],
                       *[F.try_to_date("t", f).cast("timestamp") for f in formats])
    timed = [t + " 10:11:12" for t in texts] + texts + ["2026-08-31 25:00:00", "31/08/2026 1:02:03"]
    assert values(spark, timed, parse_timestamp("t").cast("string")) == values(spark, timed, tried.cast("string"))


def test_timestamps_keep_the_time_of_day(spark):
    texts = ["2026-08-31 10:11:12", "2026/08/31 10:11:12", "31/08/2026 10:11:12", "31/08/2026", "bad", None]
    got = values(spark, texts, parse_timestamp("t").cast("string"))
    assert got == ["2026-08-31 10:11:12"] * 3 + ["2026-08-31 00:00:00", None, None]


def test_names(spark):
    assert values(spark, ["  a b ", None], normalise_name("t")) == ["A B", None]
    assert values(spark, ["home APPLIANCES t-shirt", None], title_case("t")) == ["Home Appliances T-shirt", None]


def test_segments_have_strict_bounds(spark):
    rows = ["10000.01", "10000", "5000.01", "5000", "2000.01", "2000", None]
    got = values(spark, rows, customer_segment(F.col("t").cast("double")))
    assert got == ["Premium", "Gold", "Gold", "Silver", "Silver", "Bronze", "Bronze"]


def test_direction(spark):
    rows = spark.createDataFrame([(2, 1), (1, 2), (1, 1), (None, 1), (1, None)], "a int, b int")
    got = [r[0] for r in rows.select(direction(F.col("a"), F.col("b"))).collect()]
    assert got == ["UP", "DOWN", "SAME", "SAME", "SAME"]


def test_average_rounds_half_away_from_zero(spark):
    rows = spark.createDataFrame([("0.01", 2), ("-0.01", 2), ("0.01", 3), ("0.02", 3), ("3.01", 2), (None, 0)], "c string, n bigint")
    got = [r[0] for r in rows.select(average_half_up(exact(F.col("c")), F.col("n"))).collect()]
    assert got == [0.01, -0.01, 0.0, 0.01, 1.51, None]


def test_sums_of_small_fractions_and_no_numbers(spark):
    rows = spark.range(1000).select(F.lit(0.004).alias("a")).unionByName(
        spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "a double"))
    assert rows.agg(as_amount(F.sum(exact(F.col("a"))))).first()[0] == 4.0
