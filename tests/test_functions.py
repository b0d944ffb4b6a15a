import calendar
import random

import pytest
from pyspark.sql import functions as F

from tickbars.functions import text, times, values


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()[0]


@pytest.mark.parametrize(
    "date, time, expected",
    [
        ("2024-01-01", "1000000000", 1_000_000_000),
        ("anything", "0042", 42),
        ("2024-01-01", "09:30:00", 1704101400_000000000),
        ("20240101", "09:30:00", 1704101400_000000000),
        ("20240101", "9:30:00.5", 1704101400_500000000),
        ("2024-01-01", "09:30:00.123456789123", 1704101400_123456789),
        ("2024-01-01", "09:30:00.", 1704101400_000000000),
        ("2024-01-01", "24:00:61", calendar.timegm((2024, 1, 1, 24, 0, 61)) * 10**9),
        ("2024-02-31", "00:00:00", calendar.timegm((2024, 2, 31, 0, 0, 0)) * 10**9),
        ("1969-12-31", "23:59:59.5", -500000000),
        ("2024-13-01", "09:30:00", None),
        ("2024-01-01", "09:30", None),
        ("2024-01-01", "09:30:xx", None),
        ("2024-01-01", "09:30:00.12x", None),
        ("2024-01-01", "", None),
        ("", "09:30:00", None),
        ("2024-01-01", None, None),
    ],
)
def test_parse_ts_ns(spark, date, time, expected):
    assert one(spark, times.parse_ts_ns(F.lit(date), F.lit(time))) == expected


def test_event_time_is_exact_and_whole_seconds(spark):
    column = times.event_time(F.lit(1704101400_999999999)).cast("string")
    assert one(spark, column) == "2024-01-01 09:30:00"


@pytest.mark.parametrize(
    "time, expected",
    [
        ("1672531200123", "2023-01-01 00:00:00.123"),
        ("2023-01-01T00:00:00", "2023-01-01 00:00:00"),
        ("2023-01-01 00:00:00.5", "2023-01-01 00:00:00.5"),
        ("half past nine", None),
    ],
)
def test_indicator_time(spark, time, expected):
    assert one(spark, times.indicator_time(F.lit(time)).cast("string")) == expected


@pytest.mark.parametrize(
    "given, expected",
    [("1.0", 1.0), (" 2 ", 2.0), ("1e3", 1000.0), ("1.5d", None), ("2f", None),
     ("x", None), ("", None), (None, None), ("inf", float("inf")), ("-3", -3.0)],
)
def test_to_number(spark, given, expected):
    assert one(spark, values.to_number(F.lit(given).cast("string"))) == expected


def python_amount(number):
    if number is None or number == 0:
        return "N/A"
    for bound, unit in ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K")):
        if abs(number) >= bound:
            return f"${number / bound:.2f}{unit}"
    return f"${number:,.2f}"


def test_texts_round_as_python_does(spark):
    rng = random.Random(7)
    numbers = [k / 8 for k in range(-100, 100)]
    numbers += [k / 1000 for k in range(-3000, 3000)]
    numbers += [rng.uniform(-1e7, 1e7) for _ in range(3000)]
    numbers += [rng.random() * 10 ** rng.randint(-6, 11) for _ in range(3000)]
    numbers += [-0.0, -0.001, 999.994, 999.995, 999.999, -999.999, 1.005, 2.675, 999999.0]
    numbers += [float("inf"), float("-inf")]
    rows = (
        spark.createDataFrame([(x,) for x in numbers], "x double")
        .select(
            "x",
            text.two_decimals(F.col("x")).alias("plain"),
            text.amount_text(F.col("x")).alias("amount"),
            text.percent_text(F.col("x")).alias("percent"),
        )
        .collect()
    )
    for row in rows:
        assert row.plain == f"{row.x:.2f}"
        assert row.amount == python_amount(row.x)
        assert row.percent == f"{row.x * 100:.2f}%"


def test_missing_texts(spark):
    nothing, nan = F.lit(None).cast("double"), F.lit(float("nan"))
    assert one(spark, text.amount_text(nothing)) == "N/A"
    assert one(spark, text.amount_text(nan)) == "N/A"
    assert one(spark, text.amount_text(F.lit(5e6), " USD")) == "$5.00M USD"
    assert one(spark, text.percent_text(nothing)) == "N/A"
    assert one(spark, text.percent_text(nan)) == "N/A"


def test_shorten_counts_characters(spark):
    for given, expected in [
        (None, ""),
        ("é" * 260, "é" * 260),
        ("é" * 261, "é" * 260 + "..."),
        ("😀" * 300, "😀" * 260 + "..."),
    ]:
        assert one(spark, text.shorten(F.lit(given).cast("string"))) == expected


def test_rating_band_bounds(spark):
    ratings = [1.0, 1.5, 1.51, 2.5, 3.5, 4.5, 4.51, None, float("nan")]
    names = ["Strong Buy", "Strong Buy", "Buy", "Buy", "Hold", "Sell"] + ["Strong Sell"] * 3
    df = spark.createDataFrame([(i, r) for i, r in enumerate(ratings)], "i int, r double")
    rows = df.select("i", values.rating_band(F.col("r")).alias("b")).orderBy("i").collect()
    assert [r.b for r in rows] == names


def test_percent_of_zero_is_null(spark):
    assert one(spark, values.percent_of(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, values.target_upside(F.lit(110.0), F.lit(100.0))) == 10.0
