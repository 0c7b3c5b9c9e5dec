import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions import active_flag, day_key, money_text, parse_date, safe_number


def _one(spark, col, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_active_flag_tokens(spark):
    values = ["1", "true", " TRUE", " yes", "Y", "t", "0", "false", "no", "n", "F", "2", "+3", "-0", "1.0", "maybe", "", None]
    got = _one(spark, active_flag("v"), values)
    assert got == [True, True, True, True, True, True, False, False, False, False, False, True, True, False, False, False, False, False]


def test_safe_number_and_default(spark):
    assert _one(spark, safe_number("v"), ["1.50", "abc", "", None, "2"]) == [Decimal("1.5000"), None, None, None, Decimal("2.0000")]
    assert _one(spark, safe_number("v", default=0.0), ["abc", "3"]) == [Decimal("0.0000"), Decimal("3.0000")]


def test_parse_date_layouts(spark):
    values = ["2025-03-01 10:00:00", "2025-03-01", "2025-03-01T10:00:00", "2025-03-01T10:00:00Z", "03/01/2025", "2025/03/01", "garbage", None]
    d = dt.date(2025, 3, 1)
    assert _one(spark, parse_date("v"), values) == [d, d, d, d, d, d, None, None]


def test_money_text_and_day_key(spark):
    got = _one(spark, money_text("v"), [0.125, 2.0, -1.005, None], "v double")
    assert got == ["0.13", "2.00", "-1.01", None]
    got = _one(spark, day_key(F.col("v")), [dt.date(2025, 3, 1)], "v date")
    assert got == ["20250301"]
