import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import columns as C


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_business_days_brute_force(spark):
    base = dt.date(2023, 12, 20)
    spans = [(base + dt.timedelta(days=a), base + dt.timedelta(days=a + n)) for a in range(9) for n in (-1, 0, 1, 5, 6, 13, 20)]
    holidays = {dt.date(2023, 12, 25), dt.date(2023, 12, 30)}       # the second is a Saturday
    df = spark.createDataFrame(spans, "s date, e date").select("s", "e", C.business_days(F.col("s"), F.col("e"), [str(h) for h in holidays]).alias("n"))
    for r in df.collect():
        days = [r.s + dt.timedelta(days=i) for i in range((r.e - r.s).days + 1)]
        assert r.n == sum(d.weekday() < 5 and d not in holidays for d in days), (r.s, r.e)


@pytest.mark.parametrize("text,want", [("2024-01-15", "2024-01-15"), ("2024/01/15", "2024-01-15"), ("15-01-2024", "2024-01-15"), ("garbage", None), (None, None)])
def test_parse_date(spark, text, want):
    assert one(spark, C.parse_date(F.lit(text).cast("string")).cast("string")) == want


def test_ratios_guard_zero(spark):
    assert one(spark, C.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, C.pct(F.lit(1), F.lit(8))) == 12.5
    assert one(spark, C.growth(F.lit(5), F.lit(None).cast("int"))) is None


def test_text_helpers(spark):
    assert one(spark, C.xml_row("e", name=F.lit("a<b & c"))) == "<e><name>a&lt;b &amp; c</name></e>"
    assert one(spark, C.mask_digits(F.lit("123-45-6789"))) == "***-**-6789"
    assert one(spark, C.bands(F.lit(10), (10, "low"), (20, "mid"), other="high")) == "mid"
    assert one(spark, C.bands(F.lit(None).cast("int"), (10, "low"), other="high")) is None
    assert one(spark, C.grid_cell(F.lit(-0.5), F.lit(10.0), 1.0)) == "-1:10"


def test_haversine_quarter_circle(spark):
    assert one(spark, C.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))) == pytest.approx(6371.0 * 3.141592653589793 / 2)
    assert one(spark, C.haversine_km(F.lit(10.0), F.lit(20.0), F.lit(10.0), F.lit(20.0))) == 0
