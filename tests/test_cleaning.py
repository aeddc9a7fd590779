import pytest
from pyspark.sql import functions as F

from innlake.functions import scalars
from innlake.operators import cleaning
from innlake.schemas import BOOKINGS, LISTINGS
from tests.conftest import booking_row, frame


def column(df, name):
    return [r[name] for r in df.orderBy("Booking_ID").select(name).collect()]


def test_rate_filter_runs_before_half_even_rounding(spark):
    rates = [50.0, 50.4, 76.5, 77.5, 400.0, 400.4]
    rows = [booking_row(Booking_ID=i, adr=r) for i, r in enumerate(rates)]
    cleaned = cleaning.clean_bookings(frame(spark, rows, BOOKINGS), recode=False, rate_filter=True)
    assert column(cleaned, "adr") == [50, 76, 78, 400]


def test_missing_rate_is_reported_not_dropped(spark):
    df = frame(spark, [booking_row(adr=None), booking_row(Booking_ID=2)], BOOKINGS)
    assert column(cleaning.missing_rates(df), "Booking_ID") == [1]
    with pytest.raises(cleaning.MissingRateError):
        cleaning.require_rates(df)


def test_clamp_keeps_missing(spark):
    values = [None, 0, 1, 3]
    rows = [booking_row(Booking_ID=i, required_car_parking_spaces=v) for i, v in enumerate(values)]
    clamped = cleaning.clamp_parking(frame(spark, rows, BOOKINGS))
    assert column(clamped, "required_car_parking_spaces") == [None, 0, 1, 1]


def test_recode_and_fills(spark):
    rows = [booking_row(Booking_ID=1, meal="Undefined", children=None, country=None, agent="9"),
            booking_row(Booking_ID=2, meal=None, company="4")]
    df = frame(spark, rows, BOOKINGS)
    assert column(cleaning.recode_meal(df), "meal") == ["SC", None]
    filled = cleaning.fill_missing(df)
    assert column(filled, "children") == [0, 0]
    assert column(filled, "country") == ["Unknown", "PRT"]
    labelled = cleaning.label_presence(df)
    assert column(labelled, "agent") == ["Agent", "No Agent"]
    assert column(labelled, "company") == ["No Company", "Corporate"]


def test_listing_filter_keeps_missing_values(spark):
    base = {f.name: None for f in LISTINGS}
    rows = [
        {**base, "listing_id": 1},
        {**base, "listing_id": 2, "accommodates": 10, "bedrooms": 5, "minstay": 5},
        {**base, "listing_id": 3, "accommodates": 11},
        {**base, "listing_id": 4, "bedrooms": 6},
        {**base, "listing_id": 5, "minstay": 6},
    ]
    kept = cleaning.clean_listings(frame(spark, rows, LISTINGS))
    assert sorted(r.listing_id for r in kept.collect()) == [1, 2]


def test_rate_bands_are_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (49, 50, 75, 76, 100, 400, 401)], "adr int")
    bands = [r[0] for r in df.select(scalars.rate_category(F.col("adr"))).collect()]
    assert bands == [None, 1, 1, 2, 2, 14, None]


def test_period_labels_and_roll_over(spark):
    df = spark.createDataFrame([("2017-7.csv", "Q32017"), ("2018-12.csv", "Q12018")], "m string, q string")
    year, month = scalars.month_period(F.col("m"))
    q_year, quarter = scalars.quarter_period(F.col("q"))
    following = scalars.next_month(year, month)
    rows = df.select(year, month, q_year, quarter, F.year(following), F.month(following)).collect()
    assert [tuple(r) for r in rows] == [(2017, 7, 2017, 3, 2017, 8), (2018, 12, 2018, 1, 2019, 1)]


def test_booking_number(spark):
    df = spark.createDataFrame([("INN00154",), ("INN123456789012",)], "id string")
    assert [r[0] for r in df.select(scalars.booking_number(F.col("id"))).collect()] == [154, 123456789012]
