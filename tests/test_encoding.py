import pytest

from innlake.operators import conform, encoding
from innlake.operators.splitting import quarter_slice, quarter_slice_literal
from innlake.schemas import (
    BOOKINGS, CANCEL_PREDICTORS, CANCEL_TABLE, MONTHLY, ONE_HOT, PRICE_PREDICTORS, PRICE_TABLE,
    TEMPLATE, indicators,
)
from tests.conftest import booking_row, frame


def monthly_row(**changes):
    row = {name: booking_row().get(name) for name in MONTHLY.names}
    return {**row, "Booking_ID": "INN00154", **changes}


def test_template_sizes():
    assert (len(TEMPLATE), len(PRICE_PREDICTORS), len(CANCEL_PREDICTORS)) == (43, 41, 41)
    assert set(CANCEL_PREDICTORS) == set(TEMPLATE) - {"arrival_date_year", "Booking_ID"}


def test_one_hot_of_missing_and_unknown_is_all_zero(spark):
    df = spark.createDataFrame([("BB",), (None,), ("Undefined",)], "meal string")
    encoded = encoding.one_hot(df)
    assert encoded.columns == indicators("meal")
    assert [tuple(r) for r in encoded.collect()] == [(1, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0)]


def test_observed_levels_are_sorted_bounded_and_quoted(spark):
    df = spark.createDataFrame([("b'",), ("a",), (None,), ("b'",)], "x string")
    assert encoding.one_hot_observed(df, ["x"]).columns == ["x_a", "x_b'"]
    assert [tuple(r) for r in encoding.one_hot_observed(df, ["x"]).collect()] == [(0, 1), (1, 0), (0, 0), (0, 1)]
    with pytest.raises(encoding.TooManyLevelsError):
        encoding.one_hot_observed(df, ["x"], max_levels=1)


def test_unknown_levels_are_counted(spark):
    rows = [booking_row(reserved_room_type="P"), booking_row(market_segment="Undefined"),
            booking_row(meal=None), booking_row(reserved_room_type="P")]
    found = {(r.column_name, r.level): r.n_rows for r in encoding.unknown_levels(frame(spark, rows, BOOKINGS)).collect()}
    assert found == {("reserved_room_type", "P"): 2, ("market_segment", "Undefined"): 1}


def test_historical_cancel_is_raw_and_has_no_year(spark):
    rows = [booking_row(adr=400.4, children=None, meal="Undefined", required_car_parking_spaces=3)]
    out = conform.historical_cancel(frame(spark, rows, BOOKINGS))
    assert out.columns == list(CANCEL_TABLE)
    row = out.first()
    assert (row.adr, row.arrival_date_year, row.children, row.required_car_parking_spaces) == (400.4, 0, 0, 3)
    assert row.meal_SC == 0 and row.predicted == 0


def test_historical_price_recodes_and_drops(spark):
    rows = [booking_row(adr=76.5, meal="Undefined", required_car_parking_spaces=3), booking_row(adr=20.0)]
    out = conform.historical_price(frame(spark, rows, BOOKINGS))
    assert out.columns == list(PRICE_TABLE)
    (row,) = out.collect()
    assert (row.adr, row.meal_SC, row.required_car_parking_spaces, row.arrival_date_year) == (76, 1, 1, 2016)


def test_unknown_levels_may_be_kept_as_columns(spark):
    rows = [booking_row(reserved_room_type="P", market_segment="Undefined")]
    out = conform.historical_price(frame(spark, rows, BOOKINGS), keep_unknown=True)
    assert out.columns == list(PRICE_TABLE)[:-1] + ["market_segment_Undefined", "reserved_room_type_P", "predicted"]
    assert out.first()["reserved_room_type_P"] == 1


def test_monthly_features_keep_meal_and_parking(spark):
    df = frame(spark, [monthly_row(meal="SC", required_car_parking_spaces=2, adr=77.5)], MONTHLY)
    price, cancel = conform.monthly_price(df).first(), conform.monthly_cancel(df).first()
    assert (price.Booking_ID, price.adr, price.required_car_parking_spaces) == (154, 78, 2)
    assert (cancel.adr, cancel.is_canceled, cancel.arrival_date_year) == (78.0, 0, 2016)


def test_conform_is_idempotent_and_rows_have_one_level(spark):
    df = frame(spark, [booking_row(), booking_row(market_segment="Undefined")], BOOKINGS)
    once = conform.historical_price(df)
    assert once.collect() == conform.conform(once, PRICE_TABLE).collect()
    for row in once.collect():
        assert sum(row[c] for c in ONE_HOT if c.startswith("market_segment")) <= 1


def test_warehouse_names_round_trip(spark):
    df = conform.historical_price(frame(spark, [booking_row()], BOOKINGS))
    safe = conform.to_warehouse_names(df)
    assert "market_segment_Offline_TA_TO" in safe.columns
    assert conform.from_warehouse_names(safe).columns == df.columns


def test_quarter_predicates_differ_in_the_year(spark):
    months = [("July", 2016), ("August", 2017), ("September", 2016), ("September", 2017), ("May", 2017)]
    rows = [booking_row(Booking_ID=i, arrival_date_month=m, arrival_date_year=y) for i, (m, y) in enumerate(months)]
    df = conform.historical_price(frame(spark, rows, BOOKINGS))
    ids = lambda d: sorted(r.Booking_ID for r in d.collect())
    assert ids(quarter_slice_literal(df, 3, 2017)) == [0, 1, 3]
    assert ids(quarter_slice(df, 3, 2017)) == [1, 3]
