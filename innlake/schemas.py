"""Table schemas, vocabularies and feature lists of the hotel-booking model.

The literal lists in the first block are fixed values: they have to equal the
published data model for results to match. Everything below the block is
derived from them.
"""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
NUMERIC_FEATURES = [
    "lead_time", "adr", "arrival_date_year", "stays_in_weekend_nights",
    "stays_in_week_nights", "adults", "children", "is_repeated_guest",
    "previous_cancellations", "previous_bookings_not_canceled",
    "required_car_parking_spaces", "total_of_special_requests",
]
MARKET_SEGMENTS = [
    "Aviation", "Complementary", "Corporate", "Direct", "Groups",
    "Offline TA/TO", "Online TA",
]
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August",
    "September", "October", "November", "December",
]
MEALS = ["BB", "FB", "HB", "SC"]
ROOM_TYPES = ["A", "B", "C", "D", "E", "F", "G"]
BOOKING_COLUMNS = {
    "Booking_ID": "bigint", "hotel": "string", "is_canceled": "int",
    "lead_time": "int", "arrival_date_year": "int",
    "arrival_date_month": "string", "arrival_date_week_number": "int",
    "arrival_month": "string", "arrival_date_day_of_month": "int",
    "stays_in_weekend_nights": "int", "stays_in_week_nights": "int",
    "adults": "int", "children": "int", "babies": "int", "meal": "string",
    "country": "string", "market_segment": "string",
    "distribution_channel": "string", "is_repeated_guest": "int",
    "previous_cancellations": "int", "previous_bookings_not_canceled": "int",
    "reserved_room_type": "string", "assigned_room_type": "string",
    "booking_changes": "int", "deposit_type": "string", "agent": "string",
    "company": "string", "days_in_waiting_list": "int",
    "customer_type": "string", "adr": "double",
    "required_car_parking_spaces": "int", "total_of_special_requests": "int",
    "reservation_status": "string", "reservation_status_date": "string",
}
MONTHLY_COLUMNS = {
    "Booking_ID": "string", "adults": "int", "children": "int",
    "stays_in_weekend_nights": "int", "stays_in_week_nights": "int",
    "meal": "string", "required_car_parking_spaces": "int",
    "reserved_room_type": "string", "lead_time": "int",
    "arrival_date_year": "int", "arrival_date_month": "string",
    "arrival_date_day_of_month": "int", "market_segment": "string",
    "is_repeated_guest": "int", "previous_cancellations": "int",
    "previous_bookings_not_canceled": "int", "adr": "double",
    "total_of_special_requests": "int", "is_canceled": "int",
}
LISTING_COLUMNS = {
    "listing_id": "bigint", "host_id": "bigint", "room_type": "string",
    "neighbourhood": "string", "reviews": "bigint",
    "overall_satisfaction": "double", "accommodates": "bigint",
    "bedrooms": "bigint", "price": "double", "minstay": "bigint",
    "latitude": "double", "longitude": "double", "date": "date",
}
# Columns the notebooks discard before modelling.
CANCEL_UNUSED = [
    "arrival_date_week_number", "babies", "country", "distribution_channel",
    "assigned_room_type", "booking_changes", "deposit_type", "agent",
    "company", "days_in_waiting_list", "customer_type", "reservation_status",
    "reservation_status_date", "hotel",
]
PRICE_UNUSED = CANCEL_UNUSED + ["is_canceled", "arrival_date_day_of_month"]
WAREHOUSE_RENAMES = {
    "market_segment_Offline TA/TO": "market_segment_Offline_TA_TO",
    "market_segment_Online TA": "market_segment_Online_TA",
}
# ----------------------------------------------------------------------------

VOCABULARY = {
    "market_segment": MARKET_SEGMENTS,
    "arrival_date_month": sorted(MONTHS),
    "meal": MEALS,
    "reserved_room_type": ROOM_TYPES,
}


def indicator(column: str, level: str) -> str:
    """Name of the 0/1 column of one category level."""
    return f"{column}_{level}"


def indicators(column: str) -> list[str]:
    return [indicator(column, level) for level in VOCABULARY[column]]


ONE_HOT = [name for column in VOCABULARY for name in indicators(column)]
TEMPLATE = NUMERIC_FEATURES + ONE_HOT + ["Booking_ID"]

PRICE_PREDICTORS = [c for c in TEMPLATE if c not in ("adr", "Booking_ID")]
CANCEL_PREDICTORS = (
    ["is_repeated_guest"]
    + [i for c in ("arrival_date_month", "meal", "reserved_room_type", "market_segment")
       for i in indicators(c)]
    + ["lead_time", "stays_in_weekend_nights", "stays_in_week_nights", "adults",
       "children", "previous_cancellations", "previous_bookings_not_canceled",
       "adr", "required_car_parking_spaces", "total_of_special_requests"]
)

# Historical inputs of the two feature tables; the cancellation one carries no
# arrival year (conform fills it with 0) but does carry its target.
PRICE_INPUTS = (
    ["Booking_ID"] + NUMERIC_FEATURES + list(VOCABULARY)
)
CANCEL_INPUTS = (
    [c for c in PRICE_INPUTS if c != "arrival_date_year"] + ["is_canceled"]
)


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "date": T.DateType(), "binary": T.BinaryType(),
}


def struct(columns: dict[str, str], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([
        T.StructField(name, _TYPES[kind], name not in required)
        for name, kind in columns.items()
    ])


def _feature_columns(adr: str) -> dict[str, str]:
    types = {c: "int" for c in NUMERIC_FEATURES + ONE_HOT}
    types["adr"] = adr
    return {**types, "Booking_ID": "bigint"}


# One schema per table, named after the data (never the declared lists, which
# disagree with it). The cancellation table keeps the raw rate, hence double.
PRICE_TABLE = {**_feature_columns("int"), "predicted": "double"}
CANCEL_TABLE = {**_feature_columns("double"), "is_canceled": "int", "predicted": "int"}

BOOKINGS = struct(BOOKING_COLUMNS)
MONTHLY = struct(MONTHLY_COLUMNS)
LISTINGS = struct(LISTING_COLUMNS, required=("listing_id",))
MESSAGES = struct({"topic": "string", "partition": "int", "offset": "bigint", "value": "binary"})
