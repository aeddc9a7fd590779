import pytest
from pyspark.sql import functions as F

from innlake.learners.store import ModelStore
from innlake.operators import conform
from innlake.operators.cleaning import MissingRateError
from innlake.plans import jobs
from innlake.schemas import BOOKINGS, CANCEL_TABLE, LISTINGS, MONTHLY, MONTHLY_COLUMNS, PRICE_TABLE
from innlake.session import scratch_path
from innlake.sources import messages
from innlake.sources.booking_views import MONTH_SPAN, booking_messages, bookings, listings, monthly_bookings
from innlake.sources.csv_files import write_csv
from innlake.sources.tables import Table
from innlake.streaming.ingest import CANCEL_NAME, PRICE_NAME, REJECTED_NAME, append_month, start_ingest
from tests.conftest import booking_row, frame

SF = "/root/testdata/sf0.001"


def empty_tables(spark, warehouse):
    for name, template in ((PRICE_NAME, PRICE_TABLE), (CANCEL_NAME, CANCEL_TABLE)):
        shape = conform.conform(spark.createDataFrame([], MONTHLY), template)
        Table(spark, warehouse, name).create(conform.to_warehouse_names(shape).schema)


def unscored(df):
    return df


def test_history_month_retrain_and_score(spark):
    warehouse = scratch_path(spark, "warehouse")
    store = ModelStore(spark, scratch_path(spark, "models"))
    for _ in range(2):
        jobs.batch_etl(spark, bookings(spark, SF), listings(spark, SF), warehouse)
    before = Table(spark, warehouse, PRICE_NAME).scan().count()
    assert Table(spark, warehouse, jobs.BOOKINGS_NAME).scan().count() == bookings(spark, SF).count()
    promoted = jobs.retrain(
        spark, warehouse, store, 1997, 3, price_candidates=["random_forest", "gbt"],
        cancel_candidates=["random_forest", "knn"], rounds=5, trees=5, forest_depth=5)
    assert promoted["price"].metric > 0.4
    assert promoted["cancel"].metric > 0.5
    path = scratch_path(spark, "month")
    month = monthly_bookings(spark, SF).filter("arrival_date_year = 1997 and arrival_date_month = 'July'")
    write_csv(month, path)
    for _ in range(2):
        jobs.monthly_etl(spark, path, 1, warehouse, store)
    stored = Table(spark, warehouse, PRICE_NAME).scan()
    added = conform.monthly_price(month).count()
    assert added > 0 and stored.count() == before + added
    assert stored.filter("predicted > 0").count() == added
    classes = Table(spark, warehouse, CANCEL_NAME).batches().filter("batch_id = 1")
    assert classes.count() == added and classes.filter("predicted not in (0, 1)").count() == 0
    again = jobs.retrain(
        spark, warehouse, store, 1997, 3, scope="quarter", price_candidates=["linear"],
        cancel_candidates=["knn"])
    assert again["price"].version == 2 and again["cancel"].kind == "knn"
    jobs.monthly_etl(spark, path, 2, warehouse, store)
    assert Table(spark, warehouse, CANCEL_NAME).batches().filter("batch_id = 2").count() == added


def test_batch_load_from_csv_rejects_missing_rates(spark):
    paths = scratch_path(spark, "b"), scratch_path(spark, "l")
    write_csv(frame(spark, [booking_row(), booking_row(Booking_ID=2, adr=None)], BOOKINGS), paths[0])
    write_csv(frame(spark, [{**{f.name: None for f in LISTINGS}, "listing_id": 1}], LISTINGS), paths[1])
    with pytest.raises(MissingRateError):
        jobs.batch_etl_from_csv(spark, *paths, scratch_path(spark, "warehouse"), BOOKINGS)


def test_month_keeps_rows_without_rate_apart(spark):
    warehouse = scratch_path(spark, "warehouse")
    empty_tables(spark, warehouse)
    row = {**{n: booking_row().get(n) for n in MONTHLY_COLUMNS}, "Booking_ID": "INN00001"}
    rows = frame(spark, [row, {**row, "Booking_ID": "INN00002", "adr": None}], MONTHLY)
    append_month(rows, 1, "files", warehouse, unscored, unscored)
    assert [r.Booking_ID for r in Table(spark, warehouse, PRICE_NAME).scan().collect()] == [1]
    assert [r.Booking_ID for r in Table(spark, warehouse, REJECTED_NAME).scan().collect()] == ["INN00002"]


def test_stream_equals_batch_after_a_failure_and_a_restart(spark):
    root = scratch_path(spark, "stream")
    warehouse, source = f"{root}/warehouse", f"{root}/messages"
    empty_tables(spark, warehouse)
    feed = booking_messages(spark, SF).persist()
    cut = (1997 * 12 + 3) * MONTH_SPAN + 700
    failures = [True]

    def flaky(df):
        if failures:
            failures.pop()
            raise RuntimeError("lost")
        return df

    def run(price):
        stream = messages.message_stream(spark, "parquet", path=source)
        start_ingest(stream, root, warehouse, price, unscored, block_span=MONTH_SPAN).awaitTermination()

    messages.write_messages(feed.filter(F.col("offset") < cut), "parquet", path=source)
    with pytest.raises(Exception):
        run(flaky)
    run(flaky)
    messages.write_messages(feed.filter(F.col("offset") >= cut), "parquet", path=source)
    for _ in range(2):
        run(flaky)
    expected = conform.monthly_price(monthly_bookings(spark, SF))
    stored = conform.from_warehouse_names(Table(spark, warehouse, PRICE_NAME).scan())
    assert stored.count() == expected.count()
    assert stored.exceptAll(expected.select(*stored.columns)).isEmpty()
    assert Table(spark, warehouse, CANCEL_NAME).scan().count() == expected.count()
