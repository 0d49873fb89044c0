import random
import struct
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clock, ids, labels


def test_event_time_equals_division_and_cast(spark):
    """From 2005 to 2038; outside, the division is a microsecond short for some values."""
    random.seed(1)
    values = [random.randrange(1_126_000_000_000, 2_147_483_648_000) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "t bigint")
    different = df.where(
        clock.event_time(F.col("t")) != (F.col("t") / 1000).cast("timestamp")
    )
    assert different.count() == 0


def test_stored_times(spark):
    at = F.timestamp_millis(F.lit(1714567890037))
    row = spark.range(1).select(
        clock.whole_second_millis(at), clock.exact_millis(at), clock.clock_text(at),
        ids.event_time_id(at), ids.event_time_id(F.timestamp_millis(F.lit(1714567890100))),
    ).first()
    assert tuple(row) == (
        1714567890000, 1714567890037, "12:51:30",
        "2024-05-01 12:51:30.037", "2024-05-01 12:51:30.1",
    )


def test_instant_does_not_depend_on_zones(spark):
    naive, aware = datetime(2024, 1, 2, 3, 4, 5, 6), datetime(2024, 1, 2, tzinfo=timezone.utc)
    row = spark.range(1).select(
        F.unix_micros(clock.instant(naive)), F.unix_micros(clock.instant(aware))
    ).first()
    assert row[0] == 1704164645000006
    assert row[1] == 1704153600000000


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_partition_keys_agree_between_spark_and_python(spark, zone):
    moments = [
        datetime(2024, 2, 3, 4, 59, 59, 999999), datetime(2024, 3, 10, 7, 30),
        datetime(2024, 11, 3, 5, 30), datetime(1969, 12, 31, 23, 59, 59), datetime(2024, 2, 29),
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for moment in moments:
            for pattern, strftime in ((clock.HOURLY, "%Y-%m-%d-%H"), (clock.DAILY, "%Y-%m-%d")):
                key = clock.partition_key(clock.instant(moment), pattern)
                made = spark.range(1).select(key).first()[0]
                assert made == clock.partition_key_of(moment, pattern) == moment.strftime(strftime)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stable_id_keeps_nulls_apart(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a", "b", ""), (None, "a", "b"), ("ab", "", "")]
    df = spark.createDataFrame(rows * 2, "x string, y string, z string")
    made = df.select(ids.stable_id(F.col("x"), F.col("y"), F.col("z")).alias("id"))
    assert made.distinct().count() == len(rows)


def test_random_ids_differ(spark):
    made = spark.range(1000).select(ids.random_id().alias("id"))
    assert made.distinct().count() == 1000


def doubles():
    random.seed(2)
    fixed = [0.0, -0.0, 0.125, 0.375, 2.675, 1.005, 1e7, 12345678.9, 1e15, 1e16, 1.5e16, 1e22]
    fixed += [0.001, 1e-4, 0.00012345, 9.9e-5, 1e-5, 1.25e-7, -1.5, -0.001, 1234567890123.45]
    fixed += [float("nan"), float("inf"), float("-inf"), 1.5e-300]
    cents = [random.randrange(0, 10**9) / 100 for _ in range(1500)]
    fine = [round(random.random() * 10 ** random.randrange(-3, 6), 8) for _ in range(1500)]
    halves = [random.randrange(0, 10**6) / 8 for _ in range(500)]
    return fixed + cents + fine + halves


def test_price_labels_equal_python_formatting(spark):
    df = spark.createDataFrame([(p,) for p in doubles()], "p double")
    made = df.select(
        "p",
        labels.price_label(F.col("p")).alias("rounded"),
        labels.price_label(F.col("p"), two_decimals=False).alias("full"),
    )
    for row in made.collect():
        assert row.rounded == f"${row.p:.2f}", struct.pack(">d", row.p).hex()
        assert row.full == f"${row.p}"


def test_labels_of_missing_prices(spark):
    df = spark.createDataFrame([("A", None)], "s string, p double")
    row = df.select(labels.caption(F.col("s")), labels.price_label(F.col("p"), False)).first()
    assert tuple(row) == ("Latest Price for A", None)
