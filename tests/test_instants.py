import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidewire.functions.instants import epoch_bigint_ms, instants_of, to_instants


def ms(*args, zone="UTC", fold=0):
    return int(datetime(*args, tzinfo=ZoneInfo(zone), fold=fold).timestamp() * 1000)


CASES = [
    ("2024-11-03T15:50:35Z", ms(2024, 11, 3, 15, 50, 35)), ("2024-11-03t15:50:35.5z", ms(2024, 11, 3, 15, 50, 35) + 500), ("20250309T080229Z", ms(2025, 3, 9, 8, 2, 29)),
    ("2024-07-19T13:43:33+01:00", ms(2024, 7, 19, 12, 43, 33)), ("2024-12-24 04:00:53+09", ms(2024, 12, 23, 19, 0, 53)), ("2025-08-08T00:51:53.829999999+10:00", ms(2025, 8, 7, 14, 51, 53) + 829),
    ("Mon, 10 Feb 2025 20:13:16 GMT", ms(2025, 2, 10, 20, 13, 16)), ("13 Jun 25 17:52:09 -0330", ms(2025, 6, 13, 21, 22, 9)), ("Mar 10, 2024 3:48 AM PDT", ms(2024, 3, 10, 10, 48)),
    ("1744207455", 1744207455000), ("1733810328172", 1733810328172), ("1735448413000795", 1735448413000), ("1760323825688722918", 1760323825688), (" 1744207455 ", 1744207455000),
    ("12", None), ("9999999999999", None), ("-1744207455", None), ("soon", None), ("", None), (None, None), ("2025-13-45T99:00:00Z", None), ("0000-00-00 00:00:00", None), ("2024-01-01 10:00 XYZ", None),
    ("2025-02-30", None), ("\t2024-08-19\n", ms(2024, 8, 19)), ("2025-08-22 06:47:23,574", ms(2025, 8, 22, 6, 47, 23) + 574), ("March 18, 2025 at 12:05 AM", ms(2025, 3, 18, 0, 5)),
    ("22. Juni 2025, 00:06 Uhr", ms(2025, 6, 22, 0, 6)), ("3. März 2025, 12:20 Uhr", ms(2025, 3, 3, 12, 20)), ("2025년 10월 3일 오후 12:05", ms(2025, 10, 3, 12, 5)), ("2025년 10월 3일 오전 12:05", ms(2025, 10, 3, 0, 5)),
]


def test_notations(spark):
    assert list(zip([c[0] for c in CASES], instants_of(spark, CASES))) == CASES


def test_day_order(spark):
    assert instants_of(spark, [("03/04/2025 10:00",)], day_first=True) == [ms(2025, 4, 3, 10)]
    assert instants_of(spark, [("03/04/2025 10:00",)], day_first=False) == [ms(2025, 3, 4, 10)]
    assert instants_of(spark, [("13/04/2025 10:00",)], day_first=False) == [None]


def test_daylight_saving(spark):
    got = instants_of(spark, [("2024-10-27 01:30",), ("2024-10-27 00:30",), ("2025-03-30 01:30",), ("2025-03-30",), ("2025-03-30 02:00",)], "Europe/London")
    assert got == [ms(2024, 10, 27, 1, 30, zone="Europe/London", fold=0), ms(2024, 10, 27, 0, 30, zone="Europe/London"), None, ms(2025, 3, 30), ms(2025, 3, 30, 1)]
    # a day that has no midnight starts at its first instant
    assert instants_of(spark, [("2018-11-04",)], "America/Sao_Paulo") == [ms(2018, 11, 4, 3)]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "Australia/Sydney", "Asia/Seoul"])
def test_every_hour_of_two_years_against_zoneinfo(spark, zone):
    from datetime import timedelta

    start = datetime(2024, 1, 1, 0, 30)
    naive = [start + timedelta(hours=h) for h in range(0, 24 * 730, 7)] + [datetime(y, m, d, h, 30) for y, m, d in ((2024, 3, 10), (2024, 11, 3), (2024, 4, 7), (2024, 10, 6)) for h in range(24)]
    want = []
    for n in naive:
        first = n.replace(tzinfo=ZoneInfo(zone))
        exists = first.astimezone(timezone.utc).astimezone(ZoneInfo(zone)).replace(tzinfo=None) == n
        want.append(int(first.timestamp() * 1000) if exists else None)
    assert instants_of(spark, [(n.strftime("%Y-%m-%d %H:%M:%S"),) for n in naive], zone) == want


def test_unknown_zone_null_zone_and_extra_columns(spark):
    df = spark.createDataFrame([("2024-01-01 10:00", None, 1), ("2024-01-01 10:00", "No/Where", 2), ("2024-01-01 10:00Z", None, 3)], "t string, z string, `published` int")
    got = {r.published: (r.published_ms, r.published_ms_status) for r in to_instants(df, "t", "z", None).collect()}
    assert got == {1: (None, "unknown"), 2: (None, "unknown"), 3: (ms(2024, 1, 1, 10), "offset")}
    assert to_instants(df.limit(0), "t", "z", None).count() == 0


def test_bigint_units(spark):
    values = [None, 0, -1, 946_684_799, 946_684_800, 4_102_444_799, 4_102_444_800, 1760313627740, 1760314726554625, 1760323825688722918, 9_999_999_999_999]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "n bigint").select(epoch_bigint_ms(F.col("n"))).collect()]
    assert got == [None, None, None, None, 946_684_800_000, 4_102_444_799_000, None, 1760313627740, 1760314726554, 1760323825688, None]


@pytest.mark.parametrize("zone", ["America/New_York", "Africa/Casablanca", "Europe/Berlin", "Australia/Lord_Howe"])
def test_any_year_against_zoneinfo(spark, zone):
    r = random.Random(zone)
    naive = [datetime(y, r.randrange(1, 13), r.randrange(1, 29), r.randrange(24), 30) for y in [3, 1000, *range(1790, 2120, 3), *range(2120, 9999, 37), 2499, 2500, 2501, 9998]]
    naive += [datetime(1989, 6, 1, 10), datetime(1985, 3, 1), datetime(2150, 1, 1, 10)]
    want = [(n.replace(tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)) - ZoneInfo(zone).utcoffset(n) for n in naive]
    assert instants_of(spark, [(n.isoformat(" ").rjust(19, "0"),) for n in naive], zone) == [w // timedelta(milliseconds=1) for w in want]
