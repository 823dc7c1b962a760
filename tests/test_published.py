from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidewire.functions.instants import parse_published_at_ms
from tidewire.operators.events import build_events
from tidewire.plans.domain import CAPS, ingest_run
from tidewire.plans.ingest import Run, ingest
from tidewire.plans.texts import published_at_parse, written_zone_times
from tidewire.session import read

SMALL = "/root/testdata/sf0.001"


def ms(*args, offset=0):
    return int(datetime(*args, tzinfo=timezone.utc).timestamp() * 1000) - offset * 60_000


CASES = [
    ("1744207455", 1744207455), ("+5", 5), ("-7", -7), ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), (" 5", None), ("5\n", None),
    ("Mon, 06 Jan 2025 10:00:00 GMT", ms(2025, 1, 6, 10)), ("  mon, 6 JAN 2025 10:00 ut", ms(2025, 1, 6, 10)), ("Tue, 06 Jan 2025 10:00:00 GMT", None), ("Mon 06 Jan 2025 10:00:00 GMT", None),
    ("13 Jun 25 17:52:09 +0200", ms(2025, 6, 13, 17, 52, 9, offset=120)), ("09 Oct 74 17:42:51 -0330", ms(1974, 10, 9, 17, 42, 51, offset=-210)), ("1 Jan 124 00:00 Z", ms(2024, 1, 1)),
    ("11 Sep 2001 09:45:00 EST", ms(2001, 9, 11, 9, 45, offset=-300)), ("11 Sep 2001 09:45:00 PDT", ms(2001, 9, 11, 9, 45, offset=-420)), ("11 Sep 2001 09:45:00 K", ms(2001, 9, 11, 9, 45)), ("11 Sep 2001 09:45:00 J", None), ("11 Sep 2001 09:45:00 UTC", None),
    ("11 Sep 2001 09:45:00 +0000 (a (b\\) c)) (d)", ms(2001, 9, 11, 9, 45)), ("11 Sep 2001 09:45:00 +0000 (a", None), ("11 Sep 2001 9:45:00 GMT", None), ("11 Sep 2001 09:45:00", None), ("11 Sep 2001 09:45:00 +0890", None), ("11 Sep 2001 09:45:00 +2400", None), ("30 Feb 2015 17:35:20 GMT", None),
    ("2024-11-03T15:50:35Z", ms(2024, 11, 3, 15, 50, 35)), ("2024-11-03t15:50:35.5z", ms(2024, 11, 3, 15, 50, 35) + 500), ("2025-10-13 08:35:46+05:30", ms(2025, 10, 13, 8, 35, 46, offset=330)), ("1969-12-31T23:59:59.9999999999Z", -1), ("2016-12-31T23:59:60.25Z", ms(2017, 1, 1) + 250), ("2016-12-31T23:59:61Z", None), ("2016-12-31T24:00:00Z", None),
    ("2025-10-13T08:35:46−05:30", ms(2025, 10, 13, 8, 35, 46, offset=-330)), ("2025-10-13T08:35:46+0530", None), ("2025-10-13T08:35:46", None), ("2025-10-13", None), ("2025-10-13T08:35Z", None), ("2025-13-13T08:35:00Z", None), ("2024-11-03T15:50:35Z\n", None),
    ("soon", None), ("", None), (None, None),
]


def test_published_at(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, t string")
    got = [r[0] for r in df.select("i", parse_published_at_ms(F.col("t")).alias("ms")).orderBy("i").select("ms").collect()]
    assert list(zip([c[0] for c in CASES], got)) == CASES


def test_events_keep_time_language_and_author(spark):
    items = read(spark, SMALL, "feed_item").dropDuplicates(["item_key"])
    built = build_events(items, read(spark, SMALL, "intel_source"), read(spark, SMALL, "universe_asset"), 77)
    rows = built.select("published_at", "published_at_ms", "observed_at_ms", "fetched_at_ms", "language", "language_hint", "author", "author_or_channel").collect()
    assert {r.published_at_ms is None for r in rows} == {True, False}
    for r in rows:
        assert (r.observed_at_ms, r.fetched_at_ms, r.language, r.author_or_channel) == (77 if r.published_at_ms is None else r.published_at_ms, 77, r.language_hint, r.author)


def test_a_run_stores_published_times(spark):
    run = Run("r", 1_767_225_600_000, "bucket", CAPS)
    events, pointers = ingest(read(spark, SMALL, "feed_item"), read(spark, SMALL, "intel_source"), read(spark, SMALL, "universe_asset"), None, run)
    want = {(r.event_id, r.published_at_ms) for r in events.select("event_id", "published_at_ms").collect()}
    got = {(r.event_id, r.published_at_ms) for r in pointers.select("event_id", "published_at_ms").collect()}
    assert got <= want and any(t is not None for _, t in got)
    assert ingest_run(spark, SMALL).where("published_at_ms is not null").count() > 0


def test_every_item_has_a_row_and_mail_times_are_kept(spark):
    items = read(spark, SMALL, "feed_item").dropDuplicates(["item_key"])
    got = {r.item_key: r.published_at_ms for r in published_at_parse(spark, SMALL).collect()}
    assert len(got) == items.count()
    iso = {r.item_key: r.published_at_ms for r in written_zone_times(spark, SMALL).collect()}
    assert {k: got[k] for k in iso} == iso
    mail = [r.item_key for r in items.where(r"published_at rlike '^[A-Z][a-z]{2}, [0-9]{1,2} [A-Z][a-z]{2} [0-9]{4} .* GMT$'").collect()]
    assert mail and all(got[k] is not None for k in mail) and not set(mail) & set(iso)
