import datetime as dt
import random

from pyspark.sql import functions as F

from gleaner.operators import travel
from tests.conftest import rows

FLIGHTS = "offer_id bigint, airline string, price double, is_best boolean"


def test_offers_without_price_or_flights(spark):
    offers = spark.createDataFrame([(1, "NZ$299"), (2, None), (3, "NZ$5")], "offer_id bigint, current_price string")
    flights = spark.createDataFrame([(1, "A", 299.99, True), (1, "B", 399.99, False), (2, "C", None, None)], FLIGHTS)
    nested = travel.nest_offers(offers, flights, "offer_id")
    assert [(r["offer_id"], r["current_price"], len(r["flights"])) for r in nested.orderBy("offer_id").collect()] == [(1, "NZ$299", 2), (2, None, 1), (3, "NZ$5", 0)]
    best = {r["offer_id"]: [f["airline"] for f in r["flights"]] for r in travel.best_offers(nested).collect()}
    assert best == {1: ["A"], 2: [], 3: []}


def stamp(text):
    return F.lit(text).cast("timestamp")


def test_sessions_overlap_closed_ranges(spark):
    events = spark.createDataFrame(
        [("e", [("2025-01-01T10:00:00", "2025-01-02T00:00:00", "t"), ("2025-01-05", "2025-01-06", "t"), ("2025-01-03", None, "t"), ("soon", "2025-01-03", "t")]), ("none", [])],
        "name string, sessions array<struct<datetime_start:string,datetime_end:string,session_tickets:string>>",
    )
    got = travel.overlapping_sessions(events, stamp("2025-01-02"), stamp("2025-01-05"))
    assert {r["name"]: [s["datetime_start"] for s in r["sessions"]] for r in got.collect()} == {"e": ["2025-01-01T10:00:00", "2025-01-05"], "none": []}
    assert travel.drop_session_field(events).schema["sessions"].dataType.elementType.names == ["datetime_start", "datetime_end"]


def test_date_bounds(spark):
    df = spark.createDataFrame([("2025-12-24", "2025-12-30"), ("2025-12-24T08:30:00", "2025-12-30T10:00:00"), ("x", "2025-12-30"), ("2025-12-31", "2025-12-30")], "a string, b string")
    got = [(r["range_end"], r["message"]) for r in travel.date_bounds(df, "a", "b").collect()]
    assert got == [
        (dt.datetime(2025, 12, 30, 23, 59, 59, 999999), None), (dt.datetime(2025, 12, 30, 10), None),
        (dt.datetime(2025, 12, 30, 23, 59, 59, 999999), travel.FORMAT_MESSAGE), (dt.datetime(2025, 12, 30, 23, 59, 59, 999999), travel.ORDER_MESSAGE),
    ]


def test_locations_and_top_events(spark):
    events = spark.createDataFrame([(i, "ab"[i % 2] if i < 7 else "c", float(i)) for i in range(8)], "event_id bigint, location string, popularity double")
    ranked = travel.rank_locations(events)
    assert [tuple(r) for r in ranked.collect()] == [("a", 4), ("b", 3), ("c", 1)]
    assert travel.location_slugs(ranked).first()[0] == "a,b,c"
    sessions = spark.createDataFrame([(i, dt.datetime(2025, 1, i + 1), dt.datetime(2025, 1, i + 1)) for i in range(8)], "event_id bigint, starts timestamp, ends timestamp")
    top = travel.top_events(events, sessions, ranked.limit(2), stamp("2025-01-02"), stamp("2025-01-06"), k=2)
    assert [r["event_id"] for r in top.collect()] == [5, 4]


def test_budget(spark):
    df = spark.createDataFrame([("NZ$2,164.50", dt.date(2025, 1, 1)), ("NZ$90", dt.date(2026, 1, 1)), ("free", dt.date(2025, 1, 1)), (None, dt.date(2025, 1, 1))], "price_text string, day date")
    got = travel.within_budget(df, 3000.0, F.lit("2025-01-01").cast("date"), F.lit("2025-12-31").cast("date"))
    assert [r["price"] for r in got.collect()] == [2164.5]


def test_range_join_by_brute_force(spark):
    rng = random.Random(4)
    zero = dt.datetime(1999, 12, 25)

    def interval():
        start = zero + dt.timedelta(hours=rng.randrange(0, 24 * 400))
        return start, start + dt.timedelta(hours=rng.choice([0, 1, 24, 24 * 8, 24 * 64, 24 * 300, 24 * 4000]))

    sessions = [(f"s{i}", *interval()) for i in range(150)] + [("open", zero, zero - dt.timedelta(days=1))]
    ranges = [(i, *interval()) for i in range(40)]
    a = spark.createDataFrame(sessions, "session_id string, starts timestamp, ends timestamp")
    b = spark.createDataFrame(ranges, "range_id bigint, range_start timestamp, range_end timestamp")
    got = rows(travel.range_overlap_join(a, b).select("session_id", "range_id"), "session_id", "range_id")
    assert got == sorted((s, r) for s, s0, s1 in sessions for r, r0, r1 in ranges if s0 <= s1 and s0 <= r1 and s1 >= r0)
    assert travel.range_overlap_join(a, b.limit(0)).count() == 0
