"""Offers, events and trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators import travel
from gleaner.plans import views as v
from gleaner.plans.registry import query
from gleaner.plans.standins import Tables
from gleaner.sources import results as rs
from gleaner.sources.scratch import scratch_path

# Sessions that one event payload of a search service carries.
PAYLOAD_PAGE = 50

OFFERS = """
flights AS (SELECT l_orderkey AS offer_id, l_extendedprice AS price, coalesce(l_returnflag = 'R', false) AS is_best FROM lineitem),
offers AS (SELECT o_orderkey AS offer_id, CASE WHEN o_orderkey % 5 <> 0 THEN concat('NZ$', printf('%.2f', o_totalprice)) END AS current_price FROM orders),
nested AS (
  SELECT offer_id, current_price, count(price) AS n_flights, count(*) FILTER (WHERE is_best) AS n_best,
         round(coalesce(sum(price), 0), 2) AS total_price, round(coalesce(sum(price) FILTER (WHERE is_best), 0), 2) AS best_price
  FROM offers LEFT JOIN flights USING (offer_id) GROUP BY ALL)"""


def nested_offers(t: Tables) -> DataFrame:
    return travel.nest_offers(t.offers(), t.flights(), "offer_id")


def _total(price: str) -> F.Column:
    return F.round(F.aggregate("flights", F.lit(0.0), lambda total, f: total + f["price"]), 2).alias(price)


@query("offers_nested", v.with_(OFFERS, select="SELECT offer_id, current_price, n_flights, total_price FROM nested"))
def offers_nested(t: Tables) -> DataFrame:
    n = F.size("flights").cast("bigint").alias("n_flights")
    return nested_offers(t).select("offer_id", "current_price", n, _total("total_price"))


@query("best_offers", v.with_(OFFERS, select="SELECT offer_id, current_price, n_best, best_price FROM nested"))
def best_offers(t: Tables) -> DataFrame:
    n = F.size("flights").cast("bigint").alias("n_best")
    return travel.best_offers(nested_offers(t)).select("offer_id", "current_price", n, _total("best_price"))


START, END = "TIMESTAMP '1998-03-01 00:00:00'", "TIMESTAMP '1998-03-31 23:59:59.999999'"


def _range() -> tuple[F.Column, F.Column]:
    return F.lit("1998-03-01 00:00:00").cast("timestamp_ntz"), F.lit("1998-03-31 23:59:59.999999").cast("timestamp_ntz")


@query(
    "session_overlap",
    v.with_(
        v.EVENTS,
        select=f"""
        SELECT e.event_id, count(s.session_id) AS n_sessions, CAST(min(s.starts) AS DATE) AS first_start, CAST(max(s.ends) AS DATE) AS last_end
        FROM evs e LEFT JOIN sess s ON s.event_id = e.event_id AND s.starts <= {END} AND s.ends >= {START}
        GROUP BY e.event_id
        """,
    ),
)
def session_overlap(t: Tables) -> DataFrame:
    counted = travel.session_counts(t.events().select("event_id"), t.sessions(), *_range())
    return counted.select("event_id", "n_sessions", F.to_date("first_start").alias("first_start"), F.to_date("last_end").alias("last_end"))


def payloads(t: Tables) -> DataFrame:
    """Event search results as JSON texts, one event page each."""
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    sessions = t.sessions().withColumn("page", F.floor(F.split_part("session_id", F.lit("-"), F.lit(2)).cast("int") / PAYLOAD_PAGE))
    listed = sessions.groupBy("event_id", "page").agg(
        F.collect_list(
            F.struct(
                F.when(~F.col("session_id").endswith("7"), stamp("starts")).alias("datetime_start"),
                stamp("ends").alias("datetime_end"), F.col("session_id").alias("session_tickets"),
            )
        ).alias("sessions")
    )
    event = F.struct(
        F.concat(F.lit("http://example.org/"), F.col("event_id")).alias("url"), F.concat(F.lit("Event "), F.col("event_id")).alias("name"),
        F.lit("").alias("description"), F.lit(False).alias("is_sold_out"),
        F.struct(F.col("location").alias("url"), F.col("location").alias("name")).alias("location"),
        F.when(F.col("sessions").isNotNull(), F.struct("sessions")).alias("sessions"),
    )
    return t.events().join(listed, "event_id", "left").select(F.to_json(F.struct(F.array(event).alias("events"))).alias("value"))


def parsed_events(t: Tables) -> DataFrame:
    """Payloads landed as files, one per line, then parsed."""
    path = scratch_path(t.spark, "event-payloads")
    payloads(t).write.text(path)
    return rs.parse_events(t.spark.read.text(path))


@query(
    "event_payloads",
    v.with_(
        v.EVENTS,
        select=f"""
        SELECT concat('http://example.org/', e.event_id) AS url, concat('Event ', e.event_id) AS name, e.location,
               count(s.session_id) AS n_sessions,
               count(*) FILTER (WHERE s.session_id NOT LIKE '%7' AND s.starts <= {END} AND s.ends >= {START}) AS n_overlapping
        FROM evs e LEFT JOIN sess s USING (event_id) GROUP BY ALL
        """,
    ),
)
def event_payloads(t: Tables) -> DataFrame:
    events = parsed_events(t).withColumn("n_sessions", F.size("sessions").cast("bigint"))
    start, end = (c.cast("timestamp") for c in _range())
    return travel.overlapping_sessions(events, start, end).select(
        "url", "name", F.col("location.name").alias("location"), "n_sessions", F.size("sessions").cast("bigint").alias("n_overlapping")
    )


@query(
    "drop_session_field",
    v.with_(
        v.EVENTS,
        select="""
        SELECT concat('http://example.org/', event_id) AS url, CASE WHEN session_id NOT LIKE '%7' THEN strftime(starts, '%Y-%m-%dT%H:%M:%S') END AS datetime_start,
               strftime(ends, '%Y-%m-%dT%H:%M:%S') AS datetime_end
        FROM sess
        """,
    ),
)
def drop_session_field(t: Tables) -> DataFrame:
    """What is left of the sessions, one row each."""
    return travel.drop_session_field(parsed_events(t)).select("url", F.inline("sessions"))


DATE_BOUNDS = f"""
WITH asked AS (
  SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS start_date,
         CASE WHEN o_orderstatus = 'P' THEN 'soon' WHEN o_orderstatus = 'F' THEN '1996-06-30' ELSE strftime(o_orderdate, '%Y-%m-%dT12:30:00') END AS end_date
  FROM orders),
bounds AS (
  SELECT *, TRY_CAST(start_date AS TIMESTAMP) AS s, TRY_CAST(end_date AS TIMESTAMP) AS e0 FROM asked),
closed AS (
  SELECT *, CASE WHEN date_trunc('second', e0) = date_trunc('day', e0) THEN date_trunc('day', e0) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND ELSE e0 END AS e FROM bounds)
SELECT id, strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS range_start, strftime(e, '%Y-%m-%d %H:%M:%S.%f') AS range_end,
       CASE WHEN s IS NULL OR e IS NULL THEN '{travel.FORMAT_MESSAGE}' WHEN s > e THEN '{travel.ORDER_MESSAGE}' END AS message
FROM closed
"""


@query("date_bounds", DATE_BOUNDS)
def date_bounds(t: Tables) -> DataFrame:
    orders = t.read("orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    end = F.when(F.col("o_orderstatus") == "P", F.lit("soon")).when(F.col("o_orderstatus") == "F", F.lit("1996-06-30")).otherwise(
        F.concat(day, F.lit("T12:30:00"))
    )
    asked = orders.select(F.col("o_orderkey").alias("id"), day.alias("start_date"), end.alias("end_date"))
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return travel.date_bounds(asked, "start_date", "end_date").select("id", shown("range_start"), shown("range_end"), "message")


@query("location_ranking", v.with_(v.EVENTS, select="SELECT location, count(*) AS n_events FROM evs GROUP BY location"))
def location_ranking(t: Tables) -> DataFrame:
    return travel.rank_locations(t.events())


@query(
    "location_slugs",
    v.with_(
        v.EVENTS, "ranked AS (SELECT strftime(day, '%Y-%m') AS month, location, count(*) AS n FROM evs GROUP BY ALL)",
        select="SELECT month, string_agg(location, ',' ORDER BY n DESC, location) AS location_slugs FROM ranked GROUP BY month",
    ),
)
def location_slugs(t: Tables) -> DataFrame:
    """The ranking of every search, a search being a month."""
    searched = t.events().withColumn("month", F.date_format("day", "yyyy-MM"))
    return travel.location_slugs(travel.rank_locations(searched, ["month"]), ["month"])


@query(
    "events_topn",
    v.with_(
        v.EVENTS,
        "busy AS (SELECT location FROM evs GROUP BY location ORDER BY count(*) DESC, location LIMIT 2)",
        select=f"""
        SELECT event_id, location, popularity FROM evs e
        WHERE location IN (SELECT location FROM busy)
          AND EXISTS (SELECT 1 FROM sess s WHERE s.event_id = e.event_id AND s.starts <= {END} AND s.ends >= {START})
        ORDER BY popularity DESC, event_id LIMIT 5
        """,
    ),
)
def events_topn(t: Tables) -> DataFrame:
    locations = travel.rank_locations(t.events()).limit(2)
    return travel.top_events(t.events(), t.sessions(), locations, *_range()).select("event_id", "location", "popularity")


@query(
    "within_budget",
    """
    SELECT o_orderkey AS trip_id, round(o_totalprice, 2) AS price FROM orders
    WHERE o_orderkey % 5 <> 0 AND o_totalprice <= 50000 AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'
    """,
)
def within_budget(t: Tables) -> DataFrame:
    trips = t.offers().join(t.events(), F.col("offer_id") == F.col("event_id")).select(
        F.col("offer_id").alias("trip_id"), F.col("current_price").alias("price_text"), "day"
    )
    window = (F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1997-12-31").cast("timestamp_ntz"))
    return travel.within_budget(trips, 50_000.0, *window).select("trip_id", "price")


@query(
    "session_range_join",
    v.with_(
        v.EVENTS,
        "trips AS (SELECT n_nationkey AS range_id, TIMESTAMP '1995-01-01' + to_days(n_nationkey * 60) AS a, TIMESTAMP '1995-01-01' + to_days(n_nationkey * 61 + 14) AS b FROM nation)",
        select="SELECT session_id, range_id FROM sess JOIN trips ON starts <= b AND ends >= a",
    ),
)
def session_range_join(t: Tables) -> DataFrame:
    first = F.lit("1995-01-01").cast("timestamp_ntz")
    trips = t.read("nation").select(
        F.col("n_nationkey").alias("range_id"),
        (first + F.make_dt_interval(F.col("n_nationkey") * 60)).alias("range_start"),
        (first + F.make_dt_interval(F.col("n_nationkey") * 61 + 14)).alias("range_end"),
    )
    return travel.range_overlap_join(t.sessions(), trips).select("session_id", "range_id")


@query(
    "itinerary",
    """
    SELECT o_orderkey AS trip_id,
           concat('{"flight_booking_data":', CASE WHEN o_orderkey % 5 <> 0 THEN concat('"NZ$', printf('%.2f', o_totalprice), '"') ELSE 'null' END,
                  ',"event_booking_data":"', o_orderpriority, '"}') AS itinerary
    FROM orders
    """,
)
def itinerary(t: Tables) -> DataFrame:
    flights = t.offers().select(F.col("offer_id").alias("trip_id"), F.col("current_price").alias("flight_booking_data"))
    events = t.events().select(F.col("event_id").alias("trip_id"), F.col("location").alias("event_booking_data"))
    return rs.itinerary(flights, events, "trip_id")
