"""Offers, events with sessions, and date ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.common import PART_ROWS, counted_join

# Messages that callers see.
FORMAT_MESSAGE = "start_date and end_date must be in ISO 8601 format, e.g. YYYY-MM-DD"
ORDER_MESSAGE = "Start date must be before end date"
TOP_EVENTS = 5
RANGE_LEVELS = 16


def nest_offers(offers: DataFrame, flights: DataFrame, key: str) -> DataFrame:
    """``(key, current_price, flights)``: one row per offer, its flights as an array.

    A missing price stays null, an offer without flights gets an empty array.
    """
    fields = [c for c in flights.columns if c != key]
    nested = flights.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("flights"))
    empty = F.array().cast(nested.schema["flights"].dataType)
    return offers.join(nested, key, "left").select(key, "current_price", F.coalesce("flights", empty).alias("flights"))


def best_offers(offers: DataFrame) -> DataFrame:
    """Keeps the flights marked as best; a missing mark counts as not best."""
    return offers.withColumn("flights", F.filter("flights", lambda f: F.coalesce(f["is_best"], F.lit(False))))


# What counts as an ISO text: a whole date, and a time of day with at least minutes.
ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"


def iso_time(text: Column) -> Column:
    """Timestamp of an ISO text, with dashes or without; null for any other text."""
    dashed = F.regexp_replace(text, r"^([0-9]{4})([0-9]{2})([0-9]{2})(?![0-9])", "$1-$2-$3")
    return F.when(dashed.rlike(ISO), F.try_to_timestamp(dashed))


def overlapping_sessions(events: DataFrame, start: Column, end: Column) -> DataFrame:
    """Keeps the sessions that overlap the closed range; events without any keep an empty array.

    Session bounds are ISO texts; sessions without both, or unreadable, are dropped.
    """
    keep = lambda s: (iso_time(s["datetime_start"]) <= end) & (iso_time(s["datetime_end"]) >= start)
    return events.withColumn("sessions", F.filter("sessions", keep))


def session_counts(events: DataFrame, sessions: DataFrame, start: Column, end: Column) -> DataFrame:
    """Row form of :func:`overlapping_sessions`, for sessions kept as a table.

    ``events(event_id, ...)``, ``sessions(event_id, starts, ends)``; every
    event is kept, with the number and the span of its overlapping sessions.
    """
    kept = sessions.filter((F.col("starts") <= end) & (F.col("ends") >= start))
    spans = kept.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n_sessions"), F.min("starts").alias("first_start"), F.max("ends").alias("last_end")
    )
    return events.join(spans, "event_id", "left").withColumn("n_sessions", F.coalesce("n_sessions", F.lit(0).cast("bigint")))


def drop_session_field(events: DataFrame, field: str = "session_tickets") -> DataFrame:
    """Sessions without ``field``."""
    return events.withColumn("sessions", F.transform("sessions", lambda s: s.dropFields(field)))


def date_bounds(df: DataFrame, start: str, end: str) -> DataFrame:
    """Adds ``range_start``, ``range_end`` and ``message`` for two ISO texts.

    An end at midnight moves to the last microsecond of its day. Unreadable
    bounds, and a start after the end, give a message.
    """
    first, last = iso_time(F.col(start)), iso_time(F.col(end))
    whole_day = F.date_trunc("SECOND", last) == F.date_trunc("DAY", last)
    closing = F.when(whole_day, F.date_trunc("DAY", last) + F.expr("INTERVAL '1' DAY - INTERVAL '0.000001' SECOND")).otherwise(last)
    opening = F.when(F.date_trunc("SECOND", first) == F.date_trunc("DAY", first), F.date_trunc("DAY", first)).otherwise(first)
    bounds = df.withColumn("range_start", opening).withColumn("range_end", closing)
    return bounds.withColumn(
        "message",
        F.when(F.col("range_start").isNull() | F.col("range_end").isNull(), F.lit(FORMAT_MESSAGE))
        .when(F.col("range_start") > F.col("range_end"), F.lit(ORDER_MESSAGE)),
    )


def rank_locations(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by, location, n_events)``, most events first, then by name; ``by`` names the search."""
    counted = events.groupBy(*by, "location").agg(F.count(F.lit(1)).alias("n_events"))
    return counted.orderBy(*by, F.desc("n_events"), "location")


def location_slugs(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The ranking of every search as one comma-separated text, the form that an event search takes.

    With ``by`` each search gets a row of its own, and Spark spreads the
    searches; a ranking without it is that of a single search.
    """
    pairs = F.array_sort(F.collect_list(F.struct((-F.col("n_events")).alias("order"), "location")))
    return ranked.groupBy(*by).agg(F.array_join(F.transform(pairs, lambda p: p["location"]), ",").alias("location_slugs"))


def top_events(events: DataFrame, sessions: DataFrame, locations: DataFrame, start: Column, end: Column, k: int = TOP_EVENTS) -> DataFrame:
    """The ``k`` most popular events of the given locations with a session in the range."""
    inside = sessions.filter((F.col("starts") <= end) & (F.col("ends") >= start)).select("event_id")
    return (
        events.join(locations.select("location"), "location", "left_semi")
        .join(inside, "event_id", "left_semi")
        .orderBy(F.desc("popularity"), "event_id")
        .limit(k)
    )


def price_value(text: Column) -> Column:
    """Number in a price text such as ``NZ$2164``; null when there is none."""
    return F.regexp_replace(text, r"[^0-9.]", "").try_cast("double")


def within_budget(trips: DataFrame, budget: float, start: Column, end: Column) -> DataFrame:
    """Trips whose price is known and within the budget and whose date lies in the window."""
    return trips.withColumn("price", price_value(F.col("price_text"))).filter(
        (F.col("price") <= budget) & F.col("day").between(start, end)
    )


def range_overlap_join(sessions: DataFrame, ranges: DataFrame, levels: int = RANGE_LEVELS, part_rows: int = PART_ROWS) -> DataFrame:
    """All pairs of ``sessions(session_id, starts, ends)`` and ``ranges(range_id, range_start, range_end)`` that overlap.

    Both ends are closed. Time is cut into cells of one day times a power of
    two. A pair meets at the level of the longer of the two and only in the
    cell where the later one begins, so no pair appears twice and an interval
    takes about two cells per level whatever its length. Sessions, the large
    side, enter only the levels that some range calls for. Cells are counted
    first, and one with more than ``part_rows`` sessions is cut into parts.
    """

    def seconds(name: str) -> Column:
        return F.unix_seconds(F.col(name).cast("timestamp"))

    def own_level(begin: str, finish: str) -> Column:
        days = F.greatest(seconds(finish) - seconds(begin), F.lit(1)) / 86_400
        return F.least(F.greatest(F.ceil(F.log2(days)), F.lit(0)), F.lit(levels)).cast("int")

    def cell(name: str, level: Column) -> Column:
        return F.floor(seconds(name) / (F.pow(F.lit(2.0), level) * 86_400))

    def placed(df: DataFrame, begin: str, finish: str, entered: Column, side: str) -> DataFrame:
        packed = df.select(F.struct(*[c for c in df.columns if c != "own_level"]).alias(side), begin, finish, "own_level")
        at_level = packed.withColumn("level", F.explode(entered))
        first = cell(begin, F.col("level"))
        return (
            at_level.withColumn("first", first)
            .withColumn("cell", F.explode(F.sequence(F.col("first"), cell(finish, F.col("level")))))
            .select("level", "cell", side, F.col("own_level").alias(f"{side}_level"), (F.col("cell") == F.col("first")).alias(f"{side}_begins"))
        )

    ordered = ranges.filter("range_start <= range_end").withColumn("own_level", own_level("range_start", "range_end"))
    called = sorted(row["own_level"] for row in ordered.select("own_level").distinct().collect())
    timed = sessions.filter("starts <= ends").withColumn("own_level", own_level("starts", "ends"))

    own = F.col("own_level")
    lowest = called[0] if called else levels + 1
    above = F.array(*[F.lit(level) for level in called]) if called else F.array().cast("array<int>")
    entered = F.concat(
        F.when(own >= lowest, F.array(own)).otherwise(F.array().cast("array<int>")), F.filter(above, lambda level: level > own)
    )
    a = placed(timed, "starts", "ends", entered, "a")
    b = placed(ordered, "range_start", "range_end", F.sequence(own, F.lit(levels)), "b")
    together = (
        (F.col("level") == F.greatest("a_level", "b_level"))
        & F.when(F.col("a.starts") >= F.col("b.range_start"), F.col("a_begins")).otherwise(F.col("b_begins"))
        & (F.col("a.starts") <= F.col("b.range_end")) & (F.col("a.ends") >= F.col("b.range_start"))
    )
    return counted_join(a, b, ["level", "cell"], ["a.session_id"], part_rows=part_rows).filter(together).select("a.*", "b.*")
