"""Column-level helpers: identifiers, hashes, times, units, offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit conversions.
MS_TO_KPH = 3.6
PSI_TO_BAR = 0.0689476
KELVIN_OFFSET = 273.15


def session_key(year: Column, event_name: Column, session_name: Column) -> Column:
    """``2024_Monaco_Grand_Prix_Race``: blanks become underscores."""
    return F.concat_ws(
        "_",
        year.cast("string"),
        F.replace(event_name, F.lit(" "), F.lit("_")),
        F.replace(session_name, F.lit(" "), F.lit("_")),
    )


def composite_key(*parts: str) -> Column:
    """Colon-joined key. A NULL part is skipped and shortens the key; see ``has_all``."""
    return F.concat_ws(":", *parts)


def has_all(*parts: str) -> Column:
    """True when no part of a composite key is NULL, i.e. the key cannot collide."""
    check = F.lit(True)
    for part in parts:
        check = check & F.col(part).isNotNull()
    return check


def event_key(kind: str, *parts: str) -> Column:
    """``session_<kind>_..._lap``; the first part is the session."""
    head, *tail = parts
    return F.concat_ws("_", F.col(head), F.lit(kind), *[F.col(p).cast("string") for p in tail])


def content_hash(*parts: Column) -> Column:
    """md5 of the underscore-joined text of the parts."""
    return F.md5(F.concat_ws("_", *[p.cast("string") for p in parts]))


def correlation_id(session: str, driver: str, lap: str) -> Column:
    return F.concat_ws("_", session, driver, F.col(lap).cast("string"))


def parse_ts(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP; bad text gives NULL instead of an error."""
    return F.try_to_timestamp(text)


def session_start(start_text: Column, scheduled: Column, event_date: Column) -> Column:
    """First usable of: recorded start, scheduled start, event date (all UTC).

    A recorded start that is a duration, not a time, does not parse and so counts as
    missing. NULL means that nothing was usable; quarantine such sessions.
    """
    return F.coalesce(
        parse_ts(start_text), scheduled.cast("timestamp"), event_date.cast("timestamp")
    )


def event_time(start: Column, offset_ms: Column) -> Column:
    """Session start plus an offset in milliseconds."""
    return F.timestamp_add("MILLISECOND", offset_ms, start)


def millis_between(earlier: Column, later: Column) -> Column:
    """Whole milliseconds from one time to a later one, truncated toward zero."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.call_function("div", micros, F.lit(1000).cast("bigint"))


def seconds_to_ms(seconds: Column) -> Column:
    """Whole milliseconds, truncated toward zero."""
    return (seconds * F.lit(1000)).cast("bigint")


def sampling_weight(sequence: Column) -> Column:
    return F.lit(1.0) / (sequence + F.lit(1))


def display_name(*candidates: Column) -> Column:
    return F.coalesce(*candidates)


def ms_to_kph(speed: Column) -> Column:
    return speed * F.lit(MS_TO_KPH)


def psi_to_bar(pressure: Column) -> Column:
    return pressure * F.lit(PSI_TO_BAR)


def kelvin_to_celsius(temp: Column) -> Column:
    return temp - F.lit(KELVIN_OFFSET)


def offset_total(offsets_json: Column, topic: str) -> Column:
    """Sum of the offsets of one topic in ``{topic: {partition: offset}}``; 0 if unusable."""
    parsed = F.from_json(offsets_json, "map<string,map<string,bigint>>")
    offsets = F.map_values(F.try_element_at(parsed, F.lit(topic)))
    total = F.aggregate(offsets, F.lit(0).cast("bigint"), lambda acc, v: acc + F.coalesce(v, F.lit(0)))
    return F.coalesce(total, F.lit(0).cast("bigint"))
