"""Time, identity and free-text functions on columns."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The vocabularies of a report.
HAZARDS = ("close_pass", "dooring", "surface_hazard", "sightline", "signal", "debris", "other")
MODES = ("cyclist", "pedestrian", "wheelchair", "scooter", "other")
SEVERITIES = ("near_miss", "minor", "serious")
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def local_date(occurred_at: Column) -> Column:
    """The date in the report's own offset: a slice of the string, not of an instant."""
    return F.substring(occurred_at, 1, 10)


def local_hour(occurred_at: Column) -> Column:
    return F.substring(occurred_at, 12, 2).try_cast("int")


def epoch(occurred_at: Column) -> Column:
    """Seconds since 1970 of an ISO time; without an offset it is UTC; null if it is none."""
    return F.unix_timestamp(F.try_to_timestamp(occurred_at)).cast("long")


#: Parts of the day and their hours, first and last.
PARTS_OF_DAY = (
    ("overnight", 0, 5),
    ("am_peak", 6, 9),
    ("midday", 10, 15),
    ("pm_peak", 16, 19),
    ("evening", 20, 23),
)


def part_of_day(hour: Column) -> Column:
    """The part of the day of an hour; unknown_time without one."""
    out = F.when(hour.isNull(), "unknown_time")
    for name, first, last in PARTS_OF_DAY:
        out = out.when(hour.between(first, last), name)
    return out


def weekday_name(date: Column) -> Column:
    names = F.array(*(F.lit(d) for d in WEEKDAYS))
    return F.get(names, F.weekday(F.to_date(date)))


def classify(hazard: Column) -> Column:
    """A hazard outside the vocabulary is 'other'."""
    return F.when(hazard.isin(*HAZARDS), hazard).otherwise("other")


def address_key(address: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(address)), r"\s+", " ")


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


#: A street name with its span in parentheses, and the dashes between cross streets.
NAME_AND_SPAN = r"^(.+?)\s*\(([^)]*)\)\s*$"
SPAN_DASH = "[‒–—―-]"


def street_name(name: Column) -> Column:
    """'5th St (B to C)' gives '5th St'; a name without a span is the street."""
    found = F.regexp_extract(name, NAME_AND_SPAN, 1)
    return F.trim(F.when(found == "", name).otherwise(found))


def span(name: Column) -> Column:
    """The cross streets in parentheses, as an array without empty names."""
    inside = F.regexp_extract(name, NAME_AND_SPAN, 2)
    return F.filter(F.transform(F.split(inside, SPAN_DASH), lambda s: F.trim(s)), lambda s: s != "")


def field_name(name: str) -> str:
    """A header as a name: trimmed, in lower case, blanks and dashes as one underscore, other signs left out."""
    return re.sub(r"[^a-z0-9_]", "", re.sub(r"[\s-]+", "_", name.strip().lower()))


def tombstone_key(identity: Column) -> Column:
    return F.sha2(identity.cast("string"), 256)


def corridor_id(ids: Column) -> Column:
    return F.concat(F.lit("corridor-"), F.substring(F.sha2(F.array_join(F.array_sort(ids), ","), 256), 1, 12))


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """Version 5 UUID of a name: SHA-1 of the namespace's bytes and the name, with the version bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(F.lit(63)).bitwiseOR(F.lit(128))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(F.lower(F.hex(variant)), F.substring(h, 19, 2)),
        F.substring(h, 21, 12),
    )


#: Patterns of personal data in notes.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\b\d{3}[-.\s]?\d{3}[-.\s]?\d{4}\b"
PLATE = r"\b(?=[A-Z0-9]{5,8}\b)(?=[A-Z0-9]*[A-Z])(?=[A-Z0-9]*\d)[A-Z0-9]{5,8}\b"


def pii_flags(note: Column) -> Column:
    """Which kinds of personal data a note seems to hold; plates are looked for in upper case."""
    kinds = (("email", note, EMAIL), ("phone", note, PHONE), ("plate", F.upper(note), PLATE))
    return F.array_compact(F.array(*(F.when(said.rlike(pattern), f"possible_{name}_in_note") for name, said, pattern in kinds)))


#: Keyword buckets of moderation reasons; the first that matches counts.
REASONS = (
    ("duplicate", ("duplicate", "dupe", "already reported", "already submitted", "repost")),
    ("spam", ("spam", "advert", "advertis", "junk", "bot", "gibberish", "test submission")),
    ("identifier-leak", ("identif", "personal", "pii", "email", "phone", "plate", "license", "name of", "doxx")),
    ("invalid-location", ("location", "geocode", "coordinate", "off the map", "out of area", "outside", "address")),
    ("off-topic", ("off-topic", "off topic", "unrelated", "not a hazard", "not relevant", "irrelevant")),
)


def reason_category(reason: Column) -> Column:
    low, out = F.lower(reason), F.when(reason.isNull(), "other")
    for name, words in REASONS:
        hit = F.lit(False)
        for word in words:
            hit = hit | low.contains(word)
        out = out.when(hit, name)
    return out.otherwise("other")


def iso_from_epoch_ms(ms: Column) -> Column:
    """UTC time with Z; null for zero and less."""
    return F.when(ms > 0, F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def with_offset(time: Column, offset: str) -> Column:
    """Append an offset to a time that has none."""
    return F.when(time.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$"), time).otherwise(F.concat(time, F.lit(offset)))
