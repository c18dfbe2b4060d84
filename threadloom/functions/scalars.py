"""Scalar functions as Catalyst column expressions; no Python runs per row."""

from __future__ import annotations

import math
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Listing order -> path suffix of the site.
RANKING_PATHS = {
    "tophour": "top/?sort=top&t=hour",
    "day": "top/?sort=top&t=day",
    "topweek": "top/?sort=top&t=week",
    "topmonth": "top/?sort=top&t=month",
    "topyear": "top/?sort=top&t=year",
    "topall": "top/?sort=top&t=all",
    "new": "new/",
    "hot": "/",
    "rising": "/rising/",
    "controversial": "controversial/",
}
PAGE_SIZE = 25  # fixed value: elements on a full listing page
DEFAULT_PERIOD = 86_400  # fixed value: seconds looked back when nothing else is known
PARSED_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def map_lookup(mapping: dict[str, str], key: Column | str, default: str | None = None) -> Column:
    """Value of `key` in a driver-side map, else `default`."""
    found = F.try_element_at(literal_map(mapping), col(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def slashed(path: Column | str) -> Column:
    """Path with exactly one slash at either end."""
    return F.concat(F.lit("/"), F.trim(col(path), F.lit("/")), F.lit("/"))


def board_path(name: Column | str, ranking: Column | str) -> Column:
    """Listing path of a board in a given order.

    The order is left out if it is unknown, or if its name occurs anywhere in the path, so
    `r/news` in order `new` stays `/r/news/`.
    """
    base, ranking = slashed(name), col(ranking)
    suffix = map_lookup(RANKING_PATHS, ranking)
    return F.when(suffix.isNull() | F.contains(base, ranking), base).otherwise(
        F.concat(base, suffix)
    )


def hms(seconds: Column | str) -> Column:
    """Seconds as HH:MM:SS; hours may pass 99, negatives are floored."""
    s = col(seconds)
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(s / 3600),
        F.floor(F.pmod(s, F.lit(3600)) / 60),
        F.floor(F.pmod(s, F.lit(60))),
    )


def created_ts(created_ms: Column | str) -> Column:
    """Epoch milliseconds (text or number) as a timestamp; null if not a number."""
    return F.timestamp_millis(col(created_ms).try_cast("bigint"))


def iso_to_millis(iso: Column | str) -> Column:
    """ISO-8601 text as epoch milliseconds; null unless it begins with a whole date."""
    whole = F.regexp_extract(col(iso), r"^\s*\d{4}-\d{2}-\d{2}(?!\d).*", 0)
    return F.unix_millis(F.try_to_timestamp(F.nullif(whole, F.lit(""))))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def to_zone(ts_utc: Column | str, zone: str) -> Column:
    """UTC wall-clock time (no zone) as wall-clock time in `zone`, for display."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(ts_utc))


def parsed_time(run_time: Column | None = None) -> Column:
    """Run time in the text form messages carry."""
    return F.date_format(F.current_timestamp() if run_time is None else run_time,
                         PARSED_TIME_FORMAT)


def epoch_ms(moment: datetime | int) -> int:
    """Epoch milliseconds of a datetime (naive ones are UTC) or of a plain number."""
    if isinstance(moment, datetime):
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=timezone.utc)
        return math.floor(moment.timestamp() * 1000)
    return int(moment)


def in_period(created_ms: Column | str, now: datetime | int, period: float | None) -> Column:
    """True if the age at `now` is at most `period` seconds; a falsy period accepts all.

    Written as one comparison of the stored column with a literal, so that a parquet scan can
    skip row groups by it.
    """
    if not period:
        return F.lit(True)
    oldest = math.ceil(epoch_ms(now) - Decimal(str(period)) * 1000)
    return col(created_ms) >= F.lit(oldest)


def in_period_by(created_ms: Column | str, now: datetime | int, period: Column) -> Column:
    """As in_period, with a period per row."""
    age = (F.lit(epoch_ms(now)) - col(created_ms)) / F.lit(1000.0)
    return period.isNull() | (period == 0) | (age <= period)


def next_page_suffix(path: Column | str, cursor: Column | str) -> Column:
    """Query string that asks for the page after `cursor`."""
    # url_encode follows form encoding of another language: `*` and `~` differ from the site's.
    after = F.replace(
        F.replace(F.url_encode(F.coalesce(col(cursor), F.lit("None"))), F.lit("*"), F.lit("%2A")),
        F.lit("%7E"), F.lit("~"))
    lead = F.when(F.contains(col(path), F.lit("top")), "&").otherwise("/?")
    return F.concat(lead, F.lit(f"count={PAGE_SIZE}&after="), after)


def absolute_url(base: str, path: Column | str) -> Column:
    return F.concat(F.lit(base), col(path))


def empty_to_null(value: Column | str) -> Column:
    return F.nullif(col(value), F.lit(""))
