"""Date columns: mixed-format parse, epoch seconds, display formats, time bins.

Session time zone is UTC. Naive inputs are read as UTC; aware inputs are converted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.text import col_, full_trim

# RFC-822 weekday prefix ("Mon, "): Spark's parser rejects the pattern letter E.
_WEEKDAY = r"^[A-Za-z]{3},\s*"


def parse_published(c) -> Column:
    """Timestamp from ISO-8601 (aware or naive, 'T' or space) or RFC-822 (GMT/UT/zone name or
    +hhmm offset). Unparsable, empty or NULL -> NULL."""
    s = full_trim(col_(c))
    w = F.regexp_replace(s, _WEEKDAY, "")
    return F.coalesce(
        F.try_to_timestamp(s),
        F.try_to_timestamp(w, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(w, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(w, F.lit("d MMM yyyy HH:mm z")),
        F.try_to_timestamp(w, F.lit("d MMM yyyy HH:mm Z")),
    )



def epoch_to_ts(c) -> Column:
    return F.timestamp_seconds(F.coalesce(col_(c), F.lit(0)).cast("double"))


def iso_utc(ts) -> Column:
    """ISO-8601 text with a numeric UTC offset, e.g. 2024-01-05T03:04:05+00:00."""
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm:ssxxx")


def iso_naive(ts) -> Column:
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm:ss")


def zulu(ts) -> Column:
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def rfc822(ts) -> Column:
    return F.concat(F.date_format(col_(ts), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def display_short(ts) -> Column:
    """strftime('%b %e, %Y'): day padded with a space, e.g. 'Jan  8, 2024'."""
    t = col_(ts)
    return F.concat(F.date_format(t, "MMM"), F.lit(" "),
                    F.lpad(F.dayofmonth(t).cast("string"), 2, " "), F.lit(", "),
                    F.date_format(t, "yyyy"))


def display_long(ts) -> Column:
    """strftime('%B %d, %Y'), e.g. 'January 08, 2024'."""
    return F.date_format(col_(ts), "MMMM dd, yyyy")


def date_slug(ts) -> Column:
    return F.date_format(col_(ts), "yyyy-MM-dd")


def bin_start(ts, origin, days: int) -> Column:
    """Left-closed, left-labelled bin of `days` days counted from `origin` (a midnight)."""
    t, o = col_(ts), col_(origin)
    secs = F.unix_timestamp(t) - F.unix_timestamp(o)
    width = days * 86400
    return F.timestamp_seconds(F.unix_timestamp(o) + F.floor(secs / width) * width)
