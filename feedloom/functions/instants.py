"""ISO instants in and out, independent of the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col_of

# Fixed value: the accepted instant form, with "Z" or a numeric offset. 24:00:00 is the
# end of the day and 23:59:60 a leap second.
ISO_INSTANT = (
    r"^-?\d{4}-\d{2}-\d{2}T"
    r"(24:00:00(\.0{1,9})?|23:59:60(\.\d{1,9})?|([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,9})?)"
    r"(Z|[+-]\d{2}:\d{2}(:\d{2})?)\z"
)


def as_instant(value: str | datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def parse_instant(text: str | Column) -> Column:
    """The instant the text names, or NULL. Dates alone are not instants."""
    matched = F.regexp_extract(F.upper(col_of(text)), ISO_INSTANT, 0)
    plain = F.replace(matched, F.lit("T23:59:60"), F.lit("T23:59:59"))
    plain = F.replace(plain, F.lit("T24:00:00"), F.lit("T00:00:00")).try_cast("timestamp")
    next_day = F.contains(matched, F.lit("T24:00:00"))
    return F.when(next_day, plain + F.expr("INTERVAL 1 DAY")).otherwise(plain)


def parse_instant_or(text: str | Column, run_at: str | datetime | Column) -> Column:
    """The instant the text names, else ``run_at`` (a parameter, so that re-runs agree)."""
    return F.coalesce(parse_instant(text), as_instant(run_at))


def iso_instant(instant: str | Column) -> Column:
    """ISO-8601 text in UTC with 0, 3 or 6 fraction digits, as instants print themselves."""
    seconds = F.unix_micros(col_of(instant)).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(20,0)")
    since_epoch = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    # A zone-less time prints as "date time[.fraction]" without trailing zeros.
    text = F.replace(
        (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since_epoch).cast("string"),
        F.lit(" "),
        F.lit("T"),
    )
    fraction = F.substring_index(text, ".", -1)
    padded = F.rpad(fraction, F.when(F.length(fraction) <= 3, 3).otherwise(6), F.lit("0"))
    return F.when(
        F.contains(text, F.lit(".")),
        F.concat(F.substring_index(text, ".", 1), F.lit("."), padded, F.lit("Z")),
    ).otherwise(F.concat(text, F.lit("Z")))
