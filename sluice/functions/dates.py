"""Date and time expressions; text that is no date becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed form of an HTTP date, for example "Wed, 05 Mar 2025 09:10:11 GMT".
HTTP_DATE = (
    r"(?i)^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun), "
    r"(\d{1,2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) \d{4} \d{1,2}:\d{1,2}:\d{1,2}) (?:GMT|UTC)$"
)


def http_last_modified(text: Column) -> Column:
    """Instant of a ``Last-Modified`` header."""
    # Spark parses no day names, so the rest is cut out; no match leaves a text that fails to parse.
    moment = F.concat(F.regexp_extract(text, HTTP_DATE, 1), F.lit(" UTC"))
    return F.try_to_timestamp(moment, F.lit("d MMM yyyy H:m:s z"))


def coerce_date(text: Column) -> Column:
    return text.try_cast("date")


def period_columns(date_text: Column) -> dict[str, Column]:
    """Year and month of a date text."""
    day = coerce_date(date_text)
    return {"ano": F.year(day), "mes": F.month(day)}
