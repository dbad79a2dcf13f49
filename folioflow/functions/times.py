"""Column expressions over dates and timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_time(ts: Column) -> Column:
    """ISO text of a timestamp; the fraction appears only if it is not zero."""
    return F.when(
        F.extract(F.lit("SECOND"), ts) % 1 == 0,
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
    ).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def as_of_literal(as_of: datetime | str) -> Column:
    """One fixed timestamp for a whole run."""
    return F.lit(str(as_of)).cast("timestamp_ntz")
