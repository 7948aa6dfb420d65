"""Ages, age buckets and state codes as native column expressions."""

from __future__ import annotations

import calendar as _cal
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A year is 365 days of seconds for every age computation.
SECONDS_PER_YEAR = 60 * 60 * 24 * 365

# Age buckets (lower bound inclusive, code, label) of the brand
# segmentation; ages under 16 get code 99, label "Other".
BRAND_AGE_BUCKETS = [
    (16, 0, "16-19"),
    (20, 1, "20-24"),
    (25, 2, "25-29"),
    (30, 3, "30-39"),
    (40, 4, "40-49"),
    (50, 5, "50-59"),
    (60, 6, "more than 60"),
]

# Age buckets of the item-profile segmentation.
PROFILE_AGE_BUCKETS = [
    (16, 0, "16-21"),
    (22, 1, "22-29"),
    (30, 2, "30-49"),
    (50, 3, "more than 50"),
]

OTHER_AGE_CODE = 99
OTHER_AGE_LABEL = "Other"
STATE_PREFIX = "US-"
UNKNOWN_STATE = "DESC"


def as_of_seconds(as_of: dt.date | str) -> int:
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    return _cal.timegm(d.timetuple())


def age_seconds(birthdate: Column, as_of: dt.date | str) -> Column:
    """Seconds lived at ``as_of`` midnight UTC."""
    return F.lit(as_of_seconds(as_of)) - F.unix_timestamp(birthdate)


def whole_age(birthdate: Column, as_of: dt.date | str) -> Column:
    """Integer years, truncating toward zero (the cast truncates)."""
    return (age_seconds(birthdate, as_of) / F.lit(SECONDS_PER_YEAR)).cast("bigint")


def age_code(age: Column, buckets: list[tuple[int, int, str]]) -> Column:
    """Map a whole age to its bucket code; below the first bound -> 99."""
    expr = F.lit(OTHER_AGE_CODE)
    for lower, code, _ in buckets:  # later (higher) bounds win
        expr = F.when(age >= lower, F.lit(code)).otherwise(expr)
    return expr.cast("int")


def age_label(code: Column, buckets: list[tuple[int, int, str]]) -> Column:
    expr = F.lit(OTHER_AGE_LABEL)
    for _, c, label in reversed(buckets):
        expr = F.when(code == c, F.lit(label)).otherwise(expr)
    return expr


def known_states(df: DataFrame, state_col: str, state_map: DataFrame) -> DataFrame:
    """Keep rows whose state is in the (small) state map; add ``abbreviation``.

    No broadcast hint: the map is a small dimension, and AQE turns the join
    into a broadcast hash join after checking its real size at run time
    (``spark.sql.autoBroadcastJoinThreshold``); a map that grew past the
    threshold would fall back to a sort-merge join instead of failing.
    """
    sm = state_map.select(F.col("name").alias("_state_name"), "abbreviation")
    return (df.join(sm, F.col(state_col) == F.col("_state_name"), "inner")
            .drop("_state_name"))


def state_code(abbreviation: Column) -> Column:
    return F.concat(F.lit(STATE_PREFIX), F.coalesce(abbreviation, F.lit(UNKNOWN_STATE)))
