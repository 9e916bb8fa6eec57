"""Scalar column functions (P6-P17). Each returns a ``Column``; all are JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P5, P6 ------------------------------------------------------------------------
def valid_customers(df: DataFrame) -> DataFrame:
    """Keep customer records with both an address and a birth day."""
    return df.where(F.col("email").isNotNull() & F.col("birthDay").isNotNull())


def birth_year(birth_day="birthDay") -> Column:
    """Year as text: the first '-' separated part of the date printed as text."""
    return F.split(_c(birth_day).cast("string"), "-").getItem(0)


# P7, P8 ------------------------------------------------------------------------
def line_colour(red="red", green="green", blue="blue") -> Column:
    """Colour of a stop; priority blue > green > red; null when no flag is true."""
    return (F.when(_c(blue) == F.lit(True), F.lit("blue"))
             .when(_c(green) == F.lit(True), F.lit("green"))
             .when(_c(red) == F.lit(True), F.lit("red")))


def transform_station(stations: DataFrame, keep=()) -> DataFrame:
    """Station record -> (station_id, station_name := stop_name, order, line)."""
    return stations.select(*keep, "station_id", F.col("stop_name").alias("station_name"),
                           "order", line_colour().alias("line"))


# P9, P10, P11 ------------------------------------------------------------------
def display_status(col) -> Column:
    """'partly_cloudy' -> 'Partly Cloudy'."""
    return F.initcap(F.regexp_replace(_c(col), "_", " "))


def display_temperature(col) -> Column:
    """Integer part, truncated toward zero."""
    return _c(col).cast("int")


def slot_status(col) -> Column:
    """Train status as stored in a slot: '_' becomes a space."""
    return F.regexp_replace(_c(col), "_", " ")


def display_train(col) -> Column:
    return F.coalesce(_c(col), F.lit(S.EMPTY_SLOT))


def colour_code(line="line") -> Column:
    out = None
    for name, code in S.LINE_COLOUR_CODES.items():
        out = (F.when(_c(line) == name, F.lit(code)) if out is None
               else out.when(_c(line) == name, F.lit(code)))
    return out.otherwise(F.lit(S.DEFAULT_COLOUR_CODE))


def line_rank(line="line") -> Column:
    """Board position of a line: blue 0, green 1, red 2."""
    return F.array_position(F.array(*[F.lit(x) for x in S.LINES]), _c(line)).cast("int") - 1


# P14 ---------------------------------------------------------------------------
def slug(col) -> Column:
    """lower; '/' -> '_and_'; space and '-' -> '_'; apostrophe removed."""
    return F.translate(F.replace(F.lower(_c(col)), F.lit("/"), F.lit("_and_")), " -'", "__")


# P15 ---------------------------------------------------------------------------
def known_lines(df: DataFrame, line="line") -> DataFrame:
    return df.where(_c(line).isin(*S.LINES))


# P16, P17 ----------------------------------------------------------------------
def whole_rides(col) -> Column:
    """int(round(x)) with round-half-to-even."""
    return F.bround(_c(col), 0).cast("int")


def step_entries(rides, ratio, steps) -> Column:
    """floor(rides * ratio / steps), never below zero."""
    return F.greatest(F.floor(_c(rides) * _c(ratio) / _c(steps)), F.lit(0)).cast("int")


def total_steps(step_seconds: int, mode: str = "reference") -> float:
    """Divisor for one simulation step.

    ``reference``: the length of the step in seconds (a fixed rule of the
    simulation that this reproduces). ``corrected``: the number of steps in an
    hour, which needn't be whole (half a step for two-hour steps).
    """
    if mode == "reference":
        return step_seconds
    if mode == "corrected":
        return 3600 / step_seconds
    raise ValueError(mode)


def day_kind(ts, calendar: str = "reference") -> Column:
    """weekday / saturday / sunday of a timestamp.

    ``reference`` keeps the original test ``dow >= 0 or dow < 5``, always true,
    so every day is a weekday. ``corrected`` uses Mon-Fri, Sat, Sun.
    """
    dow = F.weekday(_c(ts))  # 0 = Monday
    if calendar == "reference":
        return F.when(dow.isNotNull(), F.lit("weekday"))
    if calendar == "corrected":
        return (F.when(dow < 5, F.lit("weekday")).when(dow == 5, F.lit("saturday"))
                 .when(dow == 6, F.lit("sunday")))
    raise ValueError(calendar)


def slot_direction(col) -> Column:
    """Any direction other than 'a' is the b slot."""
    return F.when(_c(col) == "a", F.lit("a")).otherwise(F.lit("b"))
