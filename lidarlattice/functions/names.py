"""Names and dates: granule file names, delta time, decimal years, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lidarlattice.functions.geo import col
from lidarlattice.schema import COVERAGE_BEAMS, POWER_BEAMS


def base_name(path) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def granule_key(path) -> Column:
    """Year, day, time, orbit and sub-orbit: 23 characters of the file name from the tenth on."""
    return F.substring(base_name(path), 10, 23)


def extension(path) -> Column:
    return F.element_at(F.split(base_name(path), "\\."), -1)


def granule_orbit(path) -> Column:
    return F.element_at(F.split(base_name(path), "_"), 4)


def orbit_number(orbit) -> Column:
    """The number of an orbit's name: O08943 -> 8943."""
    return F.substring(col(orbit), 2, 5).cast("int")


def granule_sub_orbit(path) -> Column:
    return F.element_at(F.split(base_name(path), "_"), 5).cast("double")


def granule_date(key) -> Column:
    return F.date_add(F.make_date(F.substring(col(key), 1, 4).cast("int"), F.lit(1), F.lit(1)), F.substring(col(key), 5, 3).cast("int") - 1)


def decimal_date(at) -> Column:
    """Year and the elapsed part of it, by microseconds, for dates or timestamps without a zone."""
    t = col(at).cast("timestamp_ntz")
    start = lambda y: F.make_timestamp_ntz(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0.0))
    micros = lambda x: F.unix_micros(x.cast("timestamp"))
    y = F.year(t)
    return y + (micros(t) - micros(start(y))) / (micros(start(y + 1)) - micros(start(y))).cast("double")


def delta_time_fields(seconds) -> dict[str, Column]:
    """Seconds since 2018-01-01 UTC -> date, decimal year, time of day, day of year; the session's zone must be UTC."""
    t = F.timestamp_seconds(col(seconds) + F.lit(1514764800.0))
    return {"date": F.to_date(t), "date_dec": decimal_date(t), "time": F.date_format(t, "HH:mm:ss"), "doy": F.dayofyear(t)}


def beam_class(beam) -> Column:
    return F.when(col(beam).isin(*POWER_BEAMS), "power").when(col(beam).isin(*COVERAGE_BEAMS), "coverage")


def metric_label(metric) -> Column:
    return F.regexp_replace(col(metric), "_", "-")


def date_label(date) -> Column:
    return F.date_format(col(date), "yyyyMMdd")
