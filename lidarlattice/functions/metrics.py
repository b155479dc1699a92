"""Derived structure metrics of a shot, from arrays of its profile bins.

Every value that several metrics need (sums and the entropy of the profile) is one column
of a first projection, so that no function over an array stands within another, and each
is evaluated once a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lidarlattice.functions.geo import col
from lidarlattice.schema import MISSING, PAVD


def nan_to_null(c) -> Column:
    return F.nanvl(col(c), F.lit(None).cast("double"))


def bins() -> Column:
    return F.array(*PAVD)


def profile_sums() -> dict[str, Column]:
    """What the metrics share, under names with a leading underscore.

    _all sums every bin (null if one is missing). _sum, _vlogv and _top look at the filled
    bins only: their sum, the sum of v ln v, and the index of the highest one. _max is the
    fullest bin's value: where it is the sum, one bin is filled.
    """
    over = lambda f: F.aggregate(bins(), F.lit(0.0), lambda a, v: a + F.when(v > 0, f(v)).otherwise(F.lit(0.0)))
    return {
        "_all": reduce(lambda a, b: a + b, map(F.col, PAVD)),
        "_sum": over(lambda v: v),
        "_vlogv": over(lambda v: v * F.ln(v)),
        "_top": F.array_max(F.transform(bins(), lambda v, i: F.when(v > 0, i + 1).otherwise(0))),
        "_max": F.array_max(bins()),
    }


def pavd_0_5_frac() -> Column:
    """Share of the lowest bin; 1 for shots of 5 m or less; null for a zero or missing profile."""
    return F.when(F.col("rh_100_a0") > 5, F.try_divide(F.col(PAVD[0]), F.col("_all"))).when(F.col("rh_100_a0") <= 5, F.lit(1.0))


def pavd_max_h() -> Column:
    """Upper height of the first fullest bin."""
    return F.array_position(bins(), F.col("_max")).cast("double") * 5


def rhvdr() -> dict[str, Column]:
    """Three vertical distribution ratios, -9999 where heights are too low or negative."""
    r = {p: F.col(f"rh_{p}_a0") for p in (25, 50, 75, 98, 100)}
    ok = (r[100] > 5) & (r[98] > 0) & (r[25] >= 0) & (r[50] >= 0) & (r[75] >= 0)
    parts = {"rhvdr_b": r[50], "rhvdr_m": r[75] - r[25], "rhvdr_t": r[98] - r[50]}
    return {k: F.when(ok, F.try_divide(v, r[98])).otherwise(F.lit(MISSING)) for k, v in parts.items()}


def even_pai_1m() -> Column:
    """Evenness of the 1 m profile; null where ln(ceil(height)) is not positive."""
    top = F.when(F.col("rh_100_a0") > 0, F.ln(F.ceil("rh_100_a0").cast("double")))
    return F.try_divide(F.col("fhd_pai_1m_a0"), F.when(top > 0, top))


def _entropy() -> Column:
    """-sum p ln p over the filled bins: ln of their sum less sum(v ln v) over it."""
    return F.ln("_sum") - F.col("_vlogv") / F.col("_sum")


def _profile_metric(value: Column, none_but_first: Column) -> Column:
    """`value`; 0 where `none_but_first`, -9999 for low canopies and empty profiles."""
    return F.when(~(F.col("rh_100_a0") > 5) | (F.col("_sum") == 0), F.lit(MISSING)).when(none_but_first, F.lit(0.0)).otherwise(value)


def fhd_pavd_5m() -> Column:
    return _profile_metric(_entropy(), F.col("_sum") == F.col("_max"))


def even_pavd_5m() -> Column:
    """Shannon over ln of the index of the highest filled bin."""
    return _profile_metric(F.when(F.col("_sum") == F.col("_max"), F.lit(0.0)).otherwise(_entropy() / F.ln(F.col("_top").cast("double"))), F.col("_top") == 1)


def pavd_bot_frac() -> Column:
    """Share of the profile below half the canopy height: its lowest k bins, k a tenth of the height in metres, rounded, 1 for low canopies."""
    k = F.when(F.rint(F.col("rh_100_a0") / 2) > 5, F.rint(F.col("rh_100_a0") / 10)).otherwise(F.lit(1.0)).cast("int")
    low = F.aggregate(F.slice(bins(), F.lit(1), F.greatest(k, F.lit(1))), F.lit(0.0), lambda a, v: a + v)
    return F.when(F.col("rh_100_a0") > 5, F.try_divide(low, F.col("_all"))).otherwise(F.lit(MISSING))


def with_metrics(df):
    """All derived metrics."""
    kept = df.columns
    df = df.withColumns(profile_sums())
    df = df.withColumns({"pavd_0_5_frac": pavd_0_5_frac(), "pavd_max_h": pavd_max_h(), **rhvdr(), "even_pai_1m_a0": even_pai_1m(), "fhd_pavd_5m_a0": fhd_pavd_5m(), "even_pavd_5m_a0": even_pavd_5m(), "pavd_bot_frac": pavd_bot_frac()})
    df = df.withColumn("pavd_top_frac", F.when(F.col("rh_100_a0") > 5, 1 - F.col("pavd_bot_frac")).otherwise(F.lit(MISSING)))
    return df.drop(*[c for c in df.columns if c.startswith("_") and c not in kept])


def nodata_recode(df, columns: dict[str, int]):
    """Source nodata codes become -9999, for the columns that are there."""
    return df.withColumns({c: F.when(F.col(c) == code, F.lit(int(MISSING))).otherwise(F.col(c)) for c, code in columns.items() if c in df.columns})


def histogram_bin(value, low: float, step: float) -> Column:
    """Right-closed bins with the lowest edge included, and a tolerance of 1e-7 of a bin."""
    return F.greatest(F.lit(0), F.ceil((col(value) - F.lit(low)) / F.lit(step) - F.lit(1e-7)) - 1).cast("int")
