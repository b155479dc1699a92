"""Quality filters and flags of shots. Missing values never pass a filter and leave a flag null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lidarlattice.functions.metrics import nan_to_null
from lidarlattice.schema import COVERAGE_BEAMS, DEGRADE_OK, MISSING, POWER_BEAMS


def within(c: str, low: float, high: float) -> Column:
    """low < c <= high, false for NaN, which is above every number."""
    return (F.col(c) > low) & (F.col(c) <= high)


def _sensitivity(least: float, least_tropical: float, strict: bool) -> Column:
    """sens_a2 above the limit of its forest type. The forest type of a shot without `pft` is unknown in the tropical regions, and such shots do not pass."""
    tropical = (F.col("pft") == 2) & F.coalesce(F.col("region").isin(4, 5, 6), F.lit(False))
    limit = F.when(tropical, least_tropical).when(~tropical, least)
    return F.col("sens_a2") > limit if strict else F.col("sens_a2") >= limit


def _options(ground: str, flags: dict[str, bool], apply_deg_flag: bool, max_dem_diff: float | None, night_coverage_only: bool, leaf_on_only: bool, max_waterp: float | None, max_urban: float | None) -> Column:
    """What the three products' filters may ask for beside their base ranges."""
    ok = F.lit(True)
    for name, used in flags.items():
        if used:
            ok &= F.col(name) == 1
    if max_dem_diff is not None:
        ok &= F.abs(F.col("elev_dem_tdx") - F.col(ground)) < max_dem_diff
    if max_waterp is not None:
        ok &= F.col("ls_waterp") < max_waterp
    if max_urban is not None:
        ok &= F.col("urb_prop") < max_urban
    if apply_deg_flag:
        ok &= F.col("deg_flag").isin(*DEGRADE_OK)
    if leaf_on_only:
        ok &= F.col("leafoff_flag") != 1
    if night_coverage_only:
        ok &= F.col("beam").isin(*POWER_BEAMS) | (F.col("beam").isin(*COVERAGE_BEAMS) & (F.col("sol_elev") < 0))
    return ok


def _usable(ground: str, height: str | None, *sensitivities: str) -> Column:
    """The base ranges: sensitivity, surface and stale flags, ground elevation, and height where the product has it."""
    ok = (F.col("surf_flag") == 1) & (F.col("stale_flag") == 0) & (F.col(ground) > -200) & (F.col(ground) < 9000)
    for s in sensitivities:
        ok &= within(s, 0.9, 1.0)
    return ok & (F.col(height) >= 0) & (F.col(height) < 120) if height else ok


def filter_l2a(
    df: DataFrame, apply_qflag: bool = True, apply_deg_flag: bool = True, min_sens: float = 0.95, min_sens_tropical: float = 0.98, max_dem_diff: float | None = 150, night_coverage_only: bool = False,
    leaf_on_only: bool = False, max_waterp: float | None = 10, max_urban: float | None = 50, algorithm: int = 0,
) -> DataFrame:
    """Shots fit for use: base ranges, product flag, sensitivity by forest type, elevation difference, cover limits.

    `algorithm` names the ground algorithm whose elevation and height are looked at.
    """
    ground = f"elev_lm_a{algorithm}"
    ok = _usable(ground, f"rh_100_a{algorithm}", "sens_a0", "sens_a2") & _sensitivity(min_sens, min_sens_tropical, strict=True)
    return df.where(ok & _options(ground, {"l2a_qflag_a0": apply_qflag}, apply_deg_flag, max_dem_diff, night_coverage_only, leaf_on_only, max_waterp, max_urban))


def filter_l2b(
    df: DataFrame, apply_l2a_qflag: bool = True, apply_l2b_qflag: bool = True, apply_algrun: bool = True, apply_deg_flag: bool = True, max_dem_diff: float | None = 150, night_coverage_only: bool = False,
    leaf_on_only: bool = False, max_waterp: float | None = 10, max_urban: float | None = 50,
) -> DataFrame:
    """Shots of the second product fit for use: as filter_l2a, with its own flags and no sensitivity by forest type."""
    flags = {"l2b_algrun_flag": apply_algrun, "l2a_qflag_a0": apply_l2a_qflag, "l2b_qflag_a0": apply_l2b_qflag}
    return df.where(_usable("elev_lm_a0", "rh_100_a0", "sens_a0") & _options("elev_lm_a0", flags, apply_deg_flag, max_dem_diff, night_coverage_only, leaf_on_only, max_waterp, max_urban))


def filter_l4a(
    df: DataFrame, apply_l2a_qflag: bool = True, apply_l4a_qflag: bool = True, apply_algrun: bool = False, apply_deg_flag: bool = False, fix_sens: bool = False, min_sens: float = 0.95, min_sens_tropical: float = 0.98,
    night_coverage_only: bool = False, leaf_on_only: bool = False, max_waterp: float | None = None, max_urban: float | None = None,
) -> DataFrame:
    """Shots of the biomass product fit for use. The sensitivity rule by forest type is applied only with `fix_sens`."""
    flags = {"l4a_algrun_flag": apply_algrun, "l2a_qflag_a0": apply_l2a_qflag, "l4a_qflag_a0": apply_l4a_qflag}
    ok = _usable("elev_lm_a0", None, "sens_a0", "sens_a2") & _options("elev_lm_a0", flags, apply_deg_flag, None, night_coverage_only, leaf_on_only, max_waterp, max_urban)
    return df.where(ok & _sensitivity(min_sens, min_sens_tropical, strict=False) if fix_sens else ok)


def hq_flags(df: DataFrame, remove: bool = False) -> DataFrame:
    """Append l2_hqflag and l4a_hqflag (null where a comparison is undecided); `remove` keeps high-quality shots only."""
    number = nan_to_null
    l2 = (
        F.coalesce(F.col("deg_flag").isin(*DEGRADE_OK), F.lit(False)) & (F.col("l2b_algrun_flag") == 1) & (F.col("l2b_qflag_a0") == 1) & (F.col("ls_waterp") < 10) & (F.col("urb_prop") < 50)
        & (F.col("leafoff_flag") != 1) & (F.col("loc_out_umd") == 0) & (number("pai_a0") >= 0) & (number("pai_l1") >= 0) & (number("pavd_0_5") >= 0)
        & number("cover_a0").between(0, 1) & number("cover_l1").between(0, 1) & (F.abs(F.col("elev_dem_tdx") - F.col("elev_lm_a0")) < 150)
    )
    df = df.withColumn("l2_hqflag", l2.cast("int"))
    df = df.withColumn("l4a_hqflag", ((F.col("l2_hqflag") == 1) & (F.col("l4a_algrun_flag") == 1) & (F.col("l4a_qflag_a0") == 1) & (number("agbd_a0") >= 0)).cast("int"))
    return df.where("l2_hqflag = 1") if remove else df


def ground_veg_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("loc_out_umd = 0"), df.where("l2_hqflag = 1")


def valid(metric: str) -> Column:
    """Above the missing code, finite, not null (NaN is above every number, so below infinity says that too)."""
    c = F.col(metric)
    return (c > MISSING) & (c < float("inf"))


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)
