"""Sentinels, fixed value lists and default settings."""

from __future__ import annotations

MISSING = -9999.0

#: Accepted degrade flags.
DEGRADE_OK = (0, 3, 8, 10, 13, 18, 20, 23, 28, 30, 33, 38, 40, 43, 48, 60, 63, 68)
#: Beams by strength.
POWER_BEAMS = ("BEAM0101", "BEAM0110", "BEAM1000", "BEAM1011")
COVERAGE_BEAMS = ("BEAM0000", "BEAM0001", "BEAM0010", "BEAM0011")
#: Columns whose missing code is 255, and 32767.
NODATA_255 = ("leafoff_flag", "ls_treecov", "pft", "ls_waterp", "urb_prop")
NODATA_32767 = ("leafoff_doy", "leafon_doy")

PAVD = [f"pavd_{5 * i}_{5 * i + 5}" for i in range(20)]
RH_VALUES = (*range(0, 90, 5), 90, 92, 95, 98, 99, 100)

#: Histogram bounds and step of each metric (min, max, step).
BINS = {
    "date_dec": (2019.0, 2023.5, 0.08333333),
    "elev_lm_a0": (-200.0, 9000.0, 200.0),
    "num_modes_a0": (1.0, 20.0, 1.0),
    "sens_a0": (0.9, 1.0, 0.005),
    "rh_50_a0": (-99.0, 120.0, 1.5),
    "rh_95_a0": (-99.0, 120.0, 3.0),
    "rh_98_a0": (-99.0, 120.0, 3.0),
    "pai_a0": (0.0, 12.0, 0.25),
    "fhd_pai_1m_a0": (0.0, 4.0, 0.1),
    "fhd_pavd_5m_a0": (0.0, 4.0, 0.1),
    "cover_a0": (0.0, 1.0, 0.05),
    "even_pavd_5m_a0": (0.0, 1.0, 0.05),
    "agbd_a0": (0.0, 8000.0, 20.0),
    "agbd_a0_qf": (0.0, 8000.0, 20.0),
    "pavd_max_h": (0.0, 100.0, 5.0),
    "even_pai_1m_a0": (0.0, 2.0, 0.01),
    **{m: (0.0, 1.0, 0.025) for m in ("pavd_0_5_frac", "pavd_bot_frac", "pavd_top_frac", "rhvdr_b", "rhvdr_m", "rhvdr_t")},
    **{m: (0.0, 1.0, 0.01) for m in PAVD[:16]},
}

#: The five annual windows of the published run and the window of the full mission (inclusive dates).
WINDOWS = [("2019-04-17", "2019-12-31"), ("2020-01-01", "2020-12-31"), ("2021-01-01", "2021-12-31"), ("2022-01-01", "2022-12-31"), ("2023-01-01", "2023-03-16"), ("2019-04-17", "2023-03-16")]
RESOLUTIONS = (1000, 6000, 12000)

#: Order of the columns of an exported shot table (163 names).
EXPORT = [
    *"shot_num orbit sub_orbit ease72_og beam beam_azim beam_elev delta_time date_dec date time doy sol_elev sol_azim lon_lm_a0 lat_lm_a0 elev_lm_a0 elev_hr_a0 elev_dem_srtm elev_dem_tdx elev_diff_dem".split(),
    *"stale_flag deg_flag surf_flag loc_out_umd l2a_selalg_a0".split(),
    *[f"l2a_qflag_a{n}" for n in range(7)],
    "l2_hqflag",
    *[f"sens_a{n}" for n in (*range(7), 10)],
    *"energy_total ls_treecov ls_waterp leafoff_flag leafoff_doy leafon_doy pft region urb_prop num_modes_a0".split(),
    *[f"rh_{p}_a0" for p in RH_VALUES],
    *"rhvdr_b rhvdr_m rhvdr_t l2b_algrun_flag l2b_qflag_a0 pgap_theta_a0 pgap_theta_err_a0 fhd_pai_1m_a0".split(),
    *[f"{kind}_{n}" for kind in ("cover", "pai") for n in ("a0", *[f"l{i}" for i in range(1, 22)])],
    *PAVD,
    *"pavd_0_5_frac pavd_bot_frac pavd_top_frac pavd_max_h even_pai_1m_a0 fhd_pavd_5m_a0 even_pavd_5m_a0".split(),
    *"l4a_algrun_flag l4a_qflag_a0 l4a_hqflag l4a_pred_strat agbd_a0 agbd_se_a0 agbd_pi_low_a0 agbd_pi_upper_a0".split(),
]

#: The metrics that are gridded: dates, heights, cover and plant area, profile bins and what is derived from them, biomass with and without its own flag.
GRID_METRICS = list(BINS)
