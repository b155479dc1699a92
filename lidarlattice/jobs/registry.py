"""Registered queries over tables derived from the given ones, each with DuckDB SQL for the same rows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarlattice.functions import geo, metrics, names
from lidarlattice.jobs import workloads
from lidarlattice.operators import chunks, cover, gridding, joins, lineage, quality, validate, vector
from lidarlattice.schema import BINS, COVERAGE_BEAMS, DEGRADE_OK, GRID_METRICS, NODATA_255, NODATA_32767, PAVD, POWER_BEAMS, RH_VALUES, WINDOWS
from lidarlattice.sources import extract, files, stores, zones
from lidarlattice.sources import shots as src

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query, and the SQL that gives the same rows."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def r6(c) -> Column:
    return F.round(geo.col(c), 6)


def lit(x: float) -> str:
    s = repr(float(x))
    return s if "e" in s else s + "e0"


_NAMED = lambda columns: ", ".join(f"{e} as {n}" for n, e in columns.items())
SHOTS = src.shots_sql()
PX = f"({lit(geo.AXIS * geo.K0)} * radians(lon_lm_a0))"
_S = "sin(radians(lat_lm_a0))"
PY = f"({lit(geo.AXIS)} * ({lit(1 - geo.E2)} * ({_S} / (1e0 - {lit(geo.E2)} * {_S} * {_S}) - ln((1e0 - {lit(geo.E1)} * {_S}) / (1e0 + {lit(geo.E1)} * {_S})) / {lit(2 * geo.E1)})) / {lit(2 * geo.K0)})"
G = geo.GridSpec(1)


def cell_sql(res: float, x: str = "x", y: str = "y") -> tuple[str, str]:
    """Expressions of (row, col)."""
    return f"cast(floor(({lit(G.y0)} - {y}) / {lit(res)}) as bigint)", f"cast(floor(({x} - {lit(G.x0)}) / {lit(res)}) as bigint)"


OUT = "cast(case when ok % 17 = 0 then 1 else 0 end as int)"
_DEG = ", ".join(map(str, DEGRADE_OK))
_NUM = lambda c: f"(case when isnan({c}) then null else {c} end)"
L2 = (
    f"coalesce(deg_flag in ({_DEG}), false) and l2b_algrun_flag = 1 and l2b_qflag_a0 = 1 and ls_waterp < 10 and urb_prop < 50 and not (leafoff_flag = 1) and loc_out_umd = 0 and {_NUM('pai_a0')} >= 0 and {_NUM('pai_l1')} >= 0 "
    f"and {_NUM('pavd_0_5')} >= 0 and {_NUM('cover_a0')} between 0 and 1 and {_NUM('cover_l1')} between 0 and 1 and abs(elev_dem_tdx - elev_lm_a0) < 150"
)
L4 = f"l2_hqflag = 1 and l4a_algrun_flag = 1 and l4a_qflag_a0 = 1 and {_NUM('agbd_a0')} >= 0"
FLAGS = f"flagged0 as (select *, {OUT} as loc_out_umd from shots), flagged1 as (select *, case when {L2} then 1 when not ({L2}) then 0 end as l2_hqflag from flagged0), flagged as (select *, case when {L4} then 1 when not ({L4}) then 0 end as l4a_hqflag from flagged1)"
WIN = src.windows_sql(WINDOWS)
VEG = f"{SHOTS}, {FLAGS}, {WIN}, veg as (select f.*, {PX} as x, {PY} as y, w.win from flagged f join windows w on f.date between w.first_day and w.last_day where l2_hqflag = 1)"
FIRST = f"{VEG}, firsts as (select * from (select *, cast(floor(x / 30e0) as bigint) as fc, cast(floor(-y / 30e0) as bigint) as fr, row_number() over (partition by win, cast(floor(x / 30e0) as bigint), cast(floor(-y / 30e0) as bigint) order by date_dec, shot_num) as rn from veg) where rn = 1)"
VALID = lambda m: f"({m} > -9999 and not isnan({m}) and {m} < cast('inf' as double))"


_DEC = lambda t: f"year({t}) + date_diff('microsecond', make_timestamp(year({t}), 1, 1, 0, 0, 0.0), cast({t} as timestamp)) / cast(date_diff('microsecond', make_timestamp(year({t}), 1, 1, 0, 0, 0.0), make_timestamp(year({t}) + 1, 1, 1, 0, 0, 0.0)) as double)"


def shots(spark, d) -> DataFrame:
    return src.shots(spark, d)


def flagged(spark, d) -> DataFrame:
    return quality.hq_flags(shots(spark, d).selectExpr("*", f"{OUT} as loc_out_umd"))


def veg(spark, d) -> DataFrame:
    return workloads.windowed_veg(shots(spark, d).selectExpr("*", f"{OUT} as loc_out_umd"), src.windows(spark, WINDOWS))


def firsts(spark, d, columns: list[str]) -> DataFrame:
    return gridding.first_shot_per_fine_cell(veg(spark, d), ["x", "y", *columns])


# -- sources ---------------------------------------------------------------------------------


_AT = "datediff(date, date'2018-01-01') * 86400e0 + ok % 86400"
_LAND = "named_struct('landsat_treecover', ok % 100 * 1e0, 'landsat_water_persistence', ls_waterp, 'leaf_off_flag', leafoff_flag, 'leaf_off_doy', leafoff_doy, 'leaf_on_doy', (pk + 100) % 366, 'pft_class', pft, 'region_class', region, 'urban_proportion', urb_prop) as land_cover_data"


def _granule(product: str) -> str:
    return f"concat('/archive/SHOT0{product}_2020193060840_O', lpad(cast(orbit as string), 5, '0'), '_0', cast(sub_orbit as string), '_T00094_02_003_01_V002.h5') as granule"


def beams_l2a(spark, d) -> DataFrame:
    """The shots as decoded beam records: nested structs and a 101-value height profile."""
    others = ", ".join(f"'sensitivity_a{n}', sens_a2 - {n - 2} / 1000e0, 'quality_flag_a{n}', cast((ok + {n}) % 2 as int)" for n in range(1, 7))
    return shots(spark, d).selectExpr(
        "shot_num as shot_number", _granule("2_A"), "beam", f"{_AT} as delta_time", "lon_lm_a0 as lon_lowestmode", "lat_lm_a0 as lat_lowestmode", "elev_lm_a0 as elev_lowestmode", "elev_lm_a0 + rh_100_a0 as elev_highestreturn",
        "elev_dem_tdx + 2 as digital_elevation_model_srtm", "elev_dem_tdx as digital_elevation_model", "sol_elev as solar_elevation", "ok % 360 * 1e0 as solar_azimuth", "deg_flag as degrade_flag", "surf_flag as surface_flag", "l2a_qflag_a0 as quality_flag", "cast(1 + pk % 6 as int) as selected_algorithm",
        "sk * 10e0 as energy_total", "sens_a0 as sensitivity", "num_modes_a0 as num_detectedmodes",
        f"named_struct('stale_return_flag', stale_flag, {others}, 'lon_lowestmode_a1', lon_lm_a0, 'lat_lowestmode_a1', lat_lm_a0, 'elev_lowestmode_a1', elev_lm_a0 + 1, 'num_detectedmodes_a1', num_modes_a0, 'rh_a1', transform(sequence(0, 100), p -> rh_100_a0 * p)) as geolocation",
        _LAND, "transform(sequence(0, 100), p -> rh_100_a0 * p / 100e0) as rh",
    )


def beams_l2b(spark, d) -> DataFrame:
    z = ", ".join(PAVD)
    return shots(spark, d).where("pk % 10 <> 3").selectExpr(
        "shot_num as shot_number", _granule("2_B"), "beam", "rh_100_a0 * 100 as rh100", "cover_a0 as cover", "pai_a0 as pai", "fhd_pai_1m_a0 as fhd_normal", "1e0 + ok % 3 as omega", "0.5e0 as rossg", "1e0 - cover_l1 / 10 as pgap_theta", "cover_l1 / 100 as pgap_theta_error",
        "l2a_qflag_a0 as l2a_quality_flag", "l2b_qflag_a0 as l2b_quality_flag", "l2b_algrun_flag as algorithmrun_flag", "sens_a0 as sensitivity", "cast(1 + pk % 6 as int) as selected_l2a_algorithm", "num_modes_a0 as num_detectedmodes", "stale_flag as stale_return_flag", "surf_flag as surface_flag",
        f"named_struct('delta_time', {_AT}, 'solar_elevation', sol_elev, 'solar_azimuth', ok % 360 * 1e0, 'lon_lowestmode', lon_lm_a0, 'lat_lowestmode', lat_lm_a0, 'elev_lowestmode', elev_lm_a0, 'elev_highestreturn', elev_lm_a0 + rh_100_a0, 'digital_elevation_model', elev_dem_tdx, 'local_beam_azimuth', pk % 7 * 0.1e0, 'local_beam_elevation', 1.5e0, 'degrade_flag', deg_flag) as geolocation",
        _LAND, "transform(sequence(1, 30), i -> cover_l1 * i) as cover_z", "transform(sequence(1, 30), i -> pai_l1 * i) as pai_z", f"concat(array({z}), array_repeat(0e0, 10)) as pavd_z",
    )


def beams_l4a(spark, d) -> DataFrame:
    others = ", ".join(f"'sensitivity_a{n}', sens_a2 - {n - 2} / 1000e0" for n in (1, 2, 3, 4, 5, 6, 10))
    return shots(spark, d).where("sk % 7 <> 5").selectExpr(
        "shot_num as shot_number", _granule("4_A"), "beam", f"{_AT} as delta_time", "sol_elev as solar_elevation", "lon_lm_a0 as lon_lowestmode", "lat_lm_a0 as lat_lowestmode", "elev_lm_a0 as elev_lowestmode", "deg_flag as degrade_flag", "surf_flag as surface_flag", "sens_a0 as sensitivity",
        f"named_struct('stale_return_flag', stale_flag, {others}) as geolocation", "l2a_qflag_a0 as l2_quality_flag", "l4a_qflag_a0 as l4_quality_flag", "cast(1 + pk % 6 as int) as selected_algorithm", "l4a_algrun_flag as algorithm_run_flag", "cast(pk % 2 as int) as predictor_limit_flag",
        "cast(sk % 2 as int) as response_limit_flag", "agbd_a0 as agbd", "agbd_a0 / 10 as agbd_se", "agbd_a0 / 2 as agbd_pi_lower", "agbd_a0 * 2 as agbd_pi_upper", "pft as predict_stratum", _LAND,
    )


_WHEN = "(timestamp '2018-01-01' + to_microseconds(cast((date_diff('day', date '2018-01-01', date) * 86400 + ok % 86400) * 1000000 as bigint)))"
_TIME_SQL = {"delta_time": "date_diff('day', date '2018-01-01', date) * 86400e0 + ok % 86400", "date": f"cast({_WHEN} as date)", "date_dec": f"round({_DEC(_WHEN)}, 9)", "time": f"strftime({_WHEN}, '%H:%M:%S')", "doy": f"cast(dayofyear({_WHEN}) as int)"}
_ID_SQL = {"shot_num": "shot_num", "orbit": "'O' || lpad(cast(orbit as varchar), 5, '0')", "sub_orbit": "cast(sub_orbit as double)", "beam": "beam", **_TIME_SQL}
_LAND_SQL = {"ls_treecov": "ok % 100 * 1e0", "ls_waterp": "ls_waterp", "leafoff_flag": "leafoff_flag", "leafoff_doy": "leafoff_doy", "leafon_doy": "cast((pk + 100) % 366 as int)", "pft": "pft", "region": "region", "urb_prop": "urb_prop"}
_SAME = lambda names: {n: n for n in names.split()}
_SENS = lambda ns: {f"sens_a{n}": f"round(sens_a2 - {n - 2} / 1000e0, 9)" for n in ns}
_L2A_SQL = (
    _ID_SQL | _SAME("sol_elev lon_lm_a0 lat_lm_a0 elev_lm_a0 elev_dem_tdx stale_flag deg_flag surf_flag sens_a0 l2a_qflag_a0 num_modes_a0") | {"sol_azim": "ok % 360 * 1e0", "elev_hr_a0": "round(elev_lm_a0 + rh_100_a0, 6)", "elev_dem_srtm": "round(elev_dem_tdx + 2, 6)"}
    | {f"l2a_qflag_a{n}": f"cast((ok + {n}) % 2 as int)" for n in range(1, 7)} | {"l2a_selalg_a0": "cast(1 + pk % 6 as int)", "energy_total": "sk * 10e0"} | _LAND_SQL | _SENS(range(1, 7)) | {f"rh_{p}_a0": f"round(rh_100_a0 * {p} / 100e0, 6)" for p in RH_VALUES}
)
_L2A_A1_SQL = {"lon_lm_a1": "lon_lm_a0", "lat_lm_a1": "lat_lm_a0", "elev_lm_a1": "round(elev_lm_a0 + 1, 6)", "sens_a1": "round(sens_a2 + 1 / 1000e0, 9)", "l2a_qflag_a1": "cast((ok + 1) % 2 as int)", "num_modes_a1": "num_modes_a0", **{f"rh_{p}_a1": f"round(rh_100_a0 * {p} / 100e0, 6)" for p in RH_VALUES}}
_L2B_SQL = (
    _ID_SQL | _SAME("sol_elev lon_lm_a0 lat_lm_a0 elev_lm_a0 elev_dem_tdx stale_flag deg_flag surf_flag sens_a0 l2a_qflag_a0 l2b_qflag_a0 l2b_algrun_flag num_modes_a0 cover_a0 pai_a0 fhd_pai_1m_a0") | {"sol_azim": "ok % 360 * 1e0", "elev_hr_a0": "round(elev_lm_a0 + rh_100_a0, 6)", "beam_azim": "round(pk % 7 * 0.1e0, 6)", "beam_elev": "1.5e0", "l2a_sel_alg_a0": "cast(1 + pk % 6 as int)"}
    | {"omega": "1e0 + ok % 3", "rossg": "0.5e0", "pgap_theta_a0": "round(1e0 - cover_l1 / 10, 6)", "pgap_theta_err_a0": "round(cover_l1 / 100, 6)", "rh_100_a0": "round(rh_100_a0, 6)"} | _LAND_SQL | {f"cover_l{i}": f"round(cover_l1 * {i}, 6)" for i in range(1, 22)} | {f"pai_l{i}": f"round(pai_l1 * {i}, 6)" for i in range(1, 22)} | _SAME(" ".join(PAVD))
)
_L4A_SQL = (
    _ID_SQL | _SAME("sol_elev lon_lm_a0 lat_lm_a0 elev_lm_a0 stale_flag deg_flag surf_flag sens_a0 l2a_qflag_a0 l4a_qflag_a0 l4a_algrun_flag agbd_a0") | _SENS((1, 2, 3, 4, 5, 6, 10))
    | {"l2a_selalg_a0": "cast(1 + pk % 6 as int)", "agbd_pi_low_a0": "agbd_a0 / 2", "agbd_pi_upper_a0": "agbd_a0 * 2", "agbd_se_a0": "round(agbd_a0 / 10, 9)", "l4a_pred_lim_flag": "cast(pk % 2 as int)", "l4a_resp_lim_flag": "cast(sk % 2 as int)", "l4a_pred_strat": "cast(pft as varchar)"} | _LAND_SQL
)


def _as_sql(columns: dict[str, str], where: str = "true") -> str:
    return f"with {SHOTS} select {', '.join(f'{e} as {n}' for n, e in columns.items())} from shots where {where}"


def _as_given(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """All columns, those that SQL rounds rounded alike."""
    digits = {n: int(m[1]) for n, e in columns.items() if (m := re.match(r"round\(.*, (\d+)\)$", e))}
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in columns])


@register("extract_l2a", _as_sql(_L2A_SQL))
def extract_l2a(spark, d):
    out = extract.extract_l2a(beams_l2a(spark, d))
    assert set(out.columns) == set(_L2A_SQL)
    return _as_given(out, _L2A_SQL)


@register("profile_alt_algo", _as_sql({"shot_num": "shot_num"} | _L2A_A1_SQL))
def profile_alt_algo(spark, d):
    return _as_given(extract.extract_l2a(beams_l2a(spark, d), algorithms=(1,)), {"shot_num": "shot_num"} | _L2A_A1_SQL)


@register("extract_l2b", _as_sql(_L2B_SQL, "pk % 10 <> 3"))
def extract_l2b(spark, d):
    out = extract.extract_l2b(beams_l2b(spark, d))
    assert set(out.columns) == set(_L2B_SQL)
    return _as_given(out, _L2B_SQL)


@register("extract_l4a", _as_sql(_L4A_SQL, "sk % 7 <> 5"))
def extract_l4a(spark, d):
    out = extract.extract_l4a(beams_l4a(spark, d))
    assert set(out.columns) == set(_L4A_SQL)
    return _as_given(out, _L4A_SQL)


@register("profile_select", "select vec_id, " + ", ".join(f"round(cast(embedding[{p + 1}] as double), 6) as rh_{p}_a0" for p in (0, 5, 25, 50)) + " from embeddings")
def profile_select(spark, d):
    picked = extract.profile_select("embedding", (0, 5, 25, 50))
    return spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", *[r6(c).alias(n) for n, c in picked.items()])


@register("union_beams", f"with {SHOTS} select beam, count(*) as n from shots group by beam")
def union_beams(spark, d):
    s = shots(spark, d)
    return extract.union_beams([s.where(names.beam_class("beam") == kind) for kind in ("power", "coverage")]).groupBy("beam").agg(F.count("*").alias("n"))


# -- names and dates -------------------------------------------------------------------------

PATHS = src.file_paths_sql()


@register("granule_key", f"with {PATHS} select o_orderkey, substr(string_split(path_a, '/')[-1], 10, 23) as key, string_split(path_a, '.')[-1] as ext from paths")
def granule_key(spark, d):
    return src.file_paths(spark, d).select("o_orderkey", names.granule_key("path_a").alias("key"), names.extension("path_a").alias("ext"))


@register("granule_parts", f"with {PATHS} select o_orderkey, string_split(path_a, '_')[4] as orbit, cast(string_split(path_a, '_')[5] as double) as sub_orbit from paths")
def granule_parts(spark, d):
    return src.file_paths(spark, d).select("o_orderkey", names.granule_orbit("path_a").alias("orbit"), names.granule_sub_orbit("path_a").alias("sub_orbit"))


_GDATE = "cast(make_date(cast(substr(string_split(path_a, '/')[-1], 10, 4) as int), 1, 1) + (cast(substr(string_split(path_a, '/')[-1], 14, 3) as int) - 1) as date)"


@register("granule_date", f"with {PATHS}, g as (select o_orderkey, {_GDATE} as date from paths) select o_orderkey, date, round({_DEC('date')}, 6) as date_dec from g")
def granule_date(spark, d):
    return src.file_paths(spark, d).select("o_orderkey", names.granule_date(names.granule_key("path_a")).alias("date")).withColumn("date_dec", r6(names.decimal_date("date")))


@register("decimal_date", f"select event_id, round({_DEC('ts')}, 9) as date_dec from events")
def decimal_date(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", F.round(names.decimal_date("ts"), 9).alias("date_dec"))


@register("delta_time_fields", "with t as (select event_id, timestamp '2018-01-01' + to_microseconds(cast(floor(event_id * 1234.5e0) * 1000000 as bigint)) as ts from events) select event_id, cast(ts as date) as date, strftime(ts, '%H:%M:%S') as time, cast(dayofyear(ts) as int) as doy from t")
def delta_time_fields(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.floor(F.col("event_id") * F.lit(1234.5)).cast("double").alias("delta"))
    return e.select("event_id", *[c.alias(n) for n, c in names.delta_time_fields("delta").items() if n != "date_dec"])


@register("beam_class", f"with {SHOTS} select shot_num, case when beam in ({', '.join(repr(b) for b in POWER_BEAMS)}) then 'power' else 'coverage' end as kind, cast(orbit as varchar) || '-' || beam as track from shots")
def beam_class(spark, d):
    return shots(spark, d).select("shot_num", names.beam_class("beam").alias("kind"), geo.track_id("orbit", "beam").alias("track"))


_JOIN_GRANULES = f"with {PATHS}, k as (select *, substr(string_split(path_a, '/')[-1], 10, 23) as key from paths) select a.key, a.path_a as a, b.path_b as b, c.path_c as c from k a join k b on a.key = b.key join k c on a.key = c.key where b.o_orderkey % 10 <> 3 and c.o_orderkey % 7 <> 5"


@register("join_granules", _JOIN_GRANULES)
def join_granules(spark, d):
    """The files of three products, of which the second and third lack some."""
    p = src.file_paths(spark, d)
    return joins.join_granules({"a": p.select(F.col("path_a").alias("path")), "b": p.where("o_orderkey % 10 <> 3").select(F.col("path_b").alias("path")), "c": p.where("o_orderkey % 7 <> 5").select(F.col("path_c").alias("path"))})


register("join_granules_all", _JOIN_GRANULES)(join_granules)


@register("date_filter", f"with {PATHS}, g as (select substr(string_split(path_a, '/')[-1], 10, 23) as key, {_GDATE} as date from paths) select key from g where date between date '2019-04-17' and date '2023-03-16' and dayofyear(date) between 100 and 250")
def date_filter(spark, d):
    return joins.date_filter(src.file_paths(spark, d).select(names.granule_key("path_a").alias("key")), "2019-04-17", "2023-03-16", (100, 250))


@register("granule_count", f"with {PATHS}, g as (select {_GDATE} as date from paths) select count(*) as n, sum(cast(date between date '2019-04-17' and date '2023-03-16' as int)) as n_kept from g")
def granule_count(spark, d):
    g = src.file_paths(spark, d).select(names.granule_date(names.granule_key("path_a")).alias("date"))
    return g.agg(F.count("*").alias("n"), F.sum(F.col("date").between("2019-04-17", "2023-03-16").cast("int")).alias("n_kept"))


@register("already_done", "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber = 1)")
def already_done(spark, d):
    done = spark.read.parquet(f"{d}/lineitem.parquet").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.already_done(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey"), done, "o_orderkey")


@register("checksum_audit", "with f as (select doc_id, md5(text) as found from documents where doc_id % 11 <> 0), m as (select doc_id, case when doc_id % 7 = 0 then 'x' else md5(text) end as want from documents where doc_id % 13 <> 0) select coalesce(f.doc_id, m.doc_id) as name, case when want is null then 'unlisted' when found is null then 'missing' when found = want then 'ok' else 'changed' end as status from f full join m on f.doc_id = m.doc_id")
def checksum_audit(spark, d):
    t = spark.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id").alias("name"), F.encode("text", "UTF-8").alias("content"))
    manifest = t.where("name % 13 <> 0").select("name", F.when(F.col("name") % 7 == 0, "x").otherwise(F.md5("content")).alias("md5"))
    return joins.checksum_audit(t.where("name % 11 <> 0"), manifest)


_BBOX = f"with {SHOTS}, c as (select orbit, min(lon_lm_a0) as xmin, max(lon_lm_a0) as xmax, min(lat_lm_a0) as ymin, max(lat_lm_a0) as ymax from shots group by orbit) select orbit from c where xmin <= -112.1e0 and xmax >= -112.14e0 and ymin <= 34.9e0 and ymax >= 34.86e0"


@register("granule_bbox_query", _BBOX)
def granule_bbox_query(spark, d):
    catalog = shots(spark, d).groupBy("orbit").agg(F.min("lon_lm_a0").alias("xmin"), F.max("lon_lm_a0").alias("xmax"), F.min("lat_lm_a0").alias("ymin"), F.max("lat_lm_a0").alias("ymax"))
    return joins.granule_bbox_query(catalog, -112.14, 34.86, -112.1, 34.9).select("orbit")


register("granule_bbox_query_all", _BBOX)(granule_bbox_query)


_BOXES = {"box_id": "c_custkey", "xmin": "-112.15e0 + 0.28e0 * ((c_custkey * 7919) % 1009) / 1009e0", "ymin": "34.85e0 + 0.28e0 * ((c_custkey * 104729) % 1013) / 1013e0", "side": "0.00001e0 * power(2, c_custkey % 14)"}


@register("granule_boxes_query", f"with {SHOTS}, c as (select orbit, ln, min(lon_lm_a0) as xmin, max(lon_lm_a0) as xmax, min(lat_lm_a0) as ymin, max(lat_lm_a0) as ymax from shots group by orbit, ln, pk % 10), b as (select {_NAMED(_BOXES)} from customer) select box_id, orbit, count(*) as n from b join c on c.xmin <= b.xmin + side and c.xmax >= b.xmin and c.ymin <= b.ymin + side and c.ymax >= b.ymin group by all")
def granule_boxes_query(spark, d):
    """Boxes of many sizes, one for each customer, against the extents of parts of orbits, from points up."""
    span = {c: f(p) for p, x in (("lon_lm_a0", "x"), ("lat_lm_a0", "y")) for f, c in ((F.min, f"{x}min"), (F.max, f"{x}max"))}
    catalog = shots(spark, d).groupBy("orbit", "ln", F.expr("pk % 10").alias("part")).agg(*[c.alias(n) for n, c in span.items()])
    boxes = spark.read.parquet(f"{d}/customer.parquet").select(*[F.expr(e).alias(n) for n, e in _BOXES.items()]).selectExpr("box_id", "xmin", "ymin", "xmin + side as xmax", "ymin + side as ymax")
    return joins.granule_box_counts(catalog, boxes, "orbit")


@register("checksum_files", "with t as (select doc_id, md5(coalesce(text, '')) as md5 from documents), f as (select doc_id, md5 as found from t where doc_id % 11 <> 0), m as (select doc_id, case when doc_id % 7 = 0 then 'x' else md5 end as want from t where doc_id % 13 <> 0) select coalesce(f.doc_id, m.doc_id) as name, case when want is null then 'unlisted' when found is null then 'missing' when found = want then 'ok' else 'changed' end as status from f full join m on f.doc_id = m.doc_id")
def checksum_files(spark, d):
    """Every document as a file of its own but for some, against a list of which some entries are wrong and some are not there."""
    folder = re.sub("^file:/+", "/", files.shared_folder(spark))
    texts = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.concat(F.lit(f"{folder}/"), "doc_id", F.lit(".txt")).alias("path"))

    def write(batches):
        import pyarrow.fs

        pyarrow.fs.LocalFileSystem().create_dir(folder)
        for pdf in batches:
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                with pyarrow.fs.LocalFileSystem().open_output_stream(path) as out:
                    out.write(text.encode())
            yield pdf[["path"]]

    texts.where("doc_id % 11 <> 0").mapInPandas(write, "path string").write.format("noop").mode("overwrite").save()
    manifest = texts.where("doc_id % 13 <> 0").select("path", F.when(F.col("doc_id") % 7 == 0, "x").otherwise(F.md5("text")).alias("md5"))
    there = spark.read.format("binaryFile").load(f"file://{folder}").select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    return stores.audit_files(manifest, there).select(F.regexp_extract("path", r"(\d+)\.txt$", 1).cast("long").alias("name"), "status")


# -- projection and cells --------------------------------------------------------------------


@register("project_6933", f"with {SHOTS} select shot_num, round({PX}, 4) as x, round({PY}, 4) as y from shots")
def project_6933(spark, d):
    return shots(spark, d).select("shot_num", F.round(geo.project_x("lon_lm_a0"), 4).alias("x"), F.round(geo.project_y("lat_lm_a0"), 4).alias("y"))


_CELLS = [(f"{n}{res}", e) for res in (1000, 6000, 12000) for n, e in zip(("row", "col"), cell_sql(res, PX, PY), strict=True)]


@register("cell_key", f"with {SHOTS} select shot_num, " + ", ".join(f"{e} as {n}" for n, e in _CELLS) + " from shots")
def cell_key(spark, d):
    s = gridding.with_xy(shots(spark, d))
    return s.select("shot_num", *[c.alias(f"{n}{res}") for res in (1000, 6000, 12000) for n, c in (("row", geo.cell_row("y", geo.GridSpec(res))), ("col", geo.cell_col("x", geo.GridSpec(res))))])


@register("fine_cell_key", f"with {SHOTS} select shot_num, cast(floor({PX} / 30e0) as bigint) as fc, cast(floor(-{PY} / 30e0) as bigint) as fr, cast(floor((lon_lm_a0 + 180e0) / 0.00026949335e0) as bigint) as dc, cast(floor((90e0 - lat_lm_a0) / 0.00026949335e0) as bigint) as dr from shots")
def fine_cell_key(spark, d):
    dc, dr = geo.fine_cell_4326("lon_lm_a0", "lat_lm_a0")
    return gridding.with_xy(shots(spark, d)).select("shot_num", geo.fine_col("x").alias("fc"), geo.fine_row("y").alias("fr"), dc.alias("dc"), dr.alias("dr"))


CHUNK = "(lpad(cast(cast(abs(floor(lon_lm_a0)) as int) as varchar), 3, '0') || case when floor(lon_lm_a0) < 0 then 'W' else 'E' end || lpad(cast(cast(abs(floor(lat_lm_a0)) as int) as varchar), 2, '0') || case when floor(lat_lm_a0) < 0 then 'S' else 'N' end)"


@register("chunk_id", f"with {SHOTS} select shot_num, {CHUNK} as chunk_id from shots")
def chunk_id(spark, d):
    return shots(spark, d).select("shot_num", geo.chunk_id("lon_lm_a0", "lat_lm_a0").alias("chunk_id"))


@register("chunk_bounds", f"with {SHOTS} select distinct {CHUNK} as chunk_id, floor(lon_lm_a0) - 0.25e0 as xmin, floor(lat_lm_a0) - 0.25e0 as ymin, floor(lon_lm_a0) + 1.25e0 as xmax, floor(lat_lm_a0) + 1.25e0 as ymax from shots")
def chunk_bounds(spark, d):
    return chunks.with_chunk(shots(spark, d)).select("chunk_id").distinct().select("chunk_id", *[c.alias(n) for n, c in geo.chunk_bounds("chunk_id", buffer=0.25).items()])


@register("distinct_chunks", f"with {SHOTS} select distinct {CHUNK} as chunk_id from shots order by 1")
def distinct_chunks(spark, d):
    return chunks.with_chunk(shots(spark, d)).select("chunk_id").distinct().orderBy("chunk_id")


@register("bbox_filter", f"with {SHOTS} select shot_num, cast(lon_lm_a0 >= -112.1e0 and lon_lm_a0 < -112e0 and lat_lm_a0 >= 34.9e0 and lat_lm_a0 < 35e0 as int) as inner_box from shots where lon_lm_a0 between -112.12e0 and -111.98e0 and lat_lm_a0 between 34.88e0 and 35.02e0")
def bbox_filter(spark, d):
    kept = shots(spark, d).where(geo.in_bbox("lon_lm_a0", "lat_lm_a0", -112.12, 34.88, -111.98, 35.02))
    return kept.select("shot_num", geo.in_bbox("lon_lm_a0", "lat_lm_a0", -112.1, 34.9, -112.0, 35.0, half_open=True).cast("int").alias("inner_box"))


@register("clip_polygon", f"with {SHOTS} select shot_num from shots where lat_lm_a0 >= 34.9e0 and lat_lm_a0 < 35.1e0 and lon_lm_a0 >= -112.1e0 and (lon_lm_a0 + 112.1e0) / 0.2e0 + (lat_lm_a0 - 34.9e0) / 0.2e0 < 1e0")
def clip_polygon(spark, d):
    return shots(spark, d).where(geo.in_polygon("lon_lm_a0", "lat_lm_a0", [(-112.1, 34.9), (-111.9, 34.9), (-112.1, 35.1)])).select("shot_num")


_TRIANGLES = "polys as (select n_nationkey as polygon_id, -112.15e0 + 0.06e0 * (n_nationkey % 5) as px, 34.85e0 + 0.06e0 * (n_nationkey // 5) as py from nation)"


@register("clip_polygon_table", f"with {SHOTS}, {_TRIANGLES} select shot_num, polygon_id from shots, polys where lat_lm_a0 >= py and lat_lm_a0 < py + 0.07e0 and lon_lm_a0 >= px and (lon_lm_a0 - px) / 0.07e0 + (lat_lm_a0 - py) / 0.07e0 < 1e0")
def clip_polygon_table(spark, d):
    """Triangles that overlap a little: a shot may be in two."""
    corner = spark.read.parquet(f"{d}/nation.parquet").selectExpr("n_nationkey as polygon_id", "-112.15e0 + 0.06e0 * (n_nationkey % 5) as px", "34.85e0 + 0.06e0 * (n_nationkey div 5) as py")
    polygons = corner.selectExpr("polygon_id", "array(named_struct('x', px, 'y', py), named_struct('x', px + 0.07e0, 'y', py), named_struct('x', px, 'y', py + 0.07e0)) as vertices")
    return joins.polygon_tag(shots(spark, d).select("shot_num", "lon_lm_a0", "lat_lm_a0"), polygons).select("shot_num", "polygon_id")


_AROUND = {"polygon_id": "c_custkey", "cx": "-112.15e0 + 0.3e0 * ((c_custkey * 7919) % 1009) / 1009e0", "cy": "34.85e0 + 0.3e0 * ((c_custkey * 104729) % 1013) / 1013e0", "r": "0.004e0 + 0.001e0 * (c_custkey % 7)"}
#: Of each polygon: a diamond, a square hole in it, and a triangle beside it, as corners in radii from the middle.
_RINGS = [[(1.0, 0.0), (0.0, 1.0), (-1.0, 0.0), (0.0, -1.0)], [(-0.25, -0.25), (0.25, -0.25), (0.25, 0.25), (-0.25, 0.25)], [(1.2, 0.0), (1.6, 0.0), (1.2, 0.4)]]
_CORNER = lambda p: (f"cx + {lit(p[0])} * r", f"cy + {lit(p[1])} * r")
_SIDES = ", ".join("{{'x1': {}, 'y1': {}, 'x2': {}, 'y2': {}}}".format(*_CORNER(a), *_CORNER(b)) for ring in _RINGS for a, b in zip(ring, ring[1:] + ring[:1], strict=True))


@register("clip_polygon_holes", f"with {SHOTS}, polys as (select {_NAMED(_AROUND)} from customer), sides as (select polygon_id, s.* from (select polygon_id, unnest([{_SIDES}]) as s from polys)), near as (select shot_num, polygon_id, lon_lm_a0 as px, lat_lm_a0 as py from shots join polys on lon_lm_a0 between cx - 2 * r and cx + 2 * r and lat_lm_a0 between cy - 2 * r and cy + 2 * r) select shot_num, polygon_id from near join sides using (polygon_id) where (y1 > py) <> (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 group by all having count(*) % 2 = 1")
def clip_polygon_holes(spark, d):
    """A polygon for each customer, of three rings, one of them a hole; they overlap."""
    rings = ", ".join("array({})".format(", ".join("named_struct('x', {}, 'y', {})".format(*_CORNER(p)) for p in ring)) for ring in _RINGS)
    polygons = spark.read.parquet(f"{d}/customer.parquet").select(*[F.expr(e).alias(n) for n, e in _AROUND.items()]).selectExpr("polygon_id", f"array({rings}) as rings")
    return cover.polygon_tag(shots(spark, d).select("shot_num", "lon_lm_a0", "lat_lm_a0"), polygons).select("shot_num", "polygon_id")


@register("perc_cover", f"with {VEG}, n as (select {cell_sql(6000)[0]} as row, {cell_sql(6000)[1]} as col, count(*) as n from veg group by all) select row, col, round(n * 490.8738521234052e0 / 36000000e0 * 100, 9) as perccover from n")
def perc_cover(spark, d):
    n = gridding.with_cell(veg(spark, d), 6000).groupBy("row", "col").agg(F.count("*").alias("n"))
    return n.select("row", "col", F.round(geo.perc_cover("n", 6000), 9).alias("perccover"))


# -- filters, flags, derived metrics ---------------------------------------------------------

_IN_TROPICS = "coalesce(region in (4, 5, 6), false)"
_LIMIT = f"(case when pft = 2 and {_IN_TROPICS} then 0.98e0 when not (pft = 2 and {_IN_TROPICS}) then 0.95e0 end)"
_BASE = "sens_a0 > 0.9e0 and sens_a0 <= 1e0 and surf_flag = 1 and stale_flag = 0 and elev_lm_a0 > -200 and elev_lm_a0 < 9000"
_TALL = "rh_100_a0 >= 0 and rh_100_a0 < 120"
_NEAR = "elev_dem_tdx - elev_lm_a0 < 150 and elev_dem_tdx - elev_lm_a0 > -150"
_OPTIONS = f"ls_waterp < 10 and urb_prop < 50 and deg_flag in ({_DEG}) and not (leafoff_flag = 1) and (beam in ({', '.join(repr(b) for b in POWER_BEAMS)}) or (sol_elev < 0 and beam in ({', '.join(repr(b) for b in COVERAGE_BEAMS)})))"
F2A = f"{_BASE} and sens_a2 > 0.9e0 and sens_a2 <= 1e0 and {_TALL} and l2a_qflag_a0 = 1 and sens_a2 > {_LIMIT} and {_NEAR}"


@register("filter_l2a", f"with {SHOTS} select shot_num from shots where {F2A} and {_OPTIONS}")
def filter_l2a(spark, d):
    return quality.filter_l2a(shots(spark, d), leaf_on_only=True, night_coverage_only=True).select("shot_num")


@register("filter_l2a_algorithm", f"with {SHOTS} select shot_num from shots where sens_a0 > 0.9e0 and sens_a0 <= 1e0 and surf_flag = 1 and stale_flag = 0 and elev_lm_a0 + 1 > -200 and elev_lm_a0 + 1 < 9000 and sens_a2 > 0.9e0 and sens_a2 <= 1e0 and {_TALL} and sens_a2 > {_LIMIT} and elev_dem_tdx - (elev_lm_a0 + 1) < 150 and elev_dem_tdx - (elev_lm_a0 + 1) > -150")
def filter_l2a_algorithm(spark, d):
    """By the elevation and height of another ground algorithm."""
    return quality.filter_l2a(extract.extract_l2a(beams_l2a(spark, d), algorithms=(0, 1)), apply_qflag=False, apply_deg_flag=False, max_waterp=None, max_urban=None, algorithm=1).select("shot_num")


@register("filter_l2b", f"with {SHOTS} select shot_num from shots where pk % 10 <> 3 and {_BASE} and {_TALL} and l2b_algrun_flag = 1 and l2a_qflag_a0 = 1 and l2b_qflag_a0 = 1 and {_NEAR} and {_OPTIONS}")
def filter_l2b(spark, d):
    return quality.filter_l2b(extract.extract_l2b(beams_l2b(spark, d), vprofs=False), leaf_on_only=True, night_coverage_only=True).select("shot_num")


@register("filter_l4a", f"with {SHOTS} select shot_num, coalesce(cast(sens_a2 >= {_LIMIT} as int), 0) as fixed, cast(l4a_algrun_flag = 1 and {_OPTIONS} as int) as strict from shots where sk % 7 <> 5 and {_BASE} and sens_a2 > 0.9e0 and sens_a2 <= 1e0 and l2a_qflag_a0 = 1 and l4a_qflag_a0 = 1")
def filter_l4a(spark, d):
    """By default, with the sensitivity rule, and with every option."""
    l4a = extract.extract_l4a(beams_l4a(spark, d))
    fixed = quality.filter_l4a(l4a, fix_sens=True).select("shot_num", F.lit(1).alias("f"))
    strict = quality.filter_l4a(l4a, apply_algrun=True, apply_deg_flag=True, night_coverage_only=True, leaf_on_only=True, max_waterp=10, max_urban=50).select("shot_num", F.lit(1).alias("s"))
    return quality.filter_l4a(l4a).join(fixed, "shot_num", "left").join(strict, "shot_num", "left").select("shot_num", F.coalesce("f", F.lit(0)).alias("fixed"), F.coalesce("s", F.lit(0)).alias("strict"))


#: Some shots whose leaf flag is not known: their flags stay undecided.
_NO_LEAF = "case when ok % 13 = 5 then null else leafoff_flag end"


@register("hq_flags", f"with {SHOTS.replace('shots as (', 'all_shots as (')}, shots as (select * replace ({_NO_LEAF} as leafoff_flag) from all_shots), {FLAGS} select shot_num, l2_hqflag, l4a_hqflag from flagged")
def hq_flags(spark, d):
    s = shots(spark, d).withColumn("leafoff_flag", F.expr(_NO_LEAF)).selectExpr("*", f"{OUT} as loc_out_umd")
    return quality.hq_flags(s).select("shot_num", "l2_hqflag", "l4a_hqflag")


@register("ground_veg_split", f"with {SHOTS}, {FLAGS} select 'ground' as part, count(*) as n from flagged where loc_out_umd = 0 union all select 'veg', count(*) from flagged where l2_hqflag = 1")
def ground_veg_split(spark, d):
    ground, vegetation = quality.ground_veg_split(flagged(spark, d))
    return ground.agg(F.count("*").alias("n")).select(F.lit("ground").alias("part"), "n").unionByName(vegetation.agg(F.count("*").alias("n")).select(F.lit("veg").alias("part"), "n"))


_CODES = dict.fromkeys(NODATA_255, 255) | dict.fromkeys(NODATA_32767, 32767)


@register("nodata_recode", f"with {SHOTS}, l as (select shot_num, {', '.join(f'{e} as {n}' for n, e in _LAND_SQL.items())} from shots) select shot_num, {', '.join(f'case when {c} = {code} then -9999 else {c} end as {c}' for c, code in _CODES.items())} from l")
def nodata_recode(spark, d):
    land = extract.extract_l2a(beams_l2a(spark, d)).select("shot_num", *_CODES)
    return metrics.nodata_recode(land, _CODES)


_NEEDED = ("lon_lm_a0", "lat_lm_a0", "elev_lm_a0", "date_dec", "orbit", "cover_a0", "pai_a0")


@register("drop_missing", f"with {SHOTS} select shot_num from shots where cover_a0 is not null and not isnan(pai_a0) and " + " and ".join(f"{c} is not null" for c in _NEEDED))
def drop_missing(spark, d):
    """Position, elevation, date and orbit, and two columns that do have missing values here."""
    return quality.drop_missing(shots(spark, d).select("shot_num", *_NEEDED), list(_NEEDED)).select("shot_num")


_SUM = " + ".join(PAVD)
_ARR = f"[{', '.join(PAVD)}]"
_POS = f"list_filter({_ARR}, lambda v: v > 0)"
_TOT = f"list_sum({_POS})"
_H = f"(- list_sum(list_transform({_POS}, lambda v: v / {_TOT} * ln(v / {_TOT}))))"
_TOP = f"list_max(list_transform({_ARR}, lambda v, i: case when v > 0 then i else 0 end))"
_HALF = "cast(case when round_even(rh_100_a0 / 2, 0) > 5 then round_even(rh_100_a0 / 10, 0) else 1 end as int)"
_BOT = f"coalesce(list_sum(({_ARR})[1:{_HALF}]), 0) / nullif({_SUM}, 0)"
_RV = lambda e: f"case when rh_100_a0 > 5 and rh_98_a0 > 0 and rh_25_a0 >= 0 and rh_50_a0 >= 0 and rh_75_a0 >= 0 then ({e}) / rh_98_a0 else -9999e0 end"
_DERIVED = {
    "pavd_0_5_frac": f"case when rh_100_a0 > 5 then pavd_0_5 / nullif({_SUM}, 0) when rh_100_a0 <= 5 then 1e0 end", "pavd_max_h": f"cast(list_position({_ARR}, list_max({_ARR})) * 5 as double)", "rhvdr_b": _RV("rh_50_a0"), "rhvdr_m": _RV("rh_75_a0 - rh_25_a0"), "rhvdr_t": _RV("rh_98_a0 - rh_50_a0"),
    "even_pai_1m_a0": "case when ceil(rh_100_a0) > 1 then fhd_pai_1m_a0 / ln(ceil(rh_100_a0)) end", "fhd_pavd_5m_a0": f"case when not (rh_100_a0 > 5) or len({_POS}) = 0 then -9999e0 when len({_POS}) = 1 then 0e0 else {_H} end",
    "even_pavd_5m_a0": f"case when not (rh_100_a0 > 5) or {_TOP} = 0 then -9999e0 when {_TOP} = 1 then 0e0 else {_H} / ln(cast({_TOP} as double)) end", "pavd_bot_frac": f"case when rh_100_a0 > 5 then {_BOT} else -9999e0 end", "pavd_top_frac": f"case when rh_100_a0 > 5 then 1 - {_BOT} else -9999e0 end",
}


@register("derived_metrics", f"with {SHOTS} select shot_num, {', '.join(f'round({e}, 6) as {n}' for n, e in _DERIVED.items())} from shots")
def derived_metrics(spark, d):
    names_ = ["pavd_0_5_frac", "pavd_max_h", "rhvdr_b", "rhvdr_m", "rhvdr_t", "even_pai_1m_a0", "fhd_pavd_5m_a0", "even_pavd_5m_a0", "pavd_bot_frac", "pavd_top_frac"]
    return metrics.with_metrics(shots(spark, d)).select("shot_num", *[(F.col(n) if n == "pavd_max_h" else r6(n)).alias(n) for n in names_])


# -- joins -----------------------------------------------------------------------------------


@register("join_l2", f"with {SHOTS} select shot_num, rh_100_a0, sens_a0, pai_l1 from shots where pk % 10 <> 3 and ln <> 4")
def join_l2(spark, d):
    a, b, _ = src.products(spark, d)
    a = a.join(shots(spark, d).where("ln <> 4").select("shot_num"), "shot_num", "left_semi")
    return joins.join_shots(a, b, ["shot_num", "lon_lm_a0", "lat_lm_a0"]).select("shot_num", "rh_100_a0", "sens_a0", "pai_l1")


@register("join_l2_all", f"with {SHOTS} select shot_num, case when {_BASE} then sens_a2 end as sens_a2, pai_l1 from shots where pk % 10 <> 3")
def join_l2_all(spark, d):
    a, b, _ = src.products(spark, d)
    kept = a.where("sens_a0 > 0.9e0 and sens_a0 <= 1e0 and surf_flag = 1 and stale_flag = 0 and elev_lm_a0 > -200 and elev_lm_a0 < 9000")
    return joins.join_shots(kept, b, ["shot_num", "lon_lm_a0", "lat_lm_a0"], join_all=True).select("shot_num", "sens_a2", "pai_l1")


@register("join_l2_l4a", f"with {SHOTS} select shot_num, rh_98_a0, cover_l1, agbd_a0 from shots where pk % 10 <> 3 and sk % 7 <> 5")
def join_l2_l4a(spark, d):
    a, b, c = src.products(spark, d)
    return joins.join_shots(joins.join_shots(a, b, ["shot_num"]), c, ["shot_num"]).select("shot_num", "rh_98_a0", "cover_l1", "agbd_a0")


@register("join_bucketed", f"with {SHOTS} select shot_num, rh_98_a0, cover_l1, agbd_a0 from shots where pk % 10 <> 3 and sk % 7 <> 5")
def join_bucketed(spark, d):
    """The three products stored in buckets of shots, and joined without an exchange."""
    path, names_ = files.shared_folder(spark), []
    for product, df in zip(("l2a", "l2b", "l4a"), src.products(spark, d), strict=True):
        names_.append(f"{product}_{uuid.uuid4().hex}")
        stores.write_bucketed(df, names_[-1], f"{path}/{product}", buckets=16)
    return stores.join_bucketed(spark, names_).select("shot_num", "rh_98_a0", "cover_l1", "agbd_a0")


_R72, _C72 = cell_sql(72000, PX, PY)
TAGGED = f"t0 as (select *, {_R72} as r72, {_C72} as c72 from shots), tagged as (select *, 'r' || cast(r72 as varchar) || 'c' || cast(c72 as varchar) as grid_id, cast(orbit as varchar) || cast(sub_orbit as varchar) || '-r' || cast(r72 as varchar) || 'c' || cast(c72 as varchar) as orbit_grid from t0 where c72 <> (select max(c72) from t0))"


def coarse_cells(spark, d) -> DataFrame:
    """All 72 km cells that shots lie in but the easternmost ones, with ids r{row}c{col}."""
    s = gridding.with_xy(shots(spark, d).select("lon_lm_a0", "lat_lm_a0"))
    c = s.select(geo.cell_col("x", joins.GRID72).alias("c72"), geo.cell_row("y", joins.GRID72).alias("r72")).distinct()
    last = c.agg(F.max("c72").alias("last"))
    return c.join(F.broadcast(last), F.col("c72") < F.col("last")).select("c72", "r72", F.concat(F.lit("r"), "r72", F.lit("c"), "c72").alias("grid_id"))


def tagged(spark, d) -> DataFrame:
    return joins.grid_tag(shots(spark, d), coarse_cells(spark, d))


def outlier_list(spark, d) -> DataFrame:
    return tagged(spark, d).where("orbit % 17 = 0").select(geo.orbit_grid_id("orbit", "sub_orbit", "grid_id").alias("orbit_grid")).distinct()


@register("grid_tag", f"with {SHOTS}, {TAGGED} select shot_num, grid_id, round({PX}, 3) as x from tagged")
def grid_tag(spark, d):
    return tagged(spark, d).select("shot_num", "grid_id", F.round("x", 3).alias("x"))


@register("orbit_grid_id", f"with {SHOTS}, {TAGGED} select shot_num, orbit_grid from tagged")
def orbit_grid_id(spark, d):
    return tagged(spark, d).select("shot_num", geo.orbit_grid_id("orbit", "sub_orbit", "grid_id").alias("orbit_grid"))


@register("outlier_flag", f"with {SHOTS}, {TAGGED} select shot_num, case when orbit % 17 = 0 then 1 else 0 end as loc_out_umd from tagged")
def outlier_flag(spark, d):
    return joins.outlier_flag(tagged(spark, d), outlier_list(spark, d)).select("shot_num", "loc_out_umd")


@register("outlier_remove", f"with {SHOTS}, {TAGGED} select shot_num from tagged where orbit % 17 <> 0")
def outlier_remove(spark, d):
    return joins.outlier_flag(tagged(spark, d), outlier_list(spark, d), remove=True).select("shot_num")


SUMMARY = f"fc as (select *, 'sub' || cast(sub_orbit as varchar) || '-' || cast(orbit % 20 as varchar) as file, {CHUNK} as chunk_id from flagged), summary as (select file, chunk_id, count(*) as n_filt_shots, sum(coalesce(cast(l2_hqflag = 1 as bigint), 0)) as n_l2_hq_shots, sum(coalesce(cast(l4a_hqflag = 1 as bigint), 0)) as n_l4a_hq_shots, sum(cast(loc_out_umd = 1 as bigint)) as n_locout_shots, min(lon_lm_a0) as xmin_shots, max(lon_lm_a0) as xmax_shots, min(lat_lm_a0) as ymin_shots, max(lat_lm_a0) as ymax_shots, min(date_dec) as date_dec_min, max(date_dec) as date_dec_max from fc group by file, chunk_id)"


def summaries(spark, d) -> DataFrame:
    f = flagged(spark, d).withColumn("file", F.concat(F.lit("sub"), "sub_orbit", F.lit("-"), F.col("orbit") % 20))
    return chunks.chunk_summary(chunks.with_chunk(f))


@register("chunk_summary", f"with {SHOTS}, {FLAGS}, {SUMMARY} select * from summary")
def chunk_summary(spark, d):
    s = summaries(spark, d)
    return s.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_l2_hq_shots", "n_l4a_hq_shots", "n_locout_shots")})


@register("neighbour_files", f"with {SHOTS}, {FLAGS}, {SUMMARY}, c as (select distinct chunk_id, (case substr(chunk_id, 4, 1) when 'W' then -1 else 1 end) * cast(substr(chunk_id, 1, 3) as int) as x, cast(substr(chunk_id, 5, 2) as int) as y from summary) select distinct c.chunk_id, s.file from c join summary s on xmin_shots <= x + 1 + 0.05e0 and xmax_shots >= x - 0.05e0 and ymin_shots <= y + 1 + 0.05e0 and ymax_shots >= y - 0.05e0")
def neighbour_files(spark, d):
    s = summaries(spark, d)
    return joins.neighbour_files(s, s.select("chunk_id"), 0.05)


@register("union_neighbours", f"with {SHOTS}, c as (select distinct {CHUNK} as chunk_id, floor(lon_lm_a0) as cx, floor(lat_lm_a0) as cy from shots) select chunk_id, count(*) as n, count(distinct shot_num) as shots from c join shots on lon_lm_a0 between cx - 0.05e0 and cx + 1.05e0 and lat_lm_a0 between cy - 0.05e0 and cy + 1.05e0 group by chunk_id")
def union_neighbours(spark, d):
    """The shots of every chunk with those around it."""
    return joins.with_neighbours(shots(spark, d), 0.05).groupBy("chunk_id").agg(F.count("*").alias("n"), F.countDistinct("shot_num").alias("shots"))


@register("window_join", f"with {SHOTS}, {WIN} select win, count(*) as n, count(distinct shot_num) as shots from shots join windows on date between first_day and last_day group by win")
def window_join(spark, d):
    return joins.window_join(shots(spark, d).select("shot_num", "date"), src.windows(spark, WINDOWS)).groupBy("win").agg(F.count("*").alias("n"), F.countDistinct("shot_num").alias("shots"))


@register("window_join_many", f"with {SHOTS}, w as (select o_orderkey as win, cast(o_orderdate + INTERVAL 24 YEAR as date) as first_day, cast(o_orderdate + INTERVAL 24 YEAR as date) + cast(o_orderkey % 400 - 5 as int) as last_day from orders), n as (select date, count(*) as n, sum(elev_lm_a0) as e from shots group by date) select win, cast(sum(n) as bigint) as n, round(sum(e) / sum(n), 6) as elev from n join w on date between first_day and last_day group by win")
def window_join_many(spark, d):
    """A window for each order, from none to 394 days long, and the shots in each."""
    w = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey as win", "add_months(cast(o_orderdate as date), 288) as first_day", "date_add(add_months(cast(o_orderdate as date), 288), cast(o_orderkey % 400 - 5 as int)) as last_day")
    days = shots(spark, d).groupBy("date").agg(F.count("*").alias("n"), F.sum("elev_lm_a0").alias("e"))
    return joins.window_join(days, w).groupBy("win").agg(F.sum("n").alias("n"), F.round(F.sum("e") / F.sum("n"), 6).alias("elev"))


@register("metric_date_pairs", f"with {SHOTS}, {WIN}, m as (select distinct 'rh_' || cast(l as varchar) || '_a0' as metric from (select unnest([25, 50, 75, 95, 98, 100]) as l) where exists (select 1 from shots where rh_100_a0 > 0)), r as (select distinct win from shots join windows on date between first_day and last_day) select metric, win from m, r")
def metric_date_pairs(spark, d):
    """The metrics that the shots have values of, with each window that holds shots."""
    used = joins.window_join(shots(spark, d), src.windows(spark, WINDOWS))
    return gridding.metric_windows(used, [f"rh_{p}_a0" for p in (25, 50, 75, 95, 98, 100)])


# -- gridding --------------------------------------------------------------------------------


@register("first_shot_per_fine_cell", f"with {FIRST} select win, fc, fr, shot_num, rh_98_a0 from firsts")
def first_shot_per_fine_cell(spark, d):
    return firsts(spark, d, ["rh_98_a0"]).select("win", "fc", "fr", "shot_num", "rh_98_a0")


@register("sort_shots", f"with {SHOTS} select shot_num, date_dec from shots order by date_dec, shot_num")
def sort_shots(spark, d):
    return shots(spark, d).select("shot_num", "date_dec").orderBy("date_dec", "shot_num")


def _counts_sql(res: float) -> str:
    row, col = cell_sql(res)
    return f"with {VEG} select win, {row} as row, {col} as col, count(date_dec) as shots_count, count(distinct orbit) as orbits_uniq, count(distinct cast(orbit as varchar) || '-' || beam) as tracks_uniq from veg group by all"


for _res in (1000, 12000):
    register(f"cell_counts_{_res}m", _counts_sql(_res))(lambda spark, d, res=_res: gridding.cell_counts(gridding.with_cell(veg(spark, d), res)))

METRICS = ["rh_98_a0", "cover_a0", "pai_a0", "agbd_a0"]


def _stats_sql(m: str, res: float, source: str = "firsts") -> str:
    row, col = cell_sql(res)
    v = "m"
    return (
        f"select win, {row} as row, {col} as col, '{m}' as metric, round(avg({v}), 6) as mean, round(quantile_cont({v}, 0.5), 6) as med, round(stddev_samp({v}), 6) as sd, round(quantile_cont({v}, 0.75) - quantile_cont({v}, 0.25), 6) as iqr, round(quantile_cont({v}, 0.95), 6) as p95, count({v}) as countf "
        f"from (select *, case when {VALID(m)} then {m} end as m from {source}) group by all having count({v}) > 1"
    )


def _rounded(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns if c in df.columns})


_STAT_COLUMNS = ("mean", "med", "sd", "iqr", "p95", "shan")


def _stats(spark, d, res, chosen=METRICS):
    return _rounded(gridding.mask_single(gridding.grid_stats(gridding.with_cell(firsts(spark, d, chosen), res), chosen)), _STAT_COLUMNS)


for _res in (1000, 6000, 12000):
    register(f"stat_builtin_{_res}m", f"with {FIRST} " + " union all ".join(_stats_sql(m, _res) for m in METRICS))(lambda spark, d, res=_res: _stats(spark, d, res))


def _shan_sql(m: str, res: float, source: str = "firsts") -> str:
    row, col = cell_sql(res)
    low, high, step = BINS[m]
    return (
        f"sv as (select win, {row} as row, {col} as col, {m} as v, greatest(0, cast(ceil(({m} - {lit(low)}) / {lit(step)} - 1e-7) as bigint) - 1) as bin from {source} where {VALID(m)}), "
        f"sb as (select win, row, col, bin, count(*) as c, max(cast(v < {lit(low)} or v > {lit(high)} as int)) as bad from sv group by all), sc as (select win, row, col, sum(c) as n, sum(c * ln(c)) as s from sb group by all), "
        f"so as (select win, max(bad) as bad from sb group by win), shan as (select win, row, col, case when n > 1 and bad = 0 then greatest(0e0, ln(n) - s / n) end as shan from sc join so using (win))"
    )


@register("stat_shan", f"with {FIRST}, {_shan_sql('rh_98_a0', 1000)} select win, row, col, round(shan, 6) as shan from shan")
def stat_shan(spark, d):
    return _rounded(gridding.shannon(gridding.with_cell(firsts(spark, d, ["rh_98_a0"]), 1000), "rh_98_a0"), ["shan"])


@register("grid_metric", f"with {FIRST}, {_shan_sql('cover_a0', 6000)}, g as ({_stats_sql('cover_a0', 6000)}) select g.*, round(shan, 6) as shan from g left join shan using (win, row, col)")
def grid_metric(spark, d):
    return _rounded(gridding.metric_grid(firsts(spark, d, ["cover_a0"]), "cover_a0", 6000), _STAT_COLUMNS)


@register("metric_valid", f"with {FIRST}, q as (select win, {cell_sql(6000)[0]} as row, {cell_sql(6000)[1]} as col, case when l4a_hqflag = 1 and {VALID('agbd_a0')} then agbd_a0 end as m, case when {VALID('agbd_a0')} then agbd_a0 end as a from firsts) select win, row, col, count(m) as n_qf, count(a) as n_all, round(avg(m), 6) as mean_qf from q group by all")
def metric_valid(spark, d):
    cells = gridding.with_cell(firsts(spark, d, ["agbd_a0", "l4a_hqflag"]), 6000).withColumn("agbd_a0_qf", F.when(F.col("l4a_hqflag") == 1, F.col("agbd_a0")))
    used = lambda m: F.when(quality.valid(m), F.col(m))
    return cells.groupBy("win", "row", "col").agg(F.count(used("agbd_a0_qf")).alias("n_qf"), F.count(used("agbd_a0")).alias("n_all"), F.round(F.avg(used("agbd_a0_qf")), 6).alias("mean_qf"))


GROUND = FIRST.replace("where l2_hqflag = 1", "where loc_out_umd = 0")


@register("grid_ground_elev", f"with {GROUND} {_stats_sql('elev_lm_a0', 6000)}")
def grid_ground_elev(spark, d):
    ground = joins.window_join(gridding.with_xy(shots(spark, d).where(f"{OUT} = 0")), src.windows(spark, WINDOWS))
    first = gridding.first_shot_per_fine_cell(ground, ["x", "y", "elev_lm_a0"])
    return _rounded(gridding.mask_single(gridding.grid_stats(gridding.with_cell(first, 6000), ["elev_lm_a0"])), _STAT_COLUMNS)


@register("mask_single", f"with {FIRST}, c as (select win, {cell_sql(1000)[0]} as row, {cell_sql(1000)[1]} as col, count(case when {VALID('rh_98_a0')} then 1 end) as countf from firsts group by all) select win, count(*) as cells, sum(cast(countf > 1 as int)) as kept from c group by win")
def mask_single(spark, d):
    s = gridding.grid_stats(gridding.with_cell(firsts(spark, d, ["rh_98_a0"]), 1000), ["rh_98_a0"], stats={"countf": F.count})
    kept = gridding.mask_single(s).groupBy("win").agg(F.count("*").alias("kept"))
    return s.groupBy("win").agg(F.count("*").alias("cells")).join(kept, "win", "left").select("win", "cells", F.coalesce("kept", F.lit(0)).alias("kept"))


@register("skip_empty", f"with {FIRST}, c as (select win, count(case when {VALID('agbd_a0')} and orbit % 2 = 0 then 1 end) as n from firsts group by win) select win, n from c where n > 0")
def skip_empty(spark, d):
    f = firsts(spark, d, ["agbd_a0", "orbit"]).where(quality.valid("agbd_a0") & (F.col("orbit") % 2 == 0))
    return f.groupBy("win").agg(F.count("*").alias("n"))


def _nni_sql(source: str, res: float) -> str:
    row, col = cell_sql(res)
    return (
        f"p as (select *, {row} as row, {col} as col from {source}), nn as (select a.win, a.row, a.col, a.shot_num, min(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) as d from p a join p b on a.win = b.win and a.row = b.row and a.col = b.col and a.shot_num <> b.shot_num group by all), "
        f"nni as (select win, row, col, round(avg(d) / (0.5e0 * sqrt({lit(res * res)} / count(*))), 5) as shots_nni from nn group by win, row, col)"
    )


@register("shots_nni", f"with {VEG}, {_nni_sql('veg', 1000)} select win, row, col, shots_nni from nni")
def shots_nni(spark, d):
    v = gridding.with_cell(veg(spark, d), 1000)
    return vector.nearest_neighbour_index(v, ["win", "row", "col"], "x", "y", 1e6).withColumn("shots_nni", F.round("shots_nni", 5))


def _bse_sql(m: str, res: float, source: str = "firsts", tag: str = "") -> str:
    """Tables up to bse{tag} (win, row, col, meanbse): the draws by md5, of which one table of keys serves cells of every size."""
    row, col = cell_sql(res)
    t = lambda n: f"{n}{tag}"
    return (
        f"{t('bv')} as (select win, {row} as row, {col} as col, {m} as m, date_dec, shot_num from {source} where {VALID(m)}), "
        f"{t('bc')} as (select *, row_number() over (partition by win, row, col order by date_dec, shot_num) as i, count(*) over (partition by win, row, col) as n from {t('bv')}), {t('bz')} as (select distinct n from {t('bc')} where n >= 10), "
        f"{t('bk')} as materialized (select b, i, md5(cast(b as varchar) || ':' || cast(i as varchar)) as k from (select unnest(range(1, 401)) as b), (select unnest(range(1, coalesce((select max(n) from {t('bz')}), 0) + 1)) as i) where b <= 150 or i <= 12), "
        f"{t('bd')} as (select n, b, i, row_number() over (partition by n, b order by k, i) as r from {t('bz')} join {t('bk')} on i <= n and (b <= 150 or n <= 12)), "
        f"{t('bs')} as (select n, b, list_sort(list(i)) as s from {t('bd')} where r <= round_even(0.7e0 * n, 0) group by n, b), {t('bf')} as (select n, s, row_number() over (partition by n order by min(b)) as k from {t('bs')} group by n, s), "
        f"{t('bu')} as (select n, k, unnest(s) as i from {t('bf')} where k <= 100), {t('bm')} as (select win, row, col, k, avg(m) as mean from {t('bc')} join {t('bu')} using (n, i) group by all), "
        f"{t('be')} as (select win, row, col, stddev_samp(mean) as meanbse from {t('bm')} group by all), {t('bse')} as (select distinct c.win, c.row, c.col, round(meanbse, 6) as meanbse from {t('bc')} c left join {t('be')} using (win, row, col))"
    )


@register("stat_meanbse", f"with {FIRST}, {_bse_sql('agbd_a0', 1000)} select * from bse")
def stat_meanbse(spark, d):
    f = gridding.with_cell(firsts(spark, d, ["agbd_a0"]), 1000)
    return _rounded(vector.mean_subsample_error(f, ["win", "row", "col"], "agbd_a0", ["date_dec", "shot_num"]), ["meanbse"])


@register("stat_meanbse_pai", f"with {FIRST}, {_bse_sql('pai_a0', 6000)} select * from bse")
def stat_meanbse_pai(spark, d):
    f = gridding.with_cell(firsts(spark, d, ["pai_a0"]), 6000)
    return _rounded(vector.mean_subsample_error(f, ["win", "row", "col"], "pai_a0", ["date_dec", "shot_num"]), ["meanbse"])


@register("entry", f"with {FIRST} select win, row, col, mean, countf from ({_stats_sql('rh_98_a0', 1000)})")
def entry(spark, d):
    """Mean canopy height of each 1 km cell and window."""
    return _stats(spark, d, 1000, ["rh_98_a0"]).select("win", "row", "col", "mean", "countf")


@register("w1_condition", f"with {SHOTS}, {TAGGED}, j as (select *, case when orbit % 17 = 0 then 1 else 0 end as loc_out_umd from tagged where {F2A} and pk % 10 <> 3 and sk % 7 <> 5), f as (select *, case when {L2} then 1 when not ({L2}) then 0 end as l2_hqflag from j) select {CHUNK} as chunk_id, count(*) as n, sum(l2_hqflag) as n_hq, round(avg(case when rh_100_a0 > 5 then rh_50_a0 / rh_98_a0 end), 6) as rhvdr_b from f group by 1")
def w1_condition(spark, d):
    a, b, c = src.products(spark, d)
    out = workloads.condition_shots(a, b, c, coarse_cells(spark, d), outlier_list(spark, d), max_dem_diff=None)
    return out.groupBy("chunk_id").agg(F.count("*").alias("n"), F.sum("l2_hqflag").cast("long").alias("n_hq"), F.round(F.avg(F.when(F.col("rh_100_a0") > 5, F.col("rhvdr_b"))), 6).alias("rhvdr_b"))


def _w2_sql() -> str:
    tables, parts = [], []
    for r in (1000, 6000, 12000):
        for m in ("rh_98_a0", "cover_a0"):
            tag = f"{m}_{r}"
            named = _shan_sql(m, r)
            for t in ("sv", "sb", "sc", "so", "shan"):
                named = re.sub(rf"\b{t}\b(?= as \(| group| join| using)|(?<=from ){t}\b|(?<=join ){t}\b", f"{t}_{tag}", named)
            tables.append(named)
            parts.append(f"select g.*, round(h.shan, 6) as shan, {r} as res from ({_stats_sql(m, r)}) g left join shan_{tag} h using (win, row, col)")
    return f"with {FIRST}, {', '.join(tables)} " + " union all ".join(parts)


@register("w2_grid", _w2_sql())
def w2_grid(spark, d):
    s = shots(spark, d).selectExpr("*", f"{OUT} as loc_out_umd")
    return _rounded(workloads.grid_workload(s, src.windows(spark, WINDOWS), ["rh_98_a0", "cover_a0"], (1000, 6000, 12000)), _STAT_COLUMNS)


def _product_sql(metrics_: dict[str, str], resolutions, source: str, family: str) -> tuple[list[str], list[str]]:
    """Tables and selects of all eight statistics; metrics_: name -> its histogram's metric."""
    tables, parts = [], []
    for r in resolutions:
        for m in metrics_:
            tag = f"_{family}_{m}_{r}"
            named = _shan_sql(m, r, source)
            for t in ("sv", "sb", "sc", "so", "shan"):
                named = re.sub(rf"\b{t}\b(?= as \(| group| join| using)|(?<=from ){t}\b|(?<=join ){t}\b", f"{t}{tag}", named)
            tables += [named, _bse_sql(m, r, source, tag)]
            parts.append(f"select '{family}' as family, g.*, round(h.shan, 6) as shan, e.meanbse, {r} as res from ({_stats_sql(m, r, source)}) g left join shan{tag} h using (win, row, col) left join bse{tag} e using (win, row, col)")
    return tables, parts


def _grid_product_sql() -> str:
    resolutions = (1000, 6000, 12000)
    ground = f"ground as (select f.*, {PX} as x, {PY} as y, w.win from flagged f join windows w on f.date between w.first_day and w.last_day where loc_out_umd = 0)"
    tables = ["firsts_qf as (select *, case when l4a_hqflag = 1 then agbd_a0 end as agbd_a0_qf from firsts)", ground]
    tables.append("ground_firsts as (select * from (select *, row_number() over (partition by win, cast(floor(x / 30e0) as bigint), cast(floor(-y / 30e0) as bigint) order by date_dec, shot_num) as rn from ground) where rn = 1)")
    vf, gf = _product_sql({"agbd_a0": "", "agbd_a0_qf": ""}, resolutions, "firsts_qf", "vf"), _product_sql({"elev_lm_a0": ""}, (6000,), "ground_firsts", "gf")
    return f"with {FIRST}, {', '.join(tables + vf[0] + gf[0])} " + " union all ".join(vf[1] + gf[1])


@register("w2_product", _grid_product_sql())
def w2_product(spark, d):
    """All eight statistics of biomass, with and without its own flag, at three resolutions, and of the ground elevation at 6 km."""
    s = shots(spark, d).selectExpr("*", f"{OUT} as loc_out_umd")
    cells, _ = workloads.grid_product(s, src.windows(spark, WINDOWS), ["agbd_a0"])
    return _rounded(cells.where("family = 'vf' or res = 6000"), (*_STAT_COLUMNS, "meanbse"))


#: Metrics of few decimals, or ratios of such, spread within their bins: their means would lie on ties of rounding, where engines differ.
_SPREAD = {m: f"{m} * 0.98765431987654e0" for m in (*PAVD[:16], "pavd_max_h", "fhd_pai_1m_a0")} | {m: f"case when {m} > -9999 then {m} * 0.98765431987654e0 else {m} end" for m in ("pavd_0_5_frac", "pavd_bot_frac", "pavd_top_frac")} | {"sens_a0": "sens_a0 * 1.000012345678e0", "num_modes_a0": "1 + (num_modes_a0 - 1) * 0.98765431987654e0"}


def _whole_product_sql() -> str:
    """All metrics as rows, so that each statistic is one statement for all of them, all resolutions and both families."""
    numbers = ", ".join(f"cast({_SPREAD.get(m, m)} as double) as {m}" for m in GRID_METRICS)
    bins = ", ".join(f"('{m}', {lit(low)}, {lit(high)}, {lit(step)})" for m, (low, high, step) in BINS.items())
    row, col = cell_sql(1000)[0].replace(lit(1000), "res"), cell_sql(1000)[1].replace(lit(1000), "res")
    cell = "family, win, res, row, col, metric"
    ground = f"ground as (select f.*, {PX} as x, {PY} as y, w.win from flagged f join windows w on f.date between w.first_day and w.last_day where loc_out_umd = 0), ground_firsts as (select * from (select *, row_number() over (partition by win, cast(floor(x / 30e0) as bigint), cast(floor(-y / 30e0) as bigint) order by date_dec, shot_num) as rn from ground) where rn = 1)"
    return (
        f"with {FIRST}, {ground}, wide as (select win, x, y, date_dec as moment, shot_num, {numbers} from (select *, {', '.join(f'{e} as {n}' for n, e in _DERIVED.items())}, case when l4a_hqflag = 1 then agbd_a0 end as agbd_a0_qf from firsts)), "
        f"rows_ as (select 'vf' as family, win, x, y, moment, shot_num, metric, v from wide unpivot (v for metric in ({', '.join(GRID_METRICS)})) union all select 'gf', win, x, y, date_dec, shot_num, 'elev_lm_a0', elev_lm_a0 from ground_firsts), "
        f"cells as materialized (select family, win, res, {row} as row, {col} as col, metric, v, moment, shot_num from rows_, (values (1000e0), (6000e0), (12000e0)) as r(res) where {VALID('v')}), "
        f"g as (select {cell}, round(avg(v), 6) as mean, round(quantile_cont(v, 0.5), 6) as med, round(stddev_samp(v), 6) as sd, round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 6) as iqr, round(quantile_cont(v, 0.95), 6) as p95, count(*) as countf, list(v order by moment, shot_num) as vs from cells group by all having count(*) > 1), "
        f"bins(metric, low, high, step) as (values {bins}), sb as (select {cell}, greatest(0, cast(ceil((v - low) / step - 1e-7) as bigint) - 1) as bin, count(*) as c, max(cast(v < low or v > high as int)) as bad from cells join bins using (metric) group by all), "
        f"sc as (select {cell}, sum(c) as n, sum(c * ln(c)) as s, max(bad) as bad from sb group by all), so as (select family, win, metric, max(bad) as bad_ from sc group by all), shan as (select {cell}, case when bad_ = 0 then round(greatest(0e0, ln(n) - s / n), 6) end as shan from sc join so using (family, win, metric)), "
        "bz as (select distinct countf as n from g where countf >= 10), bk as materialized (select b, i, md5(cast(b as varchar) || ':' || cast(i as varchar)) as k from (select unnest(range(1, 401)) as b), (select unnest(range(1, coalesce((select max(n) from bz), 0) + 1)) as i) where b <= 150 or i <= 12), "
        "bd as (select n, b, i, row_number() over (partition by n, b order by k, i) as r from bz join bk on i <= n and (b <= 150 or n <= 12)), bs as (select n, b, list_sort(list(i)) as s from bd where r <= round_even(0.7e0 * n, 0) group by n, b), "
        "bf as (select n, s, row_number() over (partition by n order by min(b)) as k from bs group by n, s), bu as (select n, list(s) as sets from bf where k <= 100 group by n) "
        f"select family, win, cast(res as int) as res, row, col, metric, mean, med, sd, iqr, p95, countf, shan, case when len(sets) > 1 then round(list_aggregate(list_transform(sets, lambda s: list_avg(list_select(vs, s))), 'stddev_samp'), 6) end as meanbse from g join shan using ({cell}) left join bu on bu.n = countf"
    )


@register("grid_product", _whole_product_sql())
def grid_product(spark, d):
    """The whole grid product: all metrics and the flagged biomass, eight statistics, three resolutions, vegetation and ground."""
    s = metrics.with_metrics(shots(spark, d)).selectExpr("*", f"{OUT} as loc_out_umd")
    s = s.withColumns({c: F.expr(e) for c, e in _SPREAD.items()})
    cells, _ = workloads.grid_product(s, src.windows(spark, WINDOWS), GRID_METRICS)
    return _rounded(cells, (*_STAT_COLUMNS, "meanbse"))


def _w2_counts_sql() -> str:
    ground = VEG.replace("where l2_hqflag = 1", "where loc_out_umd = 0").replace("veg as (", "ground as (").split(f"{WIN}, ")[1]
    tables, parts = [ground], []
    for family, source in (("ga", "ground"), ("va", "veg")):
        for r in (1000, 6000):
            tag = f"_{family}_{r}"
            tables.append(re.sub(r"\b(p|nn|nni)\b(?= as \()|(?<=from )(p|nn)\b|(?<=join )p\b", lambda m: m[0] + tag, _nni_sql(source, r)))
            row, col = cell_sql(r)
            counted = f"select win, {row} as row, {col} as col, count(date_dec) as shots_count, count(distinct orbit) as orbits_uniq, count(distinct cast(orbit as varchar) || '-' || beam) as tracks_uniq from {source} group by all"
            parts.append(f"select '{family}' as family, {r} as res, c.*, shots_nni from ({counted}) c left join nni{tag} using (win, row, col)")
    return f"with {VEG}, {', '.join(tables)} " + " union all ".join(parts)


@register("w2_counts", _w2_counts_sql())
def w2_counts(spark, d):
    """The four bands of sampling density for ground and high-quality shots."""
    s = shots(spark, d).selectExpr("*", f"{OUT} as loc_out_umd")
    return workloads.count_workload(s, src.windows(spark, WINDOWS), (1000, 6000)).withColumn("shots_nni", F.round("shots_nni", 5))


def conditioned(spark, d) -> DataFrame:
    """Beam records, as files of three products -> conditioned shots."""
    path, tables = files.shared_folder(spark), {"l2a": beams_l2a, "l2b": beams_l2b, "l4a": beams_l4a}
    for name, beams in tables.items():
        files.write_shots(beams(spark, d), f"{path}/{name}")
    a, b, c = (extract_(files.read_shots(spark, f"{path}/{name}")) for name, extract_ in zip(tables, (extract.extract_l2a, extract.extract_l2b, extract.extract_l4a), strict=True))
    return workloads.condition_shots(a, b, c, coarse_cells(spark, d), outlier_list(spark, d))


_BEAM_SHOTS = f"beam_shots as (select * replace ({_DEC(_WHEN)} as date_dec, rh_100_a0 * 98 / 100e0 as rh_98_a0, cover_l1 * 1 as cover_l1) from shots)"
_CHAIN = (
    f"{SHOTS}, {_BEAM_SHOTS}, {TAGGED.replace('from shots', 'from beam_shots')}, cj as (select *, case when orbit % 17 = 0 then 1 else 0 end as loc_out_umd from tagged where {F2A} and pk % 10 <> 3 and sk % 7 <> 5), "
    f"cf as (select *, case when {L2} then 1 when not ({L2}) then 0 end as l2_hqflag from cj), {WIN}, cv as (select f.*, {PX} as x, {PY} as y, w.win from cf f join windows w on f.date between w.first_day and w.last_day where l2_hqflag = 1), "
    "firsts as (select * from (select *, row_number() over (partition by win, cast(floor(x / 30e0) as bigint), cast(floor(-y / 30e0) as bigint) order by date_dec, shot_num) as rn from cv) where rn = 1)"
)


@register("w1_w2_chain", f"with {_CHAIN} " + " union all ".join(f"select *, {r} as res from ({_stats_sql(m, r)})" for m in ("rh_98_a0", "pai_a0") for r in (1000, 6000)))
def w1_w2_chain(spark, d):
    """From beam records over conditioned shots to gridded statistics."""
    cells = workloads.grid_workload(conditioned(spark, d), src.windows(spark, WINDOWS), ["rh_98_a0", "pai_a0"], (1000, 6000))
    return _rounded(cells.drop("shan"), _STAT_COLUMNS)


# -- chunks, profiles, mosaics ---------------------------------------------------------------

#: The shots' own numeric columns: not the keys that they are derived from.
_PROFILED = [c for c in src.SHOT if c not in ("shot_num", "beam", "date", "ok", "pk", "sk", "ln")]


def _profile_sql(c: str, source: str = "shots", more: str = "") -> str:
    x = f"cast({c} as double)"
    here = f"({x} is not null and not isnan({x}))"
    fin = f"({here} and abs({x}) < cast('inf' as double))"
    ok = f"({fin} and {x} <> -9999)"
    n = lambda e: f"count(case when {e} then 1 end)"
    v, f = f"(case when {ok} then {x} end)", f"(case when {fin} then {x} end)"
    quant = ", ".join(f"round(quantile_cont({v}, {p / 100}), 6) as p{p:02d}_valid" for p in (5, 25, 75, 95))
    return (
        f"select {more}{CHUNK} as chunk_id, '{c}' as field_name, count(*) as n_all, {n(here)} as n_notna, {n(f'{here} and not {fin}')} as n_notnafin, {n(ok)} as n_valid, {n(f'{x} = -9999')} as n_n9999, {n(f'{x} = 255')} as n_255, {n(f'{x} = 32767')} as n_32767, {n(f'{fin} and {x} < 0')} as n_neg, {n(f'{ok} and {x} < 0')} as n_neg_valid, "
        f"min({f}) as min_fin, round(quantile_cont({f}, 0.5), 6) as med_fin, max({f}) as max_fin, min({v}) as min_valid, round(avg({v}), 6) as mean_valid, round(quantile_cont({v}, 0.5), 6) as med_valid, max({v}) as max_valid, round(stddev_samp({v}), 6) as sd_valid, {quant}, round(quantile_cont({v}, 0.75) - quantile_cont({v}, 0.25), 6) as iqr_valid from {source} group by all"
    )


_PROFILE_ROUNDED = ["med_fin", "mean_valid", "med_valid", "sd_valid", "p05_valid", "p25_valid", "p75_valid", "p95_valid", "iqr_valid"]
def _stored(df: DataFrame) -> DataFrame:
    """The derived shots as the stored table that profiles read several times; a table of few partitions is dealt out first."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return lineage.stored(df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df)


#: A column with infinities of both signs, beside those with nulls, NaN and missing codes.
_ENDLESS = "case when ok % 103 = 0 then cast('inf' as double) when ok % 107 = 0 then cast('-inf' as double) else sol_elev end"


@register("column_profile", f"with {SHOTS}, endless as (select * replace ({_ENDLESS} as sol_elev) from shots) " + " union all ".join(_profile_sql(c, "endless") for c in _PROFILED))
def column_profile(spark, d):
    s = shots(spark, d).withColumn("sol_elev", F.expr(_ENDLESS))
    return _rounded(chunks.column_profile(_stored(chunks.with_chunk(s.select(*_PROFILED)))), _PROFILE_ROUNDED)


_RECODED = ", ".join(f"case when {c} = {code} then -9999 else {c} end as {c}" for c, code in (dict.fromkeys(NODATA_255, 255) | dict.fromkeys(NODATA_32767, 32767)).items() if c in _PROFILED)
_FAMILIES = {"ga": "loc_out_umd = 0", "va": "l2_hqflag = 1"}


@register("export_profile", f"with {SHOTS}, {FLAGS}, recoded as (select * replace ({_RECODED}) from flagged), " + ", ".join(f"{k} as (select * from recoded where {w})" for k, w in _FAMILIES.items()) + " " + " union all ".join(_profile_sql(c, k, f"'{k}' as family, ") for k in _FAMILIES for c in _PROFILED))
def export_profile(spark, d):
    """Profiles of the exported ground and vegetation tables, after recoding."""
    f = chunks.with_chunk(flagged(spark, d)).select(*_PROFILED, "chunk_id", "loc_out_umd", "l2_hqflag")
    return _rounded(chunks.export_profile(_stored(f), _PROFILED), _PROFILE_ROUNDED)


_TILE = "select ok % 200 as row, pk % 200 as col, ln as priority, max(case when sk % 5 = 0 then null else qty end) as value from k0 group by 1, 2, 3"


def tiles(spark, d) -> DataFrame:
    t = spark.read.parquet(f"{d}/lineitem.parquet").selectExpr("l_orderkey % 200 as row", "l_partkey % 200 as col", "cast(l_linenumber as bigint) as priority", "case when l_suppkey % 5 = 0 then null else l_quantity end as v")
    return t.groupBy("row", "col", "priority").agg(F.max("v").alias("value"))


_K0 = SHOTS.split(", k1 as")[0]


@register("union_tiles", f"with {_K0}, t as ({_TILE}) select row, col, coalesce(arg_max(value, priority) filter (value is not null), -9999e0) as value from t group by row, col")
def union_tiles(spark, d):
    return chunks.union_tiles(tiles(spark, d), ["row", "col"], "value", "priority")


@register("mosaic_first", f"with {_K0}, t as ({_TILE}) select row, col, arg_min(value, priority) as value from t where value is not null group by row, col")
def mosaic_first(spark, d):
    return chunks.mosaic_first(tiles(spark, d), ["row", "col"], "value", "priority")


@register("overview", f"with {_K0}, t as ({_TILE}), m as (select row, col, arg_min(value, priority) as value from t where value is not null group by row, col) select row // 4 as row, col // 4 as col, value from m where row % 4 = 1 and col % 4 = 1")
def overview(spark, d):
    return chunks.overview(mosaic_first(spark, d), 2, 1)


@register("band_stats", f"with {FIRST}, c as (select mean, countf from ({_stats_sql('rh_98_a0', 1000)})) select 'mean' as band, min(mean) as min, max(mean) as max, round(avg(mean), 5) as mean, round(stddev_pop(mean), 5) as std from c union all select 'countf', min(countf), max(countf), round(avg(countf), 5), round(stddev_pop(countf), 5) from c")
def band_stats(spark, d):
    return chunks.band_stats(entry(spark, d), ["mean", "countf"]).withColumns({c: F.round(c, 5) for c in ("mean", "std")})


# -- validation ------------------------------------------------------------------------------

_PIX = "pix as (select pk % 200 as row, ok % 200 as col, avg(qty) * 2 + 10 as value, max(cast(ln as int)) as cover_class, 2015 + max(cast(sk % 8 as int)) as loss_year, cast(count(*) % 3 <> 0 as int) as valid from k0 group by 1, 2)"


def pixels(spark, d) -> DataFrame:
    t = spark.read.parquet(f"{d}/lineitem.parquet")
    return t.groupBy((F.col("l_partkey") % 200).alias("row"), (F.col("l_orderkey") % 200).alias("col")).agg((F.avg("l_quantity") * 2 + 10).alias("value"), F.max("l_linenumber").alias("cover_class"), (F.max(F.col("l_suppkey") % 8) + 2015).cast("int").alias("loss_year"), (F.count("*") % 3 != 0).cast("int").alias("valid"))


@register("validity_masks", f"with {_K0}, {_PIX}, wet as (select pk % 200 as row, ok % 200 as col from k0 group by 1, 2 having avg(disc * 200) < 10) select pix.row, pix.col, round(value, 6) as value from pix join wet using (row, col) where not coalesce(cover_class between 6 and 7, false) and coalesce(loss_year < 2020, true) and value between 0 and 100")
def validity_masks(spark, d):
    water = spark.read.parquet(f"{d}/lineitem.parquet").select((F.col("l_partkey") % 200).alias("row"), (F.col("l_orderkey") % 200).alias("col"), (F.abs("l_discount") * 200).alias("water"))
    return validate.validity_masks(pixels(spark, d), water, (6, 7)).select("row", "col", r6("value").alias("value"))


_SLOPES = "g as (select row, col, case when lag(col) over r = col - 1 and lead(col) over r = col + 1 then (lead(value) over r - lag(value) over r) / 60e0 end as gx, case when lag(row) over c = row - 1 and lead(row) over c = row + 1 then (lead(value) over c - lag(value) over c) / 60e0 end as gy from pix window r as (partition by row order by col), c as (partition by col order by row))"


@register("terrain_slope", f"with {_K0}, {_PIX}, {_SLOPES} select row, col, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) as slope from g")
def terrain_slope(spark, d):
    return _rounded(validate.terrain_slope(pixels(spark, d).withColumnRenamed("value", "elev"), 30.0), ["slope"])


@register("als_to_footprint", f"with {_K0}, {_PIX} select row // 5 as row, col // 5 as col, round(quantile_cont(value, 0.98), 6) as value from pix where value between 0 and 100 group by 1, 2")
def als_to_footprint(spark, d):
    return _rounded(validate.als_to_footprint(pixels(spark, d), 5), ["value"])


@register("covered_cells", f"with {_K0}, {_PIX} select row // 2 as row, col // 2 as col from pix group by 1, 2 having count(*) = 4")
def covered_cells(spark, d):
    return validate.covered_cells(pixels(spark, d), 2)


@register("valid_percent", f"with {_K0}, {_PIX} select row // 5 as row, col // 5 as col, round(avg(valid) * 100, 6) as valid_perc from pix group by 1, 2 having avg(valid) * 100 >= 60")
def valid_percent(spark, d):
    return _rounded(validate.valid_percent(pixels(spark, d), 5, 60.0), ["valid_perc"])


_ALS_FULL = "als as (select row // 20 as row, col // 20 as col, avg(value) as mean, quantile_cont(value, 0.25) as p25, quantile_cont(value, 0.5) as med, quantile_cont(value, 0.75) as p75, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) as iqr, quantile_cont(value, 0.95) as p95, stddev_pop(value) as sd, avg(slope) as slope_mean, stddev_pop(slope) as slope_sd, quantile_cont(slope, 0.95) as slope_p95 from pix join (select row, col, degrees(atan(sqrt(gx * gx + gy * gy))) as slope from g) using (row, col) group by 1, 2)"
_ALS = "als as (select row // 20 as row, col // 20 as col, avg(value) as mean, quantile_cont(value, 0.5) as med, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) as iqr, quantile_cont(value, 0.95) as p95, stddev_pop(value) as sd from pix group by 1, 2)"


_ALS_COLUMNS = "mean p25 med p75 iqr p95 sd slope_mean slope_sd slope_p95".split()


@register("als_cell_stats", f"with {_K0}, {_PIX}, {_SLOPES}, {_ALS_FULL} select row, col, {', '.join(f'round({c}, 6) as {c}' for c in _ALS_COLUMNS)} from als")
def als_cell_stats(spark, d):
    slope = validate.terrain_slope(pixels(spark, d).withColumnRenamed("value", "elev"), 30.0)
    return _rounded(validate.als_cell_stats(pixels(spark, d).join(slope, ["row", "col"]), 20, slope="slope"), _ALS_COLUMNS)


@register("als_shannon", f"with {_K0}, {_PIX}, b as (select row // 20 as row, col // 20 as col, floor((value + 99e0) / {lit(219 / 74)}) as bin, count(*) as c from pix where value >= -99e0 and value < 120e0 group by 1, 2, 3), n as (select row, col, sum(c) as n, sum(c * ln(c)) as s, count(*) as bins from b group by 1, 2) select row, col, round(case when bins >= 2 then ln(n) - s / n end, 6) as shan from n")
def als_shannon(spark, d):
    return _rounded(validate.als_shannon(pixels(spark, d), 20, -99.0, 120.0, 74), ["shan"])


_PAIRED = f"with {_K0}, {_PIX}, {_ALS}, grid as (select ok % 10 as row, pk % 10 as col, avg(qty) * 2 + 9 as mean, quantile_cont(qty, 0.5) * 2 + 9 as med, quantile_cont(qty, 0.95) * 2 as p95, count(*) % 60 as shotcount from k0 group by 1, 2), j as (select row, col, cast(row % 2 as varchar) as site, shotcount, a.mean as am, g.mean as gm, a.med as ad, g.med as gd, a.p95 as ap, g.p95 as gp from als a join grid g using (row, col)), pairs as (select row, col, site, shotcount, 'mean' as stat, am as als, gm as grid from j union all select row, col, site, shotcount, 'med', ad, gd from j union all select row, col, site, shotcount, 'p95', ap, gp from j)"


def joined(spark, d) -> DataFrame:
    t = spark.read.parquet(f"{d}/lineitem.parquet")
    p = lambda x: F.percentile("l_quantity", F.lit(x))
    grid = t.groupBy((F.col("l_orderkey") % 10).alias("row"), (F.col("l_partkey") % 10).alias("col")).agg((F.avg("l_quantity") * 2 + 9).alias("grid_mean"), (p(0.5) * 2 + 9).alias("grid_med"), (p(0.95) * 2).alias("grid_p95"), (F.count("*") % 60).alias("shotcount"))
    als = validate.als_cell_stats(pixels(spark, d), 20).select("row", "col", *[F.col(s).alias(f"als_{s}") for s in ("mean", "med", "p95")])
    return grid.join(als, ["row", "col"]).withColumn("site", (F.col("row") % 2).cast("string"))


def pairs(spark, d) -> DataFrame:
    return validate.paired_stats_long(joined(spark, d), ["row", "col", "site", "shotcount"], ["mean", "med", "p95"])


@register("grid_als_join", f"{_PAIRED} select row, col, round(am, 6) as als_mean, round(gm, 6) as grid_mean from j")
def grid_als_join(spark, d):
    return _rounded(joined(spark, d), ["als_mean", "grid_mean"]).select("row", "col", "als_mean", "grid_mean")


@register("paired_stats_long", f"{_PAIRED} select row, col, stat, round(als, 6) as als, round(grid, 6) as grid from pairs")
def paired_stats_long(spark, d):
    return _rounded(pairs(spark, d), ["als", "grid"]).select("row", "col", "stat", "als", "grid")


_ACC = "count(*) as n, round(sqrt(avg((als - grid) * (als - grid))), 6) as rmse, round(avg(abs(als - grid)), 6) as mae, round(sqrt(avg((als - grid) * (als - grid))) * 100 / avg(als), 6) as prmse"


@register("accuracy", f"{_PAIRED} select stat, site, {_ACC} from pairs group by stat, site")
def accuracy(spark, d):
    return _rounded(validate.accuracy(pairs(spark, d), ["stat", "site"]), ["rmse", "mae", "prmse"])


_FIT = "f as (select stat, site, count(*) as n, regr_slope(als, grid) as slope, regr_intercept(als, grid) as intercept, regr_r2(als, grid) as r2 from pairs group by stat, site), e as (select stat, site, sqrt(avg((als - slope * grid - intercept) * (als - slope * grid - intercept))) as lm_rmse, avg(abs(als - slope * grid - intercept)) as lm_mae, avg(als) as m from pairs join f using (stat, site) group by stat, site)"


@register("linear_fit", f"{_PAIRED}, {_FIT} select stat, site, n, round(slope, 6) as slope, round(intercept, 5) as intercept, round(1 - (1 - r2) * (n - 1) / (n - 2), 6) as adj_r2, round(lm_rmse, 6) as lm_rmse, round(lm_mae, 6) as lm_mae, round(lm_rmse * 100 / m, 6) as lm_prmse from f join e using (stat, site)")
def linear_fit(spark, d):
    return _rounded(validate.linear_fit(pairs(spark, d), ["stat", "site"]), ["slope", "adj_r2", "lm_rmse", "lm_mae", "lm_prmse"]).withColumn("intercept", F.round("intercept", 5))


@register("accuracy_by_threshold", f"{_PAIRED} select stat, site, threshold, {_ACC} from pairs, (select unnest([2, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50]) as threshold) t where shotcount >= threshold group by stat, site, threshold having count(*) >= 20")
def accuracy_by_threshold(spark, d):
    return _rounded(validate.by_threshold(pairs(spark, d), ["stat", "site"]), ["rmse", "mae", "prmse"])


@register("threshold_series", f"{_PAIRED} select threshold, {_ACC} from pairs, (select unnest([2, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50]) as threshold) t where stat = 'mean' and shotcount >= threshold group by threshold having count(*) >= 20 order by threshold")
def threshold_series(spark, d):
    return _rounded(validate.by_threshold(pairs(spark, d).where("stat = 'mean'"), []), ["rmse", "mae", "prmse"]).orderBy("threshold")


@register("axis_limits", f"{_PAIRED} select stat, cast(floor(least(min(als), min(grid))) as bigint) as low, cast(ceil(greatest(max(als), max(grid))) as bigint) as high from pairs group by stat")
def axis_limits(spark, d):
    return validate.axis_limits(pairs(spark, d), ["stat"])


@register("shotcount_deciles", f"{_PAIRED} select 'percentile' as kind, cast(p * 10 as bigint) as at, round(v, 6) as value from (select unnest(range(1, 11)) as p, unnest(quantile_cont(shotcount, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) as v from grid) union all select 'histogram', cast(shotcount // 5 * 5 as bigint), cast(count(*) as double) from grid group by 2")
def shotcount_deciles(spark, d):
    grid = spark.read.parquet(f"{d}/lineitem.parquet").groupBy((F.col("l_orderkey") % 10).alias("row"), (F.col("l_partkey") % 10).alias("col")).agg((F.count("*") % 60).alias("shotcount"))
    return _rounded(validate.shotcount_deciles(grid, "shotcount"), ["value"])


@register("pooled_regions", f"{_PAIRED} select 'all' as site, stat, {_ACC} from pairs where shotcount >= 2 group by stat")
def pooled_regions(spark, d):
    p = pairs(spark, d).drop("site")
    stacked = validate.union_regions({"even": p.where("row % 2 = 0"), "odd": p.where("row % 2 = 1")})
    return _rounded(validate.accuracy(stacked.where("shotcount >= 2").withColumn("site", F.lit("all")), ["site", "stat"]), ["rmse", "mae", "prmse"])


@register("union_regions", f"{_PAIRED} select case when row % 2 = 0 then 'even' else 'odd' end as site, count(*) as n from pairs group by 1")
def union_regions(spark, d):
    p = pairs(spark, d).drop("site")
    return validate.union_regions({"even": p.where("row % 2 = 0"), "odd": p.where("row % 2 = 1")}).groupBy("site").agg(F.count("*").alias("n"))


@register("w3_validation", f"{_PAIRED}, {_FIT} select stat, site, count(*) as n, round(sqrt(avg((als - grid) * (als - grid))), 6) as rmse, round(any_value(1 - (1 - r2) * (f.n - 1) / (f.n - 2)), 6) as adj_r2 from pairs join f using (stat, site) group by stat, site")
def w3_validation(spark, d):
    p = pairs(spark, d)
    fit = validate.linear_fit(p, ["stat", "site"]).select("stat", "site", "adj_r2")
    return _rounded(validate.accuracy(p, ["stat", "site"]).join(fit, ["stat", "site"]).select("stat", "site", "n", "rmse", "adj_r2"), ["rmse", "adj_r2"])


@register("track_count", f"with {SHOTS} select cast(orbit as varchar) || '-' || beam as track, replace(case when min(date_dec) > 2019.05e0 then 'rh_98_a0' else 'cover_a0' end, '_', '-') as label, strftime(min(date), '%Y%m%d') as first from shots group by 1")
def track_count(spark, d):
    t = shots(spark, d).groupBy(geo.track_id("orbit", "beam").alias("track")).agg(F.min("date").alias("d"), F.min("date_dec").alias("t"))
    return t.withColumn("metric", F.when(F.col("t") > 2019.05, "rh_98_a0").otherwise("cover_a0")).select("track", names.metric_label("metric").alias("label"), names.date_label("d").alias("first"))


@register("merge_summaries", f"with {SHOTS}, {FLAGS}, {SUMMARY} select chunk_id, cast(count(*) as bigint) as files, cast(sum(n_filt_shots) as bigint) as n, min(xmin_shots) as xmin, max(ymax_shots) as ymax from summary group by chunk_id")
def merge_summaries(spark, d):
    """Summaries written as files and read again as one table."""
    path, s = files.shared_folder(spark), summaries(spark, d)
    files.write_summaries(s, path)
    return files.read_summaries(spark, path, s.schema).groupBy("chunk_id").agg(F.count("*").alias("files"), F.sum("n_filt_shots").alias("n"), F.min("xmin_shots").alias("xmin"), F.max("ymax_shots").alias("ymax"))


# -- files: what is written is read again ----------------------------------------------------

_FILED = "shot_num, orbit, sub_orbit, beam, date, lon_lm_a0, lat_lm_a0, elev_lm_a0, cover_a0, urb_prop"


@register("write_shots", f"with {SHOTS} select {_FILED} from shots")
def write_shots(spark, d):
    path = files.shared_folder(spark)
    files.write_shots(shots(spark, d).selectExpr(*_FILED.split(", ")), path)
    return files.read_shots(spark, path)


@register("read_shots_csv", f"with {SHOTS} select {_FILED} from shots")
def read_shots_csv(spark, d):
    path, s = files.shared_folder(spark), shots(spark, d).selectExpr(*_FILED.split(", "))
    files.write_shots(s, path, "csv")
    return files.read_shots(spark, path, s.schema)


@register("write_chunks", f"with {SHOTS} select {CHUNK} as chunk_id, count(*) as n, round(sum(elev_lm_a0), 2) as elev from shots group by 1")
def write_chunks(spark, d):
    path = files.shared_folder(spark)
    files.write_chunks(chunks.with_chunk(shots(spark, d).select("shot_num", "lon_lm_a0", "lat_lm_a0", "elev_lm_a0")), path)
    return files.read_shots(spark, path).groupBy("chunk_id").agg(F.count("*").alias("n"), F.round(F.sum("elev_lm_a0"), 2).alias("elev"))


@register("export_va", f"with {_CHAIN}, c163 as (select 163 as n_columns) select {CHUNK} as chunk_id, shot_num, case when urb_prop = 255 then -9999 else urb_prop end as urb_prop, orbit_grid as ease72_og, round(rh_98_a0, 6) as rh_98_a0, n_columns from cf, c163 where l2_hqflag = 1")
def export_va(spark, d):
    """The exported table of every chunk, all columns in order."""
    path = files.shared_folder(spark)
    files.export_shots(conditioned(spark, d), None, path)
    back = spark.read.csv(path, header=True)
    n = len(back.columns) - 1  # beside chunk_id, which the folders hold
    return back.select("chunk_id", "shot_num", F.col("urb_prop").cast("int").alias("urb_prop"), "ease72_og", F.round(F.col("rh_98_a0").cast("double"), 6).alias("rh_98_a0"), F.lit(n).alias("n_columns"))


@register("write_grid", f"with {FIRST} select 'grid_' || replace(metric, '_', '-') || '_vf_' || win || '_1000m' as product, count(*) as n, cast(sum(countf) as bigint) as shots from ({' union all '.join(_stats_sql(m, 1000) for m in METRICS)}) group by 1")
def write_grid(spark, d):
    """Cells under a folder for each product, by name."""
    path = files.shared_folder(spark)
    cells = _stats(spark, d, 1000).withColumns({"family": F.lit("vf"), "res": F.lit(1000)})
    files.write_products(cells, src.windows(spark, WINDOWS), path)
    return spark.read.parquet(path).groupBy("product").agg(F.count("*").alias("n"), F.sum("countf").alias("shots"))


@register("read_validation", f"{_PAIRED} select 'RH98' as metric, 6000 as res, 'site' || site as site, row, col, round(am, 6) as als_mean, round(gm, 6) as grid_mean from j")
def read_validation(spark, d):
    """Validation tables of two sites, written under names that say what they hold."""
    path, j = files.shared_folder(spark), joined(spark, d)
    for site in ("0", "1"):
        files.write_shots(j.where(F.col("site") == site).select("row", "col", "als_mean", "grid_mean"), f"{path}/grid_RH98_6000m_val_als_98p_site{site}.csv", "csv")
    return _rounded(validate.read_validation(spark, path), ["als_mean", "grid_mean"]).select("metric", "res", "site", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "als_mean", "grid_mean")


# -- single operators of the groups above ----------------------------------------------------


def _part(name: str, of: str, keys: str, columns: str) -> None:
    """Register some columns of another query under their operator's name."""
    chosen = f"{keys}, {columns}"
    whole = QUERIES[of]
    register(name, f"select {chosen} from ({ORACLES[of]})")(lambda spark, d: whole(spark, d).select(*[c.strip() for c in chosen.split(",")]))


for _name, _columns in {
    "pavd_0_5_frac": "pavd_0_5_frac",
    "pavd_max_h": "pavd_max_h",
    "rhvdr": "rhvdr_b, rhvdr_m, rhvdr_t",
    "even_pai_1m": "even_pai_1m_a0",
    "fhd_pavd_5m": "fhd_pavd_5m_a0",
    "even_pavd_5m": "even_pavd_5m_a0",
    "pavd_halves": "pavd_bot_frac, pavd_top_frac",
}.items():
    _part(_name, "derived_metrics", "shot_num", _columns)
for _stat in ("mean", "med", "sd", "iqr", "p95", "countf"):
    _part(f"stat_{_stat}", "stat_builtin_1000m", "win, row, col, metric", _stat)
for _count in ("shots_count", "orbits_uniq", "tracks_uniq"):
    _part(_count, "cell_counts_1000m", "win, row, col", _count)
_part("track_id", "beam_class", "shot_num", "track")
_part("metric_label", "track_count", "track", "label, first")


@register("elev_diff", f"with {SHOTS} select shot_num, round(elev_dem_tdx - elev_lm_a0, 6) as elev_diff_dem from shots")
def elev_diff(spark, d):
    return shots(spark, d).select("shot_num", r6(F.col("elev_dem_tdx") - F.col("elev_lm_a0")).alias("elev_diff_dem"))


_TENTH = geo.DegreeGrid(0.1)


@register("cell_resolution", f"with {SHOTS} select distinct 12000e0 as res, 144000000e0 as area, {cell_sql(12000, PX, PY)[0]} as row, {cell_sql(12000, PX, PY)[1]} as col from shots union all select distinct {lit(_TENTH.metres)}, {lit(_TENTH.cell_area)}, cast(floor((90e0 - lat_lm_a0) / 0.1e0) as bigint), cast(floor((lon_lm_a0 + 180e0) / 0.1e0) as bigint) from shots")
def cell_resolution(spark, d):
    """The cells that hold shots, of a grid in metres and one in degrees, with size and area."""
    s = gridding.with_xy(shots(spark, d))
    parts = []
    for grid, metres, x, y in ((geo.GridSpec(12000), 12000.0, "x", "y"), (_TENTH, _TENTH.metres, "lon_lm_a0", "lat_lm_a0")):
        cells = s.select(geo.cell_row(y, grid).alias("row"), geo.cell_col(x, grid).alias("col")).distinct()
        parts.append(cells.select(F.lit(metres).alias("res"), F.lit(float(grid.cell_area)).alias("area"), "row", "col"))
    return parts[0].unionByName(parts[1])


# -- what a job reports, stored products, updates, sketches, group functions ------------------

_STEPS = {
    "l2a": "select count(*) as n from shots", "l2a_kept": f"select count(*) from shots where {F2A}", "l2b": "select count(*) from shots where pk % 10 <> 3", "l2b_kept": f"select count(*) from shots where pk % 10 <> 3 and {_BASE} and {_TALL} and l2a_qflag_a0 = 1",
    "l4a": "select count(*) from shots where sk % 7 <> 5", "l4a_kept": f"select count(*) from shots where sk % 7 <> 5 and {_BASE} and sens_a2 > 0.9e0 and sens_a2 <= 1e0 and l2a_qflag_a0 = 1", "l2_joined": f"select count(*) from shots where {F2A} and pk % 10 <> 3",
    "joined": f"select count(*) from shots where {F2A} and pk % 10 <> 3 and sk % 7 <> 5", "on_grid": f"select count(*) from tagged where {F2A} and pk % 10 <> 3 and sk % 7 <> 5", "in_chunks": f"select count(*) from tagged where {F2A} and pk % 10 <> 3 and sk % 7 <> 5",
}


@register("condition_counts", f"with {SHOTS}, {TAGGED} " + " union all ".join(f"select '{k}' as step, n from ({q}) as s(n)" for k, q in _STEPS.items()))
def condition_counts(spark, d):
    """Rows after each step of conditioning, counted by the one job that conditions them."""
    counts, (a, b, c) = workloads.StepCounts(), src.products(spark, d)
    out = workloads.condition_shots(a, b, c, coarse_cells(spark, d), outlier_list(spark, d), max_dem_diff=None, counts=counts)
    out.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(counts.rows().items()), "step string, n long")


_COMPLETE = " and ".join(f"{c} is not null" for c in workloads.NEEDED)
#: Some shots that lack their position, date or orbit.
_LACKS = {"lon_lm_a0": "case when ok % 59 = 1 then null else lon_lm_a0 end", "date_dec": "case when ok % 61 = 2 then null else date_dec end", "orbit": "case when ok % 67 = 3 then null else orbit end"}


@register("split_counts", f"with {SHOTS.replace('shots as (', 'all_shots as (')}, shots as (select * replace ({', '.join(f'{e} as {c}' for c, e in _LACKS.items())}) from all_shots), {FLAGS} select 'shots' as step, count(*) as n from flagged union all select 'complete', count(*) from flagged where {_COMPLETE} union all select 'ground', count(*) from flagged where {_COMPLETE} and loc_out_umd = 0 union all select 'high_quality', count(*) from flagged where {_COMPLETE} and l2_hqflag = 1")
def split_counts(spark, d):
    """Rows at each step from flagged shots to ground and high-quality ones, without those that lack what gridding needs."""
    counts = workloads.StepCounts()
    s = shots(spark, d).withColumns({c: F.expr(e) for c, e in _LACKS.items()}).selectExpr("*", f"{OUT} as loc_out_umd")
    ground, vegetation = workloads.split_shots(quality.hq_flags(s), counts)
    family = lambda df: df.groupBy().agg(F.count("*").alias("n"))
    vegetation.write.format("noop").mode("overwrite").save()
    rows = [(k, counts.rows_of(k)) for k in ("shots", "complete", "high_quality")]
    return spark.createDataFrame([*rows, ("ground", family(ground).first()["n"])], "step string, n long")


def _step(v):
    """Mean change from one value to the next, in time; None for one value."""
    return float(abs(v[1:] - v[:-1]).mean()) if len(v) > 1 else None


_STEP_SQL = f"sq as (select win, {cell_sql(6000)[0]} as row, {cell_sql(6000)[1]} as col, abs(cover_a0 - lag(cover_a0) over (partition by win, {cell_sql(6000)[0]}, {cell_sql(6000)[1]} order by date_dec, shot_num)) as change from firsts where {VALID('cover_a0')}), sp as (select win, row, col, round(avg(change), 6) as step from sq group by all)"


@register("stat_group_function", f"with {FIRST}, {_STEP_SQL}, {_bse_sql('cover_a0', 6000)}, g as ({_stats_sql('cover_a0', 6000)}) select win, row, col, metric, mean, countf, meanbse, step from g join sp using (win, row, col) join bse using (win, row, col)")
def stat_group_function(spark, d):
    """A user's own function of a cell's values, in time order, and the subsample error, beside built-in aggregates, in one call."""
    cells = gridding.with_cell(firsts(spark, d, ["cover_a0"]), 6000)
    out = gridding.grid_stats(cells, ["cover_a0"], stats={"mean": F.avg, "countf": F.count}, functions={"meanbse": vector.subsample_error, "step": _step}, order=["date_dec", "shot_num"])
    return _rounded(gridding.mask_single(out), ["mean", "meanbse", "step"])


@register("update_chunks", f"with {SHOTS} select {CHUNK} as chunk_id, count(*) as n, count(distinct shot_num) as shots, round(sum(elev_lm_a0), 2) as elev from shots group by 1")
def update_chunks(spark, d):
    """Chunk tables written in two runs, of which the second brings more granules, hold what one run would have written."""
    path, s = files.shared_folder(spark), chunks.with_chunk(shots(spark, d).select("shot_num", "orbit", "lon_lm_a0", "lat_lm_a0", "elev_lm_a0")).withColumnRenamed("orbit", "granule")
    for part in (s.where("granule % 3 <> 1"), s, s):
        stores.update_chunks(part, f"{path}/chunks", f"{path}/manifest")
    return spark.read.parquet(f"{path}/chunks").groupBy("chunk_id").agg(F.count("*").alias("n"), F.countDistinct("shot_num").alias("shots"), F.round(F.sum("elev_lm_a0"), 2).alias("elev"))


_BOX_OF_CELLS = (2760, 6536, 2775, 6556)


@register("grid_box", f"with {FIRST} select * from ({_stats_sql('rh_98_a0', 1000)}) where row between {_BOX_OF_CELLS[0]} and {_BOX_OF_CELLS[2]} and col between {_BOX_OF_CELLS[1]} and {_BOX_OF_CELLS[3]}")
def grid_box(spark, d):
    """Cells of a box, read back from grids that are stored by zones."""
    path = files.shared_folder(spark)
    files.write_grid(_stats(spark, d, 1000, ["rh_98_a0"]).withColumns({"family": F.lit("vf"), "res": F.lit(1000)}), path)
    return zones.read_box(spark, path, *_BOX_OF_CELLS).drop("family", "res")


_UNIQ = "count(date_dec) as shots_count, count(distinct orbit) as orbits_uniq, count(distinct cast(orbit as varchar) || '-' || beam) as tracks_uniq"


@register("count_sketches", f"with {VEG} " + " union all ".join(f"select {res} as res, win, {cell_sql(res)[0]} as row, {cell_sql(res)[1]} as col, {_UNIQ}, true as orbits_near, true as tracks_near from veg group by all" for res in (1000, 6000, 12000)))
def count_sketches(spark, d):
    """Exact counts beside those estimated from sketches of 1 km cells, merged for wider ones: whether each estimate lies within four standard errors."""
    v, limit = veg(spark, d), 4 * 1.04 / 2 ** (gridding.SKETCH_BITS / 2)
    fine, out = gridding.count_sketches(v, 1000), None
    for res in (1000, 6000, 12000):
        exact = gridding.cell_counts(gridding.with_cell(v, res))
        near = gridding.estimates(gridding.merge_sketches(fine, res // 1000)).withColumnsRenamed({"orbits_uniq": "o", "tracks_uniq": "t", "shots_count": "n"})
        close = lambda e, c: F.abs(F.col(e) - F.col(c)) <= limit * F.col(c)
        part = exact.join(near, ["win", "row", "col"]).select(F.lit(res).alias("res"), "win", "row", "col", F.col("n").alias("shots_count"), "orbits_uniq", "tracks_uniq", close("o", "orbits_uniq").alias("orbits_near"), close("t", "tracks_uniq").alias("tracks_near"))
        out = part if out is None else out.unionByName(part)
    return out
