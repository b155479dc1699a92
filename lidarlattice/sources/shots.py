"""Shot tables derived from the order lines by fixed integer arithmetic.

The expressions are plain SQL that Spark and other engines read alike; decimals are written
as doubles so that all of them compute the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lidarlattice.schema import COVERAGE_BEAMS, PAVD, POWER_BEAMS

_BEAMS = (*POWER_BEAMS, *COVERAGE_BEAMS)
# long factors keep means away from ties of rounding, where engines may differ
_FACTORS = {100: "1.013728461e0", 98: "0.981273643e0", 95: "0.951726359e0", 75: "0.701827364e0", 50: "0.451928371e0", 25: "0.151827361e0"}

#: First step: short names for the keys.
KEYS = {"ok": "l_orderkey", "pk": "l_partkey", "sk": "l_suppkey", "ln": "cast(l_linenumber as bigint)", "qty": "l_quantity", "price": "l_extendedprice", "disc": "abs(l_discount)", "tax": "abs(l_tax)", "shipped": "l_shipdate"}
#: Second step: hashes and the date. {date} is the engine's own expression for 24 years later.
HASHED = {"h1": "(ok * 7919 + pk * 104729 + ln * 31) % 10007", "h2": "(ok * 15485863 + sk * 32452843 + pk * 49 + ln) % 10009", "date": "{date}"}
#: Third step: the shot's columns.
SHOT = {
    "shot_num": "concat_ws('-', cast(ok as {text}), cast(ln as {text}), cast(pk as {text}), cast(sk as {text}))",
    "orbit": "cast(ok % 400 as int)",
    "sub_orbit": "cast(ok % 4 as int)",
    "beam": "case (ln + sk) % 8 " + " ".join(f"when {i} then '{b}'" for i, b in enumerate(_BEAMS)) + " end",
    "date": "date",
    "date_dec": "year(date) + (dayofyear(date) - 1) / (case when year(date) % 4 = 0 then 366e0 else 365e0 end)",
    "lon_lm_a0": "-112.15e0 + 0.30e0 * h1 / 10007e0",
    "lat_lm_a0": "34.85e0 + 0.30e0 * h2 / 10009e0",
    "elev_lm_a0": "price / 19.987654321e0",
    "elev_dem_tdx": "price / 19.987654321e0 + ((pk % 400) - 200)",
    "sens_a0": "0.90e0 + (h1 % 1000) / 10000e0",
    "sens_a2": "0.90e0 + (h2 % 1000) / 10000e0",
    "sol_elev": "cast(h1 % 140 - 70 as double)",
    "surf_flag": "cast(case when pk % 31 = 0 then 0 else 1 end as int)",
    "stale_flag": "cast(case when sk % 37 = 0 then 1 else 0 end as int)",
    "deg_flag": "cast(case when pk % 4 = 0 then pk % 80 else 0 end as int)",
    "l2a_qflag_a0": "cast(case when ln % 7 = 6 then 0 else 1 end as int)",
    "l2b_qflag_a0": "cast(case when sk % 9 <> 0 then 1 else 0 end as int)",
    "l2b_algrun_flag": "cast(case when pk % 10 <> 0 then 1 else 0 end as int)",
    "l4a_qflag_a0": "cast(case when sk % 8 <> 0 then 1 else 0 end as int)",
    "l4a_algrun_flag": "cast(case when pk % 11 <> 0 then 1 else 0 end as int)",
    "num_modes_a0": "cast(1 + ok % 20 as int)",
    "pft": "cast(ok % 7 as int)",
    "region": "cast(sk % 7 as int)",
    "ls_waterp": "cast(ok % 12 as int)",
    "urb_prop": "cast(case when pk % 79 = 0 then 255 else pk % 60 end as int)",
    "leafoff_flag": "cast(case when sk % 11 = 0 then 1 else 0 end as int)",
    "leafoff_doy": "cast(case when pk % 73 = 0 then 32767 else ok % 366 end as int)",
    **{f"rh_{p}_a0": f"qty * {f}" for p, f in _FACTORS.items()},
    "cover_a0": "case when ok % 97 = 0 then null else disc * 9.987654323e0 end",
    "cover_l1": "disc * 8e0",
    "pai_a0": "case when ok % 89 = 0 then cast('NaN' as double) else tax * 99.87654319e0 end",
    "pai_l1": "tax * 90e0",
    "fhd_pai_1m_a0": "tax * 40e0",
    "agbd_a0": "case when ok % 83 = 0 then -9999e0 else price / 99.71827364e0 end",
    **{c: f"case when {5 * i}e0 < qty then ((pk + {7 * i}) % 13) / 100e0 else 0e0 end" for i, c in enumerate(PAVD)},
    "ok": "ok",
    "pk": "pk",
    "sk": "sk",
    "ln": "ln",
}


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined shot table."""
    words = {"text": "string", "date": "add_months(cast(shipped as date), 288)"}
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    df = df.selectExpr(*[f"{e} as {n}" for n, e in KEYS.items()])
    df = df.selectExpr("*", *[f"{e.format(**words)} as {n}" for n, e in HASHED.items()])
    return df.selectExpr(*[f"{e.format(**words)} as {n}" for n, e in SHOT.items()])


def shots_sql() -> str:
    """The same table as common table expressions for DuckDB (name: shots)."""
    words = {"text": "varchar", "date": "cast(shipped + INTERVAL 24 YEAR as date)"}
    one = ", ".join(f"{e} as {n}" for n, e in KEYS.items())
    two = ", ".join(f"{e.format(**words)} as {n}" for n, e in HASHED.items())
    three = ", ".join(f"{e.format(**words)} as {n}" for n, e in SHOT.items())
    return f"k0 as (select {one} from lineitem), k1 as (select *, {two} from k0), shots as (select {three} from k1)"


L2A = ["shot_num", "orbit", "sub_orbit", "beam", "date", "date_dec", "lon_lm_a0", "lat_lm_a0", "elev_lm_a0", "elev_dem_tdx", "sens_a0", "sens_a2", "sol_elev", "surf_flag", "stale_flag", "deg_flag", "l2a_qflag_a0", "num_modes_a0", "pft", "region", "ls_waterp", "urb_prop", "leafoff_flag", "leafoff_doy", *[f"rh_{p}_a0" for p in _FACTORS]]
L2B = ["shot_num", "lon_lm_a0", "lat_lm_a0", "rh_100_a0", "l2b_qflag_a0", "l2b_algrun_flag", "l2a_qflag_a0", "stale_flag", "surf_flag", "sens_a0", "elev_lm_a0", "cover_a0", "cover_l1", "pai_a0", "pai_l1", "fhd_pai_1m_a0", *PAVD]
L4A = ["shot_num", "lon_lm_a0", "lat_lm_a0", "sens_a0", "sens_a2", "elev_lm_a0", "l4a_qflag_a0", "l4a_algrun_flag", "l2a_qflag_a0", "stale_flag", "surf_flag", "pft", "region", "agbd_a0"]


def products(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three product tables, of which the second and third lack some shots."""
    s = shots(spark, sf_dir)
    return s.select(L2A), s.where("pk % 10 <> 3").select(L2B), s.where("sk % 7 <> 5").select(L4A)


def windows(spark: SparkSession, dates: list[tuple[str, str]]) -> DataFrame:
    rows = ", ".join(f"('{a.replace('-', '')}_{b.replace('-', '')}', date'{a}', date'{b}')" for a, b in dates)
    return spark.sql(f"select * from values {rows} as w(win, first_day, last_day)")


def windows_sql(dates: list[tuple[str, str]]) -> str:
    rows = ", ".join(f"('{a.replace('-', '')}_{b.replace('-', '')}', date '{a}', date '{b}')" for a, b in dates)
    return f"windows(win, first_day, last_day) as (values {rows})"


def file_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Granule file paths of three products, one per order and product (a few are missing)."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", "o_custkey", "o_orderdate", *[f"{e.format(text='string', pad=_PAD['spark'])} as {n}" for n, e in PATHS.items()])


_PAD = {"spark": "lpad(cast(dayofyear(o_orderdate) as string), 3, '0')", "sql": "lpad(cast(dayofyear(o_orderdate) as varchar), 3, '0')"}
_KEY = "concat(cast(year(o_orderdate) + 24 as {text}), {pad}, lpad(cast(o_orderkey % 240000 as {text}), 6, '0'), '_O', lpad(cast(o_custkey % 100000 as {text}), 5, '0'), '_0', cast(o_orderkey % 4 + 1 as {text}))"
PATHS = {p: f"concat('/archive/', '{n}_', {_KEY}, '_T00094_02_003_01_V002.h5')" for p, n in (("path_a", "SHOT02_A"), ("path_b", "SHOT02_B"), ("path_c", "SHOT04_A"))}


def file_paths_sql() -> str:
    items = ", ".join(f"{e.format(text='varchar', pad=_PAD['sql'])} as {n}" for n, e in PATHS.items())
    return f"paths as (select o_orderkey, o_custkey, o_orderdate, {items} from orders)"
