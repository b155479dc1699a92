"""Hand-made rows, golden numbers and properties of the shot operators."""

import hashlib
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lidarlattice.functions import geo, metrics, names
from lidarlattice.operators import chunks, gridding, joins, lineage, percentiles, quality, validate, vector
from lidarlattice.schema import PAVD
from lidarlattice.sources import files
from lidarlattice.sources import shots as src


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_projection_and_cells(spark):
    # fixed values: projected bounds, and the 6 km cells of two known corners
    r = one(spark, x=geo.project_x(F.lit(180.0)), y=geo.project_y(F.lit(90.0)), z=geo.project_y(F.lit(52.0)))
    assert r["x"] == pytest.approx(17367530.445161, abs=1e-6) and r["y"] == pytest.approx(7342230.136499, abs=1e-5) and r["z"] == pytest.approx(5775916.830744, abs=1e-6)
    for lon, lat, col, row in ((-111.72086245973453, 35.418982428639026, 1098, 512), (-123.16290372331139, 38.82392991636058, 914, 454)):
        x, y = one(spark, x=geo.project_x(F.lit(lon)), y=geo.project_y(F.lit(lat)))
        g = geo.GridSpec(6000)
        assert (x - g.x0) / 6000 == pytest.approx(col, abs=1e-6) or (x - g.x0) / 6000 == pytest.approx(col + 1, abs=1e-6)
        assert abs((g.y0 - y) / 6000 - round((g.y0 - y) / 6000)) < 1e-6 and round((g.y0 - y) / 6000) in (row, row + 1)


def test_cover_share(spark):
    assert one(spark, c=geo.perc_cover(F.lit(3969.0), 6000))["c"] == pytest.approx(5.411884219660542, rel=1e-12)


def test_chunk_names(spark):
    rows = [(-112.0, 34.0, "112W34N"), (-0.5, -0.5, "001W01S"), (0.0, 0.0, "000E00N"), (179.99, 51.99, "179E51N"), (180.0, 0.0, None), (0.0, 52.0, None), (None, 1.0, None)]
    df = spark.createDataFrame([r[:2] for r in rows], "lon double, lat double").withColumn("c", geo.chunk_id("lon", "lat"))
    assert [r["c"] for r in df.collect()] == [r[2] for r in rows]
    b = one(spark, **geo.chunk_bounds(F.lit("001W01S"), buffer=0.25))
    assert tuple(b) == (-1.25, -1.25, 0.25, 0.25)


def test_polygon_even_odd(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    points = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0), (-1.0, 1.0), (1.0, -0.1), (None, 1.0)], "x double, y double")
    assert [r[0] for r in points.select(geo.in_polygon("x", "y", square)).collect()] == [True, False, False, False, None]


def shot(**given):
    """A shot that passes every filter and flag."""
    base = dict(shot_num="1", orbit=5, sub_orbit=1, beam="BEAM0101", sens_a0=0.97, sens_a2=0.97, surf_flag=1, stale_flag=0, rh_100_a0=20.0, elev_lm_a0=100.0, elev_dem_tdx=110.0, l2a_qflag_a0=1, pft=1, region=1, ls_waterp=0, urb_prop=0, deg_flag=0, leafoff_flag=0, sol_elev=-5.0, l2b_algrun_flag=1, l2b_qflag_a0=1, loc_out_umd=0, pai_a0=1.0, pai_l1=1.0, pavd_0_5=0.1, cover_a0=0.5, cover_l1=0.5, l4a_algrun_flag=1, l4a_qflag_a0=1, agbd_a0=10.0)
    return base | given


def table(spark, *rows):
    kinds = {k: "string" if isinstance(v, str) else "double" if isinstance(v, float) else "int" for k, v in shot().items()}
    return spark.createDataFrame([tuple(r[k] for k in kinds) for r in rows], ", ".join(f"{k} {t}" for k, t in kinds.items()))


@pytest.mark.parametrize("change,kept", [({}, 1), ({"sens_a0": 0.9}, 0), ({"sens_a0": float("nan")}, 0), ({"sens_a2": None}, 0), ({"pft": 2, "region": 4}, 0), ({"pft": 2, "region": None}, 1), ({"sens_a2": 0.99, "pft": 2, "region": 5}, 1), ({"deg_flag": 4}, 0), ({"deg_flag": 68}, 1), ({"ls_waterp": 10}, 0), ({"elev_dem_tdx": 250.0}, 0), ({"rh_100_a0": 120.0}, 0), ({"rh_100_a0": 0.0}, 1)])
def test_filter_l2a(spark, change, kept):
    assert quality.filter_l2a(table(spark, shot(**change))).count() == kept


@pytest.mark.parametrize("options,change,kept", [
    ({"leaf_on_only": True}, {"leafoff_flag": 255}, 1), ({"leaf_on_only": True}, {"leafoff_flag": 1}, 0), ({"leaf_on_only": True}, {"leafoff_flag": None}, 0), ({}, {"leafoff_flag": 1}, 1),
    ({"night_coverage_only": True}, {"beam": "BEAM0000"}, 1), ({"night_coverage_only": True}, {"beam": "BEAM0000", "sol_elev": 5.0}, 0), ({"night_coverage_only": True}, {"beam": "BEAM0101", "sol_elev": 5.0}, 1), ({"night_coverage_only": True}, {"beam": "BEAM9999"}, 0),
    ({}, {"pft": None, "region": 4}, 0), ({}, {"pft": None, "region": 1}, 1), ({"apply_deg_flag": False}, {"deg_flag": 4}, 1), ({"max_dem_diff": None}, {"elev_dem_tdx": 500.0}, 1), ({}, {"elev_dem_tdx": -41.0}, 1), ({}, {"elev_dem_tdx": -50.0}, 0), ({"max_waterp": None}, {"ls_waterp": 50}, 1), ({"max_urban": 10}, {"urb_prop": 20}, 0),
])
def test_filter_options(spark, options, change, kept):
    assert quality.filter_l2a(table(spark, shot(**change)), **options).count() == kept
    if "pft" not in change:
        assert quality.filter_l2b(table(spark, shot(**change)), **options).count() == kept


def test_filters_of_the_other_products(spark):
    rows = table(spark, shot(), shot(l2b_algrun_flag=0), shot(l2b_qflag_a0=0), shot(l2a_qflag_a0=0), shot(l4a_qflag_a0=0), shot(l4a_algrun_flag=0), shot(sens_a2=0.94), shot(deg_flag=4, leafoff_flag=1, ls_waterp=20, urb_prop=60))
    assert quality.filter_l2b(rows).count() == 4 and quality.filter_l2b(rows, apply_algrun=False, apply_l2b_qflag=False, apply_l2a_qflag=False, apply_deg_flag=False, max_waterp=None, max_urban=None).count() == 8
    assert quality.filter_l4a(rows).count() == 6 and quality.filter_l4a(rows, fix_sens=True).count() == 5 and quality.filter_l4a(rows, apply_algrun=True, apply_deg_flag=True, max_waterp=10, max_urban=50, leaf_on_only=True).count() == 4


@pytest.mark.parametrize("change,l2,l4", [({}, 1, 1), ({"deg_flag": 4}, 0, 0), ({"deg_flag": None}, 0, 0), ({"pai_a0": float("nan")}, None, None), ({"pai_a0": -1.0}, 0, 0), ({"cover_a0": None}, None, None), ({"cover_a0": None, "l2b_qflag_a0": 0}, 0, 0), ({"leafoff_flag": 1}, 0, 0), ({"leafoff_flag": None}, None, None), ({"leafoff_flag": None, "l2b_qflag_a0": 0}, 0, 0), ({"agbd_a0": -9999.0}, 1, 0), ({"agbd_a0": float("nan")}, 1, None), ({"loc_out_umd": 1}, 0, 0)])
def test_flags(spark, change, l2, l4):
    r = quality.hq_flags(table(spark, shot(**change))).first()
    assert (r["l2_hqflag"], r["l4a_hqflag"]) == (l2, l4)


def profile(spark, height, values, **more):
    given = {"rh_100_a0": height, "rh_98_a0": height and height * 0.9, "rh_75_a0": 5.0, "rh_50_a0": 3.0, "rh_25_a0": 1.0, "fhd_pai_1m_a0": 2.0} | more
    names_ = list(given)
    row = (*given.values(), *(values + [0.0] * (20 - len(values))))
    return metrics.with_metrics(spark.createDataFrame([row], ", ".join(f"{c} double" for c in [*names_, *PAVD]))).first()


def test_derived_metrics(spark):
    r = profile(spark, 12.0, [0.2, 0.2, 0.4])
    assert r["pavd_0_5_frac"] == pytest.approx(0.25) and r["pavd_max_h"] == 15 and r["fhd_pavd_5m_a0"] == pytest.approx(1.5 * math.log(2)) and r["even_pavd_5m_a0"] == pytest.approx(1.5 * math.log(2) / math.log(3))
    assert r["pavd_bot_frac"] == pytest.approx(0.25) and r["even_pai_1m_a0"] == pytest.approx(2 / math.log(12)) and r["rhvdr_m"] == pytest.approx(4 / 10.8)
    low = profile(spark, 4.0, [0.2])
    assert (low["pavd_0_5_frac"], low["rhvdr_b"], low["fhd_pavd_5m_a0"], low["pavd_top_frac"]) == (1.0, -9999.0, -9999.0, -9999.0)
    empty = profile(spark, 12.0, [])
    assert empty["pavd_0_5_frac"] is None and empty["fhd_pavd_5m_a0"] == -9999.0 and empty["pavd_bot_frac"] is None
    assert profile(spark, 1.0, [0.1])["even_pai_1m_a0"] is None and profile(spark, None, [0.1])["pavd_0_5_frac"] is None


def test_dedup_before_validity_and_idempotent(spark):
    rows = [("w", 100.0, 100.0, 1.0, "b", -9999.0), ("w", 101.0, 101.0, 2.0, "a", 5.0), ("w", 300.0, 100.0, 1.0, "c", 3.0), ("w", 300.0, 100.0, 1.0, "b", 4.0)]
    df = spark.createDataFrame(rows, "win string, x double, y double, date_dec double, shot_num string, m double")
    first = gridding.first_shot_per_fine_cell(df, ["x", "y", "m"])
    assert sorted((r["shot_num"], r["m"]) for r in first.collect()) == [("b", -9999.0), ("b", 4.0)]
    again = gridding.first_shot_per_fine_cell(first.drop("fc", "fr"), ["x", "y", "m"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect()))
    stats = gridding.grid_stats(gridding.with_cell(first, 1000), ["m"]).collect()
    assert [r["countf"] for r in stats] == [1] and gridding.mask_single(gridding.grid_stats(gridding.with_cell(first, 1000), ["m"])).collect() == []


def test_shannon_edges(spark):
    df = spark.createDataFrame([("w", 1, 1, v) for v in (0.0, 0.025, 0.03, 0.9)] + [("w", 2, 2, 0.5), ("u", 1, 1, 0.5), ("u", 1, 1, 2.0)], "win string, row int, col int, m double")
    got = {(r["win"], r["row"]): r["shan"] for r in gridding.shannon(df, "m", bins=(0.0, 1.0, 0.025)).collect()}
    assert got["w", 1] == pytest.approx(-(0.5 * math.log(0.5) + 2 * 0.25 * math.log(0.25))) and got["w", 2] is None and got["u", 1] is None


def test_counts_nest(spark, small):
    from lidarlattice.jobs import registry

    veg = registry.veg(spark, small).cache()
    totals = [gridding.cell_counts(gridding.with_cell(veg, res)).groupBy("win").agg(F.sum("shots_count").alias("n")).orderBy("win").collect() for res in (1000, 12000)]
    assert totals[0] == totals[1] and totals[0]
    veg.unpersist()


def test_nearest_distances():
    rng = np.random.default_rng(2)
    for n in (2, 3, 50, 700):
        x, y = rng.uniform(0, 1000, n), rng.uniform(0, 1000, n)
        x[: n // 3], y[: n // 3] = x[0] + rng.uniform(0, 1, n // 3), y[0] + rng.uniform(0, 1, n // 3)
        d = np.hypot(x[:, None] - x, y[:, None] - y)
        np.fill_diagonal(d, np.inf)
        assert np.allclose(vector.nearest_distances(x, y), d.min(axis=1))
    assert np.allclose(vector.nearest_distances(np.zeros(4), np.zeros(4)), 0)


def test_nearest_distances_of_groups():
    rng = np.random.default_rng(6)
    sizes = [1, 2, 2, 3, 1, 40, 40, 128, 129, 500, 3, 2]
    x, y = rng.uniform(0, 9, sum(sizes)), rng.uniform(0, 9, sum(sizes))
    edges = np.r_[0, np.cumsum(sizes)].tolist()
    groups = list(zip(edges, edges[1:], strict=False))
    want = np.concatenate([vector.nearest_distances(x[a:b], y[a:b]) for a, b in groups])
    assert np.allclose(vector.nearest_in_groups(x, y, groups), want, equal_nan=True)


def test_nearest_distances_on_tracks_and_clusters():
    rng = np.random.default_rng(3)
    for n in (130, 1000, 3000):
        t = rng.uniform(0, 1000, n)
        for x, y in ((t, 0.3 * t), (np.round(t, -2), np.round(rng.uniform(0, 1000, n), -2)), (t, rng.choice([0.0, 60.0, 120.0], n)), (np.exp(t / 60), np.exp(t / 70))):
            d = np.hypot(x[:, None] - x, y[:, None] - y)
            np.fill_diagonal(d, np.inf)
            assert np.allclose(vector.nearest_distances(x, y), d.min(axis=1))
    start = time.process_time()
    vector.nearest_distances(t := rng.uniform(0, 1000, 50_000), 0.3 * t)
    assert time.process_time() - start < 5  # a line is no worse than a square


def test_nearest_neighbour_index_of_cells_in_tiles(spark):
    rng = np.random.default_rng(4)
    rows = [("a", float(x), float(y)) for x, y in rng.uniform(0, 1000, (300, 2))] + [("a", 5.0, 5.0)] * 3 + [("a", 900.0 + i, 10.0) for i in range(40)] + [("b", 1.0, 1.0), ("b", 4.0, 5.0), ("c", 1.0, 2.0), ("d", 7.0, 7.0), ("d", 7.0, 7.0), ("e", None, 1.0)]
    df = spark.createDataFrame(rows, "cell string, px double, py double")
    want = {}
    for cell in "abd":
        p = np.array([(x, y) for c, x, y in rows if c == cell])
        d = np.hypot(p[:, None, 0] - p[None, :, 0], p[:, None, 1] - p[None, :, 1])
        np.fill_diagonal(d, np.inf)
        want[cell] = d.min(axis=1).mean() / (0.5 * np.sqrt(1e6 / len(p)))
    for tile in (50_000, 60, 15, 2):
        got = {r["cell"]: r["shots_nni"] for r in vector.nearest_neighbour_index(df, ["cell"], "px", "py", 1e6, tile).collect()}
        assert got.keys() == want.keys() and all(got[c] == pytest.approx(want[c]) for c in want)
    assert vector.nearest_neighbour_index(df.limit(0), ["cell"], "px", "py", 1e6).collect() == []


def test_subsamples_and_missing_codes(spark):
    def slow(n):
        sets = {}
        for b in range(1, (400 if n <= 12 else 150) + 1):
            keyed = sorted((hashlib.md5(f"{b}:{i}".encode()).hexdigest(), i) for i in range(1, n + 1))
            sets.setdefault(tuple(sorted(i - 1 for _, i in keyed[: int(np.rint(0.7 * n))])))
            if len(sets) == 100:
                break
        return [list(s) for s in sets]

    for n in (10, 12, 13, 200, 5):
        assert [s.tolist() for s in vector.subsample(n)] == slow(n)
    values = [float(i) for i in range(11)]
    rows = [("a", i, v) for i, v in enumerate([*values, -9999.0, float("nan"), float("inf"), None])] + [("b", i, float(i)) for i in range(9)] + [("c", 1, -9999.0)]
    got = {r["cell"]: r["meanbse"] for r in vector.mean_subsample_error(spark.createDataFrame(rows, "cell string, i int, m double"), ["cell"], "m", ["i"]).collect()}
    assert got.keys() == {"a", "b"} and got["b"] is None and got["a"] == pytest.approx(np.std([np.mean(np.array(values)[s]) for s in slow(11)], ddof=1))


def test_subsamples_of_large_cells():
    """Draws of all sizes are those of their own keys, and the table of draws serves every metric of a large cell."""
    for n in (4096, 4097, 6000):
        for b in (1, 150):
            key = np.array([int.from_bytes(hashlib.md5(f"{b}:{i}".encode()).digest()[:8], "big") for i in range(1, n + 1)], np.uint64)
            assert (vector._order(b, n) == np.argsort(key)).all()
    values = np.random.default_rng(5).normal(10, 3, 160_000)
    vector.subsample_error(values)
    start = time.process_time()
    e = vector.subsample_error(values[:159_000])
    assert time.process_time() - start < 1 and 0.5 < e / (3 * math.sqrt(0.3 / 0.7 / 159_000)) < 2


def test_polygons_with_a_shared_edge(spark):
    squares = spark.createDataFrame([(1, [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]), (2, [(2.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0)]), (3, [(0.0, 0.0), (4.0, 0.0), (2.0, 1.0)])], "polygon_id int, vertices array<struct<x: double, y: double>>")
    points = spark.createDataFrame([("p", 1.0, 1.5), ("q", 2.0, 1.5), ("r", 2.0, 0.5), ("s", 9.0, 1.0), ("t", None, 1.0)], "shot_num string, lon_lm_a0 double, lat_lm_a0 double")
    assert sorted((r["shot_num"], r["polygon_id"]) for r in joins.polygon_tag(points, squares).collect()) == [("p", 1), ("q", 2), ("r", 2), ("r", 3)]
    assert sorted(r["shot_num"] for r in joins.clip_polygons(points, squares).collect()) == ["p", "q", "r"]


PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


@pytest.mark.parametrize("last,parts", [(10_000, 4096), (5, 7), (1, 4096)])
@pytest.mark.parametrize("keys", [["g"], []])
def test_percentiles_by_counting(spark, monkeypatch, last, parts, keys):
    """The numbers of the built-in percentile, for values of every size, with ties, infinities, one value, and null keys."""
    monkeypatch.setattr(percentiles, "LAST", last)
    monkeypatch.setattr(percentiles, "PARTS", parts)
    values = "case when id % 50 = 0 then null when id % 51 = 0 then double('NaN') when id % 53 = 0 then double('inf') when id % 54 = 0 then -double('inf') when id % 7 < 3 then -9999.0 when id % 7 = 3 then cast(id % 11 - 5 as double) else (rand(3) - 0.4) * pow(10, rand(4) * 600 - 300) end"
    df = spark.range(3000).selectExpr("cast(id % 3 as int) as g", f"{values} as v").unionAll(spark.sql("select null, 1.5D union all select null, 2.5D union all select 9, null union all select 8, -0.0D union all select 8, 0.0D union all select 7, 4.9e-324D"))
    df = lineage.cut(df)
    want = {tuple(r[:-1]): r["p"] for r in df.where("v is not null and not isnan(v)").groupBy(*keys).agg(F.percentile("v", F.array(*map(F.lit, PROBS))).alias("p")).collect()}
    got = {tuple(r[:-2]): r["percentiles"] for r in percentiles.percentiles(df, keys, "v", PROBS).collect()}
    assert got == want and len(got) == (6 if keys else 1)
    assert percentiles.percentiles(df.limit(0), keys, "v", PROBS).collect() == []


def test_percentiles_of_one_large_group(spark):
    """Values of one group are never brought together: the most that one task sorts is bounded."""
    df = spark.range(400_000).selectExpr("double(pmod(id * 7919, 400009)) * 1.5 as v")
    got = percentiles.percentiles(df, [], "v", PROBS).first()
    assert got["n"] == 400_000 and got["percentiles"] == df.agg(F.percentile("v", F.array(*map(F.lit, PROBS)))).first()[0]


def test_column_profile_of_all_kinds_of_values(spark):
    """By hand, with codes between smaller and greater values, and a column without any."""
    values = [1.0, 2.5, -3.0, -9999.0, -9999.0, -20000.0, float("inf"), float("-inf"), float("nan"), None, 255.0, 32767.0, 0.0]
    df = spark.createDataFrame([("a", v, None) for v in values] + [("b", None, 4)], "chunk_id string, v double, w int")
    rows = {(r["chunk_id"], r["field_name"]): r for r in chunks.column_profile(df).collect()}
    r, valid = rows["a", "v"], np.array([1.0, 2.5, -3.0, -20000.0, 255.0, 32767.0, 0.0])
    fin = np.r_[valid, -9999.0, -9999.0]
    assert [r[c] for c in "n_all n_notna n_notnafin n_valid n_n9999 n_255 n_32767 n_neg n_neg_valid".split()] == [13, 11, 2, 7, 2, 1, 1, 4, 2]
    assert (r["min_fin"], r["med_fin"], r["max_fin"]) == (-20000.0, np.median(fin), 32767.0) and (r["min_valid"], r["max_valid"]) == (-20000.0, 32767.0)
    for p, c in ((5, "p05_valid"), (25, "p25_valid"), (50, "med_valid"), (75, "p75_valid"), (95, "p95_valid")):
        assert r[c] == pytest.approx(np.percentile(valid, p))
    assert r["mean_valid"] == pytest.approx(valid.mean()) and r["sd_valid"] == pytest.approx(valid.std(ddof=1)) and r["iqr_valid"] == pytest.approx(r["p75_valid"] - r["p25_valid"])
    for key in (("a", "w"), ("b", "v")):
        assert rows[key]["n_valid"] == 0 and all(rows[key][c] is None for c in ("min_fin", "med_fin", "mean_valid", "sd_valid", "med_valid", "iqr_valid"))
    one_value = rows["b", "w"]
    assert (one_value["med_valid"], one_value["sd_valid"], one_value["p95_valid"]) == (4.0, None, 4.0)


def test_mosaics(spark):
    tiles = spark.createDataFrame([(1, 1, 1, 5.0), (1, 1, 2, None), (1, 1, 3, float("nan")), (2, 2, 1, 7.0), (2, 2, 2, 8.0), (3, 3, 1, None)], "row int, col int, p int, v double")
    assert sorted((r["row"], r["v"]) for r in chunks.union_tiles(tiles, ["row", "col"], "v", "p").collect()) == [(1, 5.0), (2, 8.0), (3, -9999.0)]
    assert sorted((r["row"], r["v"]) for r in chunks.mosaic_first(tiles, ["row", "col"], "v", "p").collect()) == [(1, 5.0), (2, 7.0)]


def test_outliers_and_joins(spark):
    left = spark.createDataFrame([("1", 1.0, 5.0), ("2", 2.0, 6.0)], "shot_num string, lon double, v double")
    right = spark.createDataFrame([("1", 1.0, 50.0, 9), ("3", 3.0, 70.0, 8)], "shot_num string, lon double, v double, w int")
    assert [tuple(r) for r in joins.join_shots(left, right, ["shot_num", "lon"]).collect()] == [("1", 1.0, 5.0, 9)]
    assert sorted(map(tuple, joins.join_shots(left, right, ["shot_num", "lon"], join_all=True).collect())) == [("1", 1.0, 5.0, 9), ("3", 3.0, None, 8)]


def test_overlapping_windows_are_inclusive(spark):
    df = spark.sql("select explode(array(date'2019-04-17', date'2019-12-31', date'2020-01-01', date'2018-01-01')) as date")
    w = src.windows(spark, [("2019-04-17", "2019-12-31"), ("2019-04-17", "2023-03-16")])
    assert joins.window_join(df, w).count() == 5


def test_files_round_trip(spark, tmp_path):
    df = chunks.with_chunk(spark.createDataFrame([("1", -111.5, 34.5, 1, 255), ("2", -112.5, 34.5, 0, 3)], "shot_num string, lon_lm_a0 double, lat_lm_a0 double, l2_hqflag int, urb_prop int"))
    files.write_chunks(df, str(tmp_path / "chunks"))
    assert files.read_shots(spark, str(tmp_path / "chunks")).count() == 2
    files.export_shots(df, ["shot_num", "urb_prop"], str(tmp_path / "va"))
    back = spark.read.csv(str(tmp_path / "va"), header=True).collect()
    assert [(r["shot_num"], r["urb_prop"], r["chunk_id"]) for r in back] == [("1", "-9999", "112W34N")]
    files.write_shots(df, str(tmp_path / "x.csv"), "csv")
    assert files.read_shots(spark, str(tmp_path / "x.csv"), df.schema).count() == 2
    cells = spark.createDataFrame([("vf", "rh_98_a0", "w", 1000, 1, 2, 3.0)], "family string, metric string, win string, res int, row int, col int, mean double")
    files.write_grid(cells, str(tmp_path / "grid"))
    assert spark.read.parquet(str(tmp_path / "grid")).where("metric = 'rh_98_a0' and res = 1000").count() == 1
    name = cells.select(files.product_name("metric", "family", F.lit("2019-04-17").cast("date"), F.lit("2023-03-16").cast("date"), "res")).first()[0]
    assert name == "grid_rh-98-a0_vf_20190417_20230316_1000m"


def test_validation_file_names(spark, tmp_path):
    (tmp_path / "x_RH98_6000m_val_als_98p_east.csv").write_text('system:index,a_mean,.geo\n"1,2",3.5,"{""type"":""Polygon""}"\n')
    r = validate.read_validation(spark, str(tmp_path)).first()
    assert (r["metric"], r["res"], r["site"], r["a_mean"], r["system:index"]) == ("RH98", 6000, "east", 3.5, "1,2")


def test_dates(spark):
    r = one(spark, a=names.decimal_date(F.lit("2020-07-02").cast("date")), b=names.decimal_date(F.lit("2019-01-01").cast("date")), k=names.granule_key(F.lit("/a/SHOT02_A_2020193060840_O08943_02_T00094_02_003_01_V002.h5")))
    assert r["a"] == pytest.approx(2020 + 183 / 366) and r["b"] == 2019 and r["k"] == "2020193060840_O08943_02"
    d = one(spark, d=names.granule_date(F.lit("2020193060840_O08943_02")), p=names.granule_orbit(F.lit("SHOT02_A_2020193060840_O08943_02_T1.h5")))
    assert str(d["d"]) == "2020-07-11" and d["p"] == "O08943"


def test_result_does_not_depend_on_partitions(spark, tiny):
    from lidarlattice.jobs import workloads
    from lidarlattice.jobs.registry import OUT
    from lidarlattice.schema import WINDOWS

    s = src.shots(spark, tiny).selectExpr("*", f"{OUT} as loc_out_umd")
    w = src.windows(spark, WINDOWS[:2])
    runs = [sorted(map(str, workloads.grid_workload(df, w, ["rh_98_a0"], (6000,)).select("win", "row", "col", "countf", F.round("med", 9)).collect())) for df in (s.coalesce(1), s.repartition(7))]
    assert runs[0] == runs[1] and runs[0]
