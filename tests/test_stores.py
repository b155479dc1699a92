"""Stored tables: buckets, zones, updates, checksums of files; counts by step, sketches, group functions, polygons as text."""

import hashlib
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lidarlattice.jobs import registry, workloads
from lidarlattice.operators import chunks, gridding, validate
from lidarlattice.sources import files, stores, zones
from lidarlattice.sources import shots as src


def executed(df):
    """The plan that ran, as text."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan


def test_bucketed_products_join_without_an_exchange(spark, tiny, tmp_path):
    names = []
    for product, df in zip(("a", "b", "c"), src.products(spark, tiny), strict=True):
        names.append(f"stored_{product}")
        stores.write_bucketed(df, names[-1], str(tmp_path / product), buckets=4)
        assert len(list((tmp_path / product).glob("part-*"))) <= 4
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stores.join_bucketed(spark, names)
        plan = executed(joined).toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
        assert joined.count() == registry.QUERIES["join_l2_l4a"](spark, tiny).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in names:
            spark.sql(f"drop table {name}")


def by_hand(row, col):
    return sum(((row >> i & 1) << (2 * i + 1)) | ((col >> i & 1) << (2 * i)) for i in range(32))


def test_curve(spark):
    cells = [(0, 0), (1, 0), (0, 1), (3, 5), (1023, 1), (123456, 654321), (2**31 - 1, 2**31 - 1)]
    df = spark.createDataFrame(cells, "row long, col long").select(zones.morton(F.col("row"), F.col("col")).alias("m"), zones.zone(F.col("row"), F.col("col")).alias("z"))
    assert [tuple(r) for r in df.collect()] == [(by_hand(*c), by_hand(c[0] >> 9, c[1] >> 9)) for c in cells]


def files_read(df):
    leaves = executed(df).collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_a_box_of_a_stored_grid_reads_few_files(spark, tmp_path):
    cells = spark.range(64 * 64).selectExpr("'vf' as family", "'m' as metric", "'w' as win", "1000 as res", "id div 64 * 64 as row", "id % 64 * 64 as col", "double(id) as mean")
    path = str(tmp_path / "grid")
    files.write_grid(cells, path)
    n = len(list((tmp_path / "grid").rglob("part-*")))
    assert n >= 64  # zones of 512 cells a side
    box = zones.read_box(spark, path, 600, 600, 900, 1100)
    assert sorted((r["row"], r["col"]) for r in box.collect()) == [(r, c) for r in range(640, 900, 64) for c in range(640, 1101, 64)]
    assert files_read(box) <= 2 * n / 64
    # what is written again replaces its own zones only
    files.write_grid(cells.where("row < 512 and col < 512").withColumn("mean", F.lit(-1.0)), path)
    assert spark.read.parquet(path).count() == 64 * 64 and spark.read.parquet(path).where("mean = -1").count() == 64


def test_a_large_chunk_and_a_large_product_are_several_files(spark, tmp_path):
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.01"}
    old = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        shots = spark.range(0, 40_000, 1, 8).selectExpr("cast(id as string) as shot_num", "case when id % 100 = 0 then '113W34N' else '112W34N' end as chunk_id", "uuid() as text")
        files.write_chunks(shots, str(tmp_path / "c"))
        assert len(list((tmp_path / "c" / "chunk_id=112W34N").glob("part-*"))) > 1
        cells = spark.range(0, 40_000, 1, 8).selectExpr("'vf' as family", "'m' as metric", "'w' as win", "1000 as res", "id div 200 as row", "id % 200 as col", "rand() as mean")
        files.write_grid(cells, str(tmp_path / "g"))
        assert len(list((tmp_path / "g").rglob("part-*"))) > 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_updates_touch_only_chunks_of_new_granules(spark, tmp_path):
    rows = [(f"{g}{i}", g, c, float(i)) for g, c in (("g1", "112W34N"), ("g1", "111W34N"), ("g2", "111W34N"), ("g3", "110W34N"), ("g3", None)) for i in range(5)]
    df = spark.createDataFrame(rows, "shot_num string, granule string, chunk_id string, v double")
    path, manifest = str(tmp_path / "c"), str(tmp_path / "m")
    held = lambda: {c: {p.name for p in (tmp_path / "c" / f"chunk_id={c}").glob("part-*")} for c in ("112W34N", "111W34N", "110W34N")}
    table = lambda: sorted(tuple(r) for r in spark.read.parquet(path).select("shot_num", "granule", "chunk_id", "v").collect())
    assert sorted(r[0] for r in stores.update_chunks(df.where("granule = 'g1'"), path, manifest).collect()) == ["g1"]
    before = held()
    assert sorted(r[0] for r in stores.update_chunks(df.where("granule <> 'g3'"), path, manifest).collect()) == ["g2"]
    after = held()
    assert before["112W34N"] == after["112W34N"] and before["111W34N"] != after["111W34N"] and not after["110W34N"]
    stores.update_chunks(df, path, manifest)
    assert held()["111W34N"] == after["111W34N"] and table() == sorted(r for r in rows if r[2])
    assert stores.update_chunks(df, path, manifest).collect() == [] and sorted(r["granule"] for r in spark.read.parquet(manifest).collect()) == ["g1", "g2", "g3"]
    # a run that stopped before it listed its granules is made good
    spark.read.parquet(manifest).where("granule <> 'g2'").write.parquet(str(tmp_path / "m2"))
    stores.update_chunks(df, path, str(tmp_path / "m2"))
    assert table() == sorted(r for r in rows if r[2])


def test_checksums_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "PIECE", 7)
    content = {"a": b"x" * 100_000, "b": b"", "c": b"changed", "d": b"more"}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    md5 = lambda b: hashlib.md5(b).hexdigest()
    path = lambda n: str(tmp_path / n)
    manifest = spark.createDataFrame([(path("a"), md5(content["a"]).upper()), (f"file://{path('b')}", md5(b"")), (path("c"), md5(b"before")), (path("e"), "0" * 32), (str(tmp_path), "0" * 32)], "path string, md5 string")
    found = spark.createDataFrame([(path("a"),), (path("d"),)], "path string")
    got = {os.path.basename(re.sub("^file://", "", r["path"])): r["status"] for r in stores.audit_files(manifest, found).collect()}
    assert got == {"a": "ok", "b": "ok", "c": "changed", "d": "unlisted", "e": "missing", tmp_path.name: "missing"}


def test_counts_by_step_come_from_the_job_itself(spark, tiny):
    a, b, c = src.products(spark, tiny)
    counts = workloads.StepCounts()
    out = workloads.condition_shots(a, b, c, registry.coarse_cells(spark, tiny), registry.outlier_list(spark, tiny), max_dem_diff=None, counts=counts)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "one action")
    n = out.count()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts.rows()["in_chunks"] == n and counts.rows()["l2a"] == a.count() and counts.rows()["l2b"] == b.count() and counts.rows()["l4a"] == c.count()
    assert list(counts.rows()) == ["l2a", "l2a_kept", "l2b", "l2b_kept", "l4a", "l4a_kept", "l2_joined", "joined", "on_grid", "in_chunks"]
    assert len(tracker.getJobIdsForGroup("counted")) > 0


def test_shots_that_lack_a_position_date_or_orbit_are_left_out(spark):
    rows = [("1", 1.0, 2.0, 3.0, 2020.5, 7, 0, 1), ("2", None, 2.0, 3.0, 2020.5, 7, 0, 1), ("3", 1.0, 2.0, 3.0, None, 7, 0, 1), ("4", 1.0, 2.0, 3.0, 2020.5, None, 0, 1), ("5", 1.0, float("nan"), 3.0, 2020.5, 7, 0, 1), ("6", 1.0, 2.0, None, 2020.5, 7, 0, 1), ("7", 1.0, 2.0, 3.0, 2020.5, 7, 1, 0), ("8", 1.0, 2.0, 3.0, 2020.5, 7, 0, None)]
    df = spark.createDataFrame(rows, "shot_num string, lon_lm_a0 double, lat_lm_a0 double, elev_lm_a0 double, date_dec double, orbit int, loc_out_umd int, l2_hqflag int")
    ground, veg = workloads.split_shots(df)
    assert sorted(r["shot_num"] for r in ground.collect()) == ["1", "8"] and [r["shot_num"] for r in veg.collect()] == ["1"]


def test_group_functions_beside_aggregates(spark):
    rows = [("w", 1, 1, float(t), v) for t, v in enumerate([1.0, 5.0, -9999.0, float("nan"), 2.0, float("inf")])] + [("w", 2, 2, 1.0, 4.0), ("w", 3, 3, 1.0, -9999.0)]
    df = spark.createDataFrame(rows, "win string, row int, col int, t double, m double")
    got = {r["row"]: r for r in gridding.grid_stats(df, ["m"], stats={"mean": F.avg, "countf": F.count}, functions={"last": lambda v: float(v[-1]), "span": lambda v: float(np.ptp(v)) if len(v) > 1 else None}, order=["t"]).collect()}
    assert (got[1]["mean"], got[1]["countf"], got[1]["last"], got[1]["span"]) == (pytest.approx(8 / 3), 3, 2.0, 4.0)
    assert (got[2]["last"], got[2]["span"]) == (4.0, None) and (got[3]["countf"], got[3]["last"]) == (0, None)


def test_sketches_merge(spark):
    df = spark.range(60_000).selectExpr("'w' as win", "double(1000 * (id % 12)) - 17367530.0 as x", "7314540.0 - double(1000 * (id % 7)) as y", "cast(id * 31 % 20011 as int) as orbit", "concat('B', id % 8) as beam", "2020.0 as date_dec")
    fine = gridding.count_sketches(df, 1000)
    for times in (1, 6, 12):
        exact = {(r["row"], r["col"]): r for r in gridding.cell_counts(gridding.with_cell(df, 1000 * times)).collect()}
        near = {(r["row"], r["col"]): r for r in gridding.estimates(gridding.merge_sketches(fine, times)).collect()}
        assert exact.keys() == near.keys() and all(exact[k]["shots_count"] == near[k]["shots_count"] for k in exact)
        worst = max(abs(near[k][c] / exact[k][c] - 1) for k in exact for c in ("orbits_uniq", "tracks_uniq"))
        assert worst < 4 * 1.04 / 2 ** (gridding.SKETCH_BITS / 2)


def test_polygons_as_text(spark, tmp_path):
    """Known corners: the projected polygon's corners are whole cells (fixed values)."""
    for (lon, lat), (col, row) in {(-111.72086245973453, 35.418982428639026): (1098, 512), (-123.16290372331139, 38.82392991636058): (914, 454)}.items():
        text = f'{{"type": "Polygon", "coordinates": [[[{lon}, {lat}], [{lon + 0.0621}, {lat}], [{lon + 0.0621}, {lat - 0.05}], [{lon}, {lat - 0.05}], [{lon}, {lat}]]]}}'
        (tmp_path / f"x_RH98_6000m_val_als_98p_s{col}.csv").write_text(f'a,.geo\n1.5,"{text.replace(chr(34), chr(34) * 2)}"\n')
        r = validate.read_validation(spark, str(tmp_path / f"x_RH98_6000m_val_als_98p_s{col}.csv")).first()
        assert (r["row"], r["col"]) == (row, col) and (r["corners"][0]["col"], r["corners"][0]["row"]) == (col, row) and len(r["corners"]) == 4 and r["corners"][1]["col"] == col + 1
    odd = spark.createDataFrame([(None, 6000), ("no json", 6000), ('{"type": "Point", "coordinates": [1, 2]}', 6000), ('{"type": "Polygon", "coordinates": []}', 6000)], "`.geo` string, res int")
    assert [(r["row"], r["col"]) for r in validate.with_geo_cell(odd).collect()] == [(None, None)] * 4


def test_export_profile_recodes_first(spark):
    df = spark.createDataFrame([("c", 255, 32767, 0, 1), ("c", 3, 10, 0, 0), ("c", 4, 20, 1, 0)], "chunk_id string, urb_prop int, leafon_doy int, loc_out_umd int, l2_hqflag int")
    got = {(r["family"], r["field_name"]): r for r in chunks.export_profile(df, ["urb_prop", "leafon_doy"]).collect()}
    assert (got["ga", "urb_prop"]["n_n9999"], got["ga", "urb_prop"]["n_255"], got["ga", "urb_prop"]["med_valid"]) == (1, 0, 3.0)
    assert (got["va", "leafon_doy"]["n_all"], got["va", "leafon_doy"]["n_n9999"], got["va", "leafon_doy"]["med_valid"]) == (1, 1, None)


def test_count_bands_read_stored_shots(spark, tiny):
    """The shots are derived once: no band of any family or resolution goes back to the given table."""
    from lidarlattice.jobs import registry

    out = registry.w2_counts(spark, tiny)
    assert "lineitem" not in out._jdf.queryExecution().optimizedPlan().toString() and {r[0] for r in out.select("family").distinct().collect()} == {"ga", "va"}


def test_profiles_read_compressed_tables(spark, tiny):
    """What profiles read several times is kept as columns, not as whole rows."""
    from lidarlattice.jobs import registry

    s = registry.shots(spark, tiny).select(*registry._PROFILED)
    kept = registry._stored(s)
    assert kept.inputFiles() and all(f.endswith(".zstd.parquet") for f in kept.inputFiles())
    assert kept.schema.simpleString() == s.schema.simpleString() and sorted(map(str, kept.collect())) == sorted(map(str, s.collect()))


def test_profiles_of_beam_records_are_written_small(spark, tmp_path):
    """Height profiles that repeat from row to row take less than a byte a value."""
    df = spark.range(0, 20000, 1, 2).selectExpr("id", "transform(sequence(0, 100), p -> double(id * 7919 % 50) * p / 100e0) as rh")
    files.write_shots(df, f"{tmp_path}/t")
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert all(f.name.endswith(".zstd.parquet") for f in (tmp_path / "t").glob("*.parquet")) and size < 20000 * 101
    assert sorted(map(str, files.read_shots(spark, f"{tmp_path}/t").collect())) == sorted(map(str, df.collect()))
