"""Covers: polygons with holes, boxes of any size, any number of windows, against the plain rules."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lidarlattice.operators import cover, joins

POINT = "array<struct<x: double, y: double>>"


def even_odd(px, py, rings):
    hits = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            hits += (ay > py) != (by > py) and px < (bx - ax) * (py - ay) / (by - ay) + ax
    return hits % 2 == 1


def star(rng, x, y, r, n):
    return [(x + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), y + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]


def test_polygons_of_all_sizes_with_holes(spark):
    rng = random.Random(1)
    shapes = {}
    for i in range(60):
        x, y, r = rng.uniform(-3, 3), rng.uniform(-3, 3), 10 ** rng.uniform(-3, 0.6)
        shapes[i] = [star(rng, x, y, r, rng.choice((3, 4, 9, 80))), star(rng, x, y, r * 0.2, 5)]
        if i % 3 == 0:
            shapes[i].append(star(rng, x + 2 * r, y, r * 0.5, 4))
    shapes[100] = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)], [(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75)]]  # on cell edges
    shapes[101] = [[(0.5, -1.0), (0.5, 1.0), (0.5, 0.0)], []]  # no area
    shapes[102] = [[(-100.0, 0.1), (100.0, 0.1), (100.0, 0.100001), (-100.0, 0.100001)]]  # long and thin
    shapes[103] = []
    points = [(rng.uniform(-4, 4), rng.uniform(-4, 4)) for _ in range(1500)] + [(a / 8, b / 8) for a in range(-9, 10) for b in range(-9, 10)] + [(5.0, 0.1), (5.0, 0.1000005)]
    points += [p for i in (0, 5, 100) for ring in shapes[i] for p in ring] + [(None, 1.0), (1.0, None), (float("nan"), 1.0), (float("inf"), 0.0)]
    polygons = spark.createDataFrame(list(shapes.items()), f"polygon_id int, rings array<{POINT}>")
    df = spark.createDataFrame([(f"p{k}", *p) for k, p in enumerate(points)], "shot_num string, lon_lm_a0 double, lat_lm_a0 double")
    ok = [(f"p{k}", *p) for k, p in enumerate(points) if None not in p and all(map(math.isfinite, p))]
    want = sorted((k, i) for k, x, y in ok for i, rings in shapes.items() if even_odd(x, y, rings))
    got = sorted((r["shot_num"], r["polygon_id"]) for r in cover.polygon_tag(df, polygons).collect())
    assert got == want and len(want) > 500
    assert sorted(r["shot_num"] for r in cover.clip_polygons(df, polygons).collect()) == sorted({k for k, _ in want})
    cells = cover.polygon_cover(polygons)
    per = {r["polygon_id"]: r["n"] for r in cells.groupBy("polygon_id").agg(F.count("*").alias("n")).collect()}
    assert max(per.values()) < 6 * cover.MOST_CELLS and per[102] < 6 * cover.MOST_CELLS
    assert cover.polygon_tag(df, polygons.limit(0)).collect() == [] and cover.polygon_tag(df.limit(0), polygons).collect() == []


def test_points_meet_few_polygons(spark):
    """A grid of many polygons: each point meets a small number of cells, and most of them are inside, which needs no test."""
    squares = spark.range(2500).selectExpr("id as polygon_id", "double(id % 50) as x", "double(id div 50) as y").selectExpr("polygon_id", "array(named_struct('x', x, 'y', y), named_struct('x', x + 1, 'y', y), named_struct('x', x + 1, 'y', y + 1), named_struct('x', x, 'y', y + 1)) as vertices")
    points = spark.range(20000).selectExpr("cast(id as string) as shot_num", "50 * rand(1) as lon_lm_a0", "50 * rand(2) as lat_lm_a0")
    cells = cover.polygon_cover(squares)
    levels = [r[0] for r in cells.select("level").distinct().collect()]
    met = cover.met_cells(points, cells, levels, "lon_lm_a0", "lat_lm_a0")
    n, tested = met.count(), met.where("_edges is not null").count()
    assert n < 3 * 20000 and tested < 1.5 * 20000 and cover.polygon_tag(points, squares).count() == 20000
    plan = cover.polygon_tag(points, squares)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_few_polygons_are_dealt_over_tasks_and_met_in_shares(spark, monkeypatch):
    """A small table of polygons has a large cover; points and polygons of a cell meet in shares, equal points and polygons included."""
    for name, limit in (("POINTS", 40), ("POLYGONS", 3), ("AT_ONCE", 50)):
        monkeypatch.setattr(cover, name, limit)
    triangles = spark.range(60).selectExpr("id as polygon_id", "double(id % 4) / 8 as x").selectExpr("polygon_id", "array(named_struct('x', x, 'y', 0d), named_struct('x', x + 1, 'y', 0d), named_struct('x', x, 'y', 1d)) as vertices")
    assert cover.polygon_cover(triangles).rdd.getNumPartitions() == 8
    points = spark.range(2000).selectExpr("id", "array(id) as more", "double(id % 97) / 64 as lon_lm_a0", "double(id % 89) / 64 as lat_lm_a0")
    got = [(r["polygon_id"], r["id"]) for r in cover.polygon_tag(points, triangles).collect() if r["more"] == [r["id"]]]
    ring = lambda i: [(i % 4 / 8, 0.0), (i % 4 / 8 + 1, 0.0), (i % 4 / 8, 1.0)]
    assert sorted(got) == [(i, k) for i in range(60) for k in range(2000) if even_odd(k % 97 / 64, k % 89 / 64, [ring(i)])]


def test_boxes(spark):
    rng = random.Random(2)

    def box():
        x, y, w, h = rng.uniform(-180, 180), rng.uniform(-60, 60), 10 ** rng.uniform(-4, 2.5), 10 ** rng.uniform(-4, 2)
        return (x, y, x + w, y + h)

    a = [(i, *box()) for i in range(150)] + [(900, 0.0, 0.0, 1.0, 1.0), (901, 1.0, 1.0, 1.0, 1.0), (902, -180.0, -90.0, 180.0, 90.0), (903, None, 0.0, 1.0, 1.0), (904, 2.0, 0.0, 1.0, 1.0), (905, float("-inf"), 0.0, 1.0, 1.0)]
    b = [(i, *box()) for i in range(150)] + [(800, 1.0, 1.0, 2.0, 2.0), (801, 0.5, 0.5, 0.5, 0.5), (802, 0.0, 0.0, 1.0, 1.0), (803, 0.0, float("nan"), 1.0, 1.0)]
    ok = lambda t: [r for r in t if None not in r and all(map(math.isfinite, r)) and r[1] <= r[3] and r[2] <= r[4]]
    want = sorted((p[0], q[0]) for p in ok(a) for q in ok(b) if p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2])
    left, right = (spark.createDataFrame(t, f"{n} int, xmin double, ymin double, xmax double, ymax double") for n, t in (("a", a), ("b", b)))
    assert sorted(map(tuple, cover.box_join(left, right, "a", "b").collect())) == want and len(want) > 300
    for upward, most in ((False, 4), (True, 4 * (cover.BOX_COARSEST - cover.BOX_FINEST + 1))):
        assert cover.box_cells(left, upward).groupBy("a").count().agg(F.max("count")).first()[0] <= most
    assert cover.box_join(left.limit(0), right, "a", "b").collect() == []


@pytest.mark.parametrize("limits", [(4096, 4096, 1 << 16), (7, 20, 3)])
def test_boxes_counted_by_group(spark, monkeypatch, limits):
    """Without a row for each pair, in blocks and shares of any size; ids and boxes may repeat, groups may be null."""
    for name, limit in zip(("BLOCK", "PART", "SENT"), limits, strict=True):
        monkeypatch.setattr(cover, name, limit)
    rng = random.Random(5)

    def box():
        x, y, w, h = rng.uniform(-20, 20), rng.uniform(-20, 20), 10 ** rng.uniform(-4, 1.5), 10 ** rng.uniform(-4, 1.5)
        return (x, y, x + w, y + h)

    a = [(i, *box()) for i in range(200)] + [(900, 0.0, 0.0, 1.0, 1.0), (901, 1.0, 1.0, 1.0, 1.0), (902, -2e4, -2e4, 2e4, 2e4), (903, None, 0.0, 1.0, 1.0), (904, 2.0, 0.0, 1.0, 1.0)]
    b = [(f"g{i % 9}", *box()) for i in range(300)] + [("h", 1.0, 1.0, 2.0, 2.0)] * 5 + [(None, 0.5, 0.5, 0.5, 0.5), ("g1", 0.0, float("nan"), 1.0, 1.0)]
    ok = lambda t: [r for r in t if None not in r[1:] and all(map(math.isfinite, r[1:])) and r[1] <= r[3] and r[2] <= r[4]]
    for more in ([], [(3, *box()), (5, *a[5][1:])]):
        want = {}
        for p in ok(a + more):
            for q in ok(b):
                if p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2]:
                    want[p[0], q[0]] = want.get((p[0], q[0]), 0) + 1
        left, right = (spark.createDataFrame(t, f"{n}, xmin double, ymin double, xmax double, ymax double") for n, t in (("a int", a + more), ("g string", b)))
        got = cover.box_counts(left, right, "a", "g").collect()
        assert {(r["a"], r["g"]): r["n"] for r in got} == want and len(got) == len(want) > 300
    assert cover.box_counts(left.limit(0), right, "a", "g").collect() == cover.box_counts(left, right.limit(0), "a", "g").collect() == []


def test_a_file_that_spans_the_domain_is_listed_under_few_cells(spark):
    s = spark.createDataFrame([("f", "000E00N", -180.0, 180.0, -52.0, 52.0), ("g", "000E00N", 0.1, 0.2, 0.1, 0.2)], "file string, chunk_id string, xmin_shots double, xmax_shots double, ymin_shots double, ymax_shots double")
    chunks = spark.createDataFrame([("000E00N",), ("001W01S",), ("112W34N",)], "chunk_id string")
    got = sorted(map(tuple, joins.neighbour_files(s, chunks, 0.25).collect()))
    assert got == [("000E00N", "f"), ("000E00N", "g"), ("001W01S", "f"), ("001W01S", "g"), ("112W34N", "f")]
    extents = s.selectExpr("file", "xmin_shots as xmin", "xmax_shots as xmax", "ymin_shots as ymin", "ymax_shots as ymax")
    assert cover.box_cells(extents, True).where("file = 'f'").count() <= 8


@pytest.mark.parametrize("listed", [True, False])
def test_windows(spark, monkeypatch, listed):
    """Listed in the plan, and joined by spans."""
    monkeypatch.setattr(joins, "MOST_WINDOWS", 10_000 if listed else 0)
    rng = random.Random(3)
    days = sorted(rng.sample(range(10_000, 30_000), 300)) + [-400, 0, 1]
    wins = [(i, a, a + rng.choice((0, 1, 2, 30, 365, 5000, -1))) for i, a in enumerate(rng.choice(days) + rng.randint(-3, 3) for _ in range(300))] + [(900, -100_000, 400_000), (901, None, 5), (902, 0, 0), (903, -1, 1)]
    date = "date_add(date'1970-01-01', {})".format
    df = spark.createDataFrame([(d,) for d in [*days, 0, 0]] + [(None,)], "d int").selectExpr("d", f"{date('d')} as date")
    w = spark.createDataFrame(wins, "win int, a int, b int").selectExpr("win", f"{date('a')} as first_day", f"{date('b')} as last_day")
    want = sorted((d, i) for d in [*days, 0, 0] for i, a, b in wins if a is not None and a <= d <= b)
    assert sorted((r["d"], r["win"]) for r in joins.window_join(df, w).collect()) == want and len(want) > 1000


def test_a_hundred_thousand_windows(spark):
    """Against counts by running sums; the plan has no join but by equality."""
    w = spark.range(100_000).selectExpr("id as win", "date_add(date'2000-01-01', cast(id * 7919 % 9000 as int)) as first_day", "date_add(date'2000-01-01', cast(id * 7919 % 9000 + id % 1300 as int)) as last_day")
    df = spark.range(3000).selectExpr("date_add(date'2000-01-01', cast(id * 31 % 9500 as int)) as date")
    out = joins.window_join(df, w)
    assert all(k not in out._jdf.queryExecution().executedPlan().toString() for k in ("NestedLoop", "Cartesian"))
    per_day = {}
    for i in range(100_000):
        a = i * 7919 % 9000
        per_day[a] = per_day.get(a, 0) + 1
        per_day[a + i % 1300 + 1] = per_day.get(a + i % 1300 + 1, 0) - 1
    held, at = 0, []
    for day in range(9500):
        held += per_day.get(day, 0)
        at.append(held)
    assert out.count() == sum(at[i * 31 % 9500] for i in range(3000))
    spans = w.select(F.size(cover.spans(F.unix_date("first_day").cast("long"), F.unix_date("last_day").cast("long"))).alias("n")).agg(F.max("n"))
    assert spans.first()[0] <= 2 * 11
