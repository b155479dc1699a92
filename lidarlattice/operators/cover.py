"""Joins by covers: polygons by cells of two axes, boxes by a quadtree, intervals by dyadic spans.

Each turns a geometric condition into an equi-join on cells whose number for each polygon,
box or interval is bounded, whatever its size; what meets is tested with the exact rule.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarlattice.operators.lineage import cut

#: Cells of a polygon's cover, about: four for each edge within these bounds.
LEAST_CELLS, MOST_CELLS = 64, 4096
#: Levels of cells, of size 2 ** level.
FINEST, COARSEST = -20, 40
#: How far, in cells, an edge is taken to reach: far more than rounding can move it.
MARGIN = 1e-6


def size_of(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def cell(v: Column, level: Column) -> Column:
    """The cell that holds v: exact, as sizes are powers of two."""
    return F.floor(v / size_of(level)).cast("long")


def _level(size: Column) -> Column:
    """The finest level whose cells are at least so large."""
    fit = F.ceil(F.log2(F.greatest(size, F.lit(2.0**FINEST)))).cast("int")
    return F.least(F.lit(COARSEST), F.greatest(F.lit(FINEST), fit))


def in_rings(px: Column, py: Column, edges: Column | str) -> Column:
    """Even-odd rule, half open: a point on the left or lower side is inside. edges: array of struct (ax, ay, bx, by)."""
    hits = F.filter(edges, lambda e: ((e["ay"] > py) != (e["by"] > py)) & (px < (e["bx"] - e["ax"]) * (py - e["ay"]) / (e["by"] - e["ay"]) + e["ax"]))
    return F.size(hits) % 2 == 1


def polygon_edges(polygons: DataFrame, id_col: str) -> DataFrame:
    """(id, e): the edges of all rings. polygons hold `rings` (array of arrays of struct x, y), or `vertices`, one such ring; rings close by themselves."""
    rings = F.col("rings") if "rings" in polygons.columns else F.array("vertices")
    ring = polygons.select(F.col(id_col), F.explode(rings).alias("r")).where(F.size("r") > 1)
    closed = F.concat("r", F.slice("r", 1, 1))
    n = F.size("r")
    ends = F.zip_with(F.slice(closed, F.lit(1), n), F.slice(closed, F.lit(2), n), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    finite = lambda *cs: sum((F.abs(F.col(f"e.{c}")) * 0 for c in cs), F.lit(0.0)) == 0
    return ring.select(id_col, F.explode(ends).alias("e")).where(finite("ax", "ay", "bx", "by"))


def polygon_cover(polygons: DataFrame, id_col: str = "polygon_id") -> DataFrame:
    """(level, cx, cy, id, edges): the cells of each polygon; edges is null for a cell inside, and holds those that decide for a cell on an edge.

    A polygon picks the level at which it has a bounded number of cells, by its extent and
    its number of edges. The edges are listed by the bands of y that they cross, and mark the
    cells that they pass there; a run of cells between marked ones is inside or outside as its
    middle is. A marked cell keeps its band's edges that do not lie wholly on its left.
    """
    # a cover is far more than its polygons, so their small size must not decide the number of tasks
    dealt = polygons.repartition(int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions")), id_col)
    edges = polygon_edges(dealt, id_col)
    e = F.col("e")
    lower, upper = (lambda a: F.least(e[f"a{a}"], e[f"b{a}"])), (lambda a: F.greatest(e[f"a{a}"], e[f"b{a}"]))
    box = edges.groupBy(id_col).agg(F.count("*").alias("n"), *[f(side(a)).alias(f"{a}{k}") for a in "xy" for k, f, side in ((0, F.min, lower), (1, F.max, upper))])
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    most = F.least(F.lit(float(MOST_CELLS)), F.greatest(F.lit(float(LEAST_CELLS)), F.col("n") * 4.0))
    levels = box.select(id_col, _level(F.greatest(F.sqrt(w * h / most), F.greatest(w, h) / most)).alias("level"))
    s = size_of(F.col("level"))
    at = edges.join(levels, id_col)
    banded = at.withColumn("cy", F.explode(F.sequence(F.floor(lower("y") / s - MARGIN).cast("long"), F.floor(upper("y") / s + MARGIN).cast("long"))))
    # where the edge is within the band
    flat = e["ay"] == e["by"]
    x_at = lambda y: e["ax"] + (e["bx"] - e["ax"]) * (y - e["ay"]) / F.when(flat, 1.0).otherwise(e["by"] - e["ay"])
    y0, y1 = F.greatest(lower("y"), (F.col("cy") - MARGIN) * s), F.least(upper("y"), (F.col("cy") + 1 + MARGIN) * s)
    near, far = F.when(flat, lower("x")).otherwise(F.least(x_at(y0), x_at(y1))), F.when(flat, upper("x")).otherwise(F.greatest(x_at(y0), x_at(y1)))
    passed = banded.withColumn("c", F.sequence(F.floor(F.greatest(near, lower("x")) / s - MARGIN).cast("long"), F.floor(F.least(far, upper("x")) / s + MARGIN).cast("long")))
    bands = passed.groupBy(id_col, "level", "cy").agg(F.collect_list("e").alias("es"), F.array_distinct(F.flatten(F.collect_list("c"))).alias("marked"))
    middle = lambda c: (c.cast("double") + 0.5) * s
    free = F.array_except(F.sequence(F.array_min("marked"), F.array_max("marked")), F.col("marked"))
    inside = F.filter(free, lambda c: in_rings(middle(c), middle(F.col("cy")), "es"))
    none = F.lit(None).cast("array<struct<ax: double, ay: double, bx: double, by: double>>")
    on = bands.select("level", F.explode("marked").alias("cx"), "cy", id_col, "es").withColumn("edges", F.filter("es", lambda e: F.greatest(e["ax"], e["bx"]) >= (F.col("cx") - MARGIN) * s)).drop("es")
    return on.unionByName(bands.select("level", F.explode(inside).alias("cx"), "cy", id_col, none.alias("edges")))


def keyed_cells(df: DataFrame, levels: list[int], x: str, y: str) -> DataFrame:
    """Rows of `df` under their cell at each level; rows without coordinates are dropped."""
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    at = F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>"))
    keyed = df.where((F.abs(px) < float("inf")) & (F.abs(py) < float("inf"))).withColumn("_level", at)
    return keyed.withColumns({"_cx": cell(px, F.col("_level")), "_cy": cell(py, F.col("_level"))})


def met_cells(df: DataFrame, cover: DataFrame, levels: list[int], x: str, y: str) -> DataFrame:
    """Rows of `df` with each polygon whose cover holds their cell, before the exact test."""
    return keyed_cells(df, levels, x, y).join(cover.withColumnsRenamed({"level": "_level", "cx": "_cx", "cy": "_cy", "edges": "_edges"}), ["_level", "_cx", "_cy"])


#: Points and polygons of a cell that are compared as one row, about, and comparisons that are made at once.
POINTS, POLYGONS, AT_ONCE = 4096, 1024, 1 << 19


def _dealt(df: DataFrame, keys: list[str], most: int, by: list[str], name: str) -> DataFrame:
    """`df` with the number of a share of its keys' rows, of about `most` rows at most."""
    shares = df.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(float(most))).alias("_shares"))
    return df.join(shares, keys, "left").withColumn(name, F.pmod(F.xxhash64(*by), F.coalesce("_shares", F.lit(1)))).drop("_shares")


def _points_inside(batches):
    """Record batches of points (x, y, row) and polygons (id, edges) of a cell -> each row with the polygons that hold it, by the rule of in_rings."""
    held, rows = [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            points, polygons = batch.column("points")[k].values, batch.column("polygons")[k].values
            px, py = (points.field(c).to_numpy()[:, None] for c in "xy")
            sizes = polygons.field("edges").value_lengths().fill_null(-1).to_numpy()
            whole, some = np.flatnonzero(sizes < 0), np.flatnonzero(sizes > 0)
            pairs = [(np.repeat(np.arange(len(points)), len(whole)), np.tile(whole, len(points)))]
            if some.size:
                edges = polygons.field("edges").flatten()
                ax, ay, bx, by = (edges.field(c).to_numpy() for c in ("ax", "ay", "bx", "by"))
                starts, step = np.r_[0, np.cumsum(sizes[some])[:-1]], max(1, AT_ONCE // len(ax))
                for a in range(0, len(points), step):
                    x, y = px[a : a + step], py[a : a + step]
                    with np.errstate(all="ignore"):  # a flat edge is never crossed
                        hits = ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
                    p, q = np.nonzero(np.bitwise_xor.reduceat(hits, starts, axis=1))
                    pairs.append((p + a, some[q]))
            for p, q in pairs:
                if p.size:
                    found = points.field("row").take(pa.array(p))
                    held.append(pa.RecordBatch.from_arrays([*found.flatten(), polygons.field("id").take(pa.array(q))], names=[f"c{i}" for i in range(found.type.num_fields + 1)]))
                    rows += p.size
                if rows > 1 << 16:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def polygon_tag(df: DataFrame, polygons: DataFrame, x: str = "lon_lm_a0", y: str = "lat_lm_a0", id_col: str = "polygon_id") -> DataFrame:
    """Rows with the id of each polygon that holds them; rows in none, and rows without coordinates, are dropped.

    polygons: (id, vertices: array of struct x, y), or with `rings`, an array of such arrays,
    of which those inside others are holes (even-odd rule, half open: a point on a shared
    edge is in one polygon only). The points of a cell meet its polygons by an equi-join, in
    arrays of bounded size (POINTS, POLYGONS), and need a test only in the cells on edges. The
    few different sizes of cells in use are listed in the plan.
    """
    cover = cut(polygon_cover(polygons, id_col)).withColumnRenamed(id_col, "_id").withColumnsRenamed({"level": "_level", "cx": "_cx", "cy": "_cy"})
    levels = [r["_level"] for r in cover.select("_level").distinct().orderBy("_level").collect()]  # COARSEST - FINEST + 1 at most
    tasks, cells = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["_level", "_cx", "_cy"]
    shares = cover.groupBy(*cells).agg(F.ceil(F.count("*") / F.lit(float(POLYGONS))).alias("_shares"))
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    points = _dealt(keyed_cells(df, levels, x, y), cells, POINTS, hashed, "_chunk").join(shares, cells).withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_shares") - 1)))
    # what meets is far more than the points and polygons, so these are dealt over all tasks
    place = F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.struct(*df.columns).alias("row"))
    points = points.repartition(tasks, *cells, "_share").groupBy(*cells, "_share", "_chunk").agg(F.collect_list(place).alias("points"))
    held = _dealt(cover, cells, POLYGONS, ["_id"], "_share").repartition(tasks, *cells, "_share").groupBy(*cells, "_share").agg(F.collect_list(F.struct(F.col("_id").alias("id"), "edges")).alias("polygons"))
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate([*df.schema.fields, polygons.schema[id_col]])])
    return points.join(held, [*cells, "_share"]).select("points", "polygons").mapInArrow(_points_inside, schema).toDF(*df.columns, id_col)


def clip_polygons(df: DataFrame, polygons: DataFrame, x: str = "lon_lm_a0", y: str = "lat_lm_a0", id_col: str = "polygon_id") -> DataFrame:
    """Rows that lie in any of the polygons, once each: a row needs a key of its own for that, shot_num."""
    inside = polygon_tag(df.select("shot_num", x, y), polygons, x, y, id_col).select("shot_num").distinct()
    return df.join(inside, "shot_num", "left_semi")


# -- boxes ------------------------------------------------------------------------------------

#: Sizes of the quadtree's cells for boxes, as levels: boxes that are smaller or larger use the first or last.
BOX_FINEST, BOX_COARSEST = -6, 10
BOX = ("xmin", "ymin", "xmax", "ymax")


def sound_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes with the level of their size (own); those without limits on all sides, or turned inside out, are dropped."""
    own = F.least(F.lit(BOX_COARSEST), F.greatest(F.lit(BOX_FINEST), _level(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")))))
    ok = (F.col("xmin") <= F.col("xmax")) & (F.col("ymin") <= F.col("ymax")) & (F.abs(F.col("xmin")) < float("inf")) & (F.abs(F.col("ymin")) < float("inf")) & (F.col("xmax") < float("inf")) & (F.col("ymax") < float("inf"))
    return boxes.where(ok).withColumn("own", own)


def touched_cells(boxes: DataFrame) -> DataFrame:
    """Boxes with a level, under each cell of it that they touch."""
    spread = lambda a: F.explode(F.sequence(cell(F.col(f"{a}min"), F.col("level")), cell(F.col(f"{a}max"), F.col("level"))))
    return boxes.withColumn("cx", spread("x")).withColumn("cy", spread("y"))


def box_cells(boxes: DataFrame, upward: bool) -> DataFrame:
    """Each box (xmin, ymin, xmax, ymax) under the cells it touches at its own level, or, upward, at that level and all coarser ones: four at a level at most.

    Boxes without limits on all sides, or turned inside out, have no cells.
    """
    listed = sound_boxes(boxes)
    return touched_cells(listed.withColumn("level", F.explode(F.sequence(F.col("own"), F.lit(BOX_COARSEST))) if upward else F.col("own")))


def box_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """(left id, right id) of each pair of boxes that touch (edges included), once for each pair of rows.

    Both tables hold (id, xmin, ymin, xmax, ymax). A box lies in four cells at most at the
    level of its own size, and at every coarser one. The larger box of a pair is listed at its
    own level and the smaller one at that and the coarser ones, so they share a cell; the
    cell that holds the lower left corner of their overlap gives the pair.
    """
    named = lambda df, i, p: df.select(F.col(i).alias(p), *BOX)

    def side(df, p, upward):
        cells = box_cells(df, upward)
        return cells.select("level", "cx", "cy", p, *[F.col(c).alias(f"{p}{c}") for c in BOX], F.col("own").alias(f"{p}own"))

    a, b = named(left, left_id, "_a"), named(right, right_id, "_b")
    small_left = side(a, "_a", True).join(side(b, "_b", False), ["level", "cx", "cy"]).where("_aown <= _bown")
    small_right = side(a, "_a", False).join(side(b, "_b", True), ["level", "cx", "cy"]).where("_aown > _bown")
    met = small_left.unionByName(small_right)
    x, y = F.greatest("_axmin", "_bxmin"), F.greatest("_aymin", "_bymin")
    touch = (x <= F.least("_axmax", "_bxmax")) & (y <= F.least("_aymax", "_bymax"))
    once = (cell(x, F.col("level")) == F.col("cx")) & (cell(y, F.col("level")) == F.col("cy"))
    return met.where(touch & once).select(F.col("_a").alias(left_id), F.col("_b").alias(right_id))


#: Boxes of a block, which are counted together; boxes of a part of the groups, about; boxes of a cell that are sent as one row, about; how many levels a block's cell is above its boxes.
BLOCK, PART, SENT, RAISED = 4096, 4096, 1 << 16, 2


def _touch_counts(batches):
    """Record batches of blocks (boxes) and of the boxes that they may touch (rects), in order of the block -> (id, group, n)."""
    at, ids, mine, counts, names, codes, kind = None, None, None, [], [], {}, None

    def out():
        rows = 0
        held: list[tuple] = []
        for k, n in enumerate(counts):
            hit = np.flatnonzero(n)
            held.append((hit, np.full(len(hit), k), n[hit]))
            rows += len(hit)
            if rows > 1 << 17 or k == len(counts) - 1:
                hits, groups, ns = (np.concatenate(c) for c in zip(*held, strict=True))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(hits)), pa.array(names, kind).take(pa.array(groups)), pa.array(ns)], names=["a", "g", "n"])
                rows, held = 0, []

    def meet(rects, level, cx, cy):
        x0, y0, x1, y1 = (rects.field(c).to_numpy() for c in BOX)
        ax0, ay0, ax1, ay1 = mine
        size = 2.0**level
        # of the cells that both touch, the one with the lower left corner of their overlap counts
        once = (np.floor(np.maximum(x0, ax0.min()) / size) == cx) & (np.floor(np.maximum(y0, ay0.min()) / size) == cy)
        near = np.flatnonzero(once & (x0 <= ax1.max()) & (x1 >= ax0.min()) & (y0 <= ay1.max()) & (y1 >= ay0.min()))
        if not near.size:
            return
        coded = rects.field("_g").take(pa.array(near)).dictionary_encode(null_encoding="encode")
        for name in coded.dictionary.to_pylist():
            if name not in codes:
                codes[name] = len(names)
                names.append(name)
                counts.append(np.zeros(len(ids), np.int64))
        group = np.array([codes[name] for name in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]
        order = np.argsort(group, kind="stable")
        near, group = near[order], group[order]
        x0, y0, x1, y1, w = (v[near] for v in (x0, y0, x1, y1, rects.field("_w").to_numpy()))
        every = (x0 <= ax1.min()) & (x1 >= ax0.max()) & (y0 <= ay1.min()) & (y1 >= ay0.max())  # touch all boxes of the block
        for k, n in enumerate(np.bincount(group[every], w[every], len(names)).astype(np.int64)):
            if n:
                counts[k] += n
        x0, y0, x1, y1, w, group = (v[~every] for v in (x0, y0, x1, y1, w, group))
        if not group.size:
            return
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        step, plain = max(1, (1 << 21) // len(group)), (w == 1).all()
        for a in range(0, len(ids), step):
            b = slice(a, a + step)
            touch = (x0 <= ax1[b, None]) & (x1 >= ax0[b, None]) & (y0 <= ay1[b, None]) & (y1 >= ay0[b, None])
            n = np.add.reduceat(touch.view(np.int8) if plain else touch * w, starts, axis=1, dtype=np.int64)
            for k, g in enumerate(group[starts]):
                counts[g][b] += n[:, k]

    for batch in batches:
        kind = batch.schema.field("rects").type.value_type.field("_g").type
        for row in range(batch.num_rows):
            key = tuple(batch.column(c)[row].as_py() for c in ("_bl", "_bx", "_by", "_no", "part"))
            boxes, rects = batch.column("boxes")[row], batch.column("rects")[row]
            if key != at:
                if at is not None:
                    yield from out()
                at, ids, mine, counts, names, codes = key, boxes.values.field("_a"), [boxes.values.field(c).to_numpy() for c in BOX], [], [], {}
            if rects.is_valid:
                meet(rects.values, *(batch.column(c)[row].as_py() for c in ("level", "cx", "cy")))
    if at is not None:
        yield from out()


def box_counts(left: DataFrame, right: DataFrame, left_id: str, group: str) -> DataFrame:
    """(left id, group, n): how many right boxes of each group touch each left box (edges included); none give no row.

    The pairs of box_join, counted without a row for each. Left boxes of about one size and
    place make a block of BLOCK at most. A block looks up the right boxes of its own size or
    less under the cells that it touches, and larger ones under the cells of their own level,
    four cells a level at most. Groups are dealt into parts, and a task compares a block with a
    part of the groups: right boxes that touch the whole block are counted at once, and the
    others are compared in arrays of bounded size.
    """
    session = left.sparkSession
    tasks = int(session.conf.get("spark.sql.shuffle.partitions"))
    doubles = lambda df, column, name: df.select(F.col(column).alias(name), *[F.col(c).cast("double").alias(c) for c in BOX])
    block, cells = ["_bl", "_bx", "_by", "_no"], ["level", "cx", "cy"]
    a = sound_boxes(doubles(left, left_id, "_a")).withColumn("_bl", F.least(F.lit(BOX_COARSEST), F.col("own") + RAISED))
    a = _dealt(a.withColumns({"_bx": cell(F.col("xmin"), F.col("_bl")), "_by": cell(F.col("ymin"), F.col("_bl"))}), block[:3], BLOCK, ["_a", *BOX], "_no")
    blocks = cut(a.groupBy(*block).agg(F.collect_list(F.struct("_a", *BOX)).alias("boxes"), *[f(c).alias(c) for f, c in zip((F.min, F.min, F.max, F.max), BOX, strict=True)]))
    b = cut(sound_boxes(doubles(right, group, "_g")).groupBy("_g", "own", *BOX).agg(F.count("*").alias("_w")))
    levels = [r[0] for r in blocks.select("_bl").distinct().collect()]  # BOX_COARSEST - BOX_FINEST + 1 at most, as are those below
    sizes = {r["own"]: r["n"] for r in b.groupBy("own").agg(F.count("*").alias("n")).collect()}
    parts = max(1, -(-sum(sizes.values()) // PART))
    listed = lambda values: F.array(*map(F.lit, values)) if values else F.array().cast("array<int>")
    under = F.array_union(F.array("own"), F.filter(listed(levels), lambda level: level > F.col("own")))
    held = touched_cells(b.withColumn("level", F.explode(under))).withColumns({"large": F.col("level") == F.col("own"), "part": F.pmod(F.xxhash64("_g"), F.lit(parts))})
    keys = [*cells, "large", "part"]
    held = _dealt(held, keys, SENT, ["_g", *BOX], "_share").groupBy(*keys, "_share").agg(F.collect_list(F.struct("_g", *BOX, "_w")).alias("rects"))
    asked = blocks.drop("boxes").withColumn("level", F.explode(F.array_union(F.array("_bl"), F.filter(listed(list(sizes)), lambda level: level > F.col("_bl")))))
    met = touched_cells(asked).join(held, cells).where("large or level = _bl").select(*block, "part", *cells, "rects")
    each = blocks.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))).select(*block, "part", "boxes")
    rows = each.unionByName(met, allowMissingColumns=True).repartition(tasks, *block, "part").sortWithinPartitions(*block, "part", F.col("level").asc_nulls_first())
    schema = T.StructType([T.StructField("a", left.schema[left_id].dataType), T.StructField("g", right.schema[group].dataType), T.StructField("n", T.LongType())])
    out = rows.mapInArrow(_touch_counts, schema).toDF(left_id, group, "n")
    if blocks.select(F.explode("boxes._a").alias("_a")).groupBy("_a").count().where("count > 1").isEmpty():
        return out
    return out.groupBy(left_id, group).agg(F.sum("n").alias("n"))


# -- intervals --------------------------------------------------------------------------------

#: Spans of days go up to 2 ** SPANS of them (some 180 years); longer intervals take several of the longest.
SPANS = 16


def spans(first: Column, last: Column) -> Column:
    """Dyadic spans that make up the days first to last (numbers), as an array of struct (level, span): two a level, of the longest as many as there are."""

    def at(level: int) -> Column:
        low = lambda k: F.ceil(first / F.lit(2.0**k)).cast("long")
        high = lambda k: (F.floor((last + 1) / F.lit(2.0**k)) - 1).cast("long")
        a, b = low(level), high(level)
        if level == SPANS:
            found = F.when(a <= b, F.sequence(a, b))
        else:  # but for those that a longer span holds
            p, q = 2 * low(level + 1), 2 * high(level + 1) + 1
            ends = F.array_compact(F.array(F.when(a < p, a), F.when(b > q, b)))
            found = F.when(a > b, None).when(p <= q, ends).otherwise(F.sequence(a, F.greatest(a, b)))
        return F.transform(F.coalesce(found, F.array().cast("array<long>")), lambda k: F.struct(F.lit(level).alias("level"), k.alias("span")))

    return F.flatten(F.array(*[at(level) for level in range(SPANS + 1)]))


def interval_join(df: DataFrame, windows: DataFrame, date_col: str = "date") -> DataFrame:
    """A row for each row of `df` and window that holds its date; windows (win, first_day, last_day, both inclusive), any number of them.

    Windows are cut into dyadic spans of days, two a level, and meet the different dates of
    `df` under the spans that hold these; the dates' windows are then joined to the rows.
    Nothing goes through the driver. Windows without both days, or that end before they
    begin, hold nothing, as do null dates.
    """
    day = lambda c: F.unix_date(F.col(c).cast("date")).cast("long")
    pieces = windows.where("first_day <= last_day").select("win", F.explode(spans(day("first_day"), day("last_day"))).alias("s")).select("win", "s.*")
    dates = df.select(F.col(date_col).alias("_date")).where("_date is not null").distinct()
    under = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.floor(day("_date") / F.lit(2.0**k)).cast("long").alias("span")) for k in range(SPANS + 1)])).alias("s")
    held = dates.select("_date", under).select("_date", "s.*").join(pieces, ["level", "span"]).select("_date", "win")
    return df.join(held, df[date_col] == held["_date"]).drop("_date")
