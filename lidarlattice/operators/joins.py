"""Joins of products, grid cells, outlier lists, windows and files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lidarlattice.functions import geo, names
from lidarlattice.operators.cover import BOX, box_counts, box_join, clip_polygons, interval_join, polygon_tag

__all__ = ["clip_polygons", "polygon_tag"]

#: The coarse grid whose cells tag shots.
GRID72 = geo.GridSpec(72000.0)


def join_shots(left: DataFrame, right: DataFrame, on: list[str], join_all: bool = False) -> DataFrame:
    """Equi-join on shot keys; columns that both have keep the left values. `join_all` keeps every right row."""
    extra = [c for c in right.columns if c not in left.columns or c in on]
    return left.join(right.select(extra), on, "right" if join_all else "inner")


def join_granules(lists: dict[str, DataFrame], path_col: str = "path") -> DataFrame:
    """Inner join of product file lists on the granule key: key and a path column per product."""
    out = None
    for product, df in lists.items():
        one = df.select(names.granule_key(path_col).alias("key"), F.col(path_col).alias(product))
        out = one if out is None else out.join(one, "key")
    return out


def date_filter(granules: DataFrame, first: str, last: str, doy: tuple[int, int] = (1, 366)) -> DataFrame:
    d = names.granule_date("key")
    return granules.where(d.between(F.lit(first).cast("date"), F.lit(last).cast("date")) & F.dayofyear(d).between(*doy))


def grid_tag(df: DataFrame, cells: DataFrame) -> DataFrame:
    """Shots with the id of their coarse cell and projected coordinates; shots off the grid are dropped. cells: (c72, r72, grid_id), broadcast if small."""
    df = df.withColumns({"x": geo.project_x("lon_lm_a0"), "y": geo.project_y("lat_lm_a0")})
    df = df.withColumns({"c72": geo.cell_col("x", GRID72), "r72": geo.cell_row("y", GRID72)})
    return df.join(cells, ["c72", "r72"]).drop("c72", "r72")


def outlier_flag(df: DataFrame, outliers: DataFrame, remove: bool = False) -> DataFrame:
    """loc_out_umd: 1 where the orbit-grid id is listed. outliers: (orbit_grid). Orbits in text ("O08943") become numbers."""
    if dict(df.dtypes)["orbit"] == "string":
        df = df.withColumn("orbit", names.orbit_number("orbit"))
    keyed = df.withColumn("orbit_grid", geo.orbit_grid_id("orbit", "sub_orbit", "grid_id"))
    listed = outliers.select("orbit_grid").distinct()
    if remove:
        return keyed.join(listed, "orbit_grid", "left_anti")
    return keyed.join(listed.withColumn("hit", F.lit(1)), "orbit_grid", "left").withColumn("loc_out_umd", F.coalesce("hit", F.lit(0))).drop("hit")


#: Windows that a plan may list; more are joined.
MOST_WINDOWS = 1000


def window_join(df: DataFrame, windows: DataFrame, date_col: str = "date") -> DataFrame:
    """A row per shot and window that holds its date; windows: (win, first_day, last_day).

    A configured list of MOST_WINDOWS at most becomes an array literal of the plan, which
    needs no join; any number beyond that is joined by dyadic spans of days (interval_join).
    """
    if windows.limit(MOST_WINDOWS + 1).count() > MOST_WINDOWS:
        return interval_join(df, windows, date_col)
    spans = F.array(*[F.when(F.col(date_col).between(F.lit(w["first_day"]), F.lit(w["last_day"])), F.lit(w["win"])) for w in windows.collect()])
    return df.withColumn("win", F.explode(F.filter(spans, lambda w: w.isNotNull())))


def neighbour_files(summaries: DataFrame, chunks: DataFrame, distance: float = 0.25) -> DataFrame:
    """(chunk_id, file) where the file's extent meets the chunk widened by `distance` degrees.

    A join of boxes by a quadtree (box_join): an extent of any size is listed under a bounded
    number of cells.
    """
    extents = summaries.select("file", *[F.col(f"{c}_shots").alias(c) for c in BOX])
    wide = chunks.select("chunk_id").distinct().withColumns(geo.chunk_bounds("chunk_id"))
    d = F.lit(float(distance))
    wide = wide.select("chunk_id", *[(F.col(c) - d if c.endswith("min") else F.col(c) + d).alias(c) for c in BOX])
    return box_join(wide, extents, "chunk_id", "file").distinct()


def with_neighbours(df: DataFrame, distance: float = 0.25) -> DataFrame:
    """Shots with the id of every one-degree chunk that holds them or lies within `distance` degrees, of the chunks that hold a shot; a shot near an edge has several rows."""
    if not 0 <= distance < 1:
        raise ValueError("distance must be below one degree")
    around = lambda c: F.explode(F.sequence(F.ceil(F.col(c) - 1 - distance).cast("int"), F.floor(F.col(c) + distance).cast("int")))
    held = df.select(geo.chunk_id("lon_lm_a0", "lat_lm_a0").alias("chunk_id")).distinct()
    spread = df.withColumn("cx", around("lon_lm_a0")).withColumn("cy", around("lat_lm_a0")).withColumn("chunk_id", geo.chunk_id("cx", "cy"))
    return spread.drop("cx", "cy").join(held, "chunk_id", "left_semi")


def already_done(wanted: DataFrame, manifest: DataFrame, on: str) -> DataFrame:
    return wanted.join(manifest, on, "left_anti")


def checksum_audit(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """files (name, content) against manifest (name, md5): ok, changed, missing or unlisted."""
    have = files.select("name", F.md5(F.col("content")).alias("found"))
    return have.join(manifest, "name", "full").select("name", F.when(F.col("md5").isNull(), "unlisted").when(F.col("found").isNull(), "missing").when(F.col("found") == F.col("md5"), "ok").otherwise("changed").alias("status"))


def granule_bbox_query(catalog: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    return catalog.where((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))


def granule_boxes_query(catalog: DataFrame, boxes: DataFrame, granule: str = "granule", box: str = "box_id") -> DataFrame:
    """(box, granule) of all boxes asked for at once: granules of the catalog (xmin, ymin, xmax, ymax) that touch each."""
    return box_join(boxes, catalog, box, granule)


def granule_box_counts(catalog: DataFrame, boxes: DataFrame, granule: str = "granule", box: str = "box_id") -> DataFrame:
    """(box, granule, n) of all boxes asked for at once: how many rows of the catalog of each granule touch each box."""
    return box_counts(boxes, catalog, box, granule)
