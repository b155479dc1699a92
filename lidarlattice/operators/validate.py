"""Comparison of gridded values with airborne-lidar pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lidarlattice.functions import geo
from lidarlattice.operators.percentiles import percentiles

THRESHOLDS = (2, *range(5, 55, 5))


def validity_masks(pixels: DataFrame, water: DataFrame, urban: tuple[int, int], max_water: float = 10.0, year: int = 2020) -> DataFrame:
    """Pixels (row, col, value, cover_class, loss_year) that are no town, lost nothing in or after `year`, hold 0 to 100, and had little water over the years."""
    wet = water.groupBy("row", "col").agg(F.avg("water").alias("water")).where(F.col("water") < max_water).select("row", "col")
    ok = ~F.coalesce(F.col("cover_class").between(*urban), F.lit(False)) & F.coalesce(F.col("loss_year") < year, F.lit(True)) & F.col("value").between(0, 100)
    return pixels.where(ok).join(wet, ["row", "col"], "left_semi")


def terrain_slope(dem: DataFrame, size: float, tile: int = 256) -> DataFrame:
    """Slope in degrees from the four neighbours of a gridded elevation; null at edges and gaps.

    Pixels are dealt once, by square tiles with a rim of one pixel; both directions are
    windows within a tile.
    """
    tiles = lambda c: F.explode(F.array_distinct(F.array(*[F.floor((F.col(c) + d) / tile) for d in (-1, 0, 1)])))
    dealt = dem.select("row", "col", "elev").withColumn("tr", tiles("row")).withColumn("tc", tiles("col")).repartition("tr", "tc")
    along, down = Window.partitionBy("tr", "tc", "row").orderBy("col"), Window.partitionBy("tr", "tc", "col").orderBy("row")

    def gradient(w, axis):
        before, after = F.lag("elev").over(w), F.lead("elev").over(w)
        close = (F.lag(axis).over(w) == F.col(axis) - 1) & (F.lead(axis).over(w) == F.col(axis) + 1)
        return F.when(close, (after - before) / F.lit(2.0 * size))

    g = dealt.withColumns({"gx": gradient(along, "col"), "gy": gradient(down, "row")})
    own = (F.col("tr") == F.floor(F.col("row") / tile)) & (F.col("tc") == F.floor(F.col("col") / tile))
    return g.where(own).select("row", "col", F.degrees(F.atan(F.sqrt(F.col("gx") ** 2 + F.col("gy") ** 2))).alias("slope"))


def als_to_footprint(pixels: DataFrame, factor: int, p: float = 0.98) -> DataFrame:
    """Fine pixels -> footprint cells of `factor` pixels by a percentile of the values in [0, 100]."""
    keys = [F.floor(F.col(c) / factor).alias(c) for c in ("row", "col")]
    return pixels.where(F.col("value").between(0, 100)).groupBy(*keys).agg(F.percentile("value", F.lit(p)).alias("value"))


def covered_cells(pixels: DataFrame, factor: int) -> DataFrame:
    """Coarse cells all of whose pixels are there."""
    keys = [F.floor(F.col(c) / factor).alias(c) for c in ("row", "col")]
    return pixels.select("row", "col").distinct().groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") == factor * factor).drop("n")


def valid_percent(pixels: DataFrame, factor: int, least: float = 90.0) -> DataFrame:
    """Cells whose share of valid pixels (column valid, 0 or 1) is `least` percent or more."""
    keys = [F.floor(F.col(c) / factor).alias(c) for c in ("row", "col")]
    return pixels.groupBy(*keys).agg((F.avg("valid") * 100).alias("valid_perc")).where(F.col("valid_perc") >= least)


def als_cell_stats(pixels: DataFrame, factor: int, value: str = "value", slope: str | None = None) -> DataFrame:
    """Mean, percentiles, spread of the pixels of a coarse cell; with `slope` also the mean, population deviation and 95th percentile of that column."""
    keys = [F.floor(F.col(c) / factor).alias(c) for c in ("row", "col")]
    p = F.percentile(value, F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75, 0.95)]))
    steep = [F.avg(slope).alias("slope_mean"), F.stddev_pop(slope).alias("slope_sd"), F.percentile(slope, F.lit(0.95)).alias("slope_p95")] if slope else []
    wide = pixels.groupBy(*keys).agg(F.avg(value).alias("mean"), p.alias("p"), F.stddev_pop(value).alias("sd"), *steep)
    return wide.select("row", "col", "mean", F.col("p")[0].alias("p25"), F.col("p")[1].alias("med"), F.col("p")[2].alias("p75"), (F.col("p")[2] - F.col("p")[0]).alias("iqr"), F.col("p")[3].alias("p95"), "sd", *[c for c in wide.columns if c.startswith("slope_")])


def als_shannon(pixels: DataFrame, factor: int, low: float, high: float, steps: int, value: str = "value") -> DataFrame:
    """Diversity over `steps` equal left-closed bins; null for fewer than two filled bins."""
    v = pixels.where((F.col(value) >= low) & (F.col(value) < high))
    keys = [F.floor(F.col(c) / factor).alias(c) for c in ("row", "col")]
    counts = v.groupBy(*keys, F.floor((F.col(value) - F.lit(low)) / F.lit((high - low) / steps)).alias("bin")).agg(F.count("*").alias("c"))
    cells = counts.groupBy("row", "col").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.ln("c")).alias("s"), F.count("*").alias("bins"))
    return cells.select("row", "col", F.when(F.col("bins") >= 2, F.ln("n") - F.col("s") / F.col("n")).alias("shan"))


def shotcount_deciles(cells: DataFrame, count: str = "shots_count", width: int = 5) -> DataFrame:
    """Percentiles 10 to 100 of the shot count, exact at any number of cells, and a histogram of `width` shots: (kind, at, value)."""
    tenths = [x / 10 for x in range(1, 11)]
    deciles = percentiles(cells, [], count, tenths).select(F.posexplode("percentiles")).select(F.lit("percentile").alias("kind"), ((F.col("pos") + 1) * 10).cast("long").alias("at"), F.col("col").cast("double").alias("value"))
    histogram = cells.groupBy((F.floor(F.col(count) / width) * width).cast("long").alias("at")).agg(F.count("*").cast("double").alias("value")).select(F.lit("histogram").alias("kind"), "at", "value")
    return deciles.unionByName(histogram)


def paired_stats_long(wide: DataFrame, keys: list[str], stats: list[str], left: str = "als", right: str = "grid") -> DataFrame:
    """Columns <left>_<stat>, <right>_<stat> -> rows (stat, als, grid), complete and not below -10."""
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(f"{left}_{s}").cast("double").alias("als"), F.col(f"{right}_{s}").cast("double").alias("grid")) for s in stats])).alias("p")
    return wide.select(*keys, pairs).select(*keys, "p.*").where((F.col("als") >= -10) & (F.col("grid") >= -10) & ~F.isnan("als") & ~F.isnan("grid"))


def accuracy(pairs: DataFrame, keys: list[str]) -> DataFrame:
    d = F.col("als") - F.col("grid")
    return pairs.groupBy(*keys).agg(F.count("*").alias("n"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae"), F.avg("als").alias("_m")).withColumn("prmse", F.try_divide(F.col("rmse") * 100, F.col("_m"))).drop("_m")


def linear_fit(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """als ~ grid: slope, intercept, adjusted R squared, and the residuals' RMSE, MAE and relative RMSE.

    Two passes: the fit per group is small and is joined back for the absolute residuals.
    """
    fit = pairs.groupBy(*keys).agg(F.count("*").alias("n"), F.regr_slope("als", "grid").alias("slope"), F.regr_intercept("als", "grid").alias("intercept"), F.regr_r2("als", "grid").alias("r2"))
    residual = F.col("als") - (F.col("slope") * F.col("grid") + F.col("intercept"))
    left = pairs.join(fit, keys).groupBy(*keys).agg(F.sqrt(F.avg(residual * residual)).alias("lm_rmse"), F.avg(F.abs(residual)).alias("lm_mae"), F.avg("als").alias("_m"))
    adjusted: Column = 1 - (1 - F.col("r2")) * (F.col("n") - 1) / F.when(F.col("n") > 2, F.col("n") - 2)
    return fit.withColumn("adj_r2", adjusted).join(left, keys).withColumn("lm_prmse", F.try_divide(F.col("lm_rmse") * 100, F.col("_m"))).drop("_m", "r2")


def by_threshold(pairs: DataFrame, keys: list[str], count: str = "shotcount", thresholds: tuple[int, ...] = THRESHOLDS, least: int = 20) -> DataFrame:
    """Accuracy of the cells with at least `threshold` shots, for groups of `least` cells or more."""
    spread = pairs.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds)))).where(F.col(count) >= F.col("threshold"))
    return accuracy(spread, [*keys, "threshold"]).where(F.col("n") >= least)


def axis_limits(pairs: DataFrame, keys: list[str]) -> DataFrame:
    return pairs.groupBy(*keys).agg(F.floor(F.least(F.min("als"), F.min("grid"))).alias("low"), F.ceil(F.greatest(F.max("als"), F.max("grid"))).alias("high"))


def union_regions(regions: dict[str, DataFrame]) -> DataFrame:
    """Stack tables with the label of each; the label travels with its rows."""
    out = None
    for label, df in regions.items():
        df = df.withColumn("site", F.lit(label))
        out = df if out is None else out.unionByName(df)
    return out


def ring_of(text) -> Column:
    """The outer ring of a GeoJSON polygon as an array of projected corners (struct x, y), without the last one, which repeats the first; null for other texts."""
    parsed = F.from_json(text, "type string, coordinates array<array<array<double>>>")
    ring = F.when(parsed["type"] == "Polygon", F.get(parsed["coordinates"], F.lit(0)))
    open_ring = F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))
    return F.transform(open_ring, lambda p: F.struct(geo.project_x(F.get(p, F.lit(0))).alias("x"), geo.project_y(F.get(p, F.lit(1))).alias("y")))


def ring_corners(ring, res, grid: geo.GridSpec) -> Column:
    """Corners of a ring as (col, row) of the grid's corners, to the nearest one."""
    return F.transform(ring, lambda p: F.struct(F.round((p["x"] - F.lit(grid.x0)) / res).cast("long").alias("col"), F.round((F.lit(grid.y0) - p["y"]) / res).cast("long").alias("row")))


def with_geo_cell(df: DataFrame, res: str = "res", text: str = ".geo") -> DataFrame:
    """Add row and col of the cell that a row's polygon is, by its middle, and its corners on the grid; null where there is no polygon. `res` names the column of the cell size."""
    grid, size = geo.GridSpec(1.0), F.col(res)
    at = df.withColumn("_ring", ring_of(F.col(f"`{text}`")))
    middle = lambda a: F.aggregate("_ring", F.lit(0.0), lambda s, p: s + p[a]) / F.nullif(F.size("_ring"), F.lit(0))
    cells = {"row": F.floor((F.lit(grid.y0) - middle("y")) / size).cast("long"), "col": F.floor((middle("x") - F.lit(grid.x0)) / size).cast("long"), "corners": ring_corners(F.col("_ring"), size, grid)}
    return at.withColumns(cells).drop("_ring")


def read_validation(spark, path: str) -> DataFrame:
    """Validation tables (CSV with quoted polygons) under `path`, each a file or a folder of part files.

    Metric, resolution and region come from the names <x>_<metric>_<res>m_val_als_<p>p_<region>.csv.
    Tables with polygons (`.geo`) also get the row, col and corners of their cells.
    """
    pattern = r"[^/_]*_([^/_]+)_(\d+)m_val_als_[^/_]+_([^/.]+)\.csv"
    part = lambda i: F.regexp_extract(F.col("_metadata.file_path"), pattern, i)
    df = spark.read.option("header", True).option("escape", '"').option("inferSchema", True).option("recursiveFileLookup", True).csv(path)
    named = df.select("*", part(1).alias("metric"), part(2).cast("int").alias("res"), part(3).alias("site"))
    return with_geo_cell(named) if ".geo" in df.columns else named
