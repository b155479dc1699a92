"""From shots to grid cells: first shot per fine cell, counts, statistics, diversity, masks.

A cell is (win, r12, c12, row, col): the 12 km cell leads, as finer cells nest in it, so that
one exchange on (win, r12, c12) serves every resolution.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lidarlattice.functions import geo
from lidarlattice.functions.metrics import histogram_bin
from lidarlattice.operators.quality import valid
from lidarlattice.operators.vector import GroupStat, group_stats
from lidarlattice.schema import BINS

CELL = ["win", "row", "col"]


def with_xy(df: DataFrame) -> DataFrame:
    return df.withColumns({"x": geo.project_x("lon_lm_a0"), "y": geo.project_y("lat_lm_a0")})


def with_cell(df: DataFrame, res: float) -> DataFrame:
    grid = geo.GridSpec(res)
    return df.withColumns({"row": geo.cell_row("y", grid), "col": geo.cell_col("x", grid)})


def first_shot_per_fine_cell(df: DataFrame, columns: list[str], by: tuple[str, ...] = ("win",)) -> DataFrame:
    """Of each fine cell and window the shot of the least (date_dec, shot_num); combined before the shuffle.

    Metric validity comes later on purpose: a cell whose first shot is invalid is lost.
    """
    keyed = df.withColumns({"fc": geo.fine_col("x"), "fr": geo.fine_row("y")})
    kept = F.struct(*dict.fromkeys(["date_dec", "shot_num", *columns]))
    return keyed.groupBy(*by, "fc", "fr").agg(F.min_by(kept, F.struct("date_dec", "shot_num")).alias("s")).select(*by, "fc", "fr", "s.*")


def cell_counts(df: DataFrame, keys: list[str] = CELL) -> DataFrame:
    """shots_count, orbits_uniq, tracks_uniq: pre-aggregated per orbit and beam, so that no distinct expands the rows."""
    tracks = df.groupBy(*keys, "orbit", "beam").agg(F.count("date_dec").alias("n"))
    orbits = tracks.groupBy(*keys, "orbit").agg(F.sum("n").alias("n"), F.count("*").alias("t"))
    return orbits.groupBy(*keys).agg(F.sum("n").alias("shots_count"), F.count("orbit").alias("orbits_uniq"), F.sum("t").alias("tracks_uniq"))


Stat = Callable[[Column], Column]
#: Aggregates of a metric's valid values, and what is read off the one array of percentiles afterwards.
STATS: dict[str, Stat] = {"mean": F.avg, "sd": F.stddev_samp, "quantiles": lambda c: F.percentile(c, F.array(*map(F.lit, (0.25, 0.5, 0.75, 0.95)))), "countf": F.count}
OF_QUANTILES: dict[str, Stat] = {"med": lambda q: q[1], "iqr": lambda q: q[2] - q[0], "p95": lambda q: q[3]}


def approximate(accuracy: int = 10_000) -> dict[str, Stat]:
    """STATS with percentiles of bounded memory, for cells of so many different values that exact ones do not fit."""
    return STATS | {"quantiles": lambda c: F.percentile_approx(c, [0.25, 0.5, 0.75, 0.95], accuracy)}


def grid_stats(df: DataFrame, metrics: list[str], keys: list[str] = CELL, stats: dict[str, Stat] | None = None, batch: int = 8, functions: dict[str, GroupStat] | None = None, order: list[str] | None = None, dealt: bool = False) -> DataFrame:
    """One row per cell and metric with the chosen statistics of its valid values.

    Metrics are aggregated side by side, `batch` at a time to stay within generated code's
    limits, and turned into rows afterwards. A stat is any function from a column to an
    aggregate, so callers may add their own; one named "quantiles" gives med, iqr and p95.
    `functions` are statistics that no aggregate expresses: functions of a cell's valid
    values (a numpy array, in the order of the columns `order`), which run beside the others
    in a sorted stream. `dealt`: the rows of a cell are in one partition already.
    """
    stats = stats or STATS
    read = lambda m: [f(m["quantiles"]).alias(s) for s, f in OF_QUANTILES.items()] if "quantiles" in stats else []
    parts = []
    for at in range(0, len(metrics), batch):
        some = metrics[at : at + batch]
        wide = df.groupBy(*keys).agg(*[F.struct(*[f(F.when(valid(m), F.col(m))).alias(s) for s, f in stats.items()]).alias(m) for m in some])
        parts.append(wide.select(*keys, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("s")) for m in some])).alias("m")).select(*keys, "m.metric", *[F.col(f"m.s.{s}") for s in stats if s != "quantiles"], *read(F.col("m.s"))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.join(group_stats(df, keys, metrics, functions, order or [], dealt), [*keys, "metric"], "left") if functions else out


def shannon(df: DataFrame, metric: str, keys: list[str] = CELL, bins: tuple[float, float, float] | None = None) -> DataFrame:
    """Shannon diversity of a fixed-bin histogram: counts per (cell, bin) first, then ln N - sum c ln c / N.

    Null for cells of one value, and for every cell of a window in which some value lies
    outside the bins.
    """
    low, high, step = bins or BINS[metric]
    v = df.where(valid(metric)).select(*keys, F.col(metric).alias("v"))
    counts = v.groupBy(*keys, histogram_bin("v", low, step).alias("bin")).agg(F.count("*").alias("c"), F.max(((F.col("v") < low) | (F.col("v") > high)).cast("int")).alias("out"))
    cells = counts.groupBy(*keys).agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.ln("c")).alias("s"), F.max("out").alias("out"))
    bad = cells.groupBy(keys[0]).agg(F.max("out").alias("bad"))
    h = F.greatest(F.lit(0.0), F.ln("n") - F.col("s") / F.col("n"))
    return cells.join(F.broadcast(bad), keys[0]).select(*keys, F.when((F.col("n") > 1) & (F.col("bad") == 0), h).alias("shan"))


def shannon_of(df: DataFrame, metrics: list[str], keys: list[str] = CELL) -> DataFrame:
    """The same for several metrics at once, a row per cell and metric; each value is a row on its way to its bin."""
    limits = {m: BINS[m] for m in metrics}
    one = lambda m, b: F.struct(F.lit(m).alias("metric"), F.when(valid(m), histogram_bin(m, b[0], b[2])).alias("bin"), ((F.col(m) < b[0]) | (F.col(m) > b[1])).cast("int").alias("out"))
    binned = df.select(*keys, F.explode(F.array(*[one(m, b) for m, b in limits.items()])).alias("b")).select(*keys, "b.*").where("bin is not null")
    counts = binned.groupBy(*keys, "metric", "bin").agg(F.count("*").alias("c"), F.max("out").alias("out"))
    cells = counts.groupBy(*keys, "metric").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.ln("c")).alias("s"), F.max("out").alias("out"))
    bad = cells.groupBy(keys[0], "metric").agg(F.max("out").alias("bad"))
    h = F.greatest(F.lit(0.0), F.ln("n") - F.col("s") / F.col("n"))
    return cells.join(F.broadcast(bad), [keys[0], "metric"]).select(*keys, "metric", F.when((F.col("n") > 1) & (F.col("bad") == 0), h).alias("shan"))  # a row per window and metric


def metric_windows(df: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, win) for each metric and window of `df` with a valid value: one pass that keeps a flag for each metric and window."""
    held = df.groupBy("win").agg(*[F.max(F.coalesce(valid(m), F.lit(False))).alias(m) for m in metrics])
    return held.select(F.explode(F.array_compact(F.array(*[F.when(F.col(m), m) for m in metrics]))).alias("metric"), "win")


def mask_single(cells: DataFrame) -> DataFrame:
    """Statistics of cells with one shot are dropped; counts are never masked."""
    return cells.where("countf > 1")


def metric_grid(veg: DataFrame, metric: str, res: float) -> DataFrame:
    """All built-in statistics and the diversity of one metric on deduplicated shots (win, x, y, metric)."""
    cells = with_cell(veg, res)
    return mask_single(grid_stats(cells, [metric])).join(shannon(cells, metric), CELL, "left")


#: Bits of the sketches' registers: a standard error of about 1.6 % (1.04 / sqrt(2 ** 12)).
SKETCH_BITS = 12


def count_sketches(df: DataFrame, res: float = 1000, keys: tuple[str, ...] = ("win",)) -> DataFrame:
    """(keys, row, col, shots, orbits, tracks): shots of each cell, and sketches of its different orbits and tracks that can be merged."""
    track = geo.track_id("orbit", "beam")
    return with_cell(df, res).groupBy(*keys, "row", "col").agg(F.count("date_dec").alias("shots"), F.hll_sketch_agg(F.col("orbit").cast("long"), SKETCH_BITS).alias("orbits"), F.hll_sketch_agg(track, SKETCH_BITS).alias("tracks"))


def merge_sketches(cells: DataFrame, times: int, keys: tuple[str, ...] = ("win",)) -> DataFrame:
    """Sketches of cells `times` as wide (and high), from those of the cells that nest in them; 1 just estimates nothing anew."""
    wide = {c: F.floor(F.col(c) / times).cast("long") for c in ("row", "col")}
    return cells.withColumns(wide).groupBy(*keys, "row", "col").agg(F.sum("shots").alias("shots"), F.hll_union_agg("orbits").alias("orbits"), F.hll_union_agg("tracks").alias("tracks"))


def estimates(cells: DataFrame) -> DataFrame:
    """shots_count, and the estimated numbers of different orbits and tracks, of sketched cells. Up to some hundred different ones, the estimate is nearly always exact; cell_counts() is exact everywhere."""
    return cells.withColumns({"orbits_uniq": F.hll_sketch_estimate("orbits"), "tracks_uniq": F.hll_sketch_estimate("tracks")}).withColumnRenamed("shots", "shots_count").drop("orbits", "tracks")
