"""The three workloads end to end: conditioning of shots, gridding, comparison with airborne lidar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lidarlattice.functions import geo
from lidarlattice.functions.metrics import nan_to_null, with_metrics
from lidarlattice.operators.chunks import with_chunk
from lidarlattice.operators.gridding import CELL, cell_counts, first_shot_per_fine_cell, grid_stats, mask_single, shannon_of, with_cell, with_xy
from lidarlattice.operators.lineage import cut, stored
from lidarlattice.operators.joins import grid_tag, join_shots, outlier_flag, window_join
from lidarlattice.operators.quality import drop_missing, filter_l2a, filter_l2b, filter_l4a, ground_veg_split, hq_flags
from lidarlattice.operators.vector import nearest_neighbour_index, subsample_error
from lidarlattice.schema import BINS, RESOLUTIONS


#: What every gridded shot must have: position, elevation, date and orbit.
NEEDED = ("lon_lm_a0", "lat_lm_a0", "elev_lm_a0", "date_dec", "orbit")


class StepCounts:
    """Rows after each step of a job, counted by the job itself.

    `note` marks a step; once an action has run on what came of it, `rows` gives the counts.
    They cost no pass of their own. A task that runs again after a loss may count its rows
    twice; the rows themselves are not affected.
    """

    def __init__(self):
        self.steps: dict[str, Observation] = {}

    def note(self, df: DataFrame, step: str) -> DataFrame:
        self.steps[step] = Observation(step)
        return df.observe(self.steps[step], F.count(F.lit(1)).alias("n"))

    def rows_of(self, step: str) -> int:
        return self.steps[step].get["n"]

    def rows(self) -> dict[str, int]:
        return {step: self.rows_of(step) for step in self.steps}


def condition_shots(l2a: DataFrame, l2b: DataFrame, l4a: DataFrame, cells: DataFrame, outliers: DataFrame, max_dem_diff: float | None = 150, counts: StepCounts | None = None) -> DataFrame:
    """Filter each product, join on the shot, tag the coarse cell, flag outliers and quality, derive metrics, name the chunk.

    Filters run before the joins, the products are joined on the shot id, and everything
    after the joins is narrow but for the small tables of cells and outliers. `max_dem_diff`
    is the second product's limit (None where its table has no elevation model). `counts`
    takes the number of rows after each step, in the same job.
    """
    note = counts.note if counts else lambda df, step: df
    a = note(filter_l2a(note(l2a, "l2a"), apply_deg_flag=False, max_waterp=None, max_urban=None), "l2a_kept")
    b = note(filter_l2b(note(l2b, "l2b"), apply_l2b_qflag=False, apply_algrun=False, apply_deg_flag=False, max_dem_diff=max_dem_diff, max_waterp=None, max_urban=None), "l2b_kept")
    c = note(filter_l4a(note(l4a, "l4a"), apply_l4a_qflag=False), "l4a_kept")
    joined = note(join_shots(note(join_shots(a, b, ["shot_num", "lon_lm_a0", "lat_lm_a0"]), "l2_joined"), c, ["shot_num"]), "joined")
    tagged = note(grid_tag(joined.withColumn("elev_diff_dem", F.col("elev_dem_tdx") - F.col("elev_lm_a0")), cells), "on_grid")
    return note(with_chunk(with_metrics(hq_flags(outlier_flag(tagged, outliers)))), "in_chunks")


def split_shots(shots: DataFrame, counts: StepCounts | None = None) -> tuple[DataFrame, DataFrame]:
    """Ground and high-quality shots of flagged ones, without those that lack position, date or orbit; `counts` takes the rows at each step."""
    note = counts.note if counts else lambda df, step: df
    complete = note(drop_missing(note(shots, "shots"), list(NEEDED)), "complete")
    ground, veg = ground_veg_split(complete)
    return note(ground, "ground"), note(veg, "high_quality")


def with_flagged_biomass(shots: DataFrame) -> DataFrame:
    """agbd_a0_qf: biomass of the shots that the product's own flag accepts."""
    return shots.withColumn("agbd_a0_qf", F.when(F.col("l4a_hqflag") == 1, F.col("agbd_a0")))


def windowed_veg(shots: DataFrame, windows: DataFrame) -> DataFrame:
    """Complete high-quality shots with projected coordinates, a row per window that holds them."""
    return window_join(with_xy(drop_missing(hq_flags(shots).where("l2_hqflag = 1"), list(NEEDED))), windows)


def windowed_ground(shots: DataFrame, windows: DataFrame) -> DataFrame:
    """Complete shots of granules that are not outliers, with projected coordinates, a row per window that holds them."""
    return window_join(with_xy(drop_missing(shots.where("loc_out_umd = 0"), list(NEEDED))), windows)


#: Metrics that are aggregated side by side.
BATCH = 8


def _grid(shots: DataFrame, metrics: list[str], resolutions: tuple[int, ...], errors: bool) -> DataFrame:
    """Statistics of each metric, cell, window and resolution of windowed shots."""
    wide = geo.GridSpec(12000.0)
    first = first_shot_per_fine_cell(shots, ["x", "y", *metrics])
    order = ["date_dec", "shot_num"] if errors else []
    named = [nan_to_null(m).alias(m) for m in metrics if m not in order]
    dealt = first.select("win", geo.cell_row("y", wide).alias("r12"), geo.cell_col("x", wide).alias("c12"), "x", "y", *order, *named).repartition("win", "r12", "c12")
    if len(metrics) > BATCH:
        dealt = cut(dealt)  # each batch of metrics reads other columns, so none could share an exchange with the rest
    keys = ["win", "r12", "c12", "row", "col"]
    binned = [m for m in metrics if m in BINS]
    out = None
    for res in resolutions:
        if 12000 % res:
            raise ValueError("cells must nest in 12 km cells")
        cells = with_cell(dealt, res)
        part = mask_single(grid_stats(cells, metrics, keys, batch=BATCH, functions={"meanbse": subsample_error} if errors else None, order=order, dealt=True))
        part = part.join(shannon_of(cells, binned, keys), [*keys, "metric"], "left") if binned else part.withColumn("shan", F.lit(None).cast("double"))
        part = part.drop("r12", "c12").withColumn("res", F.lit(res))
        out = part if out is None else out.unionByName(part)
    return out


def grid_workload(shots: DataFrame, windows: DataFrame, metrics: list[str], resolutions: tuple[int, ...], errors: bool = False) -> DataFrame:
    """Statistics of high-quality shots for each metric, cell, window and resolution: (win, res, row, col, metric, stats, shan), with `errors` also meanbse.

    Fine cells are deduplicated once. Cells of all resolutions nest in 12 km cells, so the
    rows are dealt by (window, 12 km cell) once and every aggregation below groups by those
    keys and its own: it needs no exchange beyond that one, which the branches share.
    """
    return _grid(windowed_veg(shots, windows), metrics, resolutions, errors)


def _counts(shots: DataFrame, places: DataFrame, resolutions: tuple[int, ...]) -> DataFrame:
    """Shots, orbits, tracks and the nearest-neighbour index of each cell, window and resolution of windowed shots, and of their places (w shots each); no index for cells of one shot."""
    out = None
    for res in resolutions:
        index = nearest_neighbour_index(with_cell(places, res), CELL, "x", "y", float(res) * res, weight="w")
        part = cell_counts(with_cell(shots, res)).join(index, CELL, "left").withColumn("res", F.lit(res))
        out = part if out is None else out.unionByName(part)
    return out


def count_workload(shots: DataFrame, windows: DataFrame, resolutions: tuple[int, ...]) -> DataFrame:
    """Sampling density of all ground and all high-quality shots: (family, win, res, row, col, shots_count, orbits_uniq, tracks_uniq, shots_nni); never masked.

    Every band of every family and resolution reads the same shots and places, so both are
    stored once, with the few columns that the bands need.
    """
    families = {"ga": F.coalesce(F.col("loc_out_umd") == 0, F.lit(False)), "va": F.coalesce(F.col("l2_hqflag") == 1, F.lit(False))}
    marked = hq_flags(shots).withColumns({f"_{name}": kept for name, kept in families.items()}).where("_ga or _va")
    windowed = window_join(with_xy(drop_missing(marked, list(NEEDED))), windows)
    windowed = stored(windowed.select("win", "x", "y", "orbit", "beam", "date_dec", "_ga", "_va"))
    count = lambda name: F.sum(F.col(f"_{name}").cast("long")).alias(f"_n_{name}")
    places = stored(windowed.groupBy("win", "x", "y").agg(*map(count, families)))
    out = None
    for name in families:
        own = places.where(f"_n_{name} > 0").select("win", "x", "y", F.col(f"_n_{name}").alias("w"))
        part = _counts(windowed.where(f"_{name}"), own, resolutions).withColumn("family", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def grid_product(shots: DataFrame, windows: DataFrame, metrics: list[str], resolutions: tuple[int, ...] = RESOLUTIONS) -> tuple[DataFrame, DataFrame]:
    """The whole grid product of conditioned shots: (statistics, counts).

    Statistics (family, win, res, row, col, metric, eight statistics) are those of every
    metric on the first high-quality shot of each fine cell (vf), biomass also with its own
    flag, and of the elevation on the first ground shot (gf). Counts are those of
    count_workload.
    """
    flagged = with_flagged_biomass(hq_flags(shots))
    chosen = [*metrics, *(["agbd_a0_qf"] if "agbd_a0" in metrics and "agbd_a0_qf" not in metrics else [])]
    veg = _grid(window_join(with_xy(drop_missing(flagged.where("l2_hqflag = 1"), list(NEEDED))), windows), chosen, resolutions, True).withColumn("family", F.lit("vf"))
    ground = _grid(windowed_ground(shots, windows), ["elev_lm_a0"], resolutions, True).withColumn("family", F.lit("gf"))
    return veg.unionByName(ground), count_workload(shots, windows, resolutions)
