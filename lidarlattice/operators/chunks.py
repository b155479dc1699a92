"""Per-chunk tables, summaries, column profiles; mosaics of tiles and overviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarlattice.functions import geo
from lidarlattice.functions.metrics import nodata_recode
from lidarlattice.operators.lineage import cut
from lidarlattice.operators.percentiles import between, join_on, order_statistics, places, range_of
from lidarlattice.operators.quality import ground_veg_split
from lidarlattice.schema import MISSING, NODATA_255, NODATA_32767


def with_chunk(df: DataFrame) -> DataFrame:
    return df.withColumn("chunk_id", geo.chunk_id("lon_lm_a0", "lat_lm_a0")).where("chunk_id is not null")


def chunk_summary(df: DataFrame) -> DataFrame:
    """Per file and chunk: shots, high-quality shots, outliers, extents in space and time."""
    return df.groupBy("file", "chunk_id").agg(
        F.count("*").alias("n_filt_shots"),
        F.sum((F.col("l2_hqflag") == 1).cast("long")).alias("n_l2_hq_shots"),
        F.sum((F.col("l4a_hqflag") == 1).cast("long")).alias("n_l4a_hq_shots"),
        F.sum((F.col("loc_out_umd") == 1).cast("long")).alias("n_locout_shots"),
        *[f(c).alias(n) for c, s in (("lon_lm_a0", "x"), ("lat_lm_a0", "y")) for f, n in ((F.min, f"{s}min_shots"), (F.max, f"{s}max_shots"))],
        F.min("date_dec").alias("date_dec_min"),
        F.max("date_dec").alias("date_dec_max"),
    )


def numeric_columns(df: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    """Names of the columns that a profile can describe."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in without]


def column_profile(df: DataFrame, columns: list[str] | None = None, key: str = "chunk_id") -> DataFrame:
    """Counts of every kind of value and statistics per chunk and column (all numeric ones by default).

    A missing value is null or NaN; n_notnafin counts those that are neither missing nor
    finite; valid values are finite and not the missing code. The values are counted by
    ranges once, which gives all but the percentiles; these are exact, by counting passes
    (operators/percentiles.py), so a chunk of any size is spread over all tasks. `df` is read
    more than once and must give the same rows each time.
    """
    columns = numeric_columns(df, (key,)) if columns is None else columns
    v, n = F.col("v"), F.col("n")
    long = df.select(key, F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("pos", "v"))
    finite = F.abs(v) < float("inf")
    valid = F.when(finite & (v != MISSING), v)
    kind = F.when(v.isNull(), "null").when(F.isnan(v), "nan").when(finite, "finite").otherwise("infinite")
    keys = [key, "pos"]
    total = lambda cond: F.sum(cond.cast("long"))
    counted = long.groupBy(*keys, kind.alias("kind"), F.when(finite, range_of(v)).alias("r0")).agg(
        F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), total(v == MISSING).alias("coded"), total(v < MISSING).alias("below"), total(v == 255).alias("n_255"), total(v == 32767).alias("n_32767"),
        F.min(valid).alias("valid_lo"), F.max(valid).alias("valid_hi"), F.avg(valid).alias("mean"), F.var_pop(valid).alias("var"),
    )
    counted = cut(counted)
    of = lambda *kinds: F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), n)), F.lit(0))
    fin = F.col("kind") == "finite"
    sum_fin = lambda c: F.coalesce(F.sum(F.when(fin, c)), F.lit(0))
    used = F.when(fin, n - F.col("coded"))
    stats = counted.groupBy(*keys).agg(
        F.sum("n").alias("n_all"), of("finite", "infinite").alias("n_notna"), of("infinite").alias("n_notnafin"), of("finite").alias("_fin"), sum_fin(F.col("coded")).alias("n_n9999"), sum_fin(F.col("below")).alias("_below"), sum_fin(F.col("n_255")).alias("n_255"), sum_fin(F.col("n_32767")).alias("n_32767"),
        F.coalesce(F.sum(F.when(F.col("r0") < 0, n)), F.lit(0)).alias("n_neg"), F.min(F.when(fin, F.col("lo"))).alias("min_fin"), F.max(F.when(fin, F.col("hi"))).alias("max_fin"), F.min("valid_lo").alias("min_valid"), F.max("valid_hi").alias("max_valid"),
        (F.sum(used * F.col("mean")) / F.nullif(F.sum(used), F.lit(0))).alias("mean_valid"),
    )
    spread = join_on(counted.where(fin & (n > F.col("coded"))), stats.select(*keys, "mean_valid"), keys).groupBy(*keys).agg(F.sum(used * (F.col("var") + (F.col("mean") - F.col("mean_valid")) ** 2)).alias("_squares"))
    stats = join_on(stats, spread, keys, "left").withColumn("n_valid", F.col("_fin") - F.col("n_n9999"))
    stats = stats.withColumns({"n_neg_valid": F.col("n_neg") - F.col("n_n9999"), "sd_valid": F.when(F.col("n_valid") > 1, F.sqrt(F.col("_squares") / (F.col("n_valid") - 1)))})

    def place(k: Column) -> Column:
        """The place among finite values of a place among valid ones: codes stand between those below and above them."""
        return F.when(k < F.col("_below"), k).otherwise(k + F.col("n_n9999"))

    probs = {"p05_valid": 0.05, "p25_valid": 0.25, "med_valid": 0.5, "p75_valid": 0.75, "p95_valid": 0.95}
    middle = places(F.col("_fin"), 0.5)
    spots = {c: tuple(place(k) for k in places(F.col("n_valid"), p)) for c, p in probs.items()}
    of_valid = F.when(F.col("n_valid") > 0, F.array(*[k for pair in spots.values() for k in pair])).otherwise(F.array().cast("array<long>"))
    wanted = stats.where("_fin > 0").select(*keys, F.explode(F.array_distinct(F.concat(F.array(*middle), of_valid))).alias("k"))
    found = order_statistics(long.where(finite), keys, wanted, counted.where(fin).select(*keys, "r0", "n", "lo", "hi"))
    held = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("k", "value"))).alias("m"))
    at = lambda k: F.col("m")[k]
    out = join_on(stats, held, keys, "left").withColumn("med_fin", F.when(F.col("_fin") > 0, between(F.col("_fin"), 0.5, *map(at, middle))))
    out = out.withColumns({c: F.when(F.col("n_valid") > 0, between(F.col("n_valid"), probs[c], *map(at, pair))) for c, pair in spots.items()})
    names = F.element_at(F.array(*map(F.lit, columns)), F.col("pos") + 1).alias("field_name")
    order = "n_all n_notna n_notnafin n_valid n_n9999 n_255 n_32767 n_neg n_neg_valid min_fin med_fin max_fin min_valid mean_valid max_valid sd_valid p05_valid p25_valid med_valid p75_valid p95_valid".split()
    return out.select(key, names, *order, (F.col("p75_valid") - F.col("p25_valid")).alias("iqr_valid"))


def export_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column_profile of the exported tables, after the missing codes of land cover are recoded: of all ground shots (family ga) and of high-quality shots (va)."""
    codes = dict.fromkeys(NODATA_255, 255) | dict.fromkeys(NODATA_32767, 32767)
    recoded = nodata_recode(df, {c: code for c, code in codes.items() if c in df.columns})
    parts = [column_profile(part, columns).withColumn("family", F.lit(name)) for name, part in zip(("ga", "va"), ground_veg_split(recoded), strict=True)]
    return parts[0].unionByName(parts[1])


def union_tiles(tiles: DataFrame, keys: list[str], value: str, priority: str, fill: float | None = MISSING) -> DataFrame:
    """Mosaic: of each cell the value of the greatest priority that has one; empty cells take `fill`."""
    v = F.when(~F.isnan(value), F.col(value))
    out = F.max_by(v, F.when(v.isNotNull(), F.col(priority)))
    return tiles.groupBy(*keys).agg((F.coalesce(out, F.lit(fill)) if fill is not None else out).alias(value))


def mosaic_first(tiles: DataFrame, keys: list[str], value: str, priority: str) -> DataFrame:
    """Of each cell the first value in order of priority that is not null."""
    return tiles.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*keys).agg(F.min_by(value, priority).alias(value))


def overview(cells: DataFrame, level: int, offset: int = 0) -> DataFrame:
    """Nearest-neighbour coarser level: one cell of each block of 2^level, re-keyed."""
    size = 1 << level
    return cells.where((F.pmod("row", F.lit(size)) == offset) & (F.pmod("col", F.lit(size)) == offset)).withColumns({"row": F.floor(F.col("row") / size), "col": F.floor(F.col("col") / size)})


def band_stats(cells: DataFrame, bands: list[str]) -> DataFrame:
    """Least, greatest, mean and population deviation of each band."""
    wide = cells.agg(*[F.struct(F.lit(b).alias("band"), F.min(b).cast("double").alias("min"), F.max(b).cast("double").alias("max"), F.avg(b).alias("mean"), F.stddev_pop(b).alias("std")).alias(b) for b in bands])
    return wide.select(F.explode(F.array(*bands)).alias("b")).select("b.*")
