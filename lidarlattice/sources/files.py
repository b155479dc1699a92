"""Reading and writing of shot tables, chunk tables and gridded cells."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarlattice.functions.metrics import nodata_recode
from lidarlattice.functions.names import date_label, metric_label
from lidarlattice.schema import EXPORT, NODATA_255, NODATA_32767
from lidarlattice.sources.zones import in_order


def shared_folder(spark: SparkSession) -> str:
    """A new folder for written tables, under the folder that all executors share (`spark.checkpoint.dir`).

    Where the session names none, a folder of this machine serves a local session, as in
    tests; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-tables-")
    return f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}"


def read_shots(spark: SparkSession, source: DataFrame | str, schema: T.StructType | None = None) -> DataFrame:
    """A table as it is, or a path of CSV files (with a header) or Parquet files."""
    if isinstance(source, DataFrame):
        return source
    if source.rstrip("/").endswith(".csv") or schema is not None:
        return spark.read.csv(source, header=True, schema=schema, inferSchema=schema is None)
    return spark.read.parquet(source)


def write_shots(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """A folder of CSV or Parquet files; zstd, as the height profiles of beam records repeat over long stretches, which the default codec does not see."""
    if kind == "csv":
        df.write.mode("overwrite").csv(path, header=True)
    else:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_chunks(df: DataFrame, path: str) -> None:
    """Shots by chunk; rows are brought together by chunk first, in parts of about the advisory size: a large chunk is several tasks and files."""
    df.hint("rebalance", "chunk_id").write.mode("overwrite").partitionBy("chunk_id").parquet(path)


def export_shots(df: DataFrame, order: list[str] | None, path: str, codec: str = "gzip") -> None:
    """High-quality shots of each chunk in a fixed column order (EXPORT by default) with missing codes recoded, as CSV.

    Shots outside every chunk are left out, and each shot is in its own chunk only. The
    orbit-grid id is written as ease72_og; columns that the table lacks are written empty.
    """
    codes = dict.fromkeys(NODATA_255, 255) | dict.fromkeys(NODATA_32767, 32767)
    kept = nodata_recode(df.where("l2_hqflag = 1 and chunk_id is not null"), codes)
    source = lambda c: "orbit_grid" if c == "ease72_og" and c not in kept.columns else c
    columns = [F.col(source(c)).alias(c) if source(c) in kept.columns else F.lit(None).cast("string").alias(c) for c in dict.fromkeys([*(order or EXPORT), "chunk_id"])]
    kept.select(*columns).hint("rebalance", "chunk_id").write.mode("overwrite").option("compression", codec).partitionBy("chunk_id").csv(path, header=True)


def product_name(metric, family, first, last, res):
    """grid_<metric>_<family>_<start>_<end>_<res>m"""
    return F.concat_ws("_", F.lit("grid"), metric_label(metric), F.col(family), date_label(first), date_label(last), F.concat(F.col(res).cast("string"), F.lit("m")))


def write_grid(cells: DataFrame, path: str) -> None:
    """Cells by family, metric, window, resolution and zone; only what `cells` holds is replaced."""
    keys = ["family", "metric", "win", "res"]
    in_order(cells, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys, "zone").parquet(path)


def write_products(cells: DataFrame, windows: DataFrame, path: str) -> None:
    """Cells (family, metric, win, res, ...) under one folder for each product, named by product_name(), and one in it for each zone; windows: (win, first_day, last_day)."""
    named = cells.join(F.broadcast(windows), "win").withColumn("product", product_name("metric", "family", "first_day", "last_day", "res"))  # a row per window
    in_order(named.drop("first_day", "last_day"), ["product"]).write.mode("overwrite").partitionBy("product", "zone").parquet(path)


def write_summaries(summaries: DataFrame, path: str) -> None:
    """Chunk summaries as CSV files with a header, by chunk."""
    summaries.repartition("chunk_id").write.mode("overwrite").csv(path, header=True)


def read_summaries(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All per-chunk summary files of a folder as one table."""
    return spark.read.csv(folder, header=True, schema=schema)
