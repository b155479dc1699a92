"""Stored tables: products bucketed by shot, chunks that are updated in place, checksums of files."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lidarlattice.operators.lineage import cut

# -- bucketed products ------------------------------------------------------------------------


def write_bucketed(df: DataFrame, name: str, path: str | None = None, key: str = "shot_num", buckets: int = 200) -> None:
    """A table of the catalog (in the warehouse, or at `path`), dealt by the key into buckets and sorted by it, one file a bucket: joins of such tables need no exchange."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def join_bucketed(spark: SparkSession, names: list[str], key: str = "shot_num") -> DataFrame:
    """Inner join of bucketed tables on their key; a column that several have keeps the first table's values."""
    out = None
    for name in names:
        one = spark.table(name)
        out = one if out is None else out.join(one.select(key, *[c for c in one.columns if c not in out.columns]), key)
    return out


# -- chunks that are updated ------------------------------------------------------------------


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at `path`, None if there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition()) or "UNABLE_TO_INFER_SCHEMA" in str(e.getCondition()):
            return None
        raise


def update_chunks(shots: DataFrame, path: str, manifest: str, granule: str = "granule") -> DataFrame:
    """Bring the chunk tables at `path` up to date with the granules of `shots` that `manifest` does not list, and list them.

    Only chunks that new granules touch are written again, as whole partitions. A run that
    was stopped between the two writes is made good by the next one: rows of granules that
    are new by the manifest replace those that are stored already. Returns the granules that
    were new.
    """
    spark = shots.sparkSession
    listed, old = stored(spark, manifest), stored(spark, path)
    granules = shots.select(granule).distinct()
    new = cut(granules if listed is None else granules.join(listed.select(granule), granule, "left_anti"))
    fresh = shots.where("chunk_id is not null").join(new, granule, "left_semi")
    if old is not None:
        touched = fresh.select("chunk_id").distinct()
        kept = old.join(touched, "chunk_id", "left_semi").join(new, granule, "left_anti")
        fresh = kept.unionByName(fresh, allowMissingColumns=True)
    if not new.isEmpty():
        merged = cut(fresh)  # what is read must not be what is being replaced
        merged.hint("rebalance", "chunk_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk_id").parquet(path)
        new.write.mode("append").parquet(manifest)
    return new


# -- checksums of files -----------------------------------------------------------------------

#: Bytes of a file that are held at a time.
PIECE = 8 << 20


def file_md5(path: str) -> str | None:
    """MD5 of a file's bytes, read as a stream; None if there is no such file. Paths are local (with or without file://) or URIs of any store that Arrow reads."""
    import pyarrow.fs

    digest = hashlib.md5()
    scheme, _, rest = path.partition(":")
    where = f"/{rest.lstrip('/')}" if scheme == "file" else path
    fs, at = (pyarrow.fs.LocalFileSystem(), where) if "://" not in where else pyarrow.fs.FileSystem.from_uri(where)
    if fs.get_file_info(at).type != pyarrow.fs.FileType.File:
        return None
    with fs.open_input_stream(at) as stream:
        while piece := stream.read(PIECE):
            digest.update(piece)
    return digest.hexdigest()


def file_checksums(paths: DataFrame) -> DataFrame:
    """paths (path) -> (path, found): the MD5 of each file, null where there is none. Files of any length are streamed on the executors, dealt by path."""

    def run(batches):
        for pdf in batches:
            yield pdf.assign(found=[file_md5(p) for p in pdf["path"]])

    return paths.select("path").distinct().repartition("path").mapInPandas(run, "path string, found string")


def audit_files(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """(path, status) of manifest (path, md5) against the files there are, found (path): ok, changed, missing or unlisted. A file that is listed but was not found is looked up all the same."""
    every = file_checksums(manifest.select("path").unionByName(found.select("path")))
    listed = manifest.select("path", "md5", F.lit(True).alias("listed"))
    status = F.when(F.col("listed").isNull(), "unlisted").when(F.col("found").isNull(), "missing").when(F.lower("md5") == F.col("found"), "ok").otherwise("changed")
    return every.join(listed, "path", "left").where("listed is not null or found is not null").select("path", status.alias("status"))
