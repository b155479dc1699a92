"""Helpers shared by the text operators: table access, folds, Arrow mapping, checkpoints."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id="doc_id"):
    """True where crc32(doc_id as text) mod 5 is 0; a null id counts as the empty text (held out)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` with a reliable checkpoint in the shared folder (`spark.checkpoint.dir`).

    A folder of our own is set only where the session names none and has no other machines
    to share it with, as in tests; on a cluster that is an error.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        given = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if given is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return df.checkpoint(eager=True)


#: Rows of keys that may be broadcast: some tens of MB.
FEW = 1_000_000


def few(keys: DataFrame) -> DataFrame:
    """The same rows with a broadcast hint if they are FEW or less, counted first; beyond that Spark joins by a shuffle."""
    return F.broadcast(keys) if keys.count() <= FEW else keys


#: Rows of one Arrow batch that are handled at a time; texts are of any length, so the
#: batch is walked in slices that hold about this many characters.
SLICE_BYTES = 16 << 20


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Split a batch so that `column` holds about SLICE_BYTES in each part (one row at least)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def map_text(df: DataFrame, per_slice: Callable[[pa.RecordBatch], dict], added: T.StructType, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Append columns that `per_slice` computes from Arrow slices of `df`; the text itself is left out unless kept.

    `per_slice` gets a record batch and returns {column: list or array} for `added`.
    Columns of `df` that have the name of an added one, in whatever case, are replaced by
    it; other names may be anything, dots and repeated ones included. Rows are neither moved
    nor dropped: the map is narrow, so a lost task just runs again.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    new_names = {f.name.lower() for f in added.fields}
    names = [f.name for f in df.schema.fields]
    kept = [i for i, c in enumerate(names) if (keep_text or c != text_col) and (c.lower() not in new_names or c == text_col)]
    # columns go by position: a map resolves names, and those of a user may hold dots
    plain = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(plain[i], df.schema.fields[i].dataType) for i in kept] + [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(added.fields)])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part in slices(pa.RecordBatch.from_arrays(batch.columns, names=names), text_col):
                new = per_slice(part)
                columns = [part.column(i) for i in kept] + [pa.array(new[f.name], type=arrow.field(f"n{i}").type) for i, f in enumerate(added.fields)]
                yield pa.RecordBatch.from_arrays([c.cast(arrow.field(i).type) for i, c in enumerate(columns)], schema=arrow)

    return df.toDF(*plain).mapInArrow(run, schema).toDF(*[names[i] for i in kept], *added.names)
