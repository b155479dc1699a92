"""Exact top-k search by inner product with MaxScore.

Every vector component is a posting of its dimension (the term). Vectors are dealt to
shards and queries to blocks, and one task answers a block on a shard. There each term has
an upper bound, what the query can gain from the shard's postings of it. Terms of low bounds
whose sum stays below the current k-th score are non-essential: they cannot lift a vector
into the result alone. Postings of the essential terms are traversed and accumulated; the
others are probed, highest bound first, only for vectors that can still reach the k-th
score, which rises as exact scores become known. The shards' results are merged by a
window that keeps k rows per query before the shuffle already.

Shards and blocks have a fixed size, so a task's memory does not grow with the data; there
are as many tasks as the stated query set against all rows needs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lidarlattice.llm._common import cut, table

#: Vectors of a shard and queries of a block, about.
SHARD, BLOCK = 8192, 2048
#: Vectors scored first for a starting bound, and best partial sums scored next.
SEEDS, PROMISING = 128, 32


def maxscore(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: np.ndarray, k: int):
    """Yield (query, ids, scores): the k best per query by score, ties to the smaller id; own[i] is the row of query i, which is no candidate.

    Integers in float64 stay exact below 2^53; beyond, 64-bit integers are used.
    """
    top_q, top_v = int(np.abs(queries).max(initial=0)), int(np.abs(vectors).max(initial=0))
    if max(1, top_q) * max(1, top_v) * max(1, vectors.shape[1]) < 1 << 53:
        queries, vectors = queries.astype(np.float64), vectors.astype(np.float64)
    order = np.argsort(ids, kind="stable")
    vectors, ids = np.ascontiguousarray(vectors[order]), ids[order]
    place = {row: at for at, row in enumerate(rows[order].tolist())}
    high, low = vectors.max(axis=0), vectors.min(axis=0)
    columns = np.ascontiguousarray(vectors.T)  # the postings of each term
    seeds = np.linspace(0, len(ids) - 1, min(SEEDS, len(ids))).astype(np.int64)
    seed_scores = queries @ vectors[seeds].T
    for n, q in enumerate(queries):
        mine = place.get(int(own[n]), -1)
        bound = np.maximum(q * high, q * low)
        terms = np.argsort(-bound, kind="stable")
        tail = np.r_[np.cumsum(bound[terms][::-1])[::-1], 0]  # tail[i]: bound of terms i and later
        known = seed_scores[n][seeds != mine] if mine >= 0 else seed_scores[n]
        least = np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else -np.inf
        essential = int(np.argmax(tail < max(least, 0))) if (tail < max(least, 0)).any() else len(terms)
        essential = max(1, essential)
        part = q[terms[:essential]] @ columns[terms[:essential]]
        if mine >= 0:
            part = part.astype(np.float64, copy=True) if part.dtype.kind == "f" else part.copy()
            usable = np.delete(np.arange(len(ids)), mine)
        else:
            usable = np.arange(len(ids))
        if not usable.size:
            continue
        if usable.size > PROMISING >= k:
            some = usable[np.argpartition(part[usable], usable.size - PROMISING)[-PROMISING:]]
            exact = vectors[some] @ q
            least = max(least, np.partition(exact, PROMISING - k)[PROMISING - k])
        alive = usable[part[usable] + tail[essential] >= least]
        scores, at = part[alive], essential
        while at < len(terms):  # probe a few terms at a time while competitive
            step = terms[at : at + 4]
            scores = scores + q[step] @ columns[step][:, alive]
            at += len(step)
            keep = scores + tail[min(at, len(terms))] >= least
            alive, scores = alive[keep], scores[keep]
        best = np.lexsort((ids[alive], -scores))[:k]
        yield n, ids[alive[best]], scores[best].astype(np.int64)


def _matrix(arrays) -> np.ndarray:
    """Rows of one width; shorter vectors are filled with zeros."""
    width = max((len(a) for a in arrays), default=0)
    out = np.zeros((len(arrays), max(1, width)), np.int64)
    for i, a in enumerate(arrays):
        out[i, : len(a)] = a
    return out


def top_k(df: DataFrame, k: int, every: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, shards: int | None = None, block: int = BLOCK) -> DataFrame:
    """Rows (id, vector of floats) -> (query_id, rank, vec_id, score) for the rows whose id is divisible by `every`.

    Components become floor(scale * x). Candidates are all rows but the query's own row:
    rows that share an id are all kept, as candidates and as queries, each with its own
    result (so a query id that repeats gives k rows for each of its rows). Rows with a null
    id, a null vector, or null or non-finite components take no part; vectors of unequal
    width are compared as if filled with zeros. Ties go to the smaller id. Other columns are
    left out, whatever their names. An empty table gives no rows.
    """
    x = F.col(vector_col)
    good = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = df.where(good).select(F.col(id_col).alias("vid"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("v"))
    rows = cut(whole.withColumn("row", F.monotonically_increasing_id()))  # the checkpoint fixes the numbers
    n = rows.count()
    shards = shards or max(1, -(-n // SHARD))
    asked = rows.where(F.col("vid") % every == 0)
    blocks = max(1, -(-asked.count() // block))
    spread = lambda parts: F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    spread_q = F.pmod(F.xxhash64(F.lit("query"), "row"), F.lit(blocks)).cast("int")
    candidates = rows.select(spread(shards).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "row", "vid", "v")
    queries = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), spread_q.alias("block"), "row", "vid", "v")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            asked, own = right["vid"].to_numpy(np.int64), right["row"].to_numpy(np.int64)
            both = _matrix([*left["v"], *right["v"]])
            for i, found, scores in maxscore(both[len(left) :], both[: len(left)], left["vid"].to_numpy(np.int64), left["row"].to_numpy(np.int64), own, k):
                out.append(pd.DataFrame({"row": own[i], "query_id": asked[i], "vec_id": found, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({c: np.empty(0, np.int64) for c in ("row", "query_id", "vec_id", "score")})

    found = candidates.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInPandas(run, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


QUERIES = {"op3_maxscore": op3_maxscore}
#: Exact integers on both sides; DuckDB scores every pair, so the check is made on the tables as they are given.
ORACLE_SQL = {
    "op3_maxscore": """
with v as materialized (select row_number() over () as n, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
           where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.n, q.vec_id as query_id, c.vec_id, cast(list_dot_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score from v q join v c on q.vec_id % 50 = 0 and q.n <> c.n),
r as (select *, row_number() over (partition by n order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5
"""
}
