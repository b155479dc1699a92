"""Group statistics that columns cannot express: nearest-neighbour index and subsample standard error.

Both work in numpy on groups of limited size. The groups of the subsample error are limited
by the fine cells that deduplication leaves in a grid cell. The shots of a cell for the
nearest-neighbour index have no such limit, so cells of many shots are cut into tiles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lidarlattice.operators.lineage import stored
from lidarlattice.operators.quality import valid
from lidarlattice.schema import MISSING

#: Draws of the subsample error, draws for small cells, distinct sets that are used, share of a cell, least cell.
DRAWS, DRAWS_SMALL, SETS, SHARE, LEAST = 150, 400, 100, 0.7, 10
#: Places of a leaf of the search tree, places of a tile about, queries that are searched together.
LEAF, TILE, QUERIES = 32, 50_000, 1 << 15


class Places:
    """Points split at medians, the longer side first, into leaves of equal size; lines and clusters make the tree no deeper."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        n = len(x)
        self.depth = max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))
        order, edges = np.arange(n), np.array([0, n])
        for _ in range(self.depth):
            starts, sizes = edges[:-1], np.diff(edges)
            px, py = x[order], y[order]
            span = lambda p, at=starts: np.maximum.reduceat(p, at) - np.minimum.reduceat(p, at)
            node = np.repeat(np.arange(len(starts)), sizes)
            order = order[np.lexsort((np.where((span(px) >= span(py))[node], px, py), node))]
            edges = np.r_[np.c_[starts, starts + sizes // 2].ravel(), n]
        sizes = np.diff(edges)
        self.order, self.x, self.y = order, x[order], y[order]
        self.leaf = np.repeat(np.arange(len(sizes)), sizes)
        self.boxes = [np.stack([f.reduceat(p, edges[:-1]) for p in (self.x, self.y) for f in (np.minimum, np.maximum)])]
        for _ in range(self.depth):
            pair = self.boxes[0].reshape(4, -1, 2)
            self.boxes.insert(0, np.stack([pair[0].min(1), pair[1].max(1), pair[2].min(1), pair[3].max(1)]))
        # leaves as rows of one width, filled up with points that are infinitely far
        at = edges[:-1, None] + np.arange(int(sizes.max()))
        self.at = np.where(at < edges[1:, None], at, -2)
        self.lx, self.ly = (np.where(self.at >= 0, p[np.minimum(at, n - 1)], np.inf) for p in (self.x, self.y))

    def nearest(self, qx: np.ndarray, qy: np.ndarray, best: np.ndarray, own: np.ndarray) -> np.ndarray:
        """`best`, lessened to the distance of each query to its nearest point; own[i] is the place in the tree of query i, which does not count (-1: none).

        The search goes down only to boxes that are nearer than the best distance known.
        """
        best = best.copy()

        def look(q, leaves):
            for a in range(0, len(q), QUERIES):
                i, f = q[a : a + QUERIES], leaves[a : a + QUERIES]
                d = np.hypot(self.lx[f] - qx[i, None], self.ly[f] - qy[i, None])
                d[self.at[f] == own[i, None]] = np.inf
                np.minimum.at(best, i, d.min(axis=1))

        home = np.where(own >= 0, self.leaf[own], -1)
        inside = np.flatnonzero(home >= 0)
        look(inside, home[inside])
        for a in range(0, len(qx), QUERIES):
            q = np.arange(a, min(a + QUERIES, len(qx)))
            node = np.zeros(len(q), np.int64)
            for level in range(1, self.depth + 1):
                q, node = np.repeat(q, 2), np.repeat(2 * node, 2)
                node[1::2] += 1
                x0, x1, y0, y1 = self.boxes[level][:, node]
                gap = np.hypot(np.maximum(0, np.maximum(x0 - qx[q], qx[q] - x1)), np.maximum(0, np.maximum(y0 - qy[q], qy[q] - y1)))
                near = gap < best[q]
                q, node = q[near], node[near]
            new = node != home[q]
            look(q[new], node[new])
        return best


def by_runs(df: DataFrame, keys: list[str], order: list[str], run: Callable[[pd.DataFrame, list[tuple[int, int]]], pd.DataFrame], schema: str, dealt: bool = False) -> DataFrame:
    """Rows of equal keys handed to `run` many groups at a time: a frame in order, and the (start, end) of each group in it.

    Rows are dealt by the keys and sorted by them within partitions, so a task streams
    through its groups and holds a batch and one group at most. `dealt`: the rows of a group
    are in one partition already.
    """
    rows = (df if dealt else df.repartition(*keys)).sortWithinPartitions(*keys, *order)

    def stream(batches):
        held: list[pd.DataFrame] = []  # the group that may go on in the next batch
        for pdf in batches:
            if pdf.empty:
                continue
            changes = np.flatnonzero((pdf[keys].iloc[1:].to_numpy() != pdf[keys].iloc[:-1].to_numpy()).any(axis=1)) + 1
            if held and (pdf[keys].iloc[0].to_numpy() != held[-1][keys].iloc[0].to_numpy()).any():
                yield from whole(held)
                held = []
            if changes.size:
                yield from whole([*held, pdf.iloc[: changes[-1]]])
                held = [pdf.iloc[changes[-1] :]]
            else:
                held.append(pdf)
        if held:
            yield from whole(held)

    def whole(parts):
        pdf = pd.concat(parts, ignore_index=True)
        values = pdf[keys].to_numpy()
        edges = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist(), len(pdf)]
        out = run(pdf, list(zip(edges, edges[1:], strict=False)))
        if len(out):
            yield out

    return rows.mapInPandas(stream, schema)


def nearest_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of each point to the nearest other one; NaN for a single point."""
    if len(x) < 2:
        return np.full(len(x), np.nan)
    if len(x) <= 4 * LEAF:
        d = np.hypot(x[:, None] - x, y[:, None] - y)
        np.fill_diagonal(d, np.inf)
        return d.min(axis=1)
    tree = Places(x, y)
    out = np.empty(len(x))
    out[tree.order] = tree.nearest(tree.x, tree.y, np.full(len(x), np.inf), np.arange(len(x)))
    return out


def nearest_in_groups(x: np.ndarray, y: np.ndarray, groups: list[tuple[int, int]]) -> np.ndarray:
    """nearest_distances() of each group (start, end); small groups of one size are searched together."""
    starts = np.array([a for a, _ in groups])
    sizes = np.array([b for _, b in groups]) - starts
    out = np.full(len(x), np.nan)
    for n in np.unique(sizes):
        some = starts[sizes == n]
        if n > 4 * LEAF:
            for a in some:
                out[a : a + n] = nearest_distances(x[a : a + n], y[a : a + n])
        elif n > 1:
            most = max(1, (1 << 21) // int(n * n))
            for k in range(0, len(some), most):
                at = some[k : k + most, None] + np.arange(n)
                d = np.hypot(x[at][:, :, None] - x[at][:, None, :], y[at][:, :, None] - y[at][:, None, :])
                d[:, np.arange(n), np.arange(n)] = np.inf
                out[at] = d.min(axis=2)
    return out


def nearest_neighbour_index(df: DataFrame, keys: list[str], x: str, y: str, area: float, tile: int = TILE, weight: str | None = None) -> DataFrame:
    """Per cell: mean nearest distance over that expected of n random points in `area`; cells of one point give no row.

    Shots at one place are counted first: where there are two or more, their distance is 0.
    A cell of many places is cut into square tiles of about `tile` of them (more only where
    places cluster). A place finds its nearest one within its tile, and is then sent to
    those other tiles of its cell that are nearer than that: few places beside the edges.
    Rows without coordinates take no part. Places are stored once, as are the distances of
    large cells: both are read several times. `weight`: the rows are places already, each once,
    with so many shots.
    """
    named = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    at = [*keys, "_tx", "_ty"]
    placed = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w"))
    places = placed if weight else stored(placed.groupBy(*keys, "_x", "_y").agg(F.sum("_w").alias("_w")))
    least, most = ({a: f(f"_{a}") for a in "xy"} for f in (F.min, F.max))
    cells = places.groupBy(*keys).agg(F.ceil(F.sqrt(F.count("*") / F.lit(float(tile)))).cast("int").alias("_cut"), least["x"].alias("_x0"), least["y"].alias("_y0"), F.greatest(*[most[a] - least[a] for a in "xy"]).alias("_span"))
    tile_of = lambda a, shift=0.0: F.greatest(F.lit(0), F.least(F.col("_cut") - 1, F.floor((F.col(f"_{a}") + shift - F.col(f"_{a}0")) * F.col("_cut") / (F.col("_span") + 1e-9)).cast("int")))
    dealt = places.join(cells, keys).withColumns({"_tx": tile_of("x"), "_ty": tile_of("y")})

    def within(pdf: pd.DataFrame, groups) -> pd.DataFrame:
        px, py = pdf["_x"].to_numpy(), pdf["_y"].to_numpy()
        d = nearest_in_groups(px, py, groups)
        return pdf.assign(_d=np.where(pdf["_w"].to_numpy() > 1, 0.0, np.where(np.isnan(d), np.inf, d)))

    columns = f"{named}, _x double, _y double, _w long, _cut int, _x0 double, _y0 double, _span double, _tx int, _ty int"
    dealt = dealt.select(*keys, "_x", "_y", "_w", "_cut", "_x0", "_y0", "_span", "_tx", "_ty")
    large = F.col("_cut") > 1
    small = by_runs(dealt.where(~large), at, [], within, f"{columns}, _d double")
    score = lambda found: found.groupBy(*keys).agg(F.sum("_w").alias("_n"), F.sum(F.col("_w") * F.col("_d")).alias("_s")).where("_n > 1").select(*keys, (F.col("_s") / F.col("_n") / (0.5 * F.sqrt(F.lit(float(area)) / F.col("_n")))).alias("shots_nni"))
    if cells.where(large).isEmpty():
        return score(small)
    first = stored(by_runs(dealt.where(large), at, [], within, f"{columns}, _d double"))

    def visits(found: DataFrame) -> DataFrame:
        """Places as queries to the other tiles within their distance."""
        reach = F.least("_d", F.col("_span") + 1)
        spread = found.withColumns({"_ox": F.col("_tx"), "_oy": F.col("_ty"), "_tx": F.explode(F.sequence(tile_of("x", -reach), tile_of("x", reach)))}).withColumn("_ty", F.explode(F.sequence(tile_of("y", -reach), tile_of("y", reach))))
        return spread.where("_tx <> _ox or _ty <> _oy").select(*at, "_x", "_y", "_d")

    def across(there: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or there.empty:
            return pd.DataFrame(columns=[*keys, "_x", "_y", "_e"])
        tree = Places(there["_x"].to_numpy(), there["_y"].to_numpy())
        e = tree.nearest(asking["_x"].to_numpy(), asking["_y"].to_numpy(), asking["_d"].to_numpy(), np.full(len(asking), -1))
        return asking[[*keys, "_x", "_y"]].assign(_e=e)

    split = dealt.where(large).select(*at, "_x", "_y").groupBy(*at).cogroup(visits(first).groupBy(*at)).applyInPandas(across, f"{named}, _x double, _y double, _e double")
    asked = first.select(*keys, "_x", "_y", "_w", "_d").unionByName(split.select(*keys, "_x", "_y", F.lit(0).cast("long").alias("_w"), F.col("_e").alias("_d")))
    best = asked.groupBy(*keys, "_x", "_y").agg(F.sum("_w").alias("_w"), F.min("_d").alias("_d"))
    return score(small.select(*keys, "_w", "_d").unionByName(best.select(*keys, "_w", "_d")))


#: Sizes of cells up to which a worker keeps the orders of the draws, in tables of these widths (the last one as wide as is needed, some 100 MB at the 160,000 fine cells of a 12 km cell); draws of larger cells are made one at a time.
TIERS = (1 << 12, 1 << 15, 1 << 18)
_ORDERS: dict[int, np.ndarray] = {}


def _keys(b: int, n: int) -> np.ndarray:
    """The first 64 bits of md5('b:i') for i from 1 to n."""
    md5, before = hashlib.md5, f"{b}:".encode()
    return np.frombuffer(b"".join([md5(before + b"%d" % i).digest()[:8] for i in range(1, n + 1)]), ">u8").astype(np.uint64)


def _order(b: int, n: int) -> np.ndarray:
    """Indices below n (from 0) by their keys in the draw b: those of a wider table, without the others, so one table serves cells of many sizes."""
    if b > DRAWS or n > TIERS[-1]:
        return np.argsort(_keys(b, n))
    tier = next(t for t in TIERS if n <= t)
    table = _ORDERS.get(tier)
    if table is None or table.shape[1] < n:
        wide = tier if tier < TIERS[-1] else min(tier, -(-n // (1 << 14)) << 14)
        table = _ORDERS[tier] = np.stack([np.argsort(_keys(k, wide)).astype(np.int32) for k in range(1, DRAWS + 1)])
    order = table[b - 1]
    return order[order < n]


def subsample(n: int):
    """Yield index sets for a cell of n: draw b takes the share of indices with the least md5 of 'b:i'; the first SETS distinct sets count."""
    size, seen = int(np.rint(SHARE * n)), set()
    for b in range(1, (DRAWS_SMALL if n <= 12 else DRAWS) + 1):
        chosen = np.sort(_order(b, n)[:size].astype(np.int64)) if size < n else np.arange(n)
        name = hashlib.md5(chosen.tobytes()).digest()
        if name not in seen:
            seen.add(name)
            yield chosen
            if len(seen) == SETS:
                return


#: Values of a cell up to which its sets are kept, a few hundred sizes at a time.
FEW = 2000


@lru_cache(maxsize=256)
def _sets(n: int) -> np.ndarray:
    return np.array(list(subsample(n)), np.int16)


def subsample_error(v: np.ndarray) -> float | None:
    n = len(v)
    if n < LEAST:
        return None
    means = v[_sets(n)].mean(axis=1) if n <= FEW else np.array([v[s].mean() for s in subsample(n)])
    return float(np.std(means, ddof=1)) if len(means) > 1 else None


#: A statistic of the valid values of a cell, in order: a number or None.
GroupStat = Callable[[np.ndarray], "float | None"]


def group_stats(df: DataFrame, keys: list[str], metrics: list[str], functions: dict[str, GroupStat], order: list[str], dealt: bool = False) -> DataFrame:
    """(keys, metric, a column for each function): functions of each cell's valid values of each metric, in order; cells without any give no row.

    Rows stream through sorted partitions, a cell at a time (by_runs). `dealt`: the rows of a
    cell are in one partition already.
    """

    def run(pdf: pd.DataFrame, groups) -> pd.DataFrame:
        cells, rows = pdf[keys].to_numpy(object), []
        for m in metrics:
            values = pdf[m].to_numpy(float)
            ok = np.isfinite(values) & (values > MISSING)
            rows += [[*cells[a], m, *[f(values[a:b][ok[a:b]]) for f in functions.values()]] for a, b in groups if ok[a:b].any()]
        return pd.DataFrame(rows, columns=[*keys, "metric", *functions])

    named = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    return by_runs(df.select(*dict.fromkeys([*keys, *order, *metrics])), keys, order, run, f"{named}, metric string, " + ", ".join(f"{n} double" for n in functions), dealt)


def subsample_errors(df: DataFrame, keys: list[str], metrics: list[str], order: list[str], dealt: bool = False) -> DataFrame:
    """Per cell and metric: standard deviation of the means of subsamples of its valid values, in order; fewer than LEAST of them give null."""
    return group_stats(df, keys, metrics, {"meanbse": subsample_error}, order, dealt)


def mean_subsample_error(df: DataFrame, keys: list[str], metric: str, order: list[str]) -> DataFrame:
    """The same for one metric: a row for each cell that has a valid value."""
    return subsample_errors(df.where(valid(metric)), keys, [metric], order).drop("metric")
