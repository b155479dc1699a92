"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards carries weights at its leaves; an inner node weighs
what its leaves weigh. A row descends from the root: at each node every child draws
-ln(u) / weight, with u from a hash of the row's id and the child's path, and the least
draw wins. A child is chosen in proportion to its weight, and a changed weight only moves
rows into or out of the subtrees whose weights changed. A new shard joins as a subtree of
its own below the root, so it takes rows only into itself.

All draws are built-in column functions, one narrow pass; slots number the rows of each
shard without a task that holds a whole shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lidarlattice.llm._common import cut, table

#: An inner node is {name: subtree}, a leaf is (shard, weight).
Tree = dict
#: Parts of each shard that are numbered apart and joined by their offsets: bounds the
#: table of offsets, and the share of a shard in one task.
PARTS = 1024


def balanced_tree(regions: int = 3, racks: int = 2, shards: int = 4) -> Tree:
    """Equal weights; shard numbers run through racks and regions in order."""
    n = iter(range(regions * racks * shards))
    return {f"region{r}": {f"rack{k}": {f"shard{s}": (next(n), 1.0) for s in range(shards)} for k in range(racks)} for r in range(regions)}


def weight(node) -> float:
    return float(node[1]) if isinstance(node, tuple) else sum(map(weight, node.values()))


def leaves(node) -> list[tuple[int, float]]:
    return [node] if isinstance(node, tuple) else [x for child in node.values() for x in leaves(child)]


def grow(tree: Tree, shard_weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region and rack of its own."""
    n = 1 + max(s for s, _ in leaves(tree))
    return tree | {f"grown{n}": {"rack0": {"shard0": (n, shard_weight)}}}


def draw(id_col: str, path: str, w: float) -> Column:
    """The draw of the child at `path`: exponential with rate `w`, the least one wins."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(path), F.col(id_col)), 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(w)


def descend(node, id_col: str = "doc_id", path: str = "") -> Column:
    """The shard a row reaches below `node`; children of weight zero are never chosen."""
    if isinstance(node, tuple):
        return F.lit(node[0])
    children = [(f"{path}/{name}", child) for name, child in node.items() if weight(child) > 0]
    if not children:
        raise ValueError(f"no weight below {path or 'the root'}")
    if len(children) == 1:
        return descend(children[0][1], id_col, children[0][0])
    draws = F.array(*[F.struct(draw(id_col, p, weight(child)).alias("draw"), F.lit(i).alias("i")) for i, (p, child) in enumerate(children)])
    chosen = F.array_min(draws)["i"]
    if all(isinstance(child, tuple) for _, child in children):
        return F.element_at(F.array(*[F.lit(child[0]) for _, child in children]), chosen + 1)
    below = [descend(child, id_col, p) for p, child in children]
    return F.element_at(F.transform(F.array(chosen), lambda c: _pick(c, below)), 1)


def _pick(chosen: Column, options: list[Column]) -> Column:
    out = F.when(chosen == 0, options[0])
    for i, option in enumerate(options[1:], 1):
        out = out.when(chosen == i, option)
    return out


def shard_documents(df: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, text) -> id, size, text_crc32, law "key", shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 8 (null text: 8), text_crc32 the CRC-32 of those
    bytes (null text: 0). shard comes from the id and the tree alone, grown_shard from the
    tree with one more shard. slot numbers the rows of each shard from 0 without gaps, in an
    order that does not depend on the partitioning; rows that repeat get slots of their own.
    A null id draws like an id of no bytes. Other columns are left out; an empty table stays
    empty.
    """
    data = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    placed = cut(
        df.select(
            F.col(id_col).alias("id"),
            (F.length(data) + 8).cast("long").alias("size"),
            F.crc32(data).alias("text_crc32"),
            descend(tree, id_col).alias("shard"),
            descend(grow(tree), id_col).alias("grown_shard"),
        ).withColumn("part", F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(PARTS)))
    )
    counts = placed.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size")
    return (
        placed.withColumn("n", F.row_number().over(order))
        .join(F.broadcast(offsets), ["shard", "part"])  # at most PARTS rows for each shard of the tree
        .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("n") - 1).cast("long").alias("slot"), "grown_shard")
    )


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), balanced_tree())


QUERIES = {"op4_shards": op4_shards}
ORACLE_SQL: dict[str, str] = {}
