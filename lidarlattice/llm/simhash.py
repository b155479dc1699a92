"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, Hamming checks, components.

Fingerprints are made on the executors, one narrow map. Equal fingerprints are one node
from then on. Two fingerprints that differ in at most `distance` of 64 bits agree in at
least n - distance of n blocks, so each is listed under every choice of that many blocks: 15
keys of about 21 bits for a distance of 4 and 6 blocks. There are as many blocks as keep the
fingerprints of a key few (7 blocks: 35 keys of 27 bits, 8 blocks: 70 keys of 32). The rows of one key are compared in
a sorted stream: short runs pair by pair, each pair at the first key it shares only; long
runs by a search that drops what it has reached, which keeps a spanning forest instead of
all pairs. A run beyond RUN fingerprints is handled in chunks of RUN, and its pairs of
chunks are dealt to tasks of their own, so that no task holds more than two chunks,
whatever the size of a group of copies.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarlattice.llm._common import cut, few, map_text, table
from lidarlattice.llm.components import components

#: Blocks that may be chosen, and fingerprints of a key (spread evenly) above which there are more blocks.
BLOCKS, CROWD = (6, 7, 8), 64
#: Fingerprints of one key that are compared in memory at once, and those compared pair by pair.
RUN, SHORT = 8192, 32


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, repeats counted; 0 if it has no word."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - width + 1)
    ends = list(accumulate(map(len, words)))
    starts = [0, *(e + i + 1 for i, e in enumerate(ends))]
    digest = xxhash.xxh64_digest
    if len(words) <= width:
        hashes = digest(joined, seed)
    else:
        gap = width - 1
        hashes = b"".join([digest(joined[a : b + gap], seed) for a, b in zip(starts, [e + i for i, e in enumerate(ends[gap:])], strict=False)])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(n, 8), axis=1)
    ones = np.add.reduce(bits, axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes())


def fingerprints(df: DataFrame, text_col: str = "text", width: int = 4) -> DataFrame:
    """Append `bits` (the fingerprint as a signed long) and leave the text out; null texts count as empty."""

    def run(batch):
        prints = np.array([fingerprint(t, width) for t in batch.column(text_col).to_pylist()], np.uint64)
        return {"bits": prints.view(np.int64)}

    return map_text(df, run, T.StructType([T.StructField("bits", T.LongType())]), text_col)


def _layout(distance: int, blocks: int) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """(shift, width) of each block and the choices of blocks, for a distance below their number."""
    if not 0 <= distance < blocks:
        raise ValueError(f"distance must be 0 to {blocks - 1}")
    widths = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    shifts = [0, *accumulate(widths)][:blocks]
    return list(zip(shifts, widths, strict=True)), list(combinations(range(blocks), blocks - distance))


def blocks_for(prints: int, distance: int) -> int:
    """The least number of blocks whose keys hold CROWD fingerprints or fewer, if spread evenly; else the greatest."""
    return next((n for n in BLOCKS if distance < n and prints <= CROWD << (64 * (n - distance) // n)), BLOCKS[-1])


def _forest(prints: np.ndarray, distance: int, others: np.ndarray | None = None) -> list[tuple[int, np.ndarray]]:
    """Links that join whatever is reachable among `prints` (or between them and `others`).

    A search that takes each fingerprint out of the list once it is reached: dense groups
    cost little more than their size. With `others`, both lists are searched from each
    other in turn, as links within one list are known already.
    """
    links = []
    if others is None:
        left = prints
        while left.size:
            front, left = [left[0]], left[1:]
            while front and left.size:
                x = front.pop()
                near = np.bitwise_count(left ^ x) <= distance
                if near.any():
                    found, left = left[near], left[~near]
                    links.append((int(x), found))
                    front.extend(found)
        return links
    sides = [prints, others]
    while sides[0].size:
        front, sides[0] = [(0, sides[0][0])], sides[0][1:]
        while front:
            k, x = front.pop()
            near = np.bitwise_count(sides[1 - k] ^ x) <= distance
            if near.any():
                found, sides[1 - k] = sides[1 - k][near], sides[1 - k][~near]
                links.append((int(x), found))
                front.extend((1 - k, f) for f in found)
    return links


_FOUND = "a long, b long, key long, chunk int"


def _stream(distance: int, n_blocks: int):
    """Over rows (key, bits) in order: links (a, b), and the rows of overlong runs as (a, null, key, chunk)."""
    blocks, choices = _layout(distance, n_blocks)
    first = np.full(1 << n_blocks, len(choices), np.int64)  # by the blocks in which a pair agrees: its first choice
    for c in range(len(choices) - 1, -1, -1):
        need = sum(1 << b for b in choices[c])
        first[[m for m in range(1 << n_blocks) if m & need == need]] = c

    def agree(x):
        return sum(((x >> np.uint64(s)) & np.uint64((1 << w) - 1) == 0).astype(np.int64) << i for i, (s, w) in enumerate(blocks))

    def links(keys, prints):
        """Of whole runs, in order."""
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if keys.size else np.empty(0, np.int64)
        sizes = np.diff(np.r_[starts, keys.size])
        long_ = np.repeat(sizes > SHORT, sizes)
        out_a, out_b = [], []
        top = int(sizes[sizes <= SHORT].max(initial=0))
        for d in range(1, top):
            i = np.flatnonzero((keys[d:] == keys[:-d]) & ~long_[d:])
            if not i.size:
                break
            x = prints[i] ^ prints[i + d]
            near = np.bitwise_count(x) <= distance
            i, x = i[near], x[near]
            i = i[first[agree(x)] == keys[i] >> 44]
            out_a.append(prints[i])
            out_b.append(prints[i + d])
        for s, n in zip(starts[sizes > SHORT], sizes[sizes > SHORT], strict=True):
            for x, found in _forest(prints[s : s + n], distance):
                out_a.append(np.full(found.size, x, np.uint64))
                out_b.append(found)
        return np.concatenate(out_a or [np.empty(0, np.uint64)]), np.concatenate(out_b or [np.empty(0, np.uint64)])

    def batch_of(a, b, key=None, chunk=None):
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)) if b is not None else none, none if key is None else pa.array(np.full(len(a), key, np.int64)), pa.nulls(len(a), pa.int32()) if chunk is None else pa.array(np.full(len(a), chunk, np.int32))],
            names=["a", "b", "key", "chunk"],
        )

    def run(batches):
        held_key, held, chunk = None, np.empty(0, np.uint64), 0  # the run that may go on in the next batch

        def end():
            """The last chunk of the held run."""
            if chunk:
                yield batch_of(held, None, held_key, chunk)
            if held.size > 1:
                yield batch_of(*links(np.full(held.size, held_key), held))

        for batch in batches:
            keys, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not keys.size:
                continue
            cut_at = int(np.searchsorted(keys != keys[0], True)) if keys[0] == held_key else 0
            held = np.r_[held, prints[:cut_at]]
            while held.size > RUN:
                part, held = held[:RUN], held[RUN:]
                yield batch_of(part, None, held_key, chunk)
                yield batch_of(*links(np.full(RUN, held_key), part))
                chunk += 1
            if cut_at == keys.size:
                continue
            yield from end()
            last = int(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[-1])
            if last > cut_at:
                yield batch_of(*links(keys[cut_at:last], prints[cut_at:last]))
            held_key, held, chunk = int(keys[last]), prints[max(last, cut_at) :], 0
            while held.size > RUN:
                part, held = held[:RUN], held[RUN:]
                yield batch_of(part, None, held_key, chunk)
                yield batch_of(*links(np.full(RUN, held_key), part))
                chunk += 1
        if held_key is not None:
            yield from end()

    return run


def near_links(prints: DataFrame, distance: int = 4, n_blocks: int | None = None) -> DataFrame:
    """Distinct fingerprints (`bits`) -> links (a, b) whose components are those of all pairs within `distance`, by `n_blocks` blocks (blocks_for() of their number by default).

    Every link is a pair within the distance, and whatever such pairs connect, links connect.
    """
    n_blocks = n_blocks or blocks_for(prints.count(), distance)
    blocks, choices = _layout(distance, n_blocks)

    def key(c, chosen):
        value, at = F.lit(c).cast("long"), 0
        for b in chosen:
            s, w = blocks[b]
            value = F.shiftleft(value, w).bitwiseOR(F.shiftrightunsigned("bits", s).bitwiseAND(F.lit((1 << w) - 1)))
            at += w
        return F.shiftleft(F.lit(c).cast("long"), 44).bitwiseOR(value.bitwiseAND(F.lit((1 << at) - 1))) if at <= 44 else F.shiftleft(F.lit(c).cast("long"), 44).bitwiseOR(F.xxhash64(value).bitwiseAND(F.lit((1 << 44) - 1)))

    keyed = prints.select(F.explode(F.array(*[key(c, chosen) for c, chosen in enumerate(choices)])).alias("key"), "bits")
    found = cut(keyed.repartition("key").sortWithinPartitions("key", "bits").mapInArrow(_stream(distance, n_blocks), _FOUND))
    links = found.where("b is not null").select("a", "b")

    rest = found.where("b is null").select("key", "chunk", F.col("a").alias("bits"))
    chunks = rest.groupBy("key").agg(F.max("chunk").alias("last"))
    pairs = (
        rest.join(chunks, "key")
        .select("key", "chunk", "bits", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
        .where("chunk <> other")
        .select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "bits")
    )

    def across(pdf):
        import pandas as pd

        left = pdf["chunk"] == pdf["i"]
        bits = pdf["bits"].to_numpy().view(np.uint64)
        found = _forest(bits[left.to_numpy()], distance, bits[~left.to_numpy()])
        a = np.concatenate([np.full(f.size, x, np.uint64) for x, f in found] or [np.empty(0, np.uint64)])
        b = np.concatenate([f for _, f in found] or [np.empty(0, np.uint64)])
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return links.union(pairs.groupBy("key", "i", "j").applyInPandas(across, "a long, b long"))


def _rooted(df: DataFrame, id_col: str, text_col: str, width: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, key: a hash of the text, bits), and (bits, root) for every fingerprint."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = cut(fingerprints(df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text")), "text", width))
    nodes = rows.select("bits").distinct()
    roots = components(near_links(nodes, distance))
    return rows, nodes.join(roots, F.col("bits") == F.col("node"), "left").select("bits", F.coalesce("root", "bits").alias("root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4) -> DataFrame:
    """Rows (id, text) -> one row each: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id whose text is linked, directly or by others, to the
    row's text; fingerprints link at `distance` or fewer differing bits. Null and empty
    texts have the fingerprint zero and are linked like any other. Repeated rows stay, each
    with its component; a null id is never the smallest, and stays null where a component
    has no other. Other columns are left out; an empty table stays empty.
    """
    rows, rooted = _rooted(df, id_col, text_col, width, distance)
    least = rows.groupBy("bits").agg(F.min("id").alias("least")).join(rooted, "bits")
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.join(ids, "root").select("bits", "component_id")
    return rows.join(named, "bits").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4) -> DataFrame:
    """One row of each component, with all its columns, whatever their names: the one with the smallest id.

    Among rows of one id the smaller hash of the text decides, among equal rows any; rows
    with a null id stay only where their component has no other. Only the keys of rows that
    go meet the texts: as a broadcast where they are few, in a join otherwise.
    """
    rows, rooted = _rooted(df, id_col, text_col, width, distance)
    one = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("one")
    best = rows.groupBy("bits").agg(one).join(rooted, "bits").groupBy("root").agg(F.min("one").alias("one")).select(F.col("one.id").alias("i"), F.col("one.key").alias("k"))
    times = rows.groupBy("id", "key").count()
    same = (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("i"))
    judged = cut(times.join(best, same, "left").select("id", "key", "count", F.col("k").isNotNull().alias("chosen")).where("not chosen or count > 1").withColumnsRenamed({"id": "i", "key": "k"}))
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"), F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"))
    once = packed.join(few(judged.select("i", "k")), same, "left_anti")
    again = packed.join(few(judged.where("chosen").select("i", "k")), same).dropDuplicates(["id", "key"]).select("doc", "id", "key")
    return once.union(again).select("doc.*")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op7_simhash": op7_simhash}
ORACLE_SQL: dict[str, str] = {}
