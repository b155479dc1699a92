import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lidarlattice.llm import simhash
from lidarlattice.llm.components import components
from lidarlattice.llm.simhash import _forest, fingerprint, near_duplicates, near_links, op7_simhash


def by_hand(text, width=4):
    words = [w for w in (text or "").encode().lower().translate(bytes(range(256))).split() if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def groups(prints, distance=4):
    """Union-find over all pairs of distinct fingerprints."""
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    a = np.array(distinct, np.uint64)
    for i, p in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ np.uint64(p)) <= distance):
            x, y = find(p), find(distinct[i + 1 + j])
            root[max(x, y)] = min(x, y)
    return {p: find(p) for p in distinct}


def expected(rows):
    prints = [by_hand(t) for _, t in rows]
    root = groups(prints)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted(((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints, strict=True)), key=str)


def test_fingerprint_by_hand():
    for text in (None, "", " \t\n", "one", "One two THREE", "a b c d", "ÀB c\x1fd e f g h", "x " * 500, "a\x0bb\x0cc\rd e"):
        assert fingerprint(text) == by_hand(text)


def test_shingle_hash_is_the_engines(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("of the and a"))).first()[0] == np.uint64(xxhash.xxh64_intdigest(b"of the and a", 42)).astype(np.int64)


def test_whole_table(spark, tiny, small):
    for folder in (tiny, small):
        rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
        got = sorted((tuple(r) for r in op7_simhash(spark, folder).select("doc_id", "fingerprint", "component_id").collect()), key=str)
        assert got == expected(rows)
        assert len({c for _, _, c in got}) < len(got)


def test_nulls_empties_repeats_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (5, "A B  C d\te F"), (None, "only a null id here"), (7, "z " * 30000)]
    df = spark.createDataFrame([(i, t, 9, "x", 0) for i, t in rows], "doc_id long, text string, bits int, component_id string, key int")
    got = sorted((tuple(r) for r in near_duplicates(df).collect()), key=str)
    assert got == expected(rows)
    assert near_duplicates(df.limit(0)).collect() == []


def cluster(rng, n, flips, centre):
    out = set()
    while len(out) < n:
        x = centre
        for b in rng.sample(range(64), rng.randint(0, flips)):
            x ^= 1 << b
        out.add(x)
    return out


def test_blocks_grow_with_the_fingerprints():
    assert [simhash.blocks_for(n, 4) for n in (0, 10**8, 10**9, 10**10, 10**13)] == [6, 6, 7, 8, 8] and simhash.blocks_for(10, 6) == 7


@pytest.mark.parametrize("run,short,blocks", [(8192, 32, None), (50, 5, 6), (16, 2, 6), (50, 5, 7), (40, 4, 8)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, run, short, blocks):
    """Dense groups, chains and strangers; small bounds force chunks and pairs of chunks."""
    monkeypatch.setattr(simhash, "RUN", run)
    monkeypatch.setattr(simhash, "SHORT", short)
    rng = random.Random(run)
    prints = {rng.getrandbits(64) for _ in range(300)} | cluster(rng, 260, 3, rng.getrandbits(64)) | cluster(rng, 40, 5, rng.getrandbits(64))
    x = rng.getrandbits(64)
    for k in range(12):  # a chain, each step four bits on
        prints.add(x)
        for b in range(4):
            x ^= 1 << ((4 * k + b) % 64)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "bits long").repartition(3)
    import pyspark.cloudpickle as cloudpickle

    cloudpickle.register_pickle_by_value(simhash)  # so that the bounds above reach the workers
    try:
        links = near_links(df, n_blocks=blocks)
        found = links.collect()
        roots = dict(tuple(r) for r in components(links).collect())
    finally:
        cloudpickle.unregister_pickle_by_value(simhash)
    assert all((int(a) ^ int(b)).bit_count() <= 4 or bin((a ^ b) & (2**64 - 1)).count("1") <= 4 for a, b in found)
    want = groups(prints)
    sets = {}
    for p, r in want.items():
        sets.setdefault(r, set()).add(int(np.uint64(p).astype(np.int64)))
    got = {}
    for s in signed:
        got.setdefault(roots.get(s, s), set()).add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, sets.values()))


def test_forest_across_two_lists():
    rng = random.Random(3)
    a, b = (np.array(sorted(cluster(rng, 60, 3, 0)), np.uint64) for _ in range(2))
    joined = {(x, int(y)) for x, found in _forest(a, 4, b) for y in found}
    assert joined and all((x ^ y).bit_count() <= 4 for x, y in joined)


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (None, 4)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in range(1000, 1100)} == {1000} and len(got) == 301
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
