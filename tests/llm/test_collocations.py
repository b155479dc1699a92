"""Collocations against brute force and SQL, and the perfect hash by itself."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lidarlattice.llm import collocations, perfect_hash


def by_hand(rows, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {}
    for (lang, g), a in f.items():
        if len(g) > 1 and a >= 10:
            score, k = min((1000000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
            found[lang, g] = (a, f[lang, g[:k]], f[lang, g[k:]], score)
    hidden = set()
    for (lang, g), (a, *_) in found.items():
        if len(g) == 3:
            hidden |= {(lang, h) for h in (g[:2], g[1:]) if 100 * a >= 50 * found[lang, h][0]}
    out = []
    for lang in n:
        best = sorted(((-s, -a, " ".join(g).encode(), l, r) for (at, g), (a, l, r, s) in found.items() if at == lang and (at, g) not in hidden))[:top]
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(best)]
    return sorted(out)


def rows_of(seed, n=300):
    rng = random.Random(seed)
    words = ["The", "the", "of", "x", "é", "É", "日本", "Zed", "a\x00b", "naïve", "word", "-", "a'b"]
    ends = [" ", "  ", "\t", ". ", ", ", ";", "\n", "\r\n", "\x0b", "! ", " ", " ", " ", " ", "\xa0"]
    return [(rng.choice(["en", "de", None, "und", ""]), "".join(rng.choice(words[: rng.choice((3, 13))]) + rng.choice(ends) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("slots,top", [(1 << 22, 2000), (50, 7)])
def test_small_rows(spark, slots, top):
    """With one part of the perfect hash, and with many."""
    rows = [*rows_of(1), ("en", None), ("en", ""), (None, None), ("fr", "x x x x x x x x x x x x " * 3000), ("fr", "only. single. words"), ("es", "none here")]
    rows += [rows[0]] * 12
    df = spark.createDataFrame([(i, *r, "p", 1) for i, r in enumerate(rows)], "doc_id long, lang string, text string, phrase string, slot int").withColumnRenamed("doc_id", "a.b").repartition(5)
    got = collocations.collocations(df, top=top, slots=slots)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = sorted(map(tuple, got.collect()))
    assert found == by_hand(rows, top) and len(found) > 20
    if slots == 50:
        assert collocations.collocations(df.limit(0)).collect() == []


def test_tree_sums_in_levels(spark, monkeypatch):
    rows = rows_of(2, 120)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(9)
    monkeypatch.setattr(collocations, "FAN", 2)
    assert sorted(map(tuple, collocations.collocations(df).collect())) == by_hand(rows)


def test_text_of_a_phrase_is_sent_once(spark, tmp_path):
    """What tasks shuffle beside their keys and counts does not grow with the number of tasks that have a phrase."""
    rows = rows_of(3, 400)
    spark.createDataFrame(rows, "lang string, text string").repartition(8).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs")).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    assert docs.rdd.getNumPartitions() > 1
    share, bits = spark.sparkContext.broadcast, 8
    words = collocations.count_words(docs, bits).localCheckpoint()
    wanted = share(collocations.key_map(words, bits))
    twos = collocations.candidates(docs, wanted, None, bits).localCheckpoint()
    pairs = share(collocations.key_map(twos, bits))
    shards = collocations.hash_shards(words.unionAll(twos).unionAll(collocations.candidates(docs, wanted, pairs, bits)), bits).localCheckpoint()
    ready = collocations._Id(spark, {r["shard"]: bytes(r["payload"]) for r in shards.collect()})
    for everyone in (False, True):
        sent = collocations.count_slots(docs, wanted, pairs, ready, bits, everyone).where("names is not null").collect()
        slots = [(r["block"], at) for r in sent for at in collocations.unpack_names(bytes(r["names"]))]
        phrases = shards.agg(F.sum("phrases")).first()[0]
        assert len(set(slots)) == phrases > 100 and (len(slots) == phrases) is not everyone


def test_rows_that_change_tasks(spark):
    """Where each reading deals the rows to other tasks, no phrase is lost."""
    rows = rows_of(4, 300)
    anywhere = F.udf(lambda: random.randrange(1 << 30), "int").asNondeterministic()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(6, anywhere())
    assert sorted(map(tuple, collocations.collocations(df).collect())) == by_hand(rows)


@pytest.mark.parametrize("k,bits,shard", [(0, 8, 3), (1, 8, 255), (5, 16, 65535), (12000, 8, 200)])
def test_packed_keys(k, bits, shard):
    """Keys of a shard come back as they were, in less than the ten bytes that a key and its count have."""
    rng = np.random.default_rng(k)
    a = np.sort((rng.integers(0, 2**64, k, dtype=np.uint64) >> np.uint64(bits)) | np.uint64(shard << (64 - bits)))
    if k > 2:
        a[1], a[-1] = a[0], np.uint64(((shard + 1) << (64 - bits)) - 1)
    b, n = rng.integers(0, 2**16, k).astype(np.uint16), np.minimum(rng.geometric(0.8, k), 255)
    packed = collocations.pack(a, b, n, shard, bits)
    assert all((x == y).all() and len(x) == k for x, y in zip(collocations.unpack(packed, shard, bits), (a, b, n), strict=True))
    assert k < 1000 or len(packed) < 8 * k


def test_packed_counts_and_names():
    for most in (0, 1, 255, 256, 2**40):
        counts = np.zeros(collocations.BLOCK, np.int64)
        counts[7] = most
        assert (collocations.unpack_counts(collocations.pack_counts(counts)) == counts).all()
    names = [("a\tb\n", b"x y", 3), ("", b"q r", 0), ("a\tb\n", b"\xc3\xa9 z", 4095), ("日本", b"v w", 9)]
    assert collocations.unpack_names(collocations.pack_names(names)) == {at: (lang, phrase) for lang, phrase, at in names}


def test_counts_beyond_64_bits():
    """Scores are Python integers: a * a * SCALE passes 64 bits from three million on."""
    a = 5_000_000_000
    assert a * a * collocations.SCALE > 2**64 and collocations.SCALE * a * a // ((a + 1) * (a + 2)) == 999_999


@pytest.mark.parametrize("size", ["tiny", "small"])
def test_table(spark, request, size):
    folder = request.getfixturevalue(size)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    got = sorted(map(tuple, collocations.op11_collocations(spark, folder).collect()))
    assert got and got == sorted(con.execute(collocations.ORACLE_SQL["op11_collocations"]).fetchall())
    if size == "tiny":
        assert got == by_hand([tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()])


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        a, b = rng.integers(0, 2**64, n, dtype=np.uint64), rng.integers(0, 2**16, n, dtype=np.uint16)
        a[: n // 3] = a[0] if n else 0  # keys that differ in the second number only
        a, b, _ = collocations.summed(a, b, np.ones(n, np.uint8))
        shard = perfect_hash.shard_of(a, 6)
        made = perfect_hash.PerfectHash(6, {int(s): perfect_hash.build(a[shard == s], b[shard == s]) for s in set(shard.tolist())})
        assert len(made) == len(a) and sorted(made.slots(a, b).tolist()) == list(range(len(a)))
        assert (made.slots(rng.integers(0, 2**64, 1000, dtype=np.uint64), rng.integers(0, 2**16, 1000, dtype=np.uint16)) == -1).all()
        present = {(int(x), int(y)) for x, y in zip(a, b, strict=True)}
        other = b ^ np.uint16(1)
        gone = np.array([(int(x), int(y)) not in present for x, y in zip(a, other, strict=True)], bool)
        assert (made.slots(a, other)[gone] == -1).all()
