"""Byte-level BPE against the library, on whole tables, hard texts and chunks of every size."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lidarlattice.llm import byte_bpe

ALPHABET = ["a", " ", "  ", "the", "ing", "1", "23", "\n", "\r\n", "é", "日", "🙂", "\x00", "aaa", "'s", "'", "'re", "'ll", "  ", "\t", "==", "//", ".", "́", "'v", "٣", "<|endoftext|>", "\x85", "x" * 70]


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def want(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()


def test_texts_of_all_kinds(library):
    codec, rng = byte_bpe.codec(), random.Random(5)
    for _ in range(5000):
        t = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 20)))
        assert codec.encode(t) == library.encode_ordinary(t) and codec.decode(codec.encode(t)) == t.encode() and codec.digest(t) == want(library, t)
    for n in (63, 64, 65, 300, 20_000):
        for letters in ("ab", "thein", "a", "日é"):
            t = "".join(rng.choice(letters) for _ in range(n))
            assert codec.encode(t) == library.encode_ordinary(t)


def stitched(codec, text, chunk, overlap):
    """All chunks of a text put together by hand."""
    at, out, meet = byte_bpe.cuts(text, chunk, overlap), b"", 0
    for a, b in zip(at, [*at[1:], None], strict=True):
        ids, near, before, following = codec.chunk(text[a:] if b is None else text[a : b + overlap + byte_bpe.AHEAD], None if b is None else b - a)
        out += ids[4 * before[near.index(meet)] :]
        meet = following
    return byte_bpe.unpacked(out), len(at)


@pytest.mark.parametrize("chunk,overlap", [(9, 8), (16, 8), (40, 30), (100, 10)])
def test_chunks_meet(library, monkeypatch, chunk, overlap):
    monkeypatch.setattr(byte_bpe, "OVERLAP", overlap)
    codec, rng, most = byte_bpe.codec(), random.Random(chunk), 0
    for _ in range(1500):
        t = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80)))
        ids, n = stitched(codec, t, chunk, overlap)
        most = max(most, n)
        assert ids == library.encode_ordinary(t)
    for t in ("a" * 500, " " * 500, " \n" * 300 + "x", "'" * 200 + "s", "'s" * 200, "日本" * 300, "1a" * 200, "don't " * 100, "x́" * 100):
        assert stitched(codec, t, chunk, overlap)[0] == library.encode_ordinary(t)
    assert most > 5


def test_rows(spark, library, monkeypatch):
    rng = random.Random(8)
    long = "".join(rng.choice(ALPHABET) + rng.choice([" ", "", "word "]) for _ in range(40_000))
    rows = [(1, None), (2, ""), (3, "It's the same."), (3, "It's the same."), (None, "één wörd 日本 🙂 \n\t x"), (5, long), (5, long), (6, "long text of words " * 20000), (7, "  "), (8, "y" * 200_000), (9, " " * 200_000 + "z")]
    df = spark.createDataFrame([(i, t, "k", 1, 2.0, "n") for i, t in rows], "doc_id long, text string, key string, k int, `a.b` double, N_Tokens string")
    assert sum(len(t or "") > byte_bpe.CHUNK for _, t in rows) == 5
    out = byte_bpe.digest_texts(df)
    assert out.columns == ["doc_id", "key", "k", "a.b", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(((r[0], r[1], *r[4:]) for r in out.collect()), key=str) == sorted(((i, "k", *want(library, t)) for i, t in rows), key=str)
    whole = byte_bpe.encode_texts(df.select("doc_id", "text")).collect()
    assert len(whole) == len(rows) and all(r["ids"] == library.encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode() for r in whole)
    assert byte_bpe.digest_texts(df.limit(0)).collect() == [] and byte_bpe.encode_texts(df.limit(0)).collect() == []


def test_table(spark, library, small):
    texts = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = byte_bpe.op13_byte_bpe(spark, small).collect()
    assert sorted(map(tuple, got)) == sorted((r["doc_id"], *want(library, r["text"])) for r in texts)


def test_another_vocabulary(spark, tiny):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    other = tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.read.parquet(f"{tiny}/documents.parquet").where(F.col("doc_id") < 40)
    assert all(r["ids"] == other.encode_ordinary(r["text"] or "") for r in byte_bpe.encode_texts(df, path).collect())
