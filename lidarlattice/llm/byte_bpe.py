"""Byte-level BPE encoding and decoding by overlapping chunks.

A pre-token pattern without look-behind reads on from a boundary in one way only, so two
readings of a text that started at different places agree from their first common boundary.
Texts of more than CHUNK characters are cut into chunks, each with OVERLAP characters of the
next one. Every chunk is pre-tokenised from its own start, in whatever task, and also looks
at where a reading that starts at the next chunk first has a boundary in common with its
own: there it stops, and there the next chunk's pre-tokens count. What a chunk's reading has
before that place is dropped when the chunks are stitched. A cut is only made where all
readings must meet within OVERLAP (after a letter or digit that ends its run, or between a
mark and white space), so a run of one class that is longer than a chunk stays in one piece,
which no encoder could divide.

Each pre-token is encoded by itself: the pair of lowest rank is merged first, leftmost among
equals. Decoding concatenates the tokens' bytes.

Shorter texts are one chunk each, in a narrow map. Long ones are keyed by the SHA-256 of the
text: a text that occurs more than once is encoded once, and a lost task makes the same keys
again. Stitching streams through the chunks of a text in order and holds one of them.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarlattice.llm._common import map_text, table

#: Characters of a chunk, and how far it reaches into the next one at most.
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: Characters after a boundary that the pattern may look at before it settles there.
AHEAD = 4
#: Bounds of the two tables a worker keeps: pre-tokens of each, and the longest one that is kept.
CACHE_WORDS, CACHE_CHARS = 300_000, 48
#: Bytes up to which a pre-token's merges are found by scanning.
SCAN = 64

#: A place that is a boundary whatever was read before.
_MEET = regex.compile(r"\p{L}(?!\p{L})|\p{N}(?!\p{N})|[^\s\p{L}\p{N}](?=\s)")


class Codec:
    """The ranks of one vocabulary file and a pre-token pattern, ready to encode and decode."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        known = self.ranks.get(piece)
        if known is not None:
            return [known]
        parts = self._scan(piece) if len(piece) <= SCAN else self._queue(piece)
        return [self.ranks[p] for p in parts]

    def _scan(self, piece: bytes) -> list[bytes]:
        ranks, none = self.ranks, len(self.ranks) + 256
        part = [piece[i : i + 1] for i in range(len(piece))]
        pair = [ranks.get(a + b, none) for a, b in zip(part, part[1:], strict=False)]
        while pair and (best := min(pair)) < none:
            i = pair.index(best)
            part[i : i + 2] = [part[i] + part[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = ranks.get(part[i - 1] + part[i], none)
            if i < len(pair):
                pair[i] = ranks.get(part[i] + part[i + 1], none)
        return part

    def _queue(self, piece: bytes) -> list[bytes]:
        """The same with a heap of pairs and links between parts, for long pre-tokens."""
        ranks, n = self.ranks, len(piece)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := ranks.get(piece[i : end[j]])) is not None:
                heap.append((rank, i, end[i], end[j])) if not ready else heapq.heappush(heap, (rank, i, end[i], end[j]))

        ready = False
        for i in range(n - 1):
            offer(i)
        heapq.heapify(heap)
        ready = True
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            j = middle
            if end[i] != middle or j >= n or end[j] != stop:  # one of the two parts is no more
                continue
            end[i], end[j] = stop, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(piece[i : end[i]])
            i = after[i]
        return out

    def decode(self, ids) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def piece(self, piece: str) -> tuple[bytes, bytes]:
        """Ids of one pre-token as little-endian 32-bit numbers, and the bytes they decode to.

        Two tables hold the pre-tokens seen lately: when the young one is full it becomes
        the old one, so that frequent ones stay known within a fixed bound.
        """
        known = self.old.get(piece)
        if known is None:
            ids = self.merge(piece.encode())
            known = packed(ids), self.decode(ids)
        if len(piece) <= CACHE_CHARS:
            if len(self.young) >= CACHE_WORDS:
                self.old, self.young = self.young, {}
            self.young[piece] = known
        return known

    def parts(self, pieces: list[str]) -> list[tuple[bytes, bytes]]:
        get, more = self.young.get, self.piece
        return [get(p) or more(p) for p in pieces]

    def encode(self, text: str | None) -> list[int]:
        return unpacked(b"".join([p[0] for p in self.parts(self.pieces(text or ""))]))

    def digest(self, text: str | None) -> tuple[int, str, str]:
        parts = self.parts(self.pieces(text or ""))
        ids = b"".join([p[0] for p in parts])
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(b"".join([p[1] for p in parts])).hexdigest()

    def chunk(self, part: str, following: int | None) -> tuple[bytes, list[int], list[int], int | None]:
        """(ids up to where the next chunk takes over, boundaries near the start, ids before each, that place counted from the next chunk's start)."""
        pieces = self.pieces(part)
        ends = [0, *accumulate(map(len, pieces))]
        stop, meet = len(pieces), None
        if following is not None:
            other = {following, *accumulate(map(len, self.pieces(part[following:])), initial=following)}
            stop = next(i for i in range(bisect_left(ends, following), len(ends)) if ends[i] in other)
            meet = ends[stop] - following
        ids = [p[0] for p in self.parts(pieces[:stop])]
        near = [i for i in range(min(stop, bisect_left(ends, OVERLAP + AHEAD + 1)) + 1) if ends[i] <= OVERLAP + AHEAD]
        before = [0, *accumulate(len(i) // 4 for i in ids[: len(near)])]
        return b"".join(ids), [ends[i] for i in near], before[: len(near)], meet


def packed(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


def unpacked(ids: bytes) -> list[int]:
    if array("I").itemsize != 4 or array("I", [1]).tobytes()[0] != 1:
        return [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)]
    return array("I", ids).tolist()


def cuts(text: str, chunk: int, overlap: int) -> list[int]:
    """Where chunks start: every `chunk` characters or so, with a meeting place less than `overlap` after each."""
    out, n = [0], len(text)
    while (at := out[-1] + chunk) < n:
        found = _MEET.search(text, at)
        if found is None:
            break
        out.append(max(at, found.end() - overlap))
    return out


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """The codec of a vocabulary, loaded once per worker; by default the public one of that machine."""
    import public_tokenizers

    key = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    if key not in _CODECS:
        _CODECS[key] = Codec(*key)
    return _CODECS[key]


_CHUNKS = "key string, k int, part string, following int"
_READ = "key string, k int, ids binary, near array<int>, before array<int>, meet int"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(schema: str | T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def _long(texts: DataFrame, path: str | None, pattern: str | None, per_text, added: T.StructType) -> DataFrame:
    """texts (key, text), a row or more for each key -> (key, what `per_text` makes of the stitched ids), one row for each key."""
    chunks, read, out = _arrow(_CHUNKS), _arrow(_READ), T.StructType([T.StructField("key", T.StringType()), *added.fields])
    made = _arrow(out)

    def split(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = cuts(text, CHUNK, OVERLAP)
                for k, (a, b) in enumerate(zip(at, [*at[1:], None], strict=True)):
                    yield _batch([(key, k, text[a:] if b is None else text[a : b + OVERLAP + AHEAD], None if b is None else b - a)], chunks)

    def encode(batches):
        c = codec(path, pattern)
        for batch in batches:
            for key, k, part, following in zip(*[col.to_pylist() for col in batch.columns], strict=True):
                yield _batch([(key, k, *c.chunk(part, following))], read)

    def stitch(batches):
        c, key, sink, meet = codec(path, pattern), None, None, None
        for batch in batches:
            for row_key, _, ids, near, before, next_meet in zip(*[col.to_pylist() for col in batch.columns], strict=True):
                if row_key != key:
                    if sink is not None:
                        yield _batch([(key, *sink.done())], made)
                    key, sink, meet = row_key, per_text(c), 0
                sink.add(ids[4 * before[bisect_left(near, meet)] :])
                meet = next_meet
        if sink is not None:
            yield _batch([(key, *sink.done())], made)

    parts = texts.mapInArrow(split, _CHUNKS).dropDuplicates(["key", "k"])
    return parts.mapInArrow(encode, _READ).repartition("key").sortWithinPartitions("key", "k").mapInArrow(stitch, out)


class _Digest:
    """Digests of ids and of the bytes they decode to, a chunk at a time."""

    def __init__(self, c: Codec):
        self.codec, self.n, self.ids, self.text = c, 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: bytes) -> None:
        self.n += len(ids) // 4
        self.ids.update(ids)
        self.text.update(self.codec.decode(unpacked(ids)))

    def done(self) -> tuple:
        return self.n, self.ids.hexdigest(), self.text.hexdigest()


class _Whole:
    """All ids and bytes of a text."""

    def __init__(self, c: Codec):
        self.codec, self.ids = c, []

    def add(self, ids: bytes) -> None:
        self.ids += unpacked(ids)

    def done(self) -> tuple:
        return self.ids, self.codec.decode(self.ids)


def _both(df: DataFrame, text_col: str, added: T.StructType, short, per_text, path: str | None, pattern: str | None, keep_text: bool) -> DataFrame:
    """Short texts in a narrow map, long ones by chunks; columns named like the new ones, in whatever case, are replaced."""
    new = {f.name.lower() for f in added.fields}
    at = df.columns.index(text_col)
    names = [f"c{i}" for i in range(len(df.columns))]
    kept = [i for i, c in enumerate(df.columns) if i == at or c.lower() not in new]
    plain = df.toDF(*names).select(*[names[i] for i in kept])
    text = names[at]
    fields = T.StructType([T.StructField(f"n{i}", f.dataType) for i, f in enumerate(added.fields)])
    is_long = F.coalesce(F.length(text) > CHUNK, F.lit(False))
    few = map_text(plain.where(~is_long), lambda batch: dict(zip(fields.names, short(batch.column(text).to_pylist()), strict=True)), fields, text, keep_text=keep_text)
    keyed = plain.where(is_long).withColumn("key", F.sha2(F.col(text).cast("binary"), 256))
    made = _long(keyed.select("key", text), path, pattern, per_text, fields)
    columns = [*[names[i] for i in kept if keep_text or i != at], *fields.names]
    out = few.select(*columns).unionAll(keyed.join(made, "key", "left").select(*columns))
    return out.toDF(*[df.columns[i] for i in kept if keep_text or i != at], *added.names)


def encode_texts(df: DataFrame, path: str | None = None, pattern: str | None = None, text_col: str = "text") -> DataFrame:
    """Append `ids` (array of int) and `decoded` (binary) to every row, with the null, empty, long and repeated texts of digest_texts."""
    added = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])

    def short(texts):
        c = codec(path, pattern)
        ids = [c.encode(t) for t in texts]
        return ids, [c.decode(i) for i in ids]

    return _both(df, text_col, added, short, _Whole, path, pattern, keep_text=True)


def digest_texts(df: DataFrame, path: str | None = None, pattern: str | None = None, text_col: str = "text") -> DataFrame:
    """Encode and decode every row's text and keep digests only.

    Every row of `df` gives one row: its columns without the text, then n_tokens (long),
    ids_sha256 (of ids as little-endian 32-bit numbers) and decoded_sha256 (of the decoded
    bytes). A null text counts as empty; empty texts have no ids (digests of no bytes). Long
    texts are read whole, by chunks. Repeated rows and null ids stay as they are; there are
    no ties. Columns named like the new ones are replaced; other names may be anything. An
    empty table stays empty. `path` (a rank file that every worker can read) and `pattern`
    default to the public vocabulary, which each worker looks up.
    """
    added = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def short(texts):
        c = codec(path, pattern)
        rows = [c.digest(t) for t in texts]
        return list(zip(*rows, strict=True)) if rows else [[], [], []]

    return _both(df, text_col, added, short, _Digest, path, pattern, keep_text=False)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op13_byte_bpe": op13_byte_bpe}
ORACLE_SQL: dict[str, str] = {}
