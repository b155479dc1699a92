"""Collocations: phrases that occur more often than the parts they are cut into.

Four passes read the texts. Words and phrases travel as 80-bit keys, made from the 128-bit
hashes of the words (with their language), and never as text until they are counted:

1. Words: tasks count them, and sums by shard of the key leave the frequent ones, as a bitmap
   of bounded size.
2. Candidates of two words: tasks send the keys of phrases whose words are all frequent, each
   once with a count that stops at 255; sums by shard leave those that reach the limit.
3. Candidates of three words: the same for phrases whose words and pairs are all frequent. No
   frequent phrase can be left out, as a phrase is no more frequent than its parts (Apriori).
4. Counts: each shard turns its words and candidates into its part of a minimal perfect hash
   that stores the keys. Tasks look up every word and phrase, compare the stored key, and
   count slots in numpy arrays, which are summed block by block in a tree. One task that has
   the phrase, noted by the shard that counted it, sends its text.

Cuts are then read by slot: each phrase looks up the slots of its parts. A perfect hash of
more than SLOTS keys is used a part at a time, each part with a pass of its own, so what a
task or the driver holds does not grow with the corpus. Scores are Python integers, exact at
any size.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lidarlattice.llm._common import cut, table
from lidarlattice.llm.perfect_hash import PerfectHash, build, fold, shard_of

#: Least occurrences of a phrase, rows per language, scale of the scores, share (percent) of a phrase that a longer one must have to hide it.
LEAST, TOP, SCALE, HIDES = 10, 2000, 1_000_000, 50
#: Keys of the perfect hash that are used at a time; bits of the map of frequent words (8 MB); slots of a block; blocks' rows that are summed at a time.
SLOTS, MAP_BITS, BLOCK, FAN = 1 << 22, 26, 4096, 256
#: Parts of a language's phrases that are ranked by themselves first, so that what is ranked together in the end is bounded.
HEATS = 64
#: Bytes of text that are split at a time, words that a task knows, keys that it sorts at a time, sorted keys that it holds before it sends them (33 MB).
SLICE, KNOWN, KEYS, HELD = 512 << 10, 250_000, 400_000, 3_000_000

#: The end of a piece: a byte that no UTF-8 text has.
END = b"\xff"
#: A to Z to lower case, ends of pieces to that byte, tabs to spaces: no other white space that split() knows is left.
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + END * 10 + b" ")


class Reader:
    """Splits texts into tokens and numbers the words of each language, with their hashes; number 0 is no word: the end of a piece, or, with a map of wanted words, one that is not on it."""

    def __init__(self, wanted: np.ndarray | None = None):
        self.wanted = wanted
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, Reader._Words] = {}
        self.n, self.held = 1, 1
        self.a, self.b, self.number = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64), np.zeros(1024, np.int64)

    class _Words(dict):
        """Numbers of one language's words, given out when they are first met."""

        def __init__(self, reader: Reader, lang: str):
            super().__init__({END: 0})
            self.reader, self.before, self.new = reader, lang.encode() + b"\xff", []

        def __missing__(self, word: bytes) -> int:
            self.new.append(word)
            n = self[word] = self.reader.n
            self.reader.n = n + 1
            return n

    def of(self, lang: str) -> Reader._Words:
        words = self.words.get(lang)
        if words is None:
            words = self.words[lang] = Reader._Words(self, lang)
        return words

    def numbers(self, lang: str, tokens: list[bytes]) -> np.ndarray:
        """Numbers of one language's tokens; new words are hashed on the way."""
        words = self.of(lang)
        ids = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
        if words.new:
            digest, before = xxhash.xxh3_128_digest, words.before
            raw = np.frombuffer(b"".join([digest(before + w) for w in words.new]), ">u8").astype(np.uint64)
            words.new = []
            while self.n > len(self.a):
                self.a, self.b, self.number = (np.r_[x, np.zeros(len(x), x.dtype)] for x in (self.a, self.b, self.number))
            here = slice(self.held, self.n)
            self.b[here], self.a[here] = raw[::2], raw[1::2]
            self.number[here] = np.arange(self.held, self.n)
            if self.wanted is not None:
                self.number[here] *= on_map(self.wanted, raw[1::2])
            self.held = self.n
        return ids if self.wanted is None else self.number[ids]

    def read(self, lang: str, texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """(tokens, their numbers) of texts of one language, a piece's end between them."""
        tokens = END.join(texts).translate(_PLAIN).replace(END, b" " + END + b" ").split()
        return tokens, self.numbers(lang, tokens)

    def __len__(self) -> int:
        return self.n

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """The two halves of each word's hash by number."""
        return self.a[: self.n], self.b[: self.n]


def by_language(batches) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, about SLICE bytes at a time."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            t = text.as_py()
            if t:
                held.setdefault(lang, []).append(t)
                size += len(t)
            if size >= SLICE:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def phrases_at(ids: np.ndarray, size: int) -> np.ndarray:
    """Where phrases of `size` words start: no 0 among them."""
    word = ids > 0
    at = word[: len(ids) - size + 1]
    for k in range(1, size):
        at = at & word[k : len(ids) - size + 1 + k]
    return np.flatnonzero(at) if len(ids) >= size else np.zeros(0, np.int64)


def half(b: np.ndarray) -> np.ndarray:
    """The part of the second hash that keys hold."""
    return (b >> np.uint64(48)).astype(np.uint16)


def keys_at(a: np.ndarray, b: np.ndarray, ids: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (64 and 16 bits) of the phrases of `size` words at `at`."""
    ka, kb = a[ids[at]], b[ids[at]]
    for k in range(1, size):
        ka, kb = fold(ka, a[ids[at + k]]), fold(kb, b[ids[at + k]])
    return ka, half(kb)


def two_and_three(a: np.ndarray, b: np.ndarray, ids: np.ndarray, pairs: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]]:
    """Places and keys of the phrases of two words, then of three, which go on from them; with a map of frequent `pairs`, of those only that may be frequent by it."""
    two = phrases_at(ids, 2)
    ka, kb = fold(a[ids[two]], a[ids[two + 1]]), fold(b[ids[two]], b[ids[two + 1]])
    if pairs is not None:
        kept = on_map(pairs, ka)
        two, ka, kb = two[kept], ka[kept], kb[kept]
    yield two, (ka, half(kb))
    more = np.flatnonzero(two[1:] == two[:-1] + 1)
    three = two[more]
    yield three, (fold(ka[more], a[ids[three + 2]]), half(fold(kb[more], b[ids[three + 2]])))


# -- keys by shard ----------------------------------------------------------------------------

#: Keys of a shard with the task they come from (n), or, of its frequent keys, with a task that has each (owner); or words of a language (lang, n).
_ROWS = "shard int, payload binary, lang string, n long, owner binary"
#: What stands in an owner's place where none is asked for: at words. Tasks go by their number modulo this.
WORD = 0xFFFF


def squeeze(plain: bytes) -> bytes:
    return struct.pack("<I", len(plain)) + pa.Codec("zstd", compression_level=1).compress(plain, asbytes=True)


def unsqueeze(payload: bytes) -> bytes:
    return pa.Codec("zstd").decompress(payload[4:], decompressed_size=int.from_bytes(payload[:4], "little"), asbytes=True)


def task_number() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _rows(rows: list[tuple], names: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in names.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, type=kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def pack(a: np.ndarray, b: np.ndarray, n: np.ndarray, shard: int, bits: int) -> bytes:
    """Keys, in order, and counts of one shard: the steps from key to key, of which the leading three bytes and the counts (mostly small numbers) are compressed."""
    steps = np.diff(a, prepend=np.uint64(shard << (64 - bits)))
    plain = [steps.astype("<u4"), (steps >> np.uint64(32)).astype(np.uint8), b.astype("<u2")]
    small = [(steps >> np.uint64(40)).astype(np.uint8), (steps >> np.uint64(48)).astype("<u2"), n.astype(np.uint8)]
    return struct.pack("<I", len(a)) + b"".join([x.tobytes() for x in plain]) + squeeze(b"".join([x.tobytes() for x in small]))


def unpack(payload: bytes, shard: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    (k,) = struct.unpack_from("<I", payload)
    small = unsqueeze(payload[4 + 7 * k :])
    steps = np.zeros(k, np.uint64)
    for held, kind, at, up in ((payload, "<u4", 4, 0), (payload, np.uint8, 4 + 4 * k, 32), (small, np.uint8, 0, 40), (small, "<u2", k, 48)):
        steps |= np.frombuffer(held, kind, k, at).astype(np.uint64) << np.uint64(up)
    a = np.cumsum(steps, dtype=np.uint64) + np.uint64(shard << (64 - bits))
    return a, np.frombuffer(payload, "<u2", k, 4 + 5 * k), np.frombuffer(small, np.uint8, k, 3 * k)


def grouped(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys by the first number, and where in it each different key starts."""
    order = np.argsort(a)
    a_, b_ = a[order], b[order]
    same = a_[1:] == a_[:-1]
    if (same & (b_[1:] != b_[:-1])).any():  # different keys share the first number: order them by both
        order = np.lexsort((b, a))
        a_, b_ = a[order], b[order]
        same = a_[1:] == a_[:-1]
    return order, np.flatnonzero(np.r_[True, ~same | (b_[1:] != b_[:-1])][: len(a)])


def summed(a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal keys as one with the sum of `n` (1 each, if None), in order of the first number."""
    order, start = grouped(a, b)
    first = order[start]
    return a[first], b[first], times(n, order, start)


def times(n: np.ndarray | None, order: np.ndarray, start: np.ndarray) -> np.ndarray:
    if n is None or not len(order):
        return np.diff(np.r_[start, len(order)])
    return np.add.reduceat(n[order].astype(np.int32), start)


def dealt(a: np.ndarray, b: np.ndarray, n: np.ndarray | None, bits: int, part: int) -> pa.RecordBatch:
    """Keys of a task with their counts, each once, as a row for each shard."""
    a, b, n = summed(a, b, n)
    edges = np.r_[0, np.flatnonzero(np.diff(shard_of(a, bits))) + 1, len(a)] if len(a) else [0]
    n = np.minimum(n, 255)
    shards = [int(a[i]) >> (64 - bits) for i in edges[:-1]]
    return _rows([(s, pack(a[i:j], b[i:j], n[i:j], s, bits), None, part % WORD, None) for s, i, j in zip(shards, edges[:-1], edges[1:], strict=True)], _ROWS)


def gathered(rows: DataFrame, bits: int, finish, names: str) -> DataFrame:
    """`finish(shard, a, b, owner, totals)` of each shard's frequent keys, with a task that has each, and of the totals that it holds, one shard of a task at a time."""

    def run(batches):
        shard, parts, totals = None, [], {}

        def close():
            a, b, n, owner = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, t) for t in (np.uint64, np.uint16, np.uint8, np.uint16))
            order, start = grouped(a, b)
            kept = order[start[times(n, order, start) >= LEAST]]
            return _rows(finish(shard, a[kept], b[kept], owner[kept], totals), names)

        for batch in batches:
            for name, payload, lang, n, owner in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if name != shard:
                    if shard is not None:
                        yield close()
                    shard, parts, totals = name, [], {}
                if lang is not None:
                    totals[lang] = totals.get(lang, 0) + n
                else:
                    keys = unpack(payload, name, bits)
                    parts.append((*keys, np.full(len(keys[0]), n, np.uint16) if owner is None else np.frombuffer(owner, "<u2")))
        if shard is not None:
            yield close()

    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, names)


def kept_keys(bits: int, word: bool = False):
    """Rows of a shard's frequent keys, which count LEAST from here on, and of totals."""

    def finish(shard: int, a: np.ndarray, b: np.ndarray, owner: np.ndarray, totals: dict[str, int]) -> list[tuple]:
        rows = [(shard, None, lang, n, None) for lang, n in totals.items()]
        owner = np.full(len(a), WORD) if word else owner
        return rows + ([(shard, pack(a, b, np.full(len(a), LEAST), shard, bits), None, len(a), owner.astype("<u2").tobytes())] if len(a) else [])

    return finish


def count_words(docs: DataFrame, bits: int) -> DataFrame:
    """docs (lang, text) -> rows of frequent words by shard, and of all words of each language (lang, n)."""

    def run(batches):
        reader, counts, totals = Reader(), np.zeros(0, np.int64), {}

        def flush():
            a, b = reader.hashes()
            return dealt(a[1:], half(b[1:]), np.minimum(counts[1:], 255), bits, task_number())

        for lang, texts in by_language(batches):
            _, ids = reader.read(lang, texts)
            found = np.bincount(ids, minlength=len(reader))
            found[: len(counts)] += counts
            counts = found
            totals[lang] = totals.get(lang, 0) + int((ids > 0).sum())
            if len(reader) > KNOWN:
                yield flush()
                reader.forget()
                counts = np.zeros(0, np.int64)
        if len(counts):
            yield flush()
        # totals travel with the shards, spread by language, on numbers beyond theirs
        yield _rows([((1 << bits) + zlib.crc32(lang.encode()) % 64, None, lang, n, None) for lang, n in totals.items()], _ROWS)

    return gathered(docs.mapInArrow(run, _ROWS), bits, kept_keys(bits, word=True), _ROWS)


def key_map(keys: DataFrame, bits: int) -> bytes:
    """A map of frequent words or phrases: a bit for the leading MAP_BITS of each key. A shard makes its own stretch of it."""

    def run(batches):
        for batch in batches:
            for shard, payload in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                flags = np.zeros(1 << (MAP_BITS - bits), np.uint8)
                flags[(unpack(payload, shard, bits)[0] >> np.uint64(64 - MAP_BITS)).astype(np.int64) - (shard << (MAP_BITS - bits))] = 1
                yield _rows([(shard, zlib.compress(np.packbits(flags, bitorder="little").tobytes(), 1))], "shard int, payload binary")

    made = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    wide = 1 << (MAP_BITS - bits - 3)
    for r in keys.where("payload is not null").select("shard", "payload").mapInArrow(run, "shard int, payload binary").toLocalIterator():
        made[r["shard"] * wide : (r["shard"] + 1) * wide] = np.frombuffer(zlib.decompress(r["payload"]), np.uint8)
    return made.tobytes()


def on_map(bitmap: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set."""
    at = (a >> np.uint64(64 - MAP_BITS)).astype(np.int64)
    return bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def candidates(docs: DataFrame, words, pairs, bits: int) -> DataFrame:
    """Keys, by shard, of phrases of two words that may be frequent, given the map of frequent words; given that of frequent pairs too, of phrases of three."""

    def run(batches):
        reader, a, b, n, runs = Reader(np.frombuffer(words.value, np.uint8)), [], [], 0, []
        known = None if pairs is None else np.frombuffer(pairs.value, np.uint8)

        def sort():
            ka, kb, found = summed(np.concatenate(a), np.concatenate(b))
            runs.append((ka, kb, np.minimum(found, 255).astype(np.uint8)))
            a.clear()
            b.clear()

        def sent():
            rows = dealt(*(np.concatenate(c) for c in zip(*runs, strict=True)), bits, task_number())
            runs.clear()
            return rows

        for lang, texts in by_language(batches):
            _, ids = reader.read(lang, texts)
            _, (ka, kb) = next(two_and_three(*reader.hashes(), ids)) if known is None else list(two_and_three(*reader.hashes(), ids, known))[1]
            a.append(ka)
            b.append(kb)
            n += len(ka)
            if len(reader) > KNOWN:
                reader.forget()
            if n >= KEYS:
                sort()
                n = 0
                if sum(len(r[0]) for r in runs) >= HELD:
                    yield sent()
        if n:
            sort()
        if runs:
            yield sent()

    return gathered(docs.mapInArrow(run, _ROWS), bits, kept_keys(bits), _ROWS)


def hash_shards(keys: DataFrame, bits: int) -> DataFrame:
    """Frequent keys, each given once with LEAST, by shard -> (shard, n, phrases, payload): the shard's part of the perfect hash, its keys and those that are phrases."""

    def finish(shard, a, b, owner, _):
        return [(shard, len(a), int((owner != WORD).sum()), build(a, b, owner))] if len(a) else []

    return gathered(keys.where("payload is not null"), bits, finish, "shard int, n long, phrases long, payload binary")


# -- counts by slot ---------------------------------------------------------------------------

_PACKED = "block int, part int, counts binary, names binary"
_COUNTED = "block int, counts binary, slot long, lang string, phrase string, a long"
#: Phrases that a task holds before it sends them on.
NAMES = 100_000
_HASHES: dict[int, PerfectHash] = {}


def perfect_hash(held, bits: int) -> PerfectHash:
    """The broadcast part of the perfect hash, made ready once per worker; an earlier part is let go."""
    if held.id not in _HASHES:
        _HASHES.clear()
        _HASHES[held.id] = PerfectHash(bits, held.value)
    return _HASHES[held.id]


class _Id:
    """A broadcast with a number that workers can tell it by."""

    _next = 0

    def __init__(self, spark: SparkSession, value):
        _Id._next += 1
        self.id, self._held = _Id._next, spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self._held.value

    def __getstate__(self):
        return self.id, self._held

    def __setstate__(self, state):
        self.id, self._held = state

    def free(self) -> None:
        self._held.destroy()


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts of a block, byte by byte, as many bytes as its largest count has."""
    wide = max(1, -(-int(counts.max()).bit_length() // 8))
    return squeeze(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T[:wide].tobytes())


def unpack_counts(payload: bytes) -> np.ndarray:
    plain = np.frombuffer(unsqueeze(payload), np.uint8).reshape(-1, BLOCK)
    counts = np.zeros((BLOCK, 8), np.uint8)
    counts[:, : len(plain)] = plain.T
    return counts.view("<u8").ravel().astype(np.int64)


def pack_names(names: list[tuple[str, bytes, int]]) -> bytes:
    """Language, phrase and place in the block: the places, then a line for each phrase, after one with a tab for its language; neither tabs nor line ends are left in phrases."""
    lines, before = [], None
    names = sorted(names)
    for lang, phrase, _ in names:
        if lang != before:
            lines.append(b"\t" + lang.encode("unicode_escape"))
            before = lang
        lines.append(phrase)
    return struct.pack("<I", len(names)) + np.array([at for *_, at in names], "<u2").tobytes() + squeeze(b"\n".join(lines))


def unpack_names(payload: bytes) -> dict[int, tuple[str, bytes]]:
    (k,) = struct.unpack_from("<I", payload)
    places, names, lang = iter(np.frombuffer(payload, "<u2", k, 4).tolist()), {}, None
    for line in unsqueeze(payload[4 + 2 * k :]).split(b"\n"):
        if line[:1] == b"\t":
            lang = line[1:].decode("unicode_escape")
        else:
            names[next(places)] = lang, line
    return names


def count_slots(docs: DataFrame, wanted, pairs, held, bits: int, everyone: bool = False) -> DataFrame:
    """Counts of the slots of one part of the perfect hash: rows of blocks, with their counts or with the phrases of which the task is the owner, or, for `everyone`, that it met."""

    def run(batches):
        part = task_number()
        ready, known = perfect_hash(held, bits), np.frombuffer(pairs.value, np.uint8)
        reader, slot = Reader(np.frombuffer(wanted.value, np.uint8)), np.full(1, -1)
        counts, asked, met = np.zeros(len(ready), np.int64), np.full(len(ready), True) if everyone else ready.tags == part % WORD, []
        names: dict[int, tuple[str, bytes]] = {}

        def counted():
            np.add(counts, np.bincount(np.concatenate(met), minlength=len(counts)), out=counts)
            met.clear()

        def sent():
            by_block: dict[int, list[tuple[str, bytes, int]]] = {}
            for s, name in names.items():
                by_block.setdefault(s // BLOCK, []).append((*name, s % BLOCK))
            names.clear()
            return _rows([(block, part, None, pack_names(some)) for block, some in by_block.items()], _PACKED)

        for lang, texts in by_language(batches):
            tokens, ids = reader.read(lang, texts)
            ha, hb = reader.hashes()
            new = slice(len(slot), len(ha))
            slot = np.r_[slot, ready.slots(ha[new], half(hb[new]))]
            found = slot[ids]
            met.append(found[(ids > 0) & (found >= 0)])
            for size, (at, keys) in enumerate(two_and_three(ha, hb, ids, known), 2):
                found = ready.slots(*keys)
                at, found = at[found >= 0], found[found >= 0]
                fresh = np.flatnonzero(asked[found])
                first, where = np.unique(found[fresh], return_index=True)
                for s, i in zip(first.tolist(), at[fresh[where]].tolist(), strict=True):
                    names[s] = lang, b" ".join(tokens[i : i + size])
                asked[first] = False
                met.append(found)
            if sum(map(len, met)) >= KEYS:
                counted()
            if len(names) >= NAMES:
                yield sent()
            if len(reader) > KNOWN:
                reader.forget()
                slot = np.full(1, -1)
        if names:
            yield sent()
        if met:
            counted()
        full = np.zeros(-(-len(counts) // BLOCK) * BLOCK, np.int64)
        full[: len(counts)] = counts
        used = np.flatnonzero(full.reshape(-1, BLOCK).any(axis=1))
        for at in range(0, len(used), 1000):
            yield _rows([(int(k), part, pack_counts(full[k * BLOCK : (k + 1) * BLOCK]), None) for k in used[at : at + 1000]], _PACKED)

    return docs.mapInArrow(run, _PACKED)


def tree_sum(rows: DataFrame, parts: int) -> DataFrame:
    """Blocks of counts summed over all tasks, FAN of them at a time; in the end a row for each block (counts), and for each phrase that is frequent (slot, lang, phrase, a)."""

    def level(last: bool):
        def run(batches):
            key, total, names = None, None, {}

            def close():
                block, part = key
                payload = None if total is None else pack_counts(total)
                if not last:
                    return _rows([(block, part, payload, pack_names([(*name, at) for at, name in names.items()]) if names else None)], _PACKED)
                found = [(at, lang, phrase.decode(), int(total[at])) for at, (lang, phrase) in names.items() if total[at] >= LEAST]
                return _rows([(block, payload, None, None, None, None), *[(block, None, block * BLOCK + at, *rest) for at, *rest in found]], _COUNTED)

            for batch in batches:
                for block, part, counts, more in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if (block, part) != key:
                        if key is not None:
                            yield close()
                        key, total, names = (block, part), None, {}
                    if more is not None:
                        names |= unpack_names(more)
                    if counts is not None:
                        counted = unpack_counts(counts)
                        total = counted if total is None else total + counted
            if key is not None:
                yield close()

        return run

    while True:
        parts = -(-parts // FAN)
        up = F.lit(0) if parts == 1 else F.floor(F.col("part") / FAN).cast("int")
        rows = rows.withColumn("part", up).repartition("block", "part").sortWithinPartitions("block", "part").mapInArrow(level(parts == 1), _COUNTED if parts == 1 else _PACKED)
        if parts == 1:
            return rows


# -- cuts -------------------------------------------------------------------------------------

_CUT = "slot long, lang string, phrase string, a long, parts array<long>, inner array<long>"
_SCORED = "slot long, lang string, phrase string, a long, l long, r long, score long, inner array<long>"


def parts_of(words: list[bytes]) -> list[tuple[int, int]]:
    """The parts that a phrase is cut into, as spans: first and rest of each cut."""
    n = len(words)
    return [span for k in range(1, n) for span in ((0, k), (k, n))]


def lowest(a: int, parts: list[int]) -> tuple[int, int, int]:
    """(l, r, score) of the cut of the lowest score, the first among equals; `parts` are the counts of first part and rest of each cut."""
    if not all(parts):
        raise ValueError("a part of a frequent phrase has no count")
    score, k = min((SCALE * a * a // (parts[k] * parts[k + 1]), k) for k in range(0, len(parts), 2))
    return parts[k], parts[k + 1], score


def read_cuts(phrases: DataFrame, held, counts, bits: int, offset: int, last: bool) -> DataFrame:
    """Fill in the counts of the parts of each phrase that this part of the perfect hash holds (`parts`), and the slots of the shorter phrases in it (`inner`); the last part gives the scores."""
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), *([pa.int64()] * 3 if last else [pa.list_(pa.int64())]), pa.list_(pa.int64()))
    schema = _SCORED if last else _CUT

    def run(batches):
        ready, number = perfect_hash(held, bits), np.frombuffer(counts.value, np.int64)
        for batch in batches:
            rows = [list(r) for r in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            reader, tasks = Reader(), []
            ids, langs, spans = [], [], {1: ([], []), 2: ([], [])}
            for i, (_, lang, phrase, _, parts, inner) in enumerate(rows):
                words = phrase.encode().split(b" ")
                start = len(ids)
                ids += words
                langs += [lang] * len(words)
                cuts = parts_of(words)
                if parts is None:
                    rows[i][4], rows[i][5] = [0] * len(cuts), [-1] * (2 if len(words) == 3 else 0)
                for j, (x, y) in enumerate(cuts):
                    spans[y - x][0].append(start + x)
                    spans[y - x][1].append((i, j))
            numbers = np.zeros(len(ids), np.int64)
            of = np.array(langs, object)
            for lang in set(langs):
                here = np.flatnonzero(of == lang)
                numbers[here] = reader.numbers(lang, [ids[k] for k in here.tolist()])
            ids, (ha, hb) = numbers, reader.hashes()
            for size, (at, who) in spans.items():
                found = ready.slots(*keys_at(ha, hb, ids, np.array(at, np.int64), size)) if at else []
                tasks += [(i, j, size, int(s)) for (i, j), s in zip(who, found, strict=True) if s >= 0]
            for i, j, size, s in tasks:
                rows[i][4][j] = int(number[s])
                if size == 2:  # the rest of a first cut stands second, the first part of a second cut first
                    rows[i][5][0 if j == 2 else 1] = s + offset
            if last:
                rows = [(*r[:4], *lowest(r[3], r[4]), r[5]) for r in rows]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in schema.split(", ")])

    return phrases.mapInArrow(run, schema)


def passes(sizes: list[tuple[int, int]], most: int) -> list[list[int]]:
    """Shards, in order, in lots of at most `most` keys (one shard at least)."""
    lots, held = [[]], 0
    for shard, n in sorted(sizes):
        if lots[-1] and held + n > most:
            lots.append([])
            held = 0
        lots[-1].append(shard)
        held += n
    return lots


def collocations(docs: DataFrame, top: int = TOP, slots: int = SLOTS) -> DataFrame:
    """The `top` phrases of each language by score: (lang, rank, phrase, a, l, r, n, score).

    docs holds lang and text. Texts are read whole, of any length: A to Z in lower case, cut
    at `.,;:!?` and line ends into pieces and at spaces and tabs into words. A null lang is
    `und`, a null or empty text has no words; repeated rows count each; other columns are not
    looked at; an empty table gives no rows. Phrases of two or three words that occur LEAST
    times or more (`a`) are scored by floor(SCALE * a * a / (l * r)) of their lowest cut, ties
    by the shorter first part; those that a longer one holds in HIDES percent of their
    occurrences are left out; equal scores are ordered by a, then by the phrase's bytes.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text"))
    parts = max(1, texts.rdd.getNumPartitions())
    bits = min(16, max(8, (4 * parts - 1).bit_length()))
    words = cut(count_words(texts, bits))
    totals = words.where("payload is null").groupBy("lang").agg(F.sum("n").alias("n"))
    wanted = spark.sparkContext.broadcast(key_map(words, bits))
    twos = cut(candidates(texts, wanted, None, bits))
    pairs = spark.sparkContext.broadcast(key_map(twos, bits))
    threes = candidates(texts, wanted, pairs, bits)
    shards = cut(hash_shards(words.unionAll(twos).unionAll(threes), bits))
    sizes = {r["shard"]: (r["n"], r["phrases"]) for r in shards.select("shard", "n", "phrases").collect()}
    lots = passes([(shard, n) for shard, (n, _) in sizes.items()], slots)
    counted, held, offset = None, [], 0
    for lot in lots:
        part = {r["shard"]: bytes(r["payload"]) for r in (shards.where(F.col("shard").between(lot[0], lot[-1])).select("shard", "payload").collect() if lot else [])}
        ready = _Id(spark, part)
        blocks = cut(tree_sum(count_slots(texts, wanted, pairs, ready, bits), parts))
        if blocks.where("slot is not null").count() < sum(sizes[shard][1] for shard in lot):  # rows have changed tasks since: any task with a phrase sends its text
            blocks = cut(tree_sum(count_slots(texts, wanted, pairs, ready, bits, everyone=True), parts))
        n = sum(int.from_bytes(p[:4], "little") for p in part.values())
        counts = np.zeros(-(-n // BLOCK) * BLOCK, np.int64)
        for r in blocks.where("slot is null").select("block", "counts").toLocalIterator():
            counts[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = unpack_counts(r["counts"])
        numbers = spark.sparkContext.broadcast(counts.tobytes())
        rows = blocks.where("slot is not null").select((F.col("slot") + offset).alias("slot"), "lang", "phrase", "a")
        counted = rows if counted is None else counted.unionAll(rows)
        held.append((ready, numbers, offset))
        offset += n
    phrases = counted.select("*", F.lit(None).cast("array<long>").alias("parts"), F.lit(None).cast("array<long>").alias("inner"))
    for ready, numbers, at in held:
        phrases = read_cuts(phrases, ready, numbers, bits, at, last=at == held[-1][2])
    scored = cut(phrases)
    longer = scored.select(F.explode("inner").alias("slot"), "a").groupBy("slot").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, "slot", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < HIDES * F.col("a")))
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    dealt_ = kept.select("lang", "phrase", "a", "l", "r", "score", F.pmod(F.xxhash64("phrase"), F.lit(HEATS)).alias("heat"))
    heats = dealt_.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "heat").orderBy(*order))).where(F.col("rank") <= top)
    ranked = heats.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op11_collocations": op11_collocations}

_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
_GRAMS = " union all ".join(f"select lang, {k} as k, unnest(list_transform(range(1, len(ws) - {k - 2}), lambda i: ws[i:i + {k - 1}])) as g from w where len(ws) >= {k}" for k in (1, 2, 3))
ORACLE_SQL = {
    "op11_collocations": rf"""with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as t from documents),
        p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
        w as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from p),
        f as (select lang, k, g, count(*) as f from ({_GRAMS}) group by all), n as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by lang),
        c as (select lang, k, g, f as a from f where k > 1 and f >= {LEAST}),
        cuts as (select c.lang, c.k, c.g, c.a, j, l.f as l, r.f as r, (cast({SCALE} as hugeint) * a * a) // (cast(l.f as hugeint) * r.f) as score from c, (values (1), (2)) as o(j), f l, f r
            where j < c.k and l.lang = c.lang and l.g = c.g[1:j] and r.lang = c.lang and r.g = c.g[j + 1:c.k]),
        s as (select * from (select *, row_number() over (partition by lang, g order by score, j) as best from cuts) where best = 1),
        inside as (select lang, unnest([g[1:2], g[2:3]]) as g, a as longer from c where k = 3),
        kept as (select s.lang, array_to_string(s.g, ' ') as phrase, s.a, s.l, s.r, s.score from s left join (select lang, g, max(longer) as longer from inside group by lang, g) i on i.lang = s.lang and i.g = s.g where longer is null or 100 * longer < {HIDES} * s.a)
        select * from (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, cast(score as bigint) as score from kept join n using (lang)) where rank <= {TOP}"""
}
