"""Language identification with bit-sliced Bloom filters of character n-grams.

One table of cells holds bits for each language in each cell, so that a lookup of an n-gram
(the AND of PROBES cells) gives the mask of all languages that contain it. A language has a
bit for every n-gram that its texts hold, and further ones for n-grams that make up more
than certain shares of them (LEVELS). The bits found are counted per language over the whole
text and corrected for the rate at which strangers hit that language's filters; the greatest
corrected count decides, and among equal ones the language that sorts first.

Learning counts every n-gram of a bounded sample of labelled rows, per language, on the
executors; none is dropped. The table has CELLS cells for each n-gram of the richest
language, within MOST bytes, filled in blocks on the executors too; only finished blocks
reach the driver, and what is broadcast is bounded. A mask has as many words as the languages
need. Prediction is one narrow Arrow map; it sees the text only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarlattice.llm._common import cut, held_out, map_text, slices, table

#: Cells of the table for each n-gram of a language, probes per n-gram, orders of the n-grams, cells of a block (as powers of two: 2^16).
CELLS, PROBES, ORDERS, BLOCK = 8, 3, (2, 3, 4), 16
#: Least shares of a language's n-grams of one order for its bits; the first bit says that it has the n-gram at all.
LEVELS = (0.0, 3e-5, 3e-4)
#: Bound of the sample: about so many rows of each language; texts of more characters do not teach.
ROWS, LONGEST = 1500, 200_000

#: Bytes of the table at most: beyond them cells are shared by more n-grams, which raises the rate at which strangers hit them, and that is corrected for.
MOST = 1 << 26

#: Characters of texts whose n-grams are looked up together.
GROUP = 1 << 19

_LETTER: np.ndarray | None = None
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, other characters as one 0 between words; and where each text starts."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    parts = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    points = np.concatenate(parts)
    owner = np.repeat(np.arange(len(texts)), [p.size for p in parts])
    points = np.where(_LETTER[points], points, 0)
    keep = np.r_[True, (points[1:] != 0) | (points[:-1] != 0) | (owner[1:] != owner[:-1])]
    points, owner = points[keep], owner[keep]
    return points, np.searchsorted(owner, np.arange(len(texts) + 1))


def grams(points: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the n-grams that start at each place but the last order - 1."""
    n = points.size - order + 1
    h = np.full(max(n, 0), np.uint64(order * int(_ODD[3]) % 2**64))
    for k in range(order if n > 0 else 0):
        h = (h ^ points[k : k + n].astype(np.uint64)) * _ODD[k % 3]
        h ^= h >> np.uint64(29)
    return h


def spans(points: np.ndarray, starts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams within texts that hold a letter, and the text of each."""
    h = grams(points, order)
    if not h.size:
        return h, np.empty(0, np.int64)
    ends = np.repeat(starts[1:], np.diff(starts))[: h.size]
    owner = np.repeat(np.arange(starts.size - 1), np.diff(starts))[: h.size]
    some = np.zeros(h.size, bool)
    inner = np.ones(h.size, bool)
    for k in range(order):
        p = points[k : k + h.size] != 0
        some |= p
        if 0 < k < order - 1:
            inner &= p  # a word's end may stand at an n-gram's ends only
    ok = some & inner & (np.arange(h.size) + order <= ends)
    return h[ok], owner[ok]


def grouped(texts: list) -> list[list]:
    """Texts in order, in groups of about GROUP characters."""
    out, size = [], GROUP
    for t in texts:
        if size >= GROUP:
            out.append([])
            size = 0
        out[-1].append(t)
        size += len(t)
    return out


def layout(languages: int):
    """The type of a mask's words, their number, and the languages of a word."""
    kind = next((t for t in (np.uint8, np.uint16, np.uint32) if languages <= 8 * t().itemsize // len(LEVELS)), np.uint64)
    per = 8 * kind().itemsize // len(LEVELS)
    return kind, max(1, -(-languages // per)), per


def slots(h: np.ndarray, probe: int, bits: int) -> np.ndarray:
    """The cell of each hash for a probe, of 2^bits cells."""
    x = (h + np.uint64(probe * int(_ODD[3]) % 2**64)) * _ODD[probe % 3]
    return (x >> np.uint64(64 - bits)).astype(np.int64)


class Filter:
    """The bit-sliced filter: words of cells, the languages, and how often strangers hit each (all of its bits counted)."""

    def __init__(self, languages: list[str], bits: int = BLOCK, blocks: dict[int, bytes] | None = None):
        self.languages, self.bits = languages, bits
        self.kind, self.words, self.per = layout(len(languages))
        self.cells = np.zeros((1 << bits, self.words), self.kind)
        for i, data in (blocks or {}).items():
            self.cells[i << BLOCK : (i + 1) << BLOCK] = np.frombuffer(data, self.kind).reshape(-1, self.words)
        self.popcount = np.bitwise_count(np.arange(1 << len(LEVELS))).astype(np.float64)
        full = [[np.count_nonzero(self.of(self.cells, i) >> self.kind(k) & self.kind(1)) / len(self.cells) for k in range(len(LEVELS))] for i in range(len(languages))]
        self.strangers = (np.array(full).reshape(-1, len(LEVELS)) ** PROBES).sum(1)

    def of(self, masks: np.ndarray, i: int) -> np.ndarray:
        """The bits of language i."""
        return masks[:, i // self.per] >> self.kind(i % self.per * len(LEVELS)) & self.kind((1 << len(LEVELS)) - 1)

    def masks(self, h: np.ndarray) -> np.ndarray:
        out = self.cells[slots(h, 0, self.bits)]
        for probe in range(1, PROBES):
            out &= self.cells[slots(h, probe, self.bits)]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; n-grams of GROUP characters or one text are in memory at a time."""
        return self.predict_share(texts)[:2]

    def predict_share(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Beside language and score: the winner's corrected hits as a share of the text's own n-grams.

        Unlike the score, the share does not fall with the number of languages or with
        their likeness.
        """
        langs: list[str] = []
        scores: list[float] = []
        shares: list[float] = []
        for part in grouped([t or "" for t in texts]):
            lang, score, share = self._predict(part)
            langs += lang
            scores += score
            shares += share
        return langs, scores, shares

    def _predict(self, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
        points, starts = letters(texts)
        hits, total = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for order in ORDERS:
            h, owner = spans(points, starts, order)
            masks = self.masks(h)
            total += np.bincount(owner, minlength=len(texts))
            for i in range(len(self.languages)):
                hits[:, i] += np.bincount(owner, self.popcount[self.of(masks, i)], len(texts))
        true = np.maximum(0, (hits - total[:, None] * self.strangers) / np.maximum(1e-9, 1 - self.strangers / len(LEVELS)))
        has_letter = np.array([bool(np.any(points[a:b])) for a, b in zip(starts, starts[1:], strict=False)])
        all_ = true.sum(1)
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        best = true.argmax(1)
        share = np.where(has_letter, true[np.arange(len(texts)), best] / np.maximum(1, total * len(LEVELS)), 0.0)
        score = np.where(has_letter & (all_ > 0), true[np.arange(len(texts)), best] / np.maximum(all_, 1e-9), 0.0)
        return [self.languages[b] if ok else "und" for b, ok in zip(best, has_letter, strict=True)], [min(1.0, float(s)) for s in score], [min(1.0, float(s)) for s in share]


def fit(df: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", rows: int = ROWS) -> Filter:
    """Learn from labelled rows: about `rows` of each language, those with the least hashes of their ids.

    Rows without text or language teach nothing, nor do texts of more than LONGEST
    characters; no labelled rows give a filter that says "und" of every text.
    """
    known = df.where(F.col(lang_col).isNotNull() & (F.length(text_col) <= LONGEST)).select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Filter([])
    parts = 1 << 30
    below = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(int(min(1.0, rows / n) * parts)))])
    some = known.where(F.pmod(F.xxhash64("id", "lang"), F.lit(parts)) < below[F.col("lang")]).select("lang", "text")
    index = {lang: i for i, lang in enumerate(languages)}

    def collect(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                of_lang: dict[int, list[str]] = {}
                for lang, t in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    of_lang.setdefault(index[lang], []).append(t)
                for i, group in ((i, g) for i, ts in of_lang.items() for g in grouped(ts)):
                    points, starts = letters(group)
                    for order in ORDERS:
                        seen, n = np.unique(spans(points, starts, order)[0], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(seen.size, i, np.int32)), pa.array(np.full(seen.size, order, np.int32)), pa.array(seen.view(np.int64)), pa.array(n.astype(np.int64))], names=["i", "size", "gram", "n"])

    held = cut(some.mapInArrow(collect, "i int, size int, gram long, n long").groupBy("i", "size", "gram").agg(F.sum("n").alias("n")))
    totals = held.groupBy("i", "size").agg(F.sum("n").alias("all"), F.count("*").alias("kinds")).collect()  # a row for each language and order
    most = max((sum(r["kinds"] for r in totals if r["i"] == i) for i in range(len(languages))), default=0)
    kind, words, per = layout(len(languages))
    bits = max(BLOCK, min(int(np.ceil(np.log2(max(1, CELLS * most)))), int(np.log2(MOST // (words * kind().itemsize)))))
    all_of = np.ones((len(languages), max(ORDERS) + 1))
    for r in totals:
        all_of[r["i"], r["size"]] = r["all"]

    def place(batches):
        """(block, cell in it, word, its bits) for each probe of each n-gram."""
        for batch in batches:
            i, size, h, n = (batch.column(k).to_numpy() for k in range(4))
            share = n / all_of[i, size]
            own = sum((share >= least).astype(np.int64) << k for k, least in enumerate(LEVELS)) << (i % per * len(LEVELS))
            for probe in range(PROBES):
                at = slots(h.view(np.uint64), probe, bits)
                columns = ((at >> BLOCK).astype(np.int32), (at & ((1 << BLOCK) - 1)).astype(np.int32), (i // per).astype(np.int32), own)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "cell", "word", "own"])

    def fill(batches):
        """Finished blocks: those of a partition are in order, so one is held at a time."""
        block, cells = None, None
        for batch in batches:
            b, c, w, own = (batch.column(k).to_numpy() for k in range(4))
            for one in np.unique(b):
                if one != block:
                    if block is not None:
                        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "data": [cells.tobytes()]})
                    block, cells = int(one), np.zeros((1 << BLOCK, words), kind)
                here = b == one
                np.bitwise_or.at(cells, (c[here], w[here]), own[here].astype(kind))
        if block is not None:
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "data": [cells.tobytes()]})

    blocks = held.mapInArrow(place, "block int, cell int, word int, own long").repartition("block").sortWithinPartitions("block").mapInArrow(fill, "block int, data binary")
    return Filter(languages, bits, {r["block"]: r["data"] for r in blocks.collect()})


def identify(df: DataFrame, model: Filter, text_col: str = "text", keep_text: bool = False, share: bool = False) -> DataFrame:
    """Append lang_pred and score (0 to 1: the winner's part of the corrected counts) to every row.

    With `share`, also share (0 to 1: the winner's part of the text's own n-grams). A text
    that is null or has no letter is `und` with score 0; one without a hit has score 0 too.
    Equal counts go to the language that sorts first. Long texts are read whole. Rows stay
    as they are, with repeats and nulls; columns named like the new ones are replaced; an
    empty table stays empty.
    """
    added = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())] + [T.StructField("share", T.DoubleType())] * share)
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        return dict(zip(added.names, held.value.predict_share(batch.column(text_col).to_pylist()), strict=False))

    return map_text(df, run, added, text_col, keep_text)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)


QUERIES = {"op6_language_id": op6_language_id}
ORACLE_SQL: dict[str, str] = {}
