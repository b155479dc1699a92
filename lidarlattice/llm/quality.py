"""Quality scores by nearest-neighbour voting in a latent-semantic space.

The terms of a text are its words and word pairs (hashed), n-grams of character classes
(letters by case, digits, white space, each mark of punctuation as itself) and a few terms
for how much its words and lines repeat: what it says, and what tells prose from tables,
shouting, markup debris and filler. Term counts are damped and weighted by inverse document
frequency, and a truncated SVD of the labelled texts gives the latent space. The labelled
vectors are broadcast (LABELLED rows at most), every text's cosine with every one of them is
computed in blocks, and the NEIGHBOURS nearest vote with their labels, weighted by
similarity. Cosines count to six digits; among equal ones the labelled row that comes first
(by id and text) is nearer.

Only the fit uses labels, from a bounded sample of rows of the learning folds, whose whole
texts become terms on the executors; scoring is one narrow Arrow map over whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarlattice.llm._common import held_out, map_text, slices, table

#: Rank of the space, labelled rows that are kept about, neighbours that vote, and how steeply similarity counts.
RANK, LABELLED, NEIGHBOURS, STEEP = 64, 4000, 25, 8
#: Hashed terms of character classes, of words, of word pairs; terms that are not hashed: repetition in steps.
SHAPES, WORDS, PAIRS, EXTRA = 4032, 2048, 2048, 64
TERMS = SHAPES + WORDS + PAIRS + EXTRA
ORDERS = (1, 2, 3, 4)
#: Weight of words and pairs beside the shapes.
TOPIC = 0.5
#: Words whose hashes a worker keeps.
KEPT = 200_000

_CLASS: np.ndarray | None = None
_HASHES: dict[str, int] = {}


def classes() -> np.ndarray:
    """The class of each code point: 0 none, 1 lower, 2 upper, 3 other letter, 4 digit, 5 space, 6 line end, ASCII marks as they are, 7 others."""
    global _CLASS
    if _CLASS is None:
        table_ = np.full(0x110000, 7, np.uint8)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                table_[i] = 1 if c.islower() else 2 if c.isupper() else 3
            elif c.isdigit() or c.isspace() or i < 127:
                table_[i] = 4 if c.isdigit() else 6 if c in "\n\r" else 5 if c.isspace() else i if i > 32 else 7
        _CLASS = table_
    return _CLASS


def _hash(word: str) -> int:
    if len(_HASHES) >= KEPT:
        _HASHES.clear()
    _HASHES[word] = h = xxhash.xxh32_intdigest(word)
    return h


def _step(share: float) -> int:
    return min(15, int(share * 16))


def term_counts(text: str | None) -> np.ndarray:
    """Damped counts of the terms of a text; a text without words has one extra term of its own."""
    out = np.zeros(TERMS, np.float32)
    text = text or ""
    words = text.split()
    if not words:
        out[TERMS - 1] = 1
        return out
    c = classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    # a run of lower-case letters counts as one, so that these terms show how words look and not how long they are
    c = c[np.r_[True, (c[1:] != c[:-1]) | (c[1:] != 1)]].astype(np.uint32)
    h = np.zeros(c.size, np.uint32)
    for order in range(1, max(ORDERS) + 1):
        h = (h[: c.size - order + 1] * np.uint32(0x01000193)) ^ (c[order - 1 :] + np.uint32(order << 8))
        if not h.size:
            break
        slot = (h * np.uint32(0x9E3779B1) >> np.uint32(8)) % np.uint32(SHAPES)
        out[:SHAPES] += np.bincount(slot, minlength=SHAPES).astype(np.float32)
    out[:SHAPES] = np.log1p(out[:SHAPES] * (400 / c.size))
    known, n = _HASHES.get, len(words)
    w = np.fromiter([known(x) or _hash(x) for x in text.lower().split()], np.uint32)
    pairs = (w[:-1] * np.uint32(0x85EBCA6B)) ^ w[1:]
    at = SHAPES
    for values, size in ((w, WORDS), (pairs, PAIRS)):
        if values.size:
            counts = np.bincount((values * np.uint32(0x9E3779B1) >> np.uint32(8)) % np.uint32(size), minlength=size)
            out[at : at + size] = TOPIC * np.log1p(counts * (100 / values.size))
        at += size
    lines = text.split("\n")
    kinds, same = np.unique(w).size, int(np.count_nonzero(w[1:] == w[:-1]))
    for k, share in enumerate((1 - kinds / n, 1 - np.unique(pairs).size / max(1, pairs.size), same / n, 1 - len(set(lines)) / len(lines))):
        if k < 3:
            out[at + 16 * k + _step(share)] = 3.0
        elif share > 0:
            out[at + 48 + min(14, _step(share))] = 1.0
    return out


class Sparse:
    """Rows of terms, each as the places and values that are not zero (bytes); a block of them at a time becomes a matrix."""

    def __init__(self, rows: list[tuple[bytes, bytes]]):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, some: slice) -> np.ndarray:
        rows = self.rows[some]
        out = np.zeros((len(rows), TERMS), np.float32)
        for line, (at, x) in zip(out, rows, strict=True):
            line[np.frombuffer(at, np.int16)] = np.frombuffer(x, np.float32)
        return out


class Voter:
    """Term weights, the projection, and the labelled vectors with their labels."""

    #: Labelled rows that are a matrix at a time.
    BLOCK = 256

    def __init__(self, terms: np.ndarray | Sparse, labels: list[int], rank: int = RANK, seed: int = 11):
        """`terms` has a row of term_counts() for each label."""
        self.labels = np.array(labels, np.float32)
        n = len(terms)
        if not n:
            return
        spans = [slice(a, min(a + self.BLOCK, n)) for a in range(0, n, self.BLOCK)]
        self.idf = (np.log((1 + n) / (1 + sum(np.count_nonzero(terms[s], axis=0) for s in spans))) + 0.2).astype(np.float32)

        def weighted():
            for s in spans:
                x = terms[s] * self.idf
                x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-9)[:, None]
                yield s, x

        def onto(right: np.ndarray) -> np.ndarray:
            return np.concatenate([x @ right for _, x in weighted()])

        def back(left: np.ndarray) -> np.ndarray:
            return sum(x.T @ left[s] for s, x in weighted())

        rank = min(rank, n, TERMS)
        draw = np.random.default_rng(seed).standard_normal((TERMS, min(rank + 10, n))).astype(np.float32)
        basis, _ = np.linalg.qr(onto(draw))
        for _ in range(3):  # power iterations of the randomised SVD
            basis, _ = np.linalg.qr(onto(back(basis)))
        _, _, right = np.linalg.svd(back(basis).T, full_matrices=False)
        self.project = np.ascontiguousarray(right[:rank].T)
        self.vectors = np.ascontiguousarray(self.unit(onto(self.project)).T)

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str | None], block: int = 512, neighbours: int = NEIGHBOURS) -> list[float]:
        """Each text's vote, 0 to 1; without labelled rows every text gets 0.5."""
        if not self.labels.size:
            return [0.5] * len(texts)
        out: list[float] = []
        k = min(neighbours, self.labels.size)
        for at in range(0, len(texts), block):
            x = np.stack([term_counts(t) for t in texts[at : at + block]])
            v = self.unit(self.unit(x * self.idf) @ self.project)
            near = v @ self.vectors
            # whole numbers that differ: the similarity, and then the place of the labelled row
            near = np.rint(near.astype(np.float64) * 1e6)
            rank = near.astype(np.int64) * self.labels.size - np.arange(self.labels.size)
            top = np.sort(np.argpartition(rank, near.shape[1] - k, axis=1)[:, -k:], axis=1)
            w = np.maximum(np.take_along_axis(near, top, 1) / 1e6, 1e-3) ** STEEP
            out += ((w * self.labels[top]).sum(1) / w.sum(1)).astype(float).tolist()
        return [min(1.0, max(0.0, s)) for s in out]


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, rows: int) -> DataFrame:
    """About `rows` labelled texts (id, t, y), as many of each label as there are or half of `rows`, by least hash of the id.

    `labels` is joined first and thinned before it meets the texts, so the join's small
    side is bounded whatever the size of the corpus.
    """
    given = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("lid")).agg(F.max(label_col).cast("int").alias("y"))
    sizes = {r["y"]: r["count"] for r in given.groupBy("y").count().collect()}
    parts = 1 << 30
    few = min(sizes.values(), default=0)
    want = {y: max(rows // 2, rows - few) if n > few else rows // 2 for y, n in sizes.items()}
    below = F.lit(0)
    for y, n in sizes.items():
        below = F.when(F.col("y") == y, F.lit(int(min(1.0, want[y] / n) * parts))).otherwise(below)
    some = given.where(F.pmod(F.xxhash64("lid"), F.lit(parts)) < below)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("lid"), F.col(text_col).alias("t"))
    return texts.join(F.broadcast(some), "lid")  # bounded where labelled ids do not repeat; the callers' limits bind where they do


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = LABELLED) -> Voter:
    """Fit on about `rows` labelled rows of the learning folds (those not held out); whole texts become terms where they are."""

    def count(batches):
        for batch in batches:
            for part in slices(batch, "t"):
                terms = [term_counts(t) for t in part.column("t").to_pylist()]
                at = [np.flatnonzero(x).astype(np.int16) for x in terms]
                columns = [part.column("lid").cast(pa.string()), part.column("y").cast(pa.int32()), pa.array([a.tobytes() for a in at], pa.binary()), pa.array([x[a].tobytes() for x, a in zip(terms, at, strict=True)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["lid", "y", "at", "x"])

    some = labelled(docs.where(~held_out(id_col)), labels.where(~held_out(id_col)), label_col, id_col, text_col, rows)
    got = sorted(some.mapInArrow(count, "lid string, y int, at binary, x binary").limit(2 * rows).collect(), key=lambda r: (r["lid"], r["at"], r["x"], r["y"]))
    return Voter(Sparse([(bytes(r["at"]), bytes(r["x"])) for r in got]), [r["y"] for r in got])


def score_texts(df: DataFrame, model, text_col: str = "text", threshold: float = 0.3, keep_text: bool = False) -> DataFrame:
    """Append score (0 to 1) and predicted (1 if score >= threshold) to every row.

    Null and empty texts are scored like any other, as a text without words; long ones are
    read whole. Rows are neither dropped nor moved; repeats and null ids stay; columns named
    like the new ones are replaced; an empty table stays empty.
    """
    added = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    held = df.sparkSession.sparkContext.broadcast(model)  # bounded by the sample, the rank and the terms

    def run(batch):
        scores = held.value.score(batch.column(text_col).to_pylist())
        return {"score": scores, "predicted": [int(s >= threshold) for s in scores]}

    return map_text(df, run, added, text_col, keep_text)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return score_texts(docs.select("doc_id", held_out().alias("held_out"), "text"), model)


QUERIES = {"op8_quality": op8_quality}
ORACLE_SQL: dict[str, str] = {}
