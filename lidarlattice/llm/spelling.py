"""Grouping of spelling variants by a rare-first prefix filter over positional bigrams.

Two words that differ by one inserted, deleted or replaced character share all but two of
either's bigrams (all but one of the shorter word's), each at the same place or one further
along, in the same order. Order all bigrams of a word by (frequency of the bigram among the
words, bigram, place). The matched bigrams of two near words come in the same order in both,
and only unmatched ones, which touch the edit, stand before the first of them. So that one is
among the three first of either word, and among the two first of a word that lacks a
character; and it comes third only if the two before it are neighbours.

What stands before it says on which side of it the edit is, and all of the word on the other
side is the same in both. So the rarest bigrams are joined on the word's length, the side,
the place and that whole part of the word, which ends or starts with the bigram:

* words of equal length: the same part at the same place;
* a word and one that is longer by one: the same part at the same place if it leads up to the
  bigram, and at the next place if it follows.

Where nothing stands before the bigram the edit may be on either side, and both parts are
joined. What meets is verified. Rare bigrams and whole parts keep the groups small, and
Spark splits what stays skewed. Frequencies are those of whole bigrams, of which there are
90 x 90 at most, so the order is a table of bounded size.

Counting words is a narrow map with a bounded table of counts in each task, and one sum.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarlattice.llm._common import cut, table

#: One run in so many is disturbed by a lost character; least characters and occurrences of a word; how much more frequent a form is.
LOSES, LEAST_CHARS, LEAST_COUNT, TIMES = 97, 5, 3, 2
#: Different words that a task counts before it sends them on.
KEPT = 500_000
#: Rarest bigrams of a word that are joined: one edit spoils two.
PREFIX = 3
#: Forms grow by TIMES from one to the next, and a count is below 2 ** 63, so chains are shorter than 2 ** ROUNDS.
ROUNDS = 6

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def lower(run: str) -> str:
    """A to Z only."""
    return run.lower() if run.isascii() else run.translate(_LOWER)


def words_of(doc_id: int | None, text: str | None, loses: int = LOSES) -> Counter:
    """Words of one text with their occurrences: a run whose checksum with the id is a multiple of `loses` loses a character."""
    out: Counter = Counter()
    before = "" if doc_id is None else str(doc_id)
    for run, n in Counter(_RUN.findall(text or "")).items():
        word = lower(run)
        h = crc32(f"{before}:{word}".encode())
        if h % loses == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out[word] += n
    return out


def count_words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, loses: int = LOSES) -> DataFrame:
    """(word, n) of the words of at least so many characters and occurrences in docs (doc_id, text).

    Null texts have no words and a null id counts as empty text. Repeated rows count as
    often as they occur.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts.update(words_of(doc_id, text.as_py(), loses))
                if len(counts) >= KEPT:
                    yield sent(counts)
                    counts = Counter()
        if counts:
            yield sent(counts)

    def sent(counts):
        kept = [(w, n) for w, n in counts.items() if len(w) >= least_chars]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], schema=schema)

    counted = docs.select(F.col("doc_id").alias("c0"), F.col("text").alias("c1")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def bigram_order(words: DataFrame) -> list[str]:
    """All bigrams of the words, rarest first (ties by the bigram): 90 x 90 at most for words of the runs above."""
    at = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.where(F.length("word") > 1).select(F.explode(F.transform(at, lambda i: F.substr("word", i, F.lit(2)))).alias("gram"))
    return [r["gram"] for r in grams.groupBy("gram").agg(F.count("*").alias("n")).orderBy("n", "gram").collect()]


def rare_parts(word: str, rank: dict[str, int], most: int = PREFIX) -> list[tuple[str, int, str]]:
    """(side, place, part) of the `most` rarest bigrams of a word: the part up to each, for an edit after it ("<"), and from it on, for one before it (">")."""
    grams = sorted((rank[word[i : i + 2]], i) for i in range(len(word) - 1))[:most]
    places = [i for _, i in grams]
    out = []
    for k, i in enumerate(places):
        if k == 2 and abs(places[0] - places[1]) > 1:  # one edit cannot spoil both
            break
        before = places[:k]
        if all(j > i for j in before):
            out.append(("<", i, word[: i + 2]))
        if all(j < i for j in before):
            out.append((">", i, word[i:]))
    return out


def part_keys(words: DataFrame, order: list[str], asks: bool) -> DataFrame:
    """(word, n, key): 64-bit keys of a word's parts, those under which it is found, or those under which it asks for words as long as itself or longer by one."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("key", pa.int64())])

    def hashed(size, side, at, part):
        return xxhash.xxh3_64_intdigest(f"{size}{side}{at} {part}".encode()) - (1 << 63)

    def run(batches):
        rank = {g: i for i, g in enumerate(order)}
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                size = len(word)
                rows += [(word, n, hashed(size, *p)) for p in rare_parts(word, rank)]
                if asks:
                    rows += [(word, n, hashed(size + 1, side, at + (side == ">"), part)) for side, at, part in rare_parts(word, rank, PREFIX - 1)]
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return words.select("word", "n").mapInArrow(run, "word string, n long, key long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every word with each word that differs by exactly one inserted, deleted or replaced character, both ways.

    words: (word, n), each word once, of four characters or more (shorter ones have too few
    bigrams for the filter).
    """
    order = bigram_order(words)
    asks = part_keys(words, order, asks=True)
    has = part_keys(words, order, asks=False).select(F.col("word").alias("near"), F.col("n").alias("near_n"), "key")
    met = asks.join(has, "key")
    # equal lengths meet from both sides and count from one, as the pairs are turned round below
    met = met.where((F.length("word") < F.length("near")) | (F.col("word") < F.col("near")))
    near = met.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n").distinct()
    both = F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("p")
    return near.select(both).select("p.*")


def follow(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last by doubling; each round looks up the roots' roots."""
    roots = cut(forms.where("form is not null").select("word", F.col("form").alias("root")))
    for _ in range(ROUNDS):
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = cut(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    return roots


def group_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """words (word, n), each word once -> (word, form, root, n, n_near, form_n).

    A word's form is its near word of largest n (ties: smallest in code-point order) if that
    n is `times` the word's or more, else null; its root is where forms lead to (itself if
    it has none). n_near counts near words. An empty table stays empty.
    """
    near = near_pairs(words)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("b"))
    is_form = -F.col("b.m") >= F.col("n") * times
    named = words.select("word", "n").join(best, "word", "left").select("word", F.when(is_form, F.col("b.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, -F.col("b.m")).alias("form_n"))
    named = cut(named)
    return named.join(follow(named), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The words of docs (doc_id, text) with their forms and roots: count_words, then group_variants.

    Texts are read whole, of any length; null and empty ones have no words; repeated rows
    count each; other columns of whatever name are not looked at; an empty table gives no
    rows.
    """
    return group_variants(cut(count_words(docs)))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op12_spelling_variants": op12_spelling_variants}
#: SQL has no CRC-32 here; tests hold the query against brute force.
ORACLE_SQL: dict[str, str] = {}
