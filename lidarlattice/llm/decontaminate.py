"""Benchmark decontamination on templates: typed placeholders, a hash join of windows, slot consistency.

Words are put in lower case; numbers, units after numbers ("12 km" and "12km") and names
become placeholders, so that a question whose numbers and names were changed keeps its
template. A name is a run of capitalised words, one placeholder whose slot holds the whole
run; a capitalised word that opens a sentence belongs to it unless it is one of OPENERS.
Windows of WINDOW template words are hashed. A bitmap of fixed size over the benchmark's
hashes thins the documents' windows where they are made; those left are hash-joined with
the benchmark's windows. For each document, item and alignment the slots must agree: one
value of the item always meets the same value of the document, and different values meet
different ones. Windows of consistent alignments count; a document is contaminated by an
item of which they cover MIN_COVER or more.

Windows with few literal words say too little as templates. So every item is also indexed
by its plain words, in windows of the same width, whose values are in the hash: a copy word
for word is always found. They decide alone for items without a window of enough literal
words, again from MIN_COVER on; of other items all of them must be found, so that partial
copies stay with the rule of the slots. Scripts without spaces are cut into characters.

Stock phrases that many items and many documents share make no pairs by themselves: an item
needs a share of its windows, so one of its rarest windows must be among them, and only
those look for candidates. The windows of candidates are then joined by document and item.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lidarlattice.llm._common import cut, few, slices, table

#: Words of a window, words of it that must be literal, least share of an item's windows, bits of the bitmap (a power of two).
WINDOW, LITERAL, MIN_COVER, BITS = 6, 4, 0.3, 26
#: Words of a table that a worker keeps, characters of texts that are handled together, and windows that are sent on together.
KEPT, GROUP, PART = 60_000, 1 << 20, 16_384

UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years l ml liter liters litre litres gallon gallons cup cups degree degrees percent dollar dollars cent cents euro euros usd eur "
    "kmh mph km/h m/s kw kwh w v hz".split()
)
#: Words that open sentences without being names.
OPENERS = frozenset(
    "a an the this that these those it its he she we they you i his her their our my your there here what which who whom whose when where why how if then so but and or nor yet for of in on at by to from with without after before during while "
    "since until because although though as each every all both some any no not many much more most few several one two three is are was were be do does did can could will would shall should may might must let find given suppose assume "
    "calculate compute write explain describe show prove consider use choose select name list answer solve "
    "le la les un une des du de ce cette il elle on nous vous ils elles et ou si dans pour avec est que qui quel quelle quand comment pourquoi "
    "el los las una unos unas y o en con por para es que cual cuando como donde se su "
    "der die das ein eine einen einem einer und oder wenn in im mit auf er sie es wir ihr ist sind was wer wie wo wann warum welche welcher".split()
)
_NUMBER = re.compile(r"[+\-$€£#]?\d[\d.,:/%]*(?:st|nd|rd|th)?[%€$£]?\Z")
_GLUED = re.compile(r"([+\-]?\d[\d.,]*)([^\W\d_]+(?:/[a-z]+)?)\Z")
_EDGE = re.compile(r"^[^\w$€£#+\-]+|[^\w%€$£]+$")
_BREAK = "\x1e"
#: A character of a script without spaces between words: Thai to Burmese, Khmer, kana, Han.
_DENSE = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])")
#: Flags in the low bits of a word's code; the rest of the code is its hash, 0 for no word.
CAPITAL, NUMBER, UNIT, ENDS, STOPS, OPENS, GLUED = 1, 2, 4, 8, 16, 32, 64
_BITS = 7
_MASK = (1 << 64) - (1 << _BITS)
_TYPED = {k: np.uint64(xxhash.xxh64_intdigest(f"<{k}>") & _MASK) for k in ("number", "unit", "name")}


class Templates:
    """Codes of raw words, two generations of a bounded table."""

    def __init__(self):
        self.young: dict[str, int] = {_BREAK: ENDS | STOPS}
        self.old: dict[str, int] = {}

    def code(self, raw: str) -> int:
        known = self.old.get(raw)
        if known is None:
            mark = "" if raw.isalpha() else raw[-1] if raw[:-1].isalpha() and raw[-1] in ".,!?:;" else None
            if mark is not None:  # letters, and a mark at most
                word, number = raw[: len(raw) - len(mark)], False
                known = (STOPS if mark == "," else ENDS | STOPS) if mark else 0
            else:
                word = _EDGE.sub("", raw)
                number = _NUMBER.match(word) is not None
                known = ENDS | STOPS if raw[-1] in ".!?:;" or raw.rstrip("\"')]»”").endswith((".", "!", "?")) else STOPS if raw[-1] in ",)]" else 0
                if not number and (parts := _GLUED.match(word)) and parts[2].lower() in UNITS:
                    known |= GLUED
            if mark is not None or any(map(str.isalnum, word)):
                low = word.lower()
                known |= xxhash.xxh64_intdigest(low) & _MASK or 1 << _BITS
                known |= NUMBER if number else 0
                known |= UNIT if low in UNITS else 0
                known |= CAPITAL if word != low and word[0].isupper() and word[1:] == low[1:] else 0
                known |= OPENS if low in OPENERS else 0
        if len(self.young) >= KEPT:
            self.old, self.young = self.young, {_BREAK: ENDS | STOPS}
        known = known or NUMBER  # of no word: never 0, so that it is found again
        self.young[raw] = known
        return known

    def read(self, texts: list[str | None]):
        """Words of texts, as templates and plain: each with hashes, owners, whether they are slots, and the raw words that each stands for."""
        raws, counts = [], []
        for t in texts:
            t = t or ""
            if not t.isascii() and _DENSE.search(t):
                t = _DENSE.sub(r" \1 ", t)
            words = t.replace("\n", f" {_BREAK} ").split()
            raws += words
            counts.append(len(words))
        get, code = self.young.get, self.code
        v = np.fromiter([get(r) or code(r) for r in raws], np.uint64, len(raws))
        owner = np.repeat(np.arange(len(texts)), counts)
        if (v & np.uint64(GLUED)).any():  # a number and its unit in one word become two
            glued = (v & np.uint64(GLUED) > 0).tolist()
            raws = [p for r, g in zip(raws, glued, strict=True) for p in (self.parts(r) if g else (r,))]
            owner = np.repeat(owner, 1 + np.array(glued))
            v = np.fromiter([get(r) or code(r) for r in raws], np.uint64, len(raws))
        flags = (v & np.uint64((1 << _BITS) - 1)).astype(np.int16)
        starts = np.r_[True, (flags[:-1] & ENDS > 0) | (owner[1:] != owner[:-1])] if len(raws) else np.empty(0, bool)
        stops = np.r_[True, flags[:-1] & STOPS > 0] if len(raws) else starts
        # a word after a token without letters (a dash, a bracket) starts a sentence, or ends a run, if that token does
        at = np.flatnonzero(v >> np.uint64(_BITS) > 0)
        since = lambda marks: np.r_[True, (seen := np.cumsum(marks))[at[1:]] > seen[at[:-1]]] if at.size else np.zeros(0, bool)
        first, apart = since(starts), since(starts | stops)
        flags, h, owner = flags[at], v[at] & np.uint64(_MASK), owner[at]
        plain = h, owner, np.zeros(h.size, bool), at, at + 1
        number = flags & NUMBER > 0
        after = np.r_[False, number[:-1] & (owner[1:] == owner[:-1])] if at.size else number
        unit = (flags & UNIT > 0) & after & ~number
        name = (flags & CAPITAL > 0) & ~(first & (flags & OPENS > 0)) & ~unit & ~number
        h = np.where(number, _TYPED["number"], np.where(unit, _TYPED["unit"], np.where(name, _TYPED["name"], h)))
        keep = ~(name & np.r_[False, name[:-1]] & ~apart) if at.size else name
        kept = np.flatnonzero(keep)
        ends = at[np.r_[kept[1:], at.size] - 1] + 1 if at.size else at
        return len(texts), raws, (h[keep], owner[keep], (number | unit | name)[keep], at[keep], ends), plain

    @staticmethod
    def parts(raw: str) -> tuple[str, str]:
        """A number and the unit glued to it, each with the marks on its side."""
        at = next(i for i, c in enumerate(raw) if c.isdigit())
        while raw[at].isdigit() or raw[at] in ".,":
            at += 1
        return raw[:at], raw[at:]

    @staticmethod
    def windows(read, width: int = WINDOW, plain: bool = False):
        """Windows of read() texts: hashes, owners, places, whether enough is literal, what slots() needs, and words of each text."""
        texts, raws, *kinds = read
        h, owner, slot, at, ends = kinds[plain]
        n = max(0, h.size - width + 1)
        g = np.zeros(n, np.uint64)
        for k in range(width):
            g = (g ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            g ^= g >> np.uint64(31)
        typed = np.r_[0, np.cumsum(slot)]
        ok = (owner[:n] == owner[width - 1 :]) & (width - (typed[width:] - typed[:n]) >= min(LITERAL, width)) if n else np.empty(0, bool)
        begin = np.searchsorted(owner, np.arange(texts + 1))
        return g, owner[:n], np.arange(n) - begin[owner[:n]], ok, (raws, at, ends, slot), np.diff(begin)

    @staticmethod
    def slots(i: int, width: int, state) -> list[str]:
        """Raw values of the slots of the window at i, in order: a name's are all words of its run."""
        raws, at, ends, slot = state
        return [" ".join(filter(None, (_EDGE.sub("", r).lower() for r in raws[at[k] : ends[k]]))) for k in range(i, i + width) if slot[k]]


_TEMPLATES: list[Templates] = []


def _templates() -> Templates:
    """The worker's table, kept from task to task."""
    if not _TEMPLATES:
        _TEMPLATES.append(Templates())
    return _TEMPLATES[0]


def _grouped(texts: list) -> list[tuple[int, list]]:
    """Texts in order, in groups of about GROUP characters, each with its offset."""
    out, size = [], GROUP
    for i, t in enumerate(texts):
        if size >= GROUP:
            out.append((i, []))
            size = 0
        out[-1][1].append(t)
        size += len(t or "")
    return out


_HITS = "id long, key long, place int, h long, width int, slots array<string>"


def _windows(df: DataFrame, widths: list[int], bitmap=None) -> DataFrame:
    """Rows (id, key, text) -> windows, those only whose bit is set where a bitmap is given. Widths of plain words are negative."""

    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.string()))

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["id", "key", "place", "h", "width", "slots"])

    def run(batches):
        templates = _templates()
        for batch in batches:
            for part in slices(batch, "text"):
                ids, keys, texts = (part.column(c).to_pylist() for c in ("id", "key", "text"))
                rows: list[tuple] = []
                for offset, group in _grouped(texts):
                    read = templates.read(group)
                    for width in widths:
                        g, owner, place, ok, state, _ = templates.windows(read, abs(width), width < 0)
                        if bitmap is not None:
                            bit = g >> np.uint64(64 - BITS)
                            ok &= bitmap.value[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1) > 0
                        hashes = g.view(np.int64)
                        for i in np.flatnonzero(ok).tolist():
                            k = offset + int(owner[i])
                            rows.append((ids[k], keys[k], int(place[i]), int(hashes[i]), width, templates.slots(i, abs(width), state)))
                            if len(rows) >= PART:
                                yield pack(rows)
                                rows = []
                if rows:
                    yield pack(rows)

    return df.mapInArrow(run, _HITS)


def _sizes(items: DataFrame) -> DataFrame:
    """Template words and plain words of each item."""

    def run(batches):
        templates = _templates()
        for batch in batches:
            for part in slices(batch, "text"):
                read = templates.read(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("key"), *(pa.array(templates.windows(read, 1, plain)[5].astype(np.int32)) for plain in (False, True))], names=["key", "words", "plain"])

    return items.select("key", "text").mapInArrow(run, "key long, words int, plain int")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Documents with a benchmark item in them: (key, id, item_id, cover, n_windows, reparameterised), a row per document and item.

    key is a hash of the text, so that rows that repeat share their result. An item of
    fewer words than a window is one window; items without words match nothing, items with
    too few literal words match their plain words only. Null texts count as empty; an item whose id is null matches as
    null.
    """
    text = F.coalesce(F.col(item_text_col), F.lit(""))
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    sizes = cut(_sizes(items.dropDuplicates(["key"])).where("words > 0"))
    wanted = sizes.select(F.col("key").alias("k"), F.explode(F.array(F.least("words", F.lit(WINDOW)), -F.least("plain", F.lit(WINDOW)))).alias("w"))
    widths = sorted({WINDOW, -WINDOW} | {r["w"] for r in wanted.select("w").distinct().collect()})  # 2 * WINDOW of them at most
    index = cut(_windows(items.dropDuplicates(["key"]), widths).join(wanted, (F.col("key") == F.col("k")) & (F.col("width") == F.col("w"))).select(F.col("key").alias("item_key"), F.col("place").alias("item_place"), "h", "width", F.col("slots").alias("item_slots")))

    cells = F.shiftrightunsigned("h", 64 - BITS)
    cell = index.select(F.shiftright(cells, 6).alias("cell"), F.expr("shiftleft(1L, cast(shiftrightunsigned(h, %d) & 63 as int))" % (64 - BITS)).alias("bit"))
    set_ = cell.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toPandas()  # 2^(BITS - 6) rows at most, whatever the benchmark
    bitmap = np.zeros(1 << (BITS - 6), np.uint64)
    bitmap[set_["cell"].to_numpy(np.int64)] = set_["bits"].to_numpy(np.int64).view(np.uint64)
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    body = F.coalesce(F.col(text_col), F.lit(""))
    hits = cut(_windows(docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(body).alias("key"), body.alias("text")), widths, held))

    # of n places of an item, more than n - least must be rare for one of them to be among any `least` that are found
    plain = F.col("width") < 0
    both = Window.partitionBy("item_key")
    shared = index.groupBy("h", "width").agg(F.count("*").alias("shared"))
    order = Window.partitionBy("item_key", plain).orderBy("shared", "h", "item_place")
    n = F.count("*").over(Window.partitionBy("item_key", plain))
    least = F.ceil(n * F.when(plain & (F.max(~plain).over(both)), 1.0).otherwise(MIN_COVER) - 1e-9)
    rare = index.join(shared, ["h", "width"]).select("h", "width", "item_key", F.row_number().over(order).alias("rank"), n.alias("n"), least.alias("least")).where("rank <= n - least + 1")
    found = hits.join(rare.select("h", "width", "item_key").distinct(), ["h", "width"]).select("key", "id", "item_key").distinct()
    candidates = found.select(F.col("key").alias("k"), F.col("id").alias("i"), "item_key")
    pairs = hits.join(candidates, (F.col("key") == F.col("k")) & _same("id", "i")).drop("k", "i").join(index, ["h", "width", "item_key"]).where(F.size("slots") == F.size("item_slots"))
    slot_pairs = F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b"))
    aligned = (
        pairs.withColumn("values", slot_pairs)
        .groupBy("key", "id", "item_key", (F.col("width") < 0).alias("plain"), (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(F.collect_set("item_place").alias("places"), F.array_distinct(F.flatten(F.collect_set("values"))).alias("values"))
        .withColumn("a", F.size(F.array_distinct(F.transform("values", lambda x: x["a"]))))
        .withColumn("b", F.size(F.array_distinct(F.transform("values", lambda x: x["b"]))))
        .where((F.col("a") == F.size("values")) & (F.col("b") == F.size("values")))
        .withColumn("changed", F.exists("values", lambda x: x["a"] != x["b"]))
    )
    per_item = aligned.groupBy("key", "id", "item_key", "plain").agg(F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("n_windows"), F.min("changed").alias("reparameterised"))
    places = [F.size(F.collect_set(F.when((F.col("width") < 0) == plain, F.col("item_place")))).alias(n) for n, plain in (("n_typed", False), ("n_plain", True))]
    totals = index.groupBy("item_key").agg(*places)
    named = items.select(F.col("key").alias("item_key"), F.col("id").alias(item_col)).distinct()
    return (
        per_item.join(totals, "item_key")
        .withColumn("cover", F.col("n_windows") / F.when(F.col("plain"), F.col("n_plain")).otherwise(F.col("n_typed")))
        .where(F.col("cover") >= F.when(F.col("plain") & (F.col("n_typed") > 0), 1.0).otherwise(MIN_COVER))
        .groupBy("key", "id", "item_key")
        .agg(F.min(F.struct("plain", "cover", "n_windows", "reparameterised")).alias("by"))  # templates first
        .join(named, "item_key")
        .select("key", "id", item_col, "by.cover", F.col("by.n_windows").cast("long").alias("n_windows"), "by.reparameterised")
    )


def _same(left: str, right: str):
    return F.col(left).eqNullSafe(F.col(right))


def mark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Every document with its verdict: id, contaminated, item_ids (sorted), n_windows, reparameterised.

    Every row of `docs` gives one row; nulls and repeats stay; without a benchmark no
    document is contaminated. Other columns are left out.
    """
    found = contamination(docs, benchmark, id_col, text_col, item_col)
    per_doc = found.groupBy(F.col("key").alias("k"), F.col("id").alias("i")).agg(F.array_sort(F.collect_set(item_col)).alias("item_ids"), F.sum("n_windows").alias("n_windows"), F.max("reparameterised").alias("reparameterised"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"))
    return rows.join(per_doc, (F.col("key") == F.col("k")) & _same("id", "i"), "left").select(
        F.col("id").alias(id_col),
        F.col("k").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"),
        F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that no benchmark item contaminates, with all their columns, whatever their names.

    Only the keys of contaminated rows meet the texts: as a broadcast where they are few, in
    a join otherwise.
    """
    bad = cut(contamination(docs, benchmark, id_col, text_col).select(F.col("key").alias("k"), F.col("id").alias("i")).distinct())
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"), F.col(id_col).cast("long").alias("id"))
    return packed.join(few(bad), (F.col("key") == F.col("k")) & _same("id", "i"), "left_anti").select("doc.*")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_decontaminate": op1_decontaminate}
ORACLE_SQL: dict[str, str] = {}
