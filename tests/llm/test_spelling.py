"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

from lidarlattice.llm import spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced code point, straight from the definition."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    return grouped(counts)


def grouped(counts):
    forms, out = {}, []
    for w, n in counts.items():
        others = [v for v in counts if abs(len(v) - len(w)) < 2 and v != w and near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = (best if best is not None and counts[best] >= 2 * n else None, len(others))
    for w, (form, n_near) in forms.items():
        root = w
        while forms[root][0] is not None:
            root = forms[root][0]
        out.append((w, form, root, counts[w], n_near, None if form is None else counts[form]))
    return sorted(out)


def test_small_rows(spark):
    rows = [(1, "Colour colour COLOR color " * 4), (1, "Colour colour COLOR color " * 4), (None, "colours colours colours colour"), (3, None), (4, ""), (5, "École école Ecole ecole école École ÉCOLE " * 3), (6, "aaaaa aaaaaa aaaaaaa " * 5 + "aaaaa " * 30), (7, "x" * 100_000 + " " + "colour-colour_colour9 naïve naive naïves " * 3), (8, "ababab bababa abababa babab " * 3)]
    df = spark.createDataFrame([(i, t, "w", 3, "f") for i, t in rows], "doc_id long, text string, word string, n int, `a.b` string")
    got = spelling.spelling_variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and sorted(map(tuple, got.collect())) == by_hand(rows)
    assert spelling.spelling_variants(df.limit(0)).collect() == []


def test_many_words_of_few_letters(spark):
    """Repeated bigrams, all places, ties of counts, and chains of forms."""
    rng = random.Random(3)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 9))): 3 * 2 ** rng.randint(0, 9) for _ in range(1500)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(map(tuple, spelling.group_variants(df).collect()))
    assert got == grouped(counts) and max(r[4] for r in got) > 10
    forms = {r[0]: r[1] for r in got}
    assert max(len(list(iter_chain(forms, w))) for w in forms) > 3


def iter_chain(forms, word):
    while word is not None:
        yield word
        word = forms[word]


def test_long_chain(spark):
    """Words that each lead to the next, further than one round of doubling."""
    words = ["a" * (5 + i) for i in range(30)]
    df = spark.createDataFrame([(w, 3 * 2**i) for i, w in enumerate(words)], "word string, n long")
    assert {r["root"] for r in spelling.group_variants(df).collect()} == {words[-1]}


def test_table(spark, tiny):
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, spelling.op12_spelling_variants(spark, tiny).collect()))
    assert len(got) > 1000 and got == by_hand(rows)
