"""Toxicity scores from a subsequence string-kernel SVM with Nyström landmarks.

The kernel of a word and a landmark counts the three-letter subsequences they share, each
damped by DECAY for every letter it skips (GAP at most), is scaled by the landmark's own
kernel and counted above FLOOR only: a landmark that is contained whole gives 1, inserted
characters and gaps lower it smoothly. A sentence's kernel with a landmark is the sum over
its different words (MOST at most, so that one long sentence is no worse than two); letters
that are set apart ("i d i o t", "i-d-i-o-t") are joined before. Landmarks are mined from
labelled texts: words over-represented in toxic ones are covered by shared substrings, and
whole words of clean texts that hold such a substring are landmarks too, so that an innocent
word and an insult made from it can be told apart. The kernels of a sentence with the
landmarks are whitened by the same kernel among the landmarks (Nyström), a linear SVM is
trained on sentences, and a text's score is the calibrated margin of its two worst ones.
Every third toxic text teaches a second time with a character inserted into its telling
words.

Because a kernel is a weighted count of letter triples, all landmarks of a word are
evaluated together by adding rows of one table. Words seen lately are kept; most have no
kernel above the floor. Scoring is one narrow Arrow map over whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lidarlattice.llm._common import held_out, table
from lidarlattice.llm.quality import labelled, score_texts

#: Damping per skipped letter, letters skipped at most, floor of a word's kernel, greatest sum of a sentence, letters that are told apart, longest piece of a word that is compared at once.
DECAY, GAP, FLOOR, MOST, LETTERS, PIECE = 0.7, 3, 0.45, 3.0, 40, 24
#: Bounds: labelled texts about, characters of a text that may teach (longer ones do not), landmarks, words a worker keeps.
LABELLED, LONGEST, LANDMARKS, KEPT = 5000, 200_000, 48, 300_000
#: How often a toxic text counts in the calibration: to miss one is worse than to flag a clean one.
CARE = 1.5
#: Least log-likelihood ratio of a substring that may be a landmark.
SURPRISE = 30.0
#: Mining ends when the best substring covers less than this share of what the first one covered.
TAIL = 0.05
#: Characters of texts whose new words are compared together.
GROUP = 1 << 20

_APART = re.compile(r"(?:(?<=\s)[^\W\d_][.*_\-]?\s){3,}")
_MARKS = re.compile(r"[\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s|\n")
START, END = "^", "$"


def tokens_of(lowered: str) -> list[str]:
    """The tokens of a lower-cased text between white space, and runs of single letters as one more token each."""
    found = lowered.split()
    return found + _APART.findall(f" {lowered} ") if len(found) > 2 else found


def plain(token: str) -> str:
    """A token's letters, between the signs for a word's start and end."""
    return f"{START}{token if token.isalpha() else _MARKS.sub('', token)}{END}"


def codes(words: list[str], size: int) -> np.ndarray:
    """A row of letter numbers for each of `words`, all of `size` letters: a-z, START, END, and classes of other letters."""
    c = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), size).astype(np.int32)
    return np.where((c >= 97) & (c <= 122), c - 97, np.where(c == ord(START), 26, np.where(c == ord(END), 27, 28 + c % (LETTERS - 28))))


@cache
def places(size: int) -> list[tuple[int, int, int]]:
    """Places of three letters in a word of `size` that skip GAP letters at most."""
    return [(i, j, k) for i, j, k in combinations(range(size), 3) if k - i - 2 <= GAP]


class Landmarks:
    """The table of letter triples of all landmarks, and kernels of words with them."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.table = np.zeros((LETTERS**3, len(landmarks)), np.float32)
        for j, word in enumerate(landmarks):
            for code, weight in self.triples(word).items():
                self.table[code, j] = weight
            self.table[:, j] /= max(1e-9, float((self.table[:, j] ** 2).sum()))

    @staticmethod
    def triples(word: str) -> Counter:
        c, out = codes([word], len(word))[0], Counter()
        for i, j, k in places(len(c)):
            out[int((c[i] * LETTERS + c[j]) * LETTERS + c[k])] += DECAY ** (k - i - 2)
        return out

    def kernels(self, words: list[str]) -> np.ndarray:
        """A row per word; words beyond PIECE letters are compared in overlapping pieces, the best of which counts."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        used = self.table.any(axis=1)
        by_length: dict[int, list[tuple[int, str]]] = {}
        for n, word in enumerate(words):
            for at in range(0, max(1, len(word) - PIECE // 2), PIECE // 2) if len(word) > PIECE else (0,):
                piece = word[at : at + PIECE]
                if len(piece) >= 3:
                    by_length.setdefault(len(piece), []).append((n, piece))
        for size, pieces in by_length.items():
            i, j, k = (np.array(x) for x in zip(*places(size), strict=True))
            weight = (DECAY ** (k - i - 2)).astype(np.float32)
            for at in range(0, len(pieces), 2048):
                part = pieces[at : at + 2048]
                c = codes([p for _, p in part], size)
                code = ((c * (LETTERS * LETTERS))[:, i] + (c * LETTERS)[:, j]) + c[:, k]
                rows, which = np.nonzero(used[code])  # most triples are in no landmark
                if not rows.size:
                    continue
                first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                total = np.add.reduceat(self.table[code[rows, which]] * weight[which, None], first, axis=0)
                np.maximum.at(out, np.array([n for n, _ in part])[rows[first]], np.minimum(total, 1))
        return out


def surprise(a: int, b: int, n: int, m: int) -> float:
    """Log-likelihood ratio of a word in a of n toxic and b of m clean texts."""
    total = a + b
    return 2 * sum(x * np.log(x / (total * share)) for x, share in ((a, n / (n + m)), (b, m / (n + m))) if x)


def mine(toxic: list[set[str]], clean: list[set[str]], limit: int = LANDMARKS) -> list[str]:
    """Substrings that cover the words which toxic texts hold far more often than clean ones, and the clean words that hold them."""
    bad, good = Counter(w for t in toxic for w in t), Counter(w for t in clean for w in t)
    n, m = max(1, len(toxic)), max(1, len(clean))
    strong = {w: a for w, a in bad.items() if len(w) >= 4 and a >= 3 and a / n > 4 * (good[w] + 0.5) / m}
    parts: dict[str, set[str]] = {}
    for w in strong:
        for size in range(4, min(14, len(w)) + 1):
            for i in range(len(w) - size + 1):
                parts.setdefault(w[i : i + size], set()).add(w)
    four = {part for part in parts if len(part) == 4}
    within, against = Counter(), Counter()
    for counts, held in ((bad, within), (good, against)):
        for w, b in counts.items():
            if any(w[i : i + 4] in four for i in range(len(w) - 3)):
                for part in {w[i : i + size] for size in range(4, min(14, len(w)) + 1) for i in range(len(w) - size + 1)}:
                    if part in parts:
                        held[part] += b
    parts = {part: words for part, words in parts.items() if within[part] / n > 4 * (against[part] + 0.5) / m and surprise(within[part], against[part], n, m) > SURPRISE}
    strong = {w: strong[w] for words in parts.values() for w in words}
    out: list[str] = []
    left, least = set(strong), 0.0
    while left and len(out) < limit:
        worth = {part: sum(strong[w] for w in words & left) / n - 4 * against[part] / m for part, words in parts.items()}
        best = max(worth, key=lambda part: (worth[part], len(part), part))
        if worth[best] <= least:
            break
        least = least or worth[best] * TAIL
        # a longer substring that covers nearly as much says more
        best = max((part for part in worth if best in part and worth[part] >= 0.8 * worth[best]), key=lambda part: (len(part), worth[part], part))
        out.append(best)
        left -= parts[best]
    # clean words that hold a landmark: those of three texts or more that are not rarer among clean ones
    held = [w for w, b in good.items() if b >= 3 and b / m >= bad[w] / n and any(part in w for part in out)]
    return out + sorted(held, key=lambda w: (-good[w], w))[: limit - len(out)]


class Scorer:
    """Landmarks, the SVM's weights on their features, and the calibration of the worst sentences' margins."""

    def __init__(self, texts: list[str], labels: list[int]):
        self.young: dict[str, np.ndarray | None] = {}
        self.old: dict[str, np.ndarray | None] = {}
        texts, y = self.distinct(texts, np.array(labels))
        bags = [{plain(w) for w in set(tokens_of(t.lower()))} for t in texts]
        found = mine([b for b, v in zip(bags, y, strict=True) if v == 1], [b for b, v in zip(bags, y, strict=True) if v == 0])
        self.basis = Landmarks(found) if found else None
        if self.basis is None:  # no text is told apart by its words
            return
        gram = self.floored(self.basis.kernels(self.basis.landmarks))
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        self.white = vectors / np.sqrt(np.maximum(values, 0.05))
        self.beta, self.bias = np.zeros(len(found)), -1.0
        hot = self.features(texts)
        random = np.random.default_rng(5)
        disturbed = [self.disturb(t, random) for t, v in zip(texts, y, strict=True) if v == 1][::3]
        hot += self.features(disturbed)
        y = np.r_[y, np.ones(len(disturbed), int)]
        # a sentence without a feature is one and the same row, as often as clean texts have it
        rows, sides = [np.zeros(len(found))], [-1.0]
        for v, some in zip(y, hot, strict=True):
            rows += some
            sides += [1.0 if v == 1 else -1.0] * len(some)
        empty = sum(len(_SENTENCE.split(t)) - len(h) for t, h, v in zip(texts, hot, y, strict=False) if v == 0)
        self.train(np.array(rows), np.array(sides), float(max(1, empty)))
        self.curve = self.calibrate(np.array([self.worst(h) for h in hot]), y)

    @staticmethod
    def floored(kernels: np.ndarray) -> np.ndarray:
        return np.maximum(kernels - FLOOR, 0) / (1 - FLOOR)

    @staticmethod
    def distinct(texts: list[str], y: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Copies of a text teach once."""
        first = list(dict(zip(reversed(texts), reversed(range(len(texts))), strict=True)).values())[::-1]
        return [texts[i] for i in first], y[first]

    def train(self, x: np.ndarray, side: np.ndarray, empty: float, steps: int = 400) -> None:
        """A linear SVM (squared hinge, balanced classes) on whitened features; the first row stands for all sentences without features."""
        z = x @ self.white
        # each side weighs 1; on the clean side half of it is for sentences without features, as margins of the others decide
        weight = 1 / np.where(side > 0, max(1, (side > 0).sum()), 2 * max(1, (side < 0).sum() - 1))
        weight[0] = 0.5 * empty / (empty + 1)
        w, b, vw, vb = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1]), 0.0
        rate = 0.5 / (1 + float((np.linalg.norm(z, axis=1) ** 2 * weight).sum()))
        for _ in range(steps):
            slack = np.maximum(0, 1 - side * (z @ w + b)) * side * weight
            gw, gb = -2 * z.T @ slack + 1e-3 * w, -2 * slack.sum()
            vw, vb = 0.9 * vw - rate * gw, 0.9 * vb - rate * gb
            w, b = w + vw, b + vb
        self.beta, self.bias = self.white @ w, float(b)

    @staticmethod
    def calibrate(margins: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Weights of the logistic curve through the training texts' margins (a row each) and of a constant, with smoothed targets; a toxic text counts CARE times."""
        n1, n0 = (y == 1).sum(), (y == 0).sum()
        target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        x, rest = np.c_[margins, np.ones(len(y))], np.array([1.0, 0.0, 0.0])
        times, w = np.where(y == 1, CARE, 1.0), rest.copy()
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            ridge = np.array([1e-3, 1e-3, 0])
            step = np.linalg.solve((x * (times * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (times * (p - target)) + ridge * (w - rest))
            w = w - step
            if np.abs(step).max() < 1e-8:
                break
        return w

    def disturb(self, text: str, random) -> str:
        """The text with a letter or a mark inserted into each word that holds a landmark nearly whole."""

        def change(m):
            f = self.young.get(m[0])
            if f is None or f.max() < 0.9:
                return m[0]
            at = random.integers(1, len(m[0]))
            return m[0][:at] + "abcdefghijklmnopqrstuvwxyz*-."[random.integers(29)] + m[0][at:]

        return re.sub(r"\S{4,}", change, text.lower())

    def learn_words(self, words: set[str]) -> None:
        """Add the features of new words to the table: a vector, or None where all are below the floor."""
        if len(self.young) > KEPT:
            self.old, self.young = self.young, {}
        new = []
        for w in words:
            if w in self.old:
                self.young[w] = self.old[w]
            else:
                new.append(w)
        if new:
            k = self.floored(self.basis.kernels([plain(w) for w in new]))
            some = k.any(axis=1)
            for w, f, ok in zip(new, k, some, strict=True):
                self.young[w] = f if ok else None

    def _hot(self, lowered: str) -> list[np.ndarray]:
        """Features of the sentences that have any."""
        out = []
        for sentence in _SENTENCE.split(lowered):
            words = set(tokens_of(sentence))
            if missing := {w for w in words if w not in self.young}:  # a run of single letters may be cut by a sentence's end
                self.learn_words(missing)
            hot = [f for w in words if (f := self.young.get(w)) is not None]
            if hot:
                out.append(np.minimum(np.sum(hot, axis=0), MOST))
        return out

    def features(self, texts: list[str | None]) -> list[list[np.ndarray]]:
        """For each text the features of its sentences that have any; new words are compared a group of texts at a time."""
        out: list[list[np.ndarray]] = []
        group: list[tuple[str, set[str]]] = []
        size = 0
        for n, text in enumerate(texts, 1):
            lowered = (text or "").lower()
            group.append((lowered, set(tokens_of(lowered))))
            size += len(lowered)
            if size > GROUP or n == len(texts):
                self.learn_words({w for _, words in group for w in words if w not in self.young})
                known = self.young
                hot = [any(known.get(w) is not None for w in words) for _, words in group]
                out += [self._hot(t) if h else [] for (t, _), h in zip(group, hot, strict=True)]
                group, size = [], 0
        return out

    def worst(self, hot: list[np.ndarray]) -> list[float]:
        """The two greatest margins of a text's sentences, those of sentences without features included."""
        some = sorted([0.0, 0.0, *(float(f @ self.beta) for f in hot)])
        return [some[-1] + self.bias, some[-2] + self.bias]

    def score(self, texts: list[str | None]) -> list[float]:
        """0 to 1; a model without landmarks gives 0 to every text."""
        if self.basis is None or not texts:
            return [0.0] * len(texts)
        margins = np.array([self.worst(hot) for hot in self.features(texts)])
        return (1 / (1 + np.exp(-np.clip(margins @ self.curve[:2] + self.curve[2], -30, 30)))).tolist()


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows: int = LABELLED) -> Scorer:
    """Fit on about `rows` labelled rows of the learning folds (those not held out)."""
    short = docs.where(~held_out(id_col) & (F.length(text_col) <= LONGEST))
    got = sorted(labelled(short, labels.where(~held_out(id_col)), label_col, id_col, text_col, rows).limit(2 * rows).collect(), key=lambda r: (r["lid"], r["t"], r["y"]))
    model = Scorer([r["t"] for r in got], [r["y"] for r in got])
    model.young, model.old = {}, {}
    return model


def score_toxicity(df: DataFrame, model: Scorer, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Append score and predicted (1 if score >= threshold) to every row.

    Null and empty texts have no sentence and get the score of a text without features; long
    texts are read whole. Rows are neither dropped nor moved; repeats and null ids stay;
    columns named like the new ones are replaced; an empty table stays empty.
    """
    return score_texts(df, model, text_col, threshold)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score_toxicity(docs.select("doc_id", held_out().alias("held_out"), "text"), model)


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLE_SQL: dict[str, str] = {}
