"""SentencePiece BPE encoding and decoding, exact, by backtracking over Aho-Corasick matches.

A token sequence is the BPE encoding of a text exactly when every two neighbours are
*compatible*: merging their joined characters again, best score first and leftmost among
equals, gives the same two tokens. So the encoder walks the text with the longest match at
each position, keeps a match only if it is compatible with the token before, tries shorter
matches otherwise, and marks positions from which no way leads on in a bitfield, so that
every position fails at most once. Compatibility answers are kept in a table; each needs
one small merge of at most two pieces.

No piece of the vocabulary holds a word start after another character (checked when the
model is loaded), so no merge crosses into a new word: texts are cut there and encodings of
short words are kept in a bounded table. A vocabulary without that property is encoded as
one word per text.

The texts stay on the executors: one narrow Arrow map per partition, no shuffle.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lidarlattice.llm._common import map_text, table

SPACE = "▁"
#: Bounds of what a worker keeps: words of each of two tables, the longest word that is kept, and answers on pairs of pieces.
CACHE_WORDS, CACHE_CHARS, CACHE_PAIRS = 120_000, 48, 400_000


class Codec:
    """The vocabulary of one model file, ready to encode and decode."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces, self.scores, self.bytes_, self.byte_of = {}, {}, {}, {}
        self.surface: list[str] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.surface.append(piece)
            if model.is_byte(i):
                self.bytes_[int(piece[3:5], 16)] = i
                self.byte_of[i] = int(piece[3:5], 16)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece] = i
                self.scores[piece] = model.get_score(i)
        self.unknown = model.unk_id()
        self.matcher = ahocorasick.Automaton()
        for piece in self.pieces:
            self.matcher.add_word(piece, len(piece))
        self.matcher.make_automaton()
        inner = any(SPACE in piece.lstrip(SPACE) for piece in self.pieces)
        self.words = re.compile(".+" if inner else f"{SPACE}+[^{SPACE}]*", re.S)
        self.fits: dict[tuple[str, str], bool] = {}
        self.young: dict[str, tuple[int, str, str]] = {}
        self.old: dict[str, tuple[int, str, str]] = {}
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.pieces), None) for p in self.pieces}

    def merge(self, text: str) -> list[str]:
        """Plain BPE on a short text: best score first, leftmost among equal scores."""
        scores, none = self.scores, float("-inf")
        part = list(text)
        pair = [scores.get(a + b, none) for a, b in zip(part, part[1:], strict=False)]
        while pair:
            best = max(pair)
            if best == none:
                break
            i = pair.index(best)
            part[i : i + 2] = [part[i] + part[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = scores.get(part[i - 1] + part[i], none)
            if i < len(pair):
                pair[i] = scores.get(part[i] + part[i + 1], none)
        return part

    def fit(self, a: str, b: str) -> bool:
        """Whether `b` may follow `a` ("": the start), found by merging both again."""
        key = (a, b)
        if (known := self.fits.get(key)) is None:
            if len(self.fits) > CACHE_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self.merge(a + b) == ([a, b] if a else [b])
        return known

    def split(self, text: str) -> list[str]:
        """The pieces of `text`; a character outside the vocabulary is a piece of its own."""
        n = len(text)
        longest = [1] * n
        for end, size in self.matcher.iter(text):
            longest[end - size + 1] = size  # ends grow, so the last size at a start is the largest
        open_ = bytearray(b"\x01") * (n + 1)
        fits, shorter = self.fits, self.shorter
        out: list[str] = []
        pos, last, piece = 0, "", text[: longest[0]]
        while True:
            end = pos + len(piece)
            if open_[end]:
                fit = fits.get((last, piece))
                if self.fit(last, piece) if fit is None else fit:
                    out.append(piece)
                    if end == n:
                        return out
                    pos, last = end, piece
                    piece = text[pos : pos + longest[pos]]
                    continue
            piece = shorter.get(piece)
            if piece is None:  # nothing leads on from here: mark it and shorten the piece before
                open_[pos] = 0
                piece = out.pop()
                pos -= len(piece)
                last = out[-1] if out else ""

    def ids(self, pieces: list[str]) -> list[int]:
        out = []
        for piece in pieces:
            if (i := self.pieces.get(piece)) is not None:
                out.append(i)
            elif self.bytes_:
                out += [self.bytes_[b] for b in piece.encode()]
            else:
                out.append(self.unknown)
        return out

    def word(self, word: str) -> tuple[int, str, str]:
        """Number of ids, the ids as text, and what these ids decode to, for one word (bytes of a character never go on in the next word).

        Two tables hold the words seen lately: when the young one is full it becomes the
        old one, so that frequent words stay known within a fixed bound.
        """
        known = self.old.get(word)
        if known is None:
            ids = self.ids(self.split(word))
            known = len(ids), ",".join(map(str, ids)), self.join(ids)
        if len(word) <= CACHE_CHARS:
            if len(self.young) >= CACHE_WORDS:
                self.old, self.young = self.young, {}
            self.young[word] = known
        return known

    def normal(self, text: str | None) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def encode(self, text: str | None) -> list[int]:
        return [i for w in self.words.findall(self.normal(text)) for i in self.ids(self.split(w))]

    def join(self, ids: list[int]) -> str:
        """Surfaces of ids with spaces back in; runs of byte ids are read as UTF-8."""
        out, run = [], bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run = bytearray()
            out.append(self.surface[i].replace(SPACE, " "))
        if run:
            out.append(run.decode(errors="replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.join(ids)
        return text[1:] if text.startswith(" ") else text

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, and the SHA-256 of the ids joined by commas and of the decoded text."""
        word = self.word
        words = [self.young.get(w) or word(w) for w in self.words.findall(self.normal(text))]
        ids = ",".join([w[1] for w in words])
        decoded = "".join([w[2] for w in words])[1:]
        return sum([w[0] for w in words]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a model file, loaded once per worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def default_model() -> str:
    """The path of the public model on this machine; workers look up their own."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_texts(df: DataFrame, model: str | None = None, text_col: str = "text") -> DataFrame:
    """Append `ids` (array of int) and `decoded` to every row; a null text counts as empty and has no ids.

    `model` is a path that every worker can read; by default each looks up the public model.
    Columns named like the new ones are replaced.
    """
    added = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batch):
        c = codec(model or default_model())
        ids = [c.encode(t) for t in batch.column(text_col).to_pylist()]
        return {"ids": ids, "decoded": [c.decode(i) for i in ids]}

    return map_text(df, run, added, text_col, keep_text=True)


def digest_texts(df: DataFrame, model: str | None = None, text_col: str = "text") -> DataFrame:
    """Encode and decode every row's text and keep digests only.

    Every row of `df` gives one row: its columns without the text, then n_tokens,
    ids_sha256, decoded_sha256. Null and empty texts have no ids (digests of the empty
    string), long ones are read whole; repeated rows and null ids stay as they are; columns
    named like the new ones are replaced; an empty table stays empty. `model`: as in
    encode_texts.
    """
    added = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batch):
        c = codec(model or default_model())
        rows = [c.digest(t) for t in batch.column(text_col).to_pylist()]
        return dict(zip(("n_tokens", "ids_sha256", "decoded_sha256"), zip(*rows, strict=True) if rows else ((), (), ()), strict=True))

    return map_text(df, run, added, text_col)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest_texts(docs)


QUERIES = {"op10_sentencepiece": op10_sentencepiece}
ORACLE_SQL: dict[str, str] = {}
