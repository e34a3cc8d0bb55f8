"""Exact byte-pair encoding by backtracking, and decoding by an offset table.

Encoding: an Aho-Corasick automaton finds every vocabulary token in a piece; from each place the longest token
is tried first and kept only if it is compatible with the token before it, else the search backs up. Two tokens
are compatible if merging their joined bytes would not have crossed the boundary. The compatible sequence that
covers the piece is unique and is the one that merging gives, and each place is visited at most once, so that
the time is linear in the text. Decoding slices one byte string by token offsets.

Texts are cut into words as the vocabulary file's own pre-tokenizer does it. Its letters, numbers and white space are
those of another Unicode version than this pattern's, so that all code points are tried once on the driver
(``odd_characters``), and those that it takes for another class are replaced by one of that class while a text is cut.

Defined cases: null and empty texts have no tokens; texts are encoded whole; the special token's own string in a
text becomes the special token, as in the tokenizers library; repeated rows are encoded each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm.common import arrow_map, column_of, texts_of

#: a character of each class
STANDS = {"letter": "\u00e9", "number": "\u00b2", "space": "\u2003", "other": "\u00a4"}
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of a worker's memo of encoded words; it is emptied when full, so that memory stays bounded.
MEMO = 300_000
#: Longer chunks are not remembered.
MEMO_CHARS = 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(4)
def odd_characters(path: str) -> str:
    """Pairs of a character that the file's pre-tokenizer takes for another class than ``PIECES`` does, and one of that class.

    Characters of one class in a row make one piece, so that they are tried in halves down to those that do not.
    """
    import tokenizers

    cut = tokenizers.Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    before = {"letter": "a", "number": "1", "other": "!"}
    classes = {"letter": regex.compile(r"\p{L}"), "number": regex.compile(r"\p{N}"), "space": regex.compile(r"\s"), "other": regex.compile(r"[^\s\p{L}\p{N}]")}
    out: list[str] = []

    def one_piece(name: str, chars: str) -> bool:
        return len(cut(before[name] + chars)) == 1

    def theirs(c: str) -> str:
        return next((name for name in before if one_piece(name, c)), "space")

    def look(name: str, chars: str) -> None:
        if name == "space" or len(chars) == 1:
            out.extend(c + STANDS[x] for c in chars if (x := theirs(c)) != name)
        elif chars and not one_piece(name, chars):
            look(name, chars[: len(chars) // 2])
            look(name, chars[len(chars) // 2 :])

    for first in range(0, 0x110000, 1 << 14):
        block = "".join(chr(c) for c in range(first, first + (1 << 14)) if not 0xD800 <= c <= 0xDFFF)
        for name, mine in classes.items():
            look(name, "".join(mine.findall(block)))
    return "".join(out)


class Vocabulary:
    """Tokens, merges, automaton, pair-compatibility table and offset table of one vocabulary file."""

    def __init__(self, path: str, odd: str | None = None) -> None:
        odd = odd_characters(path) if odd is None else odd
        self.stands_for = str.maketrans(odd[::2], odd[1::2])
        self.odd, self.first_odd = frozenset(odd[::2]), min(odd[::2], default=chr(0x10FFFF))
        self.blank = {c for c, x in zip(odd[::2], odd[1::2], strict=True) if x == STANDS["space"]}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in self.special}
        size = max([*self.tokens, *self.special.values()]) + 1
        texts = [self.tokens.get(i, b"") for i in range(size)]
        for text, i in self.special.items():
            texts[i] = text.encode()
        self.blob = np.frombuffer(b"".join(texts), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.sizes = np.diff(self.offsets)
        #: of each token, when it is made (single bytes before all merges) and from which two.
        self.rank = dict.fromkeys(self.tokens, -1)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            whole, pair = vocab[left + right], (vocab[left], vocab[right])
            self.merged[pair] = rank
            if whole not in self.halves:
                self.halves[whole] = pair
                self.rank[whole] = rank
        self.automaton = ahocorasick.Automaton()
        for i, t in self.tokens.items():
            self.automaton.add_word(t.decode("latin-1"), (len(t), i))
        self.automaton.make_automaton()
        self.lengths = self.sizes.tolist()
        self.stands = [i in self.tokens and self._stands(i) for i in range(size)]
        self.whole = {t: i for i, t in self.tokens.items() if self.stands[i]}
        #: of each token the longest other token that it begins with, else -1.
        self.shorter = [-1] * size
        known = {t: i for i, t in self.tokens.items()}
        for i, t in self.tokens.items():
            self.shorter[i] = next((known[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in known), -1)
        #: The pair-compatibility table, filled as pairs are met.
        self.fits: dict[int, bool] = {}
        self.split = regex.compile(PIECES)
        self.cut = regex.compile("|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.memo = Memo(self)

    def _stands(self, token: int) -> bool:
        """Whether merging this token's own bytes gives the token."""
        pair = self.halves.get(token)
        return pair is None or (self._compatible(*pair, self.rank[token]))

    def _compatible(self, left: int, right: int, below: int | None = None) -> bool:
        """Whether no merge of rank under ``below`` crosses the boundary of two tokens.

        Both tokens are taken apart in the reverse order of their making; while the later-made one is taken
        apart, the pair that touches the boundary must not be one that would have merged earlier.
        """
        limit = below if below is not None else 1 << 60
        rank, halves, merged = self.rank, self.halves, self.merged
        while True:
            r = merged.get((left, right))
            if r is not None and r < limit:
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            # At equal rank the left occurrence merges first, so a crossing of the same rank starts at the left one.
            if a > b or (a == b and a >= 0):
                limit, left = min(limit, a), halves[left][1]
            else:
                limit, right = min(limit, b + 1), halves[right][0]

    def backtrack(self, raw: bytes) -> list[int]:
        """The tokens of one piece."""
        n = len(raw)
        longest = [0] * n
        for end, (size, token) in self.automaton.iter(raw.decode("latin-1")):
            longest[end + 1 - size] = token  # longer matches from the same start come later
        lengths, shorter, stands, fits = self.lengths, self.shorter, self.stands, self.fits
        tokens: list[int] = []
        dead = bytearray(n + 1)  # places from which the rest can't be covered
        at, last, token = 0, -1, longest[0]
        while True:
            end = at + lengths[token]
            fit = False
            if not dead[end]:
                if last < 0:
                    fit = stands[token]
                else:
                    fit = fits.get(last << 32 | token)
                    if fit is None:
                        if len(fits) > MEMO:
                            fits.clear()
                        fit = fits[last << 32 | token] = self._compatible(last, token)
            if fit:
                tokens.append(token)
                if end == n:
                    return tokens
                at, last, token = end, token, longest[end]
                continue
            token = shorter[token]
            while token < 0:
                dead[at] = 1
                token = tokens.pop()
                at -= lengths[token]
                last = tokens[-1] if tokens else -1
                token = shorter[token]

    def forget(self) -> None:
        """Empties the memos, so that an idle worker process holds the vocabulary only."""
        self.memo.clear()
        self.pieces.clear()
        self.fits.clear()

    def piece(self, piece: str) -> tuple[int, ...]:
        known = self.pieces.get(piece)
        if known is None:
            raw = piece.encode()
            token = self.whole.get(raw)
            known = (token,) if token is not None else tuple(self.backtrack(raw))
            if len(piece) <= MEMO_CHARS:
                if len(self.pieces) >= MEMO:
                    self.pieces.clear()
                self.pieces[piece] = known
        return known

    def words(self, text: str) -> list[int]:
        """The tokens of a text in which no special token stands."""
        return [i for p in self.cuts(text) for i in self.piece(p)]

    def cuts(self, text: str) -> list[str]:
        """The words of a text; one takes the place of each odd character while they are sought."""
        if text.isascii() or self.highest(text) < self.first_odd or self.odd.isdisjoint(text):
            return self.split.findall(text)
        return [text[m.start() : m.end()] for m in self.split.finditer(text.translate(self.stands_for))]

    @staticmethod
    def highest(text: str) -> str:
        """The largest code unit of a text, which is under that of any odd character in most texts."""
        return max(text) if len(text) < MEMO_CHARS else chr(int(np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).max()))

    def is_space(self, letter: str) -> bool:
        return letter.isspace() or letter in self.blank

    def encode(self, text: str) -> np.ndarray:
        """The token ids of a whole text, as uint32."""
        return np.frombuffer(b"".join(self.chunks(text)), np.uint32)

    def chunks(self, text: str) -> list[bytes]:
        """The ids of a whole text as bytes, chunk by chunk.

        Where one space stands between two other characters that are no white space, no piece crosses the
        place before the space, so that what lies between such places is encoded, and remembered, by itself.
        """
        if not text:
            return []
        if self.cut is not None and (found := list(self.cut.finditer(text))):
            out, at = [], 0
            for m in found:
                out += self.chunks_of(text[at : m.start()])
                out.append(np.uint32(self.special[m[0]]).tobytes())
                at = m.end()
            return out + self.chunks_of(text[at:])
        return self.chunks_of(text)

    def chunks_of(self, text: str) -> list[bytes]:
        if not text:
            return []
        first, *rest = text.split(" ")
        memo = self.memo
        parts = [memo[x] for x in rest]
        if None in parts or not first or self.is_space(first[-1]):
            return [array("I", self.words(text)).tobytes()]
        return [array("I", self.words(first)).tobytes(), *parts]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a token sequence, gathered from the offset table."""
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        index = np.repeat(self.offsets[ids] - (ends - sizes), sizes)
        index += np.arange(ends[-1])
        return self.blob[index].tobytes()


class Memo(dict):
    """Chunk without its leading space -> id bytes with it; None where the chunk can't be taken by itself."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, chunk: str) -> bytes | None:
        if not chunk or self.vocabulary.is_space(chunk[0]) or self.vocabulary.is_space(chunk[-1]):
            return None
        ids = array("I", self.vocabulary.words(" " + chunk)).tobytes()
        if len(chunk) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[chunk] = ids
        return ids


@lru_cache(2)
def vocabulary_of(path: str, odd: str | None = None) -> Vocabulary:
    """One vocabulary per worker process; ``odd`` comes from the driver."""
    return Vocabulary(path, odd)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, n_tokens, token_ids array<int>) of every row; one pass, no shuffle."""
    path = vocabulary or default_vocabulary()
    odd = odd_characters(path)
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))

    def make():
        v = vocabulary_of(path, odd)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [v.encode(t) for t in texts_of(batch, "__text")]
            sizes = np.array([len(x) for x in ids], np.int64)
            flat = np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
            return pa.RecordBatch.from_arrays([column_of(batch, "__id"), pa.array(sizes), lists], ["__id", "n_tokens", "token_ids"])

        step.close = v.forget
        return step

    out = arrow_map(source, make, f"__id {dict(source.dtypes)['__id']}, n_tokens long, token_ids array<int>")
    return out.withColumnRenamed("__id", id_col)


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "token_ids", vocabulary: str | None = None) -> DataFrame:
    """(id, text) of token sequences; null ids give the empty text, bytes that are no UTF-8 the replacement character."""
    path = vocabulary or default_vocabulary()
    odd = odd_characters(path)
    source = encoded.select(F.col(id_col).alias("__id"), F.col(ids_col).alias("__ids"))

    def make():
        v = vocabulary_of(path, odd)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [v.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in column_of(batch, "__ids").to_pylist()]
            return pa.RecordBatch.from_arrays([column_of(batch, "__id"), pa.array(texts, pa.string())], ["__id", "text"])

        return step

    return arrow_map(source, make, f"__id {dict(source.dtypes)['__id']}, text string").withColumnRenamed("__id", id_col)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of the ids of every whole text and of what they decode to.

    The digests are made where the ids are, so that the ids of a large table need not leave the worker.
    """
    path = vocabulary or default_vocabulary()
    odd = odd_characters(path)
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))

    def make():
        v = vocabulary_of(path, odd)
        decimal = [str(i) for i in range(len(v.sizes))]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in texts_of(batch, "__text"):
                ids = v.encode(text)
                written = ",".join([decimal[i] for i in ids.tolist()])
                decoded = v.decode(ids).decode("utf-8", "replace").encode()
                rows.append((len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([column_of(batch, "__id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["__id", "n_tokens", "ids_sha256", "decoded_sha256"])

        step.close = v.forget
        return step

    out = arrow_map(source, make, f"__id {dict(source.dtypes)['__id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("__id", id_col)
