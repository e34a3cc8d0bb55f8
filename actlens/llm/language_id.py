"""Language identification of mixed texts: script ranges, word scores and a Viterbi path.

A word's script narrows the languages to those that were seen writing it; each of these scores the word by the
log probabilities of its letter trigrams. A word is a run of letters of one script; a run of more than ``LONGEST``
letters, as in scripts without spaces, is read in pieces of ``PIECE`` letters, so that a span can change inside it.
A Viterbi path over the words of a text, with a penalty for each switch, labels spans of one language; the text's
language is the one with most letters, and the score is its share.

Where the best single language can't be beaten by any path (no stretch of words gains more over it than one switch
costs) the path is known without a search; all other texts are searched in full.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; ties go to the first language in
alphabetical order; long texts are labelled whole; repeated rows are labelled each; rows without a label or an id
are no training rows; without training rows every text is ``und``; other columns pass by; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.llm.common import arrow_map, column_of, texts_of

#: Labelled texts a language that are learned from, about; they are chosen by a hash of the id.
SAMPLE = 1500
PENALTY = 12.0
CLIP = 8.0
MEMO = 400_000
LONGEST, PIECE = 24, 12


def _numerals() -> str:
    """The characters of words that are neither letters nor decimal digits, as the ranges of a pattern."""
    codes = [c for c in range(0x80, 0x110000) if chr(c).isalnum() and not chr(c).isalpha()]
    starts = [c for k, c in enumerate(codes) if not k or codes[k - 1] != c - 1]
    ends = [c for k, c in enumerate(codes) if k + 1 == len(codes) or codes[k + 1] != c + 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True))


#: Letters exactly; and the quick forms for texts without a numeral, and for ASCII.
LETTERS, NUMERALS = re.compile(rf"[^\W\d_{_numerals()}]+"), re.compile(f"[{_numerals()}]")
LATIN_NUMERALS = "\u00b2\u00b3\u00b9\u00bc\u00bd\u00be"
QUICK, ASCII = re.compile(r"[^\W\d_]+"), re.compile(r"[A-Za-z]+")
#: a letter that is not Latin
BEYOND = re.compile(r"[^\W\d_\x41-\u024f\u1e00-\u1eff]")
#: (first, last code point, script); what is in no range is "other".
SCRIPTS = (
    (0x41, 0x24F, "latin"), (0x1E00, 0x1EFF, "latin"), (0x370, 0x3FF, "greek"), (0x1F00, 0x1FFF, "greek"), (0x400, 0x52F, "cyrillic"),
    (0x530, 0x58F, "armenian"), (0x590, 0x5FF, "hebrew"), (0x600, 0x77F, "arabic"), (0x900, 0x97F, "devanagari"), (0xE00, 0xE7F, "thai"),
    (0x10A0, 0x10FF, "georgian"), (0x3040, 0x30FF, "kana"), (0x3400, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"),
)


def script_of(letter: str) -> str:
    code = ord(letter)
    return next((s for a, b, s in SCRIPTS if a <= code <= b), "other")


def within_latin(text: str) -> bool:
    """Whether all characters are under U+0250, where letters are Latin; a quick test of most texts."""
    return int(np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).max(initial=0)) < 0x250


def letter_runs(text: str) -> list[str]:
    if text.isascii():
        return ASCII.findall(text)
    numeral = any(c in text for c in LATIN_NUMERALS) if within_latin(text) else NUMERALS.search(text)
    return (LETTERS if numeral else QUICK).findall(text)


def words_of(text: str) -> list[str]:
    """The runs of letters of a text, cut where the script changes, long ones in pieces."""
    found = letter_runs(text)
    if not (text.isascii() or within_latin(text)) and BEYOND.search(text):
        found = ["".join(part) for run in found for _, part in groupby(run, script_of)]
    if found and max(map(len, found)) > LONGEST:
        found = [x for run in found for x in ([run] if len(run) <= LONGEST else [run[k : k + PIECE] for k in range(0, len(run), PIECE)])]
    return found


def trigrams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[k : k + 3] for k in range(len(padded) - 2)]


def held_out(id_col: Column) -> Column:
    """crc32 of the id's text, modulo 4, is 2."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2


def codes_of(text: str) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def trigram_codes(points: np.ndarray) -> np.ndarray:
    """One number for each three code points in a row."""
    return (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]


class Model:
    """Trigram log probabilities and scripts of the languages learned."""

    def __init__(self, counts: list[tuple[str, str, int]], scripts: list[tuple[str, str, int]]) -> None:
        self.languages = sorted({x[0] for x in counts})
        at = {x: k for k, x in enumerate(self.languages)}
        totals = np.ones(len(at))
        table: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(at)))
        for language, gram, n in counts:
            table[gram][at[language]] = n
            totals[at[language]] += n
        keys = {int(trigram_codes(codes_of(g))[0]): g for g in table if len(g) == 3}
        self.codes = np.array(sorted(keys), np.uint64)
        rows = [np.log((table[keys[int(k)]] + 0.5) / (totals + len(table))) for k in self.codes]
        #: one row for each trigram code, then that of unknown trigrams, then one that adds nothing
        self.logs = np.array([*rows, np.log(0.5 / (totals + len(table))), np.zeros(len(at))]).reshape(len(rows) + 2, len(at))
        letters: dict[str, Counter] = defaultdict(Counter)
        for language, script, n in scripts:
            letters[language][script] += n
        names = [*dict.fromkeys(x for _, _, x in SCRIPTS), "other"]
        self.script = np.full(0x110000 >> 4, len(names) - 1, np.uint8)
        for first, last, name in SCRIPTS:
            self.script[first >> 4 : (last >> 4) + 1] = names.index(name)
        seen = [[letters[x][s] > 0 and letters[x][s] >= 0.01 * sum(letters[x].values()) for x in self.languages] for s in names[:-1]]
        #: languages that a script leaves; one that none was seen in leaves all
        self.seen = np.array([r if any(r) else [True] * len(at) for r in [*seen, [False] * len(at)]], bool).reshape(len(names), len(at))

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each word its log probabilities relative to the best language, no lower than -CLIP, and its letters.

        Languages of another script are lowest.
        """
        runs = [letter_runs(w.lower()) for w in words]  # a letter's lower case may hold marks
        letters = np.array([len(w) for w in words], np.float64)
        out = np.zeros((len(words), len(self.languages)), np.float32)
        full = np.flatnonzero([bool(r) for r in runs])
        if not len(full) or not self.languages:
            return out, letters
        padded = [f" {' '.join(runs[k])} " for k in full]
        points = codes_of("".join(padded))
        codes = trigram_codes(points)
        place = np.searchsorted(self.codes, codes)
        place[self.codes[np.minimum(place, len(self.codes) - 1)] != codes] = len(self.codes)
        place[points[1:-1] == 32] = len(self.codes) + 1  # no trigram reaches over a word's end
        starts = np.concatenate([[0], np.cumsum([len(x) for x in padded])[:-1]])
        total = np.add.reduceat(self.logs[place], starts, axis=0)
        total = np.where(self.seen[self.script[points[starts + 1].astype(np.int64) >> 4]], total, -np.inf)
        out[full] = np.maximum(total - total.max(1, keepdims=True), -CLIP)
        return out, letters


class Labeller:
    """Words to spans; remembers the scores of words met."""

    def __init__(self, model: Model, penalty: float = PENALTY) -> None:
        self.model, self.penalty = model, penalty
        self.places: dict[str, int] = {}
        self.table = np.zeros((1024, max(1, len(model.languages))), np.float32)
        self.letters = np.zeros(1024)

    def learn_words(self, words: set[str]) -> None:
        """Scores all words that are not remembered, at once."""
        new = list(words.difference(self.places))
        if len(self.places) + len(new) > MEMO:
            self.places.clear()
            new = list(words)
        if not new:
            return
        first = len(self.places)
        while first + len(new) > len(self.table):
            self.table, self.letters = np.concatenate([self.table, np.zeros_like(self.table)]), np.concatenate([self.letters, np.zeros_like(self.letters)])
        self.table[first : first + len(new), : len(self.model.languages)], self.letters[first : first + len(new)] = self.model.scores(new)
        self.places.update(zip(new, range(first, first + len(new)), strict=True))

    def path(self, scores: np.ndarray) -> np.ndarray:
        """The index of each word's language on the best path."""
        n, width = scores.shape
        whole = scores.sum(0, dtype=np.float64)
        best = int(whole.argmax())
        if width == 1:
            return np.zeros(n, np.int64)
        gain = np.cumsum(np.delete(scores, best, 1).max(1) - scores[:, best], dtype=np.float64)
        low = np.minimum.accumulate(np.concatenate([[0.0], gain[:-1]]))
        if (gain - low).max() <= self.penalty:
            return np.full(n, best)
        back = np.zeros((n, width), np.int64)
        state = scores[0].astype(np.float64)
        own = np.arange(width)
        for k in range(1, n):
            top = int(state.argmax())
            switch = state[top] - self.penalty
            back[k] = np.where(state >= switch, own, top)
            state = np.maximum(state, switch) + scores[k]
        at = int(state.argmax())
        out = np.zeros(n, np.int64)
        for k in range(n - 1, -1, -1):
            out[k] = at
            at = back[k, at]
        return out

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, language) of each run of words of one language, in code points."""
        words = words_of(text)
        if not words or not self.model.languages:
            return []
        self.learn_words(set(words))
        path = self.path(self.table[[self.places[w] for w in words]])
        starts, at = [], 0
        for w in words:
            starts.append(text.index(w, at))
            at = starts[-1] + len(w)
        cuts = [0, *(np.nonzero(np.diff(path))[0] + 1).tolist(), len(words)]
        return [(starts[a], starts[b - 1] + len(words[b - 1]), self.model.languages[path[a]]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, share of letters) of whole texts."""
        lists = [words_of(t) for t in texts]
        self.learn_words(set().union(*lists))
        place, out = self.places.__getitem__, []
        for words in lists:
            at = np.fromiter(map(place, words), np.int64, len(words))
            letters = self.letters[at]
            whole = letters.sum()
            if not whole or not self.model.languages:
                out.append(("und", 0.0))
                continue
            shares = np.bincount(self.path(self.table[at]), letters, len(self.model.languages))
            best = int(shares.argmax())
            out.append((self.model.languages[best], float(shares[best] / whole)))
        return out


def learn(docs: DataFrame, sample: int = SAMPLE, lang_col: str = "lang") -> Model:
    """A model from about ``sample`` labelled texts a language: all labels are counted, then texts are chosen by hash.

    ``docs`` has doc_id, text and the label; rows to learn from only. Trigrams are counted on the workers; what comes
    to the driver is bounded by the sample, whose trigrams are all kept.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("doc_id is not null and text is not null and lang is not null")
    rates = rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(sample)) / F.count("*")).alias("rate"))
    chosen = rows.join(F.broadcast(rates), "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < F.col("rate") * 1_000_000).select("lang", "text")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            grams: Counter = Counter()
            for language, text in zip(column_of(batch, "lang").to_pylist(), texts_of(batch, "text"), strict=True):
                for word, n in Counter(words_of(text.lower())).items():
                    for gram in trigrams(word):
                        grams[language, "g", gram] += n
                    grams[language, "s", script_of(word[0])] += n * len(word)
            keys = list(grams)
            return pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.string()) for i in range(3)] + [pa.array([grams[k] for k in keys], pa.int64())], ["lang", "kind", "part", "n"])

        return step

    counts = arrow_map(chosen, make, "lang string, kind string, part string, n long").groupBy("lang", "kind", "part").agg(F.sum("n").alias("n"))
    found = counts.collect()  # the trigrams of a sample of stated size
    return Model([(r[0], r[2], r[3]) for r in found if r[1] == "g"], [(r[0], r[2], r[3]) for r in found if r[1] == "s"])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", penalty: float = PENALTY) -> DataFrame:
    """(id, lang_pred, score) of every row; one pass, no shuffle. The model is of bounded size and goes with the tasks."""
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))

    def make():
        labeller = Labeller(model, penalty)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = labeller.predict(texts_of(batch, "__text"))
            return pa.RecordBatch.from_arrays([column_of(batch, "__id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["__id", "lang_pred", "score"])

        return step

    out = arrow_map(source, make, f"__id {dict(source.dtypes)['__id']}, lang_pred string, score double")
    return out.withColumnRenamed("__id", id_col)


def accuracy(predicted: DataFrame, labelled: DataFrame) -> float:
    """Share of labelled rows whose prediction equals the label."""
    both = predicted.join(labelled.where("lang is not null").select("doc_id", "lang"), "doc_id")
    value = both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    return math.nan if value is None else value
