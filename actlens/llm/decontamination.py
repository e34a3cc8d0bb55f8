"""Benchmark decontamination by latent semantic retrieval, common subsequences and answer checks.

Passages are weighted by TF-IDF, with document frequencies counted over every passage of the corpus. A randomised
SVD, sketched on the workers, gives a basis of the benchmark's passages; every window of every document is folded
into it, and windows whose cosine with a benchmark passage is high enough are candidates. Rare terms tell
passages apart but lie in directions of small variance in the corpus, so that the basis is taken from the benchmark
and not from the corpus. A candidate is confirmed if the longest common subsequence covers enough of the passage's
words and, for a paraphrase, if the passage's answer (its last sentence) is found too.

The corpus is read and cut into words once for every ``VOCABULARY`` words or ``PASSAGES`` passages of the benchmark, and kept as numbers of
words; frequencies are counted, and passages sought, over those numbers. Passages are sought in groups of ``GROUP``,
which bounds what goes to the driver and the tasks; each group is set against all rows. Inside a group every ``RANK``
passages have a basis of their own, so that a basis keeps every direction of its passages and a copy scores the same
in a benchmark of any size. Long items are cut into passages of nearly equal length, so that none is left out.

Defined cases: null and empty texts match nothing, as do benchmark items without words; documents are read whole;
of several windows for one item the best is reported, ties going to the first; repeated rows are reported each; other
columns pass by; an empty corpus or benchmark gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm.common import BATCH_ROWS, Scratch, arrow_map, column_of, ship, texts_of

SEGMENT = 32
#: Benchmark items longer than this are cut into passages of this many words at most; one then lies in four segments.
PASSAGE = 96
#: Words and passages of the benchmark that go with one reading of the corpus.
VOCABULARY, PASSAGES = 1_000_000, 100_000
#: Passages of one search over the rows (items are kept whole), and passages of one basis: all its directions are kept.
GROUP = 2000
RANK, OVERSAMPLE = 256, 16
#: Of a passage's own weight the share that a copy puts into one window, and of the cosine that a full copy inside a
#: window would have the share that makes a candidate.
COPY, COSINE = 0.5, 0.4
COVERED, SURE, ANSWERED = 0.6, 0.85, 0.6
MEMO = 250_000
EDGES = b".,;:!?\"'()[]"
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, all letters in lower case."""
    return text.lower().encode().split()


class Numbers(dict):
    """Word -> its number in the benchmark's vocabulary, or that of all other words; edge punctuation is left off."""

    def __init__(self, vocabulary: dict[bytes, int]) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        number = self[word] = self.vocabulary.get(word.strip(EDGES), len(self.vocabulary))
        return number


def number_type(size: int) -> type:
    return np.uint16 if size < 1 << 16 else np.uint32


def passages(items: list[tuple[int, str]]) -> list[tuple[int, list[bytes], list[bytes]]]:
    """(item, words, words of the answer) of each benchmark passage."""
    out = []
    for item, text in items:
        words = [w.strip(EDGES) for w in words_of(text or "")]
        words = [w for w in words if w]
        sentences = [s for s in SENTENCE.split((text or "").strip()) if s.strip()]
        answer = [w for w in (x.strip(EDGES) for x in words_of(sentences[-1])) if w] if len(sentences) > 1 else words[-8:]
        parts = max(1, -(-len(words) // PASSAGE))
        cuts = [len(words) * k // parts for k in range(parts + 1)]
        for first, end in zip(cuts, cuts[1:], strict=False):
            part = words[first:end]
            out.append((item, part, answer if end == len(words) else part[-8:]))
    return out


def numbered_words(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, words binary): the numbers of every row's words."""
    kind = number_type(len(vocabulary))
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)  # VOCABULARY words at most

    def make():
        numbers = Numbers(shipped.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = (words_of(t) for t in texts_of(batch, "text"))
            rows = [np.fromiter(map(numbers.__getitem__, words), kind, len(words)).tobytes() for words in lists]
            return pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(rows, pa.binary())], ["doc_id", "words"])

        return step

    return arrow_map(docs, make, f"doc_id {dict(docs.dtypes)['doc_id']}, words binary")


def document_frequencies(coded: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many segments of the corpus each word occurs, and the number of all segments."""
    kind = number_type(size)
    ship(coded.sparkSession)
    coded.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(size + 1, np.int64), 0
        for batch in batches:
            for raw in column_of(batch, "words").to_pylist():
                words = np.frombuffer(raw, kind)
                pairs = np.arange(len(words), dtype=np.int64) // SEGMENT * (size + 1) + words
                pairs.sort()
                first = np.concatenate([[True], pairs[1:] != pairs[:-1]])[: len(pairs)]
                counts += np.bincount(pairs[first] % (size + 1), minlength=size + 1)
                n += -(-len(words) // SEGMENT)
        held = np.flatnonzero(counts[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1)), pa.array(np.append(counts[held], n))], ["term", "n"])

    rows = coded.select("words").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row per word of the vocabulary
    found = np.zeros(size + 1, np.int64)
    found[column_of(rows, "term").to_numpy()] = column_of(rows, "n").to_numpy()
    return found[:-1], int(found[-1])


def weights(frequencies: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequencies, smoothed so that a term of all segments still has weight."""
    return np.log1p((1.0 + n) / (1.0 + frequencies))


def basis(spark, rows: list[np.ndarray], idf: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Term factors (terms x rank) of the TF-IDF passages by a randomised SVD.

    Two passes over the passages, each summed on the workers: the sketch Y = A'(A G) of a random G, whose
    orthonormal basis is Q, and the small matrix Q'A'A Q, whose eigenvectors turn Q into right singular vectors.
    """
    size = len(idf)
    width = min(rank + OVERSAMPLE, size)
    table = spark.createDataFrame([(r.tolist(),) for r in rows], "terms array<int>").repartition(min(len(rows), spark.sparkContext.defaultParallelism))

    def summed(right: np.ndarray, by_term: bool) -> np.ndarray:
        ship(spark)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            square = np.zeros((width, width))
            for batch in batches:
                for terms in column_of(batch, "terms").to_pylist():
                    at, tf = np.unique(np.array(terms, np.int64), return_counts=True)
                    row = tf * idf[at]
                    norm = math.sqrt(float(row @ row)) or 1.0
                    row = row / norm
                    shadow = row @ right[at]
                    if by_term:
                        for t, x in zip(at.tolist(), row.tolist(), strict=True):
                            total[t] = total.get(t, 0.0) + x * shadow
                    else:
                        square += np.outer(shadow, shadow)
            if not by_term:
                total = dict(enumerate(square))
            keys = list(total)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([total[k].tolist() for k in keys], pa.list_(pa.float64()))], ["k", "v"])

        parts = table.mapInArrow(run, "k long, v array<double>").select("k", F.posexplode("v").alias("c", "x")).groupBy("k", "c").agg(F.sum("x").alias("x"))
        out = np.zeros((size if by_term else width, width))
        columns = parts.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("c", "x"))).alias("v"))  # width entries each
        for k, v in columns.toLocalIterator():
            out[k, [e[0] for e in v]] = [e[1] for e in v]
        return out

    sketch = summed(np.random.default_rng(seed).standard_normal((size, width)), True)
    q, _ = np.linalg.qr(sketch)
    values, vectors = np.linalg.eigh(summed(q, False))
    order = [k for k in np.argsort(values)[::-1][:rank] if values[k] > 1e-9 * max(values.max(), 1e-30)]
    return (q @ vectors[:, order]).astype(np.float32)


def common_subsequence(masks: dict[int, int], size: int, sequence: list[int]) -> int:
    """Length of the longest common subsequence of a pattern (bit masks by word) and a sequence, by bit parallelism."""
    full = (1 << size) - 1
    v = full
    for x in sequence:
        m = masks.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def masks_of(pattern: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for k, x in enumerate(pattern):
        masks[x] = masks.get(x, 0) | 1 << k
    return masks


class Searcher:
    """A group of benchmark passages, ready to be looked for in documents; each block has (first, end, terms, factors).

    ``places`` gives the group's number of each word of the vocabulary, -1 for those that the group lacks.
    """

    def __init__(self, places: np.ndarray, found: list[tuple[int, np.ndarray, list[int]]], idf: np.ndarray, blocks: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        self.places, self.idf, self.kind = places, idf, number_type(len(places) - 1)
        self.items = [f[0] for f in found]
        self.patterns = [(masks_of(f[1].tolist()), len(f[1]), masks_of(f[2]), len(f[2])) for f in found]
        self.norms = np.array([math.sqrt(float((np.unique(f[1], return_counts=True)[1] ** 2 * idf[np.unique(f[1])] ** 2).sum())) or 1.0 for f in found])
        self.other = float(np.mean(idf**2))
        self.least = COSINE * np.sqrt(np.minimum(1.0, np.array([f[1].size for f in found]) / (2.0 * SEGMENT)))
        #: a whole copy puts half its weight or more into one window, however heavy the words beside it are
        self.enough = 0.999 * COPY * self.norms
        self.blocks = []
        for first, end, held, factors in blocks:
            row = np.full(len(idf), -1, np.int32)
            row[held] = np.arange(len(held))
            weighed = factors * idf[held, None].astype(np.float32)
            queries = np.array([weighed[row[f[1]]].sum(0) for f in found[first:end]], np.float32)
            self.blocks.append((first, end, row, weighed, (queries / self.norms[first:end, None]).astype(np.float32)))

    def find(self, raw: bytes) -> list[tuple[int, float, float, float]]:
        """(item, cosine, share of its words in order, share of its answer) of each passage confirmed in a row's words."""
        ids = self.places[np.frombuffer(raw, self.kind)]
        n = len(ids)
        segments = -(-n // SEGMENT)
        known = np.flatnonzero(ids >= 0)
        if not len(known):
            return []
        terms, places = ids[known], known // SEGMENT
        outside = np.full(segments + 1, SEGMENT) - np.bincount(places, minlength=segments + 1)
        outside[segments - 1 :] -= [segments * SEGMENT - n, SEGMENT]
        width = len(self.idf)
        pair = places * width + terms
        pair.sort()
        cut = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        tf = np.diff(np.append(cut, len(pair)))
        pair = pair[cut]
        inside = np.bincount(pair // width, (tf * self.idf[pair % width]) ** 2, minlength=segments + 1) + outside * self.other
        size = np.sqrt(inside[:-1] + inside[1:])
        best: dict[int, tuple[float, float, float]] = {}
        sequence: list[int] = []
        for first, end, row, factors, queries in self.blocks:
            rows, at = row[terms], places
            here = rows >= 0  # a word of an answer alone is in no basis
            rows, at = rows[here], places[here]
            if not len(rows):
                continue
            cuts = np.flatnonzero(np.diff(at, prepend=-1))
            sums = np.zeros((segments + 1, factors.shape[1]), np.float32)
            sums[at[cuts]] = np.add.reduceat(factors[rows], cuts, axis=0)
            latent = sums[:-1] + sums[1:]
            least, enough = self.least[first:end], self.enough[first:end]
            reach = np.sqrt((latent**2).sum(1))
            worth = np.flatnonzero((reach >= least.min() * size) | (reach >= enough.min()))
            if not len(worth):
                continue
            dots = latent[worth] @ queries.T
            cosines = dots / np.maximum(size[worth, None], 1e-12)
            for w, p in zip(*np.nonzero((cosines >= least) | (dots >= enough)), strict=True):
                masks, length, answer, answer_length = self.patterns[first + p]
                start = int(worth[w]) * SEGMENT
                sequence = sequence or ids.tolist()
                region = sequence[max(0, start - length // 2) : start + 2 * SEGMENT + length // 2]
                share = common_subsequence(masks, length, region) / length
                if share < COVERED:
                    continue
                answered = common_subsequence(answer, answer_length, region) / answer_length if answer_length else 1.0
                if share < SURE and answered < ANSWERED:
                    continue
                item, value = self.items[first + p], (share, answered, min(1.0, float(cosines[w, p])))
                if item not in best or value > best[item]:
                    best[item] = value
        return [(item, v[2], v[0], v[1]) for item, v in sorted(best.items())]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(id, item_id, cosine, lcs_share, answer_share): a row for each document and benchmark item found in it."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "leaks")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    schema = f"doc_id {dict(source.dtypes)['doc_id']}, item_id long, cosine double, lcs_share double, answer_share double"
    found: list[DataFrame] = []

    def search(group: list[tuple[int, list[bytes], list[bytes]]], vocabulary: dict[bytes, int], coded: DataFrame, frequencies: np.ndarray, n: int) -> DataFrame:
        own = {w: k for k, w in enumerate(sorted({w for _, words, answer in group for w in [*words, *answer]}))}
        numbered = [(i, np.array([own[w] for w in words], np.int64), [own[w] for w in answer]) for i, words, answer in group]
        numbers = np.array([vocabulary[w] for w in own], np.int64)
        idf = weights(frequencies[numbers], n)
        places = np.full(len(vocabulary) + 1, -1, np.int32)
        places[numbers] = np.arange(len(own))
        blocks = []
        for first in range(0, len(numbered), RANK):
            part = [x[1] for x in numbered[first : first + RANK]]
            held = np.unique(np.concatenate(part))
            blocks.append((first, first + len(part), held, basis(spark, [np.searchsorted(held, x) for x in part], idf[held])))

        def make():
            searcher = Searcher(places, numbered, idf, blocks)

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                rows = [(k, *hit) for k, words in enumerate(column_of(batch, "words").to_pylist()) if words for hit in searcher.find(words)]
                ids = column_of(batch, "doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                return pa.RecordBatch.from_arrays([ids, pa.array([r[1] for r in rows], pa.int64()), *[pa.array([r[c] for r in rows], pa.float64()) for c in (2, 3, 4)]], ["doc_id", "item_id", "cosine", "lcs_share", "answer_share"])

            return step

        return scratch.put(arrow_map(coded, make, schema))

    def against(held: list[tuple[int, list[bytes], list[bytes]]], words: dict[bytes, bytes]) -> None:
        vocabulary = {w: k for k, w in enumerate(sorted(words))}
        coded = scratch.put(numbered_words(source, vocabulary))
        frequencies, n = document_frequencies(coded, len(vocabulary))
        group: list[tuple[int, list[bytes], list[bytes]]] = []
        for k, passage in enumerate(held):
            group.append(passage)
            # the passages of an item stay together
            if k + 1 == len(held) or (len(group) >= GROUP and held[k + 1][0] != passage[0]):
                found.append(search(group, vocabulary, coded, frequencies, n))
                group = []
        scratch.drop(coded)

    wanted = benchmark.select(F.col(item_col).cast("long"), F.col(item_text).cast("string")).where(F.col(item_col).isNotNull() & F.col(item_text).isNotNull()).orderBy(item_col, item_text)
    held: list[tuple[int, list[bytes], list[bytes]]] = []
    words: dict[bytes, bytes] = {}
    for item, text in wanted.toLocalIterator():
        if held and (len(words) >= VOCABULARY or len(held) >= PASSAGES) and held[-1][0] != item:
            against(held, words)
            held, words = [], {}
        for _, part, answer in passages([(item, text)]):
            if part:  # each word is held once
                held.append((item, [words.setdefault(w, w) for w in part], [words.setdefault(w, w) for w in answer]))
    if held:
        against(held, words)
    out = reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)
    return out.withColumnRenamed("doc_id", id_col)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows in which no benchmark item is found, with their own columns."""
    # written first, so that the join knows its size and need not shuffle the documents
    work = Scratch(docs.sparkSession, "leaks")
    found = Scratch(docs.sparkSession, "hits").put(contaminated(docs, benchmark, scratch=work).select(F.col("doc_id").alias("__hit")).distinct())
    work.clear()
    return docs.join(found, docs["doc_id"] == F.col("__hit"), "left_anti").select(*docs.columns)
